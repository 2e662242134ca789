"""CSV sources: enforced schema, NaN to null, records that do not fit."""

import pytest

from pastline.sources import csv_tables as CSV

SCHEMA = "id bigint, name string, at timestamp_ntz, x double"


def write(path, text):
    path.write_text(text)
    return f"file://{path}"


def test_records_that_fit_and_others(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,name,at,x\n1,a,2020-01-02 03:04:05,1.5\n2,,2020-01-02 03:04:05,NaN\n3,c,,\n"
                                     "x4,d,2020-01-02 03:04:05,1\n5,e,2020-01-02 03:04:05,one\n6,f,2020-01-02 03:04:05,1,9\n")
    rows = CSV.read_csv(spark, path, SCHEMA)
    good, bad = CSV.split_corrupt(rows)
    assert [(r.id, r.name, r.x) for r in good.orderBy("id").collect()] == [(1, "a", 1.5), (2, None, None), (3, "c", None)]
    assert good.columns == ["id", "name", "at", "x"]
    assert sorted(r[CSV.CORRUPT].split(",")[0] for r in bad.collect()) == ["5", "6", "x4"]
    assert good.select("id").count() == 3 and good.count() == 3  # whichever columns are used
    report = CSV.csv_report(rows).first()
    assert (report.n_records, report.n_corrupt, report.null_x, report.null_at, report.null_id) == (6, 3, 2, 1, 0)


def test_header_has_to_match(spark, tmp_path):
    path = write(tmp_path / "b.csv", "id,label,at,x\n1,a,2020-01-02 03:04:05,1.5\n")
    with pytest.raises(Exception, match="does not conform"):
        CSV.read_csv(spark, path, SCHEMA).collect()


def test_empty_file(spark, tmp_path):
    assert CSV.read_csv(spark, write(tmp_path / "c.csv", "id,name,at,x\n"), SCHEMA).collect() == []
