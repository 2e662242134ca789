"""CSV sources with an enforced schema (S1, S2, and the read-back of S9).

Nothing is inferred: the schema is given, the header has to name its columns
in order, and a record that does not fit (a value that is no number, a field
too many or too few) is kept aside in ``CORRUPT`` instead of being cast to
nulls unseen. NaN in a number column is a missing value and becomes null, so
nulls have one convention behind the source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructType

CORRUPT = "_corrupt"


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in any floating column becomes null; other columns stay."""
    floating = {f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))}
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in floating else F.col(c) for c in df.columns])


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: str | StructType) -> DataFrame:
    """All records of CSV files with a header, with ``CORRUPT`` holding the
    text of those that do not fit ``schema`` (null for the others).

    Raises where a header does not name the schema's columns. A record is
    judged whole, whichever columns are used with ``CORRUPT`` later: with
    pruned columns one that does not fit would count as one that does. A missing field is
    null; an empty table gives no rows.
    """
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = StructType([*kind.fields]).add(CORRUPT, StringType())
    rows = (spark.read.schema(full).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).option("nanValue", "NaN").csv(path if isinstance(path, str) else list(path)))
    # the scan converts the columns in use only; this keeps all of them in use wherever CORRUPT is
    whole = F.xxhash64(*[f.name for f in kind.fields]) >= F.lit(-(1 << 63))
    return nan_to_null(rows.withColumn(CORRUPT, F.when(whole, F.col(CORRUPT))))


def split_corrupt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the records that fit, without ``CORRUPT``; the texts of the others)."""
    good = rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = rows.where(F.col(CORRUPT).isNotNull())
    return good, bad


def csv_report(rows: DataFrame) -> DataFrame:
    """One row: records, records that do not fit, and nulls per column among those that fit."""
    fits = F.col(CORRUPT).isNull()
    cols = [c for c in rows.columns if c != CORRUPT]
    return rows.agg(F.count(F.lit(1)).alias("n_records"), F.count_if(~fits).alias("n_corrupt"),
                    *[F.count_if(fits & F.col(c).isNull()).alias(f"null_{c}") for c in cols])
