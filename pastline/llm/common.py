"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pastline.sources.scratch import stored

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: The white space that separates words, as characters and as a Java/RE2 class.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; null gives none."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+", -1))


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves 1 modulo 3; a null id is held out too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def source_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    from pastline.sources.tables import read_table
    return read_table(spark, sf_dir, name, list(columns) or None)


def text_key() -> Column:
    """64-bit hash of the text, which with doc_id tells rows apart."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def keep_rows(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a true ``kept`` in ``verdicts`` (doc_id, text_key, kept); all columns stay.

    Rows that repeat both doc_id and text (null and empty are one) are kept
    once where some of them are dropped and some kept: the row that is
    smallest in its further columns. The dropped keys are the small side, and
    the join is planned by their stored size.
    """
    told = verdicts.groupBy("doc_id", "text_key").agg(F.min("kept").alias("all_kept"), F.max("kept").alias("some_kept"))
    gone = stored(told.filter("not all_kept").select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "some_kept"), "dropped")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (text_key() == F.col("__key"))
    rest = docs.join(gone.drop("some_kept"), same, "left_anti")
    twice = docs.join(gone.filter("some_kept").drop("some_kept"), same, "left_semi")
    part = twice.groupBy(F.col("doc_id").alias("__id"), text_key().alias("__key")).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("__row"))
    return rest.unionByName(part.select("__row.*"))
