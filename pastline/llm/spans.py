"""Positions of pattern matches with built-in functions only.

``regexp_extract_all`` gives the matches of a text and ``split`` the pieces
between them, both leftmost and non-overlapping; so match ``i`` starts after
pieces 0..i and matches 0..i-1. Lengths are summed by a window per text, in
time linear in the matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pastline.llm.common import bind


def match_parts(text: Column, kind: int, pattern: str, passes: Column | None = None, keep_value: bool = False) -> Column:
    """Array of (kind, i, gap, len, ok, value) for the matches of a Java pattern.

    ``passes``: a lambda from the matched string to whether it counts; matches
    that fail still take their place. Texts without a match give an empty array.
    """
    def build(found: Column) -> Column:
        return F.transform(F.arrays_zip(found.alias("m"), F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)).alias("g")),
                           lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("len"),
                                                 (passes(x["m"]) if passes else F.lit(True)).alias("ok"),
                                                 (x["m"] if keep_value else F.lit(None).cast("string")).alias("value")))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return bind(found, lambda f: F.when(F.size(f) > 0, build(f)).otherwise(
        F.array().cast("array<struct<kind:int,i:int,gap:int,len:int,ok:boolean,value:string>>")))


def positions(parts: DataFrame, key: str) -> DataFrame:
    """(key, kind, start, end, value) of the parts that count; ``parts`` has one row per match."""
    upto = Window.partitionBy(key, "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    return parts.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(upto)).filter("ok").select(
        key, "kind", (F.col("end") - F.col("len")).alias("start"), "end", "value")
