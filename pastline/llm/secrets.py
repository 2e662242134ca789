"""Secret scans with multipart credential linking.

Base spans (an assignment, an access key, a long hex run) are secrets on
their own. Weak candidates (a user or client name, an opaque mixed token, an
endpoint) are reported only when a complementary part lies in the same scope:
the interval of ``reach`` characters around them. Parts have roles
(identifier, secret, endpoint); an identifier or endpoint needs a secret, a
weak secret needs an identifier or endpoint.

The scopes of two parts meet where at most ``2 * reach`` characters lie between
them. The interval join is a sweep over the parts of a text in order of start,
once forwards and once backwards with running extremes: the farthest end
before and the nearest start after a part, by role, decide whether any lies
within reach. Nothing is paired, and the work is linear in the parts after the
two sorts (a frame that ends at the last row would be gone through anew for
every part).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pastline.llm.common import bind, source_table, stored, text_key
from pastline.llm.spans import match_parts, positions

REACH = 120


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# fixed values: the base patterns and their order
ASSIGN = "(" + "|".join(map(_either, ("password", "passwd", "secret", "token"))) + "|" + _either("api") + "_?" + _either("key") + \
    r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"  # 20 characters or more
HEX = "[0-9a-f]{24,}"
# weak parts
IDENT = "(" + "|".join(map(_either, ("username", "user", "login", "account", "client_id", "client"))) + r""")["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}"""
OPAQUE = "[A-Za-z0-9+/_-]{20,}"
ENDPOINT = r"""[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\x20\x09-\x0D"'<>]+"""
#: kind -> (name, pattern, role, weak)
KINDS = (("assign", ASSIGN, "s", False), ("access", ACCESS, "i", False), ("hex", HEX, "s", False),
         ("ident", IDENT, "i", True), ("opaque", OPAQUE, "s", True), ("endpoint", ENDPOINT, "e", True))


def _passes(name: str, m: Column) -> Column:
    if name == "assign":  # its value has 6 characters or more
        return F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6
    if name == "opaque":  # letters of both cases and a digit
        return m.rlike("[A-Z]") & m.rlike("[a-z]") & m.rlike("[0-9]")
    return F.lit(True)


def find_spans(docs: DataFrame, reach: int = REACH) -> tuple[DataFrame, DataFrame]:
    """(one stored row per document: doc_id, row_id, text_key; its reported spans: row_id, kind, start, end)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    parts = F.concat(*[match_parts(F.col("text"), k, p, lambda m, n=n: _passes(n, m)) for k, (n, p, _, _) in enumerate(KINDS)])
    rows = stored(docs.select("doc_id", text.alias("text")).select(
        "doc_id", F.monotonically_increasing_id().alias("row_id"),
        text_key().alias("text_key"), parts.alias("parts")), "secret-parts")
    spans = positions(rows.select("row_id", F.inline("parts")), "row_id").drop("value")
    return rows.drop("parts"), _linked(spans, reach)


def _linked(spans: DataFrame, reach: int) -> DataFrame:
    """Base spans, and weak ones that overlap no base span and have a complementary part within reach."""
    weak = F.col("kind").isin([k for k, x in enumerate(KINDS) if x[3]])
    role = F.element_at(F.array(*[F.lit(x[2]) for x in KINDS]), F.col("kind") + 1)
    before = (Window.unboundedPreceding, -1)
    back = Window.partitionBy("row_id").orderBy("start", "kind").rowsBetween(*before)
    ahead = Window.partitionBy("row_id").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(*before)
    parts = spans.withColumn("weak", weak).withColumn("role", role)
    parts = parts.withColumn("end_before", F.max(F.when(~F.col("weak"), F.col("end"))).over(back)).withColumn(
        "start_after", F.min(F.when(~F.col("weak"), F.col("start"))).over(ahead))
    covered = F.coalesce(F.col("end_before") > F.col("start"), F.lit(False)) | F.coalesce(F.col("start_after") < F.col("end"), F.lit(False))
    clear = parts.filter(~F.col("weak") | ~covered)
    clear = clear.withColumns({f"end_{r}": F.max(F.when(F.col("role") == r, F.col("end"))).over(back) for r in "sie"})
    clear = clear.withColumns({f"start_{r}": F.min(F.when(F.col("role") == r, F.col("start"))).over(ahead) for r in "sie"})
    near = {r: F.coalesce(F.col(f"end_{r}") + 2 * reach >= F.col("start"), F.lit(False)) |
            F.coalesce(F.col(f"start_{r}") - 2 * reach <= F.col("end"), F.lit(False)) for r in "sie"}
    linked = clear.withColumn("s", near["s"]).withColumn("x", near["i"] | near["e"])
    return linked.filter(~F.col("weak") | F.when(F.col("role") == "s", F.col("x")).otherwise(F.col("s"))).select("row_id", "kind", "start", "end")


def scan_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per row of ``docs`` (reads doc_id and text; others are ignored).

    Columns: doc_id, n_assign, n_access, n_hex, base_sha256, spans. Offsets
    are code points, ends exclusive. Null text is empty; a text without spans
    has the hash of the empty string and empty ``spans``. Repeated rows are
    scanned each on its own.
    """
    rows, spans = find_spans(docs, reach)
    name = F.element_at(F.array(*[F.lit(x[0]) for x in KINDS]), F.col("kind") + 1)
    told = spans.select("row_id", "kind", F.struct("start", "kind", F.concat_ws(":", name, "start", "end").alias("t")).alias("x")).groupBy("row_id").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{x[0]}") for k, x in enumerate(KINDS) if not x[3]],
        F.sort_array(F.collect_list("x")).alias("found"))

    def joined(a: Column) -> Column:
        return F.concat_ws(",", F.transform(F.coalesce(a, F.array().cast("array<struct<start:bigint,kind:int,t:string>>")), lambda x: x.t))
    out = rows.join(told, "row_id", "left")
    return out.select("doc_id", *[F.coalesce(f"n_{x[0]}", F.lit(0)).cast("long").alias(f"n_{x[0]}") for x in KINDS if not x[3]],
                      F.sha2(joined(F.filter("found", lambda x: x.kind < 3)), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def mask_secrets(docs: DataFrame, reach: int = REACH, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every reported span of ``text`` replaced by ``mask``; all columns stay.

    Spans that overlap are masked together. Null texts stay null. Rows are
    told apart by (doc_id, hash of the text), so repeated rows are masked alike.
    """
    rows, spans = find_spans(docs, reach)
    listed = spans.groupBy("row_id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__spans"))
    found = stored(rows.join(listed, "row_id").dropDuplicates(["doc_id", "text_key"]).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "__spans"), "secret-spans")
    masked = F.aggregate(
        F.col("__spans"), F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda a, x: F.when(x.end <= a.at, a).otherwise(F.struct(
            F.when(x.start < a.at, a.out).otherwise(F.concat(a.out, F.substr("text", (a.at + 1).cast("int"), (x.start - a.at).cast("int")), F.lit(mask))).alias("out"),
            x.end.alias("at"))),
        lambda a: F.concat(a.out, F.substr("text", (a.at + 1).cast("int"))))
    joined = docs.join(found, F.col("doc_id").eqNullSafe(F.col("__id")) & (text_key() == F.col("__key")), "left")
    text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(masked)
    return joined.withColumn("text", text).select(*docs.columns)


def secrets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(source_table(spark, sf_dir, "documents", "doc_id", "text"))


def _sql() -> str:
    """The same in DuckDB, the links by a join of overlapping scopes."""
    quote = lambda p: "'" + p.replace("'", "''") + "'"
    ok = {"assign": f"length(regexp_extract(m, {quote(ASSIGN)}, 2)) >= 6",
          "opaque": "regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[0-9]')"}
    found = " UNION ALL ".join(
        f"SELECT doc_id, {k} AS kind, '{n}' AS name, '{r}' AS role, {w} AS weak, regexp_extract_all(text, {quote(p)}) AS ms, string_split_regex(text, {quote(p)}) AS gs FROM t"
        for k, (n, p, r, w) in enumerate(KINDS))
    passes = "CASE name " + " ".join(f"WHEN '{n}' THEN {x}" for n, x in ok.items()) + " ELSE true END"
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
f AS ({found}),
u AS (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM f WHERE len(ms) > 0),
v AS (SELECT doc_id, kind, name, role, weak, ms[i] AS m, sum(length(gs[i]) + length(ms[i])) OVER (PARTITION BY doc_id, kind ORDER BY i) AS "end" FROM u),
p AS (SELECT doc_id, kind, name, role, weak, "end" - length(m) AS start, "end" FROM v WHERE {passes}),
c AS (SELECT * FROM p WHERE NOT weak OR NOT EXISTS (SELECT 1 FROM p b WHERE b.doc_id = p.doc_id AND NOT b.weak AND b.start < p."end" AND b."end" > p.start)),
k AS (SELECT * FROM c WHERE NOT weak OR EXISTS (SELECT 1 FROM c b WHERE b.doc_id = c.doc_id AND b.start - {REACH} <= c."end" + {REACH} AND b."end" + {REACH} >= c.start - {REACH}
      AND CASE WHEN c.role = 's' THEN b.role <> 's' ELSE b.role = 's' END)),
a AS (SELECT doc_id, count(*) FILTER (name = 'assign') AS n_assign, count(*) FILTER (name = 'access') AS n_access, count(*) FILTER (name = 'hex') AS n_hex,
      string_agg(name || ':' || start || ':' || "end", ',' ORDER BY start, kind) FILTER (NOT weak) AS base,
      string_agg(name || ':' || start || ':' || "end", ',' ORDER BY start, kind) AS spans FROM k GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM t LEFT JOIN a USING (doc_id)
"""


SQL = _sql()
