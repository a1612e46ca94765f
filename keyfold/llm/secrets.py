"""Secret scans over an incremental blob ledger.

Only DataFrame functions: no Python code runs on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.llm.common import cut
from keyfold.session import scratch_path
from keyfold.sources import fs


@dataclass(frozen=True)
class Rule:
    """One kind of secret: matches are leftmost and non-overlapping; those whose ``group``
    has fewer than ``least`` characters are dropped. ``version`` changes with the pattern."""
    kind: str
    version: int
    pattern: str
    group: int
    least: int
    base: bool = True

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The base kinds are fixed values. `access` and `hex` have their least length inside the
# pattern: both match maximal runs, so a too short match never hides a longer one.
RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}", 0, 18),
    Rule("hex", 1, r"[0-9a-f]{16,}", 0, 16),
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, base=False),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1, base=False),
    Rule("forge", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1, base=False),
)
SPANS = "array<struct<start:int,end:int,ord:int,kind:string>>"
#: Matches summed as one block when offsets are added up, so a text with very many
#: matches costs blocks^2 + matches * BLOCK steps instead of matches^2.
BLOCK = 256


def _offsets(pairs: Column) -> Column:
    """Start and end of every match of ``pairs`` (array of struct(gap, size, long enough)):
    running sums within blocks, then over blocks."""
    empty = F.array().cast("array<struct<start:int,end:int,ok:boolean>>")

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + p["gap"]
        end = start + p["size"]
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
            start.alias("start"), end.alias("end"), p["ok"].alias("ok")))).alias("out"))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / BLOCK).cast("int")), lambda b: F.aggregate(
        F.slice(pairs, b * BLOCK + 1, BLOCK), F.struct(F.lit(0).alias("at"), empty.alias("out")), step))

    def join(acc: Column, block: Column) -> Column:
        moved = F.transform(block["out"], lambda s: F.struct(
            (s["start"] + acc["at"]).alias("start"), (s["end"] + acc["at"]).alias("end"), s["ok"].alias("ok")))
        return F.struct((acc["at"] + block["at"]).alias("at"), F.concat(acc["out"], F.array(moved)).alias("out"))

    total = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), empty_nested(empty).alias("out")), join)
    return F.flatten(total["out"])


def empty_nested(of: Column) -> Column:
    """An empty array of arrays like ``of``."""
    return F.slice(F.array(of), 1, 0)


def _pairs(gaps: Column, whole: Column, checked: Column, least: int) -> Column:
    """Per match: the length of the piece before it, its own, and whether it is long enough."""
    matches = F.zip_with(whole, checked, lambda m, g: F.struct(
        F.length(m).alias("size"), (F.length(g) >= least).alias("ok")))
    return F.zip_with(F.slice(gaps, 1, F.size(whole)), matches, lambda gap, m: F.struct(
        F.length(gap).alias("gap"), m["size"].alias("size"), m["ok"].alias("ok")))


def _scan(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, rules, spans) of ``texts`` (blob, text, todo): spans of the rules in todo.
    Offsets are code points: the lengths of the pieces between matches and of the matches,
    added up."""
    df = texts
    for r in rules:
        due = F.array_contains("todo", r.key)
        df = df.withColumn(f"m_{r.kind}", F.when(due, F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0))))
    for r in rules:
        whole = F.col(f"m_{r.kind}")
        gaps = F.split("text", r.pattern, -1)
        checked = F.regexp_extract_all("text", F.lit(r.pattern), F.lit(r.group)) if r.group else whole
        df = df.withColumn(f"m_{r.kind}", F.when(F.size(whole) > 0, _pairs(gaps, whole, checked, r.least)))

    def spans_of(r: Rule, order: int) -> Column:
        kept = F.filter(_offsets(F.col(f"m_{r.kind}")), lambda s: s["ok"])
        return F.when(F.col(f"m_{r.kind}").isNull(), F.array().cast(SPANS)).otherwise(F.transform(
            kept, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                     F.lit(order).alias("ord"), F.lit(r.kind).alias("kind"))))

    spans = [spans_of(r, k) for k, r in enumerate(rules)]
    return df.select("blob", F.col("todo").alias("rules"), F.concat(*spans).alias("spans"))


def scan(spark: SparkSession, docs: DataFrame, ledger: str, id_col: str = "doc_id", text_col: str = "text",
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, n_<kind> per base kind, base_sha256, spans) of every row of ``docs``.

    ``ledger`` is a folder of Parquet rows (blob, rules, spans): which rule versions were
    scanned over which blob, and what they found. Every text is a path's version of a blob
    addressed by the SHA-256 of its bytes. Pairs of blob and rule version that the ledger
    lacks are scanned, once per blob however many paths hold it, and appended; findings
    are then joined back to all paths. So later versions of a document, copies and reruns
    cost nothing for what was seen, and a new rule version rescans only itself. An append
    that a crash cut short leaves no rows; the next call scans what is missing.

    Spans are kind:start:end (code points, end exclusive) by start, then kind in the order
    of ``rules``; base_sha256 is the SHA-256 of the base kinds' spans so joined by commas.

    Null text: as empty. Null doc_id: a path like any other. Repeated rows: each is
    returned. Empty table: empty result. Other columns are not read."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    paths = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"))
    addressed = paths.withColumn("blob", F.sha2(F.col("text").cast("binary"), 256))
    index = cut(addressed.select("doc_id", "blob"))
    wanted = F.array(*[F.lit(r.key) for r in rules])
    firsts = index.groupBy("blob").agg(F.min("doc_id").alias("path"))
    if fs.exists(spark, ledger):
        seen = spark.read.parquet(ledger).groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
        firsts = firsts.join(seen, "blob", "left").withColumn(
            "todo", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))).drop("seen")
    else:
        firsts = firsts.withColumn("todo", wanted)
    unseen = firsts.where(F.size("todo") > 0).select(F.col("blob").alias("due"), "path", "todo")
    texts = addressed.join(unseen.hint("shuffle_hash"), (F.col("blob") == F.col("due"))
                           & F.col("doc_id").eqNullSafe(F.col("path"))).select("blob", "text", "todo")
    _scan(texts, rules).write.mode("append").parquet(ledger)

    current = [r.kind for r in rules]
    found = (spark.read.parquet(ledger).where(F.size("spans") > 0)
             .groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(
                 F.filter("spans", lambda s: s["kind"].isin(current)))))).alias("spans")))
    found = cut(found.withColumnRenamed("blob", "of"))
    spans = F.coalesce("spans", F.array().cast(SPANS))
    base = [r.kind for r in rules if r.base]

    def joined(a: Column) -> Column:
        return F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return (index.join(found, F.col("blob") == F.col("of"), "left").withColumn("spans", spans)
            .select("doc_id", *[count(k) for k in base],
                    F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"),
                    joined(F.col("spans")).alias("spans")))


def scan_fresh(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``scan`` with an empty ledger in the shared folder."""
    return scan(spark, docs, scratch_path(spark, "blob-ledger"))


def _sql() -> str:
    """The same rows in DuckDB. The patterns are written out here on their own."""
    kinds = [("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
             ("access", r"AKIA[A-Z0-9]+", 0, 18), ("hex", r"[0-9a-f]+", 0, 16),
             ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
             ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
             ("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1)]
    parts = []
    for o, (kind, p, g, least) in enumerate(kinds):
        parts.append(f"""
  SELECT row, '{kind}' AS kind, {o} AS ord, start, start + size AS stop FROM (
    SELECT row, gl, size, (sum(gap + size) OVER (PARTITION BY row ORDER BY i) - size)::BIGINT AS start FROM (
      SELECT row, i, length(piece) AS gap, length(whole) AS size, length(checked) AS gl FROM (
        SELECT row, unnest(range(1, len(m) + 1)) AS i, unnest(s[1:len(m)]) AS piece, unnest(m) AS whole, unnest(g) AS checked
        FROM (SELECT row, string_split_regex(text, '{p}') AS s, regexp_extract_all(text, '{p}') AS m,
                     regexp_extract_all(text, '{p}', {g}) AS g FROM t))))
  WHERE gl >= {least}""")
    return f"""
WITH t AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({" UNION ALL ".join(parts)}),
joined AS (SELECT row, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) FILTER (ord < 3) AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) AS spans FROM spans GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN joined USING (row)
"""


SQL = _sql()
