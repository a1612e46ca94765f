"""Exact duplicates with a heavy-hitter split.

A Misra-Gries summary finds the frequent digests; their verified winners are broadcast and
settle the frequent rows where they lie. Only the remaining digests, none of which holds
more than a known share of the rows, are shuffled.

Only DataFrame functions: no Python code runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyfold.llm.common import cut

#: White space that counts as one space.
SPACE = r"[\x20\x09-\x0D]+"
#: Counters of the Misra-Gries summary. Spark's ``approx_top_k`` aggregates keep it as the
#: mergeable frequent-items sketch: a full table takes a common amount off every counter.
#: What was taken off is at most 3.5 / COUNTERS of the rows, and a digest is reported when
#: its count stands above that, so every digest with over 7 / COUNTERS (0.086 %) is found.
COUNTERS = 8192
#: Digests above this share of the rows are split off. It lies above the summary's bound,
#: so fewer than 1 / SHARE digests qualify and none of them is missed.
SHARE = 0.001
#: Summaries of the map tasks are merged in so many groups before the last merge.
MERGES = 64


def digest(text: Column) -> Column:
    """SHA-256 (binary) of the whole text with each run of white space as one space; null as empty."""
    plain = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE, " ")
    return F.unhex(F.sha2(plain.cast("binary"), 256))


def frequent(rows: DataFrame) -> DataFrame:
    """(digest, win, n) of every digest of ``rows`` (doc_id, digest, row) above ``SHARE`` of
    the rows, at most 1 / SHARE of them: candidates by the summary over 64-bit keys, then
    exact counts and winners of the candidates' rows, combined map-side."""
    keyed = rows.select(F.xxhash64("digest").alias("key"), F.pmod(F.spark_partition_id(), F.lit(MERGES)).alias("part"))
    parts = keyed.groupBy("part").agg(F.expr(f"approx_top_k_accumulate(key, {COUNTERS})").alias("summary"))
    # grouped by a constant: an empty table then gives no summary instead of an error
    found = parts.groupBy(F.lit("all")).agg(F.expr("approx_top_k_combine(summary)").alias("summary"))
    keys = cut(found.select(F.explode(F.expr(f"approx_top_k_estimate(summary, {round(1 / SHARE)})")).alias("f"))
               .select(F.col("f.item").alias("key")))
    least = rows.count() * SHARE
    verified = (rows.join(F.broadcast(keys), F.xxhash64("digest") == F.col("key"))
                .groupBy("digest").agg(F.min(_order()).alias("win"), F.count(F.lit(1)).alias("n")))
    return cut(verified.where((F.col("n") > 1) & (F.col("n") > least)))


def _order() -> Column:
    """The row with the smallest id wins, null last; of rows with one id, the first read."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of ``docs``.

    Texts are equal when identical after replacing each run of ASCII white space by one
    space. Of equal texts exactly one row is kept, the one with the smallest id.

    The texts are read once; then only ids and digests move. Rows of frequent digests meet
    their broadcast winners (fewer than 1 / ``SHARE`` rows) and are never shuffled. The
    others are grouped and joined by digest; no such group exceeds ``SHARE`` of the rows.

    Null text: as empty. Null id: after every other; a group of null ids only has a null
    keep_id and one of its rows is kept. Repeated rows (same id and text): one is kept.
    Empty table: empty result. Other columns are not read."""
    rows = cut(docs.select(F.col(f"`{id_col}`").alias("doc_id"), digest(F.col(f"`{text_col}`")).alias("digest"))
               .withColumn("row", F.monotonically_increasing_id()))
    hot = frequent(rows).withColumnRenamed("digest", "of")
    same = F.col("digest") == F.col("of")
    settled = rows.join(F.broadcast(hot), same)
    rest = rows.join(F.broadcast(hot.select("of")), same, "left_anti")
    firsts = rest.groupBy(F.col("digest").alias("of")).agg(F.min(_order()).alias("win"), F.count(F.lit(1)).alias("n"))
    return (settled.unionByName(rest.join(firsts, same))
            .select("doc_id", F.col("win.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
                    (F.col("row") == F.col("win.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``groups`` keeps, with all their columns.

    Losers of frequent digests go map-side; of the rest the first row per digest is taken,
    reduced per map task before the shuffle (window group limit). Of rows with equal id and
    text but other columns that differ, one stays. Other cases as in ``groups``."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), digest(F.col(f"`{text_col}`")).alias("digest"))
    hot = frequent(cut(rows.withColumn("row", F.monotonically_increasing_id()))).select(
        F.col("digest").alias("__kf_of"), F.col("win.doc_id").alias("__kf_win"))
    keyed = docs.withColumn("__kf_digest", digest(F.col(f"`{text_col}`")))
    own = F.col(f"`{id_col}`")
    left = (keyed.join(F.broadcast(hot), F.col("__kf_digest") == F.col("__kf_of"), "left")
            .where(F.col("__kf_of").isNull() | own.eqNullSafe(F.col("__kf_win"))))
    first = Window.partitionBy("__kf_digest").orderBy(own.asc_nulls_last())
    return (left.withColumn("__kf_rank", F.row_number().over(first)).where("__kf_rank = 1")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


#: The same rows in DuckDB.
SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""
