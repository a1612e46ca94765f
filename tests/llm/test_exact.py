"""Exact dedup against brute force, with and without frequent digests."""

import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from keyfold.llm import exact


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub("[\x20\x09-\x0D]+", " ", text or "")].append(i)
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i))
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, ids[0], len(ids), k == 0, sha) for k, i in enumerate(ids)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_equals_brute_force(docs, no_docs, texts):
    assert found(exact.groups(docs)) == brute(texts)
    assert exact.groups(no_docs).count() == 0
    assert exact.keep_first(no_docs).columns == no_docs.columns


def hot(spark):
    """A third of the rows hold one text (with white space that differs), 300 ids repeat,
    and texts of every group size from 1 to 40 follow."""
    rows = [(k * 3 + 1, "the same  text" if k % 2 else "the\tsame text") for k in range(3000)]
    rows += [(7, "the same text")] * 3 + [(None, "the same text"), (None, None), (None, ""), (None, None)]
    rows += [(20_000 + 100 * n + k, f"group {n}") for n in range(1, 41) for k in range(n)]
    rows += [(30_000 + k, f"alone {k}" + " x" * (k % 7)) for k in range(4000)] + [(30_000 + k, f"alone {k}" + " x" * (k % 7)) for k in range(300)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"keep_id": F.lit(1), "digest": F.lit("x"), "row": F.col("doc_id") % 5, "n": F.lit(None).cast("int")}).repartition(9)


def test_hot_group(spark):
    rows, docs = hot(spark)
    assert found(exact.groups(docs)) == brute(rows)
    kept = [(r["doc_id"], r["text"]) for r in exact.keep_first(docs).collect()]
    assert exact.keep_first(docs).columns == docs.columns and len(kept) == len({r[4] for r in brute(rows)})
    assert sorted(map(str, (i for i, _ in kept))) == sorted(str(r[0]) for r in brute(rows) if r[3])


def test_frequent_digests(spark):
    rows, docs = hot(spark)
    known = docs.select("doc_id", exact.digest(F.col("text")).alias("digest")).withColumn("row", F.monotonically_increasing_id())
    got = {bytes(r["digest"]).hex(): (r["win"]["doc_id"], r["n"]) for r in exact.frequent(known).collect()}
    assert got == {r[4]: (r[1], r[2]) for r in brute(rows) if r[2] > len(rows) * exact.SHARE}
    assert (1, 3004) in got.values()


def test_summary_overflows(spark):
    """More digests than counters: frequent ones are still found, with exact counts."""
    rows = spark.range(120_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("a")).when(F.col("id") % 400 == 1, F.lit("b"))
        .otherwise(F.concat(F.lit("t"), "id")).alias("text")).repartition(7)
    known = rows.select("doc_id", exact.digest(F.col("text")).alias("digest")).withColumn("row", F.monotonically_increasing_id())
    assert sorted(r["n"] for r in exact.frequent(known).collect()) == [
        rows.where("text = 'b'").count(), 40_000]
    sizes = exact.groups(rows).groupBy("group_size").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("kept").cast("int")).alias("k"))
    assert {r["group_size"]: r["k"] for r in sizes.collect()} == {1: 120_000 - 40_000 - 200, 40_000: 1, 200: 1}


def test_no_python_in_the_plan(docs):
    plan = exact.groups(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan
