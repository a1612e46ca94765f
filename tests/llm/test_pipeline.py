import os

import pytest

import corpus_pipeline
from keyfold.llm import packing

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_pipeline_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "language_id" and len(corpus_pipeline.STAGES) == 5
    sizes = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.toPandas(), docs.schema)
        sizes.append(docs.count())
    taken = {r["doc_id"]: r["count"] for r in docs.groupBy("doc_id").count().collect()}
    packed = packing.unpack(corpus_pipeline.run(spark, SF))
    got = {r["doc_id"]: r["count"] for r in packed.where("offset = 0").groupBy("doc_id").count().collect()}
    assert got == taken and sizes[0] >= sizes[1] >= sizes[2]


def test_pipeline_on_empty_documents(spark, docs, no_docs):
    for _, stage in corpus_pipeline.STAGES[:1] + corpus_pipeline.STAGES[3:]:
        assert stage(spark, no_docs, SF).count() == 0


def test_packed_rows_follow_the_training_order(spark, tmp_path):
    """The rows of the mix are written and read as the pipeline does; packed rows come back
    in the order of their first documents, and neighbours stay neighbours."""
    from pyspark.sql import functions as F
    from keyfold.llm import mixing
    words = "alpha beta gamma delta "
    docs = spark.createDataFrame([(k, words * (1 + k % 90), "abc"[k % 3]) for k in range(900)], "doc_id long, text string, source string").repartition(4)
    path = str(tmp_path / "mix")
    mixing.mixed(docs).write.parquet(path)
    mix = spark.read.parquet(path)
    placed = mixing.with_position(mix, "at")
    order = [r["doc_id"] for r in placed.orderBy("at").collect()]
    firsts = mixing.curriculum(docs).select(F.posexplode("positions").alias("copy", "p"), "doc_id").orderBy("p")
    assert [r["doc_id"] for r in firsts.collect()] == order and placed.select("at").distinct().count() == len(order)
    rows = [r for r in corpus_pipeline.token_rows(spark, mix, SF).collect()]
    assert [r["position"] for r in rows] == sorted(r["position"] for r in rows)
    by_place = {r["at"]: r["doc_id"] for r in placed.collect()}
    assert all(by_place[r["position"]] in r["doc_ids"] for r in rows)
    unread = corpus_pipeline.token_rows(spark, docs, SF)              # not read from files: no order
    assert {r["position"] for r in unread.collect()} == {None}


def test_language_stage_reads_long_words_whole(spark):
    """The one character that tells the languages apart lies about byte 32 of a word: the
    row is kept, as the word is scored whole."""
    shared, own = "\u4e00\u662f\u4e0d\u4e86\u4eba\u6211\u5728\u6709\u4ed6\u8fd9", {"a": "\u56fd", "b": "\u4e2d", "c": "\u4e0a", "d": "\u6765"}
    rows = [(k, f"{' '.join(shared)} {own['abcd'[k % 4]]} " * 20, "abcd"[k % 4]) for k in range(96)]
    rows += [(1000 + k, shared + c, None) for k, c in enumerate(own.values())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = corpus_pipeline.language_id(spark, docs, SF)
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows}
