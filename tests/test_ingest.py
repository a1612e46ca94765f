import os

import pytest
from pyspark.sql import types as T

from keyfold.operators import quality as dq
from keyfold.plans import ingest
from keyfold.plans.steplog import timing_report
from keyfold.session import scratch_path
from keyfold.sinks.layers import LayerTable
from keyfold.sources import fs, listing
from keyfold.streaming.file_stream import FileStream, stream_raw_to_bronze
from tests.conftest import rows

SCHEMA = T.StructType([T.StructField("K", T.StringType()), T.StructField("SEQ", T.StringType()),
                       T.StructField("AMT", T.DoubleType()), T.StructField("OP", T.StringType())])
FILES = {
    "gl_2025.01.01.csv": "K|SEQ|AMT|OP\na|1|1.5|I\nb|1|2.0|I\na|2|3.0|I\n",     # newer sequence: warning, kept
    "gl_2025.01.02.csv": "K|SEQ|AMT|OP\nc|1|1.0|I\nc|1|9.0|I\n",                # same key and sequence: rejected
    "gl_2025.01.03.csv": "K|SEQ|AMT|OP\n",                                      # header only: empty
    "gl_2025.01.04.csv": "K|SEQ|AMT|OP\n||5.0|I\nd|1|bad|D\nb|10|7.0|\n",      # all-null key (kept, row dropped), bad double
}


def _layer(spark, path, keys=()):
    """A table named after its folder, so the same folder is the same table."""
    return LayerTable(spark, "t_" + "_".join(path.rsplit("/", 2)[-2:]).replace("-", "_"), location=path, keys=keys, buckets=3)


def _loads(table):
    """Loads on record as done that wrote rows."""
    return table.loads().where("state = 'done' AND action = 'accept'").select("load_batch").distinct().count()


def _landing(spark, name):
    base = scratch_path(spark, name)
    for f, text in FILES.items():
        fs.create_empty(spark, f"{base}/landing/{f}", text)
    return base


def test_raw_to_bronze_files(spark):
    base = _landing(spark, "ingest")
    bronze = _layer(spark, f"{base}/bronze")
    res = ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, bronze, ["K"], seq="SEQ", op_col="OP", move=True)
    v = {r.file_name: (r.code, r.action) for r in res.verdicts.collect()}
    assert v == {"gl_2025.01.01.csv": (dq.DUP_NEWER_SEQUENCE, "accept"),
                 "gl_2025.01.02.csv": (dq.DUPLICATED, "reject"),
                 "gl_2025.01.03.csv": (dq.EMPTY, "reject"),
                 "gl_2025.01.04.csv": (dq.KEYS_NULL, "accept")}
    assert rows(bronze.read(), "K", "SEQ", "AMT") == [("a", "2", 3.0), ("b", "1", 2.0), ("b", "10", 7.0), ("d", "1", None)]
    # files were routed
    assert fs.list_files(spark, f"{base}/landing", ".csv") == []
    assert len(fs.list_files(spark, f"{base}/landing/archive", ".csv")) == 2
    assert len(fs.list_files(spark, f"{base}/landing/error", ".csv")) == 2
    log = res.log
    assert log.count() == 16 and {r.activity for r in log.collect()} == {"read", "data_quality", "write", "archive"}
    rep = timing_report(log, ["activity"])
    assert rep.count() == 4 and all(r.total_files == 4 for r in rep.collect())


def test_merge_mode_later_file_wins(spark):
    base = _landing(spark, "ingest_merge")
    bronze = _layer(spark, f"{base}/bronze", ["K"])
    ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, bronze, ["K"], seq="SEQ", op_col="OP",
                         write_mode="merge")
    # b: file 01 has SEQ 1, file 04 has SEQ 10 with null op -> file 04 wins; d: op D unmatched -> skipped
    assert rows(bronze.read(), "K", "SEQ") == [("a", "2"), ("b", "10")]


def test_fatal_verdict_stops_after_writing(spark):
    base = _landing(spark, "ingest_fatal")
    bronze = _layer(spark, f"{base}/bronze")
    with pytest.raises(dq.DataQualityError):
        ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, bronze, ["K"], seq="SEQ",
                             fatal=(dq.DUPLICATED,), move=True)
    assert rows(bronze.read(), "K") == [("a",), ("b",)]          # only the file before the fatal one
    assert len(fs.list_files(spark, f"{base}/landing", ".csv")) == 2   # later files untouched


def test_stream_equals_batch(spark):
    base = _landing(spark, "ingest_stream")
    batch = _layer(spark, f"{base}/bronze_batch")
    ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, batch, ["K"], seq="SEQ")
    stream = _layer(spark, f"{base}/bronze_stream")
    q = stream_raw_to_bronze(spark, f"{base}/landing", SCHEMA, stream, ["K"], f"{base}/_chk", seq="SEQ")
    q.awaitTermination()
    assert rows(stream.read()) == rows(batch.read())
    # a second run finds nothing new
    q = stream_raw_to_bronze(spark, f"{base}/landing", SCHEMA, stream, ["K"], f"{base}/_chk", seq="SEQ")
    q.awaitTermination()
    assert _loads(stream) == 1


def test_file_select(spark):
    base = _landing(spark, "select")
    lst = listing.file_listing(spark, f"{base}/landing")
    assert lst.count() == 4 and "content" not in lst.columns
    assert [r.name for r in listing.file_select(lst, "single", "gl_2025.01.02.csv").collect()] == ["gl_2025.01.02.csv"]
    assert listing.file_select(lst, "last").count() == 1


def test_rerun_after_crash_before_moves_writes_once(spark):
    base = _landing(spark, "ingest_rerun")
    bronze = _layer(spark, f"{base}/bronze")
    ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, bronze, ["K"], seq="SEQ", move=False)
    first = rows(bronze.read())
    # files were not moved (as after a crash); the rerun must not append them again
    ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, bronze, ["K"], seq="SEQ", move=True)
    assert rows(bronze.read()) == first and _loads(bronze) == 1
    assert fs.list_files(spark, f"{base}/landing", ".csv") == []


def test_one_plan_equals_union_of_per_file_runs(spark):
    base = _landing(spark, "ingest_union")
    whole = _layer(spark, f"{base}/whole")
    ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, whole, ["K"], seq="SEQ")
    single = _layer(spark, f"{base}/single")
    for name in sorted(FILES):
        ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, single, ["K"], seq="SEQ",
                             process_file="single", file_name=name)
    assert rows(whole.read()) == rows(single.read())


def test_manifest_size_label(spark):
    base = _landing(spark, "ingest_manifest")
    res = ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, _layer(spark, f"{base}/b"), ["K"], seq="SEQ")
    labels = {r.file_name: r.size_label for r in res.manifest.collect()}
    assert labels["gl_2025.01.03.csv"] == "13 bytes"


def test_merge_mode_equals_files_merged_one_after_another(spark):
    files = {
        "cdc_01.csv": "K|SEQ|AMT|OP\na|1|1.0|I\nb|1|1.0|I\nc|1|1.0|I\ne|1|1.0|U\n",
        "cdc_02.csv": "K|SEQ|AMT|OP\na|2|2.0|U\nb|2|2.0|D\ne|2|2.0|U\n",
        "cdc_03.csv": "K|SEQ|AMT|OP\nb|3|3.0|U\nc|3|3.0|D\nf|3|3.0|D\n",
    }
    base = scratch_path(spark, "ingest_fold")
    for f, text in files.items():
        fs.create_empty(spark, f"{base}/landing/{f}", text)
    seed = spark.createDataFrame([("c", "0", 0.0, None), ("e", "0", 0.0, None)], SCHEMA)
    whole, single = _layer(spark, f"{base}/whole", ["K"]), _layer(spark, f"{base}/single", ["K"])
    for t in (whole, single):
        t.overwrite(seed)
    ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, whole, ["K"], seq="SEQ", op_col="OP", write_mode="merge")
    for name in sorted(files):
        ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, single, ["K"], seq="SEQ", op_col="OP",
                             write_mode="merge", process_file="single", file_name=name)
    # a: I then U keeps the I row; b: I, D, then U re-inserts; c: deleted; e: U keeps the target; f: unmatched D
    assert rows(whole.read(), "K", "AMT") == [("a", 1.0), ("b", 3.0), ("e", 0.0)]
    assert rows(whole.read()) == rows(single.read())


def test_rerun_after_crash_midway_through_moves_writes_once(spark):
    base = _landing(spark, "ingest_partial")
    bronze = _layer(spark, f"{base}/bronze")
    ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, bronze, ["K"], seq="SEQ", move=False)
    first = rows(bronze.read())
    # the crash came after two of the four moves: the landed file set has changed
    for name in ("gl_2025.01.01.csv", "gl_2025.01.02.csv"):
        dest = "archive" if name.endswith("01.csv") else "error"
        fs.rename(spark, f"{base}/landing/{name}", f"{base}/landing/{dest}/{name}")
    res = ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, bronze, ["K"], seq="SEQ", move=True)
    assert res.files == 0
    assert rows(bronze.read()) == first and _loads(bronze) == 1
    assert fs.list_files(spark, f"{base}/landing", ".csv") == []
    assert len(fs.list_files(spark, f"{base}/landing/archive", ".csv")) == 2     # routed by the recorded verdicts
    assert len(fs.list_files(spark, f"{base}/landing/error", ".csv")) == 2
    # a file landing later is processed as usual
    fs.create_empty(spark, f"{base}/landing/gl_2025.01.05.csv", "K|SEQ|AMT|OP\nz|1|1.0|I\n")
    ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, bronze, ["K"], seq="SEQ", move=True)
    assert ("z",) in rows(bronze.read(), "K") and _loads(bronze) == 2


def test_stream_merge_equals_batch_merge(spark):
    import time as _time
    files = {
        "cdc_01.csv": "K|SEQ|AMT|OP\na|1|1.0|I\nb|1|1.0|I\nc|1|1.0|I\ne|1|1.0|U\n",
        "cdc_02.csv": "K|SEQ|AMT|OP\na|2|2.0|U\nb|2|2.0|D\ne|2|2.0|U\n",
        "cdc_03.csv": "K|SEQ|AMT|OP\nb|3|3.0|U\nc|3|3.0|D\nf|3|3.0|D\n",
    }
    base = scratch_path(spark, "stream_merge")
    start = (int(_time.time()) - 10) * 1000
    for i, (f, text) in enumerate(sorted(files.items())):
        fs.create_empty(spark, f"{base}/landing/{f}", text)
        fs.set_mtime(spark, f"{base}/landing/{f}", start + i * 1000)
    seed = spark.createDataFrame([("c", "0", 0.0, None), ("e", "0", 0.0, None)], SCHEMA)
    batch = _layer(spark, f"{base}/batch", ["K"])
    batch.overwrite(seed)
    ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, batch, ["K"], seq="SEQ", op_col="OP", write_mode="merge")
    for per_trigger in (1, None):                 # one file per micro-batch, or all in one
        stream = _layer(spark, f"{base}/stream_{per_trigger}", ["K"])
        stream.overwrite(seed)
        q = stream_raw_to_bronze(spark, f"{base}/landing", SCHEMA, stream, ["K"], f"{base}/_chk_{per_trigger}",
                                 seq="SEQ", op_col="OP", write_mode="merge", max_files=per_trigger)
        q.awaitTermination()
        assert rows(stream.read(), "K", "AMT") == [("a", 1.0), ("b", 3.0), ("e", 0.0)]
        assert rows(stream.read()) == rows(batch.read())
    assert _loads(stream) == 1 and _loads(_layer(spark, f"{base}/stream_1", ["K"])) == 3


def test_stream_goes_on_behind_a_fatal_file(spark):
    base = _landing(spark, "stream_fatal")
    bronze = _layer(spark, f"{base}/bronze")

    def run():
        stream_raw_to_bronze(spark, f"{base}/landing", SCHEMA, bronze, ["K"], f"{base}/_chk", seq="SEQ",
                             fatal=(dq.DUPLICATED,)).awaitTermination()

    with pytest.raises(Exception, match="gl_2025.01.02"):
        run()
    assert rows(bronze.read(), "K") == [("a",), ("b",)]
    run()
    assert rows(bronze.read(), "K", "SEQ") == [("a", "2"), ("b", "1"), ("b", "10"), ("d", "1")]
    run()
    assert rows(bronze.read(), "K", "SEQ") == [("a", "2"), ("b", "1"), ("b", "10"), ("d", "1")]


def test_rejected_files_leave_the_table_and_names_may_hold_blanks(spark):
    base = scratch_path(spark, "ingest_names")
    bronze = _layer(spark, f"{base}/bronze")

    def land(name, text, **kw):
        fs.create_empty(spark, f"{base}/landing/{name}", text)
        return ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, bronze, ["K"], seq="SEQ", move=True, **kw)

    land("gl 2025 a+b%.csv", "K|SEQ|AMT|OP\na|1|1.0|I\n")
    assert rows(bronze.read(), "K") == [("a",)]
    for mode in ("overwrite", "append", "merge"):
        land("empty.csv", "K|SEQ|AMT|OP\n", write_mode=mode)      # lands again: the routed ones stay
        assert rows(bronze.read(), "K") == [("a",)] and _loads(bronze) == 1
    assert len(fs.list_files(spark, f"{base}/landing/error", ".csv")) == 3


def test_a_name_that_lands_twice_leaves_both_files_in_the_archive(spark):
    base = scratch_path(spark, "ingest_twice")
    bronze = _layer(spark, f"{base}/bronze")
    for text in ("K|SEQ|AMT|OP\na|1|1.0|I\n", "K|SEQ|AMT|OP\nb|1|1.0|I\n", "K|SEQ|AMT|OP\nc|1|1.0|I\n"):
        fs.create_empty(spark, f"{base}/landing/same.csv", text)
        fs.set_mtime(spark, f"{base}/landing/same.csv", 1_700_000_000_000 + ord(text[13]) * 1000)
        ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, bronze, ["K"], seq="SEQ", move=True)
    assert rows(bronze.read(), "K") == [("a",), ("b",), ("c",)]
    kept = sorted(fs.read_text(spark, f)[13] for f in fs.list_files(spark, f"{base}/landing/archive", ".csv"))
    assert kept == ["a", "b", "c"] and fs.list_files(spark, f"{base}/landing", ".csv") == []


def test_every_landed_file_is_read_and_subfolders_are_not(spark):
    base = scratch_path(spark, "any_name")
    for name in ("a.csv", "b.txt", "no_suffix", "archive/old.csv", "_hidden.csv"):
        fs.create_empty(spark, f"{base}/landing/{name}", f"K|SEQ|AMT|OP\n{name}|1|1.0|I\n")
    assert rows(listing.file_listing(spark, f"{base}/landing"), "name") == [("a.csv",), ("b.txt",), ("no_suffix",)]
    assert rows(listing.file_listing(spark, f"{base}/landing", "*.txt"), "name") == [("b.txt",)]
    bronze, stream = _layer(spark, f"{base}/bronze"), _layer(spark, f"{base}/stream")
    stream_raw_to_bronze(spark, f"{base}/landing", SCHEMA, stream, ["K"], f"{base}/_chk", seq="SEQ").awaitTermination()
    ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, bronze, ["K"], seq="SEQ", move=True)
    assert rows(bronze.read(), "K") == rows(stream.read(), "K") == [("a.csv",), ("b.txt",), ("no_suffix",)]
    # all files are moved: an empty landing folder is no error
    assert ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, bronze, ["K"], seq="SEQ", move=True).files == 0


def test_file_calls_raise_without_a_gateway():
    class Connect:
        @property
        def sparkContext(self):
            raise NotImplementedError
    with pytest.raises(RuntimeError, match="gateway"):
        fs.exists(Connect(), "/tmp")


def test_malformed_file_is_rejected_and_the_others_are_written(spark):
    base = scratch_path(spark, "ingest_malformed")
    for f, text in {"a_1.csv": "K|SEQ|AMT|OP\na|1|1.0|I\n", "a_2.csv": "K|SEQ|AMT|OP\nb|1|1.0|I\nc|1|no number|I\n",
                    "a_3.csv": "K|SEQ|AMT|OP\nd|1|2.0|I\n"}.items():
        fs.create_empty(spark, f"{base}/landing/{f}", text)
    bronze, strict = _layer(spark, f"{base}/bronze"), {"mode": "FAILFAST"}
    res = ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, bronze, ["K"], seq="SEQ", read_options=strict, move=True)
    assert rows(bronze.read(), "K", "AMT") == [("a", 1.0), ("d", 2.0)] and dq.CORRUPT not in bronze.read().columns
    assert rows(res.verdicts.where("code IS NOT NULL"), "file_name", "code", "action") == [("a_2.csv", dq.READ_ERROR, "reject")]
    assert [f.rsplit("/", 1)[-1] for f in fs.list_files(spark, f"{base}/landing/error", ".csv")] == ["a_2.csv"]
    fs.create_empty(spark, f"{base}/landing/a_4.csv", "K|SEQ|AMT|OP\ne|1|no number|I\n")
    with pytest.raises(dq.DataQualityError):
        ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, bronze, ["K"], seq="SEQ", read_options=strict,
                             fatal=(dq.READ_ERROR,))


def test_quarantine_holds_each_rejected_file_once(spark):
    base = _landing(spark, "ingest_quarantine")
    held = _layer(spark, f"{base}/held")
    failing = _layer(spark, f"{base}/bronze")
    failing.append = lambda *a, **k: (_ for _ in ()).throw(RuntimeError("crash"))
    with pytest.raises(RuntimeError):
        ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, failing, ["K"], seq="SEQ", quarantine=held)
    fs.create_empty(spark, f"{base}/landing/gl_2025.01.05.csv", "K|SEQ|AMT|OP\nx|1|1.0|I\nx|1|2.0|I\n")
    expected = [("c", 1.0, dq.DUPLICATED), ("c", 9.0, dq.DUPLICATED)]
    assert rows(held.read(), "K", "AMT", "code") == expected
    bronze = _layer(spark, f"{base}/bronze")
    for _ in range(2):
        ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, bronze, ["K"], seq="SEQ", quarantine=held)
    assert rows(held.read(), "K", "AMT", "code") == expected + [("x", 1.0, dq.DUPLICATED), ("x", 2.0, dq.DUPLICATED)]
    assert rows(bronze.read(), "K") == [("a",), ("b",), ("b",), ("d",)]


def test_orders_landing_files_grow_with_the_rows(spark):
    from keyfold import workloads
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("test data not present")
    few, many = (listing.file_listing(spark, workloads._orders_landing(spark, sf, n)).count() for n in (2000, 200))
    assert few == 3 and many > 12
    orders = spark.read.parquet(f"{sf}/orders.parquet").where("o_orderstatus = 'O'")
    assert rows(workloads.q_file_select(spark, sf, 200), "o_orderkey") == rows(orders, "o_orderkey")


def test_truncated_files_are_rejected_alone(spark):
    """A gzip file cut short, one that is no gzip at all, two members in one file, bzip2."""
    import bz2
    import gzip
    base = scratch_path(spark, "ingest_truncated")
    text = lambda k: f"K|SEQ|AMT|OP\n{k}|1|1.0|I\n".encode()
    whole = gzip.compress(b"K|SEQ|AMT|OP\n" + b"".join(b"t%d|1|1.0|I\n" % i for i in range(20_000)))
    two = gzip.compress(text("m")) + gzip.compress(b"n|1|1.0|I\n")
    files = {"a.csv.gz": whole[:len(whole) // 2], "b.csv.gz": b"no gzip here", "c.csv.gz": two, "d.csv": text("d"),
             "e.csv.bz2": bz2.compress(text("e")), "f.csv.bz2": bz2.compress(text("f"))[:-9]}
    fs.mkdirs(spark, f"{base}/landing")
    for name, data in files.items():
        with open(f"{base}/landing/{name}".removeprefix("file:"), "wb") as f:
            f.write(data)
    bronze = _layer(spark, f"{base}/bronze")
    res = ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, bronze, ["K"], seq="SEQ", move=True)
    assert rows(res.verdicts.where("code = 'ReadError'"), "file_name", "action") == [
        ("a.csv.gz", "reject"), ("b.csv.gz", "reject"), ("f.csv.bz2", "reject")]
    assert rows(bronze.read(), "K") == [("d",), ("e",), ("m",), ("n",)]
    assert len(fs.list_files(spark, f"{base}/landing/error")) == len(fs.list_files(spark, f"{base}/landing/archive")) == 3


def _verdict_files(spark, name, files):
    base = scratch_path(spark, name)
    for i, (f, text) in enumerate(files):
        fs.create_empty(spark, f"{base}/landing/{f}", text)
        fs.set_mtime(spark, f"{base}/landing/{f}", 1_700_000_000_000 + i * 1000)
    return base


HEAD = "K|SEQ|AMT|OP\n"
ODD = [("z_1.csv", HEAD + "a|1|1.0|I\n"), ("y_2.csv", HEAD), ("x_3.csv", HEAD + "b|1|bad|I\n"), ("w_4.csv", HEAD + "c|1|1.0|I\nc|1|2.0|I\n"),
       ("v_5.csv", ""), ("u_6.csv", HEAD + "d|1|1.0|I\n"), ("a_7.csv", HEAD + "||1.0|I\n"), ("t_8.csv", HEAD + "e|1|1.0|I\n"), ("b_9.csv", HEAD)]


@pytest.mark.parametrize("fatal, max_files", [((), None), ((), 2), ((dq.KEYS_NULL,), 1), ((dq.EMPTY,), None)])
def test_stream_and_batch_judge_alike(spark, fatal, max_files):
    """Files without rows, malformed, rejected and fatal ones, landing in another order than
    their names: same verdicts, same rows."""
    got = []
    for kind in ("batch", "stream"):
        base = _verdict_files(spark, f"judge_{kind}", ODD)
        bronze, held = _layer(spark, f"{base}/bronze"), _layer(spark, f"{base}/verdicts")
        kw = dict(seq="SEQ", fatal=fatal, read_options={"mode": "FAILFAST"})
        if kind == "batch":
            try:
                ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, bronze, ["K"], **kw)
            except dq.DataQualityError:
                assert fatal
        else:
            try:
                FileStream(spark, f"{base}/landing", SCHEMA, bronze, ["K"], f"{base}/_chk", max_files=max_files, verdict_table=held, **kw).run()
            except Exception as e:
                assert fatal and "DataQualityError" in str(e)
        got.append((rows(bronze.done_files(), "name", "action"), rows(bronze.read()) if bronze.exists() else None))
    assert got[0] == got[1]
    assert len(got[0][0]) == {(): 9, (dq.KEYS_NULL,): 7, (dq.EMPTY,): 2}[fatal]


def test_stream_archives_and_routes(spark):
    base = _verdict_files(spark, "stream_route", ODD[:6])
    bronze, log, held = (_layer(spark, f"{base}/{x}") for x in ("bronze", "log", "held"))
    FileStream(spark, f"{base}/landing", SCHEMA, bronze, ["K"], f"{base}/_chk", seq="SEQ", max_files=1, clean_source="archive",
               archive_dir=f"{base}/archive", error_dir=f"{base}/error", read_options={"mode": "FAILFAST"}, log_table=log,
               quarantine=held).run()
    names = lambda folder: rows(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
                                .selectExpr("element_at(split(path, '/'), -1) AS n"), "n")
    assert names(f"{base}/archive") == [("u_6.csv",), ("z_1.csv",)]
    routed = sorted(f.rsplit("/", 1)[-1] for f in fs.list_files(spark, f"{base}/error"))     # one has no bytes
    assert routed == ["v_5.csv", "w_4.csv", "x_3.csv", "y_2.csv"]
    assert listing.file_listing(spark, f"{base}/landing").count() == 0
    assert rows(held.read(), "K", "code") == [("b", dq.READ_ERROR), ("c", dq.DUPLICATED), ("c", dq.DUPLICATED)]
    assert rows(log.read().where("activity = 'read'"), "file_name", "n_read") == [
        ("u_6.csv", 1), ("v_5.csv", 0), ("w_4.csv", 2), ("x_3.csv", 1), ("y_2.csv", 0), ("z_1.csv", 1)]


def test_log_counts_of_a_merge(spark):
    base = _verdict_files(spark, "log_counts", [
        ("1.csv", HEAD + "a|1|1.0|I\nb|1|1.0|D\nc|1|1.0|U\nd|1|1.0|I\nd|2|1.0|I\n|1|1.0|I\n"),
        ("2.csv", HEAD + "e|1|1.0|I\na|2|2.0|I\n"), ("3.csv", HEAD + "f|1|1.0|I\nf|1|2.0|I\n")])
    bronze = _layer(spark, f"{base}/bronze", ["K"])
    bronze.overwrite(spark.createDataFrame([(k, "0", 0.0, None) for k in "abcx"], SCHEMA))
    res = ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, bronze, ["K"], seq="SEQ", op_col="OP", write_mode="merge")
    got = {(r["activity"], r["file_name"]): tuple(r)[5:] for r in res.log.collect()}
    # a: both files set it, so the second decides; b deleted; c left alone by U; d and e inserted
    assert got[("write", "1.csv")] == (None, None, 1, 0, 1, 1) and got[("write", "2.csv")] == (None, None, 1, 1, 0, 0)
    assert got[("write", "3.csv")] == (None,) * 6 and got[("data_quality", "3.csv")] == (None, 2, None, None, None, None)
    assert got[("read", "1.csv")] == (6, None, None, None, None, None) and got[("archive", "1.csv")] == (None,) * 6
    assert rows(bronze.read(), "K", "AMT") == [("a", 2.0), ("c", 0.0), ("d", 1.0), ("e", 1.0), ("x", 0.0)]


def test_one_csv_scan_per_run(spark, monkeypatch):
    """The landing files are parsed by one plan; what follows reads the parsed rows."""
    seen = []
    real = ingest.delimited_read
    monkeypatch.setattr(ingest, "delimited_read", lambda *a, **k: seen.append(a[1]) or real(*a, **k))
    base = _landing(spark, "one_scan")
    res = ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, _layer(spark, f"{base}/bronze"), ["K"], seq="SEQ")
    assert seen == [f"{base}/landing"]
    plan = res.verdicts._jdf.queryExecution().toString() + res.log._jdf.queryExecution().toString()
    assert "csv" not in plan.lower().replace(".csv", "")


@pytest.mark.parametrize("mode, at", [("append", "_put"), ("append", "finish"), ("merge", "_put"), ("merge", "_drop"), ("overwrite", "_drop")])
def test_a_crash_anywhere_is_settled_by_the_next_run(spark, monkeypatch, mode, at):
    base = _landing(spark, f"crash_{mode}_{at}")
    keys = ["K"] if mode == "merge" else []
    kw = dict(seq="SEQ", op_col="OP", write_mode=mode, move=True)
    whole = _layer(spark, f"{base}/whole", keys)
    ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, whole, ["K"], **(kw | {"move": False}))
    bronze = _layer(spark, f"{base}/bronze", keys)
    real = getattr(LayerTable, at)

    def crash(self, *a):
        if at == "_put":
            real(self, *a)
        raise RuntimeError("crash")
    with monkeypatch.context() as m:
        m.setattr(LayerTable, at, crash)
        try:
            ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, bronze, ["K"], **kw)
        except RuntimeError:
            pass
    ingest.raw_to_bronze(spark, f"{base}/landing", SCHEMA, _layer(spark, f"{base}/bronze", keys), ["K"], **kw)
    assert rows(bronze.read()) == rows(whole.read())
    assert listing.file_listing(spark, f"{base}/landing").count() == 0


def test_silver_from_new_loads_equals_reading_all_of_bronze(spark):
    """Late rows, lower and equal sequences, deletes, keys that come back, keys without a change."""
    import random
    pick = random.Random(4)
    base = scratch_path(spark, "new_silver")
    bronze, full, new = _layer(spark, f"{base}/bronze"), _layer(spark, f"{base}/full", ["K"]), _layer(spark, f"{base}/new", ["K"])
    for run in range(4):
        rows_ = [(pick.choice("abcdefghij"), str(pick.randrange(12)), float(pick.randrange(4)), pick.choice(["I", "I", "D", "U", None]))
                 for _ in range(9)] + [(f"only{run}", "1", 1.0, pick.choice(["D", "U"])), (None, "1", 1.0, "I")]
        bronze.append(spark.createDataFrame(rows_, SCHEMA))
        ingest.bronze_to_silver(spark, bronze, full, ["K"], seq="SEQ", op_col="OP")
        assert ingest.new_bronze_to_silver(spark, bronze, new, ["K"], seq="SEQ", op_col="OP") == 1
        assert rows(new.read()) == rows(full.read().where("K IS NOT NULL"))
    assert ingest.new_bronze_to_silver(spark, bronze, new, ["K"], seq="SEQ", op_col="OP") == 0


@pytest.mark.parametrize("key", ["stream_raw_to_bronze_merge", "stream_archive"])
def test_micro_batch_holds_a_period(monkeypatch, key):
    """As many files as the period has parts, so more files make no more micro-batches."""
    from types import SimpleNamespace

    from keyfold import fixtures, workloads
    seen = {}

    class Stream:
        def __init__(self, *args, **options):
            seen.update(options)

        def run(self):
            raise StopIteration

    monkeypatch.setattr(workloads, "FileStream", Stream)
    monkeypatch.setattr(workloads, "_layer", lambda *a, **k: SimpleNamespace())
    monkeypatch.setattr(workloads, "scratch_path", lambda spark, name: name)
    monkeypatch.setattr(fixtures, "events_landing", lambda spark, sf_dir, folder: folder)
    monkeypatch.setattr(fixtures, "events_parts", lambda spark, sf_dir: 15, raising=False)
    with pytest.raises(StopIteration):
        workloads.QUERIES[key](None, "")
    assert seen["max_files"] == 15
