from keyfold.session import scratch_path
from keyfold.sources import fs, lookup


def test_header_lines_dropped_per_file_when_files_are_split(spark):
    base = scratch_path(spark, "lookup_split")
    body = "".join(f"k{i};x;v{i}\n" for i in range(3000))
    fs.create_empty(spark, f"{base}/a.txt", "# towns\ncode;region;name\n" + body)
    fs.create_empty(spark, f"{base}/b.txt", "# towns\ncode;region;name\nz;x;vz\n\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = lookup.lookup_load(spark, base, sep=";", header_lines=2, cols=[0, 2], names=["code", "name"])
        assert df.rdd.getNumPartitions() > 3                  # file a is read in several blocks
        got = sorted((r.code, r.name) for r in df.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted([(f"k{i}", f"v{i}") for i in range(3000)] + [("z", "vz")])


def test_unpivot_pairs(spark):
    wide = spark.createDataFrame([("a", "1", "b", "2"), ("c", "3", "", "")], "k0 string, v0 string, k1 string, v1 string")
    out = lookup.lookup_unpivot(wide, 2, key="name", value="code")
    assert sorted(map(tuple, out.collect())) == [("a", "1"), ("b", "2"), ("c", "3")]
