"""Mixing sources to target weights as a time-varying curriculum.

Only DataFrame functions: no Python code runs on the executors.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyfold.llm.common import WORD, cut, with_rank

#: Weights dealt to the sources in order, repeating.
WEIGHTS = (5, 2, 1)
#: Start and end of each source's weight over training time, as multiples of its mean,
#: dealt like the weights: falling, level, rising. Start + end = 2, so the mean is the weight.
RAMPS = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))


def _dealt(rank: Column, values) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(rank, F.lit(len(values))) + 1).cast("int"))


def targets(sizes: DataFrame, *, share: float = 1.5, most: float = 2.0, weights=WEIGHTS, ramps=RAMPS) -> DataFrame:
    """One row per source key (skey) of ``sizes`` (skey, source, size): source_size,
    target and the ramp (early, late).

    Weights are dealt to the sources by code point, null last. ``share`` of all sizes is
    shared by weight; a target stops at ``most`` times its source's size and the excess is
    shared again by weight until none is above. That fixed point is a water level L with
    target = min(most * size, L * weight). The level rises from the one that drowns no
    source: the sources under it stop, and the rest share what they leave, until no more
    go under; each step is an aggregate over the sources. There may be as many sources as
    there are hosts: no window holds them all."""
    src = with_rank(sizes.groupBy("skey", "source").agg(F.sum("size").alias("source_size")), "rank",
                    F.col("source").isNull(), F.col("source"))
    src = src.withColumn("weight", _dealt(F.col("rank"), [float(w) for w in weights]))
    level = 0.0
    while True:
        under = F.lit(float(most)) * F.col("source_size") < F.lit(level) * F.col("weight")
        sums = src.agg(F.sum("source_size").alias("total"), F.sum(F.when(under, F.col("source_size"))).alias("stopped"),
                       F.sum(F.when(~under, F.col("weight"))).alias("rest")).first()
        risen = (share * sums["total"] - most * (sums["stopped"] or 0)) / sums["rest"] if sums["rest"] else level
        if risen <= level:
            break
        level = risen
    return src.select("skey", "source_size",
                      F.least(F.lit(float(most)) * F.col("source_size"), F.lit(level) * F.col("weight")).alias("target"),
                      _dealt(F.col("rank"), [float(a) for a, _ in ramps]).alias("early"),
                      _dealt(F.col("rank"), [float(b) for _, b in ramps]).alias("late"))


def order_hash(doc_id: Column, text: Column, row: Column | None = None) -> Column:
    """md5 that orders a source's rows and deals them into buckets: of the id; where that
    is null, of the row key, or else of the text, so that null ids are no hot key."""
    return F.md5(F.coalesce(doc_id.cast("string"), F.concat(F.lit("\n"), text if row is None else row.cast("string")), F.lit("")).cast("binary"))


def curriculum(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               *, share: float = 1.5, most: float = 2.0, weights=WEIGHTS, ramps=RAMPS, row_col: str | None = None) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies, positions) of every row of
    ``docs``, range-sorted by first position (rows not taken last).

    A size is the number of words of the whole text. Targets per source: ``targets``. A
    source's documents stand in a fixed random order (``order_hash``), repeated pass after
    pass; the mix takes them from the front until the target is met: whole passes, then
    the documents whose middle word lies before the target. So taken words miss the target
    by at most half a document, no document is taken more than ``most`` times rounded up,
    and reruns agree.

    A source's weight changes over training time t in [0, 1] from early to late times its
    mean. Its integral early * t + (late - early) * t^2 / 2 is the part of the source's
    demand that is met by t; inverted at the middle word of a copy, it gives the copy's
    training position.

    A source holding a third of all rows is dealt into 4096 buckets by hash prefix: bucket
    sums give each bucket's offset, and running sums are taken within buckets.

    Null, empty and blank texts: size 0. Null source: a source of its own, the last. Null
    doc_id: ordered by row key or text. A source without words: each document is taken once, 0
    words. Repeated rows are documents of their own. Empty table: empty result. Other
    columns are not read, but for ``row_col``, which is handed on as row, last, and orders
    rows of the same id and size. Rows that share an id (not null) share a bucket."""
    key = [F.col(f"`{row_col}`").alias("row")] if row_col else []
    row_names = ["row"] if row_col else []
    text = F.col(f"`{text_col}`").cast("string")
    order = order_hash(F.col(f"`{id_col}`"), text, F.col(f"`{row_col}`") if row_col else None)
    sizes = cut(docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), order.alias("h"), F.col(f"`{source_col}`").cast("string").alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"), *key)
        .withColumn("skey", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")))
        .withColumn("bucket", F.substring("h", 1, 3)))
    goal = targets(sizes, share=share, most=most, weights=weights, ramps=ramps)
    preceding = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut(sizes.groupBy("skey", "bucket").agg(F.sum("size").alias("n"))
                  .withColumn("offset", F.coalesce(F.sum("n").over(preceding), F.lit(0)))
                  .join(goal, "skey").drop("n"))
    inside = (Window.partitionBy("skey", "bucket").orderBy("h", "doc_id", "size", *row_names)
              .rowsBetween(Window.unboundedPreceding, -1))
    row = (sizes.join(offsets, ["skey", "bucket"])
           .withColumn("start", F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
           .withColumn("middle", F.col("start") + F.col("size") / 2)
           .withColumn("passes", F.when(F.col("source_size") == 0, F.lit(1)).otherwise(
               F.floor(F.col("target") / F.col("source_size")).cast("int")))
           .withColumn("copies", F.col("passes") + F.when(
               (F.col("size") > 0) & (F.col("middle") <= F.col("target") - F.col("passes") * F.col("source_size")), 1).otherwise(0)))

    def position(copy: Column) -> Column:
        met = F.when(F.col("target") > 0, F.least(F.lit(1.0), (copy * F.col("source_size") + F.col("middle")) / F.col("target"))
                     ).otherwise(F.lit(0.0))
        root = F.sqrt(F.col("early") * F.col("early") + F.lit(2.0) * (F.col("late") - F.col("early")) * met)
        return F.lit(2.0) * met / (F.col("early") + root)

    placed = row.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies",
        F.when(F.col("copies") > 0, F.transform(F.sequence(F.lit(0), F.col("copies") - 1), position))
        .otherwise(F.array().cast("array<double>")).alias("positions"), *row_names,
        (F.conv(F.substring("h", 4, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)).alias("spread"))
    return (cut(placed).withColumn("first", F.coalesce(F.try_element_at("positions", F.lit(1)), F.lit(1.0) + F.col("spread")))
            .orderBy("first").drop("first", "spread"))


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix: each row as often as it is taken, in training order, with
    the columns of ``docs``.

    A row is known by a hash of all its columns, so rows that share a doc_id (null
    included) have placings of their own. Rows equal in every column cannot be told apart:
    one of them meets the placings of all, which a skewed join splits."""
    # JSON tells nulls and columns apart; times are written to the microsecond.
    times = {k: "yyyy-MM-dd'T'HH:mm:ss.SSSSSS" + zone for k, zone in (("timestampFormat", "XXX"), ("timestampNTZFormat", ""))}
    keyed = docs.withColumn("__kf_row", F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), times).cast("binary")))
    placed = (curriculum(keyed, row_col="__kf_row")
              .select(F.col("row").alias("__kf_row"), F.explode("positions").alias("__kf_at")))
    return (keyed.dropDuplicates(["__kf_row"]).join(placed, "__kf_row")
            .repartitionByRange("__kf_at").sortWithinPartitions("__kf_at")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def with_position(mix: DataFrame, name: str) -> DataFrame:
    """``mix`` with each row's place in training order as a long. The order is that of the
    files that ``mixed`` was written to: their number, then the row in the file, as Spark's
    file metadata has them. Null where ``mix`` is not read from such files."""
    try:
        part = F.regexp_extract(F.col("_metadata.file_name"), "part-([0-9]+)", 1).try_cast("long")
        return mix.withColumn(name, part * F.lit(1 << 32) + F.col("_metadata.row_index"))
    except AnalysisException:
        return mix.withColumn(name, F.lit(None).cast("long"))


#: The same rows in DuckDB: the water level, the running sums and the inverse written out.
SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size,
               row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk FROM sizes GROUP BY source),
weighed AS (SELECT *, [5.0, 2.0, 1.0][(rk % 3 + 1)::INT]::DOUBLE AS weight,
                   [1.5, 1.0, 0.5][(rk % 3 + 1)::INT]::DOUBLE AS early,
                   [0.5, 1.0, 1.5][(rk % 3 + 1)::INT]::DOUBLE AS late FROM src),
levels AS (SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - 2.0::DOUBLE * coalesce(sum(source_size) OVER (
    ORDER BY source_size / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
  / sum(weight) OVER (ORDER BY source_size / weight, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM weighed),
goal AS (SELECT source, source_size, early, late,
                least(2.0::DOUBLE * source_size, (max(lv) OVER ()) * weight) AS target FROM levels),
placed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, g.early, g.late,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h, s.doc_id, s.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + s.size / 2.0::DOUBLE AS middle,
    CASE WHEN g.source_size = 0 THEN 1 ELSE floor(g.target / g.source_size)::INT END AS passes
  FROM sizes s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source),
counted AS (SELECT *, passes + CASE WHEN size > 0 AND middle <= target - passes * source_size THEN 1 ELSE 0 END AS copies,
                   CASE WHEN target > 0 THEN least(1.0::DOUBLE, middle / target) ELSE 0.0::DOUBLE END AS met FROM placed)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies::INT AS copies,
       CASE WHEN copies > 0 THEN 2.0::DOUBLE * met / (early + sqrt(early * early + 2.0::DOUBLE * (late - early) * met)) END AS "position"
FROM counted
"""
