"""SimHash near-duplicates by a segment-popcount embedding and a grid range join."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import cut, id_and_bytes, map_rows
from keyfold.llm.graph import components
from keyfold.operators.sizing import bounded_broadcast

#: Shingle hashes held at once while a long text is fingerprinted.
BLOCK = 1 << 16
#: Segments of the 64 bits: two bits each, so a count is 0, 1 or 2.
SEGMENTS = 32
#: Distinct fingerprints one task compares as one group; larger cells are split.
GROUP = 8192


def fingerprint(text: bytes | None, width: int = 4) -> int:
    """Signed 64-bit SimHash of a whole text: A-Z lower-cased, words cut at ASCII white
    space, ``width``-word shingles with repeats (fewer words: all of them as one), each
    hashed by XXH64 with seed 42; a bit is 1 if it is set in over half of the hashes.
    Null, empty and blank texts give 0."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, BLOCK):
        block = words[start:min(start + BLOCK, n) + width - 1]
        k = max(1, len(block) - width + 1)
        hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(block[i:i + width]), 42) for i in range(k)),
                             np.uint64, k)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits((2 * ones > n).astype(np.uint8), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """(doc_id, fp long) of every row."""
    return map_rows(id_and_bytes(docs, id_col, text_col),
                    lambda: lambda r: [(r[0], fingerprint(r[1], width))], "doc_id long, fp long")


def popcount_code(fp: Column) -> Column:
    """The segment counts in unary (0: 00, 1: 01, 2: 11). The Hamming distance of two
    codes is the Manhattan distance of the two count vectors, which is never above the
    Hamming distance of the fingerprints: every differing bit changes one count by one."""
    odd = F.lit(0x5555555555555555)
    low, high = fp.bitwiseAND(odd), F.shiftrightunsigned(fp, 1).bitwiseAND(odd)
    return low.bitwiseOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _masks(distance: int, shared: int) -> list[int]:
    """Bit masks of the sub-grids. The segments are dealt into ``distance + shared``
    blocks; count vectors within ``distance`` differ in at most ``distance`` blocks, so
    they lie in the same cell of at least one sub-grid spanned by ``shared`` blocks."""
    blocks = [0] * (distance + shared)
    for s in range(SEGMENTS):
        blocks[s % len(blocks)] |= 3 << (2 * s)
    masks = (sum(c) for c in combinations(blocks, shared))
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _near(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    """Whether fingerprints are within ``distance``: count vectors first (the lower
    bound), then the bits themselves."""
    def code(x):
        odd = np.uint64(0x5555555555555555)
        low, high = x & odd, (x >> np.uint64(1)) & odd
        return low | high | ((low & high) << np.uint64(1))
    return (np.bitwise_count(code(a) ^ code(b)) <= distance) & (np.bitwise_count(a ^ b) <= distance)


def _star_links(fp: np.ndarray, rep: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect one group's members as all its near pairs would, one per
    member at most: each found member takes its near members out of the rest."""
    left, a, b = np.arange(len(fp)), [], []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            hit = _near(fp[left], fp[x], distance)
            found, left = left[hit], left[~hit]
            queue.extend(found)
            a.append(rep[found])
            b.append(np.full(len(found), rep[x]))
    return (np.concatenate(a), np.concatenate(b)) if a else (rep[:0], rep[:0])


def _links_of_runs(distance: int, small: int = 48):
    """mapInArrow function over rows sorted by gid: links within each run of one gid.
    Short runs are compared with shifted copies of the arrays, longer ones by
    ``_star_links``; a run over several batches is carried along (at most ``GROUP`` rows)."""
    def links(gid, fp, rep):
        starts = np.flatnonzero(np.r_[True, gid[1:] != gid[:-1]])
        lengths = np.diff(np.r_[starts, len(gid)])
        a, b = [], []
        for s, n in zip(starts[lengths > small], lengths[lengths > small]):
            x, y = _star_links(fp[s:s + n], rep[s:s + n], distance)
            a.append(x), b.append(y)
        short = np.repeat((lengths > 1) & (lengths <= small), lengths)
        gid, fp, rep = gid[short], fp[short], rep[short]
        for shift in range(1, min(small, len(gid))):
            i = np.flatnonzero(gid[shift:] == gid[:-shift])
            if not len(i):
                break
            i = i[_near(fp[i], fp[i + shift], distance)]
            a.append(rep[i]), b.append(rep[i + shift])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else rep[:0], pa.int64()) for x in (a, b)],
                                          names=["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            new[1] = new[1].view(np.uint64)
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            if not len(held[0]):
                continue
            last = int(np.searchsorted(held[0], held[0][-1]))
            if last:
                yield links(*(x[:last] for x in held))
                held = [x[last:] for x in held]
        if held is not None and len(held[0]):
            yield links(*held)
    return run


def near_links(reps: DataFrame, distance: int = 4, shared: int = 3, group: int = GROUP) -> DataFrame:
    """(a, b): links between the ``rep`` ids of distinct fingerprints (columns fp, rep)
    that connect exactly what all pairs within ``distance`` bits connect.

    Grid range join: each fingerprint goes to one cell of each sub-grid (``_masks``), and
    each cell is joined on its own. A cell with more than ``group`` fingerprints is dealt
    into chunks, and every two chunks meet in one group, so no task holds a large cell
    whole and no near pair is missed."""
    code = popcount_code(F.col("fp"))
    cells = reps.select("fp", "rep", F.explode(F.array(
        *[F.xxhash64(F.lit(k), code.bitwiseAND(F.lit(m))) for k, m in enumerate(_masks(distance, shared))])).alias("gid"))
    hot = cut(cells.groupBy("gid").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group)
              .select("gid", F.ceil(F.col("n") * 2 / group).cast("int").alias("parts")))
    if not hot.isEmpty():
        mine = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
        split = cells.join(bounded_broadcast(hot), "gid", "left").withColumn("mine", mine)
        cells = (split.withColumn("other", F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0)))
                                                     .otherwise(F.sequence(F.lit(0), F.col("parts") - 1))))
                 .select("fp", "rep", F.when(F.col("parts").isNull(), F.col("gid")).otherwise(
                     F.xxhash64("gid", F.least("mine", "other"), F.greatest("mine", "other"))).alias("gid")))
    return (cells.select("gid", "fp", "rep").repartition("gid").sortWithinPartitions("gid")
            .mapInArrow(_links_of_runs(distance), "a long, b long").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = 4,
                    distance: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``.

    Whole texts are fingerprinted (``fingerprint``). Rows with equal fingerprints are one
    class; only classes are joined, so thousands of copies cost one row. component_id is
    the smallest doc_id reachable over links of at most ``distance`` differing bits, the
    row itself included.

    Nulls, empty and blank texts: fingerprint zero, linked like any other. Null doc_id:
    fingerprinted, but component_id is null and the row links nothing. Repeated rows:
    each is returned. Empty table: empty result. Other columns are not read."""
    fps = cut(fingerprints(docs, id_col, text_col, width))
    reps = cut(fps.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep")))
    groups = components(cut(near_links(reps, distance)))
    labels = cut(reps.join(groups.withColumnRenamed("node", "rep"), "rep", "left")
                 .select(F.col("fp").alias("of_fp"), F.coalesce("component", "rep").alias("component_id")))
    return (fps.join(labels, F.col("fp") == F.col("of_fp"), "left")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")))


def keep_one(docs: DataFrame, *, width: int = 4, distance: int = 4) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one with the smallest
    doc_id. Of repeated rows with that doc_id one stays. Rows without doc_id stay.
    All columns are returned as they were."""
    found = cut(near_duplicates(docs, width=width, distance=distance))
    removed = found.where("component_id <> doc_id").select(F.col("doc_id").alias("__kf_id")).distinct()
    kept = docs.join(removed, docs["doc_id"] == F.col("__kf_id"), "left_anti")
    twice = (found.where("component_id = doc_id").groupBy("doc_id").count().where("count > 1")
             .select(F.col("doc_id").alias("__kf_id")))
    if twice.isEmpty():
        return kept
    again = kept.join(twice, kept["doc_id"] == F.col("__kf_id"), "left_semi").dropDuplicates(["doc_id"])
    return kept.join(twice, kept["doc_id"] == F.col("__kf_id"), "left_anti").unionByName(again)
