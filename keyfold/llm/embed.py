"""Embedding near-duplicates: exact metric range join over pivots."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import cut
from keyfold.llm.graph import components

#: Most pivots; their matrix is the only thing broadcast.
MAX_PIVOTS = 1024
#: Vectors for each pivot, up to that many pivots.
PER_PIVOT = 4096
#: Rows of each of the two sides that one task compares as one group.
GROUP = 8192
#: Above the rounding of single precision, below any distance that matters: pairs this
#: near the threshold are decided in double precision.
SLACK = 1e-4


def _matrix(column: pa.Array) -> np.ndarray:
    """An Arrow list column of equally long lists as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _units(x: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision. Scaling by the largest component first keeps
    very large and very small vectors from over- or underflowing."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _pivots(vectors: DataFrame, n: int, radius: float) -> np.ndarray:
    """Unit pivots: a bounded sample (one per ``PER_PIVOT`` vectors, at most
    ``MAX_PIVOTS``), the vectors with the smallest hashes; of pivots within ``radius`` of
    each other one stays. Any pivots give the same, exact result."""
    k = max(1, min(MAX_PIVOTS, math.ceil(n / PER_PIVOT)))
    sample = (vectors.select("vec", F.xxhash64("vec").alias("h")).orderBy("h", "vec").limit(k)
              .select("vec").collect())
    units = _units(np.array([r["vec"] for r in sample]))
    kept: list[int] = []
    for i in range(len(units)):
        if all(np.linalg.norm(units[i] - units[j]) > radius for j in kept):
            kept.append(i)
    return units[kept]


def _cells_of(pivots: np.ndarray, radius: float):
    """mapInArrow function: each vector's home cell (its nearest pivot) and the cells it
    is replicated to.

    For a home vector y of cell j and any x within ``radius`` of y, the triangle
    inequality gives d(x, pj) <= d(x, pi) + 2 radius for x's own pivot pi; in a Euclidean
    space x is moreover within ``radius`` of the half-space nearer to pj, i.e.
    (d(x, pj)^2 - d(x, pi)^2) / (2 d(pi, pj)) <= radius. x goes to the cells that pass
    both, so every pair meets in the home cell of either vector."""
    between = np.sqrt(np.maximum(0, 2 - 2 * pivots @ pivots.T))

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            sq = np.maximum(0, 2 - 2 * _units(_matrix(b.column(0))) @ pivots.T)
            home = sq.argmin(axis=1)
            own = sq[np.arange(len(sq)), home]
            reach = (np.sqrt(sq) <= (np.sqrt(own) + 2 * radius + SLACK)[:, None]) & (
                sq - own[:, None] <= 2 * (radius + SLACK) * between[home])
            reach[np.arange(len(sq)), home] = True
            row, cell = np.nonzero(reach)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell.astype(np.int32)), pa.array(home[row] == cell), *(c.take(pa.array(row)) for c in b.columns)],
                names=["cell", "home", *b.schema.names])
    return run


def _join_group(limit: float):
    """applyInArrow function of one group: home vectors against members.

    Returns (node, label, links): links counts the rows linked to a home vector in this
    group (``n`` rows per vector), label is a node of the same local component, such that
    the (node, label) links connect what all the group's pairs connect."""
    def run(table: pa.Table) -> pa.Table:
        home = table.column("home").to_numpy()
        rep, n = table.column("rep").to_numpy(), table.column("n").to_numpy()
        exact = _units(_matrix(table.column("vec").combine_chunks()))
        unit = exact.astype(np.float32)
        h, m = np.flatnonzero(home), np.flatnonzero(~home)
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        links = np.zeros(len(h), np.int64)
        label = np.arange(len(table))
        for s in range(0, len(h), 1024):
            rows = h[s:s + 1024]
            cos = unit[rows] @ unit[m].T
            i, j = np.nonzero(cos >= limit - SLACK)
            sure = cos[i, j] >= limit + SLACK
            ask = np.flatnonzero(~sure)
            for t in range(0, len(ask), 1 << 16):
                k = ask[t:t + (1 << 16)]
                sure[k] = np.einsum("ij,ij->i", exact[rows[i[k]]], exact[m[j[k]]]) >= limit
            sure &= rep[rows[i]] != rep[m[j]]
            i, j = i[sure], j[sure]
            links[s:s + 1024] = np.bincount(i, n[m[j]], len(rows)).astype(np.int64)
            if len(i):                      # one component label per row, then merged below
                pairs.append((rows[i], m[j]))
                pairs = [_forest(pairs, label)]
        a, b = pairs[0] if pairs else (h[:0], m[:0])
        out = links > 0
        return pa.table({
            "node": np.concatenate([rep[h[out]], rep[a]]),
            "label": np.concatenate([rep[h[out]], rep[b]]),
            "links": np.concatenate([links[out], np.zeros(len(a), np.int64)])})
    return run


def _forest(pairs: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most one link per node that connects what ``pairs`` connect: labels fall to the
    smallest position of the component by repeated minimum and pointer jumping."""
    a = np.concatenate([p[0] for p in pairs])
    b = np.concatenate([p[1] for p in pairs])
    label = label.copy()
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(before, label):
            break
    node = np.unique(np.concatenate([a, b]))
    node = node[label[node] != node]
    return node, label[node]


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", *,
                    threshold: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row: links are the other rows with
    a cosine of ``threshold`` or more, in double precision, whatever their labels.

    Equal vectors are one class with a row count, so copies cost one row of the join. On
    the unit sphere the cosine is a Euclidean distance, and the classes are joined as an
    exact metric range join: pivots cut the space into cells, the triangle inequality
    decides to which further cells a vector is replicated (``_cells_of``), and each cell
    compares its home vectors with its members on its own. A large cell is dealt into
    blocks of ``GROUP`` x ``GROUP`` vectors, so no task holds it whole. A cell returns
    link counts and a spanning forest of its links, never all pairs.

    Null vectors, zero vectors, empty vectors and vectors with null or non-finite
    components link with nothing and are their own component. Vectors of different
    lengths never link. Null ids: the row links nothing, component_id null, kept null.
    Repeated rows count as rows linked to each other; rows that share an id but not the
    vector have links and components of their own. Empty table: empty result. Other
    columns are not read."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vec_col}`").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    valid = (F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & finite
             & F.exists("vec", lambda x: x != 0))
    usable = rows.where(F.coalesce(valid, F.lit(False)))
    # a class is known by a number of its own: an id may stand at different vectors
    classes = cut(usable.groupBy("vec").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("n"))
                  .withColumn("rep", F.monotonically_increasing_id()))
    lengths = [r[0] for r in classes.select(F.size("vec").alias("d")).distinct().orderBy("d").collect()]
    found = None
    for d in lengths:                        # a table has one vector length, or a few
        part = _links(classes.where(F.size("vec") == d).select("vec", "rep", "n"), threshold)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = df.sparkSession.createDataFrame([], "node long, label long, links long")
    found = cut(found)
    groups = components(found.select(F.col("node").alias("a"), F.col("label").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    labels = cut(classes.join(counts, F.col("rep") == counts["node"], "left").drop("node")
                 .join(groups, F.col("rep") == groups["node"], "left")
                 .select(F.col("vec").alias("of_vec"), "low",
                         (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
                         F.coalesce("component", "rep").alias("top")))
    lows = labels.groupBy(F.col("top").alias("of_top")).agg(F.min("low").alias("component"))
    labels = cut(labels.join(lows, F.col("top") == F.col("of_top")).select("of_vec", "links", "component"))
    out = rows.withColumn("usable", F.coalesce(valid, F.lit(False)))
    linked = (out.where("usable").join(labels, F.col("vec") == F.col("of_vec"))
              .select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id")))
    alone = out.where("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                           F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _links(classes: DataFrame, threshold: float) -> DataFrame:
    """(node, label, links) of the classes of one vector length; see ``_join_group``."""
    radius = math.sqrt(max(0.0, 2 - 2 * threshold))
    pivots = _pivots(classes, classes.count(), radius)
    placed = classes.mapInArrow(_cells_of(pivots, radius),
                                f"cell int, home boolean, vec {classes.schema['vec'].dataType.simpleString()}, rep long, n long")
    sizes = {r["cell"]: (r["h"], r["m"]) for r in
             placed.groupBy("cell").agg(F.count_if("home").alias("h"), F.count(F.lit(1)).alias("m")).collect()}
    blocks = F.create_map(*[F.lit(x) for c, (h, m) in sizes.items() for x in (c, [
        math.ceil(h / GROUP), math.ceil(m / GROUP)])])
    mine = F.pmod(F.xxhash64("rep"), F.lit(1 << 30))
    placed = placed.withColumn("b", blocks[F.col("cell")]).withColumn("mine", mine)

    def block(side: int):
        return F.pmod("mine", F.col("b")[side]).cast("int")

    def every(side: int):
        return F.explode(F.sequence(F.lit(0), F.col("b")[side] - 1))

    # A home vector meets every member block of its cell, a member every home block.
    as_home = placed.where("home").select("cell", block(0).alias("i"), every(1).alias("j"), "home", "vec", "rep", "n")
    as_member = placed.select("cell", every(0).alias("i"), block(1).alias("j"), F.lit(False).alias("home"), "vec", "rep", "n")
    return (as_home.unionByName(as_member).groupBy("cell", "i", "j")
            .applyInArrow(_join_group(threshold), "node long, label long, links long"))
