import math
import random

import numpy as np
import xxhash

from keyfold.llm import embed, graph, simhash


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [b" ".join(words)]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def labels(nodes, linked):
    """Smallest reachable node by repeated merging."""
    of = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            for b in nodes:
                if linked(a, b) and of[a] != of[b]:
                    of[a] = of[b] = min(of[a], of[b])
                    changed = True
    return of


def test_components(spark):
    random.seed(1)
    nodes = list(range(60))
    edges = [(random.choice(nodes), random.choice(nodes)) for _ in range(45)] + [(59, k) for k in range(5)] + [(7, 7)]
    want = labels(nodes, lambda a, b: (a, b) in edges or (b, a) in edges)
    got = {r[0]: r[1] for r in graph.components(spark.createDataFrame(edges + [(None, 3)], "a long, b long")).collect()}
    touched = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {n: want[n] for n in touched}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_long_chain(spark):
    assert {r[1] for r in graph.components(spark.range(1, 40).selectExpr("id a", "id + 1 b")).collect()} == {1}


def test_simhash_against_brute_force(docs, texts):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(texts)
    fp = {i: brute_fingerprint(t) for i, t in texts}
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {i: f"{x:016x}" for i, x in fp.items()}
    ids = [i for i in fp if i is not None]
    want = labels(ids, lambda a, b: (fp[a] ^ fp[b]).bit_count() <= 4)
    assert {r["doc_id"]: r["component_id"] for r in got} == {**want, None: None}


def test_simhash_blocks_equal_whole():
    text = " ".join(str(k) for k in range(500)).encode()
    whole, simhash.BLOCK = simhash.fingerprint(text), 64
    try:
        assert simhash.fingerprint(text) == whole
    finally:
        simhash.BLOCK = 1 << 16


def test_grid_join_loses_no_link(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(-(1 << 63), (1 << 63) - 1, 40)
    points = []
    for x in base.tolist():
        points.append(x)
        for _ in range(6):
            y = x
            for bit in rng.choice(64, rng.integers(1, 7), replace=False).tolist():
                y ^= -(1 << 63) if bit == 63 else 1 << bit
            points.append(y)
    points = sorted(set(points))
    reps = spark.createDataFrame([(x, k) for k, x in enumerate(points)], "fp long, rep long")
    unsigned = [x & (1 << 64) - 1 for x in points]
    near = {(a, b) for a in range(len(points)) for b in range(len(points)) if (unsigned[a] ^ unsigned[b]).bit_count() <= 4}
    want = labels(list(range(len(points))), lambda a, b: (a, b) in near)
    for group in (8192, 4):                      # 4: every cell with company is split
        links = simhash.near_links(reps, group=group)
        found = {(r["a"], r["b"]) for r in links.collect()}
        assert found <= near
        got = {r[0]: r[1] for r in graph.components(links).collect()}
        assert {k: got.get(k, k) for k in range(len(points))} == want


def test_simhash_stage(docs, no_docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and None in ids and 2 not in ids and {1, 3}.issubset(ids)
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.keep_one(no_docs).count() == 0


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((12, 8))
    rows = [(k, (centres[k % 12] + rng.standard_normal(8) * 0.12).astype(np.float32).tolist(), k % 3) for k in range(240)]
    rows += [(300, rows[0][1], 1), (301, rows[0][1], 2), (302, [x * 7 for x in rows[1][1]], 0), (303, [0.0] * 8, 0), (304, None, 0),
             (305, [math.nan] * 8, 0), (306, [1.0, None] * 4, 0), (307, [math.inf] + [1.0] * 7, 0), (308, [], 0), (309, [1.0, 2.0], 0),
             (None, rows[2][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    small, embed.GROUP, per, embed.PER_PIVOT = embed.GROUP, 16, embed.PER_PIVOT, 20
    try:
        got = {r["vec_id"]: r for r in embed.near_duplicates(df).collect()}
    finally:
        embed.GROUP, embed.PER_PIVOT = small, per
    good = {i: np.array(v, np.float32).astype(float) for i, v, _ in rows if i is not None and i < 303}
    unit = {i: v / np.linalg.norm(v) for i, v in good.items()}
    linked = {(a, b): unit[a] @ unit[b] >= 0.95 for a in unit for b in unit if a != b}
    want = labels(list(unit), lambda a, b: linked.get((a, b), False))
    for i in unit:
        assert got[i]["n_links"] == sum(linked[i, j] for j in unit if j != i)
        assert got[i]["component_id"] == want[i] and got[i]["kept"] == (want[i] == i)
    for i in (303, 304, 305, 306, 307, 308, 309):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert got[None]["component_id"] is None and len(got) == len(rows)
    assert embed.near_duplicates(df.limit(0)).count() == 0


def test_rows_that_share_an_id_have_links_of_their_own(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.0, -1.0]), (3, [0.02, 1.0]), (0, [0.0, 2.0]), (None, [1.0, 0.0])]
    got = embed.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = sorted((tuple(r)[:4] for r in got.collect()), key=str)
    assert found == sorted([(1, 1, 1, True), (2, 1, 1, False), (1, 2, 0, False), (0, 2, 0, True), (3, 2, 0, False), (3, 0, 3, True),
                            (None, 0, None, None)], key=str)
