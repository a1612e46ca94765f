"""Prefix trie of conversations from adaptive radix trees over fixed-width turn ids.

A turn id is 16 big-endian bytes, a conversation's key its turn ids in a row. Keys are range
sorted; each task builds one tree after another over bounded runs of neighbouring keys, and
only byte depths that end a turn become nodes. Runs meet at a single path of shared
prefixes, so what the trees report adds up by node.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyfold.llm.common import _batch, crc_sql, cut, map_rows

#: Bytes of a turn id: the front of a SHA-256 over role and text.
WIDTH = 16
#: Turns of the conversations that one tree holds at most (a longer conversation has a tree
#: of its own).
RUN = 1 << 15
OUT = "kind byte, key binary, parent binary, depth long, n long, low long, kids long, leaves long, saved long, seq long, ids string"


class Sorted:
    """Up to ``room`` children by sorted bytes (layouts of 4 and of 16)."""

    def __init__(self, room: int = 4):
        self.room, self.bytes, self.nodes = room, bytearray(), []

    def get(self, b: int):
        i = bisect_left(self.bytes, b)
        return self.nodes[i] if i < len(self.bytes) and self.bytes[i] == b else None

    def put(self, b: int, node):
        """The layout that holds ``node`` under ``b``: this one or the next larger."""
        i = bisect_left(self.bytes, b)
        if i < len(self.bytes) and self.bytes[i] == b:
            self.nodes[i] = node
            return self
        if len(self.bytes) == self.room:
            larger = Sorted(16) if self.room == 4 else Indexed()
            for x, child in self.items():
                larger = larger.put(x, child)
            return larger.put(b, node)
        self.bytes.insert(i, b)
        self.nodes.insert(i, node)
        return self

    def items(self):
        return zip(self.bytes, self.nodes)


class Indexed:
    """Up to 48 children: a byte's place in a short list."""

    def __init__(self):
        self.place, self.nodes = bytearray(256), []

    def get(self, b: int):
        return self.nodes[self.place[b] - 1] if self.place[b] else None

    def put(self, b: int, node):
        if self.place[b]:
            self.nodes[self.place[b] - 1] = node
        elif len(self.nodes) == 48:
            return Direct(self).put(b, node)
        else:
            self.nodes.append(node)
            self.place[b] = len(self.nodes)
        return self

    def items(self):
        return ((b, self.nodes[p - 1]) for b, p in enumerate(self.place) if p)


class Direct:
    """One place for every byte."""

    def __init__(self, old: Indexed):
        self.nodes = [None] * 256
        for b, node in old.items():
            self.nodes[b] = node

    def get(self, b: int):
        return self.nodes[b]

    def put(self, b: int, node):
        self.nodes[b] = node
        return self

    def items(self):
        return ((b, node) for b, node in enumerate(self.nodes) if node is not None)


class Node:
    """``path``: compressed bytes below the byte that leads here; ``n`` keys pass or end
    here, ``low`` is their smallest conversation, ``ends`` those that end here."""
    __slots__ = ("path", "kids", "n", "low", "ends")

    def __init__(self, path: bytes, kids, n: int, low, ends: list):
        self.path, self.kids, self.n, self.low, self.ends = path, kids, n, low, ends


def _shared(a: bytes, key: bytes, at: int) -> int:
    """How many bytes ``a`` and ``key`` from ``at`` have in common."""
    if key.startswith(a, at):
        return len(a)
    low, high = 0, len(a)                       # a[:low] is shared, a[:high] is not
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if key.startswith(a[:mid], at) else (low, mid)
    return low


class Tree:
    """Adaptive radix tree of turn-id keys."""

    def __init__(self):
        self.root, self.sizes = Node(b"", Sorted(), 0, None, []), {}

    def add(self, key: bytes, conv: int, sizes: list[int]) -> None:
        for k, size in enumerate(sizes):
            self.sizes[key[k * WIDTH:(k + 1) * WIDTH]] = size
        node, at, up, byte = self.root, 0, None, 0
        while True:
            m = _shared(node.path, key, at)
            if m < len(node.path):              # split the compressed path
                lower = Node(node.path[m + 1:], node.kids, node.n, node.low, node.ends)
                node = Node(node.path[:m], Sorted().put(node.path[m], lower), node.n, node.low, [])
                up.kids = up.kids.put(byte, node)
            node.n += 1
            node.low = conv if node.low is None or conv < node.low else node.low
            at += m
            if at == len(key):
                node.ends.append(conv)
                return
            up, byte, child = node, key[at], node.kids.get(key[at])
            at += 1
            if child is None:
                node.kids = node.kids.put(byte, Node(key[at:], Sorted(), 1, conv, [conv]))
                return
            node = child

    def turns(self):
        """The turn-aligned nodes in preorder: (parent's place, key, depth, n, low, size, ends)."""
        root = hashlib.blake2b(b"", digest_size=WIDTH).digest()
        yield -1, root, 0, self.root.n, self.root.low, 0, self.root.ends
        place, todo = 0, [(child, bytes([b]), 0, root, 0) for b, child in reversed(list(self.root.kids.items()))]
        while todo:
            node, head, parent, key, depth = todo.pop()
            part = head + node.path
            whole = len(part) // WIDTH
            for k in range(whole):
                turn = part[k * WIDTH:(k + 1) * WIDTH]
                key, depth = hashlib.blake2b(key + turn, digest_size=WIDTH).digest(), depth + 1
                last = (k + 1) * WIDTH == len(part)
                place += 1
                yield parent, key, depth, node.n, node.low, self.sizes[turn], node.ends if last else []
                parent = place
            tail = part[whole * WIDTH:]
            todo += [(child, tail + bytes([b]), parent, key, depth) for b, child in reversed(list(node.kids.items()))]


def _reported(tree: Tree, known: int, open_end: bool, seq: int) -> list[tuple]:
    """The tree's nodes as summands. ``known``: the depth down to which the first key's path
    is shared with the run before (-1: no run before); those nodes were counted there.
    ``open_end``: the run after starts with the whole last key, which is no leaf here."""
    rows = list(tree.turns())
    n = len(rows)
    kids, leaves, saved = [0] * n, [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        up, _, _, count, _, size, _ = rows[i]
        new = i > known                         # the first path lies in places 0, 1, 2, ...
        if i == n - 1:
            leaves[i] = 0 if open_end else 1
        elif rows[i + 1][0] != i:               # in preorder a first child follows at once
            leaves[i] = 1
        saved[i] += (count - new) * size
        if up >= 0:
            kids[up] += new
            leaves[up] += leaves[i]
            saved[up] += saved[i]
    out = [(0, key, rows[up][1] if up >= 0 else None, depth, count, low, kids[i], leaves[i], saved[i], None, None)
           for i, (up, key, depth, count, low, _, _) in enumerate(rows)]
    out += [(1, key, None, None, None, None, None, None, None, seq, ",".join(map(str, ends)))
            for _, key, _, _, _, _, ends in rows if ends]
    return out


def _build(known: dict[int, int], open_ends: dict[int, bool], run_size: int):
    """Task function over sorted (part, key, conv_id, sizes): trees over runs of keys."""
    names = [f.split()[0] for f in OUT.split(", ")]
    types = [pa.int8(), pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.string()]

    def run(batches):
        tree, held, last, shared, part, seq = Tree(), 0, None, -1, 0, 0

        def flush(open_end):
            rows = _reported(tree, shared, open_end, (part << 32) + seq)
            for k in range(0, len(rows), 8192):
                yield _batch(rows[k:k + 8192], names, types)

        for b in batches:
            for p, key, conv, sizes in zip(*[b.column(i).to_pylist() for i in range(4)]):
                if last is None:
                    part, shared = p, known.get(p, -1)
                elif held >= run_size:
                    yield from flush(key.startswith(last))
                    tree, held, seq = Tree(), 0, seq + 1
                    shared = common_turns(last, key)
                tree.add(key, conv, sizes)
                held += 1 + len(sizes)
                last = key
        if last is not None:
            yield from flush(open_ends.get(part, False))

    return run


def common_turns(a: bytes, b: bytes) -> int:
    """How many leading turns two keys share."""
    return _shared(a, b, 0) // WIDTH


def _edges(keys: DataFrame) -> tuple[dict[int, int], dict[int, bool]]:
    """Per partition of sorted keys: the turns its first key shares with the key before it,
    and whether the key after it starts with its last. One row per partition."""
    by_part = Window.orderBy("part")
    ends = keys.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    around = ends.select("part", F.lag("last").over(by_part).alias("before"), "first", "last", F.lead("first").over(by_part).alias("after"))
    rows = map_rows(around, lambda: lambda r: [(
        r[0], -1 if r[1] is None else common_turns(r[1], r[2]), r[4] is not None and r[4].startswith(r[3]))],
        "part int, known int, open boolean").collect()
    return {r[0]: r[1] for r in rows}, {r[0]: r[2] for r in rows}


def _streamed_sha():
    """mapInArrow function over (key, ids) sorted by key: SHA-256 of each key's ids, joined
    by commas, hashed piece by piece."""
    def run(batches):
        key, sha, out = None, None, []
        for b in batches:
            for k, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if k != key:
                    if key is not None:
                        out.append((key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.string()))], names=["end", "sha"])
                out = []
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([sha.hexdigest()])], names=["end", "sha"])
    return run


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id long, ids array of hex turn ids, sizes array of text bytes) per conversation
    of ``turns`` (conv_id, turn, role, text), by turn (nulls first), ties by role, then id.
    Null role or text: empty. Rows without conv_id belong to none and are left out."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
                 F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256),
                             1, 2 * WIDTH).alias("id"),
                 F.octet_length(text).cast("long").alias("size")).alias("t"))
    return rows.groupBy((F.col("conv_id") - F.col("conv_id") % 5).alias("base"), "conv_id").agg(
        F.array_sort(F.collect_list("t")).alias("own")).select(
        "base", "conv_id", F.transform("own", lambda t: F.struct(t["id"].alias("id"), t["size"].alias("size"))).alias("own"))


def grafted(turns: DataFrame) -> DataFrame:
    """(conv_id, key, sizes) of ``turns`` with test prefixes: conversation c starts with the
    first h = crc32(c) % 9 turns of conversation c - c % 5, then has its own after its first h."""
    own = sequences(turns.withColumn("conv_id", F.col("conv_id").cast("long")).repartition(
        F.col("conv_id") - F.col("conv_id") % 5))
    donor = F.max(F.when(F.col("conv_id") == F.col("base"), F.slice("own", 1, 8))).over(Window.partitionBy("base"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(9)).cast("int")
    nothing = F.slice("own", 1, 0)
    seq = F.concat(F.slice(F.coalesce(donor, nothing), F.lit(1), h), F.slice("own", h + 1, F.greatest(F.size("own") - h, F.lit(0))))
    return _keyed(own.select("conv_id", seq.alias("own")))


def plain(turns: DataFrame) -> DataFrame:
    """(conv_id, key, sizes) of the conversations of ``turns`` as they are."""
    return _keyed(sequences(turns))


def _keyed(seqs: DataFrame) -> DataFrame:
    return seqs.select("conv_id", F.unhex(F.array_join("own.id", "")).alias("key"), F.col("own.size").alias("sizes"))


def trie(keys: DataFrame, run_size: int = RUN) -> DataFrame:
    """The trie of ``keys`` (``plain`` or ``grafted``): one row per distinct prefix of turns,
    with conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs,
    n_children, n_leaves, saved_tokens (over the subtree, members but one times the bytes of
    the last text) and ends_sha256 (of the members that end here, ascending, by commas).

    Equal keys are dealt by conversation too, so no first turn and no group of copies fills
    a task. Each task holds one tree of at most ``run_size`` turns. Nodes of one run are
    whole; those on the path that two runs share add up: a node is new in the first run that
    has it, and a leaf in the last.

    A conversation's turn ids (24 bytes a turn, no texts) are one row. A conversation
    without turns ends at the root. Empty table: no node."""
    dealt = cut(keys.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id"))
    dealt = dealt.select(F.spark_partition_id().alias("part"), "key", "conv_id", "sizes")
    found = cut(dealt.mapInArrow(_build(*_edges(dealt), run_size), OUT))
    nodes = cut(found.where("kind = 0").groupBy("key").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("low").alias("conv_id"), F.sum("n").alias("n_convs"),
        F.sum("kids").alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")))
    ends = (found.where("kind = 1").select("key", "seq", "ids").repartition("key").sortWithinPartitions("key", "seq")
            .select("key", "ids").mapInArrow(_streamed_sha(), "end binary, sha string"))
    parents = nodes.select(F.col("key").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.join(ends, F.col("key") == F.col("end"), "left").join(parents, F.col("parent") == F.col("above"), "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")))


#: The grafted trie in DuckDB: prefixes as hashes of joined turn hashes; a node's subtree is
#: reached from below, along the path of its smallest member.
SQL = f"""
WITH t AS (
  SELECT conv_id, md5(strlen(role) || ':' || role || text) AS id, strlen(text) AS size,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
conv AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {crc_sql("(conv_id::VARCHAR)")} % 9 AS h
         FROM (SELECT DISTINCT conv_id FROM t)),
lent AS (SELECT c.conv_id, t.pos, t.id, t.size FROM conv c JOIN t ON t.conv_id = c.base AND t.pos <= c.h),
seq AS (SELECT * FROM lent UNION ALL
        SELECT t.conv_id, t.pos - c.h + coalesce(n, 0), t.id, t.size FROM t JOIN conv c USING (conv_id)
        LEFT JOIN (SELECT conv_id, count(*) AS n FROM lent GROUP BY conv_id) USING (conv_id) WHERE t.pos > c.h
        UNION ALL SELECT conv_id, 0, '', 0 FROM conv),
path AS (SELECT conv_id, pos AS depth, size,
                md5(string_agg(id, '') OVER (PARTITION BY conv_id ORDER BY pos)) AS key FROM seq),
node AS (SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(size) AS size FROM path GROUP BY key, depth),
child AS (SELECT p.key, p.depth, count(*) AS n FROM node u JOIN path p ON p.conv_id = u.conv_id AND p.depth = u.depth - 1 GROUP BY 1, 2),
below AS (SELECT p.key, p.depth, sum((u.n_convs - 1) * u.size)::BIGINT AS saved,
                 count(*) FILTER (NOT EXISTS (SELECT 1 FROM child c WHERE c.key = u.key AND c.depth = u.depth)) AS leaves
          FROM node u JOIN path p ON p.conv_id = u.conv_id AND p.depth <= u.depth GROUP BY 1, 2),
ends AS (SELECT key, depth, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
         FROM path JOIN (SELECT conv_id, max(depth) AS depth FROM path GROUP BY conv_id) USING (conv_id, depth) GROUP BY 1, 2)
SELECT u.conv_id, u.depth, v.conv_id AS parent_conv_id, u.n_convs, coalesce(child.n, 0) AS n_children,
       below.leaves AS n_leaves, below.saved AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM node u JOIN below USING (key, depth) LEFT JOIN child USING (key, depth) LEFT JOIN ends USING (key, depth)
LEFT JOIN path up ON up.conv_id = u.conv_id AND up.depth = u.depth - 1
LEFT JOIN node v ON v.key = up.key AND v.depth = up.depth
"""
