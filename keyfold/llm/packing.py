"""Token ids, packed into fixed-length rows by best-fit decreasing."""

from __future__ import annotations

import base64
import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import cut

#: A public byte-level BPE vocabulary: base64 piece and rank per line.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pre-token pattern published with that vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The id that ends a document; free in that vocabulary.
END = 50256
#: Words whose ids a task remembers.
REMEMBERED = 300_000
#: Tokens packed together as one block: a task holds no more than this and one document.
BLOCK_TOKENS = 1 << 22

_SPACED = ("  ", "\n ", "\t ", "\r ", "\x0b ", "\x0c ")
_WIDE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

SCHEMA = ("row_key string, n_tokens int, doc_ids array<long>, doc_offsets array<long>, "
          "cu_seqlens array<int>, position_resets array<int>, input_ids binary")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}


def encoder(ranks: dict[bytes, int], pattern: str = PATTERN, dtype=np.uint16):
    """text -> ids as little-endian bytes; equal to encoding the text as a whole.

    No pre-token of the pattern goes on from a character into white space after it, so a
    text may be cut before every blank that follows a non-blank, and the parts' ids are
    remembered. Texts in which a blank follows other white space are encoded whole."""
    import tiktoken
    bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    known: dict[str, bytes] = {}

    def part(p: str) -> bytes:
        ids = np.array(bpe.encode_ordinary(p), dtype).tobytes()
        if len(known) >= REMEMBERED:
            known.clear()
        known[p] = ids
        return ids

    def encode(text: str) -> bytes:
        if any(s in text for s in _SPACED) or not text.isascii() and _WIDE.search(text):
            return np.array(bpe.encode_ordinary(text), dtype).tobytes()
        first, *rest = text.split(" ")
        parts = [first, *[" " + w for w in rest]]
        return b"".join([known.get(p) or part(p) for p in parts])

    return encode


class Capacities:
    """Open rows by free places, as a segment tree over 0..length that counts rows."""

    def __init__(self, length: int):
        self.size = 1 << (length + 1).bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: dict[int, list[int]] = {}

    def add(self, free: int, row: int) -> None:
        self.rows.setdefault(free, []).append(row)
        self._change(free, 1)

    def _change(self, free: int, by: int) -> None:
        node = free + self.size
        while node:
            self.count[node] += by
            node >>= 1

    def take_best(self, need: int) -> tuple[int, int] | None:
        """(free, row) of a row with the least free places that are at least ``need``;
        the row leaves the tree."""
        node = need + self.size
        while not self.count[node]:                 # up, to the first subtree on the right with rows
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.size:                     # down, to its leftmost leaf with rows
            node = 2 * node + (not self.count[2 * node])
        free = node - self.size
        self._change(free, -1)
        return free, self.rows[free].pop()


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Rows of piece numbers; each row's sizes sum to at most ``length``. Longest first
    (ties: first come), each into the row it fills best."""
    rows: list[list[int]] = []
    tree = Capacities(length)
    for piece in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        best = tree.take_best(sizes[piece])
        if best is None:
            rows.append([])
            best = (length, len(rows) - 1)
        free, row = best
        rows[row].append(piece)
        if free > sizes[piece]:
            tree.add(free - sizes[piece], row)
    return rows


def positions(cu_seqlens: list[int], length: int) -> np.ndarray:
    """Position ids of a row: 0, 1, ... from every reset on; padding counts from 0 too."""
    at = np.arange(length)
    starts = np.array([*cu_seqlens[:-1], *([cu_seqlens[-1]] if cu_seqlens[-1] < length else [])], int)
    return at - starts[np.searchsorted(starts, at, side="right") - 1]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, length: int = 2048,
         ranks_path: str = RANKS, pattern: str = PATTERN, end: int = END, pad: int = END,
         position_col: str | None = None) -> DataFrame:
    """Rows of exactly ``length`` ids that hold every token of every text once.

    A text's ids, then ``end``, are cut into pieces of at most ``length``; pieces are
    packed by best-fit decreasing within blocks of ``BLOCK_TOKENS`` consecutive tokens of
    a partition, so a task holds one block whatever the table's size, no row moves
    between tasks, and a lost task repeats only itself.

    Per row: row_key (first piece as doc_id:offset), n_tokens (without padding), doc_ids
    and doc_offsets of its pieces (the piece starts at that token of the document),
    cu_seqlens (0, then each piece's end), position_resets (places at which position ids
    start again from 0: every piece, and the padding), input_ids (little-endian, two bytes
    an id if all fit, else four; padded with ``pad``). ``unpack`` turns rows back.

    With ``position_col`` (long: a document's place in training order) each row gets a
    position, the first of its pieces, and the rows are range-sorted by it, nulls first.
    Packing mixes documents of one block only, which are neighbours in an ordered table.

    Null and empty texts have no tokens and take no place. Null doc_id: packed, its id is
    null. Very long texts: cut losslessly. Repeated rows: packed as often as they come.
    Empty table: empty result. Other columns are not read."""
    ranks = read_ranks(ranks_path)
    dtype = np.uint16 if max(end, pad, *ranks.values()) < 1 << 16 else np.uint32
    width = np.dtype(dtype).itemsize

    def rows_of_block(pieces):
        for row in best_fit_decreasing([len(p[2]) // width for p in pieces], length):
            held = [pieces[k] for k in row]
            ends = np.cumsum([0] + [len(p[2]) // width for p in held])
            ids = b"".join(p[2] for p in held)
            yield (f"{held[0][0]}:{held[0][1]}", int(ends[-1]), [p[0] for p in held], [p[1] for p in held],
                   ends.tolist(), ends.tolist() if ends[-1] < length else ends[:-1].tolist(),
                   ids + np.full(length - ends[-1], pad, dtype).tobytes(),
                   min((p[3] for p in held if p[3] is not None), default=None) if position_col else None)

    def run(batches):
        encode, tail = encoder(ranks, pattern, dtype), np.array([end], dtype).tobytes()
        block, tokens = [], 0
        names = ["row_key", "n_tokens", "doc_ids", "doc_offsets", "cu_seqlens", "position_resets", "input_ids", "position"]
        types = [pa.string(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()),
                 pa.list_(pa.int32()), pa.binary(), pa.int64()]

        def flush():
            rows = rows_of_block(block)
            while out := list(itertools.islice(rows, 256)):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

        for b in batches:
            for k in range(b.num_rows):
                text = b.column(1)[k].as_py()
                if not text:
                    continue
                doc, ids, place = b.column(0)[k].as_py(), encode(text) + tail, b.column(2)[k].as_py() if position_col else None
                for s in range(0, len(ids), length * width):
                    block.append((doc, s // width, ids[s:s + length * width], place))
                tokens += len(ids) // width
                if tokens >= BLOCK_TOKENS:
                    yield from flush()
                    block, tokens = [], 0
        yield from flush()

    place = F.col(f"`{position_col}`").cast("long") if position_col else F.lit(None).cast("long")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                       place.alias("place")).mapInArrow(run, SCHEMA + ", position long")
    if not position_col:
        return rows.drop("position")
    # written once: the range bounds come from a pass of their own over the rows
    return cut(rows).repartitionByRange("position").sortWithinPartitions("position")


def unpack(packed: DataFrame, width: int = 2) -> DataFrame:
    """(doc_id, offset, ids binary): the pieces of packed rows, for checks and readers."""
    piece = F.explode(F.arrays_zip("doc_ids", "doc_offsets", F.sequence(F.lit(0), F.size("doc_ids") - 1).alias("k")))
    return (packed.select("input_ids", "cu_seqlens", piece.alias("p"))
            .select(F.col("p.doc_ids").alias("doc_id"), F.col("p.doc_offsets").alias("offset"),
                    F.substring("input_ids", F.col("cu_seqlens")[F.col("p.k")] * width + 1,
                                (F.col("cu_seqlens")[F.col("p.k") + 1] - F.col("cu_seqlens")[F.col("p.k")]) * width).alias("ids")))
