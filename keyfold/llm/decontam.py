"""Benchmark decontamination by latent semantic retrieval."""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from keyfold.llm.common import _arrow_types, cut, id_and_bytes

#: Benchmark items searched for in one pass; more are searched block by block.
BLOCK_ITEMS = 4096
#: Rank of the latent space, and extra directions of the randomised range finder.
RANK, EXTRA, POWER = 128, 16, 2
#: Words of a passage when terms are counted and the space is fitted.
PASSAGE = 32
#: Words summed together; window starts and lengths are multiples of it.
STEP = 4
#: Least cosine of a candidate passage. With 128 whitened directions an unrelated passage
#: has a cosine of about 0 +- 0.09, so some pass; the checks on the text drop them.
COSINE = 0.2
#: Least share of the item's squared TF-IDF weight that a candidate must hold, term by term.
CONTAINED = 0.3
#: Share of the item's words that a longest common subsequence must hold; less will do if
#: the item's answer is there.
SAME, PARAPHRASE, ANSWER = 0.8, 0.6, 0.8
#: Shorter items prove nothing. An answer may be shorter: with ``ANSWER``, under this many
#: words must all be there, beside ``PARAPHRASE`` of the item.
LEAST_WORDS = 5
#: An item of WIDE_WORDS or more words is also searched for in stretches of WIDE times its
#: length, as when foreign words stand between its own; ``SAME`` of it must be there.
WIDE, WIDE_WORDS = 3, 12
#: Of an item's rarest words, so many must stand in a window before its cosine is worked out.
RARE = 4
#: Words searched together, and windows whose vectors are made together.
TOGETHER, ROWS = 1 << 16, 256
#: Pairs of terms that a task counts together, and counts that it holds before it passes
#: them on; parts that the rows of the table of counts are dealt into; cells of the table
#: that are multiplied together.
PAIRS, HELD, PARTS, CELLS = 1 << 21, 1 << 21, 256, 1 << 20

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Words without ASCII punctuation, A-Z lower-cased."""
    return (text or b"").translate(_FOLD).split()


def answer_of(text: bytes) -> list[bytes]:
    """The words of an item's last sentence, however short: what a question asks for stands
    last. Of an item of one sentence, its last quarter, ``LEAST_WORDS`` at least."""
    parts = [w for p in re.split(rb"[.!?\n]+", text) if (w := words_of(p))]
    if len(parts) == 1:
        return parts[0][-max(LEAST_WORDS, len(parts[0]) // 4):]
    return parts[-1] if parts else []


def common_subsequence(a_places: dict[int, int], length: int, b) -> int:
    """Length of the longest common subsequence of a sequence, given as the bit places of
    each value, and ``b``: one big-integer step per element of ``b``."""
    row = full = (1 << length) - 1
    for x in b:
        at = a_places.get(x)
        if at:
            hit = row & at
            row = ((row + hit) | (row - hit)) & full
    return length - row.bit_count()


def places(ids) -> dict[int, int]:
    out: dict[int, int] = {}
    for k, x in enumerate(ids):
        out[x] = out.get(x, 0) | 1 << k
    return out


def _scale(length: int) -> int:
    """The least of 16, 24, 32, 48, 64, 96, ... that is at least ``length``."""
    power = max(16, 1 << (length - 1).bit_length())
    return power * 3 // 4 if power > 16 and length <= power * 3 // 4 else power


class Items:
    """One block of benchmark items: their vocabulary (0: any other word), ids and answers."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        kept = [(i, t, w) for i, t in rows if len(w := words_of(t)) >= LEAST_WORDS]
        self.item_ids = [i for i, _, _ in kept]
        self.number: dict[bytes, int] = {}
        for _, _, w in kept:
            for x in w:
                self.number.setdefault(x, len(self.number) + 1)
        self.ids = [np.array([self.number[x] for x in w]) for _, _, w in kept]
        self.answers = [[self.number[x] for x in answer_of(t)] for _, t, _ in kept]
        self.terms = len(self.number) + 1

    def encode(self, text: bytes | None) -> np.ndarray:
        get = self.number.get
        words = words_of(text)
        return np.fromiter((get(w, 0) for w in words), np.int32, len(words))


def _passages(ids: np.ndarray) -> np.ndarray:
    """Passage number of each word."""
    return np.arange(len(ids)) // PASSAGE


def _counted(texts_ids: list[np.ndarray], terms: int) -> list[np.ndarray]:
    """Cells of the table of ``co_occurrences`` on and above its diagonal, each as often as
    it counts, of the passages of encoded texts."""
    base = np.cumsum([0] + [-(-len(x) // PASSAGE) for x in texts_ids])
    ids = np.concatenate(texts_ids).astype(np.int64)
    at = np.concatenate([_passages(x) + n for x, n in zip(texts_ids, base)])
    key, n = np.unique((at * terms + ids)[ids > 0], return_counts=True)
    passage, term = np.divmod(key, terms)
    out = [np.zeros(base[-1], np.int64), term, np.repeat(term * (terms + 1), n * n)]
    for k in range(1, PASSAGE):
        first = np.flatnonzero(passage[k:] == passage[:-k])
        if not len(first):
            break
        out.append(np.repeat(term[first] * terms + term[first + k], n[first] * n[first + k]))
    return out


def _added(held: tuple[np.ndarray, np.ndarray], key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sum of each one's numbers."""
    key, n = np.concatenate([held[0], key]), np.concatenate([held[1], n])
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.diff(key, prepend=-1) > 0)
    return key[first], np.add.reduceat(n, first) if len(first) else n


_NONE = np.zeros(0, np.int64), np.zeros(0, np.int64)


def _dealt(cell: np.ndarray, n: np.ndarray, terms: int) -> pa.RecordBatch:
    """Cells and their numbers as a row per part; row 0 of the table is a part of its own."""
    row = cell // terms
    part = np.where(row > 0, row % PARTS, -1)
    order = np.argsort(part, kind="stable")
    parts, first = np.unique(part[order], return_index=True)
    found = [[x.tobytes() for x in np.split(y[order], first[1:])] if len(parts) else [] for y in (cell, n)]
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), *[pa.array(x, pa.binary()) for x in found]], names=["part", "cells", "n"])


def _cells(batch: pa.RecordBatch):
    """(part, cells, numbers) of the rows that ``_dealt`` made."""
    for part, cell, n in zip(*(c.to_pylist() for c in batch.columns)):
        yield part, np.frombuffer(cell, np.int64), np.frombuffer(n, np.int64)


def co_occurrences(docs: DataFrame, items: Items) -> DataFrame:
    """(part, cells, n): over the passages of all documents, how often each two terms meet,
    repeats counted (the Gram matrix of the passages' term counts), cell i * terms + j for
    each of its two triangles. Row 0: how many passages hold each term, column 0: passages.

    Counted per task within ``HELD`` cells; the upper triangle is added up part by part, and
    each part then sends what it mirrors to the parts of those rows. The table is bounded by
    the block's terms, whatever the corpus."""
    terms, schema = items.terms, "part int, cells binary, n binary"

    def count(batches):
        held, new, texts, size, pairs = _NONE, [], [], 0, 0

        def add():
            key = np.sort(np.concatenate(new))
            first = np.flatnonzero(np.diff(key, prepend=-1) > 0)
            return _added(held, key[first], np.diff(first, append=len(key)))

        def counted():
            found = _counted(texts, terms)
            new.extend(found)
            return sum(map(len, found))

        for b in batches:
            for text in b.column(1):
                ids = items.encode(text.as_py())
                # of a long text, whole passages together
                for s in range(0, len(ids), TOGETHER):
                    texts.append(ids[s:s + TOGETHER])
                    size += len(texts[-1])
                    if size >= TOGETHER:
                        pairs += counted()
                        texts, size = [], 0
                        if pairs >= PAIRS:
                            held, new, pairs = add(), [], 0
                            if len(held[0]) >= HELD:
                                yield _dealt(*held, terms)
                                held = _NONE
        if texts:
            counted()
        if new:
            held = add()
        if len(held[0]):
            yield _dealt(*held, terms)

    def total(batches, mirrored: bool):
        held: dict[int, tuple] = {}
        for b in batches:
            for part, cell, n in _cells(b):
                held[part] = _added(held.get(part, _NONE), cell, n)
        for cell, n in held.values():
            row, column = np.divmod(cell, terms)
            below = (row > 0) & (row < column) if mirrored else np.zeros(len(cell), bool)
            yield _dealt(np.r_[cell, column[below] * terms + row[below]], np.r_[n, n[below]], terms)

    upper = docs.mapInArrow(count, schema).repartition("part").mapInArrow(lambda batches: total(batches, True), schema)
    return cut(upper.repartition("part").mapInArrow(lambda batches: total(batches, False), schema))


def document_frequencies(table: DataFrame, items: Items) -> tuple[int, np.ndarray]:
    """(passages, passages per term) from row 0 of ``co_occurrences``."""
    df = np.zeros(items.terms, np.int64)
    for b in table.where("part = -1").toArrow().to_batches():
        for _, cell, n in _cells(b):
            df[cell] += n
    return int(df[0]), df


def _sum_by(key: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of each key 0..n-1."""
    out = np.zeros((n, rows.shape[1]))
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(key[order]) > 0])
    out[key[order][first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


def _gram(texts_ids: list[np.ndarray], idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """(A^T A) basis of the TF-IDF passages of encoded texts, without forming A."""
    out = np.zeros(basis.shape)
    weighed = basis * idf[:, None]
    for s in range(0, len(texts_ids), 100):
        block = [x for x in texts_ids[s:s + 100] if len(x)]
        if not block:
            continue
        ids = np.concatenate(block)
        base = np.cumsum([0] + [-(-len(x) // PASSAGE) for x in block])
        at = np.concatenate([_passages(x) + n for x, n in zip(block, base)])
        y = np.add.reduceat(weighed[ids], np.flatnonzero(np.r_[True, np.diff(at) > 0]), axis=0)
        out += _sum_by(ids, idf[ids][:, None] * y[at], len(out))
    return out


def _product(cell: np.ndarray, n: np.ndarray, weighed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, their product with ``weighed``) of sorted cells of the table of co-occurrences."""
    row, column = np.divmod(cell, len(weighed))
    rows, first = np.unique(row, return_index=True)
    out, ends = np.zeros((len(rows), weighed.shape[1])), np.r_[first, len(cell)]
    step = max(1, CELLS // len(weighed))
    for s in range(0, len(rows), step):
        last = min(len(rows), s + step)
        a, b = ends[s], ends[last]
        used, at = np.unique(column[a:b], return_inverse=True)
        dense = np.zeros((last - s, len(used)))
        dense[np.repeat(np.arange(last - s), np.diff(ends[s:last + 1])), at] = n[a:b]
        out[s:last] = dense @ weighed[used]
    return rows, out


def latent_space(table: DataFrame, items: Items, idf: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Term vectors (terms x rank) of a randomised SVD of the TF-IDF passages of all
    documents, given as ``co_occurrences``, and of the items: a random range of rank + EXTRA
    directions, POWER distributed products with A^T A, orthogonalised each time, then a
    small eigenproblem. Directions are divided by their singular value, so that common
    words do not rule the cosine."""
    size = min(rank + EXTRA, items.terms)
    basis = np.linalg.qr(np.random.default_rng(0).standard_normal((items.terms, size)))[0]
    for k in range(POWER + 1):
        def run(batches, weighed=basis * idf[:, None]):
            for b in batches:
                for _, cell, n in _cells(b):
                    rows, v = _product(cell, n, weighed)
                    yield pa.RecordBatch.from_arrays([pa.array(rows.astype(np.int32)), pa.array([x.tobytes() for x in v], pa.binary())],
                                                     names=["term", "v"])

        image = _gram(items.ids, idf, basis)
        for b in table.where("part >= 0").mapInArrow(run, "term int, v binary").toArrow().to_batches():
            row = b.column(0).to_numpy()
            image[row] += idf[row, None] * np.frombuffer(b"".join(b.column(1).to_pylist())).reshape(-1, size)
        if k < POWER:
            basis = np.linalg.qr(image)[0]
    value, vector = np.linalg.eigh(basis.T @ image)
    top = [k for k in np.argsort(-value)[:rank] if value[k] > 1e-9 * value.max()]
    terms = basis @ vector[:, top] / np.sqrt(value[top]) * idf[:, None]
    terms[0] = 0
    return terms.astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    return x / np.where(norm > 0, norm, 1)[:, None]


class Searcher:
    """Cosine search of windows for items, then the exact checks.

    An item is searched for in windows of its length rounded up (``_scale``), and, with
    ``WIDE_WORDS`` or more words, in windows of ``WIDE`` times its length, where foreign
    words stand between its own: its forms. Windows begin every quarter of a window, so
    some window starts within an eighth of a window of any passage.

    Cosines are only worked out where the later checks can succeed: of the n words of an
    item at least m must stand in the window and an eighth of it to either side, so of
    its n - m + k rarest words at least k must. This loses nothing that the checks
    accept, whatever the window's cosine."""

    def __init__(self, items: Items, idf: np.ndarray, terms: np.ndarray, cosine: float):
        self.items, self.terms, self.cosine, self.idf = items, terms, cosine, idf
        self.vectors = _unit(np.array([terms[x].sum(axis=0) for x in items.ids], np.float32).reshape(-1, terms.shape[1]))
        self.places = [places(x.tolist()) for x in items.ids]
        self.answer_places = [places(a) for a in items.answers]
        self.weight = np.zeros(len(idf), np.float32)
        forms = [(k, _scale(len(x)), PARAPHRASE) for k, x in enumerate(items.ids)]
        forms += [(k, _scale(WIDE * len(x)), SAME) for k, x in enumerate(items.ids) if len(x) >= WIDE_WORDS]
        self.item = np.array([k for k, _, _ in forms], np.int64)
        self.scale = np.array([s for _, s, _ in forms], np.int64)
        self.wide = np.array([least == SAME for _, _, least in forms], bool)
        self.hop = np.maximum(1, self.scale // STEP // 4) * STEP
        self.lap = self.scale // 8
        self.need = np.zeros(len(forms), np.int64)
        postings = []
        for f, (k, _, least) in enumerate(forms):
            ids = items.ids[k]
            m = math.ceil(least * len(ids) - 1e-9)
            self.need[f] = min(RARE, m)
            rarest = np.argsort(-idf[ids], kind="stable")[:len(ids) - m + self.need[f]]
            postings.extend((t, f) for t in set(ids[rarest].tolist()))
        postings.sort()
        self.first = np.searchsorted([t for t, _ in postings], np.arange(items.terms + 1))
        self.forms = np.array([f for _, f in postings], np.int64)

    def reachable(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(form, window number) of the windows with enough of the item's rarest words."""
        count = np.diff(self.first)[ids]
        at = np.repeat(np.arange(len(ids)), count)
        inner = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        form = self.forms[np.repeat(self.first[ids], count) + inner]
        hop, lap = self.hop[form], self.lap[form]
        low = np.maximum(0, (at - self.scale[form] - lap) // hop + 1)
        high = (at + lap) // hop
        cells = [(form << 32 | low + k)[low + k <= high] for k in range(int((high - low).max(initial=0)) + 1)]
        cell, n = np.unique(np.concatenate(cells), return_counts=True)
        cell = cell[n >= self.need[cell >> 32]]
        return cell >> 32, cell & 0xFFFFFFFF

    def contained(self, ids: np.ndarray, form: int, start: np.ndarray) -> np.ndarray:
        """Share of the item's squared TF-IDF weight on terms of each window."""
        own, scale, lap = self.items.ids[self.item[form]], int(self.scale[form]), int(self.lap[form])
        self.weight[own] = self.idf[own] ** 2
        at = start[:, None] + np.arange(-lap, scale + lap)
        share = self.weight[ids[np.clip(at, 0, len(ids) - 1)]].sum(axis=1) / self.weight[own].sum()
        self.weight[own] = 0
        return share

    def windows(self, ids: np.ndarray):
        """(form, start, cosine) of candidate windows of an encoded text."""
        padded = np.r_[ids, np.zeros(1, np.int32)]
        form, number = self.reachable(ids)
        ends = np.flatnonzero(np.diff(np.r_[-1, form, -1]))             # form is sorted: one run per form
        for a, b in zip(ends[:-1], ends[1:]):
            for s in range(a, b, ROWS):
                f, start = int(form[a]), number[s:min(b, s + ROWS)] * int(self.hop[form[a]])
                at = np.minimum(start[:, None] + np.arange(int(self.scale[f])), len(ids))
                cos = _unit(self.terms[padded[at]].sum(axis=1)) @ self.vectors[self.item[f]]
                near = np.flatnonzero(cos >= self.cosine)
                good = near[self.contained(padded, f, start[near]) >= CONTAINED] if len(near) else near
                for g in good:
                    yield f, int(start[g]), float(cos[g])

    def check(self, ids: np.ndarray, form: int, start: int) -> tuple[float, float]:
        """Shares of the item's and of its answer's words in the longest common
        subsequences with the window and an eighth of it to either side."""
        item, lap = int(self.item[form]), int(self.lap[form])
        near = ids[max(0, start - lap):max(0, start + int(self.scale[form]) + lap)].tolist()
        whole = common_subsequence(self.places[item], len(self.items.ids[item]), near) / len(self.items.ids[item])
        answer = self.items.answers[item]
        if whole < PARAPHRASE or not answer:
            return whole, 0.0
        return whole, common_subsequence(self.answer_places[item], len(answer), near) / len(answer)

    def hits(self, texts: list[np.ndarray]):
        """(text number, item, cosine, lcs, answer, start) of what passes the checks, the
        best window of each text and item. Texts are searched end to end; a window that
        runs into the next text only adds noise, and checks stay within a text."""
        starts = np.cumsum([0] + [-(-len(t) // STEP) * STEP for t in texts])
        joined = np.zeros(starts[-1], np.int32)
        for s, t in zip(starts, texts):
            joined[s:s + len(t)] = t
        best: dict[tuple[int, int], tuple] = {}
        for form, at, cos in self.windows(joined):
            item, last = int(self.item[form]), min(at + int(self.scale[form]), len(joined)) - 1
            # The window may run over several texts.
            for doc in range(int(np.searchsorted(starts, at, side="right")) - 1, int(np.searchsorted(starts, last, side="right"))):
                whole, answer = self.check(texts[doc], form, at - int(starts[doc]))
                if whole >= SAME or whole >= PARAPHRASE and answer >= ANSWER and not self.wide[form]:
                    found = (whole, answer, cos, max(0, at - int(starts[doc])))
                    best[doc, item] = max(best.get((doc, item), found), found)
        return [(d, i, c, w, a, s) for (d, i), (w, a, c, s) in best.items()]


def _search(docs: DataFrame, items: Items, idf: np.ndarray, terms: np.ndarray, cosine: float, schema: str) -> DataFrame:
    spark = docs.sparkSession
    names, types = [f.split()[0] for f in schema.split(", ")], _arrow_types(spark, schema)

    def run(batches):
        searcher = Searcher(items, idf, terms, cosine)
        # A long text is searched in parts that overlap by the longest stretch that is checked.
        part, lap = TOGETHER, 2 * int(searcher.scale.max())

        def out(at, texts):
            rows = [(at[d][0], items.item_ids[i], c, w, a, at[d][1] + s) for d, i, c, w, a, s in searcher.hits(texts)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, types)], names=names)

        for b in batches:
            at, texts, size = [], [], 0
            for i, t in zip(b.column(0), b.column(1)):
                encoded = items.encode(t.as_py())
                for s in range(0, max(1, len(encoded) - lap), part):
                    at.append((i.as_py(), s))
                    texts.append(encoded[s:s + part + lap])
                    size += len(texts[-1])
                    if size >= TOGETHER:
                        yield out(at, texts)
                        at, texts, size = [], [], 0
            if at:
                yield out(at, texts)

    return docs.mapInArrow(run, schema)


def find(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", cosine: float = COSINE) -> DataFrame:
    """(doc_id, item_id, cosine, lcs, answer, start_word): each document and benchmark item
    whose passage it holds, verbatim or paraphrased; only such pairs are returned.

    The items are a query set, searched in blocks of ``BLOCK_ITEMS``. Per block: one pass
    counts the passages of all documents that hold each of the items' words, for the TF-IDF
    weights, and how often each two meet (``co_occurrences``); a distributed randomised SVD
    of those counts gives the latent space of all documents and all items
    (``latent_space``); all windows of all texts are searched by cosine
    within their partition; candidates are held against the text: ``CONTAINED`` of the
    item's TF-IDF weight on the window's terms, then a longest common subsequence with ``SAME`` of the item's words, or ``PARAPHRASE`` of them and
    ``ANSWER`` of its last sentence. An item with foreign words between its own is found if
    ``SAME`` of it stands in order in ``WIDE`` times its length. Only term tables and spaces, bounded by a block's
    words, reach the driver; no document row is shuffled.

    item_id keeps its type; whole numbers become long. start_word: where the best window
    starts in the text's words. Null and empty texts hold nothing. Null doc_id: searched, doc_id null. Items that are null,
    empty or shorter than ``LEAST_WORDS`` words match nothing. Repeated rows: each is
    searched, and equal result rows appear once. Empty tables: empty result. Other
    columns are not read."""
    texts = id_and_bytes(docs, id_col, text_col)
    kind = benchmark.select(F.col(f"`{item_col}`")).schema[0].dataType
    kind = "long" if isinstance(kind, IntegralType) else kind.simpleString()
    schema = f"doc_id long, item_id {kind}, cosine double, lcs double, answer double, start_word long"
    queries = benchmark.select(F.col(f"`{item_col}`").cast(kind).alias("doc_id"),
                               F.col(f"`{item_text_col}`").cast("string").cast("binary").alias("text")).where("text IS NOT NULL").distinct()
    blocks = math.ceil(queries.count() / BLOCK_ITEMS)
    found = docs.sparkSession.createDataFrame([], schema)
    for k in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)) == k)
        items = Items([(r["doc_id"], bytes(r["text"])) for r in block.orderBy("doc_id", "text").collect()])
        if not items.ids:
            continue
        table = co_occurrences(texts, items)
        passages, df = document_frequencies(table, items)
        if not passages:
            continue
        idf = np.log((1 + passages) / (1 + df)) + 1
        idf[0] = 0
        found = found.unionByName(_search(texts, items, idf, latent_space(table, items, idf), cosine, schema))
    return (found.groupBy("doc_id", "item_id").agg(
        F.max(F.struct("lcs", "answer", "cosine", "start_word")).alias("b"))
        .select("doc_id", "item_id", "b.cosine", "b.lcs", "b.answer", "b.start_word"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark passage; all columns as they
    were. Whether one does hangs on its text alone, so rows are known by the 64-bit hash
    of their text: rows without doc_id and rows that share one are judged by their own
    texts. Rows without text stay."""
    def digest(df: DataFrame):
        return F.xxhash64(df["text"].cast("string"))

    texts = docs.where(docs["text"].isNotNull()).select(digest(docs).alias("doc_id"), docs["text"].alias("text"))
    leaks = find(texts, benchmark).select(F.col("doc_id").alias("__kf_text")).distinct()
    return docs.join(cut(leaks), digest(docs) == F.col("__kf_text"), "left_anti")
