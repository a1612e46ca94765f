"""Language-model scores from a class-based bigram model (Brown classes by exchange)."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import crc_mod, cut, id_and_bytes
from keyfold.session import scratch_path

#: At most so many words, the most frequent ones, are clustered from both sides; every
#: task holds their numbers, counts and classes. The other words are a distributed table.
HEAD = 1 << 18
#: Types the classes start from: the most frequent words one by one, all others by their
#: last letters, and the end of a text.
WORD_TYPES, ENDINGS = 1024, 512
END = WORD_TYPES + ENDINGS
TYPES = END + 1
CLASSES = 32
N = CLASSES + 1
ROUNDS = 8
#: Rounds over all words of the head; half of them may move in each.
WIDE_ROUNDS = 2
#: A word outside the head that occurs so often in training has a class by its own contexts.
LEAST = 2
#: Smoothing of word and of transition counts.
WORD_SMOOTH, STEP_SMOOTH = 0.1, 0.1
#: Tokens, and bytes of text, worked on together.
SLICE, BYTES = 1 << 19, 1 << 22


def ending(word: bytes) -> int:
    """Number of a word's last letters, which stand for it where it has no class of its own."""
    return crc32(word[-3:]) % ENDINGS


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(pairs: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Class of each type, given the counts of type pairs (types x types). Starts from
    classes dealt by frequency; then each type in turn, frequent ones first, moves to the
    class that gives the class bigram model the highest likelihood; until a round moves
    none. The last type, the end of a text, keeps a class of its own (number ``classes``)."""
    pairs = pairs.astype(np.float64)
    weight = pairs.sum(axis=0) + pairs.sum(axis=1)
    order = np.argsort(-weight[:-1], kind="stable")
    of = np.empty(len(pairs), np.int64)
    of[order] = np.arange(len(order)) % classes
    of[-1] = classes
    n = classes + 1
    one = np.eye(n)[of]
    after, before = pairs @ one, pairs.T @ one          # per type: counts of following / preceding classes
    grid = one.T @ after
    for _ in range(rounds):
        moved = 0
        for w in order:
            if not weight[w]:
                continue
            a, self_pair = of[w], pairs[w, w]
            right, left = after[w].copy(), before[w].copy()
            right[a] -= self_pair
            left[a] -= self_pair
            grid[a] -= right
            grid[:, a] -= left
            grid[a, a] -= self_pair
            out, into = grid.sum(axis=1), grid.sum(axis=0)
            row = _xlogx(grid + right) - _xlogx(grid)
            col = (_xlogx(grid + left[:, None]) - _xlogx(grid)).T
            d = np.arange(n)
            corner = grid[d, d]
            gain = (row.sum(axis=1) - row[d, d] + col.sum(axis=1) - col[d, d]
                    + _xlogx(corner + right + left + self_pair) - _xlogx(corner)
                    - _xlogx(out + right.sum() + self_pair) + _xlogx(out)
                    - _xlogx(into + left.sum() + self_pair) + _xlogx(into))
            b = int(np.argmax(gain[:classes]))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            grid[b] += right
            grid[:, b] += left
            grid[b, b] += self_pair
            if b != a:
                moved += 1
                of[w] = b
                after[:, a] -= pairs[:, w]
                after[:, b] += pairs[:, w]
                before[:, a] -= pairs[w]
                before[:, b] += pairs[w]
        if not moved:
            break
    return of


def tokens_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words, sizes): the words of all texts of an array in order, A-Z lower-cased, and
    how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, b"").view(pa.string())))
    flat, offsets = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    full = pc.greater(pc.binary_length(flat), 0)
    upto = np.r_[0, np.cumsum(full.to_numpy(zero_copy_only=False))]
    return flat.filter(full).view(pa.binary()), np.diff(upto[offsets])


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows with about ``BYTES`` of text each."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over all ``texts``, counted per batch, then summed."""
    def run(batches):
        for whole in batches:
            for b in _slices(whole, 1):
                found = pc.value_counts(tokens_of(b.column(1))[0])
                yield pa.RecordBatch.from_arrays([found.field(0), found.field(1)], names=["word", "n"])
    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _head(vocab: DataFrame, most: int) -> tuple[list[bytes], np.ndarray]:
    """The most frequent words and their counts: all words whose count is over a threshold
    that at most ``most`` words reach, read off a histogram of counts (at most 16,384 bins),
    so that no task sorts the vocabulary."""
    size = F.floor(F.log2("n") * 256).cast("int")
    bins = sorted(((r["b"], r["count"]) for r in vocab.groupBy(size.alias("b")).count().collect()), reverse=True)
    least, total = None, 0
    for b, n in bins:
        total += n
        if total > most:
            break
        least = b
    if least is None:
        return [], np.zeros(0)
    top = vocab.where(size >= least).toArrow()
    found = sorted(zip((-top["n"].to_numpy()).tolist(), top["word"].to_pylist()))
    return [w for _, w in found], np.array([-n for n, _ in found], np.float64)


def _encoded(texts: DataFrame, words: list[bytes]) -> DataFrame:
    """``texts`` as numbers, written to the shared folder once: ids has a word's number in
    the head, or the head's size plus the number of its ending; rare has the words outside
    the head in order."""
    h, head = len(words), pa.array(words, pa.binary())

    def run(batches):
        for whole in batches:
            for b in _slices(whole, 4):
                flat, sizes = tokens_of(b.column(4))
                ids = pc.index_in(flat, value_set=head)
                rare = flat.filter(pc.is_null(ids))
                last = pc.dictionary_encode(pc.binary_slice(rare, -3))
                endings = np.array([ending(w) for w in last.dictionary.to_pylist()], np.int32)
                far = pc.is_null(ids).to_numpy(zero_copy_only=False)
                ids = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).copy()
                ids[far] = h + endings[last.indices.to_numpy(zero_copy_only=False)]
                upto, rare_upto = np.r_[0, np.cumsum(sizes)], np.r_[0, np.cumsum(far)]
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(k) for k in range(4)), pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(ids)),
                     pa.ListArray.from_arrays(pa.array(rare_upto[upto], pa.int32()), rare)],
                    names=["key", "doc_id", "held_out", "train", "ids", "rare"])

    path = scratch_path(texts.sparkSession, "lm-encoded")
    (texts.mapInArrow(run, "key long, doc_id long, held_out boolean, train boolean, ids array<int>, rare array<binary>")
     .write.option("compression", "zstd").parquet(path))
    return texts.sparkSession.read.parquet(path)


def _chain(ids: pa.ListArray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(units, starts): the rows of a batch as one chain, an ``end`` before, between and
    after them, and the place of the ``end`` before each row."""
    offsets = ids.offsets.to_numpy()
    sizes = np.diff(offsets)
    starts = offsets[:-1] - offsets[0] + np.arange(len(sizes))
    chain = np.full(int(sizes.sum()) + len(sizes) + 1, end, np.int64)
    inner = np.ones(len(chain), bool)
    inner[np.r_[starts, len(chain) - 1]] = False
    chain[inner] = ids.flatten().to_numpy(zero_copy_only=False)
    return chain, starts


def _steps(chains: DataFrame, of: np.ndarray, wide: int, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Counts of neighbouring classes (wide x wide) over all chains, ``of`` giving the class
    of a unit: of all, and of those whose second unit is ``inside``. Counted per task, then
    summed."""
    end = len(of) - 1
    place = of if inside is None else of + np.where(inside, 0, wide * wide)

    def run(batches):
        total = np.zeros(2 * wide * wide if inside is not None else wide * wide, np.int64)
        for b in batches:
            chain, _ = _chain(b.column(0), end)
            for s in range(0, len(chain) - 1, SLICE):
                part = chain[s:s + SLICE + 1]
                total += np.bincount(of[part[:-1]] * wide + place[part[1:]], minlength=len(total))
        pair = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(total[pair])], names=["pair", "n"])

    found = chains.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    grids = np.zeros(2 * wide * wide)
    grids[found["pair"].to_numpy()] = found["n"].to_numpy()
    grids = grids.reshape(2, wide, wide)
    return grids.sum(axis=0), grids[0]


def likelihood(grid: np.ndarray) -> float:
    """Of the class bigram model, but for what depends on the words alone."""
    return float(_xlogx(grid).sum() - _xlogx(grid.sum(axis=0)).sum() - _xlogx(grid.sum(axis=1)).sum())


def better(grid: np.ndarray, left: np.ndarray, right: np.ndarray, own: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Per unit the class that gives the likeliest model if the unit alone is moved there;
    its class ``of`` if none is better. ``left`` and ``right``: per unit the counts of
    classes before and after it, but for the unit itself, which follows itself ``own`` times."""
    gains = np.empty((len(of), CLASSES))
    out, into = grid.sum(axis=1), grid.sum(axis=0)
    n_out, n_into, rows = right.sum(axis=1) + own, left.sum(axis=1) + own, np.arange(len(of))
    for b in range(CLASSES):
        here = (of == b).astype(np.float64)
        # The grid without the unit: it stands in row and column ``of``.
        row, col = grid[b] - here[:, None] * right, grid[:, b] - here[:, None] * left
        row[rows, of] -= (1 - here) * left[:, b]
        col[rows, of] -= (1 - here) * right[:, b]
        corner = grid[b, b] - here * (right[:, b] + left[:, b] + own)
        gain = (_xlogx(row + right) - _xlogx(row)).sum(axis=1) - (_xlogx(row[:, b] + right[:, b]) - _xlogx(row[:, b]))
        gain += (_xlogx(col + left) - _xlogx(col)).sum(axis=1) - (_xlogx(col[:, b] + left[:, b]) - _xlogx(col[:, b]))
        gain += _xlogx(corner + right[:, b] + left[:, b] + own) - _xlogx(corner)
        gain -= _xlogx(out[b] - here * n_out + n_out) - _xlogx(out[b] - here * n_out)
        gain -= _xlogx(into[b] - here * n_into + n_into) - _xlogx(into[b] - here * n_into)
        gains[:, b] = gain
    best = gains.argmax(axis=1)
    return np.where(gains[rows, best] > gains[rows, of] + 1e-9, best, of)


def _moves(chains: DataFrame, of: np.ndarray, grid: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """(units, classes) of those units of one half that ``better`` moves. The counts of
    neighbouring classes are a distributed table of (unit, class); a unit's are together
    in one row of at most 2 * N + 1 numbers."""
    end, wide = len(of) - 1, 2 * N + 1

    def count(batches):
        for b in batches:
            chain, _ = _chain(b.column(0), end)
            for s in range(0, len(chain) - 1, SLICE):
                part = chain[s:s + SLICE + 1]
                u, v = part[:-1], part[1:]
                after, before = (u % 2 == half) & (u != end), (v % 2 == half) & (v != end)
                same = u == v
                key = np.concatenate([v[before & ~same] * wide + of[u[before & ~same]], u[after & ~same] * wide + N + of[v[after & ~same]],
                                      u[after & same] * wide + 2 * N])
                key, n = np.unique(key, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key // wide), pa.array(key % wide), pa.array(n)], names=["unit", "at", "n"])

    def move(batches):
        for b in batches:
            units, cells = b.column(0).to_numpy(zero_copy_only=False), b.column(1)
            flat, sizes = cells.flatten(), np.diff(cells.offsets.to_numpy())
            table = np.zeros((len(units), wide))
            table[np.repeat(np.arange(len(units)), sizes), flat.field(0).to_numpy(zero_copy_only=False)] = flat.field(1).to_numpy(zero_copy_only=False)
            to = better(grid, table[:, :N], table[:, N:2 * N], table[:, -1], of[units])
            moved = to != of[units]
            yield pa.RecordBatch.from_arrays([pa.array(units[moved]), pa.array(to[moved])], names=["unit", "to"])

    found = (chains.mapInArrow(count, "unit long, at long, n long").groupBy("unit", "at").agg(F.sum("n").alias("n"))
             .groupBy("unit").agg(F.collect_list(F.struct("at", "n")).alias("cells"))
             .mapInArrow(move, "unit long, to long").toArrow())
    return found["unit"].to_numpy(), found["to"].to_numpy()


def classes_of(encoded: DataFrame, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(of, grid, inner): the class of each unit (the words of the head, then the endings,
    then the end of a text), the counts of neighbouring classes, and those of them whose
    second unit is a word of the head or the end. ``exchange`` clusters the types; every
    word of the head starts in the class of its type. Then, in each of ``WIDE_ROUNDS``
    rounds over all training texts, every second unit moves to the class that its own
    neighbours make likeliest; the likeliest state of all rounds is kept."""
    h, chains = len(words), encoded.where("train").select("ids")
    core = min(h, WORD_TYPES)
    types = np.array([*range(core), *(WORD_TYPES + ending(w) for w in words[core:]), *range(WORD_TYPES, TYPES)], np.int64)
    inside = np.ones(len(types), bool)
    inside[h:-1] = False
    pairs, inner = _steps(chains, types, TYPES, inside)
    of_type = exchange(pairs)
    one, of = np.eye(N)[of_type], of_type[types]
    grid, inner = one.T @ pairs @ one, one.T @ inner @ one
    best = likelihood(grid), of, grid, inner
    for k in range(WIDE_ROUNDS):
        units, to = _moves(chains, of, grid, k % 2)
        if len(units):
            of = of.copy()
            of[units] = to
            grid, inner = _steps(chains, of, N, inside)
            best = max(best, (likelihood(grid), of, grid, inner), key=lambda x: x[0])
    return best[1:]


def _rare(encoded: DataFrame, of: np.ndarray, h: int) -> DataFrame:
    """(key, train, word, before, own) of every occurrence of a word outside the head:
    the class of the unit before it and the class of its ending."""
    end = len(of) - 1

    def run(batches):
        for b in batches:
            chain, starts = _chain(b.column(2), end)
            at = np.flatnonzero((chain >= h) & (chain < end))
            row = np.searchsorted(starts, at, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), b.column(3).flatten(),
                 pa.array(of[chain[at - 1]].astype(np.int32)), pa.array(of[chain[at]].astype(np.int32))],
                names=["key", "train", "word", "before", "own"])
    return encoded.select("key", "train", "ids", "rare").mapInArrow(run, "key long, train boolean, word binary, before int, own int")


def _rare_classes(rare: DataFrame, grid: np.ndarray) -> DataFrame:
    """(word, n, cls, cells) of the words outside the head that occur in training, written
    to the shared folder. cls is the class that makes the word likeliest after the classes
    before it (``cells``: their counts) if it occurs ``LEAST`` times, else its ending's."""
    into = grid.sum(axis=0)

    def run(batches):
        for b in batches:
            n, own = b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            cells = b.column(3)
            flat, sizes = cells.flatten(), np.diff(cells.offsets.to_numpy())
            before, times = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(2))
            often = n >= LEAST
            row = np.repeat(np.arange(len(n)), sizes)
            before, times, row = before[often[row]], times[often[row]].astype(np.float64)[:, None], row[often[row]]
            cls = own.copy()
            if len(row):
                # Only the classes that come before the word change the likelihood.
                at = np.flatnonzero(often)
                here = (own[at][:, None] == np.arange(CLASSES)) * 1.0
                number = np.cumsum(often)[row] - 1
                cell = grid[before, :CLASSES] - here[number] * times
                total = into[:CLASSES] - here * n[at][:, None]
                gains = (np.add.reduceat(_xlogx(cell + times) - _xlogx(cell), np.flatnonzero(np.r_[True, np.diff(row) > 0]))
                         - (_xlogx(total + n[at][:, None]) - _xlogx(total)))
                to, k = gains.argmax(axis=1), np.arange(len(at))
                cls[at] = np.where(gains[k, to] > gains[k, own[at]] + 1e-9, to, own[at])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cls.astype(np.int32)), cells],
                                             names=["word", "n", "cls", "cells"])

    path = scratch_path(rare.sparkSession, "lm-rare")
    # Dealt by word once; no word outside the head is hot.
    (rare.where("train").select("word", "own", "before").repartition("word").groupBy("word", "own", "before").agg(F.count(F.lit(1)).alias("n"))
     .groupBy("word", "own").agg(F.sum("n").alias("n"), F.collect_list(F.struct("before", "n")).alias("cells"))
     .select("word", "n", "own", "cells")
     .mapInArrow(run, "word binary, n long, cls int, cells array<struct<before:int,n:long>>")
     .write.option("compression", "zstd").parquet(path))
    return rare.sparkSession.read.parquet(path)


class Model(NamedTuple):
    """words, counts: the head. of: class of each unit (words of the head, endings, end).
    rare: (word, n, cls, cells) of the other words. steps: log10 P(class | class before).
    below: per class what a smoothed word count is divided by."""

    words: list[bytes]
    counts: np.ndarray
    of: np.ndarray
    rare: DataFrame
    steps: np.ndarray
    below: np.ndarray


def train(encoded: DataFrame, words: list[bytes], counts: np.ndarray) -> Model:
    """The class model of the training texts among ``encoded``."""
    h = len(words)
    of, grid, steps = classes_of(encoded, words)
    rare = _rare_classes(_rare(encoded, of, h), grid)
    for r in (rare.select("cls", F.explode("cells").alias("c")).groupBy("cls", "c.before").agg(F.sum("c.n").alias("n")).collect()):
        steps[r["before"], r["cls"]] += r["n"]
    distinct, tokens = np.bincount(of[:h], minlength=N).astype(float), np.bincount(of[:h], counts, N)
    for r in rare.groupBy("cls").agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("tokens")).collect():
        distinct[r["cls"]] += r["words"]
        tokens[r["cls"]] += r["tokens"]
    steps = np.log10((steps + STEP_SMOOTH) / (steps.sum(axis=1, keepdims=True) + STEP_SMOOTH * N))
    return Model(words, counts, of, rare, steps, tokens + WORD_SMOOTH * (distinct + 1))


def _table(values: np.ndarray, at: Column) -> Column:
    """Number at a place of a short constant list."""
    return F.element_at(F.expr("array(" + ", ".join(f"{float(x)!r}D" for x in values) + ")"), (at + 1).cast("int"))


def score(docs: DataFrame, *, held_out_of: int = 10, held_out: int = 0, id_col: str = "doc_id", text_col: str = "text",
          head: int = HEAD) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) of
    every row of ``docs``.

    Tokens: the words of the whole text, A-Z lower-cased, then one end. The training rows
    are those whose crc32(doc_id) modulo ``held_out_of`` is not ``held_out``; all counts
    are over all of them. Words are assigned to classes by the exchange algorithm: the at
    most ``head`` most frequent ones by the classes on both sides (``classes_of``), the
    others that occur ``LEAST`` times by the classes before them (``_rare_classes``), rarer
    and unseen ones by their last three bytes. log10 P(text) = sum of log10 P(class of the
    word | class before) + log10 P(word | its class), add-smoothed; the class before is
    that of the ending where the word before is outside the head, so that it is known
    without a join. A class keeps the mass of one unseen word. perplexity is
    10^(-score / n_tokens). base_score is the smoothed unigram score.

    The words outside the head are a distributed table that grows with the corpus; their
    occurrences are joined to it and summed per row. No text is shuffled. The texts are
    read twice, to count words and to write them as numbers, which all later passes read.

    Null, empty and blank texts: one token, the end. Null doc_id: scored, held_out false,
    not learnt from. Repeated rows: each is returned and learnt from. Nothing to learn
    from: all counts 0, base_score 0 when the smoothed vocabulary has one slot. Empty
    table: empty result. Other columns are not read."""
    texts = id_and_bytes(docs, id_col, text_col)
    crc = crc_mod(F.col("doc_id"), held_out_of)
    vocab = cut(_count_words(texts.where(crc != held_out)))
    ends = texts.where(crc != held_out).count()
    sums = vocab.agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("n")).first()
    tokens, distinct = (sums["n"] or 0) + ends, sums["v"] + (1 if ends else 0)
    words, counts = _head(vocab, head)
    encoded = _encoded(texts.select(F.monotonically_increasing_id().alias("key"), "doc_id",
                                    F.coalesce(crc == held_out, F.lit(False)).alias("held_out"),
                                    F.coalesce(crc != held_out, F.lit(False)).alias("train"), "text"), words)
    model = train(encoded, words, counts)
    h, of, steps = len(words), model.of, model.steps
    end, base_below = len(of) - 1, tokens + WORD_SMOOTH * (distinct + 1)
    # Per unit what it adds wherever it stands; words outside the head are added by the join.
    base, emitted, known = np.zeros(len(of)), np.zeros(len(of)), np.zeros(len(of), np.int64)
    base[:h], known[:h] = np.log10((counts + WORD_SMOOTH) / base_below), 1
    emitted[:h] = np.log10((counts + WORD_SMOOTH) / model.below[of[:h]])
    base[end], known[end] = np.log10((ends + WORD_SMOOTH) / base_below), int(ends > 0)
    inside = np.ones(len(of), bool)
    inside[h:end] = False

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            chain, starts = _chain(b.column(3), end)
            u, v = chain[:-1], chain[1:]
            each = np.where(inside[v], emitted[v] + steps[of[u], of[v]], 0.0)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(k) for k in range(3)), pa.array(np.diff(np.r_[starts, len(v)])), pa.array(np.add.reduceat(known[v], starts)),
                 pa.array(np.add.reduceat(base[v], starts)), pa.array(np.add.reduceat(each, starts))],
                names=["key", "doc_id", "held_out", "n_tokens", "k", "b", "s"])

    rows = encoded.select("key", "doc_id", "held_out", "ids").mapInArrow(
        run, "key long, doc_id long, held_out boolean, n_tokens long, k long, b double, s double")
    n, cls = F.coalesce("n", F.lit(0)), F.coalesce("cls", "own")
    added = (_rare(encoded, of, h).join(model.rare.select("word", "n", "cls"), "word", "left").groupBy("key").agg(
        F.sum(F.when(n > 0, 1).otherwise(0)).alias("rare_k"),
        F.sum(F.log10((n + F.lit(WORD_SMOOTH)) / F.lit(float(base_below)))).alias("rare_b"),
        F.sum(F.log10((n + F.lit(WORD_SMOOTH)) / _table(model.below, cls)) + _table(steps.ravel(), F.col("before") * N + cls)).alias("rare_s")))
    return (rows.join(added, "key", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("k") + F.coalesce("rare_k", F.lit(0))).alias("n_known"),
        F.lit(int(tokens)).cast("long").alias("train_tokens"),
        (F.col("b") + F.coalesce("rare_b", F.lit(0.0))).alias("base_score"),
        (F.col("s") + F.coalesce("rare_s", F.lit(0.0))).alias("score"))
        .withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))))
