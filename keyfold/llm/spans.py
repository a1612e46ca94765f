"""Substring dedup over sliding runs of sentences."""

from __future__ import annotations

import re
import struct

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import cut, map_rows

#: A sentence ends after its stops and the white space behind them, or at a line end.
_END = re.compile(r"[.!?\n](?:(?<=\n)\n*|(?<!\n)[.!?]*\s+)")
_WORD = re.compile(r"\S+\s*")
#: A sentence of more words than this is taken as parts, cut after the words whose hash
#: is 0 modulo EVERY (where a passage begins does not move the cuts behind it), or after
#: MOST words without such a word, as when one word is repeated.
LONG, EVERY, MOST = 16, 8, 24
#: A run is the fewest consecutive sentences (or parts) with at least these many of each.
RUN_SENTENCES, RUN_WORDS = 2, 16
#: A hashed run has at most as many sentences as it needs words, so its place in a text is
#: one number: first sentence times SPAN, plus its sentences after the first.
SPAN = 1 << max(RUN_SENTENCES, RUN_WORDS).bit_length()


def sentences(text: str, *, places: bool = True) -> list[tuple[int, int, list[str]]]:
    """(start, end, lower-cased words) of each sentence or part, in order; together they
    cover the text; blank pieces join the sentence before them. Without ``places``, start
    and end are not worked out for parts."""
    out: list[tuple[int, int, list[str]]] = []
    digest, start = xxhash.xxh32_intdigest, 0
    for end in [*[m.end() for m in _END.finditer(text)], len(text)]:
        words = text[start:end].lower().split()
        if not words:
            if out:
                out[-1] = (out[-1][0], end, out[-1][2])
        elif len(words) <= LONG:
            out.append((start, end, words))
        else:
            stops = [start + m.end() for m in _WORD.finditer(text[start:end])] if places else []
            first, n = 0, len(words) - 1
            for k in [*[k for k, w in enumerate(words) if not digest(w) % EVERY], n]:
                while first <= k:
                    last = min(k, first + MOST - 1)
                    stop = stops[last] if places else end
                    out.append((start, stop, words[first:last + 1]))
                    start, first = stop, last + 1
        start = end
    return out


def _starts(text: str | None, longer: bool = True) -> list[tuple[int, int, int, int, list[tuple[int, int, int]]]]:
    """(hash, check, first, last, more) of the shortest run from each sentence: the fewest
    sentences with ``RUN_SENTENCES`` and ``RUN_WORDS``; 96 bits identify its words. ``more``
    holds (hash, check, last) of the longer runs from there whose last sentence ends no
    shortest run: the fewest sentences back from it. Both kinds together cover a repeated
    passage of any length whole, the shortest runs up to the last that lies in it and a
    longer one from there to its end; and a longer one repeats only where its own shortest
    run does. Without ``longer``, ``more`` is empty."""
    found = [w for _, _, w in sentences(text or "", places=False)]
    joined = [" ".join(w) for w in found]
    sizes = [len(w) for w in found]

    def key(first, last):
        h = xxhash.xxh3_128_intdigest(" ".join(joined[first:last]))
        return (h >> 64) - (1 << 63), (h & 0xFFFFFFFF) - (1 << 31)

    out, last, words = [], 0, 0
    for first in range(len(found)):
        if last < first:
            last, words = first, 0
        ended = last
        while last < len(found) and (words < RUN_WORDS or last - first < RUN_SENTENCES):
            words += sizes[last]
            last += 1
        short = words < RUN_WORDS or last - first < RUN_SENTENCES
        if out and longer:
            out[-1][4].extend((*key(first - 1, k), k - 1) for k in range(ended + 1, last + short))
        if short:
            break
        out.append((*key(first, last), first, last - 1, []))
        words -= sizes[first]
    return out


def runs(text: str | None) -> list[tuple[int, int, int, int]]:
    """(hash, check, first, last) of every run that is hashed (``_starts``)."""
    return [x for h, c, first, last, more in _starts(text)
            for x in [(h, c, first, last), *[(mh, mc, first, to) for mh, mc, to in more]]]


#: Hash and check of a longer run; the runs from one sentence end at consecutive sentences.
_MORE = "<qi"


def _packed(more: list[tuple[int, int, int]]) -> bytes | None:
    return b"".join(struct.pack(_MORE, h, c) for h, c, _ in more) or None


def _without(text: str, removed: list[tuple[int, int]]) -> tuple[str, int]:
    """(text without the sentences of the runs, number of removed sentences)."""
    if not removed:
        return text, 0
    gone = set()
    for first, last in removed:
        gone.update(range(first, last + 1))
    return "".join(text[a:b] for k, (a, b, _) in enumerate(sentences(text)) if k not in gone), len(gone)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_removed) of every row: the text without the sentences
    that lie in a repeated run other than its first occurrence (smallest doc_id, then
    first in the text) in the whole table.

    The runs of ``_starts`` are hashed: what they cover is what all runs of every length
    cover. Hashes of shortest runs that occur more than once are found by a count that is
    combined map-side; only runs with such a hash are joined on, with the longer runs from
    the same sentence, which no other can repeat; and the first occurrence is again an
    aggregate, so a passage that a third of all documents share is never gathered in one
    task, and a hot hash meets one row of the other side, which a skewed join splits. Texts
    move once, to meet their runs.

    Null text: null. Empty and blank texts: as they are. Null doc_id: its runs
    count, after all others, but its text is returned whole. Repeated rows with the same
    doc_id are one document: their equal runs are the same occurrence. Empty table: empty
    result. Other columns are not read."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    hashes = map_rows(rows.select("text"), lambda: lambda r: [(x[0],) for x in _starts(r[0], False)], "h long", per_batch=65536)
    twice = cut(hashes.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("h").alias("again")))
    places = map_rows(rows, lambda: lambda r: [(h, c, first * SPAN + last - first, r[0], _packed(more)) for h, c, first, last, more in _starts(r[1])],
                      "h long, c int, at long, doc_id long, more binary", per_batch=65536)
    held = cut(places.join(twice, F.col("h") == F.col("again")).drop("again"))
    longer = map_rows(held.where("more IS NOT NULL").select("at", "doc_id", "more"),
                      lambda: lambda r: [(h, c, r[0] + k + 1, r[1]) for k, (h, c) in enumerate(struct.iter_unpack(_MORE, r[2]))],
                      "h long, c int, at long, doc_id long", per_batch=65536)
    held = held.drop("more").unionByName(longer)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "at")
    firsts = cut(held.groupBy("h", "c").agg(F.min(place).alias("p"), F.count(F.lit(1)).alias("n")).where("n > 1")
                 .select(F.col("h").alias("fh"), F.col("c").alias("fc"), F.col("p.doc_id").alias("fd"), F.col("p.at").alias("fat")))
    removed = (held.join(firsts, (F.col("h") == F.col("fh")) & (F.col("c") == F.col("fc")))
               .where("doc_id IS NOT NULL AND NOT (doc_id <=> fd AND at = fat)")
               .groupBy(F.col("doc_id").alias("in_doc")).agg(F.collect_set("at").alias("removed")))
    joined = rows.join(removed, F.col("doc_id") == F.col("in_doc"), "left").select("doc_id", "text", "removed")

    def rewrite(batches):
        for b in batches:
            out = []
            for k in range(b.num_rows):
                doc, text, gone = (b.column(i)[k].as_py() for i in range(3))
                out.append((doc, text, 0) if text is None else
                           (doc, *_without(text, [(g // SPAN, g // SPAN + g % SPAN) for g in gone or []])))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out) if out else [()] * 3, (pa.int64(), pa.string(), pa.int32()))],
                names=["doc_id", "text", "n_removed"])

    return joined.mapInArrow(rewrite, "doc_id long, text string, n_removed int")
