"""Main text of web pages: nearest-URL page differencing over parsed blocks."""

from __future__ import annotations

import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import cut
from keyfold.operators.sizing import bounded_broadcast

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
                  r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Elements by what they mean for the text (from the HTML standard).
RAW = {"script", "style", "template", "noscript", "title", "textarea", "iframe", "svg", "object", "canvas", "select"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
CHROME = {"nav", "footer", "aside", "form", "head", "menu", "dialog", "button"}
CONTENT = {"article", "main"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd",
          "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "td", "th", "tt", "u",
          "var", "wbr", "br"}
#: Names of things that are not the article, as the last word of a class or id: what such
#: a name means stands last ("site-footer"; a "share-price" is a price).
CHROME_NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
                "consent", "cookie", "cookies", "copyright", "disqus", "footer", "masthead", "menu", "modal", "nav", "navbar",
                "navigation", "newsletter", "notice", "pagination", "popup", "promo", "recommended", "related", "share", "sharing",
                "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "tags", "widget"}
#: Last words that only hold what the word before them names ("comment-list").
HOLDERS = {"area", "articles", "bar", "block", "box", "buttons", "container", "form", "inner", "item", "items", "links", "list",
           "media", "panel", "posts", "section", "slot", "stories", "unit", "wrap", "wrapper"}
#: Words that make a name say something about the page, or name another thing.
FLAGS = {"has", "no", "of", "with", "without"}
CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog"}

#: Zones of a block: inside a declared article or main element, outside one, chrome by
#: element or role, or chrome by the name of a class or id only.
MAIN, FREE, OFF, NAMED = 0, 1, 2, 3
#: Places before and after a page, in the order of URLs, whose pages are held against it.
STEPS = (-1, 1, -2, 2)
#: Neighbours that must share a marked part of an article before it counts as chrome.
WITNESSES = 2
#: Cells of the alignment table kept at once (bits).
CELLS = 1 << 25


def _names_chrome(value: str, inside: bool) -> bool:
    for token in value.split():
        parts = [x.lower() for x in _PARTS.findall(token)]
        if not FLAGS.isdisjoint(parts):
            continue
        while len(parts) > 1 and parts[-1] in HOLDERS:
            parts.pop()
        if parts and (parts[-1] in CHROME_NAMES or parts[-1] == "header" and not inside):
            return True
    return False


def _zone(tag: str, attributes: str, outer: int) -> tuple[int, str]:
    """(zone of an element, its class and id) given the zone around it."""
    found = [(name.lower(), "".join(values)) for name, *values in _ATTRIBUTE.findall(attributes)]
    mark = " ".join(f"{name}={value}" for name, value in sorted(found) if name in ("class", "id") and value)
    if outer == OFF:
        return OFF, mark
    if (tag in CHROME or tag == "header" and outer != MAIN or re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", attributes)
            or any(name == "role" and value.lower() in CHROME_ROLES or name == "aria-hidden" and value.lower() == "true"
                   for name, value in found)):
        return OFF, mark
    if outer == NAMED or tag not in ("html", "body") and any(
            name in ("class", "id") and _names_chrome(value, outer == MAIN) for name, value in found):
        return NAMED, mark
    return (MAIN if tag in CONTENT else outer), mark


def blocks(page: str | None) -> list[tuple[str, int]]:
    """(text, zone) of the non-empty blocks of a page, in page order (``marked_blocks``)."""
    return [(line, zone) for line, zone, _ in marked_blocks(page)]


def marked_blocks(page: str | None) -> list[tuple[str, int, str]]:
    """(text, zone, mark) of the non-empty blocks of a page, in page order; mark: tag,
    class and id of the nearest element around it that has a class or id, below the
    article or main element (empty: none). Block elements cut
    blocks, inline ones do not; character references are decoded; white space inside a
    block becomes one space. Unclosed elements end with the element around them, an
    unclosed comment, script or the like with the page."""
    page = page or ""
    out: list[tuple[str, int, str]] = []
    text: list[str] = []
    open_tags: list[tuple[str, int, str]] = []      # element, zone and mark outside it
    zone, mark, at = FREE, "", 0

    def flush():
        line = " ".join("".join(text).split())
        text.clear()
        if line:
            out.append((line, zone, mark))

    def add(piece: str):
        text.append(html.unescape(piece) if "&" in piece else piece)

    while m := _TAG.search(page, at):
        add(page[at:m.start()])
        at = m.end()
        close, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if tag is None:
            continue
        tag = tag.lower()
        if not close and tag in RAW:
            end = re.compile(rf"</{tag}\s*>|\Z", re.I).search(page, at)
            at = end.end()
            text.append(" ")
            continue
        if tag in INLINE:
            if tag in ("br", "td", "th"):
                text.append(" ")
            continue
        flush()
        if close:
            if any(t == tag for t, _, _ in open_tags):
                while True:
                    name, zone, mark = open_tags.pop()
                    if name == tag:
                        break
        elif tag not in VOID and not attributes.rstrip().endswith("/"):
            if tag == "p" and open_tags and open_tags[-1][0] == "p":
                _, zone, mark = open_tags.pop()
            open_tags.append((tag, zone, mark))
            zone, own = _zone(tag, attributes, zone)
            mark = "" if tag in CONTENT else f"{tag} {own}" if own else mark
    add(page[at:])
    flush()
    return out


def line_hash(line: str) -> int:
    return xxhash.xxh3_64_intdigest(line) - (1 << 63)


def _table(a: list[int], b: list[int]):
    """Rows of the alignment table of a and b, one per prefix of b: bit i of a row is 0
    where the longest common subsequence grows with a[i]."""
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    row = full = (1 << len(a)) - 1
    yield row
    for x in b:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        yield row


def _prefix_lengths(a: list[int], b: list[int]) -> list[int]:
    """Length of the longest common subsequence of b and each prefix of a."""
    for row in _table(a, b):
        pass
    sums = [0]
    for bit in format(row, f"0{len(a)}b")[::-1]:
        sums.append(sums[-1] + (bit == "0"))
    return sums


def shared_lines(a: list[int], b: list[int], offset: int = 0) -> list[int]:
    """Places in ``a`` of a longest common subsequence of the lines of ``a`` and ``b``."""
    first = 0
    while first < min(len(a), len(b)) and a[first] == b[first]:
        first += 1
    last = 0
    while last < min(len(a), len(b)) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    out = list(range(offset, offset + first))
    tail = list(range(offset + len(a) - last, offset + len(a)))
    inner = a[first:len(a) - last]
    b, both = b[first:len(b) - last], set(inner)
    at = [i for i, x in enumerate(inner) if x in set(b)]
    a, b = [inner[i] for i in at], [x for x in b if x in both]
    if not a or not b:
        return out + tail
    at = [offset + first + i for i in at]
    if len(a) * len(b) <= CELLS or min(len(a), len(b)) == 1:
        rows, i, j, found = list(_table(a, b)), len(a), len(b), []

        def length(i, j):
            return i - (rows[j] & ((1 << i) - 1)).bit_count()

        while i and j:
            if a[i - 1] == b[j - 1]:
                i, j = i - 1, j - 1
                found.append(at[i])
            elif length(i - 1, j) >= length(i, j - 1):
                i -= 1
            else:
                j -= 1
        return out + found[::-1] + tail
    # Too large a table: split b in the middle and a where both halves together are longest.
    half = len(b) // 2
    left, right = _prefix_lengths(a, b[:half]), _prefix_lengths(a[::-1], b[half:][::-1])
    cut_at = max(range(len(a) + 1), key=lambda i: left[i] + right[len(a) - i])
    found = [at[i] for i in shared_lines(a[:cut_at], b[:half])]
    return out + found + [at[cut_at + i] for i in shared_lines(a[cut_at:], b[half:])] + tail


def _lines(batches):
    """Per page: hashes of its lines; the places that differencing may delete, which are
    the marked lines of a declared article, or else all lines outside chrome elements; and
    the hash of each place's mark (0 on pages that declare no article)."""
    for b in batches:
        out = []
        for k in range(b.num_rows):
            key, host, path, page = (b.column(i)[k].as_py() for i in range(4))
            found = marked_blocks(page)
            declared = any(z == MAIN for _, z, _ in found)
            free = [(i, line_hash(m) if declared else 0) for i, (_, z, m) in enumerate(found)
                    if (z == MAIN and m if declared else z in (FREE, NAMED))]
            out.append((key, host, path, [line_hash(t) for t, _, _ in found], [i for i, _ in free], [m for _, m in free]))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 6, (
            pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())))],
            names=["key", "host", "path", "lines", "free", "marks"])


def chrome_lines(lines: list[int], free: list[int], marks: list[int], others: list[list[int]]) -> tuple[int, list[int]]:
    """(lines shared with the nearest page, places to delete) of a page, given the lines of
    its neighbours, nearest first.

    Without a declared article (mark 0): the free lines shared with the nearest page. In
    an article, a line is chrome if all lines of its mark are shared with ``WITNESSES``
    neighbours: what a template puts in has an element of its own, while a passage that
    pages quote stands among lines of the same element that they do not share. A page that
    shares all lines, or half of the unmarked lines of an article, is a mirror or a copy
    and no witness."""
    shared = shared_lines(lines, others[0])
    nearest = len(shared)
    plain = [i for i, m in zip(free, marks) if not m]
    gone = set(shared) & set(plain) if nearest < len(lines) else set()
    groups: dict[int, set[int]] = {}
    for i, m in zip(free, marks):
        if m:
            groups.setdefault(m, set()).add(i)
    seen = dict.fromkeys(groups, 0)
    for k, other in enumerate(others if groups else ()):
        same = set(shared if not k else shared_lines(lines, other))
        body = set(range(len(lines))) - {i for g in groups.values() for i in g}
        if len(same) < len(lines) and 2 * len(same & body) <= len(body):
            for m, places in groups.items():
                seen[m] += places <= same
    return nearest, sorted(gone.union(*[g for m, g in groups.items() if seen[m] >= WITNESSES]))


def _align(batches):
    for b in batches:
        out = []
        for k in range(b.num_rows):
            key, lines, free, marks, others = (b.column(i)[k].as_py() for i in range(5))
            out.append((key, *chrome_lines(lines, free, marks, others)))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 3, (
            pa.int64(), pa.int32(), pa.list_(pa.int32())))], names=["key", "n_shared", "gone"])


def _text(batches):
    for b in batches:
        out = []
        for k in range(b.num_rows):
            page_id, url, page, gone = (b.column(i)[k].as_py() for i in range(4))
            found, gone = blocks(page), set(gone or ())
            zones = {z for _, z in found}
            # Names of classes alone never empty a page.
            zone = MAIN if MAIN in zones else FREE if FREE in zones else NAMED
            text = "\n".join(t for i, (t, z) in enumerate(found) if z == zone and i not in gone)
            out.append((page_id, url, text, len(text)))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 4, (
            pa.int64(), pa.string(), pa.string(), pa.int64()))], names=["page_id", "url", "text", "n_chars"])


def differences(pages: DataFrame) -> DataFrame:
    """(key, n_shared, gone) of the pages (key, host, path, html) that have a neighbour:
    the number of lines they share with the page of the nearest URL on the same host, and
    which lines that deletes (``chrome_lines``).

    Pages are range-sorted by (host, path, key), which splits a hot host over partitions,
    and ranked through partition counts; the nearest is the one before or after with the
    longer common path start (ties: before), then come the others of ``STEPS``, which only
    pages with marked lines meet. Ranks are unique, so the joins have no hot key, and only
    line hashes move, not pages."""
    lines = cut(pages.mapInArrow(_lines, "key long, host string, path string, lines array<long>, free array<int>, marks array<long>")
                .dropDuplicates(["key"]))
    placed = cut(lines.repartitionByRange("host", "path", "key").sortWithinPartitions("host", "path", "key"))
    placed = placed.withColumn("part", F.spark_partition_id()).withColumn("low", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    sizes = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}
    starts, total = [], 0
    for k in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(k, 0)
    if not total:
        return pages.sparkSession.createDataFrame([], "key long, n_shared int, gone array<int>")
    ranked = cut(placed.select((F.element_at(F.array(*[F.lit(s).cast("long") for s in starts]), F.col("part") + 1) + F.col("low"))
                               .alias("rank"), "key", "host", "path", "lines", "free", "marks"))
    # At most len(STEPS) short rows meet at a rank: each page is sent to the places around it.
    asks = ranked.select("rank", "key", "host", "path", "lines", "free", "marks",
                         F.exists("marks", lambda m: m != 0).alias("marked"))
    sent = ranked.select("host", "path", "lines", F.explode(F.array(*[F.struct(
        (F.col("rank") - s).alias("rank"), F.lit(k).alias("step")) for k, s in enumerate(STEPS)])).alias("to"))
    sent = sent.select(F.col("to.rank").alias("at"), F.col("to.step").alias("step"), F.col("host").alias("its_host"),
                       F.col("path").alias("its_path"), F.col("lines").alias("its_lines"))
    met = asks.join(sent, (F.col("rank") == F.col("at")) & (F.col("host") == F.col("its_host")) & ((F.col("step") < 2) | F.col("marked")))
    near = F.struct((F.col("step") > 1).alias("far"), (-_common_start(F.col("path"), F.col("its_path"))).alias("n"), "step",
                    F.col("its_lines").alias("lines"))
    # Grouped on the keys of the join, so rows do not move again; a rank has one page.
    chosen = (met.groupBy("rank", "host").agg(*[F.first(c).alias(c) for c in ("key", "lines", "free", "marks")],
                                              F.sort_array(F.collect_list(near)).alias("others"))
              .select("key", "lines", "free", "marks", F.transform("others", lambda o: o["lines"]).alias("others")))
    return chosen.mapInArrow(_align, "key long, n_shared int, gone array<int>")


def _common_start(a, b):
    """Length of the common start of two strings."""
    n = F.least(F.length(a), F.length(b))
    differing = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: (i <= n) & (F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1))))
    return F.coalesce(F.try_element_at(differing, F.lit(1)) - 1, n)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``: the main text.

    A page is parsed into blocks (``blocks``). It is paired with the page of the nearest
    URL on its host, the text lines of both are aligned by longest common subsequence, and
    shared lines are deleted (``differences``). Inside a declared article or main element
    this needs two neighbours and an element of its own (``chrome_lines``), since texts
    that pages quote alike are not chrome. Menus, forms, adverts and the like that declare
    themselves by element, role, or the last word of a class or id go on every page, for
    they often differ from page to page; a page that has nothing else keeps what only a
    class or id names. What is left is joined by line feeds.

    Null and empty html: empty text. Null or odd url: no host, paired among themselves.
    Null page_id: returned as is. Repeated rows: each is returned, differenced once. A
    page that shares all its lines with its neighbour is its mirror and keeps them. Empty
    table: empty result. Other columns are not read."""
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.col(f"`{html_col}`").cast("string").alias("html"))
    parts = F.lower(F.coalesce("url", F.lit("")))
    keyed = rows.withColumn("key", F.xxhash64("page_id", "url", "html"))
    changes = cut(differences(keyed.select(
        "key", F.regexp_extract(parts, r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1).alias("host"),
        F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1).alias("path"), "html")))
    deletions = changes.where(F.size("gone") > 0).select(F.col("key").alias("of"), "gone")
    return (keyed.join(bounded_broadcast(deletions), F.col("key") == F.col("of"), "left").select("page_id", "url", "html", "gone")
            .mapInArrow(_text, "page_id long, url string, text string, n_chars long"))
