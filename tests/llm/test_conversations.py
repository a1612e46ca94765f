"""Conversation repair and the prefix trie against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from keyfold.llm import repair, trie

TURNS = "conv_id long, turn long, role string, text string, fault int, gone boolean, key string, n_convs int"
WHITE = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def turns(spark):
    """Nulls in every column, blank and long texts, ties, repeated rows, copies of whole
    conversations, an id that is negative, and columns whose names clash with results."""
    pick, rows = random.Random(3), []
    for c in [*range(60), -7, None]:
        for t in range(pick.choice([1, 2, 3, 5, 9, 14, 40])):
            role = pick.choice(["user", "assistant", "user", "assistant", "system", "tool", "User", "", None])
            text = pick.choice(["Yes.", "no", "So it is!", "why? \n", "", " \t", None, "ä€𝄞.", "Yes.\n\n", f"line {t}."])
            rows.append((c, pick.choice([t, t, t, t + 2, None]), role, text))
    for c in range(100, 130):                                           # copies with one first turn
        rows += [(c, 0, "system", "Be kind."), (c, 1, "user", "Hi."), (c, 2, "assistant", "Hello."), (c, 3, "user", f"{c % 3}.")]
    rows += [(200, t, "user" if t % 2 else "assistant", f"turn {t}") for t in range(300)] + [(201, 0, "user", "x " * 50_000 + ".")]
    rows += [(202, 5, "user", "Same."), (202, 5, "user", "Same."), (203, None, None, None)]
    return spark.createDataFrame([(*r, 1, True, "k", 2) for r in rows], TURNS).repartition(5)


def in_order(rows):
    def place(row):
        turn, role, text = row
        known = f"{len(role.encode())}:{role}{text}".encode()
        return turn is not None, turn or 0, role.encode(), hashlib.sha256(known).digest()[:16]
    return sorted(rows, key=place)


def ordered(turns, empty):
    """conv_id -> its (turn, role, text) by turn, nulls first, ties by role then digest."""
    found = defaultdict(list)
    for r in turns.collect():
        role, text = (empty if x is None else x for x in (r["role"], r["text"]))
        found[r["conv_id"]].append((r["turn"], role, text))

    return {c: in_order(v) for c, v in found.items()}


def damaged(turns):
    out = {}
    for c, rows in ordered(turns, " ").items():
        out[c] = []
        for turn, role, text in rows:
            f = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if f:
                text = "" if f == 1 else "".join(x for x in text if x not in ".!?") if f == 2 else text
                out[c] += [(turn, "user" if f == 4 else role, text)] * (2 if f == 3 else 1)
    return {c: in_order(rows) for c, rows in out.items()}


def cheapest(rows):
    """Least (cost, edits), and the lines, over every way to edit: ``after`` holds the least
    for the rows still to come per state, from the end on; inserts settle until none improves."""
    go = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    tail = {"": (0, "", ()), "a": (0, "", ())}

    def settle(own):
        for _ in range(8):
            for state in ("", "s", "u", "a"):
                for role in ("user", "assistant"):
                    nxt = go[state].get(role[0])
                    if nxt in own:
                        cost, edits, lines = own[nxt]
                        new = (cost + 2, "I" + edits, (f"{role}:",) + lines)
                        if state not in own or new[:2] < own[state][:2]:
                            own[state] = new
        return own

    after = settle(dict(tail))
    for role, text, must_go, cut_off in reversed(rows):
        own = {}
        for state in ("", "s", "u", "a"):
            ways = []
            cost, edits, lines = after[state]
            ways.append((cost + 3, "D" + edits, lines))
            if not must_go:
                nxt = go[state].get(role[:1])
                if nxt:
                    cost, edits, lines = after[nxt]
                    ways.append((cost + cut_off, "K" + edits, (f"{role}:{text}",) + lines))
                for new in ("user", "assistant"):
                    nxt = go[state].get(new[0])
                    if nxt:
                        cost, edits, lines = after[nxt]
                        ways.append((cost + 2 + cut_off, "R" + edits, (f"{new}:{text}",) + lines))
            own[state] = min(ways, key=lambda w: w[:2])
        after = settle(own)
    return after[""]


def judged(rows):
    seen, out, n = set(), [], [0, 0, 0]
    for _, role, text in rows:
        blank, double = not text.strip(WHITE), (role, text) in seen
        cut_off = not blank and not double and text.rstrip(WHITE)[-1] not in ".!?"
        seen.add((role, text))
        n[0] += blank
        n[1] += double and not blank
        n[2] += cut_off
        out.append((role, text, blank or double, int(cut_off)))
    return out, n


def test_repair_equals_brute_force(turns):
    got = {r["conv_id"]: r for r in repair.repair(repair.damage(turns), gone_col="gone").collect()}
    want = damaged(turns)
    assert set(got) == set(want) and None in got
    for c, rows in want.items():
        marked, n = judged(rows)
        cost, edits, lines = cheapest(marked)
        known = [t for t, _, _ in rows if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        assert tuple(got[c])[1:] == (gaps, *n, illegal, cost, edits, sha), c


def test_repaired_turns(turns):
    damage = repair.damage(turns)
    found = defaultdict(list)
    for r in sorted(repair.repaired(damage, gone_col="gone").collect(), key=lambda r: r["line"]):
        found[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    for r in repair.repair(damage, gone_col="gone").collect():
        assert hashlib.sha256("\n".join(found[r["conv_id"]]).encode()).hexdigest() == r["repaired_sha256"]
        initials = "".join(x[0] for x in found[r["conv_id"]])
        assert initials.removeprefix("s") in ("ua" * (len(initials) // 2), "") and initials != "s"


@pytest.mark.parametrize("block", [1, 2, 3, 5])
def test_block_length_does_not_matter(block):
    tables, other, pick = repair.tables(), repair.Tables(block), random.Random(block)
    assert len(tables.vectors) < 200
    for n in [0, 1, 2, 3, 4, 5, 7, 8, 9, 64, 1001]:
        symbols = bytes(pick.randrange(repair.SYMBOLS) for _ in range(n))
        assert tables.repair(symbols) == other.repair(symbols)


def brute_trie(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = own + sum(saved[k] for k in kids[p])
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(kids[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


def rows_of(df):
    return sorted(tuple(-1 if x is None else x for x in r) for r in df.collect())


def plain_sequences(turns):
    return {c: tuple(r[1:] for r in rows) for c, rows in ordered(turns, "").items() if c is not None}


@pytest.mark.parametrize("run_size", [1, 7, trie.RUN])
def test_trie_equals_brute_force(turns, run_size):
    own = plain_sequences(turns)
    grafted = {}
    for c, seq in own.items():
        h, base = zlib.crc32(str(c).encode()) % 9, c - (abs(c) % 5) * (1 if c >= 0 else -1)
        grafted[c] = own.get(base, ())[:h] + seq[h:]
    assert any(not seq for seq in grafted.values())                     # one without turns
    assert rows_of(trie.trie(trie.grafted(turns), run_size)) == brute_trie(grafted)
    assert rows_of(trie.trie(trie.plain(turns.where("conv_id < 130")), run_size)) == brute_trie(
        {c: s for c, s in own.items() if c < 130})


def test_copies_over_many_partitions(spark):
    """A third of all conversations are copies; some extend them."""
    rows = [(c, t, "user", "a long first turn." if t == 0 else f"t{t}") for c in range(300) for t in range(3)]
    rows += [(c, t, "user", "a long first turn." if t == 0 else f"t{t}") for c in range(300, 600) for t in range(3 + c % 4)]
    rows += [(c, 0, "user", f"{c % 290}") for c in range(600, 900)]
    convs = defaultdict(tuple)
    for c, _, r, x in rows:
        convs[c] += ((r, x),)
    keys = trie.plain(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    old = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert rows_of(trie.trie(keys, 40)) == brute_trie(convs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old[1])


def test_node_layouts_grow():
    """Byte by byte fan-out through all four layouts, keys that end inside others' paths."""
    tree, layouts = trie.Tree(), set()
    for b in range(256):
        tree.add(bytes([b * 7 % 256]) + b"\0" * 15, b, [1])
        kids = tree.root.kids
        layouts.add((type(kids).__name__, getattr(kids, "room", 0)))
        assert [x for x, _ in kids.items()] == sorted(k * 7 % 256 for k in range(b + 1))
    assert layouts == {("Sorted", 4), ("Sorted", 16), ("Indexed", 0), ("Direct", 0)}
    tree.add(b"\0" * 48, 900, [1, 2, 3])
    tree.add(b"\0" * 32, 901, [1, 2])
    tree.add(b"\0" * 31 + b"\1", 902, [1, 4])
    rows = list(tree.turns())
    assert len(rows) == 1 + 256 + 3
    assert sorted(r[6] for r in rows if r[2] > 1) == [[900], [901], [902]]


def test_empty_tables(spark):
    none = spark.createDataFrame([], TURNS)
    assert repair.repair(repair.damage(none), gone_col="gone").count() == 0
    assert repair.repaired(none).count() == 0
    assert trie.trie(trie.grafted(none)).count() == 0
    assert trie.trie(trie.plain(none.union(spark.createDataFrame([(None, 1, "user", "x", 1, True, "k", 2)], TURNS)))).count() == 0


def test_tables_without_a_row_left(spark):
    """Every row dropped by the damage: the conversations stay, with zeros."""
    ids = [(c, t, "user", "Hi.") for c in range(200) for t in [0] if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    got = repair.repair(repair.damage(spark.createDataFrame(ids, "conv_id long, turn long, role string, text string")), gone_col="gone")
    empty = hashlib.sha256(b"").hexdigest()
    assert ids and {tuple(r)[1:] for r in got.collect()} == {(0, 0, 0, 0, 0, 0, "", empty)}
    assert got.count() == got.select(F.countDistinct("conv_id")).first()[0] == len(ids)
