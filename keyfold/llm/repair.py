"""Repair of conversation structure by least-cost edits, with Four-Russians block tables.

A repaired conversation's role initials read ``(s?(ua)+)?``. The cheapest edits come from a
dynamic program over the turns, whose column of costs (one per state of that pattern) is kept
normalised: its least entry is 0. Few such vectors exist, so what a block of ``BLOCK`` turns
does to each of them is tabled once, and a conversation is processed block by block.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import crc_sql, cut, map_rows, rows_of

#: Costs of the edits (keep costs nothing).
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
ILLEGAL_FREE = ("su", "ua", "au")
WHITE = " \t\n\x0b\x0c\r"
#: Turns per tabled block.
BLOCK = 4
# States: nothing yet, after s, after u, after a. Insert and Rerole go to the state's only
# non-system successor, so a state and an edit's initial fix the role written.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ONWARD = (USER, USER, ASSISTANT, USER)
WRITES = ("user", "user", "assistant", "user")
KEEPS = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "": {}}
#: Symbols: 0 must go; else 1 + 2 * initial (s, u, a, any other) + truncated.
INITIALS = ("s", "u", "a", "")
SYMBOLS = 1 + 2 * len(INITIALS)
#: Costs and edits after the last turn: an open s takes two inserts, an open u one.
AT_END = (0, 2 * INSERT, INSERT, 0)
ENDING = ("", "II", "I", "")


def _choices(after: tuple, symbol: int, state: int) -> list[tuple[int, str, int]]:
    """(cost to the end, edit initial, next state) of the edits that use up a turn."""
    found = [(DELETE + after[state], "D", state)]
    if symbol:
        initial, fault = INITIALS[(symbol - 1) // 2], TRUNCATED * ((symbol - 1) % 2)
        if state in KEEPS[initial]:
            found.append((fault + after[KEEPS[initial][state]], "K", KEEPS[initial][state]))
        found.append((REROLE + fault + after[ONWARD[state]], "R", ONWARD[state]))
    return found


def _before(after: tuple, symbol: int) -> tuple:
    """Costs to the end before a turn from those after it; at most two inserts precede it."""
    own = [min(c[0] for c in _choices(after, symbol, s)) for s in range(4)]
    once = [min(own[s], INSERT + own[ONWARD[s]]) for s in range(4)]
    return tuple(min(own[s], INSERT + once[ONWARD[s]]) for s in range(4))


class Tables:
    """The normalised cost vectors, and per vector (after) and symbol or block of symbols:
    the vector before it and the amount taken off; per vector, symbol and state: the edits
    up to and including the turn and the next state, least in ASCII among the cheapest."""

    def __init__(self, block: int = BLOCK):
        ids, self.vectors, rows = {AT_END: 0}, [AT_END], []
        for v in self.vectors:                      # grows until no new vector appears
            row = []
            for symbol in range(SYMBOLS):
                costs = _before(v, symbol)
                low = min(costs)
                norm = tuple(c - low for c in costs)
                if norm not in ids:
                    ids[norm] = len(self.vectors)
                    self.vectors.append(norm)
                row.append((ids[norm], low))
            rows.append(row)
        step = np.array(rows, np.int32)
        self.one, self.one_off = step[:, :, 0], step[:, :, 1]
        self.block, self.weights = block, SYMBOLS ** np.arange(block - 1, -1, -1)
        to = np.arange(len(self.vectors))[:, None] + np.zeros(1, np.int64)
        off = np.zeros_like(to)
        for k in range(block):                      # the block's last symbol acts first
            lead = np.repeat(np.arange(SYMBOLS), SYMBOLS ** k)
            to, off = np.tile(to, SYMBOLS), np.tile(off, SYMBOLS)
            off = off + self.one_off[to, lead]
            to = self.one[to, lead]
        self.many, self.many_off = to.tolist(), off.tolist()
        self.one, self.one_off = self.one.tolist(), self.one_off.tolist()
        self.edits = [[[self._edit(v, symbol, s) for s in range(4)] for symbol in range(SYMBOLS)] for v in self.vectors]

    def _edit(self, after: tuple, symbol: int, state: int) -> tuple[str, int]:
        costs, done = _before(after, symbol), ""
        while True:
            ways = [(c, e, s) for c, e, s in _choices(after, symbol, state) if c == costs[state]]
            if costs[state] == INSERT + costs[ONWARD[state]]:
                ways.append((costs[state], "I", ONWARD[state]))
            _, edit, state = min(ways, key=lambda w: w[1])
            done += edit
            if edit != "I":
                return done, state

    def repair(self, symbols: bytes) -> tuple[int, str]:
        """Least cost and its ASCII-least edits. Blocks are looked up from the end to the
        start, keeping the vector at each block's end; then the blocks are expanded turn by
        turn, backward for the vectors and forward for the edits."""
        n, size = len(symbols), self.block
        whole = n // size
        codes = (np.frombuffer(symbols, np.uint8)[:whole * size].reshape(whole, size) @ self.weights).tolist()
        v, total = 0, 0
        for k in range(n - 1, whole * size - 1, -1):
            total += self.one_off[v][symbols[k]]
            v = self.one[v][symbols[k]]
        ends = [0] * whole
        for b in range(whole - 1, -1, -1):
            ends[b] = v
            total += self.many_off[v][codes[b]]
            v = self.many[v][codes[b]]
        total += self.vectors[v][NOTHING]
        out, state = [], NOTHING
        for b in range(whole + 1):
            part = symbols[b * size:(b + 1) * size]
            after = [ends[b] if b < whole else 0]
            for symbol in reversed(part[1:]):
                after.append(self.one[after[-1]][symbol])
            for symbol, v in zip(part, reversed(after)):
                edit, state = self.edits[v][symbol][state]
                out.append(edit)
        return total, "".join(out) + ENDING[state]


@lru_cache(1)
def tables() -> Tables:
    return Tables()


def _spaced(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def damage(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone) of ``turns`` (conv_id, turn, role, text) with test
    faults by crc32(conv_id:turn) modulo 20: 0 marks the row as gone, 1 empties the text, 2
    takes its sentence ends, 3 repeats the row, 4 makes the role user. Nulls are one space."""
    fault = F.pmod(F.crc32(F.concat(_spaced(F.col("conv_id")), F.lit(":"), _spaced(F.col("turn"))).cast("binary")), F.lit(20))
    text = _spaced(F.col("text"))
    return turns.select("conv_id", "turn", "role", "text", fault.alias("fault")).select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(_spaced(F.col("role"))).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (F.col("fault") == 0).alias("gone"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def _in_order(df: DataFrame, *first: str) -> DataFrame:
    """Each conversation's rows together, by turn (nulls first); ties by role, then digest."""
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *first, "turn", "role", "digest")


def _audit_rows(kind: str):
    """mapInArrow function over rows in order: one audit row per conversation."""
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]

    def run(batches):
        table = tables()
        conv, seen, symbols, turns, last, counts = (), set(), bytearray(), None, None, [0, 0, 0, 0]

        def close():
            cost, audit = table.repair(bytes(symbols))
            gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
            return (conv[0], gaps, *counts, cost, audit)

        def pack(rows):
            types = [schema_type, *[pa.int64()] * 6, pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        out, schema_type = [], pa.int64()
        for b in batches:
            schema_type = b.column(0).type
            for c, gone, turn, initial, key, blank, cut_off in zip(*[b.column(i).to_pylist() for i in range(7)]):
                if conv != (c,):
                    if conv:
                        out.append(close())
                    conv, seen, symbols, turns, last, counts = (c,), set(), bytearray(), None, None, [0, 0, 0, 0]
                if gone:
                    continue
                if turn is not None:
                    turns = (turn, turn, 1) if turns is None else (turns[0], turn, turns[2] + (turn != turns[1]))
                if last is not None and last + initial not in ILLEGAL_FREE:
                    counts[3] += 1
                last = initial
                double = key in seen
                seen.add(key)
                if blank or double:
                    counts[0 if blank else 1] += 1
                    symbols.append(0)
                else:
                    counts[2] += cut_off
                    symbols.append(1 + 2 * (INITIALS.index(initial) if initial in INITIALS[:3] and initial else 3) + cut_off)
                if len(out) >= 1024:
                    yield pack(out)
                    out = []
        if conv:
            out.append(close())
        if out:
            yield pack(out)

    return run, f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _written():
    """Row function over a conversation's audit followed by its rows in order: gives the
    repaired (role, text) one at a time. State is an audit and a place in it, so texts pass
    through one by one."""
    audit, at, state = "", 0, NOTHING

    def start(text):
        nonlocal audit, at, state
        audit, at, state = text, 0, NOTHING

    def inserts():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            yield WRITES[state], ""
            state, at = ONWARD[state], at + 1

    def turn(role, text):
        nonlocal at, state
        yield from inserts()
        edit, at = audit[at], at + 1
        if edit == "K":
            state = KEEPS[role[:1]][state]
            yield role, text
        elif edit == "R":
            role, state = WRITES[state], ONWARD[state]
            yield role, text

    return start, turn, inserts


def _hashes():
    """mapInArrow function: (conv_id, sha) of each conversation's repaired lines, hashed as they pass."""
    def run(batches):
        start, turn, rest = _written()
        conv, sha, lines, out, kind = (), None, 0, [], pa.int64()

        def add(found):
            nonlocal lines
            for role, text in found:
                sha.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                lines += 1

        def pack(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.string())],
                                              names=["conv_id", "sha"])

        for b in batches:
            kind = b.column(0).type
            for c, audit, role, text in rows_of(b):
                if audit is not None:
                    if conv:
                        add(rest())
                        out.append((conv[0], sha.hexdigest()))
                    conv, sha, lines = (c,), hashlib.sha256(), 0
                    start(audit)
                else:
                    add(turn(role, text))
                if len(out) >= 1024:
                    yield pack(out)
                    out = []
        if conv:
            add(rest())
            out.append((conv[0], sha.hexdigest()))
        if out:
            yield pack(out)

    return run


def _prepared(turns: DataFrame, gone_col: str | None) -> DataFrame:
    text = _spaced(F.col("text"))
    role = _spaced(F.col("role"))
    return turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                        (F.col(gone_col) if gone_col else F.lit(False)).alias("gone"),
                        F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
                                                   .cast("binary"), 256), 1, 32)).alias("digest"))


def audits(turns: DataFrame, gone_col: str | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conv_id of
    ``turns`` (conv_id, turn, role, text). A row marked by ``gone_col`` only names its
    conversation.

    Rows are taken by turn, nulls first; rows of one turn by role, then by digest. A row's
    first fault counts: blank, duplicate (role and text seen earlier), truncated (the last
    character that is not white space ends no sentence). ``audit`` has the initials of the
    cheapest edits in order (Keep, Rerole, Delete, Insert), ASCII-least among equals.

    Only flags and digests are shuffled. A task holds one conversation's digests and one
    byte a turn. Null conv_id: a conversation of its own. Null role or text: one space. Empty
    table: empty result. Other columns are not read."""
    rows = _prepared(turns, gone_col)
    stripped = F.rtrim(F.col("text"), F.lit(WHITE))
    flagged = rows.select(
        "conv_id", "gone", "turn", F.substring("role", 1, 1).alias("initial"), "digest", (stripped == "").alias("blank"),
        (~F.substring(stripped, -1, 1).isin(".", "!", "?")).alias("cut_off"), "role")
    run, schema = _audit_rows(dict(turns.dtypes)["conv_id"])
    return _in_order(flagged).drop("role").mapInArrow(run, schema)


def _heads(audit: DataFrame) -> DataFrame:
    """A row per conversation that goes ahead of its turns."""
    nothing = F.lit(None)
    return audit.select("conv_id", "audit", nothing.cast("long").alias("turn"), F.lit("").alias("role"),
                        nothing.cast("binary").alias("digest"), nothing.cast("string").alias("text"))


def _lines(turns: DataFrame, gone_col: str | None) -> DataFrame:
    return _prepared(turns, gone_col).where("NOT gone").select(
        "conv_id", F.lit(None).cast("string").alias("audit"), "turn", "role", "digest", "text")


def repair(turns: DataFrame, gone_col: str | None = None) -> DataFrame:
    """``audits`` with repaired_sha256: SHA-256 of the repaired conversation's ``role:text``
    lines joined by newlines (none: of the empty string). The audit travels ahead of its
    conversation's rows, so their texts pass through a task one at a time."""
    audit = cut(audits(turns, gone_col))
    both = _heads(audit).unionByName(_lines(turns, gone_col))
    together = _in_order(both.withColumn("later", F.col("audit").isNull()), "later")
    kind = dict(turns.dtypes)["conv_id"]
    sha = (together.select("conv_id", "audit", "role", "text").mapInArrow(_hashes(), f"conv_id {kind}, sha string")
           .withColumnRenamed("conv_id", "of"))
    return (audit.join(sha, F.col("conv_id").eqNullSafe(F.col("of")))
            .select(*audit.columns, F.col("sha").alias("repaired_sha256")))


def repaired(turns: DataFrame, gone_col: str | None = None) -> DataFrame:
    """The repaired turns: (conv_id, line, role, text), line from 0; conversations repaired
    to nothing have no rows. Inserted turns have empty texts."""
    heads = _heads(cut(audits(turns, gone_col)))
    kind = dict(turns.dtypes)["conv_id"]
    # a closing row asks for the inserts behind the last turn
    tails = heads.withColumns({c: F.lit(None).cast("string") for c in ("audit", "role")})
    place = F.when(F.col("audit").isNotNull(), 0).when(F.col("role").isNotNull(), 1).otherwise(2)
    together = _in_order(heads.unionByName(_lines(turns, gone_col)).unionByName(tails).withColumn("place", place), "place")

    def make():
        start, turn, rest = _written()
        line = 0

        def rows(row):
            nonlocal line
            conv, audit, role, text = row
            if audit is not None:
                start(audit)
                line = 0
                return []
            out = []
            for name, body in (rest() if role is None else turn(role, text)):
                out.append((conv, line, name, body))
                line += 1
            return out

        return rows

    return map_rows(together.select("conv_id", "audit", "role", "text"), make, f"conv_id {kind}, line long, role string, text string")


def _sql() -> str:
    """The same rows for the damaged table in DuckDB: a recursive query goes through the
    conversations from their last turns to the first. A state's entry is one text, least for
    the best repair: cost in 8 digits, edits, a separator, the repaired lines."""
    states = range(4)

    def entry(cost: str, letter: str, after: str, line: str | None) -> str:
        body = f"split_part({after}, chr(1), 1)[9:]"
        tail = f"substr({after}, strpos({after}, chr(1)))"
        written = tail if line is None else f"chr(1) || {line} || chr(10) || {tail}[2:]"
        return f"lpad((({after})[1:8]::INT + {cost})::VARCHAR, 8, '0') || '{letter}' || {body} || {written}"

    def own(s: int) -> str:
        ways = [entry("3", "D", f"g{s}", None)]
        kept = " ".join(f"WHEN '{i}' THEN {entry('cut_off', 'K', f'g{KEEPS[i][s]}', 'line')}" for i in "sua" if s in KEEPS[i])
        ways.append(f"CASE WHEN NOT must_go THEN {entry('2 + cut_off', 'R', f'g{ONWARD[s]}', f"'{WRITES[s]}:' || text")} END")
        ways.append(f"CASE WHEN NOT must_go THEN CASE initial {kept} END END")
        return f"least({', '.join(ways)})"

    def insert(s: int, source: str) -> str:
        return entry("2", "I", f"{source}{ONWARD[s]}", f"'{WRITES[s]}:'")

    white = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    finish = ["'00000000' || chr(1)", "'00000004II' || chr(1) || 'user:' || chr(10) || 'assistant:' || chr(10)",
              "'00000002I' || chr(1) || 'assistant:' || chr(10)", "'00000000' || chr(1)"]
    return f"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS id FROM conversations),
hit AS (SELECT *, {crc_sql("id")} % 20 AS fault FROM given),
damaged AS (
  SELECT coalesce(conv_id::VARCHAR, 'null') AS conv, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hit JOIN (VALUES (1), (2)) AS copies(copy) ON copy = 1 OR fault = 3 WHERE fault <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(strlen(role) || ':' || role || text)) AS pos,
                  rtrim(text, {white}) AS bare, role[1:1] AS initial FROM damaged),
judged AS (
  SELECT *, bare = '' AS blank, row_number() OVER (PARTITION BY conv, role, text ORDER BY pos) > 1 AS seen,
         lag(initial) OVER (PARTITION BY conv ORDER BY pos) AS initial_before FROM placed),
marked AS (
  SELECT *, (blank OR seen) AS must_go, (NOT blank AND seen) AS double,
         (NOT blank AND NOT seen AND bare[-1:] NOT IN ('.', '!', '?'))::INT AS cut_off, role || ':' || text AS line FROM judged),
report AS (
  SELECT conv, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(blank::INT) AS blank,
         sum(double::INT) AS duplicate, sum(cut_off) AS truncated,
         sum((initial_before || initial NOT IN ('su', 'ua', 'au'))::INT) AS illegal FROM marked GROUP BY conv),
step AS (
  SELECT conv, n AS pos, {', '.join(f"{finish[s]} AS g{s}" for s in states)} FROM report
  UNION ALL
  SELECT conv, pos, {', '.join(f"least(h{s}, {insert(s, 'i')}) AS g{s}" for s in states)} FROM (
    SELECT conv, pos, {', '.join(f"h{s}" for s in states)}, {', '.join(f"least(h{s}, {insert(s, 'h')}) AS i{s}" for s in states)} FROM (
      SELECT step.conv, step.pos - 1 AS pos, {', '.join(f"{own(s)} AS h{s}" for s in states)}
      FROM step JOIN marked ON marked.conv = step.conv AND marked.pos = step.pos))),
best AS (SELECT conv, g0 FROM step WHERE pos = 0)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(g0[1:8]::BIGINT, 0) AS cost,
       coalesce(split_part(g0, chr(1), 1)[9:], '') AS audit,
       sha256(coalesce(substr(g0, strpos(g0, chr(1)) + 1, greatest(0, length(g0) - strpos(g0, chr(1)) - 1)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(conv_id::VARCHAR, 'null') AS conv FROM conversations)
LEFT JOIN report USING (conv) LEFT JOIN best USING (conv)
"""


SQL = _sql()
