"""Conversation structure repair with Four-Russians block tables.

A conversation's rows, in order, are kept, reroled, deleted, or get empty turns
put between them, at the least cost after which the initials of its roles are
``(s?(ua)+)?``. The cheapest way on from a row depends only on the state before
it (nothing yet, after s, after u, after a), so a row turns a vector of four costs
into another. Less their least, such vectors are few; the Four-Russians method
numbers them, puts the change by every block of ``BLOCK`` row symbols into a
table, and goes through a conversation a block a step, from its end to its
start. Ways of one cost are told apart by their edits' letters, read from the
start: each block is expanded backward again, row by row, and the least letter
that keeps the cost is taken.

Rows are dealt by ranges of their order. A conversation that lies within a range
is repaired on the spot. One that meets the edge of a range, or is too long to
be held, goes piece by piece: a piece gives the change of every vector at once,
the pieces' changes are run through from the last to the first, every piece is
traced for each state it may start in, the states are run through from first to
last, and each piece writes its part of the text. So no task holds a whole
conversation, and only one small row a piece, and the digest of a conversation's
text, which is one chain by its definition, go through one task in order.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import arrow_map, stage

# Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Row symbols of a block of the tables.
BLOCK = 4
#: A conversation of more rows or characters goes piece by piece.
HELD_ROWS, HELD_CHARS = 4096, 1 << 22
#: Rows of a piece at most, as a power of 2.
PIECE_BITS = 12
#: Characters of a written part of a text.
CHUNK = 1 << 16

BLANKS = " \t\n\x0b\f\r"
ENDS = ".!?"
#: State after each state's next valid role: 0 nothing yet, 1 after s, 2 after u, 3 after a.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: Role an inserted or reroled turn takes after each state, and the state then.
GIVEN = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
#: Roles put at the end after each state.
TAIL = {0: [], 1: ["user", "assistant"], 2: ["assistant"], 3: []}
INITIALS = "sua"
LEGAL = {"su", "ua", "au"}
#: Symbols: initial (s, u, a, other) + 4 if truncated; a row that must go.
DEAD = 8
SYMBOLS = 9


def symbol(initial: str, truncated: bool) -> int:
    at = INITIALS.find(initial) if initial else -1
    return (at if at >= 0 else 3) + 4 * truncated


def choices(state: int, sym: int) -> list[tuple]:
    """(letter, cost, next state) of the edits that use up a row."""
    out = [("D", DELETE, state)]
    if sym != DEAD:
        more, initial = TRUNCATED * (sym >= 4), "sua-"[sym % 4]
        if (state, initial) in NEXT:
            out.append(("K", more, NEXT[state, initial]))
        out.append(("R", REROLE + more, GIVEN[state][1]))
    return out


def _with_inserts(costs: list[int]) -> tuple:
    for _ in range(3):
        costs = [min(c, INSERT + costs[GIVEN[q][1]]) for q, c in enumerate(costs)]
    return tuple(costs)


class Tables:
    """Numbered vectors (``vectors``; the first is that of the end), the change of
    each by a row (``step``, ``cost``) and by each block (``block_step``, ``block_cost``;
    a block is a number with the first row's symbol as its highest digit, base 9), and
    the edits at a row (``edits``: by vector behind it, symbol and state, the letters up
    to the one that uses the row up, and the next state)."""

    def __init__(self, block: int = BLOCK):
        end = _with_inserts([0, 10 ** 6, 10 ** 6, 0])
        self.block, self.vectors, number = block, [end], {end: 0}
        step, cost, self.edits = [], [], []
        for v in self.vectors:   # grows as new vectors are met
            rows = [self._back(v, s) for s in range(SYMBOLS)]
            step.append([])
            cost.append([min(r) for r in rows])
            for r in rows:
                small = tuple(x - min(r) for x in r)
                if small not in number:
                    number[small] = len(self.vectors)
                    self.vectors.append(small)
                step[-1].append(number[small])
            self.edits.append([[self._edit(v, r, s, q) for q in range(4)] for s, r in enumerate(rows)])
        self.step, self.cost = np.array(step), np.array(cost, np.int64)
        self.block_step = np.arange(len(self.vectors))[:, None]
        self.block_cost = np.zeros((len(self.vectors), 1), np.int64)
        for _ in range(block):   # one more row before those of the table so far
            self.block_cost = (self.block_cost[:, None, :] + self.cost[self.block_step].transpose(0, 2, 1)).reshape(
                len(self.vectors), -1)
            self.block_step = self.step[self.block_step].transpose(0, 2, 1).reshape(len(self.vectors), -1)

    @staticmethod
    def _back(v: tuple, s: int) -> tuple:
        return _with_inserts([min(c + v[q2] for _, c, q2 in choices(q, s)) for q in range(4)])

    @staticmethod
    def _edit(v: tuple, before: tuple, s: int, q: int) -> tuple:
        letters = ""
        while True:
            options = [(x, q2) for x, c, q2 in choices(q, s) if c + v[q2] == before[q]]
            if INSERT + before[GIVEN[q][1]] == before[q]:
                options.append(("I", GIVEN[q][1]))
            letter, q = min(options)
            letters += letter
            if letter != "I":
                return letters, q

    def blocks(self, symbols: bytes) -> tuple[int, list[int]]:
        """The number of rows before the first whole block, and the blocks' numbers in order."""
        head = len(symbols) % self.block
        x = np.frombuffer(symbols, np.uint8)[head:].reshape(-1, self.block).astype(np.int64)
        return head, (x @ (SYMBOLS ** np.arange(self.block)[::-1])).tolist()

    def change(self, symbols: bytes) -> tuple[np.ndarray, np.ndarray]:
        """For every vector behind ``symbols``, the one before them and the cost added."""
        at = np.arange(len(self.vectors))
        cost = np.zeros(len(at), np.int64)
        head, blocks = self.blocks(symbols)
        for b in reversed(blocks):
            cost += self.block_cost[at, b]
            at = self.block_step[at, b]
        for s in reversed(symbols[:head]):
            cost += self.cost[at, s]
            at = self.step[at, s]
        return at, cost

    def solve(self, symbols: bytes, behind: int) -> tuple[int, list[int], int]:
        """The cost added before ``behind``, the vector behind each block, and the one before all."""
        head, blocks = self.blocks(symbols)
        at, cost, kept = behind, 0, []
        for b in reversed(blocks):
            kept.append(at)
            cost += int(self.block_cost[at, b])
            at = int(self.block_step[at, b])
        edge = at
        for s in reversed(symbols[:head]):
            cost += int(self.cost[at, s])
            at = int(self.step[at, s])
        return cost, [edge, *reversed(kept)], at

    def trace(self, symbols: bytes, behind: list[int], state: int) -> tuple[str, int]:
        """The edits from ``state`` on, least letters first, and the state after them.
        ``behind`` is the middle result of ``solve``."""
        head, out, low = len(symbols) % self.block, [], 0
        for i, at in enumerate(behind):
            high = head + i * self.block
            rows, after = symbols[low:high], []
            for s in reversed(rows):   # the block again, backward row by row
                after.append(at)
                at = int(self.step[at, s])
            for s, v in zip(rows, reversed(after)):
                letters, state = self.edits[v][s][state]
                out.append(letters)
            low = high
        return "".join(out), state


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def lines(rows, audit: str, state: int):
    """``role:text`` of the repaired rows; ``rows`` are (role, text) in order."""
    rows = iter(rows)
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        if letter == "K":
            state = NEXT[state, role[:1]]
        else:
            role, state = GIVEN[state]
        yield f"{role}:{text}"


def fault(text: str) -> str:
    """blank, truncated or nothing, for a row whose role and text are new."""
    text = text.rstrip(BLANKS)
    return "" if text and text[-1] in ENDS else "truncated" if text else "blank"


#: Of a conversation or a piece of one: rows by first fault, pairs of initials out of order.
COUNTS = "blank long, duplicate long, truncated long, illegal long"
TURNS = "least long, most long, turns long"
RESULT = f"{COUNTS}, {TURNS}, cost long, audit string, sha256 string"
NONE = (None,) * 10
#: ``pos`` is the place of a piece's first row in the order of all rows that go by pieces.
PIECE = f"pos long, symbols binary, {COUNTS}, {TURNS}, first string, last string, first_turn long, last_turn long"


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _whole(rows: list[tuple]) -> tuple[str, tuple]:
    """Repaired text and RESULT of one conversation's (turn, role, text)."""
    t, seen, symbols = tables(), set(), bytearray()
    counts = {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
    for _, role, text in rows:
        kind = fault(text)
        if kind != "blank":
            kind = "duplicate" if (role, text) in seen else kind
            seen.add((role, text))
        counts[kind] += 1
        symbols.append(DEAD if kind in ("blank", "duplicate") else symbol(role[:1], kind == "truncated"))
    illegal = sum(a[1][:1] + b[1][:1] not in LEGAL for a, b in zip(rows, rows[1:]))
    turns = [x for x, _, _ in rows if x is not None]
    cost, behind, before = t.solve(bytes(symbols), 0)
    audit, state = t.trace(bytes(symbols), behind, 0)
    audit += "I" * len(TAIL[state])
    text = "\n".join(lines([r[1:] for r in rows], audit, 0))
    return text, (counts["blank"], counts["duplicate"], counts["truncated"], illegal, min(turns, default=None),
                  max(turns, default=None), len(set(turns)), cost + t.vectors[before][0], audit, _sha256(text))


def _first_pass(rows, held_rows: int):
    """Repaired text and RESULT of conversations that lie within the task's rows, and the
    rows of the others, numbered in order (``pos``) over all tasks."""
    pos = TaskContext.get().partitionId() << 33
    held, size, conv, edge, apart = [], 0, None, True, False

    def let_go():
        nonlocal pos, held, size
        for turn, role, text in held:
            kind = fault(text)
            yield (conv, pos, turn, role, DEAD if kind == "blank" else symbol(role[:1], kind == "truncated"),
                   text, *NONE)
            pos += 1
        held, size = [], 0

    for c, turn, role, text in rows:
        if c != conv and (held or apart):
            if edge or apart:
                yield from let_go()
            else:
                repaired, result = _whole(held)
                yield (conv, None, None, None, None, repaired, *result)
            held, size, edge, apart = [], 0, False, False
        conv = c
        held.append((turn, role, text))
        size += len(text)
        if len(held) > held_rows or size > HELD_CHARS:
            apart = True
            yield from let_go()
    yield from let_go()   # the last one may go on in the next task


def _pieces(rows):
    """A row for each run of a conversation's rows in a segment, with the change that it makes.

    ``rows``: (seg, pos, mark, conv, turn, initial, sym), ordered; a mark comes before
    the row that has its role and text before all others do."""
    t, held, marked = tables(), None, None

    def done():
        conv, _, pos, symbols, counts, illegal, turns, initials, first_turn, last_turn = held
        at, cost = t.change(bytes(symbols))
        return (conv, pos, bytes(symbols), counts["blank"], counts["duplicate"], counts["truncated"], illegal,
                *turns, *initials, first_turn, last_turn, at.astype("<i4").tobytes(), cost.astype("<i8").tobytes())

    for seg, pos, mark, conv, turn, initial, sym in rows:
        if mark:
            marked = pos
            continue
        if held is None or held[:2] != [conv, seg]:
            if held:
                yield done()
            held = [conv, seg, pos, bytearray(), {"blank": 0, "duplicate": 0, "truncated": 0}, 0,
                    [None, None, 0], [initial, initial], turn, turn]
        elif held[7][1] + initial not in LEGAL:
            held[5] += 1
        kind = "blank" if sym == DEAD else "duplicate" if marked != pos else "truncated" if sym >= 4 else ""
        if kind:
            held[4][kind] += 1
        held[3].append(DEAD if kind in ("blank", "duplicate") else sym)
        held[7][1], held[9] = initial, turn
        if turn is not None:
            low, high, n = held[6]
            held[6] = [turn if low is None else low, turn, n + (turn != high)]
    if held:
        yield done()


def _right_to_left(rows):
    """The vector behind each piece and the cost from it on; pieces come last first."""
    t, conv, at, cost = tables(), None, 0, 0
    for i, (*row, step, added) in enumerate(rows):
        last = i == 0 or row[0] != conv
        if last:
            conv, at, cost = row[0], 0, 0
        behind = at
        cost += int(np.frombuffer(added, "<i8")[at])
        at = int(np.frombuffer(step, "<i4")[at])
        yield (*row, behind, last, cost + t.vectors[at][0])


def _four_traces(rows):
    """The edits of each piece for every state that it may be met in."""
    t = tables()
    for conv, pos, symbols, *row, behind, last, cost in rows:
        kept = t.solve(symbols, behind)[1]
        got = [t.trace(symbols, kept, q) for q in range(4)]
        if last:
            got = [(audit + "I" * len(TAIL[q]), q) for audit, q in got]
        yield (conv, pos, *row, cost, [a for a, _ in got], [q for _, q in got])


def _left_to_right(rows):
    """One state and its edits for each piece; what lies between two pieces is counted."""
    conv, state, initial, before, begun = None, 0, "", None, False
    for (c, pos, blank, duplicate, truncated, illegal, least, most, turns, first, last, first_turn, last_turn,
         cost, audits, states) in rows:
        if begun and c == conv:
            illegal += initial + first not in LEGAL
            turns -= before is not None and before == first_turn
            cost = 0
        else:
            begun, conv, state, before = True, c, 0, None
        yield c, pos, blank, duplicate, truncated, illegal, least, most, turns, cost, audits[state], state
        state, initial = states[state], last
        before = before if last_turn is None else last_turn


def _written(rows):
    """Parts of each piece's repaired text, numbered; ``rows``: (seg, pos, audit, state, conv,
    role, text), a piece's edits before its rows."""
    key, letters, at, state, no, part, size = None, "", 0, 0, 0, [], 0

    def inserts():
        nonlocal at, state
        while letters[at:at + 1] == "I":
            role, state = GIVEN[state]
            part.append(f"{role}:")
            at += 1

    for _, pos, audit, begin, conv, role, text in rows:
        if audit is not None:
            inserts()
            if part:
                yield (*key, no, "\n".join(part))
            key, letters, at, state, no, part, size = (conv, pos), audit, 0, begin, 0, [], 0
            continue
        inserts()
        letter, at = letters[at], at + 1
        if letter != "D":
            role, state = (role, NEXT[state, role[:1]]) if letter == "K" else GIVEN[state]
            part.append(f"{role}:{text}")
            size += len(text)
            if size > CHUNK:
                yield (*key, no, "\n".join(part))
                no, part, size = no + 1, [], 0
    inserts()
    if part:
        yield (*key, no, "\n".join(part))


def _digests(rows):
    """(conv, SHA-256) over the parts of each conversation, in order."""
    conv, digest = None, None
    for c, part in rows:
        part = part.encode("utf-8", "surrogatepass")
        if digest is not None and c == conv:
            digest.update(b"\n" + part)
        else:
            if digest is not None:
                yield conv, digest.hexdigest()
            conv, digest = c, hashlib.sha256(part)
    if digest is not None:
        yield conv, digest.hexdigest()


@dataclass
class Repaired:
    """``report``: one row a conversation. ``texts``: its repaired ``role:text`` lines, in
    parts (conv, pos, no, part) ordered by pos and no and joined by a line end."""

    report: DataFrame
    texts: DataFrame


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", held_rows: int = HELD_ROWS, piece_bits: int = PIECE_BITS) -> Repaired:
    """Least-cost repair of every conversation of ``turns``.

    Rows of a conversation are taken by turn (longs, nulls first), rows of one
    turn by role and then by the MD5 of the text, so that repeated rows are
    neighbours. A null role or text is one space; rows with a null ``conv`` are
    one conversation; other columns are ignored; an empty table has no
    conversation. The report has gaps, blank, duplicate, truncated, illegal,
    cost (longs), audit and repaired_sha256. Longer conversations than
    ``held_rows`` go by pieces of at most ``2 ** piece_bits`` rows.
    """
    kind = "conv " + turns.schema[conv].dataType.simpleString()
    space = F.lit(" ")
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
                        F.coalesce(F.col(role), space).alias("role"), F.coalesce(F.col(text), space).alias("text"))
    # the last column deals out rows that are equal in all others
    rows = rows.withColumns({"digest": F.md5("text"), "row": F.monotonically_increasing_id()})
    order = ["conv", "turn", "role", "digest", "row"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "turn", "role", "text")
    first = stage(arrow_map(dealt, lambda rows: _first_pass(rows, held_rows), f"{kind}, pos long, turn long, role string, sym int, text string, "
                                                f"{RESULT}"), "turns")
    whole, apart = first.where("pos IS NULL"), first.where("pos IS NOT NULL")

    seg = F.shiftright("pos", piece_bits).alias("seg")
    marks = (apart.where(F.col("sym") != DEAD).groupBy("conv", "role", F.sha2("text", 256)).agg(F.min("pos").alias("pos"))
             .select(seg, "pos", F.lit(True).alias("mark"), "conv", F.lit(None).cast("long").alias("turn"),
                     F.lit("").alias("initial"), F.lit(0).alias("sym")))
    narrow = apart.select(seg, "pos", F.lit(False).alias("mark"), "conv", "turn",
                          F.substring("role", 1, 1).alias("initial"), "sym").union(marks)
    pieces = arrow_map(narrow.repartition("seg").sortWithinPartitions("seg", "pos", F.desc("mark")), _pieces,
                       f"{kind}, {PIECE}, step binary, added binary")
    solved = arrow_map(pieces.repartition("conv").sortWithinPartitions("conv", F.desc("pos")), _right_to_left,
                       f"{kind}, {PIECE}, behind int, last_piece boolean, cost long")
    traced = arrow_map(solved.repartition("conv", "pos"), _four_traces,
                       f"{kind}, {PIECE.replace('symbols binary, ', '')}, cost long, audits array<string>, "
                       "states array<int>")
    chosen = stage(arrow_map(traced.repartition("conv").sortWithinPartitions("conv", "pos"), _left_to_right,
                             f"{kind}, pos long, {COUNTS}, {TURNS}, cost long, audit string, state int"), "pieces")

    heads = chosen.select(seg, "pos", "audit", "state", "conv", F.lit("").alias("role"), F.lit("").alias("text"))
    body = apart.select(seg, "pos", F.lit(None).cast("string").alias("audit"), F.lit(None).cast("int").alias("state"),
                        "conv", "role", "text")
    parts = stage(arrow_map(heads.union(body).repartition("seg")
                            .sortWithinPartitions("seg", "pos", F.asc_nulls_last("audit")), _written,
                            f"{kind}, pos long, no int, part string", flush=16), "parts")
    digests = arrow_map(parts.repartition("conv").sortWithinPartitions("conv", "pos", "no").select("conv", "part"),
                        _digests, f"{kind}, sha256 string")
    sums = chosen.groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "turns", "cost")],
        F.min("least").alias("least"), F.max("most").alias("most"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "audit"))), lambda x: x["audit"]), "")
        .alias("audit"))
    digests = digests.withColumnRenamed("conv", "of")
    names = [c.split()[0] for c in RESULT.split(", ")]
    far = sums.join(digests, F.col("conv").eqNullSafe(F.col("of")), "left").select("conv", *names)
    report = whole.select("conv", *names).union(far).select(
        F.col("conv").alias(conv), F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0)).alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.coalesce("sha256", F.lit(_sha256(""))).alias("repaired_sha256"))
    texts = whole.select("conv", F.lit(0).cast("long").alias("pos"), F.lit(0).alias("no"),
                         F.col("text").alias("part")).where("part <> ''").union(parts)
    return Repaired(report, texts.withColumnRenamed("conv", conv))
