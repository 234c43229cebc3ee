"""Structure repair of conversations by iterative-deepening A*.

A conversation is sound if its roles' initials are ``(s?(ua)+)?``: an optional system turn, then user and assistant in turn. Edits make
it so: Keep a row (0), Rerole it to user or assistant (3), Delete it (4; blank and repeated rows must go), Insert an empty user or
assistant row (3); a truncated row that stays costs 3 more. The answer is the cheapest list of edits, of those the one whose
initials come first in ASCII order.

The search is depth-first, tries edits in ASCII order (D, I, K, R) under a bound on the cost, and raises the bound to the least cost that
broke it until a path is accepted; the first accepting path is the answer. The table of failed states keeps for each (row,
state of the automaton) the least cost that its failure proved necessary, so a state is entered again only with more to spend.

A conversation may be any share of the input. Rows are counted by role and text first, on the map side too; the first of equal ones
is known by a marker that sorts just before it, so nothing is joined. Then rows without their texts are dealt by range of (conversation,
turn), so one conversation may span tasks, and are cut into blocks of at most 64 rows; a block's cheapest edits from each state of
the automaton to each are found by the search, and so is the conversation's path through its blocks. No block's list of edits is the
beginning of another of its own (inserts go before a row, or at the very end), so the order of lists is that of whole paths. Texts are
read once more, sorted, to write the repaired turns: a task streams them and holds the list of edits of one conversation, a byte a row.

Defined cases: null ids, roles and texts: ids are a value like any other (null turns come first), a null role or text is one space.
Rows of one turn come in the order of role, then of a digest of role and text; rows equal in all of it are interchangeable. An empty role has
no initial, is never legal and is reroled or deleted. Blank rows have no character but white space; of a row's faults the first of
blank, repeated, truncated counts. Columns other than the four are left out, whatever their names. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CHARS

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
ENDS = (".", "!", "?")
LEGAL = {"su", "ua", "au"}
#: The automaton: nothing yet, after system, after user, after assistant; by state the next one for a role's initial.
STEPS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: The state after an inserted or reroled row, and the state of an end that is accepted.
NEXT, SOUND = (2, 2, 3, 2), (0, 3)
NEW_ROLE = {2: "user", 3: "assistant"}
#: Rows of a block that the search takes at a time; runs of rows that must go count as one.
BLOCK = 64
NEVER = 1 << 60
#: The path of a whole conversation, where one task has seen all of it.
WHOLE = -1


def cheapest(start, moves: Callable, done: Callable, least: Callable, most: int) -> tuple[int, str] | None:
    """Iterative-deepening A* from a state: (cost, letters) of the cheapest path, the first in the order of moves; None above most.

    moves(state): (letters, next state, cost) in order; least(state): no more than what is left to pay.
    """
    need: dict = {}
    bound = least(start)
    while bound <= most:
        if done(start):
            return 0, ""
        need[start] = bound + 1
        stack, letters = [[start, bound, iter(moves(start)), NEVER]], []
        while stack:
            top = stack[-1]
            for text, state, cost in top[2]:
                left = top[1] - cost
                known = need.get(state)
                if known is None:
                    known = least(state)
                if known > left:
                    top[3] = min(top[3], cost + known)
                    continue
                letters.append(text)
                if done(state):
                    return bound - left, "".join(letters)
                need[state] = left + 1  # a way back to it with less to spend is none
                stack.append([state, left, iter(moves(state)), NEVER])
                break
            else:
                need[top[0]] = max(need[top[0]], top[3])
                stack.pop()
                if stack:
                    letters.pop()
                    above = stack[-1]
                    above[3] = min(above[3], above[1] - top[1] + need[top[0]])
        bound = need[start]
    return None


def search(rows: list[tuple[str, int]], starts: tuple[int, ...], whole: bool) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, edits) of a block, sorted by edits for each state before.

    rows: (role's initial, cost of staying), or ("", n) for n rows that must go. whole: the block is its conversation, so the one end is
    a sound state (WHOLE) and rows may be inserted there.
    """
    n = len(rows)
    after = [0] * (n + 1)
    for i in reversed(range(n)):
        initial, x = rows[i]
        after[i] = after[i + 1] + (DELETE * x if initial == "" else x)
    top = sum(DELETE * x if initial == "" else DELETE for initial, x in rows) + 2 * INSERT

    def moves(state):
        i, q = state
        if i == n:
            if whole:
                yield "I", (n, NEXT[q]), INSERT
            return
        initial, x = rows[i]
        yield ("D" * x, (i + 1, q), DELETE * x) if initial == "" else ("D", (i + 1, q), DELETE)
        yield "I", (i, NEXT[q]), INSERT
        if initial:
            if initial in STEPS[q]:
                yield "K", (i + 1, STEPS[q][initial]), KEEP + x
            yield "R", (i + 1, NEXT[q]), REROLE + x

    out = []
    for a in starts:
        found = []
        for b in (WHOLE,) if whole else ((0, 1, 2, 3), (1, 2, 3), (2, 3), (2, 3))[a]:
            if b == 1 and a == 0 and all(initial != "s" for initial, _ in rows):
                continue
            goal = {(n, q) for q in (SOUND if whole else (b,))}
            path = cheapest((0, a), moves, goal.__contains__, lambda state: after[state[0]], top)
            if path:
                found.append((a, b, *path))
        out += sorted(found, key=lambda e: e[3])
    return out


def join(blocks: list[dict]) -> tuple[int, str]:
    """(cost, edits) of a conversation from its blocks, by the same search over whole blocks."""
    if not blocks:
        return 0, ""
    if blocks[0]["edges"][0][1] == WHOLE:
        return blocks[0]["edges"][0][2], blocks[0]["edges"][0][3]
    n = len(blocks)
    least = [0] * (n + 1)
    for i in reversed(range(n)):
        least[i] = least[i + 1] + min(e[2] for e in blocks[i]["edges"])
    tail = {0: (0, ""), 1: (2 * INSERT, "II"), 2: (INSERT, "I"), 3: (0, "")}

    def moves(state):
        i, q = state
        if i == n:
            yield tail[q][1], (n + 1, 0), tail[q][0]
            return
        for a, b, cost, edits in blocks[i]["edges"]:
            if a == q:
                yield edits, (i + 1, b), cost

    found = cheapest((0, 0), moves, lambda state: state[0] == n + 1, lambda state: least[min(state[0], n)], NEVER - 1)
    assert found is not None  # deleting everything is always a way
    return found


class Cutter:
    """Blocks of one conversation's rows in order, as a task meets them."""

    def __init__(self, opened: bool) -> None:
        self.opened, self.first_block = opened, True  # opened: the conversation begins in this task
        self.reset()

    def reset(self) -> None:
        self.rows: list[tuple[str, int]] = []
        self.key, self.turns, self.faults = None, [], [0, 0, 0, 0]
        self.first = self.last = None

    def add(self, key: tuple, initial: str, end: str, times: int, is_first: bool) -> Iterator[dict]:
        if len(self.rows) >= BLOCK:
            yield self.block(False)
        if self.key is None:
            self.key, self.first = key, initial
        if self.last is not None and self.last + initial not in LEGAL:
            self.faults[3] += 1
        self.faults[3] += times - 1  # equal roles in a row are never legal
        self.last, turn = initial, key[0]
        if turn is not None and (not self.turns or self.turns[1] != turn):
            self.turns = [self.turns[0] if self.turns else turn, turn, self.turns[2] + 1 if self.turns else 1]
        gone = times
        if end == "":
            self.faults[0] += times
        else:
            gone -= is_first
            self.faults[1] += gone
            if is_first:
                self.faults[2] += end not in ENDS
                self.rows.append((initial or "-", 0 if end in ENDS else TRUNCATED))
        if gone:
            if self.rows and self.rows[-1][0] == "":
                gone += self.rows.pop()[1]
            self.rows.append(("", gone))

    def block(self, closed: bool) -> dict:
        """What is known of the rows so far; closed: the conversation ends in this task."""
        starts = (0,) if self.opened and self.first_block else (0, 1, 2, 3)
        whole = self.opened and self.first_block and closed
        out = {"key": self.key, "edges": search(self.rows, starts, whole), "faults": self.faults, "turns": self.turns, "first": self.first, "last": self.last}
        self.first_block = False
        self.reset()
        return out


def summary(blocks: list[dict]) -> dict[str, int]:
    """Gaps and faults of a conversation, added up over its blocks."""
    faults = [sum(b["faults"][k] for b in blocks) for k in range(4)]
    faults[3] += sum(a["last"] + b["first"] not in LEGAL for a, b in zip(blocks, blocks[1:]))
    turns = [b["turns"] for b in blocks if b["turns"]]
    different = sum(t[2] for t in turns) - sum(a[1] == b[0] for a, b in zip(turns, turns[1:]))
    gaps = turns[-1][1] - turns[0][0] + 1 - different if turns else 0
    return dict(zip(("gaps", "blank", "duplicate", "truncated", "illegal"), (gaps, *faults)))


def prepared(rows: DataFrame, times: str | None) -> DataFrame:
    space = lambda c: F.coalesce(rows[c].cast("string"), F.lit(" ")).alias(c)
    n = (rows[times] if times else F.lit(1)).cast("bigint").alias("times")
    x = rows.select(rows["conv_id"].alias("conv_id"), rows["turn"].alias("turn"), space("role"), space("text"), n)
    # Lengths first: no two pairs of role and text are written alike.
    return x.withColumn("digest", F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))))


ORDER = ("conv_id", "turn", "role", "digest")


def blocks_of(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and digest of each block's first row, and the block as JSON text."""
    facts = rows.where("times > 0").select(*ORDER, "times", F.substring(F.rtrim("text", F.lit(SPACE_CHARS)), -1, 1).alias("end"))
    equal = facts.groupBy(*ORDER, "end").agg(F.sum("times").alias("times"))
    at = F.min(F.struct(F.col("turn").isNotNull(), "turn"))["turn"]
    marks = equal.groupBy("conv_id", "role", "digest").agg(at.alias("turn"), F.lit(0).cast("bigint").alias("times"), F.lit("").alias("end"))
    both = equal.select(*ORDER, "end", "times").unionByName(marks).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER, "times")
    kind = rows.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stream():
            for batch in batches:
                yield from zip(*[c.to_pylist() for c in batch.columns])

        def made():
            seen = False
            cutter, conv = None, None
            for conv_id, of in groupby(stream(), key=lambda r: r[0]):
                if cutter is not None:
                    yield conv, cutter.block(True)
                cutter, conv, seen, marked = Cutter(seen), conv_id, True, False
                for _, turn, role, digest, end, times in of:
                    if times == 0:
                        marked = True
                        continue
                    for block in cutter.add((turn, role, digest), role[:1], end, times, marked):
                        yield conv, block
                    marked = False
            if cutter is not None:
                yield conv, cutter.block(False)

        out = []
        for conv, block in made():
            out.append((conv, *block.pop("key"), json.dumps(block)))
            if len(out) >= 4096:
                yield arrow(out)
                out = []
        yield arrow(out)

    types = [*(arrow_type(kind[c]) for c in ORDER), pa.string()]
    names = [*ORDER, "block"]

    def arrow(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=names)

    schema = ", ".join(f"{c} {kind[c].dataType.simpleString()}" for c in ORDER) + ", block string"
    return both.select(*ORDER, "end", "times").mapInArrow(run, schema)


def arrow_type(field) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(field.dataType)


def replayed(rows: DataFrame, made: Callable[[Iterator], Iterator[tuple]], schema: str, types: list[pa.DataType]) -> DataFrame:
    """The rows that made() yields from the conversations: (conv_id, blocks, its rows (role, text, times) in order) one after another."""
    kind = rows.schema
    blank = lambda c: F.lit(None).cast(kind[c].dataType).alias(c)
    order = [F.col(c) for c in ORDER]
    texts = rows.select(*order, F.lit(1).alias("part"), F.when(F.col("times") > 0, F.col("text")).alias("text"), "times", F.lit(None).cast("string").alias("block"))
    blocks = blocks_of(rows).select(*order, F.lit(0).alias("part"), blank("text"), blank("times"), "block")
    both = texts.unionByName(blocks).repartition("conv_id").sortWithinPartitions("conv_id", "part", "turn", "role", "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stream():
            for batch in batches:
                yield from zip(*[c.to_pylist() for c in batch.columns])

        def conversations():
            for conv, of in groupby(stream(), key=lambda r: r[0]):
                first, blocks = None, []
                for first in of:
                    if first[1]:
                        break
                    blocks.append(json.loads(first[5]))
                rest = (r for part in ([first], of) for r in part)
                yield conv, blocks, ((r[2], r[3], r[4]) for r in rest if r[4])

        out, size = [], 0
        for row, weight in made(conversations()):
            out.append(row)
            size += weight
            if size >= 1 << 22 or len(out) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=names)
                out, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=names)

    names = [part.strip().split(" ")[0] for part in schema.split(",")]
    return both.select("conv_id", "part", "role", "text", "times", "block").mapInArrow(run, schema)


def turns_after(edits: str, rows: Iterator[tuple[str, str, int]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the repaired conversation's rows; rows are read once, in order."""
    state, at = 0, 0

    def inserted():
        nonlocal state, at
        while at < len(edits) and edits[at] == "I":
            state, at = NEXT[state], at + 1
            yield "I", NEW_ROLE[state], ""

    for role, text, times in rows:
        for _ in range(times):
            yield from inserted()
            edit, at = edits[at], at + 1
            if edit == "K":
                state = STEPS[state][role[:1]]
                yield edit, role, text
            elif edit == "R":
                state = NEXT[state]
                yield edit, NEW_ROLE[state], text
    yield from inserted()


FAULTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair(rows: DataFrame, times: str | None = None) -> DataFrame:
    """One row a conversation: its faults, the cost and the letters of its edits (audit), and repaired_sha256 of the repaired turns as
    ``role:text``, joined by line ends. rows: conv_id, turn, role, text; times: a column that says how often a row occurs (0: not at all,
    but its conversation is reported)."""

    def made(conversations):
        for conv, blocks, of in conversations:
            cost, edits = join(blocks)
            digest, joint = hashlib.sha256(), b""
            for _, role, text in turns_after(edits, of):
                digest.update(joint + role.encode() + b":" + text.encode())
                joint = b"\n"
            yield (conv, *summary(blocks).values(), cost, edits, digest.hexdigest()), 200 + len(edits)

    rows = prepared(rows, times)
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, " + ", ".join(f"{f} long" for f in FAULTS) + ", audit string, repaired_sha256 string"
    return replayed(rows, made, schema, [arrow_type(rows.schema["conv_id"]), *[pa.int64()] * len(FAULTS), pa.string(), pa.string()])


def repaired(rows: DataFrame, times: str | None = None) -> DataFrame:
    """The repaired turns: conv_id, turn (from 0), edit (K, R or I), role, text."""

    def made(conversations):
        for conv, blocks, of in conversations:
            for turn, (edit, role, text) in enumerate(turns_after(join(blocks)[1], of)):
                yield (conv, turn, edit, role, text), 100 + len(text)

    rows = prepared(rows, times)
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, turn long, edit string, role string, text string"
    return replayed(rows, made, schema, [arrow_type(rows.schema["conv_id"]), pa.int64(), *[pa.string()] * 3])


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and times of conversations with planted faults, by a hash of id and turn."""
    part = lambda c: F.coalesce(rows[c].cast("string"), F.lit(" "))
    kind: Column = F.crc32(F.concat_ws(":", part("conv_id"), part("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(part("text"), "[.!?]", "")).otherwise(part("text"))
    role = F.when(kind == 4, "user").otherwise(part("role"))
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return rows.select(rows["conv_id"].alias("conv_id"), rows["turn"].alias("turn"), role.alias("role"), text.alias("text"), times.alias("times"))
