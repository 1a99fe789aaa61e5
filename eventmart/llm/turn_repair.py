"""Faults of conversations, and their cheapest repair to an alternating exchange.

A conversation should read ``(s?(ua)+)?`` by the initials of its roles: nothing, or an optional system
turn and then pairs of user and assistant. Repair is Wagner-Fischer alignment of the turns with
the string of that grammar of each feasible length: keeping a turn is free, changing its role to user or
assistant costs 2, inserting an empty turn 2, deleting one 3, and a truncated turn that stays
adds 1. A length is feasible if its least possible cost does not pass the cheapest alignment
found so far, the incumbent, and only the diagonals that the incumbent allows are filled
(Ukkonen). Of equally cheap alignments, of one length or several, the audit (the initials of the edits
in order) least in ASCII order counts.

A conversation of any length is cut: turns are dealt by ranges of (conversation, place), and
every run is aligned in blocks of ``BLOCK`` turns for each state the grammar may be in before
and after. Blocks, then runs, are joined by least cost and audit; equally cheap audits of the same
block and states have one length, so none is the beginning of another and the least parts make the
least whole. No task holds a hot conversation's turns: what remains of them is an audit.

Faults: a turn without a visible character is blank; one whose role and text an earlier turn
had is a duplicate; one whose last visible character is no ``. ! ?`` is truncated; the first that
holds counts. Blank and duplicate turns are always deleted.

Defined results: turns are ordered by number, nulls first, ties in input order. A null role or
text reads as one space. A null conversation is one of its own. Roles count by their first character;
a turn of any other initial can be changed or deleted. Conversations without a turn have zeros and an
empty audit. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.runtime import materialise, prepare, run_bounds, runs
from eventmart.session import shuffle_width

SPACES = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
RENAME, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
BLOCK = 32
MEMORY = 50_000

# Where the grammar stands: nothing yet, after a system turn, after a user's, after an assistant's.
START, OPENED, ASKED, ANSWERED = range(4)
_AFTER = {"s": OPENED, "u": ASKED, "a": ANSWERED}
_FINAL = (START, ANSWERED)

Cheapest = dict[int, tuple[int, str]]


def fragments(state: int, length: int) -> list[str]:
    """What the grammar allows next from a state, in so many turns."""
    plain = ("au" if state == ASKED else "ua") * (length // 2 + 1)
    found = [plain[:length]]
    if state == START and length:
        found.append("s" + plain[: length - 1])
    return found


def aligned(turns: str, target: str, most: int) -> tuple[int, str] | None:
    """The cheapest edits of ``turns`` to ``target`` and the least audit; None above ``most``.

    A turn is the initial of its role (``o``: any other), a capital where it is truncated, ``x``
    where it must go.
    """
    n, m = len(turns), len(target)
    surplus = m - n

    def bound(diagonal: int) -> int:
        """Least cost of a path over (i, i + diagonal)."""
        before = INSERT * diagonal if diagonal > 0 else -DELETE * diagonal
        left = surplus - diagonal
        return before + (INSERT * left if left > 0 else -DELETE * left)

    low, high = min(0, surplus), max(0, surplus)
    if bound(low) > most:
        return None
    while bound(low - 1) <= most:
        low -= 1
    while bound(high + 1) <= most:
        high += 1
    none = most + 1
    width = high - low + 1
    # Costs of what is left to do from (i, i + low + k), from the last turn backwards.
    table: list[list[int]] = [[]] * (n + 1)
    below: list[int] = []
    for i in range(n, -1, -1):
        row = [none] * width
        turn = turns[i] if i < n else ""
        kept = turn.lower()
        extra = TRUNCATED if turn != kept else 0
        for k in range(width - 1, -1, -1):
            j = i + low + k
            if not 0 <= j <= m:
                continue
            if i == n and j == m:
                row[k] = 0
                continue
            best = none
            if j < m and k + 1 < width and target[j] != "s":
                best = min(best, row[k + 1] + INSERT)
            if i < n:
                if k:
                    best = min(best, below[k - 1] + DELETE)
                if j < m and kept != "x":
                    if kept == target[j]:
                        best = min(best, below[k] + extra)
                    elif target[j] != "s":
                        best = min(best, below[k] + RENAME + extra)
            row[k] = min(best, none)
        table[i] = below = row
    cost = table[0][-low]
    if cost > most:
        return None
    audit, i, k = [], 0, -low
    while i < n or i + low + k < m:
        j = i + low + k
        here = table[i][k]
        if i < n and k and table[i + 1][k - 1] + DELETE == here:
            audit.append("D")
            i, k = i + 1, k - 1
        elif j < m and k + 1 < width and target[j] != "s" and table[i][k + 1] + INSERT == here:
            audit.append("I")
            k += 1
        else:
            audit.append("K" if turns[i].lower() == target[j] else "R")
            i += 1
    return cost, "".join(audit)


@lru_cache(maxsize=MEMORY)
def block(turns: str, state: int) -> Cheapest:
    """For each state after them, the cheapest edits of some turns from a state before."""
    gone = turns.count("x")
    stay = len(turns) - gone
    best: Cheapest = {}

    def attempt(length: int) -> bool:
        """Whether some target of this length could still be cheapest."""
        least = DELETE * gone + (INSERT * (length - stay) if length > stay else DELETE * (stay - length))
        open_ = False
        for target in fragments(state, length):
            after = _AFTER[target[-1]] if target else state
            incumbent = best.get(after)
            most = incumbent[0] if incumbent else DELETE * len(turns) + INSERT * length
            if least > most:
                continue
            open_ |= after in (ASKED, ANSWERED)
            found = aligned(turns, target, most)
            if found and (incumbent is None or found < incumbent):
                best[after] = found
        return open_

    attempt(stay)
    # A length apart has the other parity, so that two in a row must fail before all further do.
    for step in (1, -1):
        length, failed = stay + step, 0
        while failed < 2 and length >= 0:
            failed = 0 if attempt(length) else failed + 1
            length += step
    # Reached from few lengths only, however costly.
    for length in (0, 1):
        attempt(length)
    return best


def joined(left: Cheapest, right: dict[int, Cheapest]) -> Cheapest:
    """Edits of turns followed by those of the turns after them."""
    best: Cheapest = {}
    for state, (cost, audit) in left.items():
        for after, (more, rest) in right.get(state, {}).items():
            found = cost + more, audit + rest
            if after not in best or found < best[after]:
                best[after] = found
    return best


def run_of(turns: str, states: range) -> dict[int, Cheapest]:
    """Cheapest edits of any number of turns from each of the given states."""
    found = {}
    for state in states:
        total: Cheapest = {state: (0, "")}
        for start in range(0, len(turns), BLOCK):
            part = turns[start : start + BLOCK]
            total = joined(total, {each: block(part, each) for each in total})
        found[state] = total
    return found


def repair(turns: str) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    found = run_of(turns, range(1))[START]
    return min(found[state] for state in _FINAL if state in found)


def _key(column: Column) -> Column:
    """A conversation's id as text that is never null."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def mark(frame: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Every turn with its fault: conv_key, turn, place, role, text, fault (blank, duplicate, truncated or null)."""
    prepare(frame.sparkSession)
    filled = {name: F.coalesce(F.col(name), F.lit(" ")) for name in (role, text)}
    rows = frame.select(
        _key(F.col(conv)).alias("conv_key"),
        F.col(turn).cast("long").alias("turn"),
        F.monotonically_increasing_id().alias("place"),
        filled[role].alias("role"),
        filled[text].alias("text"),
    )
    seen = F.rtrim(F.col("text"), F.lit(SPACES))
    rows = materialise(
        rows.withColumns(
            {
                "digest": F.unhex(F.md5(F.col("text"))),
                "blank": seen == "",
                "cut": ~F.right(seen, F.lit(1)).isin(*ENDS),
            }
        ),
        "turns",
    )
    # Counted before they meet, so that a turn that repeats without end is one row a task.
    first = rows.groupBy("conv_key", "role", "digest").agg(F.min(F.struct("turn", "place")).alias("first"))
    found = rows.join(first, ["conv_key", "role", "digest"])
    again = F.struct("turn", "place") != F.col("first")
    fault = (
        F.when(F.col("blank"), F.lit("blank")).when(again, F.lit("duplicate")).when(F.col("cut"), F.lit("truncated"))
    )
    return materialise(found.select("conv_key", "turn", "place", "role", "text", fault.alias("fault")), "turn-faults")


_PIECE = (
    "conv_key string, part int, first boolean, blank long, duplicate long, truncated long, illegal long, head string, tail string, "
    "least long, most long, numbers long, costs array<long>, audits array<string>"
)
_LEGAL = ("su", "ua", "au")


def _turn_codes(roles: list[str], faults: list[str | None]) -> str:
    codes = []
    for role, fault in zip(roles, faults):
        initial = role[:1] if role[:1] in _AFTER else "o"
        codes.append("x" if fault in ("blank", "duplicate") else initial.upper() if fault else initial)
    return "".join(codes)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each run of a conversation's turns in this partition."""
    part = TaskContext.get().partitionId()
    names = [x.split()[0] for x in _PIECE.split(", ")]
    begun = False
    for table in runs(batches, "conv_key"):
        bounds = run_bounds(table.column("conv_key").to_numpy(zero_copy_only=False))
        keys, numbers, initials, faults = (table.column(c).to_pylist() for c in ("conv_key", "turn", "role", "fault"))
        rows = []
        for start, end in zip(bounds[:-1], bounds[1:]):
            # Only a partition's first run can continue another's.
            found = run_of(_turn_codes(initials[start:end], faults[start:end]), range(1) if begun else range(4))
            known = [x for x in numbers[start:end] if x is not None]
            pairs = zip(initials[start : end - 1], initials[start + 1 : end])
            cells = [found.get(state, {}).get(after) for state in range(4) for after in range(4)]
            rows.append(
                (
                    keys[start], part, not begun, *(faults[start:end].count(x) for x in ("blank", "duplicate", "truncated")),
                    sum(a[:1] + b[:1] not in _LEGAL for a, b in pairs), initials[start], initials[end - 1],
                    known[0] if known else None, known[-1] if known else None, len(set(known)),
                    [None if c is None else c[0] for c in cells], [None if c is None else c[1] for c in cells],
                )
            )
            begun = True
        yield _batch(rows, names, _PIECE)


_ARROW = {
    "string": pa.string(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(),
    "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
}


def _batch(rows: list[tuple], names: list[str], schema: str) -> pa.RecordBatch:
    kinds = [_ARROW[x.split()[1]] for x in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names)


_SUMMARY = "conv_key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins a conversation's runs, which come in the order of partitions."""
    names = [x.split()[0] for x in _SUMMARY.split(", ")]
    for table in runs(batches, "conv_key"):
        bounds = run_bounds(table.column("conv_key").to_numpy(zero_copy_only=False))
        pieces = table.to_pylist()
        rows = []
        for start, end in zip(bounds[:-1], bounds[1:]):
            total: Cheapest = {START: (0, "")}
            least = most = tail = None
            numbers = illegal = 0
            for piece in pieces[start:end]:
                cells = list(zip(piece["costs"], piece["audits"]))
                table_of = {s: {a: cells[4 * s + a] for a in range(4) if cells[4 * s + a][0] is not None} for s in range(4)}
                total = joined(total, table_of)
                illegal += piece["illegal"] + (tail is not None and tail[:1] + piece["head"][:1] not in _LEGAL)
                tail = piece["tail"]
                if piece["least"] is not None:
                    numbers += piece["numbers"] - (most == piece["least"])  # a number cut by the border counts once
                    least = piece["least"] if least is None else least
                    most = piece["most"]
            cost, audit = min(total[state] for state in _FINAL if state in total)
            sums = (sum(p[x] for p in pieces[start:end]) for x in ("blank", "duplicate", "truncated"))
            gaps = 0 if least is None else most - least + 1 - numbers
            rows.append((pieces[start]["conv_key"], gaps, *sums, illegal, cost, audit))
        yield _batch(rows, names, _SUMMARY)


def align(marked: DataFrame) -> DataFrame:
    """conv_key, gaps, blank, duplicate, truncated, illegal, cost and audit of every conversation of ``mark``."""
    order = ["conv_key", "turn", "place"]
    turns = marked.select(*order, "role", "fault")
    dealt = turns.repartitionByRange(shuffle_width(marked), *order).sortWithinPartitions(*order)
    pieces = dealt.mapInArrow(_pieces, _PIECE)
    whole = pieces.repartition("conv_key").sortWithinPartitions("conv_key", "part").mapInArrow(_whole, _SUMMARY)
    return materialise(whole, "turn-audits")


class _Editor:
    """Applies an audit to a conversation's turns as they come."""

    def __init__(self, audit: str):
        self._audit, self._at, self._state = audit, 0, START

    def _turn(self, edit: str, role: str, text: str) -> tuple[str, str, str]:
        if edit != "K":
            role = "assistant" if self._state == ASKED else "user"
        self._state = _AFTER[role[:1]]
        return edit, role, text

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self._at < len(self._audit) and self._audit[self._at] == "I":
            self._at += 1
            yield self._turn("I", "", "")

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        edit = self._audit[self._at]
        self._at += 1
        if edit != "D":
            yield self._turn(edit, role, text)


def _edited(marked: DataFrame, summary: DataFrame) -> DataFrame:
    """Each conversation's audit (``head``), followed by its turns, in one partition and in order."""
    nothing = F.lit(None)
    rows = summary.select(
        "conv_key", F.lit(True).alias("head"), nothing.cast("long").alias("turn"), nothing.cast("long").alias("place"),
        F.lit("").alias("role"), F.col("audit").alias("text"),
    ).unionByName(marked.select("conv_key", F.lit(False).alias("head"), "turn", "place", "role", "text"))
    order = ["conv_key", F.desc("head"), "turn", "place"]
    return rows.repartition("conv_key").sortWithinPartitions(*order).select("conv_key", "head", "role", "text")


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Iterator]]:
    """Conversation and its repaired turns, piece by piece; the audit's length is all that is held."""
    key = editor = None
    for batch in batches:
        for start in range(0, batch.num_rows, 1_000):
            for row in batch.slice(start, 1_000).to_pylist():
                if row["head"]:
                    if editor:
                        yield key, editor.inserted()
                    key, editor = row["conv_key"], _Editor(row["text"])
                    yield key, iter(())
                else:
                    yield key, editor.turn(row["role"], row["text"])
    if editor:
        yield key, editor.inserted()


def repaired(marked: DataFrame, summary: DataFrame) -> DataFrame:
    """The repaired turns: conv_key, number (from 0), edit (I, K or R), role and text."""
    schema = "conv_key string, number long, edit string, role string, text string"
    names = [x.split()[0] for x in schema.split(", ")]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, number, rows = None, 0, []
        for key, turns in _turns(batches):
            number = number if key == last else 0
            last = key
            for turn in turns:
                rows.append((key, number, *turn))
                number += 1
            if len(rows) >= 1_000:
                yield _batch(rows, names, schema)
                rows = []
        yield _batch(rows, names, schema)

    return _edited(marked, summary).mapInArrow(made, schema)


def digests(marked: DataFrame, summary: DataFrame) -> DataFrame:
    """conv_key and the SHA-256 of its repaired turns as lines ``role:text``."""
    schema = "conv_key string, sha256 string"

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, first, rows = None, hashlib.sha256(), True, []
        for key, turns in _turns(batches):
            if key != last:
                if last is not None:
                    rows.append((last, held.hexdigest()))
                last, held, first = key, hashlib.sha256(), True
            for _, role, text in turns:
                held.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                first = False
            if len(rows) >= 10_000:
                yield _batch(rows, ["conv_key", "sha256"], schema)
                rows = []
        if last is not None:
            rows.append((last, held.hexdigest()))
        yield _batch(rows, ["conv_key", "sha256"], schema)

    return _edited(marked, summary).mapInArrow(made, schema)


def conversations(frame: DataFrame, conv: str) -> DataFrame:
    """Every conversation's id with its ``conv_key``."""
    return frame.select(F.col(conv)).distinct().withColumn("conv_key", _key(F.col(conv)))
