"""Repair of the turn structure of conversations by streamed dynamic programming.

A conversation is well formed when the initials of its roles read ``(s?(ua)+)?``: perhaps a
system turn, then user and assistant in alternation. Each row may be kept, given the role
that the place calls for, or deleted, and empty turns may be inserted; the cheapest such
edits are wanted, and of equally cheap ones those whose initials (Delete, Insert, Keep,
Rerole) come first in ASCII.

Rows are dealt out by conversation and sorted by turn, last turn first, and a task streams
them in Arrow batches. What it carries from row to row, across batches, is the least cost of
bringing the rest of the conversation to an end from each of the four states of the pattern.
A row leaves one byte: for each state the first letter of the cheapest edits from there. When
the conversation's first row has passed, the bytes are read back from the last one written,
which gives the edits in the order of the conversation, and the least letters first. Rows and
bytes wait in memory up to ``HELD_BYTES`` and beyond that in a temporary file of the task, so
a conversation of any length takes bounded memory but for its audit, a letter per edit.

Faults are found before, by Spark: a repeat is a row whose role and text an earlier row of
the conversation has, which a window over the same partitioning tells without a shuffle.
A conversation is read by one task, however long it is: its digest and its edits are
sequential. Other conversations are spread over the others.

Defined cases: a null conv_id is a conversation of its own; a null role or text counts as one
space, which no pattern allows and which is blank; an empty role has no initial and fits
nowhere; null turns come first and do not count
for gaps; rows of one turn are taken in order of role, then text, then copies; repeated rows
are repeats, which are deleted; a conversation without rows (all dropped) has zeros, an empty
audit and the digest of no text; an empty table gives no rows; other columns, whatever their
names, are not read.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sunledger.llm import common

SPACE = " \t\n\x0b\x0c\r"
#: Faults of a row, the first that holds.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Costs of the edits, and of leaving a truncated row in.
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 3, 2, 2, 1
#: Edits, in the order of their letters.
LETTERS = "DIKR"
DELETE, INSERT, KEEP, REROLE = range(4)
#: States: nothing yet, after system, after user, after assistant; the next turn in each.
NEXT = (2, 2, 3, 2)
ROLE_OF = {2: "user", 3: "assistant"}
INITIALS = "sua"
#: Least cost from each state when no row is left.
AT_END = (0, 2 * INSERT_COST, INSERT_COST, 0)
LEGAL = frozenset(("su", "ua", "au"))

#: Rows of one conversation are kept in memory up to so many bytes, then in a file.
HELD_BYTES = 32 << 20
#: Rows put out at once.
OUT_ROWS = 4096


def after_keeping(state: int, initial: int) -> int | None:
    """The state after a row whose role has this initial (a number in INITIALS), if allowed."""
    if initial == 0:
        return 1 if state == 0 else None
    if initial == 1:
        return 2 if state != 2 else None
    return 3 if initial == 2 and state == 2 else None


def step(after: tuple[int, ...], code: int) -> tuple[tuple[int, ...], int]:
    """Costs before a row from those after it, and the row's byte of first letters."""
    initial, fault = code & 3, code >> 2
    extra = TRUNCATED_COST if fault == TRUNCATED else 0
    taken = []
    for state in range(4):
        cost = {DELETE: DELETE_COST + after[state]}
        if fault not in (BLANK, DUPLICATE):
            kept = after_keeping(state, initial)
            if kept is not None:
                cost[KEEP] = extra + after[kept]
            cost[REROLE] = REROLE_COST + extra + after[NEXT[state]]
        taken.append(cost)
    least = [min(cost.values()) for cost in taken]
    # An insertion leads to state 2 or 3; two in a row come back at a cost.
    two, three = min(least[2], INSERT_COST + least[3]), min(least[3], INSERT_COST + least[2])
    before = (min(least[0], INSERT_COST + two), min(least[1], INSERT_COST + two), two, three)
    pointers = 0
    for state, cost in enumerate(taken):
        cost[INSERT] = INSERT_COST + before[NEXT[state]]
        letter = min(edit for edit, c in cost.items() if c == before[state])
        pointers |= letter << 2 * state
    return before, pointers


class Steps(dict):
    """``step`` by (costs less the least of them, code); there are few such pairs."""

    def __missing__(self, key):
        costs, pointers = step(*key)
        low = min(costs)
        self[key] = tuple(c - low for c in costs), low, pointers
        return self[key]


_STEPS = Steps()


class Rows:
    """Pieces of one conversation, written last first and read back in its order."""

    def __init__(self):
        self.held: list = []
        self.held_bytes = 0
        self.file = None
        self.places: list[int] = []

    def add(self, piece, size: int) -> None:
        self.held.append(piece)
        self.held_bytes += size
        if self.held_bytes > HELD_BYTES:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()  # noqa: SIM115
        for piece in self.held:
            self.places.append(self.file.tell())
            pickle.dump(piece, self.file, pickle.HIGHEST_PROTOCOL)
        self.held, self.held_bytes = [], 0

    def back(self) -> Iterator:
        while self.held:
            yield self.held.pop()
        while self.places:
            self.file.seek(self.places.pop())
            yield pickle.load(self.file)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


@dataclass
class Conversation:
    """What is carried over the rows of one conversation, its last row first."""

    key: object
    costs: tuple[int, ...] = AT_END
    base: int = 0
    faults: list[int] = field(default_factory=lambda: [0, 0, 0, 0])
    illegal: int = 0
    later: str | None = None
    highest: int | None = None
    lowest: int | None = None
    turns: int = 0
    rows: Rows = field(default_factory=Rows)

    def take(self, codes: list, turns: list, roles: list, texts: list) -> None:
        pointers = bytearray()
        for code, turn, role in zip(codes, turns, roles, strict=True):
            self.costs, low, byte = _STEPS[self.costs, code]
            self.base += low
            pointers.append(byte)
            self.faults[code >> 2] += 1
            if self.later is not None and role[:1] + self.later not in LEGAL:
                self.illegal += 1
            self.later = role[:1]
            if turn is not None and turn != self.lowest:
                self.turns += 1
                self.lowest = turn
                self.highest = turn if self.highest is None else self.highest
        piece = bytes(pointers), codes, turns, roles, texts
        self.rows.add(piece, sum(map(len, texts)) + 100 * len(texts))

    def gaps(self) -> int:
        if self.highest is None:
            return 0
        return min(self.highest - self.lowest + 1 - self.turns, 2**63 - 1)

    def edits(self) -> Iterator[tuple[str, int | None, str, str]]:
        """(letter, turn, role, text) in the order of the conversation; deleted rows too."""
        state = 0
        for pointers, codes, turns, roles, texts in self.rows.back():
            for i in range(len(pointers) - 1, -1, -1):
                while (letter := pointers[i] >> 2 * state & 3) == INSERT:
                    state = NEXT[state]
                    yield "I", None, ROLE_OF[state], ""
                role = roles[i]
                if letter == KEEP:
                    state = after_keeping(state, codes[i] & 3)
                elif letter == REROLE:
                    state = NEXT[state]
                    role = ROLE_OF[state]
                yield LETTERS[letter], turns[i], role, texts[i]
        while AT_END[state]:
            state = NEXT[state]
            yield "I", None, ROLE_OF[state], ""
        self.rows.close()


def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[Conversation]:
    """Whole conversations of a task's rows, each when its first row has passed."""
    own = None
    for batch in batches:
        keys, codes, turns, roles, texts = (c.to_pylist() for c in batch.columns)
        low = 0
        while low < len(keys):
            high = low + 1
            while high < len(keys) and keys[high] == keys[low]:
                high += 1
            if own is None or own.key != keys[low]:
                if own is not None:
                    yield own
                own = Conversation(keys[low])
            here = [i for i in range(low, high) if codes[i] is not None]
            if here:
                own.take(*([column[i] for i in here] for column in (codes, turns, roles, texts)))
            low = high
    if own is not None:
        yield own


REPORT = {
    "gaps": pa.int64(),
    "blank": pa.int64(),
    "duplicate": pa.int64(),
    "truncated": pa.int64(),
    "illegal": pa.int64(),
    "cost": pa.int64(),
    "audit": pa.string(),
    "repaired_sha256": pa.string(),
}


def report_of(own: Conversation) -> tuple:
    digest, audit, apart = hashlib.sha256(), bytearray(), ""
    for letter, _, role, text in own.edits():
        audit += letter.encode()
        if letter != "D":
            digest.update(f"{apart}{role}:{text}".encode())
            apart = "\n"
    cost = own.base + own.costs[0]
    return own.gaps(), *own.faults[1:], own.illegal, cost, audit.decode(), digest.hexdigest()


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for own in _then_none(conversations(batches)):
        if own is not None:
            held.append((own.key, *report_of(own)))
        if held and (own is None or len(held) >= OUT_ROWS):
            columns = list(zip(*held, strict=True))
            yield [list(columns[0]), *(pa.array(c, t) for c, t in zip(columns[1:], REPORT.values(), strict=True))]
            held = []


def _then_none(items: Iterator) -> Iterator:
    yield from items
    yield None


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    held: list[tuple] = []
    for own in _then_none(conversations(batches)):
        place = 0
        for letter, turn, role, text in own.edits() if own is not None else ():
            if letter == "D":
                continue
            held.append((own.key, place, turn, role, text, letter))
            place += 1
            if len(held) >= OUT_ROWS:
                yield _repaired_columns(held)
                held = []
        if held and own is None:
            yield _repaired_columns(held)


def _repaired_columns(held: list[tuple]) -> list:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
    columns = list(zip(*held, strict=True))
    return [list(columns[0]), *(pa.array(c, t) for c, t in zip(columns[1:], kinds, strict=True))]


def _streamed(work: Callable, names: list[str]):
    """``work`` over a task's batches, its first column in the key's own type."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind: list[pa.DataType] = []

        def seen() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kind[:] = [batch.schema.field(0).type]
                yield batch

        for columns in work(seen()):
            keys = pa.array(columns[0], kind[0])
            yield pa.RecordBatch.from_arrays([keys, *columns[1:]], names)

    return run


def fault_of(text: Column, repeat: Column) -> Column:
    """The first fault of a row, as a number."""
    trimmed = F.rtrim(text, F.lit(SPACE))
    return (
        F.when(trimmed == "", BLANK)
        .when(repeat, DUPLICATE)
        .when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), TRUNCATED)
        .otherwise(SOUND)
    )


def streamable(rows: DataFrame, present: str | None = None) -> DataFrame:
    """conv_id, code, turn, role, text: by conversation, last turn first.

    ``code`` joins the role's initial and the fault; it is null in rows that only say that
    the conversation exists.
    """
    there = F.lit(True) if present is None else F.coalesce(rows[present], F.lit(False))
    plain = rows.select(
        rows["conv_id"],
        F.when(there, rows["turn"].cast("long")).alias("turn"),
        F.when(there, F.coalesce(rows["role"].cast("string"), F.lit(" "))).alias("role"),
        F.when(there, F.coalesce(rows["text"].cast("string"), F.lit(" "))).alias("text"),
    ).repartition("conv_id")
    alike = Window.partitionBy("conv_id", "role", "text").orderBy(F.asc_nulls_first("turn"))
    marked = plain.withColumn("copy", F.row_number().over(alike))
    initial = F.lit(len(INITIALS))
    for number, letter in enumerate(INITIALS):
        initial = F.when(F.col("role").startswith(letter), number).otherwise(initial)
    coded = marked.withColumn(
        "code",
        F.when(F.col("text").isNotNull(), fault_of(F.col("text"), F.col("copy") > 1) * 4 + initial),
    )
    return coded.sortWithinPartitions(
        "conv_id", F.desc_nulls_last("turn"), F.desc("role"), F.desc("text"), F.desc("copy")
    ).select("conv_id", "code", "turn", "role", "text")


def report(rows: DataFrame, present: str | None = None) -> DataFrame:
    """A row per conversation: gaps, faults, illegal neighbours, cost, audit and digest.

    ``present`` names a boolean column; rows where it is not true have been dropped and only
    say that their conversation exists.
    """
    ready = streamable(rows, present)
    kind = ready.schema["conv_id"].dataType.simpleString()
    names = {pa.int64(): "long", pa.string(): "string"}
    schema = ", ".join([f"conv_id {kind}", *(f"{n} {names[t]}" for n, t in REPORT.items())])
    return ready.mapInArrow(_streamed(_report, ["conv_id", *REPORT]), schema)


def repair(rows: DataFrame, present: str | None = None) -> DataFrame:
    """The repaired rows: conv_id, place (from 0), turn (null if inserted), role, text, edit."""
    ready = streamable(rows, present)
    kind = ready.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "place", "turn", "role", "text", "edit"]
    schema = f"conv_id {kind}, place long, turn long, role string, text string, edit string"
    return ready.mapInArrow(_streamed(_repair, names), schema)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows after the damage that the query's contract sets, and ``present``."""
    key = F.concat_ws(
        ":",
        F.coalesce(rows["conv_id"].cast("string"), F.lit(" ")),
        F.coalesce(rows["turn"].cast("string"), F.lit(" ")),
    )
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(rows["text"].cast("string"), F.lit(" "))
    damaged_text = F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(kind == 4, "user").otherwise(F.coalesce(rows["role"].cast("string"), F.lit(" ")))
    once = rows.select(
        rows["conv_id"],
        rows["turn"],
        role.alias("role"),
        damaged_text.alias("text"),
        (kind != 0).alias("present"),
        F.when(kind == 3, 2).otherwise(1).alias("copies"),
    )
    each = F.explode(F.array_repeat(F.lit(0), F.col("copies")))
    return once.select("conv_id", "turn", "role", "text", "present", each.alias("copy")).drop("copy")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(damaged(common.table(spark, sf_dir, "conversations")), "present")
