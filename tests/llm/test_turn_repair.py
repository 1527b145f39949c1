"""Repair of conversation structure against plain enumeration."""

from __future__ import annotations

import functools
import hashlib
import itertools
import random
import re
import sys
import zlib

import pytest
from pyspark.sql import functions as F

from sunledger.llm import common, turn_repair

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
SHAPE = re.compile("(s?(ua)+)?")
WORD = re.compile("[^\x20\x09-\x0d]")


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        said = WORD.findall(text)
        if not said:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if said[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """(cost, audit, rows) by memo over rows left, the last initial, and insertions in a row."""
    may_follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    @functools.cache
    def best(i, last, inserted):
        options = [(0, "", ())] if i == len(rows) and last in ("", "a") else []

        def add(letter, price, given, i, last, inserted=0):
            cost, audit, tail = best(i, last, inserted)
            options.append((cost + price, letter + audit, given + tail))

        for role in ("user", "assistant"):
            if inserted < 2 and role[0] in may_follow[last]:
                add("I", 2, ((role, ""),), i, role[0], inserted + 1)
        if i < len(rows):
            role, text = rows[i][2:]
            add("D", 3, (), i + 1, last)
            if faults[i] not in ("blank", "duplicate"):
                for letter, price, to in (("K", 0, role), ("R", 2, "user"), ("R", 2, "assistant")):
                    if to and to[0] in may_follow[last]:
                        add(letter, price + (faults[i] == "truncated"), ((to, text),), i + 1, to[0])
        return min(options) if options else (10**6, "", ())

    sys.setrecursionlimit(20_000)
    return best(0, "", 0)


def brute_report(rows, convs):
    out = {}
    for conv in convs:
        own = [r for r in rows if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        faults = faults_of(own)
        cost, audit, kept = cheapest(own, faults)
        turns = {r[1] for r in own} - {None}
        legal = ("su", "ua", "au")
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a[2][:1] + b[2][:1] not in legal for a, b in itertools.pairwise(own)),
            cost,
            audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest(),
        )
    return out


def reports(frame):
    return {r[0]: tuple(r)[1:] for r in frame.collect()}


def random_rows(seed, convs, longest=9):
    r = random.Random(seed)
    out = []
    for conv in range(convs):
        turn = 0
        for _ in range(r.randint(0, longest)):
            turn += r.choice((0, 1, 1, 1, 3))
            role = r.choice(("system", "user", "assistant", "user", "assistant", "tool", "", "saga", "ux"))
            text = r.choice(("Yes.", "Yes.", "No!", "why ", "why? ", "", " \t", "é", "a.b"))
            out.append((conv, turn, role, text))
    return out


def exhaustive(rows, faults, longest):
    """The least (cost, audit) over all edit sequences of at most ``longest`` letters."""
    found = []

    def go(i, given, cost, audit):
        if i == len(rows) and SHAPE.fullmatch(given):
            found.append((cost, audit))
        if len(audit) == longest:
            return
        for role in "ua":
            go(i, given + role, cost + 2, audit + "I")
        if i < len(rows):
            go(i + 1, given, cost + 3, audit + "D")
            if faults[i] not in ("blank", "duplicate"):
                extra = faults[i] == "truncated"
                go(i + 1, given + (rows[i][2][:1] or "?"), cost + extra, audit + "K")
                for role in "ua":
                    go(i + 1, given + role, cost + 2 + extra, audit + "R")

    go(0, "", 0, "")
    return min(found)


def test_costs_against_every_edit_sequence():
    for conv in range(60):
        rows = [r for r in random_rows(conv, 1, 4)][:3]
        faults = faults_of(rows)
        assert cheapest(rows, faults)[:2] == exhaustive(rows, faults, 6)


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in common.table(spark, SF_DIR, "conversations").select("conv_id", "turn", "role", "text").collect()]
    want = brute_report(brute_damage(rows), {r[0] for r in rows})
    got = reports(turn_repair.op11_turn_repair(spark, SF_DIR))
    assert got == want
    assert any(sum(v[1:5]) for v in got.values())


@pytest.mark.parametrize("held", [32 << 20, 200])
def test_report_against_brute_force(spark, monkeypatch, held):
    monkeypatch.setattr(turn_repair, "HELD_BYTES", held)
    rows = random_rows(7, 300)
    frame = spark.createDataFrame(rows, SCHEMA)
    assert reports(turn_repair.report(frame)) == brute_report(rows, {r[0] for r in rows})


def test_state_is_carried_across_batches_and_files(spark):
    """One conversation over many batches, in a task and straight through its pieces."""
    rows = [(1, t, r, f"{x}.") for t, r, x in ((i, "user" if i % 3 else "assistant", i % 500) for i in range(900))]
    want = brute_report(rows[:0], {1})
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = reports(turn_repair.report(spark.createDataFrame(rows, SCHEMA)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    whole = reports(turn_repair.report(spark.createDataFrame(rows, SCHEMA)))
    assert got == whole and got != want
    assert len(got[1][6].replace("I", "")) == 900


def test_spilled_rows_come_back_in_order(monkeypatch):
    monkeypatch.setattr(turn_repair, "HELD_BYTES", 1000)
    small = turn_repair.Conversation(1)
    roles = ["user", "assistant"] * 500
    for i in range(999, -1, -1):
        code = turn_repair.INITIALS.index(roles[i][0])
        small.take([code], [i], [roles[i]], [f"{i}."])
    assert small.rows.file is not None and small.rows.held_bytes <= 1000
    assert [(e, t, x) for e, t, _, x in small.edits()] == [("K", i, f"{i}.") for i in range(1000)]
    assert small.gaps() == 0 and small.base + small.costs[0] == 0


def test_repaired_rows_fit_the_pattern(spark):
    rows = random_rows(11, 200)
    frame = spark.createDataFrame(rows, SCHEMA)
    given = turn_repair.repair(frame).orderBy("conv_id", "place").collect()
    texts = reports(turn_repair.report(frame))
    by_conv = {c: list(g) for c, g in itertools.groupby(given, key=lambda r: r.conv_id)}
    for conv, kept in by_conv.items():
        assert SHAPE.fullmatch("".join(r.role[:1] for r in kept))
        assert [r.place for r in kept] == list(range(len(kept)))
        joined = "\n".join(f"{r.role}:{r.text}" for r in kept)
        assert hashlib.sha256(joined.encode()).hexdigest() == texts[conv][7]
        assert "".join(r.edit for r in kept) == texts[conv][6].replace("D", "")


def test_defined_cases(spark):
    rows = [
        (None, 1, "user", "a."),
        (None, 2, "assistant", "b."),
        (1, None, None, None),
        (1, None, "user", "x."),
        (2, 5, "user", "same."),
        (2, 5, "user", "same."),
        (2, 5, "assistant", "ok."),
        (3, 1, "user", "w. " * 400_000),
        (3, 9, "assistant", "end"),
        (4, 1, "user", ""),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    want = brute_report(plain, {r[0] for r in rows})
    assert reports(turn_repair.report(frame)) == want
    extra = frame.select("*", F.lit(1).alias("code"), F.lit(2).alias("copy"), F.lit(3).alias("audit"))
    assert reports(turn_repair.report(extra)) == want
    assert reports(turn_repair.report(frame.repartition(7))) == want
    # A conversation all of whose rows are gone is still there.
    gone = turn_repair.report(frame.withColumn("present", F.col("conv_id") != 4), "present")
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert reports(gone)[4] == empty
    assert turn_repair.report(spark.createDataFrame([], SCHEMA)).collect() == []
    assert turn_repair.repair(spark.createDataFrame([], SCHEMA)).collect() == []


def test_damage(spark):
    rows = [(c, t, r, x) for c in (None, 1, 2, 3) for t in (None, *range(40)) for r, x in [("assistant", "Hi. A? B!")]]
    rows += [(9, t, None, None) for t in range(40)]
    got = turn_repair.damaged(spark.createDataFrame(rows, SCHEMA))
    key = lambda r: tuple((x is not None, x) for x in r)
    left = sorted((tuple(r)[:4] for r in got.where("present").collect()), key=key)
    assert left == sorted(brute_damage(rows), key=key)
    assert {r.conv_id for r in got.collect()} == {r[0] for r in rows}


def test_no_second_shuffle(spark):
    frame = spark.createDataFrame(random_rows(3, 20), SCHEMA)
    plan = turn_repair.report(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
