"""Periodic runs against a plain search over all periods."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from sunledger.llm import common, word_runs

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"
WORD = re.compile("[^\x20\x09-\x0d]+")
COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def brute_runs(words):
    """For each period the maximal stretches of equal words so far apart."""
    size, out, numbers = len(words), [], np.unique(words, return_inverse=True)[1] if words else []
    for q in range(1, size // 4 + 1):
        same = np.concatenate([[False], numbers[q:] == numbers[:-q], [False]])
        edges = np.flatnonzero(np.diff(same.astype(np.int8)))
        for low, high in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            length = high - low + q
            own = words[low : low + length]
            if length >= max(6, 4 * q) and not any(own[d:] == own[:-d] for d in range(1, q)):
                out.append((low, length, q))
    return sorted(out, key=lambda run: (run[0], run[2]))


def brute_damage(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def brute_row(words):
    runs = brute_runs(words)
    gone = {i for s, w, q in runs for i in range(s + q, s + w)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    lines = "".join(f"{s},{w},{q}\n" for s, w, q in runs)
    kept = " ".join(x for i, x in enumerate(words) if i not in gone)
    return (
        len(runs),
        *(best or (None, None, None)),
        best and 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(kept.encode()).hexdigest(),
    )


def rows_of(frame):
    return sorted(tuple(r) for r in frame.select(F.col("doc_id").cast("string"), *COLUMNS).na.fill("none", ["doc_id"]).na.fill(-1).collect())


def wanted(rows):
    out = [(("none" if d is None else str(d)), *brute_row(words)) for d, words in rows]
    return sorted(tuple(-1 if x is None else x for x in row) for row in out)


def test_query_against_brute_force(spark):
    rows = common.table(spark, SF_DIR, "documents").select("doc_id", "text").collect()
    want = wanted((r.doc_id, brute_damage(r.doc_id, WORD.findall(r.text or ""))) for r in rows)
    assert rows_of(word_runs.op12_word_runs(spark, SF_DIR)) == want
    assert sum(row[1] > 0 for row in want) > 5


def mixed_words(r, length, kinds):
    words = [r.choice("abcdefgh"[:kinds]) for _ in range(r.randint(0, length))]
    for _ in range(r.randint(0, 3)):
        root = [r.choice("abcdefgh"[:kinds]) for _ in range(r.randint(1, 6))]
        at, times = r.randint(0, len(words)), r.randint(2, 7)
        words[at:at] = (root * times)[: len(root) * times - r.randint(0, len(root) - 1)]
    return words


def test_runs_of_random_words():
    r = random.Random(2)
    for _ in range(3000):
        words = mixed_words(r, 50, r.choice((1, 2, 2, 3, 8)))
        numbers = [ord(w) for w in words]
        assert word_runs.find_runs(numbers) == brute_runs(words), words


def test_trees_give_common_extensions():
    r = random.Random(3)
    for kinds in (1, 2, 5):
        text = [r.randint(1, kinds) for _ in range(120)]
        tree = word_runs.SuffixTree([*text, 0])
        for descending in (False, True):
            order, _ = tree.tour(descending)
            sign = -1 if descending else 1
            assert order.tolist() == sorted(range(121), key=lambda i: [sign * x for x in text[i:]])
        extensions = word_runs.Extensions(*tree.tour())
        x, y = np.array([(i, j) for i in range(121) for j in range(121) if i != j]).T
        got = extensions.of(x, y)
        for i, j, n in zip(x.tolist(), y.tolist(), got.tolist(), strict=True):
            tail, other = text[i:], text[j:]
            same = next((k for k, (a, b) in enumerate(zip(tail, other, strict=False)) if a != b), min(len(tail), len(other)))
            assert n == same


def test_no_run_lies_outside_the_candidates():
    """Whole batches of texts, cut by the windows' hashes first."""
    r = random.Random(4)
    for _ in range(60):
        texts = [" ".join(mixed_words(r, 80, r.choice((1, 2, 3, 8)))) for _ in range(20)]
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        offsets = np.cumsum([0, *map(len, texts)])
        want = {i: runs for i, t in enumerate(texts) if (runs := brute_runs(WORD.findall(t)))}
        assert word_runs.runs_of_rows(data, offsets) == want


def test_colliding_hashes_change_nothing(monkeypatch):
    monkeypatch.setattr(common, "gram_hashes", lambda hashes, width: np.zeros(max(0, len(hashes) - width + 1), np.uint64))
    text = "x y a b a b a b a b a z q r s t u v"
    data = np.frombuffer(text.encode(), np.uint8)
    assert word_runs.runs_of_rows(data, np.array([0, len(text)])) == {0: [(2, 9, 2)]}


def test_equal_exponents():
    assert word_runs.greatest([(9, 8, 2), (3, 12, 3), (3, 4, 1)]) == (3, 4, 1)
    assert word_runs.greatest([(0, 9, 2), (20, 13, 3)]) == (0, 9, 2)
    assert word_runs.greatest([]) is None


def test_outputs(spark):
    frame = spark.createDataFrame([(1, "go\tto to  to to to to\nend A B A B A B A B")], SCHEMA)
    row = word_runs.periodic_runs(frame).collect()[0]
    assert [tuple(x) for x in row.runs] == [(1, 6, 1), (8, 8, 2)]
    assert row.collapsed == "go to end A B"


@pytest.mark.parametrize("parts", [1, 5])
def test_defined_cases(spark, parts):
    long = " ".join(f"w{i}" for i in range(60_000)) + " é" * 70_000 + " a b c" * 20_000
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "a " * 6), (4, "a " * 5), (5, "b b"), (5, "b " * 9), (5, "b " * 9)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    want = wanted((d, WORD.findall(t or "")) for d, t in rows)
    assert rows_of(word_runs.periodic_runs(frame, digests=True)) == want
    clash = frame.select("*", F.lit(1).alias("runs"), F.lit(2).alias("period"), F.lit("x").alias("words"), F.lit(3).alias("seed"))
    assert rows_of(word_runs.periodic_runs(clash, digests=True)) == want
    empty = spark.createDataFrame([], SCHEMA)
    assert word_runs.periodic_runs(word_runs.with_repeats(empty), digests=True).collect() == []
    found = word_runs.periodic_runs(spark.createDataFrame([(9, long)], SCHEMA)).collect()[0]
    assert [tuple(x) for x in found.runs] == [(60_000, 70_000, 1), (130_000, 60_000, 3)]


def test_damage(spark):
    r = random.Random(6)
    rows = [(i, " ".join(mixed_words(r, 30, 8)) + r.choice(("", " \n"))) for i in range(300)]
    rows += [(None, "x y z"), (7, None), (20, "")]
    got = word_runs.with_repeats(spark.createDataFrame(rows, SCHEMA)).collect()
    plain = lambda pairs: sorted((str(d), WORD.findall(t or "")) for d, t in pairs)
    want = [(d, " ".join(brute_damage(d, WORD.findall(t or "")))) for d, t in rows if d is not None]
    assert plain(got) == plain([*want, (None, "x y z")])
    assert sum(a != b for a, b in zip(plain(got), plain(rows), strict=True)) > 5
