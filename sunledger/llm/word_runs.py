"""Periodic runs of words, found with suffix trees, and texts with their repeats collapsed.

A run is a stretch of words that repeats its first ``period`` words, at least ``TIMES`` times
and ``LEAST_WORDS`` words long, and that cannot grow to either side.

The words of a text become numbers, and Ukkonen's construction builds the suffix trees of the
sequence and of its reversal. A tour of a tree gives the suffixes in order and, between two
neighbours, the depth at which the tour turned; a table of minima over these depths gives the
lowest common ancestor of two leaves, and with it the longest common extension of two places,
in constant time, forwards from the one tree and backwards from the other. Every run holds a
Lyndon word that is the longest one to start where it does, in the order of the numbers or in
the opposite order; these words are the candidates, each is extended to both sides, and those
that extend far enough are the runs. All of this is linear in the words but for the table.

Trees are built only over stretches that can hold a run: each window of ``WINDOW`` words
inside a run occurs twice there, no farther apart than a quarter of the run, so the windows
of a whole batch are hashed and compared first. A collision of hashes only adds a stretch.

Defined cases: null text counts as empty and has no words, no run and empty digests; so does
text of white space alone; repeated rows and a null doc_id are taken row by row; an empty
table gives no rows; other columns, whatever their names, are not read. A very long text is
read whole by one task, which takes about 700 bytes a word of a stretch that may hold a run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.llm import common

LEAST_WORDS = 6
TIMES = 4
#: A run of w words and period q has w - 4 windows of five words, at least two for each of
#: the q places of its period: w >= 6 where q is 1, and w >= 4 q where q is 2 or more.
WINDOW = 5

Run = tuple[int, int, int]  # start, length, period


# ---- suffix trees -------------------------------------------------------------------


class SuffixTree:
    """Ukkonen's suffix tree of numbers; the last number must occur nowhere else."""

    def __init__(self, symbols: list[int]):
        self.size = len(symbols)
        # An edge leads to a node and carries symbols[start:end]; a leaf's end stays open.
        self.start, self.end, self.child = [0], [0], [{}]
        self.leaf_of = [-1]
        self._build(symbols)

    def _node(self, start: int, end: int, child: dict | None, leaf: int) -> int:
        self.start.append(start)
        self.end.append(end)
        self.child.append(child)
        self.leaf_of.append(leaf)
        return len(self.start) - 1

    def _build(self, symbols: list[int]) -> None:
        start, end, child = self.start, self.end, self.child
        link = {0: 0}
        node = edge = length = leaves = 0
        for i, symbol in enumerate(symbols):
            fresh = 0
            while leaves <= i:
                if not length:
                    edge = i
                below = child[node].get(symbols[edge])
                if below is None:
                    child[node][symbols[edge]] = self._node(i, self.size, None, leaves)
                    if fresh:
                        link[fresh] = node
                    fresh = 0
                else:
                    span = min(end[below], i + 1) - start[below]
                    if length >= span:
                        node, edge, length = below, edge + span, length - span
                        continue
                    if symbols[start[below] + length] == symbol:
                        length += 1
                        if fresh:
                            link[fresh] = node
                        break
                    middle = start[below] + length
                    split = self._node(start[below], middle, {}, -1)
                    child[node][symbols[edge]] = split
                    child[split][symbol] = self._node(i, self.size, None, leaves)
                    child[split][symbols[middle]] = below
                    start[below] = middle
                    if fresh:
                        link[fresh] = split
                    fresh = split
                leaves += 1
                if node:
                    node = link.get(node, 0)
                elif length:
                    length -= 1
                    edge = leaves

    def tour(self, descending: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in order, and the depth of the turn before each.

        The last symbol sorts first in both orders, as the end of a text does.
        """
        order, turns = np.empty(self.size, np.int64), np.zeros(self.size, np.int32)
        start, end, child, leaf_of = self.start, self.end, self.child, self.leaf_of
        at, stack = 0, [(0, 0, 0)]
        while stack:
            node, above, turn = stack.pop()
            below = child[node]
            if below is None:
                order[at], turns[at] = leaf_of[node], turn
                at += 1
                continue
            depth = above + end[node] - start[node]
            # The stack gives the least child first, which turns where its parent did.
            keys = sorted(below, reverse=not descending)
            if descending and keys[0] == 0:
                keys.append(keys.pop(0))
            stack.extend((below[k], depth, depth) for k in keys[:-1])
            stack.append((below[keys[-1]], depth, turn))
        return order, turns


class Extensions:
    """Longest common extensions of pairs of places, from a tour and its table of minima."""

    def __init__(self, order: np.ndarray, turns: np.ndarray):
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.arange(len(order))
        self.least = [turns]
        width = 1
        while 2 * width <= len(turns):
            last = self.least[-1]
            self.least.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def of(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Of different places x and y, which are below the number of symbols."""
        low, high = np.minimum(self.rank[x], self.rank[y]) + 1, np.maximum(self.rank[x], self.rank[y])
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            here = level == k
            table = self.least[k]
            out[here] = np.minimum(table[low[here]], table[high[here] - (1 << int(k)) + 1])
        return out


def next_smaller(rank: list[int]) -> list[int]:
    """For each place the next one with a smaller suffix: the end of its longest Lyndon word."""
    size = len(rank)
    out = [size] * size
    for i in range(size - 2, -1, -1):
        j, own = i + 1, rank[i]
        while j < size and rank[j] > own:
            j = out[j]
        out[i] = j
    return out


def find_runs(numbers: list[int]) -> list[Run]:
    """All runs of a sequence of positive numbers, by start, then period."""
    size = len(numbers)
    if size < LEAST_WORDS:
        return []
    tree = SuffixTree([*numbers, 0])
    order, turns = tree.tour()
    forward = Extensions(order, turns)
    other = np.empty(size + 1, np.int64)
    other[tree.tour(descending=True)[0]] = np.arange(size + 1)
    del tree
    backward = Extensions(*SuffixTree([*reversed(numbers), 0]).tour())

    low = np.tile(np.arange(size), 2)
    high = np.array(next_smaller(forward.rank[:size].tolist()) + next_smaller(other[:size].tolist()))
    fits = TIMES * (high - low) <= size
    low, high = low[fits], high[fits]
    # Place size is the end: nothing extends from it.
    after = forward.of(low, high)
    before = backward.of(size - low, size - high)
    period, start = high - low, low - before
    length = high + after - start
    long = length >= np.maximum(LEAST_WORDS, TIMES * period)
    found = np.unique(np.stack([start[long], period[long], length[long]], 1), axis=0)
    return [(s, w, q) for s, q, w in found.tolist()]


# ---- stretches of a batch ------------------------------------------------------------


def candidates(hashes: np.ndarray, row_of: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of words, each in one row, outside of which no run lies."""
    grams = common.gram_hashes(hashes, WINDOW)
    count = len(grams)
    if not count:
        return []
    one_row = row_of[:count] == row_of[WINDOW - 1 :]
    with np.errstate(over="ignore"):
        keys = grams ^ common.mix(row_of[:count].astype(np.uint64) + np.uint64(1))
    order = np.argsort(keys, kind="stable")
    order = order[one_row[order]]
    alike = keys[order[1:]] == keys[order[:-1]]
    apart = np.where(alike, order[1:] - order[:-1], count + 1)
    nearest = np.full(count, count + 1, np.int64)
    nearest[order[1:]] = apart
    nearest[order[:-1]] = np.minimum(nearest[order[:-1]], apart)
    may = nearest <= count
    while True:
        edges = np.flatnonzero(np.diff(np.concatenate([[False], may, [False]]).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        words = ends - starts + WINDOW - 1
        # A run of such a stretch has a period of at most a quarter of its words.
        bound = np.repeat(np.where(words >= LEAST_WORDS, words // TIMES, 0), ends - starts)
        places = np.flatnonzero(may)
        far = nearest[places] > bound
        if not far.any():
            return list(zip(starts.tolist(), (starts + words).tolist(), strict=True))
        may[places[far]] = False


def runs_of_rows(data: np.ndarray, offsets: np.ndarray) -> dict[int, list[Run]]:
    """Runs of those rows that have one, of texts that follow one another in ``data``."""
    words = common.split_words(data, offsets, common.SPACED)
    row_of = np.repeat(np.arange(len(offsets) - 1), words.counts())
    found: dict[int, list[Run]] = {}
    for low, high in candidates(common.word_hashes(data, words), row_of):
        number: dict[bytes, int] = {}
        numbers = [
            number.setdefault(data[a:b].tobytes(), len(number) + 1)
            for a, b in zip(words.starts[low:high].tolist(), words.ends[low:high].tolist(), strict=True)
        ]
        row = int(row_of[low])
        first = low - int(words.first[row])
        found.setdefault(row, []).extend((first + s, w, q) for s, w, q in find_runs(numbers))
    for runs in found.values():
        runs.sort(key=lambda run: (run[0], run[2]))
    return {row: runs for row, runs in found.items() if runs}


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """Words that no run holds after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    gone = np.cumsum(change[:-1]) > 0
    return [word for word, drop in zip(words, gone.tolist(), strict=True) if not drop]


def greatest(runs: list[Run]) -> Run | None:
    """The run with the greatest exact exponent; of equals the first, then the shortest period."""
    return min(runs, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2]), default=None)


_BEST = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
_DIGESTS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def _digests(runs: list[list[Run]], texts: list[bytes]) -> list[pa.Array]:
    best = [greatest(own) for own in runs]
    lines = ["".join(f"{s},{w},{q}\n" for s, w, q in own) for own in runs]
    return [
        pa.array([len(own) for own in runs], pa.int64()),
        *(pa.array([b and b[i] for b in best], pa.int64()) for i in range(3)),
        pa.array([b and 1000 * b[1] // b[2] for b in best], pa.int64()),
        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in lines]),
        pa.array([hashlib.sha256(x).hexdigest() for x in texts]),
    ]


def _outputs(runs: list[list[Run]], texts: list[bytes]) -> list[pa.Array]:
    as_rows = [[dict(zip(("start", "length", "period"), run, strict=True)) for run in own] for own in runs]
    return [pa.array(as_rows, pa.list_(_BEST)), pa.array([x.decode() for x in texts], pa.string())]


def _finder(digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, data, offsets in common.text_slices(batch.column(1), lower=False):
                found = runs_of_rows(data, offsets)
                count = len(offsets) - 1
                runs = [found.get(i, []) for i in range(count)]
                texts = []
                for i in range(count):
                    words = data[offsets[i] : offsets[i + 1]].tobytes().split()
                    texts.append(b" ".join(collapsed(words, runs[i]) if runs[i] else words))
                last = _digests(runs, texts) if digests else _outputs(runs, texts)
                names = _DIGESTS if digests else ("runs", "collapsed")
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, count), *last], ["doc_id", *names])

    return run


def periodic_runs(docs: DataFrame, digests: bool = False) -> DataFrame:
    """doc_id, runs and the collapsed text of every row.

    With ``digests``: the number of runs, the one with the greatest exponent, and digests of
    all runs and of the collapsed text, taken in the task.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    last = "runs array<struct<start: long, length: long, period: long>>, collapsed string"
    if digests:
        last = ", ".join(f"{n} {'string' if n.endswith('256') else 'long'}" for n in _DIGESTS)
    rows = docs.select(docs["doc_id"], docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(_finder(digests), f"doc_id {kind}, {last}")


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text, in which a tenth of the texts end in a repeat, as the contract sets."""
    number = F.crc32(docs["doc_id"].cast("string").cast("binary"))
    split = docs.select(
        docs["doc_id"],
        docs["text"].cast("string").alias("text"),
        F.when(number % 10 == 0, F.floor(number / 10)).alias("seed"),
    ).withColumn(
        "words",
        F.when(F.col("seed").isNotNull(), F.regexp_extract_all("text", F.lit("([^\\x20\\x09-\\x0D]+)"), F.lit(1))),
    )
    words, seed, size = F.col("words"), F.col("seed"), F.greatest(F.size("words"), F.lit(1))
    kept = seed % size
    period = 1 + F.floor((size - kept) / (3 + seed % 8))
    placed = split.withColumns({"kept": kept.cast("int"), "period": period.cast("int"), "size": size})
    rest = F.col("size") - F.col("kept")
    times = F.ceil(rest / F.col("period")).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, F.col("kept") + 1, F.col("period")), times))
    text = F.array_join(F.concat(F.slice(words, F.lit(1), F.col("kept")), F.slice(again, F.lit(1), rest)), " ")
    return placed.select("doc_id", F.when(F.size(words) > 0, text).otherwise(F.col("text")).alias("text"))


def op12_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(with_repeats(common.table(spark, sf_dir, "documents")), digests=True)
