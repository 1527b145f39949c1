"""Quality rules: text statistics and a learned, ordered decision list.

``statistics`` counts words, symbols, repeated lines and repeated phrases of whole texts.
``learn`` runs sequential covering on labelled statistics: a rule is grown condition by
condition (``statistic <= x`` or ``> x``) by information gain on two thirds of the rows,
pruned from its end on the last third, and kept if it is right on at least nine tenths of the
rows of that third that it covers; these rows then leave. The rows of a rule that is not kept
are set aside, and rules are grown on the others (``TRIES`` in all). The rules are few, bounded and readable, and
``expression`` turns them into one ordered conditional expression that Spark evaluates.

The list is fitted on a bounded sample of labelled rows (``SAMPLE``), chosen by a hash of
doc_id; statistics, verdicts and the rows they hold for cover all documents.

Defined cases: null text counts as empty; a text without words fails the base rules; a
row whose label is null teaches nothing; without labels the list is empty and keeps
what the base rules keep.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.llm import common

#: Labelled rows a list is fitted on, at most.
SAMPLE = 20_000
#: Rules of a list and conditions of a rule, at most; cut points tried per statistic.
RULES, CONDITIONS, CUTS = 12, 3, 64
#: Rules grown for a list, at most, with those that are not kept.
TRIES = 8 * RULES

SYMBOLS = "#*$%&|<>"

_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[list(SYMBOLS.encode())] = 1
_CAPITAL = np.zeros(256, dtype=np.int64)
_CAPITAL[65:91] = 1
_START = np.zeros(256, dtype=np.int64)
_START[:128] = 1
_START[192:] = 1  # first bytes of longer characters

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_distinct")


def _repeated_words(hashes: np.ndarray) -> int:
    """Words inside three-word windows that occur twice or more."""
    if len(hashes) < 4:
        return 0
    grams = common.gram_hashes(hashes, 3)
    order = np.argsort(grams)
    ranked = grams[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(grams), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(hashes), dtype=bool)
    for j in range(3):
        covered[j : j + len(grams)] |= twice
    return int(covered.sum())


def _line_counts(data: np.ndarray, offsets: np.ndarray, words) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and how many of them equal an earlier one, for each row."""
    rows = len(offsets) - 1
    breaks = data == 10
    begins = np.zeros(len(data), dtype=bool)
    begins[1:] = breaks[:-1]
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    begins &= ~breaks  # an empty line has no word
    starts = np.flatnonzero(begins)
    stops = np.flatnonzero(breaks)
    row = np.searchsorted(offsets, starts, "right") - 1
    stop = np.append(stops, len(data))[np.searchsorted(stops, starts)]
    ends = np.minimum(stop, offsets[row + 1])
    worded = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends, row = starts[worded], ends[worded], row[worded]
    code = common.word_hashes(data, common.Words(starts, ends, np.zeros(0)))
    order = np.lexsort((code, row))
    code, row = code[order], row[order]
    again = (code[1:] == code[:-1]) & (row[1:] == row[:-1])
    return np.bincount(row, minlength=rows), np.bincount(row[1:][again], minlength=rows)


def count_slice(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each row of a slice of texts."""
    words = common.split_words(data, offsets, common.SPACED)
    hashes = common.word_hashes(data, words)
    rows = len(offsets) - 1

    def per_row(table: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(table[data], out=sums[1:])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    spaces = np.zeros(256, dtype=np.int64)
    spaces[~common.SPACED] = 1
    lines, again = _line_counts(data, offsets, words)
    own = [hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
    return {
        "n_words": words.counts().astype(np.int64),
        "word_chars": per_row(_START) - per_row(spaces),
        "n_symbols": per_row(_SYMBOL),
        "n_dup_lines": again,
        "n_repeat_words": np.array([_repeated_words(h) for h in own], dtype=np.int64).reshape(rows),
        "n_lines": lines,
        "n_capitals": per_row(_CAPITAL),
        "n_distinct": np.array([len(np.unique(h)) for h in own], dtype=np.int64).reshape(rows),
    }


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, data, offsets in common.text_slices(batch.column(1), lower=False):
            counts = count_slice(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, len(offsets) - 1), *[pa.array(counts[c]) for c in COUNTS]],
                ["doc_id", *COUNTS],
            )


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of every row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        _count_rows, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS)
    )


def ratios(column=F.col) -> dict[str, Column]:
    """The statistics that conditions look at."""
    words = F.greatest(column("n_words"), F.lit(1))
    return {
        "n_words": column("n_words").cast("double"),
        "word_length": column("word_chars") / words,
        "symbols_per_word": column("n_symbols") / words,
        "dup_line_share": column("n_dup_lines") / F.greatest(column("n_lines"), F.lit(1)),
        "repeat_word_share": column("n_repeat_words") / words,
        "distinct_word_share": column("n_distinct") / words,
        "words_per_line": column("n_words") / F.greatest(column("n_lines"), F.lit(1)),
        "capital_share": column("n_capitals") / F.greatest(column("word_chars"), F.lit(1)),
    }


FEATURES = (
    "n_words",
    "word_length",
    "symbols_per_word",
    "dup_line_share",
    "repeat_word_share",
    "distinct_word_share",
    "words_per_line",
    "capital_share",
)


@dataclass(frozen=True)
class Rule:
    """All conditions hold: the label is ``label``. A condition is (statistic, '<=' or '>', value)."""

    conditions: tuple[tuple[str, str, float], ...]
    label: int

    def covers(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), dtype=bool)
        for name, sign, value in self.conditions:
            out &= x[name] <= value if sign == "<=" else x[name] > value
        return out

    def condition(self) -> Column:
        out = F.lit(True)
        for name, sign, value in self.conditions:
            out = out & (F.col(name) <= value if sign == "<=" else F.col(name) > value)
        return out


def _gain(good: np.ndarray, bad: np.ndarray, p: int, n: int) -> np.ndarray:
    """Information gained on the covered positives (the measure of rule growing)."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(good > 0, good * (np.log2(good / (good + bad)) - np.log2(p / (p + n))), -np.inf)


def _grow(x: dict[str, np.ndarray], target: np.ndarray) -> list[tuple[str, str, float]]:
    chosen: list[tuple[str, str, float]] = []
    inside = np.ones(len(target), dtype=bool)
    while len(chosen) < CONDITIONS:
        p, n = int((inside & target).sum()), int((inside & ~target).sum())
        if not p or not n:
            break
        best = (0.0, None)
        for name in FEATURES:
            values = x[name]
            cuts = np.unique(np.quantile(values[inside], np.linspace(0, 1, CUTS + 2)[1:-1]))
            order = np.sort(values[inside & target]), np.sort(values[inside & ~target])
            low = [np.searchsorted(v, cuts, "right") for v in order]
            for sign, (good, bad) in (("<=", low), (">", [p - low[0], n - low[1]])):
                gain = _gain(good, bad, p, n)
                at = int(np.argmax(gain))
                if gain[at] > best[0] + 1e-9:
                    best = (float(gain[at]), (name, sign, float(cuts[at])))
        if best[1] is None:
            break
        chosen.append(best[1])
        inside = Rule(tuple(chosen), 0).covers(x)
    return chosen


def _prune(rule: list, x: dict[str, np.ndarray], target: np.ndarray) -> tuple[tuple, float]:
    """The prefix of ``rule`` that is most often right on the pruning rows, and how often
    (with one row more on either side, so that few rows prove little)."""
    best: tuple[tuple, float] = ((), 0.0)
    for size in range(1, len(rule) + 1):
        inside = Rule(tuple(rule[:size]), 0).covers(x)
        if inside.sum():
            right = (float((inside & target).sum()) + 1) / (float(inside.sum()) + 2)
            if right > best[1] + 1e-9:
                best = (tuple(rule[:size]), right)
    return best


def learn(x: dict[str, np.ndarray], quality: np.ndarray, fold: np.ndarray, least_right: float = 0.9) -> list[Rule]:
    """Rules that reject low quality, in order; whatever none covers is kept.

    ``fold`` deals the rows: 0 and 1 grow, 2 prunes. A rule must be right on
    ``least_right`` of the pruning rows that it covers and no earlier rule does. Rows set
    aside take no part in growing, but they count in pruning.
    """
    rules: list[Rule] = []
    left = np.ones(len(quality), dtype=bool)
    aside = np.zeros(len(quality), dtype=bool)
    bad = quality == 0
    for _ in range(TRIES):
        grow, prune = left & ~aside & (fold < 2), left & (fold == 2)
        if len(rules) == RULES:
            break
        if not (bad & grow).any():
            break
        grown = _grow({k: v[grow] for k, v in x.items()}, bad[grow])
        if not grown:
            break
        conditions, right = _prune(grown, {k: v[prune] for k, v in x.items()}, bad[prune])
        if not conditions or right < least_right:
            aside |= Rule(tuple(grown), 0).covers(x)
            continue
        rules.append(Rule(conditions, 0))
        left &= ~rules[-1].covers(x)
    return rules


def expression(rules: list[Rule], default: int = 1) -> Column:
    """The rules as one ordered conditional expression over the statistics."""
    if not rules:
        return F.lit(default)
    out = F.when(rules[0].condition(), F.lit(rules[0].label))
    for rule in rules[1:]:
        out = out.when(rule.condition(), F.lit(rule.label))
    return out.otherwise(F.lit(default))


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> list[Rule]:
    chosen = common.labelled_ids(labels, size)
    counted = statistics(common.of_ids(docs, chosen))
    shares = counted.select("doc_id", *[c.alias(k) for k, c in ratios().items()]).toPandas()
    rows = shares.merge(chosen, on="doc_id").sort_values("doc_id")
    fold = common.mix(rows["doc_id"].to_numpy().astype(np.uint64)) % np.uint64(3)
    return learn({k: rows[k].to_numpy(float) for k in FEATURES}, rows["quality"].to_numpy(), fold.astype(int))


def verdicts(counts: DataFrame, rules: list[Rule]) -> DataFrame:
    """``counts`` with base_failed, the learned verdict and kept."""
    shares = {f"_{k}": c for k, c in ratios().items()}
    named = counts.withColumns(shares)
    renamed = [Rule(tuple((f"_{n}", s, v) for n, s, v in r.conditions), r.label) for r in rules]
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        named.withColumn("base_failed", failed)
        .withColumn("learned", expression(renamed))
        .withColumn("kept", ~F.col("base_failed") & (F.col("learned") == 1))
        .drop(*shares)
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    rules = fit(docs, common.table(spark, sf_dir, "labels"))
    return verdicts(statistics(docs), rules).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )
