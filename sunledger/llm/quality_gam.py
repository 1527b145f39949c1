"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into bins at quantiles of the training sample. Boosting goes round
the features again and again; on each it fits a shallow tree (two cuts, so three leaves)
to the gradient summed per bin and adds a small step to the feature's lookup table. When
the tables have settled, the pairs of features whose joint bins explain most of what is
left get two-dimensional tables, boosted in the same cyclic way with one cut per axis.
Bagging over parts of the sample smooths the tables. A score is the logistic function of
an intercept plus one table entry per feature and pair, looked up for whole batches.

The model is fitted on a bounded sample of labelled rows (``SAMPLE``), chosen by a hash of
doc_id among the rows that are not held out; it never sees doc_id, lang, source or any
label as an input. Every document is scored, on its whole text.

Defined cases: null text counts as empty and gets the score of its counts; repeated rows
get equal scores; without labels the score is 0.5 for all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.llm import common

#: Labelled rows the model is fitted on, at most.
SAMPLE = 20_000
BINS, ROUNDS, PAIR_ROUNDS, PAIRS, BAGS, STEP = 32, 120, 40, 6, 4, 0.15
#: Rows a leaf must hold, and the penalty on a leaf's size.
LEAF, RIDGE = 8, 4.0
ACCEPT = 0.7

FEATURES = (
    "log_words",
    "word_length",
    "word_length_spread",
    "distinct_share",
    "repeat_next_share",
    "repeat_gram_share",
    "top_word_share",
    "capital_share",
    "capital_word_share",
    "digit_share",
    "symbol_share",
    "pipe_share",
    "exclaim_share",
    "mark_share",
    "stop_share",
    "short_word_share",
    "words_per_line",
    "dup_line_share",
    "non_ascii_share",
)


def _classes() -> np.ndarray:
    """A class for each byte: 0 other, then the counted kinds."""
    table = np.zeros(256, dtype=np.int64)
    for kind, content in enumerate(_KINDS, start=1):
        table[list(content)] = kind
    return table


_KINDS = (
    bytes(range(65, 91)),  # capitals
    b"0123456789",
    b"#*$%&<>",
    b"|",
    b"!",
    b",;:?'\"-()",
    b".",
    bytes([10]),
    bytes(range(192, 256)),  # first bytes of longer characters
)
_CLASS = _classes()


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text of a slice."""
    rows = len(offsets) - 1
    words = common.split_words(data, offsets, common.SPACED)
    hashes = common.word_hashes(data, words)
    n = words.counts().astype(float)
    kinds = len(_KINDS) + 1
    owner = np.repeat(np.arange(rows), np.diff(offsets))
    counts = np.bincount(owner * kinds + _CLASS[data], minlength=rows * kinds).reshape(rows, kinds).astype(float)
    size = np.maximum(np.diff(offsets), 1).astype(float)
    word_row = np.repeat(np.arange(rows), words.counts())
    length = (words.ends - words.starts).astype(float)
    some = np.maximum(n, 1)
    mean = np.bincount(word_row, length, rows) / some
    spread = np.sqrt(np.maximum(np.bincount(word_row, length**2, rows) / some - mean**2, 0))
    last = data[words.ends - 1] if len(words.ends) else data[:0]
    ahead = _CLASS[data[words.starts]] == 1 if len(words.starts) else np.zeros(0, bool)
    shout = ahead & (length > 1)
    shout[shout] = _CLASS[data[words.starts[shout] + 1]] == 1
    marked = (_CLASS[last] >= 3) & (_CLASS[last] <= 5)
    distinct, next_same, grams, top = (np.zeros(rows) for _ in range(4))
    for i in range(rows):
        own = hashes[words.first[i] : words.first[i + 1]]
        if len(own):
            _, times = np.unique(own, return_counts=True)
            distinct[i], top[i] = len(times), times.max()
            next_same[i] = (own[1:] == own[:-1]).sum()
            three = common.gram_hashes(own, 3)
            grams[i] = len(three) - len(np.unique(three))
    lines = counts[:, 8] + 1
    again = np.zeros(rows)
    for i in np.flatnonzero(counts[:, 8]):
        found = data[offsets[i] : offsets[i + 1]].tobytes().split(b"\n")
        again[i] = len(found) - len(set(found))
    return np.column_stack(
        [
            np.log1p(n),
            mean,
            spread,
            distinct / some,
            next_same / some,
            grams / some,
            top / some,
            counts[:, 1] / size,
            np.bincount(word_row, shout, rows) / some,
            counts[:, 2] / size,
            counts[:, 3] / size,
            counts[:, 4] / some,
            counts[:, 5] / some,
            np.bincount(word_row, marked, rows) / some,
            counts[:, 7] / some,
            np.bincount(word_row, length <= 3, rows) / some,
            n / lines,
            again / lines,
            counts[:, 9] / size,
        ]
    )


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, data, offsets in common.text_slices(batch.column(1), lower=False):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, len(offsets) - 1), pa.array(list(features(data, offsets)), pa.list_(pa.float64()))],
                ["doc_id", "x"],
            )


@dataclass
class Model:
    edges: list[np.ndarray]
    intercept: float = 0.0
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)])

    def raw(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(len(bins), self.intercept)
        for j, table in enumerate(self.tables):
            total += table[bins[:, j]]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[bins[:, i], bins[:, j]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return _logistic(self.raw(self.bins(x)))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _gain(g, h):
    return g * g / (h + RIDGE)


def _best_cut(g: np.ndarray, h: np.ndarray, c: np.ndarray) -> tuple[float, int]:
    """The cut between bins that gains most: (gain, last bin on the left) or (0, -1)."""
    gl, hl, cl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(c)[:-1]
    g_all, h_all, c_all = g.sum(), h.sum(), c.sum()
    gain = _gain(gl, hl) + _gain(g_all - gl, h_all - hl) - _gain(g_all, h_all)
    gain[(cl < LEAF) | (c_all - cl < LEAF)] = 0
    if not len(gain) or gain.max() <= 1e-9:
        return 0.0, -1
    return float(gain.max()), int(gain.argmax())


def _shallow_tree(g: np.ndarray, h: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Values per bin of a tree with up to three leaves."""
    leaves = [(0, len(g))]
    while len(leaves) < 3:
        cuts = [(*_best_cut(g[a:b], h[a:b], c[a:b]), a, b) for a, b in leaves]
        gain, at, a, b = max(cuts)
        if at < 0:
            break
        leaves.remove((a, b))
        leaves += [(a, a + at + 1), (a + at + 1, b)]
    out = np.zeros(len(g))
    for a, b in leaves:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, c: np.ndarray) -> tuple[float, np.ndarray]:
    """The best pair of cuts, one per axis, of joint bins: (gain, values of the four parts)."""
    sums = [np.cumsum(np.cumsum(x, 0), 1) for x in (g, h, c)]

    def parts(s):
        a = s[:-1, :-1]
        return a, s[:-1, -1:] - a, s[-1:, :-1] - a, s[-1, -1] - s[:-1, -1:] - s[-1:, :-1] + a

    gs, hs, cs = map(parts, sums)
    gain = sum(_gain(x, y) for x, y in zip(gs, hs, strict=True)) - _gain(g.sum(), h.sum())
    for x in cs:
        gain = np.where(x < LEAF, 0, gain)
    out = np.zeros_like(g)
    if not gain.size or gain.max() <= 1e-9:
        return 0.0, out
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    for rows, x in ((slice(0, i + 1), 0), (slice(i + 1, None), 2)):
        for cols, y in ((slice(0, j + 1), 0), (slice(j + 1, None), 1)):
            k = x + y
            out[rows, cols] = gs[k][i, j] / (hs[k][i, j] + RIDGE)
    return float(gain.max()), out


def train(x: np.ndarray, y: np.ndarray, seed: int = 7) -> Model:
    """Boost the lookup tables on rows ``x`` with labels ``y`` (0 or 1)."""
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    model = Model([np.unique(np.quantile(x[:, j], quantiles)) for j in range(x.shape[1])])
    bins = model.bins(x)
    sizes = [len(e) + 1 for e in model.edges]
    model.tables = [np.zeros(s) for s in sizes]
    mean = min(max(y.mean(), 1e-3), 1 - 1e-3)
    model.intercept = float(np.log(mean / (1 - mean)))
    rng = np.random.default_rng(seed)
    for _ in range(BAGS):
        pick = rng.random(len(y)) < 0.8
        b, t = bins[pick], y[pick]
        raw = np.full(len(t), model.intercept)
        for _ in range(ROUNDS):
            for j, size in enumerate(sizes):
                p = _logistic(raw)
                step = STEP * _shallow_tree(
                    np.bincount(b[:, j], t - p, size),
                    np.bincount(b[:, j], p * (1 - p), size),
                    np.bincount(b[:, j], minlength=size),
                )
                model.tables[j] += step / BAGS
                raw += step[b[:, j]]
    _add_pairs(model, bins, sizes, y)
    for j, table in enumerate(model.tables):  # centred, so that the intercept is the mean
        shift = table[bins[:, j]].mean()
        table -= shift
        model.intercept += shift
    return model


def _add_pairs(model: Model, bins: np.ndarray, sizes: list[int], y: np.ndarray) -> None:
    """Rank all pairs by what their best quadrants gain, and boost tables for the first."""

    def joint(i, j, raw):
        p = _logistic(raw)
        code = bins[:, i] * sizes[j] + bins[:, j]
        shape, cells = (sizes[i], sizes[j]), sizes[i] * sizes[j]
        return [np.bincount(code, w, cells).reshape(shape) for w in (y - p, p * (1 - p), np.ones(len(y)))]

    raw = model.raw(bins)
    ranked = sorted(
        ((_quadrants(*joint(i, j, raw))[0], i, j) for i in range(len(sizes)) for j in range(i)), reverse=True
    )
    model.pairs = [(i, j) for gain, i, j in ranked[:PAIRS] if gain > 0]
    model.pair_tables = [np.zeros((sizes[i], sizes[j])) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
            step = STEP * _quadrants(*joint(i, j, raw))[1]
            table += step
            raw = raw + step[bins[:, i], bins[:, j]]


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Model | None:
    chosen = common.labelled_ids(labels, size)
    sample = common.of_ids(docs, chosen).mapInArrow(_feature_rows, "doc_id long, x array<double>")
    rows = sample.toPandas().merge(chosen, on="doc_id").sort_values("doc_id")
    if rows["quality"].nunique() < 2:
        return None
    return train(np.stack(rows["x"].to_numpy()), rows["quality"].to_numpy(float))


def _score_rows(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, data, offsets in common.text_slices(batch.column(1), lower=False):
                rows = len(offsets) - 1
                scores = model.score(features(data, offsets)) if model else np.full(rows, 0.5)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, rows), pa.array(scores)], ["key", "score"]
                )

    return run


def scores(docs: DataFrame, model: Model | None, key: str = "doc_id") -> DataFrame:
    """(key, score) of every row of ``docs``."""
    kind = docs.schema[key].dataType.simpleString()
    scored = docs.select(F.col(key).alias("key"), F.col("text").cast("string")).mapInArrow(
        _score_rows(model), f"key {kind}, score double"
    )
    return scored.select(F.col("key").alias(key), "score")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = fit(docs, common.table(spark, sf_dir, "labels"))
    return scores(docs, model).select(
        "doc_id",
        common.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )


def _accepted_rows(model: Model, least: float, at: int):
    """Rows whose text, the column ``at``, scores at least ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at)
            texts = texts if common.is_text(texts) else texts.cast(pa.string())
            for low, data, offsets in common.text_slices(texts, lower=False):
                good = model.score(features(data, offsets)) >= least
                yield batch.slice(low, len(good)).filter(pa.array(good))
            common.release_memory()

    return run


def accepted(docs: DataFrame, model: Model | None, least: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` that score at least ``least``, in one pass without a shuffle."""
    if model is None:
        return docs
    return docs.mapInArrow(_accepted_rows(model, least, docs.columns.index("text")), docs.schema)
