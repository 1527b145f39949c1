"""Boosted trees with second-order histograms: many models grown side by side by Spark jobs.

Numeric columns are cut into bins once. Every level of a tree is one job: tasks add up the
gradients of their rows per (model, node, column, bin) and Spark sums the cells, runs over
the bins of a column and takes the best split of each node; the driver sees one row per node.
All folds, and all trials of a search step, grow in the same jobs, so their rows are read once.

A leaf is -G / (H + lambda) for the squared error, with H the number of rows. The columns and
rows of a tree are drawn from the seed, the model's fold and the tree's number. The error on
a fold's own rows is added up while the next tree's root is read, so patience ends a model
after the tree that exhausts it, and no tree is grown again.

Gradients are added as whole numbers (a power of two of the label's unit), so a model does
not depend on how the rows are partitioned or in what order they are read.
"""

from __future__ import annotations

import hashlib
import json
import math
import random
import sys
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sunledger.operators.encoding import category_index, with_index
from sunledger.operators.features import LABEL, PREDICTION
from sunledger.operators.folds import key_digest
from sunledger.operators.statistics import mean_metrics, regression_metrics
from sunledger.session import materialise, new_shared_path

# Send this module's task code itself: executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Cells of equal width that a column's range is counted in before its bins are chosen.
CELLS = 1 << 16
#: Margins are stored after so many trees; in between, a pass evaluates the trees since.
STORE_EVERY = 10
#: Least gain of a split (a fixed value).
LEAST_GAIN = 1e-6
#: Cells of one model that a task adds up before it sends them.
DENSE_CELLS = 1 << 20
#: Rows are drawn by their number modulo this prime.
PRIME = (1 << 31) - 1
#: Up to so many nodes a model is evaluated in the tasks, beyond that by joins with its table.
TASK_NODES = 1 << 21


@dataclass(frozen=True)
class BoostParams:
    """Training parameters; ``colsample`` is the share of columns drawn for each tree."""

    learning_rate: float = 0.1
    max_depth: int = 5
    subsample: float = 1.0
    colsample: float = 1.0
    rounds: int = 900
    patience: int = 50
    seed: int = 42
    max_bins: int = 256
    reg_lambda: float = 1.0
    min_child_rows: int = 1

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> BoostParams:
        return BoostParams(**json.loads(text))


# The tuned parameters of each model variant.
TUNED: dict[str, BoostParams] = {
    "base": BoostParams(
        learning_rate=0.09444809314154706,
        max_depth=12,
        reg_lambda=0.27119234357683963,
        subsample=0.964652036337781,
        colsample=0.8130623308751801,
    ),
    "angle": BoostParams(
        learning_rate=0.13886682003571107,
        max_depth=12,
        reg_lambda=3.413938622791411,
        subsample=0.7641310613219057,
        colsample=0.746570438703717,
    ),
    "full": BoostParams(
        learning_rate=0.1441785028265748,
        max_depth=12,
        reg_lambda=6.122792085184975,
        subsample=0.7780119263280894,
        colsample=0.7370037701322227,
    ),
    "pseudo": BoostParams(
        learning_rate=0.06651948043726232,
        max_depth=12,
        reg_lambda=0.003016252822732625,
        subsample=0.8020024224177278,
        colsample=0.8604677317852358,
    ),
}


def best_round(errors: Sequence[float], patience: int) -> int:
    """Number of rounds to keep: the best one before ``patience`` rounds bring nothing better."""
    best, at = math.inf, 0
    for i, error in enumerate(errors):
        if error < best:
            best, at = error, i
        elif i - at >= patience:
            break
    return at + 1


# ---- bins ---------------------------------------------------------------------------


def _long(matrix: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, x): a row per value that is neither null nor NaN nor infinite."""
    pairs = [F.struct(F.lit(i).alias("feature"), F.col(f"`{c}`").cast("double").alias("x")) for i, c in enumerate(features)]
    long = matrix.select(F.inline(F.array(*pairs)))
    return long.where(F.col("x").isNotNull() & ~F.isnan("x") & (F.abs("x") != math.inf))


def _finite(name: str) -> F.Column:
    x = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != math.inf), x)


def choose_cuts(matrix: DataFrame, features: Sequence[str], max_bins: int) -> list[np.ndarray]:
    """Per feature the values at which a bin starts, at most ``max_bins`` - 1.

    The range of a feature is counted in ``CELLS`` cells of equal width. If at most
    ``max_bins`` cells have rows each starts a bin, else bins have about equal rows. A cut is
    the least value of its cell. The counts do not depend on the partitioning.
    """
    if not features:
        return []
    long = _long(matrix, features)
    ends = matrix.agg(*[end(_finite(c)) for end in (F.min, F.max) for c in features]).first()
    x = F.col("x")
    # Two numbers per feature; a feature without values has no rows to place.
    low, high = (
        F.array(*[F.lit(v).cast("double") for v in half])[F.col("feature")]
        for half in (ends[: len(features)], ends[len(features) :])
    )
    placed = long.withColumn(
        "cell",
        F.when(high > low, F.least(F.floor((x - low) / (high - low) * CELLS), F.lit(CELLS - 1))).otherwise(F.lit(0)),
    )
    cells = placed.groupBy("feature", "cell").agg(F.count("*").alias("n"), F.min("x").alias("x"))
    # At most CELLS rows per feature.
    ordered = Window.partitionBy("feature").orderBy("cell")
    whole = Window.partitionBy("feature")
    before = F.sum("n").over(ordered) - F.col("n")
    bucket = F.floor(before * max_bins / F.sum("n").over(whole))
    chosen = (
        cells.withColumns({"bucket": bucket, "cells": F.count("*").over(whole)})
        .withColumn("previous", F.lag("bucket").over(ordered))
        .where(F.col("previous").isNotNull())
        .where((F.col("cells") <= max_bins) | (F.col("bucket") > F.col("previous")))
    )
    cuts: list[list[float]] = [[] for _ in features]
    for row in chosen.select("feature", "x").orderBy("feature", "x").collect():
        cuts[row["feature"]].append(row["x"])
    return [np.array(c, np.float64) for c in cuts]


def to_bins(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Bin 0 for what is missing, then 1 + the number of cuts not above the value."""
    bins = np.searchsorted(cuts, values, side="right") + 1
    return np.where(np.isnan(values), 0, bins).astype(np.uint16)


_BINNED = "fold int, label double, row long, site int, bins binary, margins binary"


def _bin_rows(batches: Iterator[pa.RecordBatch], cuts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        *head, site = batch.columns[:4]
        columns = [c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns[4:]]
        packed = [to_bins(v, c) for v, c in zip(columns, cuts, strict=True)]
        table = np.stack(packed, 1) if packed else np.zeros((batch.num_rows, 0), np.uint16)
        yield pa.RecordBatch.from_arrays(
            [*head, site, _packed(table), pa.nulls(batch.num_rows, pa.binary())],
            ["fold", "label", "row", "site", "bins", "margins"],
        )


def _packed(table: np.ndarray) -> pa.Array:
    """A binary value per row of a table of numbers."""
    rows, width = len(table), table.shape[1] * table.itemsize
    offsets = pa.py_buffer((np.arange(rows + 1) * width).astype(np.int32))
    content = pa.py_buffer(np.ascontiguousarray(table).tobytes())
    return pa.Array.from_buffers(pa.binary(), rows, [None, offsets, content])


def _unpacked(column: pa.Array, kind, width: int) -> np.ndarray:
    _, offsets, content = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(content, np.uint8)[at[0] : at[-1]] if content is not None else np.zeros(0, np.uint8)
    return flat.view(kind).reshape(len(column), width)


@dataclass
class Prepared:
    """A stored table of binned rows, and what the driver knows of it."""

    table: DataFrame
    features: list[str]
    category: str | None
    index: DataFrame | None
    categories: int
    cuts: list[np.ndarray]
    scale: float
    square_scale: float
    sums: dict[int, tuple[int, int]]  # fold: label as whole number, rows


def prepare(
    matrix: DataFrame,
    features: Sequence[str],
    category: str | None,
    keys: Sequence[str],
    max_bins: int = 256,
    index: DataFrame | None = None,
) -> Prepared:
    """Bin the rows of ``matrix`` (keys, features, label, fold) that have a label and a fold.

    ``category`` names a column whose values each count as a 0/1 column of their own. It is
    stored as one number a row, whatever the number of its values; ``index`` maps values to
    numbers and is found from the rows if not given.
    """
    rows = matrix.where(F.col(f"`{LABEL}`").isNotNull() & F.col("fold").isNotNull())
    cuts = choose_cuts(rows, features, max_bins)
    categories = 0
    if category is not None:
        index = index if index is not None else category_index(rows, category)
        rows = with_index(rows, category, index, "_site")
        categories = index.count()
    number = F.conv(F.substring(key_digest([F.col(k) for k in keys]), 9, 7), 16, 10).cast("long")
    ready = rows.select(
        F.col("fold").cast("int").alias("fold"),
        F.col(f"`{LABEL}`").cast("double").alias("label"),
        number.alias("row"),
        (F.coalesce(F.col("_site"), F.lit(-1)) if category is not None else F.lit(-1)).cast("int").alias("site"),
        *[F.col(f"`{c}`").cast("double").alias(f"_{i}") for i, c in enumerate(features)],
    )
    table = materialise(ready.mapInArrow(partial(_bin_rows, cuts=cuts), _BINNED), "binned")
    label = table.agg(F.min("label"), F.max("label"), F.count("*")).first()
    low, high, count = label[0] or 0.0, label[1] or 0.0, label[2]
    scale, square_scale = scales(low, high, count)
    whole = F.rint(F.col("label") * scale).cast("long")
    sums = table.groupBy("fold").agg(F.sum(whole).alias("total"), F.count("*").alias("rows")).collect()
    return Prepared(
        table,
        list(features),
        category,
        index,
        categories,
        cuts,
        scale,
        square_scale,
        {r["fold"]: (r["total"], r["rows"]) for r in sums},
    )


def scales(low: float, high: float, rows: int) -> tuple[float, float]:
    """Powers of two by which gradients and squared errors become whole numbers.

    Sums over all rows stay below 2**62, and over a batch of 2**17 rows below 2**53.
    """
    reach = max(4 * (high - low), abs(low), abs(high), 1e-30)

    def power(size: float) -> float:
        bits = math.ceil(math.log2(size))
        return 2.0 ** min(36 - bits, 61 - math.ceil(math.log2(max(rows, 1))) - bits)

    return power(reach), power(reach * reach)


# ---- trees --------------------------------------------------------------------------


@dataclass
class Tree:
    """Nodes in heap order: 1 is the root, 2 n and 2 n + 1 the children of n.

    ``feature`` is -1 in leaves, and the number of numeric columns where a node asks for one
    category. A row goes right if its bin is above ``cut``, or if it has that category.
    """

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def nodes(self, bins: np.ndarray, site: np.ndarray) -> np.ndarray:
        at, every = np.ones(len(site), np.int64), np.arange(len(site))
        width = bins.shape[1]
        while True:
            feature = self.feature[at]
            inner = feature >= 0
            if not inner.any():
                return at
            asks = feature == width
            own = bins[every, np.where(inner & ~asks, feature, 0)] if width else np.zeros(len(site), np.int64)
            cut = self.cut[at]
            right = np.where(asks, site == cut, own > cut)
            at = np.where(inner, 2 * at + right, at)


def drawn_columns(params: BoostParams, fold: int | None, tree: int, total: int) -> list[int]:
    """The columns of one tree: the share with the least digests of seed, fold, tree and column."""
    count = max(1, int(params.colsample * total)) if total else 0
    if count == total:
        return list(range(total))
    digest = {c: hashlib.md5(f"{params.seed}|{fold}|{tree}|{c}".encode()).digest() for c in range(total)}
    return sorted(sorted(digest, key=digest.get)[:count])


@dataclass
class Growing:
    """One model while it grows."""

    number: int
    fold: int | None
    params: BoostParams
    base: float
    trees: list[list[dict]] = field(default_factory=list)
    errors: list[float] = field(default_factory=list)
    nodes: dict[int, dict] = field(default_factory=dict)
    open: list[int] = field(default_factory=list)
    since: list[Tree] = field(default_factory=list)
    draw: tuple = ()

    def start(self, columns: int, categories: int) -> None:
        """A new tree: the root is open, rows and columns are drawn."""
        rng = random.Random(f"{self.params.seed}|{self.fold}|{len(self.trees)}")
        multiplier, offset = rng.randrange(1, PRIME), rng.randrange(PRIME)
        limit = PRIME if self.params.subsample >= 1 else int(self.params.subsample * PRIME)
        total = columns + categories
        drawn = drawn_columns(self.params, self.fold, len(self.trees), total)
        numeric = [c for c in drawn if c < columns]
        allowed = None
        if len(drawn) < total:
            allowed = np.zeros(categories + 1, bool)  # the last one stands for unknown
            allowed[[c - columns for c in drawn if c >= columns]] = True
        self.draw = multiplier, offset, limit, numeric, allowed
        self.nodes, self.open = {1: {"feature": -1, "cut": 0, "g": 0, "n": 0, "gain": 0.0}}, [1]

    def arrays(self, value=lambda node: 0.0) -> Tree:
        size = max(self.nodes) + 1
        feature, cut, values = np.full(size, -1, np.int64), np.zeros(size, np.int64), np.zeros(size)
        for at, node in self.nodes.items():
            feature[at], cut[at], values[at] = node["feature"], node["cut"], value(node)
        return Tree(feature, cut, values)

    def leaf(self, node: dict, scale: float) -> float:
        if node["feature"] >= 0 or not node["n"]:
            return 0.0
        return self.params.learning_rate * (-(node["g"] / scale) / (node["n"] + self.params.reg_lambda))

    def split(self, row, level: int) -> list[int]:
        """Apply the best split of a node; the children that may split further."""
        node, best = self.nodes[row["node"]], row["best"]
        node["g"], node["n"] = best["g"], best["n"]
        if best["gain"] is None or not best["gain"] > LEAST_GAIN:
            return []
        node.update(feature=-best["feature"], cut=-best["bin"], gain=best["gain"])
        left = {"feature": -1, "cut": 0, "g": best["gl"], "n": best["nl"], "gain": 0.0}
        right = {"feature": -1, "cut": 0, "g": best["g"] - best["gl"], "n": best["n"] - best["nl"], "gain": 0.0}
        at = 2 * row["node"]
        self.nodes[at], self.nodes[at + 1] = left, right
        deeper = level + 1 < self.params.max_depth
        return [k for k, child in ((at, left), (at + 1, right)) if deeper and child["n"] >= 2 * self.params.min_child_rows]


@dataclass
class TaskModel:
    """What a task needs of a model in one pass."""

    number: int
    fold: int | None
    base: float
    since: list[Tree]
    partial: Tree | None
    open: list[int]
    draw: tuple
    checks: bool


@dataclass
class Pass:
    models: list[TaskModel]
    slots: int  # margins stored per row
    bins: list[int]
    categories: int
    scale: float
    square_scale: float


def _margins(model: TaskModel, stored: np.ndarray | None, bins: np.ndarray, site: np.ndarray) -> np.ndarray:
    margin = np.full(len(site), model.base) if stored is None else stored[:, model.number].copy()
    for tree in model.since:
        margin += tree.value[tree.nodes(bins, site)]
    return margin


def _columns(batch: pa.RecordBatch, state: Pass):
    fold, label, row, site = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
    bins = _unpacked(batch.column(4), np.uint16, len(state.bins))
    margins = batch.column(5)
    stored = None if margins.null_count else _unpacked(margins, np.float64, state.slots)
    return fold, label, row, site, bins, stored


class Cells:
    """Sums of one model's gradients and rows per (open node, column, bin)."""

    def __init__(self, model: TaskModel, state: Pass):
        self.model, self.columns = model, len(state.bins)
        self.features = [*model.draw[3], self.columns] if state.categories else list(model.draw[3])
        self.widths = {f: state.bins[f] if f < len(state.bins) else state.categories + 1 for f in self.features}
        self.slot_of = np.full(max(model.open) + 1, -1)
        self.slot_of[model.open] = np.arange(len(model.open))
        self.sums: dict[int, list[np.ndarray]] = {}
        self.keep = len(model.open) * sum(self.widths.values()) <= DENSE_CELLS

    def slots(self, nodes: np.ndarray) -> np.ndarray:
        """The place of each row's node among the open ones; -1 if it is not open."""
        last = len(self.slot_of) - 1
        return np.where(nodes <= last, self.slot_of[np.minimum(nodes, last)], -1)

    def add(self, slot: np.ndarray, gradient: np.ndarray, bins: np.ndarray, site: np.ndarray):
        """Add a batch; what a task does not hold on to is given back as rows."""
        allowed = self.model.draw[4]
        for f in self.features:
            width = self.widths[f]
            if f < bins.shape[1]:
                own = bins[:, f].astype(np.int64)
            else:
                own = site if allowed is None else np.where(allowed[site], site, -1)
                own = own + 1
            key = slot * width + own
            size = len(self.model.open) * width
            g = np.bincount(key, gradient, size).astype(np.int64)
            n = np.bincount(key, minlength=size)
            if self.keep:
                held = self.sums.setdefault(f, [np.zeros(size, np.int64), np.zeros(size, np.int64)])
                held[0] += g
                held[1] += n
            else:
                yield self._rows(f, g, n)

    def rows(self):
        for f, (g, n) in self.sums.items():
            yield self._rows(f, g, n)

    def _rows(self, feature: int, g: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(n)
        node = np.array(self.model.open)[at // self.widths[feature]]
        # Category -1 is one that is unknown, or not drawn for this tree.
        bin_ = at % self.widths[feature] - (feature == self.columns)
        return _cell_batch(self.model.number, node, feature, bin_, g[at], n[at])


_CELL = "model int, node long, feature int, bin int, g long, n long"
_CELL_NAMES = [f.split()[0] for f in _CELL.split(", ")]


def _cell_batch(model, node, feature, bin_, g, n) -> pa.RecordBatch:
    size = len(node)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(size, model, np.int32)),
            pa.array(np.asarray(node, np.int64)),
            pa.array(np.full(size, feature, np.int32)),
            pa.array(np.asarray(bin_).astype(np.int32)),
            pa.array(np.asarray(g, np.int64)),
            pa.array(np.asarray(n, np.int64)),
        ],
        _CELL_NAMES,
    )


def _histograms(batches: Iterator[pa.RecordBatch], state: Pass) -> Iterator[pa.RecordBatch]:
    cells = {m.number: Cells(m, state) for m in state.models if m.open}
    errors = {m.number: [0, 0] for m in state.models if m.checks}
    for batch in batches:
        fold, label, row, site, bins, stored = _columns(batch, state)
        for model in state.models:
            margin = _margins(model, stored, bins, site)
            off = margin - label
            if model.checks:
                own = off[fold == model.fold]
                errors[model.number][0] += int(np.rint(own * own * state.square_scale).astype(np.int64).sum())
                errors[model.number][1] += len(own)
            if not model.open:
                continue
            multiplier, offset, limit = model.draw[:3]
            used = (row * multiplier + offset) % PRIME < limit
            if model.fold is not None:
                used &= fold != model.fold
            own = cells[model.number]
            slot = own.slots(model.partial.nodes(bins[used], site[used]))
            here = slot >= 0
            places = np.flatnonzero(used)[here]
            gradient = np.rint(off[places] * state.scale)
            yield from own.add(slot[here], gradient, bins[places], site[places])
    for own in cells.values():
        yield from own.rows()
    for number, (total, count) in errors.items():
        yield _cell_batch(number, [0], -1, [0], [total], [count])


def _store_margins(batches: Iterator[pa.RecordBatch], state: Pass) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, _, _, site, bins, stored = _columns(batch, state)
        margins = np.zeros((batch.num_rows, state.slots)) if stored is None else stored.copy()
        for model in state.models:
            margins[:, model.number] = _margins(model, stored, bins, site)
        yield pa.RecordBatch.from_arrays([*batch.columns[:5], _packed(margins)], batch.schema.names)


def best_splits(cells: DataFrame, state: Pass, growing: Mapping[int, Growing]) -> DataFrame:
    """The best split of every (model, node), as one row; node 0 carries validation errors."""
    summed = cells.groupBy("model", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("n").alias("n"))
    column = Window.partitionBy("model", "node", "feature")
    upto = column.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    one = F.col("feature") == len(state.bins)
    run = summed.withColumns(
        {
            "total_g": F.sum("g").over(column),
            "total_n": F.sum("n").over(column),
            "run_g": F.sum("g").over(upto),
            "run_n": F.sum("n").over(upto),
        }
    )
    total_g, total_n = F.col("total_g"), F.col("total_n")
    sides = run.withColumns(
        {
            "gl": F.when(one, total_g - F.col("g")).otherwise(F.col("run_g")),
            "nl": F.when(one, total_n - F.col("n")).otherwise(F.col("run_n")),
        }
    )

    def of_model(value) -> F.Column:
        numbers = sorted(growing)
        values = F.array(*[F.lit(value(growing[k])) for k in numbers])
        places = {k: i for i, k in enumerate(numbers)}
        dense = F.array(*[F.lit(places.get(k, 0)) for k in range(max(numbers) + 1)])
        return values[dense[F.col("model")]]

    penalty, least = of_model(lambda m: float(m.params.reg_lambda)), of_model(lambda m: max(1, m.params.min_child_rows))

    def merit(g: F.Column, n: F.Column) -> F.Column:
        return (g / state.scale) * (g / state.scale) / (n + penalty)

    gl, nl = F.col("gl"), F.col("nl")
    gain = merit(gl, nl) + merit(total_g - gl, total_n - nl) - merit(total_g, total_n)
    fits = (nl >= least) & (total_n - nl >= least) & ~(one & (F.col("bin") < 0)) & (F.col("feature") >= 0)
    best = F.struct(
        # Of equal gains the first column and bin.
        F.when(fits, gain).alias("gain"),
        (-F.col("feature")).alias("feature"),
        (-F.col("bin")).alias("bin"),
        gl.alias("gl"),
        nl.alias("nl"),
        total_g.alias("g"),
        total_n.alias("n"),
    )
    return sides.groupBy("model", "node").agg(F.max(best).alias("best"))


class Trainer:
    """Grows several models over one prepared table, level by level."""

    def __init__(self, data: Prepared, models: Sequence[tuple[int | None, BoostParams]]):
        self.data = data
        self.spark = data.table.sparkSession
        self.bins = [len(c) + 2 for c in data.cuts]
        self.models = [Growing(i, fold, params, self._base(fold)) for i, (fold, params) in enumerate(models)]
        self.table = data.table
        self.paths = [new_shared_path(self.spark, "margins") for _ in range(2)]
        self.passes = 0

    def _base(self, fold: int | None) -> float:
        used = [v for k, v in self.data.sums.items() if k != fold]
        rows = sum(n for _, n in used)
        return sum(g for g, _ in used) / rows / self.data.scale if rows else 0.0

    def _state(self, models: Sequence[Growing], checks: bool, grows: bool = True) -> Pass:
        tasks = [
            TaskModel(
                m.number,
                m.fold,
                m.base,
                m.since,
                m.arrays() if grows else None,
                list(m.open) if grows else [],
                m.draw,
                checks and m.fold is not None and bool(m.trees),
            )
            for m in models
        ]
        return Pass(tasks, len(self.models), self.bins, self.data.categories, self.data.scale, self.data.square_scale)

    def _run(self, models: Sequence[Growing], checks: bool, grows: bool = True) -> list:
        self.passes += 1
        state = self._state(models, checks, grows)
        cells = self.table.mapInArrow(partial(_histograms, state=state), _CELL)
        return best_splits(cells, state, {m.number: m for m in models}).collect()

    def _check(self, rows: list) -> None:
        for row in rows:
            if row["node"] == 0:
                best = row["best"]
                # A fold without rows judges nothing: its model grows all rounds.
                if best["n"]:
                    self.models[row["model"]].errors.append(best["g"] / self.data.square_scale / best["n"])

    def _going(self, model: Growing) -> bool:
        if len(model.trees) >= model.params.rounds:
            return False
        if model.fold is None or not model.errors:
            return True
        best = model.errors.index(min(model.errors))
        return len(model.errors) - 1 - best < model.params.patience

    def _store(self, models: Sequence[Growing]) -> None:
        """Write the margins, in turn to one of two folders, and forget the trees in memory."""
        state = self._state(models, False, False)
        self.paths.reverse()
        self.table.mapInArrow(partial(_store_margins, state=state), _BINNED).write.mode("overwrite").parquet(self.paths[0])
        self.table = self.spark.read.schema(_BINNED).parquet(self.paths[0])
        for model in models:
            model.since = []

    def fit(self) -> list[Growing]:
        active = [m for m in self.models if m.params.rounds > 0]
        while active:
            for model in active:
                model.start(len(self.bins), self.data.categories)
            growing, level = active, 0
            while growing:
                rows = self._run(growing, checks=level == 0)
                if level == 0:
                    self._check(rows)
                    active = growing = [m for m in active if self._going(m)]
                going = {m.number: m for m in growing}
                opened: dict[int, list[int]] = {k: [] for k in going}
                for row in rows:
                    if row["node"] and row["model"] in going:
                        opened[row["model"]] += going[row["model"]].split(row, level)
                level += 1
                for k, nodes in opened.items():
                    going[k].open = sorted(nodes)
                growing = [m for m in growing if m.open]
            for model in active:
                tree = model.arrays(lambda node, m=model: m.leaf(node, self.data.scale))
                model.since.append(tree)
                model.trees.append([{"node": k, "value": float(tree.value[k]), **v} for k, v in sorted(model.nodes.items())])
            done = [m for m in active if len(m.trees) >= m.params.rounds]
            if any(m.fold is not None for m in done):
                self._check(self._run([m for m in done if m.fold is not None], checks=True, grows=False))
            active = [m for m in active if m not in done]
            if active and max(len(m.since) for m in active) >= STORE_EVERY:
                self._store(active)
        for model in self.models:
            if model.fold is not None and model.errors:
                del model.trees[best_round(model.errors, model.params.patience) :]
        return self.models


# ---- models as tables ---------------------------------------------------------------

NODE_SCHEMA = (
    "model int, tree int, node long, feature string, cut double, category string, "
    "left long, right long, value double, gain double, rows long"
)


@dataclass
class FoldModels:
    """Models as tables: their nodes, and what each starts from.

    A node's row goes right if its value is at least ``cut``, or if the category column has
    the value ``category``; else, and if the value is missing, left. A leaf has neither.
    """

    features: list[str]
    nodes: DataFrame
    bases: dict[int, float]
    rounds: dict[int, int]
    params: BoostParams
    category: str | None = None
    index: DataFrame | None = None

    @property
    def models(self) -> list[int]:
        return sorted(self.bases)

    def save(self, path: str) -> None:
        """The node table, the numbers of the categories, and one JSON text."""
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        spark = self.nodes.sparkSession
        if self.index is not None:
            self.index.write.mode("overwrite").parquet(f"{path}/categories")
        record = {
            "features": self.features,
            "bases": {str(k): v for k, v in self.bases.items()},
            "rounds": {str(k): v for k, v in self.rounds.items()},
            "params": asdict(self.params),
            "category": self.category,
        }
        rows = spark.createDataFrame([(json.dumps(record),)], "contract string")
        rows.coalesce(1).write.mode("overwrite").text(f"{path}/contract")

    @staticmethod
    def load(path: str) -> FoldModels:
        spark = SparkSession.active()
        record = json.loads(spark.read.text(f"{path}/contract").first()[0])
        return FoldModels(
            record["features"],
            spark.read.schema(NODE_SCHEMA).parquet(f"{path}/nodes"),
            {int(k): v for k, v in record["bases"].items()},
            {int(k): v for k, v in record["rounds"].items()},
            BoostParams(**record["params"]),
            record["category"],
            spark.read.parquet(f"{path}/categories") if record["category"] else None,
        )


def node_table(data: Prepared, grown: Sequence[Growing]) -> DataFrame:
    """The nodes of finished models as a stored table."""
    spark = data.table.sparkSession
    width = len(data.features)
    rows = []
    for model in grown:
        number = model.fold if model.fold is not None else 0
        for t, tree in enumerate(model.trees):
            for n in tree:
                inner = n["feature"] >= 0
                numeric = inner and n["feature"] < width
                cut = None
                if numeric:
                    # Bin 0 holds what is missing: only that goes left.
                    cut = float(data.cuts[n["feature"]][n["cut"] - 1]) if n["cut"] else -math.inf
                rows.append(
                    (
                        number,
                        t,
                        n["node"],
                        data.features[n["feature"]] if numeric else data.category if inner else None,
                        cut,
                        n["cut"] if inner and not numeric else None,
                        2 * n["node"] if inner else None,
                        2 * n["node"] + 1 if inner else None,
                        n["value"],
                        n["gain"],
                        n["n"],
                    )
                )
    schema = pa.schema(
        [
            ("model", pa.int32()),
            ("tree", pa.int32()),
            ("node", pa.int64()),
            ("feature", pa.string()),
            ("cut", pa.float64()),
            ("number", pa.int32()),
            ("left", pa.int64()),
            ("right", pa.int64()),
            ("value", pa.float64()),
            ("gain", pa.float64()),
            ("rows", pa.int64()),
        ]
    )
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    table = pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
    nodes = spark.createDataFrame(table)
    if data.index is not None:
        named = data.index.select(F.col("number"), F.col("value").alias("category"))
        nodes = nodes.join(named, "number", "left")
    else:
        nodes = nodes.withColumn("category", F.lit(None).cast("string"))
    names = [f.split()[0] for f in NODE_SCHEMA.split(", ")]
    return materialise(nodes.select(*names), "nodes")


def _packed_models(data: Prepared, grown: Sequence[Growing], params: BoostParams) -> FoldModels:
    numbers = [m.fold if m.fold is not None else 0 for m in grown]
    return FoldModels(
        data.features,
        node_table(data, grown),
        {k: m.base for k, m in zip(numbers, grown, strict=True)},
        {k: len(m.trees) for k, m in zip(numbers, grown, strict=True)},
        params,
        data.category,
        data.index,
    )


def fit_folds(
    matrix: DataFrame,
    features: Sequence[str],
    params: BoostParams,
    fold_ids: Iterable[int] = range(10),
    keys: Sequence[str] = ("LocationCode", "DateTime"),
    category: str | None = None,
) -> FoldModels:
    """One model per fold, trained on the other folds and stopped on its own; all at once."""
    data = prepare(matrix, features, category, keys, params.max_bins)
    return fit_prepared(data, params, fold_ids)


def fit_prepared(data: Prepared, params: BoostParams, fold_ids: Iterable[int] = range(10)) -> FoldModels:
    return _packed_models(data, Trainer(data, [(fold, params) for fold in fold_ids]).fit(), params)


def fit_whole(
    matrix: DataFrame,
    features: Sequence[str],
    params: BoostParams,
    keys: Sequence[str] = ("LocationCode", "DateTime"),
    category: str | None = None,
) -> FoldModels:
    """One model, number 0, of all rows and all rounds."""
    data = prepare(matrix, features, category, keys, params.max_bins)
    return _packed_models(data, Trainer(data, [(None, params)]).fit(), params)


# ---- scoring ------------------------------------------------------------------------


@dataclass
class Scorer:
    """Trees over raw values, for tasks."""

    bases: list[float]
    trees: list[list[Tree]]


def _scorer(models: FoldModels, category_numbers: Mapping[str, int]) -> Scorer:
    at = {name: i for i, name in enumerate(models.features)}
    width = len(models.features)
    trees: dict[int, dict[int, list]] = {k: {} for k in models.models}
    for n in models.nodes.collect():
        trees[n["model"]].setdefault(n["tree"], []).append(n)
    out = []
    for k in models.models:
        own = []
        for t in sorted(trees[k]):
            nodes = trees[k][t]
            size = max(n["node"] for n in nodes) + 1
            tree = Tree(np.full(size, -1, np.int64), np.zeros(size), np.zeros(size))
            for n in nodes:
                if n["category"] is not None:
                    tree.feature[n["node"]], tree.cut[n["node"]] = width, category_numbers[n["category"]]
                elif n["feature"] is not None:
                    tree.feature[n["node"]], tree.cut[n["node"]] = at[n["feature"]], n["cut"]
                tree.value[n["node"]] = n["value"]
            own.append(tree)
        out.append(own)
    return Scorer([models.bases[k] for k in models.models], out)


def raw_nodes(tree: Tree, values: np.ndarray, site: np.ndarray) -> np.ndarray:
    """Leaves of rows by their values: right at or above the cut, left below and if missing."""
    at, every, width = np.ones(len(site), np.int64), np.arange(len(site)), values.shape[1]
    while True:
        feature = tree.feature[at]
        inner = feature >= 0
        if not inner.any():
            return at
        asks = feature == width
        own = values[every, np.where(inner & ~asks, feature, 0)] if width else np.zeros(len(site))
        cut = tree.cut[at]
        right = np.where(asks, site == cut, own >= cut)
        at = np.where(inner, 2 * at + right, at)


def _predict(batches: Iterator[pa.RecordBatch], scorer: Scorer, keys: int, by_fold: list[int] | None):
    """Keys and the mean of all models, or the model of the row's own fold."""
    for batch in batches:
        site = batch.column(keys).fill_null(-1).to_numpy(zero_copy_only=False)
        columns = [c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns[keys + 1 :]]
        values = np.stack(columns, 1) if columns else np.zeros((batch.num_rows, 0))
        fold = batch.column(keys - 1).to_numpy(zero_copy_only=False) if by_fold is not None else None
        total = np.zeros(batch.num_rows)
        for i, (base, trees) in enumerate(zip(scorer.bases, scorer.trees, strict=True)):
            here = np.arange(len(total)) if fold is None else np.flatnonzero(fold == by_fold[i])
            own = np.full(len(here), base)
            for tree in trees:
                own += tree.value[raw_nodes(tree, values[here], site[here])]
            total[here] += own
        if fold is None:
            total = total / len(scorer.bases)
        names = [f"_key{i}" for i in range(keys)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:keys], pa.array(total)], [*names, PREDICTION])


def _numbered(df: DataFrame, models: FoldModels) -> DataFrame:
    if models.category is None:
        return df.withColumn("_site", F.lit(None).cast("int"))
    return with_index(df, models.category, models.index, "_site")


def _in_tasks(df: DataFrame, models: FoldModels, keep: Sequence[str], by_fold: bool) -> DataFrame:
    used = models.nodes.select("category").where("category IS NOT NULL").distinct()
    numbers = {}
    if models.index is not None:
        # At most one category per node of the model.
        numbers = {r["value"]: r["number"] for r in models.index.join(used.withColumnRenamed("category", "value"), "value").collect()}
    scorer = _scorer(models, numbers)
    rows = _numbered(df, models)
    have = set(df.columns)
    names = [f"_key{i}" for i in range(len(keep))]
    chosen = rows.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)],
        F.col("_site"),
        *[(F.col(f"`{c}`") if c in have else F.lit(None)).cast("double").alias(f"_{i}") for i, c in enumerate(models.features)],
    )
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join([*(f"{n} {types[c]}" for c, n in zip(keep, names, strict=True)), f"`{PREDICTION}` double"])
    task = partial(_predict, scorer=scorer, keys=len(keep), by_fold=models.models if by_fold else None)
    scored = chosen.mapInArrow(task, schema)
    return scored.withColumnsRenamed(dict(zip(names, keep, strict=True)))


def score_by_joins(df: DataFrame, models: FoldModels, keep: Sequence[str], row_key: Sequence[str]) -> DataFrame:
    """(keep..., prediction): every row walks every tree, a level per join with the node table.

    Only joins and sums: for models too large for a task, and in SQL. ``row_key`` names rows.
    """
    have = set(df.columns)
    values = F.create_map(
        *[x for c in models.features if c in have for x in (F.lit(c), F.col(f"`{c}`").cast("double"))]
    ) if any(c in have for c in models.features) else F.lit(None).cast("map<string,double>")
    category = F.col(f"`{models.category}`").cast("string") if models.category else F.lit(None).cast("string")
    trees = [(k, t) for k in models.models for t in range(models.rounds[k])]
    each = F.array(*[F.struct(F.lit(k).alias("model"), F.lit(t).alias("tree")) for k, t in trees])
    walkers = df.select(*keep, *[c for c in row_key if c not in keep], values.alias("_values"), category.alias("_category"))
    at = walkers.select("*", F.inline(each)).withColumns({"node": F.lit(1).cast("long"), "_sum": F.lit(0.0)})
    nodes = models.nodes.select("model", "tree", "node", "feature", "cut", "category", "left", "right", "value")
    depth = (models.nodes.agg(F.max("node")).first()[0] or 1).bit_length()
    for _ in range(depth):
        joined = at.join(nodes, ["model", "tree", "node"], "left")
        x = F.col("_values")[F.col("feature")]
        right = F.when(F.col("category").isNotNull(), F.col("_category") == F.col("category")).otherwise(
            x.isNotNull() & ~F.isnan(x) & (x >= F.col("cut"))
        )
        at = joined.select(
            *[c for c in at.columns if c not in ("node", "_sum")],
            F.when(F.col("feature").isNotNull(), F.when(F.coalesce(right, F.lit(False)), F.col("right")).otherwise(F.col("left"))).alias("node"),
            (F.col("_sum") + F.when(F.col("feature").isNull(), F.coalesce("value", F.lit(0.0))).otherwise(F.lit(0.0))).alias("_sum"),
        )
    bases = reduce(lambda a, b: a + b, models.bases.values())
    names = list(dict.fromkeys([*keep, *row_key]))
    summed = at.groupBy(*names).agg(F.sum("_sum").alias("_sum"))
    return summed.select(*keep, ((F.col("_sum") + bases) / len(models.bases)).alias(PREDICTION))


def score(
    df: DataFrame, models: FoldModels, keys: Sequence[str] = ("LocationCode", "DateTime")
) -> DataFrame:
    """(keys..., prediction): the mean of all models; an absent or null feature counts as 0."""
    filled = df.select(
        *[c for c in dict.fromkeys([*keys, *([models.category] if models.category else [])])],
        *[
            F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(c) if c in df.columns else F.lit(0.0).alias(c)
            for c in models.features
        ],
    )
    if models.nodes.count() <= TASK_NODES:
        return _in_tasks(filled, models, list(keys), by_fold=False)
    return score_by_joins(filled.withColumn("_row", F.expr("uuid()")), models, list(keys), ["_row"])


def out_of_fold(matrix: DataFrame, models: FoldModels, keys: Sequence[str]) -> DataFrame:
    """(keys..., fold, label, prediction): each row scored by the model that did not see it."""
    known = matrix.where(F.col("fold").isin(models.models))
    return _in_tasks(known, models, [*keys, LABEL, "fold"], by_fold=True).select(*keys, "fold", LABEL, PREDICTION)


def fold_metrics(oof: DataFrame) -> DataFrame:
    return regression_metrics(oof, LABEL, PREDICTION, by=("fold",))


def cv_metrics(oof: DataFrame) -> DataFrame:
    return mean_metrics(fold_metrics(oof))


def ensemble_mean(df: DataFrame, predictions: Sequence[str], name: str = PREDICTION) -> DataFrame:
    """Arithmetic mean of prediction columns, added in the given order."""
    total = reduce(lambda a, b: a + b, [F.col(c) for c in predictions])
    return df.withColumn(name, total / F.lit(float(len(predictions))))


def sample_params(trials: int, base: BoostParams, seed: int = 42) -> list[BoostParams]:
    """Random draws from the search space: rates and penalties log-uniform, the others uniform."""
    draw = random.Random(seed)
    return [
        replace(
            base,
            learning_rate=math.exp(draw.uniform(math.log(0.01), math.log(0.3))),
            max_depth=draw.randint(6, 12),
            subsample=draw.uniform(0.5, 1.0),
            colsample=draw.uniform(0.5, 1.0),
            reg_lambda=math.exp(draw.uniform(math.log(1e-3), math.log(10))),
        )
        for _ in range(trials)
    ]


def cross_validate(data: Prepared, candidates: Sequence[BoostParams], fold_ids: Iterable[int]) -> list[list[dict]]:
    """Per candidate and fold the rows, errors and kept rounds; all models grow side by side."""
    fold_ids = list(fold_ids)
    grown = Trainer(data, [(f, p) for p in candidates for f in fold_ids]).fit()
    out = []
    for i in range(len(candidates)):
        own = grown[i * len(fold_ids) : (i + 1) * len(fold_ids)]
        out.append(
            [
                {
                    "fold": m.fold,
                    "rows": data.sums.get(m.fold, (0, 0))[1],
                    "mse": min(m.errors, default=math.nan),
                    "rmse": math.sqrt(min(m.errors, default=math.nan)),
                    "rounds": len(m.trees),
                }
                for m in own
            ]
        )
    return out
