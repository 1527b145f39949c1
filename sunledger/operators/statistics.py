"""Pairwise correlation and regression metrics."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sunledger.functions.numeric import rint_round

# Send this module's task code itself: executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_MOMENTS = "x int, y int, n double, mx double, my double, sxx double, syy double, sxy double"
_NAMES = [field.split()[0] for field in _MOMENTS.split(", ")]

# A spread below this share of the squared mean is rounding noise of a constant.
_CONSTANT = 1e-24


def _pair_moments(raw: np.ndarray, upper: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """n, mx, my, sxx, syy, sxy per column pair over the rows where both are present.

    Values are centred on the column means first, so large offsets cost no digits.
    """
    there = ~np.isnan(raw)
    mask = there.astype("float64")
    centre = np.where(there, raw, 0.0).sum(axis=0) / np.maximum(mask.sum(axis=0), 1.0)
    v = np.where(there, raw - centre, 0.0)
    squares = v * v
    n = (mask.T @ mask)[upper]
    safe = np.maximum(n, 1.0)
    sum_x, sum_y = (v.T @ mask)[upper], (mask.T @ v)[upper]
    return np.stack(
        [
            n,
            sum_x / safe + centre[upper[0]],
            sum_y / safe + centre[upper[1]],
            (squares.T @ mask)[upper] - sum_x * sum_x / safe,
            (mask.T @ squares)[upper] - sum_y * sum_y / safe,
            (v.T @ v)[upper] - sum_x * sum_y / safe,
        ]
    )


def _merge_moments(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = a[0] + b[0]
    share = b[0] / np.maximum(n, 1.0)
    dx, dy = b[1] - a[1], b[2] - a[2]
    weight = a[0] * share
    return np.stack(
        [
            n,
            a[1] + dx * share,
            a[2] + dy * share,
            a[3] + b[3] + dx * dx * weight,
            a[4] + b[4] + dy * dy * weight,
            a[5] + b[5] + dx * dy * weight,
        ]
    )


def _task_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reduce a task's rows to one row per column pair."""
    total = upper = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        raw = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype("float64")
        if upper is None:
            upper = np.triu_indices(raw.shape[1])
        part = _pair_moments(raw, upper)
        total = part if total is None else _merge_moments(total, part)
    if total is not None:
        arrays = [upper[0].astype("int32"), upper[1].astype("int32"), *total]
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=_NAMES)


def correlation_matrix(df: DataFrame, columns: Sequence[str], digits: int | None = 2) -> DataFrame:
    """Long (x, y, r): Pearson correlation of every ordered column pair.

    Pairs use the rows where both are present; r is null where a column of the
    pair does not vary. A task sends one row of sums per pair, never its rows,
    and the sums are merged about the overall mean.
    """
    moments = df.select(*[F.col(c).cast("double") for c in columns]).mapInArrow(_task_moments, _MOMENTS)
    pair = Window.partitionBy("x", "y")
    n = F.sum("n").over(pair)
    centred = moments.select(
        "*",
        F.try_divide(F.sum(F.col("n") * F.col("mx")).over(pair), n).alias("cx"),
        F.try_divide(F.sum(F.col("n") * F.col("my")).over(pair), n).alias("cy"),
    ).withColumns({"dx": F.col("mx") - F.col("cx"), "dy": F.col("my") - F.col("cy")})
    sums = centred.groupBy("x", "y").agg(
        F.sum("n").alias("n"),
        F.first("cx").alias("cx"),
        F.first("cy").alias("cy"),
        F.sum(F.expr("sxx + n * dx * dx")).alias("sxx"),
        F.sum(F.expr("syy + n * dy * dy")).alias("syy"),
        F.sum(F.expr("sxy + n * dx * dy")).alias("sxy"),
    )
    varies = F.expr(f"sxx > n * cx * cx * {_CONSTANT!r}D AND syy > n * cy * cy * {_CONSTANT!r}D")
    r = F.when(varies, F.least(F.greatest(F.expr("sxy / (sqrt(sxx) * sqrt(syy))"), F.lit(-1.0)), F.lit(1.0)))
    name = F.array(*[F.lit(c) for c in columns])
    upper = sums.select("x", "y", (r if digits is None else rint_round(r, digits)).alias("r"))
    # Mirrored row by row: a union of the table with itself would compute it twice.
    pair_of = F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y"))
    mirrored = F.when(F.col("x") == F.col("y"), F.array(pair_of[0])).otherwise(F.array(*pair_of))
    both = upper.select(F.explode(mirrored).alias("p"), "r")
    return both.select(name[F.col("p.x")].alias("x"), name[F.col("p.y")].alias("y"), "r")


def category_correlations(
    df: DataFrame, columns: Sequence[str], category: str, prefix: str, digits: int | None = 2
) -> DataFrame:
    """Long (x, y, r): correlation of every column with the 0/1 column of every category.

    The 0/1 columns are not made: one aggregation per category gives the sums. Pairs of 0/1
    columns are left out, as their correlation follows from the numbers of rows alone:
    -sqrt(p q / ((1 - p) (1 - q))) for shares p and q.
    """
    names = F.array(*[F.lit(c) for c in columns])
    pairs = F.arrays_zip(names.alias("x"), F.array(*[F.col(f"`{c}`").cast("double") for c in columns]).alias("v"))
    long = df.select(F.col(f"`{category}`").cast("string").alias("k"), F.inline(pairs)).toDF("k", "x", "v")
    per = long.where("v IS NOT NULL AND NOT isnan(v)").groupBy("x", "k").agg(
        F.count("*").cast("double").alias("n"), F.avg("v").alias("m"), (F.var_pop("v") * F.count("*")).alias("s")
    )
    # One row per column and category from here on.
    whole = Window.partitionBy("x")
    rows = F.sum("n").over(whole)
    mean = F.sum(F.col("n") * F.col("m")).over(whole) / rows
    shifted = per.withColumns({"rows": rows, "mean": mean})
    between = F.col("n") * (F.col("m") - F.col("mean")) * (F.col("m") - F.col("mean"))
    total = shifted.withColumn("spread", F.sum(F.col("s") + between).over(whole))
    varies = (F.col("spread") > F.col("rows") * F.col("mean") * F.col("mean") * _CONSTANT) & (F.col("n") < F.col("rows"))
    share = F.col("n") * (F.col("rows") - F.col("n")) / F.col("rows")
    r = F.when(varies, F.col("n") * (F.col("m") - F.col("mean")) / (F.sqrt("spread") * F.sqrt(share)))
    r = F.least(F.greatest(r, F.lit(-1.0)), F.lit(1.0))
    one = F.concat(F.lit(prefix), F.col("k"))
    found = total.where("k IS NOT NULL").select("x", one.alias("y"), (r if digits is None else rint_round(r, digits)).alias("r"))
    both = F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))
    return found.select(F.inline(both), "r").select("x", "y", "r")


def regression_metrics(
    df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()
) -> DataFrame:
    """rows, RMSE, MSE, MAE and R2 per group, in one pass."""
    y, e = F.col(label), F.col(label) - F.col(prediction)
    used = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    sums = used.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.avg(e * e).alias("mse"),
        F.avg(F.abs(e)).alias("mae"),
        F.var_pop(y).alias("_var"),
    )
    return sums.select(
        *by,
        "rows",
        F.sqrt("mse").alias("rmse"),
        "mse",
        "mae",
        (F.lit(1.0) - F.try_divide(F.col("mse"), F.col("_var"))).alias("r2"),
    )


def mean_metrics(per_fold: DataFrame, names: Sequence[str] = ("rmse", "mse", "mae", "r2")) -> DataFrame:
    """Unweighted mean of the fold metrics."""
    return per_fold.agg(*[F.avg(c).alias(c) for c in names])
