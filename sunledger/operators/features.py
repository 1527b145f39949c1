"""Model features: calendar parts, one-hot sites, feature sets, alignment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.functions.temporal import calendar_parts

LABEL = "Power(mW)"
PREDICTION = "Predicted_Power(mW)"
ONE_HOT_PREFIX = "LocationCode_"
CALENDAR = ("Hour", "Minute", "Month")

# The measures of each model variant, in training order.
_BASE = ("H_UVI_TEMP_interaction", "GHI", "Azimuth", "Elevation", "Solarinsolation")
_FULL = (*_BASE, "angle", "story", "DHI", "DNI")
FEATURE_SETS: dict[str, tuple[str, ...]] = {
    "base": _BASE,
    "angle": (*_BASE, "angle"),
    "full": _FULL,
    "pseudo": _FULL,
}


def add_calendar(df: DataFrame, ts: str = "DateTime") -> DataFrame:
    return df.withColumns(calendar_parts(F.col(ts)))


def fit_categories(df: DataFrame, column: str = "LocationCode") -> list[str]:
    """The distinct values as text, in text order ("1", "10", ..., "17", "2").

    They name the columns of a model and are stored with it, so the driver holds one
    short text per category, however many rows there are.
    """
    found = df.select(F.col(column).cast("string").alias("value")).where(F.col("value").isNotNull()).distinct()
    return sorted(row["value"] for row in found.toLocalIterator())


def one_hot(
    df: DataFrame, categories: Sequence[str], column: str = "LocationCode", prefix: str = ONE_HOT_PREFIX
) -> DataFrame:
    """A 0/1 column per category; a value that is no category has zeros only."""
    # Compared in the column's own type: cheaper per row than as text.
    kind = df.schema[column].dataType
    return df.withColumns(
        {
            f"{prefix}{value}": F.when(F.col(column) == F.lit(value).try_cast(kind), 1.0).otherwise(0.0)
            for value in categories
        }
    )


def feature_names(variant: str, categories: Sequence[str]) -> list[str]:
    return [*FEATURE_SETS[variant], *CALENDAR, *[f"{ONE_HOT_PREFIX}{c}" for c in categories]]


def training_matrix(
    df: DataFrame,
    variant: str,
    categories: Sequence[str],
    keys: Sequence[str] = ("LocationCode", "DateTime"),
    null_policy: str = "drop",
) -> DataFrame:
    """Keys, all features as doubles and the label.

    ``null_policy="drop"`` removes rows with any null feature, ``"zero"`` fills them.
    """
    features = feature_names(variant, categories)
    wide = one_hot(add_calendar(df), categories)
    matrix = wide.select(
        *keys, *[F.col(c).cast("double").alias(c) for c in features], F.col(LABEL).cast("double")
    )
    if null_policy == "drop":
        return matrix.dropna(subset=features)
    if null_policy == "zero":
        return matrix.fillna(0.0, subset=features)
    raise ValueError(f"unknown null policy {null_policy!r}")


def align_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The saved feature list in its order: absent columns and nulls are 0, others are dropped."""
    have = set(df.columns)
    return df.select(
        *keep,
        *[
            F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) if c in have else F.lit(0.0).alias(c)
            for c in features
        ],
    )


def site_dimension(spark, attributes: Mapping[int, tuple[int, int]] | None = None) -> DataFrame:
    """(LocationCode, angle, story) for the measuring sites."""
    rows = ", ".join(f"({k}, {a}, {s})" for k, (a, s) in (attributes or SITE_ATTRIBUTES).items())
    # Literal rows have a known size, so that the join is planned as a broadcast.
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(LocationCode, angle, story)")


# Panel azimuth in degrees and floor of each site.
SITE_ATTRIBUTES: dict[int, tuple[int, int]] = {
    1: (181, 5),
    2: (175, 5),
    3: (180, 5),
    4: (161, 5),
    5: (208, 5),
    6: (208, 5),
    7: (172, 5),
    8: (219, 3),
    9: (151, 3),
    10: (223, 1),
    11: (131, 1),
    12: (298, 1),
    13: (249, 5),
    14: (197, 5),
    15: (127, 1),
    16: (82, 1),
    17: (200, 1),
}
