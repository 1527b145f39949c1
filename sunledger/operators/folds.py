"""Reproducible fold assignment: a column kept with the row's business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunledger.operators.ordering import add_positions

DEFAULT_FOLDS = 10
DEFAULT_SEED = 42


def key_digest(keys: Sequence[Column], seed: int = DEFAULT_SEED) -> Column:
    """md5 text of the key columns and the seed."""
    return F.md5(F.concat_ws("|", *[k.cast("string") for k in keys], F.lit(str(seed))))


def hash_fold(keys: Sequence[Column], folds: int = DEFAULT_FOLDS, seed: int = DEFAULT_SEED) -> Column:
    """Fold 0 .. folds-1 from the key alone: no shuffle, the same on any partitioning."""
    head = F.conv(F.substring(key_digest(keys, seed), 1, 8), 16, 10).cast("bigint")
    return (head % folds).cast("int")


def assign_folds(
    df: DataFrame, keys: Sequence[str], folds: int = DEFAULT_FOLDS, seed: int = DEFAULT_SEED
) -> DataFrame:
    return df.withColumn("fold", hash_fold([F.col(k) for k in keys], folds, seed))


def assign_day_folds(
    df: DataFrame, ts: str = "DateTime", folds: int = DEFAULT_FOLDS, seed: int = DEFAULT_SEED
) -> DataFrame:
    """All rows of a day in one fold, so that neighbouring minutes do not leak."""
    return df.withColumn("fold", hash_fold([F.to_date(ts)], folds, seed))


def assign_balanced_folds(
    df: DataFrame, keys: Sequence[str], folds: int = DEFAULT_FOLDS, seed: int = DEFAULT_SEED
) -> DataFrame:
    """Folds whose sizes differ by at most one row: shuffled by key digest, dealt in turn."""
    digested = df.withColumn("_digest", key_digest([F.col(k) for k in keys], seed))
    dealt = add_positions(digested, ["_digest", *keys], "_turn")
    return dealt.withColumn("fold", (F.col("_turn") % folds).cast("int")).drop("_digest", "_turn")


def fold_table(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What is stored to replay a split: (keys..., fold)."""
    return df.select(*keys, "fold")


def replay_folds(df: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the fold stored for their key; rows without one are left out.

    Copies of a key share its lowest stored fold.
    """
    per_key = stored.groupBy(*keys).agg(F.min("fold").alias("fold"))
    return df.join(per_key, list(keys))
