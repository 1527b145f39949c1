"""Row quality: deterministic dedup, duplicate and reject reports, null counts, cutoffs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FIXED_WIDTH = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.BooleanType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
    T.DecimalType,
)


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row of each key in the given order.

    ``order`` should be unique within a key. An aggregate instead of a ranking
    window: copies are merged on the map side, so a key that holds most of the
    rows costs one row per map task in the shuffle.
    """
    columns = df.columns
    rest = [c for c in columns if c not in keys]
    types = {f.name: f.dataType for f in df.schema}
    narrow = [*rest, *order]
    if len(order) == 1 and all(isinstance(types[c], _FIXED_WIDTH) for c in narrow):
        # Fixed-width buffers let Spark use the hash aggregate.
        firsts = [F.min_by(F.col(c), F.col(order[0])).alias(c) for c in rest]
        return df.groupBy(*keys).agg(*firsts).select(*columns)
    row = F.struct(*[F.col(c) for c in rest])
    rank = F.struct(*[F.col(c) for c in order])
    return (
        df.groupBy(*keys)
        .agg(F.min_by(row, rank).alias("_first"))
        .select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in columns])
    )


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every member of each key that occurs more than once (null keys count as equal)."""
    repeated = (
        df.groupBy(*[F.col(k).alias(f"_dup_{k}") for k in keys])
        .agg(F.count("*").alias("_n"))
        .where("_n > 1")
    )
    same = [df[k].eqNullSafe(repeated[f"_dup_{k}"]) for k in keys]
    return df.join(repeated, same, "left_semi")


def any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def split_rejects(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) by nulls in the required columns; together they are ``df``."""
    bad = any_null(required)
    return df.where(~bad), df.where(bad)


def reject_records(rejected: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Reject keys with the timestamp as ``yyyy-MM-dd HH:mm:ss`` text."""
    return rejected.select(
        *[
            F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if c == ts else F.col(c)
            for c in keys
        ]
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, nulls) for all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column", "nulls")


def missing_report(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Number of rows per group with a null in any of the columns."""
    return df.where(any_null(columns)).groupBy(*by).agg(F.count("*").alias("unmatched"))


def available_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in wanted if c in df.columns])


def drop_if_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def start_cutoff(
    df: DataFrame, valid_from: Mapping[int, str], key: str = "LocationCode", ts: str = "DateTime"
) -> DataFrame:
    """Drop each listed site's rows before its first valid moment; other sites are whole."""
    if not valid_from:
        return df
    cutoff = F.lit(None).cast("timestamp_ntz")
    for site, moment in valid_from.items():
        cutoff = F.when(F.col(key) == site, F.lit(moment).cast("timestamp_ntz")).otherwise(cutoff)
    return df.where(cutoff.isNull() | (F.col(ts) >= cutoff))


def union_sources(*sources: DataFrame, rank: str = "source_rank") -> DataFrame:
    """Union by name; ``rank`` is the position of the source, for keep-first dedup."""
    ranked = [df.withColumn(rank, F.lit(i)) for i, df in enumerate(sources)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)
