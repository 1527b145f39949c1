"""Operators that depend on the order of the rows of a long series.

A window over a whole series would put it into one task. Instead the rows are
range-partitioned and sorted once, numbered and written to the shared folder;
the row number then cuts the series into chunks of a fixed largest size, however
the rows are spread over time or keys. Windows run inside chunks, and what
crosses a chunk border is carried on two small tables: one row per chunk, and
one row per range partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger.functions.numeric import line_value
from sunledger.session import materialise

ROW = "_row"
CHUNK_BITS = 18  # at most 262,144 rows in a chunk
PARTITION_BITS = 33  # monotonically_increasing_id: partition above, index below


def number_rows(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Globally sorted rows with a rising ``_row`` number, written once.

    ``order`` must be unique per row, so that no key value is too big to split
    and a re-run task numbers its rows the same way.
    """
    numbered = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(ROW, F.monotonically_increasing_id())
    )
    return materialise(numbered, "ordered")


def with_position(numbered: DataFrame, name: str = "_pos") -> DataFrame:
    """Add the gap-free 0-based position of each numbered row."""
    part = F.shiftright(F.col(ROW), PARTITION_BITS)
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start")
    )
    # One row per range partition, so its size is set by configuration, not by data.
    index = F.col(ROW) - F.shiftleft(F.col("_part"), PARTITION_BITS)
    return (
        numbered.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + index)
        .drop("_part", "_start")
    )


def add_positions(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """0-based position of every row in the global order."""
    return with_position(number_rows(df, order), name).drop(ROW)


def running_sums(numbered: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace number columns by their sums over all rows up to and with each row; null counts as 0.

    Decimals are added exactly. Sums run inside chunks; those of earlier chunks and of earlier
    range partitions are added from two small tables.
    """
    kinds = {f.name: f.dataType for f in numbered.schema}

    def total(c: str, window=None) -> Column:
        whole = F.sum(F.coalesce(F.col(c), F.lit(0).cast(kinds[c])))
        whole = whole if window is None else whole.over(window)
        # Room for two more additions without losing a digit.
        return whole.cast("decimal(36,9)") if kinds[c].typeName() == "decimal" else whole

    def sums(window, name: str) -> list[Column]:
        return [total(c, window).alias(f"{name}{c}") for c in columns]

    keyed = numbered.withColumn("_chunk", F.shiftright(F.col(ROW), CHUNK_BITS))
    inside = Window.partitionBy("_chunk").orderBy(ROW).rowsBetween(Window.unboundedPreceding, 0)
    rows = keyed.select("*", *sums(inside, "_in_"))
    chunks = keyed.groupBy("_chunk").agg(*[total(c).alias(c) for c in columns])
    chunks = chunks.withColumn("_part", F.shiftright(F.col("_chunk"), PARTITION_BITS - CHUNK_BITS))
    parts = chunks.groupBy("_part").agg(*[total(c).alias(c) for c in columns])
    earlier = Window.partitionBy("_part").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    near = chunks.select("_chunk", "_part", *sums(earlier, "_near_"))
    # One row per range partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    far = parts.select("_part", *sums(before, "_far_"))
    carried = near.join(F.broadcast(far), "_part")
    zero = F.lit(0)
    run = {
        c: F.col(f"_in_{c}") + F.coalesce(F.col(f"_near_{c}"), zero) + F.coalesce(F.col(f"_far_{c}"), zero)
        for c in columns
    }
    return rows.join(carried, "_chunk").withColumns(run).select(*numbered.columns)


def forward_fill(
    df: DataFrame, columns: Sequence[str], order: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Replace nulls with the last earlier non-null value of the same series."""
    numbered = number_rows(df, [*by, *order])
    anchored = _with_anchors(numbered, columns, by, extra=(), following=False)
    filled = {c: F.coalesce(F.col(c), F.col(f"_prev_{c}.value")) for c in columns}
    return anchored.withColumns(filled).select(*df.columns)


def interpolate_rows(
    df: DataFrame, columns: Sequence[str], order: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Fill null runs on a straight line over row positions.

    Rows count as equally spaced. Leading nulls stay null; trailing nulls repeat
    the last value.
    """
    numbered = with_position(number_rows(df, [*by, *order]))
    anchored = _with_anchors(numbered, columns, by, extra=("_pos",), following=True)

    def filled(c: str) -> Column:
        before, after = F.col(f"_prev_{c}"), F.col(f"_next_{c}")
        inside = line_value(
            before["value"],
            after["value"],
            after["_pos"] - before["_pos"],
            F.col("_pos") - before["_pos"],
        )
        return (
            F.when(F.col(c).isNotNull(), F.col(c))
            .when(after.isNotNull() & before.isNotNull(), inside)
            .otherwise(before["value"])
        )

    return anchored.withColumns({c: filled(c) for c in columns}).select(*df.columns)


def _with_anchors(
    numbered: DataFrame,
    columns: Sequence[str],
    by: Sequence[str],
    extra: Sequence[str],
    following: bool,
) -> DataFrame:
    """Add ``_prev_<c>`` (and ``_next_<c>``): the nearest non-null sample of the same
    series before (after) each row, as struct(value, extra..., by...)."""
    names = [("_prev_", c) for c in columns]
    if following:
        names += [("_next_", c) for c in columns]
    keyed = numbered.withColumn("_chunk", F.shiftright(F.col(ROW), CHUNK_BITS))

    def sample(c: str) -> Column:
        fields = [F.col(c).alias("value"), *map(F.col, extra), *map(F.col, by)]
        return F.when(F.col(c).isNotNull(), F.struct(*fields))

    # A frame that ends at the partition's end is quadratic in Spark; the
    # following sample is therefore the preceding one in descending order.
    chunk = Window.partitionBy("_chunk")
    until = {
        "_prev_": chunk.orderBy(ROW).rowsBetween(Window.unboundedPreceding, 0),
        "_next_": chunk.orderBy(F.col(ROW).desc()).rowsBetween(Window.unboundedPreceding, 0),
    }
    rows = keyed
    for c in columns:
        rows = rows.withColumn(f"_s_{c}", sample(c))
    for side, c in names:
        nearest = F.last(F.col(f"_s_{c}"), ignorenulls=True).over(until[side])
        rows = rows.withColumn(f"_in{side}{c}", nearest)

    edges = keyed.groupBy("_chunk").agg(
        *[_edge(side)(sample(c), F.when(F.col(c).isNotNull(), F.col(ROW))).alias(side + c)
          for side, c in names]
    )
    joined = rows.join(_carry_over_chunks(edges, names), "_chunk", "left")

    def same_series(a: Column) -> Column:
        checks = [a[k].eqNullSafe(F.col(k)) for k in by]
        return F.when(_all_of(checks), a) if checks else a

    # A sample inside the chunk hides any further away, even one of another series.
    chosen = {
        side + c: same_series(F.coalesce(F.col(f"_in{side}{c}"), F.col(f"_out{side}{c}")))
        for side, c in names
    }
    return joined.withColumns(chosen)


def _edge(side: str):
    return F.max_by if side == "_prev_" else F.min_by


def _all_of(conditions: Sequence[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result & condition
    return result


def _carry_over_chunks(edges: DataFrame, names: Sequence[tuple[str, str]]) -> DataFrame:
    """For each chunk the nearest sample before its first (after its last) row.

    The chunks of one range partition are scanned in one window; a second scan
    over one row per range partition links the partitions.
    """
    part = F.shiftright(F.col("_chunk"), PARTITION_BITS - CHUNK_BITS)
    edges = edges.withColumn("_part", part)
    parts = edges.groupBy("_part").agg(
        *[_edge(side)(F.col(side + c), F.when(F.col(side + c).isNotNull(), F.col("_chunk")))
          .alias(side + c)
          for side, c in names]
    )

    def scan(df: DataFrame, key: str, group: Sequence[str], tag: str) -> DataFrame:
        window = Window.partitionBy(*group)
        outside = {
            "_prev_": window.orderBy(key),
            "_next_": window.orderBy(F.col(key).desc()),
        }
        for side, c in names:
            frame = outside[side].rowsBetween(Window.unboundedPreceding, -1)
            df = df.withColumn(
                f"{tag}{side}{c}", F.last(F.col(side + c), ignorenulls=True).over(frame)
            )
        return df

    far = scan(parts, "_part", [], "_far").select(
        "_part", *[f"_far{side}{c}" for side, c in names]
    )
    near = scan(edges, "_chunk", ["_part"], "_near")
    return near.join(F.broadcast(far), "_part", "left").select(
        "_chunk",
        *[
            F.coalesce(F.col(f"_near{side}{c}"), F.col(f"_far{side}{c}")).alias(f"_out{side}{c}")
            for side, c in names
        ],
    )
