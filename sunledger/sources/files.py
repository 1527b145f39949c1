"""Batch readers for the CSV and JSON inputs."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger import schemas
from sunledger.functions.numeric import to_number
from sunledger.functions.temporal import as_datetime, slash_datetime


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: str, **options) -> DataFrame:
    """CSV with a header line and a known schema.

    A header with fewer or more columns than the schema is allowed: columns are
    matched by name.
    """
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.options(header=True, enforceSchema=False, **options).schema(schema).csv(paths)


def read_text_columns(spark: SparkSession, path: str | Sequence[str], **options) -> DataFrame:
    """CSV with every column as text, named by the header line."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.options(header=True, inferSchema=False, **options).csv(paths)


#: A row's place in its files: path, block, and row within the scan of the block.
FILE_ORDER = "file_order"


def _file_order() -> Column:
    return F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    ).alias(FILE_ORDER)


def read_site_files(
    spark: SparkSession, path_glob: str, pattern: str = r"^L(\d+)_", ordered: bool = False
) -> DataFrame:
    """Per-site power files as one table; ``site_file`` is the site number in the file name.

    Sites have different optional columns, so a row is read by the header line of its own
    file. One scan finds the header of every file, another reads all lines and joins them to
    their header: the plan does not grow with the files. The driver sees the distinct headers
    alone. A line that repeats its file's header is no row, and a quoted value may not run
    over several lines. Files that vanish are skipped; no file at all is an error.
    """
    lines = (
        spark.read.option("ignoreMissingFiles", True)
        .text(path_glob)
        .select(
            "value",
            F.col("_metadata.file_path").alias("_path"),
            F.col("_metadata.file_name").alias("_name"),
            F.col("_metadata.file_block_start").alias("_block"),
            *[_file_order()] * ordered,
        )
        .where(F.trim("value") != "")
    )
    # Lines of a block are numbered in their order.
    placed = lines.withColumn("_line", F.monotonically_increasing_id())
    headers = placed.groupBy("_path").agg(F.min_by("value", F.struct("_block", "_line")).alias("_header"))
    named = [
        [n.strip() for n in next(csv.reader([r[0].removeprefix("\ufeff")]))]
        for r in headers.select("_header").distinct().collect()
    ]
    columns = list(dict.fromkeys(n for names in sorted(named) for n in names if n))
    width = max((len(names) for names in named), default=0)
    schema = ", ".join(f"f{i} string" for i in range(width))

    def fields(text: Column) -> Column:
        parsed = F.from_csv(text, F.lit(schema))
        return F.array(*[parsed[f"f{i}"] for i in range(width)])

    if not columns:
        raise ValueError(f"{path_glob} has no header line")
    bare = F.regexp_replace("_header", "^\ufeff", "")
    known = headers.select("_path", "_header", F.transform(fields(bare), F.trim).alias("_names"))
    rows = lines.join(known, "_path").where(F.col("value") != F.col("_header")).withColumn("_fields", fields(F.col("value")))

    def own(name: str) -> Column:
        place = F.coalesce(F.array_position("_names", name), F.lit(0))
        text = F.when(place > 0, F.get("_fields", (place - 1).cast("int")))
        return _SITE_TYPES.get(name, _as_is)(text).alias(name)

    site = F.regexp_extract("_name", pattern, 1).try_cast("int")
    return rows.select(*[own(c) for c in columns], site.alias("site_file"), *[F.col(FILE_ORDER)] * ordered)


def _as_is(c: Column) -> Column:
    return c


_SITE_TYPES = {
    "LocationCode": lambda c: c.try_cast("int"),
    "DateTime": as_datetime,
    "Power(mW)": lambda c: c.try_cast("double"),
    **{name: (lambda c: c.try_cast("double")) for name in schemas.STATION_SENSORS},
}


def read_station_lines(
    spark: SparkSession, path: str, ordered: bool = False, columns: Sequence[str] | None = None
) -> DataFrame:
    """Every line of a station export: DateTime, Solarinsolation, ``text`` and ``reason``.

    One parse; a line with too few or too many fields has its text and the reason
    "malformed", one without a usable time the reason "untimed". Blank text is null. The
    first line names the columns unless ``columns`` does.
    """
    names = list(columns or read_text_columns(spark, path).columns)
    schema = ", ".join(f"`{n}` string" for n in [*names, schemas.CORRUPT])
    # Without column pruning the parser sees every field, and so the surplus ones.
    options = {"header": columns is None, "columnNameOfCorruptRecord": schemas.CORRUPT, "columnPruning": False}
    raw = spark.read.options(**options).schema(schema).csv(path)
    bad = F.col(schemas.CORRUPT).isNotNull()

    def sound(name: str) -> Column:
        return F.when(~bad, F.nullif(F.trim(F.col(f"`{name}`")), F.lit("")))

    time = as_datetime(sound("DateTime"))
    return raw.select(
        time.alias("DateTime"),
        to_number(sound("Solarinsolation")).alias("Solarinsolation"),
        F.coalesce(F.col(schemas.CORRUPT), F.concat_ws(",", *[F.col(f"`{n}`") for n in names])).alias("text"),
        F.when(bad, F.lit("malformed")).when(time.isNull(), F.lit("untimed")).alias("reason"),
        *[_file_order()] * ordered,
    )


def read_station_hourly(spark: SparkSession, path: str, ordered: bool = False) -> DataFrame:
    """Station export without its malformed lines."""
    lines = read_station_lines(spark, path, ordered)
    return lines.where(~F.col("reason").eqNullSafe(F.lit("malformed"))).drop("text", "reason")


def read_slash_series(spark: SparkSession, path: str, value: str = "Solarinsolation") -> DataFrame:
    """Series stored with ``yyyy/MM/dd HH:mm`` timestamps."""
    raw = read_text_columns(spark, path)
    return raw.select(
        slash_datetime(F.col("DateTime")).alias("DateTime"), F.col(value).try_cast("double").alias(value)
    )


def read_weather(spark: SparkSession, path: str, ordered: bool = False) -> DataFrame:
    """Polled weather rows; measures stay text so that cleaning can judge them."""
    raw = read_text_columns(spark, path)
    return raw.select(as_datetime(F.col("time")).alias("time"), "H_UVI", "TEMP", *[_file_order()] * ordered)


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """Slot questions with the serial as text."""
    return read_text_columns(spark, path).select(F.col(schemas.SERIAL).alias("serial"))


def read_payloads(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON payload files, one document per file; unreadable ones are in ``_corrupt_record``."""
    return (
        spark.read.schema(f"{schema}, {schemas.CORRUPT} string")
        .option("multiLine", True)
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .json(path)
    )


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df
