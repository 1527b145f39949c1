"""Writers: CSV at the edges, Parquet between stages, JSON rejects, training artifacts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.functions.numeric import fixed_text
from sunledger.operators.quality import reject_records


def write_csv(
    df: DataFrame, path: str, decimals: Mapping[str, int] | None = None, mode: str = "overwrite"
) -> None:
    """CSV with a header; listed columns get a fixed number of decimals."""
    texts = {c: fixed_text(F.col(c), digits) for c, digits in (decimals or {}).items()}
    for name, kind in df.dtypes:
        if kind == "timestamp_ntz":
            texts[name] = F.col(name).cast("string")  # with the fraction of a second, if any
    df.withColumns(texts).write.mode(mode).option("header", True).csv(path)


def write_by_site(
    df: DataFrame, path: str, site: str = "LocationCode", ts: str = "DateTime", mode: str = "overwrite"
) -> None:
    """Parquet partitioned by site and sorted by time inside each file.

    Tasks get equal ranges of (site, time), so a site with most of the rows is
    written by many of them, and few tasks write to more than one site.
    """
    spread = df.repartitionByRange(site, ts, F.xxhash64(*df.columns))
    spread.sortWithinPartitions(site, ts).write.mode(mode).partitionBy(site).parquet(path)


def in_site_text_order(df: DataFrame, site: str = "LocationCode", ts: str = "DateTime") -> DataFrame:
    """Global order by the site as text ("1", "10", ..., "2"), then time."""
    return df.orderBy(F.col(site).cast("string"), ts)


def write_rejects(
    rejected: DataFrame,
    path: str,
    keys: tuple[str, ...] = ("LocationCode", "DateTime"),
    ts: str = "DateTime",
) -> None:
    reject_records(rejected, keys, ts).write.mode("overwrite").json(path)


def write_table(df: DataFrame, path: str) -> None:
    """An artifact table: correlations, metrics, out-of-fold predictions, fold assignment."""
    df.write.mode("overwrite").parquet(path)
