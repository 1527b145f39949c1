"""Properties of the plans: shared folder, restart safety, independence of partitioning."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sunledger import session
from sunledger.catalog import queries, views
from sunledger.operators import folds, joins, ordering, quality
from sunledger.operators.features import LABEL
from sunledger.plans import power, weather

SF_DIR = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_tables_go_to_the_configured_folder(spark):
    base = spark.sparkContext.getConf().get(session.CHECKPOINT_KEY)
    assert session.shared_dir(spark) == base
    written = session.materialise(spark.range(5), "probe")
    assert written.inputFiles() and all(f"{base}/probe-" in f for f in written.inputFiles())
    assert written.dtypes == spark.range(5).dtypes


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Context:
        master = "yarn"
        applicationId = "app"

        def getConf(self):
            return {}

    class Session:
        conf = {}
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="shared folder"):
        session.shared_dir(Session())


@pytest.mark.parametrize("parts", [1, 7, 32])
def test_results_do_not_depend_on_partitioning(spark, small_chunks, parts):
    rows = views.power(spark, SF_DIR)
    seen = weather.repair_weather(views.weather_raw(spark, SF_DIR), ["time", "event_id"])
    order = ["DateTime", "event_id"]
    once = weather.add_weather(rows, seen, order, sequence="event_id")
    again = weather.add_weather(rows.repartition(parts), seen.repartition(parts), order, sequence="event_id")
    assert rows_of(once) == rows_of(again)
    assert rows_of(power.dedup_minutes(rows, ["event_id"])) == rows_of(
        power.dedup_minutes(rows.repartition(parts), ["event_id"])
    )
    means = joins.slot_means_aligned(rows, LABEL)
    assert rows_of(means) == rows_of(joins.slot_means_aligned(rows.repartition(parts), LABEL))


def test_accepted_and_rejected_are_the_input(spark):
    good, bad = queries._insolation_split(spark, SF_DIR)
    assert good.count() + bad.count() == views.events(spark, SF_DIR).count()


def test_folds_are_disjoint_and_cover(spark):
    rows = folds.assign_folds(views.power(spark, SF_DIR), ["event_id"])
    total = rows.count()
    for k in range(10):
        valid, train = rows.where(F.col("fold") == k), rows.where(F.col("fold") != k)
        assert valid.count() + train.count() == total
    stored = folds.fold_table(rows, ["event_id"])
    twice = folds.replay_folds(views.power(spark, SF_DIR), stored.unionAll(stored), ["event_id"])
    assert rows_of(twice) == rows_of(rows)


def test_only_bounded_tables_are_windowed_without_a_key(spark):
    """The one task of an unpartitioned window sees one row per partition or day."""
    filled = ordering.forward_fill(views.power(spark, SF_DIR), [LABEL], ["DateTime", "event_id"])
    text = filled._jdf.queryExecution().optimizedPlan().toString()
    single = [line for line in text.splitlines() if "Window [" in line and "_chunk" not in line]
    assert single and all("_part" in line for line in single)


def test_hot_key_reports_use_partial_aggregates(spark):
    for df in (
        quality.duplicate_rows(views.power(spark, SF_DIR), ["LocationCode"]),
        joins.slot_means_aligned(views.power(spark, SF_DIR), LABEL),
    ):
        assert "partial_" in df._jdf.queryExecution().executedPlan().toString()
