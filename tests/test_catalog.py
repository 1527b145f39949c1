"""Every registered query against its SQL, and the shape of the plans."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import DataFrameWriter

import __spark_entry__ as entry
from sunledger.catalog.oracles import ORACLES
from sunledger.catalog.queries import REGISTRY as QUERIES
from tools import check

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF_DIR)


def test_entry_serves_the_catalog():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"gbt_early_stopping", "gbt_sweep"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    verdict = check.compare(duck, name, QUERIES[name](spark, SF_DIR))
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(ORACLES) - {n for n in ORACLES if n.startswith("gbt_")}))
def test_no_pairwise_joins(spark, name, monkeypatch):
    """In the plan of the result and of every table that is written on the way."""
    plans, write = [], DataFrameWriter.parquet

    def noted(writer, *args, **kwargs):
        plans.append(plan(writer._df))
        return write(writer, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    plans.append(plan(QUERIES[name](spark, SF_DIR)))
    assert not [p for p in plans if "NestedLoop" in p or "CartesianProduct" in p]


@pytest.mark.parametrize("name", ["training_feature_rejects", "irradiance_json_rejects", "reject_rows", "serial_rejects"])
def test_reject_queries_have_rows(duck, name):
    assert duck.sql(f"SELECT count(*) FROM ({ORACLES[name]})").fetchall()[0][0] > 0


def test_scan_reads_only_what_is_used(spark):
    text = plan(QUERIES["slot_mean_answer"](spark, SF_DIR))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == ["ts", "user_id", "value"]
    text = plan(QUERIES["interpolate_weather"](spark, SF_DIR))
    assert "partial_avg" not in text


def test_filters_reach_the_scan(spark):
    text = plan(QUERIES["asof_weather"](spark, SF_DIR))
    assert "EqualTo(event_type,view)" in text
