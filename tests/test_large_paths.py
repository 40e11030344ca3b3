"""Whole queries on the paths of large inputs, with a third of all rows on one key, against SQL."""

import glob
import os

import duckdb
import pytest
from compare import connect, differences

from claimrisk.operators import lookup_join, ordered
from claimrisk.oracles import ORACLES
from claimrisk.queries import QUERIES


@pytest.fixture(scope="module")
def skewed(sf_dir, tmp_path_factory):
    """The tables, with a third of the orders and of the lines on one customer and one part."""
    folder = tmp_path_factory.mktemp("skewed")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)
        select = {
            "orders.parquet": "* REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey)",
            "lineitem.parquet": "* REPLACE (CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_partkey END AS l_partkey)",
        }.get(name, "*")
        duckdb.sql(f"COPY (SELECT {select} FROM '{path}') TO '{folder}/{name}' (FORMAT parquet)")
    return str(folder)


@pytest.fixture
def small_limits(monkeypatch):
    monkeypatch.setattr(lookup_join, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(lookup_join, "HEAVY_SHARE", 4)
    monkeypatch.setattr(ordered, "ONE_TASK_ROWS", 40)
    monkeypatch.setattr(ordered, "SMALL_GROUP", 20)


@pytest.mark.parametrize("name", [
    "provider_risk", "fct_provider_risk", "specialty_percentiles", "kpi_high_cost_claims", "ml_auc_roc",
    "features_median", "ml_avg_precision", "silver_features"])
def test_same_as_sql(name, spark, skewed, small_limits):
    assert differences(QUERIES[name](spark, skewed), connect(skewed), ORACLES[name]) == ""
