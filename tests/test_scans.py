"""How often a query reads its input, counted by the scans that ran."""

import pytest

from claimrisk.queries import QUERIES

LINES = 6000


def rows_read(spark, since, table="lineitem.parquet"):
    """Rows that scans of ``table`` put out in executions after ``since``."""
    store = spark._jsparkSession.sharedState().statusStore()
    executions = store.executionsList()
    total = 0
    for i in range(executions.size()):
        number = executions.apply(i).executionId()
        if number <= since:
            continue
        values = store.executionMetrics(number)
        nodes = store.planGraph(number).allNodes()
        for j in range(nodes.size()):
            node = nodes.apply(j)
            if node.name().startswith("Scan") and table in node.desc():
                metrics = node.metrics()
                for k in range(metrics.size()):
                    if metrics.apply(k).name() == "number of output rows":
                        found = values.get(metrics.apply(k).accumulatorId())
                        total += int(found.get().replace(",", "")) if found.isDefined() else 0
    return total


def last_execution(spark):
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    executions = spark._jsparkSession.sharedState().statusStore().executionsList()
    return max((executions.apply(i).executionId() for i in range(executions.size())), default=-1)


@pytest.mark.parametrize("name", [
    "provider_risk", "fct_provider_risk", "bronze_anomaly_flags", "bronze_money_summary",
    "dq_report", "dq_not_null", "dq_accepted_values", "dq_relationships", "features_median",
    "specialty_percentiles", "rationale_narrative", "ml_features_wide", "ml_label_any3", "serve_cohort"])
def test_the_input_is_read_once(name, spark, sf_dir):
    before = last_execution(spark)
    QUERIES[name](spark, sf_dir).collect()
    last_execution(spark)
    assert rows_read(spark, before) == LINES


def test_high_cost_claims_read_twice_and_store_the_top(spark, sf_dir):
    """Once for a sketch, once for the rows near the cut and above it: no other claim is stored or shuffled."""
    before = last_execution(spark)
    QUERIES["kpi_high_cost_claims"](spark, sf_dir).collect()
    last_execution(spark)
    assert rows_read(spark, before) == 2 * LINES
