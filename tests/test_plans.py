"""Properties of the physical plans that matter at scale."""

import pytest
from pyspark.sql import functions as F

from claimrisk.plans import gold, serving, silver
from claimrisk.schemas import RAW_SCHEMA
from claimrisk.sources.claims_mapping import raw_claims


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "clean")
    silver.clean(raw_claims(spark, sf_dir)).write.parquet(path)
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_do_not_shuffle_the_claims(stored):
    text = plan(silver.features(stored))
    assert "BroadcastHashJoin" in text
    assert "Exchange hashpartitioning" not in text and "Window" not in text


def test_peer_statistics_read_two_columns(stored):
    text = plan(silver.peer_stats(stored))
    schema = text.split("ReadSchema: ")[1].split("\n")[0]
    assert schema == "struct<specialty:string,avg_submitted_charge:double>"


def test_top_claims_are_a_filter(stored):
    text = plan(gold.kpi_high_cost_claims(stored))
    assert "Exchange" not in text and "Window" not in text


def test_cleaning_is_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([], RAW_SCHEMA).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    try:
        text = plan(silver.clean(spark.read.parquet(path)).select("provider_id"))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(Avg_Sbmtd_Chrg,0.01)" in text and "IsNotNull(Rndrng_NPI)" in text
    assert "ReadSchema: struct<Rndrng_NPI:bigint,Avg_Sbmtd_Chrg:double>" in text


def test_rank_never_windows_over_provider_rows(stored):
    text = plan(gold.provider_risk(silver.features(stored)))
    window = text.split("Window")[1]
    assert "provider_id" not in window


def test_cohort_is_a_top_k(spark, stored, tmp_path):
    risk = gold.provider_risk_from_claims(stored).withColumn("risk_score", F.lit(0.5))
    risk.write.parquet(str(tmp_path / "serving"))
    table = spark.read.parquet(str(tmp_path / "serving"))
    assert "TakeOrderedAndProject" in plan(serving.cohort(table, "Critical"))
    assert "EqualTo(provider_id,42)" in plan(
        serving.provider(table.withColumn("predicted_fraud", F.lit(0)), 42))


def test_distinct_procedures_are_counted_apart(raw, monkeypatch):
    """Measures are not shuffled once per procedure of a provider; missing keys and procedures count as before."""
    plans, real = [], gold.materialise_measured
    monkeypatch.setattr(gold, "materialise_measured", lambda df: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or real(df))
    claims = silver.clean(raw(
        {"HCPCS_Cd": "a"}, {"HCPCS_Cd": "a"}, {"HCPCS_Cd": "b"}, {"HCPCS_Cd": None},
        {"Rndrng_Prvdr_City": None, "HCPCS_Cd": None}, {"Rndrng_Prvdr_City": None, "HCPCS_Cd": None},
        {"Rndrng_Prvdr_Type": None, "HCPCS_Cd": "c"}))
    found = gold.provider_risk_from_claims(claims).select("specialty", "city", "total_procedures", "unique_procedures").collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [("Cardiology", "A", 4, 2), ("Cardiology", None, 2, 0), (None, "A", 1, 1)], key=str)
    by_procedure = [line for line in plans[0].splitlines() if "Aggregate(keys" in line and "procedure_code" in line.split("functions")[0]]
    assert by_procedure and all("functions=[]" in line for line in by_procedure)
