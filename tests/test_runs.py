"""The whole chain of tables, and the serving queries on its result."""

import pytest
from pyspark.sql import functions as F

from claimrisk.plans import gold, runs, serving
from claimrisk.schemas import FEATURE_COLUMNS, CLEAN_COLUMNS, TIERS
from claimrisk.sources.claims_mapping import raw_claims


@pytest.fixture(scope="module")
def done(spark, sf_dir, tmp_path_factory):
    schemas = {layer: f"run_{layer}" for layer in runs.SCHEMAS}
    return runs.run_all(spark, raw=raw_claims(spark, sf_dir), schemas=schemas, rounds=2, depth=2,
                        model_path=str(tmp_path_factory.mktemp("model") / "saved"))


@pytest.fixture(scope="module")
def served(spark, done):
    return spark.table("run_gold.serving_provider_risk")


def test_rows_and_columns(done, spark):
    shape = {r.table_name: (r.rows, r.columns) for r in done[0].collect()}
    assert shape["run_silver.cms_claims_clean"] == (6000, 30)
    assert shape["run_silver.cms_claims_features"] == (6000, 37)
    assert shape["run_gold.provider_risk"] == shape["run_marts.fct_provider_risk"] == (150, 20)
    assert shape["run_gold.kpi_high_cost_claims"] == (60, 10)
    assert spark.table("run_silver.cms_claims_features").columns == CLEAN_COLUMNS + FEATURE_COLUMNS
    assert len(spark.table("run_marts.stg_cms_claims").columns) == 27
    assert len(spark.table("run_marts.int_provider_stats").columns) == 17


def test_model_tables(done, spark):
    shape = {r.table_name: (r.rows, r.columns) for r in done[0].collect()}
    assert shape["run_bronze.quality_report"] == (5, 2)
    assert shape["run_gold.ml_provider_scores"][0] == shape["run_gold.serving_provider_risk"][0] == 150
    assert shape["run_gold.ml_importance"] == shape["run_gold.ml_shap_importance"] == (9, 2)
    assert shape["run_gold.ml_attributions"][0] == shape["run_gold.ml_rationales"][0] == 150
    scores, served = spark.table("run_gold.ml_provider_scores"), spark.table("run_gold.serving_provider_risk")
    assert served.columns == [*scores.columns, "risk_tier", "total_billed"]
    mart = spark.table("run_marts.fct_provider_risk")
    joined = serving.serving_provider_risk(scores, mart)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, served.collect()))


def test_held_out_figures(done, spark):
    figures = {(r.feature_set, r.metric, r["class"]): r.value for r in spark.table("run_gold.ml_evaluation").collect()}
    held = spark.table("run_gold.ml_provider_scores").filter("split = 'test'")
    for name in ("reference", "no_leak"):
        assert figures[name, "support", "Fraud"] == held.filter("fraud_flag = 1").count()
        assert 0 <= figures[name, "average_precision", "all"] <= 1
    assert figures["reference", "auc_roc", "all"] == 1.0 and figures["no_leak", "auc_roc", "all"] < 1.0


def test_saved_model_scores_alike(spark, sf_dir, tmp_path):
    from claimrisk.plans import ml

    schemas = {layer: f"saved_{layer}" for layer in runs.SCHEMAS}
    runs.run_all(spark, bronze_table="run_bronze.bronze_cms_raw", schemas=schemas, rounds=1, depth=1,
                 model_path=str(tmp_path / "m"))
    scores = spark.table("saved_gold.ml_provider_scores")
    again = ml.score(scores.drop("risk_score", "predicted_fraud"), ml.load_model(str(tmp_path / "m")))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, scores.collect()))


def test_lookup_is_rounded_for_display(served):
    row, shown = serving.provider(served, 42).first(), serving.displayed(serving.provider(served, 42)).first()
    assert (shown.risk_score, shown.avg_charge_ratio) == (round(row.risk_score, 4), round(row.avg_charge_ratio, 2))


def test_data_tests(done):
    failures = {(r.table_name, r.test, r.column_name): r.failures for r in done[1].collect()}
    assert len(failures) == 9
    assert [k[1:] for k, n in failures.items() if n] == [
        ("unique", "provider_id+procedure_code+place_of_service")]


def test_views_follow_the_stored_tables(spark, done):
    stats, mart = spark.table("run_marts.int_provider_stats"), spark.table("run_marts.fct_provider_risk")
    assert sorted(map(tuple, stats.collect())) == sorted(tuple(r)[:17] for r in mart.collect())


def test_tiers_partition_the_providers(spark, done):
    risk = spark.table("run_gold.provider_risk")
    tiers = {r.risk_tier: r for r in gold.tier_billed(risk).collect()}
    assert {t: tiers[t].providers for t in TIERS} == {"Critical": 83, "Elevated": 50, "Normal": 17}
    total = risk.agg(F.sum("total_billed")).first()[0]
    assert sum(r.total_billed_usd for r in tiers.values()) == pytest.approx(total)


def test_repeat_from_the_stored_bronze_table(spark, done):
    schemas = {layer: f"again_{layer}" for layer in runs.SCHEMAS}
    report, _ = runs.run_all(spark, bronze_table="run_bronze.bronze_cms_raw", schemas=schemas,
                             rounds=1, depth=1, dedupe=True)
    shape = {r.table_name: r.rows for r in report.collect()}
    assert "again_bronze.bronze_cms_raw" not in shape
    assert shape["again_silver.cms_claims_clean"] < 6000


def test_lookup(served):
    best = served.filter("provider_id = 42").orderBy(F.desc("total_billed")).first()
    row = serving.provider(served, 42).collect()
    assert [r.total_billed for r in row] == [best.total_billed]
    assert serving.provider(served, -1).count() == 0


def test_cohort_filters(served):
    assert serving.cohort(served, risk_tier="", state=None, limit=1000).count() == 150
    picked = serving.cohort(served, risk_tier="Critical", state="NATION_1", limit=1000).collect()
    assert len(picked) == served.filter("risk_tier = 'Critical' and state = 'NATION_1'").count()
    assert serving.cohort(served, specialty="x' OR '1'='1").count() == 0
    scores = [r.risk_score for r in serving.cohort(served, limit=20).collect()]
    assert scores == sorted(scores, reverse=True) and len(scores) == 20


def test_summary_and_map(served):
    assert sum(r.provider_count for r in serving.summary(served).collect()) == 150
    assert sum(r.providers for r in serving.state_risk(served).collect()) == 150


def test_csv_export(spark, served, tmp_path):
    serving.export_cohort(served, str(tmp_path / "out"), risk_tier="Critical", limit=10)
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.count() == 10 and back.columns[:2] == ["provider_id", "specialty"]


def test_null_keys_join(spark, served):
    keys = {k: F.lit(None).cast("string") for k in ("specialty", "state", "city", "zip_code", "entity_code")}
    scores = served.limit(1).drop("risk_tier", "total_billed").withColumns(keys)
    mart = served.limit(1).withColumns(keys)
    assert serving.serving_provider_risk(scores, mart).first().risk_tier is not None


def test_a_run_that_fails_leaves_the_former_tables(spark, sf_dir, tmp_path, monkeypatch):
    from claimrisk.sources import tables

    schemas = {layer: f"fails_{layer}" for layer in runs.SCHEMAS}
    raw = raw_claims(spark, sf_dir)

    def run(rows, **options):
        return runs.run_all(spark, raw=rows, schemas=schemas, rounds=1, depth=1, model_path=str(tmp_path / "m"), **options)

    def names():
        return {(s, t.name) for s in schemas.values() for t in spark.catalog.listTables(s)}

    run(raw)
    first, before = names(), sorted(map(tuple, spark.table("fails_gold.serving_provider_risk").collect()))
    version = tables.published_version(spark, "fails_gold.provider_risk")
    with monkeypatch.context() as broken:
        broken.setattr(runs.explain, "rationale", None)
        with pytest.raises(TypeError):
            run(raw.filter("Rndrng_NPI % 2 = 0"))
    assert tables.published_version(spark, "fails_gold.provider_risk") == version
    assert sorted(map(tuple, spark.table("fails_gold.serving_provider_risk").collect())) == before
    assert spark.table("fails_marts.stg_cms_claims").count() == 6000
    run(raw.filter("Rndrng_NPI % 2 = 0"))
    assert spark.table("fails_gold.serving_provider_risk").count() < len(before)
    assert tables.published_version(spark, "fails_gold.provider_risk") != version
    # Of each table its view, this version and the one before are there; those of the broken run are not.
    assert len(names()) == len(first) + len([n for n in first if "__" in n[1]])


def test_a_plain_table_gives_way_to_the_view(spark):
    from claimrisk.sources import tables

    tables.create_schema(spark, "publish_test")
    tables.write_table(spark.range(3), "publish_test.t")
    tables.write_version(spark.range(5), "publish_test.t", "a")
    assert tables.published_version(spark, "publish_test.t") is None and spark.table("publish_test.t").count() == 3
    tables.publish(spark, "publish_test.t", "a")
    assert spark.table("publish_test.t").count() == 5
    for version, rows in (("b", 7), ("c", 9)):
        tables.write_version(spark.range(rows), "publish_test.t", version)
        tables.publish(spark, "publish_test.t", version)
    assert spark.table("publish_test.t").count() == 9
    assert {t.name for t in spark.catalog.listTables("publish_test")} == {"t", "t__b", "t__c"}
