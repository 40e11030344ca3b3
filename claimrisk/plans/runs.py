"""The whole chain of tables in dependency order, with measured row counts."""

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from claimrisk.plans import bronze, explain, gold, marts, ml, quality, serving, silver
from claimrisk.plans.provider_state import ProviderState
from claimrisk.schemas import FEATURE_SETS, PROVIDER_KEYS
from claimrisk.session import materialise, scratch_dir, store
from claimrisk.sources.tables import create_schema, publish, read_table, version_name, write_version

# Default schemas of the layers.
SCHEMAS = {"bronze": "bronze", "silver": "silver", "gold": "gold", "marts": "marts"}


class TableRun:
    """Writes tables and records what was written; counting happens while writing.

    A run writes versions of its own, which readers don't see. ``publish`` shows all of them at the end, so a run that
    breaks off leaves the former tables as they were, and can be repeated.
    """

    def __init__(self, spark: SparkSession, fmt: str, schemas: dict):
        self.spark, self.fmt, self.schemas, self.written, self.views = spark, fmt, schemas, [], {}
        self.version = f"v{uuid.uuid4().hex[:12]}"
        for schema in schemas.values():
            create_schema(spark, schema)

    def name(self, layer, table):
        return f"{self.schemas[layer]}.{table}"

    def write(self, df: DataFrame, layer, table, sort_by=None, **options) -> DataFrame:
        counter = Observation()
        stored = write_version(df.observe(counter, F.count("*").alias("rows")),
                               self.name(layer, table), self.version, fmt=self.fmt, sort_by=sort_by, **options)
        # Sorting samples its input, so its rows pass the counter twice; a stored table knows its count.
        rows = stored.count() if sort_by else counter.get["rows"]
        self.written.append((self.name(layer, table), rows, len(df.columns)))
        return stored

    def add_view(self, layer, view, select_sql) -> DataFrame:
        self.views[self.name(layer, view)] = select_sql
        return self.spark.sql(select_sql)

    def publish(self) -> None:
        for name, _, _ in self.written:
            publish(self.spark, name, self.version)
        for name, select_sql in self.views.items():
            publish(self.spark, name, self.version, select_sql)

    def report(self) -> DataFrame:
        return self.spark.createDataFrame(
            self.written, "table_name string, rows bigint, columns int")


def run_all(spark: SparkSession, bronze_table=None, raw: DataFrame | None = None, fmt="parquet",
            run_ts=None, source_file=None, dedupe=False, schemas=None, rounds=300, depth=6,
            feature_set="reference", model_path=None, learner="second_order") -> tuple[DataFrame, DataFrame]:
    """Build every table from Bronze to serving; returns the row report and the data test results.

    The model of ``learner`` is evaluated on the held-out providers, for both feature sets; ``feature_set`` names the one that
    is saved (under ``model_path``, by default in the shared folder), explained and served.

    Give the name of a loaded Bronze table, or raw rows to load first. Each step reads the tables that
    the earlier steps stored. Readers see the new tables when all are written: a run that fails leaves the former ones, and can be repeated.
    """
    run = TableRun(spark, fmt, {**SCHEMAS, **(schemas or {})})
    rows = (read_table(spark, bronze_table) if bronze_table
            else run.write(raw, "bronze", "bronze_cms_raw"))
    run.write(bronze.quality_report(rows), "bronze", "quality_report")
    claims = run.write(silver.clean(rows, run_ts, source_file, dedupe), "silver", "cms_claims_clean")
    features = run.write(silver.features(claims, run_ts), "silver", "cms_claims_features")
    risk = run.write(gold.provider_risk(features, run_ts), "gold", "provider_risk")

    run.write(gold.kpi_high_cost_claims(features), "gold", "kpi_high_cost_claims")
    run.write(gold.kpi_specialty_benchmarks(features, ordered=False), "gold", "kpi_specialty_benchmarks")
    run.write(gold.kpi_procedure_analysis(features, ordered=False), "gold", "kpi_procedure_analysis")
    _write_provider_kpis(run, risk)

    features_table = version_name(run.name("silver", "cms_claims_features"), run.version)
    staging = [run.add_view("marts", name, sql) for name, sql in marts.views(features_table).items()][0]
    mart = run.write(marts.fct_provider_risk(features, run_ts), "marts", "fct_provider_risk")
    run.write(ml.rank_index(mart), "marts", "provider_rank_index")

    inputs = store(ml.add_split(ml.features_table(mart, carry=serving.CARRIED)))
    train = inputs.filter(F.col("split") == "train")
    models = {name: ml.LEARNERS[learner](train, name, rounds, depth) for name in FEATURE_SETS}
    model = models[feature_set]
    ml.save_model(model, model_path or f"{scratch_dir(spark)}/risk-model")
    scores = _write_scores(run, ml.score(inputs, model))
    evaluations = [ml.evaluate(scores if name == feature_set else ml.score(inputs, models[name])).withColumn(
        "feature_set", F.lit(name)) for name in FEATURE_SETS]
    run.write(reduce(DataFrame.unionByName, evaluations), "gold", "ml_evaluation")
    run.write(ml.importance(spark, model), "gold", "ml_importance")
    explained = run.write(explain.shap_values(scores, model), "gold", "ml_attributions")
    run.write(explain.shap_importance(explained), "gold", "ml_shap_importance")
    run.write(explain.rationale(explained).select(*PROVIDER_KEYS, "risk_score", "rationale"), "gold",
              "ml_rationales")

    tests = materialise(quality.run_tests(staging, mart, scores))
    run.publish()
    return run.report(), tests


def _write_provider_kpis(run: TableRun, risk: DataFrame) -> None:
    run.write(gold.kpi_state_exposure(risk, ordered=False), "gold", "kpi_state_exposure")
    run.write(gold.kpi_critical_providers(risk, ordered=False), "gold", "kpi_critical_providers")
    run.write(gold.kpi_patient_concentration(risk, ordered=False), "gold", "kpi_patient_concentration")


def _write_scores(run: TableRun, scored: DataFrame) -> DataFrame:
    served = run.write(serving.serving_provider_risk(scored), "gold", "serving_provider_risk", sort_by=PROVIDER_KEYS,
                       lookup_by=["provider_id"])
    run.write(serving.cohort_index(served), "gold", "serving_cohorts", sort_by=serving.COHORT_ORDER,
              partition_by=serving.COHORT_ORDER[:1])
    return run.write(served.drop(*serving.CARRIED), "gold", "ml_provider_scores")


def run_part(state: ProviderState, name: str, raw: DataFrame, model_path: str, fmt="parquet", run_ts=None,
             schemas=None) -> DataFrame:
    """Bring the provider tables, from Gold to serving, up to date with a late part; returns the row report.

    Only the part's claims are read: the tables follow from the states of all parts in ``state``, the scores from the
    model saved under ``model_path``. A part that is in already changes nothing, but the tables are written, so that a run
    that broke off can be repeated. Bronze is appended to by ``streaming.arrivals``; tables with a row per claim are rebuilt by ``run_all``.
    """
    state.add_part(name, silver.clean(raw, run_ts))
    run = TableRun(state.spark, fmt, {**SCHEMAS, **(schemas or {})})
    _write_provider_kpis(run, run.write(state.provider_risk(run_ts), "gold", "provider_risk"))
    mart = run.write(state.fct_provider_risk(run_ts), "marts", "fct_provider_risk")
    run.write(ml.rank_index(mart), "marts", "provider_rank_index")
    inputs = ml.add_split(ml.features_table(mart, carry=serving.CARRIED))
    _write_scores(run, ml.score(inputs, ml.load_model(model_path)))
    run.publish()
    return run.report()
