"""Named queries over the order tables, each from the raw tables to its result."""

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimrisk.functions.columns import exact_sum, flag
from claimrisk.operators.lookup_join import lookup_join
from claimrisk.operators.scoring_metrics import auc_roc, average_precision, classification_report
from claimrisk.plans import bronze, deduped_parts, explain, gold, marts, ml, provider_state, quality, serving, silver
from claimrisk.schemas import FEATURE_SETS, MODEL_FEATURES, PROVIDER_KEYS, RAW_MONEY_COLUMNS, TIERS
from claimrisk.session import file_system, materialise, scratch_dir, store
from claimrisk.sources.claims_mapping import TABLES, raw_claims

# The audit source of the mapped rows; audit times are left out of the results.
SOURCE = "order_lines"
AUDIT_TIMES = ["silver_processed_at", "features_created_at", "gold_processed_at", "dbt_processed_at"]


def clean_claims(spark, sf_dir, **options):
    return silver.clean(raw_claims(spark, sf_dir), source_file=SOURCE, **options)


def feature_claims(spark, sf_dir):
    return silver.features(clean_claims(spark, sf_dir))


def risk(spark, sf_dir):
    return gold.provider_risk_from_claims(stored_claims(spark, sf_dir))


def mart(spark, sf_dir):
    return marts.fct_provider_risk_from_claims(stored_claims(spark, sf_dir))


def rounded(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


# Plans that read their input several times get a columnar copy with just the columns that they read.
CLAIM_INPUTS = [*PROVIDER_KEYS, "procedure_code", "place_of_service", "avg_submitted_charge",
                "avg_medicare_paid", "total_services", "total_beneficiaries"]
LABELLED_BY = ["specialty", "charge_to_payment_ratio", "billing_intensity", "provider_charge_zscore"]


def _money_summary(raw):
    return bronze.money_summary(store(raw, RAW_MONEY_COLUMNS))


def _features_median(claims):
    return _median_out(silver.features_median(store(claims, [
        "provider_id", "specialty", "procedure_code", "place_of_service", "avg_submitted_charge",
        "avg_medicare_paid"])))


def _specialty_percentiles(claims):
    return _percentiles_out(gold.specialty_percentiles(store(claims, [
        "specialty", "avg_submitted_charge", "avg_medicare_paid"])))


def _narrative(claims):
    return explain.rationale_narrative(store(claims, [
        *PROVIDER_KEYS, "avg_submitted_charge", "avg_medicare_paid", "total_services",
        "total_beneficiaries"]))


def _labelled(features, *columns):
    return silver.label_any(store(features, [*LABELLED_BY, *columns]))


def _label_any3(features):
    return _label_out(_labelled(
        features, "provider_id", "procedure_code", "place_of_service", "avg_submitted_charge"))


def _procedure_fraud_rate(features):
    return gold.procedure_fraud_rate(_labelled(features, "procedure_code", "procedure_desc"))


def stored_claims(spark, sf_dir):
    """The columns of the clean claims that the mart, the features and the tests of the models read."""
    return store(clean_claims(spark, sf_dir), CLAIM_INPUTS)


def _ml_label_any3(spark, sf_dir):
    claims = stored_claims(spark, sf_dir)
    labelled = silver.label_any(silver.features(claims))
    return ml.features_table(marts.fct_provider_risk_from_claims(claims), labelled).select(
        *PROVIDER_KEYS, "fraud_flag")


# The claims dealt to parts, the order in which the parts come in (one of them twice), and when they are folded.
PARTS = 5
ARRIVALS = [3, 1, "fold", 4, 0, 1, 2]


def state_of_parts(spark, sf_dir):
    """(provider state, claims) after all claims came in as parts; the raw tables are read once, to write the parts."""
    folder = f"{scratch_dir(spark)}/arrived-{uuid.uuid4().hex}"
    system, place = file_system(spark, folder)
    system.deleteOnExit(place)
    claims = clean_claims(spark, sf_dir).select(*provider_state.INPUTS)
    claims.withColumn("part", F.pmod(F.xxhash64(*claims.columns), F.lit(PARTS))).write.partitionBy("part").parquet(
        f"{folder}/claims")
    state = provider_state.ProviderState(spark, f"{folder}/state")
    for part in ARRIVALS:
        if part == "fold":
            state.fold()
        else:
            state.add_part(f"part {part}", spark.read.schema(claims.schema).parquet(f"{folder}/claims/part={part}"))
    return state, spark.read.schema(claims.schema).parquet(f"{folder}/claims")


def _dedup_from_parts(spark, sf_dir):
    """The deduplicated claims after they came in as parts with keys in common."""
    folder = f"{scratch_dir(spark)}/arrived-{uuid.uuid4().hex}"
    system, place = file_system(spark, folder)
    system.deleteOnExit(place)
    claims = clean_claims(spark, sf_dir).drop(*AUDIT_TIMES)
    claims.withColumn("part", F.pmod(F.xxhash64("avg_submitted_charge", "total_services"), F.lit(PARTS))).write.partitionBy(
        "part").parquet(f"{folder}/claims", compression=deduped_parts.CODEC)
    deduped = deduped_parts.DedupedClaims(spark, f"{folder}/deduped")
    for part in ARRIVALS:
        if part != "fold":
            deduped.add_part(f"part {part}", spark.read.schema(claims.schema).parquet(f"{folder}/claims/part={part}"), stored=True)
    return deduped.table()


def _percentiles_from_sketches(spark, sf_dir):
    """Exact percentiles of all claims; where to look for them is known from the sketches that came with the parts."""
    state, claims = state_of_parts(spark, sf_dir)
    return _percentiles_out(gold.specialty_percentiles(claims, state.table("sketches")))


def _from_parts(plan):
    return lambda spark, sf_dir: plan(state_of_parts(spark, sf_dir)[0]).drop(*AUDIT_TIMES)


def _raw(plan):
    return lambda spark, sf_dir: plan(raw_claims(spark, sf_dir))


def _claims(plan):
    return lambda spark, sf_dir: plan(clean_claims(spark, sf_dir)).drop(*AUDIT_TIMES)


def _features(plan):
    return lambda spark, sf_dir: plan(feature_claims(spark, sf_dir)).drop(*AUDIT_TIMES)


def _risk(plan):
    return lambda spark, sf_dir: plan(risk(spark, sf_dir)).drop(*AUDIT_TIMES)


def _mart(plan):
    return lambda spark, sf_dir: plan(mart(spark, sf_dir)).drop(*AUDIT_TIMES)


def _features_out(df):
    return rounded(df, 6, "specialty_avg_charge", "specialty_stddev_charge", "provider_charge_zscore")


def _median_out(df):
    return rounded(df, 6, "median_charge_zscore", "specialty_median_charge", "specialty_median_ratio"
                   ).select(
        "provider_id", "specialty", "procedure_code", "place_of_service", "avg_submitted_charge",
        "charge_to_payment_ratio", "specialty_median_charge", "specialty_median_ratio",
        "median_charge_zscore")


def _unique_out(df):
    return df.select("provider_id", "specialty", "procedure_code", "place_of_service",
                     "total_services", "avg_submitted_charge", "unique_hcpcs_per_npi")


def _percentiles_out(df):
    return rounded(df, 4, "charge_median", "charge_p95", "ratio_median", "ratio_p95")


def _label_out(df):
    return rounded(df, 6, "provider_charge_zscore").select(
        "provider_id", "specialty", "procedure_code", "place_of_service", "avg_submitted_charge",
        "charge_to_payment_ratio", "billing_intensity", "provider_charge_zscore", "fraud_flag")


def _rank_percentile_out(df):
    return rounded(df, 6, "specialty_rank_percentile").select(
        *PROVIDER_KEYS, "max_zscore", "specialty_rank_percentile")


def _wide(spark, sf_dir):
    claims = stored_claims(spark, sf_dir)
    table = ml.features_wide(marts.fct_provider_risk_from_claims(claims), claims)
    return rounded(table, 6, "specialty_rank_percentile")


def _tested(spark, sf_dir):
    """(rows per grain of the staging model, mart): the staging model keeps the grain columns as they are."""
    claims = stored_claims(spark, sf_dir)
    return store(quality.grain_counts(claims)), materialise(marts.fct_provider_risk_from_claims(claims))


def _relationships(spark, sf_dir):
    grains, mart_table = _tested(spark, sf_dir)
    return quality.relationships(grains, mart_table, "stg_cms_claims", "provider_id", rows="n")


def _not_null(spark, sf_dir):
    """The scores are those of the fixed formula; ``ml_scores_check`` tests the model's."""
    grains, mart_table = _tested(spark, sf_dir)
    staging = quality.column_tests(
        grains, "stg_cms_claims", ["provider_id", "procedure_code"], rows="n")
    return staging.unionByName(
        quality.column_tests(mart_table, "fct_provider_risk", ["provider_id"])).unionByName(
        quality.column_tests(formula_scores(mart_table), "ml_provider_scores", ["risk_score"]))


def _accepted_values(spark, sf_dir):
    grains, mart_table = _tested(spark, sf_dir)
    return quality.column_tests(
        grains, "stg_cms_claims", accepted={"place_of_service": quality.PLACES}, rows="n").unionByName(
        quality.column_tests(mart_table, "fct_provider_risk", accepted={"risk_tier": TIERS}))


def formula_scores(mart_table):
    """Stand-in scores by a fixed formula, so that the serving queries have an exact expected result.

    The queries with ``model`` in their name serve the scores of the fitted model.
    """
    table = ml.add_split(ml.features_table(mart_table, carry=serving.CARRIED))
    score = F.round(F.least(F.greatest(F.col("max_zscore"), F.lit(0.0)) / 7, F.lit(1.0)), 6)
    return table.withColumn("risk_score", score).withColumn(
        "predicted_fraud", flag(F.col("risk_score") >= 0.3))


def _serving(plan):
    def run(spark, sf_dir):
        return plan(serving.serving_provider_risk(formula_scores(mart(spark, sf_dir))))
    return run


def _indexed_cohort(spark, sf_dir):
    """The cohort query answered from a stored index of the first rows of all cohorts."""
    served = store(serving.serving_provider_risk(formula_scores(mart(spark, sf_dir))))
    index = store(serving.cohort_index(served))
    return serving.indexed_cohort(index, served, risk_tier="Critical", state="", specialty="BUILDING", limit=100)


def _new_providers(spark, sf_dir):
    """The wider inputs of providers with an id divisible by 7, as new ones: ranked by lookup among all others."""
    claims = stored_claims(spark, sf_dir)
    table = materialise(marts.fct_provider_risk_from_claims(claims))
    new = F.col("provider_id") % 7 == 0
    procedures = claims.filter(new).groupBy("provider_id").agg(
        F.count_distinct("procedure_code").alias("unique_hcpcs_per_npi"))
    index = store(ml.rank_index(table.filter(~new)))
    rows = lookup_join(table.filter(new), procedures, ["provider_id"])
    return rounded(ml.features_wide_of_new(rows, index), 6, "specialty_rank_percentile")


def _ranked_inputs(df):
    """Provider rows with the label and a plain score and prediction, for the metric queries."""
    return ml.features_table(df).withColumn("predicted", flag(F.col("avg_zscore") >= 0.5))


def _report_out(df):
    return rounded(classification_report(_ranked_inputs(df), "fraud_flag", "predicted"),
                   6, "precision", "recall", "f1_score")


def _peer_rationale(df):
    """Rationale texts over differences from the specialty mean of each model input."""
    inputs = ml.features_table(df)
    means = inputs.groupBy("specialty").agg(*[F.avg(c).alias(f"mean_{c}") for c in MODEL_FEATURES])
    compared = lookup_join(inputs, means, ["specialty"])
    contributions = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.round(F.col(c) - F.col(f"mean_{c}"), 3).alias("impact"))
        for c in MODEL_FEATURES])
    return explain.rationale(compared.withColumn("contributions", contributions)).select(
        *PROVIDER_KEYS, "rationale")


# Fitted models of this process: the path of the saved model by session, tables, feature set and learner.
_FITTED = {}


def _version(spark, sf_dir):
    """Place, sizes and times of the tables that claims come from: new data under an old name is another version."""
    marks = []
    for name in TABLES:
        system, place = file_system(spark, f"{sf_dir}/{name}.parquet")
        status = system.getFileStatus(place)
        marks.append((name, system.getContentSummary(place).getLength(), status.getModificationTime()))
    return sf_dir, tuple(marks)


def _inputs(spark, sf_dir):
    return store(ml.add_split(ml.features_table(mart(spark, sf_dir), carry=serving.CARRIED)))


def _fitted(spark, sf_dir, inputs, feature_set, learner):
    """A model is fitted once per session and version of the tables, then loaded."""
    key = spark.sparkContext.applicationId, _version(spark, sf_dir), feature_set, learner
    if key not in _FITTED:
        path = f"{scratch_dir(spark)}/fitted-{uuid.uuid4().hex}"
        ml.save_model(ml.LEARNERS[learner](inputs.filter(F.col("split") == "train"), feature_set), path)
        system, place = file_system(spark, path)
        system.deleteOnExit(place)
        _FITTED[key] = path
    return ml.load_model(_FITTED[key])


def _model(spark, sf_dir, learner):
    """(inputs, fitted model) of the reference feature set."""
    inputs = _inputs(spark, sf_dir)
    return inputs, _fitted(spark, sf_dir, inputs, "reference", learner)


def _scored(spark, sf_dir, learner="first_order"):
    return ml.score(*_model(spark, sf_dir, learner))


def _of_model(plan, learner="first_order"):
    return lambda spark, sf_dir: plan(spark, sf_dir, learner)


def _ml_scores(spark, sf_dir, learner):
    return _scored(spark, sf_dir, learner).drop(*serving.CARRIED)


def _ml_importance(spark, sf_dir, learner):
    return ml.importance(spark, _model(spark, sf_dir, learner)[1])


def _explained(spark, sf_dir, learner):
    inputs, model = _model(spark, sf_dir, learner)
    return explain.shap_values(ml.score(inputs.drop(*serving.CARRIED), model), model)


def _ml_shap(spark, sf_dir, learner):
    impact = {f"shap_{c}": F.col("contributions")[i]["impact"] for i, c in enumerate(MODEL_FEATURES)}
    return _explained(spark, sf_dir, learner).select(
        *PROVIDER_KEYS, "risk_score", "base_value", *[c.alias(name) for name, c in impact.items()])


def _ml_shap_importance(spark, sf_dir, learner):
    return explain.shap_importance(_explained(spark, sf_dir, learner))


def _ml_rationale(spark, sf_dir, learner):
    return explain.rationale(_explained(spark, sf_dir, learner)).select(*PROVIDER_KEYS, "risk_score", "rationale")


def _ml_evaluate(spark, sf_dir):
    """Held-out figures of both learners for both feature sets; ``no_leak`` leaves out the input that the label is made of."""
    inputs = _inputs(spark, sf_dir)
    pairs = [(name, learner) for learner in ml.LEARNERS for name in FEATURE_SETS]
    held_out = inputs.filter(F.col("split") == "test")
    # A model is fitted in few tasks, or in many short jobs one after another: those of different models run side by side, and
    # one by one their figures are worked out while later ones are fitted.
    with ThreadPoolExecutor(len(pairs)) as pool:
        models = pool.map(lambda pair: _fitted(spark, sf_dir, inputs, *pair), pairs)
        figures = [ml.evaluate(ml.score(held_out, model)).select(
            F.lit(learner).alias("learner"), F.lit(name).alias("feature_set"), "*")
            for (name, learner), model in zip(pairs, models)]
    return reduce(DataFrame.unionByName, figures)


# What holds for any model: counts that SQL knows from the mart, and numbers of rows that break a rule.

def _ml_evaluate_check(spark, sf_dir):
    """Supports of the classes, which SQL knows, and numbers of figures out of range; accuracy from the stored counts."""
    figures = _ml_evaluate(spark, sf_dir)
    wanted = (F.col("metric") == "support") & F.col("class").isin("Normal", "Fraud", "accuracy")
    supports = F.sum(F.when(wanted, F.col("value"))).cast("long")
    off = ~F.col("value").between(0, 1) & (F.col("metric") != "support")
    return figures.groupBy("learner", "feature_set", "class").agg(
        supports.alias("support"), F.count_if(off).alias("figures_off")).filter("support IS NOT NULL")


def _ml_importance_check(spark, sf_dir, learner):
    return _ml_importance(spark, sf_dir, learner).agg(
        F.count_distinct("feature").alias("inputs"), F.count_if(F.col("importance") < 0).alias("negative"),
        F.round(F.sum("importance"), 6).alias("total"))


def _ml_scores_check(spark, sf_dir, learner):
    test, positive = F.col("split") == "test", F.col("fraud_flag") == 1
    return _ml_scores(spark, sf_dir, learner).agg(
        F.count("*").alias("score_rows"), F.count_distinct(F.struct(*PROVIDER_KEYS)).alias("provider_keys"),
        F.count_if(~test).alias("train_rows"), F.count_if(test).alias("test_rows"),
        F.count_if(~test & positive).alias("train_positives"), F.count_if(test & positive).alias("test_positives"),
        F.count_if(F.col("risk_score").isNull()).alias("null_scores"),
        F.count_if(~F.col("risk_score").between(0, 1)).alias("scores_out_of_range"),
        F.count_if(F.col("predicted_fraud") != flag(F.col("risk_score") > 0.5)).alias("predictions_off"))


def _ml_shap_check(spark, sf_dir, learner):
    margin = F.col("base_value") + F.aggregate(
        "contributions", F.lit(0.0), lambda total, c: total + c["impact"])
    # Close to a score of 0 or 1 the margin can't be told from the score: there the scores are compared.
    off = F.abs(1 / (1 + F.exp(-margin)) - F.col("risk_score")) > 1e-6
    return _explained(spark, sf_dir, learner).agg(
        F.count("*").alias("explained_rows"), F.count_if(off).alias("sums_off"),
        F.count_if(F.size("contributions") != len(MODEL_FEATURES)).alias("inputs_missing"))


def _ml_rationale_check(spark, sf_dir, learner):
    terms = F.split("rationale", ", ")
    size = F.transform(F.regexp_extract_all("rationale", F.lit(r"impact: (-?[0-9.]+)")), lambda t: F.abs(t.cast("double")))
    falling = (size[0] >= size[1]) & (size[1] >= size[2])
    return _ml_rationale(spark, sf_dir, learner).agg(
        F.count("*").alias("rationale_rows"), F.count_if(F.size(terms) != 3).alias("terms_off"),
        F.count_if(~falling).alias("order_off"))


def _model_serving(plan):
    return lambda spark, sf_dir: plan(serving.serving_provider_risk(_scored(spark, sf_dir)))


def _model_serving_check(served):
    """What does not depend on the scores; the scores are only tested for presence and range."""
    return served.groupBy("risk_tier").agg(
        F.count("*").alias("provider_count"), exact_sum("total_billed", 2).alias("total_billed"),
        F.count_if(F.coalesce(F.col("risk_score").between(0, 1), F.lit(False))).alias("scored"))


QUERIES = {
    "bronze_null_counts": _raw(bronze.null_counts),
    "bronze_money_summary": _raw(_money_summary),
    "bronze_price_gap": _raw(bronze.price_gap),
    "bronze_distinct_counts": _raw(bronze.distinct_counts),
    "bronze_top_specialties": _raw(bronze.top_specialties),
    "bronze_payment_ratio": _raw(bronze.payment_ratio),
    "bronze_anomaly_flags": _raw(bronze.anomaly_flags),
    "dq_report": _raw(bronze.quality_report),
    "silver_row_audit": _raw(silver.row_audit),
    "silver_clean": _claims(lambda c: c),
    "silver_dedup": lambda spark, d: silver.clean(
        store(raw_claims(spark, d)), source_file=SOURCE, dedupe=True).drop(*AUDIT_TIMES),
    "dedup_from_parts": _dedup_from_parts,
    "silver_features": _features(_features_out),
    "features_median": _claims(_features_median),
    "feature_describe": _features(silver.describe),
    "claims_unique_procedures": _claims(lambda c: _unique_out(silver.with_unique_procedures(c))),
    "provider_risk": _risk(lambda r: r),
    "provider_risk_from_features": _features(gold.provider_risk),
    "risk_from_parts": _from_parts(lambda state: state.provider_risk()),
    "percentiles_from_sketches": _percentiles_from_sketches,
    "mart_from_parts": _from_parts(lambda state: state.fct_provider_risk()),
    "tier_distribution": _risk(gold.tier_distribution),
    "tier_billed": _risk(gold.tier_billed),
    "critical_top5": _risk(gold.critical_top),
    "kpi_high_cost_claims": _claims(gold.kpi_high_cost_claims),
    "kpi_specialty_benchmarks": _claims(lambda c: gold.kpi_specialty_benchmarks(
        c.withColumns(silver.ratio_columns()))),
    "kpi_state_exposure": _risk(gold.kpi_state_exposure),
    "kpi_procedure_analysis": _claims(lambda c: gold.kpi_procedure_analysis(
        c.withColumns(silver.ratio_columns()))),
    "kpi_critical_providers": _risk(gold.kpi_critical_providers),
    "kpi_patient_concentration": _risk(gold.kpi_patient_concentration),
    "kpi_patient_outliers": _risk(lambda r: rounded(gold.kpi_patient_outliers(r), 4, "patient_limit")),
    "specialty_percentiles": _claims(_specialty_percentiles),
    "label_any3": _features(_label_any3),
    "procedure_fraud_rate": _features(_procedure_fraud_rate),
    "specialty_rank_percentile": _risk(lambda r: _rank_percentile_out(gold.specialty_rank_percentile(r))),
    "stg_claims": _features(lambda f: _features_out(marts.stg_claims(f))),
    "provider_stats": _features(marts.provider_stats),
    "fct_provider_risk": _mart(lambda m: m),
    "fct_provider_risk_from_features": _features(marts.fct_provider_risk),
    "tier_pivot": _mart(marts.tier_pivot),
    "dq_not_null": _not_null,
    "dq_accepted_values": _accepted_values,
    "dq_unique": _mart(lambda m: quality.unique(m, "fct_provider_risk", ["provider_id"])),
    "dq_unique_grain": _features(lambda f: quality.unique(
        marts.stg_claims(f), "stg_cms_claims", ["provider_id", "procedure_code", "place_of_service"])),
    "dq_relationships": _relationships,
    "ml_features": _mart(ml.features_table),
    "ml_features_wide": _wide,
    "ml_features_wide_new": _new_providers,
    "ml_label_any3": _ml_label_any3,
    "ml_class_balance": _mart(lambda m: ml.class_balance(ml.features_table(m))),
    "ml_split": _mart(lambda m: ml.add_split(ml.features_table(m)).select(*PROVIDER_KEYS, "split")),
    "ml_report": _mart(_report_out),
    "ml_auc_roc": _mart(lambda m: rounded(
        auc_roc(_ranked_inputs(m), "fraud_flag", "avg_zscore"), 6, "auc_roc")),
    "ml_avg_precision": _mart(lambda m: rounded(
        average_precision(_ranked_inputs(m), "fraud_flag", "avg_zscore"), 6, "average_precision")),
    "rationale_top3": _mart(_peer_rationale),
    "rationale_narrative": _claims(_narrative),
    "ml_scores": _of_model(_ml_scores),
    "ml_importance": _of_model(_ml_importance),
    "ml_shap": _of_model(_ml_shap),
    "ml_shap_importance": _of_model(_ml_shap_importance),
    "ml_rationale": _of_model(_ml_rationale),
    "ml_evaluate": _ml_evaluate,
    "ml_scores_check": _of_model(_ml_scores_check),
    "ml_shap_check": _of_model(_ml_shap_check),
    "ml_rationale_check": _of_model(_ml_rationale_check),
    "ml_importance_check": _of_model(_ml_importance_check),
    "ml_evaluate_check": _ml_evaluate_check,
    "newton_scores": _of_model(_ml_scores, "second_order"),
    "newton_importance": _of_model(_ml_importance, "second_order"),
    "newton_shap": _of_model(_ml_shap, "second_order"),
    "newton_scores_check": _of_model(_ml_scores_check, "second_order"),
    "newton_shap_check": _of_model(_ml_shap_check, "second_order"),
    "newton_rationale_check": _of_model(_ml_rationale_check, "second_order"),
    "newton_importance_check": _of_model(_ml_importance_check, "second_order"),
    "model_serving_provider_risk": _model_serving(lambda s: s),
    "model_serve_provider": _model_serving(lambda s: serving.displayed(serving.provider(s, 42))),
    "model_serve_cohort": _model_serving(lambda s: serving.cohort(
        s, risk_tier="Critical", state="", specialty="BUILDING", limit=100)),
    "model_serve_summary": _model_serving(serving.summary),
    "model_state_risk": _model_serving(serving.state_risk),
    "model_serving_check": _model_serving(_model_serving_check),
    "serving_provider_risk": _serving(lambda s: s),
    "serve_provider": _serving(lambda s: serving.provider(s, 42)),
    "serve_cohort": _serving(lambda s: serving.cohort(
        s, risk_tier="Critical", state="", specialty="BUILDING", limit=100)),
    "serve_cohort_indexed": _indexed_cohort,
    "serve_summary": _serving(serving.summary),
    "state_risk": _serving(serving.state_risk),
}
