"""Provider-level risk and KPI tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimrisk.functions.columns import (
    claim_value, exact_sum, guarded_ratio, processed_at, risk_tier, zscore)
from claimrisk.operators.lookup_join import lookup_join, null_safe_join
from claimrisk.operators.ordered import add_percent_rank, add_rank, percentiles, top_fraction
from claimrisk.plans.silver import CHARGE, peer_percentiles, ratio_columns
from claimrisk.schemas import PROVIDER_KEYS, PROVIDER_MEASURES
from claimrisk.session import Size, materialise, materialise_measured


def _volume_measures() -> dict:
    return {
        "total_procedures": F.count("*"),
        "total_beneficiaries": F.sum("total_beneficiaries"),
        "total_services": F.sum("total_services"),
        "total_billed": exact_sum(claim_value(), 2),
        "total_paid": exact_sum(claim_value("avg_medicare_paid"), 2),
        "unique_procedures": F.count_distinct("procedure_code"),
    }


def _aggregate(rows: DataFrame, measures: dict) -> DataFrame:
    return rows.groupBy(*PROVIDER_KEYS).agg(*[m.alias(name) for name, m in measures.items()])


def _unique_procedures(claims: DataFrame) -> DataFrame:
    """Distinct procedures per provider key."""
    pairs = claims.select(*PROVIDER_KEYS, "procedure_code").distinct()
    return pairs.groupBy(*PROVIDER_KEYS).agg(F.count("procedure_code").alias("unique_procedures"))


def provider_risk(features: DataFrame, run_ts=None) -> DataFrame:
    """One row per provider key with 11 measures, rank in specialty and tier by rounded max z."""
    stats = _aggregate(features, {
        **_volume_measures(),
        "avg_charge_ratio": F.round(F.avg("charge_to_payment_ratio"), 4),
        "avg_billing_intensity": F.round(F.avg("billing_intensity"), 4),
        "max_zscore": F.round(F.max("provider_charge_zscore"), 4),
        "avg_zscore": F.round(F.avg("provider_charge_zscore"), 4),
        "facility_rate": F.round(F.avg("facility_flag"), 4),
    })
    return rank_and_tier(*materialise_measured(stats), run_ts)


def scored_providers(claims: DataFrame) -> tuple[DataFrame, Size]:
    """Provider rows with all measures and ``peak_zscore`` (unrounded), from aggregates of the claims.

    The z-score is linear in the charge and a provider key lies within one specialty, so the largest
    and mean z-score follow from the provider's largest and mean charge, and the peer statistics from
    the provider rows: no claim is joined. Distinct procedures are counted apart, from keys and procedures alone: in one aggregate
    with them, all measures would be shuffled once per procedure of a provider, and again. ``claims`` are read twice: pass a stored table.
    """
    measures = _volume_measures()
    del measures["unique_procedures"]
    base, size = materialise_measured(null_safe_join(_aggregate(claims.withColumns(ratio_columns()), {
        **measures,
        "avg_charge_ratio": F.round(F.avg("charge_to_payment_ratio"), 4),
        "avg_billing_intensity": F.round(F.avg("billing_intensity"), 4),
        "facility_rate": F.round(F.count_if(F.col("place_of_service") == "F") / F.count("*"), 4),
        "charges": F.count(CHARGE),
        "min_charge": F.min(CHARGE),
        "max_charge": F.max(CHARGE),
        "mean_charge": F.sum(CHARGE) / F.count(CHARGE),
        "var_charge": F.var_pop(CHARGE),
    }), _unique_procedures(claims), PROVIDER_KEYS))
    pooled = materialise(_pooled_stats(base, size))
    scored = lookup_join(base, pooled, ["specialty"], rows="providers", size=size)
    mean, spread = "specialty_avg_charge", "specialty_stddev_charge"
    scored = scored.withColumns({
        "peak_zscore": zscore("max_charge", mean, spread),
        "max_zscore": F.round(zscore("max_charge", mean, spread), 4),
        "avg_zscore": F.round(zscore("mean_charge", mean, spread), 4),
    })
    return scored.select(*PROVIDER_KEYS, *PROVIDER_MEASURES, "peak_zscore"), size


def provider_risk_from_claims(claims: DataFrame, run_ts=None) -> DataFrame:
    """``provider_risk(features(claims))`` without joining the claims."""
    scored, size = scored_providers(claims)
    return rank_and_tier(scored.drop("peak_zscore"), size, run_ts)


def _pooled_stats(base: DataFrame, size: Size) -> DataFrame:
    """Specialty mean and sample standard deviation from per-provider counts, means and variances.

    Squares are taken around the pooled mean, not as a difference of large sums; equal charges give
    exactly 0.
    """
    means = base.groupBy("specialty").agg(
        F.count("*").alias("providers"),
        F.sum("charges").alias("n"),
        (F.sum(F.col("charges") * F.col("mean_charge")) / F.sum("charges")).alias("mean"),
        F.min("min_charge").alias("low"),
        F.max("max_charge").alias("high"))
    parts = lookup_join(base.select("specialty", "charges", "mean_charge", "var_charge"),
                        means.withColumn("peers", F.col("providers")), ["specialty"],
                        rows="peers", size=size)
    offset = F.col("mean_charge") - F.col("mean")
    squares = F.col("charges") * (F.col("var_charge") + offset * offset)
    spread = F.when(F.col("n") == 1, None).when(F.col("low") == F.col("high"), 0.0).otherwise(
        F.sqrt(F.try_divide("squares", F.col("n") - 1)))
    pooled = parts.groupBy("specialty").agg(
        F.sum(squares).alias("squares"),
        *[F.max(c).alias(c) for c in ("providers", "n", "mean", "low", "high")])
    return pooled.select(
        "specialty", "providers", F.col("mean").alias("specialty_avg_charge"),
        spread.alias("specialty_stddev_charge"))


def rank_and_tier(stats: DataFrame, size: Size, run_ts) -> DataFrame:
    ranked = add_rank(stats, ["specialty"], "max_zscore", "specialty_rank", size)
    return ranked.select(
        *PROVIDER_KEYS, *PROVIDER_MEASURES, "specialty_rank",
        risk_tier("max_zscore").alias("risk_tier"),
        processed_at(run_ts).alias("gold_processed_at"))


def tier_distribution(risk: DataFrame) -> DataFrame:
    counts = risk.groupBy("risk_tier").agg(F.count("*").alias("providers"))
    return counts.orderBy("providers", "risk_tier")


def tier_billed(risk: DataFrame) -> DataFrame:
    return (
        risk.groupBy("risk_tier")
        .agg(F.count("*").alias("providers"), exact_sum("total_billed", 2).alias("total_billed_usd"))
        .orderBy("providers", "risk_tier"))


def critical_top(risk: DataFrame, n=5) -> DataFrame:
    return (
        risk.filter(F.col("risk_tier") == "Critical")
        .orderBy(F.desc("max_zscore"), *PROVIDER_KEYS)
        .select("provider_id", "specialty", "state", "max_zscore", "avg_charge_ratio", "total_billed")
        .limit(n))


# KPI tables; their column names and roundings are fixed values. Sorts end in the group keys, so that rows with equal measures still split over tasks;
# ``ordered=False`` leaves the sort out for writing, as a stored table has no row order.

def _sorted(df, ordered, *order):
    return df.orderBy(*order) if ordered else df


def kpi_high_cost_claims(features: DataFrame, fraction=0.99, measure=None) -> DataFrame:
    """Claims at or above the percent rank ``fraction`` by value (charge x services by default)."""
    value = claim_value() if measure is None else F.col(measure)
    columns = ["provider_id", "specialty", "state", "procedure_code", "procedure_desc", CHARGE, "avg_medicare_paid",
               "total_services", "total_beneficiaries"]
    ranked = features.select(*columns, *([] if measure in (None, *columns) else [measure]))
    return top_fraction(ranked, value, fraction).select(*columns, claim_value().alias("total_claim_value"))


def kpi_specialty_benchmarks(features: DataFrame, ordered=True) -> DataFrame:
    """Claims, providers and averages per specialty; ``median_submitted_charge`` holds the mean."""
    table = features.groupBy("specialty").agg(
        F.count("*").alias("total_claims"),
        F.count_distinct("provider_id").alias("unique_providers"),
        F.round(F.avg(CHARGE), 2).alias("median_submitted_charge"),
        F.round(F.avg("charge_to_payment_ratio"), 4).alias("avg_charge_ratio"),
        F.round(F.avg("billing_intensity"), 4).alias("avg_billing_intensity"),
        exact_sum(claim_value(), 2).alias("total_billed"))
    return _sorted(table, ordered, F.desc("total_billed"), "specialty")


def kpi_state_exposure(risk: DataFrame, ordered=True) -> DataFrame:
    table = risk.groupBy("state").agg(
        F.count("*").alias("total_providers"),
        exact_sum("total_billed").alias("total_billed"),
        exact_sum("total_paid").alias("total_paid"),
        F.round(F.avg("avg_charge_ratio"), 4).alias("avg_charge_ratio"),
        F.count_if(F.col("risk_tier") == "Critical").alias("critical_providers"))
    return _sorted(table, ordered, F.desc("total_billed"), "state")


def kpi_procedure_analysis(features: DataFrame, ordered=True) -> DataFrame:
    table = features.groupBy("procedure_code", "procedure_desc").agg(
        F.count("*").alias("claim_count"),
        F.count_distinct("provider_id").alias("unique_providers"),
        F.round(F.avg(CHARGE), 2).alias("avg_charge"),
        F.round(F.avg("avg_medicare_paid"), 2).alias("avg_paid"),
        F.round(F.avg("charge_to_payment_ratio"), 4).alias("avg_charge_ratio"))
    return _sorted(table, ordered, F.desc("claim_count"), "procedure_code", "procedure_desc")


def kpi_critical_providers(risk: DataFrame, ordered=True) -> DataFrame:
    table = risk.filter(F.col("risk_tier") == "Critical").select(
        "provider_id", "specialty", "state", "risk_tier", "specialty_rank", "total_billed",
        "max_zscore", "avg_charge_ratio")
    return _sorted(table, ordered, "specialty", "specialty_rank", "provider_id", "state")


def kpi_patient_concentration(risk: DataFrame, ordered=True) -> DataFrame:
    per_patient = guarded_ratio("total_services", "total_beneficiaries")
    table = risk.filter(F.col("total_beneficiaries") > 0).select(
        "provider_id", "specialty", "state", "risk_tier", "total_beneficiaries", "total_services",
        F.round(per_patient, 2).alias("services_per_patient"), "total_billed")
    return _sorted(table, ordered, F.desc("services_per_patient"), "provider_id", "specialty", "state")


def kpi_patient_outliers(risk: DataFrame, fraction=0.95) -> DataFrame:
    """Providers with more patients than the given percentile of their specialty."""
    limits = percentiles(risk, ["specialty"], "total_beneficiaries", {"patient_limit": fraction})
    return lookup_join(risk, limits, ["specialty"]).filter(
        F.col("total_beneficiaries") > F.col("patient_limit")).select(
        *PROVIDER_KEYS, "risk_tier", "total_beneficiaries", "patient_limit")


def specialty_percentiles(claims: DataFrame, sketches=None) -> DataFrame:
    """True median and 95th percentile of charge and charge ratio per specialty."""
    metrics = {"charge": F.col(CHARGE), "ratio": ratio_columns()["charge_to_payment_ratio"]}
    return peer_percentiles(claims, metrics, {"median": 0.5, "p95": 0.95}, sketches)


def procedure_fraud_rate(labelled: DataFrame) -> DataFrame:
    """Share of flagged claims per procedure, from claims that carry ``fraud_flag``."""
    return labelled.groupBy("procedure_code", "procedure_desc").agg(
        F.count("*").alias("claim_count"),
        F.sum("fraud_flag").alias("flagged_claims"),
        F.round(F.avg("fraud_flag"), 4).alias("fraud_rate"))


def specialty_rank_percentile(risk: DataFrame) -> DataFrame:
    """Provider rows with their percent rank in the specialty by rising max z."""
    return add_percent_rank(risk, ["specialty"], "max_zscore", "specialty_rank_percentile")
