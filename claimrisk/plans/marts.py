"""SQL models over the features table: staging view, provider statistics view, risk mart."""

from pyspark.sql import DataFrame, SparkSession

from claimrisk.functions.columns import processed_at, risk_tier
from claimrisk.operators.ordered import add_rank
from claimrisk.plans.gold import scored_providers
from claimrisk.schemas import PROVIDER_KEYS, PROVIDER_MEASURES
from claimrisk.session import materialise_measured
from claimrisk.sources.tables import replace_view

# The columns of the staging model.
STAGING_COLUMNS = [
    "provider_id", "provider_last_name", "provider_first_name", "entity_code", "city", "state",
    "zip_code", "specialty", "procedure_code", "procedure_desc", "drug_indicator", "place_of_service",
    "total_beneficiaries", "total_services", "total_beneficiary_days", "avg_submitted_charge",
    "avg_medicare_allowed", "avg_medicare_paid", "avg_medicare_standardized", "charge_to_payment_ratio",
    "billing_intensity", "specialty_avg_charge", "specialty_stddev_charge", "provider_charge_zscore",
    "facility_flag", "silver_processed_at", "source_file",
]

STAGING = f"SELECT {', '.join(STAGING_COLUMNS)} FROM {{features}}"

_KEYS = ", ".join(PROVIDER_KEYS)


def _money(price):
    # As in functions.columns.exact_sum: whole units and millionths add up as integers.
    amount = f"{price} * total_services"
    parts = f"floor(({amount} - floor({amount})) * 1000000 + 0.5)"
    return (f"CAST(round(CAST(sum(floor({amount})) AS DECIMAL(25, 6)) "
            f"+ CAST(sum({parts}) AS DECIMAL(25, 0)) * 0.000001, 2) AS DOUBLE)")


_MEASURES = {
    "total_procedures": "count(*)",
    "total_beneficiaries": "sum(total_beneficiaries)",
    "total_services": "sum(total_services)",
    "total_billed": _money("avg_submitted_charge"),
    "total_paid": _money("avg_medicare_paid"),
    "avg_charge_ratio": "round(avg(charge_to_payment_ratio), 4)",
    "avg_billing_intensity": "round(avg(billing_intensity), 4)",
    "max_zscore": "round(max(provider_charge_zscore), 4)",
    "avg_zscore": "round(avg(provider_charge_zscore), 4)",
    "unique_procedures": "count(DISTINCT procedure_code)",
    "facility_rate": "round(avg(facility_flag), 4)",
}


def _grouped(measures):
    listed = ", ".join(f"{sql} AS {name}" for name, sql in measures.items())
    return f"SELECT {_KEYS}, {listed} FROM {{features}} GROUP BY {_KEYS}"


STATS = _grouped(_MEASURES)
# The mart ranks and tiers by the unrounded peak; the published max_zscore is rounded.
_STATS_WITH_PEAK = _grouped({**_MEASURES, "peak_zscore": "max(provider_charge_zscore)"})

TIER_PIVOT = """
    SELECT count(*) AS provider_count,
           count_if(risk_tier = 'Critical') AS critical,
           count_if(risk_tier = 'Elevated') AS elevated,
           count_if(risk_tier = 'Normal') AS normal,
           CAST(round(sum(CAST(total_billed AS DECIMAL(28, 6))), 2) AS DOUBLE) AS total_billed
    FROM {mart}"""


def stg_claims(features: DataFrame) -> DataFrame:
    return features.sparkSession.sql(STAGING, features=features)


def provider_stats(features: DataFrame) -> DataFrame:
    return features.sparkSession.sql(STATS, features=features)


def fct_provider_risk(features: DataFrame, run_ts=None) -> DataFrame:
    """The risk mart from stored features; ``fct_provider_risk_from_claims`` needs no features."""
    stats, size = materialise_measured(features.sparkSession.sql(_STATS_WITH_PEAK, features=features))
    return rank_and_tier_by_peak(stats, size, run_ts)


def fct_provider_risk_from_claims(claims: DataFrame, run_ts=None) -> DataFrame:
    """``fct_provider_risk(features(claims))`` without joining the claims."""
    return rank_and_tier_by_peak(*scored_providers(claims), run_ts)


def rank_and_tier_by_peak(stats, size, run_ts):
    ranked = add_rank(stats, ["specialty"], "peak_zscore", "specialty_rank", size)
    return ranked.select(
        *PROVIDER_KEYS, *PROVIDER_MEASURES, "specialty_rank",
        risk_tier("peak_zscore").alias("risk_tier"),
        processed_at(run_ts).alias("dbt_processed_at"))


def tier_pivot(mart: DataFrame) -> DataFrame:
    return mart.sparkSession.sql(TIER_PIVOT, mart=mart)


def views(features_table: str) -> dict:
    """The two models that are views, as SQL; they are expanded where they are used."""
    return {"stg_cms_claims": STAGING.format(features=features_table),
            "int_provider_stats": STATS.format(features=features_table)}


def create_views(spark: SparkSession, schema: str, features_table: str) -> None:
    for name, select_sql in views(features_table).items():
        replace_view(spark, f"{schema}.{name}", select_sql)
