"""Queries on scored providers; filter values are literals of the plan, never parts of SQL text."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimrisk.functions.columns import all_of, exact_sum
from claimrisk.operators.lookup_join import null_safe_join
from claimrisk.schemas import PROVIDER_KEYS
from claimrisk.sources.tables import export_csv


# Mart columns that served scores carry; the result columns of lookup, cohort and summary.
CARRIED = ["risk_tier", "total_billed"]


def serving_provider_risk(scores: DataFrame, mart: DataFrame | None = None) -> DataFrame:
    """Scores with tier and billed total; both sides have one row per provider key.

    Scores that carry both columns since their features were taken from the mart need no join.
    """
    if mart is None:
        return scores.select(*[c for c in scores.columns if c not in CARRIED], *CARRIED)
    return null_safe_join(scores, mart.select(*PROVIDER_KEYS, *CARRIED),
                          PROVIDER_KEYS, "left")


def provider(serving: DataFrame, provider_id: int) -> DataFrame:
    """The provider's row with the largest billed total; empty for an unknown provider."""
    return (
        serving.filter(F.col("provider_id") == F.lit(provider_id))
        .orderBy(F.desc("total_billed"), *PROVIDER_KEYS[1:])
        .select("provider_id", "specialty", "state", "risk_score", "predicted_fraud", "risk_tier",
                "avg_charge_ratio", "max_zscore", "total_billed")
        .limit(1))


def displayed(found: DataFrame) -> DataFrame:
    """A looked-up provider as it is shown: score to four digits, charge ratio to two."""
    return found.withColumns({
        "risk_score": F.round("risk_score", 4), "avg_charge_ratio": F.round("avg_charge_ratio", 2)})


FILTERS = ["risk_tier", "state", "specialty"]
COHORT_COLUMNS = ["provider_id", "specialty", "state", "risk_score", "risk_tier", "avg_charge_ratio", "max_zscore", "total_billed"]
# Providers that the cohort index holds for each value of a set of filters.
COHORT_ROWS = 500
# Order of the stored index: a lookup reads neighbouring rows.
COHORT_ORDER = ["filters", *[f"by_{c}" for c in FILTERS], "place"]


def _wanted(risk_tier, state, specialty):
    """The filters that have a value; an empty or missing one does not filter."""
    return {c: v for c, v in zip(FILTERS, (risk_tier, state, specialty)) if v}


def cohort(serving: DataFrame, risk_tier=None, state=None, specialty=None, limit=100) -> DataFrame:
    """Highest scores first; an empty or missing filter value does not filter."""
    return (
        serving.filter(all_of(F.col(c) == F.lit(v) for c, v in _wanted(risk_tier, state, specialty).items()))
        .orderBy(F.desc("risk_score"), *PROVIDER_KEYS)
        .select(*COHORT_COLUMNS)
        .limit(limit))


def cohort_index(serving: DataFrame, rows=COHORT_ROWS) -> DataFrame:
    """The first ``rows`` providers of every cohort: of each combination of values of each of the eight sets of filters.

    ``filters`` names the set (bit i for FILTERS[i]), ``by_*`` its values (NULL where not filtered), ``place`` the place from 1. The
    limit is applied in each task before the shuffle, so also the cohort of all providers brings few rows to one task.
    """
    sets = F.explode(F.array(*[F.lit(i) for i in range(2 ** len(FILTERS))])).alias("filters")
    spread = serving.select(sets, *dict.fromkeys([*COHORT_COLUMNS, *PROVIDER_KEYS]))
    by = {f"by_{c}": F.when(F.col("filters").bitwiseAND(1 << i) != 0, F.col(c)) for i, c in enumerate(FILTERS)}
    cohorts = spread.withColumns(by).filter(all_of(  # a filter finds no row without a value
        (F.col("filters").bitwiseAND(1 << i) == 0) | F.col(c).isNotNull() for i, c in enumerate(FILTERS)))
    order = Window.partitionBy("filters", *by).orderBy(F.desc("risk_score"), *PROVIDER_KEYS)
    return cohorts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= rows).select(
        *COHORT_ORDER, *COHORT_COLUMNS)


def indexed_cohort(index: DataFrame, serving: DataFrame, risk_tier=None, state=None, specialty=None, limit=100,
                   rows=COHORT_ROWS) -> DataFrame:
    """``cohort`` from a stored ``cohort_index``; limits beyond what it holds are answered from ``serving``."""
    if limit > rows:
        return cohort(serving, risk_tier, state, specialty, limit)
    wanted = _wanted(risk_tier, state, specialty)
    filters = sum(1 << FILTERS.index(c) for c in wanted)
    found = index.filter((F.col("filters") == filters) & all_of(
        F.col(f"by_{c}") == F.lit(v) for c, v in wanted.items()) & (F.col("place") <= limit))
    return found.orderBy("place").select(*COHORT_COLUMNS).limit(limit)


def summary(serving: DataFrame) -> DataFrame:
    return (
        serving.groupBy("risk_tier")
        .agg(
            F.count("*").alias("provider_count"),
            F.round(F.avg("risk_score"), 4).alias("avg_risk_score"),
            exact_sum("total_billed", 2).alias("total_billed"))
        .orderBy(F.desc("avg_risk_score"), "risk_tier"))


def state_risk(serving: DataFrame) -> DataFrame:
    """Map data: providers, mean score and share of Critical providers per state."""
    critical = F.count_if(F.col("risk_tier") == "Critical")
    return serving.groupBy("state").agg(
        F.count("*").alias("providers"),
        F.round(F.avg("risk_score"), 4).alias("avg_risk_score"),
        F.round(critical * 100 / F.count("*"), 2).alias("critical_percent"))


def export_cohort(serving: DataFrame, path: str, **filters) -> None:
    export_csv(cohort(serving, **filters), path)
