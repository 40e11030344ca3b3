"""Profiles of the raw billing rows; each report is one aggregate pass unless it says otherwise."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimrisk.functions.columns import INF, guarded_ratio
from claimrisk.operators.ordered import percentiles
from claimrisk.schemas import (
    CRITICAL_RAW_COLUMNS, MIN_CHARGE, RAW_GRAIN, RAW_MONEY_COLUMNS)
from claimrisk.sources.csv_parts import CORRUPT_LINE, UNREADABLE


def null_counts(raw: DataFrame, columns=CRITICAL_RAW_COLUMNS) -> DataFrame:
    counts = raw.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "null_count")


def money_summary(raw: DataFrame, columns=RAW_MONEY_COLUMNS) -> DataFrame:
    """Count, mean, spread, range and exact quartiles per money column, one row each."""
    values = raw.unpivot([], columns, "column_name", "value")
    spread = values.groupBy("column_name").agg(
        F.count("value").alias("value_count"),
        F.round(F.avg("value"), 4).alias("mean"),
        F.round(F.stddev("value"), 4).alias("stddev"),
        F.min("value").alias("min"),
        F.max("value").alias("max"))
    quartiles = percentiles(values, ["column_name"], "value", {"q25": 0.25, "median": 0.5, "q75": 0.75})
    quartiles = quartiles.select("column_name", *[
        F.round(q, 4).alias(q) for q in ("q25", "median", "q75")])
    return spread.join(quartiles, "column_name", "left")


def price_gap(raw: DataFrame) -> DataFrame:
    """Mean charge, allowed and paid amount, and how many times the payment the charge is."""
    charge, allowed, paid = (F.avg(c) for c in RAW_MONEY_COLUMNS)
    return raw.agg(
        F.round(charge, 4).alias("avg_charge"),
        F.round(allowed, 4).alias("avg_allowed"),
        F.round(paid, 4).alias("avg_paid"),
        F.round(guarded_ratio(charge, paid), 4).alias("charge_to_payment"),
        F.round(F.stddev("Avg_Sbmtd_Chrg"), 4).alias("stddev_charge"),
        F.min("Avg_Sbmtd_Chrg").alias("min_charge"),
        F.max("Avg_Sbmtd_Chrg").alias("max_charge"))


def distinct_counts(raw: DataFrame, approximate=False) -> DataFrame:
    """Distinct providers, specialties, procedures and states; sketches when ``approximate``."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return raw.agg(
        count("Rndrng_NPI").alias("providers"),
        count("Rndrng_Prvdr_Type").alias("specialties"),
        count("HCPCS_Cd").alias("procedures"),
        count("Rndrng_Prvdr_State_Abrvtn").alias("states"))


def top_specialties(raw: DataFrame, n=10) -> DataFrame:
    counts = raw.groupBy(F.col("Rndrng_Prvdr_Type").alias("specialty")).agg(
        F.count("*").alias("claims"))
    return counts.orderBy(F.desc("claims"), "specialty").limit(n)


def payment_ratio(raw: DataFrame) -> DataFrame:
    """Mean payment per mean charge by specialty, lowest first."""
    charge, paid = F.avg("Avg_Sbmtd_Chrg"), F.avg("Avg_Mdcr_Pymt_Amt")
    return (
        raw.groupBy(F.col("Rndrng_Prvdr_Type").alias("specialty"))
        .agg(
            F.count("*").alias("claims"),
            F.round(charge, 4).alias("avg_charge"),
            F.round(paid, 4).alias("avg_paid"),
            F.round(guarded_ratio(paid, charge), 4).alias("payment_ratio"))
        .orderBy("payment_ratio", "specialty"))


def _overserved(factor):
    return F.col("total_services") > F.col("total_beneficiaries") * factor


def _per_provider(raw, **more):
    return raw.groupBy(F.col("Rndrng_NPI").alias("provider_id")).agg(
        F.sum("Tot_Srvcs").alias("total_services"),
        F.sum("Tot_Benes").alias("total_beneficiaries"), *[c.alias(n) for n, c in more.items()])


def overserved_providers(raw: DataFrame, factor=10) -> DataFrame:
    """Providers with more than ``factor`` services per patient over all their rows."""
    return _per_provider(raw).filter(_overserved(factor))


def anomaly_flags(raw: DataFrame, factor=10) -> DataFrame:
    """Negative charges, unpaid rows and overserved providers as (flag, hits); row flags are counted per provider first."""
    providers = _per_provider(
        raw, negative=F.count_if(F.col("Avg_Sbmtd_Chrg") < 0),
        unpaid=F.count_if(F.col("Avg_Mdcr_Pymt_Amt") == 0))
    hits = providers.agg(
        F.coalesce(F.sum("negative"), F.lit(0)).alias("negative_charge_rows"),
        F.coalesce(F.sum("unpaid"), F.lit(0)).alias("zero_paid_rows"),
        F.count_if(_overserved(factor)).alias("overserved_providers"))
    return hits.unpivot([], hits.columns, "flag", "hits")


def quality_report(raw: DataFrame) -> DataFrame:
    """The five checks before cleaning as (check_name, rows), from one pass over the rows.

    Counting per grain first serves all five: the row predicates are summed per grain, and a grain
    with n rows has n - 1 duplicates. If the rows came with an account of rejects, lines with too few
    or too many cells and unreadable values are counted too. A NaN or infinite charge is below minimum.
    """
    charge = F.col("Avg_Sbmtd_Chrg")
    checks = {
        "null_provider": F.col("Rndrng_NPI").isNull(),
        "null_procedure": F.col("HCPCS_Cd").isNull(),
        "charge_below_minimum": (charge < MIN_CHARGE) | (charge >= INF),
        "zero_paid": F.col("Avg_Mdcr_Pymt_Amt") == 0,
    }
    counts = {name: F.count_if(c) for name, c in checks.items()}
    if CORRUPT_LINE in raw.columns:
        counts["corrupt_line"] = F.count(CORRUPT_LINE)
    if UNREADABLE in raw.columns:
        counts["unreadable_value"] = F.sum(F.size(UNREADABLE))
    per_grain = raw.groupBy(*RAW_GRAIN).agg(
        F.count("*").alias("__n"), *[c.alias(name) for name, c in counts.items()])
    sums = {**{name: F.sum(name) for name in counts}, "duplicate_grain": F.sum(F.col("__n") - 1)}
    report = per_grain.agg(*[F.coalesce(s, F.lit(0)).alias(name) for name, s in sums.items()])
    return report.unpivot([], report.columns, "check_name", "rows")


def unreadable_values(raw: DataFrame) -> DataFrame:
    """Unreadable values per column, from rows that were read with an account of rejects."""
    return raw.select(F.explode(UNREADABLE).alias("column_name")).groupBy("column_name").agg(
        F.count("*").alias("values")).orderBy("column_name")
