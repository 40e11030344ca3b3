"""Clean billing rows and their peer-relative features."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql import types as T

from claimrisk.functions.columns import (
    INF, any_of, finite, flag, guarded_ratio, processed_at, zscore)
from claimrisk.operators.dedupe import keep_first
from claimrisk.operators.lookup_join import lookup_join
from claimrisk.operators.ordered import merge_sketches, percentiles, value_sketches
from claimrisk.schemas import CLAIM_COLUMNS, CLAIM_GRAIN, MIN_CHARGE, RAW_TO_CLEAN, UPPER_CASED

CHARGE = "avg_submitted_charge"
DESCRIBED = ["charge_to_payment_ratio", "billing_intensity", "provider_charge_zscore", "facility_flag"]


def _usable():
    charge = F.col("Avg_Sbmtd_Chrg")
    return (charge >= MIN_CHARGE) & (charge < INF) & F.col("Rndrng_NPI").isNotNull()


def clean(raw: DataFrame, run_ts=None, source_file=None, dedupe=False) -> DataFrame:
    """Drop unusable rows, rename to clean names, add the audit columns.

    ``source_file`` overrides the file name recorded at ingest. ``dedupe`` keeps one row per provider,
    procedure and place; the default keeps all, as copies are only reported. NaN and infinite amounts
    become NULL, and rows with such a charge are unusable.
    """
    doubles = {f.name for f in raw.schema if isinstance(f.dataType, T.DoubleType)}

    def renamed(raw_name, name):
        column = F.col(raw_name)
        if raw_name in doubles and raw_name != "Avg_Sbmtd_Chrg":
            column = finite(column)
        return (F.upper(column) if name in UPPER_CASED else column).alias(name)

    recorded = F.col("source_file") if "source_file" in raw.columns else F.lit(None)
    source = recorded if source_file is None else F.lit(source_file)
    rows = raw.filter(_usable()).select(
        *[renamed(raw_name, name) for raw_name, (name, _) in RAW_TO_CLEAN.items()],
        processed_at(run_ts).alias("silver_processed_at"),
        source.cast("string").alias("source_file"))
    return keep_first(rows, CLAIM_GRAIN) if dedupe else rows


def row_audit(raw: DataFrame) -> DataFrame:
    """Raw, kept and dropped rows in one pass."""
    counts = raw.agg(F.count("*").alias("bronze_rows"), F.count_if(_usable()).alias("silver_rows"))
    return counts.select(
        "*", (F.col("bronze_rows") - F.col("silver_rows")).alias("rows_dropped"),
        F.lit(len(CLAIM_COLUMNS) + 2).alias("silver_columns"))


RATIOS = {
    "charge_to_payment_ratio": (CHARGE, "avg_medicare_paid"),
    "billing_intensity": ("total_services", "total_beneficiaries"),
}


# The metric of a percentile or sketch that each ratio gives.
METRIC_OF = {"charge_to_payment_ratio": "ratio", "billing_intensity": "intensity"}


def ratio_columns(available=None) -> dict:
    """The ratios, or those whose inputs are ``available``."""
    return {name: guarded_ratio(*inputs) for name, inputs in RATIOS.items()
            if available is None or set(inputs) <= set(available)}


def peer_stats(claims: DataFrame) -> DataFrame:
    """Mean charge and sample standard deviation per specialty; reads two columns."""
    return claims.groupBy("specialty").agg(
        F.avg(CHARGE).alias("specialty_avg_charge"),
        F.stddev_samp(CHARGE).alias("specialty_stddev_charge"),
        F.count("*").alias("peer_claims"))


def features(claims: DataFrame, run_ts=None) -> DataFrame:
    """The clean columns plus ratios, peer statistics, z-score and facility flag.

    Peer statistics are aggregated and looked up, so no specialty is gathered in one task; pass a
    stored table, as it is scanned twice (once for two columns).
    """
    scored = lookup_join(claims.withColumns(ratio_columns()), peer_stats(claims), ["specialty"],
                         rows="peer_claims")
    return scored.withColumns({
        "provider_charge_zscore": zscore(CHARGE, "specialty_avg_charge", "specialty_stddev_charge"),
        "facility_flag": flag(F.col("place_of_service") == "F"),
        "features_created_at": processed_at(run_ts),
    })


def claim_sketches(claims: DataFrame) -> DataFrame:
    """``specialty, metric, n, sketch``: quantile sketches of charge, charge ratio and intensity, to be stored with the claims and merged by
    ``merge_claim_sketches``. The percentile plans take them as ``sketches`` and then read the claims once."""
    return value_sketches(claims, ["specialty"], {"charge": F.col(CHARGE), **{
        METRIC_OF[name]: column for name, column in ratio_columns(claims.columns).items()}})


def merge_claim_sketches(sketches: DataFrame) -> DataFrame:
    return merge_sketches(sketches, ["specialty"])


def peer_percentiles(claims: DataFrame, metrics: dict, fractions: dict, sketches=None) -> DataFrame:
    """Exact percentiles of several row metrics per specialty, one column per metric and fraction."""
    long = claims.select("specialty", *[c.cast("double").alias(m) for m, c in metrics.items()])
    long = long.unpivot(["specialty"], list(metrics), "metric", "value")
    if sketches is not None:
        sketches = sketches.filter(F.col("metric").isin(*metrics))
    found = percentiles(long, ["specialty", "metric"], "value", fractions, sketches=sketches)
    return found.groupBy("specialty").agg(*[
        F.max(F.when(F.col("metric") == m, F.col(f))).alias(f"{m}_{f}")
        for m in metrics for f in fractions])


def features_median(claims: DataFrame, sketches=None) -> DataFrame:
    """Claims with the median charge and ratio of their specialty and the z-score around the median.

    Reads its input four times, three times with stored ``sketches``, so pass a stored frame with the columns that are needed.
    """
    rows = claims.withColumns(ratio_columns(claims.columns))
    medians = peer_percentiles(
        claims, {"charge": F.col(CHARGE), "ratio": ratio_columns()["charge_to_payment_ratio"]},
        {"median": 0.5}, sketches)
    peers = lookup_join(peer_stats(claims), medians, ["specialty"]).select(
        "specialty",
        F.col("charge_median").alias("specialty_median_charge"),
        F.col("ratio_median").alias("specialty_median_ratio"),
        "specialty_stddev_charge", "peer_claims")
    return lookup_join(rows, peers, ["specialty"], rows="peer_claims").withColumn(
        "median_charge_zscore", zscore(CHARGE, "specialty_median_charge", "specialty_stddev_charge"))


def with_unique_procedures(claims: DataFrame) -> DataFrame:
    """Claims with the number of distinct procedures of their provider."""
    counts = claims.groupBy("provider_id").agg(
        F.count_distinct("procedure_code").alias("unique_hcpcs_per_npi"),
        F.count("*").alias("provider_claims"))
    return lookup_join(claims, counts, ["provider_id"], rows="provider_claims")


def label_any(features_df: DataFrame, z=3.0, ratio_factor=10.0, intensity_fraction=0.95, sketches=None) -> DataFrame:
    """Claims with ``fraud_flag``: high z-score, or high ratio or intensity against the specialty."""
    peers = peer_percentiles(
        features_df,
        {"ratio": F.col("charge_to_payment_ratio"), "intensity": F.col("billing_intensity")},
        {"median": 0.5, "high": intensity_fraction}, sketches)
    peers = peers.select("specialty", "ratio_median", "intensity_high")
    rules = [
        F.col("provider_charge_zscore") > z,
        F.col("charge_to_payment_ratio") > ratio_factor * F.col("ratio_median"),
        F.col("billing_intensity") > F.col("intensity_high"),
    ]
    labelled = lookup_join(features_df, peers, ["specialty"])
    return labelled.withColumn("fraud_flag", flag(any_of(F.coalesce(r, F.lit(False)) for r in rules)))


def describe(features_df: DataFrame, columns=DESCRIBED) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum per feature, one pass."""
    long = features_df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return (
        long.unpivot([], columns, "feature", "value").groupBy("feature")
        .agg(
            F.count("value").alias("value_count"),
            F.round(F.avg("value"), 4).alias("mean"),
            F.round(F.stddev("value"), 4).alias("stddev"),
            F.round(F.min("value"), 4).alias("min"),
            F.round(F.max("value"), 4).alias("max")))
