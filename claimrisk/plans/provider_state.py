"""Provider tables that follow late parts: a mergeable state per part instead of a rebuild from all claims.

A part's claims are read once. What stays of them are sums, counts and extremes per provider key, the distinct
procedures of each key, and count, mean and squared deviations per specialty; all of these merge exactly,
in any order. Quantile sketches per specialty say where exact percentiles must look. The state of a part is a folder of its own, named by the part and written whole or not at all, so a part that is
loaded again changes nothing. Folding many parts into one base keeps reads short.
"""

from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimrisk.functions.columns import claim_value, exact_parts, exact_total, zscore
from claimrisk.operators.lookup_join import lookup_join
from claimrisk.plans.gold import rank_and_tier
from claimrisk.plans.marts import rank_and_tier_by_peak
from claimrisk.plans.silver import CHARGE, RATIOS, claim_sketches, merge_claim_sketches, ratio_columns
from claimrisk.schemas import PROVIDER_KEYS, PROVIDER_MEASURES
from claimrisk.session import Size, drop_stored, file_system, materialise_measured, store

# The columns of clean claims that a state is made from.
INPUTS = [*PROVIDER_KEYS, "procedure_code", "place_of_service", CHARGE, "avg_medicare_paid",
          "total_services", "total_beneficiaries"]
# A folder of state is committed when the last of its tables is.
TABLES = ["peers", "sketches", "procedures", "providers"]



def _sums() -> dict:
    """The columns of a provider's state that add up."""
    amounts = {"billed": claim_value(), "paid": claim_value("avg_medicare_paid"), "services": "total_services"}
    columns = {"claims": F.count("*"), "beneficiaries": F.sum("total_beneficiaries"),
               "facility_claims": F.count_if(F.col("place_of_service") == "F"),
               "charges": F.count(CHARGE), "charge_sum": F.sum(CHARGE)}
    for name, amount in amounts.items():
        whole, millionths = exact_parts(amount)
        columns |= {f"{name}_whole": F.sum(whole), f"{name}_millionths": F.sum(millionths)}
    for name in RATIOS:
        columns |= {f"{name}_count": F.count(name), f"{name}_sum": F.sum(name)}
    return columns


# The names of these columns.
SUMS = ["claims", "beneficiaries", "facility_claims", "charges", "charge_sum", *[
    f"{name}_{part}" for name in ("billed", "paid", "services") for part in ("whole", "millionths")], *[
    f"{name}_{part}" for name in RATIOS for part in ("count", "sum")]]


def part_state(claims: DataFrame) -> dict[str, DataFrame]:
    """The state of some stored claims: ``providers``, ``procedures``, ``peers`` and ``sketches``."""
    rows = claims.withColumns(ratio_columns())
    return {
        "providers": rows.groupBy(*PROVIDER_KEYS).agg(
            *[c.alias(name) for name, c in _sums().items()], F.max(CHARGE).alias("max_charge")),
        "procedures": claims.select(*PROVIDER_KEYS, "procedure_code").distinct(),
        "peers": claims.groupBy("specialty").agg(
            F.count(CHARGE).alias("n"), F.avg(CHARGE).alias("mean"),
            (F.var_pop(CHARGE) * F.count(CHARGE)).alias("squares"),
            F.min(CHARGE).alias("low"), F.max(CHARGE).alias("high")),
        "sketches": claim_sketches(claims),
    }


def merge_providers(states: DataFrame) -> DataFrame:
    """One row per provider key from any number of states."""
    return states.groupBy(*PROVIDER_KEYS).agg(
        *[F.sum(c).alias(c) for c in SUMS], F.max("max_charge").alias("max_charge"))


def merge_procedures(states: DataFrame) -> DataFrame:
    return states.distinct()


def merge_peers(states: DataFrame) -> DataFrame:
    """Count, mean and squared deviations of the union (Chan et al., 1979): around the pooled mean, so that no large sums are
    subtracted. A specialty has one row per part, so this is small."""
    pooled = states.groupBy("specialty").agg(
        F.sum("n").alias("all_n"), F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("all_mean"))
    apart = F.col("mean") - F.col("all_mean")
    return lookup_join(states, pooled, ["specialty"]).groupBy("specialty").agg(
        F.sum("n").alias("n"), F.max("all_mean").alias("mean"),
        F.sum(F.col("squares") + F.col("n") * apart * apart).alias("squares"),
        F.min("low").alias("low"), F.max("high").alias("high"))


MERGE = {"providers": merge_providers, "procedures": merge_procedures, "peers": merge_peers,
         "sketches": merge_claim_sketches}


class ProviderState:
    """States of parts under ``path``, a folder that driver and executors share. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _names(self, kind) -> list:
        system, place = file_system(self.spark, f"{self.path}/{kind}")
        if not system.exists(place):
            return []
        names = [status.getPath().getName() for status in system.listStatus(place)]
        return [n for n in names if system.exists(
            file_system(self.spark, f"{self.path}/{kind}/{n}/{TABLES[-1]}/_SUCCESS")[1])]

    def _base(self):
        """(folder of the newest base, names of the parts in it); (None, nothing) before the first."""
        numbers = sorted(int(n) for n in self._names("base"))
        if not numbers:
            return None, set()
        folder = f"{self.path}/base/{numbers[-1]}"
        return folder, {r.part for r in self.spark.read.parquet(f"{folder}/parts").collect()}

    def parts(self) -> list:
        """Names of the parts that are in, in order."""
        return sorted(self._base()[1] | {unquote(n) for n in self._names("parts")})

    def _write(self, folder, tables: dict) -> None:
        for name in TABLES:
            tables[name].write.mode("overwrite").parquet(f"{folder}/{name}")

    def add_part(self, name: str, claims: DataFrame) -> bool:
        """Add the clean claims of a part; False if a part of that name is in already.

        ``claims`` is read once; nothing of other parts is read. What an attempt that broke off wrote is overwritten.
        """
        if name in self.parts():
            return False
        narrow = store(claims, INPUTS)
        self._write(f"{self.path}/parts/{quote(name, safe='')}", part_state(narrow))
        drop_stored(narrow)
        return True

    def _folders(self) -> list:
        base, folded = self._base()
        single = [f"{self.path}/parts/{n}" for n in self._names("parts") if unquote(n) not in folded]
        return ([base] if base else []) + sorted(single)

    def table(self, name) -> DataFrame | None:
        """One of TABLES of all parts, merged; None before the first part."""
        folders = self._folders()
        if not folders:
            return None
        rows = self.spark.read.parquet(*[f"{folder}/{name}" for folder in folders])
        return MERGE[name](rows) if len(folders) > 1 else rows

    def fold(self) -> bool:
        """Merge the parts that are in into a new base, which then stands for them; False if there are fewer than two folders.

        Readers see the former folders until the base is whole; folders that it replaces are removed afterwards, when no
        query on them may be running any more.
        """
        folders, names = self._folders(), self.parts()
        if len(folders) < 2:
            return False
        number = max([int(n) for n in self._names("base")], default=0) + 1
        folder = f"{self.path}/base/{number}"
        self.spark.createDataFrame([(n,) for n in names], "part string").write.mode("overwrite").parquet(f"{folder}/parts")
        self._write(folder, {name: self.table(name) for name in TABLES})
        for old in folders:
            system, place = file_system(self.spark, old)
            system.delete(place, True)
        return True

    def scored_providers(self) -> tuple[DataFrame, Size]:
        """As ``gold.scored_providers`` over the claims of all parts: measures and ``peak_zscore`` of each provider key."""
        procedures = self.table("procedures").groupBy(*PROVIDER_KEYS).agg(
            F.count("procedure_code").alias("unique_procedures"))
        states = self.table("providers")
        # A union and a sum instead of a join: both sides are grouped by the keys anyway.
        base = states.withColumn("unique_procedures", F.lit(None).cast("long")).unionByName(
            procedures, allowMissingColumns=True).groupBy(*PROVIDER_KEYS).agg(
            *[F.sum(c).alias(c) for c in [*SUMS, "unique_procedures"]], F.max("max_charge").alias("max_charge"))
        base, size = materialise_measured(base)
        n = F.col("n")
        spread = F.when(n == 1, None).when(F.col("low") == F.col("high"), 0.0).otherwise(
            F.sqrt(F.try_divide("squares", n - 1)))
        peers = self.table("peers").select("specialty", F.col("mean").alias("peer_mean"), spread.alias("peer_spread"))
        scored = lookup_join(base, peers, ["specialty"], size=size)
        peak = zscore("max_charge", "peer_mean", "peer_spread")
        mean = F.try_divide("charge_sum", "charges")

        def average(name):
            return F.round(F.try_divide(f"{name}_sum", f"{name}_count"), 4)

        measures = {
            "total_procedures": F.col("claims"),
            "total_beneficiaries": F.col("beneficiaries"),
            "total_services": exact_total("services_whole", "services_millionths"),
            "total_billed": exact_total("billed_whole", "billed_millionths", 2),
            "total_paid": exact_total("paid_whole", "paid_millionths", 2),
            "avg_charge_ratio": average("charge_to_payment_ratio"),
            "avg_billing_intensity": average("billing_intensity"),
            "max_zscore": F.round(peak, 4),
            "avg_zscore": F.round(zscore(mean, "peer_mean", "peer_spread"), 4),
            "unique_procedures": F.coalesce("unique_procedures", F.lit(0).cast("long")),
            "facility_rate": F.round(F.col("facility_claims") / F.col("claims"), 4),
        }
        return scored.select(
            *PROVIDER_KEYS, *[measures[m].alias(m) for m in PROVIDER_MEASURES], peak.alias("peak_zscore")), size

    def provider_risk(self, run_ts=None) -> DataFrame:
        """``gold.provider_risk`` over the claims of all parts, from their states alone."""
        scored, size = self.scored_providers()
        return rank_and_tier(scored.drop("peak_zscore"), size, run_ts)

    def fct_provider_risk(self, run_ts=None) -> DataFrame:
        """``marts.fct_provider_risk`` over the claims of all parts, from their states alone."""
        return rank_and_tier_by_peak(*self.scored_providers(), run_ts)
