"""Scores that follow arriving claims: keyed state per provider, one updated provider row per micro-batch and touched provider."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from claimrisk.functions.columns import flag, risk_tier, zscore
from claimrisk.operators.lookup_join import null_safe_join
from claimrisk.plans import ml, serving
from claimrisk.plans.silver import CHARGE, RATIOS, ratio_columns
from claimrisk.schemas import PROVIDER_KEYS

# What adds up over the claims of a provider; ratios and z-scores with the number of their values.
SUMS = ["claims", "beneficiaries", "services", "billed", "paid", "facility_claims", "z_sum", "z_count",
        *[f"{name}_{part}" for name in RATIOS for part in ("sum", "count")]]
PARTIAL = T.StructType([T.StructField(k, T.LongType() if k == "provider_id" else T.StringType()) for k in PROVIDER_KEYS] + [
    T.StructField(c, T.DoubleType()) for c in (*SUMS, "max_z")] + [T.StructField("codes", T.ArrayType(T.StringType()))])
STATE = T.StructType([T.StructField(c, T.DoubleType()) for c in (*SUMS, "max_z")])
OUT = T.StructType(PARTIAL.fields[:-1] + [T.StructField("unique_procedures", T.LongType())])


def _partial_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The sums of each provider in an Arrow batch: a provider with very many claims sends one row per batch to its state."""
    for rows in batches:
        if not len(rows):
            continue
        grouped = rows.groupby(PROVIDER_KEYS, dropna=False, sort=False)
        out = grouped[SUMS].sum()
        out["max_z"] = grouped["max_z"].max()
        out["codes"] = grouped["procedure_code"].agg(lambda c: sorted(set(c.dropna())))
        out = out.reset_index()
        for key in PROVIDER_KEYS[1:]:
            out[key] = out[key].astype(object).where(out[key].notna(), None)
        yield out[PARTIAL.fieldNames()]


class ProviderSums(StatefulProcessor):
    """Adds a provider's sums to its state and puts out the totals; procedures are kept as a set."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", STATE)
        self.codes = handle.getMapState("codes", "code string", "seen int")
        self.distinct = handle.getValueState("distinct", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows))
        old = self.totals.get() if self.totals.exists() else None
        sums = new[SUMS].sum().to_numpy(dtype=float) + (np.array(old[:-1], float) if old else 0.0)
        highest = np.nanmax([*new["max_z"].astype(float), old[-1] if old and old[-1] is not None else np.nan, -np.inf])
        highest = None if highest == -np.inf else float(highest)
        distinct = self.distinct.get()[0] if self.distinct.exists() else 0
        for code in sorted({c for codes in new["codes"] for c in codes}):
            if not self.codes.containsKey((code,)):
                self.codes.updateValue((code,), (1,))
                distinct += 1
        self.totals.update((*sums.tolist(), highest))
        self.distinct.update((distinct,))
        values = dict(zip(PROVIDER_KEYS, key)) | dict(zip(SUMS, sums.tolist())) | {"max_z": highest, "unique_procedures": distinct}
        yield pd.DataFrame({c: pd.Series([values[c]], dtype=object) for c in OUT.fieldNames()})

    def close(self) -> None:
        pass


def provider_rows(claims: DataFrame, peers: DataFrame) -> DataFrame:
    """A stream of updated provider rows (the model inputs, billed total and tier) from a stream of clean claims.

    ``peers`` is a stored table of ``specialty, specialty_avg_charge, specialty_stddev_charge``, as of ``silver.peer_stats``: z-scores
    refer to it, so a row says where the provider stands among the peers known when the stream was started.
    """
    known = peers.select("specialty", "specialty_avg_charge", "specialty_stddev_charge")
    scored = null_safe_join(claims.withColumns(ratio_columns()), known, ["specialty"], "left").withColumn(
        "z", zscore(CHARGE, "specialty_avg_charge", "specialty_stddev_charge"))

    def number(column):
        return F.coalesce(column.cast("double"), F.lit(0.0))

    terms = {
        "claims": F.lit(1.0), "beneficiaries": number(F.col("total_beneficiaries")), "services": number(F.col("total_services")),
        "billed": number(F.col(CHARGE) * F.col("total_services")), "paid": number(F.col("avg_medicare_paid") * F.col("total_services")),
        "facility_claims": flag(F.col("place_of_service") == "F").cast("double"),
        "z_sum": number(F.col("z")), "z_count": number(F.col("z").isNotNull().cast("int")),
    }
    for name in RATIOS:
        terms |= {f"{name}_sum": number(F.col(name)), f"{name}_count": number(F.col(name).isNotNull().cast("int"))}
    rows = scored.select(*PROVIDER_KEYS, "procedure_code", *[c.alias(name) for name, c in terms.items()], F.col("z").alias("max_z"))
    states = rows.mapInPandas(_partial_sums, PARTIAL).groupBy(*PROVIDER_KEYS).transformWithStateInPandas(
        ProviderSums(), OUT, outputMode="Update", timeMode="None")

    def average(name):
        return F.round(F.try_divide(f"{name}_sum", f"{name}_count"), 4)

    return states.select(
        *PROVIDER_KEYS, average("charge_to_payment_ratio").alias("avg_charge_ratio"),
        average("billing_intensity").alias("avg_billing_intensity"), F.round("max_z", 4).alias("max_zscore"),
        average("z").alias("avg_zscore"), "unique_procedures",
        F.round(F.col("facility_claims") / F.col("claims"), 4).alias("facility_rate"),
        F.col("claims").cast("long").alias("total_procedures"), F.col("services").alias("total_services"),
        F.col("beneficiaries").cast("long").alias("total_beneficiaries"),
        risk_tier("max_z").alias("risk_tier"), F.round("billed", 2).alias("total_billed"))


def scores_of_arriving_claims(claims: DataFrame, peers: DataFrame, model) -> DataFrame:
    """Scored provider rows as claims arrive: a provider's last row is its score over all its claims so far.

    Write it in append or update mode with a checkpoint; after a restart the state goes on from there. The state store must
    be RocksDB (``spark.sql.streaming.stateStore.providerClass``).
    """
    inputs = ml.features_table(provider_rows(claims, peers), carry=serving.CARRIED)
    return ml.score(inputs, model)


ROCKSDB = {"spark.sql.streaming.stateStore.providerClass":
           "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
