"""Scores of arriving claims against the batch scores over the same claims."""

import pytest
from pyspark.sql import functions as F

from claimrisk.plans import marts, ml, silver
from claimrisk.queries import clean_claims
from claimrisk.schemas import PROVIDER_KEYS
from claimrisk.session import store
from claimrisk.streaming import scoring


@pytest.fixture
def rocksdb(spark):
    before = {k: spark.conf.get(k, None) for k in scoring.ROCKSDB}
    for key, value in scoring.ROCKSDB.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_last_scores_equal_the_batch(spark, sf_dir, rocksdb, tmp_path):
    claims = store(clean_claims(spark, sf_dir))
    odd = claims.limit(3).withColumns({"state": F.lit(None).cast("string"), "avg_medicare_paid": F.lit(0.0),
                                       "procedure_code": F.lit(None).cast("string")})
    claims = store(claims.unionByName(odd))
    peers = store(silver.peer_stats(claims))
    mart = marts.fct_provider_risk(store(silver.features(claims)))
    inputs = store(ml.features_table(mart))
    models = [ml.fit_newton(inputs, "no_leak", rounds=3, depth=3)]
    expected = {tuple(r[k] for k in PROVIDER_KEYS): r for r in ml.score(inputs, models[0]).collect()}

    part = F.pmod(F.xxhash64("procedure_code", "total_services"), F.lit(3))
    schema, source = claims.schema, str(tmp_path / "in")

    def run():
        """A new query from the checkpoint, as after a restart."""
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(source)
        scores = scoring.scores_of_arriving_claims(stream, peers, models[0])
        batch = []
        scores.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(
            availableNow=True).foreachBatch(lambda df, i: batch.extend((i, r) for r in df.collect())).start().awaitTermination()
        return batch

    found, seen = {}, 0
    for number in range(3):
        claims.filter(part == number).coalesce(1).write.mode("append").parquet(source)
        rows = run()
        touched = claims.filter(part == number).select(*PROVIDER_KEYS).distinct().count()
        assert len(rows) == touched  # only providers of the new claims, once each
        found |= {tuple(r[k] for k in PROVIDER_KEYS): r for _, r in sorted(rows, key=lambda p: p[0])}
        seen += len(rows)
    assert seen > len(found) and set(found) == set(expected)
    for key, row in found.items():
        want = expected[key]
        for column in (*ml.MODEL_FEATURES, "risk_score", "predicted_fraud", "fraud_flag"):
            assert row[column] == pytest.approx(want[column], abs=2e-4), (key, column)
    tiers = {tuple(r[k] for k in PROVIDER_KEYS): r.risk_tier for r in mart.collect()}
    assert all(r.risk_tier == tiers[k] for k, r in found.items())
