"""Provider tables from the states of parts: the same as from all claims, whatever the order of the parts."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F
from test_scans import last_execution, rows_read

from claimrisk.plans import gold, marts, provider_state, runs, silver
from claimrisk.plans.provider_state import ProviderState
from claimrisk.queries import clean_claims
from claimrisk.schemas import PROVIDER_KEYS
from claimrisk.session import store
from claimrisk.sources.claims_mapping import raw_claims


def rows_of(df):
    return sorted(map(tuple, df.drop("gold_processed_at", "dbt_processed_at").collect()), key=repr)


@pytest.fixture(scope="module")
def claims(spark, sf_dir):
    return store(clean_claims(spark, sf_dir).withColumn("part", F.pmod(F.xxhash64("procedure_code"), F.lit(4))))


@pytest.fixture(scope="module")
def expected(claims):
    return rows_of(gold.provider_risk_from_claims(claims)), rows_of(marts.fct_provider_risk_from_claims(claims))


def part(claims, number):
    return claims.filter(F.col("part") == number).drop("part")


@pytest.mark.parametrize("order", [[0, 1, 2, 3], [3, 1, 3, "fold", 0, 2, 0], [2, "fold", 0, "fold", "fold", 1, 3, "fold", 2]])
def test_any_order_and_repeats(spark, claims, expected, tmp_path, order):
    state, seen = ProviderState(spark, str(tmp_path / "state")), set()
    for number in order:
        if number == "fold":
            several = len(state._folders()) > 1
            assert state.fold() == several and len(state._folders()) == 1
        else:
            assert state.add_part(f"a/b {number}%", part(claims, number)) == (number not in seen)
            seen.add(number)
    assert state.parts() == [f"a/b {n}%" for n in range(4)]
    assert rows_of(state.provider_risk()) == expected[0]
    assert rows_of(state.fct_provider_risk()) == expected[1]


def test_only_the_claims_of_the_new_part_are_read(spark, claims):
    root = tempfile.mkdtemp(dir="/tmp")  # a short path: plans show only the beginning
    folder = f"{root}/claims"
    claims.write.partitionBy("part").parquet(folder)
    state = ProviderState(spark, f"{root}/state")
    sizes = [part(claims, n).count() for n in range(4)]
    for number in range(4):
        before = last_execution(spark)
        state.add_part(str(number), spark.read.parquet(f"{folder}/part={number}"))
        last_execution(spark)
        assert rows_read(spark, before, f"/claims/part={number}") == sizes[number]
        assert rows_read(spark, before, "/state/") == 0
    before = last_execution(spark)
    state.provider_risk().collect()
    last_execution(spark)
    assert rows_read(spark, before, "/claims") == 0


def test_a_part_that_broke_off_is_not_in(spark, claims, expected, tmp_path):
    state = ProviderState(spark, str(tmp_path))
    for number in range(4):
        state.add_part(str(number), part(claims, number))
    os.remove(tmp_path / "parts" / "2" / "providers" / "_SUCCESS")
    assert state.parts() == ["0", "1", "3"] and rows_of(state.provider_risk()) != expected[0]
    assert state.add_part("2", part(claims, 2))
    assert rows_of(state.provider_risk()) == expected[0]


def test_a_fold_that_broke_off_changes_nothing(spark, claims, expected, tmp_path):
    state = ProviderState(spark, str(tmp_path))
    for number in range(4):
        state.add_part(str(number), part(claims, number))
    names = state.parts()
    state.spark.createDataFrame([(n,) for n in names], "part string").write.parquet(f"{tmp_path}/base/1/parts")
    state.table("peers").write.parquet(f"{tmp_path}/base/1/peers")
    assert state.parts() == names and rows_of(state.provider_risk()) == expected[0]
    assert state.fold() and state.parts() == names
    assert rows_of(state.provider_risk()) == expected[0]


def test_peers_merge_like_all_rows(spark):
    rows = [("a", 1e9 + i, i % 3) for i in range(50)] + [("b", 5.25, i % 2) for i in range(7)] + [
        ("c", 3.0, 0), (None, 1.0, 0), (None, 2.0, 1), (None, 9.0, 2)]
    claims = spark.createDataFrame(rows, "specialty string, avg_submitted_charge double, part int")
    for key in (*PROVIDER_KEYS, "procedure_code", "place_of_service"):
        if key != "specialty":
            claims = claims.withColumn(key, F.lit("1"))
    claims = claims.withColumns({c: F.lit(1.0) for c in ("avg_medicare_paid", "total_services", "total_beneficiaries")})
    states = [provider_state.part_state(claims.filter(F.col("part") == p))["peers"] for p in range(3)]
    merged = provider_state.merge_peers(states[0].unionByName(states[1]).unionByName(states[2]))
    whole = {r.specialty: r for r in provider_state.part_state(claims)["peers"].collect()}
    for r in merged.collect():
        assert (r.n, r.low, r.high) == (whole[r.specialty].n, whole[r.specialty].low, whole[r.specialty].high)
        assert r["mean"] == pytest.approx(whole[r.specialty]["mean"], rel=1e-12)
        assert r.squares == pytest.approx(whole[r.specialty].squares, rel=1e-9, abs=1e-9)
    assert whole["b"].squares == 0 and {r.specialty for r in merged.collect()} == {"a", "b", "c", None}


def test_odd_providers(spark, raw, tmp_path):
    rows = [{"Rndrng_NPI": 1}, {"Rndrng_NPI": 1, "Avg_Sbmtd_Chrg": 300.0, "HCPCS_Cd": None},
            {"Rndrng_NPI": 2, "Avg_Mdcr_Pymt_Amt": 0.0, "Tot_Benes": 0}, {"Rndrng_NPI": 3, "Rndrng_Prvdr_Type": "Only one"},
            {"Rndrng_NPI": 4, "Rndrng_Prvdr_Type": None, "Rndrng_Prvdr_City": None, "Tot_Srvcs": 0.1},
            {"Rndrng_NPI": 4, "Rndrng_Prvdr_Type": None, "Rndrng_Prvdr_City": None, "Tot_Srvcs": 0.2, "Tot_Benes": None}]
    state = ProviderState(spark, str(tmp_path))
    for number, row in enumerate(rows):
        state.add_part(str(number), silver.clean(raw(row)))
    state.add_part("empty", silver.clean(raw(rows[0])).limit(0))
    everything = gold.provider_risk_from_claims(silver.clean(raw(*rows)))
    found = state.provider_risk()
    assert found.dtypes == everything.dtypes
    left, right = rows_of(found.drop("total_services")), rows_of(everything.drop("total_services"))
    assert left == right
    services = {r.provider_id: r.total_services for r in found.collect()}
    assert services == pytest.approx({1: 40.0, 2: 20.0, 3: 20.0, 4: 0.3})


def test_parts_follow_a_stream(spark, tmp_path):
    from test_ingest import HEADER, line

    from claimrisk.sources.csv_parts import read_parts
    from claimrisk.streaming.arrivals import follow_parts

    folder = tmp_path / "parts"
    folder.mkdir()
    state = ProviderState(spark, str(tmp_path / "state"))
    (folder / "a.csv").write_text("\n".join([HEADER, line(1), line(2, "7.5")]) + "\n")
    follow_parts(state, str(folder), str(tmp_path / "checkpoint")).awaitTermination()
    (folder / "b.csv").write_text("\n".join([line(1, "20.25"), line(3, "oops")]) + "\n")
    (folder / "c.csv").write_text(line(2, "9.5") + "\n")
    for _ in range(2):
        follow_parts(state, str(folder), str(tmp_path / "checkpoint")).awaitTermination()
    assert len(state.parts()) == 3
    everything = gold.provider_risk_from_claims(silver.clean(read_parts(spark, str(folder))))
    assert rows_of(state.provider_risk()) == rows_of(everything)


def test_late_part_reaches_serving(spark, sf_dir, tmp_path):
    raw = raw_claims(spark, sf_dir).withColumn("late", F.col("Rndrng_NPI") % 4 == 0)
    early, late = (raw.filter(F.col("late") == which).drop("late") for which in (False, True))
    schemas = {layer: f"late_{layer}" for layer in runs.SCHEMAS}
    model = str(tmp_path / "model")
    runs.run_all(spark, raw=early, schemas=schemas, rounds=2, depth=2, model_path=model)
    before = spark.table("late_gold.serving_provider_risk").count()
    state = ProviderState(spark, str(tmp_path / "state"))
    state.add_part("early", silver.clean(early))
    report = {r.table_name: r.rows for r in runs.run_part(state, "late", late, model, schemas=schemas).collect()}
    whole = gold.provider_risk_from_claims(silver.clean(raw.drop("late")))
    assert rows_of(spark.table("late_gold.provider_risk")) == rows_of(whole)
    assert report["late_gold.serving_provider_risk"] == whole.count() > before
    again = runs.run_part(state, "late", late, model, schemas=schemas)
    assert {r.table_name: r.rows for r in again.collect()} == report


def test_percentiles_read_the_claims_once(spark, claims, monkeypatch):
    """With the merged sketches of the parts; exact also with sketches of other claims, or none for a specialty."""
    from claimrisk.operators import ordered

    monkeypatch.setattr(ordered, "SMALL_GROUP", 20)
    root = tempfile.mkdtemp(dir="/tmp")
    claims.write.parquet(f"{root}/claims")
    stored = spark.read.parquet(f"{root}/claims")
    state = ProviderState(spark, f"{root}/state")
    for number in range(4):
        state.add_part(str(number), part(stored, number))
    exact = stored.withColumns(silver.ratio_columns()).groupBy("specialty").agg(
        F.percentile("avg_submitted_charge", 0.5).alias("charge_median"), F.percentile("avg_submitted_charge", 0.95).alias("charge_p95"),
        F.percentile("charge_to_payment_ratio", 0.5).alias("ratio_median"),
        F.percentile("charge_to_payment_ratio", 0.95).alias("ratio_p95"))
    expected = {r.specialty: r.asDict() for r in exact.collect()}
    sketches = state.table("sketches")
    assert {r.n for r in sketches.filter("metric = 'charge'").collect()} == {
        r.n for r in claims.groupBy("specialty").agg(F.count("avg_submitted_charge").alias("n")).collect()}
    before = last_execution(spark)
    found = gold.specialty_percentiles(stored, sketches).collect()
    last_execution(spark)
    assert rows_read(spark, before, f"{root}/claims") == claims.count()
    off = ProviderState(spark, f"{root}/other")
    off.add_part("dear ones", stored.filter("avg_submitted_charge > 1200 AND specialty <> 'BUILDING'"))
    for result in (found, gold.specialty_percentiles(stored, off.table("sketches")).collect()):
        assert {r.specialty for r in result} == set(expected)
        for r in result:
            assert r.asDict() == pytest.approx(expected[r.specialty])
    medians = [sorted(map(tuple, silver.features_median(stored, s).select(
        "provider_id", "procedure_code", "specialty_median_charge", "specialty_median_ratio").collect())) for s in (None, sketches)]
    assert medians[0] == medians[1]
    features = store(silver.features(stored))
    flags = [silver.label_any(features, sketches=s).groupBy("fraud_flag").count().collect() for s in (None, sketches)]
    assert sorted(flags[0]) == sorted(flags[1])
