"""Hand-made rows for the rules that the order tables do not exercise."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from claimrisk.functions.columns import exact_sum, risk_tier
from claimrisk.plans import bronze, gold, marts, quality, silver

RUN = datetime(2024, 1, 2, 3, 4, 5)


def features(raw_rows):
    return silver.features(silver.clean(raw_rows, RUN), RUN)


def both_risks(raw_rows):
    claims = silver.clean(raw_rows, RUN)
    return [gold.provider_risk(silver.features(claims, RUN), RUN),
            gold.provider_risk_from_claims(claims, RUN)]


def test_unusable_rows_are_dropped(raw):
    rows = raw({"Avg_Sbmtd_Chrg": 0.00005}, {"Avg_Sbmtd_Chrg": None}, {"Rndrng_NPI": None}, {},
               {"Avg_Sbmtd_Chrg": 0.01})
    assert silver.clean(rows).count() == 2
    assert silver.row_audit(rows).first().asDict() == {
        "bronze_rows": 5, "silver_rows": 2, "rows_dropped": 3, "silver_columns": 30}


def test_clean_columns_case_and_audit(raw):
    row = silver.clean(raw({"Rndrng_Prvdr_State_Abrvtn": "ca", "Place_Of_Srvc": "f"}), RUN, "part").first()
    assert (row.state, row.place_of_service, row.source_file) == ("CA", "F", "part")
    assert row.silver_processed_at == RUN and len(row) == 30 and row.zip_code == "01234"


def test_recorded_file_name_is_kept(raw):
    rows = raw({}).withColumn("source_file", F.lit("part_b.csv"))
    assert silver.clean(rows).first().source_file == "part_b.csv"


def test_feature_columns(raw):
    row = features(raw({"Place_Of_Srvc": "f"}, {"Avg_Sbmtd_Chrg": 300.0})).orderBy(
        "avg_submitted_charge").first()
    assert len(row) == 37 and row.features_created_at == RUN
    assert (row.charge_to_payment_ratio, row.billing_intensity, row.facility_flag) == (2.0, 2.0, 1)
    assert row.specialty_avg_charge == 200.0
    assert row.provider_charge_zscore == pytest.approx(-100 / 20000 ** 0.5)


@pytest.mark.parametrize("change, column", [
    ({"Avg_Mdcr_Pymt_Amt": 0.0}, "charge_to_payment_ratio"),
    ({"Avg_Mdcr_Pymt_Amt": None}, "charge_to_payment_ratio"),
    ({"Tot_Benes": 0}, "billing_intensity"),
    ({"Tot_Benes": None}, "billing_intensity"),
])
def test_guarded_ratios(raw, change, column):
    assert features(raw(change)).first()[column] is None


def test_zero_paid_is_left_out_of_the_average(raw):
    rows = raw({"Avg_Mdcr_Pymt_Amt": 0.0}, {})
    for risk in both_risks(rows):
        assert risk.first().avg_charge_ratio == 2.0


def test_zero_patients_are_absent_from_concentration(raw):
    rows = raw({"Tot_Benes": 0}, {"Rndrng_NPI": 2})
    for risk in both_risks(rows):
        assert [r.provider_id for r in gold.kpi_patient_concentration(risk).collect()] == [2]


def test_one_row_specialty_is_normal_and_last(raw):
    rows = raw({"Rndrng_Prvdr_Type": "Rare", "Rndrng_NPI": 9})
    assert features(rows).first().provider_charge_zscore is None
    for risk in [*both_risks(rows), marts.fct_provider_risk(features(rows))]:
        row = risk.first()
        assert (row.max_zscore, row.avg_zscore, row.risk_tier, row.specialty_rank) == (
            None, None, "Normal", 1)


def test_unknown_score_ranks_last(spark):
    rows = spark.createDataFrame([("s", 1.0), ("s", None), ("s", 2.0)], "specialty string, z double")
    from claimrisk.operators.ordered import add_rank
    assert {r.z: r.r for r in add_rank(rows, ["specialty"], "z", "r").collect()} == {
        2.0: 1, 1.0: 2, None: 3}


def test_equal_charges_have_zero_score(raw):
    rows = raw(*[{"Rndrng_NPI": i, "Avg_Sbmtd_Chrg": 0.1} for i in range(7)])
    for risk in both_risks(rows):
        for row in risk.collect():
            assert (row.max_zscore, row.avg_zscore, row.specialty_rank, row.risk_tier) == (
                0.0, 0.0, 1, "Normal")


def test_null_specialty_is_one_peer_group(raw):
    rows = raw({"Rndrng_Prvdr_Type": None, "Avg_Sbmtd_Chrg": 100.0},
               {"Rndrng_Prvdr_Type": None, "Avg_Sbmtd_Chrg": 200.0, "Rndrng_NPI": 2}, {"Avg_Sbmtd_Chrg": 7.0})
    peers = [r for r in features(rows).collect() if r.specialty is None]
    assert {r.specialty_avg_charge for r in peers} == {150.0}
    for risk in both_risks(rows):
        assert sorted(r.specialty_rank for r in risk.collect() if r.specialty is None) == [1, 2]


def test_null_place_passes(raw):
    frame = features(raw({"Place_Of_Srvc": None}))
    assert frame.first().facility_flag == 0
    tests = quality.column_tests(frame, "t", accepted={"place_of_service": quality.PLACES})
    assert tests.first().failures == 0


def test_rank_has_gaps_after_ties(raw):
    charges = {1: 500.0, 2: 500.0, 3: 100.0}
    rows = raw(*[{"Rndrng_NPI": k, "Avg_Sbmtd_Chrg": v} for k, v in charges.items()])
    for risk in both_risks(rows):
        assert {r.provider_id: r.specialty_rank for r in risk.collect()} == {1: 1, 2: 1, 3: 3}


def test_tier_boundary_rounds_first_only_in_gold(spark, raw):
    frame = features(raw({})).withColumn("provider_charge_zscore", F.lit(2.99996))
    assert gold.provider_risk(frame).first().risk_tier == "Critical"
    mart = marts.fct_provider_risk(frame).first()
    assert (mart.risk_tier, mart.max_zscore) == ("Elevated", 3.0)
    values = spark.createDataFrame([(3.0,), (2.9999,), (1.0,), (0.9,), (None,)], "z double")
    assert [r[0] for r in values.select(risk_tier("z")).collect()] == [
        "Critical", "Elevated", "Elevated", "Normal", "Normal"]


def test_provider_in_two_cities(raw):
    rows = raw({}, {"Rndrng_Prvdr_City": "B"})
    for risk in both_risks(rows):
        assert risk.count() == 2
        assert quality.unique(risk, "t", ["provider_id"]).first().failures == 1


def test_duplicates_are_counted_and_removed_on_request(raw):
    rows = raw({"Avg_Sbmtd_Chrg": 5.0}, {"Avg_Sbmtd_Chrg": 4.0}, {"HCPCS_Cd": None}, {"HCPCS_Cd": None},
               {"Place_Of_Srvc": "o"}, {"Avg_Sbmtd_Chrg": 0.001, "Rndrng_NPI": None, "HCPCS_Cd": "x",
                                        "Avg_Mdcr_Pymt_Amt": 0.0})
    report = {r.check_name: r.rows for r in bronze.quality_report(rows).collect()}
    assert report == {"null_provider": 1, "null_procedure": 2, "charge_below_minimum": 1,
                      "zero_paid": 1, "duplicate_grain": 2}
    assert silver.clean(rows).count() == 5
    kept = silver.clean(rows, RUN, dedupe=True)
    assert kept.columns == silver.clean(rows, RUN).columns
    # The upper-cased place makes the lower-case row a copy as well.
    assert sorted((r.procedure_code or "", r.avg_submitted_charge) for r in kept.collect()) == [
        ("", 100.0), ("99213", 4.0)]


def test_anomaly_flags(raw):
    rows = raw({"Avg_Sbmtd_Chrg": -1.0}, {"Avg_Mdcr_Pymt_Amt": 0.0, "Rndrng_NPI": 2},
               {"Rndrng_NPI": 3, "Tot_Benes": 1, "Tot_Srvcs": 11.0})
    assert {r.flag: r.hits for r in bronze.anomaly_flags(rows).collect()} == {
        "negative_charge_rows": 1, "zero_paid_rows": 1, "overserved_providers": 1}


def test_top_one_percent_of_few_or_equal_rows_is_empty(raw):
    assert gold.kpi_high_cost_claims(features(raw({}))).count() == 0
    copies = F.explode(F.sequence(F.lit(1), F.lit(1500)))
    equal = features(raw({}, {})).withColumn("copy", copies).drop("copy")
    assert gold.kpi_high_cost_claims(equal).count() == 0


def test_high_cost_measure_is_a_parameter(raw):
    rows = features(raw(*[{"Avg_Sbmtd_Chrg": float(i), "Tot_Srvcs": 1000.0 / i} for i in range(1, 201)]))
    top = gold.kpi_high_cost_claims(rows, measure="avg_submitted_charge").collect()
    assert sorted(r.avg_submitted_charge for r in top) == [199.0, 200.0]


def test_money_sum_is_exact_and_skips_nulls(spark):
    rows = spark.createDataFrame([(0.1,)] * 10 + [(None,), (-0.25,), (1e11 + 0.5,)], "v double")
    assert rows.agg(exact_sum("v", 2)).first()[0] == 1e11 + 1.25
    assert rows.filter("v is null").agg(exact_sum("v", 2)).first()[0] is None


def test_relationships_count_child_rows(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    assert quality.relationships(child, parent, "child", "k").first().failures == 2
    assert quality.relationships(parent, child, "parent", "k").first().failures == 0


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), float("-inf")])
def test_one_bad_number_changes_no_other_provider(raw, bad):
    """Rows that arrive typed: neither the charge nor the inputs of the means carry NaN to the peers."""
    good = [{"Rndrng_NPI": i, "Avg_Sbmtd_Chrg": c} for i, c in enumerate((100.0, 120.0, 90.0), 1)]
    spoilt = raw(*good, {"Rndrng_NPI": 4, "Avg_Sbmtd_Chrg": bad},
                 {"Rndrng_NPI": 5, "Avg_Sbmtd_Chrg": 95.0, "Avg_Mdcr_Pymt_Amt": bad, "Tot_Srvcs": bad})
    clean_rows = raw(*good, {"Rndrng_NPI": 5, "Avg_Sbmtd_Chrg": 95.0, "Avg_Mdcr_Pymt_Amt": None, "Tot_Srvcs": None})
    for plan in (gold.provider_risk_from_claims, lambda c: gold.provider_risk(silver.features(c))):
        found, expected = (plan(silver.clean(r)).drop("gold_processed_at").orderBy("provider_id").collect()
                           for r in (spoilt, clean_rows))
        assert found == expected and {r.risk_tier for r in found} <= {"Normal", "Elevated"}
    assert bronze.quality_report(spoilt).filter("check_name = 'charge_below_minimum'").first().rows == 1
