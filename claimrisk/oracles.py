"""The same queries as plain SQL on the order tables, for an independent engine."""

from claimrisk.schemas import (
    CLAIM_COLUMNS, CLAIM_GRAIN, CRITICAL_RAW_COLUMNS, MODEL_FEATURES, PROVIDER_KEYS,
    PROVIDER_MEASURES, RAW_MONEY_COLUMNS, RAW_TO_CLEAN, UPPER_CASED)

KEYS = ", ".join(PROVIDER_KEYS)
MEASURES = ", ".join(PROVIDER_MEASURES)

_MAPPED = {
    "Rndrng_NPI": "c_custkey",
    "Rndrng_Prvdr_Last_Org_Name": "c_name",
    "Rndrng_Prvdr_Ent_Cd": "CASE WHEN c_custkey % 2 = 0 THEN 'I' ELSE 'O' END",
    "Rndrng_Prvdr_City": "n_name",
    "Rndrng_Prvdr_State_Abrvtn": "n_name",
    "Rndrng_Prvdr_State_FIPS": "lpad(CAST(c_nationkey AS VARCHAR), 2, '0')",
    "Rndrng_Prvdr_Zip5": "lpad(CAST(c_nationkey AS VARCHAR), 5, '0')",
    "Rndrng_Prvdr_Type": "c_mktsegment",
    "HCPCS_Cd": "CAST(l_partkey AS VARCHAR)",
    "HCPCS_Desc": "p_name",
    "HCPCS_Drug_Ind": "CASE WHEN p_size <= 10 THEN 'Y' ELSE 'N' END",
    "Place_Of_Srvc": "CASE WHEN l_linenumber = 7 THEN lower(l_linestatus) ELSE l_linestatus END",
    "Tot_Benes": "CAST(ceil(l_quantity / l_linenumber) AS BIGINT)",
    "Tot_Srvcs": "l_quantity",
    "Tot_Bene_Day_Srvcs": "CAST(ceil(l_quantity / l_linenumber) AS BIGINT)",
    "Avg_Sbmtd_Chrg": "l_extendedprice / l_quantity",
    "Avg_Mdcr_Alowd_Amt": "l_extendedprice / l_quantity * (1 - l_discount)",
    "Avg_Mdcr_Pymt_Amt": """CASE WHEN l_returnflag = 'R' AND l_discount = 0 THEN CAST(0 AS DOUBLE)
        ELSE l_extendedprice / l_quantity * (1 - l_discount) * (1 - l_tax) END""",
    "Avg_Mdcr_Stdzd_Amt": "l_extendedprice / l_quantity * (1 - l_discount)",
}

_CLEAN = ", ".join(
    f'{f"upper({raw})" if name in UPPER_CASED else raw} AS {name}'
    for raw, (name, _) in RAW_TO_CLEAN.items())


def _money(amount):
    return f"CAST(round(sum(CAST({amount} AS DECIMAL(28, 6))), 2) AS DOUBLE)"


_CTES = f"""
WITH raw AS (
    SELECT {', '.join(f"{_MAPPED.get(c, 'CAST(NULL AS VARCHAR)')} AS {c}" for c in RAW_TO_CLEAN)}
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN part ON l_partkey = p_partkey
), clean AS (
    SELECT {_CLEAN}, 'order_lines' AS source_file
    FROM raw WHERE Avg_Sbmtd_Chrg >= 0.01 AND Rndrng_NPI IS NOT NULL
), peers AS (
    SELECT *,
        CASE WHEN avg_medicare_paid = 0 THEN NULL
             ELSE avg_submitted_charge / avg_medicare_paid END AS charge_to_payment_ratio,
        CASE WHEN total_beneficiaries = 0 THEN NULL
             ELSE total_services / total_beneficiaries END AS billing_intensity,
        avg(avg_submitted_charge) OVER (PARTITION BY specialty) AS specialty_avg_charge,
        stddev_samp(avg_submitted_charge) OVER (PARTITION BY specialty) AS specialty_stddev_charge
    FROM clean
), features AS (
    SELECT *,
        CASE WHEN specialty_stddev_charge = 0 THEN 0
             ELSE (avg_submitted_charge - specialty_avg_charge) / specialty_stddev_charge
        END AS provider_charge_zscore,
        CASE WHEN place_of_service = 'F' THEN 1 ELSE 0 END AS facility_flag
    FROM peers
), stats AS (
    SELECT {KEYS},
        count(*) AS total_procedures,
        CAST(sum(total_beneficiaries) AS BIGINT) AS total_beneficiaries,
        sum(total_services) AS total_services,
        {_money("avg_submitted_charge * total_services")} AS total_billed,
        {_money("avg_medicare_paid * total_services")} AS total_paid,
        round(avg(charge_to_payment_ratio), 4) AS avg_charge_ratio,
        round(avg(billing_intensity), 4) AS avg_billing_intensity,
        max(provider_charge_zscore) AS peak,
        round(max(provider_charge_zscore), 4) AS max_zscore,
        round(avg(provider_charge_zscore), 4) AS avg_zscore,
        count(DISTINCT procedure_code) AS unique_procedures,
        round(avg(facility_flag), 4) AS facility_rate
    FROM features GROUP BY {KEYS}
), risk AS (
    SELECT {KEYS}, {MEASURES},
        CAST(rank() OVER (PARTITION BY specialty ORDER BY max_zscore DESC NULLS LAST) AS INTEGER)
            AS specialty_rank,
        CASE WHEN max_zscore >= 3 THEN 'Critical' WHEN max_zscore >= 1 THEN 'Elevated'
             ELSE 'Normal' END AS risk_tier
    FROM stats
), mart AS (
    SELECT {KEYS}, {MEASURES},
        CAST(rank() OVER (PARTITION BY specialty ORDER BY peak DESC NULLS LAST) AS INTEGER)
            AS specialty_rank,
        CASE WHEN peak >= 3 THEN 'Critical' WHEN peak >= 1 THEN 'Elevated'
             ELSE 'Normal' END AS risk_tier
    FROM stats
), limits AS (
    SELECT specialty,
        quantile_cont(charge_to_payment_ratio, 0.5) AS ratio_median,
        quantile_cont(billing_intensity, 0.95) AS intensity_high
    FROM features GROUP BY specialty
), labelled AS (
    SELECT f.*, CASE WHEN provider_charge_zscore > 3
                       OR charge_to_payment_ratio > 10 * ratio_median
                       OR billing_intensity > intensity_high THEN 1 ELSE 0 END AS fraud_flag
    FROM features f JOIN limits l ON f.specialty IS NOT DISTINCT FROM l.specialty
), inputs AS (
    SELECT {KEYS},
        {', '.join(f'coalesce({c}, 0) AS {c}' for c in MODEL_FEATURES)},
        CAST(CASE WHEN max_zscore >= 3 THEN 1 ELSE 0 END AS INTEGER) AS fraud_flag
    FROM mart
), scores AS (
    SELECT *,
        CASE WHEN CAST('0x' || substr(md5(CAST(provider_id AS VARCHAR) || '|42'), 1, 8) AS BIGINT) % 10
                  < 2 THEN 'test' ELSE 'train' END AS split,
        round(least(greatest(max_zscore, 0) / 7, 1), 6) AS risk_score
    FROM inputs
), serving AS (
    SELECT s.*, CAST(CASE WHEN risk_score >= 0.3 THEN 1 ELSE 0 END AS INTEGER) AS predicted_fraud,
        m.risk_tier, m.total_billed
    FROM scores s JOIN mart m ON {' AND '.join(
        f's.{k} IS NOT DISTINCT FROM m.{k}' for k in PROVIDER_KEYS)}
), guesses AS (
    SELECT *, CASE WHEN avg_zscore >= 0.5 THEN 1 ELSE 0 END AS predicted FROM inputs
)"""


def _union(selects):
    return " UNION ALL ".join(selects)


def _cast_features(columns):
    """Feature columns as published: peer statistics rounded, flag as a 32-bit integer."""
    shown = {
        "facility_flag": "CAST(facility_flag AS INTEGER)",
        **{c: f"round({c}, 6) + 0" for c in (
            "specialty_avg_charge", "specialty_stddev_charge", "provider_charge_zscore")},
    }
    return ", ".join(f"{shown.get(c, c)} AS {c}" for c in columns)


_FEATURE_COLUMNS = [
    *CLAIM_COLUMNS, "source_file", "charge_to_payment_ratio", "billing_intensity",
    "specialty_avg_charge", "specialty_stddev_charge", "provider_charge_zscore", "facility_flag"]
_STAGING_COLUMNS = [c for c in _FEATURE_COLUMNS if c not in (
    "provider_middle_initial", "credentials", "address_line1", "address_line2", "state_fips",
    "ruca_code", "ruca_desc", "country", "medicare_participation_ind")]
_DEDUP_ORDER = ", ".join(f"{c} NULLS FIRST" for c in CLAIM_COLUMNS if c not in CLAIM_GRAIN)

_SPECIALTY_BENCHMARK = f"""
    SELECT specialty, count(*) AS total_claims, count(DISTINCT provider_id) AS unique_providers,
        round(avg(avg_submitted_charge), 2) AS median_submitted_charge,
        round(avg(charge_to_payment_ratio), 4) AS avg_charge_ratio,
        round(avg(billing_intensity), 4) AS avg_billing_intensity,
        {_money("avg_submitted_charge * total_services")} AS total_billed
    FROM features GROUP BY specialty"""

_REPORT = """
    , cells AS (
        SELECT count(*) FILTER (fraud_flag = 1 AND predicted = 1) AS tp,
               count(*) FILTER (fraud_flag = 0 AND predicted = 1) AS fp,
               count(*) FILTER (fraud_flag = 1 AND predicted = 0) AS fn,
               count(*) FILTER (fraud_flag = 0 AND predicted = 0) AS tn FROM guesses
    ), parts AS (
        SELECT 'Normal' AS class, tn / (tn + fn) AS p, tn / (tn + fp) AS r, tn + fp AS n FROM cells
        UNION ALL SELECT 'Fraud', tp / (tp + fp), tp / (tp + fn), tp + fn FROM cells
    ), both_classes AS (SELECT *, 2 * p * r / (p + r) AS f FROM parts)
    SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1_score,
           CAST(n AS BIGINT) AS support FROM both_classes
    UNION ALL SELECT 'accuracy', NULL, NULL, round((tp + tn) / (tp + fp + fn + tn), 6),
           CAST(tp + fp + fn + tn AS BIGINT) FROM cells
    UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6),
           CAST(sum(n) AS BIGINT) FROM both_classes
    UNION ALL SELECT 'weighted avg', round(sum(p * n) / sum(n), 6), round(sum(r * n) / sum(n), 6),
           round(sum(f * n) / sum(n), 6), CAST(sum(n) AS BIGINT) FROM both_classes"""

_NARRATIVE = f"""
    , medians AS (
        SELECT specialty, median(avg_submitted_charge) AS middle FROM features GROUP BY specialty
    ), around AS (
        SELECT f.*, CASE WHEN specialty_stddev_charge = 0 THEN 0
                         ELSE (avg_submitted_charge - middle) / specialty_stddev_charge END AS mz
        FROM features f JOIN medians m ON f.specialty IS NOT DISTINCT FROM m.specialty
    ), providers AS (
        SELECT {KEYS}, round(avg(charge_to_payment_ratio), 4) AS ratio,
            round(avg(billing_intensity), 4) AS intensity, round(max(mz), 4) AS peak
        FROM around GROUP BY {KEYS}
    ), compared AS (
        SELECT *, round(ratio / avg(ratio) OVER (PARTITION BY specialty), 1) AS times,
            CAST(floor(percent_rank() OVER (PARTITION BY specialty
                 ORDER BY intensity NULLS FIRST) * 100) AS INTEGER) AS pct
        FROM providers
    )
    SELECT {KEYS}, 'Risk driven by: ' || concat_ws(', ',
        CASE WHEN times IS NOT NULL THEN printf('charge ratio %.1fx specialty average', times) END,
        CASE WHEN intensity IS NOT NULL THEN 'billing intensity at ' || pct ||
            CASE WHEN pct % 100 BETWEEN 11 AND 13 THEN 'th' WHEN pct % 10 = 1 THEN 'st'
                 WHEN pct % 10 = 2 THEN 'nd' WHEN pct % 10 = 3 THEN 'rd' ELSE 'th' END
            || ' percentile' END,
        CASE WHEN peak IS NOT NULL THEN
            printf('%.1f std deviations above specialty median charge', round(peak, 1) + 0) END)
        AS rationale
    FROM compared"""


def _test(table, test, column, source, failures):
    return (f"SELECT '{table}' AS table_name, '{test}' AS test, '{column}' AS column_name, "
            f"CAST({failures} AS BIGINT) AS failures FROM {source}")


def _null(table, column, source):
    return _test(table, "not_null", column, source, f"count(*) FILTER ({column} IS NULL)")


_QUERIES = {
    "bronze_null_counts": _union(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count FROM raw"
        for c in CRITICAL_RAW_COLUMNS),
    "bronze_money_summary": _union(
        f"""SELECT '{c}' AS column_name, count({c}) AS value_count, round(avg({c}), 4) AS mean,
            round(stddev_samp({c}), 4) AS stddev, min({c}) AS min, max({c}) AS max,
            round(quantile_cont({c}, 0.25), 4) AS q25, round(median({c}), 4) AS median,
            round(quantile_cont({c}, 0.75), 4) AS q75 FROM raw""" for c in RAW_MONEY_COLUMNS),
    "bronze_price_gap": """
        SELECT round(avg(Avg_Sbmtd_Chrg), 4) AS avg_charge, round(avg(Avg_Mdcr_Alowd_Amt), 4) AS avg_allowed,
            round(avg(Avg_Mdcr_Pymt_Amt), 4) AS avg_paid,
            round(avg(Avg_Sbmtd_Chrg) / avg(Avg_Mdcr_Pymt_Amt), 4) AS charge_to_payment,
            round(stddev_samp(Avg_Sbmtd_Chrg), 4) AS stddev_charge,
            min(Avg_Sbmtd_Chrg) AS min_charge, max(Avg_Sbmtd_Chrg) AS max_charge FROM raw""",
    "bronze_distinct_counts": """
        SELECT count(DISTINCT Rndrng_NPI) AS providers, count(DISTINCT Rndrng_Prvdr_Type) AS specialties,
            count(DISTINCT HCPCS_Cd) AS procedures,
            count(DISTINCT Rndrng_Prvdr_State_Abrvtn) AS states FROM raw""",
    "bronze_top_specialties": """
        SELECT Rndrng_Prvdr_Type AS specialty, count(*) AS claims FROM raw
        GROUP BY 1 ORDER BY claims DESC, specialty LIMIT 10""",
    "bronze_payment_ratio": """
        SELECT Rndrng_Prvdr_Type AS specialty, count(*) AS claims,
            round(avg(Avg_Sbmtd_Chrg), 4) AS avg_charge, round(avg(Avg_Mdcr_Pymt_Amt), 4) AS avg_paid,
            round(avg(Avg_Mdcr_Pymt_Amt) / avg(Avg_Sbmtd_Chrg), 4) AS payment_ratio
        FROM raw GROUP BY 1""",
    "bronze_anomaly_flags": """
        SELECT 'negative_charge_rows' AS flag, count(*) FILTER (Avg_Sbmtd_Chrg < 0) AS hits FROM raw
        UNION ALL SELECT 'zero_paid_rows', count(*) FILTER (Avg_Mdcr_Pymt_Amt = 0) FROM raw
        UNION ALL SELECT 'overserved_providers', count(*) FROM (
            SELECT Rndrng_NPI FROM raw GROUP BY 1 HAVING sum(Tot_Srvcs) > 10 * sum(Tot_Benes))""",
    "dq_report": """
        SELECT 'null_provider' AS check_name, count(*) FILTER (Rndrng_NPI IS NULL) AS rows FROM raw
        UNION ALL SELECT 'null_procedure', count(*) FILTER (HCPCS_Cd IS NULL) FROM raw
        UNION ALL SELECT 'charge_below_minimum', count(*) FILTER (Avg_Sbmtd_Chrg < 0.01) FROM raw
        UNION ALL SELECT 'zero_paid', count(*) FILTER (Avg_Mdcr_Pymt_Amt = 0) FROM raw
        UNION ALL SELECT 'duplicate_grain', (SELECT count(*) FROM raw) - count(*) FROM (
            SELECT DISTINCT Rndrng_NPI, HCPCS_Cd, Place_Of_Srvc FROM raw)""",
    "silver_row_audit": """
        SELECT (SELECT count(*) FROM raw) AS bronze_rows, count(*) AS silver_rows,
            (SELECT count(*) FROM raw) - count(*) AS rows_dropped,
            CAST(30 AS INTEGER) AS silver_columns FROM clean""",
    "silver_clean": "SELECT * FROM clean",
    "silver_dedup": f"""
        SELECT * FROM clean QUALIFY row_number() OVER (
            PARTITION BY {', '.join(CLAIM_GRAIN)} ORDER BY {_DEDUP_ORDER}) = 1""",
    "silver_features": f"SELECT {_cast_features(_FEATURE_COLUMNS)} FROM features",
    "features_median": """
        , medians AS (SELECT specialty, median(avg_submitted_charge) AS mc,
            median(charge_to_payment_ratio) AS mr FROM features GROUP BY specialty)
        SELECT provider_id, f.specialty, procedure_code, place_of_service, avg_submitted_charge,
            charge_to_payment_ratio, round(mc, 6) AS specialty_median_charge,
            round(mr, 6) AS specialty_median_ratio,
            round(CASE WHEN specialty_stddev_charge = 0 THEN 0
                  ELSE (avg_submitted_charge - mc) / specialty_stddev_charge END, 6) + 0
                AS median_charge_zscore
        FROM features f JOIN medians m ON f.specialty IS NOT DISTINCT FROM m.specialty""",
    "feature_describe": _union(
        f"""SELECT '{c}' AS feature, count({c}) AS value_count, round(avg({c}), 4) + 0 AS mean,
            round(stddev_samp({c}), 4) AS stddev, round(CAST(min({c}) AS DOUBLE), 4) AS min,
            round(CAST(max({c}) AS DOUBLE), 4) AS max FROM features"""
        for c in ("charge_to_payment_ratio", "billing_intensity", "provider_charge_zscore",
                  "facility_flag")),
    "claims_unique_procedures": """
        , counts AS (SELECT provider_id, count(DISTINCT procedure_code) AS n FROM clean GROUP BY 1)
        SELECT c.provider_id, specialty, procedure_code, place_of_service, total_services,
            avg_submitted_charge, n AS unique_hcpcs_per_npi
        FROM clean c JOIN counts p ON c.provider_id = p.provider_id""",
    "provider_risk": "SELECT * FROM risk",
    "provider_risk_from_features": "SELECT * FROM risk",
    "risk_from_parts": "SELECT * FROM risk",
    "mart_from_parts": "SELECT * FROM mart",
    "tier_distribution": "SELECT risk_tier, count(*) AS providers FROM risk GROUP BY 1",
    "tier_billed": f"""
        SELECT risk_tier, count(*) AS providers, {_money("total_billed")} AS total_billed_usd
        FROM risk GROUP BY 1""",
    "critical_top5": f"""
        SELECT provider_id, specialty, state, max_zscore, avg_charge_ratio, total_billed
        FROM risk WHERE risk_tier = 'Critical' ORDER BY max_zscore DESC, {KEYS} LIMIT 5""",
    "kpi_high_cost_claims": """
        SELECT provider_id, specialty, state, procedure_code, procedure_desc, avg_submitted_charge,
            avg_medicare_paid, total_services, total_beneficiaries,
            avg_submitted_charge * total_services AS total_claim_value
        FROM features QUALIFY percent_rank() OVER (
            ORDER BY avg_submitted_charge * total_services NULLS FIRST) >= 0.99""",
    "kpi_specialty_benchmarks": _SPECIALTY_BENCHMARK,
    "kpi_state_exposure": """
        SELECT state, count(*) AS total_providers,
            CAST(sum(CAST(total_billed AS DECIMAL(28, 6))) AS DOUBLE) AS total_billed,
            CAST(sum(CAST(total_paid AS DECIMAL(28, 6))) AS DOUBLE) AS total_paid,
            round(avg(avg_charge_ratio), 4) AS avg_charge_ratio,
            count(*) FILTER (risk_tier = 'Critical') AS critical_providers
        FROM risk GROUP BY state""",
    "kpi_procedure_analysis": """
        SELECT procedure_code, procedure_desc, count(*) AS claim_count,
            count(DISTINCT provider_id) AS unique_providers,
            round(avg(avg_submitted_charge), 2) AS avg_charge,
            round(avg(avg_medicare_paid), 2) AS avg_paid,
            round(avg(charge_to_payment_ratio), 4) AS avg_charge_ratio
        FROM features GROUP BY 1, 2""",
    "kpi_critical_providers": """
        SELECT provider_id, specialty, state, risk_tier, specialty_rank, total_billed, max_zscore,
            avg_charge_ratio FROM risk WHERE risk_tier = 'Critical'""",
    "kpi_patient_concentration": """
        SELECT provider_id, specialty, state, risk_tier, total_beneficiaries, total_services,
            round(total_services / total_beneficiaries, 2) AS services_per_patient, total_billed
        FROM risk WHERE total_beneficiaries > 0""",
    "kpi_patient_outliers": f"""
        , bounds AS (SELECT specialty, quantile_cont(CAST(total_beneficiaries AS DOUBLE), 0.95) AS top
            FROM risk GROUP BY specialty)
        SELECT {KEYS.replace('specialty', 'r.specialty')}, risk_tier, total_beneficiaries,
            round(top, 4) AS patient_limit
        FROM risk r JOIN bounds b ON r.specialty IS NOT DISTINCT FROM b.specialty
        WHERE total_beneficiaries > top""",
    "specialty_percentiles": """
        SELECT specialty, round(median(avg_submitted_charge), 4) AS charge_median,
            round(quantile_cont(avg_submitted_charge, 0.95), 4) AS charge_p95,
            round(median(charge_to_payment_ratio), 4) AS ratio_median,
            round(quantile_cont(charge_to_payment_ratio, 0.95), 4) AS ratio_p95
        FROM features GROUP BY specialty""",
    "label_any3": """
        SELECT provider_id, specialty, procedure_code, place_of_service, avg_submitted_charge,
            charge_to_payment_ratio, billing_intensity,
            round(provider_charge_zscore, 6) AS provider_charge_zscore,
            CAST(fraud_flag AS INTEGER) AS fraud_flag FROM labelled""",
    "procedure_fraud_rate": """
        SELECT procedure_code, procedure_desc, count(*) AS claim_count,
            CAST(sum(fraud_flag) AS BIGINT) AS flagged_claims, round(avg(fraud_flag), 4) AS fraud_rate
        FROM labelled GROUP BY 1, 2""",
    "specialty_rank_percentile": f"""
        SELECT {KEYS}, max_zscore, round(percent_rank() OVER (
            PARTITION BY specialty ORDER BY max_zscore NULLS FIRST), 6) AS specialty_rank_percentile
        FROM risk""",
    "stg_claims": f"SELECT {_cast_features(_STAGING_COLUMNS)} FROM features",
    "provider_stats": f"SELECT {KEYS}, {MEASURES} FROM stats",
    "fct_provider_risk": "SELECT * FROM mart",
    "tier_pivot": f"""
        SELECT count(*) AS provider_count, count(CASE WHEN risk_tier = 'Critical' THEN 1 END) AS critical,
            count(CASE WHEN risk_tier = 'Elevated' THEN 1 END) AS elevated,
            count(CASE WHEN risk_tier = 'Normal' THEN 1 END) AS normal,
            {_money("total_billed")} AS total_billed FROM mart""",
    "dq_not_null": _union([
        _null("stg_cms_claims", "provider_id", "features"),
        _null("stg_cms_claims", "procedure_code", "features"),
        _null("fct_provider_risk", "provider_id", "mart"),
        _null("ml_provider_scores", "risk_score", "scores")]),
    "dq_accepted_values": _union([
        _test("stg_cms_claims", "accepted_values", "place_of_service", "features",
              "count(*) FILTER (place_of_service NOT IN ('F', 'O'))"),
        _test("fct_provider_risk", "accepted_values", "risk_tier", "mart",
              "count(*) FILTER (risk_tier NOT IN ('Critical', 'Elevated', 'Normal'))")]),
    "dq_unique": _test(
        "fct_provider_risk", "unique", "provider_id",
        "(SELECT provider_id FROM mart WHERE provider_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)",
        "count(*)"),
    "dq_unique_grain": _test(
        "stg_cms_claims", "unique", "provider_id+procedure_code+place_of_service",
        """(SELECT 1 FROM features WHERE provider_id IS NOT NULL AND procedure_code IS NOT NULL
            AND place_of_service IS NOT NULL
            GROUP BY provider_id, procedure_code, place_of_service HAVING count(*) > 1)""", "count(*)"),
    "dq_relationships": _test(
        "stg_cms_claims", "relationships", "provider_id",
        "features WHERE provider_id IS NOT NULL AND provider_id NOT IN "
        "(SELECT provider_id FROM mart WHERE provider_id IS NOT NULL)", "count(*)"),
    "ml_features": "SELECT * FROM inputs",
    "ml_features_wide": f"""
        , counts AS (SELECT provider_id, count(DISTINCT procedure_code) AS n FROM clean GROUP BY 1)
        SELECT {', '.join('m.' + k for k in PROVIDER_KEYS)},
            {', '.join(f'coalesce(m.{c}, 0) AS {c}' for c in MODEL_FEATURES)},
            round(percent_rank() OVER (PARTITION BY m.specialty ORDER BY m.max_zscore NULLS FIRST), 6)
                AS specialty_rank_percentile,
            CAST(CASE WHEN facility_rate >= 0.5 THEN 1 ELSE 0 END AS INTEGER) AS facility_flag,
            n AS unique_hcpcs_per_npi,
            CAST(CASE WHEN max_zscore >= 3 THEN 1 ELSE 0 END AS INTEGER) AS fraud_flag
        FROM mart m JOIN counts c ON m.provider_id = c.provider_id""",
    "ml_label_any3": f"""
        SELECT {KEYS}, CAST(max(fraud_flag) AS INTEGER) AS fraud_flag FROM labelled GROUP BY {KEYS}""",
    "ml_class_balance": """
        SELECT count(*) AS providers, count(*) FILTER (fraud_flag = 1) AS positives,
            count(*) FILTER (fraud_flag = 0) AS negatives,
            round(count(*) FILTER (fraud_flag = 0) / count(*) FILTER (fraud_flag = 1), 4)
                AS positive_weight FROM inputs""",
    "ml_split": f"SELECT {KEYS}, split FROM scores",
    "ml_report": _REPORT,
    "ml_auc_roc": """
        , ranked AS (SELECT fraud_flag, rank() OVER (ORDER BY avg_zscore)
            + (count(*) OVER (PARTITION BY avg_zscore) - 1) / 2 AS mid_rank FROM inputs)
        SELECT round((sum(mid_rank) FILTER (fraud_flag = 1) - p * (p + 1) / 2) / (p * n), 6) AS auc_roc
        FROM ranked, (SELECT count(*) FILTER (fraud_flag = 1) AS p,
            count(*) FILTER (fraud_flag = 0) AS n FROM inputs) GROUP BY p, n""",
    "ml_avg_precision": """
        , steps AS (SELECT DISTINCT avg_zscore,
            sum(fraud_flag) OVER (PARTITION BY avg_zscore) AS gained,
            sum(fraud_flag) OVER (ORDER BY avg_zscore DESC) AS hits,
            count(*) OVER (ORDER BY avg_zscore DESC) AS found FROM inputs)
        SELECT round(sum(gained / (SELECT sum(fraud_flag) FROM inputs) * hits / found), 6)
            AS average_precision FROM steps""",
    "rationale_top3": f"""
        , long AS ({_union(
            f"SELECT {KEYS}, '{c}' AS feature, "
            f"round({c} - avg({c}) OVER (PARTITION BY specialty), 3) AS impact FROM inputs"
            for c in MODEL_FEATURES)}
        ), ranked AS (SELECT *, row_number() OVER (
            PARTITION BY {KEYS} ORDER BY abs(impact) DESC, feature) AS place FROM long)
        SELECT {KEYS}, string_agg(printf('%s (impact: %.3f)', feature, impact), ', ' ORDER BY place)
            AS rationale FROM ranked WHERE place <= 3 GROUP BY {KEYS}""",
    "rationale_narrative": _NARRATIVE,
    "serving_provider_risk": "SELECT * FROM serving",
    "serve_provider": f"""
        SELECT provider_id, specialty, state, risk_score, predicted_fraud, risk_tier, avg_charge_ratio,
            max_zscore, total_billed FROM serving WHERE provider_id = 42
        ORDER BY total_billed DESC, {KEYS} LIMIT 1""",
    "serve_cohort": f"""
        SELECT provider_id, specialty, state, risk_score, risk_tier, avg_charge_ratio, max_zscore,
            total_billed FROM serving WHERE risk_tier = 'Critical' AND specialty = 'BUILDING'
        ORDER BY risk_score DESC, {KEYS} LIMIT 100""",
    "serve_summary": f"""
        SELECT risk_tier, count(*) AS provider_count, round(avg(risk_score), 4) AS avg_risk_score,
            {_money("total_billed")} AS total_billed FROM serving GROUP BY 1""",
    "state_risk": """
        SELECT state, count(*) AS providers, round(avg(risk_score), 4) AS avg_risk_score,
            round(count(*) FILTER (risk_tier = 'Critical') * 100 / count(*), 2) AS critical_percent
        FROM serving GROUP BY state""",
    "ml_scores_check": f"""
        SELECT count(*) AS score_rows,
            (SELECT count(*) FROM (SELECT DISTINCT {KEYS} FROM inputs)) AS provider_keys,
            count(*) FILTER (split = 'train') AS train_rows, count(*) FILTER (split = 'test') AS test_rows,
            count(*) FILTER (split = 'train' AND fraud_flag = 1) AS train_positives,
            count(*) FILTER (split = 'test' AND fraud_flag = 1) AS test_positives,
            CAST(0 AS BIGINT) AS null_scores, CAST(0 AS BIGINT) AS scores_out_of_range,
            CAST(0 AS BIGINT) AS predictions_off
        FROM scores""",
    "ml_shap_check": """
        SELECT count(*) AS explained_rows, CAST(0 AS BIGINT) AS sums_off, CAST(0 AS BIGINT) AS inputs_missing
        FROM inputs""",
    "ml_rationale_check": """
        SELECT count(*) AS rationale_rows, CAST(0 AS BIGINT) AS terms_off, CAST(0 AS BIGINT) AS order_off
        FROM inputs""",
    "model_serving_check": f"""
        SELECT risk_tier, count(*) AS provider_count, {_money("total_billed")} AS total_billed,
            count(*) AS scored
        FROM mart GROUP BY risk_tier""",
}

_QUERIES["ml_importance_check"] = f"""
    SELECT CAST({len(MODEL_FEATURES)} AS BIGINT) AS inputs, CAST(0 AS BIGINT) AS negative,
        CAST(1 AS DOUBLE) AS total"""
for _check in ("scores", "shap", "rationale", "importance"):
    _QUERIES[f"newton_{_check}_check"] = _QUERIES[f"ml_{_check}_check"]
_QUERIES["ml_evaluate_check"] = """
    SELECT learner, feature_set, class, support, CAST(0 AS BIGINT) AS figures_off
    FROM (SELECT count(*) FILTER (fraud_flag = 0) AS n, count(*) FILTER (fraud_flag = 1) AS p
        FROM scores WHERE split = 'test'),
        (VALUES ('first_order'), ('second_order')) l(learner), (VALUES ('reference'), ('no_leak')) f(feature_set),
        LATERAL (VALUES ('Normal', n), ('Fraud', p), ('accuracy', n + p)) c(class, support)"""
_QUERIES["dedup_from_parts"] = _QUERIES["silver_dedup"]
_QUERIES["serve_cohort_indexed"] = _QUERIES["serve_cohort"]
_QUERIES["ml_features_wide_new"] = f"""
    , counts AS (SELECT provider_id, count(DISTINCT procedure_code) AS n FROM clean GROUP BY 1)
    , ranked AS (SELECT m.*,
        (SELECT count(*) FROM mart o WHERE o.provider_id % 7 <> 0 AND o.specialty IS NOT DISTINCT FROM m.specialty
            AND (o.max_zscore < m.max_zscore OR o.max_zscore IS NULL)) AS below,
        (SELECT count(*) FROM mart o WHERE o.provider_id % 7 <> 0
            AND o.specialty IS NOT DISTINCT FROM m.specialty) AS others
        FROM mart m WHERE m.provider_id % 7 = 0)
    SELECT {', '.join('m.' + k for k in PROVIDER_KEYS)},
        {', '.join(f'coalesce(m.{c}, 0) AS {c}' for c in MODEL_FEATURES)},
        round(CASE WHEN m.max_zscore IS NULL OR others = 0 THEN 0 ELSE below / others END, 6) AS specialty_rank_percentile,
        CAST(CASE WHEN facility_rate >= 0.5 THEN 1 ELSE 0 END AS INTEGER) AS facility_flag,
        n AS unique_hcpcs_per_npi,
        CAST(CASE WHEN max_zscore >= 3 THEN 1 ELSE 0 END AS INTEGER) AS fraud_flag
    FROM ranked m JOIN counts c ON m.provider_id = c.provider_id"""
_QUERIES["percentiles_from_sketches"] = _QUERIES["specialty_percentiles"]
_QUERIES["fct_provider_risk_from_features"] = _QUERIES["fct_provider_risk"]

ORACLES = {name: f"{_CTES}\n{sql}" for name, sql in _QUERIES.items()}
