"""Column names, types and other fixed values of the billing model."""

from pyspark.sql import types as T

# Raw billing column -> (clean column, clean type), in file order.
RAW_TO_CLEAN = {
    "Rndrng_NPI": ("provider_id", T.LongType()),
    "Rndrng_Prvdr_Last_Org_Name": ("provider_last_name", T.StringType()),
    "Rndrng_Prvdr_First_Name": ("provider_first_name", T.StringType()),
    "Rndrng_Prvdr_MI": ("provider_middle_initial", T.StringType()),
    "Rndrng_Prvdr_Crdntls": ("credentials", T.StringType()),
    "Rndrng_Prvdr_Ent_Cd": ("entity_code", T.StringType()),
    "Rndrng_Prvdr_St1": ("address_line1", T.StringType()),
    "Rndrng_Prvdr_St2": ("address_line2", T.StringType()),
    "Rndrng_Prvdr_City": ("city", T.StringType()),
    "Rndrng_Prvdr_State_Abrvtn": ("state", T.StringType()),
    "Rndrng_Prvdr_State_FIPS": ("state_fips", T.StringType()),
    "Rndrng_Prvdr_Zip5": ("zip_code", T.StringType()),
    "Rndrng_Prvdr_RUCA": ("ruca_code", T.StringType()),
    "Rndrng_Prvdr_RUCA_Desc": ("ruca_desc", T.StringType()),
    "Rndrng_Prvdr_Cntry": ("country", T.StringType()),
    "Rndrng_Prvdr_Type": ("specialty", T.StringType()),
    "Rndrng_Prvdr_Mdcr_Prtcptg_Ind": ("medicare_participation_ind", T.StringType()),
    "HCPCS_Cd": ("procedure_code", T.StringType()),
    "HCPCS_Desc": ("procedure_desc", T.StringType()),
    "HCPCS_Drug_Ind": ("drug_indicator", T.StringType()),
    "Place_Of_Srvc": ("place_of_service", T.StringType()),
    "Tot_Benes": ("total_beneficiaries", T.LongType()),
    "Tot_Srvcs": ("total_services", T.DoubleType()),
    "Tot_Bene_Day_Srvcs": ("total_beneficiary_days", T.LongType()),
    "Avg_Sbmtd_Chrg": ("avg_submitted_charge", T.DoubleType()),
    "Avg_Mdcr_Alowd_Amt": ("avg_medicare_allowed", T.DoubleType()),
    "Avg_Mdcr_Pymt_Amt": ("avg_medicare_paid", T.DoubleType()),
    "Avg_Mdcr_Stdzd_Amt": ("avg_medicare_standardized", T.DoubleType()),
}

# The clean columns stored in upper case.
UPPER_CASED = ("state", "place_of_service")

RAW_SCHEMA = T.StructType([T.StructField(raw, t) for raw, (_, t) in RAW_TO_CLEAN.items()])
RAW_TEXT_SCHEMA = T.StructType([T.StructField(raw, T.StringType()) for raw in RAW_TO_CLEAN])

CLAIM_COLUMNS = [clean for clean, _ in RAW_TO_CLEAN.values()]
CLEAN_COLUMNS = [*CLAIM_COLUMNS, "silver_processed_at", "source_file"]
# The columns that features add.
FEATURE_COLUMNS = [
    "charge_to_payment_ratio",
    "billing_intensity",
    "specialty_avg_charge",
    "specialty_stddev_charge",
    "provider_charge_zscore",
    "facility_flag",
    "features_created_at",
]

# Grain of one billing row, raw and clean.
RAW_GRAIN = ["Rndrng_NPI", "HCPCS_Cd", "Place_Of_Srvc"]
CLAIM_GRAIN = ["provider_id", "procedure_code", "place_of_service"]

# Key and measures of a provider row.
PROVIDER_KEYS = ["provider_id", "specialty", "state", "city", "zip_code", "entity_code"]
PROVIDER_MEASURES = [
    "total_procedures",
    "total_beneficiaries",
    "total_services",
    "total_billed",
    "total_paid",
    "avg_charge_ratio",
    "avg_billing_intensity",
    "max_zscore",
    "avg_zscore",
    "unique_procedures",
    "facility_rate",
]

# Smallest acceptable charge, tier thresholds on max z, tier below all of them.
MIN_CHARGE = 0.01
TIER_THRESHOLDS = [("Critical", 3.0), ("Elevated", 1.0)]
TIER_DEFAULT = "Normal"
TIERS = [name for name, _ in TIER_THRESHOLDS] + [TIER_DEFAULT]

# The model inputs, in vector order.
MODEL_FEATURES = [
    "avg_charge_ratio",
    "avg_billing_intensity",
    "max_zscore",
    "avg_zscore",
    "unique_procedures",
    "facility_rate",
    "total_procedures",
    "total_services",
    "total_beneficiaries",
]
FEATURE_SETS = {
    "reference": MODEL_FEATURES,
    # The label is a threshold on max_zscore, so a model that sees it only reads the label back.
    "no_leak": [c for c in MODEL_FEATURES if c != "max_zscore"],
}

# Raw columns whose NULLs are profiled, and the money columns.
CRITICAL_RAW_COLUMNS = [
    "Rndrng_NPI",
    "Rndrng_Prvdr_Last_Org_Name",
    "HCPCS_Cd",
    "Avg_Sbmtd_Chrg",
    "Avg_Mdcr_Alowd_Amt",
    "Avg_Mdcr_Pymt_Amt",
    "Tot_Benes",
    "Tot_Srvcs",
]
RAW_MONEY_COLUMNS = ["Avg_Sbmtd_Chrg", "Avg_Mdcr_Alowd_Amt", "Avg_Mdcr_Pymt_Amt"]
