"""Billing rows derived from the order tables: one row per order line."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimrisk.schemas import RAW_TO_CLEAN


# The columns used of each table; a given schema saves reading file footers to infer it.
TABLES = {
    "lineitem": "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string",
    "orders": "o_orderkey long, o_custkey long",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey long, p_name string, p_size int",
}


def raw_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 28 raw billing columns; Catalyst prunes the joins' inputs to the columns a query needs.

    The dimension joins come first and the two line-level joins last. Join sides are left to Catalyst,
    which broadcasts by measured file size and splits skewed partitions at run time.
    """
    def table(name):
        return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")

    providers = table("customer").join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    orders = table("orders").join(providers, F.col("o_custkey") == F.col("c_custkey"))
    lines = (
        table("lineitem")
        .join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey")))

    charge = F.col("l_extendedprice") / F.col("l_quantity")
    allowed = charge * (1 - F.col("l_discount"))
    unpaid = (F.col("l_returnflag") == "R") & (F.col("l_discount") == 0)
    patients = F.ceil(F.col("l_quantity") / F.col("l_linenumber"))
    place = F.col("l_linestatus")
    mapped = {
        "Rndrng_NPI": F.col("c_custkey"),
        "Rndrng_Prvdr_Last_Org_Name": F.col("c_name"),
        "Rndrng_Prvdr_Ent_Cd": F.when(F.col("c_custkey") % 2 == 0, "I").otherwise("O"),
        "Rndrng_Prvdr_City": F.col("n_name"),
        "Rndrng_Prvdr_State_Abrvtn": F.col("n_name"),
        "Rndrng_Prvdr_State_FIPS": F.lpad(F.col("c_nationkey").cast("string"), 2, "0"),
        "Rndrng_Prvdr_Zip5": F.lpad(F.col("c_nationkey").cast("string"), 5, "0"),
        "Rndrng_Prvdr_Type": F.col("c_mktsegment"),
        "HCPCS_Cd": F.col("l_partkey").cast("string"),
        "HCPCS_Desc": F.col("p_name"),
        "HCPCS_Drug_Ind": F.when(F.col("p_size") <= 10, "Y").otherwise("N"),
        "Place_Of_Srvc": F.when(F.col("l_linenumber") == 7, F.lower(place)).otherwise(place),
        "Tot_Benes": patients,
        "Tot_Srvcs": F.col("l_quantity"),
        "Tot_Bene_Day_Srvcs": patients,
        "Avg_Sbmtd_Chrg": charge,
        "Avg_Mdcr_Alowd_Amt": allowed,
        "Avg_Mdcr_Pymt_Amt": F.when(unpaid, 0.0).otherwise(allowed * (1 - F.col("l_tax"))),
        "Avg_Mdcr_Stdzd_Amt": allowed,
    }
    return lines.select(*[
        mapped.get(raw, F.lit(None)).cast(kind).alias(raw)
        for raw, (_, kind) in RAW_TO_CLEAN.items()])
