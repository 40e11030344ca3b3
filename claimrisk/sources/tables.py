"""Catalog tables, views, exports and read-back reports."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql("CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:name)", args={"name": name})


def list_schemas(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW SCHEMAS")


def list_tables(spark: SparkSession, schema: str) -> DataFrame:
    return spark.sql("SHOW TABLES IN IDENTIFIER(:name)", args={"name": schema})


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def write_table(df: DataFrame, name: str, mode="overwrite", fmt="parquet", sort_by=None, lookup_by=(),
                partition_by=()) -> DataFrame:
    """Replace a table including its schema, or append to it; returns the stored table.

    ``sort_by`` range partitions and sorts the files, so that lookups on these columns skip most of
    them by their statistics. ``lookup_by`` names columns that get Bloom filters (Parquet), so that values that a file
    doesn't hold are not looked for in it. ``partition_by`` names columns of few values that get folders.
    """
    if sort_by:
        df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    writer = df.write.format(fmt).mode(mode)
    for column in lookup_by:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if mode == "overwrite":
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def replace_view(spark: SparkSession, name: str, select_sql: str) -> DataFrame:
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {select_sql}")
    return spark.table(name)


def version_name(name: str, version: str) -> str:
    return f"{name}__{version}"


def write_version(df: DataFrame, name: str, version: str, **options) -> DataFrame:
    """Write ``df`` as a table of its own, which readers of ``name`` don't see before ``publish``; options as for ``write_table``."""
    return write_table(df, version_name(name, version), **options)


def published_version(spark: SparkSession, name: str) -> str | None:
    """The version that the view ``name`` shows; None if there is no such view."""
    if not spark.catalog.tableExists(name) or spark.catalog.getTable(name).tableType != "VIEW":
        return None
    found = spark.sql(f"SHOW TBLPROPERTIES {name}").filter("key = 'version'").first()
    return found.value if found else None


def publish(spark: SparkSession, name: str, version: str, select_sql: str | None = None) -> None:
    """Let the view ``name`` show a written version (or ``select_sql``), by one change of the catalog.

    A plain table of that name from earlier gives way to the view. Of other versions the one shown before stays, for queries
    that still read it; older ones, and those of runs that broke off, are dropped.
    """
    before = published_version(spark, name)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    select_sql = select_sql or f"SELECT * FROM {version_name(name, version)}"
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('version' = '{version}') AS {select_sql}")
    schema, _, table = name.rpartition(".")
    kept = {version_name(table, v) for v in (version, before) if v}
    for row in spark.sql(f"SHOW TABLES IN {schema} LIKE '{version_name(table, '*')}'").collect():
        if row.tableName not in kept:
            spark.sql(f"DROP TABLE IF EXISTS {schema}.{row.tableName}")


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header; one file per partition, written by the executors."""
    df.write.mode("overwrite").option("header", True).csv(path)


def table_report(df: DataFrame, name: str) -> DataFrame:
    """Rows and columns of a table as one row; one scan that reads no column."""
    return df.agg(F.count("*").alias("rows")).select(
        F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).alias("columns"))


def preview(df: DataFrame, rows=5, columns=None) -> DataFrame:
    return df.select(*(columns or df.columns)).limit(rows)
