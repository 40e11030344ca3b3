"""Raw billing files: one CSV split into parts, of which only some start with a header line."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from claimrisk.functions.columns import finite
from claimrisk.schemas import RAW_SCHEMA, RAW_TEXT_SCHEMA

# Accounts of what could not be read: the line, if it has too few or too many cells, and the names of
# columns whose text is no number.
CORRUPT_LINE = "corrupt_line"
UNREADABLE = "unreadable_columns"


def text_schema(with_rejects=False) -> T.StructType:
    return (T.StructType(list(RAW_TEXT_SCHEMA.fields)).add(CORRUPT_LINE, T.StringType()) if with_rejects
            else RAW_TEXT_SCHEMA)


def typed(text: DataFrame, with_rejects=False) -> DataFrame:
    """Drop repeated header lines and cast the text columns; unreadable numbers become NULL.

    NaN and infinity are no amounts and count as unreadable. ``with_rejects`` adds the names of such
    columns as ``unreadable_columns``.
    """
    first = RAW_TEXT_SCHEMA.fieldNames()[0]
    rows = text.filter(F.coalesce(F.col(first) != first, F.lit(True)))
    extra = [c for c in text.columns if c not in RAW_SCHEMA.fieldNames()]

    def cast(field):
        value = F.col(field.name).try_cast(field.dataType)
        return finite(value) if isinstance(field.dataType, T.DoubleType) else value

    if with_rejects:
        lost = [F.when(cast(f).isNull() & (F.trim(f.name) != ""), F.lit(f.name)) for f in RAW_SCHEMA
                if not isinstance(f.dataType, T.StringType)]
        rows = rows.withColumn(UNREADABLE, F.array_compact(F.array(*lost)))
        extra.append(UNREADABLE)
    return rows.select(*[cast(f).alias(f.name) for f in RAW_SCHEMA], *extra)


def read_parts(spark: SparkSession, paths, with_source=False, with_rejects=False) -> DataFrame:
    """Read one or many parts; no part loses its first row when it has no header.

    ``with_source`` adds the name of the file each row came from as ``source_file``. ``with_rejects``
    parses whole lines and adds ``corrupt_line`` and ``unreadable_columns``, which ``bronze.quality_report`` and
    ``bronze.unreadable_values`` count.
    """
    text = spark.read.schema(text_schema(with_rejects)).option("header", False).option(
        "columnNameOfCorruptRecord", CORRUPT_LINE).option("columnPruning", not with_rejects).csv(paths)
    if with_source:
        text = text.withColumn("source_file", F.col("_metadata.file_name"))
    return typed(text, with_rejects)
