"""Incremental load of late parts: each file is appended to Bronze exactly once."""

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimrisk.plans import silver
from claimrisk.plans.provider_state import ProviderState
from claimrisk.sources.csv_parts import CORRUPT_LINE, text_schema, typed


def load_new_parts(spark: SparkSession, source_dir: str, table: str, checkpoint: str,
                   fmt="parquet", max_files=None, with_source=False,
                   with_rejects=False) -> StreamingQuery:
    """Append the files that arrived since the last call, then stop.

    Parsing is stateless, so no watermark or state store is needed; the checkpoint records the files
    that are done. ``max_files`` splits a large backlog into several commits; ``with_rejects`` is that of
    ``read_parts``.
    """
    return (
        _new_parts(spark, source_dir, max_files, with_source, with_rejects).writeStream.format(fmt).outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .toTable(table))


def _new_parts(spark, source_dir, max_files=None, with_source=False, with_rejects=False):
    reader = spark.readStream.schema(text_schema(with_rejects)).option("header", False).option(
        "columnNameOfCorruptRecord", CORRUPT_LINE).option("columnPruning", not with_rejects)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    text = reader.csv(source_dir)
    if with_source:
        text = text.withColumn("source_file", F.col("_metadata.file_name"))
    return typed(text, with_rejects)


def follow_parts(state: ProviderState, source_dir: str, checkpoint: str, max_files=1) -> StreamingQuery:
    """Add the files that arrived since the last call to the provider state, then stop.

    Each micro-batch of up to ``max_files`` files is a part, named by its number; a batch that the stream repeats after a
    failure has the same number and is added once.
    """
    def add(rows, number):
        state.add_part(f"batch-{number}", silver.clean(rows))

    return (
        _new_parts(state.spark, source_dir, max_files).writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start())
