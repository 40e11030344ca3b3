"""Session defaults and fault-tolerant materialisation."""

import tempfile
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Settings the plans count on; a cluster may override any of them at submit time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Above this many groups per task, percentile sketches fall back to sorting all their rows.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "512",
    # Recording the Python call site of every expression doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name="claimrisk", master=None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for cut lineage: the one the cluster names, a temporary one only in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="claimrisk-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into reliable storage, so later stages neither recompute nor lose it."""
    scratch_dir(df.sparkSession)
    return df.checkpoint()


def store(df: DataFrame, columns=None) -> DataFrame:
    """A Parquet copy of ``df`` (or of ``columns``) in the shared folder, for plans that read it again.

    Unlike ``materialise`` it is columnar and compressed: later passes read only their columns. The
    copy goes when the driver's JVM ends, or earlier by ``drop_stored``.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/stored-{uuid.uuid4().hex}"
    df = df.select(*columns) if columns else df
    df.write.parquet(path)
    file_system(spark, path)[0].deleteOnExit(file_system(spark, path)[1])
    return spark.read.schema(df.schema).parquet(path)


def file_system(spark, path):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def drop_stored(df: DataFrame) -> None:
    """Remove the files behind a frame that ``store`` returned."""
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        system, place = file_system(df.sparkSession, folder)
        system.delete(place, True)


class Size(NamedTuple):
    """Measured rows and estimated bytes of a frame, or an upper bound of them."""

    rows: int
    bytes: int

    def plus_columns(self, columns: int) -> "Size":
        return Size(self.rows, self.bytes + 16 * columns * self.rows)


def materialise_measured(df: DataFrame) -> tuple[DataFrame, Size]:
    """``materialise``, with the size measured by the same job."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    chars = sum((F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in text), F.lit(0))
    measured = Observation()
    stored = materialise(df.observe(measured, F.count("*").alias("rows"), chars.alias("chars")))
    rows = measured.get["rows"]
    return stored, Size(rows, measured.get["chars"] + rows * (16 * len(df.columns) + 16))
