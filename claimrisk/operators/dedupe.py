"""Duplicates on a grain, found with mergeable aggregates only."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimrisk.operators.lookup_join import fits_broadcast, null_safe_join
from claimrisk.session import materialise_measured


def keep_first(df: DataFrame, grain) -> DataFrame:
    """One row per grain: the smallest by all other columns in column order, NULLs first.

    Only the grain columns of all rows are shuffled, to find the grains that repeat. Rows of other grains pass an anti join as they
    are; the minimum is taken among the rest. It combines before the shuffle, so any number of copies
    of one key is harmless. ``df`` is read three times, first the grain only: pass a stored table.
    """
    counts = df.groupBy(*grain).agg(F.count("*").alias("__copies")).filter("__copies > 1").drop("__copies")
    repeated, size = materialise_measured(counts)
    if not size.rows:
        return df
    if fits_broadcast(size):
        repeated = F.broadcast(repeated)
    rest = [c for c in df.columns if c not in grain]
    winner = null_safe_join(df, repeated, grain, "left_semi").groupBy(*grain).agg(F.min(F.struct(*rest)).alias("__row"))
    return null_safe_join(df, repeated, grain, "left_anti").unionByName(
        winner.select(*[c if c in grain else F.col("__row")[c].alias(c) for c in df.columns]))


def duplicate_count(df: DataFrame, grain) -> DataFrame:
    """One row: how many rows are copies of an earlier one; NULL keys count as equal."""
    counts = df.groupBy(*grain).agg(F.count("*").alias("n"))
    return counts.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))
