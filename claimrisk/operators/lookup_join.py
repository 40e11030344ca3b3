"""Join of a large frame with per-key statistics, safe for hot keys and for large lookups."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimrisk.functions.columns import all_of
from claimrisk.session import Size, materialise, materialise_measured

# A lookup measured above this is never broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024
# A key with more than 1/HEAVY_SHARE of the rows is heavy, so there are fewer than HEAVY_SHARE of them.
HEAVY_SHARE = 10_000


def null_safe_join(left: DataFrame, right: DataFrame, keys, how="inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL equals NULL; the keys appear once in the result."""
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    matched = all_of(left[k].eqNullSafe(renamed[f"__right_{k}"]) for k in keys)
    return left.join(renamed, matched, how).drop(*[f"__right_{k}" for k in keys])


def fits_broadcast(size: Size) -> bool:
    return size.bytes <= BROADCAST_BYTES


def lookup_join(big: DataFrame, small: DataFrame, keys, rows=None, size: Size | None = None
                ) -> DataFrame:
    """Add the columns of ``small`` (unique per ``keys``) to ``big``; NULL keys match NULL keys.

    Within the broadcast limit the lookup is broadcast and ``big`` is not shuffled. Beyond it, keys
    with many rows are joined by a broadcast of their few lookup rows, and only the others are
    shuffled.

    ``rows`` names a column of ``small`` that holds the number of rows of the key in ``big``; it is
    dropped, and saves counting them. ``size`` bounds the size of ``small`` where that is known, else
    ``small`` is materialised and measured.
    """
    if size is None or not fits_broadcast(size):
        small, size = materialise_measured(small)
    if fits_broadcast(size):
        lookup = small if rows is None else small.drop(rows)
        return null_safe_join(big, F.broadcast(lookup), keys, "left")
    return _split_join(big, small, keys, rows)


def _split_join(big, small, keys, rows):
    if rows is None:
        counts = materialise(big.groupBy(*keys).agg(F.count("*").alias("__rows")))
        small, rows = null_safe_join(counts, small, keys, "left"), "__rows"
    total = small.agg(F.sum(rows)).first()[0] or 0
    heavy = F.broadcast(materialise(small.filter(F.col(rows) * HEAVY_SHARE > total).drop(rows)))
    light = null_safe_join(big, heavy.select(*keys), keys, "left_anti")
    return null_safe_join(big, heavy, keys).unionByName(
        null_safe_join(light, small.drop(rows), keys, "left"))
