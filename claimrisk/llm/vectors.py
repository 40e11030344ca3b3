"""Tables of vectors as numbered rows, and columns of vectors as matrices."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(table: DataFrame, *keep, vec_id="vec_id", embedding="embedding", width=None) -> DataFrame:
    """``row, vec_id, x`` and the columns ``keep`` of the rows with a vector whose components (``width`` of them, if
    given) are all finite numbers; ``x`` holds them as doubles.

    ``row`` numbers the rows, so that rows which repeat an id, or have none, stay rows of their own. It is
    only stable once the result is stored.
    """
    x = F.transform(F.col(embedding), lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    good = F.col(embedding).isNotNull() & ~bad
    if width is not None:
        good = good & (F.size(embedding) == width)
    return table.filter(good).select(
        F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("vec_id"), x.alias("x"), *keep)


def matrix(column, width=None, dtype=np.float64):
    """The lists of an Arrow column as rows of a matrix, shorter ones filled up with zeros."""
    if hasattr(column, "combine_chunks"):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(sizes.max(initial=0)) if width is None else width
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def floors(x, scale: int):
    """floor(scale * x) exactly: 64-bit integers where all are below 2^53, else Python's integers."""
    if not len(x) or np.abs(x).max(initial=0) * scale < 2.0 ** 53:
        return np.floor(x * scale).astype(np.int64)
    exact = [int(c) * scale if abs(c) >= 2.0 ** 53 else int(np.floor(c * scale)) for c in x.ravel().tolist()]
    return np.array(exact, object).reshape(x.shape)


def largest(x) -> int:
    """The largest absolute value of a matrix of integers, as one of Python's integers."""
    return max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0


def clipped(values):
    """Python's integers cut to the range of a long."""
    return [max(-2 ** 63, min(2 ** 63 - 1, int(v))) for v in values]


def meet(held: DataFrame, asked: DataFrame, unit: str, group: str, units: int) -> DataFrame:
    """The rows of both frames, which have the same columns, one partition per ``unit`` (numbers below ``units``), with the
    held rows before those that are asked about them; the latter by ``group``. For ``meetings``."""
    both = held.withColumn("kind", F.lit(0)).unionByName(asked.withColumn("kind", F.lit(1)))
    return both.repartitionById(units, F.col(unit).cast("int")).sortWithinPartitions(unit, "kind", group)


def meetings(batches, unit, group, asked_rows=256):
    """(held rows, some asked rows) of each unit from the Arrow batches of a partition of ``meet``.

    A task keeps the held rows of one unit and no more than about ``asked_rows`` asked rows of one group, which stream past;
    asked rows of a unit without held rows are passed over. The table of held rows stays the same object during a unit.
    """
    def places(batch):
        keys = [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
                for c in (unit, "kind", group)]
        cuts = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1
        for first, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            for at in range(first, stop, asked_rows):
                yield tuple(k[first] for k in keys), batch.slice(at, min(asked_rows, stop - at))

    held, table, pending, now = [], None, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        for (at, kind, part_of), piece in places(batch):
            if pending and (now != (at, part_of) or kind == 0 or sum(p.num_rows for p in pending) + piece.num_rows > asked_rows):
                yield table, pa.Table.from_batches(pending)
                pending = []
            if kind == 0:
                if now is None or now[0] != at:
                    held, table = [], None
                held.append(piece)
            elif held and now[0] == at:
                table = pa.Table.from_batches(held).combine_chunks() if table is None else table
                pending.append(piece)
            now = at, part_of
    if pending:
        yield table, pa.Table.from_batches(pending)
