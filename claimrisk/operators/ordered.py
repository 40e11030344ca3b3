"""Rank, percentile and running-sum operators that never sort one group in one task.

Spark's window functions put every row of a group into one task, and ``percentile`` holds every value
of a group in one buffer. With few, very large groups neither finishes. The operators here work on
(group, value) counts: repeated values collapse before the shuffle, and what is left is range
partitioned, so a group of any size is spread over tasks.
"""

from fractions import Fraction
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimrisk.functions.columns import any_of
from claimrisk.operators.lookup_join import lookup_join, null_safe_join
from claimrisk.session import Size, materialise, materialise_measured, store

# Rows a single window task may hold; frames above it are range partitioned.
ONE_TASK_ROWS = 1_000_000
# Groups up to this size keep all their values when percentiles are bracketed.
SMALL_GROUP = 10_000
SKETCH_ACCURACY = 10_000
# Half width of a bracket: sketch error 1e-4, plus 1.5 positions of a group above SMALL_GROUP.
BRACKET = 0.0005

# Stored sketches: their size parameter, and the half width of a bracket from them (some three times their error).
KLL_SIZE = 2048
KLL_BRACKET = 0.004

INF = float("inf")


def prefix_sums(df: DataFrame, groups, order, measures) -> DataFrame:
    """Add ``<m>_before`` (sum over smaller ``order`` values) and ``<m>_total`` for each measure.

    ``df`` holds one row per (groups, order). NULL order values come first.
    """
    df, size = materialise_measured(df)
    return _prefix_sums(df, size, groups, order, measures)


def _prefix_sums(df, size, groups, order, measures):
    if size.rows <= ONE_TASK_ROWS:
        return _running(df, list(groups), order, measures, totals=True)
    spark = df.sparkSession
    slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil(size.rows / ONE_TASK_ROWS))
    # The slice number is stored, so every later use sees the same slicing.
    sliced = materialise(
        df.repartitionByRange(slices, *groups, F.col(order).asc_nulls_first())
        .withColumn("__slice", F.spark_partition_id()))
    per_slice = sliced.groupBy(*groups, "__slice").agg(*[F.sum(m).alias(m) for m in measures])
    offsets = _running(per_slice, list(groups), "__slice", measures, totals=True)
    offsets = offsets.select(
        *groups, "__slice",
        *[F.col(f"{m}_before").alias(f"__{m}_offset") for m in measures],
        *[f"{m}_total" for m in measures])
    local = _running(sliced, [*groups, "__slice"], order, measures, totals=False)
    joined = lookup_join(local, offsets, [*groups, "__slice"])
    summed = joined.withColumns(
        {f"{m}_before": F.col(f"{m}_before") + F.col(f"__{m}_offset") for m in measures})
    return summed.drop("__slice", *[f"__{m}_offset" for m in measures])


def _running(df, groups, order, measures, totals):
    whole = Window.partitionBy(*groups)
    earlier = whole.orderBy(F.col(order).asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1)
    added = {f"{m}_before": F.coalesce(F.sum(m).over(earlier), F.lit(0)) for m in measures}
    if totals:
        added |= {f"{m}_total": F.sum(m).over(whole) for m in measures}
    return df.withColumns(added)


def value_counts(df: DataFrame, groups, value) -> DataFrame:
    return df.groupBy(*groups, value).agg(F.count("*").alias("rows"))


def _add_order(df, groups, value, name, expression, size):
    counts = value_counts(df, groups, value)
    if size is None or size.rows > ONE_TASK_ROWS:
        counts, size = materialise_measured(counts)
    summed = _prefix_sums(counts, size, groups, value, ["rows"])
    lookup = summed.select(*groups, value, "rows", expression.alias(name))
    return lookup_join(df, lookup, [*groups, value], rows="rows", size=size.plus_columns(2))


def add_rank(df: DataFrame, groups, value, name, size: Size | None = None) -> DataFrame:
    """``rank()`` within groups by falling value, NULLs last.

    ``value`` must be stable when recomputed: materialise it first if it comes from a sum of doubles.
    ``size`` bounds the size of ``df`` where that is known.
    """
    above = F.col("rows_total") - F.col("rows_before") - F.col("rows")
    return _add_order(df, groups, value, name, (above + 1).cast("int"), size)


def add_percent_rank(df: DataFrame, groups, value, name, size: Size | None = None) -> DataFrame:
    """``percent_rank()`` within groups by rising value, NULLs first."""
    below = F.try_divide(F.col("rows_before"), F.col("rows_total") - 1)
    return _add_order(df, groups, value, name, F.coalesce(below, F.lit(0.0)), size)


def value_sketches(df: DataFrame, groups, metrics: dict) -> DataFrame:
    """``groups, metric, n, sketch``: a mergeable quantile sketch of each metric (name: column) per group, and how many
    values it stands for. One pass; a sketch has some 50 kB at most, whatever the number of rows."""
    sketched = df.select(*groups, *[as_double(c).alias(m) for m, c in metrics.items()]).groupBy(*groups).agg(*[
        F.struct(F.lit(m).alias("metric"), F.count(m).alias("n"), F.kll_sketch_agg_double(m, KLL_SIZE).alias("sketch")).alias(m)
        for m in metrics])
    return sketched.select(*groups, F.inline(F.array(*metrics))).filter("n > 0")


def merge_sketches(sketches: DataFrame, groups) -> DataFrame:
    """One sketch per group and metric from the sketches of any number of parts."""
    return sketches.groupBy(*groups, "metric").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", KLL_SIZE).alias("sketch"))


def _edges(rows, groups, edges, sketches):
    """``groups, __n, __e0, ...``: the values near which single values are kept, by a sketch of the rows or by stored ones."""
    if sketches is not None:
        found = sketches.select(*groups, F.col("n").alias("__n"), F.array(*[
            F.kll_sketch_get_quantile_double("sketch", F.lit(min(max(e, 0.0), 1.0))) for e in edges]).alias("__edges"))
    else:
        found = rows.groupBy(*groups).agg(F.count("*").alias("__n"), F.percentile_approx(
            "__v", [min(max(e, 0.0), 1.0) for e in edges], SKETCH_ACCURACY).alias("__edges"))
    return materialise(found).select(*groups, "__n", *[
        F.when((F.col("__n") > SMALL_GROUP) & F.lit(0.0 < e < 1.0), F.col("__edges")[i])
        .otherwise(F.lit(INF if i % 2 else -INF)).alias(f"__e{i}")
        for i, e in enumerate(edges)])


def compressed_histogram(df: DataFrame, groups, value, fractions, bracket=BRACKET, sketches=None) -> DataFrame:
    """Ordered counts per group that keep single values only near the wanted percentiles.

    A sketch gives a bracket around each percentile. Values inside keep their own row; all rows between
    two brackets become one row (``is_lump``), represented by its smallest value. The result has
    ``groups, value, is_lump, rows, rows_before, rows_total`` and stays small for any input size.
    ``bracket=None`` keeps every value. ``sketches`` (``groups, n, sketch``) of the same values save the pass that makes one.
    """
    rows = df.select(*groups, as_double(value).alias("__v")).filter(F.col("__v").isNotNull())
    inside, segment = F.lit(True), F.lit(0)
    if bracket is not None:
        edges = [e for f in fractions for e in (f - bracket, f + bracket)]
        bounds = _edges(rows, groups, edges, sketches)
        if groups:
            rows = lookup_join(rows, bounds, groups, rows="__n")
            edge = [F.col(f"__e{i}") for i in range(len(edges))]
        else:
            edge = [F.lit(e) for e in bounds.first()[1:]]
        pairs = list(zip(edge[::2], edge[1::2]))
        inside = any_of(F.col("__v").between(lo, hi) for lo, hi in pairs)
        segment = sum(((F.col("__v") >= lo).cast("int") + (F.col("__v") > hi).cast("int")
                       for lo, hi in pairs), F.lit(0))
    counted = (
        rows.groupBy(*groups, segment.alias("__segment"), F.when(inside, F.col("__v")).alias("__kept"))
        .agg(F.count("*").alias("rows"), F.min("__v").alias("value"))
        .select(*groups, "value", F.col("__kept").isNull().alias("is_lump"), "rows"))
    return prefix_sums(counted, groups, "value", ["rows"])


def as_double(value) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("double")


def _holds(position: Column) -> Column:
    """True on the histogram row that contains the 0-based position."""
    before = F.col("rows_before")
    return (before <= position) & (position < before + F.col("rows"))


def percentiles(df: DataFrame, groups, value, fractions: dict, bracket=BRACKET, sketches=None) -> DataFrame:
    """Exact percentiles per group with linear interpolation; ``fractions`` maps names to 0..1.

    Groups without any value are absent from the result. With stored ``sketches`` (``groups, n, sketch``) ``df`` is read once. They only
    say where to look: if they are off, or lack a group, all values are counted.
    """
    if sketches is not None and bracket is not None:
        bracket = KLL_BRACKET
    columns = {}
    picks = []
    for name, fraction in fractions.items():
        position = F.lit(float(fraction)) * (F.col("rows_total") - 1)
        low, high = F.floor(position), F.ceil(position)
        for end, place in (("low", low), ("high", high)):
            picks.append(F.max(F.when(_holds(place), F.col("value"))).alias(f"__{name}_{end}"))
            picks.append(F.max(_holds(place) & F.col("is_lump")).alias(f"__{name}_{end}_missed"))
        picks.append(F.max(position - low).alias(f"__{name}_part"))
        at = F.col(f"__{name}_low")
        columns[name] = at + (F.col(f"__{name}_high") - at) * F.col(f"__{name}_part")
    histogram = compressed_histogram(df, groups, value, list(fractions.values()), bracket, sketches)
    if groups:
        picked = histogram.groupBy(*groups).agg(*picks)
    else:
        picked = histogram.agg(*picks)
    picked = materialise(picked)
    missed = any_of(F.col(c) for c in picked.columns if c.endswith("_missed"))
    if bracket is not None and not picked.filter(missed).isEmpty():
        return percentiles(df, groups, value, fractions, bracket=None)
    return picked.select(*groups, *[c.alias(name) for name, c in columns.items()])


def top_fraction_cut(df: DataFrame, value, fraction, bracket=BRACKET):
    """The value v for which ``percent_rank() >= fraction`` over all rows means ``value > v``.

    NULLs rank first and count as rows. None means that no row passes.
    """
    ranked = df.select(F.coalesce(as_double(value), F.lit(-INF)).alias("v"))
    histogram = materialise(compressed_histogram(ranked, [], "v", [float(fraction)], bracket))
    rows = histogram.agg(F.sum("rows")).first()[0] or 0
    smaller = ceil(Fraction(str(fraction)) * (rows - 1))
    if smaller <= 0:
        return None if rows <= 1 else -INF
    found = histogram.filter(_holds(F.lit(smaller - 1))).select("value", "is_lump").first()
    if found.is_lump:
        return top_fraction_cut(df, value, fraction, bracket=None)
    return found.value


def top_fraction(df: DataFrame, value: Column, fraction, bracket=BRACKET) -> DataFrame:
    """Rows with ``percent_rank() >= fraction`` by ``value``, without a shuffle or a copy of the other rows.

    ``df`` is read twice. A sketch of the values gives a lower bound of the cut; then only rows that reach it are stored, and the
    exact cut is found among them, as the number of rows below is known. If the bound misses, all values are counted.
    """
    count, low = df.agg(F.count("*"), F.percentile_approx(
        F.coalesce(as_double(value), F.lit(-INF)), max(0.0, float(fraction) - bracket), SKETCH_ACCURACY)).first()
    smaller = ceil(Fraction(str(fraction)) * (count - 1))
    if smaller <= 0:
        return df.filter(F.lit(count > 1) & (value > -INF))
    kept = store(df if count <= SMALL_GROUP or low == -INF else df.filter(value >= low))
    ranked = kept.select(F.coalesce(as_double(value), F.lit(-INF)).alias("v"))
    histogram = materialise(prefix_sums(value_counts(ranked, [], "v"), [], "v", ["rows"]))
    above = histogram.agg(F.sum("rows")).first()[0] or 0
    found = histogram.select(F.col("v").alias("value"), "rows", "rows_before").filter(
        _holds(F.lit(smaller - 1 - (count - above)))).first()
    if found is None:
        return df.filter(value > F.lit(top_fraction_cut(df, value, fraction, bracket=None)))
    return kept.filter(value > F.lit(found.value))


# Distinct values that one row of an order index holds.
INDEX_SLICE = 1024


def order_index(df: DataFrame, groups, value) -> DataFrame:
    """An index of the order of ``value`` in each group, to be stored: later values find their rank in it without ranking again.

    ``groups, slice, first, total, values, before``: a row per slice of INDEX_SLICE neighbouring distinct values, with how many rows
    of the group are smaller than each. ``first`` is the slice's smallest value, ``total`` the rows of the group. NULLs come first, as
    in ``add_percent_rank``: they are rows below every value.
    """
    counts = value_counts(df.select(*groups, as_double(value).alias("value")), groups, "value").withColumn("one", F.lit(1))
    summed = prefix_sums(counts, groups, "value", ["rows", "one"])
    part = F.floor(F.col("one_before") / INDEX_SLICE).alias("slice")
    entry = F.struct("value", F.col("rows_before").alias("before"), "rows")
    packed = summed.groupBy(*groups, part).agg(
        F.max("rows_total").alias("total"), F.array_sort(F.collect_list(entry)).alias("entries"))
    return packed.select(
        *groups, "slice", F.col("entries")[0]["value"].alias("first"), "total", "entries")


def add_rank_among(df: DataFrame, index: DataFrame, groups, value, name) -> DataFrame:
    """The percent rank that ``value`` has among the rows of a stored ``order_index`` and itself; works on a batch or a stream.

    As ``percent_rank()`` over the indexed rows of the group with this one row added: 0 for NULL and for a group that the index
    doesn't know. A row meets the one slice of its group that holds its place: a lookup in the first values of the slices, then a join on
    (group, slice). Only these first values, one per INDEX_SLICE values, are gathered per group.
    """
    firsts = index.groupBy(*groups).agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("first", F.lit(-INF)).alias("first"), "slice"))).alias("__firsts"))
    wanted = F.coalesce(as_double(value), F.lit(-INF))
    # The last slice whose first value is smaller: rows in later ones are not below.
    below = F.filter("__firsts", lambda f: f["first"] < wanted)
    placed = lookup_join(df, firsts, groups).withColumn(
        "__slice", F.when(F.size(below) > 0, F.try_element_at(below, F.lit(-1))["slice"])).drop("__firsts")
    slices = index.select(*groups, F.col("slice").alias("__slice"), F.col("total").alias("__total"),
                          F.col("entries").alias("__entries"))
    if df.isStreaming:  # a stream can't be counted; Spark broadcasts the index by its size or shuffles
        joined = null_safe_join(placed, slices, [*groups, "__slice"], "left")
    else:
        joined = lookup_join(placed, slices, [*groups, "__slice"])
    smaller = F.filter("__entries", lambda e: F.coalesce(e["value"], F.lit(-INF)) < wanted)
    last = F.try_element_at(smaller, F.lit(-1))
    rank = F.coalesce(F.try_divide(last["before"] + last["rows"], F.col("__total")), F.lit(0.0))
    return joined.withColumn(name, F.when(as_double(value).isNull(), F.lit(0.0)).otherwise(rank)).drop(
        "__slice", "__total", "__entries")
