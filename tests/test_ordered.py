"""Ordered operators against Spark's literal window and percentile forms, on both of their paths."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from claimrisk.operators import lookup_join as joins
from claimrisk.operators import ordered

FEW = settings(max_examples=5, deadline=None,
               suppress_health_check=[HealthCheck.function_scoped_fixture])
ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", None]),
                          st.one_of(st.none(), st.integers(-3, 3).map(float))), max_size=40)
SCHEMA = "g string, v double"


@pytest.fixture(params=["one task", "sliced"])
def path(request, monkeypatch):
    """The sliced path also splits joins instead of broadcasting."""
    if request.param == "sliced":
        monkeypatch.setattr(ordered, "ONE_TASK_ROWS", 2)
        monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(joins, "HEAVY_SHARE", 4)
        monkeypatch.setattr(ordered, "SMALL_GROUP", 0)
    return request.param


def same(actual, expected):
    assert sorted(map(repr, map(tuple, actual.collect()))) == sorted(
        map(repr, map(tuple, expected.select(actual.columns).collect())))


@FEW
@given(rows=ROWS)
def test_rank(spark, path, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    window = Window.partitionBy("g").orderBy(F.desc_nulls_last("v"))
    same(ordered.add_rank(df, ["g"], "v", "r"), df.withColumn("r", F.rank().over(window)))


@FEW
@given(rows=ROWS)
def test_percent_rank(spark, path, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    window = Window.partitionBy("g").orderBy("v")
    same(ordered.add_percent_rank(df, ["g"], "v", "r"), df.withColumn("r", F.percent_rank().over(window)))


@FEW
@given(rows=ROWS, fraction=st.sampled_from([0.25, 0.5, 0.95, 1.0]))
def test_percentiles(spark, path, rows, fraction):
    df = spark.createDataFrame(rows, SCHEMA)
    actual = {r.g: r.p for r in ordered.percentiles(df, ["g"], "v", {"p": fraction}).collect()}
    expected = {r.g: r.p for r in df.groupBy("g").agg(F.percentile("v", fraction).alias("p")).collect()
                if r.p is not None}
    assert actual == pytest.approx(expected)


@FEW
@given(values=st.lists(st.one_of(st.none(), st.integers(-3, 3).map(float)), max_size=60),
       fraction=st.sampled_from([0.5, 0.9, 0.99]))
def test_top_fraction(spark, path, values, fraction):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    literal = df.withColumn("p", F.percent_rank().over(Window.orderBy("v"))).filter(F.col("p") >= fraction)
    same(ordered.top_fraction(df, F.col("v"), fraction), literal.drop("p"))


def test_percentiles_of_a_large_skewed_group(spark, path):
    """Brackets are in use here: most rows share one group and a third share one value."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 50 == 0, "small").otherwise("big").alias("g"),
        F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(10_000)) / 7).alias("v"))
    wanted = {"low": 0.25, "mid": 0.5, "high": 0.95}
    actual = {r.g: tuple(r)[1:] for r in ordered.percentiles(df, ["g"], "v", wanted).collect()}
    expected = df.groupBy("g").agg(*[F.percentile("v", f) for f in wanted.values()]).collect()
    for row in expected:
        assert actual[row.g] == pytest.approx(tuple(row)[1:])


def test_histogram_is_small(spark):
    df = spark.range(100_000).select(F.xxhash64("id").cast("double").alias("v"))
    histogram = ordered.compressed_histogram(df, [], "v", [0.5])
    assert histogram.count() < 500
    assert histogram.agg(F.sum("rows")).first()[0] == 100_000


def test_failed_bracket_falls_back_to_all_values(spark, monkeypatch):
    monkeypatch.setattr(ordered, "SMALL_GROUP", 0)
    df = spark.createDataFrame([("a", float(i)) for i in range(11)], SCHEMA)
    found = ordered.percentiles(df, ["g"], "v", {"p": 0.94}, bracket=1e-9).first().p
    assert found == pytest.approx(9.4)
    assert ordered.top_fraction_cut(df, "v", 0.94, bracket=1e-9) == 9.0


@FEW
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 5)), max_size=30),
       counted=st.booleans())
def test_lookup_join(spark, path, rows, counted):
    big = spark.createDataFrame(rows, "g string, x int")
    small = big.groupBy("g").agg(F.sum("x").alias("total"), F.count("*").alias("n"))
    if not counted:
        small = small.filter("g is null or g <> 'a'").drop("n")
    actual = joins.lookup_join(big, small, ["g"], rows="n" if counted else None)
    expected = big.join(small.withColumnRenamed("g", "k"), F.col("g").eqNullSafe(F.col("k")), "left")
    same(actual, expected)


def test_top_fraction_when_the_sketch_misses(spark, monkeypatch):
    """A bound above the cut: the rows below it are looked at again."""
    monkeypatch.setattr(ordered, "SMALL_GROUP", 10)
    df = spark.range(1000).selectExpr("cast(id % 500 AS double) AS v")
    exact = ordered.top_fraction(df, F.col("v"), 0.9)
    missed = ordered.top_fraction(df, F.col("v"), 0.9, bracket=-0.05)
    assert sorted(r.v for r in exact.collect()) == sorted(r.v for r in missed.collect()) == sorted(
        r.v for r in df.collect() if r.v >= 450)
