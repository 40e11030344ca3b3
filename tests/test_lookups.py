"""Lookups in stored indexes: ranks of new rows, cohorts, single providers."""

import itertools
import tempfile

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from test_scans import last_execution, rows_read

from claimrisk.operators import lookup_join, ordered
from claimrisk.plans import ml, serving
from claimrisk.queries import formula_scores, mart
from claimrisk.session import store
from claimrisk.sources import tables


@pytest.fixture(scope="module")
def served(spark, sf_dir):
    return store(serving.serving_provider_risk(formula_scores(mart(spark, sf_dir))))


def full_ranks(indexed, rows):
    """(g, v, percent rank of each row with only itself added), by a full ranking per row."""
    out = []
    for g, v in rows:
        same = [x for h, x in indexed if h == g]
        below = sum(v is not None and (x is None or x < v) for x in same)
        out.append((g, v, below / len(same) if same else 0.0))
    return sorted(out, key=repr)


INDEXED = [("a", float(i % 37)) for i in range(300)] + [("b", 5.0)] * 40 + [("b", None)] * 5 + [("c", None)] + [
    (None, float(i)) for i in range(20)]
NEW = [("a", -1.0), ("a", 0.0), ("a", 17.5), ("a", 36.0), ("a", 99.0), ("a", None), ("b", 5.0), ("b", 4.0), ("b", 6.0),
       ("c", 1.0), (None, 7.5), ("unknown", 3.0)]


@pytest.mark.parametrize("slice_rows,broadcast", [(1024, 64 << 20), (5, 64 << 20), (5, 0)])
def test_rank_among(spark, monkeypatch, slice_rows, broadcast):
    monkeypatch.setattr(ordered, "INDEX_SLICE", slice_rows)
    monkeypatch.setattr(lookup_join, "BROADCAST_BYTES", broadcast)
    index = store(ordered.order_index(spark.createDataFrame(INDEXED, "g string, v double"), ["g"], "v"))
    found = ordered.add_rank_among(spark.createDataFrame(NEW, "g string, v double"), index, ["g"], "v", "p")
    assert sorted(map(tuple, found.collect()), key=repr) == full_ranks(INDEXED, NEW)


def test_rank_equals_percent_rank_with_the_row_added(spark):
    base = spark.createDataFrame(INDEXED, "g string, v double")
    index = store(ordered.order_index(base, ["g"], "v"))
    for row in NEW[:9]:
        one = spark.createDataFrame([row], "g string, v double")
        window = Window.partitionBy("g").orderBy("v")
        everything = base.withColumn("new", F.lit(0)).unionByName(one.withColumn("new", F.lit(1)))
        expected = everything.withColumn("p", F.percent_rank().over(window)).filter("new = 1").first().p
        assert ordered.add_rank_among(one, index, ["g"], "v", "p").first().p == pytest.approx(expected)


def test_new_providers_on_a_stream(spark, sf_dir, tmp_path):
    table = store(mart(spark, sf_dir).withColumn("unique_hcpcs_per_npi", F.col("unique_procedures")))
    new = table.filter("provider_id % 5 = 0")
    index = store(ml.rank_index(table.filter("provider_id % 5 <> 0")))
    batch = ml.features_wide_of_new(new, index)
    new.write.parquet(str(tmp_path / "in"))
    stream = ml.features_wide_of_new(spark.readStream.schema(new.schema).parquet(str(tmp_path / "in")), index)
    stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(
        availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == sorted(map(tuple, batch.collect()))


def test_every_filter_set_equals_the_full_cohort(spark, served):
    index = store(serving.cohort_index(served, rows=30))
    row = served.first()
    values = [("", row.risk_tier, "no such tier"), (None, row.state), ("", row.specialty, "x' OR '1'='1")]
    for tier, state, specialty in itertools.product(*values):
        for limit in (1, 7, 30):
            wanted = dict(risk_tier=tier, state=state, specialty=specialty, limit=limit)
            found = serving.indexed_cohort(index, served, rows=30, **wanted)
            assert [tuple(r) for r in found.collect()] == [tuple(r) for r in serving.cohort(served, **wanted).collect()]
            assert found.columns == serving.cohort(served).columns
    beyond = serving.indexed_cohort(index, served, rows=30, limit=31)
    assert [tuple(r) for r in beyond.collect()] == [tuple(r) for r in serving.cohort(served, limit=31).collect()]
    assert index.groupBy("filters", "by_risk_tier", "by_state", "by_specialty").count().filter("count > 30").isEmpty()


def test_rows_without_a_filter_value_are_in_no_cohort_of_it(spark, served):
    odd = served.withColumn("state", F.lit(None).cast("string"))
    index = store(serving.cohort_index(odd))
    assert index.filter("filters = 2").isEmpty() and not index.filter("filters = 1").isEmpty()
    assert serving.indexed_cohort(index, odd, state="NATION_1").isEmpty()


def test_a_lookup_reads_few_rows(spark):
    """An id that is not there is not looked for in any file, one that is only where it may be."""
    root = tempfile.mkdtemp(dir="/tmp")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS lookups LOCATION '{root}'")
    rows = spark.range(0, 40_000).select((F.col("id") * 2).alias("provider_id"), F.md5(F.col("id").cast("string")).alias("x"))
    stored = tables.write_table(rows.repartition(4), "lookups.shuffled", lookup_by=["provider_id"])

    def read(provider_id):
        before = last_execution(spark)
        found = stored.filter(F.col("provider_id") == provider_id).collect()
        last_execution(spark)
        return len(found), rows_read(spark, before, "lookups.shuffled")

    assert read(20_001) == (0, 0)  # within the range of every file
    found, touched = read(20_002)
    assert found == 1 and touched <= 12_000


def test_cohort_lookup_reads_part_of_the_index(spark, served):
    root = tempfile.mkdtemp(dir="/tmp")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS cohorts LOCATION '{root}'")
    index = tables.write_table(serving.cohort_index(served), "cohorts.indexed", sort_by=serving.COHORT_ORDER,
                               partition_by=["filters"])
    held = index.filter("filters = 3").count()
    before = last_execution(spark)
    serving.indexed_cohort(index, served, risk_tier="Critical", state=served.first().state, limit=5).collect()
    last_execution(spark)
    assert 0 < rows_read(spark, before, "cohorts.indexed") <= held < index.count() / 4
