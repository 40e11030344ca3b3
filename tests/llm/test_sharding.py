"""Shard placement: against SQL, and the properties of the table."""

from collections import Counter

import pytest
from compare import connect, differences
from llm.conftest import rows_of

from claimrisk.llm import sharding


def test_same_as_sql(spark, sf_dir):
    from claimrisk.llm.queries import ORACLES, QUERIES

    found = QUERIES["op9_sharding"](spark, sf_dir)
    assert differences(found, connect(sf_dir), ORACLES["op9_sharding"]) == ""
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Exchange hash" not in plan


def test_slots_are_shared_evenly():
    counts = Counter(sharding.fill_table(sharding.shard_names(10), 1009))
    assert max(counts.values()) - min(counts.values()) <= 1


def test_few_slots_move_when_a_shard_leaves():
    names = sharding.shard_names(20)
    before, after = (sharding.fill_table(n, 2003) for n in (names, names[:-1]))
    moved = sum(a != b for a, b in zip(before, after) if a != 19)
    assert moved < 0.1 * 2003


@pytest.mark.parametrize("shards, size", [([], 7), (["a"], 8), (["a", "b", "c"], 2)])
def test_wrong_tables(shards, size):
    with pytest.raises(ValueError):
        sharding.fill_table(shards, size)


def test_odd_rows(odd, clashing, empty):
    names = sharding.shard_names(4)
    placed = sharding.place(odd, names)
    assert placed.count() == odd.count() and placed.filter("shard is null").count() == 0
    assert placed.filter("doc_id = 4").select("shard").distinct().count() == 1
    again = sharding.place(clashing, names)
    assert rows_of(again.select("doc_id", "slot", "shard")) == rows_of(placed.select("doc_id", "slot", "shard"))
    assert sharding.place(empty, names).count() == 0
    assert sharding.place(odd, names, key="text").filter("shard is null").count() == 0


def test_written_shards(odd, spark, tmp_path):
    names = sharding.shard_names(3)
    sharding.write_shards(odd, str(tmp_path / "out"), names, files_per_shard=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert rows_of(back.select("doc_id", "text")) == rows_of(odd.select("doc_id", "text"))
