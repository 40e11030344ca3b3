"""Token rollups: against counting the final state, replays and broken commits."""

import random
import tempfile
from collections import Counter

import pytest
from llm.conftest import rows_of
from pyspark.sql import functions as F
from test_scans import last_execution, rows_read

from claimrisk.llm.packing import token_ids
from claimrisk.llm.token_rollup import BUCKETS, CHANGES, TokenRollup, rollup_of_table


def slow_totals(state):
    documents, tokens = Counter(), Counter()
    for (_, version), (source, lang, n) in state.items():
        documents[source, lang, version] += 1
        tokens[source, lang, version] += n
    return sorted(((*g, documents[g], tokens[g]) for g in documents), key=repr)


def test_random_batches(spark, tmp_path):
    rng = random.Random(1)
    rollup, state = TokenRollup(spark, str(tmp_path / "rollup")), {}
    for batch in range(1, 5):
        rows = []
        for doc in rng.sample(range(40), 20):
            op = rng.choice(["insert", "revise", "delete"])
            row = (op, doc, rng.choice(["a", "b", None]), rng.choice(["en", None]), rng.choice(["v1", "v2"]), rng.randrange(90))
            rows.append(row)
            if op == "delete":
                state.pop((doc, row[4]), None)
            else:
                state[doc, row[4]] = (row[2], row[3], row[5])
        changes = spark.createDataFrame([*rows, rows[0]], CHANGES)
        assert rollup.commit(batch, changes)
        assert rows_of(rollup.totals()) == slow_totals(state)
        assert not rollup.commit(batch, changes)
        assert rows_of(rollup.totals()) == slow_totals(state)


def test_a_broken_commit_is_written_anew(spark, tmp_path):
    path = tmp_path / "rollup"
    rollup = TokenRollup(spark, str(path))
    first = spark.createDataFrame([("insert", 1, "a", "en", "v", 5), ("insert", None, None, None, "v", None)], CHANGES)
    rollup.commit(1, first)
    second = spark.createDataFrame([("revise", 1, "b", "en", "v", 7)], CHANGES)
    rollup.commit(2, second)
    (path / "totals" / "batch=2" / "_SUCCESS").unlink()  # as if the driver was lost before the end
    assert rollup.committed() == [1]
    assert rows_of(rollup.totals()) == [("a", "en", "v", 1, 5), (None, None, "v", 1, 0)]
    assert TokenRollup(spark, str(path)).commit(2, second)
    assert rows_of(rollup.totals()) == [("b", "en", "v", 1, 7), (None, None, "v", 1, 0)]
    with pytest.raises(ValueError):
        rollup.commit(0, first)


def test_a_commit_reads_only_the_buckets_of_its_documents(spark):
    root = tempfile.mkdtemp(dir="/tmp")  # a short path: plans show only the beginning
    rollup = TokenRollup(spark, f"{root}/r")
    rollup.commit(1, spark.range(2000).selectExpr(
        "'insert' AS op", "id AS doc_id", "'a' AS source", "'en' AS lang", "'v' AS tokenizer_version", "5L AS tokens"))
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS))
    sizes = {r.b: r["count"] for r in spark.range(2000).withColumnRenamed("id", "doc_id").groupBy(bucket.alias("b")).count().collect()}
    revised = spark.createDataFrame([("revise", d, "a", "en", "v", 9) for d in (3, 4)], CHANGES)
    touched = {r.b for r in revised.select(bucket.alias("b")).collect()}
    before = last_execution(spark)
    rollup.commit(2, revised)
    last_execution(spark)
    # The new rows are read again for the totals.
    assert rows_read(spark, before, f"{root}/r/ledger/batch=1") == sum(sizes[b] for b in touched) < 200
    assert rows_of(rollup.totals()) == [("a", "en", "v", 2000, 5 * 2000 + 8)]


def test_nothing_committed(spark, tmp_path):
    rollup = TokenRollup(spark, str(tmp_path / "rollup"))
    assert rollup.totals().count() == 0
    assert rollup.commit(1, spark.createDataFrame([], CHANGES)) and rollup.totals().count() == 0


def slow_table(rows, tokenizer):
    import re

    rows = {r[0]: r for r in rows}
    first, state = {}, {}
    for i, text, lang, source in sorted(rows.values(), key=lambda r: (r[0] is None, r[0])):
        if first.setdefault(text, i) == i:
            words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
            spoken = [w for w in words if any(c.isalnum() for c in w)]
            state[i, "words"] = (source, lang, len(spoken))
            state[i, "bpe"] = (source, lang, len(token_ids(tokenizer, text)) if text else 0)
    return slow_totals(state)


def test_whole_table(spark, sf_dir):
    from claimrisk.llm.queries import BYTE_BPE, documents

    table = documents(spark, sf_dir)
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in table.collect()]
    assert rows_of(rollup_of_table(table, BYTE_BPE, "bpe")) == slow_table(rows, BYTE_BPE)


def test_odd_rows(odd, clashing, empty):
    from claimrisk.llm.queries import BYTE_BPE

    rows = [(r.doc_id, r.text, r.lang, r.source) for r in odd.collect()]
    found = rows_of(rollup_of_table(odd, BYTE_BPE, "bpe"))
    assert found == slow_table(rows, BYTE_BPE)
    assert rows_of(rollup_of_table(clashing, BYTE_BPE, "bpe")) == found
    assert rollup_of_table(empty, BYTE_BPE, "bpe").count() == 0


def test_rows_without_an_id_or_with_a_repeated_one_count(docs):
    from claimrisk.llm.queries import BYTE_BPE

    table = docs([(None, "one two"), (None, "three"), (4, "five six seven"), (4, "eight"), (4, "eight"), (None, "eight")])
    totals = {r.tokenizer_version: (r.documents, r.tokens) for r in rollup_of_table(table, BYTE_BPE, "bpe").collect()}
    assert totals["words"] == (4, 7)
    texts = ["one two", "three", "five six seven", "eight"]
    assert totals["bpe"] == (4, sum(len(token_ids(BYTE_BPE, t)) for t in texts))
