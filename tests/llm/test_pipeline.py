"""The corpus pipeline: each stage on what its predecessor kept, held against slow forms of its decisions."""

import re

import corpus_pipeline
import pytest
from llm.test_packing import check_packed
from llm.test_quality import slow as slow_measures
from llm.test_simhash import slow_components, slow_fingerprint

from claimrisk.llm.queries import BYTE_BPE, documents
from claimrisk.session import store


@pytest.fixture(scope="module")
def stages(spark):
    """(input, output) of each stage."""
    folder, docs, out = "/root/testdata/sf0.001", None, {}
    docs = documents(spark, folder)
    for name, stage in corpus_pipeline.STAGES:
        result = store(stage(spark, docs, folder))
        out[name] = docs, result
        docs = result
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_names_and_columns(stages, spark):
    assert list(stages) == ["language_id", "quality_rules", "near_dedup", "pack"]
    columns = documents(spark, "/root/testdata/sf0.001").columns
    for name in list(stages)[:-1]:
        before, after = (rows(df) for df in stages[name])
        assert stages[name][1].columns == columns
        assert all(before[i] == row for i, row in after.items())


def test_language_stage_keeps_texts_with_letters(stages):
    before, after = (rows(df) for df in stages["language_id"])
    assert {i for i, r in before.items() if re.search(r"[^\W\d_]", r.text or "")} == set(after)


def test_quality_stage(stages, spark):
    before, after = (rows(df) for df in stages["quality_rules"])
    for i, r in before.items():
        n_words, _, _, _, repeats = slow_measures(r.text)
        if n_words < 50 or 100 * repeats > 50 * n_words:
            assert i not in after
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()}
    judged = [i for i in before if i in labels and slow_measures(before[i].text)[0] >= 50
              and 2 * slow_measures(before[i].text)[4] <= slow_measures(before[i].text)[0]]
    assert all((i in after) == (labels[i] == 1) for i in judged)


def test_near_dedup_stage(stages):
    before, after = (rows(df) for df in stages["near_dedup"])
    ids = sorted(before)
    components = slow_components([slow_fingerprint(before[i].text) for i in ids])
    assert set(after) == {ids[c] for c in components}


def test_pack_stage(stages):
    from tokenizers import Tokenizer

    before, packed = stages["pack"]
    used, total = check_packed(packed, {i: r.text for i, r in rows(before).items()}, Tokenizer.from_file(BYTE_BPE))
    assert used <= -(-total // 1024) + 1


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    found = corpus_pipeline.run(spark, sf_dir)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    key = lambda df: sorted(map(tuple, df.select(columns).collect()))
    assert key(found) == key(stages["pack"][1])


def test_stages_on_odd_rows(spark, odd, clashing, empty):
    for table in (odd, clashing, empty):
        docs = table
        for name, stage in corpus_pipeline.STAGES:
            docs = store(stage(spark, docs, "/root/testdata/sf0.001"))
            assert name == "pack" or docs.columns == table.columns
