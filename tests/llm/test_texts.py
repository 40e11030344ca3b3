"""Texts with bytes that are not valid UTF-8 count as texts with U+FFFD in these places."""

import pytest
from llm.conftest import rows_of
from pyspark.sql import functions as F

from claimrisk.llm import bpe_cuts, packing, token_rollup
from claimrisk.llm.queries import BYTE_BPE, WORD_BPE


@pytest.fixture
def pair(docs):
    table = docs(["some words here", "x"])
    broken = F.expr("cast(concat(cast(text AS binary), X'20FF41C3') AS string)")
    replaced = F.concat("text", F.lit(" \ufffdA\ufffd"))
    return table.withColumn("text", broken), table.withColumn("text", replaced)


@pytest.mark.parametrize("operator", [
    lambda t: packing.pack(t, BYTE_BPE).select("doc_id", "piece", "length", "ids_crc32"),
    lambda t: bpe_cuts.encode(t, WORD_BPE), lambda t: token_rollup.bpe_counts(t, BYTE_BPE)])
def test_broken_bytes(pair, operator):
    broken, replaced = pair
    assert rows_of(operator(broken)) == rows_of(operator(replaced))
