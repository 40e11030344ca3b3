"""A training corpus from raw documents: each stage reads what its predecessor wrote.

The stages keep the columns of ``documents``, the last one returns the packed pieces.
"""

from claimrisk.llm import lang_crf, packing, quality, simhash
from claimrisk.llm.queries import BYTE_BPE, documents
from claimrisk.session import store


def language_id(spark, docs, sf_dir):
    """Documents whose language is not undetermined: texts without letters go."""
    return lang_crf.keep_identified(docs)


def quality_rules(spark, docs, sf_dir):
    """Documents that pass the base rules and are good by the posterior of all rules' votes."""
    return quality.keep_good(docs)


def near_dedup(spark, docs, sf_dir):
    """One document of each group of near-duplicates: the one with the smallest id."""
    return simhash.one_of_each(docs, shingle=4, distance=4)


def pack(spark, docs, sf_dir):
    """The kept documents as pieces in sequences of 1024 tokens."""
    return packing.pack(docs, BYTE_BPE)


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("pack", pack),
]

# Learned decisions, fingerprints and tokenizers have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir))
    return docs
