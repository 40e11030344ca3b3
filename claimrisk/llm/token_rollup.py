"""Token counts by source, language and tokenizer version, kept up to date by signed deltas.

A batch of changes (insert, revise, delete) becomes signed rows: what a document counted before is taken
off, what it counts now is added. Only the sums of these rows are kept for the totals, one small folder per
batch. A folder is written whole or not at all and named by its batch, so a batch that is committed again
changes nothing, and one that broke off is written anew. What each document counts is kept in a ledger, dealt to buckets by a hash of
the id: a batch reads only the buckets of its documents.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimrisk.llm.packing import token_ids
from claimrisk.llm.texts import map_texts
from claimrisk.operators.lookup_join import lookup_join
from claimrisk.session import file_system, scratch_dir, store

KEY = ["doc_id", "tokenizer_version"]
GROUP = ["source", "lang", "tokenizer_version"]
CHANGES = "op string, doc_id long, source string, lang string, tokenizer_version string, tokens long"
# Buckets of the ledger; part of the stored layout.
BUCKETS = 64
ENTRY = "struct<batch:bigint,live:boolean,source:string,lang:string,tokens:bigint>"
LEDGER = f"doc_id long, tokenizer_version string, entry {ENTRY}"


class TokenRollup:
    """Totals and ledger under ``path``, a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _folder(self, kind, batch):
        return f"{self.path}/{kind}/batch={batch}"

    def committed(self):
        """Batches with written totals, in order; the totals are the last thing that a commit writes."""
        system, place = file_system(self.spark, f"{self.path}/totals")
        if not system.exists(place):
            return []
        names = [status.getPath().getName() for status in system.listStatus(place)]
        done = [int(n.removeprefix("batch=")) for n in names if n.startswith("batch=")]
        return sorted(b for b in done if system.exists(
            file_system(self.spark, f"{self._folder('totals', b)}/_SUCCESS")[1]))

    def _ledger(self, before, buckets):
        """Latest entry of each document and tokenizer version of ``buckets`` in batches before ``before``."""
        folders = [f"{self._folder('ledger', b)}/bucket={n}" for b in self.committed() if b < before for n in buckets]
        folders = [f for f in folders if file_system(self.spark, f)[0].exists(file_system(self.spark, f)[1])]
        if not folders:
            return None
        rows = self.spark.read.schema(LEDGER).parquet(*folders)
        return rows.groupBy(*KEY).agg(F.max("entry").alias("old"))

    def commit(self, batch: int, changes: DataFrame) -> bool:
        """Apply ``changes`` (columns of CHANGES) as ``batch``; False if it was committed before.

        Batch numbers ascend. A document counts once per tokenizer version: an insert of a known one revises it, and
        deleting or revising an unknown one deletes nothing or inserts. Of several changes of a document
        in one batch the largest (by operation, then values) counts, so a repeated row changes nothing. Rows without
        an id are one document. NULL tokens count zero; NULL sources and languages are groups of their own.
        """
        done = self.committed()
        if batch in done:
            return False
        if done and batch < done[-1]:
            raise ValueError(f"batch {batch} comes after batch {done[-1]}")
        live = F.col("op") != "delete"
        entry = F.struct(
            F.lit(batch).cast("long").alias("batch"), live.alias("live"), "source", "lang",
            F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"))
        news = changes.filter(F.col("op").isin("insert", "revise", "delete")).groupBy(*KEY).agg(
            F.max(F.struct("op", entry.alias("entry")))["entry"].alias("entry"))
        bucket = F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)).cast("int").alias("bucket")
        news = store(news.select("*", bucket))
        buckets = sorted(r.bucket for r in news.select("bucket").distinct().collect())
        ledger = self._ledger(batch, buckets)
        if ledger is None:
            signed = news.withColumn("old", F.lit(None).cast(ENTRY))
        else:
            old = ledger.withColumnsRenamed({k: f"old_{k}" for k in KEY})
            same = news["doc_id"].eqNullSafe(old["old_doc_id"]) & news["tokenizer_version"].eqNullSafe(
                old["old_tokenizer_version"])
            signed = news.join(old, same, "left").drop(*[f"old_{k}" for k in KEY])
        signed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(self._folder("ledger", batch))
        written = self.spark.read.schema(f"{LEDGER}, old {ENTRY}").parquet(self._folder("ledger", batch))
        moves = F.array(F.struct(F.lit(-1).alias("sign"), F.col("old").alias("e")),
                        F.struct(F.lit(1).alias("sign"), F.col("entry").alias("e")))
        deltas = written.select("tokenizer_version", F.explode(moves).alias("m")).filter("m.e.live").groupBy(
            F.col("m.e.source").alias("source"), F.col("m.e.lang").alias("lang"), "tokenizer_version").agg(
            F.sum("m.sign").alias("documents"), F.sum(F.col("m.sign") * F.col("m.e.tokens")).alias("tokens"))
        deltas.write.mode("overwrite").parquet(self._folder("totals", batch))
        return True

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer_version, documents, tokens`` after all batches; empty groups are left out."""
        batches = self.committed()
        schema = T.StructType.fromDDL(
            "source string, lang string, tokenizer_version string, documents long, tokens long")
        rows = (self.spark.read.schema(schema).parquet(*[self._folder("totals", b) for b in batches])
                if batches else self.spark.createDataFrame([], schema))
        return rows.groupBy(*GROUP).agg(
            F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")).filter("documents <> 0")


def bpe_counts(docs: DataFrame, tokenizer, keep=("doc_id", "source", "lang")) -> DataFrame:
    """Columns ``keep`` and ``tokens``, the number of ids by a byte-level BPE file; NULL texts have none."""
    def kernel():
        return lambda texts: {"tokens": [len(token_ids(tokenizer, t.decode("utf-8", "replace"))) if t else 0 for t in texts]}
    return map_texts(docs, kernel, "tokens long", keep)


def rollup_of_table(docs: DataFrame, tokenizer, version: str) -> DataFrame:
    """Totals of ``docs`` through three batches: all are inserted with their numbers of words, as ``words``, and of
    tokens, as ``version``; exact copies of a text are deleted but for one; and documents with words that have
    neither letter nor digit are revised to their number of other words. Every row is a document, also without an id
    or with that of another, so the rollup's ids are numbers of rows. Copies are told by SHA-256; of copies the smallest
    by id, source and language stays, those without an id last."""
    spark = docs.sparkSession
    rollup = TokenRollup(spark, f"{scratch_dir(spark)}/rollup-{uuid.uuid4().hex}")
    system, place = file_system(spark, rollup.path)
    system.deleteOnExit(place)
    words = F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+")
    n_words = F.size(F.filter(words, lambda w: w != "")).cast("long")
    spoken = F.size(F.filter(words, lambda w: w.rlike(r"[\p{L}\p{N}]"))).cast("long")
    counted = store(bpe_counts(docs.select(
        F.monotonically_increasing_id().alias("doc_id"), F.col("doc_id").alias("id"), "source", "lang", "text",
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("hash"), n_words.alias("n_words"), spoken.alias("n_spoken")), tokenizer,
        ("doc_id", "id", "source", "lang", "hash", "n_words", "n_spoken")))

    def changes(rows, op, name, tokens):
        return rows.select(F.lit(op).alias("op"), "doc_id", "source", "lang", F.lit(name).alias(
            "tokenizer_version"), F.col(tokens).alias("tokens"))

    def both(rows, op):
        return changes(rows, op, "words", "n_words").unionByName(changes(rows, op, version, "tokens"))

    rollup.commit(1, both(counted, "insert"))
    order = F.struct(F.col("id").isNull(), "id", "source", "lang", "doc_id")
    first = counted.groupBy("hash").agg(F.min(order)["doc_id"].alias("first"), F.count("*").alias("copies"))
    # A text may have very many copies, so they are not gathered by it.
    copies = store(lookup_join(counted, first.filter("copies > 1"), ["hash"], rows="copies").filter(
        "doc_id <> first").select("doc_id", "source", "lang", "n_words", "tokens"))
    rollup.commit(2, both(copies, "delete"))
    kept = counted.join(copies.select("doc_id"), "doc_id", "left_anti")
    rollup.commit(3, changes(kept.filter("n_spoken <> n_words"), "revise", "words", "n_spoken"))
    return rollup.totals()
