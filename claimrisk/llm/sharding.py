"""Placement of documents on shards by a permutation-filled lookup table.

Every shard has a preference order over the slots of a table of prime size; the shards take turns claiming
their next free slot. A key's slot gives its shard. The table is small and broadcast, so a placement
takes constant time; when a shard joins or leaves, few keys move.
"""

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARDS = 64
TABLE_SIZE = 6553
# Slots of a table, at most: its broadcast stays within a few megabytes.
LARGEST_TABLE = 1 << 20
HEX_DIGITS = 15


def _number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:HEX_DIGITS], 16)


def is_prime(n):
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def fill_table(shards, size=TABLE_SIZE):
    """The shard (its place in ``shards``) of each slot; slots of two shards differ by one at most."""
    if not shards or not is_prime(size) or not len(shards) <= size <= LARGEST_TABLE:
        raise ValueError("the size must be a prime, at least the number of shards and not too large")
    offsets = [_number(f"{name}/offset") % size for name in shards]
    skips = [_number(f"{name}/skip") % (size - 1) + 1 for name in shards]
    table, steps, claimed = [None] * size, [0] * len(shards), 0
    while True:
        for shard, (offset, skip) in enumerate(zip(offsets, skips)):
            slot = (offset + steps[shard] * skip) % size
            while table[slot] is not None:
                steps[shard] += 1
                slot = (offset + steps[shard] * skip) % size
            table[slot] = shard
            steps[shard] += 1
            claimed += 1
            if claimed == size:
                return table


def lookup_table(spark, shards, size=TABLE_SIZE) -> DataFrame:
    """``slot, shard`` as a frame of ``size`` rows."""
    table = ",".join(map(str, fill_table(shards, size)))
    return spark.range(1).select(F.posexplode(F.split(F.lit(table), ",")).alias("slot", "shard")).select(
        F.col("slot").cast("long").alias("slot"), F.col("shard").cast("int").alias("shard"))


def slot_of(key, size=TABLE_SIZE):
    """Slot of a key, from its text; a NULL key counts as an empty text."""
    text = F.coalesce(key.cast("string"), F.lit("")).cast("binary")
    return F.conv(F.substring(F.md5(text), 1, HEX_DIGITS), 16, 10).cast("long") % size


def place(rows: DataFrame, shards, key="doc_id", size=TABLE_SIZE) -> DataFrame:
    """``rows`` with ``slot`` and ``shard``; columns of these names are replaced.

    Equal keys, repeated rows among them, get the same shard; a NULL key has the place of an empty text. An empty table gives
    no rows. Other columns, whatever their names and NULLs, stay as they are and in order.
    """
    table = F.broadcast(lookup_table(rows.sparkSession, shards, size).withColumnsRenamed(
        {"slot": "__slot", "shard": "__shard"}))
    kept = rows.drop(*{"slot", "shard"}.intersection(rows.columns) - {key})
    placed = kept.withColumn("__at", slot_of(kept[key], size)).join(table, F.col("__at") == F.col("__slot"))
    return placed.withColumns({"slot": F.col("__slot"), "shard": F.col("__shard")}).drop(
        "__at", "__slot", "__shard")


def shard_names(count=SHARDS):
    return [f"shard-{i:04d}" for i in range(count)]


def write_shards(rows: DataFrame, path, shards, key="doc_id", size=TABLE_SIZE, files_per_shard=8):
    """Write a folder per shard; each shard's rows go to ``files_per_shard`` tasks, so none holds a whole shard."""
    placed = place(rows, shards, key, size)
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(files_per_shard))
    placed.repartition(len(shards) * files_per_shard, "shard", salt).write.partitionBy("shard").parquet(path)


def oracle_sql(shards=SHARDS, size=TABLE_SIZE):
    """The same placement as DuckDB SQL: a recursion fills the table, one turn a step."""
    number = "('0x' || substr(md5({}), 1, %d))::BIGINT" % HEX_DIGITS
    return f"""
WITH RECURSIVE shard AS (
  SELECT i, 'shard-' || lpad(i::VARCHAR, 4, '0') AS name FROM range({shards}) t(i)),
preference AS (
  SELECT list({number.format("name || '/offset'")} % {size} ORDER BY i) AS offsets,
         list({number.format("name || '/skip'")} % {size - 1} + 1 ORDER BY i) AS skips FROM shard),
turn(n, slot, steps, taken) AS (
  SELECT 0::BIGINT, NULL::BIGINT, list_transform(range({shards}), lambda x: 0::BIGINT),
         list_transform(range({size}), lambda x: false)
  UNION ALL
  SELECT n + 1, (offsets[s + 1] + step * skips[s + 1]) % {size},
         list_transform(steps, lambda x, i: CASE WHEN i = s + 1 THEN step + 1 ELSE x END),
         list_transform(taken, lambda x, i: x OR i = (offsets[s + 1] + step * skips[s + 1]) % {size} + 1)
  FROM (
    SELECT n, s, steps, taken, offsets, skips, list_filter(range(steps[s + 1], {size}),
             lambda j: NOT taken[(offsets[s + 1] + j * skips[s + 1]) % {size} + 1])[1] AS step
    FROM (SELECT *, n % {shards} AS s FROM turn, preference WHERE n < {size}))),
filled AS (SELECT slot, ((n - 1) % {shards})::INTEGER AS shard FROM turn WHERE slot IS NOT NULL)
SELECT d.doc_id, f.slot, f.shard FROM documents d
JOIN filled f ON f.slot = {number.format("coalesce(d.doc_id::VARCHAR, '')")} % {size}"""
