"""Claims without duplicates, kept part by part: a late part is compared with what earlier parts hold of its keys alone.

Each part stores its claims and, dealt to buckets by a hash, the keys of their grain. A late part reads the keys of the buckets that its
own keys fall in, and whole claims only for keys that are there already. Which of two claims stays is decided as in
``operators.dedupe.keep_first``; a claim of an earlier part that loses is named in a small table, its part is not rewritten.
"""

from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimrisk.operators.dedupe import keep_first
from claimrisk.operators.lookup_join import fits_broadcast, null_safe_join
from claimrisk.schemas import CLAIM_GRAIN
from claimrisk.session import drop_stored, file_system, materialise_measured, store

# Buckets of the keys; part of the stored layout.
BUCKETS = 64
# Claims stay for long, so they are stored small.
CODEC = "zstd"


class DedupedClaims:
    """Parts under ``path``, a folder that driver and executors share. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, grain=CLAIM_GRAIN):
        self.spark, self.path, self.grain = spark, path, list(grain)

    def _folder(self, kind, name):
        return f"{self.path}/{kind}/{quote(name, safe='')}"

    def parts(self) -> list:
        """Names of the parts that are in, in order; a part's claims are the last thing that is written of it."""
        system, place = file_system(self.spark, f"{self.path}/claims")
        if not system.exists(place):
            return []
        names = [unquote(status.getPath().getName()) for status in system.listStatus(place)]
        return sorted(n for n in names if system.exists(file_system(self.spark, f"{self._folder('claims', n)}/_SUCCESS")[1]))

    def _read(self, kind, folders, schema=None) -> DataFrame:
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(*[f"{self.path}/{kind}/{folder}" for folder in folders])

    def _superseded(self) -> DataFrame:
        """``grain, part``: keys whose claim in that part gave way to one of a later part."""
        return self._read("superseded", [quote(n, safe="") for n in self.parts()])

    def _held(self, new: DataFrame) -> DataFrame:
        """``grain, part`` of the keys of ``new`` that earlier parts hold, from the buckets that they fall in."""
        key_schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new.select(*self.grain).schema)}, part string"
        buckets = sorted(r.bucket for r in new.select("bucket").distinct().collect())
        folders = [f"{quote(n, safe='')}/bucket={b}" for n in self.parts() for b in buckets]
        folders = [f for f in folders if file_system(self.spark, f"{self.path}/keys/{f}")[0].exists(
            file_system(self.spark, f"{self.path}/keys/{f}")[1])]
        if not folders:
            return self.spark.createDataFrame([], key_schema)
        keys = null_safe_join(self._read("keys", folders, key_schema), new.select(*self.grain), self.grain, "left_semi")
        return null_safe_join(keys, self._superseded(), [*self.grain, "part"], "left_anti")

    def add_part(self, name: str, claims: DataFrame, stored=False) -> bool:
        """Add the clean claims of a part; False if a part of that name is in already. ``claims`` is read once, to make a columnar
        copy; with ``stored`` it is such a table already, and no claim is written but once, to the part.
        """
        if name in self.parts():
            return False
        raw = claims if stored else store(claims)
        bucket = F.pmod(F.xxhash64(*self.grain), F.lit(BUCKETS)).cast("int").alias("bucket")
        new = keep_first(raw, self.grain).select("*", bucket)
        held, size = materialise_measured(self._held(new))
        kept, lost = new, held.limit(0)
        if size.rows:
            small = F.broadcast(held) if fits_broadcast(size) else held
            rest = [c for c in claims.columns if c not in self.grain]
            before = [null_safe_join(self._read("claims", [quote(part, safe="")], claims.schema),
                                     small.filter(F.col("part") == part).drop("part"), self.grain, "left_semi").select(
                *self.grain, F.struct(*rest).alias("old"), F.lit(part).alias("part"))
                for part in sorted(r.part for r in held.select("part").distinct().collect())]
            old = before[0]
            for frame in before[1:]:
                old = old.unionByName(frame)
            both = null_safe_join(old, null_safe_join(new, small.drop("part"), self.grain, "left_semi").select(
                *self.grain, F.struct(*rest).alias("new")), self.grain)
            judged = store(both.select(*self.grain, "part", (F.col("new") < F.col("old")).alias("gives_way")))
            lost = judged.filter("gives_way").drop("gives_way")
            stays = judged.filter("NOT gives_way").select(*self.grain)
            kept = null_safe_join(new, F.broadcast(stays) if fits_broadcast(size) else stays, self.grain, "left_anti")
        lost.write.mode("overwrite").parquet(self._folder("superseded", name))
        kept.select(*self.grain, F.lit(name).alias("part"), "bucket").repartition("bucket").write.mode(
            "overwrite").partitionBy("bucket").parquet(self._folder("keys", name), compression=CODEC)
        kept.drop("bucket").write.mode("overwrite").parquet(self._folder("claims", name), compression=CODEC)
        if not stored:
            drop_stored(raw)
        return True

    def table(self) -> DataFrame | None:
        """The claims of all parts, one per key; None before the first part."""
        names = self.parts()
        if not names:
            return None
        lost, size = materialise_measured(self._superseded())
        lost = F.broadcast(lost) if fits_broadcast(size) else lost
        frames = [null_safe_join(self._read("claims", [quote(name, safe="")]), lost.filter(F.col("part") == name).drop("part"),
                                 self.grain, "left_anti") for name in names]
        out = frames[0]
        for frame in frames[1:]:
            out = out.unionByName(frame)
        return out
