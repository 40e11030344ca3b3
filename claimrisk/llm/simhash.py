"""Near-duplicates by SimHash: fingerprints linked by a Gray-order hierarchical index.

Distinct fingerprints are dealt to buckets by their equal blocks: of ``distance + 2`` blocks, two at
least agree whenever no more than ``distance`` bits differ. In a bucket they are sorted by the rank of
their Gray code, so that neighbours share long bit patterns. Runs of neighbours make the nodes of a tree;
a node holds the bits that all below it share and its parent doesn't. A search adds up the differing
bits on its way down and leaves a whole group as soon as they exceed the distance.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimrisk.llm.components import connected_components
from claimrisk.llm.texts import map_texts, quoted
from claimrisk.operators.lookup_join import lookup_join
from claimrisk.session import store

SEED = 42
FANOUT = 8
# Query rows that search the index together; bounds the memory of a search.
QUERY_BLOCK = 1024
# Rows of a bucket that one unit of work takes from each of its two sides.
CHUNK_ROWS = 4096
# Rows of a sorted stream that are indexed together (more only to complete a bucket).
STREAM_ROWS = 100_000


def fingerprints_of(texts, shingle=4):
    """SimHash of each text (bytes or None) as unsigned 64-bit numbers."""
    out = np.zeros(len(texts), np.uint64)
    hashes, rows, sizes = [], [], []
    digest = xxhash.xxh64_intdigest
    for row, text in enumerate(texts):
        words = (text or b"").lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        if len(words) <= shingle:
            hashes.append(digest(joined, SEED))
            sizes.append(1)
        else:
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(lengths + 1) - 1
            starts = (ends - lengths)[:len(words) - shingle + 1].tolist()
            hashes += [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())]
            sizes.append(len(starts))
        rows.append(row)
    if rows:
        sizes = np.array(sizes)
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(octets, axis=1, bitorder="little")
        ones = np.add.reduceat(bits, np.cumsum(sizes) - sizes, axis=0, dtype=np.int64)
        majority = np.packbits(2 * ones > sizes[:, None], axis=1, bitorder="little")
        out[rows] = np.ascontiguousarray(majority).view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle=4) -> DataFrame:
    """``doc_id, fp``: fp is the fingerprint as a signed long. A text without words, or NULL, has 0."""
    def kernel():
        return lambda texts: {"fp": fingerprints_of(texts, shingle).view(np.int64)}
    return map_texts(docs, kernel, "fp long")


def gray_rank(codes):
    """Rank of 64-bit codes in Gray order: successive ranks differ in one bit."""
    rank = codes.copy()
    for step in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(step)
    return rank


def block_masks(distance):
    """Masks of ``distance + 2`` near-equal blocks of the 64 bits."""
    cuts = [64 * i // (distance + 2) for i in range(distance + 3)]
    return [np.uint64(((1 << b) - 1) ^ ((1 << a) - 1)) for a, b in zip(cuts, cuts[1:])]


def _bucket_rows(distinct: DataFrame, distance: int) -> DataFrame:
    """One row per fingerprint and pair of blocks: ``pair, key`` name the bucket, ``rank`` orders it."""
    masks = block_masks(distance)
    pairs = [a | b for i, a in enumerate(masks) for b in masks[i + 1:]]

    def run(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            codes = fp.view(np.uint64)
            # The sign bit is flipped so that signed order is the unsigned order of the ranks.
            rank = (gray_rank(codes) ^ np.uint64(1 << 63)).view(np.int64)
            for i, mask in enumerate(pairs):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(fp), i, np.int32)), pa.array((codes & mask).view(np.int64)),
                     pa.array(rank), batch.column(0), batch.column(1)],
                    names=["pair", "key", "rank", "fp", "node"])

    return distinct.select("fp", "node").mapInArrow(
        run, "pair int, key long, rank long, fp long, node long")


class GrayIndex:
    """Hierarchical index over fingerprints that are sorted by bucket, then by Gray rank."""

    def __init__(self, codes, bucket, fanout=FANOUT):
        self.codes, self.bucket = codes, bucket
        everything = np.uint64(0xFFFFFFFFFFFFFFFF)
        # From the leaves up; a node: shared bits, their pattern, first child, rows it ends before.
        level = {"mask": np.full(len(codes), everything), "pattern": codes, "bucket": bucket,
                 "end": np.arange(1, len(codes) + 1), "start": np.arange(len(codes))}
        self.levels = [level]
        while len(level["bucket"]) > len(np.unique(level["bucket"])):
            _, first, size = np.unique(level["bucket"], return_index=True, return_counts=True)
            place = np.arange(len(level["bucket"])) - np.repeat(first, size)
            heads = np.flatnonzero(place % fanout == 0)
            stop = np.append(heads[1:], len(place))
            both = np.bitwise_and.reduceat(level["pattern"], heads)
            either = np.bitwise_or.reduceat(level["pattern"], heads)
            mask = np.bitwise_and.reduceat(level["mask"], heads) & ~(both ^ either)
            level = {"mask": mask, "pattern": both & mask, "bucket": level["bucket"][heads],
                     "child": heads, "child_stop": stop, "start": level["start"][heads],
                     "end": level["end"][stop - 1]}
            self.levels.append(level)
        # A child keeps only the shared bits that its parent doesn't have.
        for upper, lower in zip(self.levels[1:], self.levels):
            above = np.repeat(upper["mask"], upper["child_stop"] - upper["child"])
            lower["rest"] = lower["mask"] & ~above
        self.levels[-1]["rest"] = self.levels[-1]["mask"]
        self.roots = np.searchsorted(self.levels[-1]["bucket"], bucket)

    def search(self, queries, distance, labels):
        """Pairs (query row, later row) of a bucket within ``distance``.

        Nodes whose rows all have the query's label already are skipped: they are linked to it.
        """
        query, node = queries, self.roots[queries]
        differing = np.zeros(len(queries), np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            level = self.levels[depth]
            differing = differing + np.bitwise_count(
                (self.codes[query] ^ level["pattern"][node]) & level["rest"][node])
            low, high = labels[depth]
            keep = ((differing <= distance) & (level["end"][node] > query + 1)
                    & ~((low[node] == labels[0][0][query]) & (high[node] == labels[0][0][query])))
            query, node, differing = query[keep], node[keep], differing[keep]
            if depth:
                size = level["child_stop"][node] - level["child"][node]
                before = np.cumsum(size) - size
                node = np.repeat(level["child"][node] - before, size) + np.arange(size.sum())
                query, differing = np.repeat(query, size), np.repeat(differing, size)
        later = node > query
        return query[later], node[later]

    def label_ranges(self, labels):
        """Smallest and largest label below each node, by level."""
        ranges = [(labels, labels)]
        for level in self.levels[1:]:
            low, high = ranges[-1]
            ranges.append((np.minimum.reduceat(low, level["child"]),
                           np.maximum.reduceat(high, level["child"])))
        return ranges


def _merge(labels, left, right):
    """Labels of rows after linking ``left`` with ``right``: the smallest row number of a component."""
    while True:
        a, b = labels[left], labels[right]
        apart = a != b
        if not apart.any():
            return labels
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels = up


def forest(codes, bucket, distance):
    """Row numbers (first row of a component, other row): links that connect each bucket's components."""
    labels = np.arange(len(codes))
    near = np.arange(len(codes) - 1)
    for gap in (1, 2):  # neighbours in Gray order mostly link; what is linked needs no search
        left = near[:len(codes) - gap]
        left = left[bucket[left] == bucket[left + gap]]
        left = left[np.bitwise_count(codes[left] ^ codes[left + gap]) <= distance]
        labels = _merge(labels, left, left + gap)
    index = GrayIndex(codes, bucket)
    for first in range(0, len(codes), QUERY_BLOCK):
        queries = np.arange(first, min(first + QUERY_BLOCK, len(codes)))
        labels = _merge(labels, *index.search(queries, distance, index.label_ranges(labels)))
    rows = np.flatnonzero(labels != np.arange(len(codes)))
    return labels[rows], rows


def _whole_buckets(batches):
    """Join Arrow batches of a sorted stream into tables that never cut a bucket in two."""
    names = ["pair", "key", "low", "high"]
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if len(held) < STREAM_ROWS:
            continue
        columns = [held.column(n).to_numpy() for n in names]
        starts = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
        if len(starts):
            yield held.slice(0, starts[-1])
            held = held.slice(starts[-1])
    if held is not None and len(held):
        yield held


def _link_buckets(distance):
    def run(batches):
        for table in _whole_buckets(batches):
            columns = [table.column(n).to_numpy() for n in ("pair", "key", "low", "high")]
            new = np.append(True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns]))
            bucket = np.cumsum(new) - 1
            shared = np.bincount(bucket)[bucket] > 1
            codes = table.column("fp").to_numpy()[shared].view(np.uint64)
            node = table.column("node").to_numpy()[shared]
            if len(codes):
                left, right = forest(codes, np.unique(bucket[shared], return_inverse=True)[1], distance)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[left]), pa.array(node[right])], names=["a", "b"])
    return run


UNIT = ["pair", "key", "low", "high"]


def _linked(units: DataFrame, distance) -> DataFrame:
    """Links inside each unit (UNIT names it); units are dealt by hash and sorted by Gray rank."""
    dealt = units.select(*UNIT, "rank", "fp", "node").repartition(*UNIT).sortWithinPartitions(*UNIT, "rank")
    return dealt.mapInArrow(_link_buckets(distance), "a long, b long")


def links(distinct: DataFrame, distance=4, chunk_rows=CHUNK_ROWS) -> DataFrame:
    """``a, b``: links between the nodes of distinct fingerprints (``fp, node``) that give the same
    components as all pairs within ``distance`` bits.

    A bucket of more than ``chunk_rows`` fingerprints is cut into chunks that are searched by themselves.
    Such a bucket comes from one large group of near copies, so its chunks are then mostly one component, in
    which no more links are needed: only its other rows, in chunks too, meet every chunk. No task holds
    more than two chunks of a bucket, and no link between different components is lost.
    """
    rows = _bucket_rows(distinct, distance)
    large = store(rows.groupBy("pair", "key").agg(F.count("*").alias("size")).filter(
        F.col("size") > chunk_rows))
    if large.isEmpty():
        return _linked(rows.withColumns({"low": F.lit(0), "high": F.lit(0)}), distance)
    rows = lookup_join(rows, large, ["pair", "key"])
    chunks = F.ceil(F.coalesce("size", F.lit(1)) / chunk_rows).cast("int")
    rows = rows.withColumns({"chunks": chunks, "own": F.pmod(F.xxhash64("fp"), chunks).cast("int")})
    inner = store(_linked(rows.withColumns({"low": F.col("own"), "high": F.col("own")}), distance))
    return inner.unionByName(_links_between_chunks(
        rows.filter("chunks > 1"), connected_components(inner), distance, chunk_rows))


def _links_between_chunks(rows, labels, distance, chunk_rows):
    """Links of the rows of large buckets that are not in their bucket's largest component so far."""
    bucket = ["pair", "key"]
    labelled = store(rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
    sizes = labelled.groupBy(*bucket, "label").agg(F.count("*").alias("n"))
    main = sizes.groupBy(*bucket).agg(
        F.max_by("label", F.struct("n", "label")).alias("main"), (F.sum("n") - F.max("n")).alias("others"))
    rows = lookup_join(labelled, main, bucket)
    parts = F.ceil(F.col("others") / chunk_rows).cast("int")
    met = rows.filter("others > 0").withColumn("parts", parts)
    part = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("parts")).cast("int")
    everyone = met.withColumns({
        "low": F.col("own"), "high": F.explode(F.sequence(F.lit(0), F.col("parts") - 1))})
    others = met.filter(F.col("label") != F.col("main")).withColumns({
        "low": F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)), "high": part})
    columns = [*UNIT, "rank", "fp", "node"]
    return _linked(everyone.select(columns).unionByName(others.select(columns)), distance)


def _components(marked: DataFrame, distance, chunk_rows=CHUNK_ROWS) -> DataFrame:
    """``fp, component, id, rows`` for each fingerprint of ``marked`` (``doc_id, fp``): ``id`` is its smallest doc_id.

    The nodes are the fingerprints themselves, those of rows without an id too: they link others, and unlike texts that
    repeat an id don't link by it.
    """
    distinct = store(marked.groupBy("fp").agg(F.min("doc_id").alias("id"), F.count("*").alias("rows")))
    labels = connected_components(links(distinct.select("fp", F.col("fp").alias("node")), distance, chunk_rows))
    return store(distinct.join(labels, distinct["fp"] == labels["node"], "left").select(
        "fp", F.coalesce("label", "fp").alias("component"), "id", "rows"))


def near_duplicates(docs: DataFrame, shingle=4, distance=4, chunk_rows=CHUNK_ROWS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    Fingerprints link at ``distance`` or fewer differing bits; a component's id is the smallest doc_id
    in it. Texts without words (NULL, empty, white space) have fingerprint zero and link like any other.
    Repeated rows are kept, each with the same component; rows that repeat an id with another text have the component of
    their own fingerprint. A row without an id links like any other and has the id of its component, NULL if no row
    there has one. An empty table gives an empty result. Other columns are ignored.
    """
    marked = store(fingerprints(docs, shingle))
    nodes = _components(marked, distance, chunk_rows)
    smallest = nodes.groupBy("component").agg(F.min("id").alias("component_id"), F.count("*").alias("members"))
    of_fp = lookup_join(nodes, smallest, ["component"], rows="members").select("fp", "component_id", "rows")
    return lookup_join(marked, of_fp, ["fp"], rows="rows").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _representatives(marked: DataFrame, distance) -> DataFrame:
    """``kept_id, kept_fp`` of each component: its smallest doc_id and the smallest fingerprint with that id; without
    any id, its smallest fingerprint."""
    return _components(marked, distance).groupBy("component").agg(
        F.min("id").alias("kept_id"), F.min_by("fp", F.struct(F.col("id").isNull(), "id", "fp")).alias("kept_fp")
    ).drop("component")


def one_of_each(docs: DataFrame, shingle=4, distance=4) -> DataFrame:
    """One row of ``docs`` for each component: that with its smallest doc_id.

    Of rows that repeat an id, those with unlike texts are documents of their own; of those with one fingerprint
    the smallest row by all columns stays. Of a component without any id the smallest row of its smallest fingerprint stays.
    Maps are compared by their JSON text. Empty tables give empty results; columns stay as they are, whatever their names.
    The ids to keep grow with the table, so they are never broadcast: texts meet them in a shuffled hash
    join, which does not sort the texts.
    """
    marked = store(fingerprints(docs, shingle))
    kept = store(_representatives(marked, distance))
    named = kept.filter("kept_id is not null")
    rows = docs.join(named.hint("shuffle_hash"), docs["doc_id"] == named["kept_id"], "left_semi")
    repeated = store(marked.filter("doc_id is not null").groupBy(F.col("doc_id").alias("repeated_id")).count().filter(
        "count > 1").select("repeated_id"))
    if not repeated.isEmpty():
        single = rows.join(repeated, rows["doc_id"] == repeated["repeated_id"], "left_anti")
        several = rows.join(repeated, rows["doc_id"] == repeated["repeated_id"], "left_semi")
        rows = single.unionByName(_one_per_fingerprint(several, named, shingle))
    if not kept.filter("kept_id is null").isEmpty():
        rows = rows.unionByName(_one_per_fingerprint(
            docs.filter("doc_id is null"), kept.filter("kept_id is null"), shingle))
    return rows


def _one_per_fingerprint(docs, kept, shingle):
    """The smallest of the rows of ``docs`` with each id (or none) and fingerprint of ``kept``."""
    columns = docs.columns

    def kernel():
        return lambda texts: {"__fp": fingerprints_of(texts, shingle).view(np.int64)}
    marked = map_texts(docs, kernel, "`__fp` long", columns)
    marked = marked.join(
        kept, marked["doc_id"].eqNullSafe(kept["kept_id"]) & (marked["__fp"] == kept["kept_fp"]), "left_semi")
    order = [F.to_json(F.struct(quoted(f.name))) if "map" in f.dataType.simpleString() else quoted(f.name)
             for f in docs.schema]
    whole = F.struct(*map(quoted, columns))
    return marked.groupBy(F.col("doc_id").alias("__id"), "__fp").agg(
        F.min_by(whole, F.struct(*order)).alias("__row")).select("__row.*")
