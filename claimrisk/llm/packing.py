"""Documents packed into sequences of bounded length: best-fit decreasing with certified bounds.

Pieces are dealt to groups of bounded size and packed by best-fit decreasing. Dual feasible functions
give a lower bound of each group's bins; a group that meets it is certified. Groups with a gap exchange their
pieces and are packed anew. At last the least filled bin of each group is pooled, since a bound of a group is rounded up.
"""

import functools
import json
import zlib

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimrisk.llm.texts import map_texts
from claimrisk.session import store

CAPACITY = 1024
END_OF_DOCUMENT = 2
GROUP_ROWS = 4096
EXCHANGES = 4
# Fixed value: the splitting pattern of byte-level BPE files.
BYTE_LEVEL_PATTERN = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")


def byte_symbols():
    """The character that stands for each byte in the vocabulary files of byte-level BPE."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=4)
def byte_level_encoding(path) -> tiktoken.Encoding:
    """Encoder with the ids of a byte-level BPE file of the tokenizers library; ranks are its ids."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    byte_of = {symbol: byte for byte, symbol in byte_symbols().items()}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    for token in special:
        ranks.pop(token.encode(), None)
    return tiktoken.Encoding(path, pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens=special)


@functools.lru_cache(maxsize=4)
def _slow_tokenizer(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def token_ids(path, text: str):
    """Ids of ``text`` as the tokenizers library gives them, special tokens in it included."""
    try:
        return byte_level_encoding(path).encode_to_numpy(text, allowed_special="all")
    except ValueError:  # runs of very many spaces are too long for the splitting pattern of this encoder
        ids = _slow_tokenizer(path).encode(text, add_special_tokens=False).ids
        return np.array(ids, np.uint32)


def piece_checksums(ids, capacity):
    """CRC32 of each piece: full pieces from the end on, the first one may be shorter."""
    first = (len(ids) - 1) % capacity + 1
    cuts = [0, *range(first, len(ids) + 1, capacity)]
    octets = ids.astype("<u4").tobytes()
    return [zlib.crc32(octets[4 * a:4 * b]) for a, b in zip(cuts, cuts[1:])]


def pieces(docs: DataFrame, tokenizer, capacity=CAPACITY, end_id=END_OF_DOCUMENT) -> DataFrame:
    """``row_id, doc_id, piece, start, length, ids_crc32``; row_id is unique, also for repeated rows.

    ``tokenizer`` is the path of a byte-level BPE file, readable on every machine. NULL is an empty text.
    """
    def kernel():
        def run(texts):
            made = {"n_ids": [], "checksums": []}
            for text in texts:
                ids = np.append(token_ids(tokenizer, (text or b"").decode("utf-8", "replace")), np.uint32(end_id))
                made["n_ids"].append(len(ids))
                made["checksums"].append(piece_checksums(ids, capacity))
            return made
        return run

    counted = map_texts(docs, kernel, "n_ids long, checksums array<long>")
    first = (F.col("n_ids") - 1) % capacity + 1
    cut = counted.select("doc_id", first.alias("first"), F.posexplode("checksums").alias("piece", "ids_crc32"))
    start = F.when(F.col("piece") == 0, 0).otherwise(F.col("first") + (F.col("piece") - 1) * capacity)
    length = F.when(F.col("piece") == 0, F.col("first")).otherwise(capacity)
    return cut.select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", "piece", start.cast("long").alias("start"),
        length.cast("long").alias("length"), "ids_crc32")


def best_fit_decreasing(lengths, capacity):
    """(bin of each item, place in the bin, fill of each bin); bins are filled to ``capacity`` at most."""
    bins, places = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins = [[] for _ in range(capacity + 1)]  # by free room
    rooms = 0  # bit r is set if a bin with room r is open
    fill = []
    for item, size in zip(np.argsort(-lengths, kind="stable").tolist(), np.sort(lengths)[::-1].tolist()):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, chosen = capacity, len(fill)
            fill.append(0)
        bins[item], places[item] = chosen, capacity - room
        fill[chosen] += size
        if room > size:
            open_bins[room - size].append(chosen)
            rooms |= 1 << (room - size)
    return bins, places, np.array(fill, np.int64)


def lower_bound(sizes, counts, capacity):
    """Fewest bins for ``counts`` items of each size, by dual feasible functions, in exact integers.

    A function f on sizes is dual feasible if no set that fits a bin has more than 1 in sum of f; then the
    sum of f over all items, rounded up, bounds the bins. The families are: the size itself; rounding to
    k-ths; sizes cut off below a threshold and above its complement; and the large sizes counted by what they leave room for.
    """
    sizes, counts = np.asarray(sizes, np.int64), np.asarray(counts, np.int64)
    if not counts.sum():
        return 0
    best = -(-int(sizes @ counts) // capacity)
    for k in range(1, 65):
        exact = (k + 1) * sizes % capacity == 0
        value = np.where(exact, k * sizes, (k + 1) * sizes // capacity * capacity)  # times k * capacity
        best = max(best, -(-int(value @ counts) // (k * capacity)))
    for least in np.unique(sizes[2 * sizes <= capacity]):
        value = np.where(sizes > capacity - least, capacity, np.where(sizes < least, 0, sizes))
        best = max(best, -(-int(value @ counts) // capacity))
        parts = int(capacity // least)
        value = np.where(2 * sizes > capacity, parts - (capacity - sizes) // least,
                         np.where(sizes < least, 0, 1))
        best = max(best, -(-int(value @ counts) // parts))
    return best


def _packer(capacity):
    def pack_group(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("row_id")
        lengths = rows["length"].to_numpy()
        bins, places, fill = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(*np.unique(lengths, return_counts=True), capacity)
        tail = bins == (fill.argmin() if len(fill) else -1)
        gap = np.full(len(bins), len(fill) - bound, np.int64)
        for name, values in (("bin", bins), ("offset", places), ("tail", tail), ("gap", gap)):
            rows = rows.append_column(name, pa.array(values))
        return rows
    return pack_group


def _deal(pool: DataFrame, count, turn, capacity, group_rows) -> DataFrame:
    """Pack ``pool`` (``count`` rows) in groups of about ``group_rows``, dealt by a hash of row and turn."""
    groups = max(1, -(-count // group_rows))
    group = F.pmod(F.xxhash64("row_id", F.lit(turn)), groups)
    dealt = pool.select(*PIECE_COLUMNS, (group + turn * (1 << 32)).alias("group")).repartitionByRange(
        groups, "group")
    return store(dealt.groupBy("group").applyInArrow(
        _packer(capacity), f"{PIECE_SCHEMA}, group long, bin long, offset long, tail boolean, gap long"))


PIECE_COLUMNS = ["row_id", "doc_id", "piece", "start", "length", "ids_crc32"]
PIECE_SCHEMA = "row_id long, doc_id long, piece int, start long, length long, ids_crc32 long"


def _bins(packed):
    return packed.filter("offset = 0").count()


def pack_pieces(cut: DataFrame, capacity=CAPACITY, group_rows=GROUP_ROWS, exchanges=EXCHANGES) -> DataFrame:
    """Assign stored ``pieces`` to sequences: adds ``sequence_id`` and ``offset``."""
    # A full piece is a sequence; its id is negative, those of bins are not.
    whole = cut.filter(F.col("length") == capacity).select(
        *PIECE_COLUMNS, (-1 - F.col("row_id")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    small = cut.filter(F.col("length") < capacity)
    result = _deal(small, small.count(), 0, capacity, group_rows)
    for turn in range(1, exchanges + 1):
        result, better = _exchange(result, turn, capacity, group_rows)
        if not better:
            break
    result = _merge_tails(result, exchanges + 1, capacity, group_rows)
    numbered = result.select(
        *PIECE_COLUMNS, (F.col("group") * (1 << 24) + F.col("bin")).alias("sequence_id"), "offset")
    return whole.unionByName(numbered)


def _exchange(result, turn, capacity, group_rows):
    """Pack the groups with a gap anew, their pieces dealt to other groups, if that needs fewer bins."""
    wide = result.filter("gap > 0")
    count = wide.count()
    if not count:
        return result, False
    again = _deal(wide, count, turn, capacity, group_rows)
    if _bins(again) >= _bins(wide):
        return result, False
    return result.filter("gap <= 0").unionByName(again), True


def _merge_tails(result, turn, capacity, group_rows):
    """Pack the least filled bins of all groups together, if that needs fewer bins."""
    tails = result.filter("tail")
    count = tails.count()
    if not count:
        return result
    again = _deal(tails, count, turn, capacity, group_rows)
    return result.filter("not tail").unionByName(again) if _bins(again) < _bins(tails) else result


def certificate(packed: DataFrame, capacity=CAPACITY):
    """(sequences used, lower bound over all pieces); equal numbers prove the packing optimal."""
    used = packed.filter("offset = 0").count()
    sizes = packed.groupBy("length").count().orderBy("length").collect()  # at most ``capacity`` rows
    return used, lower_bound([r["length"] for r in sizes], [r["count"] for r in sizes], capacity)


def pack(docs: DataFrame, tokenizer, capacity=CAPACITY, end_id=END_OF_DOCUMENT,
         group_rows=GROUP_ROWS, exchanges=EXCHANGES) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``, a row per piece.

    Only documents of more than ``capacity`` ids are cut. A NULL or empty text is a piece of the end id alone;
    repeated rows and NULL ids are packed like any others; an empty table gives an empty result.
    """
    cut = store(pieces(docs, tokenizer, capacity, end_id))
    return pack_pieces(cut, capacity, group_rows, exchanges).drop("row_id")
