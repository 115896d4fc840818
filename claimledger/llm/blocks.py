"""Documents in blocks of bounded size, and keys exchanged between blocks.

Operators that look for equal pieces of text in different documents work in rounds. Each block turns its documents into 64-bit
keys, once per distinct key, so that however many documents of a block share a key, the block sends it once. Keys
are dealt by value into buckets, packed (four bytes a key); a bucket sees which keys came from several
blocks and reports back to those. Blocks are made again from the same shuffle for each round.

A key of a bucket is 32 bits besides the bucket's number. The number of buckets
follows the number of blocks, so a bucket holds about as many keys as three blocks at most, and chance equality stays rare (about
1 in 1,000 keys) at every size. The rounds
use it to find candidates only.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 6 * 1024 * 1024
# Smaller inputs are cut into smaller blocks, so many for each core, but not below this size: every block
# may send a row to every bucket, so blocks follow the text and not the number of shuffle partitions.
BLOCKS_PER_CORE = 8
LEAST_BYTES = 1024 * 1024
KEYS = "bucket int, block int, keys binary, counts binary"
# Texts are hashed in chunks of so many bytes; a longer text is a chunk of its own.
HASHED_BYTES = 100_000


def block_count(documents: DataFrame, text: str = "text") -> int:
    """Blocks of at most about ``BLOCK_BYTES`` of text, smaller ones where that leaves cores without work."""
    total = documents.agg(F.sum(F.octet_length(text).cast("bigint"))).first()[0] or 0
    spread = min(BLOCKS_PER_CORE * documents.sparkSession.sparkContext.defaultParallelism, -(-total // LEAST_BYTES))
    return max(1, spread, -(-total // BLOCK_BYTES))


def with_block(documents: DataFrame, count: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(block, doc_id, text) rows; NULL texts are empty. Rows without an id are spread by their text and partition."""
    place = F.xxhash64(F.col(text), F.spark_partition_id())
    spread = F.when(F.col(id).isNotNull(), F.xxhash64(id)).otherwise(place)
    return documents.select(
        F.pmod(spread, F.lit(count)).cast("int").alias("block"),
        F.col(id).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )


def bucket_bits(count: int) -> int:
    """At least a third as many buckets as blocks, as a power of two."""
    return max(1, (count // 3 - 1).bit_length())


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(20240229).integers(0, 2**64, 256, np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in a row, and how many words each text has.

    Words are runs of anything but ASCII white space. A word's hash is a polynomial in its bytes' random values.
    """
    hashes, counts, start = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0
    while start < len(texts):
        stop, size = start, 0
        while stop < len(texts) and (stop == start or size + len(texts[stop]) <= HASHED_BYTES):
            size += len(texts[stop])
            stop += 1
        own, number = _hash_chunk(texts[start:stop])
        hashes.append(own)
        counts.append(number)
        start = stop
    return np.concatenate(hashes), np.concatenate(counts)


def _hash_chunk(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"\n".join([b"", *texts, b""]), np.uint8)
    space = _SPACE[data]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1  # it begins and ends with white space
    begin, lengths = edges[::2], edges[1::2] - edges[::2]
    bounds = np.cumsum([1, *(len(t) + 1 for t in texts)])
    counts = np.diff(np.searchsorted(begin, bounds))
    if not len(begin):
        return np.empty(0, np.uint64), counts
    letters = data[~space]
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(int(lengths.max()), _STEP))
        return mix(np.add.reduceat(_BYTE[letters] * power[place], first)), counts


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def rolling(hashes: np.ndarray, width: int, multiplier: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hashes of all runs of ``width`` values."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:count].copy()
    for offset in range(1, width):
        out *= np.uint64(multiplier)
        out += hashes[offset : offset + count]
    return mix(out)


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, sorted."""
    ranked = np.sort(values)
    return ranked[np.append(True, ranked[1:] != ranked[:-1])[: len(ranked)]]


def packed(keys: np.ndarray, bits: int, block: int, counts: np.ndarray | None = None) -> pa.Table:
    """Sorted distinct 64-bit keys as one row per bucket."""
    keys = keys >> np.uint64(32 - bits)
    bucket, low = (keys >> np.uint64(32)).astype(np.int64), keys.astype(np.uint32)
    starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(keys) else np.empty(0, np.int64)
    stops = np.append(starts[1:], len(keys))
    sizes = np.minimum(counts, 65535).astype(np.uint16) if counts is not None else np.ones(len(keys), np.uint16)
    spans = list(zip(starts.tolist(), stops.tolist(), strict=True)) if len(keys) else []
    return pa.table(
        {
            "bucket": pa.array(bucket[starts], pa.int32()),
            "block": pa.array(np.full(len(starts), block), pa.int32()),
            "keys": pa.array([low[a:b].tobytes() for a, b in spans], pa.binary()),
            "counts": pa.array([sizes[a:b].tobytes() for a, b in spans], pa.binary()),
        }
    )


def shared_keys(sent: DataFrame) -> DataFrame:
    """Of the packed keys, those that several blocks sent, back to these blocks, with the keys' total counts."""
    return sent.groupBy("bucket").applyInArrow(_shared, KEYS)


def _shared(rows: pa.Table) -> pa.Table:
    blocks = rows.column("block").to_pylist()
    lists = [np.frombuffer(k, np.uint32) for k in rows.column("keys").to_pylist()]
    sizes = np.concatenate([np.frombuffer(c, np.uint16) for c in rows.column("counts").to_pylist()]).astype(np.int64)
    keys = np.concatenate(lists)
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    copies = np.diff(np.append(first, len(keys)))
    totals = np.add.reduceat(sizes[order], first)
    several = np.empty(len(keys), bool)
    several[order] = np.repeat(copies > 1, copies)
    total = np.empty(len(keys), np.int64)
    total[order] = np.repeat(totals, copies)
    total = np.minimum(total, 65535).astype(np.uint16)
    out = {"bucket": [], "block": [], "keys": [], "counts": []}
    start = 0
    bucket = rows.column("bucket")[0].as_py()
    for block, own in zip(blocks, lists, strict=True):
        here = several[start : start + len(own)]
        if here.any():
            out["bucket"].append(bucket)
            out["block"].append(block)
            out["keys"].append(own[here].tobytes())
            out["counts"].append(total[start : start + len(own)][here].tobytes())
        start += len(own)
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.table({name: pa.array(values, kind) for (name, values), kind in zip(out.items(), kinds, strict=True)})


def unpacked(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The keys (bucket and 32 bits, sorted) and counts of packed rows."""
    parts = [(np.empty(0, np.uint64), np.empty(0, np.uint16))]
    for bucket, keys, counts in zip(*(rows.column(c).to_pylist() for c in ("bucket", "keys", "counts")), strict=True):
        low = np.frombuffer(keys, np.uint32).astype(np.uint64)
        parts.append((low | np.uint64(bucket << 32), np.frombuffer(counts, np.uint16)))
    keys, counts = (np.concatenate(p) for p in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    return keys[order], counts[order]


def places_in(ranked: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Where each value is in a sorted array, -1 if nowhere."""
    if not len(ranked):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(ranked, values), len(ranked) - 1)
    return np.where(ranked[at] == values, at, -1)


class Block:
    """The documents of one block in order of (id, text), ids that are missing last, with their words' hashes."""

    def __init__(self, rows: pa.Table):
        order = rows.select(["doc_id", "text"]).append_column("at", pa.array(np.arange(rows.num_rows)))
        order = order.sort_by([("doc_id", "ascending"), ("text", "ascending"), ("at", "ascending")])
        self.ids: list[int | None] = order.column("doc_id").to_pylist()
        self.texts: list[bytes] = order.column("text").cast(pa.large_binary()).to_pylist()
        self.hashes, self.lengths = hash_words(self.texts)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.owner = np.repeat(np.arange(len(self.ids)), self.lengths)
        #: Place of each word in its document, and words that are left from it on.
        self.place = np.arange(len(self.owner)) - self.starts[self.owner]
        self.left = self.lengths[self.owner] - self.place
