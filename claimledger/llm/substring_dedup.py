"""Repeated passages: windows of words that occur earlier in the corpus.

A window is ``WINDOW`` consecutive words of one document. A window is repeated if the same words also start earlier, in a
document with a smaller id or in the same one. Words that a repeated window covers are removed; windows are
judged on the input.

Difference-cover anchors: of the runs of ``ANCHOR`` words only those are hashed that start at a place in a difference cover of
the period (``PERIOD``). For any two places there is a shift below the period that takes both into the cover, so two
equal windows share the hash of an aligned anchor. Hence, in rounds over blocks of documents:

1. blocks send their anchors; buckets report those that several blocks have;
2. blocks extend: every window around a shared anchor (or one that is repeated within the block) is hashed whole, in 128 bits,
   and sent with its first document; buckets report to each block the windows that start earlier elsewhere;
3. blocks mark the windows reported, and those that start earlier within the block, and cut out their words.
"""

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from claimledger.llm import blocks
from claimledger.llm.blocks import Block

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1

_WINDOWS = "bucket int, block int, first binary, second binary, document binary"
_EARLIER = "block int, first binary, second binary"
RESULT = "doc_id bigint, text string, n_words bigint, n_removed bigint"
_OTHER = 0xD6E8FEB86659FD93
_NO_ID = np.iinfo(np.int64).max


def _anchors(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors at cover positions."""
    hashes = blocks.rolling(block.hashes, ANCHOR)
    here = slice(0, len(hashes))
    whole = (block.left[here] >= ANCHOR) & (block.lengths[block.owner[here]] >= WINDOW)
    at = np.flatnonzero(whole & np.isin(block.place[here] % PERIOD, COVER))
    return at, hashes[at]


def _windows(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of every run of ``WINDOW`` words, and which lie within a document."""
    first, second = blocks.rolling(block.hashes, WINDOW), blocks.rolling(block.hashes, WINDOW, _OTHER)
    return first, second, block.left[: len(first)] >= WINDOW


def _send_anchors(bits: int):
    def run(rows: pa.Table) -> pa.Table:
        _, hashes = _anchors(Block(rows))
        return blocks.packed(blocks.distinct(hashes), bits, rows.column("block")[0].as_py())

    return run


def _earliest(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Where each distinct window occurs first, in order of the windows' hashes."""
    if not len(first):
        return np.empty(0, np.int64)
    order = np.argsort(first)
    a, b = first[order], second[order]
    if np.any((a[1:] == a[:-1]) & (b[1:] != b[:-1])):  # one half agrees by chance
        order = np.lexsort((second, first))
        a, b = first[order], second[order]
    start = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    return np.minimum.reduceat(order, start)


def _send_windows(bits: int):
    def run(rows: pa.Table, shared: pa.Table) -> pa.Table:
        block, number = Block(rows), rows.column("block")[0].as_py()
        at, hashes = _anchors(block)
        first, second, whole = _windows(block)
        known, _ = blocks.unpacked(shared)
        ranked = np.sort(hashes)
        here = ranked[1:][ranked[1:] == ranked[:-1]]  # repeated within the block
        marked = (blocks.places_in(known, hashes >> np.uint64(32 - bits)) >= 0) | (blocks.places_in(here, hashes) >= 0)
        sums = np.zeros(len(block.hashes) + 1, np.int64)
        sums[at[marked] + 1] = 1
        sums = np.cumsum(sums)
        n = len(first)
        # A window at i holds the anchors that start at i to i + PERIOD - 1.
        chosen = np.flatnonzero(whole & (sums[PERIOD : PERIOD + n] > sums[:n]))
        first, second, document = first[chosen], second[chosen], block.owner[chosen]
        kept = _earliest(first, second)
        ids = np.array([_NO_ID if i is None else i for i in block.ids], np.int64)
        first, second, document = first[kept], second[kept], ids[document[kept]]
        bucket = (first >> np.uint64(64 - bits)).astype(np.int64)
        starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(kept) else np.empty(0, np.int64)
        spans = list(zip(starts.tolist(), np.append(starts[1:], len(kept)).tolist(), strict=True)) if len(kept) else []
        return pa.table(
            {
                "bucket": pa.array(bucket[starts], pa.int32()),
                "block": pa.array([number] * len(spans), pa.int32()),
                **{
                    name: pa.array([column[a:b].tobytes() for a, b in spans], pa.binary())
                    for name, column in (("first", first), ("second", second), ("document", document))
                },
            }
        )

    return run


def _earlier(rows: pa.Table) -> pa.Table:
    """For each block the windows that start in an earlier document of another block."""

    def flat(name: str, kind: type) -> list[np.ndarray]:
        return [np.frombuffer(v, kind) for v in rows.column(name).to_pylist()]

    firsts, seconds = flat("first", np.uint64), flat("second", np.uint64)
    numbers = rows.column("block").to_numpy()
    block = np.repeat(numbers, [len(f) for f in firsts])
    first, second = np.concatenate(firsts), np.concatenate(seconds)
    order = np.lexsort((block, np.concatenate(flat("document", np.int64)), second, first))
    a, b = first[order], second[order]
    new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
    late = np.empty(len(first), bool)
    late[order] = ~new
    out: dict[str, list] = {"block": [], "first": [], "second": []}
    start = 0
    for number, f, s in zip(numbers.tolist(), firsts, seconds, strict=True):
        here = late[start : start + len(f)]
        start += len(f)
        if here.any():
            out["block"].append(number)
            out["first"].append(f[here].tobytes())
            out["second"].append(s[here].tobytes())
    kinds = (pa.int32(), pa.binary(), pa.binary())
    return pa.table({n: pa.array(v, k) for (n, v), k in zip(out.items(), kinds, strict=True)})


def _cut(rows: pa.Table, earlier: pa.Table) -> pa.Table:
    block = Block(rows)
    first, second, whole = _windows(block)
    at = np.flatnonzero(whole)
    repeated = np.zeros(len(block.hashes) + 1, np.int64)
    repeated[at] = 1
    repeated[at[_earliest(first[at], second[at])]] = 0
    a, b = (
        np.concatenate([np.empty(0, np.uint64), *(np.frombuffer(v, np.uint64) for v in earlier.column(c).to_pylist())])
        for c in ("first", "second")
    )
    rank = np.argsort(a, kind="stable")
    a, b = a[rank], b[rank]
    # Equal first halves are neighbours; nearly always there is one.
    most = int(np.diff(np.flatnonzero(np.append(np.append(True, a[1:] != a[:-1]), True))).max()) if len(a) else 0
    low = np.searchsorted(a, first[at])
    for step in range(most):
        here = np.minimum(low + step, len(a) - 1)
        repeated[at[(a[here] == first[at]) & (b[here] == second[at])]] = 1
    # A word goes if a repeated window starts at it or up to WINDOW - 1 words before, in the same document.
    sums = np.append(0, np.cumsum(repeated))
    n = len(block.hashes)
    begin = np.maximum(np.arange(n) - WINDOW + 1, 0)
    gone = sums[1 : n + 1] > sums[begin]
    gone &= block.lengths[block.owner] >= WINDOW
    # A window that starts in the document before ends there, so what it marks here must be taken back.
    near = np.flatnonzero(gone & (block.place < WINDOW - 1))
    gone[near] = sums[near + 1] > sums[block.starts[block.owner[near]]]
    removed = np.bincount(block.owner[gone], minlength=len(block.ids))
    texts, stays = [], ~gone
    for text, start, lost in zip(block.texts, block.starts.tolist(), removed.tolist(), strict=True):
        words = text.split()
        if lost:
            words = compress(words, stays[start : start + len(words)].tolist())
        texts.append(b" ".join(words))
    return pa.table(
        {
            "doc_id": pa.array(block.ids, pa.int64()),
            "text": pa.array(texts, pa.binary()).cast(pa.string()),
            "n_words": pa.array(block.lengths, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
        }
    )


def without_repeats(documents: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its kept words joined by one space, and how many words it had and lost.

    Words are runs of anything but ASCII white space. NULL and empty texts have no words. Documents are ordered by id,
    rows that repeat an id by their text; of equal rows all but the first lose what they repeat. Rows without
    an id come after all others. Texts pass through one shuffle, used for all three rounds.
    """
    count = blocks.block_count(documents, text)
    bits = blocks.bucket_bits(count)
    rows = blocks.with_block(documents, count, id, text)
    anchors = rows.groupBy("block").applyInArrow(_send_anchors(bits), blocks.KEYS)
    shared = blocks.shared_keys(anchors)
    windows = rows.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(_send_windows(bits), _WINDOWS)
    earlier = windows.groupBy("bucket").applyInArrow(_earlier, _EARLIER)
    return rows.groupBy("block").cogroup(earlier.groupBy("block")).applyInArrow(_cut, RESULT)
