"""Similarity join on word n-gram sets by parity sketches.

Two sets link if their Jaccard similarity is at least ``LINK`` percent; then a <= 4b/3 for their sizes a >= b, and they differ
in at most (a + b) / 7 <= b / 3 elements. A parity sketch XORs each element into one cell of a row of cells. Two sketches
differ in no more cells than the sets differ in elements, so if more than d cells of a set are filled and
at most d elements differ, some filled cell is equal in both (pigeonhole). Sets are joined on equal cells per size
band (powers of two; a set near the next band joins there too).

1. Documents with equal sets are one class, and only its least id goes on.
2. Blocks of documents send the cells of their sketches, buckets report those that occur more than once.
3. A cell that more than ``HOT`` sets share is hot. A set with more than d cells that are not hot meets every partner in one of
   its first d + 1 such cells, where at most ``HOT`` sets are compared. A set without so many is "dense".
4. Dense sets, which consist of much-shared elements, are joined among each other on their rarest elements (more than a
   quarter of the set). Elements that over ``HOT`` sets share are hot. If the rarest element that sets of n and m share is
   the one at place i of the first (from 0, rarest first), none of the i before it is common, so they link only if
   7(n - i) >= 3(n + m); that leaves each set a greatest size of partners at each of its elements. Within a hot element, every
   set is compared with the one of the fewest elements that are not hot first, and what is then still in another component
   than the most with those of the sizes that both allow.
5. Pairs whose bit sketches differ in more bits than the sets may in elements are dropped; the rest is verified on the texts.
   Pairs that verified links connect already are not verified.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimledger.llm import blocks
from claimledger.llm.blocks import distinct, hash_words, mix, places_in, rolling
from claimledger.llm.common import add_columns, stored
from claimledger.llm.components import components

SHINGLE = 5
LINK = 75
HOT = 16
# A bit sketch has at least so many bits, and at least one for each element.
SKETCH_BITS = 256
# Smaller sets have a cell for each element.
SMALL = 64
_ALONE = 32
# Keys looked up at a time, which bounds what a lookup needs besides the keys.
_LOOKED_UP = 100_000
# Partners by hot elements are looked up by size, in classes whose sizes differ by this factor at most.
SIZE_STEP = 1.1

SIGNATURE = ["n_shingles", "signature_1", "signature_2"]
CANDIDATE = "block int, doc_id bigint, n int, cells array<bigint>, dense boolean, sketch binary, text string"
RARE = "doc_id bigint, element bigint, hot boolean, n int, cold int, place int"


def shingles(hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``SHINGLE`` words, given the words' hashes; of all words if there are fewer."""
    if not len(hashes):
        return hashes
    if len(hashes) < SHINGLE:
        return mix(rolling(hashes, len(hashes)) + np.uint64(len(hashes)))
    return distinct(rolling(hashes, SHINGLE))


def sets_of(texts: list[str]) -> list[np.ndarray]:
    """The sets of shingles of texts."""
    hashes, counts = hash_words([t.encode("utf-8", "surrogatepass").lower() for t in texts])
    return [shingles(own) for own in np.split(hashes, np.cumsum(counts)[:-1])] if texts else []


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    if not len(a) or not len(b):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= LINK * (len(a) + len(b) - common)


def may_differ(n: int) -> int:
    """How many elements a set of n and a partner differ in at most."""
    return n // 3


def bands(n: int) -> list[int]:
    own = n.bit_length() - 1
    return [own, own + 1] if 4 * n >= 3 << (own + 1) else [own]


def cells(elements: np.ndarray, band: int) -> np.ndarray:
    """The filled cells of the parity sketch for a size band, as 64-bit values that name band, place and content."""
    bits = _ALONE if 1 << band < SMALL else max(band, 7)
    place = elements >> np.uint64(64 - bits)
    start = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    content = np.bitwise_xor.reduceat(mix(elements ^ np.uint64(0x5851F42D4C957F2D)), start)
    name = mix(place[start] ^ np.uint64((band + 1) << 48))
    return mix(content ^ name)


def bit_sketch(elements: np.ndarray) -> bytes:
    """The parity of the number of elements that fall on each bit."""
    bits = max(SKETCH_BITS, 1 << (len(elements) - 1).bit_length())
    counts = np.bincount((elements & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(counts & 1, bitorder="little").tobytes()


def distance(a: bytes, b: bytes) -> int:
    """In how many bits two sketches differ; a longer one is folded onto the other's length."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def document_sets(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` with the size of each set and a 128-bit signature of it."""

    def make():
        def compute(texts: list[str]) -> list[pa.Array]:
            sets = sets_of(texts)
            plain = [int(np.add.reduce(s).astype(np.int64)) if len(s) else 0 for s in sets]
            mixed = [int(np.add.reduce(mix(s)).astype(np.int64)) if len(s) else 0 for s in sets]
            return [pa.array([len(s) for s in sets], pa.int64()), pa.array(plain, pa.int64()), pa.array(mixed, pa.int64())]

        return compute

    return add_columns(documents, text, make, "n_shingles bigint, signature_1 bigint, signature_2 bigint")


class _Sets(blocks.Block):
    """The sets of the chosen documents of a block, with all their cells."""

    def __init__(self, rows: pa.Table, chosen: pa.Table):
        wanted = chosen.group_by(["doc_id", "signature_1"]).aggregate([])
        self.number = rows.column("block")[0].as_py()
        names = set(zip(wanted.column("doc_id").to_pylist(), wanted.column("signature_1").to_pylist(), strict=True))
        mask = pc.is_in(rows.column("doc_id"), wanted.column("doc_id").combine_chunks())
        rows = rows.filter(mask)
        self.ids, self.texts, self.sets = [], [], []
        own = sorted(zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist(), strict=True))
        for (doc_id, text), elements in zip(own, sets_of([text for _, text in own]), strict=True):
            name = (doc_id, int(np.add.reduce(elements).astype(np.int64)) if len(elements) else 0)
            if len(elements) and name in names:
                names.discard(name)  # equal rows of one id count once
                self.ids.append(doc_id)
                self.texts.append(text)
                self.sets.append(elements)
        own_cells = [[cells(s, band) for band in bands(len(s))] for s in self.sets]
        #: How many cells each set has in each of its bands, in the order of ``cells``.
        self.lengths = [[len(c) for c in own] for own in own_cells]
        self.cells = np.concatenate([np.empty(0, np.uint64), *(c for own in own_cells for c in own)])


def _send_cells(bits: int):
    def run(rows: pa.Table, chosen: pa.Table) -> pa.Table:
        sets = _Sets(rows, chosen.filter(pc.is_valid(chosen.column("signature_1"))))
        keys, counts = np.unique(sets.cells, return_counts=True)
        pa.default_memory_pool().release_unused()  # the worker goes on to other blocks
        return blocks.packed(keys, bits, sets.number, counts)

    return run


def _uses(keys: np.ndarray, bits: int, shared: pa.Table) -> np.ndarray:
    """In how many sets of all blocks each key occurs."""
    known, totals = blocks.unpacked(shared)
    ranked, here = np.unique(keys, return_counts=True)
    uses = np.empty(len(keys), np.int32)
    for start in range(0, len(keys), _LOOKED_UP):
        part = keys[start : start + _LOOKED_UP]
        at = places_in(known, part >> np.uint64(32 - bits))
        elsewhere = np.where(at >= 0, totals[at] if len(totals) else 0, 0)
        # Exchanged counts end at 65,535; the block's own do too, so that all blocks count alike.
        uses[start : start + _LOOKED_UP] = np.maximum(elsewhere, np.minimum(here[np.searchsorted(ranked, part)], 65535))
    return uses


def _candidates(bits: int):
    def run(rows: pa.Table, notes: pa.Table) -> pa.Table:
        is_choice = pc.is_valid(notes.column("signature_1"))
        sets = _Sets(rows, notes.filter(is_choice))
        uses = _uses(sets.cells, bits, notes.filter(pc.invert(is_choice)))
        out: dict[str, list] = {"doc_id": [], "n": [], "cells": [], "dense": [], "sketch": [], "text": []}
        start = 0
        for doc_id, text, elements, own in zip(sets.ids, sets.texts, sets.sets, sets.lengths, strict=True):
            kept, dense, limit = [], False, may_differ(len(elements))
            for length in own:
                band_cells, use = sets.cells[start : start + length], uses[start : start + length]
                start += length
                if len(band_cells) <= limit:
                    raise RuntimeError(f"too few filled cells for document {doc_id}: {len(band_cells)} of {len(elements)}")
                cold = np.flatnonzero(use <= HOT)
                dense |= len(cold) <= limit
                cold = cold[: limit + 1]
                kept.append(band_cells[cold[use[cold] > 1]])
            kept_cells = np.concatenate(kept)
            if dense or len(kept_cells):
                out["doc_id"].append(doc_id)
                out["n"].append(len(elements))
                out["cells"].append(kept_cells.astype(np.int64))
                out["dense"].append(dense)
                out["sketch"].append(bit_sketch(elements))
                out["text"].append(text)
        kinds = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.bool_(), pa.binary(), pa.string())
        columns = {name: pa.array(values, kind) for (name, values), kind in zip(out.items(), kinds, strict=True)}
        pa.default_memory_pool().release_unused()  # the worker goes on to other blocks
        return pa.table({"block": pa.array([sets.number] * len(out["n"]), pa.int32()), **columns})

    return run


def _send_elements(bits: int):
    def run(rows: pa.Table) -> pa.Table:
        sets = sets_of(rows.column("text").to_pylist())
        keys, counts = np.unique(np.concatenate(sets), return_counts=True)
        return blocks.packed(keys, bits, rows.column("block")[0].as_py(), counts)

    return run


def _rare_elements(bits: int):
    """The rarest elements of each dense set: one more than a partner can lack."""

    def run(rows: pa.Table, shared: pa.Table) -> pa.Table:
        sets = sets_of(rows.column("text").to_pylist())
        flat = np.concatenate([np.empty(0, np.uint64), *sets])
        # Kept as far as it is exchanged, so that all blocks order elements alike.
        names, uses = flat >> np.uint64(32 - bits), _uses(flat, bits, shared)
        ids, sizes, colds, places, found, hot, start = [], [], [], [], [], [], 0
        for doc_id, elements in zip(rows.column("doc_id").to_pylist(), sets, strict=True):
            name, use = names[start : start + len(elements)], uses[start : start + len(elements)]
            start += len(elements)
            first = np.lexsort((elements, name, use))[: len(elements) // 4 + 1]
            place = np.flatnonzero(use[first] > 1)
            first = first[place]
            ids += [doc_id] * len(first)
            sizes += [len(elements)] * len(first)
            colds += [int(np.count_nonzero(use <= HOT))] * len(first)
            places.append(place)
            found.append(name[first])
            hot.append(use[first] > HOT)
        elements = np.concatenate([np.empty(0, np.uint64), *found]).astype(np.int64)
        flags = np.concatenate([np.empty(0, bool), *hot])
        order = np.concatenate([np.empty(0, np.int64), *places]).astype(np.int32)
        columns = {"doc_id": pa.array(ids, pa.int64()), "element": pa.array(elements), "hot": pa.array(flags)}
        return pa.table({**columns, "n": pa.array(sizes, pa.int32()), "cold": pa.array(colds, pa.int32()), "place": pa.array(order)})

    return run


def _pairs_within(rows: DataFrame, key: str) -> DataFrame:
    """The pairs of documents that share a key. A key has at most ``HOT`` documents."""
    groups = rows.groupBy(key).agg(F.array_sort(F.collect_set("doc_id")).alias("ids")).where(F.size("ids") > 1)

    def after(low: Column) -> Column:
        return F.transform(F.filter("ids", lambda high: high > low), lambda high: F.struct(low.alias("low"), high.alias("high")))

    return groups.select(F.explode(F.flatten(F.transform("ids", after))).alias("pair")).select("pair.*").distinct()


def _verified(pairs: DataFrame, candidates: DataFrame) -> DataFrame:
    """The pairs (low, high) that link."""
    sketch = candidates.select("doc_id", "n", "sketch")
    near = (
        pairs.join(sketch.toDF("low", "low_n", "low_sketch"), "low")
        .join(sketch.toDF("high", "high_n", "high_sketch"), "high")
        .where("4 * least(low_n, high_n) >= 3 * greatest(low_n, high_n)")
        .mapInArrow(_near, "low bigint, high bigint")
    )
    text = candidates.select("doc_id", "text")
    both = near.join(text.toDF("low", "low_text"), "low").join(text.toDF("high", "high_text"), "high")
    return both.mapInArrow(_linking, "low bigint, high bigint")


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("low_n", "high_n", "low_sketch", "high_sketch")), strict=True)
        good = [7 * distance(a, b) <= low + high for low, high, a, b in rows]
        yield batch.select(["low", "high"]).filter(pa.array(good, pa.bool_()))


def _linking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 200):
            part = batch.slice(start, 200)
            low = dict(zip(part.column("low").to_pylist(), part.column("low_text").to_pylist(), strict=True))
            known = dict(zip(low, sets_of(list(low.values())), strict=True))
            other = sets_of(part.column("high_text").to_pylist())
            good = [linked(known[i], b) for i, b in zip(part.column("low").to_pylist(), other, strict=True)]
            yield part.select(["low", "high"]).filter(pa.array(good, pa.bool_()))


def _size_class(n: Column) -> Column:
    return F.floor(F.log(SIZE_STEP, n))


def _links(pairs: DataFrame, rare: DataFrame, candidates: DataFrame) -> DataFrame:
    """Enough links to connect what links connect: of ``pairs``, and among the documents that share a hot element.

    Only components are wanted, so pairs whose ends are connected already are not verified. First every document is
    compared with the least one it is paired with, and of each hot element with the one of the least share of cold elements;
    then the pairs between different components, and of each hot element all but the largest component with everything else
    of a fitting size. ``room`` is the greatest size of a partner that shares no rarer element; a pair whose rarest common
    element is cold is in ``pairs``.
    """
    room = F.floor((4 * F.col("n") - 7 * F.col("place")) / 3)
    hot = rare.where("hot").select("element", "doc_id", "n", room.alias("room"), (F.col("cold") / F.col("n")).alias("share"))
    centre = hot.groupBy("element").agg(F.min(F.struct("share", "doc_id", "n", "room")).alias("centre"))
    star = (
        hot.join(centre, "element")
        .where("doc_id != centre.doc_id and n <= centre.room and centre.n <= room")
        .select(F.least("doc_id", "centre.doc_id").alias("low"), F.greatest("doc_id", "centre.doc_id").alias("high"))
    )
    first = pairs.groupBy("high").agg(F.min("low").alias("low")).select("low", "high").union(star).distinct()
    links = stored(_verified(first, candidates))
    label = stored(components(links, "low", "high"))

    def labelled(rows: DataFrame, id: str, name: str) -> DataFrame:
        return rows.join(label.toDF(id, name), id, "left").withColumn(name, F.coalesce(name, id))

    rest = labelled(labelled(pairs, "low", "low_part"), "high", "high_part").where("low_part != high_part").select("low", "high")
    placed = stored(labelled(hot.drop("share"), "doc_id", "component"))
    sizes = placed.groupBy("element", "component").agg(F.count("doc_id").alias("members"))
    most = sizes.groupBy("element").agg(F.max(F.struct("members", "component")).alias("most"), F.count("component").alias("parts"))
    split = most.where("parts > 1").select("element", F.col("most.component").alias("largest"))
    members = placed.join(split, "element").withColumn("class", _size_class(F.col("n")))
    others = members.where("component != largest and 4 * room >= 3 * n").select(
        "element",
        F.col("doc_id").alias("one"),
        F.col("component").alias("own"),
        F.col("n").alias("own_n"),
        F.col("room").alias("own_room"),
        F.explode(F.sequence(_size_class(F.ceil(3 * F.col("n") / 4)), _size_class(F.col("room")))).alias("class"),
    )
    apart = (
        others.join(members, ["element", "class"])
        .where("own != component and n <= own_room and own_n <= room")
        .select(F.least("one", "doc_id").alias("low"), F.greatest("one", "doc_id").alias("high"))
    )
    return links.union(_verified(rest.union(apart).distinct(), candidates))


def similar_documents(documents: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, class_id (least id with the same set) and component_id (least id
    that links reach).

    A to Z count as lower case; words are runs of anything but ASCII white space. A document with fewer words than a
    shingle has one element, all its words. NULL, empty and blank texts have none, link with nothing and are
    their own class. Ids are taken to be unique; equal rows get equal results, and rows that repeat an id with another text
    are judged by that text. A row without an id links with nothing and has no class or component.
    """
    return _similar(documents, id, text).drop("signature_1", "signature_2")


def _similar(documents: DataFrame, id: str, text: str) -> DataFrame:
    """``similar_documents`` with the signature of each row's set."""
    count = blocks.block_count(documents, text)
    bits = blocks.bucket_bits(count)
    given = documents.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    sets = stored(document_sets(given).drop("text"))
    signature = SIGNATURE
    first = sets.where("n_shingles > 0 and doc_id is not null").groupBy(*signature).agg(F.min("doc_id").alias("class_id"))
    classes = stored(first)

    rows = blocks.with_block(given, count).where("doc_id is not null")
    block = F.pmod(F.xxhash64("doc_id"), F.lit(count)).cast("int").alias("block")
    chosen = classes.select(F.col("class_id").alias("doc_id"), "signature_1").select(block, "doc_id", "signature_1")
    sent = rows.groupBy("block").cogroup(chosen.groupBy("block")).applyInArrow(_send_cells(bits), blocks.KEYS)
    notes = chosen.unionByName(blocks.shared_keys(sent), allowMissingColumns=True)
    candidates = stored(rows.groupBy("block").cogroup(notes.groupBy("block")).applyInArrow(_candidates(bits), CANDIDATE))

    cold = candidates.select("doc_id", F.explode("cells").alias("cell"))
    dense = candidates.where("dense").select("block", "doc_id", "text")
    elements = blocks.shared_keys(dense.groupBy("block").applyInArrow(_send_elements(bits), blocks.KEYS))
    rare = stored(dense.groupBy("block").cogroup(elements.groupBy("block")).applyInArrow(_rare_elements(bits), RARE))
    pairs = stored(_pairs_within(cold, "cell").union(_pairs_within(rare.where("not hot"), "element")).distinct())
    reached = components(_links(pairs, rare, candidates), "low", "high")

    named = classes.join(reached, classes.class_id == reached.id, "left").select(
        *signature, "class_id", F.coalesce("component", "class_id").alias("component_id")
    )
    own = sets.join(named, signature, "left").withColumn("_named", F.col("doc_id").isNotNull())
    alone = F.when(F.col("_named"), F.col("doc_id"))
    return own.select(
        "doc_id",
        *signature,
        F.when(F.col("_named"), F.coalesce("class_id", alone)).alias("class_id"),
        F.when(F.col("_named"), F.coalesce("component_id", alone)).alias("component_id"),
    )


def one_of_each(documents: DataFrame) -> DataFrame:
    """The documents with the least id of their component.

    Where an id is repeated, each of its rows is judged by its own text: of those with an equal set the one with the least
    text stays, if the set's component has that id as its least. Rows without an id stay, as do those without
    text.
    """
    found = stored(_similar(documents, "doc_id", "text"))
    rows = found.where("doc_id is not null").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("_rows"), F.bool_or(F.col("doc_id") == F.col("component_id")).alias("_least")
    )
    some = rows.where("_least").select(F.col("doc_id").alias("_kept"), "_rows")
    given = documents.join(some, F.col("doc_id") == F.col("_kept"))
    once = given.where("_rows = 1").select(documents.columns)
    # Ids that are repeated, if there are any, need the sets of their rows again.
    repeated = given.where("_rows > 1").select(F.struct(*documents.columns).alias("_row"), "doc_id", "text")
    least = found.where("doc_id = component_id").select("doc_id", *SIGNATURE).distinct()
    first = F.row_number().over(Window.partitionBy("doc_id", *SIGNATURE).orderBy("text"))
    of_repeated = (
        document_sets(repeated).join(least, ["doc_id", *SIGNATURE]).withColumn("_place", first).where("_place = 1").select("_row.*")
    )
    return once.union(of_repeated).union(documents.where("doc_id is null"))
