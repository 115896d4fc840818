"""Near-duplicate vectors by search in a robust-pruned neighbour graph.

Vectors are compared within a label only. Equal vectors are one point. The points of a label are dealt to shards of
bounded size by their nearest centroids (learned from a bounded sample), several shards each, so that neighbours meet
in a shard. In each shard a graph is built: every point's nearest ones, pruned so that a neighbour is left out where
another neighbour is much closer to it (robust pruning), with links in both directions. A point's lists from all its
shards are united. Then every point is searched for from the shard's medoid and its own list, all points of a shard at a time and in
waves: a wave expands what is among a point's best ``BEAM`` or within the range, however many there are, until all of that is
expanded. What is found is verified in double precision.

A shard knows only its own points, so its links tell which points belong to one group, and no more. The links are then counted
over each whole group, all pairs of it, whatever shards its points were in: a group of at most ``SHARD_ROWS`` at once, a
larger one in pairs of blocks. Larger groups are laid in rings by the angle to one of their points, and rings that are certain
to be within the range of each other, or certain not to be, are not compared.

Which groups there are is approximate: ``audit_recall`` compares the links with all pairs for a stated set of queries.
"""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimledger.llm.common import stored
from claimledger.llm.components import components

RANGE = 0.93
SHARD_ROWS = 1_500
FAN_OUT = 24
SAMPLE_ROWS = 4_000
DEALT_ROWS = 20_000
# Shards a point is dealt to when a label is cut, and when a shard that is still too large is cut again.
OVERLAP = 3
OVERLAP_AGAIN = 2
MAX_LEVELS = 6

NEIGHBOURS = 24
POOL = 64
NEAREST = 12
ALPHA = 1.2
BEAM = 12
# Points this little below the range are expanded too: their neighbours may lie within.
SLACK = 0.08

# Rings of a large group that are as wide as the range.
RINGS = 8
_SURE = 1e-5

_POINT = "label bigint, shard string, point bigint, embedding array<float>"
_COUNT = "label bigint, point bigint, others bigint"


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """The vectors (of one length), in double precision and of length 1."""
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    rows = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def usable(vector: str) -> "F.Column":
    """Whether a vector has a direction: not NULL, not zero, all components finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def _group() -> "F.Column":
    """What vectors must share to be compared: the label and the length, as one number."""
    return F.col("label").cast("int").cast("bigint") * (1 << 20) + F.size("embedding")


def fit_centroids(rows: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from evenly spread starts; the same for the same rows."""
    centre = rows[np.linspace(0, len(rows) - 1, min(count, len(rows))).astype(int)]
    for _ in range(rounds):
        nearest = (rows @ centre.T).argmax(1)
        sums = np.zeros_like(centre)
        np.add.at(sums, nearest, rows)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centre = np.where(size > 0, sums / np.maximum(size, 1e-12), centre)
    return centre


def _learn(rows: pa.Table) -> pa.Table:
    ranked = rows.sort_by("point")
    size = ranked.column("members")[0].as_py()
    # Shards come out at about half the limit, and always at a quarter of what is cut or less.
    count = min(FAN_OUT, max(4 * OVERLAP_AGAIN, -(-2 * OVERLAP * size // SHARD_ROWS)))
    centre = fit_centroids(_matrix(ranked.column("embedding")), count)
    kind = pa.list_(pa.list_(pa.float64()))
    return pa.table({"label": ranked.column("label")[:1], "shard": ranked.column("shard")[:1], "centre": pa.array([centre.tolist()], kind)})


def _deal(key: tuple, rows: pa.Table, centres: pa.Table) -> pa.Table:
    """The rows of a part of a shard under the shards of their nearest centroids."""
    shard = key[1].as_py()
    deal = OVERLAP_AGAIN if shard else OVERLAP
    if not rows.num_rows:
        return rows.select(["label", "shard", "point", "embedding"])
    similar = _matrix(rows.column("embedding")) @ np.array(centres.column("centre")[0].as_py()).T
    near = np.argsort(-similar, axis=1, kind="stable")[:, :deal]
    dealt = rows.select(["label", "point", "embedding"]).take(pa.array(np.repeat(np.arange(len(near)), near.shape[1])))
    names = pa.array([f"{shard}/{n}" for n in near.ravel().tolist()])
    return dealt.add_column(1, "shard", names)


def in_shards(points: DataFrame) -> DataFrame:
    """The points in overlapping shards of at most ``SHARD_ROWS``. Shards over that size are split again.

    A shard's centroids come from at most about ``SAMPLE_ROWS`` of its points. One that does not get smaller (its points are
    all alike) is cut by hash after ``MAX_LEVELS``.
    """
    done = None
    rows = points.select("label", F.lit("").alias("shard"), "point", "embedding")
    for _ in range(MAX_LEVELS):
        rows = stored(rows)
        sizes = rows.groupBy("label", "shard").agg(F.count("point").alias("members"))
        large = stored(sizes.where(F.col("members") > SHARD_ROWS))
        small = rows.join(large.select("label", "shard"), ["label", "shard"], "left_anti")
        done = small if done is None else done.union(small)
        if large.isEmpty():
            return stored(done)
        here = rows.join(large, ["label", "shard"])
        sample = here.where(F.pmod(F.xxhash64("point"), F.col("members")) < SAMPLE_ROWS)
        centres = stored(
            sample.groupBy("label", "shard").applyInArrow(_learn, "label bigint, shard string, centre array<array<double>>")
        )
        # Large shards are dealt in parts of bounded size, each with its shard's centroids.
        parts = F.ceil(F.col("members") / DEALT_ROWS).cast("int")
        part = F.pmod(F.xxhash64("point"), parts).cast("int")
        own = here.select("label", "shard", part.alias("part"), "point", "embedding")
        each = centres.join(large, ["label", "shard"]).withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
        keys = ["label", "shard", "part"]
        rows = own.groupBy(keys).cogroup(each.select(*keys, "centre").groupBy(keys)).applyInArrow(_deal, _POINT)
    return stored(done.union(_in_block_pairs(stored(rows))))


def _in_block_pairs(rows: DataFrame) -> DataFrame:
    """The rows, with each shard over ``SHARD_ROWS`` dealt by hash to blocks of half the size, and every two blocks made a
    shard: all its pairs still meet, and no task holds more than a shard."""
    key = ["label", "shard"]
    sizes = rows.groupBy(key).agg(F.count("point").alias("members")).where(F.col("members") > SHARD_ROWS)
    blocks = sizes.select(*key, F.ceil(F.col("members") * 2 / SHARD_ROWS).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("point"), F.col("blocks")).cast("int")
    dealt = rows.join(blocks, key).withColumn("block", block)
    other = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("block != other")
    pair = F.concat_ws("+", F.col("shard"), F.least("block", "other").cast("string"), F.greatest("block", "other").cast("string"))
    paired = other.select("label", pair.alias("shard"), "point", "embedding")
    return rows.join(blocks, key, "left_anti").union(paired)


def robust_prune(near: np.ndarray, similar: np.ndarray, degree: int = NEIGHBOURS) -> np.ndarray:
    """Of each row's candidates (by falling similarity, -1: none) those that no chosen one is ``ALPHA`` times closer to.

    All rows at a time: a step chooses the next candidate that is still open in each row, up to ``degree`` of them. Returns
    which candidates are chosen.
    """
    rows = np.arange(len(near))
    distance = 1 - similar[rows[:, None], near]
    open_ = near >= 0
    chosen = np.zeros(near.shape, bool)
    for _ in range(min(degree, near.shape[1])):
        left = open_.any(1)
        if not left.any():
            break
        own = rows[left]
        at = open_[own].argmax(1)
        chosen[own, at] = True
        open_[own, at] = False
        between = 1 - similar[near[own, at][:, None], near[own]]
        open_[own] &= ALPHA * between > distance[own]
    return chosen


def build_graph(vectors: np.ndarray) -> list[list[int]]:
    """Neighbour lists over the rows of ``vectors``."""
    count = len(vectors)
    if count < 2:
        return [[] for _ in range(count)]
    single = vectors.astype(np.float32)
    similar = single @ single.T
    np.fill_diagonal(similar, -2)
    # The nearest ones stay unpruned: in a dense cluster, pruning alone leaves parts that do not reach each other.
    near = _nearest(similar, None, min(POOL, count - 1))
    kept = robust_prune(near, similar)
    kept[:, :NEAREST] = True
    both = np.zeros((count, count), bool)
    rows = np.repeat(np.arange(count), kept.sum(1))
    both[rows, near[kept]] = True
    both |= both.T
    crowded = np.flatnonzero(both.sum(1) > 2 * NEIGHBOURS)
    if len(crowded):
        near = np.full((count, int(both[crowded].sum(1).max())), -1)
        near[crowded] = _nearest(similar[crowded], both[crowded], near.shape[1])
        kept = robust_prune(near, similar, 2 * NEIGHBOURS)
        kept[:, :NEIGHBOURS] = near[:, :NEIGHBOURS] >= 0
        both[crowded] = False
        both[np.repeat(np.arange(count), kept.sum(1)), near[kept]] = True
    return [np.flatnonzero(own).tolist() for own in both]


def _nearest(similar: np.ndarray, wanted: np.ndarray | None, width: int) -> np.ndarray:
    """For each row the most similar ``width`` of the wanted columns, by falling similarity; -1 where there are fewer."""
    value = similar if wanted is None else np.where(wanted, similar, np.float32(-3))
    width = min(width, value.shape[1])
    near = np.argpartition(value, value.shape[1] - width, axis=1)[:, value.shape[1] - width :]
    found = np.take_along_axis(value, near, 1)
    order = np.argsort(-found, axis=1, kind="stable")
    return np.where(np.take_along_axis(found, order, 1) > -3, np.take_along_axis(near, order, 1), -1)


# Pairs that are expanded, or whose similarity is computed, at a time.
_PAIRS = 5_000
# Rows that search at a time: their work fits a processor's cache.
_QUERIES = 128


def _packed(rows: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    bits = np.packbits(rows, axis=1, bitorder="little")
    return np.pad(bits, ((0, 0), (0, -bits.shape[1] % 8))).view(np.uint64)


def search(vectors: np.ndarray, graph: list[list[int]], reach: float = RANGE) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows (the lower ones, the higher ones) within ``reach`` that a range-expanding greedy search for every row finds.

    All rows search at a time, in waves: each expands the points it has seen that are among its best ``BEAM`` or
    within the range (and a little more), until it has expanded all of these. A row's lists are bits, and
    the lists of all points that it expands in a wave are united as such.
    """
    count = len(vectors)
    if count < 2:
        return np.empty(0, int), np.empty(0, int)
    lists = np.zeros((count, count), bool)
    lists[np.repeat(np.arange(count), [len(own) for own in graph]), np.concatenate(graph).astype(int)] = True
    lists = _packed(lists)
    single = vectors.astype(np.float32)
    medoid = int((single @ single.mean(0)).argmax())
    # Marked, not listed: where all points are alike there are as many pairs as marks.
    met = np.zeros((count, count), bool)
    for first in range(0, count, _QUERIES):
        met[_search_some(np.arange(first, min(first + _QUERIES, count)), single, lists, medoid, reach)] = True
    met |= met.T
    return np.nonzero(np.triu(met, 1))


def within(vectors: np.ndarray, low: np.ndarray, high: np.ndarray, reach: float) -> np.ndarray:
    """Which pairs of rows are within ``reach``, a bounded number of pairs at a time: two vectors are copied for each."""
    keep = np.empty(len(low), bool)
    for first in range(0, len(low), _PAIRS):
        some = slice(first, first + _PAIRS)
        keep[some] = np.einsum("ij,ij->i", vectors[low[some]], vectors[high[some]]) >= reach
    return keep


def _search_some(queries: np.ndarray, single: np.ndarray, lists: np.ndarray, medoid: int, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """The points within ``reach`` that the search finds for some rows, as (row, point) pairs."""
    count = len(single)
    seen = np.full((len(queries), count), -np.inf, np.float32)
    seen[:, medoid] = single[queries] @ single[medoid]
    # A query is a point of the graph itself, so its own list is known from the start, besides the way from the medoid.
    seen[np.arange(len(queries)), queries] = 1.0
    fresh = seen > -np.inf  # seen and not expanded
    rows = np.arange(len(queries))
    beam = min(BEAM, count)
    while len(rows):
        now = seen[rows]
        bar = np.partition(now, count - beam, axis=1)[:, count - beam]
        bar = np.maximum(np.minimum(bar, np.float32(reach - SLACK)), np.float32(-2))
        row, point = np.nonzero(fresh[rows] & (now >= bar[:, None]))
        row = rows[row]
        fresh[row, point] = False
        rows, starts = np.unique(row, return_index=True)
        ends = np.append(starts[1:], len(row))
        first = 0
        while first < len(rows):
            last = max(int(np.searchsorted(ends, starts[first] + _PAIRS, "right")), first + 1)
            own = rows[first:last]
            met = np.bitwise_or.reduceat(lists[point[starts[first] : ends[last - 1]]], starts[first:last] - starts[first], axis=0)
            new = np.unpackbits(met.view(np.uint8), axis=1, count=count, bitorder="little").view(bool)
            left, right = np.nonzero(new & (seen[own] == -np.inf))
            left = own[left]
            for start in range(0, len(left), _PAIRS):
                a, b = left[start : start + _PAIRS], right[start : start + _PAIRS]
                seen[a, b] = np.einsum("ij,ij->i", single[queries[a]], single[b])
            fresh[left, right] = True
            first = last
    row, point = np.nonzero(seen >= reach - 1e-3)
    row = queries[row]
    other = row != point
    return row[other], point[other]


def least_reached(count: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each of ``count`` rows the least row that the pairs lead to."""
    least = np.arange(count)
    while True:
        both = np.minimum(least[low], least[high])
        now = least.copy()
        np.minimum.at(now, low, both)
        np.minimum.at(now, high, both)
        now = now[now]
        if (now == least).all():
            return least
        least = now


def _build(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("point")
    points = rows.column("point").to_numpy()
    graph = build_graph(_matrix(rows.column("embedding")))
    return pa.table({"point": pa.array(points), "near": pa.array([points[own].tolist() for own in graph], pa.list_(pa.int64()))})


def _search(reach: float):
    def run(rows: pa.Table, lists: pa.Table) -> pa.Table:
        rows, lists = rows.sort_by("point"), lists.sort_by("own")
        points = rows.column("point").to_numpy()
        # The united lists of the same points, of which those in the shard are followed.
        near = lists.column("near").combine_chunks()
        flat = near.flatten().to_numpy(zero_copy_only=False)
        sizes = pc.list_value_length(near).to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(points, flat), len(points) - 1)
        here = points[at] == flat
        ends = np.cumsum(np.bincount(np.repeat(np.arange(len(sizes)), sizes)[here], minlength=len(points)))
        graph = np.split(at[here], ends[:-1])
        vectors = _matrix(rows.column("embedding"))
        low, high = search(vectors, graph, reach)
        keep = within(vectors, low, high, reach)
        least = least_reached(len(points), low[keep], high[keep])
        own = np.flatnonzero(least != np.arange(len(points)))
        return pa.table({"low": points[least[own]], "high": points[own]})

    return run


def _links(left: np.ndarray, right: np.ndarray, reach: float) -> np.ndarray:
    return (left @ right.T >= reach).astype(np.int64)


def _count_in_groups(reach: float):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("label", "ascending"), ("component", "ascending")])
        label, component = rows.column("label").to_numpy(), rows.column("component").to_numpy()
        copies = rows.column("copies").to_numpy()
        cuts = np.flatnonzero((np.diff(label) != 0) | (np.diff(component) != 0)) + 1
        out = np.zeros(len(copies), np.int64)
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(copies)], strict=True):
            vectors = _matrix(rows.column("embedding").slice(start, end - start))
            linked = _links(vectors, vectors, reach)
            np.fill_diagonal(linked, 0)
            out[start:end] = linked @ copies[start:end]
        return pa.table({"label": rows.column("label"), "point": rows.column("point"), "others": out})

    return run


def _count_in_blocks(reach: float):
    def run(rows: pa.Table) -> pa.Table:
        side, copies = rows.column("side").to_numpy(), rows.column("copies").to_numpy()
        vectors = _matrix(rows.column("embedding"))
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        out = np.zeros(len(copies), np.int64)
        if len(right):
            linked = _links(vectors[left], vectors[right], reach)
            out[left], out[right] = linked @ copies[right], copies[left] @ linked
        else:
            linked = _links(vectors, vectors, reach)
            np.fill_diagonal(linked, 0)
            out = linked @ copies
        return pa.table({"label": rows.column("label"), "point": rows.column("point"), "others": out})

    return run


def _dot(left: str, right: str) -> "F.Column":
    return F.aggregate(F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def _count_in_large(members: DataFrame, reach: float) -> DataFrame:
    """The links within groups of any size: by rings where the angles alone decide, else in pairs of blocks.

    A point at angle a from the group's centre and one at angle b are at most a + b and at least b - a apart.
    """
    group = ["label", "component"]
    centre = members.groupBy(group).agg(F.min(F.struct("point", "embedding")).alias("least")).select(*group, F.col("least.embedding").alias("centre"))
    widest = math.acos(max(-1.0, min(1.0, reach)))
    step = max((widest - 2 * _SURE) / RINGS, 0.01)
    within, beyond = math.floor((widest - _SURE) / step), math.ceil((widest + _SURE) / step)
    cosine = _dot("embedding", "centre") / F.sqrt(_dot("embedding", "embedding")) / F.sqrt(_dot("centre", "centre"))
    ring = F.floor(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))) / step).cast("int")
    laid = stored(members.join(centre, group).withColumn("ring", ring).drop("centre"))
    rings = stored(laid.groupBy(*group, "ring").agg(F.count("point").alias("members"), F.sum("copies").alias("weight")))
    far = rings.select(*group, F.col("ring").alias("ring_b"), F.col("members").alias("members_b"), F.col("weight").alias("weight_b"))
    sure = F.col("ring") + F.col("ring_b") + 2 <= within
    whole = rings.join(far, group).where(sure).groupBy(*group, "ring").agg(F.sum("weight_b").alias("sure"))
    # Where a ring is certain to be within the range of itself, a point is among the points counted.
    own = F.when(2 * F.col("ring") + 2 <= within, F.col("copies")).otherwise(0)
    certain = laid.join(whole, [*group, "ring"]).select("label", "point", (F.col("sure") - own).alias("others"))

    blocks = F.ceil(F.col("members") / SHARD_ROWS).cast("int")
    numbers = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    block = rings.withColumn("blocks", blocks).withColumn("block", numbers)
    other = block.select(*group, F.col("ring").alias("ring_b"), F.col("block").alias("block_b"))
    once = (F.col("ring") < F.col("ring_b")) | ((F.col("ring") == F.col("ring_b")) & (F.col("block") <= F.col("block_b")))
    tasks = stored(
        block.drop("members", "weight", "blocks").join(other, group).where(once & ~sure & (F.col("ring_b") - F.col("ring") - 1 < beyond))
    )
    dealt = laid.join(rings.select(*group, "ring", blocks.alias("blocks")), [*group, "ring"]).withColumn("block", F.pmod(F.xxhash64("point"), F.col("blocks")).cast("int"))
    dealt = dealt.select(*group, "point", "copies", "embedding", "ring", "block")
    task = ["ring", "block", "ring_b", "block_b"]
    left = dealt.join(tasks, [*group, "ring", "block"]).withColumn("side", F.lit(0))
    right = (
        dealt.withColumnsRenamed({"ring": "ring_b", "block": "block_b"})
        .join(tasks.where("ring != ring_b or block != block_b"), [*group, "ring_b", "block_b"])
        .withColumn("side", F.lit(1))
    )
    columns = [*group, *task, "point", "copies", "embedding", "side"]
    compared = left.select(columns).union(right.select(columns)).groupBy(*group, *task).applyInArrow(_count_in_blocks(reach), _COUNT)
    return certain.union(compared).groupBy("label", "point").agg(F.sum("others").alias("others"))


def count_links(points: DataFrame, reached: DataFrame, reach: float = RANGE) -> DataFrame:
    """(label, point, others): the rows of other points linked with each point, over all pairs of its group.

    ``reached`` gives the group (id, component) of the points that have one.
    """
    group = ["label", "component"]
    named = reached.select(F.col("id").alias("point"), "component")
    members = stored(points.join(named, "point").select(*group, "point", "copies", "embedding"))
    sizes = members.groupBy(group).agg(F.count("point").alias("members"))
    large = stored(sizes.where(F.col("members") > SHARD_ROWS).select(group))
    # Small groups are packed, as many together as a shard has rows.
    packs = max(1, -(-members.count() // SHARD_ROWS))
    small = members.join(large, group, "left_anti").withColumn("pack", F.pmod(F.xxhash64(*group), F.lit(packs)))
    counted = small.groupBy("pack").applyInArrow(_count_in_groups(reach), _COUNT)
    if large.isEmpty():
        return counted
    return counted.union(_count_in_large(members.join(large, group), reach))


def near_duplicates(embeddings: DataFrame, id: str = "vec_id", reach: float = RANGE) -> DataFrame:
    """One row per vector: id, n_links, component_id and kept.

    Two vectors of one label link if their cosine is at least ``reach``; ``n_links`` counts the other rows linked directly
    (equal vectors among them), ``component_id`` is the least id that links reach and ``kept`` marks the row with it. Without
    a label or a direction (NULL, zero, or with NULL or non-finite components) a vector links with nothing. Rows that repeat
    an id with an equal vector are linked rows of one id. Without an id, a row has no component and is not kept. Vectors of
    different length do not link.
    """
    rows = embeddings.select(
        F.col(id).cast("bigint").alias("vec_id"), _group().alias("label"), F.col("embedding").cast("array<float>").alias("embedding")
    )
    valid = rows.where(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & usable("embedding"))
    # Vectors are compared by a hash first where rows are sorted by them.
    valid = valid.withColumn("hash", F.xxhash64("embedding"))
    points = stored(
        valid.groupBy("label", "hash", "embedding").agg(F.min("vec_id").alias("point"), F.count("vec_id").alias("copies"))
    )
    shards = in_shards(points)
    built = shards.groupBy("label", "shard").applyInArrow(_build, "point bigint, near array<bigint>")
    united = stored(built.groupBy("point").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))).alias("near")))
    own = shards.select(F.col("label").alias("group"), F.col("shard").alias("part"), F.col("point").alias("own"))
    lists = own.join(united, F.col("own") == F.col("point")).select("group", "part", "own", "near")
    pairs = stored(
        shards.groupBy("label", "shard")
        .cogroup(lists.groupBy("group", "part"))
        .applyInArrow(_search(reach), "low bigint, high bigint")
        .distinct()
    )
    reached = stored(components(pairs, "low", "high"))
    linked = stored(count_links(points, reached, reach))
    named = (
        points.join(linked, ["label", "point"], "left")
        .join(reached, F.col("point") == reached.id, "left")
        .select(
            "label",
            "hash",
            "embedding",
            (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("component", "point").alias("component_id"),
        )
    )
    ok = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & usable("embedding")
    alone = rows.where(~F.coalesce(ok, F.lit(False))).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    found = valid.join(named, ["label", "hash", "embedding"]).select("vec_id", "n_links", "component_id").union(alone)
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def exact_links(embeddings: DataFrame, every: int = 20, reach: float = RANGE) -> DataFrame:
    """(query, other) for the queries whose id ``every`` divides, against all rows of their label, in blocks.

    The queries are compared in parts of bounded size; each part is one pass over the vectors.
    """
    valid = embeddings.where(F.col("label").isNotNull() & usable("embedding")).select("vec_id", _group().alias("label"), "embedding")
    queries = stored(valid.where(F.col("vec_id") % every == 0))
    n_parts = max(1, -(-queries.count() // 20_000))
    out = None
    for part in range(n_parts):
        own = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(n_parts)) == part).collect()
        by_label: dict[int, list] = {}
        for r in own:
            by_label.setdefault(r.label, []).append((r.vec_id, r.embedding))
        given = embeddings.sparkSession.sparkContext.broadcast(by_label)

        def run(batches, given=given):
            ready = {
                k: (np.array([i for i, _ in v]), _matrix(pa.array([e for _, e in v], pa.list_(pa.float64()))))
                for k, v in given.value.items()
            }
            for batch in batches:
                if not batch.num_rows:
                    continue
                labels, ids = batch.column("label").to_numpy(zero_copy_only=False), batch.column("vec_id").to_numpy()
                for label, (names, matrix) in ready.items():
                    here = np.flatnonzero(labels == label)
                    a, b = np.nonzero(_matrix(batch.column("embedding").take(pa.array(here))) @ matrix.T >= reach)
                    differ = ids[here][a] != names[b]
                    yield pa.RecordBatch.from_arrays([pa.array(names[b][differ]), pa.array(ids[here][a][differ])], ["query", "other"])

        rows = valid.mapInArrow(run, "query bigint, other bigint")
        out = rows if out is None else out.union(rows)
    return out


def audit_recall(embeddings: DataFrame, every: int = 20, reach: float = RANGE) -> float:
    """The share of the queries' links, counted exactly, that the search has found (as numbers of links per query)."""
    found = near_duplicates(embeddings, reach=reach).select("vec_id", "n_links")
    wanted = exact_links(embeddings, every, reach).groupBy("query").agg(F.count("other").alias("links"))
    row = wanted.join(found, wanted["query"] == found.vec_id).agg(F.sum("links").alias("all"), F.sum("n_links").alias("got")).first()
    return 1.0 if not row["all"] else row["got"] / row["all"]
