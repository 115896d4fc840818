"""Shards of vectors that are all alike: bounded memory, and no pair lost."""

import tracemalloc

import numpy as np
import pyarrow as pa

from claimledger.llm import embedding_dedup

MB = 1_000_000


def alike(count, size=64):
    draw = np.random.default_rng(4)
    return (draw.normal(size=size) + draw.normal(size=(count, size)) * 0.05).astype(np.float32)


def test_a_shard_of_alike_vectors_is_searched_in_little_memory():
    count = embedding_dedup.SHARD_ROWS
    vectors = pa.array(alike(count).tolist(), pa.list_(pa.float32()))
    rows = pa.table({"point": pa.array(range(count), pa.int64()), "embedding": vectors})
    lists = embedding_dedup._build(rows).rename_columns(["own", "near"])
    tracemalloc.start()
    pairs = embedding_dedup._search(embedding_dedup.RANGE)(rows, lists)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    # Two copies of vectors for each of the 1.1 million pairs were 1,150 MB.
    assert peak < 150 * MB
    assert pairs.column("low").to_pylist() == [0] * (count - 1)
    assert pairs.column("high").to_pylist() == list(range(1, count))


def test_shards_that_do_not_get_smaller_are_cut(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "SHARD_ROWS", 40)
    monkeypatch.setattr(embedding_dedup, "MAX_LEVELS", 2)
    one = alike(1, 8)[0]
    # Of one direction exactly, so that all have the same nearest centroids.
    rows = [(1, i, (one * 2.0 ** (i - 100)).tolist()) for i in range(200)]
    rows += [(2, 900 + i, v) for i, v in enumerate(alike(30, 8).tolist())]
    points = spark.createDataFrame(rows, "label long, point long, embedding array<float>")
    shards = {}
    for r in embedding_dedup.in_shards(points).select("label", "shard", "point").collect():
        shards.setdefault((r.label, r.shard), set()).add(r.point)
    assert max(map(len, shards.values())) < 2 * 40
    met = {(a, b) for members in shards.values() for a in members for b in members if a < b}
    assert met == {(a, b) for one in (range(200), range(900, 930)) for a in one for b in one if a < b}
