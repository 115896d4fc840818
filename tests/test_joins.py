"""Key joins: one row per key, hot keys found, slices even, results unchanged."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimledger.operators import joins
from claimledger.operators.joins import NULL_KEY, KeyUse, Side, keyed, lookup, one_per_key, sliced_join
from tests.conftest import same_rows


@pytest.fixture
def low_bounds(monkeypatch):
    """Hot from 50 rows on, and nothing small enough to broadcast by hand."""
    monkeypatch.setattr(joins, "SLICE_ROWS", 50)
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", -1)


@pytest.fixture
def shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def skewed(spark):
    """3000 rows: a third under one key, a third without a key, the rest under many."""
    return spark.range(3000).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), "id")).alias("key"),
    )


@pytest.fixture(scope="module")
def names(spark, skewed):
    some = skewed.where(F.col("row") % 2 == 0).select("key").distinct()
    return some.withColumn("name", F.concat(F.lit("name of "), "key"))


def test_one_per_key_keeps_one_whole_row(spark):
    rows = [("a", 2, None), ("a", 1, "x"), ("b", 3, "y"), (None, 4, "z")]
    df = spark.createDataFrame(rows, "k string, n int, t string")
    assert sorted(map(tuple, one_per_key(df, ["k"]).collect())) == [("a", 1, "x"), ("b", 3, "y")]
    assert sorted(map(tuple, one_per_key(df.select("k"), ["k"]).collect())) == [("a",), ("b",)]


def test_hot_keys_are_found(low_bounds, spark, skewed):
    hot = dict(KeyUse(skewed).hot("key"))
    assert len(hot) == 2
    assert hot[NULL_KEY] == 20
    key = spark.range(1).select(F.xxhash64(F.lit("hot"))).first()[0]
    assert hot[key] == 20


def test_a_table_for_one_task_has_no_hot_keys(skewed):
    assert KeyUse(skewed).hot("key") == []


def test_every_key_above_the_limit_is_cut(low_bounds, shuffled, spark):
    """However many keys are hot: none stays whole, and no slice is far above the limit."""
    sizes = {f"k{n}": n for n in range(1, 131, 3)}
    rows = [(n, key) for key, size in sizes.items() for n in range(size)]
    df = spark.createDataFrame(rows, "row int, key string")
    hot = dict(KeyUse(df, ["key"]).hot("key"))
    hashes = {r.key: r.h for r in df.select("key", F.xxhash64("key").alias("h")).distinct().collect()}
    assert {key for key, h in hashes.items() if h in hot} == {key for key, size in sizes.items() if size > joins.SLICE_ROWS}
    marked = sliced_join(df, [], ["key"], [*hot.items()], ["row"])
    slices = F.pmod(F.xxhash64("row"), F.coalesce(F.col("n"), F.lit(1)))
    count = spark.createDataFrame([*hot.items()], "h long, n int")
    largest = (
        df.withColumn("h", F.xxhash64("key")).join(count, "h", "left").groupBy("key", slices.alias("slice")).count()
    ).agg(F.max("count")).first()[0]
    assert marked.count() == len(rows) and joins.SLICE_ROWS / 2 < largest <= 1.3 * joins.SLICE_ROWS


def test_a_sample_finds_hot_keys(monkeypatch, spark):
    """Keys at four times the limit are found from one row in 31, those at a quarter of it are not."""
    monkeypatch.setattr(joins, "SLICE_ROWS", 4_000)
    many = spark.range(200_000).select(F.concat(F.lit("k"), (F.col("id") % 200).cast("string")).alias("key"))
    hot = [spark.range(16_000).select(F.lit(f"hot{n}").alias("key")) for n in range(5)]
    rows = many
    for part in [*hot, spark.range(12_000).select(F.lit(None).cast("string").alias("key"))]:
        rows = rows.union(part)
    use = KeyUse(rows, ["key"])
    found = dict(use.hot("key"))
    want = {NULL_KEY} | {spark.range(1).select(F.xxhash64(F.lit(f"hot{n}"))).first()[0] for n in range(5)}
    assert set(found) == want and use.rows == 292_000
    assert all(3 <= slices <= 8 for slices in found.values())


def test_one_scan_measures_all_key_sets(monkeypatch, low_bounds, skewed):
    """Row count and every set of keys come from one job, asked for once."""
    monkeypatch.setattr(joins, "SMALL_BYTES", -1)
    runs = []
    measure = KeyUse._measure
    monkeypatch.setattr(KeyUse, "_measure", lambda self: (runs.append(1), measure(self)))
    use = KeyUse(skewed, ["key"], ["row"], ["key", "row"])
    assert use.rows == 3000 and len(use.hot("key")) == 2 and use.hot("row") == []
    assert use.hot("key", "row") == [(NULL_KEY, 20)]
    assert len(runs) == 1


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_slicing_does_not_change_the_result(low_bounds, shuffled, skewed, names, how):
    hot = KeyUse(skewed).hot("key")
    got = lookup(skewed, keyed(names, ["key"]), ["key"], hot, spread=["row"], how=how)
    same_rows(got, skewed.join(names, "key", how))


def test_several_sides_share_one_slicing(low_bounds, shuffled, skewed, names):
    hot = KeyUse(skewed).hot("key")
    more = names.select("key", F.length("name").alias("size"))
    got = lookup(skewed, [keyed(names, ["key"]), keyed(more, ["key"])], ["key"], hot, spread=["row"])
    same_rows(got, skewed.join(names, "key", "left").join(more, "key", "left"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    left = [line for line in plan.splitlines() if "Exchange hashpartitioning(key" in line and "_slice" in line]
    # The left side once, and each of the two right sides once.
    assert len(left) == 3, plan


def test_slices_of_a_hot_key_are_even(low_bounds, shuffled, spark, skewed, names):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hot = KeyUse(skewed).hot("key")
        joined = sliced_join(skewed, [one_per_key(names, ["key"])], ["key"], hot, spread=["row"])
        sizes = Counter(r[0] for r in joined.select(F.spark_partition_id(), "name").collect())
        plain = skewed.join(one_per_key(names, ["key"]), "key", "left")
        before = Counter(r[0] for r in plain.select(F.spark_partition_id(), "name").collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(before.values()) > 1000
    assert max(sizes.values()) < 800 and len(sizes) == 8


def test_copies_collapse_before_they_are_sliced(low_bounds, shuffled, spark, names):
    copies = spark.range(3000).select(F.lit(1).alias("row"), F.lit("hot").alias("key"))
    seen = []

    def collapse(df):
        seen.append(df)
        return df.distinct()

    hot = KeyUse(copies).hot("key")
    got = lookup(copies, keyed(names, ["key"]), ["key"], hot, spread=["row"], collapse=collapse)
    assert got.count() == 1 and len(seen) == 1


def test_composite_keys_with_missing_parts(low_bounds, shuffled, spark):
    left = spark.range(600).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 2 == 0, "a").alias("x"),
        F.when(F.col("id") % 3 == 0, "b").alias("y"),
    )
    right = spark.createDataFrame([("a", "b", 1), ("a", None, 2), (None, "b", 3)], "x string, y string, v int")
    got = lookup(left, keyed(right, ["x", "y"]), ["x", "y"], KeyUse(left).hot("x", "y"), spread=["row"])
    same_rows(got, left.join(right, ["x", "y"], "left"))
    assert got.where("v = 1").count() == 100


def test_a_side_is_broadcast_within_both_bounds_only(monkeypatch, spark, names):
    side = keyed(names, ["key"])
    assert side.small
    monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", 10)
    assert not keyed(names, ["key"]).small
    monkeypatch.undo()
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", 10)
    assert not keyed(names, ["key"]).small
    assert not Side(names, spark.range(11)).small
    assert side.renamed({"key": "other"}).small


def test_a_small_side_of_a_hot_join_is_broadcast(monkeypatch, shuffled, skewed, names):
    monkeypatch.setattr(joins, "SLICE_ROWS", 50)
    got = lookup(skewed, keyed(names, ["key"]), ["key"], KeyUse(skewed).hot("key"), spread=["row"])
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()
    same_rows(got, skewed.join(names, "key", "left"))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    left=st.lists(st.sampled_from(["a", "a", "a", "b", "c", None]), min_size=1, max_size=40),
    right=st.sets(st.sampled_from(["a", "b", "d"])),
    slices=st.integers(1, 7),
)
def test_any_slicing_gives_the_plain_join(spark, left, right, slices):
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(left)], "row int, key string")
    dim = spark.createDataFrame([(k, k * 2) for k in right], "key string, v string")
    key = spark.range(1).select(F.xxhash64(F.lit("a"))).first()[0]
    got = sliced_join(rows, [dim], ["key"], [(key, slices), (NULL_KEY, slices)], spread=["row"])
    want = Counter((i, k, k * 2 if k in right else None) for i, k in enumerate(left))
    assert Counter(map(tuple, got.select("row", "key", "v").collect())) == want
