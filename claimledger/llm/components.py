"""Connected components of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimledger.llm.common import stored

MAX_ROUNDS = 60


def _stars(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step on distinct links (high, low)."""
    both = links.union(links.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = both.groupBy("high").agg(F.min("low").alias("least"))
    large = (
        both.where("low > high")
        .join(least, "high")
        .select(F.col("low").alias("high"), F.least("least", "high").alias("low"))
        .where("high > low")
        .distinct()
    )
    root = large.groupBy("high").agg(F.min("low").alias("least"))
    joined = large.join(root, "high")
    moved = joined.where("low > least").select(F.col("low").alias("high"), F.col("least").alias("low"))
    return moved.union(root.select("high", F.col("least").alias("low"))).distinct()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(id, component): the least id that can be reached, for every id that has a link.

    Alternating star steps until nothing changes: a number of rounds that grows with the logarithm of the longest chain.
    Each round is written to the shared folder. An id with very many links is summed up before it is shuffled, and
    the joins on it can be split.
    """
    now = stored(
        links.where(F.col(left) != F.col(right))
        .select(F.greatest(left, right).alias("high"), F.least(left, right).alias("low"))
        .distinct()
    )
    before = None
    for _ in range(MAX_ROUNDS):
        size = now.agg(F.count("high"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if size == before or not size[0]:
            break
        before = size
        now = stored(_stars(now))
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = now.select(F.col("high").alias("id"), F.col("low").alias("component"))
    return roots.union(now.select(F.col("low").alias("id"), F.col("low").alias("component")).distinct())
