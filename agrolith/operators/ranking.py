"""Ranking with quotas, greedy batches, keep-first and fuzzy duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Pages of each tier that are taken before any others fill up.
QUOTAS = {"T1": 4, "T2": 2, "T3": 2, "T4": 2, "T5": 1}
PAGES = 10


def quota_rank(pages: DataFrame, group: list[str], order: list[Column], tier: str = "tier", quotas: dict[str, int] = QUOTAS, most: int = PAGES) -> DataFrame:
    """The pages picked for each group: per tier up to its quota, then the rest in rank order, ``most`` at most."""
    quota = F.create_map(*[F.lit(x) for pair in quotas.items() for x in pair])
    w = W.partitionBy(*group)
    ranked = pages.withColumn("rank", F.row_number().over(w.orderBy(*order))).withColumn("in_tier", F.row_number().over(W.partitionBy(*group, tier).orderBy(*order)))
    fill = F.col("in_tier") > F.coalesce(F.try_element_at(quota, F.col(tier)), F.lit(0))
    picked = ranked.withColumn("backfill", fill).withColumn("position", F.row_number().over(w.orderBy("backfill", "rank")))
    return picked.where(F.col("position") <= most).drop("in_tier")


def greedy_batches(sizes: Column, limit: int) -> Column:
    """Batch numbers (from 1) of an array of sizes packed one after another under a limit; a size above it is alone in its batch."""
    start = F.struct(F.lit(0).alias("batch"), F.lit(0).cast("bigint").alias("used"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, size: Column) -> Column:
        fits = (acc["batch"] > 0) & (acc["used"] + size <= limit)
        batch = F.when(fits, acc["batch"]).otherwise(acc["batch"] + 1)
        return F.struct(batch.alias("batch"), F.when(fits, acc["used"] + size).otherwise(size).cast("bigint").alias("used"), F.concat(acc["out"], F.array(batch)).alias("out"))

    return F.aggregate(sizes, start, step, lambda acc: acc["out"])


def keep_first(df: DataFrame, identity: list[Column], order: str) -> DataFrame:
    """identity -> the least value of ``order``: a partial aggregation, not a window, so that hot identities cost nothing."""
    return df.groupBy(*identity).agg(F.min(order).alias(order), F.count("*").alias("copies"))


def contained_keys(names: DataFrame, group: list[str], key: str, least: int = 5) -> DataFrame:
    """group, short, long: keys of which one stands in the other, both distinct within their group.

    The short key's first ``least`` letters must occur somewhere in the long one: that is an equality join on pieces of that
    length instead of a comparison of all pairs.
    """
    keys = names.select(*group, key).where(F.length(key) >= least).distinct()
    short = keys.select(*group, F.col(key).alias("short"), F.substring(key, 1, least).alias("seed"))
    long = keys.select(*group, F.col(key).alias("long"), F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(key) - least + 1), lambda i: F.substring(F.col(key), i, F.lit(least))))).alias("seed"))
    pairs = short.join(long, [*group, "seed"]).where((F.length("short") < F.length("long")) & F.col("long").contains(F.col("short")))
    return pairs.select(*group, "short", "long").distinct()
