"""Filling containers of fixed capacity with items of varying length.

1. An item longer than the capacity is cut into full pieces and a rest; nothing else is split.
2. Over the global histogram of lengths (at most ``capacity`` bins) dynamic programming chooses the bucket boundaries that
   minimise padding, that is what is lost when every item takes its bucket's boundary.
3. Token-budget batches form bucket by bucket, from the longest: a batch takes as many items of its bucket as the capacity
   holds, and what is left over is topped up with items of the longest shorter buckets that fit. The plan is made on counts:
   a batch layout and how often it is used; no item reaches the driver.
4. Items are numbered within their bucket, salt by salt, and the number leads to the container. A bucket that holds a third
   of all rows is spread over all salts.

Inside a bucket alone, items of more than half the capacity would leave the rest of their containers empty; topping up is
what keeps the space left small. Defined results: items without length (null, zero, negative) are in no container; equal
items are told apart by key and piece; repeated keys count as they come, each row is an item; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from agrolith.session import checkpointed

BUCKETS = 128
#: Rows numbered in one window.
ROWS_PER_SALT = 200_000


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Upper ends of at most ``buckets`` buckets that minimise the total padding; lengths ascend and differ."""
    n = len(lengths)
    if n <= buckets:
        return lengths.copy()
    total = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    mass = np.concatenate([[0], np.cumsum(counts * lengths)]).astype(np.float64)
    b = lengths.astype(np.float64)
    # best[j]: least cost of the first j lengths; the cost of (i, j] is b[j-1] * (total[j] - total[i]) - (mass[j] - mass[i])
    best = np.concatenate([[0.0], b * total[1:] - mass[1:]])
    came = np.zeros((buckets + 1, n + 1), np.int64)
    for k in range(2, buckets + 1):
        now, hull, at = best.copy(), [], 0
        offset = best + mass
        for j in range(1, n + 1):
            i = j - 1
            # lines y = offset[i] - total[i] * x for a last bucket that begins behind i: slopes fall, queries grow
            while len(hull) >= 2:
                p, q = hull[-2], hull[-1]
                if (offset[i] - offset[p]) * (total[q] - total[p]) <= (offset[q] - offset[p]) * (total[i] - total[p]):
                    hull.pop()
                else:
                    break
            hull.append(i)
            at = min(at, len(hull) - 1)
            x = b[j - 1]
            while at + 1 < len(hull) and offset[hull[at + 1]] - total[hull[at + 1]] * x <= offset[hull[at]] - total[hull[at]] * x:
                at += 1
            i = hull[at]
            now[j], came[k, j] = offset[i] - total[i] * x + x * total[j] - mass[j], i
        best = now
    ends, j = [], n
    for k in range(buckets, 0, -1):
        if j == 0:
            break
        ends.append(j - 1)
        j = int(came[k, j]) if k > 1 else 0
    return lengths[np.array(ends[::-1])]


def layouts(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """(items of each bucket in one container, number of such containers), the longest bucket first."""
    left = counts.astype(np.int64).copy()
    out: list[tuple[dict[int, int], int]] = []
    while left.any():
        room, layout = capacity, {}
        for k in np.flatnonzero(left)[::-1]:
            take = min(room // int(sizes[k]), int(left[k]))
            if take:
                layout[int(k)] = take
                room -= take * int(sizes[k])
        times = min(int(left[k]) // c for k, c in layout.items())
        for k, c in layout.items():
            left[k] -= c * times
        out.append((layout, times))
    return out


def plain_containers(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """How many containers there would be if no batch were topped up: those of each bucket by itself."""
    return sum(-(-int(c) // (capacity // int(s))) for s, c in zip(sizes, counts, strict=True) if c)


def fill_containers(items: DataFrame, key: str, length: str, capacity: int, buckets: int = BUCKETS) -> DataFrame:
    """container_id, key, piece, first_token, tokens: every item in its container or containers. ``items`` is read twice."""
    spark = items.sparkSession
    pieces = items.where(F.col(length) > 0).select(F.col(key), F.inline(F.transform(
        F.sequence(F.lit(0), ((F.col(length) - 1) / capacity).cast("int")),
        lambda i: F.struct(i.alias("piece"), (i.cast("bigint") * capacity).alias("first_token"), F.least(F.lit(capacity).cast("bigint"), F.col(length) - i.cast("bigint") * capacity).alias("tokens")),
    )))
    histogram = pieces.groupBy("tokens").agg(F.count("*").alias("n")).orderBy("tokens").collect()  # at most capacity rows
    lengths, counts = np.array([r["tokens"] for r in histogram], np.int64), np.array([r["n"] for r in histogram], np.int64)
    ends = boundaries(lengths, counts, buckets) if len(lengths) else lengths
    of = np.searchsorted(ends, lengths)
    per = np.bincount(of, weights=counts, minlength=len(ends)).astype(np.int64)
    slots, at, base = [], np.zeros(len(ends), np.int64), 0
    for layout, times in layouts(ends, per, capacity):
        for k, c in layout.items():
            slots.append((k, int(at[k]), int(at[k] + c * times), c, base))
            at[k] += c * times
        base += times
    plan = spark.createDataFrame(slots, "bucket int, low bigint, high bigint, each int, base bigint")
    bucket_of = spark.createDataFrame([(int(n), int(k)) for n, k in zip(lengths, of, strict=True)], "tokens bigint, bucket int")
    salts = max(1, int(counts.sum()) // ROWS_PER_SALT)
    placed = pieces.join(F.broadcast(bucket_of), "tokens").withColumn("salt", F.pmod(F.xxhash64(key, "piece"), F.lit(salts)))
    ranked = placed.withColumn("rank", F.row_number().over(W.partitionBy("bucket", "salt").orderBy(key, "piece")) - 1)
    sizes = placed.groupBy("bucket", "salt").agg(F.count("*").alias("n"))
    before = sizes.select("bucket", "salt", F.coalesce(F.sum("n").over(W.partitionBy("bucket").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    numbered = ranked.join(before, ["bucket", "salt"]).withColumn("no", F.col("rank") + F.col("before"))
    # the plan has a few rows per bucket, whatever the number of items
    held = numbered.join(F.broadcast(plan), (numbered["bucket"] == plan["bucket"]) & (F.col("no") >= F.col("low")) & (F.col("no") < F.col("high")))
    return held.select((F.col("base") + F.floor((F.col("no") - F.col("low")) / F.col("each"))).cast("bigint").alias("container_id"), F.col(key), "piece", "first_token", "tokens")


def fill_by_budget(items: DataFrame, budgets: list[tuple[int, int]], key: str, length: str) -> DataFrame:
    """budget_id, container_id, ...: the containers of each (budget_id, capacity); the items are computed once."""
    kept = checkpointed(items)
    out = None
    for budget, capacity in budgets:
        one = fill_containers(kept, key, length, capacity).select(F.lit(budget).alias("budget_id"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def fill_report(containers: DataFrame, budgets: DataFrame) -> DataFrame:
    """budget_id, containers, tokens, items, unused_share."""
    per = containers.groupBy("budget_id").agg(F.count_distinct("container_id").alias("containers"), F.sum("tokens").alias("tokens"), F.count("*").alias("items"))
    return per.join(budgets.select("budget_id", "capacity"), "budget_id").select("budget_id", "containers", "tokens", "items", F.round(1 - F.col("tokens") / (F.col("containers") * F.col("capacity")), 6).alias("unused_share"))


def fill_invariants(containers: DataFrame, budgets: DataFrame, key: str) -> DataFrame:
    """budget_id, documents, overfull (containers above the capacity), needless (documents in pieces that would fit whole), gaps (pieces that don't follow each other)."""
    sizes = budgets.select("budget_id", "capacity")
    full = containers.groupBy("budget_id", "container_id").agg(F.sum("tokens").alias("used")).join(sizes, "budget_id").groupBy("budget_id").agg(F.count_if(F.col("used") > F.col("capacity")).alias("overfull"))
    per = containers.groupBy("budget_id", key).agg(F.count("*").alias("pieces"), F.sum("tokens").alias("tokens"), F.max(F.col("first_token") + F.col("tokens")).alias("reach"), F.max("piece").alias("last")).join(sizes, "budget_id")
    whole = per.groupBy("budget_id").agg(F.count("*").alias("documents"), F.count_if((F.col("pieces") > 1) & (F.col("tokens") <= F.col("capacity"))).alias("needless"), F.count_if((F.col("reach") != F.col("tokens")) | (F.col("last") + 1 != F.col("pieces"))).alias("gaps"))
    return whole.join(full, "budget_id")
