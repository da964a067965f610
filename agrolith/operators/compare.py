"""Comparisons: field-by-field differences by key, corroboration, rates with unknown denominators, set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def unpivot(df: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """keys, field, value (as text): one row per cell."""
    return df.select(*keys, F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])))


def version_changes(df: DataFrame, keys: list[str], version: str, fields: list[str]) -> DataFrame:
    """keys, version, before, field, old, new: cells that differ from the version before (null-safe)."""
    w = W.partitionBy(*keys).orderBy(version)
    cells = df.select(*keys, version, F.lag(version).over(w).alias("before"), *fields, *[F.lag(f).over(w).alias(f"_{f}") for f in fields]).where("before is not null")
    rows = cells.select(*keys, version, "before", F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_{f}").cast("string").alias("old"), F.col(f).cast("string").alias("new")) for f in fields])))
    return rows.where(~F.col("old").eqNullSafe(F.col("new")))


def rate(part: Column, whole: Column) -> Column:
    """Percent to one decimal; null if there is nothing to be a part of."""
    return F.round(100 * part / F.when(whole != 0, whole), 1)


def within(a: Column, b: Column, share: float) -> Column:
    """Whether two figures agree within a share of the second one."""
    return F.abs(a - b) <= F.abs(b) * share


def first_known(*frames: tuple[DataFrame, str], keys: list[str], values: list[str]) -> DataFrame:
    """keys, values, source: of several frames (frame, name) the earliest one that has a key wins, as a whole row."""
    ranked = reduce(DataFrame.unionByName, [df.select(*keys, *values, F.lit(i).alias("_rank"), F.lit(name).alias("source")) for i, (df, name) in enumerate(frames)])
    best = ranked.groupBy(*keys).agg(F.min(F.struct("_rank", "source", *values)).alias("b"))
    return best.select(*keys, *[F.col(f"b.{v}").alias(v) for v in values], F.col("b.source").alias("source"))


def last_version(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """The last row of each key by the order columns, by a partial aggregation."""
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *values)).alias("b"))
    return best.select(*keys, *[F.col(f"b.{c}").alias(c) for c in [*order, *values]])
