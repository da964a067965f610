"""Differences between two copies of data, cell by cell.

1. Per key and side the last version's digest (128 bits over all compared columns) is kept by one aggregation, partial before its
   shuffle: a few bytes a row are shuffled, and a row delivered very often leaves each map task once.
2. The rows of the keys whose digests aren't the same on both sides are spread over hash buckets of the key, and each pair of buckets
   meets as two Arrow tables: keys are aligned by sorted search, columns compared by vectorised null-aware masks, differing
   cells emitted.

Defined results: null equals null only; texts are equal in every code point, arrays in every item and in order; NaN equals
NaN. Of a key with several versions on one side the one loaded last counts, then the one with the greatest content hash. Rows
whose key is null aren't comparable and are left out. An empty side makes every key of the other one missing. Columns that
only one side has, also such with clashing names, are ignored unless asked for.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrolith.session import BROADCAST_ROWS, BUCKET_BYTES, checkpointed, plan_bytes

SCHEMA = "row_key bigint, kind string, field string"


def _last_versions(t: pa.Table, order: str | None) -> pa.Table:
    """The table sorted by key with one row per key."""
    by = [("row_key", "ascending"), *([(order, "ascending")] if order else []), ("_hash", "ascending")]
    t = t.take(pc.sort_indices(t, sort_keys=by, null_placement="at_start")) if t.num_rows else t
    keys = t.column("row_key").to_numpy()
    last = np.append(keys[1:] != keys[:-1], True) if len(keys) else np.zeros(0, bool)
    return t.filter(pa.array(last))


def unequal(a: pa.ChunkedArray, b: pa.ChunkedArray) -> np.ndarray:
    """Null-aware mask of the positions where the two differ; nested values are compared by their items."""
    kind = a.type
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        a, b = a.combine_chunks(), b.combine_chunks()
        na, nb = np.asarray(a.is_null()), np.asarray(b.is_null())
        la, lb = (np.where(n, 0, np.asarray(pc.fill_null(pc.list_value_length(x), 0))) for x, n in ((a, na), (b, nb)))
        diff = (na != nb) | (la != lb)
        same = ~diff & ~na & (la > 0)
        at = np.flatnonzero(same)
        if len(at):
            fa, fb = pc.list_flatten(a.take(pa.array(at))), pc.list_flatten(b.take(pa.array(at)))
            cell = unequal(pa.chunked_array([fa]), pa.chunked_array([fb]))
            starts = np.concatenate([[0], np.cumsum(la[at])[:-1]])
            diff[at] |= np.logical_or.reduceat(cell, starts)
        return diff
    na, nb = np.asarray(a.is_null()), np.asarray(b.is_null())
    ne = np.asarray(pc.fill_null(pc.not_equal(a, b), False)).astype(bool)
    if pa.types.is_floating(kind):
        ne &= ~(np.asarray(pc.fill_null(pc.is_nan(a), False)) & np.asarray(pc.fill_null(pc.is_nan(b), False)))
    return (na != nb) | (ne & ~na & ~nb)


def _bucket_diff(columns: list[str], order: str | None):
    def diff(_key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = _last_versions(left, order), _last_versions(right, order)
        ka, kb = a.column("row_key").to_numpy(), b.column("row_key").to_numpy()
        at = np.searchsorted(kb, ka)
        hit = np.zeros(len(ka), bool)
        inside = at < len(kb)
        hit[inside] = kb[at[inside]] == ka[inside]
        back = np.searchsorted(ka, kb)
        found = np.zeros(len(kb), bool)
        inside = back < len(ka)
        found[inside] = ka[back[inside]] == kb[inside]
        keys, kinds, fields = [ka[~hit], kb[~found]], ["missing_in_copy"] * int((~hit).sum()) + ["missing_in_main"] * int((~found).sum()), []
        fields += [""] * len(kinds)
        pa_, pb_ = a.filter(pa.array(hit)), b.take(pa.array(at[hit]))
        for i, c in enumerate(columns):
            mask = unequal(pa_.column(f"c{i}"), pb_.column(f"c{i}"))
            keys.append(ka[hit][mask])
            kinds += ["differs"] * int(mask.sum())
            fields += [c] * int(mask.sum())
        return pa.table({"row_key": pa.array(np.concatenate(keys), pa.int64()), "kind": pa.array(kinds, pa.string()), "field": pa.array(fields, pa.string())})

    return diff


def digest(columns: list[Column], types: list[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row. Nulls, which the hash function passes over, count by a mask; nested values by their JSON."""
    flat = [F.to_json(F.struct(c.alias("c")), {"ignoreNullFields": "false"}) if t.startswith(("array", "struct", "map")) else c for c, t in zip(columns, types, strict=True)]
    nulls = F.concat(F.lit(""), *[F.when(c.isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(F.lit(1), nulls, *flat), F.xxhash64(F.lit(2), nulls, *reversed(flat))


def unequal_keys(main: DataFrame, copy: DataFrame) -> DataFrame:
    """row_key: the keys that one side lacks, or whose last versions (row_key, _order, _hash, _hash2) have other digests."""
    both = main.withColumn("_main", F.lit(True)).unionByName(copy.withColumn("_main", F.lit(False)))
    last = lambda side: F.max(F.when(F.col("_main") == side, F.struct("_order", "_hash", "_hash2")))
    per = both.groupBy("row_key").agg(last(True).alias("a"), last(False).alias("b"))
    same = (F.col("a._hash") == F.col("b._hash")) & (F.col("a._hash2") == F.col("b._hash2"))
    return per.where(~F.coalesce(same, F.lit(False))).select("row_key")


def diff_copies(main: DataFrame, copy: DataFrame, key: str, ignore: tuple[str, ...] = ("loaded_at",), order: str | None = "loaded_at", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """row_key, kind, field: rows missing on either side (field empty) and one row per differing cell."""
    columns = [c for c in main.columns if c in copy.columns and c != key and c not in ignore]
    order = order if order and order in main.columns and order in copy.columns else None

    def side(df: DataFrame) -> DataFrame:
        # columns go by number inside, so that no name of theirs can clash
        named = [F.col(c).alias(f"c{i}") for i, c in enumerate(columns)]
        rows = df.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("row_key"), *named, (F.col(order) if order else F.lit(0)).alias("_order"))
        types = dict(rows.dtypes)
        one, two = digest([F.col(f"c{i}") for i in range(len(columns))], [types[f"c{i}"] for i in range(len(columns))])
        return rows.withColumn("_hash", one).withColumn("_hash2", two)

    a, b = side(main), side(copy)
    narrow = ("row_key", "_order", "_hash", "_hash2")
    keys = checkpointed(unequal_keys(a.select(*narrow), b.select(*narrow)))
    n = keys.count()
    # the rows behind these keys: as many bytes each as the tables' rows have on average
    each = sum(plan_bytes(df) for df in (main, copy)) / max(1, sum(df.count() for df in (main, copy)))
    buckets = max(1, min(1 << 20, int(3 * n * each) // bucket_bytes + 1))
    few = F.broadcast(keys) if n <= BROADCAST_ROWS else keys

    def picked(df: DataFrame) -> DataFrame:
        rows = df.join(few, "row_key", "left_semi").groupBy("row_key", "_hash", "_hash2", *[f"c{i}" for i in range(len(columns))]).agg(F.max("_order").alias("_order"))
        return rows.withColumn("_bucket", F.pmod(F.xxhash64("row_key"), F.lit(buckets)))

    return picked(a).groupBy("_bucket").cogroup(picked(b).groupBy("_bucket")).applyInArrow(_bucket_diff(columns, "_order"), SCHEMA)
