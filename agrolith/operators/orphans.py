"""References to records that do not exist: composite keys with partial nulls, periods of validity.

References are grouped by their null mask; each mask is anti-joined on its non-null columns, under the declared match
semantics:

* ``simple``: a reference with any null column is satisfied; only full keys are looked up.
* ``partial``: the non-null columns must occur together in some target row; an all-null key is satisfied.
* ``full``: all columns null is satisfied; a mix of null and non-null is an orphan; full keys are looked up.

A target row exists for a reference at time t if added_on <= t (or null) and retired_on > t (or null). Orphans come out as
``missing`` (no such key), ``deleted`` (a target retired by then) or ``late`` (only targets added afterwards). A null time
can't be compared: such a reference is an orphan only if its key is missing. Repeated references collapse if ``once`` is set.
Masks that the schema rules out (non-nullable columns) are not planned. The targets' side is left to Catalyst, which
broadcasts it only under its size threshold and else shuffles, with skewed keys split by AQE.
"""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def orphan_references(refs: DataFrame, targets: DataFrame, keys: list[str], at: str | None = None, added: str = "added_on", retired: str = "retired_on", match: str = "simple", once: bool = True) -> DataFrame:
    """The orphan rows of ``refs`` with a column ``state``. Key columns carry the same names on both sides."""
    if match not in ("simple", "partial", "full"):
        raise ValueError(f"unknown match semantics {match!r}")
    nullable = {f.name for f in refs.schema if f.nullable}
    cols = refs.columns
    life = [F.col(added).alias("_added"), F.col(retired).alias("_retired")] if at else []
    out: list[DataFrame] = []
    for mask in product(*[(False, True) if k in nullable else (False,) for k in keys]):
        null = [k for k, gone in zip(keys, mask, strict=True) if gone]
        here = [k for k in keys if k not in null]
        part = refs.where(_all([F.col(k).isNull() for k in null] + [F.col(k).isNotNull() for k in here]))
        if null and (match == "simple" or not here):
            continue
        if null and match == "full":
            out.append(part.withColumn("state", F.lit("missing")))
            continue
        t = targets.select(*[F.col(k).alias(f"_t_{k}") for k in here], *life).where(_all([F.col(f"_t_{k}").isNotNull() for k in here])).distinct()
        same = _all([F.col(k) == F.col(f"_t_{k}") for k in here])
        if not at:
            out.append(part.join(t, same, "left_anti").withColumn("state", F.lit("missing")))
            continue
        ref_at = part.withColumnRenamed(at, "_at")
        valid = (F.col("_added").isNull() | (F.col("_added") <= F.col("_at"))) & (F.col("_retired").isNull() | (F.col("_retired") > F.col("_at")))
        lost = ref_at.join(t, same & F.coalesce(valid, F.lit(True)), "left_anti")
        if once:
            lost = lost.distinct()
        # few rows are left: the targets' last retirement per key tells deleted from late
        ends = t.groupBy(*[f"_t_{k}" for k in here]).agg(F.count("*").alias("_n"), F.min(F.coalesce(F.col("_added"), F.to_timestamp_ntz(F.lit("0001-01-01")))).alias("_first"))
        told = lost.join(ends, same, "left").withColumn("state", F.when(F.col("_n").isNull(), "missing").when(F.col("_first") > F.col("_at"), "late").otherwise("deleted"))
        out.append(told.withColumnRenamed("_at", at).select(*cols, "state"))
    if not out:
        return refs.limit(0).withColumn("state", F.lit(None).cast("string"))
    found = reduce(DataFrame.unionByName, [o.select(*cols, "state") for o in out])
    return found.distinct() if once and not at else found


def by_table_and_period(orphans: DataFrame, table: str, field: str, period: str) -> DataFrame:
    """Counts per table, field, period and state."""
    return orphans.groupBy(table, field, period, "state").agg(F.count("*").alias("orphans"))
