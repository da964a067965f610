"""Rule cascades, error lists and three-valued predicates, compiled to column expressions; journals and inventories checked."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

Rule = tuple[Column, str]
#: Values of the order that are numbered in one window.
BLOCK = 100_000
#: Verdicts from the worst to the best.
VERDICTS = ("reject", "hold", "pass")


def first_failing(rules: list[Rule]) -> Column:
    """The name of the first rule whose condition is true, null if none is; unknown conditions don't fail."""
    return F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for c, name in rules])


def all_failing(rules: list[Rule]) -> Column:
    """The names of all rules that fail, in their order."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for c, name in rules]))


def worst(verdicts: list[Column]) -> Column:
    """The worst of several verdicts; null ones don't count."""
    return F.coalesce(*[F.when(reduce(lambda a, b: a | b, [F.coalesce(v == w, F.lit(False)) for v in verdicts]), F.lit(w)) for w in VERDICTS])


def predicate(tree: dict, facts: dict[str, Column]) -> Column:
    """A tree of {field, equals}, {any: [...]}, {all: [...]} as a Kleene expression: an unknown fact stays unknown where it matters."""
    if "any" in tree or "all" in tree:
        parts = [predicate(t, facts) for t in tree.get("any", tree.get("all"))]
        return reduce((lambda a, b: a | b) if "any" in tree else (lambda a, b: a & b), parts)
    return facts[tree["field"]] == F.lit(tree["equals"])


def prefix_agreement(left: DataFrame, right: DataFrame, keys: list[str], order: str, value: Column) -> DataFrame:
    """keys, left_n, right_n, agreed: how far two lists in the order of a number agree from their start, per key.

    Places are counted within blocks of the order and set off by the blocks before, so that a key with most of the rows is spread.
    """

    def numbered(df: DataFrame, side: str) -> DataFrame:
        rows = df.select(*keys, F.floor(F.col(order) / BLOCK).alias("_block"), F.col(order).alias("_order"), value.alias(side))
        sizes = rows.groupBy(*keys, "_block").agg(F.count("*").alias("_n"))
        before = sizes.select(*keys, "_block", F.coalesce(F.sum("_n").over(W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
        inner = F.row_number().over(W.partitionBy(*keys, "_block").orderBy("_order"))
        return rows.withColumn("_no", inner).join(before, [*keys, "_block"]).select(*keys, (F.col("_no") + F.col("_off")).alias("pos"), side)

    both = numbered(left, "a").join(numbered(right, "b"), [*keys, "pos"], "full_outer")
    miss = F.min(F.when(~F.col("a").eqNullSafe(F.col("b")), F.col("pos")))
    return both.groupBy(*keys).agg(F.count("a").alias("left_n"), F.count("b").alias("right_n"), (F.coalesce(miss, F.count("*") + 1) - 1).cast("bigint").alias("agreed"))


def completeness(needed: DataFrame, there: DataFrame, keys: list[str]) -> DataFrame:
    """keys, problem: what is missing, what is unknown and what stands more than once."""
    counts = there.groupBy(*keys).agg(F.count("*").alias("n"))
    joined = needed.select(*keys).distinct().withColumn("_need", F.lit(1)).join(counts, keys, "full_outer")
    problem = first_failing([(F.col("n").isNull(), "missing"), (F.col("_need").isNull(), "unknown"), (F.col("n") > 1, "repeated")])
    return joined.select(*keys, problem.alias("problem")).where("problem is not null")


def package_contents(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """name, problem: files (name, content) against a manifest (name, bytes, sha256)."""
    have = files.select("name", F.length("content").cast("bigint").alias("_bytes"), F.sha2("content", 256).alias("_digest"))
    joined = manifest.join(have, "name", "full_outer")
    rules = [(F.col("_digest").isNull(), "missing"), (F.col("sha256").isNull(), "not listed"), (F.col("bytes") != F.col("_bytes"), "size"), (F.lower("sha256") != F.col("_digest"), "digest")]
    return joined.select("name", first_failing(rules).alias("problem")).where("problem is not null")
