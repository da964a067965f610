"""Nested records: leaves and their values, differences path by path, field-level overrides, checks against a declared schema.

Defined results: a text that is no valid JSON has no leaves and one error; NaN and infinities are no JSON; a key that stands twice is an
error of its own; null is a value, other than a key that is absent.
"""

from __future__ import annotations

import json
import math
import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PLAIN_KEY = re.compile(r"[A-Za-z0-9_]+")
_LEAVES = "array<struct<path:string,value:string>>"


def _no_number(constant: str) -> None:
    raise ValueError(constant)


def parsed(text: str | None) -> object:
    """The value of a JSON text without NaN and infinities; ValueError otherwise."""
    try:
        return json.loads(text or "", parse_constant=_no_number)
    except RecursionError as e:
        raise ValueError("too deep") from e


def leaves(text: str | None) -> list[dict]:
    """path and value (as JSON) of every leaf; empty arrays and objects are leaves."""
    try:
        rest = [("", parsed(text))]
    except ValueError:
        return []
    out = []
    while rest:
        path, v = rest.pop()
        if isinstance(v, dict) and v:
            rest += [(f"{path}.{k}" if path else k, x) for k, x in ((k if _PLAIN_KEY.fullmatch(k) else json.dumps(k, ensure_ascii=False), x) for k, x in v.items())]
        elif isinstance(v, list) and v:
            rest += [(f"{path}[{i}]", x) for i, x in enumerate(v)]
        else:
            out.append({"path": path, "value": json.dumps(v, ensure_ascii=False, separators=(",", ":"))})
    return out


def leaf_values(c: Column) -> Column:
    @F.pandas_udf(_LEAVES)
    def extract(t: pd.Series) -> pd.Series:
        return t.map(leaves)

    return extract(c)


def path_changes(records: DataFrame, keys: list[str], order: str, payload: str) -> DataFrame:
    """keys, order, before, path, change (added, removed, changed), old, new: each version of a record against the one before, leaf by leaf.

    A leaf is sent once as the new value of its version and once as the old value of the next one, so that both meet in one aggregation.
    Of several contents with the same place in the order the greatest text counts.
    """
    versions = records.where(F.col(payload).isNotNull()).groupBy(*keys, order).agg(F.max(payload).alias("_payload"))
    w = W.partitionBy(*keys).orderBy(order)
    placed = versions.select(*keys, order, F.lag(order).over(w).alias("_before"), F.lead(order).over(w).alias("_next"), "_payload")
    flat = placed.select(*keys, order, "_before", "_next", F.inline(leaf_values(F.col("_payload"))))
    new = F.struct(F.col(order).alias("at"), F.col("_before").alias("before"), F.lit(None).cast("string").alias("old"), F.col("value").alias("new"))
    old = F.struct(F.col("_next").alias("at"), F.col(order).alias("before"), F.col("value").alias("old"), F.lit(None).cast("string").alias("new"))
    sides = flat.select(*keys, "path", F.inline(F.array(new, old))).where("at is not null and before is not null")
    both = sides.groupBy(*keys, "at", "before", "path").agg(F.max("old").alias("old"), F.max("new").alias("new")).where("not (old <=> new)")
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("changed")
    return both.select(*keys, F.col("at").alias(order), "before", "path", change.alias("change"), "old", "new")


def apply_overrides(base: DataFrame, layers: list[DataFrame], keys: list[str], fields: list[str]) -> DataFrame:
    """The base's keys and fields (as texts) under layers of (keys, patch map<string,string>), the later layer winning field by field.

    A key of the patch that is null sets the field to null; one that is absent leaves it. Rows that only a layer has are no rows of the base.
    """
    out = base.select(*keys, *[F.col(f).cast("string").alias(f) for f in fields])
    for layer in layers:
        patch = layer.select(*keys, F.col("patch").alias("_patch"))
        value = lambda f: F.when(F.coalesce(F.map_contains_key("_patch", F.lit(f)), F.lit(False)), F.try_element_at("_patch", F.lit(f))).otherwise(F.col(f)).alias(f)
        out = out.join(patch, keys, "left").select(*keys, *[value(f) for f in fields])
    return out


_TYPES = {"string": str, "boolean": bool, "array": list, "object": dict, "null": type(None)}


def _is_a(v: object, kind: str) -> bool:
    if kind in ("number", "integer"):
        return isinstance(v, (int, float)) and not isinstance(v, bool) and (kind == "number" or float(v).is_integer())
    return isinstance(v, _TYPES[kind])


def schema_errors(value: object, schema: dict, path: str = "") -> list[tuple[str, str]]:
    """(path, problem) of everything in which a JSON value breaks a schema: type, enum, required, properties, additionalProperties, items, minItems, minLength, pattern, minimum, maximum."""
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is_a(value, k) for k in kinds):
        return [(path, "type")]
    out = []
    if "enum" in schema and not any(value == e and isinstance(value, bool) == isinstance(e, bool) for e in schema["enum"]):
        out.append((path, "enum"))
    if isinstance(value, dict):
        known = schema.get("properties", {})
        under = lambda k: f"{path}.{k}" if path else k
        out += [(under(k), "required") for k in schema.get("required", ()) if k not in value]
        for k, v in value.items():
            if k in known:
                out += schema_errors(v, known[k], under(k))
            elif schema.get("additionalProperties", True) is False:
                out.append((under(k), "not allowed"))
    elif isinstance(value, list):
        if len(value) < schema.get("minItems", 0):
            out.append((path, "minItems"))
        if "items" in schema:
            out += [e for i, v in enumerate(value) for e in schema_errors(v, schema["items"], f"{path}[{i}]")]
    elif isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            out.append((path, "minLength"))
        if "pattern" in schema and not re.search(schema["pattern"], value):
            out.append((path, "pattern"))
    elif isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", -math.inf):
            out.append((path, "minimum"))
        if value > schema.get("maximum", math.inf):
            out.append((path, "maximum"))
    return out


def schema_problems(c: Column, schema: dict) -> Column:
    """array of struct(path, problem) of a JSON text; one with the problem ``not JSON`` if it isn't valid."""

    @F.pandas_udf("array<struct<path:string,problem:string>>")
    def check(texts: pd.Series) -> pd.Series:
        def of(t: str | None) -> list[dict]:
            try:
                found = schema_errors(parsed(t), schema)
            except ValueError:
                found = [("", "not JSON")]
            return [{"path": p, "problem": x} for p, x in found]

        return texts.map(of)

    return check(c)


def strict_problem_of(text: str | None) -> str | None:
    """What makes a text no strict JSON: ``not JSON``, ``not finite`` or ``repeated key``; None if nothing does."""
    repeated = False

    def pairs(items: list[tuple]) -> None:
        nonlocal repeated
        repeated |= len({k for k, _ in items}) < len(items)

    class NotFinite(ValueError):
        pass

    def constant(_: str) -> None:
        raise NotFinite

    try:
        json.loads(text or "", object_pairs_hook=pairs, parse_constant=constant)
    except NotFinite:
        return "not finite"
    except (ValueError, RecursionError):
        return "not JSON"
    return "repeated key" if repeated else None


@F.pandas_udf(T.StringType())
def _strict(texts: pd.Series) -> pd.Series:
    return texts.map(strict_problem_of)


def strict_problem(c: Column) -> Column:
    return _strict(c)


def canonical_json(c: Column) -> Column:
    """A JSON text with its keys in order, no blanks between and no zeros at the end of numbers; null if it isn't valid. Spark's variant keeps keys in order."""
    return F.to_json(F.try_parse_json(c))


def scalar_text(c: Column, kind: str) -> Column:
    """A cell as text: nested values as compact JSON, null as an empty text."""
    return F.coalesce(F.to_json(c) if kind.startswith(("array", "struct", "map")) else c.cast("string"), F.lit(""))


def merge_first(frames: list[DataFrame], identity: list[Column], order: str) -> DataFrame:
    """The columns of the frames' rows, one per identity: of the earliest frame, and in it of the least ``order``."""
    columns = frames[0].columns
    ranked = reduce(DataFrame.unionByName, [f.select(F.lit(i).alias("_rank"), *columns) for i, f in enumerate(frames)])
    named = [x.alias(f"_i{i}") for i, x in enumerate(identity)]
    rest = [c for c in columns if c != order]
    best = ranked.groupBy(*named).agg(F.min(F.struct("_rank", order, *rest)).alias("b"))
    return best.select(*[F.col(f"b.{c}").alias(c) for c in columns], F.col("b._rank").alias("source_no"))


def numbered_in_order(df: DataFrame, group: str, major: str, minor: list[str]) -> DataFrame:
    """The rows with ``position`` in their group by (major, minor): numbered within each value of ``major``, and set off by the counts of the smaller ones."""
    inner = F.row_number().over(W.partitionBy(group, major).orderBy(*minor))
    sizes = df.groupBy(group, major).agg(F.count("*").alias("_n"))
    before = sizes.select(F.col(group).alias("_g"), F.col(major).alias("_m"), F.coalesce(F.sum("_n").over(W.partitionBy(group).orderBy(major).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    numbered = df.withColumn("_no", inner)
    return numbered.join(before, F.col(group).eqNullSafe(F.col("_g")) & F.col(major).eqNullSafe(F.col("_m"))).select(*df.columns, (F.col("_no") + F.col("_off")).alias("position"))
