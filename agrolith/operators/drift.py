"""Schemas that drift between files: a catalogue of column lifespans.

The footer of a file of JSON records is what its records say: the exploded keys with their JSON types. Catalogue rows are
(feed, file, field, type, records); windows over it give each field's spans (islands of files in a row that have it), whose
starts and endings are changes; a start and an ending in one file whose values agree for most records are one renaming.

Files of a feed are in the order of their number, whatever the order of arrival; a number may be missing. Payloads that are no
JSON objects are left out, and a file without any valid record is no file. A field that is null throughout is present without
a type. If the records of one file disagree on a field's type, the type that most of them have counts, then the first by name.
Records sent twice count once; records without feed or file number belong to no file; those without
an id count for the fields of their file, but not for renamings, and have a digest of their contents as key in the table. Records of one
id and file with different contents stay apart in the table. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from agrolith.session import broadcast_if_small, checkpointed

CHANGES = "feed string, file_no int, change_kind string, field string, new_field string"


def cells(records: DataFrame, payload: str = "payload", id_field: str = "id", outer: bool = False) -> DataFrame:
    """feed, file_no, rid, field, type, value (canonical JSON), text, digest (of the record, if ``outer``): the exploded keys of valid records, parsed once, in the JVM.

    ``outer``: a record without any key has a row too, its field null.
    """
    parsed = records.select("feed", "file_no", F.try_parse_json(payload).alias("v")).where("v is not null")
    objects = parsed.where(F.schema_of_variant("v").startswith("OBJECT"))
    rid = F.try_variant_get("v", f"$.{id_field}", "string").alias("rid")
    tvf = objects.sparkSession.tvf
    # keys are in the order of their names, so that the digest doesn't depend on theirs
    digest = F.sha2(F.to_json("v"), 256) if outer else F.lit(None).cast("string")
    exploded = objects.select("feed", "file_no", rid, digest.alias("digest"), "v").lateralJoin((tvf.variant_explode_outer if outer else tvf.variant_explode)(F.col("v").outer()))
    kind = F.schema_of_variant("value")
    return exploded.select("feed", "file_no", "rid", F.col("key").alias("field"), _json_type(kind).alias("type"), F.when(kind != "VOID", F.to_json("value")).alias("value"), F.try_variant_get("value", "$", "string").alias("text"), "digest")


def _json_type(kind: Column) -> Column:
    return (
        F.when(kind == "VOID", None).when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean").when(kind.startswith("ARRAY"), "array")
        .when(kind.startswith("OBJECT"), "object").otherwise("number")
    )


def catalogue(exploded: DataFrame) -> DataFrame:
    """feed, file_no, field, type (null if null throughout), records, rank of the file in its feed and of the file before.

    Aggregated in two steps, each with a partial aggregation before its shuffle; its size is that of the files' schemas.
    """
    per = exploded.groupBy("feed", "file_no", "field", "type").agg(F.count("*").alias("n"))
    order = F.struct(F.when(F.col("type").isNotNull(), F.col("n")).otherwise(-1), F.translate("type", "abcdefghijklmnopqrstuvwxyz", "zyxwvutsrqponmlkjihgfedcba"), F.col("type"))
    # written, as it is used twice and the records are not to be parsed twice
    fields = checkpointed(per.groupBy("feed", "file_no", "field").agg(F.max_by("type", order).alias("type"), F.sum("n").alias("records")))
    files = fields.select("feed", "file_no").distinct()
    w = W.partitionBy("feed").orderBy("file_no")
    ranked = files.select("feed", "file_no", F.row_number().over(w).alias("seq"), F.lag("file_no").over(w).alias("previous"), F.lead("file_no").over(w).alias("next"))
    return fields.join(ranked, ["feed", "file_no"])


def spans(cat: DataFrame) -> DataFrame:
    """feed, field, first_file, last_file, before (file before the start), after (file behind the end): islands of presence."""
    w = W.partitionBy("feed", "field").orderBy("seq")
    islands = cat.withColumn("island", F.col("seq") - F.row_number().over(w))
    return islands.groupBy("feed", "field", "island").agg(
        F.min("file_no").alias("first_file"), F.max("file_no").alias("last_file"),
        F.min_by("previous", "seq").alias("before"), F.max_by("next", "seq").alias("after"),
    ).drop("island")


def renames(exploded: DataFrame, span: DataFrame) -> DataFrame:
    """feed, file_no, field, new_field: endings and starts at one file whose values are the same for most records.

    Only the cells of fields that start or end next to the change are compared: they are joined on feed, file and record.
    """
    gone = span.where("after is not null").select("feed", F.col("after").alias("file_no"), F.col("last_file").alias("old_file"), F.col("field"))
    new = span.where("before is not null").select("feed", F.col("first_file").alias("file_no"), F.col("before").alias("old_file"), F.col("field").alias("new_field"))
    pairs = checkpointed(gone.join(new, ["feed", "file_no", "old_file"]))
    # few cells stand beside a change: they are picked in one pass, before anything is shuffled
    roles = pairs.select("feed", F.inline(F.array(F.struct(F.col("old_file").alias("at"), "field", F.col("file_no").alias("change"), F.lit("old").alias("role")), F.struct(F.col("file_no").alias("at"), F.col("new_field").alias("field"), F.col("file_no").alias("change"), F.lit("new").alias("role"))))).distinct()
    values = exploded.where("value is not null and rid is not null").select("feed", F.col("file_no").alias("at"), "rid", "field", "value")
    picked = checkpointed(values.join(broadcast_if_small(checkpointed(roles)), ["feed", "at", "field"]).select("feed", "change", "role", "rid", "field", "value").distinct())
    old = picked.where("role = 'old'").select("feed", F.col("change").alias("file_no"), "rid", "field", F.col("value").alias("old_value"))
    now = picked.where("role = 'new'").select("feed", F.col("change").alias("file_no"), "rid", F.col("field").alias("new_field"), "value")
    both = old.join(now, ["feed", "file_no", "rid"])
    score = both.groupBy("feed", "file_no", "field", "new_field").agg(F.count("*").alias("n"), F.count_if(F.col("value") == F.col("old_value")).alias("same"))
    good = checkpointed(score.where(F.col("same") * 2 > F.col("n")))
    # one partner each: the pair that agrees best, then by name; whoever lost its best partner takes the best one left
    rank = [F.desc(F.col("same") / F.col("n")), F.desc("same"), "field", "new_field"]
    by_old, by_new = W.partitionBy("feed", "file_no", "field").orderBy(*rank), W.partitionBy("feed", "file_no", "new_field").orderBy(*rank)
    found = None
    while True:
        best = good.withColumn("a", F.row_number().over(by_old)).withColumn("b", F.row_number().over(by_new)).where("a = 1 and b = 1").select("feed", "file_no", "field", "new_field")
        found = best if found is None else found.unionByName(best)
        left = good.join(best.select("feed", "file_no", "field"), ["feed", "file_no", "field"], "left_anti").join(best.select("feed", "file_no", "new_field"), ["feed", "file_no", "new_field"], "left_anti")
        if not left.take(1):
            return found
        good = checkpointed(left)


def lineages(span: DataFrame, renamed: DataFrame) -> DataFrame:
    """feed, field, first_file, last_file, lineage: spans that carry one field under its names, the root's name first.

    A span continues the span it was renamed from, else the earlier span of its own name unless that one went on elsewhere. Spans
    of one name that follow each other so are one link, numbered by a window; links are joined to the link they were renamed from, and
    pointers are doubled until all lead to a root: so many joins as the logarithm of the longest chain, and no walk in one task.
    """
    into = renamed.select("feed", F.col("file_no").alias("first_file"), F.col("new_field").alias("field"), F.col("field").alias("old"))
    onward = renamed.select("feed", F.col("file_no").alias("after"), "field", F.lit(True).alias("left"))
    w = W.partitionBy("feed", "field").orderBy("first_file")
    rows = span.select("feed", "field", "first_file", "last_file", "after").join(into, ["feed", "first_file", "field"], "left").join(onward, ["feed", "after", "field"], "left")
    begins = F.col("old").isNotNull() | F.coalesce(F.lag("left").over(w), F.lit(False)) | (F.row_number().over(w) == 1)
    numbered = rows.withColumn("begins", begins).withColumn("link_start", F.max(F.when(F.col("begins"), F.col("first_file"))).over(w))
    linked = checkpointed(numbered.withColumn("link", F.concat_ws("\0", "field", "link_start")))
    ends = linked.select("feed", F.col("field").alias("old"), F.col("after").alias("first_file"), F.col("link").alias("up"))
    up = checkpointed(linked.where("old is not null").select("feed", "link", "old", "first_file").join(ends, ["feed", "old", "first_file"]).select("feed", "link", "up"))
    open_ends = up.count()
    while open_ends:
        further = up.select("feed", F.col("link").alias("up"), F.col("up").alias("over"))
        up = checkpointed(up.join(further, ["feed", "up"], "left").select("feed", "link", F.coalesce("over", "up").alias("up"), F.col("over").isNotNull().alias("moved")))
        open_ends = up.where("moved").count()
        up = up.select("feed", "link", "up")
    return linked.join(up, ["feed", "link"], "left").select("feed", "field", "first_file", "last_file", F.coalesce("up", "link").alias("lineage"))


def retyped(cat: DataFrame, line: DataFrame) -> DataFrame:
    """feed, file_no, field: the type differs from the one the field last had under any of its names, nulls aside."""
    at = cat.alias("c").join(line.alias("l"), (F.col("c.feed") == F.col("l.feed")) & (F.col("c.field") == F.col("l.field")) & F.col("c.file_no").between(F.col("l.first_file"), F.col("l.last_file")))
    typed = at.select("c.feed", "c.file_no", "c.field", "c.type", "l.lineage").where("type is not null")
    w = W.partitionBy("feed", "lineage").orderBy("file_no", "field")
    return typed.withColumn("last", F.lag("type").over(w)).where("last is not null and last <> type").select("feed", "file_no", "field")


def schema_changes(records: DataFrame) -> DataFrame:
    """Every change of schema: feed, file_no, change_kind (renamed, removed, added, retyped), field, new_field."""
    exploded = cells(records)
    # what follows from the catalogue is small and used again and again
    cat = catalogue(exploded)
    span = checkpointed(spans(cat))
    renamed = checkpointed(renames(exploded, span))
    ends = span.where("after is not null").select("feed", F.col("after").alias("file_no"), "field")
    starts = span.where("before is not null").select("feed", F.col("first_file").alias("file_no"), "field")
    row = lambda df, kind, new=F.lit(""): df.select("feed", F.col("file_no").cast("int").alias("file_no"), F.lit(kind).alias("change_kind"), "field", new.alias("new_field"))
    removed = ends.join(renamed.select("feed", "file_no", "field"), ["feed", "file_no", "field"], "left_anti")
    added = starts.join(renamed.select("feed", "file_no", F.col("new_field").alias("field")), ["feed", "file_no", "field"], "left_anti")
    return row(renamed, "renamed", F.col("new_field")).unionByName(row(removed, "removed")).unionByName(row(added, "added")).unionByName(row(retyped(cat, lineages(span, renamed)), "retyped"))


#: The columns of the one consistent table and their types; whatever else the files hold comes out in the map ``extra``.
TARGET = {
    "name": "string", "lead": "string", "uc": "array<string>", "status": "string", "scale": "string", "funding": "string", "results": "string", "results_tier": "string", "overlap": "array<string>",
    "tier": "string", "src": "string", "src_url": "string", "verification_note": "string", "indicator_id": "string", "value_type": "string", "value": "string", "year": "int", "source_title": "string",
    "source_url": "string", "presence_rung": "string", "quality_evidence": "string", "scale_evidence": "string", "search_trail": "string", "notes": "string", "protocol_issues": "string",
}


def aliases(line: DataFrame, target: dict[str, str] = TARGET) -> DataFrame:
    """feed, field, first_file, last_file, canon: the target column that a field's line has among its names, else its first name."""
    known = F.when(F.col("field").isin(*target), F.col("field"))
    root = F.regexp_extract("lineage", "^([^\\x00]*)", 1)
    per = line.groupBy("feed", "lineage").agg(F.min_by(known, F.when(known.isNotNull(), F.col("first_file"))).alias("named"))
    return line.join(per, ["feed", "lineage"]).select("feed", "field", "first_file", "last_file", F.coalesce("named", root).alias("canon"))


def _cast(text: Column, kind: Column, value: Column, to: str) -> Column:
    """A cell as the target type: wrapped texts are unwrapped, packed lists split, numbers in texts read."""
    inner = F.coalesce(F.get_json_object(value, "$.text"), text)
    single = F.when(kind == "array", F.array_join(F.from_json(value, "array<string>"), "; ")).when(kind == "object", inner).otherwise(text)
    if to == "int":
        return single.try_cast("int")
    if to == "array<string>":
        return F.when(kind == "array", F.from_json(value, "array<string>")).when(kind.isNotNull(), F.filter(F.transform(F.split(single, ";"), lambda x: F.trim(x)), lambda x: x != ""))
    return single


def consistent_table(records: DataFrame, target: dict[str, str] = TARGET) -> DataFrame:
    """feed, file_no, rid, the target's columns, extra, failed: every valid record once, whatever its fields were called and typed.

    ``extra`` maps the other fields to their texts, null ones to null; ``failed`` names the target columns whose cell isn't null but can't be
    read as the column's type. If two fields of one record are the same column, the least value counts.
    """
    every = cells(records, outer=True).where("feed is not null and file_no is not null")
    exploded = every.where("field is not null")
    cat = catalogue(exploded)
    span = checkpointed(spans(cat))
    alias = broadcast_if_small(checkpointed(aliases(lineages(span, checkpointed(renames(exploded, span))), target)))
    at = every.alias("c").join(alias.alias("a"), (F.col("c.feed") == F.col("a.feed")) & (F.col("c.field") == F.col("a.field")) & F.col("c.file_no").between(F.col("a.first_file"), F.col("a.last_file")), "left")
    named = at.select("c.feed", "c.file_no", "c.rid", "c.digest", "a.canon", "c.type", "c.value", "c.text")
    cell = lambda to: _cast(F.col("text"), F.col("type"), F.col("value"), to)
    pick = lambda c, to: F.min(F.when(F.col("canon") == c, cell(to))).alias(c)
    rest = F.array_sort(F.collect_set(F.when(~F.col("canon").isin(*target, "id"), F.struct(F.col("canon"), F.coalesce("text", F.when(F.col("type").isNotNull(), F.col("value"))).alias("text")))))
    lost = F.coalesce(*[F.when((F.col("canon") == c) & F.col("type").isNotNull() & cell(to).isNull(), F.lit(c)) for c, to in target.items() if to != "string"])
    # the fields of one record may be renamed to one another: of several values the first in order counts
    names = F.array_distinct(F.col("_rest.canon"))
    extra = F.map_from_arrays(names, F.transform(names, lambda k: F.element_at(F.filter("_rest", lambda e: e["canon"] == k), 1)["text"])).alias("extra")
    whole = named.groupBy("feed", "file_no", "rid", "digest").agg(*[pick(c, to) for c, to in target.items()], rest.alias("_rest"), F.array_sort(F.collect_set(lost)).alias("failed"))
    return whole.select("feed", "file_no", F.coalesce("rid", F.concat(F.lit("sha256:"), "digest")).alias("rid"), *target, extra, "failed")
