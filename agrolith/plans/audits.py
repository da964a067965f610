"""Queries that derive, compare, merge and check records; with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from agrolith.functions import numbers as nm
from agrolith.functions import text as tx
from agrolith.operators import documents as dc
from agrolith.operators import scoring as sc
from agrolith.plans.scoring import _OBS
from agrolith.sources import sinks
from agrolith.sources.files import read_assessments
from agrolith.sources.tables import table

#: The schema that records of a feed should have.
RECORD = {
    "type": "object", "required": ["id", "tier", "notes"],
    "properties": {"id": {"type": "string", "minLength": 1}, "tier": {"type": "string", "enum": ["T1", "T2", "T3"]}, "year": {"type": ["integer", "null"], "minimum": 2015}, "overlap": {"type": "array", "minItems": 1, "items": {"type": "string"}}, "uc": {"type": ["array", "string", "null"]}},
}
PATCHED = ("tier", "value_type", "presence_rung")


def _cells(spark, d, *columns):
    return table(spark, d, "research_cells").select("cell_id", *columns).distinct()


def _derived(spark, d):
    c = _cells(spark, d, "indicator_id", "value", "tier", "source_url", "presence_rung", "quality_evidence", "scale_evidence")
    rows = c.join(table(spark, d, "indicators").select("indicator_id", "method", "thresholds", "direction"), "indicator_id").withColumn("number", tx.parse_number(F.col("value")))
    cls = F.when((F.col("method") != "ladder") & F.col("number").isNotNull(), "Measured").when((F.coalesce("source_url", F.lit("")) != "") & (F.coalesce("tier", F.lit("")) != "T5"), "Documented").otherwise("Judged")
    return rows.withColumn("cls", cls)


def q_derived_class(spark, d):
    """The class of a researched cell: a number is Measured unless its indicator is a ladder, a source that isn't T5 makes it Documented."""
    return _derived(spark, d).select("cell_id", "cls")


def q_derived_level(spark, d):
    """The level of a researched cell: by rung and evidence for ladders, by thresholds for numbers."""
    ladder = sc.ladder_level(F.col("presence_rung"), tx.substantive(F.col("quality_evidence")), tx.substantive(F.col("scale_evidence")))
    level = F.when(F.col("method") == "ladder", ladder).when(F.col("cls") == "Measured", sc.threshold_level(F.col("number"), F.col("thresholds"), F.col("direction")))
    return _derived(spark, d).select("cell_id", level.cast("int").alias("level"))


def q_path_diff(spark, d):
    """Records of a feed against their version in the file before, leaf by leaf; counted by path."""
    r = table(spark, d, "raw_records").select("feed", "file_no", "payload", F.get_json_object("payload", "$.id").alias("rid")).where("rid is not null")
    return dc.path_changes(r, ["feed", "rid"], "file_no", "payload").groupBy("feed", "file_no", "path", "change").agg(F.count("*").alias("records"))


def q_overrides(spark, d):
    """Cells under the copy's corrections, field by field; a correction to null is one."""
    base = _cells(spark, d, *PATCHED)
    copy = table(spark, d, "research_cells_copy").select("cell_id", *[F.col(c).alias(f"n_{c}") for c in PATCHED]).distinct()
    both = base.join(copy, "cell_id")
    entries = F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"n_{c}")), F.struct(F.lit(c).alias("key"), F.col(f"n_{c}").alias("value"))) for c in PATCHED]))
    return dc.apply_overrides(base, [both.select("cell_id", F.map_from_entries(entries).alias("patch"))], ["cell_id"], list(PATCHED))


def q_schema_check(spark, d):
    """Records that break the declared schema, counted by feed, path and problem."""
    r = table(spark, d, "raw_records").select("record_id", "feed", F.inline(dc.schema_problems(F.col("payload"), RECORD)))
    return r.groupBy("feed", F.regexp_replace("path", r"\[\d+\]", "[]").alias("path"), "problem").agg(F.count_distinct("record_id").alias("records"))


def q_strict_json(spark, d):
    r = table(spark, d, "raw_records").select("record_id", dc.strict_problem(F.col("payload")).alias("problem"))
    return r.where("problem is not null")


def q_canonical_json(spark, d):
    """Digests of records whose keys are put in order and whose numbers have no zeros at the end."""
    r = table(spark, d, "raw_records").select("record_id", F.sha2(dc.canonical_json(F.col("payload")), 256).alias("digest"))
    return r.where("digest is not null")


def q_scalar_text(spark, d):
    r = table(spark, d, "register_entries").select("entry_id", "overlap", "funding").distinct()
    return r.select("entry_id", dc.scalar_text(F.col("overlap"), "array<string>").alias("overlap"), dc.scalar_text(F.col("funding"), "string").alias("funding"))


def q_merged_findings(spark, d):
    """Entries of both systems, one per subject and name: the main system's first."""
    frames = [table(spark, d, t).where("name is not null").select("entry_id", "subject", "name", "status").distinct() for t in ("register_entries", "register_copy")]
    return dc.merge_first(frames, [F.col("subject"), tx.normal_form(F.col("name"))], "entry_id")


def q_timeline(spark, d):
    """Cells of a subject in the order of year and title."""
    c = _cells(spark, d, "subject", "year", "source_title").where("year is not null and source_title is not null")
    return dc.numbered_in_order(c, "subject", "year", ["source_title", "cell_id"]).select("subject", "cell_id", F.col("position").cast("int").alias("position"))


def q_answer_scores(spark, d):
    """The main system's cells held against the copy's as the known answers: value within two percent, kind, year, gaps found and missed."""
    a = _cells(spark, d, "subject", "value_type", "value", "year").withColumn("x", tx.parse_number(F.col("value")))
    t = table(spark, d, "research_cells_copy").select("cell_id", F.col("value_type").alias("t_type"), F.col("value").alias("t_value"), F.col("year").alias("t_year")).distinct().withColumn("y", tx.parse_number(F.col("t_value")))
    same = F.when(F.col("x").isNotNull() & F.col("y").isNotNull(), F.abs(F.col("x") - F.col("y")) <= F.abs(F.col("y")) * 0.02).otherwise(F.col("value").eqNullSafe(F.col("t_value")))
    gap, t_gap = F.coalesce(F.col("value_type") == "gap", F.lit(False)), F.coalesce(F.col("t_type") == "gap", F.lit(False))
    n = lambda c, name: F.count_if(c).alias(name)
    return a.join(t, "cell_id").groupBy("subject").agg(
        F.count("*").alias("cells"), n(~t_gap & ~gap & same, "right"), n(~t_gap & ~gap & ~same, "wrong"), n(t_gap & gap, "rightly_absent"), n(t_gap & ~gap, "made_up"), n(~t_gap & gap, "missed"),
        n(F.col("value_type").eqNullSafe(F.col("t_type")), "same_type"), n(F.col("year").eqNullSafe(F.col("t_year")), "same_year"),
    )


def q_withheld_cause(spark, d):
    """Indicators without a level by cause, and in how many subjects: a gap, a level that is held, a value that no rule makes a level of."""
    r = sc.scored(table(spark, d, "observations"), table(spark, d, "indicators")).where("level is null")
    cause = F.when(F.col("cls") == "Gap", "gap").when(F.col("cls") == "", "no value").when(F.col("level_present"), "held").otherwise("no rule")
    return r.groupBy("indicator_id", cause.alias("cause")).agg(F.count("*").alias("n"), F.count_distinct("subject").alias("subjects"))


def q_figure_fidelity(spark, d):
    """Share of the plain figures in a subject's notes that the cell's value or year supports; 1 if there are none."""
    figures = F.regexp_extract_all("notes", F.lit(r"[0-9]+(?:\.[0-9]+)?"), 0)
    c = _cells(spark, d, "subject", "year", "value", "notes").select("subject", "year", tx.parse_number(F.col("value")).alias("v"), figures.alias("f"))
    known = lambda x: F.coalesce(x.cast("double") == F.col("v"), F.lit(False)) | F.coalesce(x.cast("double") == F.col("year").cast("double"), F.lit(False))
    per = c.groupBy("subject").agg(F.sum(F.coalesce(F.size("f"), F.lit(0))).alias("claimed"), F.sum(F.coalesce(F.size(F.filter("f", known)), F.lit(0))).alias("supported"))
    fixed = per.select("subject", F.greatest("claimed", F.lit(0)).alias("claimed"), F.greatest("supported", F.lit(0)).alias("supported"))
    return fixed.select("subject", "claimed", "supported", F.coalesce(F.round(F.col("supported") / F.when(F.col("claimed") > 0, F.col("claimed")), 4), F.lit(1.0)).alias("fidelity"))


def q_quantity_mentions(spark, d):
    """Every quantity in the documents: figures and number words with their dimension and place."""
    m = table(spark, d, "documents").select("doc_id", F.explode(nm.quantities(F.col("text"))).alias("q"))
    return m.select("doc_id", "q.*")


def q_quantity_support(spark, d):
    """Quantities in a cell's notes, and those that its value with its unit, or its year, supports."""
    c = _cells(spark, d, "value", "value_unit", "year", "notes").where("notes is not null")
    known = F.concat_ws("; ", F.concat_ws(" ", "value", "value_unit"), F.col("year").cast("string"))
    return c.select("cell_id", nm.support_counts(F.col("notes"), known).alias("s")).select("cell_id", "s.claimed", "s.supported")


def q_lane_gate(spark, d):
    """The first rule of the lane that a source breaks: it has a page, the page is read as of this subject, and it is no T5."""
    c = _cells(spark, d, "subject", "tier", "source_url")
    code = F.upper(F.regexp_extract("source_url", r"://[a-z]+-([a-z]{3})\.", 1))
    gate = F.when(F.coalesce("source_url", F.lit("")) == "", "no page").when((code != "") & (code != F.col("subject")), "of another subject").when(F.col("tier") == "T5", "weak source")
    return c.select("cell_id", gate.alias("gate"))


def q_unknown_citations(spark, d):
    """Ids cited in notes that the catalog hasn't, with their place among the citations."""
    cited = _cells(spark, d, "notes").select("cell_id", F.posexplode(F.regexp_extract_all("notes", F.lit(r"\b([0-9]+\.[0-9]+)\b"), 1)).alias("place", "cited"))
    return cited.join(table(spark, d, "indicators").select(F.col("indicator_id").alias("cited")).distinct(), "cited", "left_anti").select("cell_id", "place", "cited")


def q_catalog_errors(spark, d):
    """All errors of the catalog's entries: cuts that aren't four or don't go one way, units and directions that lack or stand where none belongs."""
    i = table(spark, d, "indicators")
    cuts, down = F.col("thresholds"), F.col("direction") == "lower"
    steps = F.zip_with(F.slice(cuts, 1, F.greatest(F.size(cuts) - 1, F.lit(0))), F.slice(cuts, 2, F.greatest(F.size(cuts), F.lit(1))), lambda a, b: a < b)
    is_cut = F.col("method") == "threshold"
    errors = F.array_compact(F.array(
        F.when(is_cut & (F.coalesce(F.size(cuts), F.lit(0)) != 4), "not four cuts"), F.when(is_cut & F.exists(steps, lambda up: up == down), "cuts out of order"), F.when(is_cut & F.col("unit").isNull(), "no unit"),
        F.when(is_cut & ~F.coalesce(F.col("direction").isin("higher", "lower"), F.lit(False)), "no direction"), F.when(~is_cut & F.col("unit").isNotNull(), "unit of a ladder"), F.when(F.col("retired_on") <= F.col("added_on"), "retired before it was added"),
    ))
    return i.select("indicator_id", F.size(errors).alias("errors"), F.array_join(errors, ", ").alias("which"))


def q_distinct_areas(spark, d):
    """The subjects that any table names, blank ones aside, each with the number of tables that do."""
    parts = [table(spark, d, t).select(F.trim("subject").alias("subject"), F.lit(t).alias("t")).distinct() for t in ("observations", "research_cells", "register_entries", "documents")]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return every.where("coalesce(subject, '') <> ''").groupBy("subject").agg(F.count_distinct("t").alias("tables"))


def q_headline_figures(spark, d):
    """Facts of the tables as reports write them."""
    out = None
    for name, key in (("observations", "obs_id"), ("research_cells", "cell_id"), ("register_entries", "entry_id"), ("documents", "doc_id")):
        one = table(spark, d, name).agg(F.count_distinct(key).alias("n"), F.count_distinct("subject").alias("s"))
        facts = F.array(F.struct(F.lit(f"{name} rows").alias("fact"), F.format_number("n", 0).alias("shown")), F.struct(F.lit(f"{name} subjects").alias("fact"), F.format_number("s", 0).alias("shown")))
        one = one.select(F.inline(facts))
        out = one if out is None else out.unionByName(one)
    return out


def q_edge_runtime(spark, d):
    """Every edge from a prerequisite to a use case in each run: the prerequisite's status, and whether the edge holds the use case back."""
    status = sc.prerequisite_status(sc.scored(table(spark, d, "observations"), table(spark, d, "indicators")))
    edges = status.where("prerequisite like 'UC:%'").select("run_id", "subject", "indicator_id", "status", F.explode(F.split(F.regexp_replace("prerequisite", "^UC:", ""), ",")).alias("use_case"))
    action = F.when(F.col("status") == "Absent", "gate").when(F.col("status") == "Unverified", "verify").when(F.col("status") == "Present (narrow)", "risk").otherwise("none")
    return edges.select("run_id", "subject", "indicator_id", F.trim("use_case").alias("use_case"), "status", action.alias("action"))


def q_first_sources(spark, d):
    """The first four source titles of each subject and indicator, in their order, and how many more there are."""
    c = table(spark, d, "research_cells").where("source_title is not null").groupBy("subject", "indicator_id").agg(F.array_sort(F.collect_set("source_title")).alias("t"))
    return c.select("subject", "indicator_id", F.array_join(F.slice("t", 1, 4), " | ").alias("first"), F.greatest(F.size("t") - 4, F.lit(0)).alias("more"))


def q_written_inventory(spark, d):
    """An inventory written as CSV and read again: guarded texts in the stable order of columns; null and empty are the same in a CSV."""
    path = sinks.scratch(spark, "inventory")
    sinks.write_inventory(table(spark, d, "research_cells").select("cell_id", "subject", "tier", "value", "year").distinct(), path)
    back = spark.read.option("header", True).option("escape", '"').option("multiLine", True).schema("subject string, tier string, year string, cell_id string, value string").csv(path)
    return back.select(F.col("cell_id").cast("bigint").alias("cell_id"), "subject", F.col("year").cast("int").alias("year"), F.coalesce("value", F.lit("")).alias("value"))


def q_written_assembly(spark, d):
    """Sections of a run written as one JSON object each and read again: how many rows each section has."""
    path = sinks.scratch(spark, "assembly")
    rows = sc.scored(table(spark, d, "observations"), table(spark, d, "indicators"))
    gaps = rows.where("cls = 'Gap'").select("run_id", "subject", "indicator_id")
    levels = rows.where("level is not null").select("run_id", "subject", "indicator_id", "level")
    sinks.write_assembled({"gaps": gaps, "levels": levels}, ["run_id", "subject"], path)
    back = spark.read.schema("run_id string, subject string, gaps array<struct<indicator_id:string>>, levels array<struct<indicator_id:string,level:int>>").json(path)
    total = F.aggregate("levels", F.lit(0).cast("bigint"), lambda acc, x: acc + x["level"])
    return back.select("run_id", "subject", F.greatest(F.size("gaps"), F.lit(0)).cast("bigint").alias("gaps"), F.greatest(F.size("levels"), F.lit(0)).cast("bigint").alias("levels"), F.coalesce(total, F.lit(0)).alias("sum_of_levels"))


def q_read_assessments(spark, d):
    """Observations of each run written as an assessment file and read again: numbers stay numbers, texts texts, a null level is told from an absent one."""
    path = sinks.scratch(spark, "assessments")
    o = table(spark, d, "observations").select("run_id", "indicator_id", "value_num", "value_text", "level", "level_present", "year", "obs_id").groupBy("run_id", "indicator_id").agg(F.min_by(F.struct("value_num", "value_text", "level", "level_present", "year"), "obs_id").alias("o")).select("run_id", "indicator_id", "o.*")
    pair = lambda name, c: F.concat(F.lit(f'"{name}":'), F.coalesce(c.cast("string"), F.lit("null")))
    held = F.when(F.col("level_present"), F.concat(F.lit(","), pair("level", F.col("level")))).otherwise("")
    text = F.regexp_extract(F.to_json(F.struct(F.col("value_text").alias("v"))), r"^\{\"v\":(.*)\}$", 1)
    shown = F.when(F.col("value_num").isNotNull(), F.col("value_num").cast("string")).when(F.col("value_text").isNotNull(), text).otherwise("null")
    entry = F.concat(F.lit('"'), F.col("indicator_id"), F.lit('":{"value":'), shown, F.lit(","), pair("year", F.col("year")), held, F.lit("}"))
    files = o.groupBy("run_id").agg(F.array_join(F.sort_array(F.collect_list(entry)), ",").alias("e")).select(F.concat(F.lit('{"subject":"'), "run_id", F.lit('","observations":{'), "e", F.lit("}}")).alias("value"))
    # one file a run: the reader takes a file as one assessment
    files.repartition(F.col("value")).write.option("maxRecordsPerFile", 1).text(path)
    return read_assessments(spark, path).select(F.col("subject").alias("run_id"), "indicator_id", "value_num", "value_text", "level", "level_present", "year")


_NUM = "CASE WHEN regexp_matches(regexp_replace({0}, '[,%\\s]', '', 'g'), '^[-+]?([0-9]+\\.?[0-9]*|\\.[0-9]+)$') THEN try_cast(regexp_replace({0}, '[,%\\s]', '', 'g') AS double) END"
_SAYS = "(length(lower(trim(coalesce({0}, '')))) >= 40 AND NOT regexp_matches(lower(trim(coalesce({0}, ''))), '^(none found|no |not |n/a|unpublished|unmeasured|unverified|no published)'))"
_DERIVED = f"""WITH c AS (SELECT DISTINCT cell_id, indicator_id, value, tier, source_url, presence_rung, quality_evidence, scale_evidence FROM research_cells),
  s AS (SELECT c.*, method, thresholds, direction, {_NUM.format('value')} AS x FROM c JOIN indicators USING (indicator_id)),
  k AS (SELECT *, CASE WHEN method <> 'ladder' AND x IS NOT NULL THEN 'Measured' WHEN coalesce(source_url, '') <> '' AND coalesce(tier, '') <> 'T5' THEN 'Documented' ELSE 'Judged' END AS cls FROM s) """
_LEAF = """v AS (SELECT feed, file_no, json_extract_string(payload, '$.id') AS rid, max(payload) AS payload FROM raw_records WHERE json_valid(payload) AND json_extract_string(payload, '$.id') IS NOT NULL GROUP BY ALL),
  l AS (SELECT v.feed, v.rid, v.file_no, ltrim(substr(t.fullkey, 2), '.') AS path, t.value::varchar AS value FROM v, json_tree(v.payload) t WHERE t.type NOT IN ('ARRAY', 'OBJECT') OR t.value::varchar IN ('[]', '{}')),
  p AS (SELECT feed, rid, file_no, lag(file_no) OVER (PARTITION BY feed, rid ORDER BY file_no) AS before FROM v)"""
_OK = "(SELECT record_id, feed, payload FROM raw_records WHERE json_valid(payload))"
_AUD = "audit AS (SELECT DISTINCT cell_id, subject, year, value, notes FROM research_cells)"
ORACLES = {
    "derived_class": _DERIVED + "SELECT cell_id, cls FROM k",
    "derived_level": _DERIVED + f"""SELECT cell_id, CAST(CASE WHEN method = 'ladder' THEN least(5, CASE presence_rung WHEN 'Absent' THEN 1 WHEN 'Announced' THEN 2 WHEN 'Adopted' THEN 3 WHEN 'Operating' THEN 3 END
      + CASE WHEN presence_rung = 'Operating' AND {_SAYS.format('quality_evidence')} THEN CASE WHEN {_SAYS.format('scale_evidence')} THEN 2 ELSE 1 END ELSE 0 END)
      WHEN cls = 'Measured' AND len(thresholds) > 0 THEN 1 + len(list_filter(thresholds, lambda t: CASE WHEN direction = 'lower' THEN x <= t ELSE x >= t END)) END AS INTEGER) AS level FROM k""",
    "path_diff": f"""WITH {_LEAF}, n AS (SELECT p.feed, p.rid, p.file_no, l.path, l.value FROM p JOIN l ON l.feed = p.feed AND l.rid = p.rid AND l.file_no = p.file_no WHERE before IS NOT NULL),
      o AS (SELECT p.feed, p.rid, p.file_no, l.path, l.value FROM p JOIN l ON l.feed = p.feed AND l.rid = p.rid AND l.file_no = p.before)
      SELECT feed, file_no, path, CASE WHEN o.value IS NULL THEN 'added' WHEN n.value IS NULL THEN 'removed' ELSE 'changed' END AS change, count(*) AS records FROM n FULL JOIN o USING (feed, rid, file_no, path) WHERE n.value IS DISTINCT FROM o.value GROUP BY ALL""",
    "overrides": "SELECT DISTINCT a.cell_id, " + ", ".join(f"CASE WHEN b.cell_id IS NULL THEN a.{c} ELSE b.{c} END AS {c}" for c in PATCHED) + " FROM research_cells a LEFT JOIN research_cells_copy b USING (cell_id)",
    "schema_check": f"""WITH p AS ({" UNION ALL ".join(f"SELECT record_id, feed, '{k}' AS path, 'required' AS problem FROM {_OK} WHERE json_type(payload, '$.{k}') IS NULL" for k in ("id", "tier", "notes"))}
      UNION ALL SELECT record_id, feed, '', 'not JSON' FROM raw_records WHERE NOT coalesce(json_valid(payload), false)
      UNION ALL SELECT record_id, feed, 'id', 'type' FROM {_OK} WHERE json_type(payload, '$.id') <> 'VARCHAR' UNION ALL SELECT record_id, feed, 'id', 'minLength' FROM {_OK} WHERE json_type(payload, '$.id') = 'VARCHAR' AND json_extract_string(payload, '$.id') = ''
      UNION ALL SELECT record_id, feed, 'tier', 'type' FROM {_OK} WHERE json_type(payload, '$.tier') <> 'VARCHAR' UNION ALL SELECT record_id, feed, 'tier', 'enum' FROM {_OK} WHERE json_type(payload, '$.tier') = 'VARCHAR' AND json_extract_string(payload, '$.tier') NOT IN ('T1', 'T2', 'T3')
      UNION ALL SELECT record_id, feed, 'year', 'type' FROM {_OK} WHERE json_type(payload, '$.year') NOT IN ('UBIGINT', 'BIGINT', 'NULL') UNION ALL SELECT record_id, feed, 'year', 'minimum' FROM {_OK} WHERE json_type(payload, '$.year') IN ('UBIGINT', 'BIGINT') AND json_extract_string(payload, '$.year')::bigint < 2015
      UNION ALL SELECT record_id, feed, 'overlap', 'type' FROM {_OK} WHERE json_type(payload, '$.overlap') <> 'ARRAY' UNION ALL SELECT record_id, feed, 'overlap', 'minItems' FROM {_OK} WHERE json_type(payload, '$.overlap') = 'ARRAY' AND json_array_length(payload, '$.overlap') = 0
      UNION ALL SELECT record_id, feed, 'overlap[]', 'type' FROM (SELECT record_id, feed, unnest(json_extract(payload, '$.overlap[*]')) AS x FROM {_OK} WHERE json_type(payload, '$.overlap') = 'ARRAY') WHERE json_type(x) <> 'VARCHAR'
      UNION ALL SELECT record_id, feed, 'uc', 'type' FROM {_OK} WHERE json_type(payload, '$.uc') NOT IN ('ARRAY', 'VARCHAR', 'NULL'))
      SELECT feed, path, problem, count(DISTINCT record_id) AS records FROM p GROUP BY ALL""",
    "strict_json": f"SELECT record_id, 'not JSON' AS problem FROM raw_records WHERE NOT coalesce(json_valid(payload), false) UNION ALL SELECT record_id, 'repeated key' FROM {_OK} WHERE len(json_keys(payload)) > len(list_distinct(json_keys(payload)))",
    "canonical_json": f"""WITH k AS (SELECT record_id, payload, unnest(json_keys(payload)) AS k FROM {_OK}), x AS (SELECT record_id, k, json_extract(payload, '$."' || k || '"') AS x FROM k),
      y AS (SELECT record_id, k, CASE WHEN json_type(x) = 'OBJECT' THEN '{{' || list_aggregate(list_transform(list_sort(json_keys(x)), lambda i: to_json(i)::varchar || ':' || json_extract(x, '$."' || i || '"')::varchar), 'string_agg', ',') || '}}' WHEN json_type(x) = 'DOUBLE' THEN regexp_replace(x::varchar, '[.]?0*$', '') ELSE x::varchar END AS v FROM x)
      SELECT record_id, sha256('{{' || string_agg(to_json(k)::varchar || ':' || v, ',' ORDER BY k) || '}}') AS digest FROM y GROUP BY record_id""",
    "scalar_text": "SELECT DISTINCT entry_id, coalesce(to_json(overlap)::varchar, '') AS overlap, coalesce(funding, '') AS funding FROM register_entries",
    "merged_findings": r"""WITH u AS (SELECT DISTINCT 0 AS source_no, entry_id, subject, name, status FROM register_entries WHERE name IS NOT NULL UNION ALL SELECT DISTINCT 1, entry_id, subject, name, status FROM register_copy WHERE name IS NOT NULL)
      SELECT entry_id, subject, name, status, source_no FROM u QUALIFY row_number() OVER (PARTITION BY subject, lower(trim(regexp_replace(name, '\s+', ' ', 'g'))) ORDER BY source_no, entry_id) = 1""",
    "timeline": "SELECT subject, cell_id, CAST(row_number() OVER (PARTITION BY subject ORDER BY year, source_title, cell_id) AS INTEGER) AS position FROM (SELECT DISTINCT cell_id, subject, year, source_title FROM research_cells WHERE year IS NOT NULL AND source_title IS NOT NULL)",
    "answer_scores": f"""WITH a AS (SELECT DISTINCT cell_id, subject, coalesce(value_type = 'gap', false) AS gap, value_type, value, year, {_NUM.format('value')} AS x FROM research_cells), t AS (SELECT DISTINCT cell_id, coalesce(value_type = 'gap', false) AS tgap, value_type AS tt, value AS tv, year AS ty, {_NUM.format('value')} AS y FROM research_cells_copy),
      j AS (SELECT *, CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN abs(x - y) <= abs(y) * 0.02 ELSE value IS NOT DISTINCT FROM tv END AS same FROM a JOIN t USING (cell_id))
      SELECT subject, count(*) AS cells, count(*) FILTER (WHERE NOT tgap AND NOT gap AND same) AS right, count(*) FILTER (WHERE NOT tgap AND NOT gap AND NOT same) AS wrong, count(*) FILTER (WHERE tgap AND gap) AS rightly_absent, count(*) FILTER (WHERE tgap AND NOT gap) AS made_up,
      count(*) FILTER (WHERE NOT tgap AND gap) AS missed, count(*) FILTER (WHERE value_type IS NOT DISTINCT FROM tt) AS same_type, count(*) FILTER (WHERE year IS NOT DISTINCT FROM ty) AS same_year FROM j GROUP BY subject""",
    "withheld_cause": _OBS + "SELECT indicator_id, CASE WHEN cls = 'Gap' THEN 'gap' WHEN cls = '' THEN 'no value' WHEN level_present THEN 'held' ELSE 'no rule' END AS cause, count(*) AS n, count(DISTINCT subject) AS subjects FROM s WHERE level IS NULL GROUP BY ALL",
    "figure_fidelity": f"""WITH {_AUD}, f AS (SELECT subject, cell_id, year, {_NUM.format('value')} AS v, unnest(regexp_extract_all(notes, '[0-9]+(?:\\.[0-9]+)?')) AS x FROM audit),
      g AS (SELECT subject, count(*) AS claimed, count(*) FILTER (WHERE x::double = v OR x::double = year) AS supported FROM f GROUP BY subject)
      SELECT subject, coalesce(claimed, 0) AS claimed, coalesce(supported, 0) AS supported, coalesce(round((supported / nullif(claimed, 0))::varchar::decimal(38,20), 4)::double, 1.0) AS fidelity FROM (SELECT DISTINCT subject FROM audit) LEFT JOIN g USING (subject)""",
    "lane_gate": r"""SELECT cell_id, CASE WHEN coalesce(source_url, '') = '' THEN 'no page' WHEN code <> '' AND code <> subject THEN 'of another subject' WHEN tier = 'T5' THEN 'weak source' END AS gate
      FROM (SELECT DISTINCT cell_id, subject, tier, source_url, upper(regexp_extract(source_url, '://[a-z]+-([a-z]{3})\.', 1)) AS code FROM research_cells)""",
    "unknown_citations": r"""WITH c AS (SELECT DISTINCT cell_id, notes FROM research_cells WHERE notes IS NOT NULL), l AS (SELECT cell_id, regexp_extract_all(notes, '\b([0-9]+\.[0-9]+)\b', 1) AS xs FROM c)
      SELECT * FROM (SELECT cell_id, CAST(generate_subscripts(xs, 1) - 1 AS INTEGER) AS place, unnest(xs) AS cited FROM l) WHERE cited NOT IN (SELECT indicator_id FROM indicators)""",
    "catalog_errors": """WITH e AS (SELECT indicator_id, list_filter([CASE WHEN method = 'threshold' AND coalesce(len(thresholds), 0) <> 4 THEN 'not four cuts' END,
        CASE WHEN method = 'threshold' AND thresholds <> (CASE WHEN direction = 'lower' THEN list_reverse_sort(thresholds) ELSE list_sort(thresholds) END) THEN 'cuts out of order' END, CASE WHEN method = 'threshold' AND unit IS NULL THEN 'no unit' END,
        CASE WHEN method = 'threshold' AND NOT coalesce(direction IN ('higher', 'lower'), false) THEN 'no direction' END, CASE WHEN method <> 'threshold' AND unit IS NOT NULL THEN 'unit of a ladder' END, CASE WHEN retired_on <= added_on THEN 'retired before it was added' END], lambda x: x IS NOT NULL) AS l FROM indicators)
      SELECT indicator_id, CAST(len(l) AS INTEGER) AS errors, coalesce(array_to_string(l, ', '), '') AS which FROM e""",
    "distinct_areas": "SELECT subject, count(DISTINCT t) AS tables FROM (" + " UNION ALL ".join(f"SELECT trim(subject) AS subject, '{t}' AS t FROM {t}" for t in ("observations", "research_cells", "register_entries", "documents")) + ") WHERE coalesce(subject, '') <> '' GROUP BY subject",
    "headline_figures": " UNION ALL ".join(f"SELECT '{t} {w}' AS fact, format('{{:,}}', count(DISTINCT {k})) AS shown FROM {t}" for t, key in (("observations", "obs_id"), ("research_cells", "cell_id"), ("register_entries", "entry_id"), ("documents", "doc_id")) for w, k in (("rows", key), ("subjects", "subject"))),
    "edge_runtime": _OBS + """, p AS (SELECT run_id, subject, indicator_id, unnest(string_split(substring(prerequisite, 4), ',')) AS use_case, CASE WHEN cls = 'Gap' OR level IS NULL THEN 'Unverified' WHEN level >= 3 THEN 'Present' WHEN level = 2 THEN 'Present (narrow)' ELSE 'Absent' END AS status FROM s WHERE prerequisite LIKE 'UC:%')
      SELECT run_id, subject, indicator_id, trim(use_case) AS use_case, status, CASE status WHEN 'Absent' THEN 'gate' WHEN 'Unverified' THEN 'verify' WHEN 'Present (narrow)' THEN 'risk' ELSE 'none' END AS action FROM p""",
    "first_sources": "WITH t AS (SELECT subject, indicator_id, list_sort(list(DISTINCT source_title)) AS t FROM research_cells WHERE source_title IS NOT NULL GROUP BY ALL) SELECT subject, indicator_id, array_to_string(t[1:4], ' | ') AS first, CAST(greatest(len(t) - 4, 0) AS INTEGER) AS more FROM t",
    "written_inventory": r"SELECT DISTINCT cell_id, subject, year, CASE WHEN regexp_matches(value, '^\s*[=+\-@]') THEN chr(39) || value ELSE coalesce(value, '') END AS value FROM research_cells",
    "written_assembly": _OBS + "SELECT run_id, subject, count(*) FILTER (WHERE cls = 'Gap') AS gaps, count(level) AS levels, CAST(coalesce(sum(level), 0) AS BIGINT) AS sum_of_levels FROM s GROUP BY run_id, subject HAVING count(level) > 0 OR count(*) FILTER (WHERE cls = 'Gap') > 0",
    "read_assessments": "SELECT run_id, indicator_id, value_num, CASE WHEN value_num IS NULL THEN value_text END AS value_text, CASE WHEN level_present THEN level END AS level, level_present, year FROM (SELECT * FROM observations QUALIFY row_number() OVER (PARTITION BY run_id, indicator_id ORDER BY obs_id) = 1)",
}
QUERIES = {name.removeprefix("q_"): f for name, f in list(globals().items()) if name.startswith("q_")}
