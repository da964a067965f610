"""Queries made of rule cascades, completeness checks and journals; with their SQL."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from agrolith.functions import text as tx
from agrolith.operators import rules
from agrolith.sources.tables import table

#: Families of sources by the first pattern that their title matches, in this order.
FAMILIES = (("(?i)survey|census", "survey"), ("(?i)bulletin|brief", "bulletin"), ("(?i)programme|project", "programme"), ("(?i)page|site", "web"))
#: An example of a tree of conditions on three facts that may be unknown.
TREE = {"any": [{"field": "dated", "equals": True}, {"all": [{"field": "tiered", "equals": True}, {"field": "sourced", "equals": True}]}]}


def _cells(spark, d):
    return table(spark, d, "research_cells").select("cell_id", "subject", "indicator_id", "value_type", "value", "year", "tier", "source_title", "source_url", "presence_rung", "quality_evidence").distinct()


def _gates(c):
    blank = lambda x: F.coalesce(F.trim(F.col(x)), F.lit("")) == ""
    return [
        (blank("value"), "nothing asserted"), (blank("source_url"), "no source"), (F.col("tier").rlike("^T5$"), "weak source"), ((F.col("year") < 2016), "too old"),
        (F.col("presence_rung").isin("Adopted", "Operating") & ~tx.substantive(F.col("quality_evidence")), "rung without evidence"),
    ]


def q_gate_first_fail(spark, d):
    c = _cells(spark, d)
    return c.select("cell_id", rules.first_failing(_gates(c)).alias("gate"))


def q_gate_all_fail(spark, d):
    c = _cells(spark, d)
    return c.select("cell_id", F.explode(rules.all_failing(_gates(c))).alias("gate"))


def q_gate_verdict(spark, d):
    """Worst verdict of each cell, counted by subject."""
    c = _cells(spark, d)
    g = _gates(c)
    verdicts = [F.when(g[1][0], "reject"), F.when(F.coalesce(g[2][0], F.lit(False)) | F.coalesce(g[3][0], F.lit(False)), "hold"), F.when(F.coalesce(g[4][0], F.lit(False)), "hold"), F.lit("pass")]
    return c.where(~g[0][0]).groupBy("subject", rules.worst(verdicts).alias("verdict")).agg(F.count("*").alias("cells"))


def q_predicate_kleene(spark, d):
    """A tree of conditions over facts that may be unknown: true, false and unknown cells."""
    c = _cells(spark, d)
    facts = {"dated": F.col("year") >= 2020, "tiered": F.when(F.col("tier").isNotNull(), F.col("tier").rlike("^T[1-3]$")), "sourced": F.when(F.col("source_title").isNotNull(), F.col("source_title") != "")}
    state = F.coalesce(rules.predicate(TREE, facts).cast("string"), F.lit("unknown"))
    return c.groupBy("subject", state.alias("state")).agg(F.count("*").alias("cells"))


def q_mapping_completeness(spark, d):
    """Catalog entries in force against what each edition of the census holds: missing, unknown, repeated."""
    census = table(spark, d, "indicator_census").select("census_id", "edition", "indicator_id").distinct()
    ids = table(spark, d, "indicators").agg(F.collect_list("indicator_id").alias("ids"))  # fixed table, one row
    needed = census.select("edition").distinct().withColumn("k", F.lit(1)).join(ids.withColumn("k", F.lit(1)), "k").select("edition", F.explode("ids").alias("indicator_id"))
    return rules.completeness(needed, census.select("edition", "indicator_id"), ["edition", "indicator_id"])


def q_ledger_prefix(spark, d):
    """How far the values of a subject agree in both systems, in the order of cell_id."""
    a, b = (table(spark, d, t).select("cell_id", "subject", "value").distinct() for t in ("research_cells", "research_cells_copy"))
    return rules.prefix_agreement(a, b, ["subject"], "cell_id", F.concat_ws("|", "cell_id", F.coalesce("value", F.lit("-"))))


def q_journal_validity(spark, d):
    """Users whose journal breaks the order: purchases before any sign-up, sign-ups in a row without a purchase."""
    e = table(spark, d, "events").where("event_type in ('signup', 'purchase')")
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    seq = e.select("user_id", "event_type", F.lag("event_type").over(w).alias("before"))
    return seq.groupBy("user_id").agg(F.count_if((F.col("event_type") == "purchase") & F.col("before").isNull()).alias("unopened"), F.count_if((F.col("event_type") == "signup") & (F.col("before") == "signup")).alias("reopened"))


def q_definition_conflicts(spark, d):
    """Names defined more than once with differing status: the first definition, the number of others, the number that differ."""
    r = table(spark, d, "register_entries").where("name is not null").select("entry_id", "subject", tx.dedupe_key(F.col("name")).alias("key"), F.coalesce("status", F.lit("")).alias("status")).distinct()
    g = r.groupBy("subject", "key").agg(F.min(F.struct("entry_id", "status")).alias("first"), F.collect_set("status").alias("all"), F.count("*").alias("n")).where("n > 1")
    return g.select("subject", "key", F.col("first.entry_id").alias("entry_id"), F.col("first.status").alias("status"), (F.col("n") - 1).alias("others"), (F.size("all") - 1).alias("other_statuses"))


def q_source_family(spark, d):
    """Sources by the first matching family, and the best source of each subject and indicator: family first, then the latest year."""
    c = _cells(spark, d).where("source_title is not null")
    rank = F.coalesce(*[F.when(F.col("source_title").rlike(p), F.lit(i)) for i, (p, _) in enumerate(FAMILIES)], F.lit(len(FAMILIES)))
    best = c.withColumn("rank", rank).groupBy("subject", "indicator_id").agg(F.min(F.struct("rank", (-F.coalesce("year", F.lit(0))).alias("newest"), "cell_id")).alias("b"))
    return best.select("subject", "indicator_id", "b.cell_id", F.try_element_at(F.array(*[F.lit(n) for _, n in FAMILIES]), F.col("b.rank") + 1).alias("family"))


def q_figure_scan(spark, d):
    """Documents that still carry a figure of a given year and a per cent figure: superseded figures looked for by pattern."""
    docs = table(spark, d, "documents").select("doc_id", F.col("text").rlike(r"\b2016\b").alias("old_year"), F.col("text").rlike(r"\d ?(%|per cent)").alias("per_cent")).where("old_year or per_cent")
    return docs.select("doc_id", "old_year", "per_cent")


def q_exclusive_gaps(spark, d):
    """Indicators with a gap in exactly one subject: a difference of sets."""
    g = _cells(spark, d).where("value_type = 'gap'").groupBy("indicator_id").agg(F.count_distinct("subject").alias("n"), F.min("subject").alias("subject"))
    return g.where("n = 1").select("indicator_id", "subject")


_C = "c AS (SELECT DISTINCT cell_id, subject, indicator_id, value_type, value, year, tier, source_title, source_url, presence_rung, quality_evidence FROM research_cells)"
_B = "coalesce(trim({}), '') = ''"
_SUB = "(length(trim(coalesce(quality_evidence, ''))) >= 40 AND NOT regexp_matches(lower(trim(coalesce(quality_evidence, ''))), '^(none found|no |not |n/a|unpublished|unmeasured|unverified|no published)'))"
_RUNG = f"(presence_rung IN ('Adopted', 'Operating') AND NOT {_SUB})"
_G = [(_B.format("value"), "nothing asserted"), (_B.format("source_url"), "no source"), ("tier = 'T5'", "weak source"), ("year < 2016", "too old"), (_RUNG, "rung without evidence")]
_PRED = "((year >= 2020) OR ((CASE WHEN tier IS NOT NULL THEN regexp_matches(tier, '^T[1-3]$') END) AND (CASE WHEN source_title IS NOT NULL THEN source_title <> '' END)))"
_KEY = "regexp_replace(regexp_replace(lower(name), '\\b(the|el|al|programme|program|project|platform|app|application|system|initiative|service|digital|national|smart)\\b', '', 'g'), '[^a-z0-9]', '', 'g')"
ORACLES = {
    "gate_first_fail": f"WITH {_C} SELECT cell_id, CASE {' '.join(f'WHEN {c} THEN {n!r}' for c, n in _G)} END AS gate FROM c",
    "gate_all_fail": f"WITH {_C} " + " UNION ALL ".join(f"SELECT cell_id, {n!r} AS gate FROM c WHERE {c}" for c, n in _G),
    "gate_verdict": f"WITH {_C} SELECT subject, CASE WHEN {_G[1][0]} THEN 'reject' WHEN coalesce(tier = 'T5', false) OR coalesce(year < 2016, false) OR {_RUNG} THEN 'hold' ELSE 'pass' END AS verdict, count(*) AS cells FROM c WHERE NOT ({_G[0][0]}) GROUP BY ALL",
    "predicate_kleene": f"WITH {_C} SELECT subject, CASE WHEN {_PRED} IS NULL THEN 'unknown' WHEN {_PRED} THEN 'true' ELSE 'false' END AS state, count(*) AS cells FROM c GROUP BY ALL",
    "mapping_completeness": """WITH c AS (SELECT DISTINCT census_id, edition, indicator_id FROM indicator_census), n AS (SELECT DISTINCT c.edition, i.indicator_id FROM c, indicators i), g AS (SELECT edition, indicator_id, count(*) AS n FROM c GROUP BY ALL)
      SELECT coalesce(n.edition, g.edition) AS edition, coalesce(n.indicator_id, g.indicator_id) AS indicator_id, CASE WHEN g.n IS NULL THEN 'missing' WHEN n.edition IS NULL THEN 'unknown' ELSE 'repeated' END AS problem
      FROM n FULL JOIN g ON n.edition = g.edition AND n.indicator_id = g.indicator_id WHERE g.n IS NULL OR n.edition IS NULL OR g.n > 1""",
    "ledger_prefix": """WITH a AS (SELECT subject, row_number() OVER (PARTITION BY subject ORDER BY cell_id) AS pos, cell_id || '|' || coalesce(value, '-') AS v FROM (SELECT DISTINCT cell_id, subject, value FROM research_cells)),
      b AS (SELECT subject, row_number() OVER (PARTITION BY subject ORDER BY cell_id) AS pos, cell_id || '|' || coalesce(value, '-') AS v FROM (SELECT DISTINCT cell_id, subject, value FROM research_cells_copy)),
      j AS (SELECT coalesce(a.subject, b.subject) AS subject, coalesce(a.pos, b.pos) AS pos, a.v AS a, b.v AS b FROM a FULL JOIN b ON a.subject = b.subject AND a.pos = b.pos)
      SELECT subject, count(a) AS left_n, count(b) AS right_n, coalesce(min(CASE WHEN a IS DISTINCT FROM b THEN pos END), count(*) + 1) - 1 AS agreed FROM j GROUP BY subject""",
    "journal_validity": "WITH s AS (SELECT user_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events WHERE event_type IN ('signup', 'purchase')) SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase' AND before IS NULL) AS unopened, count(*) FILTER (WHERE event_type = 'signup' AND before = 'signup') AS reopened FROM s GROUP BY user_id",
    "definition_conflicts": f"WITH r AS (SELECT DISTINCT entry_id, subject, {_KEY} AS key, coalesce(status, '') AS status FROM register_entries WHERE name IS NOT NULL) SELECT subject, key, min(entry_id) AS entry_id, first(status ORDER BY entry_id) AS status, count(*) - 1 AS others, CAST(count(DISTINCT status) - 1 AS INTEGER) AS other_statuses FROM r GROUP BY subject, key HAVING count(*) > 1",
    "source_family": f"WITH {_C}, k AS (SELECT *, CASE WHEN regexp_matches(source_title, '(?i)survey|census') THEN 0 WHEN regexp_matches(source_title, '(?i)bulletin|brief') THEN 1 WHEN regexp_matches(source_title, '(?i)programme|project') THEN 2 WHEN regexp_matches(source_title, '(?i)page|site') THEN 3 ELSE 4 END AS rank FROM c WHERE source_title IS NOT NULL) SELECT subject, indicator_id, cell_id, ['survey', 'bulletin', 'programme', 'web'][rank + 1] AS family FROM k QUALIFY row_number() OVER (PARTITION BY subject, indicator_id ORDER BY rank, coalesce(year, 0) DESC, cell_id) = 1",
    "figure_scan": "SELECT * FROM (SELECT doc_id, regexp_matches(text, '\\b2016\\b') AS old_year, regexp_matches(text, '\\d ?(%|per cent)') AS per_cent FROM documents) WHERE old_year OR per_cent",
    "exclusive_gaps": f"WITH {_C} SELECT indicator_id, min(subject) AS subject FROM c WHERE value_type = 'gap' GROUP BY indicator_id HAVING count(DISTINCT subject) = 1",
}
QUERIES = {name.removeprefix("q_"): f for name, f in list(globals().items()) if name.startswith("q_")}
