"""Queries on evidence: texts, sources, rankings, comparisons, journals; with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from agrolith.functions import text as tx
from agrolith.operators import compare, ranking, scoring
from agrolith.sources.tables import table

#: Suffixes of hosts and the tier of what they publish; the longest suffix decides.
NEEDLES = (("example", "T4"), ("archive-xve.example", "T1"), ("stats-xve.example", "T1"), ("bulletin-xve.example", "T3"), ("news-xka.example", "T5"), ("review-qmo.example", "T2"))
#: Terms looked for as whole words.
TERMS = ("maize", "maïs", "Mais", "rice", "barley", "sorghum", "onions", "warehouse receipt", "warehouse", "grower roll", "council", "Derdon")
#: Status words of the register, and tiers that support results.
STATUSES = ("Announced", "Adopted", "Operating", "Closed", "Absent")
#: Names as typed, and aliases of country names.
TYPED_NAMES = ("CANADA", "canada ", "Egypt, Arab Rep.", "Viet Nam", "VIETNAM", "Russian Federation", "United States of America", "Korea", "China, P.R.", "Perú", "peru", "IRAN, ISLAMIC REP.", "Atlantis")
ALIASES = (("viet nam", "VIETNAM"), ("russian federation", "RUSSIA"), ("united states of america", "UNITED STATES"))


def q_ladder_level(spark, d):
    c = table(spark, d, "research_cells").select("cell_id", "presence_rung", "quality_evidence", "scale_evidence").distinct()
    level = scoring.ladder_level(F.col("presence_rung"), tx.substantive(F.col("quality_evidence")), tx.substantive(F.col("scale_evidence")))
    return c.where("presence_rung is not null").select("cell_id", level.alias("level"))


def q_tier_token(spark, d):
    return table(spark, d, "register_entries").select("entry_id", tx.tier_token(F.col("results_tier")).alias("token")).distinct()


def q_numeric_parse(spark, d):
    return table(spark, d, "research_cells").select("cell_id", tx.parse_number(F.col("value")).alias("number")).where("number is not null").distinct()


def q_domain_tier(spark, d):
    """Sources by host, each with the tier of the longest known suffix."""
    hosts = table(spark, d, "research_cells").select(tx.host(F.col("source_url")).alias("host"), "cell_id").distinct().groupBy("host").agg(F.count("*").alias("pages")).where("host <> ''")
    needles = spark.createDataFrame(NEEDLES, "suffix string, tier string")
    suffixes = hosts.select("host", "pages", F.posexplode(tx.host_suffixes(F.col("host"))).alias("pos", "suffix"))
    hit = suffixes.join(needles, "suffix", "left").groupBy("host", "pages").agg(F.min_by("tier", F.when(F.col("tier").isNotNull(), F.col("pos"))).alias("tier"))
    return hit.select("host", "pages", F.coalesce("tier", F.lit("T5")).alias("tier"))


def q_foreign_in_url(spark, d):
    """Cells by whether their source's host carries the subject's code, another subject's, or none."""
    c = table(spark, d, "research_cells").select("cell_id", "subject", F.upper(F.regexp_extract("source_url", r"://[a-z]+-([a-z]{3})\.", 1)).alias("code")).distinct()
    whose = F.when(F.coalesce("code", F.lit("")) == "", "none").when(F.col("code") == F.col("subject"), "own").otherwise("foreign")
    return c.groupBy("subject", whose.alias("whose")).agg(F.count("*").alias("cells"))


def q_term_mentions(spark, d):
    """Documents per term that they contain as a whole word."""
    docs = table(spark, d, "documents").select("doc_id", F.explode(tx.mentions(F.col("text"), list(TERMS))).alias("term"))
    return docs.groupBy("term").agg(F.count("*").alias("documents"))


def q_excerpt_windows(spark, d):
    e = table(spark, d, "documents").where("text is not null").select("doc_id", tx.excerpt(F.col("text"), 300).alias("e"))
    return e.select("doc_id", "e.start", "e.middle", "e.end")


def q_quote_verify(spark, d):
    """Whether each document's title stands in its text."""
    return table(spark, d, "documents").select("doc_id", tx.quote_verified(F.col("title"), F.col("text")).alias("verified"))


def q_numeric_mentions(spark, d):
    m = table(spark, d, "documents").select("doc_id", F.explode(tx.numeric_mentions(F.col("text"))).alias("m"))
    return m.select("doc_id", "m.start", "m.raw", "m.number", "m.currency", "m.unit")


def q_reference_ids(spark, d):
    """Ids of the catalog cited in the notes of cells."""
    ids = table(spark, d, "indicators").select(F.col("indicator_id").alias("cited"))
    cited = table(spark, d, "research_cells").select("cell_id", F.explode(F.array_distinct(F.regexp_extract_all("notes", F.lit(r"\b([1-9][0-9]?\.[1-9][0-9]?)\b"), 1))).alias("cited"))
    return cited.join(ids, "cited", "left_semi").select("cell_id", "cited").distinct()


def q_dedupe_first(spark, d):
    """Reposts: the first document of each text and the number of copies, by a digest of the text."""
    docs = table(spark, d, "documents").where("text is not null")
    return ranking.keep_first(docs, [F.sha2("text", 256).alias("digest")], "doc_id").select("doc_id", "copies")


def q_dedupe_key(spark, d):
    return table(spark, d, "register_entries").where("name is not null").select("entry_id", tx.dedupe_key(F.col("name")).alias("key")).distinct()


def q_fuzzy_dupes(spark, d):
    keys = table(spark, d, "register_entries").where("name is not null").select("subject", tx.dedupe_key(F.col("name")).alias("key"))
    return ranking.contained_keys(keys, ["subject"], "key")


def q_normal_form(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.normal_form(F.col("title")).alias("title"))


def q_spreadsheet_guard(spark, d):
    return table(spark, d, "research_cells").where("value is not null").select("cell_id", tx.guard_spreadsheet(F.col("value")).alias("cell")).distinct()


def q_html_strip(spark, d):
    return table(spark, d, "documents").where("text like '%<%>%'").select("doc_id", tx.strip_html(F.col("text")).alias("plain"))


def q_canonical_hash(spark, d):
    c = table(spark, d, "research_cells").select("cell_id", "subject", "indicator_id", F.coalesce("value", F.lit("")).alias("value")).distinct()
    return c.select("cell_id", F.sha2(F.concat_ws("\u001f", "subject", "indicator_id", "value"), 256).alias("digest"))


def q_flatten_paths(spark, d):
    """How many records have each key at the top level; flatten_leaves has the paths below them."""
    v = table(spark, d, "raw_records").select("record_id", F.try_parse_json("payload").alias("v")).where("v is not null")
    leaves = v.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select("record_id", "key")
    return leaves.groupBy("key").agg(F.count_distinct("record_id").alias("records"))


def q_flatten_leaves(spark, d):
    """Records flattened to path and leaf type, down to the leaves: how many records have each."""
    leaves = table(spark, d, "raw_records").select("record_id", F.inline(tx.leaf_paths(F.col("payload"))))
    return leaves.groupBy("path", "type").agg(F.count_distinct("record_id").alias("records"))


def q_quota_rank(spark, d):
    pages = table(spark, d, "research_cells").select("subject", "indicator_id", F.regexp_extract("tier", "^(T[1-5])$", 1).alias("tier"), F.col("source_url").alias("url")).where("tier <> '' and url is not null").distinct()
    picked = ranking.quota_rank(pages, ["subject", "indicator_id"], [F.col("tier"), F.col("url")])
    return picked.select("subject", "indicator_id", "tier", "url", "backfill", "position")


def q_batch_greedy(spark, d):
    """The notes of each run packed in the order of obs_id under a limit of characters; a run has at most the catalog's rows."""
    o = table(spark, d, "observations").where("coalesce(note, '') <> ''").select("run_id", "obs_id", F.length("note").cast("bigint").alias("size")).distinct()
    per = o.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("obs_id", "size"))).alias("items"))
    return per.select("run_id", F.inline(F.arrays_zip(F.col("items.obs_id").alias("obs_id"), ranking.greedy_batches(F.col("items.size"), 600).alias("batch"))))


def q_rates(spark, d):
    """Rates per subject; null where there is nothing to rate."""
    c = table(spark, d, "research_cells").select("cell_id", "subject", "value_type", "year", F.regexp_extract("tier", "^(T[1-5])$", 1).alias("tier")).distinct()
    g = c.groupBy("subject").agg(F.count("*").alias("n"), F.count_if(F.expr("value_type = 'gap'")).alias("gaps"), F.count_if(F.expr("tier <> ''")).alias("tiered"), F.count_if(F.expr("tier in ('T1', 'T2', 'T3')")).alias("admissible"), F.count_if(F.expr("value_type = 'number'")).alias("numbers"), F.count_if(F.expr("value_type = 'number' and year is not null")).alias("dated"))
    return g.select("subject", "n", compare.rate(F.col("gaps"), F.col("n")).alias("gap_pct"), compare.rate(F.col("admissible"), F.col("tiered")).alias("admissible_pct"), compare.rate(F.col("dated"), F.col("numbers")).alias("dated_pct"))


def q_discovery(spark, d):
    """Pages, admissible pages and distinct admissible cells per kind of source."""
    c = table(spark, d, "research_cells").select("cell_id", F.regexp_extract("source_url", r"://([a-z]+)-", 1).alias("surfacer"), "source_url", F.regexp_extract("tier", "^(T[1-3])$", 1).alias("ok")).where("source_url is not null").distinct()
    return c.groupBy("surfacer").agg(F.count_distinct("source_url").alias("pages"), F.count_distinct(F.when(F.col("ok") != "", F.col("source_url"))).alias("admissible"), F.count_distinct(F.when(F.col("ok") != "", F.col("cell_id"))).alias("cells"))


def _census(spark, d) -> DataFrame:
    c = table(spark, d, "indicator_census").select("census_id", "subject", "indicator_id", "edition", "pillar", "layer", "method", "disposition", "merged_into", "decided_at").distinct()
    return compare.last_version(c, ["subject", "indicator_id", "edition"], ["decided_at", "census_id"], ["pillar", "layer", "method", "disposition", "merged_into"])


def q_version_changes(spark, d):
    """Fields of the census that changed from one edition to the next, by the last decision on the indicator in each."""
    c = table(spark, d, "indicator_census").select("census_id", "indicator_id", "edition", "pillar", "layer", "method", "disposition", "merged_into", "decided_at").distinct()
    last = compare.last_version(c, ["indicator_id", "edition"], ["decided_at", "census_id"], ["pillar", "layer", "method", "disposition", "merged_into"])
    return compare.version_changes(last, ["indicator_id"], "edition", ["pillar", "layer", "method", "disposition", "merged_into"])


def q_last_wins(spark, d):
    return _census(spark, d).select("subject", "indicator_id", "edition", "census_id", "disposition")


def q_first_known(spark, d):
    """Values by cell: the main system wins, the copy fills what it lacks."""
    cols = ["subject", "indicator_id", "value"]
    main, copy = (table(spark, d, t).select("cell_id", *cols).distinct() for t in ("research_cells", "research_cells_copy"))
    return compare.first_known((main, "main"), (copy, "copy"), keys=["cell_id"], values=cols)


def q_corroborated(spark, d):
    """Numeric values of both systems: whether they agree within two percent."""
    a, b = (table(spark, d, t).select("cell_id", tx.parse_number(F.col("value")).alias(n)).where(f"{n} is not null").distinct() for t, n in (("research_cells", "a"), ("research_cells_copy", "b")))
    return a.join(b, "cell_id").select("cell_id", compare.within(F.col("a"), F.col("b"), 0.02).alias("agrees"))


def q_set_algebra(spark, d):
    """Indicators by whether they are observed, researched, both: union, intersection and difference in one pass."""
    o = table(spark, d, "observations").select("subject", "indicator_id", F.lit(1).alias("o"), F.lit(0).alias("r"))
    r = table(spark, d, "research_cells").select("subject", "indicator_id", F.lit(0).alias("o"), F.lit(1).alias("r"))
    g = o.unionByName(r).groupBy("subject", "indicator_id").agg(F.max("o").alias("o"), F.max("r").alias("r"))
    return g.groupBy("subject").agg(F.count("*").alias("either"), F.sum(F.col("o") * F.col("r")).alias("both"), F.sum(F.col("o") * (1 - F.col("r"))).alias("only_observed"), F.sum(F.col("r") * (1 - F.col("o"))).alias("only_researched"))


def q_source_inventory(spark, d):
    """Sources of all tables by URL, with the first table that names them and the number of rows that do."""
    parts = [("1 observations", "observations", "url", "src", "obs_id"), ("2 cells", "research_cells", "source_url", "source_title", "cell_id"), ("3 register", "register_entries", "src_url", "src", "entry_id")]
    out = None
    for origin, name, url, title, key in parts:
        one = table(spark, d, name).where(F.coalesce(F.col(url), F.lit("")) != "").select(F.col(url).alias("url"), F.col(title).alias("title"), F.col(key).alias("k")).distinct().select("url", "title", F.lit(origin).alias("origin"))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("url").agg(F.min("origin").alias("first_origin"), F.min("title").alias("title"), F.count("*").alias("uses"))


def q_name_resolution(spark, d):
    """Typed names resolved to the list: exact, then alias, then what stands before a comma if it is unique."""
    names = table(spark, d, "nation").select(F.col("n_name").alias("name"), tx.normal_form(F.col("n_name")).alias("key"))
    typed = spark.createDataFrame([(t,) for t in TYPED_NAMES], "typed string").withColumn("key", tx.normal_form(F.col("typed")))
    alias = spark.createDataFrame(ALIASES, "key string, alias string")
    heads = names.groupBy(F.split("key", ",")[0].alias("head")).agg(F.count("*").alias("n"), F.min("name").alias("head_name")).where("n = 1")
    hit = typed.join(names, "key", "left").join(alias, "key", "left").withColumn("head", F.trim(F.split("key", ",")[0])).join(heads, "head", "left")
    return hit.select("typed", F.coalesce("name", "alias", "head_name").alias("resolved"))


def q_register_gate(spark, d):
    """The first rule that a register entry breaks, null if it passes."""
    r = table(spark, d, "register_entries").select("entry_id", "name", "lead", "status", "tier", "results_tier").distinct()
    blank = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    first = (
        F.when(blank("name"), "no name").when(blank("lead"), "no lead").when(~F.coalesce(F.col("tier"), F.lit("")).rlike("^T[1-5]$"), "tier not valid")
        .when(~F.coalesce(F.col("status"), F.lit("")).isin(*STATUSES), "status not valid")
        .when(~blank("results_tier") & ~F.coalesce(tx.tier_token(F.col("results_tier")), F.lit("")).isin("T1", "T2", "T3"), "results not supported")
    )
    return r.select("entry_id", first.alias("broken"))


def q_accepted_numbered(spark, d):
    """Accepted register entries, numbered anew within each run; run by run, so no window is larger than a run."""
    ok = q_register_gate(spark, d).where("broken is null").join(table(spark, d, "register_entries").select("entry_id", "run_id").distinct(), "entry_id")
    return ok.select("run_id", "entry_id", F.row_number().over(W.partitionBy("run_id").orderBy("entry_id")).alias("finding_no"))


def q_event_rollup(spark, d):
    """Journal totals by kind, summed exactly and rounded once."""
    e = table(spark, d, "events")
    return e.groupBy("event_type").agg(F.count("*").alias("calls"), F.count_distinct("user_id").alias("users"), F.round(F.sum(F.col("value").cast("decimal(18,4)")), 4).cast("double").alias("total"))


def q_open_signups(spark, d):
    """Sign-ups without a later purchase of the user: an anti join on the user's last purchase."""
    e = table(spark, d, "events")
    last = e.where("event_type = 'purchase'").groupBy("user_id").agg(F.max("ts").alias("last_purchase"))
    return e.where("event_type = 'signup'").join(last, "user_id", "left").where("last_purchase is null or last_purchase <= ts").select("event_id", "user_id")


def q_event_sequence(spark, d):
    """Events of each user numbered in time, with the minutes since the one before."""
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, d, "events")
    return e.select("event_id", F.row_number().over(w).alias("seq"), F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lag("ts").over(w).cast("timestamp"))) / 60000000).alias("minutes"))


def q_props_json(spark, d):
    """A field of the JSON properties, averaged by kind of event."""
    e = table(spark, d, "events").select("event_type", F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    return e.groupBy("event_type").agg(F.sum("k").alias("k_sum"), F.max("k").alias("k_max"))


def q_union_sources(spark, d):
    """Numbers of rows by table and subject of all tables about subjects."""
    out = None
    for t, k in (("observations", "obs_id"), ("indicator_census", "census_id"), ("research_cells", "cell_id"), ("register_entries", "entry_id"), ("documents", "doc_id")):
        one = table(spark, d, t).select(F.lit(t).alias("table_name"), "subject", F.col(k).alias("k"))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("table_name", "subject").agg(F.count_distinct("k").alias("rows"))


def q_rollup_levels(spark, d):
    """Means by pillar and layer, by pillar, by layer and over all, in one pass (grouping sets)."""
    rows = scoring.scored(table(spark, d, "observations"), table(spark, d, "indicators"))
    return rows.groupingSets([["pillar", "layer"], ["pillar"], ["layer"], []], "pillar", "layer").agg(F.round(F.avg("level"), 2).alias("mean"), F.count("level").alias("rated"))


_T = "('" + "'), ('".join(t.replace("'", "''") for t in TERMS) + "')"
_BAD = "regexp_matches(coalesce({0}, ''), '^T[1-5]$')"
_NORM = "lower(trim(regexp_replace({0}, '\\s+', ' ', 'g')))"
_KEY = "regexp_replace(regexp_replace(lower(name), '\\b(the|el|al|programme|program|project|platform|app|application|system|initiative|service|digital|national|smart)\\b', '', 'g'), '[^a-z0-9]', '', 'g')"
_SUB = "(length(lower(trim(coalesce({0}, '')))) >= 40 AND NOT regexp_matches(lower(trim(coalesce({0}, ''))), '^(none found|no |not |n/a|unpublished|unmeasured|unverified|no published)'))"
_GATE = """CASE WHEN coalesce(trim(name), '') = '' THEN 'no name' WHEN coalesce(trim(lead), '') = '' THEN 'no lead' WHEN NOT regexp_matches(coalesce(tier, ''), '^T[1-5]$') THEN 'tier not valid'
  WHEN coalesce(status, '') NOT IN ('Announced', 'Adopted', 'Operating', 'Closed', 'Absent') THEN 'status not valid' WHEN coalesce(trim(results_tier), '') <> '' AND regexp_extract(results_tier, '(T[1-5])', 1) NOT IN ('T1', 'T2', 'T3') THEN 'results not supported' END"""
_REG = "(SELECT DISTINCT entry_id, run_id, name, lead, status, tier, results_tier FROM register_entries)"
_LASTC = """c AS (SELECT * FROM (SELECT DISTINCT census_id, subject, indicator_id, edition, pillar, layer, method, disposition, merged_into, decided_at FROM indicator_census)
  QUALIFY row_number() OVER (PARTITION BY subject, indicator_id, edition ORDER BY decided_at DESC, census_id DESC) = 1)"""

ORACLES = {
    "ladder_level": f"""SELECT DISTINCT cell_id, CAST(least(5, CASE presence_rung WHEN 'Absent' THEN 1 WHEN 'Announced' THEN 2 WHEN 'Adopted' THEN 3 WHEN 'Operating' THEN 3 END
      + CASE WHEN presence_rung = 'Operating' AND {_SUB.format('quality_evidence')} THEN CASE WHEN {_SUB.format('scale_evidence')} THEN 2 ELSE 1 END ELSE 0 END) AS INTEGER) AS level FROM research_cells WHERE presence_rung IS NOT NULL""",
    "tier_token": "SELECT DISTINCT entry_id, nullif(regexp_extract(results_tier, '(T[1-5])', 1), '') AS token FROM register_entries",
    "numeric_parse": "SELECT DISTINCT cell_id, number FROM (SELECT cell_id, CASE WHEN regexp_matches(regexp_replace(value, '[,%\\s]', '', 'g'), '^[-+]?([0-9]+\\.?[0-9]*|\\.[0-9]+)$') THEN try_cast(regexp_replace(value, '[,%\\s]', '', 'g') AS double) END AS number FROM research_cells) WHERE number IS NOT NULL",
    "domain_tier": "WITH h AS (SELECT host, count(DISTINCT cell_id) AS pages FROM (SELECT cell_id, regexp_extract(lower(source_url), '^[a-z][a-z0-9+.-]*://([^/:?#]+)', 1) AS host FROM research_cells) WHERE host <> '' GROUP BY host), n(suffix, tier) AS (VALUES "
    + ", ".join(f"('{s}', '{t}')" for s, t in NEEDLES)
    + ") SELECT host, pages, coalesce((SELECT tier FROM n WHERE host = suffix OR host LIKE '%.' || suffix ORDER BY length(suffix) DESC LIMIT 1), 'T5') AS tier FROM h",
    "foreign_in_url": "SELECT subject, CASE WHEN coalesce(code, '') = '' THEN 'none' WHEN code = subject THEN 'own' ELSE 'foreign' END AS whose, count(*) AS cells FROM (SELECT DISTINCT cell_id, subject, upper(regexp_extract(source_url, '://[a-z]+-([a-z]{3})\\.', 1)) AS code FROM research_cells) GROUP BY ALL",
    "term_mentions": f"WITH t(term) AS (VALUES {_T.replace('), (', '), (')}) SELECT term, count(*) AS documents FROM documents, t WHERE regexp_matches(text, '(?i)(^|[^A-Za-z])' || term || '([^A-Za-z]|$)') GROUP BY term",
    "excerpt_windows": "SELECT doc_id, CASE WHEN length(text) <= 300 THEN text ELSE substring(text, 1, 100) END AS start, CASE WHEN length(text) <= 300 THEN '' ELSE substring(text, CAST(floor((length(text) - 100) / 2) AS BIGINT) + 1, 100) END AS middle, CASE WHEN length(text) <= 300 THEN '' ELSE substring(text, length(text) - 99, 100) END AS end FROM documents WHERE text IS NOT NULL",
    "reference_ids": "SELECT DISTINCT cell_id, cited FROM (SELECT cell_id, unnest(regexp_extract_all(notes, '\\b([1-9][0-9]?\\.[1-9][0-9]?)\\b', 1)) AS cited FROM research_cells) WHERE cited IN (SELECT indicator_id FROM indicators)",
    "dedupe_first": "SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents WHERE text IS NOT NULL GROUP BY text",
    "dedupe_key": f"SELECT DISTINCT entry_id, {_KEY} AS key FROM register_entries WHERE name IS NOT NULL",
    "fuzzy_dupes": f"WITH k AS (SELECT DISTINCT subject, {_KEY} AS key FROM register_entries WHERE name IS NOT NULL) SELECT DISTINCT a.subject, a.key AS short, b.key AS long FROM k a JOIN k b ON a.subject = b.subject AND length(a.key) >= 5 AND length(a.key) < length(b.key) AND contains(b.key, a.key)",
    "normal_form": f"SELECT doc_id, {_NORM.format('title')} AS title FROM documents",
    "spreadsheet_guard": "SELECT DISTINCT cell_id, CASE WHEN regexp_matches(value, '^\\s*[=+\\-@]') THEN '''' || value ELSE value END AS cell FROM research_cells WHERE value IS NOT NULL",
    "html_strip": "SELECT doc_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(text, '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '\\s+', ' ', 'g')) AS plain FROM documents WHERE text LIKE '%<%>%'",
    "canonical_hash": "SELECT DISTINCT cell_id, sha256(subject || chr(31) || indicator_id || chr(31) || coalesce(value, '')) AS digest FROM research_cells",
    "flatten_paths": "SELECT key, count(DISTINCT record_id) AS records FROM (SELECT record_id, unnest(json_keys(payload)) AS key FROM raw_records WHERE json_valid(payload)) GROUP BY key",
    "flatten_leaves": """WITH v AS (SELECT record_id, CASE WHEN json_valid(payload) THEN payload END AS payload FROM raw_records),
      n AS (SELECT record_id, ltrim(substr(t.fullkey, 2), '.') AS path, t.type, t.value::varchar AS value FROM v, json_tree(v.payload) t)
      SELECT path, CASE type WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' ELSE 'number' END AS type, count(DISTINCT record_id) AS records
      FROM n WHERE type NOT IN ('ARRAY', 'OBJECT') OR value IN ('[]', '{}') GROUP BY ALL""",
    "batch_greedy": """WITH RECURSIVE o AS (SELECT run_id, obs_id, size, row_number() OVER (PARTITION BY run_id ORDER BY obs_id, size) AS n FROM (SELECT DISTINCT run_id, obs_id, length(note) AS size FROM observations WHERE coalesce(note, '') <> '')),
      b(run_id, n, obs_id, batch, used) AS (SELECT run_id, n, obs_id, 1, size FROM o WHERE n = 1
        UNION ALL SELECT o.run_id, o.n, o.obs_id, CASE WHEN b.used + o.size <= 600 THEN b.batch ELSE b.batch + 1 END, CASE WHEN b.used + o.size <= 600 THEN b.used + o.size ELSE o.size END FROM b JOIN o ON o.run_id = b.run_id AND o.n = b.n + 1)
      SELECT run_id, obs_id, batch FROM b""",
    "quota_rank": """WITH p AS (SELECT DISTINCT subject, indicator_id, tier, source_url AS url FROM research_cells WHERE regexp_matches(tier, '^T[1-5]$') AND source_url IS NOT NULL),
      r AS (SELECT *, row_number() OVER (PARTITION BY subject, indicator_id ORDER BY tier, url) AS rank, row_number() OVER (PARTITION BY subject, indicator_id, tier ORDER BY tier, url) > CASE tier WHEN 'T1' THEN 4 WHEN 'T5' THEN 1 ELSE 2 END AS backfill FROM p)
      SELECT * FROM (SELECT subject, indicator_id, tier, url, backfill, CAST(row_number() OVER (PARTITION BY subject, indicator_id ORDER BY backfill, rank) AS INTEGER) AS position FROM r) WHERE position <= 10""",
    "rates": """WITH g AS (SELECT subject, count(*) n, count(*) FILTER (WHERE value_type = 'gap') gaps, count(*) FILTER (WHERE regexp_matches(tier, '^T[1-5]$')) tiered, count(*) FILTER (WHERE tier IN ('T1', 'T2', 'T3')) adm,
      count(*) FILTER (WHERE value_type = 'number') num, count(*) FILTER (WHERE value_type = 'number' AND year IS NOT NULL) dated FROM (SELECT DISTINCT cell_id, subject, value_type, year, tier FROM research_cells) GROUP BY subject)
      SELECT subject, n, round((100 * gaps / nullif(n, 0))::varchar::decimal(38,20), 1)::double AS gap_pct, round((100 * adm / nullif(tiered, 0))::varchar::decimal(38,20), 1)::double AS admissible_pct, round((100 * dated / nullif(num, 0))::varchar::decimal(38,20), 1)::double AS dated_pct FROM g""",
    "discovery": "SELECT regexp_extract(source_url, '://([a-z]+)-', 1) AS surfacer, count(DISTINCT source_url) AS pages, count(DISTINCT CASE WHEN tier IN ('T1','T2','T3') THEN source_url END) AS admissible, count(DISTINCT CASE WHEN tier IN ('T1','T2','T3') THEN cell_id END) AS cells FROM research_cells WHERE source_url IS NOT NULL GROUP BY 1",
    "version_changes": "WITH c AS (SELECT * FROM (SELECT DISTINCT census_id, indicator_id, edition, pillar, layer, method, disposition, merged_into, decided_at FROM indicator_census) QUALIFY row_number() OVER (PARTITION BY indicator_id, edition ORDER BY decided_at DESC, census_id DESC) = 1), u AS (SELECT indicator_id, edition, unnest(['pillar','layer','method','disposition','merged_into']) AS field, unnest([pillar, layer, method, disposition, merged_into]) AS new FROM c), l AS (SELECT *, lag(edition) OVER w AS before, lag(new) OVER w AS old FROM u WINDOW w AS (PARTITION BY indicator_id, field ORDER BY edition)) SELECT indicator_id, edition, before, field, old, new FROM l WHERE before IS NOT NULL AND old IS DISTINCT FROM new",
    "last_wins": f"WITH {_LASTC} SELECT subject, indicator_id, edition, census_id, disposition FROM c",
    "first_known": "WITH a AS (SELECT DISTINCT cell_id, subject, indicator_id, value FROM research_cells), b AS (SELECT DISTINCT cell_id, subject, indicator_id, value FROM research_cells_copy) SELECT *, 'main' AS source FROM a UNION ALL SELECT *, 'copy' FROM b WHERE cell_id NOT IN (SELECT cell_id FROM a)",
    "corroborated": "WITH a AS (SELECT DISTINCT cell_id, CASE WHEN regexp_matches(regexp_replace(value, '[,%\\s]', '', 'g'), '^[-+]?([0-9]+\\.?[0-9]*|\\.[0-9]+)$') THEN try_cast(regexp_replace(value, '[,%\\s]', '', 'g') AS double) END AS a FROM research_cells), b AS (SELECT DISTINCT cell_id, CASE WHEN regexp_matches(regexp_replace(value, '[,%\\s]', '', 'g'), '^[-+]?([0-9]+\\.?[0-9]*|\\.[0-9]+)$') THEN try_cast(regexp_replace(value, '[,%\\s]', '', 'g') AS double) END AS b FROM research_cells_copy) SELECT cell_id, abs(a - b) <= abs(b) * 0.02 AS agrees FROM a JOIN b USING (cell_id) WHERE a IS NOT NULL AND b IS NOT NULL",
    "set_algebra": "WITH o AS (SELECT DISTINCT subject, indicator_id FROM observations), r AS (SELECT DISTINCT subject, indicator_id FROM research_cells) SELECT coalesce(o.subject, r.subject) AS subject, count(*) AS either, count(*) FILTER (WHERE o.subject IS NOT NULL AND r.subject IS NOT NULL) AS both, count(*) FILTER (WHERE r.subject IS NULL) AS only_observed, count(*) FILTER (WHERE o.subject IS NULL) AS only_researched FROM o FULL JOIN r ON o.subject = r.subject AND o.indicator_id = r.indicator_id GROUP BY 1",
    "source_inventory": "WITH u AS (SELECT url, src AS title, '1 observations' AS origin FROM (SELECT DISTINCT url, src, obs_id FROM observations) UNION ALL SELECT source_url, source_title, '2 cells' FROM (SELECT DISTINCT source_url, source_title, cell_id FROM research_cells) UNION ALL SELECT src_url, src, '3 register' FROM (SELECT DISTINCT src_url, src, entry_id FROM register_entries)) SELECT url, min(origin) AS first_origin, min(title) AS title, count(*) AS uses FROM u WHERE coalesce(url, '') <> '' GROUP BY url",
    "name_resolution": "WITH t(typed) AS (VALUES " + ", ".join(f"('{t}')" for t in TYPED_NAMES) + "), n AS (SELECT n_name AS name, lower(n_name) AS key FROM nation), a(key, alias) AS (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in ALIASES)
    + f") SELECT typed, coalesce((SELECT min(name) FROM n WHERE key = {_NORM.format('typed')}), (SELECT min(alias) FROM a WHERE key = {_NORM.format('typed')}), (SELECT CASE WHEN count(*) = 1 THEN min(name) END FROM n WHERE split_part(key, ',', 1) = trim(split_part({_NORM.format('typed')}, ',', 1)))) AS resolved FROM t",
    "register_gate": f"SELECT entry_id, {_GATE} AS broken FROM {_REG}",
    "accepted_numbered": f"SELECT run_id, entry_id, CAST(row_number() OVER (PARTITION BY run_id ORDER BY entry_id) AS INTEGER) AS finding_no FROM {_REG} WHERE {_GATE} IS NULL",
    "event_rollup": "SELECT event_type, count(*) AS calls, count(DISTINCT user_id) AS users, round(sum(value::decimal(18,4)), 4)::double AS total FROM events GROUP BY event_type",
    "open_signups": "SELECT event_id, user_id FROM events s WHERE event_type = 'signup' AND NOT EXISTS (SELECT 1 FROM events p WHERE p.user_id = s.user_id AND p.event_type = 'purchase' AND p.ts > s.ts)",
    "event_sequence": "SELECT event_id, CAST(row_number() OVER w AS INTEGER) AS seq, CAST(floor((epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 60000000) AS BIGINT) AS minutes FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)",
    "props_json": "SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum, max(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS k_max FROM events GROUP BY event_type",
    "union_sources": " UNION ALL ".join(f"SELECT '{t}' AS table_name, subject, count(DISTINCT {k}) AS rows FROM {t} GROUP BY subject" for t, k in (("observations", "obs_id"), ("indicator_census", "census_id"), ("research_cells", "cell_id"), ("register_entries", "entry_id"), ("documents", "doc_id"))),
}
from agrolith.plans.scoring import _OBS, _R2  # noqa: E402

ORACLES["rollup_levels"] = _OBS + f"SELECT pillar, layer, {_R2.format('sum(level) / nullif(count(level), 0)')} AS mean, count(level) AS rated FROM s GROUP BY GROUPING SETS ((pillar, layer), (pillar), (layer), ())"

QUERIES = {name.removeprefix("q_"): f for name, f in list(globals().items()) if name.startswith("q_")}
