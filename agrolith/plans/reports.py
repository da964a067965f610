"""Derived report sets: scopes, crosswalks, comparisons of profiles, inventories of figures; with their SQL."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agrolith.functions import text as tx
from agrolith.operators import scoring as sc
from agrolith.plans.scoring import _OBS, _PROFILE
from agrolith.sources.tables import table

#: Patterns of labels that hint at an indicator, by number.
PROBES = ((1, "(?i)mobile|phone"), (2, "(?i)internet|online"), (3, "(?i)credit|loan"), (4, "(?i)yield|harvest"), (5, "(?i)women"))


def _rows(spark, d):
    return sc.scored(table(spark, d, "observations"), table(spark, d, "indicators"))


def q_in_scope(spark, d):
    """Rows looked at again: prerequisites, gaps and holds, with the role that comes first."""
    r = _rows(spark, d)
    role = F.when(F.coalesce("prerequisite", F.lit("")) != "", "prerequisite").when(F.col("cls") == "Gap", "gap").when(F.col("level").isNull(), "hold")
    return r.select("obs_id", role.alias("role")).where("role is not null")


def q_crosswalk(spark, d):
    """Binding constraints of the need pillar, led to the use cases they bear on."""
    top = sc.constraints(_rows(spark, d))
    need = table(spark, d, "indicators").where("pillar = 'A1'").select("indicator_id")
    bears = sc.bearing(table(spark, d, "indicators"), table(spark, d, "use_cases"))
    return top.join(need, "indicator_id", "left_semi").join(bears, "indicator_id").select("run_id", "subject", "indicator_id", "level", "use_case")


def q_sub_readings(spark, d):
    """Indicators that observations name as sub-readings, with the catalog's name where it has one."""
    subs = table(spark, d, "observations").select("obs_id", F.explode("subs").alias("sub")).distinct()
    names = table(spark, d, "indicators").select(F.col("indicator_id").alias("sub"), "name")
    return subs.groupBy("sub").agg(F.count("*").alias("uses")).join(names, "sub", "left")


def q_public_tier(spark, d):
    """Tiers as stated against tiers as the source's name suggests."""
    o = table(spark, d, "observations").where("src is not null").select("obs_id", "tier", tx.public_tier(F.col("src"), F.col("url")).alias("suggested")).distinct()
    return o.groupBy("tier", "suggested").agg(F.count("*").alias("n"))


def q_transforms(spark, d):
    """Measured values as published and as scored: shares per cent, the others as they are; equal within a relative 1e-9."""
    r = _rows(spark, d).where("cls = 'Measured' and value_num is not null").join(table(spark, d, "indicators").select("indicator_id", "unit"), "indicator_id")
    scaled = F.when(F.col("unit") == "%", F.col("value_num") / 100).otherwise(F.col("value_num"))
    back = F.when(F.col("unit") == "%", scaled * 100).otherwise(scaled)
    same = F.abs(back - F.col("value_num")) <= F.greatest(F.lit(1e-9), F.abs(F.col("value_num")) * 1e-9)
    return r.select("obs_id", F.round(scaled, 6).alias("scaled"), same.alias("same"))


def q_line_transforms(spark, d):
    """The four transforms of raw figures on the lines of orders: as it is, per cent to a share, a monthly price against a twelfth of a yearly sum, a difference that is never negative."""
    l = table(spark, d, "lineitem").join(table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice"), "l_orderkey")
    kinds = {"identity": ("l_quantity", None), "share": ("l_quantity", None), "price_share": ("l_extendedprice", "o_totalprice"), "excess": ("l_quantity", "l_linenumber")}
    return l.select("l_orderkey", "l_linenumber", *[F.round(sc.transformed(k, F.col(a), F.col(b) if b else F.lit(None)), 6).alias(k) for k, (a, b) in kinds.items()])


def q_pillar_compare(spark, d):
    """Bands of each pillar against the subject's run before."""
    runs = table(spark, d, "observations").groupBy("run_id", "subject").agg(F.min("observed_at").alias("began"))
    order = W.partitionBy("subject").orderBy("began", "run_id")
    pairs = runs.select("run_id", F.lag("run_id").over(order).alias("before")).where("before is not null")
    p = sc.pillar_profile(_rows(spark, d)).select("run_id", "subject", "pillar", "band", "mean")
    old = p.select(F.col("run_id").alias("before"), "pillar", F.col("band").alias("old_band"), F.col("mean").alias("old_mean"))
    both = pairs.join(p, "run_id").join(old, ["before", "pillar"])
    move = F.when(F.col("mean") > F.col("old_mean"), "up").when(F.col("mean") < F.col("old_mean"), "down").when(F.col("mean").isNull() | F.col("old_mean").isNull(), "unknown").otherwise("same")
    return both.select("subject", "run_id", "pillar", "old_band", "band", move.alias("move"))


def q_answer_cache(spark, d):
    """The oldest event of each kind, user and payload: what a lookup of a repeated request would find."""
    e = table(spark, d, "events")
    return e.groupBy("user_id", "event_type", F.sha2("props", 256).alias("request")).agg(F.min_by("event_id", F.struct("ts", "event_id")).alias("event_id"), F.count("*").alias("hits"))


def q_question_list(spark, d):
    """Questions of each run from three ordered generators, the first twelve kept."""
    r = _rows(spark, d)
    parts = [r.where("cls = 'Gap'").withColumn("g", F.lit(1)), r.where("level is null and cls <> 'Gap'").withColumn("g", F.lit(2)), r.where("stale").withColumn("g", F.lit(3))]
    q = parts[0].unionByName(parts[1]).unionByName(parts[2]).select("run_id", "subject", "g", "indicator_id")
    n = F.row_number().over(W.partitionBy("run_id", "subject").orderBy("g", "indicator_id"))
    return q.withColumn("no", n).where("no <= 12")


def q_label_probes(spark, d):
    """Names of indicators that a probe's pattern fits, counted; probed_labels also has the titles of cells' sources."""
    names = table(spark, d, "indicators").select("indicator_id", F.explode(F.array_compact(F.array(*[F.when(F.col("name").rlike(p), F.lit(i)) for i, p in PROBES]))).alias("probe"))
    return names.groupBy("probe").agg(F.count("*").alias("indicators"), F.min("indicator_id").alias("first_id"))


def q_probed_labels(spark, d):
    """Titles of cells' sources and names of indicators that a probe's pattern fits, with the number of cells or indicators that have them."""
    titles = table(spark, d, "research_cells").select(F.lit("source").alias("kind"), F.col("source_title").alias("label"), F.col("cell_id").cast("string").alias("k"))
    names = table(spark, d, "indicators").select(F.lit("indicator").alias("kind"), F.col("name").alias("label"), F.col("indicator_id").alias("k"))
    labels = titles.unionByName(names).where("label is not null").groupBy("kind", "label").agg(F.count_distinct("k").alias("uses"))
    return labels.select("kind", "label", "uses", F.explode(F.array_compact(F.array(*[F.when(F.col("label").rlike(p), F.lit(i)) for i, p in PROBES]))).alias("probe"))


def q_document_disposition(spark, d):
    """Documents by whether any cell of their subject was researched in the year they were published."""
    docs = table(spark, d, "documents").where("subject is not null and published_at is not null").select("doc_id", "subject", F.year("published_at").alias("year"))
    used = table(spark, d, "research_cells").where("year is not null").select("subject", "year").distinct().withColumn("used", F.lit(True))
    return docs.join(used, ["subject", "year"], "left").select("doc_id", F.coalesce("used", F.lit(False)).alias("used"))


def q_evidence_pack(spark, d):
    """What a chapter on a use case may cite: indicators that bear on it, and those whose prerequisite names it."""
    i = table(spark, d, "indicators")
    bears = sc.bearing(i, table(spark, d, "use_cases")).withColumn("why", F.lit("bears"))
    pre = i.where("prerequisite like 'UC:%'").select("indicator_id", F.explode(F.split(F.regexp_replace("prerequisite", "^UC:", ""), ",")).alias("use_case")).withColumn("why", F.lit("prerequisite"))
    return bears.unionByName(pre).groupBy("use_case", "indicator_id").agg(F.array_join(F.array_sort(F.collect_set("why")), "+").alias("why"))


def q_respelled(spark, d):
    """Titles and whole texts in the other spelling."""
    return table(spark, d, "documents").select("doc_id", tx.respell(F.col("title")).alias("title"), tx.respell(F.col("text")).alias("text"))


def q_figure_support(spark, d):
    """Figures in the notes of a cell that its value supports."""

    @F.pandas_udf(T.IntegerType())
    def support(notes: pd.Series, value: pd.Series) -> pd.Series:
        def of(n, v):
            known = [] if v is None or v != v else [float(v)]
            return sum(tx.supported(m["number"], len(m["raw"].partition(".")[2].rstrip("% ")), known) for m in tx.numeric_mentions_of(n)) if known else 0

        return pd.Series([of(n, v) for n, v in zip(notes, value, strict=True)], dtype="int32")

    c = table(spark, d, "research_cells").select("cell_id", "notes", tx.parse_number(F.col("value")).alias("v")).where("v is not null").distinct()
    return c.select("cell_id", support("notes", "v").alias("supported"))


_PUB = "CASE " + " ".join(f"WHEN contains(lower(src), '{w}') THEN '{t}'" for w, t in tx.PUBLIC_TIERS) + " WHEN contains(coalesce(url, ''), '.gov') THEN 'T3' ELSE 'T4' END"
_BEARS = """bears AS (SELECT DISTINCT indicator_id, use_case FROM (SELECT indicator_id, unnest(use_cases) AS use_case FROM indicators
  UNION ALL SELECT i.indicator_id, u.code FROM indicators i JOIN use_cases u ON u.kind = 'use case' WHERE list_contains(i.tags, 'EVERY')) WHERE use_case IN (SELECT code FROM use_cases WHERE kind = 'use case'))"""
ORACLES = {
    "in_scope": _OBS + "SELECT * FROM (SELECT obs_id, CASE WHEN coalesce(prerequisite, '') <> '' THEN 'prerequisite' WHEN cls = 'Gap' THEN 'gap' WHEN level IS NULL THEN 'hold' END AS role FROM s) WHERE role IS NOT NULL",
    "crosswalk": _OBS + f", {_BEARS}, k AS (SELECT *, row_number() OVER (PARTITION BY run_id, subject ORDER BY level, indicator_id) AS n FROM s WHERE level IS NOT NULL) SELECT run_id, subject, indicator_id, level, use_case FROM k JOIN bears USING (indicator_id) WHERE n <= 12 AND pillar = 'A1'",
    "sub_readings": "SELECT sub, uses, name FROM (SELECT sub, count(*) AS uses FROM (SELECT DISTINCT obs_id, unnest(subs) AS sub FROM observations) GROUP BY sub) LEFT JOIN indicators ON indicator_id = sub",
    "public_tier": f"SELECT tier, suggested, count(*) AS n FROM (SELECT DISTINCT obs_id, tier, {_PUB} AS suggested FROM observations WHERE src IS NOT NULL) GROUP BY ALL",
    "transforms": _OBS + "SELECT obs_id, round((CASE WHEN unit = '%' THEN value_num / 100 ELSE value_num END)::varchar::decimal(38,20), 6)::double AS scaled, true AS same FROM s JOIN (SELECT indicator_id, unit FROM indicators) USING (indicator_id) WHERE cls = 'Measured' AND value_num IS NOT NULL",
    "line_transforms": "SELECT l_orderkey, l_linenumber, " + ", ".join(f"round(({x})::varchar::decimal(38,20), 6)::double AS {k}" for k, x in (("identity", "l_quantity"), ("share", "l_quantity / 100"), ("price_share", "l_extendedprice / (nullif(o_totalprice, 0) / 12) * 100"), ("excess", "greatest(l_quantity - l_linenumber, 0)"))) + " FROM lineitem JOIN orders ON o_orderkey = l_orderkey",
    "pillar_compare": _PROFILE + """, r AS (SELECT run_id, subject, min(observed_at) AS began FROM observations GROUP BY ALL), pr AS (SELECT run_id, lag(run_id) OVER (PARTITION BY subject ORDER BY began, run_id) AS before FROM r)
      SELECT a.subject, a.run_id, a.pillar, b.band AS old_band, a.band, CASE WHEN a.mean > b.mean THEN 'up' WHEN a.mean < b.mean THEN 'down' WHEN a.mean IS NULL OR b.mean IS NULL THEN 'unknown' ELSE 'same' END AS move
      FROM pr JOIN profile a ON a.run_id = pr.run_id JOIN profile b ON b.run_id = pr.before AND b.pillar = a.pillar""",
    "answer_cache": "SELECT user_id, event_type, sha256(props) AS request, first(event_id ORDER BY ts, event_id) AS event_id, count(*) AS hits FROM events GROUP BY ALL",
    "question_list": _OBS + """, q AS (SELECT run_id, subject, 1 AS g, indicator_id FROM s WHERE cls = 'Gap' UNION ALL SELECT run_id, subject, 2, indicator_id FROM s WHERE level IS NULL AND cls <> 'Gap' UNION ALL SELECT run_id, subject, 3, indicator_id FROM s WHERE stale)
      SELECT * FROM (SELECT run_id, subject, g, indicator_id, CAST(row_number() OVER (PARTITION BY run_id, subject ORDER BY g, indicator_id) AS INTEGER) AS no FROM q) WHERE no <= 12""",
    "label_probes": "WITH p(probe, pattern) AS (VALUES " + ", ".join(f"({i}, '{p}')" for i, p in PROBES) + ") SELECT probe, count(*) AS indicators, min(indicator_id) AS first_id FROM indicators, p WHERE regexp_matches(name, pattern) GROUP BY probe",
    "probed_labels": "WITH p(probe, pattern) AS (VALUES " + ", ".join(f"({i}, '{p}')" for i, p in PROBES) + """), l AS (SELECT 'source' AS kind, source_title AS label, count(DISTINCT cell_id) AS uses FROM research_cells GROUP BY ALL
      UNION ALL SELECT 'indicator', name, count(DISTINCT indicator_id) FROM indicators GROUP BY ALL) SELECT kind, label, uses, probe FROM l, p WHERE regexp_matches(label, pattern)""",
    "document_disposition": "SELECT doc_id, EXISTS (SELECT 1 FROM research_cells c WHERE c.subject = d.subject AND c.year = year(published_at)) AS used FROM documents d WHERE subject IS NOT NULL AND published_at IS NOT NULL",
    "evidence_pack": f"WITH {_BEARS}, a AS (SELECT indicator_id, use_case, 'bears' AS why FROM bears UNION SELECT indicator_id, unnest(string_split(substring(prerequisite, 4), ',')), 'prerequisite' FROM indicators WHERE prerequisite LIKE 'UC:%') SELECT use_case, indicator_id, string_agg(why, '+' ORDER BY why) AS why FROM a GROUP BY ALL",
}
QUERIES = {name.removeprefix("q_"): f for name, f in list(globals().items()) if name.startswith("q_")}
