"""Queries of the scoring core over the whole tables of observations, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from agrolith.operators import scoring as sc
from agrolith.sources.tables import table


def _rows(spark: SparkSession, d: str) -> DataFrame:
    return sc.scored(table(spark, d, "observations"), table(spark, d, "indicators"))


def q_evidence_class(spark, d):
    return _rows(spark, d).select("obs_id", "cls")


def q_threshold_level(spark, d):
    rows = _rows(spark, d).where("method = 'threshold' and value_num is not null")
    return rows.select("obs_id", sc.threshold_level(F.col("value_num"), F.col("thresholds"), F.col("direction")).alias("level"))


def q_effective_level(spark, d):
    return _rows(spark, d).select("obs_id", "level", (F.col("level").isNull() & (F.col("cls") != "Gap")).alias("held"))


def q_stale_flag(spark, d):
    return _rows(spark, d).select("obs_id", "year", "stale")


def q_pillar_profile(spark, d):
    return sc.pillar_profile(_rows(spark, d))


def q_layer_mean(spark, d):
    return sc.layer_means(_rows(spark, d))


def q_leapfrog(spark, d):
    return sc.leapfrog(_rows(spark, d))


def q_prereq_status(spark, d):
    return sc.prerequisite_status(_rows(spark, d))


def q_bearing(spark, d):
    return sc.bearing(table(spark, d, "indicators"), table(spark, d, "use_cases"))


def q_role_means(spark, d):
    return sc.role_means(_rows(spark, d), q_bearing(spark, d))


def q_constraints_topk(spark, d):
    return sc.constraints(_rows(spark, d))


def q_headline(spark, d):
    return sc.headline(q_pillar_profile(spark, d))


def q_kpi(spark, d):
    return _rows(spark, d).where("cls = 'Measured' and pillar in ('A1', 'O1')").select("run_id", "subject", "indicator_id", "value_num", "level")


def q_verify_list(spark, d):
    return _rows(spark, d).where("cls in ('Gap', 'Judged')").select("run_id", "subject", "pillar", "indicator_id", "cls")


def q_refresh_list(spark, d):
    return _rows(spark, d).where("stale").select("run_id", "subject", "indicator_id", "year")


def q_class_counts(spark, d):
    return _rows(spark, d).groupBy("run_id", "subject").agg(
        *[F.count_if(F.col("cls") == c).alias(c.lower()) for c in ("Measured", "Documented", "Judged", "Gap")],
        F.count("level").alias("rated"), F.count_if(F.col("level").isNull() & (F.col("cls") != "Gap")).alias("held"),
    )


def q_level_distribution(spark, d):
    return _rows(spark, d).where("level is not null").groupBy("pillar", "level").agg(F.count("*").alias("n"))


def q_chart_segments(spark, d):
    """Share of each class in a pillar, over all runs."""
    per = _rows(spark, d).groupBy("pillar", "cls").agg(F.count("*").alias("n"))
    return per.withColumn("share", F.round(F.col("n") / F.sum("n").over(W.partitionBy("pillar")), 4))


def q_vintage_histogram(spark, d):
    y = F.when(F.col("year") <= 2022, "<=2022").otherwise(F.col("year").cast("string"))
    return _rows(spark, d).where("cls <> 'Gap' and year is not null").groupBy("subject", y.alias("bucket")).agg(F.count("*").alias("n"))


def q_id_natural_sort(spark, d):
    ids = table(spark, d, "indicators").select("indicator_id").distinct()
    return ids.select("indicator_id", F.row_number().over(W.orderBy(*sc.natural_key(F.col("indicator_id")))).alias("position"))  # fixed table


def q_missing_ids(spark, d):
    """Entries in force today that were in the catalog before 2022 and that a run has no observation of; missing_in_force has those of the run's time."""
    runs = table(spark, d, "observations").select("run_id", "subject", "indicator_id").distinct()
    ids = table(spark, d, "indicators").where("retired_on is null and added_on < timestamp_ntz '2022-01-01'").agg(F.collect_list("indicator_id").alias("ids"))  # fixed table, one row
    wanted = runs.select("run_id", "subject").distinct().withColumn("k", F.lit(1)).join(ids.withColumn("k", F.lit(1)), "k").select("run_id", "subject", F.explode("ids").alias("indicator_id"))
    return wanted.join(runs, ["run_id", "subject", "indicator_id"], "left_anti")


def q_missing_in_force(spark, d):
    """Catalog entries in force when a run began (added by then, not retired) that it has no observation of."""
    o = table(spark, d, "observations").select("run_id", "subject", "indicator_id", "observed_at")
    runs = o.groupBy("run_id", "subject").agg(F.min("observed_at").alias("began"))
    entries = table(spark, d, "indicators").select(F.struct("indicator_id", "added_on", "retired_on").alias("e")).agg(F.collect_list("e").alias("entries"))  # fixed table, one row
    wanted = runs.withColumn("k", F.lit(1)).join(entries.withColumn("k", F.lit(1)), "k").select("run_id", "subject", "began", F.inline("entries"))
    wanted = wanted.where("(added_on is null or added_on <= began) and (retired_on is null or retired_on > began)").select("run_id", "subject", "indicator_id")
    return wanted.join(o.select("run_id", "subject", "indicator_id").distinct(), ["run_id", "subject", "indicator_id"], "left_anti")


def q_latest_obs(spark, d):
    """The latest value of each subject and indicator; of one year the greatest obs_id."""
    o = table(spark, d, "observations").where("value_num is not null and year is not null")
    best = o.groupBy("subject", "indicator_id").agg(F.max(F.struct("year", "obs_id", "value_num")).alias("b"))
    return best.select("subject", "indicator_id", "b.year", "b.obs_id", "b.value_num")


def q_run_compare(spark, d):
    """Each run against the subject's run before it: levels, classes, within one."""
    runs = table(spark, d, "observations").groupBy("run_id", "subject").agg(F.min("observed_at").alias("at"))
    order = W.partitionBy("subject").orderBy("at", "run_id")
    pairs = runs.select("run_id", "subject", F.lag("run_id").over(order).alias("before")).where("before is not null")
    now = _rows(spark, d).select("run_id", "indicator_id", "level", "cls")
    old = now.select(F.col("run_id").alias("before"), "indicator_id", F.col("level").alias("old_level"), F.col("cls").alias("old_cls"))
    both = pairs.join(now, "run_id").join(old, ["before", "indicator_id"])
    return both.groupBy("subject", "run_id", "before").agg(
        F.count("*").alias("rows"), F.count_if(F.col("level").eqNullSafe(F.col("old_level"))).alias("same_level"), F.count_if(F.col("cls") == F.col("old_cls")).alias("same_class"),
        F.count_if(F.col("level").isNotNull() & F.col("old_level").isNotNull()).alias("both_levelled"), F.count_if(F.abs(F.col("level") - F.col("old_level")) <= 1).alias("within_one"),
        F.count_if(F.col("level") > F.col("old_level")).alias("higher"), F.count_if(F.col("level") < F.col("old_level")).alias("lower"),
    )


def q_withheld_everywhere(spark, d):
    """Indicators without a level in every run that has them (an intersection over runs)."""
    per = _rows(spark, d).groupBy("indicator_id").agg(F.count("*").alias("n"), F.count_if(F.col("level").isNull()).alias("unlevelled"), F.count_distinct("subject").alias("subjects"), F.count_distinct(F.when(F.col("level").isNull(), F.col("subject"))).alias("withheld_subjects"))
    return per.select("indicator_id", "n", "unlevelled", "subjects", "withheld_subjects", (F.col("subjects") == F.col("withheld_subjects")).alias("everywhere"))


def q_intervals(spark, d):
    return sc.intervals(table(spark, d, "indicators"))


def q_interval_level(spark, d):
    """Levels by a range join on the intervals: a second way to threshold_level."""
    rows = _rows(spark, d).where("method = 'threshold' and value_num is not null").select("obs_id", "indicator_id", "value_num")
    i = sc.intervals(table(spark, d, "indicators"))
    higher = (F.coalesce(F.col("value_num") >= F.col("lower_cut"), F.lit(True))) & (F.coalesce(F.col("value_num") < F.col("upper_cut"), F.lit(True)))
    lower = (F.coalesce(F.col("value_num") <= F.col("lower_cut"), F.lit(True))) & (F.coalesce(F.col("value_num") > F.col("upper_cut"), F.lit(True)))
    return rows.join(i, "indicator_id").where(F.when(F.col("direction") == "lower", lower).otherwise(higher)).select("obs_id", "level")


def q_qc_invariants(spark, d):
    """Counts of rows that break an invariant, one row per check."""
    r = _rows(spark, d)
    checks = {"level_range": F.col("level").isNotNull() & ~F.col("level").between(1, 5), "gap_without_level": (F.col("cls") == "Gap") & F.col("level").isNotNull(), "measured_has_value": (F.col("cls") == "Measured") & F.col("value_num").isNull(), "known_pillar": ~F.col("pillar").isin(*sc.PILLARS)}
    one = r.agg(*[F.count_if(c).alias(n) for n, c in checks.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("broken")) for n in checks])).alias("x")).select("x.check", "x.broken")


def q_row_contract(spark, d):
    """All errors of each observation that has any, not only the first."""
    r = sc.scored(table(spark, d, "observations"), table(spark, d, "indicators"), keep=("src", "tier", "url"))
    errors = F.array_compact(F.array(
        F.when(F.coalesce("src", F.lit("")) == "", "no source"), F.when(~F.coalesce(F.col("tier"), F.lit("")).rlike("^T[1-5]$"), "no tier"),
        F.when((F.col("cls") != "Gap") & F.col("year").isNull(), "no year"), F.when(F.coalesce("url", F.lit("")) == "", "no url"),
    ))
    return r.select("obs_id", F.explode(errors).alias("error"))


_OBS = """WITH obs AS (SELECT DISTINCT obs_id, run_id, subject, indicator_id, value_num, value_text, cls, level, level_present, year, src, tier, url, prereq FROM observations),
s0 AS (SELECT o.* EXCLUDE (cls), i.name AS indicator, i.pillar, i.layer, i.method, i.direction, i.thresholds, i.use_cases, i.tags, i.prerequisite,
  CASE WHEN coalesce(o.cls, '') <> '' THEN o.cls WHEN value_num IS NOT NULL THEN 'Measured' WHEN coalesce(value_text, '') = '' THEN ''
       WHEN contains(upper(value_text), 'DATA GAP') THEN 'Gap' WHEN coalesce(src, '') <> '' AND coalesce(tier, '') <> '' AND tier <> 'T5' THEN 'Documented' ELSE 'Judged' END AS cls
  FROM obs o JOIN indicators i USING (indicator_id)),
cut AS (SELECT obs_id, 1 + count(*) FILTER (WHERE CASE WHEN direction = 'lower' THEN value_num <= t ELSE value_num >= t END) AS tl
  FROM (SELECT obs_id, direction, value_num, unnest(thresholds) AS t FROM s0 WHERE value_num IS NOT NULL) GROUP BY obs_id),
s AS (SELECT s0.* EXCLUDE (level), CAST(CASE WHEN cls IN ('Gap', '') THEN NULL WHEN level_present AND level IS NULL THEN NULL WHEN cls = 'Measured' AND method = 'threshold' THEN tl ELSE level END AS INTEGER) AS level,
  coalesce(year <> 0 AND cls <> 'Gap' AND year < 2023, false) AS stale FROM s0 LEFT JOIN cut USING (obs_id))
"""
_R2 = "round(({})::varchar::decimal(38,20), 2)::double"
_BAND = "CASE WHEN mean IS NULL THEN 'Not rated' WHEN mean >= 1 AND mean < 1.5 THEN 'Nascent' WHEN mean < 2.5 THEN 'Emerging' WHEN mean < 3.5 THEN 'Established' WHEN mean < 4.5 THEN 'Advanced' WHEN mean < 5.01 THEN 'Transformative' ELSE '—' END"
_BANDN = "CASE WHEN mean IS NULL THEN NULL WHEN mean >= 1 AND mean < 1.5 THEN 1 WHEN mean < 2.5 THEN 2 WHEN mean < 3.5 THEN 3 WHEN mean < 4.5 THEN 4 WHEN mean < 5.01 THEN 5 END"
_PROFILE = (
    _OBS
    + f""", g AS (SELECT run_id, subject, pillar, count(*) n, count(level) rated, count(*) FILTER (WHERE level IS NULL AND cls <> 'Gap') held, sum(level) / count(level) AS raw,
  count(*) FILTER (WHERE cls = 'Measured') measured, count(*) FILTER (WHERE cls = 'Documented') documented, count(*) FILTER (WHERE cls = 'Judged') judged, count(*) FILTER (WHERE cls = 'Gap') gaps,
  count(*) FILTER (WHERE stale) stale, count(*) FILTER (WHERE cls = 'Judged' AND level IS NOT NULL) jr FROM s GROUP BY ALL),
runs AS (SELECT DISTINCT run_id, subject FROM s), p AS (SELECT unnest(['A1','C1','C2','C3','C4','E1','O1']) AS pillar),
f AS (SELECT r.run_id, r.subject, p.pillar, coalesce(n, 0) n, coalesce(rated, 0) rated, coalesce(held, 0) held, {_R2.format('raw')} AS mean, coalesce(measured, 0) measured, coalesce(documented, 0) documented,
  coalesce(judged, 0) judged, coalesce(gaps, 0) gaps, coalesce(stale, 0) stale, coalesce(jr, 0) jr FROM runs r CROSS JOIN p LEFT JOIN g ON g.run_id = r.run_id AND g.subject = r.subject AND g.pillar = p.pillar),
profile AS (SELECT run_id, subject, pillar, n, rated, held, mean, {_BAND} AS band, {_R2.format('mean - ' + _BANDN)} AS margin, measured, documented, judged, gaps, stale, (jr + gaps + held) > (rated - jr) AS weak FROM f)
"""
)
_BEARING = """WITH bears AS (SELECT DISTINCT indicator_id, use_case FROM (
  SELECT indicator_id, unnest(use_cases) AS use_case FROM indicators UNION ALL SELECT i.indicator_id, u.code FROM indicators i JOIN use_cases u ON u.kind = 'use case' WHERE list_contains(i.tags, 'EVERY'))
  WHERE use_case IN (SELECT code FROM use_cases WHERE kind = 'use case'))
"""
_RUNC = _OBS + """, runs AS (SELECT run_id, subject, min(observed_at) AS began FROM observations GROUP BY ALL),
pairs AS (SELECT * FROM (SELECT run_id, subject, lag(run_id) OVER (PARTITION BY subject ORDER BY began, run_id) AS before FROM runs) WHERE before IS NOT NULL)
"""

_SQL = {
    "evidence_class": _OBS + "SELECT obs_id, cls FROM s",
    "threshold_level": _OBS + "SELECT obs_id, CAST(tl AS INTEGER) AS level FROM s0 JOIN cut USING (obs_id) WHERE method = 'threshold'",
    "effective_level": _OBS + "SELECT obs_id, level, level IS NULL AND cls <> 'Gap' AS held FROM s",
    "stale_flag": _OBS + "SELECT obs_id, year, stale FROM s",
    "pillar_profile": _PROFILE + "SELECT * FROM profile",
    "layer_mean": _OBS + f"SELECT run_id, subject, layer, {_R2.format('sum(level) / count(level)')} AS mean, count(level) AS rated FROM s GROUP BY ALL",
    "leapfrog": _OBS + f""", m AS (SELECT run_id, subject, {_R2.format("sum(level) FILTER (WHERE layer = 'Foundation') / nullif(count(level) FILTER (WHERE layer = 'Foundation'), 0)")} AS foundation,
      {_R2.format("sum(level) FILTER (WHERE layer = 'Transformation') / nullif(count(level) FILTER (WHERE layer = 'Transformation'), 0)")} AS transformation FROM s GROUP BY ALL)
      SELECT run_id, subject, foundation, transformation, {_R2.format('foundation - transformation')} AS gap, coalesce(abs(foundation - transformation) > 1.5, false) AS flag,
      CASE WHEN NOT coalesce(abs(foundation - transformation) > 1.5, false) THEN 'balanced' WHEN foundation > transformation THEN 'foundations ahead' ELSE 'transformation ahead' END AS reading FROM m""",
    "prereq_status": _OBS + """SELECT run_id, subject, indicator_id, prerequisite, level, CASE WHEN cls = 'Gap' OR level IS NULL THEN 'Unverified' WHEN level >= 3 THEN 'Present' WHEN level = 2 THEN 'Present (narrow)' ELSE 'Absent' END AS status
      FROM s WHERE coalesce(prerequisite, '') <> ''""",
    "bearing": _BEARING + "SELECT indicator_id, use_case FROM bears",
    "role_means": _OBS + ", " + _BEARING.removeprefix("WITH ") + f"""SELECT run_id, subject, use_case, {_R2.format("sum(level) FILTER (WHERE pillar NOT IN ('A1','O1')) / nullif(count(level) FILTER (WHERE pillar NOT IN ('A1','O1')), 0)")} AS readiness,
      {_R2.format("sum(level) FILTER (WHERE pillar = 'A1') / nullif(count(level) FILTER (WHERE pillar = 'A1'), 0)")} AS need, {_R2.format("sum(level) FILTER (WHERE pillar = 'O1') / nullif(count(level) FILTER (WHERE pillar = 'O1'), 0)")} AS outcome,
      count(level) FILTER (WHERE pillar NOT IN ('A1','O1')) AS n_readiness, count(level) FILTER (WHERE pillar = 'A1') AS n_need, count(level) FILTER (WHERE pillar = 'O1') AS n_outcome, count(*) AS n_bearing FROM s JOIN bears USING (indicator_id) GROUP BY ALL""",
    "constraints_topk": _OBS + "SELECT * FROM (SELECT run_id, subject, indicator_id, level, CAST(row_number() OVER (PARTITION BY run_id, subject ORDER BY level, indicator_id) AS INTEGER) AS position FROM s WHERE level IS NOT NULL) WHERE position <= 12",
    "headline": _PROFILE + """, o AS (SELECT *, list_position(['A1','C1','C2','C3','C4','E1','O1'], pillar) AS p FROM profile WHERE mean IS NOT NULL)
      SELECT run_id, subject, first(pillar ORDER BY mean DESC, p) AS best, first(pillar ORDER BY mean, p) AS worst, max(mean) AS best_mean, min(mean) AS worst_mean FROM o GROUP BY ALL""",
    "kpi": _OBS + "SELECT run_id, subject, indicator_id, value_num, level FROM s WHERE cls = 'Measured' AND pillar IN ('A1', 'O1')",
    "verify_list": _OBS + "SELECT run_id, subject, pillar, indicator_id, cls FROM s WHERE cls IN ('Gap', 'Judged')",
    "refresh_list": _OBS + "SELECT run_id, subject, indicator_id, year FROM s WHERE stale",
    "class_counts": _OBS + "SELECT run_id, subject, count(*) FILTER (WHERE cls = 'Measured') AS measured, count(*) FILTER (WHERE cls = 'Documented') AS documented, count(*) FILTER (WHERE cls = 'Judged') AS judged, count(*) FILTER (WHERE cls = 'Gap') AS gap, count(level) AS rated, count(*) FILTER (WHERE level IS NULL AND cls <> 'Gap') AS held FROM s GROUP BY ALL",
    "level_distribution": _OBS + "SELECT pillar, level, count(*) AS n FROM s WHERE level IS NOT NULL GROUP BY ALL",
    "chart_segments": _OBS + ", c AS (SELECT pillar, cls, count(*) AS n FROM s GROUP BY ALL) SELECT pillar, cls, n, round((n / sum(n) OVER (PARTITION BY pillar))::varchar::decimal(38,20), 4)::double AS share FROM c",
    "vintage_histogram": _OBS + "SELECT subject, CASE WHEN year <= 2022 THEN '<=2022' ELSE year::varchar END AS bucket, count(*) AS n FROM s WHERE cls <> 'Gap' AND year IS NOT NULL GROUP BY ALL",
    "id_natural_sort": "SELECT indicator_id, CAST(row_number() OVER (ORDER BY split_part(indicator_id, '.', 1)::int, split_part(indicator_id, '.', 2)::int) AS INTEGER) AS position FROM (SELECT DISTINCT indicator_id FROM indicators)",
    "missing_ids": "WITH r AS (SELECT DISTINCT run_id, subject FROM observations) SELECT r.run_id, r.subject, i.indicator_id FROM r CROSS JOIN indicators i WHERE i.retired_on IS NULL AND i.added_on < TIMESTAMP '2022-01-01' AND NOT EXISTS (SELECT 1 FROM observations o WHERE o.run_id = r.run_id AND o.subject = r.subject AND o.indicator_id = i.indicator_id)",
    "missing_in_force": """WITH r AS (SELECT run_id, subject, min(observed_at) AS began FROM observations GROUP BY ALL) SELECT r.run_id, r.subject, i.indicator_id FROM r JOIN indicators i ON (i.added_on IS NULL OR i.added_on <= r.began)
      AND (i.retired_on IS NULL OR i.retired_on > r.began) WHERE NOT EXISTS (SELECT 1 FROM observations o WHERE o.run_id = r.run_id AND o.subject = r.subject AND o.indicator_id = i.indicator_id)""",
    "latest_obs": "SELECT subject, indicator_id, year, obs_id, value_num FROM (SELECT DISTINCT subject, indicator_id, year, obs_id, value_num FROM observations WHERE value_num IS NOT NULL AND year IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY subject, indicator_id ORDER BY year DESC, obs_id DESC) = 1",
    "run_compare": _RUNC + """SELECT p.subject, p.run_id, p.before, count(*) AS rows, count(*) FILTER (WHERE a.level IS NOT DISTINCT FROM b.level) AS same_level, count(*) FILTER (WHERE a.cls = b.cls) AS same_class,
      count(*) FILTER (WHERE a.level IS NOT NULL AND b.level IS NOT NULL) AS both_levelled, count(*) FILTER (WHERE abs(a.level - b.level) <= 1) AS within_one, count(*) FILTER (WHERE a.level > b.level) AS higher, count(*) FILTER (WHERE a.level < b.level) AS lower
      FROM pairs p JOIN s a ON a.run_id = p.run_id JOIN s b ON b.run_id = p.before AND b.indicator_id = a.indicator_id GROUP BY ALL""",
    "withheld_everywhere": _OBS + "SELECT indicator_id, count(*) AS n, count(*) FILTER (WHERE level IS NULL) AS unlevelled, count(DISTINCT subject) AS subjects, count(DISTINCT CASE WHEN level IS NULL THEN subject END) AS withheld_subjects, count(DISTINCT subject) = count(DISTINCT CASE WHEN level IS NULL THEN subject END) AS everywhere FROM s GROUP BY ALL",
    "intervals": "SELECT indicator_id, direction, CAST(l AS INTEGER) AS level, CASE WHEN l > 1 THEN thresholds[l - 1] END AS lower_cut, CASE WHEN l < 5 THEN thresholds[l] END AS upper_cut FROM indicators, (SELECT unnest([1, 2, 3, 4, 5]) AS l) WHERE method = 'threshold'",
    "interval_level": _OBS + "SELECT obs_id, CAST(tl AS INTEGER) AS level FROM s0 JOIN cut USING (obs_id) WHERE method = 'threshold'",
    "qc_invariants": _OBS + """SELECT 'level_range' AS check, count(*) FILTER (WHERE level IS NOT NULL AND level NOT BETWEEN 1 AND 5) AS broken FROM s UNION ALL SELECT 'gap_without_level', count(*) FILTER (WHERE cls = 'Gap' AND level IS NOT NULL) FROM s
      UNION ALL SELECT 'measured_has_value', count(*) FILTER (WHERE cls = 'Measured' AND value_num IS NULL) FROM s UNION ALL SELECT 'known_pillar', count(*) FILTER (WHERE pillar NOT IN ('A1','C1','C2','C3','C4','E1','O1')) FROM s""",
    "row_contract": _OBS + """SELECT obs_id, 'no source' AS error FROM s WHERE coalesce(src, '') = '' UNION ALL SELECT obs_id, 'no tier' FROM s WHERE NOT regexp_matches(coalesce(tier, ''), '^T[1-5]$')
      UNION ALL SELECT obs_id, 'no year' FROM s WHERE cls <> 'Gap' AND year IS NULL UNION ALL SELECT obs_id, 'no url' FROM s WHERE coalesce(url, '') = ''""",
}

QUERIES = {name.removeprefix("q_"): f for name, f in list(globals().items()) if name.startswith("q_")}
ORACLES = _SQL
