"""The scoring core as declarative plans: one job scores all subjects and runs.

Every function takes and returns DataFrames; groups are keyed by (run_id, subject), so that the largest subject is only one
of many keys and is partially aggregated before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: The year of the assessment, years until evidence is stale, the gap that counts as leapfrogging.
ASSESSMENT_YEAR, STALE_YEARS, LEAPFROG_GAP = 2026, 3, 1.5
#: Maturity bands, lower bound included, upper bound excluded.
BANDS = ((1.0, 1.5, "Nascent", 1), (1.5, 2.5, "Emerging", 2), (2.5, 3.5, "Established", 3), (3.5, 4.5, "Advanced", 4), (4.5, 5.01, "Transformative", 5))
PILLARS = ("A1", "C1", "C2", "C3", "C4", "E1", "O1")
RUN = ("run_id", "subject")


def evidence_class(cls: Column, value_num: Column, value_text: Column, src: Column, tier: Column) -> Column:
    """A supplied class wins; then Measured, blank, Gap, Documented, Judged."""
    text = F.coalesce(value_text, F.lit(""))
    return (
        F.when(F.coalesce(cls, F.lit("")) != "", cls)
        .when(value_num.isNotNull(), "Measured")
        .when(text == "", "")
        .when(F.upper(text).contains("DATA GAP"), "Gap")
        .when((F.coalesce(src, F.lit("")) != "") & (F.coalesce(tier, F.lit("")) != "") & (tier != "T5"), "Documented")
        .otherwise("Judged")
    )


def threshold_level(value: Column, thresholds: Column, direction: Column) -> Column:
    """One more than the number of cuts crossed."""
    crossed = F.when(direction == "lower", F.size(F.filter(thresholds, lambda t: value <= t))).otherwise(F.size(F.filter(thresholds, lambda t: value >= t)))
    return F.when(value.isNotNull() & (F.size(thresholds) > 0), 1 + crossed)


def scored(observations: DataFrame, indicators: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Observations with class, level, stale; explicit holds (level present and null) stay without a level.

    The class is derived before rows delivered twice are dropped, so that no long text is shuffled; ``keep`` names further
    columns that are to come out.
    """
    catalog = indicators.select("indicator_id", F.col("name").alias("indicator"), "pillar", "layer", "method", "direction", "thresholds", "use_cases", "tags", "prerequisite")
    cls = evidence_class(F.col("cls"), F.col("value_num"), F.col("value_text"), F.col("src"), F.col("tier"))
    rows = observations.select("obs_id", "run_id", "subject", "indicator_id", "value_num", cls.alias("cls"), "level", "level_present", "year", *keep).distinct().join(catalog, "indicator_id")
    hold = F.col("level_present") & F.col("level").isNull()
    level = (
        F.when(F.col("cls").isin("Gap", ""), None).when(hold, None)
        .when((F.col("cls") == "Measured") & (F.col("method") == "threshold"), threshold_level(F.col("value_num"), F.col("thresholds"), F.col("direction"))).otherwise(F.col("level"))
    )
    stale = F.coalesce((F.col("year") != 0) & (F.col("cls") != "Gap") & (F.col("year") < ASSESSMENT_YEAR - STALE_YEARS), F.lit(False))
    return rows.withColumn("level", level.cast("int")).withColumn("stale", stale)


def band(mean: Column) -> Column:
    out = F.when(mean.isNull(), "Not rated")
    for low, high, name, _ in BANDS:
        out = out.when((mean >= low) & (mean < high), name)
    return out.otherwise("—")


def band_level(mean: Column) -> Column:
    out = F.when(mean.isNull(), None)
    for low, high, _, n in BANDS:
        out = out.when((mean >= low) & (mean < high), n)
    return out


def pillar_profile(rows: DataFrame) -> DataFrame:
    """Every run with every pillar, empty ones included: counts, mean, band, margin, composition, weak."""
    c = lambda name: F.count_if(F.col("cls") == name)
    agg = rows.groupBy(*RUN, "pillar").agg(
        F.count("*").alias("n"), F.count("level").alias("rated"), F.count_if(F.col("level").isNull() & (F.col("cls") != "Gap")).alias("held"),
        F.avg("level").alias("raw"), c("Measured").alias("measured"), c("Documented").alias("documented"), c("Judged").alias("judged"), c("Gap").alias("gaps"),
        F.count_if("stale").alias("stale"), F.count_if((F.col("cls") == "Judged") & F.col("level").isNotNull()).alias("judged_rated"),
    )
    # empty pillars are filled in from each run's seven aggregates, not by a join with a second pass over the rows
    fields = [c for c in agg.columns if c not in (*RUN, "pillar")]
    runs = agg.groupBy(*RUN).agg(F.map_from_entries(F.collect_list(F.struct("pillar", F.struct(*fields).alias("a")))).alias("m"))
    every = runs.select(*RUN, "m", F.explode(F.array(*map(F.lit, PILLARS))).alias("pillar")).select(*RUN, "pillar", F.try_element_at("m", F.col("pillar")).alias("a"))
    out = every.select(*RUN, "pillar", "a.*").withColumn("mean", F.round("raw", 2)).na.fill(0, ["n", "rated", "held", "measured", "documented", "judged", "gaps", "stale", "judged_rated"])
    weak = (F.col("judged_rated") + F.col("gaps") + F.col("held")) > (F.col("rated") - F.col("judged_rated"))
    return out.select(*RUN, "pillar", "n", "rated", "held", "mean", band(F.col("mean")).alias("band"), F.round(F.col("mean") - band_level(F.col("mean")), 2).alias("margin"), "measured", "documented", "judged", "gaps", "stale", weak.alias("weak"))


def layer_means(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*RUN, "layer").agg(F.round(F.avg("level"), 2).alias("mean"), F.count("level").alias("rated"))


def leapfrog(rows: DataFrame) -> DataFrame:
    """Foundation against Transformation: gap, flag, reading; unknown means give no flag."""
    of = lambda name: F.round(F.avg(F.when(F.col("layer") == name, F.col("level"))), 2)
    means = rows.groupBy(*RUN).agg(of("Foundation").alias("foundation"), of("Transformation").alias("transformation"))
    gap = F.round(F.col("foundation") - F.col("transformation"), 2)
    flag = F.coalesce(F.abs(F.col("foundation") - F.col("transformation")) > LEAPFROG_GAP, F.lit(False))
    reading = F.when(~flag, "balanced").when(F.col("foundation") > F.col("transformation"), "foundations ahead").otherwise("transformation ahead")
    return means.select(*RUN, "foundation", "transformation", gap.alias("gap"), flag.alias("flag"), reading.alias("reading"))


def prerequisite_status(rows: DataFrame) -> DataFrame:
    """Status of every prerequisite indicator."""
    status = F.when((F.col("cls") == "Gap") | F.col("level").isNull(), "Unverified").when(F.col("level") >= 3, "Present").when(F.col("level") == 2, "Present (narrow)").otherwise("Absent")
    return rows.where(F.coalesce("prerequisite", F.lit("")) != "").select(*RUN, "indicator_id", "prerequisite", "level", status.alias("status"))


def bearing(indicators: DataFrame, use_cases: DataFrame) -> DataFrame:
    """use_case, indicator_id: named use cases, and all of them for indicators tagged EVERY. Fixed tables, no cross join of data."""
    cases = use_cases.where("kind = 'use case'").select(F.col("code").alias("use_case"))
    named = indicators.select("indicator_id", F.explode("use_cases").alias("use_case")).join(cases, "use_case", "left_semi")
    every = indicators.where(F.array_contains("tags", "EVERY")).select("indicator_id", F.lit("use case").alias("kind"))
    of_all = every.join(use_cases.select("kind", F.col("code").alias("use_case")), "kind").select("indicator_id", "use_case")
    return named.select("indicator_id", "use_case").unionByName(of_all).distinct()


def role_means(rows: DataFrame, bears: DataFrame) -> DataFrame:
    """Means by role for each use case: A1 is need, O1 outcome, the rest readiness. Levels are summed per indicator first."""
    m = rows.join(bears, "indicator_id")
    role = lambda cond: F.round(F.avg(F.when(cond, F.col("level"))), 2)
    basis = lambda cond: F.count(F.when(cond, F.col("level")))
    need, out = F.col("pillar") == "A1", F.col("pillar") == "O1"
    return m.groupBy(*RUN, "use_case").agg(
        role(~need & ~out).alias("readiness"), role(need).alias("need"), role(out).alias("outcome"), basis(~need & ~out).alias("n_readiness"), basis(need).alias("n_need"), basis(out).alias("n_outcome"), F.count("*").alias("n_bearing"),
    )


def constraints(rows: DataFrame, k: int = 12) -> DataFrame:
    """The k binding constraints of each run: lowest level first, then id as text."""
    rank = F.row_number().over(W.partitionBy(*RUN).orderBy("level", "indicator_id"))
    return rows.where("level is not null").select(*RUN, "indicator_id", "level", rank.alias("position")).where(F.col("position") <= k)


def headline(profile: DataFrame) -> DataFrame:
    """Best and worst rated pillar of each run, ties to the first in pillar order."""
    order = F.array_position(F.array(*map(F.lit, PILLARS)), F.col("pillar"))
    rated = profile.where("mean is not null")
    return rated.groupBy(*RUN).agg(F.max_by("pillar", F.struct("mean", -order)).alias("best"), F.min_by("pillar", F.struct("mean", order)).alias("worst"), F.max("mean").alias("best_mean"), F.min("mean").alias("worst_mean"))


def transformed(kind: str, raw: Column, other: Column) -> Column:
    """A raw figure by its transform: ``identity``, ``share`` (of per cent), ``price_share`` (a month's price in per cent of a twelfth of a yearly sum), ``excess`` (over the other figure, 0 at least)."""
    a, b = raw.cast("double"), other.cast("double")
    return {"identity": a, "share": a / 100, "price_share": a / (F.when(b != 0, b) / 12) * 100, "excess": F.when(a.isNotNull() & b.isNotNull(), F.greatest(a - b, F.lit(0.0)))}[kind]


def natural_key(c: Column) -> list[Column]:
    """Sort keys that put 6.3 before 6.13, and ids without numbers last."""
    a, b = F.split(c, r"\.")[0].try_cast("int"), F.try_element_at(F.split(c, r"\."), F.lit(2)).try_cast("int")
    return [F.coalesce(a, F.lit(1 << 30)), F.coalesce(b, F.lit(0)), c]


def intervals(indicators: DataFrame) -> DataFrame:
    """The five level intervals of each threshold indicator, in the order of levels."""
    cuts = indicators.where("method = 'threshold'").select("indicator_id", "direction", F.posexplode(F.concat(F.array(F.lit(None).cast("double")), "thresholds")).alias("pos", "lower_cut"))
    w = W.partitionBy("indicator_id").orderBy("pos")
    return cuts.select("indicator_id", "direction", (F.col("pos") + 1).alias("level"), "lower_cut", F.lead("lower_cut").over(w).alias("upper_cut"))


def ladder_level(rung: Column, quality: Column, scale: Column) -> Column:
    """Absent 1, Announced 2, Adopted 3, Operating 3 and one more for each substantive text, quality first."""
    start = F.when(rung == "Absent", 1).when(rung == "Announced", 2).when(rung.isin("Adopted", "Operating"), 3)
    more = F.when((rung == "Operating") & quality, F.when(scale, 2).otherwise(1)).otherwise(0)
    return F.least(start + more, F.lit(5))
