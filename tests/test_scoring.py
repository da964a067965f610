from pyspark.sql import functions as F

from agrolith.operators import scoring as sc

CATALOG = "indicator_id string, name string, pillar string, layer string, method string, direction string, thresholds array<double>, use_cases array<string>, tags array<string>, prerequisite string"
OBS = "obs_id bigint, run_id string, subject string, indicator_id string, value_num double, value_text string, cls string, level int, level_present boolean, year int, src string, tier string, url string, prereq string"


def rows(spark, obs):
    cat = [("1.1", "a", "A1", "Foundation", "threshold", "higher", [1.0, 2.0, 3.0, 4.0], [], [], ""), ("2.1", "b", "C1", "Transformation", "threshold", "lower", [40.0, 30.0, 20.0, 10.0], [], [], "UNIVERSAL"), ("3.1", "c", "C2", "Enablers", "ladder", "", [], [], [], "")]
    return sc.scored(spark.createDataFrame(obs, OBS), spark.createDataFrame(cat, CATALOG))


def test_levels_and_holds(spark):
    o = [
        (1, "r", "X", "1.1", 0.0, None, "Measured", 5, False, 2020, "s", "T1", "u", ""), (2, "r", "X", "1.1", 4.0, None, None, None, False, 2024, "s", "T1", "u", ""), (3, "r", "X", "1.1", 4.0, None, None, None, True, 0, "s", "T1", "u", ""),
        (4, "r", "X", "2.1", 25.0, None, "", 1, True, None, None, None, None, ""), (5, "r", "X", "3.1", None, "DATA GAP here", None, 3, True, 2000, "s", "T1", "u", ""), (6, "r", "X", "3.1", None, "text", None, 3, True, 2000, "s", "T5", "u", ""), (7, "r", "X", "3.1", None, "text", None, 2, True, 2023, "s", "T2", "u", ""), (8, "r", "X", "3.1", None, None, None, 2, True, 2023, None, None, None, ""),
    ]
    got = {r["obs_id"]: (r["cls"], r["level"], r["stale"]) for r in rows(spark, o).collect()}
    assert got == {1: ("Measured", 1, True), 2: ("Measured", 5, False), 3: ("Measured", None, False), 4: ("Measured", 3, False), 5: ("Gap", None, False), 6: ("Judged", 3, True), 7: ("Documented", 2, False), 8: ("", None, False)}


def test_empty_groups_and_rounding(spark):
    o = [(i, "r", "X", "3.1", None, "t", "Judged", 1 + (i < 1), True, 2024, "s", "T1", "u", "") for i in range(40)]
    p = {r["pillar"]: r for r in sc.pillar_profile(rows(spark, o)).collect()}
    assert len(p) == 7 and p["A1"]["band"] == "Not rated" and p["A1"]["mean"] is None and p["C2"]["mean"] == 1.03 and p["C2"]["weak"]
    assert sc.pillar_profile(rows(spark, []).limit(0)).count() == 0
    pairs = spark.range(1, 58).select(F.col("id").alias("n")).select("n", F.explode(F.sequence("n", F.col("n") * 5)).alias("s"))
    from decimal import ROUND_HALF_UP, Decimal

    for r in pairs.select("n", "s", F.round(F.col("s") / F.col("n"), 2).alias("m")).collect():
        assert r["m"] == float(Decimal(str(r["s"] / r["n"])).quantize(Decimal("0.01"), ROUND_HALF_UP))


def test_missing_entries_are_those_of_the_runs_time(spark, tmp_path):
    from agrolith.plans.scoring import q_missing_in_force

    day = "timestamp_ntz '{} 00:00:00'".format
    spark.sql(f"select * from values ('1.1', {day('2021-01-01')}, null), ('1.2', {day('2021-01-01')}, {day('2023-04-30')}), ('1.3', {day('2025-05-01')}, null), ('1.4', null, {day('2024-01-01')}) t(indicator_id, added_on, retired_on)").write.parquet(str(tmp_path / "indicators.parquet"))
    spark.sql(
        f"select * from values ('r1', 'A', '1.1', {day('2022-02-01')}), ('r2', 'A', '1.1', {day('2023-04-30')}), ('r3', 'A', '1.2', {day('2025-05-01')}), ('r4', 'B', '1.3', {day('2026-01-01')}), ('r4', 'B', '1.1', {day('2026-01-03')}) t(run_id, subject, indicator_id, observed_at)"
    ).write.parquet(str(tmp_path / "observations.parquet"))
    got = sorted((r["run_id"], r["indicator_id"]) for r in q_missing_in_force(spark, str(tmp_path)).collect())
    assert got == [("r1", "1.2"), ("r1", "1.4"), ("r2", "1.4"), ("r3", "1.1"), ("r3", "1.3")]
