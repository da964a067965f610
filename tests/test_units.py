import re
from decimal import ROUND_HALF_UP, Decimal

from agrolith.operators import units as u

FACTORS = [("USD", "money", "USD", 1.0), ("XKL", "money", "USD", 0.00064), ("%", "share", "%", 1.0), ("bp", "share", "%", 0.01), ("fraction", "share", "%", 100.0), ("permille", "share", "%", 0.1), ("mm", "rain", "mm", 1.0), ("m", "rain", "mm", 1000.0), ("km", "length", "km", 1.0), ("metre", "length", "km", 0.001), ("persons", "count", "persons", 1.0), ("thousand persons", "count", "persons", 1000.0), ("million persons", "count", "persons", 1e6), ("index100", "score", "index100", 1.0), ("index10", "score", "index100", 10.0), ("kg/ha", "yield", "kg/ha", 1.0)]
CASES = [
    ("12.5", None, None, "%", 12500), ("12,5", None, None, "%", 12500), ("1,043", None, None, "persons", 1043000), ("1.601.861", None, None, "persons", 1601861000), ("1.014,6", "bp", None, "%", 10146), ("10 999.71", None, None, "USD", 10999710), ("1'180'681", None, None, "USD", 1180681000),
    ("0,0014", None, None, "%", 1), ("0.0005", None, None, "%", 1), ("0.0004", None, None, "%", 0), ("1.83 bn", "XKL", None, "USD", 1171200000), ("XKL 1.83 bn", None, None, "USD", 1171200000), ("US$ 18'871'202", None, None, "USD", 18871202000), ("approx. 3.2", None, None, "%", 3200), ("≈ 3", None, None, "%", 3000),
    ("0.81 out of 10", None, None, "index100", 8100), ("0.5", "m", None, "mm", 500000), ("500 m", None, None, "km", 500), ("0.64 '000 people", None, None, "persons", 640000), ("0.0012 m people", None, None, "persons", 1200000), ("368,6 (latest)", "'000 people", None, "persons", 368600000), ("2.5 thousand persons", "thousand persons", None, "persons", 2500000),
    ("569.9", None, "NB: basis points, not converted.", "%", 5699), ("5", None, "The source reports this in ‰.", "%", 500), ("5 %", None, "NB: basis points, not converted.", "%", 5000), ("0.0456 ratio (0-1) (2023)", None, None, "%", 4560), ("١٩٦.٣٥‰", None, None, "%", 19635), ("11.0％", None, None, "%", 11000), ("2240.1 kg ha-1", None, None, "kg/ha", 2240100), ("-5", None, None, "%", -5000),
    # the remark anywhere in the notes, in names with stops too; other sentences with the same words are no remarks
    ("569.9", None, "The rest was drawn by hand in 2019. NB: basis points, not converted.", "%", 5699), ("3.37 bn", None, "Wait for the next season. Figure given in XKL.", "USD", 2156800000), ("3.37 bn", None, "It rained. Figure given in U.S. dollars. The council met.", "USD", 3370000000000),
    ("5", None, "First.\nUnit as published: ‰. Then it rained.", "%", 500), ("5", None, "Losses were reported in bp. We saw 5 of them.", "%", 5000), ("5", None, "The ledger is kept in XKL.", "USD", 5000), ("7", None, "Figure given in bp; see the annex.", "%", 70), ("7", None, "NB: old data. Figure given in bp.", "%", 7000),
    ("2.5" + " " * 300 + "(" + "as read by the council " * 40 + ")", "m", None, "mm", 2500000), ("0.0000015 bn", "XKL", None, "USD", 960), ("1,248,964,784,875", "XKL", None, "USD", 799337462320), ("0.123456", "bp", None, "%", 1), ("1,248,964,784,875,000", None, None, "USD", 1248964784875000000), ("7000 tn", None, None, "USD", 7 * 10**18), ("5" + "0" * 24, None, None, "USD", 5 * 10**27), ("9" * 29, None, None, "USD", None),
    ("1," * 20000, None, None, "%", None), ("about " * 5000 + "5", None, None, "%", None), ("5 " + "(" * 30000, None, None, "%", None), ("x" * 100000 + " 5", None, None, "%", None),
    ("n/a", None, None, "%", None), ("-", None, None, "%", None), (None, None, None, "%", None), ("", "%", None, "%", None), ("DATA GAP — 5 of 7 plots were seen.", None, None, "%", None), ("5 to 7", None, None, "%", None), ("5 bananas", None, None, "%", None), ("9" * 5000, None, None, "%", None), ("5 kg/ha", None, None, "%", None),
]


def test_cases(spark):
    f = spark.createDataFrame(FACTORS, "unit string, quantity string, base_unit string, factor double")
    rows = spark.createDataFrame([(i, *c[:4]) for i, c in enumerate(CASES)], "id bigint, v string, u string, n string, d string")
    got = {r["id"]: r["base_value"] for r in u.normalise_units(rows, f, "id", "v", "u", "n", "d").collect()}
    milli = {i: int((v * 1000 + Decimal("0.5")).to_integral_value("ROUND_FLOOR")) for i, v in got.items()}
    assert {i: milli.get(i) for i in range(len(CASES))} == {i: c[4] for i, c in enumerate(CASES)}
    joined = {r["id"]: r["base_value"] for r in u.normalise_units(rows, f, "id", "v", "u", "n", "d", bound=3).collect()}
    assert joined == got
    assert u.normalise_units(rows.limit(0), f, "id", "v", "u", "n", "d").count() == 0


def test_offsets_and_targets_other_than_the_base(spark):
    units = [("C", "heat", "K", 1.0, 273.15), ("K", "heat", "K", 1.0, 0.0), ("F", "heat", "K", 5 / 9, 459.67 * 5 / 9), ("kg", "mass", "t", 0.001, None), ("t", "mass", "t", 1.0, None), ("q", "mass", "t", 0.1, None)]
    f = spark.createDataFrame(units, "unit string, quantity string, base_unit string, factor double, offset double")
    rows = spark.createDataFrame([(1, "25 C", "K"), (2, "77 F", "C"), (3, "3 q", "kg"), (4, "298.15", "K"), (5, "7 t", "q")], "id bigint, v string, d string").selectExpr("*", "cast(null as string) u", "cast(null as string) n")
    got = {r["id"]: float(r["base_value"]) for r in u.normalise_units(rows, f, "id", "v", "u", "n", "d").collect()}
    assert {k: round(v, 6) for k, v in got.items()} == {1: 298.15, 2: 25.0, 3: 300.0, 4: 298.15, 5: 70.0}


def slow_number(t: str) -> Decimal:
    """The rule for marks, read character by character."""
    t = re.sub("[ ']", "", t)
    out, dots = "", t.count(".")
    decimal_comma = bool(re.search(r",\d+$", t)) and not re.search(r",\d{3}$", t)
    for i, c in enumerate(t):
        after = re.match(r"\d*", t[i + 1 :])[0]
        if c == ",":
            out += "" if len(after) == 3 else "."
        elif c == ".":
            out += "" if dots > 1 or (decimal_comma and "," in t[i:]) else "."
        else:
            out += c
    return Decimal(out)


def test_plain_numbers_of_the_tables(spark, data):
    from agrolith.plans.dealt import p3_found
    from agrolith.sources.tables import table

    data = data.replace("sf0.001", "sf0.01")
    got = {r["cell_id"]: r["value_milli"] for r in p3_found(spark, data).collect()}
    unit = {r["indicator_id"]: r["unit"] for r in table(spark, data, "indicators").collect()}
    seen = 0
    for r in table(spark, data, "research_cells").collect():
        base = unit[r["indicator_id"]]
        note = r["notes"] or ""
        if base and not r["value_unit"] and r["value"] and re.fullmatch(r"\d+(?:[ ']\d{3}|[.,]\d+)*", r["value"]) and not re.search("published:|NB:|reports this|given in", note):
            seen += 1
            assert got[r["cell_id"]] == int((slow_number(r["value"]) * 1000).to_integral_value(ROUND_HALF_UP))
    assert seen > 10


def test_values_too_great_for_the_result_are_left_out(spark, tmp_path):
    from agrolith.plans.dealt import p3_found

    cells = [(1, "a", "9" * 20, None, None), (2, "a", "9" * 26, "XKL", None), (3, "a", "9,000,000,000,000,000", None, None), (4, "a", "12", None, "Figure given in XKL."), (4, "a", "12", None, "Figure given in XKL."), (5, None, "1", None, None)]
    spark.createDataFrame(cells, "cell_id bigint, indicator_id string, value string, value_unit string, notes string").write.parquet(f"{tmp_path}/research_cells.parquet")
    spark.createDataFrame([("a", "USD"), ("b", None)], "indicator_id string, unit string").write.parquet(f"{tmp_path}/indicators.parquet")
    spark.createDataFrame(FACTORS, "unit string, quantity string, base_unit string, factor double").write.parquet(f"{tmp_path}/unit_factors.parquet")
    assert sorted(map(tuple, p3_found(spark, str(tmp_path)).collect())) == [(3, 9 * 10**18), (4, 8)]
