import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from agrolith.functions import numbers as n

CASES = {
    "US$250 million was paid": [("US$250 million", 250e6, "USD", "million", None, None)],
    "a loss of -3.5 % and minus two percent": [("-3.5 %", -3.5, None, None, "percent", None), ("minus two percent", -2, None, None, "percent", None)],
    "1,250 farmers and 3 of the 12 villages": [("1,250 farmers", 1250, None, None, None, "farmers"), ("3", 3, None, None, None, None), ("12 villages", 12, None, None, None, "villages")],
    "two hundred and five households": [("two hundred and five households", 205, None, None, None, "households")],
    "twenty-five years": [("twenty-five years", 25, None, None, None, "years")], "twenty-five-year plan": [("twenty-five-year", 25, None, None, None, "years")],
    "two thirds of the plots": [("two thirds of the plots", 2 / 3, None, None, None, "plots")], "a third of the farmers": [("a third of the farmers", 1 / 3, None, None, None, "farmers")], "half of members": [("half of members", 0.5, None, None, None, "members")],
    "half a million people": [("half a million people", 500000, None, "million", None, "people")], "two and a half tonnes per hectare": [("two and a half tonnes per hectare", 2.5, None, None, None, "tonnes/ha")], "three dozen sites": [("three dozen sites", 36, None, None, None, "sites")], "a dozen": [("a dozen", 12, None, None, None, None)],
    "5 million US dollars": [("5 million US dollars", 5e6, "USD", "million", None, None)], "40 euros": [("40 euros", 40, "EUR", None, None, None)], "€ 7bn": [("€ 7bn", 7e9, "EUR", "billion", None, None)], "1.2e3 kg/ha": [("1.2e3 kg/ha", 1200, None, None, None, "kg/ha")], "10⁶ records": [("10⁶ records", 1e6, None, None, None, "records")],
    "one two three": [("one", 1, None, None, None, None), ("two", 2, None, None, None, None), ("three", 3, None, None, None, None)], "a million": [("a million", 1e6, None, "million", None, None)],
    "on 2019-05-01, version 1.2.3 of A1, page p.12, B-12 and x_5": [], "the third village": [], "no one and a half-hearted bid": [("one", 1, None, None, None, None)], "": [], None: [], "...": [], "eleven per cent.": [("eleven per cent", 11, None, None, "percent", None)],
}


@pytest.mark.parametrize("text", list(CASES))
def test_quantities(text):
    got = [(q["raw"], q["number"], q["currency"], q["scale"], q["unit"], q["measure"]) for q in n.quantities_of(text)]
    assert [g[0] for g in got] == [w[0] for w in CASES[text]]
    assert all(math.isclose(g[1], w[1]) and g[2:] == w[2:] for g, w in zip(got, CASES[text], strict=True)), got


@given(st.text("0123456789.,-$%€ abe hundredtwothirdyonlfmpc⁶'\n", max_size=60))
@settings(max_examples=400, deadline=None)
def test_any_text_has_spans_in_order(text):
    at = 0
    for q in n.quantities_of(text):
        assert at <= q["start"] < q["end"] and text[q["start"] : q["end"]] == q["raw"]
        at = q["end"]


def one(text):
    (q,) = n.quantities_of(text)
    return q


def test_support():
    assert n.agrees(one("2.7"), 2.71) and not n.agrees(one("3"), 2.41) and n.agrees(one("3"), 2.5) and n.agrees(one("1.2 million"), 1_234_567) and not n.agrees(one("1.3 million"), 1_234_567)
    assert n.agrees(one("40"), 41, "more than ") and not n.agrees(one("40"), 39, "more than ") and n.agrees(one("40"), 39, "under ")
    c = lambda op, a, b, r, w="": n.calculation_holds(op, one(a), one(b), one(r), w)
    assert c("sum", "US$5 million", "US$2 million", "US$7 million") and not c("sum", "US$5 million", "2 million", "US$7 million") and c("difference", "7 km", "2 km", "5 km") and not c("sum", "7 km", "2 km", "9")
    assert c("product", "3", "4", "12") and not c("product", "3 km", "4", "12") and c("ratio", "6 farmers", "4 farmers", "1.5") and c("percentage", "1 farmer", "3 farmers", "33.3 %") and not c("percentage", "1 farmer", "3 farmers", "33.3") and not c("ratio", "1", "0", "1")
    assert n.supported_of("more than 40 farmers, 40 villages and 12 %", n.quantities_of("55 farmers; 12.2 %")) == [True, False, True]
    assert not n.agrees(one("1e999"), math.inf)


def test_columns(spark):
    df = spark.createDataFrame([("5 % of it", "it is 5.0 %"), (None, "7"), ("six", None)], "a string, b string")
    got = [tuple(r["s"]) for r in df.select(n.support_counts(df.a, df.b).alias("s")).collect()]
    assert got == [(1, 1), (0, 0), (1, 0)]
    assert df.select(n.quantities(df.a).alias("q")).collect()[0]["q"][0]["unit"] == "percent"
