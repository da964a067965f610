from datetime import datetime

import pytest

from agrolith.operators.orphans import by_table_and_period, orphan_references


def test_periods(spark):
    t = spark.createDataFrame([("A", datetime(2020, 1, 1), datetime(2023, 1, 1)), ("B", datetime(2024, 1, 1), None), ("C", None, None), (None, None, None)], "code string, added_on timestamp_ntz, retired_on timestamp_ntz")
    refs = [(1, "A", 2022, "ok"), (2, "A", 2023, "deleted"), (3, "A", 2019, "late"), (4, "B", 2023, "late"), (5, "B", 2024, "ok"), (6, "C", 1999, "ok"), (7, "Z", 2022, "missing"), (8, None, 2022, "ok"), (7, "Z", 2022, "missing")]
    r = spark.createDataFrame([(i, c, datetime(y, 1, 1), "x") for i, c, y, _ in refs], "id int, code string, at timestamp_ntz, added_on string")
    got = sorted((x["id"], x["state"]) for x in orphan_references(r, t, ["code"], at="at").collect())
    assert got == sorted({(i, s) for i, _, _, s in refs if s != "ok"})
    assert orphan_references(r.limit(0), t, ["code"], at="at").count() == 0
    assert orphan_references(r, t.limit(0), ["code"], at="at").where("state = 'missing'").count() == 7
    counts = by_table_and_period(orphan_references(r, t, ["code"], at="at"), "added_on", "code", "id")
    assert counts.agg({"orphans": "sum"}).first()[0] == 4


@pytest.mark.parametrize(("match", "ids"), [("simple", [4, 9]), ("partial", [3, 4, 9]), ("full", [2, 3, 4, 9])])
def test_partial_nulls(spark, match, ids):
    t = spark.createDataFrame([("a", 1), ("b", 2), ("a", None)], "k string, n int")
    r = spark.createDataFrame([(1, "a", 1), (2, "a", None), (3, None, 7), (4, "a", 2), (5, None, None), (9, "z", 1)], "id int, k string, n int")
    assert sorted(x["id"] for x in orphan_references(r, t, ["k", "n"], match=match).collect()) == ids


def test_unknown_semantics(spark):
    df = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError):
        orphan_references(df, df, ["k"], match="some")
