import json
from collections import defaultdict

from agrolith.operators import drift


def slow_changes(records):
    """The changes of (feed, file_no, payload) rows, file by file."""
    files = defaultdict(lambda: defaultdict(list))
    for feed, no, payload in records:
        try:
            r = json.loads(payload)
        except (ValueError, TypeError):
            continue
        if isinstance(r, dict):
            files[feed][no].append(r)
    kind = lambda v: {str: "string", bool: "boolean", int: "number", float: "number", list: "array", dict: "object"}.get(type(v))
    out = set()
    for feed, by_no in files.items():
        last, before = {}, None
        for no in sorted(by_no):
            rows = by_no[no]
            here = {k for r in rows for k in r}
            if before is not None:
                was = {k for r in by_no[before] for k in r}
                gone, new = sorted(was - here), sorted(here - was)
                for g in list(gone):
                    for n in list(new):
                        a = {r["id"]: r[g] for r in by_no[before] if r.get(g) is not None}
                        b = {r["id"]: r[n] for r in rows if r.get(n) is not None}
                        both = a.keys() & b.keys()
                        if both and sum(a[i] == b[i] for i in both) * 2 > len(both) and g in gone and n in new:
                            out.add((feed, no, "renamed", g, n))
                            gone.remove(g)
                            new.remove(n)
                            last[n] = last.pop(g, None)
                out |= {(feed, no, "removed", g, "") for g in gone} | {(feed, no, "added", n, "") for n in new}
            for f in here:
                kinds = [kind(r[f]) for r in rows if r.get(f) is not None]
                if kinds:
                    if last.get(f) not in (None, kinds[0]):
                        out.add((feed, no, "retyped", f, ""))
                    last[f] = kinds[0]
            before = no
    return out


def test_against_brute_force(spark, data):
    from agrolith.sources.tables import table

    data = data.replace("sf0.001", "sf0.01")
    raw = table(spark, data, "raw_records").select("feed", "file_no", "payload")
    got = set(map(tuple, drift.schema_changes(raw).collect()))
    assert got == slow_changes(map(tuple, raw.collect())) and len(got) > 20


def test_small_cases(spark):
    rows = [
        ("f", 1, {"id": "a", "x": "1", "gone": 1, "n": None}), ("f", 1, {"id": "b", "x": "2", "gone": 2}), ("f", 3, {"id": "a", "y": "1", "n": 5}), ("f", 3, {"id": "b", "y": "2", "late": True}),
        ("f", 4, {"id": "a", "y": ["1"], "n": "5", "late": None}), ("f", 9, {"id": "a", "y": [], "x": 7, "late": False}), ("g", 1, {"id": "a", "é ü": {"t": 1}}),
    ]
    records = [(f, n, json.dumps(r)) for f, n, r in rows] + [("f", 2, '{"id": "a", "x"'), ("f", 4, "[1]"), ("f", 4, None), ("f", 3, json.dumps(rows[2][2]))]
    lost = [(None, 1, json.dumps(rows[0][2]), "noise"), ("f", None, json.dumps(rows[0][2]), "noise")]
    df = spark.createDataFrame([(*r, "noise") for r in records] + lost, "feed string, file_no int, payload string, field string")
    got = set(map(tuple, drift.schema_changes(df).collect()))
    assert got == slow_changes(records)
    assert ("f", 3, "renamed", "x", "y") in got and ("f", 4, "retyped", "y", "") in got and ("f", 3, "removed", "gone", "") in got and ("f", 9, "added", "x", "") in got
    assert drift.schema_changes(df.limit(0)).count() == 0


def test_consistent_table(spark):
    rows = [("f", 1, {"id": "a", "lead": "L", "uc": "p; q", "odd": 1}), ("f", 2, {"id": "a", "Lead": "L", "uc": ["p"], "year": "2024"}), ("f", 3, {"id": "a", "Lead": {"text": "M"}, "year": 2025}), ("f", 3, {"id": "a", "Lead": {"text": "M"}, "year": 2025})]
    df = spark.createDataFrame([(f, n, json.dumps(r)) for f, n, r in rows], "feed string, file_no int, payload string")
    got = {r["file_no"]: r for r in drift.consistent_table(df).collect()}
    assert [got[i]["lead"] for i in (1, 2, 3)] == ["L", "L", "M"]
    assert got[1]["uc"] == ["p", "q"] and got[2]["uc"] == ["p"] and got[3]["uc"] is None
    assert [got[i]["year"] for i in (1, 2, 3)] == [None, 2024, 2025] and got[1]["extra"] == {"odd": "1"} and len(got) == 3


def test_consistent_table_keeps_records_without_id(spark):
    rows = [("f", 1, '{"id": "a", "lead": "L"}'), ("f", 1, '{"lead": "M", "odd": 1}'), ("f", 1, '{"odd": 1,  "lead": "M"}'), ("f", 1, '{"id": null, "lead": "N"}'), ("g", 1, '{"lead": "P"}'), ("g", 2, "{}"), ("g", 2, "[1]"), (None, 1, '{"lead": "Q"}')]
    got = drift.consistent_table(spark.createDataFrame(rows, "feed string, file_no int, payload string")).collect()
    assert sorted((r["feed"], r["file_no"], r["lead"] or "", r["extra"].get("odd") or "") for r in got) == [("f", 1, "L", ""), ("f", 1, "M", "1"), ("f", 1, "N", ""), ("g", 1, "P", ""), ("g", 2, "", "")]
    assert len({r["rid"] for r in got}) == 5 and all(r["rid"] == "a" or r["rid"].startswith("sha256:") for r in got)


def test_conflicts_nulls_and_failed_casts_of_the_table(spark):
    rows = [("f", 1, {"id": "a", "lead": "L", "year": "soon", "odd": None}), ("f", 1, {"id": "a", "lead": "K", "year": "2024"}), ("f", 1, {"year": "2024", "lead": "K", "id": "a"}), ("f", 1, {"id": "b", "uc": [1, "x"], "deep": {"k": [1]}})]
    df = spark.createDataFrame([(f, n, json.dumps(r)) for f, n, r in rows], "feed string, file_no int, payload string")
    got = sorted(drift.consistent_table(df).collect(), key=lambda r: (r["rid"], r["lead"] or ""))
    assert [(r["rid"], r["lead"], r["year"], r["failed"]) for r in got] == [("a", "K", 2024, []), ("a", "L", None, ["year"]), ("b", None, None, [])]
    assert got[1]["extra"] == {"odd": None} and got[0]["extra"] == {} and got[2]["extra"] == {"deep": '{"k":[1]}'} and got[2]["uc"] == ["1", "x"]


def test_long_chains_of_names(spark):
    rows, name = [], "n0"
    for i in range(1, 40):
        # the field is renamed in each file; another one comes and goes under a name that was used before
        name = f"n{i}" if i % 3 else name
        rows += [("f", i, {"id": k, name: f"v{k}", "kind": 5 if i < 30 else "5", **({"n0": True} if i % 5 == 0 else {})}) for k in ("a", "b", "c")]
    records = [(f, n, json.dumps(r)) for f, n, r in rows]
    df = spark.createDataFrame(records, "feed string, file_no int, payload string")
    assert set(map(tuple, drift.schema_changes(df).collect())) == slow_changes(records)
    line = drift.lineages(spark.createDataFrame([("f", f"x{i}", i, i, i - 1, i + 1) for i in range(1, 65)], "feed string, field string, first_file int, last_file int, before int, after int"), spark.createDataFrame([("f", i + 1, f"x{i}", f"x{i + 1}") for i in range(1, 64)], "feed string, file_no int, field string, new_field string"))
    assert {r["lineage"] for r in line.collect()} == {"x1\0" + "1"}


def test_whoever_loses_its_best_partner_takes_the_next(spark):
    old = [{"id": i, "p": i, "q": i if i < 9 else -i} for i in range(10)]
    new = [{"id": i, "r": i, "s": i if i < 8 else -i} for i in range(10)]
    df = spark.createDataFrame([("f", 1, json.dumps(r)) for r in old] + [("f", 2, json.dumps(r)) for r in new], "feed string, file_no int, payload string")
    assert set(map(tuple, drift.schema_changes(df).collect())) == {("f", 2, "renamed", "p", "r"), ("f", 2, "renamed", "q", "s")}
