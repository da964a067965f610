import json

from pyspark.sql import functions as F

from agrolith.operators import documents as d


def test_leaves():
    got = {x["path"]: x["value"] for x in d.leaves('{"a": {"b": [1, {"c": null}], "e": []}, "x y": "é", "t": true, "n": {}}')}
    assert got == {"a.b[0]": "1", "a.b[1].c": "null", "a.e": "[]", '"x y"': '"é"', "t": "true", "n": "{}"}
    assert d.leaves(None) == d.leaves("") == d.leaves('{"a": NaN}') == d.leaves("[" * 100_000) == []
    assert d.leaves("7") == [{"path": "", "value": "7"}]


def test_path_changes(spark):
    rows = [("k", 1, {"a": 1, "b": [1, 2], "gone": None}), ("k", 3, {"a": 2, "b": [1, 2, 3]}), ("k", 3, {"a": 2, "b": [1, 2, 3]}), ("k", 4, {"a": 2, "b": [1, 2, 3]}), ("other", 1, {"a": 1})]
    df = spark.createDataFrame([(k, n, json.dumps(r), "clash", "x") for k, n, r in rows] + [("k", 9, None, "", "")], "k string, no int, payload string, path string, old string")
    got = sorted(map(tuple, d.path_changes(df, ["k"], "no", "payload").collect()))
    assert got == [("k", 3, 1, "a", "changed", "1", "2"), ("k", 3, 1, "b[2]", "added", None, "3"), ("k", 3, 1, "gone", "removed", "null", None)]
    assert d.path_changes(df.limit(0), ["k"], "no", "payload").count() == 0


def test_overrides_tell_null_from_absent(spark):
    base = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (3, None, 7)], "id int, x string, y int")
    one = spark.createDataFrame([(1, {"x": None}), (2, {"y": "60"}), (9, {"x": "new"})], "id int, patch map<string,string>")
    two = spark.createDataFrame([(2, {"x": "later", "y": None}), (3, {}), (1, None)], "id int, patch map<string,string>")
    got = sorted(map(tuple, d.apply_overrides(base, [one, two], ["id"], ["x", "y"]).collect()))
    assert got == [(1, None, "5"), (2, "later", None), (3, None, "7")]
    assert sorted(map(tuple, d.apply_overrides(base, [], ["id"], ["x", "y"]).collect())) == [(1, "a", "5"), (2, "b", "6"), (3, None, "7")]


SCHEMA = {"type": "object", "required": ["id"], "additionalProperties": False, "properties": {"id": {"type": "string", "minLength": 2, "pattern": "^[a-z]+$"}, "n": {"type": ["integer", "null"], "minimum": 1, "maximum": 5}, "xs": {"type": "array", "minItems": 1, "items": {"type": "number"}}, "e": {"enum": [1, True, "a"]}}}


def test_schema_errors(spark):
    cases = {
        '{"id": "ab", "n": null, "xs": [1, 2.5], "e": "a"}': [], '{"n": 7}': [("id", "required"), ("n", "maximum")], '{"id": "A", "n": true, "zz": 0}': [("id", "minLength"), ("id", "pattern"), ("n", "type"), ("zz", "not allowed")],
        '{"id": "ab", "xs": [1, "2", null], "n": 0}': [("n", "minimum"), ("xs[1]", "type"), ("xs[2]", "type")], '{"id": "ab", "xs": [], "e": 0}': [("e", "enum"), ("xs", "minItems")], "[]": [("", "type")], "{": [("", "not JSON")], '{"id": "ab", "n": 2.0}': [], '{"id": "ab", "n": 2.5}': [("n", "type")],
    }
    df = spark.createDataFrame([(t,) for t in [*cases, None]], "t string").select("t", d.schema_problems(F.col("t"), SCHEMA).alias("p"))
    got = {r["t"]: sorted((x["path"], x["problem"]) for x in r["p"]) for r in df.collect()}
    assert got == {**cases, None: [("", "not JSON")]}


def test_strict_json():
    cases = {'{"a": 1}': None, '{"a": 1, "a": 1}': "repeated key", '[{"b": {"a": 1, "a": 2}}]': "repeated key", '{"a": NaN}': "not finite", "[-Infinity]": "not finite", "{'a': 1}": "not JSON", None: "not JSON", "": "not JSON", "1": None}
    assert {t: d.strict_problem_of(t) for t in cases} == cases


def test_canonical_json(spark):
    texts = ['{"b": {"z": 1, "a": [3, {"y": null, "x": true}]}, "a": "é\\"\\n"}', "[1, 2]", '"x"', "7", "{}", '{"a": {"c": [], "b": {}}}']
    got = {r["t"]: r["c"] for r in spark.createDataFrame([(t,) for t in [*texts, "{", None]], "t string").select("t", d.canonical_json(F.col("t")).alias("c")).collect()}
    assert got == {**{t: json.dumps(json.loads(t), sort_keys=True, separators=(",", ":"), ensure_ascii=False) for t in texts}, "{": None, None: None}


def test_merge_and_order(spark):
    a, b = spark.createDataFrame([(5, "X", "main"), (4, "X", "main")], "id int, name string, of string"), spark.createDataFrame([(1, "x ", "copy"), (2, "y", "copy")], "id int, name string, of string")
    got = sorted(map(tuple, d.merge_first([a, b], [F.lower(F.trim("name"))], "id").collect()))
    assert got == [(2, "y", "copy", 1), (4, "X", "main", 0)]
    rows = spark.createDataFrame([("g", y, i) for i, y in enumerate([3, 1, 1, 2, None, 3])] + [(None, 1, 9)], "g string, y int, i int")
    assert sorted((r["i"], r["position"]) for r in d.numbered_in_order(rows, "g", "y", ["i"]).collect()) == [(0, 5), (1, 2), (2, 3), (3, 4), (4, 1), (5, 6), (9, 1)]
