import hashlib
from itertools import product

from pyspark.sql import functions as F

from agrolith.operators import rules


def test_cascades(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 9)], "id int, x int")
    r = [(F.col("x") > 8, "big"), (F.col("x") > 4, "some"), (F.col("x").isNull(), "none")]
    got = {x["id"]: (x["f"], x["a"]) for x in df.select("id", rules.first_failing(r).alias("f"), rules.all_failing(r).alias("a")).collect()}
    assert got == {1: ("none", ["none"]), 2: ("some", ["some"]), 3: ("big", ["big", "some"])}
    w = df.select(rules.worst([F.when(F.col("x") == 9, "hold"), F.when(F.col("x") > 4, "pass"), F.lit(None)]).alias("v")).collect()
    assert [x["v"] for x in w] == [None, "pass", "hold"]


def test_predicate_is_three_valued(spark):
    tree = {"any": [{"field": "a", "equals": True}, {"all": [{"field": "b", "equals": True}, {"field": "c", "equals": False}]}]}
    facts = list(product((True, False, None), repeat=3))
    df = spark.createDataFrame(facts, "a boolean, b boolean, c boolean")

    def kleene_and(x, y):
        return False if x is False or y is False else None if x is None or y is None else True

    def kleene_not(x):
        return None if x is None else not x

    def kleene_or(x, y):
        return kleene_not(kleene_and(kleene_not(x), kleene_not(y)))

    got = [r["p"] for r in df.select(rules.predicate(tree, {k: F.col(k) for k in "abc"}).alias("p")).collect()]
    assert got == [kleene_or(a, kleene_and(b, kleene_not(c))) for a, b, c in facts]


def test_completeness_and_prefix(spark):
    need = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    have = spark.createDataFrame([("a",), ("b",), ("b",), ("z",)], "k string")
    assert sorted(map(tuple, rules.completeness(need, have, ["k"]).collect())) == [("b", "repeated"), ("c", "missing"), ("z", "unknown")]
    a = spark.createDataFrame([("s", 1, "x"), ("s", 2, "y"), ("s", 3, "z"), ("t", 1, "q")], "g string, o int, v string")
    b = spark.createDataFrame([("s", 5, "x"), ("s", 6, "y"), ("t", 1, "q")], "g string, o int, v string")
    got = {r["g"]: (r["left_n"], r["right_n"], r["agreed"]) for r in rules.prefix_agreement(a, b, ["g"], "o", F.col("v")).collect()}
    assert got == {"s": (3, 2, 2), "t": (1, 1, 1)}


def test_package_contents(spark):
    files = spark.createDataFrame([("a", bytearray(b"1")), ("b", bytearray(b"22")), ("c", bytearray(b"3")), ("x", bytearray(b""))], "name string, content binary")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    manifest = spark.createDataFrame([("a", 1, sha(b"1").upper()), ("b", 1, sha(b"22")), ("c", 1, sha(b"4")), ("d", 1, sha(b"5"))], "name string, bytes bigint, sha256 string")
    assert sorted(map(tuple, rules.package_contents(files, manifest).collect())) == [("b", "size"), ("c", "digest"), ("d", "missing"), ("x", "not listed")]


def test_probes_read_titles_of_sources(spark, tmp_path):
    from agrolith.plans.reports import q_probed_labels

    spark.sql("select * from values ('1.1', 'Mobile credit use'), ('1.2', 'Roads') t(indicator_id, name)").write.parquet(str(tmp_path / "indicators.parquet"))
    spark.sql("select * from values (1L, 'Survey of women online'), (1L, 'Survey of women online'), (2L, 'Survey of women online'), (3L, 'Brief'), (4L, null), (5L, 'Roads') t(cell_id, source_title)").write.parquet(str(tmp_path / "research_cells.parquet"))
    got = sorted((r["kind"], r["label"], r["probe"], r["uses"]) for r in q_probed_labels(spark, str(tmp_path)).collect())
    assert got == [("indicator", "Mobile credit use", 1, 1), ("indicator", "Mobile credit use", 3, 1), ("source", "Survey of women online", 2, 2), ("source", "Survey of women online", 5, 2)]
