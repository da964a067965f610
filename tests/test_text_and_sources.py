import hashlib
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from agrolith.functions import text as tx
from agrolith.operators import ranking
from agrolith.sources import files, sinks


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column).first()[0]


@pytest.mark.parametrize(
    ("quote", "page", "holds"),
    [("short", "a short page", False), ("“It’s – here” now", 'so "It\'s - here" now.', True), ("the ﬁgure is 12", "The figure is 12.", True), ("!!!!!!!! ???", "anything", False), ("figure 13 was", "figure 12 was", False), ("قال المزارع ذلك", "ثم قال المزارع ذلك أمس", True), (None, "x", False), ("a b c d e f", "**a** b, c d e f", True)],
)
def test_quote(quote, page, holds):
    assert tx.quote_holds(quote, page) is holds


def test_numeric_mentions():
    got = [(m["number"], m["currency"], m["unit"]) for m in tx.numeric_mentions_of("About 12,500 hectares, US$ 3 million, -4.5 % and twenty-five growers; one hundred thousand.")]
    assert got == [(12500, None, "hectares"), (3e6, "US$", None), (-4.5, None, "%"), (25, None, None), (100000, None, None)]
    assert tx.numeric_mentions_of(None) == [] and tx.word_number("three hundred and five") == 305


def test_scalars(spark):
    c = F.col("a")
    assert one(spark, tx.host(c), a="HTTPS://www.Data.example:80/x?y") == "data.example"
    assert one(spark, tx.guard_spreadsheet(c), a=" =1+1") == "' =1+1"
    assert one(spark, tx.mentions(c, ["maize", "ai"]), a="Maize, said maiden") == ["maize"]
    assert one(spark, tx.strip_html(c), a="<p>a &amp; <b>b</b></p><script>x</script>") == "a & b"
    assert one(spark, tx.excerpt(c, 6), a="abcdefghij") == ("ab", "ef", "ij")
    assert one(spark, tx.parse_number(c), a="1,234.5 %") == 1234.5 and one(spark, tx.parse_number(c), a="abc") is None
    assert one(spark, tx.accent_folded(c), a="Türkiye, Perú!") == "turkiye  peru "


def test_greedy_batches(spark):
    sizes = [5, 5, 3, 11, 2, 2, 10, 1]
    df = spark.createDataFrame([(sizes,)], "s array<bigint>")
    got = df.select(ranking.greedy_batches(F.col("s"), 10)).first()[0]
    want, batch, used = [], 0, 0
    for x in sizes:
        if batch and used + x <= 10:
            used += x
        else:
            batch, used = batch + 1, x
        want.append(batch)
    assert got == want


def test_assessment_json(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"subject": "XAA", "observations": {"1.1": {"value": 12, "level": None, "year": 2024}, "1.2": {"value": "12", "cls": "Judged"}, "1.3": {"value": None, "level": 3}}}))
    got = {r["indicator_id"]: r for r in files.read_assessments(spark, str(tmp_path)).collect()}
    assert got["1.1"]["value_num"] == 12 and got["1.1"]["level_present"] and got["1.1"]["level"] is None
    assert got["1.2"]["value_text"] == "12" and got["1.2"]["value_num"] is None and not got["1.2"]["level_present"]
    assert got["1.3"]["level"] == 3 and got["1.3"]["value_text"] is None
    catalog = spark.createDataFrame([("1.1",), ("9.9",)], "indicator_id string")
    assert [r["indicator_id"] for r in files.missing_observations(files.read_assessments(spark, str(tmp_path)), catalog).collect()] == ["9.9"]
    (tmp_path / "b.json").write_text('{"subject": NaN')
    with pytest.raises(Exception):
        files.read_assessments(spark, str(tmp_path)).collect()


def test_csv_zip_uploads_pages(spark, tmp_path):
    (tmp_path / "s.csv").write_text("﻿area,item,year,value\nA,x,2020,1\nA,x,2021,\nA,x,2019,3\n", encoding="utf-8")
    s = files.read_statistics_csv(spark, str(tmp_path / "s.csv"), "area string, item string, year int, value double")
    assert [tuple(r) for r in files.latest_value(s, ["area", "item"]).collect()] == [("A", "x", 2020, 1.0)]
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("d.csv", "﻿area,year\nB,2001\nC,2002\n")
    assert sorted(map(tuple, files.read_zipped_csv(spark, str(tmp_path / "z.zip"), ["area", "year", "none"]).collect())) == [("B", "2001", None), ("C", "2002", None)]
    up = tmp_path / "up"
    up.mkdir()
    (up / "a.txt").write_text("ä")
    (up / "b.txt").write_text("b")
    manifest = spark.createDataFrame([("a.txt", hashlib.sha256("ä".encode()).hexdigest()), ("b.txt", "0" * 64)], "name string, sha256 string")
    assert sorted(map(tuple, files.verified_documents(spark, str(up), manifest).collect())) == [("a.txt", True, "ä"), ("b.txt", False, None)]
    for i in (1, 2):
        (tmp_path / f"page_{i}.json").write_text(json.dumps([{"code": "K", "year": 2020 + i, "value": i}, {"code": "K", "year": 1, "value": None}]))
    spark.dataSource.register(files.PagedJsonSource)
    pages = spark.read.format("paged_json").option("path", str(tmp_path)).option("pages", 2).load()
    assert sorted(map(tuple, pages.collect())) == [("K", 2021, 1.0), ("K", 2022, 2.0)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("=x", 1, ["a"])], "zeta string, year int, tags array<string>")
    sinks.write_inventory(df, str(tmp_path / "inv"))
    got = spark.read.option("header", True).csv(str(tmp_path / "inv"))
    assert got.columns == ["year", "tags", "zeta"] and got.first()["zeta"] == "'=x"
    sinks.publish_once(df, str(tmp_path / "once"))
    sinks.publish_once(df, str(tmp_path / "once"))
    with pytest.raises(ValueError):
        sinks.publish_once(df.withColumn("year", F.lit(2)), str(tmp_path / "once"))
    a = spark.createDataFrame([("s", 1), ("s", 2), ("t", 3)], "subject string, x int")
    sinks.write_assembled({"a": a, "b": a.where("x = 3")}, ["subject"], str(tmp_path / "all"))
    rows = {r["subject"]: r for r in spark.read.json(str(tmp_path / "all")).collect()}
    assert [x["x"] for x in rows["s"]["a"]] == [1, 2] and rows["s"]["b"] is None


def test_respelling_and_support():
    assert tx.respelled("Programme at https://x.example/programme, PROGRAMME; labour centre") == "Program at https://x.example/programme, PROGRAMME; labor center"
    assert tx.respelled(None) is None
    assert tx.supported(12.3, 1, [12.34]) and tx.supported(7, 0, [3, 4]) and tx.supported(75, 0, [3, 4]) and not tx.supported(13.3, 1, [12.34]) and not tx.supported(5, 0, [])


def test_flatten_to_leaves(spark, tmp_path):
    from agrolith.plans.evidence import ORACLES, q_flatten_leaves

    payload = '{"a": {"b": [1, {"c": null, "d": [], "e": {}}], "x.y": true}, "s": "t", "a b": [[2.5, "u"]]}'
    assert [(x["path"], x["type"]) for x in tx.leaf_paths_of(payload)] == [
        ("a.b[0]", "number"), ("a.b[1].c", "null"), ("a.b[1].d", "array"), ("a.b[1].e", "object"), ('a."x.y"', "boolean"), ("s", "string"), ('"a b"[0][0]', "number"), ('"a b"[0][1]', "string"),
    ]
    assert [tx.leaf_paths_of(x) for x in (None, "", '{"a": ', '{"a": NaN}', "[" * 100_000)] == [None] * 5
    assert [tx.leaf_paths_of(x) for x in ("7", "[]")] == [[{"path": "", "type": "number"}], [{"path": "", "type": "array"}]]
    deep = '{"k":' * 60 + "1" + "}" * 60
    rows = [(1, payload), (2, '{"a": {"b": "x"}, "s": 4}'), (3, '{"a": {"b": [7'), (4, None), (5, deep), (6, '[{"a": {"b": "x"}}]'), (7, '{"a": {"b": "y"}}'), (8, "9" * 5000)]
    spark.createDataFrame(rows, "record_id long, payload string").coalesce(1).write.parquet(str(tmp_path / "t"))
    next((tmp_path / "t").glob("*.parquet")).rename(tmp_path / "raw_records.parquet")
    for x in (tmp_path / "t").iterdir():
        x.unlink()
    (tmp_path / "t").rmdir()
    got = {(r["path"], r["type"]): r["records"] for r in q_flatten_leaves(spark, str(tmp_path)).collect()}
    assert got["a.b", "string"] == 2 and got["a.b[1].d", "array"] == 1 and got[".".join(["k"] * 60), "number"] == 1 and got["[0].a.b", "string"] == 1 and got["", "number"] == 1
    from sqlcheck import same_as_sql

    same_as_sql(spark, str(tmp_path), q_flatten_leaves, ORACLES["flatten_leaves"])


def test_alias_and_hosts(spark, tmp_path):
    from agrolith.sources import files

    new, old = tmp_path / "new.json", tmp_path / "old.json"
    assert files.read_alias(spark, str(new), str(old)) is None
    old.write_text('{"a": 1, "b": 2}')
    assert files.read_alias(spark, str(new), str(old)) == '{"a": 1, "b": 2}'
    new.write_text('{"b": 2, "a": 1}')
    assert files.read_alias(spark, str(new), str(old)) == '{"b": 2, "a": 1}'
    new.write_text('{"a": 3}')
    with pytest.raises(ValueError, match="differ"):
        files.read_alias(spark, str(new), str(old))
    html = '<a href="https://www.Stats.example/x">Xland</a> <A class="k" href=\'http://stats.example:80/y?q\'> Xland </A><a href="https://o.example">Yland</a><a href="/local">no</a>'
    got = {r["label"]: r["hosts"] for r in files.hosts_by_label(spark.createDataFrame([(html,), (None,)], "h string"), "h").collect()}
    assert got == {"Xland": ["stats.example"], "Yland": ["o.example"]}
    with pytest.raises(ValueError, match="fewer"):
        files.hosts_by_label(spark.createDataFrame([(html,)], "h string"), "h", least=100)


def test_an_assessment_must_be_complete(spark):
    from agrolith.sources import files

    catalog = spark.createDataFrame([("1.1",), ("1.2",)], "indicator_id string")
    full = spark.createDataFrame([("X", "1.1"), ("X", "1.2")], "subject string, indicator_id string")
    assert files.complete_observations(full, catalog).count() == 2
    with pytest.raises(ValueError, match="1.2 for X"):
        files.complete_observations(full.limit(1), catalog)
