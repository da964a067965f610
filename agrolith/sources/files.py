"""Readers beside the Parquet tables: assessment JSON, statistics as CSV (also zipped), verified uploads, paged services.

All of them declare their schemas; nothing is inferred. A number that is typed as text stays text.
"""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def read_assessments(spark: SparkSession, path: str) -> DataFrame:
    """Observations of files {subject: ..., observations: {indicator_id: {...}}}: one row per indicator.

    ``value`` becomes value_num if its JSON type is a number, else value_text; a level that is null is told from one that is
    absent. A file that is no valid JSON fails the read.
    """
    v = spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("v"))
    rows = v.select(F.variant_get("v", "$.subject", "string").alias("subject"), F.variant_get("v", "$.observations", "variant").alias("o"))
    cells = rows.lateralJoin(spark.tvf.variant_explode(F.col("o").outer())).select("subject", F.col("key").alias("indicator_id"), F.col("value").alias("r"))
    value = F.try_variant_get("r", "$.value", "variant")
    kind = F.schema_of_variant(value)
    numeric = kind.rlike("^(BIGINT|DOUBLE|DECIMAL.*|FLOAT|INT|SMALLINT|TINYINT)$")
    text = lambda f: F.try_variant_get("r", f"$.{f}", "string").alias(f)
    return cells.select(
        "subject", "indicator_id", F.when(numeric, F.try_variant_get("r", "$.value", "double")).alias("value_num"), F.when(~numeric & (kind != "VOID"), F.try_variant_get("r", "$.value", "string")).alias("value_text"),
        text("cls"), F.try_variant_get("r", "$.level", "int").alias("level"), F.schema_of_variant("r").rlike(r"[<, ]level:").alias("level_present"), F.try_variant_get("r", "$.year", "int").alias("year"),
        text("src"), text("note"), text("tier"), text("url"), F.try_variant_get("r", "$.subs", "array<string>").alias("subs"),
    )


def missing_observations(observations: DataFrame, indicators: DataFrame) -> DataFrame:
    """subject, indicator_id of the catalog that a subject has no observation of."""
    ids = sorted(r[0] for r in indicators.select("indicator_id").distinct().collect())  # the catalog
    have = observations.groupBy("subject").agg(F.collect_set("indicator_id").alias("have"))
    return have.select("subject", F.explode(F.array_except(F.array(*map(F.lit, ids)), "have")).alias("indicator_id"))


def complete_observations(observations: DataFrame, indicators: DataFrame) -> DataFrame:
    """The observations, if no subject lacks an entry of the catalog; else an error that names some of what lacks."""
    lost = missing_observations(observations, indicators).limit(5).collect()
    if lost:
        raise ValueError("no observation of " + ", ".join(f"{r['indicator_id']} for {r['subject']}" for r in lost))
    return observations


def read_statistics_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header in UTF-8; a byte order mark and short rows do no harm."""
    return spark.read.option("header", True).option("enforceSchema", True).option("encoding", "UTF-8").option("ignoreLeadingWhiteSpace", True).schema(schema).csv(path)


def read_zipped_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The CSV members of ZIP archives as text columns; archives are spread over tasks, one archive in memory per task."""
    import csv

    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def rows(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            for content in pdf["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in z.namelist():
                        if name.lower().endswith(".csv"):
                            with io.TextIOWrapper(z.open(name), encoding="utf-8-sig", newline="") as f:
                                part = []
                                for r in csv.DictReader(f):
                                    part.append([r.get(c) for c in columns])
                                    if len(part) == 50_000:
                                        yield pd.DataFrame(part, columns=columns)
                                        part = []
                                yield pd.DataFrame(part, columns=columns)

    return files.mapInPandas(rows, ", ".join(f"`{c}` string" for c in columns))


def read_alias(spark: SparkSession, path: str, legacy: str) -> str | None:
    """The text of a file under its name or its former name; None if neither is there. If both are, they must be the same JSON."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    texts = []
    for p in (path, legacy):
        target = jvm.org.apache.hadoop.fs.Path(p)
        if target.getFileSystem(conf).exists(target):
            texts.append(spark.read.text(p, wholetext=True).first()[0])
    if len(texts) == 2 and json.loads(texts[0]) != json.loads(texts[1]):
        raise ValueError(f"{path} and {legacy} differ")
    return texts[0] if texts else None


def hosts_by_label(pages: DataFrame, html: str, least: int = 1) -> DataFrame:
    """label, hosts: the hosts that links of each label lead to, each once; an error if there are fewer than ``least`` labels, as a page that changed its form would give."""
    link = r"(?is)<a\b[^>]*?href=[\"']https?://([^/\"':?#]+)[^>]*>\s*([^<]+?)\s*</a>"
    pairs = pages.select(F.explode(F.arrays_zip(F.regexp_extract_all(html, F.lit(link), 1).alias("host"), F.regexp_extract_all(html, F.lit(link), 2).alias("label"))).alias("p"))
    out = pairs.groupBy("p.label").agg(F.array_sort(F.collect_set(F.regexp_replace(F.lower("p.host"), r"^www\.", ""))).alias("hosts"))
    if least > 1 and len(out.limit(least).collect()) < least:
        raise ValueError(f"fewer than {least} labels")
    return out


def latest_value(series: DataFrame, keys: list[str], year: str = "year", value: str = "value") -> DataFrame:
    """The latest non-blank value of each key (greatest year, then greatest value)."""
    best = series.where(F.trim(F.coalesce(F.col(value).cast("string"), F.lit(""))) != "").groupBy(*keys).agg(F.max(F.struct(F.col(year).cast("int").alias(year), F.col(value))).alias("b"))
    return best.select(*keys, f"b.{year}", f"b.{value}")


def verified_documents(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """Uploads whose content has the digest of the manifest (name, sha256): name, text, verified; others have no text."""
    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("digest"), "content")
    joined = files.join(manifest, "name")
    ok = F.col("digest") == F.lower("sha256")
    return joined.select("name", ok.alias("verified"), F.when(ok, F.decode("content", "UTF-8")).alias("text"))


class PagedJsonSource(DataSource):
    """``spark.read.format("paged_json")``: a service that answers page by page, here from files page_1.json, page_2.json, ...

    Option ``path``: the folder; ``pages``: their number. Each page, a list of {code, year, value}, is one input partition.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "code string, year int, value double"

    def reader(self, schema) -> DataSourceReader:
        return _PagedReader(self.options["path"], int(self.options.get("pages", "1")))


class _PagedReader(DataSourceReader):
    def __init__(self, path: str, pages: int):
        self.path, self.pages = path, pages

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(i + 1) for i in range(self.pages)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with open(f"{self.path}/page_{partition.value}.json", encoding="utf-8") as f:
            for r in json.load(f):
                if r.get("value") is not None:
                    yield str(r["code"]), int(r["year"]), float(r["value"])
