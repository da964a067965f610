"""Writers: sections as Parquet, an assembled JSON, inventories as CSV that spreadsheets can't run, publish-once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolith.functions.text import guard_spreadsheet
from agrolith.session import ensure_checkpoint_dir

#: The columns that come first in an inventory, in this order.
PREFERRED = ("table_name", "subject", "indicator_id", "name", "title", "url", "tier", "year")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{ensure_checkpoint_dir(spark)}/written/{name}-{uuid.uuid4().hex}"


def inventory_columns(columns: list[str]) -> list[str]:
    """Preferred columns first, the rest by name."""
    return [c for c in PREFERRED if c in columns] + sorted(c for c in columns if c not in PREFERRED)


def write_inventory(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV in stable column order; nested values as JSON; texts guarded, with their outer blanks."""
    kinds = dict(df.dtypes)
    cells = [guard_spreadsheet(F.col(c) if kinds[c] == "string" else F.to_json(F.col(c)) if kinds[c].startswith(("array", "struct", "map")) else F.col(c).cast("string")).alias(c) for c in inventory_columns(df.columns)]
    df.select(*cells).write.mode(mode).option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_assembled(sections: dict[str, DataFrame], keys: list[str], path: str, mode: str = "errorifexists") -> None:
    """One JSON object per key, with a list for each section; sections are grouped by key before they meet."""
    out = None
    for name, df in sections.items():
        one = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*[c for c in df.columns if c not in keys]))).alias(name))
        out = one if out is None else out.join(one, keys, "full_outer")
    out.write.mode(mode).json(path)


def publish_once(df: DataFrame, path: str) -> None:
    """Writes Parquet if the path is free; if not, the rows there must be the same ones."""
    spark = df.sparkSession
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(hadoop).exists(target):
        df.write.mode("errorifexists").parquet(path)
        return
    there = spark.read.parquet(path)
    if there.columns != df.columns or there.exceptAll(df).take(1) or df.exceptAll(there).take(1):
        raise ValueError(f"{path} holds other rows")
