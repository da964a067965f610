"""Journals as streams: windowed totals with late data, open reservations and their states as running aggregates."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolith.session import ensure_checkpoint_dir

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of files, the table being one file or a folder of them; on a cluster the same plan reads a topic."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/events.parquet")
    folder = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory()
    reader = spark.readStream.schema(EVENTS)
    stream = reader.parquet(f"{sf_dir}/events.parquet") if folder else reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def windowed_totals(events: DataFrame, window: str = "1 day", late: str = "1 day") -> DataFrame:
    """Totals per window and kind; events later than ``late`` behind the newest one are left out, as their windows are closed."""
    g = events.withWatermark("ts", late).groupBy(F.window("ts", window).alias("w"), "event_type")
    return g.agg(F.count("*").alias("calls"), F.sum(F.col("value").cast("decimal(18,4)")).alias("total")).select(F.col("w.start").alias("start"), "event_type", "calls", "total")


def open_reservations(events: DataFrame, opens: str = "signup", settles: str = "purchase") -> DataFrame:
    """user_id, opened, settled, open: a running balance per user, updated as events come."""
    used = events.where(F.col("event_type").isin(opens, settles))
    g = used.groupBy("user_id").agg(F.count_if(F.col("event_type") == opens).alias("opened"), F.count_if(F.col("event_type") == settles).alias("settled"))
    return g.select("user_id", "opened", "settled", F.greatest(F.lit(0), F.col("opened") - F.col("settled")).alias("open"))


def reservation_states(events: DataFrame, keys: list[str], reserves: str = "signup", settles: str = "purchase", releases: str = "error") -> DataFrame:
    """keys, state of each reservation: open, settled, released; or what is wrong with it: never reserved, reserved twice, resolved twice, resolved early.

    Made of counts and first times, so that it doesn't matter in which order events arrive; the same plan runs over a table and over a stream.
    """
    kind = F.col("event_type")
    resolves = kind.isin(settles, releases)
    g = events.where(kind.isin(reserves, settles, releases)).groupBy(*keys).agg(
        F.count_if(kind == reserves).alias("reserved"), F.count_if(kind == settles).alias("settled"), F.count_if(kind == releases).alias("released"),
        F.min(F.when(kind == reserves, F.col("ts"))).alias("first_reserved"), F.min(F.when(resolves, F.col("ts"))).alias("first_resolved"),
    )
    state = (
        F.when(F.col("reserved") == 0, "never reserved").when(F.col("reserved") > 1, "reserved twice").when(F.col("settled") + F.col("released") > 1, "resolved twice")
        .when(F.col("first_resolved") < F.col("first_reserved"), "resolved early").when(F.col("settled") == 1, "settled").when(F.col("released") == 1, "released").otherwise("open")
    )
    return g.select(*keys, state.alias("state"))


def run_once(df: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Runs a stream over what there is. Progress and results are files in the shared checkpoint folder, each batch in its own part, so that one that is repeated replaces itself.

    The result: of ``complete`` the last batch's table, of ``update`` the rows of all batches with their number as ``batch``.
    """
    spark = df.sparkSession
    base = f"{ensure_checkpoint_dir(spark)}/streams/{name}-{uuid.uuid4().hex}"
    done: list[int] = []

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{base}/result/batch={batch}")
        done.append(batch)

    q = df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{base}/progress").trigger(availableNow=True).start()
    try:
        q.awaitTermination()
    finally:
        q.stop()
    if not done:
        return spark.createDataFrame([], df.schema if mode == "complete" else df.schema.add("batch", "int"))
    return spark.read.parquet(f"{base}/result/batch={max(done)}") if mode == "complete" else spark.read.parquet(f"{base}/result")
