"""Session helpers: shared checkpoint folder, sizes read from the optimizer, bounded broadcasts."""

from __future__ import annotations

import hashlib
import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Bytes of input that one Python bucket or salted partition is meant to hold.
BUCKET_BYTES = 16 << 20


def local_session(cores: str = "8", **conf: str) -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    base = {
        "spark.sql.shuffle.partitions": "8", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.sql.execution.arrow.pyspark.enabled": "true", "spark.driver.memory": "8g", "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    spark = SparkSession.builder.master(f"local[{cores}]").config(map=base | conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; only where it is unset (tests) a local one is made."""
    sc = spark.sparkContext
    known = sc.getCheckpointDir()
    if known:
        return known
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all nodes share")
    sc.setCheckpointDir(path or tempfile.mkdtemp(prefix="agrolith-checkpoint-"))
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, so that a lost executor doesn't repeat what came before."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of a frame's size; it grows with the files read."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def buckets_for(df: DataFrame, bytes_each: int = BUCKET_BYTES, least: int = 1) -> int:
    """How many buckets hold the frame at about ``bytes_each``; parquet is taken as three times its size in memory."""
    return max(least, min(1 << 20, 3 * plan_bytes(df) // bytes_each + 1))


#: Rows, and bytes as JSON, up to which a side that is already written (a checkpoint) is broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 64 << 20


def broadcast_if_small(written: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A written frame with a broadcast hint if it has no more than ``most`` rows and BROADCAST_BYTES, else as it is: the join then shuffles."""
    from pyspark.sql import functions as F

    rows, size = written.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))).first()
    return F.broadcast(written) if rows <= most and size <= BROADCAST_BYTES else written


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers once per context, so that they need no path to it."""
    sc = spark.sparkContext
    if getattr(sc, "_agrolith_shipped", False):
        return
    root = Path(__file__).resolve().parent
    sources = sorted(root.rglob("*.py"))
    digest = hashlib.sha256(b"".join(p.read_bytes() for p in sources)).hexdigest()[:12]
    target = Path(tempfile.mkdtemp(prefix="agrolith-")) / f"agrolith_{digest}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sources:
            z.write(p, p.relative_to(root.parent).as_posix())
    sc.addPyFile(str(target))
    sc._agrolith_shipped = True
