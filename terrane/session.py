"""Session settings and lineage cuts shared by every module."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime settings the library is tuned for. AQE sizes the shuffles and splits
# skewed join partitions, also where that costs one more exchange.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

SMALL_ROWS = 100_000    # rows of a stored table that Spark may choose to broadcast


def get_spark(app: str = "terrane", master: str | None = None, **conf) -> SparkSession:
    """Build (or fetch) a session with the library's runtime settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster that
    folder would be lost with its machine, so a missing setting is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="terrane-")
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, for layers a job writes and rereads."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str = "layer", merged: bool = True) -> DataFrame:
    """Write once below the shared folder and read back: for layers used several times.

    Unlike a checkpoint the result keeps column pruning and file statistics. Spark weighs
    a table by its files, which says little of repeated numbers: millions of rows of them can fill
    less than the broadcast threshold. So a table above SMALL_ROWS rows asks for
    merge joins; a broadcast hint on the other side still wins. ``merged=False`` is for tables
    whose joins are chosen by hand.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    back = df.sparkSession.read.parquet(path)
    return back if not merged or back.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else back.hint("merge")


def chosen_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """A small table of known size: marked for broadcast up to ``rows`` rows, left to a plain join beyond.

    ``df`` must be cheap to count (stored).
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
