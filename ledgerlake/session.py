"""Session defaults and the shared folder for tables written between stages."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def get_session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with the rules every model relies on (UTC, ANSI, AQE)."""
    builder = SparkSession.builder.appName("ledgerlake")
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors share."""
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not root:
        root = _own_root(context.master)
        context.setCheckpointDir(root)
    return root.rstrip("/")


def _own_root(master: str) -> str:
    """A folder of this machine, for sessions whose executors are threads of the driver; an error on a cluster."""
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="ledgerlake-")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared root, so runs never collide."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that its owner needs no longer, through the file system that holds it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


CODEC = "zstd"  # payloads repeat the same keys row after row
_SHREDDING = "spark.sql.variant.inferShreddingSchema"
_LOCK = threading.Lock()
_OPEN: dict[SparkSession, list] = {}  # writes under way in a session, and its setting before the first of them


@contextmanager
def whole_variants(df: DataFrame):
    """While ``df`` is written, its VARIANTs stay in one piece.

    Spark would take each apart into columns of inferred fields and put it together again where a row is read. Stages and
    keyed tables are read and written row by row as a whole, so both ways cost more than the fields that a read leaves out.
    """
    spark = df.sparkSession
    with _LOCK:
        open_ = _OPEN.setdefault(spark, [0, spark.conf.get(_SHREDDING, None)])
        open_[0] += 1
        spark.conf.set(_SHREDDING, "false")
    try:
        yield df
    finally:
        with _LOCK:
            open_[0] -= 1
            if not open_[0]:
                before = _OPEN.pop(spark)[1]
                if before is None:
                    spark.conf.unset(_SHREDDING)
                else:
                    spark.conf.set(_SHREDDING, before)


def write_whole(df: DataFrame, path: str, *parts: str) -> None:
    """``df`` as compressed files of a new folder, with whole VARIANTs."""
    with whole_variants(df):
        df.write.option("compression", CODEC).partitionBy(*parts).parquet(path)


def settle(df, label: str = "stage"):
    """Write ``df`` once in the shared folder and read it back.

    Used where several branches read one costly result: the lineage ends at files that outlive any executor.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    write_whole(df, path)
    return spark.read.schema(df.schema).parquet(path)
