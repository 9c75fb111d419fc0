"""Tables between the steps of an operator, in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, or the checkpoint folder that was set by hand. A local session without
    either gets a temporary one; on a cluster that would be a folder of one machine, and so is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        by_hand = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = by_hand.get() if by_hand.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='shared-')}"
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def arrow_files(path: str):
    """The filesystem and inner path of a path or URI that tasks open by themselves (local, hdfs, s3, gs)."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        scheme, _, rest = path.partition(":")
        return fs.FileSystem.from_uri(f"file:///{rest.lstrip('/')}" if scheme == "file" else path)
    return fs.LocalFileSystem(), path


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


#: Rows that a task gets where much is done with each.
SPREAD = 10_000


def spread(df: DataFrame, *keys: str, rows: int = SPREAD) -> DataFrame:
    """``df`` dealt by its keys into parts of about ``rows`` rows: readers make tasks by bytes, and a small file of many short
    rows would be one task, however long each row takes."""
    parts = -(-df.count() // rows)
    return df.repartition(parts, *keys) if parts > 1 else df


def stored(df: DataFrame, label: str, *folders: str) -> DataFrame:
    """Write ``df`` and read it back: later steps neither repeat its work nor depend on executors' disks. ``folders`` are
    columns by whose values the files are divided; they come last in the schema."""
    path = fresh_path(df.sparkSession, label)
    df.write.partitionBy(*folders).parquet(path)
    order = [c for c in df.columns if c not in folders] + list(folders)
    return df.sparkSession.read.schema(df.select(order).schema).parquet(path)
