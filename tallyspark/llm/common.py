"""Helpers that the training-data operators share: scratch tables, file access, batches."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """Folder that the driver and all executors share, from ``spark.checkpoint.dir``.

    A local session without that setting (tests) gets a temporary folder; a cluster without it is
    an error, since no machine-local folder would do.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        set_by_hand = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = set_by_hand.get() if set_by_hand.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="scratch-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


#: Scratch data are read once or twice: the fastest level will do.
ZSTD = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}
#: Spark's setting that has a query's shuffle files deleted as soon as the query has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write(df: DataFrame, path: str, **options: str) -> None:
    """Write ``df`` as Parquet; its shuffle files go when it is written, and so don't add up over the
    steps of an operator."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        df.write.options(**(ZSTD | options)).parquet(path)
    finally:
        conf.set(CLEANUP, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet in the shared folder and read it again."""
    path = scratch(df.sparkSession, label)
    write(df, path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def bucketed(df: DataFrame, label: str, key: str, buckets: int) -> DataFrame:
    """``df`` as a table in the shared folder, in buckets of ``key``: grouping it by ``key`` needs no shuffle."""
    path = scratch(df.sparkSession, label)
    name = path.rpartition("/")[2].replace("-", "_")
    df.write.options(**ZSTD, path=path).bucketBy(buckets, key).saveAsTable(name)
    out = df.sparkSession.table(name)
    out.scratch_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete scratch tables made by ``stored`` that no later job reads."""
    for table in tables:
        path = getattr(table, "scratch_path", None)
        if path:
            jvm, spark = table.sparkSession._jvm, table.sparkSession
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


#: Rows up to which a table of numbers is broadcast: some 120 bytes each in the driver's hash table, and their copy that is sent.
BROADCAST_ROWS = 500_000


def small(table: DataFrame) -> DataFrame:
    """A stored table of numbers, to be broadcast in a join if it has at most BROADCAST_ROWS rows. Beyond
    that, and for other types, Spark shuffles both sides, however few bytes the files have."""
    fixed = all(f.dataType.typeName() in ("long", "integer", "short", "byte") for f in table.schema)
    return F.broadcast(table) if fixed and table.count() <= BROADCAST_ROWS else table.hint("merge")


#: Up to which size a side of a join is broadcast: as files suggest before a query runs, and as measured in its shuffles.
ESTIMATED, MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"


@contextlib.contextmanager
def measured_joins(spark: SparkSession) -> Iterator[None]:
    """Queries that run within it broadcast by hint, or where a shuffle's size is known to be under the session's threshold.
    By its files, a compressed table of ids counts for a twentieth of what it takes in the driver, and one whose rows are
    multiplied before the join for less still."""
    conf = spark.conf
    before = {k: conf.get(k, None) for k in (ESTIMATED, MEASURED)}
    conf.set(MEASURED, before[MEASURED] or conf.get(ESTIMATED))
    conf.set(ESTIMATED, "-1")
    try:
        yield
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The filesystem and inner path of a shared-folder URI (file, hdfs, s3, gs)."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def slices(batches: Iterable[pa.RecordBatch], rows: int = 1000, most_bytes: int = 32 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of at most ``rows`` rows and ``most_bytes`` bytes (a longer row is alone), so a
    task's working set stays small. What Arrow holds for reuse is given back at the end, for a worker
    goes on to tasks of other kinds."""
    for batch in batches:
        parts = [batch.slice(at, rows) for at in range(0, batch.num_rows, rows)][::-1]
        while parts:
            part = parts.pop()
            if part.num_rows > 1 and part.nbytes > most_bytes:
                half = part.num_rows // 2
                parts += [part.slice(half), part.slice(0, half)]
            else:
                yield part
    pa.default_memory_pool().release_unused()


def runs(batches: Iterable[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows that come together by ``keys``, a key's rows at once."""
    at, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if key != at:
                if rows:
                    yield at, rows
                at, rows = key, []
            rows.append(row)
    if rows:
        yield at, rows


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Just the id and the text, under fixed names: other columns can't clash."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
