"""The record rules over a stream of holdings: they look at one row each and so need no state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.validate import record_issues
from ..schema import HOLDINGS


def holdings_stream(spark: SparkSession, path: str) -> DataFrame:
    """Holdings in Parquet files that are added to a folder, with their holding_id."""
    return spark.readStream.schema("holding_id string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in HOLDINGS)).parquet(path)


def write_issues(holdings: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append each holding's issues to Parquet files, exactly once across restarts."""
    return record_issues(holdings).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
