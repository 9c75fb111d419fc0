"""Writers: numbered tables, manifests, holdings, reports, database tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import FIELDS
from ..storage import stored
from . import numbered


def write_tables(tables: DataFrame, path: str, prefix: str = "table_") -> None:
    """Tables as CSV files ``{path}/{doc_id}/{prefix}{n}.csv``, numbered from 1, rows padded to one width, as
    ``readers.read_numbered_csvs`` reads them. Earlier files of this prefix at ``path`` are replaced. A document is written by one
    task; there are as many tasks as shuffle partitions, for files take time by their number, not by their bytes."""
    numbered.register(tables.sparkSession)
    tasks = int(tables.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tables.select("doc_id", "table_idx", "rows").repartition(tasks, "doc_id").write.format(numbered.FORMAT).option("prefix", prefix).mode("overwrite").save(path)


def manifest(pages: DataFrame, responses: DataFrame, tables: DataFrame, failed: DataFrame) -> DataFrame:
    """A row for each document: its pages, batches, tables and failed page ranges."""
    counts = pages.groupBy("doc_id").agg(F.count("*").alias("total_pages"))
    for df, name, what in ((responses, "total_batches", F.countDistinct("batch_idx")), (tables, "total_tables", F.count("*")), (failed, "failed_page_ranges", F.array_sort(F.collect_list("page_range")))):
        counts = counts.join(df.groupBy("doc_id").agg(what.alias(name)), "doc_id", "left")
    none = F.array().cast("array<string>")
    return counts.select(F.col("doc_id").alias("source_file"), "total_pages", F.coalesce("total_batches", F.lit(0)).alias("total_batches"), F.coalesce("total_tables", F.lit(0)).alias("total_tables"), F.coalesce("failed_page_ranges", none).alias("failed_page_ranges"))


def write_manifest(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_holdings_csv(holdings: DataFrame, path: str) -> None:
    """The canonical columns under their titles. Write each version to a path of its own."""
    titled = holdings.select(*(F.col(name).alias(title) for title, name, _ in FIELDS))
    titled.write.mode("overwrite").option("header", True).csv(path)


def issue_lines(issues: DataFrame) -> DataFrame:
    """The report's lines with their order: each category's title and count, then its issues. Issues are found once and
    stored, for they are counted, sampled for their order, and told."""
    from ..operators.validate import CATEGORIES

    issues = stored(issues.select("category", "message"), "told-issues")
    order = F.array_position(F.array(*map(F.lit, CATEGORIES)), F.col("category"))
    titles = issues.groupBy("category").agg(F.count("*").alias("n"))
    title = F.concat(F.upper(F.replace("category", F.lit("_"), F.lit(" "))), F.lit(" ("), F.col("n").cast("string"), F.lit(")"))
    rows = titles.select(order.alias("section"), F.lit(0).alias("kind"), title.alias("line"))
    rows = rows.unionByName(issues.select(order.alias("section"), F.lit(1).alias("kind"), F.concat(F.lit("- "), F.col("message")).alias("line")))
    return rows.orderBy("section", "kind", "line")


def verdict_lines(verdicts: DataFrame) -> DataFrame:
    """The ledger's lines: each issue with its verdict and reason, by iteration and category."""
    line = F.concat_ws(" ", F.concat(F.lit("["), F.col("verdict"), F.lit("]")), F.col("message"), F.concat(F.lit("— "), F.col("reason")))
    return verdicts.select("iteration", "category", line.alias("line")).orderBy("iteration", "category", "line")


def write_text(lines: DataFrame, path: str) -> None:
    """Ordered lines as text files whose names keep the order."""
    lines.select("line").write.mode("overwrite").text(path)


def append_ledger(verdicts: DataFrame, path: str) -> None:
    verdicts.write.mode("append").partitionBy("iteration").parquet(path)


def write_table(holdings: DataFrame, name: str = "brokerage_statement") -> None:
    """Replace the table of this name in the session's catalog."""
    holdings.write.mode("overwrite").saveAsTable(name)


def write_database(holdings: DataFrame, url: str, name: str, properties: dict[str, str]) -> None:
    """Replace a database's table, through a JDBC driver that the session has."""
    holdings.write.jdbc(url, name, mode="overwrite", properties=properties)


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:name)", {"name": name})
