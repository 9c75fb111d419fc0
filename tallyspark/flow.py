"""The stages of a statement run in order: extract, parse, correct, load.

Stages hand DataFrames on; what each writes under ``config.output`` is a record, or input of a later run,
not the hand-over. A model's answers are written down in ``config.answers``, so neither a task nor a run that is repeated asks again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .config import Config
from .operators import correct, extract, journal, parse, tables, validate, views
from .sources import readers, writers


@dataclass(frozen=True)
class Extracted:
    tables: DataFrame
    failed: DataFrame | None


@dataclass(frozen=True)
class Corrected:
    holdings: DataFrame
    ledger: DataFrame | None
    log: DataFrame | None


def extract_flow(spark: SparkSession, config: Config, reader: extract.PageReader | None = None) -> Extracted:
    """Raw tables, from pages through a reader, or from numbered CSV files that a run has left."""
    if config.pages is None:
        return Extracted(readers.read_numbered_csvs(spark, config.tables, config.table_prefix), None)
    pages = readers.read_pages(spark, config.pages, config.dpi, config.max_image_dimension)
    reader = journal.JournaledReader(reader, config.answers_path, config.attempts, config.retry_delay)
    responses, failed = extract.read_batches(pages, reader, config.batch_size)
    found = tables.drop_repeated_tables(tables.merge_shared_headers(tables.parse_responses(responses)))
    found = tables.renumbered(found).checkpoint()
    writers.write_tables(found, f"{config.output}/tables", config.table_prefix)
    writers.write_manifest(writers.manifest(pages, responses, found, failed), f"{config.output}/manifest")
    return Extracted(found, failed)


def parse_flow(config: Config, extracted: Extracted, accounts: DataFrame | None = None, client: extract.AccountReader | None = None) -> tuple[DataFrame, DataFrame]:
    """Holdings and stated totals; the first issue report is written. Where no ``accounts`` are given, a client that can
    find accounts is asked about the documents whose tables name none."""
    if accounts is None and hasattr(client, "accounts"):
        named = parse.account_list(parse.prepared(extracted.tables)).select("doc_id").distinct()
        asked = extracted.tables.select("doc_id").distinct().join(named, "doc_id", "left_anti")
        client = journal.JournaledClient(client, config.answers_path, config.attempts, config.retry_delay)
        accounts = extract.supplied_accounts(asked, client).checkpoint()
    holdings = parse.extract_holdings(extracted.tables, accounts).checkpoint()
    totals = parse.stated_totals(extracted.tables).checkpoint()
    issues = validate.find_issues(holdings, totals, config.tolerance, extracted.failed)
    writers.write_text(writers.issue_lines(issues), f"{config.output}/issues")
    writers.write_holdings_csv(holdings, f"{config.output}/holdings/parsed")
    return holdings, totals


def correct_flow(config: Config, holdings: DataFrame, totals: DataFrame, client: correct.ModelClient | None, sources: DataFrame | None = None) -> Corrected:
    """Holdings after at most max_correction_iterations rounds; without a client as they are. Given tables' rows (parse.named_rows),
    a table's holdings are looked for by name."""
    if client is None:
        return Corrected(holdings, None, None)
    client = journal.JournaledClient(client, config.answers_path, config.attempts, config.retry_delay)
    fixed, ledger, log = correct.self_correct(holdings, totals, client, config.max_correction_iterations, config.tolerance, sources)
    writers.append_ledger(ledger, f"{config.output}/ledger")
    writers.write_text(writers.verdict_lines(ledger), f"{config.output}/ledger-text")
    writers.write_holdings_csv(fixed, f"{config.output}/holdings/corrected")
    return Corrected(fixed, ledger, log)


def load_flow(config: Config, holdings: DataFrame) -> list[str]:
    """The catalog's table and the views over it."""
    writers.write_table(holdings, config.table_name)
    return views.create_views(holdings.sparkSession.table(config.table_name))


def run(spark: SparkSession, config: Config, reader: extract.PageReader | None = None, client: correct.ModelClient | None = None, accounts: DataFrame | None = None) -> Corrected:
    extracted = extract_flow(spark, config, reader)
    holdings, totals = parse_flow(config, extracted, accounts, client)
    sources = parse.named_rows(extracted.tables) if config.reassign_by_name else None
    corrected = correct_flow(config, holdings, totals, client, sources)
    load_flow(config, corrected.holdings)
    return corrected
