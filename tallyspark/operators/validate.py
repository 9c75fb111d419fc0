"""Rules over holdings, and the reconciliation of tables with their own totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import UNKNOWN_ACCOUNT

CATEGORIES = ("negative_values", "abnormal_quantities", "missing_symbol", "missing_account", "missing_data", "total_mismatches", "extraction_failures")
TITLES = {"quantity": "Quantity", "cost_basis": "Cost Basis", "market_value": "Market Value", "unrealized_gl": "Unrealized Gain/Loss", "est_annual_income": "Est. Annual Income"}
CHECKED = ("quantity", "cost_basis", "market_value")
LARGE_QUANTITY = 1_000_000
#: Percent by which a table's holdings may differ from its total.
TOLERANCE = 0.01


def _issue(category: str, field: str | None, message: Column, when: Column) -> Column:
    return F.when(when, F.struct(F.lit(category).alias("category"), F.lit(field).cast("string").alias("field"), message.alias("message")))


def record_issues(holdings: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """holding_id, name, category, field, message: each broken rule of each holding, with its columns ``keep``."""
    name = F.coalesce("name", F.lit("Unknown"))
    missing = lambda c: F.col(c).isNull() | (F.col(c) == "")
    text = lambda *parts: F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))
    rules = [
        *(_issue("negative_values", c, text(f"Negative {TITLES[c]} = ", F.col(c).cast("string"), " for ", name), F.col(c) < 0) for c in CHECKED),
        _issue("abnormal_quantities", "quantity", text("Abnormally large quantity = ", F.format_number(F.col("quantity").cast("double"), 0), " for ", name), F.col("quantity") > LARGE_QUANTITY),
        _issue("missing_symbol", "symbol", text("Missing Symbol/CUSIP for ", name), missing("symbol")),
        _issue("missing_account", "account", text("Missing or Unknown Account for ", name), missing("account") | (F.col("account") == UNKNOWN_ACCOUNT)),
        *(_issue("missing_data", c, text(f"Missing {TITLES[c]} for ", name), F.col(c).isNull()) for c in CHECKED),
    ]
    broken = F.filter(F.array(*rules), lambda i: i.isNotNull())
    return holdings.select("holding_id", "name", *keep, F.explode(broken).alias("i")).select("holding_id", "name", "i.category", "i.field", "i.message", *keep)


def reconcile(holdings: DataFrame, totals: DataFrame, keys: list[str], tolerance: float = TOLERANCE) -> DataFrame:
    """keys, field, expected, calculated, off_pct where sums of holdings differ from the stated totals
    by more than ``tolerance`` percent. Fields without a total, or with 0, aren't checked; a table
    without holdings sums to 0."""
    sums = holdings.groupBy(*keys).agg(*(F.sum(c).alias(f"sum_{c}") for c in TITLES))
    both = totals.join(sums, keys, "left")
    fields = [F.struct(F.lit(c).alias("field"), F.col(c).cast("decimal(30,6)").alias("expected"), F.coalesce(F.col(f"sum_{c}"), F.lit(0)).cast("decimal(30,6)").alias("calculated")) for c in TITLES]
    rows = both.select(*keys, F.explode(F.array(*fields)).alias("f")).select(*keys, "f.field", "f.expected", "f.calculated").where("expected <> 0")
    off = F.abs(F.col("calculated") - F.col("expected")).cast("double") / F.abs("expected").cast("double") * 100
    return rows.withColumn("off_pct", off).where(F.col("off_pct") > tolerance)


def mismatch_issues(found: DataFrame) -> DataFrame:
    """reconcile()'s rows by table as issues."""
    title = F.element_at(F.create_map(*(F.lit(x) for pair in TITLES.items() for x in pair)), F.col("field"))
    money = lambda c: F.concat(F.lit("$"), F.format_number(F.col(c).cast("double"), 2))
    message = F.concat(F.lit("Table "), (F.col("table_idx") + 1).cast("string"), F.lit(": "), title, F.lit(" sum/total mismatch — Expected: "), money("expected"), F.lit(", Calculated: "), money("calculated"))
    return found.select(F.lit(None).cast("string").alias("holding_id"), F.lit(None).cast("string").alias("name"), F.lit("total_mismatches").alias("category"), "field", message.alias("message"), "doc_id", "table_idx", "expected", "calculated")


def extraction_failures(failed: DataFrame) -> DataFrame:
    """Failed page ranges (doc_id, page_range) as issues."""
    null = lambda kind="string": F.lit(None).cast(kind)
    message = F.concat(F.lit("Pages "), F.col("page_range"), F.lit(" could not be extracted"))
    return failed.select(null().alias("holding_id"), null().alias("name"), F.lit("extraction_failures").alias("category"), null().alias("field"), message.alias("message"), "doc_id")


def find_issues(holdings: DataFrame, totals: DataFrame, tolerance: float = TOLERANCE, failed: DataFrame | None = None, members: DataFrame | None = None) -> DataFrame:
    """All issues of holdings with doc_id and table_idx: records, totals, failed pages.

    ``members`` (doc_id, table_idx, holding_id) says which holdings count for a table; without it each counts for its own.
    """
    keys = ["doc_id", "table_idx"]
    counted = holdings if members is None else members.select(*keys, "holding_id").join(holdings.drop(*keys), "holding_id")
    issues = record_issues(holdings, tuple(keys)).unionByName(mismatch_issues(reconcile(counted, totals, keys, tolerance)), allowMissingColumns=True)
    if failed is not None:
        issues = issues.unionByName(extraction_failures(failed), allowMissingColumns=True)
    return _with_ids(issues)


def _with_ids(issues: DataFrame) -> DataFrame:
    return issues.withColumn("issue_id", F.sha2(F.concat_ws("\x1f", "doc_id", "table_idx", "holding_id", "category", "field"), 256))


def revalidated(issues: DataFrame, holdings: DataFrame, totals: DataFrame, touched: DataFrame, tolerance: float = TOLERANCE, members: DataFrame | None = None) -> DataFrame:
    """``issues`` after a change of the ``touched`` holdings (doc_id, table_idx, holding_id): those of touched holdings and tables
    are found anew, the others are kept. The result is that of find_issues over everything.
    """
    ids = touched.select("holding_id").distinct()
    own = holdings.select("doc_id", "table_idx", "holding_id") if members is None else members.select("doc_id", "table_idx", "holding_id")
    tables = own.join(ids, "holding_id", "left_semi").select("doc_id", "table_idx").distinct()
    keys = ["doc_id", "table_idx"]
    of_holdings, of_tables = issues.where("holding_id is not null"), issues.where("holding_id is null")
    mismatch = F.col("category") == "total_mismatches"
    kept = of_holdings.join(ids, "holding_id", "left_anti").unionByName(of_tables.where(mismatch).join(tables, keys, "left_anti")).unionByName(of_tables.where(~mismatch))

    records = record_issues(holdings.join(ids, "holding_id", "left_semi"), ("doc_id", "table_idx"))
    counted = holdings.join(tables, keys, "left_semi") if members is None else members.join(tables, keys, "left_semi").select(*keys, "holding_id").join(holdings.drop(*keys), "holding_id")
    sums = mismatch_issues(reconcile(counted, totals.join(tables, keys, "left_semi"), keys, tolerance))
    found = records.unionByName(sums, allowMissingColumns=True)
    return kept.select(issues.columns).unionByName(_with_ids(found), allowMissingColumns=True)


def issue_counts(issues: DataFrame) -> DataFrame:
    """A row with the count of each category, 0 included."""
    unknown = F.when(~F.col("category").isin(*CATEGORIES), F.raise_error(F.concat(F.lit("unknown category "), F.col("category"))))
    counts = [F.count(F.when(F.col("category") == c, 1)).alias(c) for c in CATEGORIES]
    return issues.where(unknown.isNull()).agg(*counts)
