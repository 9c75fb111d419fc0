"""From tables to holdings: header rows, column resolution, accounts, asset classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cells as X
from ..schema import COLUMNS
from ..storage import stored

MARKER = "Beginning Account Value"
AMOUNT_FIELDS = {"quantity": "quantity", "cost_basis": "cost_basis", "market_value": "market_value", "gain_loss": "unrealized_gl", "annual_income": "est_annual_income", "yield": "est_yield"}


# -- headers


def from_header(rows: Column) -> Column:
    """Rows from the header on: the first of the top five whose cells, but for the first filled one,
    are no bare numbers (a lone cell is itself looked at); the very first where there is none."""

    def is_header(row: Column) -> Column:
        filled = F.filter(row, lambda c: c != "")
        looked_at = F.when(F.size(filled) > 1, F.slice(filled, F.lit(2), F.size(filled))).otherwise(filled)
        return F.forall(looked_at, lambda c: ~c.rlike(r"^-?\d+(\.\d+)?$"))

    at = F.array_position(F.transform(F.slice(rows, 1, 5), is_header), True)
    return F.slice(rows, F.greatest(at, F.lit(1)).cast("int"), F.size(rows))


def drop_index_column(rows: Column) -> Column:
    """Without a first column that has no name and only whole numbers."""
    unnamed = F.coalesce(F.try_element_at(F.element_at(rows, 1), F.lit(1)).isin("", "Unnamed: 0"), F.lit(False))
    numbers = F.forall(F.slice(rows, F.lit(2), F.size(rows)), lambda r: F.coalesce(F.try_element_at(r, F.lit(1)).rlike(r"^\d*$"), F.lit(True)))
    return F.when(unnamed & numbers, F.transform(rows, lambda r: F.slice(r, F.lit(2), F.size(r)))).otherwise(rows)


def resolve_column(header: Column, field: str) -> Column:
    """1-based place of the first column that contains the field's best keyword; null where none does."""
    names = F.transform(header, lambda h: F.lower(h))

    def first_with(keyword: str) -> Column:
        return F.nullif(F.array_position(F.transform(names, lambda h: h.contains(keyword)), True), F.lit(0))

    return F.coalesce(*map(first_with, X.COLUMN_KEYWORDS[field])).cast("int")


def _shares_word(a: Column, b: Column, ignored: tuple[str, ...]) -> Column:
    words = lambda t: F.array_except(F.regexp_extract_all(t, F.lit("[a-z]+"), 0), F.array(*map(F.lit, ignored)))
    return F.arrays_overlap(words(a), words(b))


def matching_column(header: Column, field: Column, ignored: tuple[str, ...] = ("the", "a", "an", "of", "est")) -> Column:
    """1-based place of the first named column that contains a free-text field or is contained in it, else of the first
    that shares a telling word; null where none does."""
    sought, names = F.lower(F.trim(field)), F.transform(header, lambda h: F.lower(F.trim(h)))
    first = lambda test: F.nullif(F.array_position(F.transform(names, lambda h: F.coalesce((h != "") & (sought != "") & test(h), F.lit(False))), True), F.lit(0))
    return F.coalesce(first(lambda h: h.contains(sought) | sought.contains(h)), first(lambda h: _shares_word(sought, h, ignored))).cast("int")


# -- tables of a document, one row each: doc_id, table_idx, rows


def prepared(tables: DataFrame) -> DataFrame:
    """doc_id, table_idx, header, data (rows below the header)."""
    # a step each: as one expression the rows from the header on would be made for each of their uses
    rows = tables.withColumn("rows", from_header(F.col("rows"))).withColumn("rows", drop_index_column(F.col("rows")))
    return rows.select("doc_id", "table_idx", F.element_at("rows", 1).alias("header"), F.slice("rows", F.lit(2), F.size("rows")).alias("data"))


def _cell(row: Column, place: Column) -> Column:
    """A cell by 1-based place; null where there is no such place or cell, or it is empty."""
    return F.nullif(F.when(place > 0, F.try_element_at(row, place)), F.lit(""))


def account_list(tables: DataFrame, supplied: DataFrame | None = None) -> DataFrame:
    """doc_id, account_idx, kind, number from tables with an account-number column.

    Kinds and numbers are listed separately and paired by place. Documents whose tables name no kind
    take the ``supplied`` accounts (doc_id, account_idx, kind, number) where given.
    """
    named = tables.where(F.array_contains("header", "Account Number")).select("doc_id", "table_idx", "header", F.posexplode("data").alias("row_idx", "row"))
    at = lambda name: F.array_position("header", name).cast("int")
    kind, number = X.account_label(_cell(F.col("row"), at("Account Type/Name"))), F.trim(_cell(F.col("row"), at("Account Number")))
    told = F.array(*(F.struct(F.lit(what).alias("what"), text.alias("text")) for what, text in (("kind", kind), ("number", number))))
    told = named.select("doc_id", "table_idx", "row_idx", F.explode(told).alias("t")).select("doc_id", "table_idx", "row_idx", "t.*").where("text is not null")
    order = Window.partitionBy("doc_id", "what").orderBy("table_idx", "row_idx")
    placed = told.withColumn("account_idx", F.row_number().over(order) - 1)
    both = placed.groupBy("doc_id", "account_idx").agg(*(F.max(F.when(F.col("what") == c, F.col("text"))).alias(c) for c in ("kind", "number")))
    found = both.where("kind is not null and number is not null")
    if supplied is None:
        return found
    usable = supplied.where("kind <> '' and number <> ''").join(placed.where("what = 'kind'").select("doc_id").distinct(), "doc_id", "left_anti")
    return found.unionByName(usable.select(found.columns))


def account_of_tables(tables: DataFrame, accounts: DataFrame) -> DataFrame:
    """tables with account: that of the last marker table at or before each, "Unknown Account" before
    the first. The n-th marker opens the n-th account; markers beyond the last account open none.

    Markers are counted over the tables' numbers alone, so tables are dealt out once, to meet their account's name."""
    counts = accounts.groupBy("doc_id").agg(F.count("*").alias("__accounts"))
    order = Window.partitionBy("doc_id").orderBy("table_idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    has_marker = F.exists("data", lambda row: F.exists(row, lambda c: c.contains(MARKER)))
    keys = ["doc_id", "table_idx"]
    marked = tables.groupBy(*keys).agg(F.sum(F.when(has_marker, 1).otherwise(0)).alias("__markers")).join(counts, "doc_id", "left")
    nth = F.least(F.sum("__markers").over(order), F.coalesce("__accounts", F.lit(0)))
    named = marked.withColumn("account_idx", nth - 1).where("account_idx >= 0").join(accounts, ["doc_id", "account_idx"])
    named = named.select(*keys, X.account_name(F.col("kind"), F.col("number")).alias("account"))
    return tables.join(named, keys, "left").withColumn("account", F.coalesce("account", F.lit(X.UNKNOWN_ACCOUNT))).select(*tables.columns, "account")


def with_columns_resolved(tables: DataFrame) -> DataFrame:
    """Holdings tables, those with a quantity, a market value and a Description, with the place of each
    field as at_<field>."""
    places = {f"at_{field}": resolve_column(F.col("header"), field) for field in X.COLUMN_KEYWORDS}
    places["at_description"] = F.array_position("header", "Description").cast("int")
    return tables.withColumns(places).where("at_quantity is not null and at_market_value is not null and at_description > 0")


def table_rows(tables: DataFrame) -> DataFrame:
    """A row per data row of holdings tables: description and the six amounts.

    Rows are parsed in their array: as columns, filters and cells would be compiled into methods too long for the JIT."""
    keep = [c for c in ("doc_id", "table_idx", "account") if c in tables.columns]

    def parsed(row: Column, k: Column) -> Column:
        amounts = {name: (X.percentage if field == "yield" else X.currency)(_cell(row, F.col(f"at_{field}"))) for field, name in AMOUNT_FIELDS.items()}
        return F.struct(k.alias("row_idx"), _cell(row, F.col("at_description")).alias("description"), *(v.alias(c) for c, v in amounts.items()))

    return tables.select(*keep, F.inline(F.transform("data", parsed)))


def _named(rows: DataFrame) -> DataFrame:
    """rows with the name and symbol that their descriptions tell; filters by these stay behind it."""
    told = F.transform(F.array("description"), lambda d: F.struct(X.security_name(d).alias("name"), X.symbol(d).alias("symbol")))
    return rows.select("*", F.inline(told)).where("name <> ''")


def carry_forward_class(rows: DataFrame) -> DataFrame:
    """rows (with name, symbol and amounts) without their category headers, and with the asset class of
    the last header above that names one, else of the security's name."""
    header = X.is_category_header(F.col("name"), F.col("symbol"), *(F.col(c) for c in ("quantity", "cost_basis", "market_value")))
    above = Window.partitionBy("doc_id", "table_idx").orderBy("row_idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("__header", header)
    label = F.last(F.when(F.col("__header"), X.class_from_header(F.col("name"))), ignorenulls=True).over(above)
    rows = rows.withColumn("asset_class", F.coalesce(label, X.class_from_name(F.col("name"), F.col("symbol"))))
    return rows.where("not __header").drop("__header")


def extract_holdings(tables: DataFrame, supplied: DataFrame | None = None) -> DataFrame:
    """doc_id, table_idx, row_idx, holding_id and the canonical columns of every holding of raw tables.

    Prepared tables are stored, for they are read for accounts, markers and rows.
    """
    tables = stored(prepared(tables), "prepared-tables")
    accounted = account_of_tables(tables, account_list(tables, supplied))
    rows = table_rows(with_columns_resolved(accounted)).where(F.col("description").isNotNull() & ~X.is_total(F.col("description")))
    holdings = carry_forward_class(_named(rows)).where("coalesce(quantity, cost_basis, market_value) is not null")
    holdings = holdings.withColumns({"account_type": X.account_type(F.col("account")), "holding_id": F.concat_ws("-", "doc_id", "table_idx", "row_idx")})
    return holdings.select("doc_id", "table_idx", "row_idx", "holding_id", *COLUMNS)


def named_rows(tables: DataFrame) -> DataFrame:
    """doc_id, table_idx, row_idx and the security's name of every row of holdings tables that is no total: by these a table
    finds its holdings again."""
    rows = table_rows(with_columns_resolved(prepared(tables))).where(F.col("description").isNotNull() & ~X.is_total(F.col("description")))
    return _named(rows).select("doc_id", "table_idx", "row_idx", "name")


def stated_totals(tables: DataFrame) -> DataFrame:
    """doc_id, table_idx and, per amount, the sum of the tables' own sub-section totals.

    A total directly below another is one of a higher level and not counted; nor are the holdings' or
    the portfolio's totals.
    """
    rows = table_rows(with_columns_resolved(prepared(tables)))
    total = X.is_total(F.col("description")) & ~F.coalesce(F.col("description").rlike("(?i)total holdings|total portfolio"), F.lit(False))
    order = Window.partitionBy("doc_id", "table_idx").orderBy("row_idx")
    rows = rows.withColumn("__total", total)
    rows = rows.withColumn("__above", F.coalesce(F.lag("__total").over(order), F.lit(False)))
    sums = [F.sum(c).alias(c) for c in ("quantity", "cost_basis", "market_value", "unrealized_gl", "est_annual_income")]
    return rows.where("__total and not __above").groupBy("doc_id", "table_idx").agg(*sums)
