"""Cell cleaning and classification, as built-in Column expressions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import AMOUNT

# -- fixed values: keyword tables, in order of priority

COLUMN_KEYWORDS = {
    "market_value": ["ending market value", "ending market", "ending value", "market value", "market val"],
    "cost_basis": ["total cost basis", "cost basis", "total cost"],
    "quantity": ["quantity"],
    "gain_loss": ["unrealized gain/loss", "unrealized gain / loss", "gain/loss", "gain / loss", "unrealized gain"],
    "annual_income": ["est. annual income", "est. annual inc", "annual income", "annual inc", "eai"],
    "yield": ["est. yield", "current yield", "coupon rate", "yield"],
}
TAX_DEFERRED = ["traditional ira", "sep ira", "simple ira", "401(k)", "403(b)", "457"]
TAX_EXEMPT = ["roth ira", "roth 401", "roth 403", "529", "education", "hsa"]
TAXABLE = ["individual", "joint", "tod", "tenants", "trust", "custodial", "brokerage"]
HEADER_CLASSES = [
    ("corporate bond", "Fixed Income"),
    ("municipal bond", "Fixed Income"),
    ("government", "Fixed Income"),
    ("agency", "Fixed Income"),
    ("asset backed", "Fixed Income"),
    ("treasury", "Fixed Income"),
    ("fixed income", "Fixed Income"),
    ("bond fund", "Funds"),
    ("mutual fund", "Funds"),
    ("etf", "Funds"),
    ("fund", "Funds"),
    ("bond", "Fixed Income"),
    ("cash", "Cash & Equivalents"),
    ("money market", "Cash & Equivalents"),
    ("sweep", "Cash & Equivalents"),
    ("deposit", "Cash & Equivalents"),
    ("common stock", "Equities"),
    ("preferred stock", "Equities"),
    ("equities", "Equities"),
    ("equity", "Equities"),
    ("stock", "Equities"),
]
NAME_CLASSES = [
    ("money market", "Cash & Equivalents"),
    ("cash", "Cash & Equivalents"),
    ("sweep", "Cash & Equivalents"),
    ("deposit", "Cash & Equivalents"),
    ("etf", "Funds"),
    ("fund", "Funds"),
    ("trust", "Funds"),
    ("bond", "Fixed Income"),
    ("note", "Fixed Income"),
    ("treasury", "Fixed Income"),
    ("muni", "Fixed Income"),
    ("fixed", "Fixed Income"),
    ("income", "Fixed Income"),
]
CATEGORY_HEADERS = ["common stock", "bond funds", "preferred stock", "corporate bonds", "municipal bonds", "asset backed", "government", "cash", "money market", "etf", "fund", "equity", "equities", "fixed income", "treasury"]
UNKNOWN_ACCOUNT = "Unknown Account"

# -- ordered choice


def contains_any(text: Column, fragments: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, (text.contains(f) for f in fragments))


def first_label(text: Column, labels: list[tuple[str, str]]) -> Column:
    """The label of the first fragment, in the list's order, that text contains; else null."""
    return reduce(lambda chain, pair: F.when(text.contains(pair[0]), pair[1]).otherwise(chain), reversed(labels), F.lit(None).cast("string"))


# -- numbers


def currency(raw: Column) -> Column:
    """A money or quantity cell as decimal: parentheses are a minus sign, currency marks and footnote
    letters go, and what is then no number is null."""
    text = F.regexp_replace(F.trim(raw), r"^\((.*)\)$", "-$1")
    text = F.trim(F.translate(text, "$,cBt*", ""))
    return text.try_cast(AMOUNT)


def percentage(raw: Column) -> Column:
    """A percentage cell by its magnitude: 4.68% is 4.68."""
    return F.trim(F.replace(F.trim(raw), F.lit("%"), F.lit(""))).try_cast(AMOUNT)


# -- securities

# fixed values: where a description names its symbol, in order of priority
SYMBOL_PATTERNS = [r"\(([^)]+)\)", r"(?i)ISIN:\s*([A-Z0-9]{12})", r"(?i)CUSIP:\s*([A-Z0-9]{9})", r"(?i)Symbol:\s*([A-Z0-9](?:[A-Z0-9.\-:]{0,7}[A-Z0-9])?)"]


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def symbol(description: Column) -> Column:
    return F.coalesce(*(F.trim(_found(description, p)) for p in SYMBOL_PATTERNS))


def security_name(description: Column) -> Column:
    """What stands before the pattern that gave the symbol, or the whole description."""
    out = F.trim(description)
    for p in reversed(SYMBOL_PATTERNS):
        before = F.trim(F.substring(description, F.lit(1), F.regexp_instr(description, F.lit(p)) - 1))
        out = F.when(_found(description, p).isNotNull(), before).otherwise(out)
    return out


def class_from_header(text: Column) -> Column:
    return first_label(F.lower(text), HEADER_CLASSES)


def class_from_name(name: Column, symbol_: Column) -> Column:
    return F.coalesce(first_label(F.lower(F.concat_ws(" ", name, symbol_)), NAME_CLASSES), F.lit("Equities"))


# -- accounts


def account_type(account: Column) -> Column:
    text = F.lower(account)
    kinds = F.when(contains_any(text, TAX_DEFERRED), "Tax-Deferred").when(contains_any(text, TAX_EXEMPT), "Tax-Exempt").when(contains_any(text, TAXABLE), "Taxable")
    return kinds.otherwise("Unknown")


def account_label(type_and_name: Column) -> Column:
    """The account's kind out of "holder - kind": behind the first dash; null where there is none or
    where the row is a portfolio's."""
    parts = F.split(type_and_name, "-")
    label = F.trim(F.array_join(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), "-"))
    return F.when((F.size(parts) > 1) & ~((F.size(parts) == 2) & type_and_name.contains("Portfolio")), label)


def account_name(kind: Column, number: Column) -> Column:
    return F.coalesce(F.concat(kind, F.lit(" "), number), F.lit(UNKNOWN_ACCOUNT))


# -- texts


def normalized(text: Column) -> Column:
    """Lower case, single spaces, dash runs as one dash."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(text)), r"\s+", " "), r"[-–—]+", "-")


def is_total(description: Column) -> Column:
    return F.coalesce(description.rlike(r"(?i)^\s*total"), F.lit(False))


def is_category_header(name: Column, symbol_: Column, *amounts: Column) -> Column:
    empty = reduce(lambda a, b: a & b, (a.isNull() for a in amounts), symbol_.isNull())
    return empty & F.coalesce(contains_any(F.lower(name), CATEGORY_HEADERS), F.lit(False))


def looks_like_date(text: Column) -> Column:
    """12/17/13, 12-17-2013, 03 Feb 2021 or Feb 3, 2021."""
    month = "(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*"
    return text.rlike(rf"(?i)^(?:\d{{1,2}}[/-]\d{{1,2}}[/-]\d{{2,4}}|\d{{1,2}}\s+{month}\.?\s+\d{{2,4}}|{month}\.?\s+\d{{1,2}},?\s+\d{{2,4}})$")


def unfenced(text: Column) -> Column:
    """Model output without code fences."""
    return F.regexp_replace(F.regexp_replace(text, r"^\s*(?:```(?:json)?\s*)?", ""), r"\s*(?:```\s*)?$", "")
