"""The canonical holdings table: names, types, and its derivation from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

AMOUNT = T.DecimalType(20, 6)

#: An in-band amount that stands for "unknown" in cost basis and gain/loss.
SENTINEL = "999999.99"

#: Name in statements' CSV files, name of the column here, type.
FIELDS = [
    ("Symbol/CUSIP", "symbol", T.StringType()),
    ("Name", "name", T.StringType()),
    ("Asset Class", "asset_class", T.StringType()),
    ("Quantity", "quantity", AMOUNT),
    ("Cost Basis", "cost_basis", AMOUNT),
    ("Market Value", "market_value", AMOUNT),
    ("Unrealized Gain/Loss", "unrealized_gl", AMOUNT),
    ("Est. Annual Income", "est_annual_income", AMOUNT),
    ("Est. Yield", "est_yield", AMOUNT),
    ("Account Type", "account_type", T.StringType()),
    ("Account", "account", T.StringType()),
]
COLUMNS = [name for _, name, _ in FIELDS]
HOLDINGS = T.StructType([T.StructField(name, kind) for _, name, kind in FIELDS])
CSV_HOLDINGS = T.StructType([T.StructField(title, kind) for title, _, kind in FIELDS])

#: The holdings of the driver's star schema. Spark and DuckDB run this same text; amounts are cast to
#: decimal before any arithmetic, so both get equal values. holding_id is unique.
HOLDINGS_SQL = """
WITH line AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
         CAST(l_quantity AS DECIMAL(12,2)) AS qty, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
         CAST(l_discount AS DECIMAL(4,2)) AS disc, CAST(l_tax AS DECIMAL(4,2)) AS tax,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN -1 ELSE 1 END AS sign,
         p_name, p_brand, p_type, c_mktsegment
  FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
       JOIN {customer} ON o_custkey = c_custkey JOIN {part} ON l_partkey = p_partkey
), priced AS (
  SELECT *, CAST(sign * price AS DECIMAL(20,6)) AS mv,
         CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 5 THEN CAST(999999.99 AS DECIMAL(20,6))
              ELSE CAST(sign * price * (1 - disc) AS DECIMAL(20,6)) END AS cb
  FROM line
)
SELECT concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS holding_id,
       CASE WHEN l_linenumber = 6 THEN NULL ELSE concat('P', l_partkey) END AS symbol,
       concat(p_name, ' ', p_brand) AS name,
       CASE WHEN p_type IN ('STANDARD', 'ECONOMY') THEN 'Equities' WHEN p_type IN ('MEDIUM', 'LARGE') THEN 'Fixed Income'
            WHEN p_type = 'PROMO' THEN 'Funds' ELSE 'Cash & Equivalents' END AS asset_class,
       CAST(sign * qty AS DECIMAL(20,6)) AS quantity,
       cb AS cost_basis,
       mv AS market_value,
       CASE WHEN cb IS NULL THEN NULL WHEN cb = 999999.99 THEN cb ELSE CAST(mv - cb AS DECIMAL(20,6)) END AS unrealized_gl,
       CASE WHEN tax = 0 THEN NULL ELSE CAST(price * tax AS DECIMAL(20,6)) END AS est_annual_income,
       CASE WHEN tax = 0 THEN NULL ELSE CAST(tax * 100 AS DECIMAL(20,6)) END AS est_yield,
       CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'Taxable' WHEN c_mktsegment = 'FURNITURE' THEN 'Tax-Deferred'
            WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Tax-Exempt' ELSE 'Unknown' END AS account_type,
       c_mktsegment AS account
FROM priced
"""
#: The text's joins, and the same ones in an order in which Spark deals out lines once less: orders find their customers before
#: lines find their orders. Spark joins in the order of the text; DuckDB picks its own.
_JOINS = """FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
       JOIN {customer} ON o_custkey = c_custkey JOIN {part} ON l_partkey = p_partkey"""
_DEALT_JOINS = """FROM {lineitem} JOIN ({orders} JOIN {customer} ON o_custkey = c_custkey) ON l_orderkey = o_orderkey
       JOIN {part} ON l_partkey = p_partkey"""
_TABLES = ("lineitem", "orders", "customer", "part")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def testdata_holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """holding_id and the canonical columns, from the driver's tables."""
    assert _JOINS in HOLDINGS_SQL
    return spark.sql(HOLDINGS_SQL.replace(_JOINS, _DEALT_JOINS), **{name: table(spark, sf_dir, name) for name in _TABLES})


def holdings_oracle() -> str:
    """The same as DuckDB SQL."""
    return HOLDINGS_SQL.format(**{name: name for name in _TABLES})
