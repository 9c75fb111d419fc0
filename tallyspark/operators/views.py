"""The twelve portfolio views, as functions from holdings to DataFrames.

Sums stay decimal, so they don't depend on row order; quotients are computed in double and then rounded.
Every view ends in its presentation order, with the place of nulls spelled out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import SENTINEL
from .ranking import numbered, value_counts, with_ntile, with_ranks


def _known(name: str) -> Column:
    """The amount, null where it is the sentinel."""
    return F.nullif(F.col(name), F.lit(SENTINEL).cast("decimal(20,6)"))


def _ratio(top: Column, bottom: Column, digits: int, scale: float = 100.0) -> Column:
    """round(scale * top / bottom), null where the divisor is null or 0."""
    quotient = F.lit(scale) * top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))
    return F.round(quotient, digits)


def _money(amount: Column) -> Column:
    return F.round(amount, 2).cast("double")


def _position(*names: str) -> list[Column]:
    """Amounts as shown: quantities with four digits, money with two."""
    return [F.round(c, 4 if c == "quantity" else 2).cast("double").alias(c) for c in names]


def clean_holdings(holdings: DataFrame) -> DataFrame:
    return holdings.withColumns({"cost_basis": _known("cost_basis"), "unrealized_gl": _known("unrealized_gl")})


def _overall(name: str) -> Column:
    """The sum over all rows; used on aggregates of a few rows only."""
    return F.sum(name).over(Window.partitionBy())


def _weighted_yield() -> Column:
    return _ratio(F.sum(F.col("market_value") * F.col("est_yield")), F.sum("market_value"), 4, 1.0)


def asset_class_allocation(holdings: DataFrame) -> DataFrame:
    sums = clean_holdings(holdings).groupBy("asset_class").agg(F.count("*").alias("holding_count"), F.sum("market_value").alias("mv"), F.sum("cost_basis").alias("cb"), F.sum("unrealized_gl").alias("gl"))
    share = _ratio(F.col("mv"), _overall("mv"), 2)
    out = sums.select("asset_class", "holding_count", _money(F.col("mv")).alias("total_market_value"), share.alias("pct_of_portfolio"), _money(F.col("cb")).alias("total_cost_basis"), _money(F.col("gl")).alias("total_unrealized_gl"))
    return out.orderBy(F.desc_nulls_first("total_market_value"))


def account_summary(holdings: DataFrame) -> DataFrame:
    """Accounts, then the total, which is there for an empty table too. The total is added up from the
    accounts' rows, so holdings are read once."""
    measures = [F.count("*").alias("holding_count"), F.sum("cost_basis").alias("cb"), F.sum("market_value").alias("mv"), F.sum("unrealized_gl").alias("gl")]
    leaves = clean_holdings(holdings).groupBy("account", "account_type").agg(*measures)
    total = leaves.agg(F.coalesce(F.sum("holding_count"), F.lit(0)).alias("holding_count"), *(F.sum(c).cast(leaves.schema[c].dataType).alias(c) for c in ("cb", "mv", "gl")))
    total = total.select(F.lit(1).alias("gid"), F.lit("— TOTAL PORTFOLIO —").alias("account"), F.lit("").alias("account_type"), "holding_count", "cb", "mv", "gl")
    # a null account or type takes the label the total and blank types have
    leaves = leaves.select(F.lit(0).alias("gid"), F.coalesce("account", F.lit("— TOTAL PORTFOLIO —")).alias("account"), F.coalesce("account_type", F.lit("")).alias("account_type"), "holding_count", "cb", "mv", "gl")
    rows = leaves.unionByName(total).orderBy("gid", F.desc_nulls_first("mv"))
    return rows.select("account", "account_type", "holding_count", _money(F.col("cb")).alias("total_cost_basis"), _money(F.col("mv")).alias("total_market_value"), _money(F.col("gl")).alias("total_unrealized_gl"), _ratio(F.col("gl"), F.col("cb"), 2).alias("return_on_cost_pct"))


def income_generating_holdings(holdings: DataFrame) -> DataFrame:
    paying = holdings.where("est_annual_income > 0")
    counted = value_counts(paying, "est_annual_income")
    total = counted.agg(F.sum(F.col("est_annual_income") * F.col("n")).alias("__income"))
    ranked = with_ranks(paying, "est_annual_income", {"income_rank": ()}, counted).crossJoin(F.broadcast(total))  # one row
    out = ranked.select("symbol", "name", "asset_class", "account_type", "account", _money(F.col("market_value")).alias("market_value"), _money(F.col("est_annual_income")).alias("est_annual_income"), F.round("est_yield", 4).cast("double").alias("est_yield_pct"), "income_rank", _ratio(F.col("est_annual_income"), F.col("__income"), 2).alias("pct_of_total_income"))
    return out.orderBy("income_rank")


def cost_basis_quality(holdings: DataFrame) -> DataFrame:
    status = F.when(F.col("cost_basis").isNull(), "Missing").when(_known("cost_basis").isNull(), "Sentinel").otherwise("Known")
    out = holdings.select("symbol", "name", "asset_class", "account", F.col("cost_basis").cast("double").alias("raw_cost_basis"), status.alias("cost_basis_status"), F.col("market_value").cast("double").alias("market_value"))
    return out.orderBy("cost_basis_status", F.asc_nulls_last("asset_class"), F.desc_nulls_first("market_value"))


def _costed(holdings: DataFrame) -> DataFrame:
    """Long holdings of known cost, with their return, unrounded and in percent."""
    cost, gain = F.col("cost_basis"), F.col("market_value") - F.col("cost_basis")
    rows = holdings.where(_known("cost_basis").isNotNull() & (cost != 0) & (F.col("quantity") > 0))
    return rows.withColumns({"__ratio": gain.cast("double") / cost.cast("double"), "return_pct": _ratio(gain, cost, 2)})


def return_on_cost_by_holding(holdings: DataFrame) -> DataFrame:
    ranked = with_ranks(_costed(holdings), "return_pct", {"rank_overall": (), "rank_within_class": ("asset_class",)})
    amounts = _position("quantity", "cost_basis", "market_value", "unrealized_gl")
    out = ranked.select("symbol", "name", "asset_class", "account_type", "account", *amounts, "return_pct", "rank_within_class", "rank_overall")
    return out.orderBy(F.asc_nulls_last("asset_class"), "rank_within_class")


def gain_loss_by_tax_treatment(holdings: DataFrame) -> DataFrame:
    """A sentinel gain/loss passes the filter as a value and is null afterwards."""
    rows, gl = clean_holdings(holdings.where("unrealized_gl is not null")), F.col("unrealized_gl")
    zero = F.lit(0).cast("decimal(20,6)")
    sums = rows.groupBy("account_type", "asset_class").agg(
        F.count("*").alias("holding_count"),
        F.sum("market_value").alias("mv"),
        F.sum(F.when(gl > 0, gl).otherwise(zero)).alias("gains"),
        F.sum(F.when(gl < 0, gl).otherwise(zero)).alias("losses"),
        F.sum(gl).alias("net"),
        F.sum("cost_basis").alias("cb"),
        F.count(F.when(gl > 0, 1)).alias("winning_positions"),
        F.count(F.when(gl < 0, 1)).alias("losing_positions"),
    )
    out = sums.select("account_type", "asset_class", "holding_count", _money(F.col("mv")).alias("total_market_value"), _money(F.col("gains")).alias("total_gains"), _money(F.col("losses")).alias("total_losses"), _money(F.col("net")).alias("net_unrealized_gl"), _ratio(F.col("net"), F.col("cb"), 2).alias("net_return_pct"), "winning_positions", "losing_positions")
    return out.orderBy(F.asc_nulls_last("account_type"), F.desc_nulls_first("net_unrealized_gl"))


def short_positions(holdings: DataFrame) -> DataFrame:
    rows, gl = clean_holdings(holdings.where("quantity < 0")), F.col("unrealized_gl")
    status = F.when(gl > 0, "Gain").when(gl < 0, "Loss").otherwise("Flat")
    amounts = _position("quantity", "cost_basis", "market_value", "unrealized_gl")
    out = rows.select("symbol", "name", "asset_class", "account_type", "account", *amounts, _ratio(gl, F.abs("cost_basis"), 2).alias("return_pct"), status.alias("position_status"))
    return out.orderBy(F.desc_nulls_first("unrealized_gl"))


def gain_loss_quartiles(holdings: DataFrame, tiebreak: str = "holding_id") -> DataFrame:
    rows = with_ntile(_costed(holdings), 4, "__ratio", tiebreak, "quartile")
    # fixed values
    names = {1: "Q1 — Bottom 25% (Worst Performers)", 2: "Q2 — Below Median", 3: "Q3 — Above Median", 4: "Q4 — Top 25% (Best Performers)"}
    label = F.lit(None).cast("string")
    for n, name in names.items():
        label = F.when(F.col("quartile") == n, name).otherwise(label)
    amounts = _position("cost_basis", "market_value", "unrealized_gl")
    out = rows.select("symbol", "name", "asset_class", "account_type", "account", *amounts, "return_pct", "quartile", label.alias("quartile_label"))
    return out.orderBy("quartile", F.desc_nulls_first("return_pct"))


def weighted_avg_yield(holdings: DataFrame) -> DataFrame:
    """Accounts, then the total, which is there for an empty table too."""
    rows = holdings.where("market_value > 0 and est_yield > 0")
    weighted = F.col("market_value") * F.col("est_yield")
    leaves = rows.groupBy("account", "account_type").agg(F.count("*").alias("n"), F.sum("market_value").alias("mv"), F.sum("est_annual_income").alias("income"), F.sum(weighted).alias("weighted"))
    total = leaves.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *(F.sum(c).cast(leaves.schema[c].dataType).alias(c) for c in ("mv", "income", "weighted")))
    total = total.select(F.lit(1).alias("gid"), F.lit("— PORTFOLIO TOTAL —").alias("account"), F.lit("").alias("account_type"), "n", "mv", "income", "weighted")
    leaves = leaves.select(F.lit(0).alias("gid"), F.coalesce("account", F.lit("— PORTFOLIO TOTAL —")).alias("account"), F.coalesce("account_type", F.lit("")).alias("account_type"), "n", "mv", "income", "weighted")
    out = leaves.unionByName(total).orderBy("gid", F.desc_nulls_first("mv"))
    return out.select("account", "account_type", F.col("n").alias("yielding_holdings"), _money(F.col("mv")).alias("total_market_value"), _money(F.col("income")).alias("total_est_income"), _ratio(F.col("weighted"), F.col("mv"), 4, 1.0).alias("weighted_avg_yield_pct"))


def _tiers() -> tuple[Column, Column]:
    """A holding's tier and, by ``tier``, its name."""
    y = F.col("est_yield")
    tier = F.when(y.isNull() | (y == 0), 1).when(y <= 2, 2).when(y <= 4, 3).otherwise(4)
    # fixed values
    names = {1: "No Yield", 2: "Low  (0–2%)", 3: "Mid  (2–4%)", 4: "High (4%+)"}
    label = F.lit(None).cast("string")
    for n, name in names.items():
        label = F.when(F.col("tier") == n, name).otherwise(label)
    return tier, label


def yield_tier_distribution(holdings: DataFrame, tiebreak: str | None = None, symbols: bool = True) -> DataFrame:
    """``symbols`` lists all symbols of a tier, by value, in one string: a report for small portfolios. The list is put together
    from pieces, so no task sorts a tier. Without it the view aggregates any number of holdings; ``yield_tier_symbols`` then has the
    lists in pieces."""
    rows = holdings.where("market_value is not null")
    tier, label = _tiers()
    rows = rows.withColumn("tier", tier)
    count, listed = F.count("*"), []
    if symbols:
        amounts = [F.sum(c).alias(c) for c in ("__mv", "est_annual_income")]
        columns = ["tier", F.col("market_value").alias("__mv"), "est_annual_income", "symbol", "market_value", *([tiebreak] if tiebreak else [])]
        rows = _symbol_pieces(rows.select(*columns), ("market_value", *([tiebreak] if tiebreak else [])), 1000, *amounts).withColumnRenamed("__mv", "market_value")
        count, listed = F.sum("holding_count"), [F.expr("listagg(symbols, ', ') WITHIN GROUP (ORDER BY piece)").alias("symbols")]
    sums = rows.groupBy("tier").agg(count.alias("holding_count"), F.sum("market_value").cast("decimal(30,6)").alias("mv"), F.sum("est_annual_income").cast("decimal(30,6)").alias("income"), *listed)
    share = _ratio(F.col("mv"), _overall("mv"), 2)
    out = sums.orderBy("tier").select(label.alias("yield_tier"), "holding_count", _money(F.col("mv")).alias("total_market_value"), share.alias("pct_of_portfolio"), _money(F.col("income")).alias("total_est_income"), *(["symbols"] if symbols else []), "tier")
    return out.orderBy("tier").drop("tier")


def _symbol_pieces(rows: DataFrame, by: tuple[str, ...], size: int, *more: Column) -> DataFrame:
    """tier, piece, holding_count, symbols and aggregates ``more``: the symbols of a tier by falling value, ``size`` holdings a piece."""
    placed = numbered(rows, ("tier",), by, "__place", True)
    listed = F.expr("listagg(symbol, ', ') WITHIN GROUP (ORDER BY __place)")
    return placed.groupBy("tier", F.floor(F.col("__place") / size).alias("piece")).agg(F.count("*").alias("holding_count"), listed.alias("symbols"), *more)


def yield_tier_symbols(holdings: DataFrame, tiebreak: str = "holding_id", size: int = 1000) -> DataFrame:
    """yield_tier, piece, holding_count, symbols: the symbols of a tier by value, ``size`` holdings a piece, so no task
    gathers a whole tier; a writer that joins the pieces in order has the tier's list. Without a symbol a holding counts, but
    isn't listed; a piece without any symbol has null."""
    tier, label = _tiers()
    rows = holdings.where("market_value is not null").withColumn("tier", tier)
    out = _symbol_pieces(rows.select("tier", "market_value", tiebreak, "symbol"), ("market_value", tiebreak), size).orderBy("tier", "piece")
    return out.select(label.alias("yield_tier"), "piece", "holding_count", "symbols")


def account_income_positioning(holdings: DataFrame) -> DataFrame:
    paying = F.when(F.col("est_annual_income") > 0, 1).otherwise(0)
    sums = holdings.where("market_value is not null").groupBy("account", "account_type").agg(F.count("*").alias("total_holdings"), F.sum(paying).alias("income_bearing_count"), F.sum("market_value").alias("mv"), F.sum("est_annual_income").alias("income"))
    sums = sums.withColumn("income_bearing_pct", _ratio(F.col("income_bearing_count"), F.col("total_holdings"), 1))
    orientation = F.when(F.col("income_bearing_pct") >= 60, "Income-Oriented").when(F.col("income_bearing_pct") <= 30, "Growth-Oriented").otherwise("Balanced")
    out = sums.select("account", "account_type", "total_holdings", "income_bearing_count", "income_bearing_pct", _money(F.col("mv")).alias("total_market_value"), _money(F.col("income")).alias("total_est_income"), orientation.alias("account_orientation"))
    return out.orderBy(F.desc_nulls_first("total_market_value"))


def projected_income_by_account(holdings: DataFrame) -> DataFrame:
    """Shares are taken of incomes that are rounded already."""
    rows = holdings.where("est_annual_income > 0")
    sums = rows.groupBy("account_type", "account").agg(F.count("*").alias("income_holding_count"), F.round(F.sum("market_value"), 2).alias("mv"), F.round(F.sum("est_annual_income"), 2).alias("income"), _weighted_yield().alias("weighted_avg_yield_pct"))
    share = _ratio(F.col("income"), _overall("income"), 2)
    out = sums.select("account", "account_type", "income_holding_count", F.col("mv").cast("double").alias("total_market_value"), F.col("income").cast("double").alias("total_est_income"), "weighted_avg_yield_pct", share.alias("pct_of_total_income"))
    return out.orderBy(F.desc_nulls_first("total_est_income"))


#: In the order in which the views are created.
VIEWS = {
    "v_asset_class_allocation": asset_class_allocation,
    "v_account_summary": account_summary,
    "v_income_generating_holdings": income_generating_holdings,
    "v_cost_basis_quality": cost_basis_quality,
    "v_return_on_cost_by_holding": return_on_cost_by_holding,
    "v_gain_loss_by_tax_treatment": gain_loss_by_tax_treatment,
    "v_short_positions": short_positions,
    "v_gain_loss_quartiles": gain_loss_quartiles,
    "v_weighted_avg_yield": weighted_avg_yield,
    "v_yield_tier_distribution": yield_tier_distribution,
    "v_account_income_positioning": account_income_positioning,
    "v_projected_income_by_account": projected_income_by_account,
}


def create_views(holdings: DataFrame) -> list[str]:
    """Register holdings as brokerage_statement and every view over it; returns the views' names."""
    holdings.createOrReplaceTempView("brokerage_statement")
    for name, view in VIEWS.items():
        view(holdings).createOrReplaceTempView(name)
    return list(VIEWS)
