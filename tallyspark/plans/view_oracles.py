"""DuckDB SQL of the portfolio views over the driver's tables."""

from __future__ import annotations

from ..schema import holdings_oracle

_CLEAN = "clean AS (SELECT * REPLACE (NULLIF(cost_basis, 999999.99) AS cost_basis, NULLIF(unrealized_gl, 999999.99) AS unrealized_gl), unrealized_gl IS NOT NULL AS stated FROM holdings)"


def _money(expr: str) -> str:
    return f"CAST(ROUND({expr}, 2) AS DOUBLE)"


def _ratio(top: str, bottom: str, digits: int, scale: str = "100.0") -> str:
    return f"ROUND({scale}::DOUBLE * CAST({top} AS DOUBLE) / NULLIF(CAST({bottom} AS DOUBLE), 0), {digits})"


_COSTED = f"""costed AS (SELECT *, CAST(market_value - cost_basis AS DOUBLE) / CAST(cost_basis AS DOUBLE) AS ratio,
    {_ratio("market_value - cost_basis", "cost_basis", 2)} AS return_pct
  FROM holdings WHERE cost_basis IS NOT NULL AND cost_basis <> 999999.99 AND cost_basis <> 0 AND quantity > 0)"""
_AMOUNTS = ", ".join(f"{_money(c)} AS {c}" for c in ("cost_basis", "market_value", "unrealized_gl"))

_VIEWS = {
    "v_asset_class_allocation": f"""WITH {_CLEAN} SELECT asset_class, COUNT(*) AS holding_count, {_money("SUM(market_value)")} AS total_market_value,
        {_ratio("SUM(market_value)", "SUM(SUM(market_value)) OVER ()", 2)} AS pct_of_portfolio,
        {_money("SUM(cost_basis)")} AS total_cost_basis, {_money("SUM(unrealized_gl)")} AS total_unrealized_gl FROM clean GROUP BY asset_class""",
    "v_account_summary": f"""WITH {_CLEAN} SELECT COALESCE(account, '— TOTAL PORTFOLIO —') AS account, COALESCE(account_type, '') AS account_type,
        COUNT(*) AS holding_count, {_money("SUM(cost_basis)")} AS total_cost_basis, {_money("SUM(market_value)")} AS total_market_value,
        {_money("SUM(unrealized_gl)")} AS total_unrealized_gl, {_ratio("SUM(unrealized_gl)", "SUM(cost_basis)", 2)} AS return_on_cost_pct
        FROM clean GROUP BY ROLLUP(account, account_type) HAVING NOT (account IS NOT NULL AND account_type IS NULL)""",
    "v_income_generating_holdings": f"""SELECT symbol, name, asset_class, account_type, account, {_money("market_value")} AS market_value,
        {_money("est_annual_income")} AS est_annual_income, CAST(ROUND(est_yield, 4) AS DOUBLE) AS est_yield_pct,
        CAST(RANK() OVER (ORDER BY est_annual_income DESC) AS INTEGER) AS income_rank,
        {_ratio("est_annual_income", "SUM(est_annual_income) OVER ()", 2)} AS pct_of_total_income FROM holdings WHERE est_annual_income > 0""",
    "v_cost_basis_quality": """SELECT symbol, name, asset_class, account, CAST(cost_basis AS DOUBLE) AS raw_cost_basis,
        CASE WHEN cost_basis IS NULL THEN 'Missing' WHEN cost_basis = 999999.99 THEN 'Sentinel' ELSE 'Known' END AS cost_basis_status,
        CAST(market_value AS DOUBLE) AS market_value FROM holdings""",
    "v_return_on_cost_by_holding": f"""WITH {_COSTED} SELECT symbol, name, asset_class, account_type, account, CAST(ROUND(quantity, 4) AS DOUBLE) AS quantity, {_AMOUNTS}, return_pct,
        CAST(RANK() OVER (PARTITION BY asset_class ORDER BY return_pct DESC) AS INTEGER) AS rank_within_class,
        CAST(RANK() OVER (ORDER BY return_pct DESC) AS INTEGER) AS rank_overall FROM costed""",
    "v_gain_loss_by_tax_treatment": f"""WITH {_CLEAN} SELECT account_type, asset_class, COUNT(*) AS holding_count, {_money("SUM(market_value)")} AS total_market_value,
        {_money("SUM(CASE WHEN unrealized_gl > 0 THEN unrealized_gl ELSE 0 END)")} AS total_gains,
        {_money("SUM(CASE WHEN unrealized_gl < 0 THEN unrealized_gl ELSE 0 END)")} AS total_losses, {_money("SUM(unrealized_gl)")} AS net_unrealized_gl,
        {_ratio("SUM(unrealized_gl)", "SUM(cost_basis)", 2)} AS net_return_pct, COUNT(CASE WHEN unrealized_gl > 0 THEN 1 END) AS winning_positions,
        COUNT(CASE WHEN unrealized_gl < 0 THEN 1 END) AS losing_positions
        FROM clean WHERE stated GROUP BY account_type, asset_class""",
    "v_short_positions": f"""WITH {_CLEAN} SELECT symbol, name, asset_class, account_type, account, CAST(ROUND(quantity, 4) AS DOUBLE) AS quantity, {_AMOUNTS},
        {_ratio("unrealized_gl", "ABS(cost_basis)", 2)} AS return_pct,
        CASE WHEN unrealized_gl > 0 THEN 'Gain' WHEN unrealized_gl < 0 THEN 'Loss' ELSE 'Flat' END AS position_status FROM clean WHERE quantity < 0""",
    "v_gain_loss_quartiles": f"""WITH {_COSTED}, tiled AS (SELECT *, CAST(NTILE(4) OVER (ORDER BY ratio, holding_id) AS INTEGER) AS quartile FROM costed)
        SELECT symbol, name, asset_class, account_type, account, {_AMOUNTS}, return_pct, quartile,
        CASE quartile WHEN 1 THEN 'Q1 — Bottom 25% (Worst Performers)' WHEN 2 THEN 'Q2 — Below Median' WHEN 3 THEN 'Q3 — Above Median'
        ELSE 'Q4 — Top 25% (Best Performers)' END AS quartile_label FROM tiled""",
    "v_weighted_avg_yield": f"""SELECT COALESCE(account, '— PORTFOLIO TOTAL —') AS account, COALESCE(account_type, '') AS account_type, COUNT(*) AS yielding_holdings,
        {_money("SUM(market_value)")} AS total_market_value, {_money("SUM(est_annual_income)")} AS total_est_income,
        {_ratio("SUM(market_value * est_yield)", "SUM(market_value)", 4, "1.0")} AS weighted_avg_yield_pct
        FROM holdings WHERE market_value > 0 AND est_yield > 0 GROUP BY GROUPING SETS ((account, account_type), ())""",
    "v_yield_tier_distribution": f"""SELECT CASE WHEN est_yield IS NULL OR est_yield = 0 THEN 'No Yield' WHEN est_yield <= 2 THEN 'Low  (0–2%)'
        WHEN est_yield <= 4 THEN 'Mid  (2–4%)' ELSE 'High (4%+)' END AS yield_tier, COUNT(*) AS holding_count,
        {_money("SUM(market_value)")} AS total_market_value, {_ratio("SUM(market_value)", "SUM(SUM(market_value)) OVER ()", 2)} AS pct_of_portfolio,
        {_money("SUM(est_annual_income)")} AS total_est_income, STRING_AGG(symbol, ', ' ORDER BY market_value DESC, holding_id) AS symbols
        FROM holdings WHERE market_value IS NOT NULL GROUP BY 1""",
    "v_account_income_positioning": f"""WITH sums AS (SELECT account, account_type, COUNT(*) AS total_holdings,
        CAST(SUM(CASE WHEN est_annual_income > 0 THEN 1 ELSE 0 END) AS BIGINT) AS income_bearing_count, {_money("SUM(market_value)")} AS total_market_value,
        {_money("SUM(est_annual_income)")} AS total_est_income, {_ratio("SUM(CASE WHEN est_annual_income > 0 THEN 1 ELSE 0 END)", "COUNT(*)", 1)} AS income_bearing_pct
        FROM holdings WHERE market_value IS NOT NULL GROUP BY account, account_type)
        SELECT *, CASE WHEN income_bearing_pct >= 60 THEN 'Income-Oriented' WHEN income_bearing_pct <= 30 THEN 'Growth-Oriented' ELSE 'Balanced' END AS account_orientation FROM sums""",
    "v_projected_income_by_account": f"""WITH sums AS (SELECT account, account_type, COUNT(*) AS income_holding_count, ROUND(SUM(market_value), 2) AS mv,
        ROUND(SUM(est_annual_income), 2) AS income, {_ratio("SUM(market_value * est_yield)", "SUM(market_value)", 4, "1.0")} AS weighted_avg_yield_pct
        FROM holdings WHERE est_annual_income > 0 GROUP BY account, account_type)
        SELECT account, account_type, income_holding_count, CAST(mv AS DOUBLE) AS total_market_value, CAST(income AS DOUBLE) AS total_est_income,
        weighted_avg_yield_pct, {_ratio("income", "SUM(income) OVER ()", 2)} AS pct_of_total_income FROM sums""",
}


def _over_holdings(sql: str) -> str:
    holdings = f"WITH holdings AS ({holdings_oracle()})"
    return f"{holdings}, {sql[5:]}" if sql.startswith("WITH ") else f"{holdings} {sql}"


ORACLES = {name: _over_holdings(sql) for name, sql in _VIEWS.items()}
