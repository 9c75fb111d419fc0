"""Every query with an oracle against DuckDB, and what the oracle doesn't see: order and empty tables."""

import decimal
import re
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tallyspark import schema
from tallyspark.operators import ranking, views
from tallyspark.plans import queries


def plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    return repr(round(value, 9)) if isinstance(value, float) else str(value)


def in_order(columns, rows):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(plain(row[i]) for i in at) for row in rows)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for path in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_oracle(spark, sf, duck, name):
    df = queries.QUERIES[name](spark, sf)
    want = duck.sql(queries.ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert in_order(df.columns, df.collect()) == in_order(want.columns, want.fetchall())


def test_every_own_query_has_an_oracle():
    assert queries.QUERIES.keys() == queries.ORACLES.keys()


def test_entry(spark):
    assert entry_points.entry(spark).count() == 4
    assert queries.QUERIES.keys() <= entry_points.queries().keys()
    assert entry_points.oracle_sql().keys() <= entry_points.queries().keys()


def empty(spark):
    return spark.createDataFrame([], schema.HOLDINGS).withColumn("holding_id", F.lit("x"))


def test_views_of_no_holdings(spark):
    """Only the two views with totals have a row."""
    for name, view in views.VIEWS.items():
        rows = view(empty(spark)).collect()
        assert len(rows) == (name in ("v_account_summary", "v_weighted_avg_yield")), name
    total = views.weighted_avg_yield(empty(spark)).first()
    assert (total.account, total.yielding_holdings, total.total_market_value) == ("— PORTFOLIO TOTAL —", 0, None)


def test_order_of_views(spark, sf):
    holdings = schema.testdata_holdings(spark, sf)
    rows = views.account_summary(holdings).collect()
    assert rows[-1].account == "— TOTAL PORTFOLIO —"
    values = [r.total_market_value for r in rows[:-1]]
    assert values == sorted(values, reverse=True)
    assert sum(r.holding_count for r in rows[:-1]) == rows[-1].holding_count
    assert [r.yield_tier[:2] for r in views.yield_tier_distribution(holdings).collect()] == ["No", "Lo", "Mi", "Hi"]
    ranks = [r.income_rank for r in views.income_generating_holdings(holdings).collect()]
    assert ranks == sorted(ranks)
    tiles = [(r.quartile, -r.return_pct) for r in views.gain_loss_quartiles(holdings).collect()]
    assert tiles == sorted(tiles)
    assert abs(sum(r.pct_of_portfolio for r in views.asset_class_allocation(holdings).collect()) - 100) < 0.1


def test_created_views_answer_sql(spark, sf):
    names = views.create_views(schema.testdata_holdings(spark, sf))
    assert len(names) == 12
    statuses = spark.sql("SELECT cost_basis_status, count(*) AS n FROM v_cost_basis_quality GROUP BY 1").collect()
    assert {r.cost_basis_status for r in statuses} == {"Known", "Missing", "Sentinel"}


@pytest.mark.parametrize("n", [0, 1, 3, 7, 200])
def test_ranks_and_tiles(spark, n):
    values = [(i, None if i % 11 == 10 else float(i * i % 17)) for i in range(n)]
    df = spark.createDataFrame(values, "id bigint, v double")
    df.createOrReplaceTempView("ranked")
    want = {r.id: (r.a, r.b) for r in spark.sql("SELECT id, rank() OVER (ORDER BY v DESC NULLS LAST) a, ntile(4) OVER (ORDER BY v NULLS LAST, id) b FROM ranked").collect()}
    got = {r.id: (r.a, r.b) for r in ranking.with_ntile(ranking.with_rank(df, "v", "a"), 4, "v", "id", "b").collect()}
    assert got == want
    grouped = df.withColumn("g", F.nullif(F.col("id") % 3, F.lit(2)))
    grouped.createOrReplaceTempView("ranked")
    want = {r.id: r.a for r in spark.sql("SELECT id, rank() OVER (PARTITION BY g ORDER BY v DESC NULLS LAST) a FROM ranked").collect()}
    assert {r.id: r.a for r in ranking.with_rank(grouped, "v", "a", ("g",)).collect()} == want


def test_no_global_sort_of_all_holdings(spark, sf):
    """Every window of ranks and tiles has partition keys."""
    for view in (views.return_on_cost_by_holding, views.gain_loss_quartiles, views.income_generating_holdings):
        plan = view(schema.testdata_holdings(spark, sf))._jdf.queryExecution().optimizedPlan().toString()
        keys = re.findall(r"Window \[.*?\], \[(.*?)\]", plan)
        assert all("__part" in k or "asset_class" in k or "__from" in k for k in keys), keys


def test_a_frequent_value_is_one_row_in_windows(spark):
    """90 % of the rows have one value, a tenth are null; no task of a window reads more than the distinct values."""
    df = spark.range(0, 20_000, numPartitions=4).select("id", F.when(F.col("id") % 10 == 9, F.lit(None)).otherwise(F.when(F.col("id") < 300, F.col("id")).otherwise(7)).cast("double").alias("v"))
    got = ranking.with_rank(df, "v", "a")
    df.createOrReplaceTempView("ranked")
    want = spark.sql("SELECT id, v, CAST(rank() OVER (ORDER BY v DESC NULLS LAST) AS INT) a FROM ranked")
    assert got.select("id", "v", "a").exceptAll(want).isEmpty() and got.count() == 20_000
    before = ranking.with_before(df.groupBy("v").agg(F.count("*").alias("n")), (), ("v",), True)
    assert before.count() == df.select("v").distinct().count()


def test_half_of_all_rows_in_one_value_across_a_border(spark, monkeypatch):
    """Neither counting nor placing gives a task much more than its share of a very frequent value's rows."""
    kept = {}
    plain = ranking.ranged

    def ranged(counts, within, by, descending):
        kept[by] = out = plain(counts, within, by, descending)
        return out

    monkeypatch.setattr(ranking, "ranged", ranged)
    n, before = 20_000, spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(n).selectExpr("id", "CASE WHEN id % 2 = 0 THEN 7.5D WHEN id % 101 = 0 THEN NULL ELSE id * 0.001D END AS v", "'x' AS other")
        got = ranking.with_ntile(df, 4, "v", "id", "b")
        sizes = [r["count"] for r in kept[("id",)].groupBy("__part").count().collect()]
        assert sum(sizes) == n // 2 and len(sizes) == 4 and max(sizes) < 1.5 * n / 2 / 4
        assert sum(r["count"] for r in kept[("v",)].groupBy("__part").count().collect()) < n
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    df.createOrReplaceTempView("halves")
    want = {r.id: r.b for r in spark.sql("SELECT id, ntile(4) OVER (ORDER BY v NULLS LAST, id) b FROM halves").collect()}
    assert {r.id: r.b for r in got.collect()} == want


def test_tiles_of_rows_that_are_equal_in_value_and_tiebreak(spark):
    df = spark.range(50).selectExpr("id", "IF(id < 40, 1, id) AS v", "IF(id < 30, 0, id) AS t")
    for n in (3, 4, 7, 60):
        got = [r["count"] for r in ranking.with_ntile(df, n, "v", "t", "b").groupBy("b").count().orderBy("b").collect()]
        assert got == [50 // n + (k < 50 % n) for k in range(min(n, 50))]


def test_places(spark):
    df = spark.range(300).selectExpr("id", "id % 3 AS g", "CAST(id % 7 AS INT) AS v")
    df.createOrReplaceTempView("placed")
    want = {r.id: r.p for r in spark.sql("SELECT id, row_number() OVER (PARTITION BY g ORDER BY v DESC, id) - 1 p FROM placed").collect()}
    assert {r.id: r.p for r in ranking.with_place(df, ("g",), ("v", "id"), "p", True).collect()} == want


def test_ranks_derive_rows_twice(spark, sf):
    """Once while the query is built; the plan that is left has one derivation of holdings."""
    for name in ("v3_income_generating_holdings", "v5_return_on_cost_by_holding", "v8_gain_loss_quartiles"):
        plan = queries.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("lineitem.parquet") == 1 and plan.count("FileScan") <= 12


def test_numbers_of_rows_in_groups(spark, monkeypatch):
    """Numbers go on from one range to the next, and a tier's list is put together from pieces that are gathered alone."""
    rows = [(k % 2, None if k % 11 == 0 else k * 7 % 30, k, f"S{k}" if k % 5 else None) for k in range(200)]
    df = spark.createDataFrame(rows, "g int, v int, id int, s string")
    want = {}
    for g in (0, 1):
        order = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        want |= {r[3]: n for n, r in enumerate(order) if r[3]}
    got = ranking.numbered(df.repartition(5), ("g",), ("v", "id"), "n", True)
    assert got.columns == ["g", "s", "n"] and {r.s: r.n for r in got.collect() if r.s} == want and got.count() == 200

    pieces, plain = [], views._symbol_pieces
    monkeypatch.setattr(views, "_symbol_pieces", lambda *a: pieces.append(plain(*a)) or pieces[-1])
    amount = lambda c: F.col(c).cast("decimal(20,6)").alias(c)
    held = spark.range(2500).select(F.col("id").alias("holding_id"), F.concat(F.lit("P"), "id").alias("symbol"), F.lit(1).alias("market_value"), F.lit(2).alias("est_annual_income"), F.lit(3).alias("est_yield"))
    held = held.select("holding_id", "symbol", *map(amount, ("market_value", "est_annual_income", "est_yield")))
    out = views.yield_tier_distribution(held, "holding_id").collect()
    assert [(r.yield_tier, r.holding_count, r.total_market_value, r.total_est_income) for r in out] == [("Mid  (2–4%)", 2500, 2500.0, 5000.0)]
    assert out[0].symbols == ", ".join(f"P{k}" for k in range(2500)) and sorted(r.holding_count for r in pieces[0].collect()) == [500, 1000, 1000]


def test_small_rows_are_dealt_by_number(spark):
    from tallyspark.storage import spread

    few = spark.range(0, 100, 1, 1)
    assert spread(few, "id", rows=30).rdd.getNumPartitions() == 4 and spread(few, "id").rdd.getNumPartitions() == 1


def test_holdings_deal_out_lines_twice(spark):
    """Orders find their customers before lines find their orders; the rows are those of the text as it stands."""
    from tallyspark import schema

    sf_dir = "/root/testdata/sf0.001"
    got = schema.testdata_holdings(spark, sf_dir)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.index("Join Inner, (l_orderkey") < plan.index("Join Inner, (o_custkey")
    plain = spark.sql(schema.HOLDINGS_SQL, **{name: schema.table(spark, sf_dir, name) for name in schema._TABLES})
    assert got.exceptAll(plain).isEmpty() and got.count() == plain.count()
