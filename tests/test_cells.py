"""Cell functions over tables of literals."""

import pytest
from pyspark.sql import functions as F

from tallyspark.functions import cells as X


def over(spark, values, f):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in rows.select("i", f(F.col("v")).alias("out")).orderBy("i").collect()]


def test_currency(spark):
    cases = {"$11,361.52": 11361.52, "$7,536.91*": 7536.91, "(9,008.50)": -9008.5, "-$250.00": -250, "10,000.00t": 10000, "203.15A": None, "N/A": None, "unknown": None, "--": None, "-": None, "": None, " 5 ": 5, "nan": None, "1e5": 100000, "8.250,": 8.25, "($1,000.00)": -1000}
    got = over(spark, [*cases, None], X.currency)
    assert [None if v is None else float(v) for v in got] == [*cases.values(), None]


def test_percentage(spark):
    cases = {"4.68%": 4.68, "2.86": 2.86, "0.010%": 0.01, "N/A": None, "--": None, "": None, " 3 % ": 3, "x": None}
    assert [None if v is None else float(v) for v in over(spark, [*cases, None], X.percentage)] == [*cases.values(), None]


SECURITIES = {
    "APPLE INC (AAPL)": ("APPLE INC", "AAPL"),
    "GENERAL MOTORS CO USD0.01 (GM) ISIN: US37045V1008": ("GENERAL MOTORS CO USD0.01", "GM"),
    "FEDERAL NATL MTG ASSN CUSIP: 3136F7EX1 -- Bi-Semi-Annually": ("FEDERAL NATL MTG ASSN", "3136F7EX1"),
    "AMBEV S A ADS EST YIELD: 2.97% Symbol: ABEV": ("AMBEV S A ADS EST YIELD: 2.97%", "ABEV"),
    "COCA COLA COMPANY (THE) Symbol: KO": ("COCA COLA COMPANY", "THE"),
    "FOO isin: us37045v1008 more": ("FOO", "us37045v1008"),
    "  plain text ": ("plain text", None),
    None: (None, None),
}


def test_symbol_and_name(spark):
    assert over(spark, list(SECURITIES), X.security_name) == [n for n, _ in SECURITIES.values()]
    assert over(spark, list(SECURITIES), X.symbol) == [s for _, s in SECURITIES.values()]


def test_classes(spark):
    accounts = {"Traditional IRA 1": "Tax-Deferred", "Individual traditional ira": "Tax-Deferred", "ROTH IRA": "Tax-Exempt", "Education Account 3": "Tax-Exempt", "Joint - TOD": "Taxable", "TFR ON DEATH IND 9": "Unknown", "": "Unknown", None: "Unknown"}
    assert over(spark, list(accounts), X.account_type) == list(accounts.values())
    headers = {"CASH & SWEEP FUNDS": "Funds", "Corporate Bond Funds": "Fixed Income", "Bond Funds": "Funds", "Common Stock": "Equities", "Other": None, None: None}
    assert over(spark, list(headers), X.class_from_header) == list(headers.values())
    names = {"ESCROW GEN MOTORS CORP BOND": "Fixed Income", "DELPHI CORP JR SB NT": "Equities", "DEPOSIT SWEEP": "Cash & Equivalents", "SHARES TRUST": "Funds", None: "Equities"}
    assert over(spark, list(names), lambda v: X.class_from_name(v, F.lit(None).cast("string"))) == list(names.values())


def test_labels_and_texts(spark):
    labels = {"GENERAL John Doe - Individual TOD": "Individual TOD", "A - B - C": "B - C", "Total Portfolio": None, "x Portfolio - y": None, "no dash": None, None: None}
    assert over(spark, list(labels), X.account_label) == list(labels.values())
    assert over(spark, [" A –— b\t c "], X.normalized) == ["a - b c"]
    assert over(spark, ["```json\n[1]\n```", "[2]"], X.unfenced) == ["[1]", "[2]"]
    assert over(spark, ["Total x", " total", "Subtotal", None], X.is_total) == [True, True, False, False]
    dates = {"12/17/13": True, "03 Feb 2021": True, "Feb 3, 2021": True, "3,094.08": False, "N": False}
    assert over(spark, list(dates), X.looks_like_date) == list(dates.values())


@pytest.mark.parametrize("kind,number,want", [("IRA", "1-2", "IRA 1-2"), (None, "1", "Unknown Account"), ("IRA", None, "Unknown Account")])
def test_account_name(spark, kind, number, want):
    assert spark.range(1).select(X.account_name(F.lit(kind).cast("string"), F.lit(number).cast("string"))).first()[0] == want
