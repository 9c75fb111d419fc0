"""Table repair, against examples and a plain model on random tables."""

import random

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import tables as T

TABLE = "doc_id string, table_idx int, rows array<array<string>>"


def expression(spark, rows, f):
    return spark.createDataFrame([(rows,)], "rows array<array<string>>").select(f(F.col("rows"))).first()[0]


def run(spark, repair, rows):
    return [list(r) for r in expression(spark, rows, repair)]


def response(*tables, fence=False):
    blocks = [f"===TABLE_START===\n{t}\n===TABLE_END===" if not fence else f"===TABLE_START===\n```\n{t}\n```\n===TABLE_END===" for t in tables]
    return "\n".join(blocks)


def test_blocks(spark):
    texts = [("d", 0, response("A|B\n1|2\n\n | \n3|4", "C\n5")), ("d", 1, "NO_TABLES_FOUND"), ("d", 2, "===TABLE_START===\nX|Y\n1|2"), ("d", 3, response("|E|F|\n|6|7|", fence=True)), ("e", 0, ""), ("e", 1, None)]
    df = T.split_blocks(spark.createDataFrame(texts, "doc_id string, batch_idx int, text string"))
    got = [(r.table_idx, r.rows) for r in df.orderBy("doc_id", "table_idx").collect()]
    assert got == [(0, [["A", "B"], ["1", "2"], ["3", "4"]]), (1, [["C"], ["5"]]), (2, [["", "E", "F", ""], ["", "6", "7", ""]])]
    assert expression(spark, got[2][1], T.drop_pipe_columns) == [["E", "F"], ["6", "7"]]
    assert expression(spark, [["", "a"]], T.drop_pipe_columns) == [["", "a"]]
    assert expression(spark, [["", "a"], [""]], T.drop_pipe_columns) == [["", "a"], [""]]


def test_continuations(spark):
    rows = [["Description", "Qty", "Value"], ["lone first row", "", ""], ["ACME", "--", ""], ["CUSIP: 123", "5", "7"], ["ISIN: X", "9"], ["more words", "", ""], ["BOND FUNDS", "", ""], ["BETA", "1", "2"], ["Symbol: B"]]
    assert run(spark, T.merge_continuations, rows) == [["Description", "Qty", "Value"], ["lone first row ACME CUSIP: 123"[:14], "", ""], ["ACME CUSIP: 123 ISIN: X more words", "5", "7"], ["BOND FUNDS", "", ""], ["BETA Symbol: B", "1", "2"]]
    assert run(spark, T.merge_continuations, [["H"]]) == [["H"]]


def test_split_securities(spark):
    head = ["D", "Q", "V"]
    assert run(spark, T.merge_split_securities, [head, ["ACME CORP NEW SHS", "1", "2"], ["ACME CORP NEW CLASS A", "", "--"]]) == [head, ["ACME CORP NEW SHS CLASS A", "1", "2"]]
    assert run(spark, T.merge_split_securities, [head, ["ACME CORP NEW SHS", "1", "2"], ["ACME CORP NEW CLASS A", "8", "9"]]) == [head, ["ACME CORP NEW SHS CLASS A", "1", "2"]]
    same = [head, ["ACME CORP", "1", "2"], ["acme corp", "3", "4"]]
    assert run(spark, T.merge_split_securities, same) == same
    dated = [head, ["12 Feb note x", "1", "2"], ["12 Feb note y", "3", "4"]]
    assert run(spark, T.merge_split_securities, dated) == dated


def test_lot_codes(spark):
    rows = [["D", "Date", "N", "V"], ["A", "03 Feb 2021", "N", "5.00"], ["B", "x", "ST", "7 LT"], ["N", "(1) N", "n", "text N"]]
    assert expression(spark, rows, T.strip_lot_codes) == [rows[0], ["A", "03 Feb 2021", "5.00", ""], ["B", "x", "", "7"], ["N", "(1)", "", "text N"]]


def test_stacked_pairs(spark):
    double = ["D", "Est. Accrued Inc.", "Est. Annual Inc."]
    assert run(spark, T.fix_stacked_pairs, [double, ["a", "--", "5"], ["b", "3", "--", "4"], ["c", "1", "2"]]) == [double, ["a", "", "5"], ["b", "3", "4"], ["c", "1", "2"]]
    single = ["D", "Qty", "Price", "Ending Market Value", "Accrued Interest (AI)", "Cost"]
    got = run(spark, T.fix_stacked_pairs, [single, ["a", "1", "2", "3", "4", "5"], ["b", "1", "2", "--", "4", "5"], ["Total x", "", "$5.00", "", "", ""]])
    assert got[1:] == [["a", "1", "2", "3", "", "5"], ["b", "1", "2", "4", "", "5"], ["Total x", "", "", "$5.00", "", ""]]
    assert run(spark, T.fix_stacked_pairs, [["D", "Q"], ["a", "1"]]) == [["D", "Q"], ["a", "1"]]


def fingerprint(row):
    import re

    numbers = [re.sub(r"\s+", "", c).lower() for c in row if re.search(r"\d", c)]
    if numbers:
        return re.sub(r"\s+", " ", row[0].strip().lower())[:20] + "|" + "|".join(numbers)
    parts = (re.sub(r"\s+", " ", re.sub("[-–—]+", "-", c.strip().lower())) for c in row)
    return "||".join(p for p in parts if p)


def merged_model(tables, safe):
    """tables: rows of one document in order."""
    out = []
    for at, rows in tables:
        before = tables[[i for i, _ in tables].index(at) - 1][1] if out and at != tables[0][0] else None
        key = [h.strip().lower() for h in rows[0]]
        if before and key == [h.strip().lower() for h in before[0]] and len(rows) > 1 and len(before) > 1 and "\x1f".join(key):
            have = {fingerprint(r) for r in out[-1][1][1:][-30:]}
            seen = [fingerprint(r) in have for r in rows[1:]]
            skip = next((i for i, s in enumerate(seen) if not s), len(seen)) if safe else max([i + 1 for i, s in enumerate(seen) if s], default=0)
            out[-1][1].extend(rows[1 + skip :])
        else:
            out.append((at, [list(r) for r in rows]))
    return out


@pytest.mark.parametrize("safe", [True, False])
def test_merge_shared_headers(spark, safe):
    rng = random.Random(4)
    docs = {d: [(i, [rng.choice([["D", "V"], ["d ", "v"], ["X"]]), *([rng.choice("abc"), str(rng.randint(0, 4))] for _ in range(rng.randint(0, 4)))]) for i in range(rng.randint(1, 9))] for d in map(str, range(30))}
    df = spark.createDataFrame([(d, i, rows) for d, ts in docs.items() for i, rows in ts], TABLE)
    got = {}
    for r in T.merge_shared_headers(df, safe).orderBy("doc_id", "table_idx").collect():
        got.setdefault(r.doc_id, []).append((r.table_idx, r.rows))
    assert got == {d: merged_model(ts, safe) for d, ts in docs.items()}


@pytest.mark.parametrize("safe", [True, False])
def test_an_island_of_ten_thousand_tables(spark, safe):
    """Each table begins with the last two rows of the one before."""
    n, step = 10_000, 3
    df = spark.range(n).selectExpr("'d' AS doc_id", "CAST(id AS INT) AS table_idx", f"concat(array(array('A', 'B')), transform(sequence(CASE WHEN id = 0 THEN 0 ELSE id * {step} - 2 END, id * {step} + {step - 1}), k -> array('row', CAST(k AS STRING)))) AS rows").repartition(5)
    got = T.merge_shared_headers(df, safe).collect()
    assert len(got) == 1 and got[0].table_idx == 0
    assert got[0].rows == [["A", "B"], *(["row", str(k)] for k in range(n * step))]


def test_repeated_tables(spark):
    data = [("d", 0, [["H"], ["a", "1"]]), ("d", 1, [["H"]]), ("d", 2, [["Other"], ["A ", "1"]]), ("d", 3, [["H"]]), ("e", 0, [["H"], ["a", "1"]])]
    got = T.drop_repeated_tables(spark.createDataFrame(data, TABLE)).orderBy("doc_id", "table_idx").collect()
    assert [(r.doc_id, r.table_idx) for r in got] == [("d", 1), ("d", 2), ("d", 3), ("e", 0)]
    again = T.renumbered(spark.createDataFrame([(r.doc_id, r.table_idx, r.rows) for r in got], TABLE)).orderBy("doc_id", "table_idx").collect()
    assert [r.table_idx for r in again] == [0, 1, 2, 0]


def test_padding(spark):
    assert expression(spark, [["a"], ["b", "c"]], T.padded) == [["a", ""], ["b", "c"]]


def test_fingerprints(spark):
    rows = [["Total  Funds", " 1,2 3", "--"], ["Some – text", "--", ""], ["", "9"]]
    got = spark.createDataFrame([(r,) for r in rows], "r array<string>").select(T.row_fingerprint(F.col("r"))).collect()
    assert [r[0] for r in got] == [fingerprint(r) for r in rows]


def test_parse_responses(spark):
    text = response("|Description|Quantity|Ending Market Value|Accrued Interest|\n|ACME INC|5|--|$7.00|\n|CUSIP: 123456789||||\n|Total|$7.00|||")
    rows = T.parse_responses(spark.createDataFrame([("d", 0, text)], "doc_id string, batch_idx int, text string")).first().rows
    assert rows == [["Description", "Quantity", "Ending Market Value", "Accrued Interest"], ["ACME INC CUSIP: 123456789", "5", "$7.00", ""], ["Total", "$7.00", "", ""]]
