"""A synthetic statement through readers, parsing, validation, correction and writers."""

import io
import json
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyspark.operators import correct, extract, journal, matching, parse, validate
from tallyspark.sources import readers, writers

TABLE = "doc_id string, table_idx int, rows array<array<string>>"
STOCKS = ["Description", "Quantity", "Price Per Unit", "Ending Market Value", "Total Cost Basis", "Unrealized Gain/Loss", "Est. Annual Income (EAI)", "Est. Yield (EY)"]
BONDS = ["Description", "Maturity", "Quantity", "Price Per Unit", "Ending Market Value", "Accrued Interest (AI)", "Total Cost Basis", "Unrealized Gain/Loss", "Est. Annual Income (EAI)", "Coupon Rate"]
STATEMENT = [
    [["Page", "Account Type/Name", "Account Number", "Beginning Value"], ["5", "GENERAL Ann Example - Individual TOD", "111-1", "$1.00"], ["6", "PERSONAL Ann Example - Traditional IRA", "222-2", "2"], ["", "Total Portfolio", "", "$3.00"]],
    [["Description", "Quantity", "Market Value"], ["ORPHAN INC (ORF)", "1", "$10.00"]],
    [["", "This Period"], ["Beginning Account Value", "$1.00"]],
    [STOCKS, ["Common Stock", "", "", "", "", "", "", ""], ["ACME CORP (ACME)", "10", "$5.000", "$50.00", "$40.00*", "$10.00", "$2.00", "4.00%"], ["SHORT CO (SHRT)", "-5", "2", "(10.00)", "$12.00", "2.00", "--", "--"], ["Total Common Stock (9% of account)", "", "", "$40.00", "$52.00", "$12.00", "$2.00", ""], ["Total Equities", "", "", "$40.00", "", "", "", ""], ["Bond Funds", "", "", "", "", "", "", ""], ["NO SYMBOL FUND", "3", "1", "3.00", "N/A", "N/A", "", ""], ["Total Holdings", "", "", "$99.00", "", "", "", ""]],
    [["", "This Period"], ["Beginning Account Value", "$1.00"]],
    [BONDS, ["ESCROW NOTE BOND CUSIP: 37045XAD9 rest", "3/15/36", "10000", "101", "$10,100.00", "", "999,999.99", "999,999.99", "7.750", ""], ["DELTA CORP JR NT CUSIP: 247126AF2", "10/15/33", "2,000,000", "1", "$15.00", "", "350.00", "", "8.250", "6.00%"], ["Total Bonds", "", "", "", "$20,000.00", "", "$1,000,349.99", "", "", ""]],
    [["0", "1"], ["just", "text"]],
]


@pytest.fixture(scope="module")
def statement(spark):
    return spark.createDataFrame([("s", i, rows) for i, rows in enumerate(STATEMENT)], TABLE)


@pytest.fixture(scope="module")
def holdings(statement):
    return parse.extract_holdings(statement).cache()


def test_holdings(holdings):
    rows = {r.name: r for r in holdings.collect()}
    assert rows.keys() == {"ORPHAN INC", "ACME CORP", "SHORT CO", "NO SYMBOL FUND", "ESCROW NOTE BOND", "DELTA CORP JR NT"}
    acme = rows["ACME CORP"]
    assert (acme.symbol, acme.asset_class, float(acme.quantity), float(acme.cost_basis), float(acme.est_yield)) == ("ACME", "Equities", 10, 40, 4)
    assert (acme.account, acme.account_type) == ("Individual TOD 111-1", "Taxable")
    assert (float(rows["SHORT CO"].market_value), rows["SHORT CO"].est_annual_income) == (-10, None)
    assert (rows["NO SYMBOL FUND"].asset_class, rows["NO SYMBOL FUND"].symbol) == ("Funds", None)
    assert (rows["ORPHAN INC"].account, rows["ORPHAN INC"].account_type) == ("Unknown Account", "Unknown")
    escrow, delta = rows["ESCROW NOTE BOND"], rows["DELTA CORP JR NT"]
    assert (escrow.asset_class, delta.asset_class) == ("Fixed Income", "Equities")  # by name: no category rows
    assert (float(escrow.cost_basis), float(escrow.est_annual_income), delta.account_type) == (999999.99, 7.75, "Tax-Deferred")


def test_issues(statement, holdings):
    issues = validate.find_issues(holdings, parse.stated_totals(statement), failed=statement.sparkSession.createDataFrame([("s", "3-4")], "doc_id string, page_range string"))
    got = sorted((r.category, r.field, r.name) for r in issues.collect() if r.name)
    assert got == sorted([
        ("negative_values", "quantity", "SHORT CO"), ("negative_values", "market_value", "SHORT CO"), ("abnormal_quantities", "quantity", "DELTA CORP JR NT"),
        ("missing_symbol", "symbol", "NO SYMBOL FUND"), ("missing_account", "account", "ORPHAN INC"), ("missing_data", "cost_basis", "NO SYMBOL FUND"), ("missing_data", "cost_basis", "ORPHAN INC"),
    ])
    mismatches = sorted((r.table_idx, r.field, float(r.expected), float(r.calculated)) for r in issues.where("category = 'total_mismatches'").collect())
    assert mismatches == [(3, "market_value", 40, 43), (5, "market_value", 20000, 10115)]
    messages = {r.message for r in issues.collect()}
    assert "Table 6: Market Value sum/total mismatch — Expected: $20,000.00, Calculated: $10,115.00" in messages
    assert "Abnormally large quantity = 2,000,000 for DELTA CORP JR NT" in messages and "Pages 3-4 could not be extracted" in messages
    counts = validate.issue_counts(issues).first()
    assert (counts.total_mismatches, counts.extraction_failures, counts.missing_data) == (2, 1, 2)
    parsed = issues.select(*(c.alias(k) for k, c in readers.parse_issue(F.col("message")).items())).collect()
    assert {(r.table_number, r.field, float(r.expected)) for r in parsed if r.table_number} == {(4, "Market Value", 40.0), (6, "Market Value", 20000.0)}


def test_header_rows_and_index_columns(spark):
    cases = [
        ([["1", "2"], ["Name", "Value"], ["a", "3"]], [["Name", "Value"], ["a", "3"]]),
        ([["2021", "Value"], ["a", "3"]], [["2021", "Value"], ["a", "3"]]),
        ([["5", "6"], ["7", "8"]], [["5", "6"], ["7", "8"]]),
        ([["5"], ["x"]], [["x"]]),
    ]
    for rows, want in cases:
        assert spark.createDataFrame([(rows,)], "rows array<array<string>>").select(parse.from_header(F.col("rows"))).first()[0] == want
    for rows, want in [([["", "A"], ["0", "x"], ["1", "y"]], [["A"], ["x"], ["y"]]), ([["", "A"], ["x", "1"]], [["", "A"], ["x", "1"]]), ([["id", "A"], ["0", "x"]], [["id", "A"], ["0", "x"]])]:
        assert spark.createDataFrame([(rows,)], "rows array<array<string>>").select(parse.drop_index_column(F.col("rows"))).first()[0] == want


def test_columns_by_priority(spark):
    header = ["Description", "Cost Basis", "Total Cost Basis", "Coupon Rate", "Yield", "Ending Market Value Accrued Interest (AI)"]
    row = spark.createDataFrame([(header,)], "h array<string>").select(*(parse.resolve_column(F.col("h"), f).alias(f) for f in ("cost_basis", "yield", "market_value", "quantity"))).first()
    assert tuple(row) == (3, 4, 6, None)
    titles = ["", "Market Price", "Quantity", "Ending Market Value", "Est. Annual Income (EAI)"]
    asked = spark.createDataFrame([("Market Value", 4), ("est. income", 5), ("the price", 2), ("a value", 4), ("of the est", None), ("", None), (None, None), ("QUANTITY held", 3)], "f string, at int")
    found = asked.select("at", parse.matching_column(F.array(*map(F.lit, titles)), F.col("f")).alias("got"))
    assert [r for r in found.collect() if r.at != r.got] == []


def test_supplied_accounts(spark):
    bare = spark.createDataFrame([("t", 0, [["", "x"], ["Beginning Account Value", "1"]]), ("t", 1, [STOCKS, ["ACME (A)", "1", "", "2", "", "", "", ""]])], TABLE)
    supplied = spark.createDataFrame([("t", 0, "Roth IRA", "9-9"), ("t", 1, "", "x")], "doc_id string, account_idx int, kind string, number string")
    row = parse.extract_holdings(bare, supplied).first()
    assert (row.account, row.account_type) == ("Roth IRA 9-9", "Tax-Exempt")


class Reviewer:
    """A model that knows two corrections, an account and a mismatch."""

    def verify(self, category, issues):
        answers = []
        for i in issues:
            a = {"issue_id": i["issue_id"], "verdict": "confirmed", "reason": "as printed"}
            if category == "missing_symbol":
                a |= {"verdict": " false positive ", "corrected_symbol": " NSF "}
            elif category == "missing_account":
                a |= {"verdict": "RESOLVED", "account_type": "Roth IRA", "account_number": "333-3"}
            elif category == "missing_data" and "ORPHAN" in i["message"]:
                a |= {"verdict": "FALSE POSITIVE", "corrected_cost_basis": "$9.50"}
            elif category == "missing_data":
                a |= {"verdict": "perhaps"}
            elif category == "total_mismatches" and "Table 6" in i["message"]:
                a |= {"verdict": "VALUES INCORRECT", "phase1_corrections": [{"name": "delta corp", "corrected_value": "9,900.00"}, {"name": "unknown name", "corrected_value": "1"}, {"name": "DELTA", "corrected_value": "n/a"}]}
            elif category == "total_mismatches":
                a |= {"verdict": "CONFIRMED TRUE MISMATCH"}
            answers.append(a)
        return "```json\n" + json.dumps(answers) + "\n```" if category != "abnormal_quantities" else "no json"


def test_self_correction(statement, holdings):
    fixed, ledger, log = correct.self_correct(holdings, parse.stated_totals(statement), Reviewer())
    rows = {r.name: r for r in fixed.collect()}
    assert rows["NO SYMBOL FUND"].symbol == "NSF" and float(rows["ORPHAN INC"].cost_basis) == 9.5
    assert (rows["ORPHAN INC"].account, rows["ORPHAN INC"].account_type) == ("Roth IRA 333-3", "Tax-Exempt")
    assert float(rows["DELTA CORP JR NT"].market_value) == 9900
    statuses = sorted((r.security, r.status) for r in log.where("iteration = 1").collect() if r.status != "APPLIED")
    assert statuses == [("DELTA", "FAILED — value not numeric"), ("unknown name", "FAILED — no row matched")]
    old = {r.column: r.old_value for r in log.where("security = 'delta corp' and status = 'APPLIED'").collect()}
    assert float(old["market_value"]) == 15
    first = ledger.where("iteration = 1")
    verdicts = {(r.category, r.name): r.verdict for r in first.collect()}
    assert verdicts["abnormal_quantities", "DELTA CORP JR NT"] == "NEEDS REVIEW" and verdicts["missing_data", "NO SYMBOL FUND"] == "NEEDS REVIEW"
    second = {(r.category, r.name) for r in ledger.where("iteration = 2").collect()}
    assert second == {("abnormal_quantities", "DELTA CORP JR NT"), ("missing_data", "NO SYMBOL FUND")}
    assert correct.verdict_counts(first).where("category = 'negative_values'").first()["CONFIRMED"] == 2
    last = correct.final_disposition(ledger).collect()
    assert last[0].verdict == "CONFIRMED" and last[-1].verdict == "NEEDS REVIEW" and len(last) == 9


def test_mismatch_rules(spark):
    rows = [(None, True, False, [], 5.0, "NEEDS REVIEW"), (5.5, True, True, ["x"], 5.0, "VALUES INCORRECT"), (5.0, False, True, [], 5.0, "NEEDS REVIEW"), (5.9, True, True, [], 5.0, "CONFIRMED TRUE MISMATCH"), (8.0, True, True, [], 5.0, "BAD TOTAL PARSE"), (None, True, None, [], 5.0, "NEEDS REVIEW")]
    df = spark.createDataFrame(rows, "total double, ok boolean, checks boolean, fixes array<string>, expected double, want string")
    got = df.select("want", correct.mismatch_verdict(*(F.col(c) for c in ("total", "ok", "checks", "fixes", "expected"))).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


class TwoSteps:
    """Reads totals and spot-checks holdings, and leaves the verdict on mismatches to the rules."""

    def verify(self, category, issues):
        answers = []
        for i in issues:
            held = json.loads(i["holdings"])
            a = {"issue_id": i["issue_id"], "verdict": "CONFIRMED", "reason": ",".join(sorted(h["name"] for h in held))}
            if category == "total_mismatches":
                assert i["calculated"] is not None
                a |= {"verdict": None, "pdf_total": i["expected"], "total_ok": True, "checks_ok": True}
                if "Table 6" in i["message"]:
                    a["phase1_corrections"] = [{"name": held[0]["name"], "corrected_value": "9,900.00"}]
            answers.append(a)
        return json.dumps(answers)


def test_two_step_mismatches(statement, holdings):
    issues = validate.find_issues(holdings, parse.stated_totals(statement))
    verdicts = correct.verify(issues, TwoSteps(), holdings).collect()
    mismatches = [v for v in verdicts if v.category == "total_mismatches"]
    assert mismatches and len(mismatches) < len(verdicts)
    for v in mismatches:
        assert v.verdict == ("VALUES INCORRECT" if "Table 6" in v.message else "CONFIRMED TRUE MISMATCH")
    for v in verdicts:
        names = {r.name for r in holdings.collect() if (r.holding_id == v.holding_id if v.holding_id else (r.doc_id, r.table_idx) == (v.doc_id, v.table_idx))}
        assert set(v.reason.split(",")) == names


def test_names_match_as_substrings(spark):
    names = ["ACME Corp (New)", "acme", "a", None, "Other acme corp"]
    fragments = ["acme corp", "A", "(new", "zzz", ""]
    got = matching.match_names(spark.createDataFrame([(f, f) for f in fragments], "fragment_id string, fragment string"), spark.createDataFrame(list(enumerate(names)), "holding_id int, name string"))
    want = {(f, i) for f in fragments if f for i, n in enumerate(names) if n and f.lower() in n.lower()}
    assert {(r.fragment, r.holding_id) for r in got.collect()} == want and got.count() == len(want)


# -- files


def test_batches_are_asked_as_they_come():
    """A task's batches go through one stream of frames, however they are cut; a batch is one call."""
    import pandas as pd

    class Reader:
        def read(self, doc_id, pages):
            return ",".join(str(n) for n, _ in pages), "STOP"

    rows = [("a", k // 3, k, b"") for k in range(250)] + [("b", 0, k, b"") for k in range(2)]
    frame = pd.DataFrame(rows, columns=["doc_id", "batch_idx", "page_number", "image"])
    got = pd.concat(extract._ask(Reader())(iter([frame[:100], frame[100:101], frame[101:]])))
    assert len(got) == 85 and list(got["text"][-2:]) == ["249", "0,1"] and ",".join(got["text"][:-1]) == ",".join(map(str, range(250)))
    assert list(got["first_page"][:3]) == [0, 3, 6] and list(got["last_page"][:3]) == [2, 5, 8]


def test_report_in_parts(spark, tmp_path):
    """A report that was written in parts is one: bullets find titles of earlier parts, and no task writes it all."""
    issues = spark.createDataFrame([("negative_values", f"n{k:03}") for k in range(50)] + [("missing_data", f"d{k:03}") for k in range(50)], "category string, message string")
    writers.write_text(writers.issue_lines(issues).repartitionByRange(6, "section", "kind", "line").sortWithinPartitions("section", "kind", "line"), str(tmp_path / "report"))
    assert len(list((tmp_path / "report").glob("part-*"))) > 3
    got = readers.read_issue_report(spark, str(tmp_path / "report")).orderBy("seq").collect()
    assert [(r.category, r.message) for r in got] == [(c, f"{m}{k:03}") for c, m in (("negative_values", "n"), ("missing_data", "d")) for k in range(50)]
    assert len({r.file for r in got}) == 1


@pytest.mark.parametrize("hot", [10_000, 2, 0])
def test_names_with_a_string_that_all_have(spark, hot):
    """One string is in every name; fragments are looked up by their rarest ones, hot ones by two together."""
    names = [(k, f"FUND OF {k % 7} and {'x' * (k % 5)} {k}", k % 3) for k in range(300)] + [(900, None, 1), (901, "", 1), (902, "fun", 1)]
    fragments = ["fund of 3", "FUND", "d of 5 and xx", "and", "n", "zz", "", "fund of 9", "12", " xxxx "]
    asked = spark.createDataFrame([(f"{f}/{g}", f, g) for f in [*fragments, None] for g in range(3)], "fragment_id string, fragment string, g int")
    held = spark.createDataFrame(names, "holding_id int, name string, g int")
    for within in ((), ("g",)):
        got = sorted((r.fragment_id, r.holding_id) for r in matching.match_names(asked, held, within, hot).collect())
        want = sorted((f"{f}/{g}", i) for f in fragments for g in range(3) for i, n, h in names if f and n and f in n.lower() or f and n and f.lower() in n.lower() if not within or g == h)
        assert got == want


@pytest.mark.parametrize("side", [2_000, 3])
def test_texts_that_many_rows_have(spark, monkeypatch, side):
    """Each distinct text is indexed once, however many fragments and holdings have it; their pairs are dealt out in squares."""
    kept, plain = {}, matching.stored

    def watched(df, label, *folders):
        kept[label] = plain(df, label, *folders)
        return kept[label]

    monkeypatch.setattr(matching, "stored", watched)
    asked = spark.createDataFrame([(k, ("Red W", "wheel", "x")[k % 3]) for k in range(60)], "fragment_id int, fragment string")
    held = spark.createDataFrame([(k, ("red wheel", "RED WOOL", "blue wheel", None)[k % 4]) for k in range(80)], "holding_id int, name string")
    got = sorted((r.fragment_id, r.holding_id) for r in matching.match_names(asked, held, side=side).collect())
    assert got == [(f, h) for f in range(60) for h in range(80) if (f % 3, h % 4) in {(0, 0), (0, 1), (1, 0), (1, 2)}]
    assert kept["name-strings"].count() < 20 and kept["matched-texts"].count() == 4
    assert kept["frequent-texts"].count() == (2 if side == 3 else 0)


def test_rows_find_holdings_by_sixty_characters(spark):
    long = "A VERY LONG NAME OF A SECURITY THAT GOES ON FOR MORE THAN SIXTY CHARACTERS"
    held = spark.createDataFrame([("a", 0, "h1", long + " SERIES A"), ("a", 1, "h2", long.lower() + " series b"), ("b", 0, "h3", long), ("a", 2, "h4", "ACME"), ("a", 2, "h5", "New Acme Corp")], "doc_id string, table_idx int, holding_id string, name string")
    rows = spark.createDataFrame([("a", 0, 0, long + " SERIES A"), ("a", 1, 0, "acme"), ("a", 1, 1, "acme"), ("b", 0, 0, "nothing"), ("b", 1, 0, None), ("b", 1, 1, "  ")], "doc_id string, table_idx int, row_idx int, name string")
    got = sorted(tuple(r) for r in matching.reassigned(rows, held).collect())
    assert got == [("a", 0, 0, "h1"), ("a", 0, 0, "h2"), ("a", 1, 0, "h4"), ("a", 1, 0, "h5"), ("a", 1, 1, "h4"), ("a", 1, 1, "h5")]


def many_holdings(spark, docs=30):
    """Documents of two tables with three holdings, every third with something wrong."""
    rows, totals = [], []
    for d in range(docs):
        for t in range(2):
            for k in range(3):
                value = -5 if (d + k) % 9 == 0 else 10
                rows.append((f"d{d}", t, k, f"d{d}-{t}-{k}", f"name {k} of {d}", None if (d + t) % 7 == 0 and k == 1 else "S", "acc", "Taxable", 1, None if d % 11 == 0 and k == 0 else 3, value))
            totals.append((f"d{d}", t, None, None, 30, None, None))
    amounts = "decimal(20,6)"
    holdings = spark.createDataFrame([(*r[:8], *map(str_or_none, r[8:])) for r in rows], "doc_id string, table_idx int, row_idx int, holding_id string, name string, symbol string, account string, account_type string, quantity string, cost_basis string, market_value string")
    holdings = holdings.withColumns({c: F.col(c).cast(amounts) for c in ("quantity", "cost_basis", "market_value")} | {c: F.lit("1").cast(amounts) for c in ("unrealized_gl", "est_annual_income")})
    given = spark.createDataFrame([(*r[:2], *map(str_or_none, r[2:])) for r in totals], "doc_id string, table_idx int, quantity string, cost_basis string, market_value string, unrealized_gl string, est_annual_income string")
    return holdings, given.withColumns({c: F.col(c).cast(amounts) for c in ("quantity", "cost_basis", "market_value", "unrealized_gl", "est_annual_income")})


def str_or_none(x):
    return None if x is None else str(x)


class Doubter:
    """Finds a negative value of document d0 or d9 wrong, everything else as printed."""

    def verify(self, category, issues):
        wrong = lambda i: category == "negative_values" and any(f" of {d}" in i["message"][-6:] for d in (0, 9))
        return json.dumps([{"issue_id": i["issue_id"], "verdict": "FALSE POSITIVE" if wrong(i) else "CONFIRMED" if category != "missing_symbol" else "?", "corrected_value": "10" if wrong(i) else None} for i in issues])


@pytest.mark.parametrize("by_name", [False, True])
def test_rounds_validate_what_has_changed(spark, monkeypatch, by_name):
    holdings, totals = many_holdings(spark)
    sources = holdings.select("doc_id", "table_idx", "row_idx", "name") if by_name else None
    seen, plain = [], validate.revalidated

    def watched(issues, rows, totals, touched, tolerance, members):
        out = plain(issues, rows, totals, touched, tolerance, members)
        seen.append((rows, totals, touched, issues, out))
        return out

    monkeypatch.setattr(correct, "revalidated", watched)
    fixed, ledger, log = correct.self_correct(holdings, totals, Doubter(), sources=sources)
    assert len(seen) == 1
    rows, some_totals, touched, before, after = seen[0]
    assert {r.doc_id for r in touched.collect()} <= {"d0", "d9"} and touched.count() > 0
    assert rows.count() < holdings.count() / 4 and some_totals.count() < totals.count() / 4  # only buckets with a change
    # the same issues as from scratch, in the buckets that were read again and in all
    docs = [r.doc_id for r in rows.select("doc_id").distinct().collect()]
    own = fixed.where(F.col("doc_id").isin(docs))
    counted = own if sources is None else matching.reassigned(sources, own).join(own.drop("doc_id", "table_idx", "row_idx"), "holding_id")
    records = validate.record_issues(own, ("doc_id", "table_idx"))
    sums = validate.mismatch_issues(validate.reconcile(counted, totals.where(F.col("doc_id").isin(docs)), ["doc_id", "table_idx"]))
    want = records.unionByName(sums, allowMissingColumns=True)
    shown = lambda df: sorted(map(str, ((r.doc_id, r.table_idx, r.holding_id, r.category, r.field, r.message, r.expected, r.calculated) for r in df.collect())))
    assert shown(after) == shown(want)
    assert float(fixed.where("holding_id = 'd0-0-0'").first().market_value) == 10
    second = ledger.where("iteration = 2")
    # by name, the holdings of both tables count for each
    assert second.where("category = 'total_mismatches' and doc_id = 'd0'").count() == (2 if by_name else 0) and second.where("category = 'missing_symbol'").count() > 0


class Moody:
    """Fails twice before each answer, and writes down what it was asked."""

    def __init__(self, path, failures=2):
        self.path, self.failures = str(path), failures

    def _asked(self, key):
        from pathlib import Path

        tries = Path(self.path, key)
        n = int(tries.read_text()) if tries.exists() else 0
        tries.write_text(str(n + 1))
        if n < self.failures:
            raise journal.Unavailable("busy")

    def read(self, doc_id, pages):
        self._asked("-".join(map(str, [doc_id, *(n for n, _ in pages)])))
        return f"===TABLE_START===\nA|B\n{pages[0][0]}|x\n===TABLE_END===", "STOP"

    def verify(self, category, issues):
        self._asked(category)
        return json.dumps([{"issue_id": i["issue_id"], "verdict": "CONFIRMED"} for i in issues])

    def accounts(self, doc_id):
        self._asked(doc_id)
        return '```json\n[{"account_type": " Roth IRA ", "account_number": "1"}, {"account_type": "", "account_number": "2"}, {"account_type": "Trust", "account_number": "3"}]\n```'


def test_a_task_that_runs_again_asks_nothing(spark, tmp_path):
    from pathlib import Path

    asked, answers = tmp_path / "asked", f"file://{tmp_path}/answers"
    asked.mkdir()
    pages = spark.createDataFrame([(d, k, bytes([k])) for d in ("a", "b") for k in range(1, 9)], "doc_id string, page_number int, image binary")
    reader = journal.JournaledReader(Moody(asked), answers, delay=0)
    batches = extract.batched(pages, 4).groupBy("doc_id", "batch_idx").applyInPandas(extract._ask(reader), extract._RESPONSE)
    first, again = (sorted(map(tuple, batches.collect())) for _ in range(2))  # the tasks run twice
    assert first == again and len(first) == 4 and all("===TABLE_END===" in r[3] for r in first)
    assert {p.name: p.read_text() for p in Path(asked).iterdir()} == {f"{d}-{'-'.join(map(str, range(a, a + 4)))}": "3" for d in ("a", "b") for a in (1, 5)}
    holdings, totals = many_holdings(spark, 4)
    client = journal.JournaledClient(Moody(asked), answers, delay=0)
    issues = validate.find_issues(holdings, totals)
    for _ in range(2):
        verdicts = correct.verify(issues, client, holdings)
        assert verdicts.where("verdict = 'CONFIRMED'").count() > 0
    assert all(Path(asked, c).read_text() == "3" for c in ("negative_values", "missing_symbol", "missing_data") if Path(asked, c).exists())


def test_requests_that_keep_failing(tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()
    waits = []
    assert journal.retried(lambda: Moody(asked, 99)._asked("x"), 5, 2, 5, waits.append) is None
    assert waits == [2, 4, 5, 5]
    reader = journal.JournaledReader(Moody(asked, 4), str(tmp_path / "answers"), 3, 0)
    assert reader.read("d", [(1, b"")]) == ("NO_TABLES_FOUND", None)  # not written down, so asked again
    assert reader.read("d", [(1, b"")])[1] == "STOP"
    with pytest.raises(ZeroDivisionError):
        journal.retried(lambda: 1 / 0)
    client = journal.JournaledClient(Moody(asked, 99), str(tmp_path / "answers"), 2, 0)
    assert client.verify("c", [{"issue_id": "1"}]) == "[]"


def test_accounts_from_the_model(spark, tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()
    client = journal.JournaledClient(Moody(asked), str(tmp_path / "answers"), delay=0)
    docs = spark.createDataFrame([("one",), ("two",), ("one",)], "doc_id string")
    got = sorted(tuple(r) for r in extract.supplied_accounts(docs, client).collect())
    assert got == [(d, k, *a) for d in ("one", "two") for k, a in enumerate((("Roth IRA", "1"), ("Trust", "3")))]


def test_tables_round_trip(spark, statement, tmp_path):
    folder = tmp_path / "csv" / "s"
    writers.write_tables(statement, f"{tmp_path}/csv", "t_")
    assert sorted(p.name for p in folder.iterdir()) == [f"t_{n}.csv" for n in range(1, len(STATEMENT) + 1)]
    assert [p.name for p in (tmp_path / "csv").iterdir()] == ["s"]  # nothing staged is left
    (folder / "notes.csv").write_text("x")
    (folder / "t_9.csv").write_text('"two\nlines",b\n1,"a ""quoted"" cell"\n')
    for path in (f"{tmp_path}/csv", f"file://{tmp_path}/csv"):
        again = sorted((tuple(r) for r in readers.read_numbered_csvs(spark, path, "t_").collect()))
        assert again == sorted((tuple(r) for r in readers.read_numbered_csvs(spark, f"{tmp_path}/csv/*/*.csv", "t_").collect()))
    got = {r.table_idx: r.rows for r in readers.read_numbered_csvs(spark, f"{tmp_path}/csv/*/*.csv", "t_").collect()}
    widest = [max(map(len, t)) for t in STATEMENT]
    assert {i: got[i] for i in range(len(STATEMENT))} == {i: [r + [""] * (w - len(r)) for r in t] for i, (t, w) in enumerate(zip(STATEMENT, widest, strict=True))}
    assert got[8] == [["two\nlines", "b"], ["1", 'a "quoted" cell']]
    again = parse.extract_holdings(readers.read_numbered_csvs(spark, f"{tmp_path}/csv/*/t_[1-7].csv", "t_"))
    assert again.count() == 6
    one = readers.read_one_table(parse.prepared(statement), 4, "Market Value sum/total")
    assert [(r.name, r.value) for r in one.where("value <> ''").orderBy("row_idx").collect()] == [("ACME CORP (ACME)", "$50.00"), ("SHORT CO (SHRT)", "(10.00)"), ("NO SYMBOL FUND", "3.00")]


def test_numbered_files(spark, tmp_path, monkeypatch):
    """Many documents, odd names and cells; written twice, read in packs."""
    from tallyspark.sources import numbered

    cells = ['"', "a,b", "two\nlines", "", " padded ", "é"]
    rows = [(f"file:/in/{d} +%.zip", t, [[f"{d}.{t}", cells[(d + t) % 6]], ["x"]]) for d in range(25) for t in range(8)]
    for n in (200, 120):  # fewer the second time: the earlier ones are replaced
        writers.write_tables(spark.createDataFrame(rows[:n], TABLE).repartition(7), f"{tmp_path}/many", "n_")
        got = sorted(tuple(r) for r in readers.read_numbered_csvs(spark, f"{tmp_path}/many", "n_").collect())
        assert got == sorted((d, t, [[a, b.strip()], ["x", ""]]) for d, t, ((a, b), _) in rows[:n])
    assert sorted(tuple(r) for r in readers.read_numbered_csvs(spark, f"{tmp_path}/many/*/*.csv", "n_").collect()) == got
    assert {len(p.paths) for p in numbered.NumberedReader(f"{tmp_path}/many", "n_").partitions()} == {120}
    monkeypatch.setattr(numbered, "MANY", 50)
    assert [len(p.paths) for p in numbered.NumberedReader(f"{tmp_path}/many", "n_").partitions()] == [50, 50, 20]
    before = sorted(tmp_path.glob("many/*/*"))
    twice = spark.createDataFrame([("d", 0, [["a"]]), ("d", 0, [["b"]])], TABLE)
    for bad in (twice.coalesce(1), twice.repartition(2), spark.createDataFrame([(None, 0, [["a"]])], TABLE)):
        with pytest.raises(Exception, match="one number|can't be named"):
            writers.write_tables(bad, f"{tmp_path}/many", "n_")
        assert sorted(tmp_path.glob("many/*/*")) == before  # an aborted write leaves what was there
    writers.write_tables(spark.createDataFrame([], TABLE), f"{tmp_path}/many", "n_")
    assert readers.read_numbered_csvs(spark, f"{tmp_path}/many", "n_").collect() == []


def test_numbered_files_are_moved_by_document(spark, tmp_path, monkeypatch):
    """A new document is one rename; in a folder that is there already, files are moved one by one beside what it has."""
    from pyarrow import fs

    from tallyspark.sources import numbered

    def staged(name, rows):
        writer = numbered.NumberedWriter(f"{tmp_path}/{name}", "n_", True)
        return writer, [writer.write(pa.Table.from_pylist([dict(zip(TABLE_NAMES, r, strict=True)) for r in part]).to_batches()) for part in rows]

    class Counted(fs.LocalFileSystem):
        moved = []

        def move(self, source, target):
            self.moved.append(target)
            super().move(source, target)

    monkeypatch.setattr(numbered, "arrow_files", lambda path: (Counted(), path))
    TABLE_NAMES = ("doc_id", "table_idx", "rows")
    first = [[("a", t, [["x"]]) for t in range(5)] + [("both", 0, [["y"]])], [("both", 1, [["z"]])]]
    writer, messages = staged("out", first)
    writer.commit(messages)
    assert sorted(p.removeprefix(f"{tmp_path}/out/") for p in Counted.moved) == ["a", "both/n_1.csv", "both/n_2.csv"]
    assert sorted(str(p.relative_to(tmp_path / "out")) for p in tmp_path.glob("out/*/*")) == [f"a/n_{t}.csv" for t in range(1, 6)] + ["both/n_1.csv", "both/n_2.csv"]
    (tmp_path / "out" / "a" / "notes.csv").write_text("x")
    writer, messages = staged("out", [[("a", 6, [["x"]])]])
    writer.commit(messages)
    assert sorted(str(p.relative_to(tmp_path / "out")) for p in tmp_path.glob("out/*/*")) == ["a/n_7.csv", "a/notes.csv"]
    writer, messages = staged("out", [[("a", 0, [["x"]]), ("a", 0, [["y"]])]])
    with pytest.raises(ValueError, match="one number"):
        writer.commit(messages)
    assert (tmp_path / "out" / "a" / "n_7.csv").exists()
    tables = [[["a", None], None, []], None, [], [["b"], ["c", ""]], [None]]
    column = pa.array([[["left", "out"]], *tables], pa.list_(pa.list_(pa.string())))[1:]
    assert list(numbered.cells(column)) == [[[c or "" for c in r or []] for r in t or []] for t in tables]


def test_reports_in_two_encodings(spark, tmp_path):
    lines = ["MISSING DATA (1)", "- Missing Cost Basis for Café – “A” €", "", "negative values", "  -  Negative Quantity = -1 for Ž", "MISSING SYMBOL (0)"]
    (tmp_path / "a.txt").write_bytes("\r\n".join(lines).encode("windows-1252"))
    (tmp_path / "b.txt").write_bytes("\n".join(["- before any title", *lines]).encode())
    (tmp_path / "c.txt").write_bytes(b"")
    got = [(r.file.rpartition("/")[2], r.category, r.message) for r in readers.read_issue_report(spark, str(tmp_path)).orderBy("file", "seq").collect()]
    assert got == [(f, c, m) for f in ("a.txt", "b.txt") for c, m in (("missing_data", lines[1][2:]), ("negative_values", "Negative Quantity = -1 for Ž"))]
    # a file that is read in several parts
    many = [f"{t.upper()} ({k})\n" + "".join(f"- {t} {k} {n}\n" for n in range(400)) for k in range(3) for t in readers.SECTIONS]
    (tmp_path / "long").mkdir()
    (tmp_path / "long" / "d.txt").write_text("".join(many))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        back = readers.read_issue_report(spark, f"{tmp_path}/long")
        rows = back.orderBy("seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.message for r in rows] == [f"{t} {k} {n}" for k in range(3) for t in readers.SECTIONS for n in range(400)]
    assert all(readers.SECTIONS[r.message.rsplit(" ", 2)[0]] == r.category for r in rows)


def test_holdings_round_trip(spark, holdings, tmp_path):
    writers.write_holdings_csv(holdings, f"{tmp_path}/h")
    back = readers.read_holdings_csv(spark, f"{tmp_path}/h")
    assert sorted(map(str, back.collect())) == sorted(map(str, holdings.select(back.columns).collect()))
    writers.write_table(holdings, "brokerage_statement_test")
    assert spark.table("brokerage_statement_test").count() == 6
    spark.sql("DROP TABLE brokerage_statement_test")
    writers.create_database(spark, "statements_test")
    spark.sql("DROP DATABASE statements_test")


def test_reports(spark, statement, holdings, tmp_path):
    issues = validate.find_issues(holdings, parse.stated_totals(statement))
    lines = writers.issue_lines(issues)
    assert lines.first().line == "NEGATIVE VALUES (2)"
    writers.write_text(lines.coalesce(1), f"{tmp_path}/report")
    back = readers.read_issue_report(spark, f"{tmp_path}/report/part-*")
    want = {(r.category, r.message) for r in issues.collect()}
    assert {(r.category, r.message) for r in back.collect()} == want
    ledger = issues.withColumns({"iteration": F.lit(1), "verdict": F.lit("CONFIRMED"), "reason": F.lit("so printed")})
    assert writers.verdict_lines(ledger).first().line.startswith("[CONFIRMED] ")
    writers.append_ledger(ledger, f"{tmp_path}/ledger")
    writers.append_ledger(ledger.withColumn("iteration", F.lit(2)), f"{tmp_path}/ledger")
    assert spark.read.parquet(f"{tmp_path}/ledger").count() == 2 * len(want)


def test_pages(spark, tmp_path):
    def archive(name, files):
        raw = io.BytesIO()
        with zipfile.ZipFile(raw, "w") as z:
            for n, content in files.items():
                z.writestr(n, content)
        (tmp_path / name).write_bytes(raw.getvalue())

    archive("a.pdf", {"p10.png": "ten", "p2.jpg": "two", "x.txt": "no"})  # the content counts, not the name
    archive("b.zip", {"one.png": "1", "two.png": "2", "manifest.json": json.dumps({"pages": [{"image": {"path": "two.png"}}, {"image": {"path": "one.png"}}]})})
    got = [(r.doc_id.rpartition("/")[2], r.page_number, bytes(r.image), r.media_type) for r in readers.read_pages(spark, str(tmp_path)).orderBy("doc_id", "page_number").collect()]
    assert got == [("a.pdf", 1, b"two", "image/jpeg"), ("a.pdf", 2, b"ten", "image/png"), ("b.zip", 1, b"2", "image/png"), ("b.zip", 2, b"1", "image/png")]
    (tmp_path / "c.zip").write_bytes(b"neither")
    with pytest.raises(Exception, match="neither PDF nor ZIP"):
        readers.read_pages(spark, str(tmp_path)).collect()


def test_a_large_archive_is_read_by_several_tasks(spark, tmp_path, monkeypatch):
    with zipfile.ZipFile(tmp_path / "large.zip", "w") as z:
        for n in range(2000):
            z.writestr(f"page_{n}.png", f"image {n}")
    pages = readers.read_pages(spark, str(tmp_path)).withColumn("task", F.spark_partition_id())
    rows = pages.orderBy("page_number").collect()
    assert [(r.page_number, bytes(r.image)) for r in rows] == [(n + 1, f"image {n}".encode()) for n in range(2000)]
    tasks = [r["count"] for r in pages.groupBy("task").count().collect()]
    assert len(tasks) > 10 and max(tasks) <= 8 * readers.RUN_PAGES


def picture(height, width, samples, seed=0):
    import numpy as np

    y, x = np.mgrid[:height, :width]
    waves = [128 + 90 * np.sin(x / (7 + s)) * np.cos(y / (5 + s)) for s in range(samples)]
    return np.stack(waves, -1).astype(np.uint8)


@pytest.mark.parametrize("samples", [1, 2, 3, 4])
def test_png_round_trip(samples):
    import numpy as np

    from tallyspark.sources import images

    pixels = picture(33, 47, samples)
    assert (images.png_pixels(images.png_bytes(pixels)) == pixels).all()
    # every filter, in mixed order, applied pixel by pixel
    rng, step = np.random.default_rng(1), samples
    flat = pixels.reshape(33, -1).astype(int)
    lines = np.zeros((33, flat.shape[1] + 1), np.uint8)
    for r in range(33):
        kind = int(rng.integers(5))
        lines[r, 0] = kind
        for c in range(flat.shape[1]):
            left, up = (flat[r, c - step] if c >= step else 0), (flat[r - 1, c] if r else 0)
            corner = flat[r - 1, c - step] if r and c >= step else 0
            p = left + up - corner
            paeth = min((abs(p - left), 0, left), (abs(p - up), 1, up), (abs(p - corner), 2, corner))[2]
            lines[r, c + 1] = (flat[r, c] - (0, left, up, (left + up) // 2, paeth)[kind]) % 256
    assert (images._unfiltered(lines, step) == flat).all()
    with pytest.raises(ValueError, match="checksum"):
        images.png_pixels(images.png_bytes(pixels)[:60] + b"x" + images.png_bytes(pixels)[61:])


def test_small_depths_and_palettes():
    import struct
    import zlib

    import numpy as np

    from tallyspark.sources import images

    def png(head, lines, **chunks):
        chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
        return images.SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", *head)) + b"".join(chunk(k.encode(), v) for k, v in chunks.items()) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")

    assert images.png_pixels(png((5, 1, 1, 0, 0, 0, 0), b"\0\xa8"))[..., 0].tolist() == [[255, 0, 255, 0, 255]]
    palette = images.png_pixels(png((2, 1, 4, 3, 0, 0, 0), b"\0\x10", PLTE=bytes([1, 2, 3, 4, 5, 6]), tRNS=b"\x80"))
    assert palette.tolist() == [[[4, 5, 6, 255], [1, 2, 3, 128]]]
    assert images.png_pixels(png((1, 1, 16, 0, 0, 0, 0), b"\0\x12\x34")).tolist() == [[[0x12]]]
    assert images.png_pixels(png((1, 1, 8, 0, 0, 0, 1), b"\0\0")) is None and images.png_pixels(b"jpeg") is None
    assert np.array_equal(images.png_pixels(png((2, 1, 8, 2, 0, 0, 0), b"\0abcdef")), np.array([[[97, 98, 99], [100, 101, 102]]]))


def test_images_obey_one_bound(spark, tmp_path):
    import numpy as np

    from tallyspark.sources import images

    flat = np.full((40, 90, 3), 77, np.uint8)
    assert (images.resampled(flat, 31, 17) == 77).all()  # a plain area stays as it is, at the edges too
    smooth = picture(200, 300, 1)
    half = images.resampled(smooth, 150, 100).astype(int)
    means = smooth.reshape(100, 2, 150, 2).mean((1, 3))
    assert np.abs(half[5:-5, 5:-5, 0] - means[5:-5, 5:-5]).max() < 6
    assert images.bounded(4000, 1000, 2048) == (2048, 512) and images.bounded(10, 3000, 100) == (1, 100) and images.bounded(5, 5, 5) == (5, 5)
    with zipfile.ZipFile(tmp_path / "p.zip", "w") as z:
        for name, pixels in (("1.png", picture(60, 240, 3)), ("2.png", picture(30, 20, 1))):
            z.writestr(name, images.png_bytes(pixels))
    got = {r.page_number: images.png_pixels(bytes(r.image)).shape for r in readers.read_pages(spark, str(tmp_path), largest=100).collect()}
    assert got == {1: (25, 100, 3), 2: (30, 20, 1)}


class Reader:
    """A model that is cut off on page 9, and on any batch of more than three pages."""

    def read(self, doc_id, pages):
        numbers = [n for n, _ in pages]
        if 9 in numbers or len(numbers) > 3:
            return "===TABLE_START===\nA|B", "STOP"
        if numbers == [1, 2, 3]:
            return "NO_TABLES_FOUND", "STOP"
        return "===TABLE_START===\nA|B\n" + "\n".join(f"{doc_id}|{n}" for n in numbers) + "\n===TABLE_END===", "STOP"


def test_adaptive_batches(spark):
    pages = spark.createDataFrame([("d", n, b"x", "image/png") for n in range(1, 16)], "doc_id string, page_number int, image binary, media_type string")
    responses, failed = extract.read_batches(pages, Reader())
    seen = [int(line.partition("|")[2]) for r in responses.orderBy("batch_idx").collect() for line in r.text.split("\n") if line.startswith("d|")]
    assert seen == [4, 5, 6, 7, 8, 10, 11, 12, 13, 14, 15]
    assert [tuple(r) for r in failed.collect()] == [("d", "9-9")]
    from tallyspark.operators.tables import parse_responses

    tables = parse_responses(responses)
    row = writers.manifest(pages, responses, tables, failed).first()
    assert (row.total_pages, row.total_tables, row.failed_page_ranges) == (15, tables.count(), ["9-9"]) and row.total_batches == responses.count()


def test_truncation(spark):
    rows = [(None, "", True), ("MAX_TOKENS", "", True), ("OTHER", "x", True), ("STOP", "===TABLE_START===", True), ("STOP", "===TABLE_START=== ===TABLE_END===", False), ("STOP", None, False)]
    df = spark.createDataFrame(rows, "reason string, text string, want boolean")
    assert all(r.want == r.got for r in df.select("want", extract.is_truncated(F.col("reason"), F.col("text")).alias("got")).collect())


def test_issues_of_a_report_are_found_once(spark):
    issues = spark.createDataFrame([("negative_values", "a"), ("negative_values", "b"), ("missing_data", "c")], "category string, message string")
    lines = writers.issue_lines(issues)
    assert lines.inputFiles() and all("told-issues" in f for f in lines.inputFiles())  # counts and bullets are of the stored ones
    assert [r.line for r in lines.collect()] == ["NEGATIVE VALUES (2)", "- a", "- b", "MISSING DATA (1)", "- c"]


def test_prepared_tables_are_stored_and_read_for_all_steps(spark):
    cells = [["Description", "Quantity", "Ending Market Value"], ["Common Stock", "", "--"], ["RED WIDGET (P1)", "(2)", "$1,234.50"], ["PLAIN (no", "n/a", "7"], ["(X) ", "1", "1"], ["Total", "9", "9"]]
    listed = [["Account Type/Name", "Account Number"], ["Doe - Roth IRA", "2-2"], ["Total Portfolio", ""]]
    marker = [["", "This Period"], ["Beginning Account Value", "$1.00"]]
    tables = spark.createDataFrame([("d", 0, listed), ("d", 1, cells), ("d", 2, marker), ("d", 3, cells), (None, 0, cells)], "doc_id string, table_idx int, rows array<array<string>>")
    found = parse.extract_holdings(tables)
    assert found.inputFiles() and all("prepared-tables" in f for f in found.inputFiles())
    rows = sorted((r.doc_id or "", r.table_idx, r.row_idx, r.name, r.symbol, r.asset_class, r.quantity and float(r.quantity), float(r.market_value), r.account) for r in found.collect())
    of = lambda doc, t, account: [(doc, t, 1, "RED WIDGET", "P1", "Equities", -2.0, 1234.5, account), (doc, t, 2, "PLAIN (no", None, "Equities", None, 7.0, account)]
    assert rows == of("", 0, "Unknown Account") + of("d", 1, "Unknown Account") + of("d", 3, "Roth IRA 2-2")
