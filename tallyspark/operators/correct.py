"""Verdicts of a model on issues, corrections by them, and the loop around both."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cells as X
from ..storage import stored
from .matching import match_names, reassigned
from .validate import TOLERANCE, find_issues, revalidated

# fixed values: verdicts
CONFIRMED, FALSE_POSITIVE, NEEDS_REVIEW, RESOLVED = "CONFIRMED", "FALSE POSITIVE", "NEEDS REVIEW", "RESOLVED"
TRUE_MISMATCH, BAD_TOTAL, VALUES_INCORRECT = "CONFIRMED TRUE MISMATCH", "BAD TOTAL PARSE", "VALUES INCORRECT"
VERDICT_ORDER = (CONFIRMED, FALSE_POSITIVE, RESOLVED, TRUE_MISMATCH, BAD_TOTAL, VALUES_INCORRECT, NEEDS_REVIEW)

FRAGMENT = 40
#: Issues that one call of a model gets.
PER_CALL = 50
ANSWER = "array<struct<issue_id:string,verdict:string,reason:string,corrected_symbol:string,corrected_cost_basis:string,corrected_value:string,account_type:string,account_number:string,pdf_total:string,total_ok:boolean,checks_ok:boolean,phase1_corrections:array<struct<name:string,parsed_value:string,pdf_value:string,match:boolean,corrected_value:string>>>>"
_FIELDS = {"negative_values": "corrected_value", "missing_data": "corrected_cost_basis", "missing_symbol": "corrected_symbol"}


class ModelClient(Protocol):
    """What checks issues against the source. It must be picklable; tasks call it."""

    def verify(self, category: str, issues: list[dict]) -> str:
        """JSON array with an object for each issue (issue_id, verdict, reason, corrected values).

        Issues hold issue_id, message, expected, calculated (mismatches) and holdings (JSON: the issue's
        holding; mismatches of one table come together, the first with all of the table's). For a
        mismatch, total_ok with pdf_total (the total as read) and checks_ok with phase1_corrections (holdings
        spot-checked) may take the verdict's place.
        """


# -- verdicts


_ASKED = ("issue_id", "message", "expected", "calculated")
_SHOWN = ("holding_id", "name", "symbol", "account", "quantity", "cost_basis", "market_value", "unrealized_gl", "est_annual_income")


def with_holdings(issues: DataFrame, holdings: DataFrame) -> DataFrame:
    """issues but those of tables' totals, with ``holdings``: what the model needs to know of the issue's holding, as a JSON
    array of one."""
    shown = F.to_json(F.array(F.struct(*_SHOWN))).alias("holdings")
    return issues.where("holding_id is not null or category <> 'total_mismatches'").join(holdings.select("holding_id", shown), "holding_id", "left")


def of_tables(issues: DataFrame, holdings: DataFrame) -> DataFrame:
    """doc_id, table_idx, issues, holdings: issues of totals by table, so a table's holdings (tens of rows) are sent once for
    all its fields."""
    keys = ["doc_id", "table_idx"]
    asked = issues.where("holding_id is null and category = 'total_mismatches'")
    if not {*keys} <= {*issues.columns}:
        return issues.sparkSession.createDataFrame([], "doc_id string, table_idx int, issues array<struct<issue_id:string>>, holdings string")
    rows = asked.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*_asked(asked)))).alias("issues"))
    tables = holdings.join(rows.select(*keys), keys, "left_semi").groupBy(*keys).agg(F.to_json(F.array_sort(F.collect_list(F.struct(*_SHOWN)))).alias("holdings"))
    return rows.join(tables, keys, "left")


def _asked(issues: DataFrame) -> list[Column]:
    return [(F.col(c) if c in issues.columns else F.lit(None)).cast("string").alias(c) for c in _ASKED]


def verify(issues: DataFrame, client: ModelClient, holdings: DataFrame | None = None) -> DataFrame:
    """issues with the model's verdict and corrections. Bad or missing answers mean NEEDS REVIEW.

    A category's issues are dealt by hash into calls of about PER_CALL. Store the result before using
    it twice: a second evaluation would call the model again.
    """
    alone = issues.withColumn("holdings", F.lit(None).cast("string")) if holdings is None else with_holdings(issues, holdings)
    sizes = alone.groupBy("category").agg(F.ceil(F.count("*") / PER_CALL).alias("__calls"))
    dealt = alone.join(F.broadcast(sizes), "category").withColumn("__call", F.pmod(F.xxhash64("issue_id"), F.col("__calls")))  # a row per category
    names = [*_ASKED, "holdings"]

    def ask(pdf):
        import pandas as pd

        rows = pdf[names].astype(object).where(pdf[names].notna(), None).to_dict("records")
        return pd.DataFrame({"answer": [client.verify(pdf["category"].iloc[0], rows)]})

    answers = dealt.select("category", "__call", *_asked(alone), "holdings").groupBy("category", "__call").applyInPandas(ask, "answer string")
    if holdings is not None:
        answers = answers.unionByName(of_tables(issues, holdings).mapInPandas(_ask_of_tables(client), "answer string"))
    parsed = answers.select(F.explode(F.from_json(X.unfenced(F.col("answer")), ANSWER)).alias("a")).select("a.*").dropDuplicates(["issue_id"])
    judged = issues.join(parsed, "issue_id", "left")
    verdict = known_verdict(F.col("category"), F.col("verdict"))
    if "expected" in issues.columns:
        wrong = F.filter("phase1_corrections", lambda c: c["corrected_value"].isNotNull())
        steps = (F.col("category") == "total_mismatches") & F.coalesce("total_ok", "checks_ok").isNotNull()
        verdict = F.when(steps, mismatch_verdict(_amount(F.col("pdf_total")), F.col("total_ok"), F.col("checks_ok"), wrong, F.col("expected"))).otherwise(verdict)
    return judged.withColumn("verdict", verdict)


def _ask_of_tables(client: ModelClient):
    """A call for each table; only its first issue carries the holdings."""

    def run(frames):
        import pandas as pd

        for frame in frames:
            for issues, held in zip(frame["issues"], frame["holdings"], strict=True):
                rows = [dict(i.asDict() if hasattr(i, "asDict") else i) for i in issues]
                rows = [r | {"holdings": held if k == 0 else None} for k, r in enumerate(rows)]
                yield pd.DataFrame({"answer": [client.verify("total_mismatches", rows)]})

    return run


def known_verdict(category: Column, verdict: Column) -> Column:
    v = F.upper(F.trim(verdict))
    allowed = F.when(category == "total_mismatches", v.isin(TRUE_MISMATCH, BAD_TOTAL, VALUES_INCORRECT)).when(category == "missing_account", v.isin(RESOLVED, CONFIRMED)).otherwise(v.isin(CONFIRMED, FALSE_POSITIVE))
    return F.when(allowed, v).otherwise(NEEDS_REVIEW)


def mismatch_verdict(read_total: Column, total_ok: Column, checks_ok: Column, corrections: Column, expected: Column) -> Column:
    """From reading the stated total and spot-checking the holdings: wrong holdings come first, then a
    total that was read as expected, else the total was misread."""
    review = ~F.coalesce(checks_ok, F.lit(False))
    incorrect = F.coalesce(F.size(corrections), F.lit(0)) > 0
    right = F.abs(read_total - expected) <= 1
    total_ok = total_ok & read_total.isNotNull()
    return F.when(review, NEEDS_REVIEW).when(incorrect, VALUES_INCORRECT).when(~F.coalesce(total_ok, F.lit(False)), NEEDS_REVIEW).when(right, TRUE_MISMATCH).otherwise(BAD_TOTAL)


def verdict_counts(verdicts: DataFrame) -> DataFrame:
    return verdicts.groupBy("category").agg(*(F.count(F.when(F.col("verdict") == v, 1)).alias(v) for v in VERDICT_ORDER))


# -- corrections


def _amount(raw: Column) -> Column:
    return F.regexp_replace(raw, "[$,]", "").try_cast("decimal(20,6)")


def proposed_changes(verdicts: DataFrame, holdings: DataFrame) -> DataFrame:
    """issue_id, seq, doc_id, table_idx, holding_id, security, column, new_value (as text), status of each correctable verdict.

    Issues that name a holding change that one; corrections of a mismatch change the holdings of the
    issue's table whose name contains theirs. Changes that match no holding, or aren't numbers, fail.
    """
    order = F.array_position(F.array(*map(F.lit, ("negative_values", "missing_symbol", "missing_data", "missing_account", "total_mismatches"))), F.col("category"))
    by_category = F.coalesce(*(F.when(F.col("category") == c, F.col(v)) for c, v in _FIELDS.items()))
    plain = verdicts.where((F.col("verdict") == FALSE_POSITIVE) & F.col("category").isin(*_FIELDS))
    column = F.when(F.col("category") == "missing_symbol", "symbol").when(F.col("category") == "missing_data", "cost_basis").otherwise(F.col("field"))
    value = F.when(F.col("category") == "missing_symbol", F.trim(by_category)).when(F.col("category") == "negative_values", F.abs(_amount(by_category)).cast("string")).otherwise(_amount(by_category).cast("string"))
    plain = plain.where(by_category.isNotNull()).select("issue_id", order.alias("seq"), "doc_id", "table_idx", "holding_id", F.col("name").alias("security"), column.alias("column"), value.alias("new_value"))

    resolved = verdicts.where((F.col("verdict") == RESOLVED) & (F.col("category") == "missing_account") & (F.col("account_type") != "") & (F.col("account_number") != ""))
    new = F.array(F.struct(F.lit("account").alias("column"), F.concat_ws(" ", "account_type", "account_number").alias("new_value")), F.struct(F.lit("account_type").alias("column"), X.account_type(F.col("account_type")).alias("new_value")))
    accounts = resolved.select("issue_id", order.alias("seq"), "doc_id", "table_idx", "holding_id", F.col("name").alias("security"), F.explode(new).alias("n")).select("issue_id", "seq", "doc_id", "table_idx", "holding_id", "security", "n.column", "n.new_value")

    wrong = verdicts.where((F.col("verdict") == VALUES_INCORRECT) & (F.col("category") == "total_mismatches"))
    wrong = wrong.select("issue_id", order.alias("seq"), "doc_id", "table_idx", "field", F.posexplode("phase1_corrections").alias("k", "c")).where("c.name <> '' and c.corrected_value is not null")
    fragments = wrong.select(F.concat_ws("-", "issue_id", "k").alias("fragment_id"), F.trim(F.substring("c.name", 1, FRAGMENT)).alias("fragment"), "*")
    matched = match_names(fragments.select("fragment_id", "fragment", "doc_id", "table_idx"), holdings, ("doc_id", "table_idx")).select("fragment_id", "holding_id")
    mismatches = fragments.join(matched, "fragment_id", "left").select("issue_id", "seq", "doc_id", "table_idx", "holding_id", F.col("c.name").alias("security"), F.col("field").alias("column"), _amount(F.col("c.corrected_value")).cast("string").alias("new_value"))

    status = F.when(F.col("holding_id").isNull(), "FAILED — no row matched").when(F.col("new_value").isNull(), "FAILED — value not numeric").otherwise("APPLIED")
    return plain.unionByName(accounts).unionByName(mismatches).withColumn("status", status)


def apply_changes(holdings: DataFrame, changes: DataFrame) -> DataFrame:
    """holdings with the last applied change, by seq and issue, of each of their columns."""
    last = changes.where("status = 'APPLIED'").groupBy("holding_id").pivot("column", ["symbol", "quantity", "cost_basis", "market_value", "unrealized_gl", "est_annual_income", "account", "account_type"]).agg(F.max_by("new_value", F.struct("seq", "issue_id")))
    new = {c: F.coalesce(F.col(f"__new.{c}").try_cast(holdings.schema[c].dataType), F.col(f"__old.{c}")).alias(c) for c in last.columns if c != "holding_id"}
    joined = holdings.alias("__old").join(last.alias("__new"), F.col("__old.holding_id") == F.col("__new.holding_id"), "left")
    return joined.select(*(new.get(c, F.col(f"__old.{c}")) for c in holdings.columns))


def change_log(holdings: DataFrame, changes: DataFrame) -> DataFrame:
    """changes with old_value: what the cell held before, other changes of this round included."""
    names = ["symbol", "quantity", "cost_basis", "market_value", "unrealized_gl", "est_annual_income", "account", "account_type"]
    cells = holdings.select("holding_id", *(F.col(c).alias(f"__{c}") for c in names))
    before = changes.join(cells, "holding_id", "left").withColumn("__cell", F.coalesce(*(F.when(F.col("column") == c, F.col(f"__{c}").cast("string")) for c in names)))
    order = Window.partitionBy("holding_id", "column").orderBy("seq", "issue_id")
    old = F.when(F.col("status") == "APPLIED", F.coalesce(F.lag("new_value").over(order), "__cell"))
    return before.select(*changes.columns, "__cell").withColumn("old_value", old).drop("__cell")


def resolved_issues(verdicts: DataFrame, changes: DataFrame) -> DataFrame:
    """issue_id of what needn't be looked at again: confirmed issues, and corrected ones of which a
    change was applied."""
    settled = verdicts.where(F.col("verdict").isin(CONFIRMED, TRUE_MISMATCH, BAD_TOTAL)).select("issue_id")
    return settled.union(changes.where("status = 'APPLIED'").select("issue_id")).distinct()


def unresolved(issues: DataFrame, resolved: DataFrame) -> DataFrame:
    return issues.join(resolved, "issue_id", "left_anti")


def final_disposition(ledger: DataFrame) -> DataFrame:
    """issue_id, message, verdict: each issue's last verdict, in the order of verdicts."""
    last = ledger.groupBy("issue_id").agg(F.max_by(F.struct("message", "verdict"), "iteration").alias("l")).select("issue_id", "l.message", "l.verdict")
    return last.orderBy(F.array_position(F.array(*map(F.lit, VERDICT_ORDER)), F.col("verdict")), "message")


#: Parts of the documents: a round reads those in which something has changed.
BUCKETS = 64


def in_buckets(df: DataFrame, label: str, buckets: int = BUCKETS) -> DataFrame:
    """``df`` stored in folders by a hash of doc_id, which readers can leave out; large ones in several files."""
    dealt = df.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int"))
    return stored(dealt.hint("rebalance", "bucket"), label, "bucket")


def self_correct(holdings: DataFrame, totals: DataFrame, client: ModelClient, iterations: int = 3, tolerance: float = TOLERANCE, sources: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Corrected holdings, the ledger of verdicts and the log of changes, both with iteration.

    A round asks about the issues that aren't resolved, applies corrections and finds anew the issues of the holdings and
    tables that these touch; all others stay as they were. Holdings, totals and issues lie in buckets of documents, and
    only buckets with a change are read and written again. The loop ends without open issues, without changes, or after
    ``iterations`` rounds. Each round's tables are stored, so the model is asked once.

    With ``sources`` (doc_id, table_idx, row_idx, name of the tables' rows) totals are held against the holdings that a table's
    rows name by their first 60 characters, in whatever table they are; corrections don't change names, so the holdings
    are looked up once.
    """
    columns = holdings.columns
    state, totals = in_buckets(holdings, "holdings"), in_buckets(totals, "totals")
    members = None if sources is None else in_buckets(reassigned(sources, state), "members")
    issues = in_buckets(find_issues(state, totals, tolerance, members=members), "issues")
    ledger = log = resolved = None
    for n in range(1, iterations + 1):
        asked = issues.drop("bucket") if resolved is None else unresolved(issues.drop("bucket"), resolved)
        verdicts = stored(verify(asked, client, state).withColumn("iteration", F.lit(n)), "verdicts")
        if verdicts.isEmpty():
            break
        proposed = stored(proposed_changes(verdicts, state), "proposed")
        touched = proposed.where("status = 'APPLIED'").select("doc_id", "table_idx", "holding_id").distinct()
        bucket = F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)).cast("int")
        changed = sorted(r[0] for r in touched.select(bucket).distinct().collect())  # BUCKETS rows at most
        inside = F.col("bucket").isin(changed) if changed else F.lit(False)
        changes = stored(change_log(state.where(inside), proposed).withColumn("iteration", F.lit(n)), "changes")
        ledger = verdicts if ledger is None else ledger.unionByName(verdicts)
        log = changes if log is None else log.unionByName(changes)
        done = resolved_issues(verdicts, changes)
        resolved = stored(done if resolved is None else resolved.union(done), "resolved")
        if not changed:
            break
        fixed = in_buckets(apply_changes(state.where(inside), changes).drop("bucket"), "holdings")
        state = state.where(~inside).unionByName(fixed)
        if n < iterations:
            own = None if members is None else members.where(inside)
            again = revalidated(issues.where(inside).drop("bucket"), fixed, totals.where(inside), touched, tolerance, own)
            issues = issues.where(~inside).unionByName(in_buckets(again, "issues"), allowMissingColumns=True)
    if ledger is None:
        ledger = verdicts
        log = change_log(state, proposed_changes(verdicts, state)).withColumn("iteration", F.lit(0))
    return state.select(columns), ledger, log
