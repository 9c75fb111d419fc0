"""From model text to clean tables.

A table is one row: doc_id, table_idx, rows (array of arrays of strings, the header first). Statement
tables have tens of rows, so repairs within a table are expressions or small helpers on that one value;
whatever relates tables to each other is a window or a grouping by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cells import unfenced

# -- fixed values: the delimited format and the repair rules' patterns
START, END, NO_TABLES = "===TABLE_START===", "===TABLE_END===", "NO_TABLES_FOUND"
SECTION_HEADINGS = (
    r"^(TOTAL|COMMON STOCK|PREFERRED STOCK|MUTUAL FUNDS?|BOND FUNDS?|SHORT-TERM FUNDS?|EXCHANGE TRADED|STOCKS?|BONDS?|OTHER|"
    r"INVESTMENT ACTIVITY|CASH MANAGEMENT|CONTRIBUTIONS?|DISTRIBUTIONS?|ADDITIONS?|SUBTRACTIONS?|SECURITIES|CHECKING ACTIVITY|"
    r"FEES AND CHARGES|TAXES WITHHELD|GENERAL INVESTMENTS|PERSONAL RETIREMENT|EDUCATION|MARGIN INTEREST|BILL PAYMENTS|DEBIT CARD)\b"
)
STACKED_PAIRS = [
    ("accrued inc", "annual inc", "double"),
    ("est. accrued", "est. annual", "double"),
    ("accrued", "annual", "double"),
    ("ending market", "accrued interest", "single"),
    ("market value", "accrued interest", "single"),
    ("market value", "accrued inc", "single"),
]
LOT_CODES = ("ST", "LT", "MT", "N")
OVERLAP_TAIL, KEY_ROWS = 30, 5

IDENTIFIER = r"(?i)^(?:CUSIP|ISIN|Symbol)\s*:"
DATE_OR_NUMBER = r"(?i)^(?:\d|Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
DATED = r"(?i)\d{1,2}\s+(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)|(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\s+\d{1,2}|\d{4}"
CODE_BEHIND_NUMBER = r"(?i)(?<=[\d)])\s+(?:ST|LT|MT|N)\s*$"
CURRENCY = r"^\$[\d,]+\.\d{2}$"


def blank(cell: Column) -> Column:
    return F.trim(cell).isin("", "--")


# -- text to tables


def split_blocks(responses: DataFrame) -> DataFrame:
    """doc_id, table_idx, rows from model responses (doc_id, batch_idx, text).

    Tables are numbered from 0 by batch and place. Blank lines and rows of empty cells vanish; a block
    without end mark is no table.
    """
    blocks = responses.where((F.col("text") != "") & (F.trim("text") != NO_TABLES)).select("doc_id", "batch_idx", F.posexplode(F.split("text", START)).alias("block_idx", "block"))
    blocks = blocks.where(F.col("block").contains(END))
    body = unfenced(F.trim(F.split("block", END)[0]))
    rows = blocks.select("doc_id", "batch_idx", "block_idx", split_cells(body).alias("rows")).where(F.size("rows") > 0)
    order = Window.partitionBy("doc_id").orderBy("batch_idx", "block_idx")
    return rows.withColumn("table_idx", F.row_number().over(order) - 1).select("doc_id", "table_idx", "rows")


def split_cells(text: Column) -> Column:
    """Rows of trimmed cells out of lines with | between cells."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda line: F.trim(line)), lambda line: line != "")
    rows = F.transform(lines, lambda line: F.transform(F.split(line, r"\|"), lambda c: F.trim(c)))
    return F.filter(rows, lambda row: F.exists(row, lambda c: c != ""))


def drop_pipe_columns(rows: Column) -> Column:
    """Without the empty last, then first, column that outer pipes leave, where every row has it."""
    wide = lambda r: F.forall(r, lambda row: F.size(row) >= 2)
    last = (F.size(rows) >= 2) & wide(rows) & F.forall(rows, lambda row: F.element_at(row, -1) == "")
    rows = F.when(last, F.transform(rows, lambda row: F.slice(row, F.lit(1), F.size(row) - 1))).otherwise(rows)
    first = (F.size(rows) >= 2) & wide(rows) & F.forall(rows, lambda row: F.element_at(row, 1) == "")
    return F.when(first, F.transform(rows, lambda row: F.slice(row, F.lit(2), F.size(row)))).otherwise(rows)


# -- repairs within a table


def _first(row: Column) -> Column:
    return F.coalesce(F.trim(F.try_element_at(row, F.lit(1))), F.lit(""))


def _values(row: Column) -> Column:
    return F.slice(row, F.lit(2), F.size(row))


def _with_last(rows: Column, row: Column) -> Column:
    return F.concat(F.slice(rows, F.lit(1), F.size(rows) - 1), F.array(row))


def merge_continuations(rows: Column) -> Column:
    """Identifier rows and lone first cells, unless headings, are the end of the row above.

    A fold over the data rows; the first of them always stands alone. An identifier row also fills the
    blank cells of the row above with its values."""
    lone = lambda row: (_first(row) != "") & F.forall(_values(row), lambda v: F.trim(v) == "") & ~_first(row).rlike(f"(?i){SECTION_HEADINGS}")

    def completed(above: Column, row: Column) -> Column:
        text = F.when(_first(above) == "", _first(row)).otherwise(F.concat_ws(" ", _first(above), _first(row)))
        reach = F.array_max(F.transform(row, lambda v, i: F.when(blank(v), 0).otherwise(i + 1)))  # up to its last value
        filled = F.zip_with(_values(above), _values(F.slice(row, F.lit(1), reach)), lambda old, new: F.when(new.isNull() | blank(new), F.coalesce(old, F.lit(""))).when(old.isNull() | blank(old), new).otherwise(old))
        return F.concat(F.array(text), F.when(_first(row).rlike(IDENTIFIER), filled).otherwise(_values(above)))

    def step(done: Column, row: Column) -> Column:
        joins = (F.size(done) > 0) & (_first(row).rlike(IDENTIFIER) | lone(row))
        return F.when(joins, _with_last(done, completed(F.element_at(done, -1), row))).otherwise(F.concat(done, F.array(row)))

    return F.concat(F.slice(rows, 1, 1), F.aggregate(_values(rows), F.array().cast("array<array<string>>"), step))


def merge_split_securities(rows: Column) -> Column:
    """A row that begins like the one above, and is empty or has borrowed its values, only completes
    the description; its values are dropped.

    A fold, since what stands above grows: rows begin alike if their first three words agree."""
    words = lambda text: F.filter(F.split(text, r"\s+"), lambda w: w != "")
    leading = lambda text: F.slice(F.regexp_extract_all(F.upper(text), F.lit("[A-Z0-9]+"), 0), 1, 3)

    def absorbed(above: Column, row: Column) -> Column:
        known, own = words(F.upper(_first(above))), words(_first(row))
        same = F.transform(own, lambda w, k: F.coalesce(F.get(known, k) == F.upper(w), F.lit(False)))
        other = F.array_position(same, False).cast("int")
        rest = F.when(other > 0, F.array_join(F.slice(own, other, F.size(own)), " ")).otherwise("")
        adds = (rest != "") & ~F.upper(_first(above)).contains(F.upper(rest))
        return F.when(adds, F.concat(F.array(F.concat_ws(" ", _first(above), rest)), _values(above))).otherwise(above)

    def step(done: Column, row: Column) -> Column:
        above = F.element_at(done, -1)
        alike = (_first(row) != "") & (leading(_first(row)) == leading(_first(above))) & (F.upper(_first(row)) != F.upper(_first(above)))
        empty = F.forall(_values(row), lambda v: F.trim(v) == "")
        borrowed = F.exists(_values(above), lambda v: ~blank(v)) & ~_first(row).rlike(DATE_OR_NUMBER)
        joins = (F.size(done) > 0) & alike & (empty | borrowed)
        return F.when(joins, _with_last(done, absorbed(above, row))).otherwise(F.concat(done, F.array(row)))

    return F.concat(F.slice(rows, 1, 1), F.aggregate(_values(rows), F.array().cast("array<array<string>>"), step))


def strip_lot_codes(rows: Column) -> Column:
    """Data rows without holding-period codes: Ns behind a date make way for the cells after them, a
    code on its own leaves an empty cell, a code behind a number goes."""
    def row_of(row: Column) -> Column:
        code = lambda c: F.upper(F.trim(c)) == "N"
        before = lambda i: F.try_element_at(F.filter(F.slice(row, F.lit(1), i), lambda c: ~code(c)), F.lit(-1))
        kept = F.filter(row, lambda c, i: ~((i > 0) & code(c) & F.coalesce(before(i).rlike(DATED), F.lit(False))))
        padded = F.concat(kept, F.array_repeat(F.lit(""), F.size(row) - F.size(kept)))
        clean = lambda c: F.when(F.upper(F.trim(c)).isin(*LOT_CODES), "").otherwise(F.trim(F.regexp_replace(F.trim(c), CODE_BEHIND_NUMBER, "")))
        return F.transform(padded, lambda c, i: F.when(i == 0, c).otherwise(clean(c)))

    return F.transform(rows, lambda row, k: F.when(k == 0, row).otherwise(row_of(row)))


def stacked_pairs(header: Column) -> Column:
    """Places (from 0) of neighbouring columns that statements print one above the other, and of which kind."""
    names = F.transform(header, lambda h: F.lower(F.trim(h)))
    kind = lambda a, b: F.coalesce(*(F.when(a.contains(one) & b.contains(two), k) for one, two, k in STACKED_PAIRS))
    pairs = F.transform(names, lambda h, i: F.struct(i.alias("at"), kind(h, F.get(names, i + 1)).alias("kind")))
    return F.filter(pairs, lambda p: p["kind"].isNotNull())


def fix_stacked_pairs(rows: Column) -> Column:
    """Values of stacked columns back under their headers; shifted totals back under market value.

    Tables without such columns stay as they are. Per pair of places, in order: of a double pair the
    second value moves left into a dash's place, or the dash before a value goes; of a single pair the
    first column gets the one value there is."""
    header = F.element_at(rows, 1)
    pairs = stacked_pairs(header)
    market = F.greatest(F.array_position(F.transform(header, lambda h: F.lower(h).contains("market") & F.lower(h).contains("value")), True) - 1, F.lit(0)).cast("int")
    widest = F.element_at(pairs, -1)["at"] + 3
    blanks = lambda n: F.array_repeat(F.lit(""), F.greatest(n, F.lit(0)).cast("int"))

    def shifted(row: Column) -> Column:
        early = F.array_position(F.transform(row, lambda c, i: (i >= 2) & (i < market) & F.trim(c).rlike(CURRENCY)), True).cast("int") - 1
        moved = F.concat(F.slice(row, F.lit(1), early), blanks(market - early), F.slice(row, early + 1, F.size(row)))
        return F.when(F.upper(_first(row)).startswith("TOTAL") & (early >= 0), moved).otherwise(row)

    def placed(row: Column, pair: Column) -> Column:
        at = pair["at"]
        one, two, over = (F.trim(F.get(row, at + k)) for k in range(3))
        dash_first = (pair["kind"] == "double") & (one == "--") & ~blank(two)
        dash_second = (pair["kind"] == "double") & ~dash_first & (two == "--") & ~blank(over)
        single = (pair["kind"] == "single") & ~blank(two)
        new_one = F.when(dash_first, "").when(single & blank(one), two).otherwise(F.get(row, at))
        new_two = F.when(dash_second, over).when(single, "").otherwise(F.get(row, at + 1))
        new_over = F.when(dash_second, "").otherwise(F.get(row, at + 2))
        return F.transform(row, lambda c, i: F.when(i == at, new_one).when(i == at + 1, new_two).when(i == at + 2, new_over).otherwise(c))

    def fixed(row: Column) -> Column:
        wide = F.concat(shifted(row), blanks(widest - F.size(shifted(row))))
        return F.slice(F.aggregate(pairs, wide, placed), F.lit(1), F.size(header))

    fixes = F.concat(F.slice(rows, 1, 1), F.transform(_values(rows), fixed))
    return F.when((F.size(rows) > 1) & (F.size(pairs) > 0), fixes).otherwise(rows)


def parse_responses(responses: DataFrame) -> DataFrame:
    """Model responses to repaired tables: split, outer pipes, continuations, split securities, codes,
    stacked columns, in this order."""
    tables = split_blocks(responses)
    for repair in (drop_pipe_columns, merge_continuations, merge_split_securities, strip_lot_codes, fix_stacked_pairs):
        tables = tables.withColumn("rows", repair(F.col("rows")))
    return tables


# -- relations between tables


def row_fingerprint(row: Column) -> Column:
    """What tells a row apart: its cells with digits behind the start of its label, else all its text."""
    numeric = F.transform(F.filter(row, lambda c: c.rlike(r"\d")), lambda c: F.lower(F.regexp_replace(c, r"\s+", "")))
    label = F.substring(F.regexp_replace(F.lower(F.trim(F.try_element_at(row, F.lit(1)))), r"\s+", " "), 1, 20)
    folded = F.transform(row, lambda c: F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), "[-–—]+", "-"), r"\s+", " "))
    return F.when(F.size(numeric) > 0, F.concat(label, F.lit("|"), F.array_join(numeric, "|"))).otherwise(F.array_join(F.filter(folded, lambda c: c != ""), "||"))


def header_key(rows: Column) -> Column:
    return F.array_join(F.transform(F.element_at(rows, 1), lambda h: F.lower(F.trim(h))), "\x1f")


def _repeated(fingerprints: list[str], tail, safe: bool) -> int:
    """How many of a table's first rows repeat what ``tail`` has."""
    known, n = set(tail), 0
    for k, fingerprint in enumerate(fingerprints, 1):
        if fingerprint in known:
            n = k
        elif safe:
            break
    return n


def _trimmed(safe: bool):
    """Tables as they come, by island and place, without the rows that repeat the island's last OVERLAP_TAIL."""

    def run(batches):
        from collections import deque

        import pyarrow as pa

        island, tail = None, deque(maxlen=OVERLAP_TAIL)
        for batch in batches:
            skipped = []
            for doc, nth, prints in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "__island", "__prints")), strict=True):
                if (doc, nth) != island:
                    island, n = (doc, nth), 0
                    tail.clear()
                else:
                    n = _repeated(prints, tail, safe)
                tail.extend(prints[n:])
                skipped.append(n)
            yield batch.drop_columns(["__prints"]).append_column("__skipped", pa.array(skipped, pa.int32()))

    return run


def merge_shared_headers(tables: DataFrame, safe: bool = True) -> DataFrame:
    """Neighbouring tables of a document with one header, each with data, as one table.

    Islands come from the previous table's header. An island's tables pass a task in order, which keeps the fingerprints of the
    last OVERLAP_TAIL rows and says how many rows of each table are repeats: those up to the last one that is among
    these. With ``safe``, only an unbroken run of repeats from the table's start is taken for repeats, so no
    row is lost. What is left is then put together at once.
    """
    order = Window.partitionBy("doc_id").orderBy("table_idx")
    keyed = tables.withColumns({"__key": header_key(F.col("rows")), "__data": F.size("rows") > 1})
    joins = (F.col("__key") == F.lag("__key").over(order)) & F.col("__data") & F.lag("__data").over(order) & (F.col("__key") != "")
    keyed = keyed.withColumn("__joins", F.coalesce(joins, F.lit(False)))
    keyed = keyed.withColumn("__island", F.sum(F.when(F.col("__joins"), 0).otherwise(1)).over(order))
    data = F.slice("rows", F.lit(2), F.size("rows"))
    rows = keyed.select("doc_id", "__island", "table_idx", "__joins", "rows", F.transform(data, row_fingerprint).alias("__prints"))
    dealt = rows.repartition("doc_id", "__island").sortWithinPartitions("doc_id", "__island", "table_idx")
    kind = tables.schema["doc_id"].dataType.simpleString()
    index = tables.schema["table_idx"].dataType.simpleString()
    trimmed = dealt.mapInArrow(_trimmed(safe), f"doc_id {kind}, __island bigint, table_idx {index}, __joins boolean, rows array<array<string>>, __skipped int")
    left = F.when(F.col("__joins"), F.slice("rows", F.col("__skipped") + 2, F.size("rows"))).otherwise(F.col("rows"))
    parts = trimmed.select("doc_id", "__island", F.struct("table_idx", left.alias("rows")).alias("part")).groupBy("doc_id", "__island").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    return parts.select("doc_id", F.col("parts")[0]["table_idx"].alias("table_idx"), F.flatten(F.col("parts")["rows"]).alias("rows"))


def drop_repeated_tables(tables: DataFrame) -> DataFrame:
    """Of tables of a document whose first data rows agree, the last; tables without data all stay."""
    data = F.slice("rows", F.lit(2), F.lit(KEY_ROWS))
    keyed = tables.withColumn("__fp", F.array_join(F.transform(data, row_fingerprint), "|||"))
    last = F.row_number().over(Window.partitionBy("doc_id", "__fp").orderBy(F.desc("table_idx")))
    return keyed.withColumn("__n", last).where("__n = 1 or __fp = ''").select(*tables.columns)


def renumbered(tables: DataFrame) -> DataFrame:
    """table_idx without gaps."""
    order = Window.partitionBy("doc_id").orderBy("table_idx")
    return tables.withColumn("table_idx", F.row_number().over(order) - 1)


def padded(rows: Column) -> Column:
    """All rows as wide as the widest, for CSV."""
    width = F.aggregate(rows, F.lit(0), lambda n, row: F.greatest(n, F.size(row)))
    return F.transform(rows, lambda row: F.concat(row, F.array_repeat(F.lit(""), width - F.size(row))))
