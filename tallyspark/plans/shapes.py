"""Tables of many shapes for the repairs: each part has one of a repair's shapes, by its key.

A shape is a table's text, rows by line and cells by |, and what the repair makes of it; {b} is the part's brand, {s} its
size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import tables
from ..schema import table
from ..storage import spread

Shapes = list[tuple[str, str]]
SAME = ""  # the repair leaves the table as it is

PIPES: Shapes = [
    ("|Name|Size|\n|{b}|{s}|", "Name|Size\n{b}|{s}"),
    ("Name|Size|\n{b}|{s}|", "Name|Size\n{b}|{s}"),
    ("|Name|Size\n|{b}|{s}", "Name|Size\n{b}|{s}"),
    ("Name|Size|\n{b}|{s}|x", SAME),
    ("|Name||\n|{b}||", "Name|\n{b}|"),
    ("|{b}|", SAME),
    ("|Name|\n{s}", SAME),
    ("Name|\n|{b}\n{s}|", SAME),
]
CONTINUATIONS: Shapes = [
    ("D|Q|V\n{b}|--|\nCUSIP: 1|{s}|7", "D|Q|V\n{b} CUSIP: 1|{s}|7"),
    ("D|Q|V\n{b}|1\nISIN: X|2|{s}|--", "D|Q|V\n{b} ISIN: X|1|{s}"),
    ("D|Q|V\n{b}|1|2\nmore {s}||", "D|Q|V\n{b} more {s}|1|2"),
    ("D|Q|V\n{b}|1|2\nTotal {s}||", SAME),
    ("D|Q|V\nCUSIP: {s}||\n{b}|1|2", SAME),
    ("D|Q|V\n{b}|1|2\nmore {s}|--|", SAME),
    ("D|Q|V\n{b}|1|2\nword {s}", "D|Q|V\n{b} word {s}|1|2"),
    ("D|Q|V\n{b}||\nsymbol : ab|{s}|", "D|Q|V\n{b} symbol : ab|{s}|"),
    ("D|Q|V\n{b}|1|2\nBOND FUNDS||\nof {s}||\n{b}|3|4", "D|Q|V\n{b}|1|2\nBOND FUNDS of {s}||\n{b}|3|4"),
    ("D|Q|V\n|1|2\nISIN: {s}||", "D|Q|V\nISIN: {s}|1|2"),
]
SECURITIES: Shapes = [
    ("D|Q|V\nACME CORP NEW {b}|1|2\nACME CORP NEW CLASS A||", "D|Q|V\nACME CORP NEW {b} CLASS A|1|2"),
    ("D|Q|V\nACME CORP NEW {b}|1|2\nACME CORP NEW CLASS A|1|{s}", "D|Q|V\nACME CORP NEW {b} CLASS A|1|2"),
    ("D|Q|V\nACME CORP NEW CLASS A {b}|1|2\nACME CORP NEW CLASS A||", "D|Q|V\nACME CORP NEW CLASS A {b}|1|2"),
    ("D|Q|V\nACME CORP NEW {b} CLASS A|1|2\nACME CORP NEW CLASS A||", "D|Q|V\nACME CORP NEW {b} CLASS A|1|2"),
    ("D|Q|V\nACME CORP NEW {b}|1|2\nacme corp new {b}|3|4", SAME),
    ("D|Q|V\n12 CORP NEW {b}|1|2\n12 CORP NEW A|3|4", SAME),
    ("D|Q|V\n12 CORP NEW {b}|1|2\n12 CORP NEW A|--|--", SAME),
    ("D|Q|V\n12 CORP NEW {b}|1|2\n12 CORP NEW XTRA||", "D|Q|V\n12 CORP NEW {b} XTRA|1|2"),
    ("D|Q|V\nACME CORP NEW {b}|1|2\nACME CORP NEW A||", "D|Q|V\nACME CORP NEW {b}|1|2"),
    ("D|Q|V\nACME CORP NEW {b}||--\nACME CORP NEW CLASS A|3|{s}", SAME),
    ("D|Q|V\nBETA {b}|3|4\nACME {b}|1|", SAME),
    ("D|Q|V\nACME CORP NEW {b}|1|2\nACME CORP NEW XTRA||\nACME CORP NEW YOLK|9|9", "D|Q|V\nACME CORP NEW {b} XTRA YOLK|1|2"),
]
CODES: Shapes = [
    ("D|Date|N|V\n{b}|03 Feb 2021|N|{s}", "D|Date|N|V\n{b}|03 Feb 2021|{s}|"),
    ("D|Date|N|V\n{b}|x|ST|{s} LT", "D|Date|N|V\n{b}|x||{s}"),
    ("D|Date|N|V\n{b}|x|N|{s}", "D|Date|N|V\n{b}|x||{s}"),
    ("D|Date|N|V\n{b}|(12.5) MT|n|{s}", "D|Date|N|V\n{b}|(12.5)||{s}"),
    ("D|Date|N|V\nST|2021|lt|{s}N", "D|Date|N|V\nST|2021||{s}N"),
    ("D|Date|N|V\n{b}|Mar 5|N|N", "D|Date|N|V\n{b}|Mar 5||"),
    ("D|Date|N|V|W\n{b}|Mar 5|N|n|{s}", "D|Date|N|V|W\n{b}|Mar 5|{s}||"),
    ("D|Date|N|V\n2020 {b}|N|{s}|5 dec", "D|Date|N|V\n2020 {b}|{s}|5 dec|"),
    ("N|LT|ST\n{b}|ST {s}|MT", "N|LT|ST\n{b}|ST {s}|"),
]
PAIRS: Shapes = [
    ("D|Est. Accrued Inc.|Est. Annual Inc.\n{b}|--|{s}", "D|Est. Accrued Inc.|Est. Annual Inc.\n{b}||{s}"),
    ("D|Est. Accrued Inc.|Est. Annual Inc.\n{b}|3|--|{s}", "D|Est. Accrued Inc.|Est. Annual Inc.\n{b}|3|{s}"),
    ("D|Est. Accrued Inc.|Est. Annual Inc.\n{b}|1|{s}", SAME),
    ("D|Est. Accrued Inc.|Est. Annual Inc.\n{b}|--|--|{s}", "D|Est. Accrued Inc.|Est. Annual Inc.\n{b}|--|{s}"),
    ("D|Qty|Ending Market Value|Accrued Interest (AI)|Cost\n{b}|1|{s}|4|5", "D|Qty|Ending Market Value|Accrued Interest (AI)|Cost\n{b}|1|{s}||5"),
    ("D|Qty|Ending Market Value|Accrued Interest (AI)|Cost\n{b}|1|--|{s}|5", "D|Qty|Ending Market Value|Accrued Interest (AI)|Cost\n{b}|1|{s}||5"),
    ("D|Qty|Ending Market Value|Accrued Interest (AI)|Cost\n{b}|1|{s}|--|5", SAME),
    ("D|Qty|Price|Ending Market Value|Accrued Interest (AI)|Cost\nTotal {b}||$5.00|$1.00", "D|Qty|Price|Ending Market Value|Accrued Interest (AI)|Cost\nTotal {b}|||$5.00||"),
    ("D|Qty|Price|Ending Market Value|Accrued Interest (AI)|Cost\nTOTAL {b}||5.00||{s}|", "D|Qty|Price|Ending Market Value|Accrued Interest (AI)|Cost\nTOTAL {b}||5.00|{s}||"),
    ("D|Q\n{b}|{s}|x", SAME),
    ("D|Market Value|Accrued Int.\n{b}", SAME),
    ("D|Market Value|Accrued Inc.\n{b}", "D|Market Value|Accrued Inc.\n{b}||"),
]
#: Whole answers; what becomes of them is given as tables, one after another, with a line of = between.
ANSWERS: Shapes = [
    ("===TABLE_START===\n```\n|D|Q|V|\n|{b}|--||\n|CUSIP: 1|{s}|7|\n```\n===TABLE_END===", "D|Q|V\n{b} CUSIP: 1|{s}|7"),
    ("text\n===TABLE_START===\nD|Date|N|V\n\n{b}|03 Feb 2021|N|{s}\n===TABLE_END===\n===TABLE_START===\nA | B\n{b}|{s}\n===TABLE_END===\n===TABLE_START===\nA|B", "D|Date|N|V\n{b}|03 Feb 2021|{s}|\n=\nA|B\n{b}|{s}"),
    ("===TABLE_START===\nD|Q|V\nACME CORP NEW {b}|1|2 LT\nCUSIP: 7||\nACME CORP NEW A||\n===TABLE_END===", "D|Q|V\nACME CORP NEW {b} CUSIP: 7 ACME CORP NEW A|1|2"),
    ("===TABLE_START===\nD|Q|Market Value|Accrued Inc.\n{b}|N|--|{s} ST\n||  |\n===TABLE_END===", "D|Q|Market Value|Accrued Inc.\n{b}||{s}|"),
]
REPAIRS: dict[str, tuple[Callable[[Column], Column], Shapes]] = {
    "t3_shapes": (tables.drop_pipe_columns, PIPES),
    "t4_shapes": (tables.merge_continuations, CONTINUATIONS),
    "t5_shapes": (tables.merge_split_securities, SECURITIES),
    "t6_shapes": (tables.strip_lot_codes, CODES),
    "t7_shapes": (tables.fix_stacked_pairs, PAIRS),
}


def _filled(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("{b}"), F.col("p_brand")), F.lit("{s}"), F.col("p_size").cast("string"))


def _given(spark: SparkSession, sf_dir: str, shapes: Shapes) -> DataFrame:
    nth = (F.col("p_partkey") % len(shapes)).cast("int")
    return spread(table(spark, sf_dir, "part"), "p_partkey").select("p_partkey", _filled(F.element_at(F.array(*(F.lit(given) for given, _ in shapes)), nth + 1)).alias("text"))


def _shown(rows: Column) -> Column:
    return F.array_join(F.transform(rows, lambda r: F.array_join(r, "|")), "\n")


def repaired(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    repair, shapes = REPAIRS[name]
    rows = F.transform(F.split("text", "\n"), lambda line: F.split(line, r"\|"))
    return _given(spark, sf_dir, shapes).select("p_partkey", _shown(repair(rows)).alias("cells"))


def composed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All repairs of whole answers."""
    answers = _given(spark, sf_dir, ANSWERS).select(F.col("p_partkey").alias("doc_id"), F.lit(0).alias("batch_idx"), "text")
    found = tables.parse_responses(answers).select("doc_id", F.struct("table_idx", _shown(F.col("rows")).alias("t")).alias("t"))
    parts = found.groupBy("doc_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return parts.select(F.col("doc_id").alias("p_partkey"), F.array_join(F.col("ts")["t"], "\n=\n").alias("cells"))


def oracle(shapes: Shapes) -> str:
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    cases = " ".join(f"WHEN {k} THEN {quoted(made or given)}" for k, (given, made) in enumerate(shapes))
    return f"SELECT p_partkey, replace(replace(CASE p_partkey % {len(shapes)} {cases} END, '{{b}}', p_brand), '{{s}}', CAST(p_size AS VARCHAR)) AS cells FROM part"
