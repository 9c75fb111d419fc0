"""Chat formatting with a loss mask, as Spark expressions only.

A conversation's turns are collected as structs, sorted, and adjacent turns of one role merged into a block:

    <|im_start|>role
    text<|im_sep|>text<|im_end|>

``<|im_sep|>`` stands between the texts that were merged, so every turn can be read back. Inside roles and texts, a
``<`` before ``|`` or ``\\`` is followed by an additional ``\\``, so ``<|`` begins a mark and nothing else; a line feed in a role
becomes ``<``, ``\\``, ``n``. The mask is a list of spans (begin and length in code points) over assistants' texts, marks and
roles left out.

A conversation is formatted in parts of PART turn numbers, which are collected, sorted and merged apart, so a very long one
isn't gathered as turns in one task; a part's row tells with its neighbours' roles whether its first block goes on. The
formatted conversation is the concatenation of its parts in order.

Null roles and texts count as empty. Turns are ordered by turn, role, text; null turns come first, and equal rows are turns of
their own. Rows with a null conversation id are one conversation with that id. An empty table gives an empty result. Columns
other than the four named are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turn numbers of a part.
PART = 256
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<([\\|])", r"<\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\([\\|])", r"<$1")


def _role_line(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n"))


def _role_of(line: Column) -> Column:
    return unescape(F.replace(line, F.lit("<\\n"), F.lit("\n")))


def _merged(turns: Column) -> Column:
    """Sorted turns as blocks: a role and the texts of adjacent turns of that role."""
    none = F.array().cast("array<struct<role:string,texts:array<string>>>")

    def add(blocks: Column, turn: Column) -> Column:
        last = F.try_element_at(blocks, F.lit(-1))
        same = F.coalesce(last["role"] == turn["role"], F.lit(False))
        longer = F.struct(last["role"].alias("role"), F.concat(last["texts"], F.array(turn["text"])).alias("texts"))
        fresh = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
        return F.when(same, F.concat(F.slice(blocks, 1, F.size(blocks) - 1), F.array(longer))).otherwise(F.concat(blocks, F.array(fresh)))

    return F.aggregate(turns, none, add)


def render(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, part, formatted, mask (array of begin and length within the part), a row for each part."""
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    part = F.floor(F.col(turn_col) / PART).cast("bigint")
    rows = turns.select(F.col(conv_col).alias("conv_id"), part.alias("part"), turn.alias("t"))
    parts = rows.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    blocks = parts.select("conv_id", "part", _merged(F.col("turns")).alias("blocks"))

    order = Window.partitionBy("conv_id").orderBy(F.col("part").asc_nulls_first())  # a row for each part
    first, last = F.element_at("blocks", F.lit(1))["role"], F.element_at("blocks", F.lit(-1))["role"]
    goes_on = F.coalesce(F.lag(last).over(order) == first, F.lit(False))
    ends = ~F.coalesce(F.lead(first).over(order) == last, F.lit(False))
    blocks = blocks.withColumns({"goes_on": goes_on, "ends": ends})

    # pieces of the output in order: marks and texts in turn, with the places that count for the loss
    def pieces(block: Column, at: Column) -> Column:
        head = F.when((at == 0) & F.col("goes_on"), F.lit(SEP)).otherwise(F.concat(F.lit(START), _role_line(block["role"]), F.lit("\n")))
        tail = F.when((at == F.size("blocks") - 1) & ~F.col("ends"), F.lit("")).otherwise(F.lit(END))
        learned = block["role"] == ASSISTANT
        mark = lambda text: F.array(F.struct(text.alias("text"), F.lit(False).alias("learned")))
        texts = F.transform(block["texts"], lambda t, k: F.concat(F.when(k > 0, mark(F.lit(SEP))).otherwise(mark(head)), F.array(F.struct(escape(t).alias("text"), learned.alias("learned")))))
        return F.concat(F.flatten(texts), mark(tail))

    cut = blocks.select("conv_id", "part", F.flatten(F.transform("blocks", pieces)).alias("pieces"))
    begun = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,length:int>>").alias("mask"))

    def place(state: Column, piece: Column) -> Column:
        n = F.length(piece["text"])
        span = F.struct(state["at"].alias("begin"), n.alias("length"))
        mask = F.when(piece["learned"], F.concat(state["mask"], F.array(span))).otherwise(state["mask"])
        return F.struct((state["at"] + n).alias("at"), mask.alias("mask"))

    return cut.select("conv_id", "part", F.array_join(F.col("pieces")["text"], "").alias("formatted"), F.aggregate("pieces", begun, place)["mask"].alias("mask"))


def conversations(rendered: DataFrame) -> DataFrame:
    """conv_id, formatted, learned (the texts under the mask, unescaped), a row for each conversation."""
    learned = F.transform("mask", lambda s: unescape(F.substring("formatted", s["begin"] + 1, s["length"])))
    rows = rendered.select("conv_id", F.struct("part", "formatted", F.array_join(learned, "").alias("learned")).alias("p"))
    parts = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("p")).alias("parts"))
    return parts.select("conv_id", *(F.array_join(F.col("parts")[x], "").alias(x) for x in ("formatted", "learned")))


def read_turns(formatted: Column) -> Column:
    """Role and text of every turn of a formatted conversation, in order."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda b: b != "")
    role = lambda b: _role_of(F.substring_index(F.substring(b, len(START) + 1, 2**30), "\n", 1))
    body = lambda b: F.substring(b, F.locate("\n", b) + 1, F.lit(2**30))
    return F.flatten(F.transform(blocks, lambda b: F.transform(F.split(body(b), r"<\|im_sep\|>"), lambda t: F.struct(role(b).alias("role"), unescape(t).alias("text")))))


def digests(rendered: DataFrame) -> DataFrame:
    """What the formatted conversations hold, read back from them: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars."""
    read = conversations(rendered).withColumn("turns", read_turns(F.col("formatted")))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    sha = lambda text: F.sha2(F.encode(text, "UTF-8"), 256)
    chars = lambda name: F.length(name).cast("bigint")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        sha(lines).alias("turns_sha256"),
        chars("learned").alias("loss_chars"),
        sha(F.col("learned")).alias("loss_sha256"),
        chars("formatted").alias("formatted_chars"),
    )
