"""Page batches through a model, halved where answers are cut off."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cells as X
from .tables import END, NO_TABLES, START

#: Answers that are handed back to Spark together.
ANSWERS = 100
_RESPONSE = "doc_id string, first_page int, last_page int, text string, finish_reason string"


class PageReader(Protocol):
    """What reads page images. It must be picklable; tasks call it. ``journal.JournaledReader`` adds retries, and
    answers that outlive a task."""

    def read(self, doc_id: str, pages: list[tuple[int, bytes]]) -> tuple[str, str | None]:
        """Text in the delimited format, and why it ended (STOP where it is whole)."""


def is_truncated(finish_reason: Column, text: Column) -> Column:
    """Whether an answer was cut off: no reason or one that says so, or more starts than ends of tables."""
    marks = lambda m: F.size(F.split(text, m))
    return finish_reason.isNull() | finish_reason.isin("MAX_TOKENS", "OTHER") | F.coalesce(marks(START) > marks(END), F.lit(False))


def batched(pages: DataFrame, size: int = 7) -> DataFrame:
    """pages with batch_idx: runs of ``size`` pages in page order."""
    order = Window.partitionBy("doc_id").orderBy("page_number")
    return pages.withColumn("batch_idx", F.floor((F.row_number().over(order) - 1) / size).cast("int"))


def _ask(reader: PageReader):
    """Calls for batches as they come, a batch's pages one after another; a call's pages are all that is held besides the rows
    that Spark hands over together. By its hints Spark takes it for a function of frames over groups, too."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import itertools

        rows = (row for frame in frames for row in zip(*(frame[c].tolist() for c in ("doc_id", "batch_idx", "page_number", "image")), strict=True))
        answers = []
        for (doc, _), some in itertools.groupby(rows, key=lambda r: r[:2]):
            pages = [r[2:] for r in some]
            answers.append((doc, pages[0][0], pages[-1][0], *reader.read(doc, pages)))
            if len(answers) >= ANSWERS:
                yield pd.DataFrame(answers, columns=["doc_id", "first_page", "last_page", "text", "finish_reason"])
                answers = []
        if answers:
            yield pd.DataFrame(answers, columns=["doc_id", "first_page", "last_page", "text", "finish_reason"])

    return run


def read_batches(pages: DataFrame, reader: PageReader, size: int = 7) -> tuple[DataFrame, DataFrame]:
    """Responses (doc_id, batch_idx, text) and failures (doc_id, page_range).

    Batches whose answer is cut off are asked again at half the size, down to single pages, which then
    fail: at most log2(size) + 1 rounds, each checkpointed so that the model isn't asked twice.
    """
    whole, pending, failed = None, pages.select("doc_id", "page_number", "image"), None
    while True:
        dealt = batched(pending, size) if whole is None else _rebatched(pending, size)
        ordered = dealt.select("doc_id", "batch_idx", "page_number", "image").repartition("doc_id", "batch_idx").sortWithinPartitions("doc_id", "batch_idx", "page_number")
        answers = ordered.mapInPandas(_ask(reader), _RESPONSE).checkpoint()
        cut = is_truncated(F.col("finish_reason"), F.col("text"))
        good = answers.where(~cut)
        whole = good if whole is None else whole.unionByName(good)
        rest = answers.where(cut)
        if size == 1:
            failed = rest.select("doc_id", F.concat_ws("-", "first_page", "last_page").alias("page_range"))
            break
        spans = rest.select("doc_id", "first_page", "last_page")
        within = (F.col("p.doc_id") == F.col("s.doc_id")) & F.col("p.page_number").between(F.col("s.first_page"), F.col("s.last_page"))
        pending = pages.alias("p").join(spans.alias("s"), within).select("p.doc_id", "p.page_number", "p.image", "s.first_page")
        size = max(1, size // 2)
    order = Window.partitionBy("doc_id").orderBy("first_page")
    responses = whole.where(F.col("text") != NO_TABLES).select("doc_id", (F.row_number().over(order) - 1).alias("batch_idx"), "text")
    return responses, failed


def _rebatched(pages: DataFrame, size: int) -> DataFrame:
    """Batches within each earlier batch, numbered by their first page."""
    order = Window.partitionBy("doc_id", "first_page").orderBy("page_number")
    nth = F.floor((F.row_number().over(order) - 1) / size) * size
    return pages.withColumn("batch_idx", (F.col("first_page") + nth).cast("int"))


class AccountReader(Protocol):
    """What looks for accounts in a whole statement. It must be picklable; tasks call it."""

    def accounts(self, doc_id: str) -> str:
        """JSON array of objects with account_type and account_number, in the document's order."""


def supplied_accounts(docs: DataFrame, client: AccountReader) -> DataFrame:
    """doc_id, account_idx, kind, number: the accounts that the model finds in each document (doc_id), one call for each.

    Entries without a type or a number are left out; an answer that is no such array gives no accounts. Store the result
    before using it twice.
    """

    def ask(frames):
        import pandas as pd

        for frame in frames:
            for doc in frame["doc_id"]:
                yield pd.DataFrame({"doc_id": [doc], "answer": [client.accounts(doc)]})

    answers = docs.select("doc_id").distinct().mapInPandas(ask, "doc_id string, answer string")
    found = F.from_json(X.unfenced(F.col("answer")), "array<struct<account_type:string,account_number:string>>")
    trimmed = F.transform(found, lambda a: F.struct(F.trim(a["account_type"]).alias("kind"), F.trim(a["account_number"]).alias("number")))
    usable = F.filter(trimmed, lambda a: F.coalesce((a["kind"] != "") & (a["number"] != ""), F.lit(False)))
    return answers.select("doc_id", F.posexplode(usable).alias("account_idx", "a")).select("doc_id", "account_idx", "a.kind", "a.number")
