"""Benchmark decontamination with a BM25 index of the test items and block maxima.

Every training passage is a query. Items are of classes by their length, up to SHORT words, four times as many and so
on; a passage is twice as long as its class's longest, and begins every so many words, so any item fits whole into one,
and a long item doesn't widen the passages of others. Impacts are divided by the item's score for its own text, so a score is the share of an item that the
passage covers. Passages whose terms' best impacts can't reach THRESHOLD are skipped, then blocks of BLOCK
successive items in which their best impacts can't; in the other blocks every item is scored exactly, all at
once (walking to pivots one by one, as WAND does, finds the same at twice the time). Every item at or above
THRESHOLD is verified: at least OVERLAP of the word trigrams of its question and of its answer must be in the passage.
The answer is an item's last sentence, or its last third where it has just one.

Item counts, document frequencies and mean length are those of the whole benchmark. The index is
broadcast in shards of at most SHARD_BYTES of item text; more items mean more shards, and the same scores.

Null or empty texts and items match nothing. Very long texts are many passages. Of an item's passages with
equal scores the first is reported. Rows are independent: repeated rows each give their own result, and
equal items are each reported. Empty tables on either side give no rows. Only ids and texts are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .pieces import words

THRESHOLD, OVERLAP, K1, B, BLOCK = 0.6, 0.5, 1.2, 0.75, 16
#: Words of the first class of items; each further class has four times as many.
SHORT = 64
SHARD_BYTES = 16 << 20
_MARKS = re.compile(r"[\W_]+")
_END = re.compile(r"(?<=[.!?:])\s+|\n+")


def term(piece: str) -> str:
    return _MARKS.sub("", piece.lower())


def terms(text: str) -> list[str]:
    return [t for t in map(term, text.split()) if t]


class Statistics:
    """Of the whole benchmark: items, their mean length, and in how many items terms are."""

    def __init__(self, n: int, mean: float, df: dict[str, int]):
        self.n, self.mean, self.df = n, mean, df

    @classmethod
    def of(cls, texts: list[str]) -> Statistics:
        split = [w for w in map(terms, texts) if w]
        sizes = [len(w) for w in split]
        return cls(len(split), sum(sizes) / max(1, len(split)), Counter(t for w in split for t in set(w)))


def longest(size: int) -> int:
    """Words of the longest item in the class of an item of ``size`` words."""
    limit = SHORT
    while limit < size:
        limit *= 4
    return limit


def indexes(items: list[tuple[int, str]], statistics: Statistics) -> list[Index]:
    """An index of each class of items."""
    classes: dict[int, list[tuple[int, str]]] = {}
    for i, t in items:
        if n := len(terms(t or "")):
            classes.setdefault(longest(n), []).append((i, t))
    return [Index(some, statistics) for _, some in sorted(classes.items())]


class Index:
    """Postings of one class of items with normalised impacts, their maxima per term and per block of items."""

    def __init__(self, items: list[tuple[int, str]], statistics: Statistics | None = None):
        items = [(i, t) for i, t in items if t and terms(t)]
        statistics = statistics or Statistics.of([t for _, t in items])
        self.ids = [i for i, _ in items]
        split = [terms(t) for _, t in items]
        self.vocabulary = {t: k for k, t in enumerate(dict.fromkeys(t for w in split for t in w))}
        n, mean, df = statistics.n, statistics.mean, statistics.df
        postings: list[list[tuple[int, float]]] = [[] for _ in self.vocabulary]
        for k, w in enumerate(split):
            impact = {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * c * (K1 + 1) / (c + K1 * (1 - B + B * len(w) / mean)) for t, c in Counter(w).items()}
            whole = sum(impact.values())
            for t, x in impact.items():
                postings[self.vocabulary[t]].append((k, x / whole))
        self.items = [np.array([k for k, _ in p], np.int64) for p in postings]
        self.impacts = [np.array([x for _, x in p]) for p in postings]
        self.best = np.array([*(x.max() for x in self.impacts), 0.0])  # the last: words of no item
        #: per term the blocks of items that have it, and its best impact in each
        self.block_best = []
        for x, impact in zip(self.items, self.impacts, strict=True):
            some, first = np.unique(x // BLOCK, return_index=True)
            self.block_best.append((some, np.maximum.reduceat(impact, first)))
        self.parts = [tuple(self.grams(np.array([self.vocabulary[t] for t in terms(p)], np.int64)) for p in _question_answer(t)) for _, t in items]
        self.stride = longest(max(map(len, split), default=1))
        self.passage = 2 * self.stride

    def grams(self, ids: np.ndarray) -> tuple[int, np.ndarray]:
        """Length and codes of the n-grams, n = 3 or the number of words if smaller."""
        n = min(3, len(ids))
        return n, np.unique(self.codes(ids, n)) if n else np.zeros(0, np.int64)

    def codes(self, ids: np.ndarray, n: int) -> np.ndarray:
        """Codes of the n-grams without words of no item."""
        m, base = max(0, len(ids) - n + 1), len(self.vocabulary)
        code, whole = np.zeros(m, np.int64), np.ones(m, bool)
        for j in range(n):
            part = ids[j : j + m]
            code, whole = code * base + part, whole & (part >= 0)
        return code[whole]

    def numbers(self, texts: pa.Array) -> list[np.ndarray]:
        """Per text the term of each word, -1 for words of no item; pieces without letters vanish."""
        if not len(texts):
            return []
        distinct, codes, offsets = words(texts)
        table = np.fromiter((self.vocabulary.get(t, -1) if (t := term(p)) else -2 for p in distinct), np.int64, len(distinct))
        ids = table[codes]
        real = ids > -2
        bounds = np.concatenate([[0], np.cumsum(real)])[offsets].tolist()
        ids = ids[real]
        return [ids[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def search(self, ids: np.ndarray) -> list[tuple[int, float, float, float, int]]:
        """Verified items of a document: item's place, best score, overlaps, first word of the passage."""
        bound = np.concatenate([[0.0], np.cumsum(self.best[ids])])
        starts = np.arange(0, max(1, len(ids) - self.passage + self.stride), self.stride)
        ends = np.minimum(starts + self.passage, len(ids))
        found: dict[int, tuple] = {}
        for k in np.flatnonzero(bound[ends] - bound[starts] >= THRESHOLD - 1e-9).tolist():
            passage = ids[starts[k] : ends[k]]
            distinct = np.unique(passage[passage >= 0]).tolist()
            blocks, tops = (np.concatenate([self.block_best[t][k] for t in distinct]) for k in (0, 1))
            open_blocks = np.bincount(blocks, tops) >= THRESHOLD - 1e-9
            if not open_blocks.any():
                continue
            at, impact = (np.concatenate([x[t] for t in distinct]) for x in (self.items, self.impacts))
            inside = open_blocks[at // BLOCK]
            scores = np.bincount(at[inside], impact[inside])
            for item in np.flatnonzero(scores >= THRESHOLD - 1e-9).tolist():
                score = float(scores[item])
                shares = [np.isin(codes, self.codes(passage, n)).mean() if n else 1.0 for n, codes in self.parts[item]]
                if min(shares) >= OVERLAP and (item not in found or score > found[item][1]):
                    found[item] = (item, score, float(shares[0]), float(shares[1]), int(starts[k]))
        return list(found.values())


def _question_answer(text: str) -> tuple[str, str]:
    parts = [p for p in _END.split(text.strip()) if terms(p)]
    if len(parts) > 1:
        return " ".join(parts[:-1]), parts[-1]
    words = text.split()
    return " ".join(words[: -(len(words) // 3) or None]), " ".join(words[len(words) - len(words) // 3 :])


def _terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches):
        split = [terms(t) for t in batch.column("t").to_pylist()]
        distinct = [list(set(w)) for w in split]
        yield pa.RecordBatch.from_arrays([batch.column("shard"), pa.array(map(len, split), pa.int64()), pa.array(distinct, pa.list_(pa.string()))], ["shard", "size", "terms"])


def _shards(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[tuple[list[tuple[int, str]], Statistics]]:
    """The test items, in shards that are small enough to broadcast, with the whole benchmark's statistics of
    their terms."""
    items = benchmark.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where("t is not null")
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-size // SHARD_BYTES) or 1
    items = items.withColumn("shard", F.pmod(F.xxhash64("i", "t"), F.lit(n)).cast("int"))
    described = common.stored(items.select("shard", "t").mapInArrow(_terms_of, "shard int, size bigint, terms array<string>").where("size > 0"), "benchmark-terms")
    whole = described.agg(F.count("*").alias("n"), F.avg("size").alias("mean")).first()
    by_term = described.select("shard", F.explode("terms").alias("term"))
    df = common.stored(by_term.groupBy("term").agg(F.count("*").alias("df"), F.collect_set("shard").alias("shards")), "benchmark-df")
    for k in range(n):
        of = {r.term: r.df for r in df.where(F.array_contains("shards", k)).select("term", "df").collect()}  # a shard's terms
        rows = [(r.i, r.t) for r in items.where(F.col("shard") == k).orderBy("i", "t").collect()]
        yield rows, Statistics(whole.n, whole.mean or 1.0, of)
    common.release(described, df)


def _indexes_of(shared) -> list[Index]:
    """The worker's indexes for a broadcast shard."""
    if getattr(_indexes_of, "held", (None,))[0] != shared.id:
        _indexes_of.held = (shared.id, indexes(*shared.rows.value))
    return _indexes_of.held[1]


class _Shared:
    """A broadcast shard with an id that tells workers whether they have indexed it."""

    def __init__(self, spark, rows):
        import uuid

        self.id, self.rows = uuid.uuid4().hex, spark.sparkContext.broadcast(rows)


def _find(shared: _Shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, 4000):
            where, rows = [], []
            for index in _indexes_of(shared):
                for k, ids in enumerate(index.numbers(batch.column("text"))):
                    for item, *values in index.search(ids):
                        where.append(k)
                        rows.append((index.ids[item], *values))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = (pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(where, pa.int64())), *map(pa.array, columns, kinds)], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "first_word"])

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap, first_word: an item's best passage in a document."""
    docs = common.keyed(docs, id_col, text_col)
    kind, out = docs.schema["doc_id"].dataType.simpleString(), None
    for rows in _shards(benchmark, item_col, item_text_col):
        found = docs.mapInArrow(_find(_Shared(docs.sparkSession, rows)), f"doc_id {kind}, item_id bigint, score double, question_overlap double, answer_overlap double, first_word bigint")
        out = found if out is None else out.unionByName(found)
    return out


def _clean(shared: _Shared, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, 4000):
            for index in _indexes_of(shared):
                ids = index.numbers(batch.column(text_col))
                batch = batch.filter(pa.array([not index.search(x) for x in ids], pa.bool_()))
            yield batch

    return run


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Rows of docs, with all their columns, that have no verified item in any passage."""
    for rows in _shards(benchmark, item_col, item_text_col):
        docs = docs.mapInArrow(_clean(_Shared(docs.sparkSession, rows), text_col), docs.schema)
    return docs
