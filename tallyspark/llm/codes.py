"""Vector compression by product codes: vectors cut into parts, each part replaced by its nearest codebook entry.

Components are integers, floor(256 x). Equal parts at one position are counted as one row with a weight, so the
codebooks are learned from distinct parts: a round assigns each distinct part to the nearest entry (squared
distance, ties to the lower entry) and replaces every entry by the floor of the weighted mean of its parts. Entries
(64 for each of 16 positions at most) are all that a round brings to the driver. Codes and distances of the distinct
parts are then joined back to the vectors.

A part that makes more than one in HEAVY of its position's vectors is joined by broadcast (fewer than HEAVY rows a
position), every other part by a shuffle in which it is at most one row in HEAVY of its position; labels alike.

Null vectors and vectors with a null or non-finite component are left out, as asked. Vectors shorter than the longest, or of
a length that isn't a multiple of the number of parts, count as if zeros followed. Components are held within the range in
which a whole vector's squared distance is a bigint. With fewer vectors than entries there are as many entries as vectors. Among equal
ids the smaller vector comes first, null ids come last. Repeated rows each have a result, null labels count as one label.
Columns other than the id, the vector and the label are ignored, whatever their names. An empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: A key with more than one row in so many is joined by broadcast.
HEAVY = 1000
#: Rows whose distances to all entries are computed at a time.
BLOCK = 4096


def _integers(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, label and v, the integer components, of the vectors that are kept."""
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    kept = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("x")).where(F.col("x").isNotNull() & finite)
    width = kept.agg(F.max(F.size("x"))).first()[0] or 0
    width = -(-width // PARTS) * PARTS
    most = math.isqrt((2**63 - 1) // max(width, 1)) // 2
    whole = F.transform("x", lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(float(most))), F.lit(-float(most)))).cast("bigint"))
    return kept.select("vec_id", "label", F.concat(whole, F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size("x"))).alias("v"))


def _parts(v: Column, width: int) -> Column:
    size = width // PARTS
    return F.array(*(F.slice(v, p * size + 1, size) for p in range(PARTS)))


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row and its squared distance; ties go to the lower entry."""
    found, error = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
    for at in range(0, len(parts), BLOCK):
        some = parts[at : at + BLOCK]
        distance = np.zeros((len(some), len(entries)), np.int64)
        for k in range(parts.shape[1]):
            apart = some[:, k, None] - entries[None, :, k]
            distance += apart * apart
        found[at : at + BLOCK] = best = distance.argmin(1)
        error[at : at + BLOCK] = distance[np.arange(len(some)), best]
    return found, error


def _assigned(books: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, 50_000):
            at, column = batch.column("p").to_numpy(), batch.column("part")
            rows = column.flatten().to_numpy().reshape(len(at), books[0].shape[1])
            code, error = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            for p in np.unique(at).tolist():
                own = at == p
                code[own], error[own] = nearest(rows[own], books[p])
            yield pa.RecordBatch.from_arrays([batch.column("p"), column, batch.column("n"), pa.array(code, pa.int32()), pa.array(error)], ["p", "part", "n", "code", "error"])

    return run


def assign(distinct: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``distinct`` (p, part, n) with code and error, from the codebook of each position."""
    return distinct.mapInArrow(_assigned(books), "p int, part array<bigint>, n bigint, code int, error bigint")


def train(distinct: DataFrame, books: list[np.ndarray], rounds: int = ROUNDS) -> list[np.ndarray]:
    """Weighted Lloyd over distinct parts; each round brings the sums of all entries to the driver, one row an entry."""
    size = books[0].shape[1]
    total = lambda k: F.sum(F.col("part")[k].cast("decimal(19,0)") * F.col("n").cast("decimal(18,0)")).alias(f"s{k}")
    for _ in range(rounds):
        sums = assign(distinct, books).groupBy("p", "code").agg(F.sum("n").alias("n"), *(total(k) for k in range(size))).collect()
        books = [b.copy() for b in books]
        for row in sums:
            books[row["p"]][row["code"]] = [int(row[f"s{k}"]) // row["n"] for k in range(size)]
    return books


def _joined(rows: DataFrame, table: DataFrame, keys: list[str], heavy: Column) -> DataFrame:
    """``rows`` with the columns of ``table`` by null-safe equal ``keys``: its heavy rows by broadcast, the rest by a shuffle."""
    named = {k: f"__{k}" for k in keys}
    table = table.withColumnsRenamed(named).withColumn("__heavy", heavy)
    same = [F.col(k).eqNullSafe(F.col(v)) for k, v in named.items()]
    often, seldom = (table.where(c).drop("__heavy") for c in (F.col("__heavy"), ~F.col("__heavy")))
    gone = list(named.values())
    return rows.join(F.broadcast(often), same).drop(*gone).unionByName(rows.join(F.broadcast(often.select(*gone)), same, "left_anti").join(seldom, same).drop(*gone))


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 and label of every vector that is kept."""
    spark = vectors.sparkSession
    rows = _integers(vectors, id_col, vector_col, label_col).withColumn("row", F.monotonically_increasing_id())
    rows = common.stored(rows, "vectors")
    # the first vectors by id are the entries that the codebooks begin with
    first = [r["v"] for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(ENTRIES).collect()]
    width = len(first[0]) if first else 0
    start = np.array(first, np.int64).reshape(len(first), PARTS, width // PARTS)
    books = [start[:, p] for p in range(PARTS)]

    total = rows.count()
    cut = rows.select("row", "vec_id", "label", F.posexplode(_parts(F.col("v"), width)).alias("p", "part"))
    distinct = common.stored(cut.groupBy("p", "part").agg(F.count("*").alias("n")), "distinct-parts")
    if first and width:
        books = train(distinct, books)
    digest = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()
    codes = common.stored(assign(distinct, books), "codes")
    coded = _joined(cut, codes, ["p", "part"], F.col("n") * HEAVY > total)
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("p", "code"))), lambda c: F.lpad(F.lower(F.hex(c["code"])), 2, "0")), "")
    found = coded.groupBy("row", "vec_id", "label").agg(text.alias("code"), F.sum("error").alias("error"))
    found = common.stored(found, "coded-vectors")
    labels = common.stored(found.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "label-errors")
    out = _joined(found, labels, ["label"], F.col("n") * HEAVY > total)
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"), "label")
