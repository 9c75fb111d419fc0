"""Content-addressed store of token ids: rolling-hash chunks, recipes and Merkle manifests.

Layout under the store's path, all Parquet:

- ``chunks``: digest, ids (little-endian, 2 bytes an id where the vocabulary allows, else 4); each
  distinct chunk once;
- ``recipes``: doc_id, start, n_tokens, root, digests, ends (of each chunk, in ids); in ascending doc_id order; a document is
  the concatenation of its chunks;
- ``manifest``: segment, n_docs, n_tokens, root; the Merkle root over the recipes' roots of each
  segment of 2**20 ids, and the top root in segment -1.

Added tokens of the tokenizer's file (<|endoftext|>) that a text spells out get their own ids, as in a plain
call of the library: such texts are encoded whole.

A null text counts as empty and so has the end id alone. Rows with equal or null doc_id are documents
of their own, nulls first. An empty table gives an empty store.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .pieces import encode_texts

#: Chunks have at least MIN ids, 2**MEAN_BITS beyond that on average, MAX at most.
MIN, MEAN_BITS, MAX, ROLL = 64, 9, 4096, 16
SEGMENT_BITS = 20
#: Pieces that are joined for one call of the tokenizer.
JOIN = 256
_ENCODED = "doc_id {id}, n_tokens bigint, root binary, digests array<binary>, ends array<bigint>, payloads array<binary>"
_held: dict[str, Encoder] = {}


class Encoder:
    """The tokenizers library over Arrow columns: distinct pieces are encoded JOIN at a time, and told
    apart by the length of their tokens."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = "|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values())
        self.sizes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.sizes[i] = len(token)  # a byte-level token has a character for each byte

    def each(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def pieces(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        bounds = [*range(0, len(distinct), JOIN), len(distinct)]
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), distinct), " ").to_pylist() if len(distinct) else []
        ids = np.concatenate([np.zeros(0, np.int32), *self.each([" " + t for t in joined])])
        ends, stops = np.cumsum(self.sizes[ids]), np.cumsum(pc.binary_length(distinct).to_numpy().astype(np.int64) + 1)
        at = np.searchsorted(ends, stops)
        if len(stops) and (ends[at] != stops).any():
            raise ValueError("a token crosses a space")
        return ids, np.diff(at + 1, prepend=0)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        spelt = np.zeros(len(texts), bool)
        if self.added:
            spelt = pc.fill_null(pc.match_substring_regex(texts, self.added), False).to_numpy(zero_copy_only=False)
        # taking, since if_else with a null gives wrong offsets for a slice of an array of strings
        plain = texts.take(pa.array(np.arange(len(texts)), mask=spelt)) if spelt.any() else texts
        out = encode_texts(plain, self.pieces, self.each)
        found = np.flatnonzero(spelt).tolist()
        for k, ids in zip(found, self.each([texts[k].as_py() for k in found]), strict=True):
            out[k] = ids
        return out


def encoder(path: str) -> Encoder:
    """The worker's tokenizer, kept between tasks."""
    if path not in _held:
        _held[path] = Encoder(path)
    return _held[path]


def chunk_ends(ids: np.ndarray) -> np.ndarray:
    """Where a gear-style rolling hash over the last ROLL ids allows a cut (after the id at that place)."""
    mixed = (ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    rolled, span = mixed, 1
    while span < ROLL:
        rolled = rolled.copy()
        rolled[span:] += rolled[:-span].copy() << np.uint64(span)
        span *= 2
    return np.flatnonzero((rolled >> np.uint64(40)) & np.uint64(2**MEAN_BITS - 1) == 0) + 1


def cuts(allowed: np.ndarray, n: int) -> list[int]:
    """Ends of the chunks of n ids."""
    ends, last = [], 0
    for c in allowed.tolist():
        while c - last > MAX:
            last += MAX
            ends.append(last)
        if c - last >= MIN and c < n:
            ends.append(c)
            last = c
    while n - last > MAX:
        last += MAX
        ends.append(last)
    return [*ends, n]


def merkle(leaves: list[bytes]) -> bytes:
    """Root of a binary hash tree; an odd node moves up as it is."""
    level = [hashlib.sha256(b"\0" + x).digest() for x in leaves] or [hashlib.sha256(b"").digest()]
    while len(level) > 1:
        paired = [hashlib.sha256(b"\1" + a + b).digest() for a, b in zip(level[::2], level[1::2], strict=False)]
        level = paired + level[len(paired) * 2 :]
    return level[0]


def _encode(path: str, end_id: int, width: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = encoder(path), np.array([end_id])
        for batch in common.slices(batches, 4000):
            rows: list[list] = [[], [], [], [], []]
            for ids in own.encode(batch.column("text")):
                ids = np.concatenate([ids, end]).astype(width)
                ends = cuts(chunk_ends(ids), len(ids))
                starts, size, raw = [0, *ends[:-1]], ids.itemsize, ids.tobytes()
                payloads = [raw[a * size : b * size] for a, b in zip(starts, ends, strict=True)]
                digests = [hashlib.sha256(p).digest() for p in payloads]
                for column, value in zip(rows, (len(ids), merkle(digests), digests, ends, payloads), strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, rows, kinds)], ["doc_id", "n_tokens", "root", "digests", "ends", "payloads"])

    return run


def write_store(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, vocabulary: int = 50_257, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Tokenize whole texts with the tokenizers library and write the store at ``path``.

    The encoded rows are staged once. The distinct chunks take one shuffle by digest, in which copies
    meet on the map side first; everything else moves digests and lengths only.
    """
    width = "<u2" if max(vocabulary, end_id + 1) <= 2**16 else "<u4"
    docs = common.keyed(docs, id_col, text_col)
    encoded = common.stored(docs.mapInArrow(_encode(tokenizer_path, end_id, width), _ENCODED.format(id=docs.schema["doc_id"].dataType.simpleString())), "token-ids")
    parts = F.explode(F.arrays_zip("digests", "payloads")).alias("c")
    chunks = encoded.select(parts).select(F.col("c.digests").alias("digest"), F.col("c.payloads").alias("ids")).dropDuplicates(["digest"])

    common.write(chunks, f"{path}/chunks")
    ordered = encoded.select("doc_id", "n_tokens", "root", "digests", "ends").repartitionByRange("doc_id", "root").withColumn("part", F.spark_partition_id())
    ordered = common.stored(ordered, "token-recipes")
    by_part = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    offsets = ordered.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(by_part), F.lit(0)).alias("before"))
    within = Window.partitionBy("part").orderBy("doc_id", "root").rowsBetween(Window.unboundedPreceding, -1)
    recipes = ordered.withColumn("own", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(F.broadcast(offsets), "part").withColumn("start", F.col("before") + F.col("own"))
    common.write(recipes.select("doc_id", "start", "n_tokens", "root", "digests", "ends").repartitionByRange("start").sortWithinPartitions("start"), f"{path}/recipes")
    common.release(encoded, ordered)
    manifest(docs.sparkSession, path).write.parquet(f"{path}/manifest")


@F.pandas_udf(T.BinaryType())
def _root_of(leaves):
    return leaves.map(lambda some: merkle(list(some)))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Merkle roots over the recipes; a segment has 2**20 documents at most, since each has an id."""
    recipes = spark.read.parquet(f"{path}/recipes").withColumn("segment", F.shiftright("start", SEGMENT_BITS))
    one, many = F.lit(1).cast("bigint"), F.col("n_docs")

    def joined(rows: DataFrame, n_docs: Column, *keys: Column) -> DataFrame:
        """The root over rows (start, n_tokens, root) of each key, in the order of start."""
        leaves = F.sort_array(F.collect_list(F.struct("start", "root")))["root"]
        sums = rows.groupBy(*keys).agg(F.sum(n_docs).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), leaves.alias("leaves"))
        return sums.withColumn("root", _root_of("leaves")).drop("leaves")

    segments = joined(recipes, one, F.col("segment"))
    above = joined(segments.withColumnRenamed("segment", "start"), many, F.shiftright("start", SEGMENT_BITS).alias("above"))
    top = joined(above.withColumnRenamed("above", "start"), many)
    return segments.unionByName(top.where("n_docs > 0").select(F.lit(-1).cast("bigint").alias("segment"), "n_docs", "n_tokens", "root"))


def verify(spark: SparkSession, path: str) -> None:
    """Hold every recipe's root against its digests, and the manifest against the recipes; an error where
    they differ. The chunks themselves are checked as they are read."""
    wrong = F.raise_error(F.lit("a recipe doesn't match its root"))
    recipes = spark.read.parquet(f"{path}/recipes").select(F.when(_root_of("digests") != F.col("root"), wrong).alias("checked"))
    if recipes.where("checked is not null").count() or not _same(manifest(spark, path), spark.read.parquet(f"{path}/manifest")):
        raise ValueError("the manifest doesn't match the recipes")


def _same(one: DataFrame, other: DataFrame) -> bool:
    """Manifests have a row for each segment."""
    names = {c: f"__{c}" for c in one.columns}
    differs = ~(F.struct(*one.columns).eqNullSafe(F.struct(*names.values())))
    return one.join(other.withColumnsRenamed(names), F.col("segment") == F.col("__segment"), "full").where(differs).isEmpty()


# -- crc32 of a concatenation from the crc32 of its parts: moving a part left by n bytes multiplies its
#    crc by x**(8n) modulo the crc polynomial


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    product, b = np.zeros_like(b), b.copy()
    for bit in range(31, -1, -1):
        product ^= np.where(a >> np.uint32(bit) & np.uint32(1), b, np.uint32(0))
        b = np.where(b & np.uint32(1), b >> np.uint32(1) ^ np.uint32(0xEDB88320), b >> np.uint32(1))
    return product


def crc_moved(crc: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """Each crc32 as it counts when n_bytes more follow its bytes."""
    out, n = crc.astype(np.uint32), n_bytes.astype(np.uint64) * np.uint64(8)
    power = np.full(1, 1 << 30, np.uint32)  # x
    while n.any():
        odd = (n & np.uint64(1)).astype(bool)
        if odd.any():
            out[odd] = _times(np.broadcast_to(power, odd.sum()), out[odd])
        power, n = _times(power, power), n >> np.uint64(1)
    return out


@F.pandas_udf(T.LongType())
def _moved(crc, n_bytes):
    import pandas as pd

    return pd.Series(crc_moved(crc.to_numpy(), n_bytes.to_numpy()).astype(np.int64))


def _check(width: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, payloads = batch.column("digest").to_pylist(), batch.column("ids").to_pylist()
            if any(hashlib.sha256(p).digest() != d for d, p in zip(digests, payloads, strict=True)):
                raise ValueError("a chunk doesn't match its digest")
            crcs = [zlib.crc32(np.frombuffer(p, width).astype("<u4").tobytes()) for p in payloads]
            n = [len(p) // np.dtype(width).itemsize for p in payloads]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(crcs, pa.int64()), pa.array(n, pa.int64())], ["digest", "crc", "n"])

    return run


def _places(recipes: DataFrame) -> DataFrame:
    """A row for each chunk of each document: its digest, length and the number of ids after it."""
    exploded = recipes.select("doc_id", "start", "n_tokens", "ends", F.posexplode(F.arrays_zip("digests", "ends")).alias("at", "c"))
    first: Column = F.when(F.col("at") == 0, 0).otherwise(F.element_at("ends", F.greatest("at", F.lit(1))))
    return exploded.select("doc_id", "start", "n_tokens", "at", F.col("c.digests").alias("digest"), (F.col("c.ends") - first).alias("len"), (F.col("n_tokens") - F.col("c.ends")).alias("after"))


def read_digests(spark: SparkSession, path: str, vocabulary: int = 50_257) -> DataFrame:
    """Read every chunk and recipe back and give doc_id, start, n_tokens, ids_crc32, n_chunks.

    Each chunk is read once, checked against its digest and reduced to its crc32 as 4-byte ids; the
    recipes then combine these, so no ids are shuffled. A missing chunk or a wrong length is an error.
    """
    width = "<u2" if vocabulary <= 2**16 else "<u4"
    chunks = spark.read.parquet(f"{path}/chunks").mapInArrow(_check(width), "digest binary, crc bigint, n bigint")
    rows = _places(spark.read.parquet(f"{path}/recipes")).join(chunks, "digest", "left")
    wrong = F.col("n").isNull() | (F.col("n") != F.col("len"))
    crc = F.when(wrong, F.raise_error(F.lit("a chunk is missing or has another length"))).otherwise(_moved("crc", F.col("after") * 4))
    return rows.select("doc_id", "start", "n_tokens", crc.alias("crc")).groupBy("doc_id", "start", "n_tokens").agg(F.bit_xor("crc").alias("ids_crc32"), F.count("*").alias("n_chunks"))


def read_ids(spark: SparkSession, path: str, vocabulary: int = 50_257) -> DataFrame:
    """The documents of a store as doc_id, start, ids (array of int)."""
    width = "<u2" if vocabulary <= 2**16 else "<u4"

    @F.udf("array<int>")
    def joined(parts):
        return np.frombuffer(b"".join(bytes(p.ids) for p in parts), width).astype(np.int32).tolist()

    rows = _places(spark.read.parquet(f"{path}/recipes")).join(spark.read.parquet(f"{path}/chunks"), "digest")
    return rows.groupBy("doc_id", "start").agg(joined(F.array_sort(F.collect_list(F.struct("at", "ids")))).alias("ids"))
