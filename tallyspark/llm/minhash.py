"""Near-duplicate documents by min-max hashing, confirmed on the full shingle sets.

A document's set holds its distinct five-word shingles (fewer words: the whole sequence as one; none:
empty). Documents are linked when 100 * |A and B| >= 75 * |A or B|; ``near_duplicates`` gives each its
component. Both the minimum and the maximum under each permutation are kept, so 64 hash evaluations
give 128 values; a band takes values of four different permutations.

- Documents with equal sets (sizes and 128-bit hashes of their sorted 64-bit shingle hashes agree) are
  linked to the smallest id; one of them goes on. Two different sets agree with odds of 1 to 2**128, two
  different shingles with 1 to 2**64.
- Each bucket of a band compares its members with its leader, the smallest id. Pairs whose sketches (a
  byte of each of the 128 values) agree in fewer than half go; at similarity 0.75 that loses one pair in
  10**10. What is left is confirmed on full sets.
- Buckets that still hold several components form clusters. In a cluster all documents outside its largest
  component are compared with each other and with those inside, in blocks within tasks that give out
  links only: by sketches, and where these agree by full sets. Documents of the largest component are never
  compared with each other.

Null and empty texts are linked with nothing. Rows that share a doc_id are one node, linked by any of
its rows. A null doc_id has no component and is kept. Very long texts are sets like any other. An empty
table gives an empty result. Only id and text are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import common
from .components import components
from .pieces import words

WORDS, BANDS, ROWS, SIMILAR = 5, 32, 4, 75
PERMUTATIONS = BANDS * ROWS // 2
#: Documents, and shingles in them, of a block; a task compares two blocks at a time.
BLOCK, BLOCK_SHINGLES = 256, 1 << 20
_constants = np.random.default_rng(20240229).integers(0, 2**64, (2, PERMUTATIONS), np.uint64)
TIMES, PLUS = _constants[0] | np.uint64(1), _constants[1]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_sets(texts: pa.Array, n: int = WORDS) -> list[np.ndarray]:
    """Per text the sorted 64-bit hashes of its distinct shingles. bytes.lower takes exactly A-Z; words
    are separated by the bytes 20 and 09 to 0D."""
    if not len(texts):
        return []
    distinct, codes, offsets = words(texts, ascii_only=True)
    counts = np.diff(offsets)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w.encode().lower()) for w in distinct), np.uint64, len(distinct))[codes]
    step, power = np.uint64(0x9E3779B97F4A7C15), np.uint64(1)
    rolled = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            rolled += hashes[j : j + len(rolled)] * power
            power *= step
        rolled = _mixed(rolled)
        out, at = [], 0
        for k in counts.tolist():
            if k >= n:
                out.append(np.unique(rolled[at : at + k - n + 1]))
            elif k:
                out.append(_mixed(np.array([xxhash.xxh3_64_intdigest(hashes[at : at + k].tobytes(), k)], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
            at += k
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minima, then maxima, of each non-empty set under each permutation: (sets, 2 * PERMUTATIONS)."""
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    flat, out = np.concatenate(sets), np.empty((2 * PERMUTATIONS, len(sets)), np.uint64)
    for p in range(PERMUTATIONS):
        hashed = flat * TIMES[p] + PLUS[p]
        out[p], out[PERMUTATIONS + p] = np.minimum.reduceat(hashed, starts), np.maximum.reduceat(hashed, starts)
    return out.T


def band_keys(values: np.ndarray) -> np.ndarray:
    """A 64-bit key per set and band. The minimum and maximum of one permutation are in different bands."""
    half = values.shape[1] // 2
    maxima = np.roll(values[:, half:], ROWS // 2, axis=1)
    bands = np.concatenate([values[:, :half].reshape(-1, BANDS, ROWS // 2), maxima.reshape(-1, BANDS, ROWS // 2)], axis=2)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bands.shape[:2]).copy()
    for j in range(ROWS):
        key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, j])
    return key


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches):
        sets = shingle_sets(batch.column("text"))
        full = [i for i, s in enumerate(sets) if len(s)]
        keys, sketches = [None] * len(sets), [None] * len(sets)
        if full:
            values = signatures([sets[i] for i in full])
            for i, row, sketch in zip(full, band_keys(values).view(np.int64), values.astype(np.uint8), strict=True):
                keys[i], sketches[i] = row, sketch.tobytes()
        whole = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(map(len, sets), pa.int64()), pa.array(whole, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())], ["doc_id", "n", "whole", "keys", "sketch"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches):
        sets = [s.view(np.int64) for s in shingle_sets(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "shingles"])


def _similar(common_size, a, b):
    return 100 * common_size >= SIMILAR * (a + b - common_size)


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full sets are similar. A leader with very many members is a skewed join key,
    of which Spark splits the members' side."""
    members = pairs.join(sets.withColumnsRenamed({"doc_id": "b", "shingles": "of_b"}), "b")
    both = members.join(sets.withColumnsRenamed({"doc_id": "a", "shingles": "of_a"}), "a")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    return both.where(_similar(shared, F.size("of_a"), F.size("of_b"))).select("a", "b")


def _sized(pairs: DataFrame) -> DataFrame:
    """Pairs whose sizes allow the similarity, each once."""
    allowed = (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * SIMILAR) & (F.col("a") != F.col("b"))
    return pairs.where(allowed).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _near(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which sketches agree with ``one`` in half of their bytes or more."""
    return np.count_nonzero(one == others, axis=-1) >= PERMUTATIONS


def _sketched(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sketches don't rule the similarity out."""
    kind = pairs.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("of_a", "of_b"))
            yield batch.select(["a", "b"]).filter(pa.array(_near(x, y), pa.bool_()))

    members = pairs.join(sketches.withColumnsRenamed({"doc_id": "b", "sketch": "of_b"}), "b")
    both = members.join(sketches.withColumnsRenamed({"doc_id": "a", "sketch": "of_a"}), "a")
    return both.select("a", "b", "of_a", "of_b").mapInArrow(run, f"a {kind}, b {kind}").distinct()


def _first_unlinked(docs: list[dict], low: int, high: int, inside: bool) -> list[tuple]:
    """Links (a, b) between different components of two blocks, or within one (``inside``), by full sets. A link that joins
    nothing new is left out."""
    parent: dict = {}

    def root(x):
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    left = docs if inside else [d for d in docs if d["own"] == low]
    right = docs if inside else [d for d in docs if d["own"] == high]
    if not left or not right:
        return []
    sketches = np.frombuffer(b"".join(d["sketch"] for d in right), np.uint8).reshape(len(right), -1)
    sizes, found = np.array([len(d["shingles"]) for d in right]), []
    for i, d in enumerate(left):
        n = len(d["shingles"])
        near = _near(np.frombuffer(d["sketch"], np.uint8), sketches) & (100 * np.minimum(n, sizes) >= SIMILAR * np.maximum(n, sizes))
        for j in np.flatnonzero(near).tolist():
            if inside and j <= i:
                continue
            x, y = root(d["c"]), root(right[j]["c"])
            if x != y and _similar(len(np.intersect1d(d["shingles"], right[j]["shingles"], assume_unique=True)), n, sizes[j]):
                parent[x] = y
                found.append((d["doc_id"], right[j]["doc_id"]))
    return found


def _compare(kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups (cluster, main, low, high) come together; each holds two blocks at most. ``main``: ``high`` is a block of the
        largest component, whose own documents are marked -1 - block."""
        keys = ("cluster", "main", "low", "high")

        def rows() -> Iterator[tuple]:
            for batch in batches:
                shingles = batch.column("shingles")
                flat, ends = shingles.flatten().to_numpy(), (shingles.offsets.to_numpy() - shingles.offsets[0].as_py()).tolist()
                for k, row in enumerate(batch.drop_columns(["shingles"]).to_pylist()):
                    yield tuple(row[c] for c in keys), row | {"shingles": flat[ends[k] : ends[k + 1]]}

        for (_, main, low, high), some in itertools.groupby(rows(), key=lambda x: x[0]):
            links = _first_unlinked([row for _, row in some], low, -1 - high if main else high, not main and low == high)
            a, b = zip(*links, strict=True) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, kind)], ["a", "b"])

    return run


def _across(members: DataFrame, described: DataFrame, found: DataFrame) -> DataFrame:
    """Links that the leaders' comparisons left out. described: doc_id, n, sketch, shingles.

    Buckets that hold several components after these, and more members than a leader and one other,
    are put together to clusters. Of a cluster, the documents outside its largest component and those
    inside are dealt into blocks; each pair of blocks that is not inside twice meets in one task.
    """
    labelled = members.join(found.withColumnsRenamed({"node": "doc_id", "component_id": "c"}), "doc_id", "left").select("key", "doc_id", "leader", F.coalesce("c", "doc_id").alias("c"))
    labelled = common.stored(labelled, "labelled")
    several = labelled.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count("*").alias("n")).where("low != high and n > 2").select("key")
    several = common.stored(several, "several")
    open_rows = common.stored(labelled.join(several, "key").select("doc_id", "c", F.col("leader.doc_id").alias("leader")).distinct(), "open")
    clusters = components(open_rows.select(F.col("leader").alias("a"), F.col("doc_id").alias("b")))
    clustered = common.stored(open_rows.select("doc_id", "c").distinct().join(clusters.withColumnsRenamed({"node": "doc_id", "component_id": "cluster"}), "doc_id").join(described.select("doc_id", "n"), "doc_id"), "clusters")
    sizes = clustered.groupBy("cluster", "c").agg(F.count("*").alias("k"), F.sum("n").alias("n"))
    blocks = lambda k, n: F.greatest(F.ceil(k / BLOCK), F.ceil(n / BLOCK_SHINGLES), F.lit(1)).cast("int")
    most = sizes.groupBy("cluster").agg(F.max(F.struct("k", "c", "n")).alias("main"), F.sum("k").alias("k"), F.sum("n").alias("n"))
    most = most.select("cluster", F.col("main.c").alias("largest"), blocks(F.col("main.k"), F.col("main.n")).alias("inside"), blocks(F.col("k") - F.col("main.k"), F.col("n") - F.col("main.n")).alias("outside"))
    most = common.stored(most, "cluster-sizes")
    docs = clustered.join(most, "cluster").withColumn("is_main", F.col("c") == F.col("largest"))
    block = F.pmod(F.xxhash64("doc_id"), F.when(F.col("is_main"), F.col("inside")).otherwise(F.col("outside"))).cast("int")
    docs = docs.withColumn("block", block).withColumn("own", F.when(F.col("is_main"), -1 - F.col("block")).otherwise(F.col("block")))
    others = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    group = lambda main, low, high: F.struct(F.lit(main).alias("main"), low.alias("low"), high.alias("high"))
    from_main = F.transform(others("outside"), lambda i: group(True, i, F.col("block")))
    from_rest = F.concat(F.transform(others("inside"), lambda j: group(True, F.col("block"), j)), F.transform(others("outside"), lambda j: group(False, F.least("block", j), F.greatest("block", j))))
    dealt = docs.select("cluster", "doc_id", "c", "own", F.explode(F.when(F.col("is_main"), from_main).otherwise(from_rest)).alias("g")).select("cluster", "g.main", "g.low", "g.high", "doc_id", "c", "own")
    dealt = dealt.join(described.select("doc_id", "sketch", "shingles"), "doc_id")
    ordered = dealt.repartition("cluster", "main", "low", "high").sortWithinPartitions("cluster", "main", "low", "high", "doc_id")
    kind = described.schema["doc_id"].dataType
    out = common.stored(ordered.mapInArrow(_compare(to_arrow_type(kind)), f"a {kind.simpleString()}, b {kind.simpleString()}"), "similar")
    common.release(labelled, several, open_rows, clusters, clustered, most)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs. What the driver gets is bounded, however
    many rows there are."""
    with common.measured_joins(docs.sparkSession):
        return _near_duplicates(common.keyed(docs, id_col, text_col))


def _near_duplicates(docs: DataFrame) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = common.stored(docs.mapInArrow(_sign, f"doc_id {kind}, n bigint, whole binary, keys array<bigint>, sketch binary"), "signed")
    rows = signed.where("doc_id is not null and n > 0")

    # groups are stored before they are joined, so that the joins stand alone and Spark can split a hot key
    firsts = rows.groupBy("whole", "n").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    firsts = common.stored(firsts.where("copies > 1").drop("copies"), "copies")
    repeats = common.stored(rows.select("doc_id", "whole", "n").join(firsts, ["whole", "n"]).where("doc_id != first").select("doc_id", "whole", "first"), "repeats")
    copies = repeats.select(F.col("first").alias("a"), F.col("doc_id").alias("b"))
    singles = rows.join(repeats, ["doc_id", "whole"], "left_anti")
    keyed = singles.select("doc_id", "n", F.explode("keys").alias("key"))
    buckets = keyed.groupBy("key").agg(F.min(F.struct("doc_id", "n")).alias("leader"), F.count("*").alias("members")).where("members > 1")
    buckets = common.stored(buckets.select("key", "leader"), "leaders")
    members = common.stored(keyed.join(buckets, "key").select("key", "doc_id", "n", "leader"), "buckets")

    ids = common.stored(members.select("doc_id").distinct(), "ids")
    sets = docs.join(common.small(ids), "doc_id", "left_semi").mapInArrow(_sets, f"doc_id {kind}, shingles array<bigint>").where("size(shingles) > 0")
    sets = common.stored(sets, "shingles")
    sketches = common.stored(rows.select("doc_id", "n", "sketch").join(common.small(ids), "doc_id", "left_semi"), "sketches")
    pairs = _sized(members.select(F.col("leader.doc_id").alias("a"), F.col("leader.n").alias("na"), F.col("doc_id").alias("b"), F.col("n").alias("nb")))
    pairs = common.stored(_sketched(pairs, sketches.select("doc_id", "sketch")), "pairs")
    linked = common.stored(_confirmed(pairs, sets), "similar")
    found = components(linked)
    rest = _across(members, sketches.join(sets, "doc_id"), found)
    used = [firsts, repeats, buckets, members, ids, sets, sketches, pairs, linked, found, rest]
    linked = linked.union(rest)
    found = components(linked.union(copies))
    label = found.withColumnsRenamed({"node": "doc_id"})
    out = signed.select("doc_id", "n").join(label, "doc_id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    out = common.stored(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))), "near-duplicates")
    common.release(signed, *used, found)
    return out


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of docs, with all their columns, that are the first of their component. Of rows that repeat
    a kept doc_id, all stay."""
    found = near_duplicates(docs, id_col, text_col)
    gone = common.stored(found.where("not kept").select(F.col("doc_id").alias("__gone")).distinct(), "gone")
    common.release(found)
    return docs.join(common.small(gone), docs[id_col] == F.col("__gone"), "left_anti")
