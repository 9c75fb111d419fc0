"""Document quality by nearest-neighbour voting over latent-semantic vectors.

Each text becomes a vector of term counts: its words, hashed whole, at any length; the shapes of its words;
short words; and how much repeats. Counts are weighted by inverse document frequency over all documents and
projected on the leading singular vectors of a labelled sample. Every document's cosine with every sample
vector is computed exactly, in blocks; its NEIGHBOURS nearest vote with their label, weighted by similarity
and by the share of their label among all labelled rows.

The sample has at most SAMPLE labelled documents of each label, the first by a hash of their id; that
bound, not the data, limits what is broadcast. Of sample documents as near as the last neighbour, which
count is left to numpy, alike for equal vectors. Null and empty texts are vectors like any other: they
have a term of their own. Very long texts are vectors of the same width. Rows are independent, so repeated
rows get equal scores, and null ids stay. Without any labelled row every score is 0.5; an empty table gives an
empty result. Of several labels of a document the smallest counts. Only id and text are read; drop_poor
keeps all columns.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .pieces import words

SAMPLE, NEIGHBOURS, DIMENSIONS, ACCEPT = 1500, 25, 32, 0.7
SHAPES, SHORT, OTHER = 256, 192, 16
DENSE, WORDS = SHAPES + SHORT + OTHER, 2048
WIDTH = DENSE + WORDS
#: What a hashed word counts beside a shape.
WORD_WEIGHT = 0.3
_SHAPE = str.maketrans({**{chr(c): "A" for c in range(65, 91)}, **{chr(c): "a" for c in range(97, 123)}, **{chr(c): "9" for c in range(48, 58)}})


def _bucket(text: str, n: int) -> int:
    return zlib.crc32(text.encode()) % n


def _shape(word: str) -> str:
    """Runs of capitals, small letters, digits and each mark."""
    out = []
    for c in word.translate(_SHAPE):
        if not c.isascii() and c.isalpha():
            c = "A" if c.isupper() else "a"
        if not out or out[-1] != c:
            out.append(c)
    return "".join(out)


def vectors(texts: pa.Array) -> np.ndarray:
    """Log-scaled term rates of each text, (texts, WIDTH)."""
    n, at = len(texts), SHAPES + SHORT
    if not n:
        return np.zeros((0, WIDTH), np.float32)
    texts = pc.fill_null(texts, "")
    distinct, codes, offsets = words(texts)
    total, owner = np.diff(offsets), np.repeat(np.arange(n), np.diff(offsets))
    of = lambda terms: np.array(terms, np.int64)[codes] if terms else codes
    shape = of([_bucket(_shape(w), SHAPES) for w in distinct])
    short = of([SHAPES + _bucket(w.lower(), SHORT) if len(w) <= 4 else -1 for w in distinct])
    whole = of([DENSE + _bucket(w.lower(), WORDS) for w in distinct])
    base = owner * WIDTH
    where = np.concatenate([base + shape, (base + short)[short >= 0], base + whole])
    out = np.bincount(where, minlength=n * WIDTH).reshape(n, WIDTH).astype(np.float32)

    pairs, repeats = np.unique(owner * len(distinct) + codes, return_counts=True)
    holder = pairs // max(1, len(distinct))
    most = np.zeros(n, np.int64)
    np.maximum.at(most, holder, repeats)
    same = (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])
    size = np.maximum(total, 1)
    out[:, at] = size - np.bincount(holder, minlength=n)
    out[:, at + 1] = np.bincount(owner[1:][same], minlength=n)
    out[:, at + 2] = pc.count_substring(texts, "\n").to_numpy()
    out[:, at + 3], out[:, at + 4] = most, total == 0
    out[:, at + 5] = pc.utf8_length(texts).to_numpy() / 8
    out = np.log1p(out * (200 / (size + 10))[:, None].astype(np.float32))
    out[:, DENSE:] *= WORD_WEIGHT
    bits = np.minimum(8, np.ceil(np.log2(total + 1)).astype(int))
    out[np.arange(n), at + 6 + bits] = 1
    return out.astype(np.float16)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches, 1000):
        rows = [v.tobytes() for v in vectors(batch.column("text"))]
        yield batch.drop_columns(["text"]).append_column("vector", pa.array(rows, pa.binary()))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, n = np.zeros(WIDTH, np.int64), 0
    for batch in common.slices(batches, 1000):
        if batch.num_rows:
            seen += (_dense(batch.column("vector")) > 0).sum(axis=0)
            n += batch.num_rows
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(WIDTH + 1)), pa.array(np.append(seen, n))], ["term", "n"])


def _dense(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float16).reshape(-1, WIDTH).astype(np.float32)


class Model:
    """Projection, sample vectors and their votes."""

    def __init__(self, idf: np.ndarray, sample: np.ndarray, labels: np.ndarray, share: dict[int, float]):
        weighted = sample * idf
        axes = np.random.default_rng(11).normal(size=(weighted.shape[1], 2 * DIMENSIONS)).astype(np.float32)
        for _ in range(8):  # subspace iteration
            axes, _ = np.linalg.qr(weighted.T @ (weighted @ axes))
        _, _, turn = np.linalg.svd(weighted @ axes, full_matrices=False)
        axes = (axes @ turn.T)[:, :DIMENSIONS].astype(np.float64) * idf[:, None]
        self.axes = np.rint(axes * (2**18 / max(np.abs(axes).max(), 1e-30)))
        self.points, self.labels = self.latent(sample), labels.astype(np.float32)
        counts = {y: max(1, int((labels == y).sum())) for y in (0, 1)}
        self.weight = np.array([share.get(int(y), 0) / counts[int(y)] for y in labels], np.float32) * len(labels)

    def latent(self, dense: np.ndarray) -> np.ndarray:
        """Unit vectors in steps of 2**-20. Sums of products of such steps are exact in float64 (here, for rows that sum up to
        less than 2**19), whichever kernel and order BLAS takes for a row."""
        out = np.rint(dense.astype(np.float64) * 2**16) @ self.axes
        return np.rint(out * (2**20 / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1))) / 2**20

    def scores(self, dense: np.ndarray, block: int = 512) -> np.ndarray:
        """Share of label 1 among the nearest neighbours' votes.

        Products are exact, and cosines are taken in steps of 1e-5, ties by place in the sample; so a vector has one score whatever
        vectors are beside it, on any machine."""
        k, out, n = min(NEIGHBOURS, len(self.labels)), [], len(self.labels)
        for at in range(0, len(dense), block):
            some = dense[at : at + block]
            cosine = np.rint((self.latent(some) @ self.points.T) * 1e5).astype(np.int64)
            near = np.sort(np.argpartition(cosine * n - np.arange(n), n - k, axis=1)[:, n - k :], axis=1)
            vote = np.maximum(np.take_along_axis(cosine, near, axis=1) * 1e-5, 1e-6) ** 4 * self.weight[near]
            out.append((vote * self.labels[near]).sum(axis=1) / vote.sum(axis=1))
        return np.clip(np.concatenate(out), 0, 1) if out else np.zeros(0)


def fit(vectors: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fit on rows of ``labels`` (doc_id, label) that have a vector; None where there is none."""
    counted = vectors.select("vector").mapInArrow(_frequencies, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    seen = {r.term: r.n for r in counted}  # WIDTH + 1 rows
    labels = labels.where("label in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("label").alias("label"))
    share = {r.label: r.n for r in labels.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order, chosen = F.xxhash64("doc_id"), None
    for y in share:
        part = labels.where(F.col("label") == y).orderBy(order, "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.union(part)
    if chosen is None:
        return None
    # at most 2 * sample rows; of repeated documents the first vector counts
    rows = vectors.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("vector").alias("vector")).orderBy("doc_id").collect()
    if not rows:
        return None
    dense = np.frombuffer(b"".join(bytes(r.vector) for r in rows), np.float16).reshape(-1, WIDTH).astype(np.float32)
    n = seen.get(WIDTH, 0)
    idf = np.log((1 + n) / (1 + np.array([seen.get(t, 0) for t in range(WIDTH)]))).astype(np.float32) + 0.2
    return Model(idf, dense, np.array([r.label for r in rows]), {int(y): c / sum(share.values()) for y, c in share.items()})


def vectorize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns ``keep`` and vector (half floats) of whole texts, written once for fitting and scoring."""
    docs = docs.select(F.col(id_col).alias("doc_id"), *keep, F.col(text_col).alias("text"))
    schema = T.StructType([*docs.drop("text").schema.fields, T.StructField("vector", T.BinaryType())])
    return common.stored(docs.mapInArrow(_vectors, schema), "quality-vectors")


def score(vectors: DataFrame, model: Model | None, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns ``keep`` and score of every vector."""
    vectors = vectors.select("doc_id", *keep, "vector")
    schema = T.StructType([*vectors.drop("vector").schema.fields, T.StructField("score", T.DoubleType())])
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in common.slices(batches, 1000):
            values = np.full(batch.num_rows, 0.5) if own is None else own.scores(_dense(batch.column("vector"))).astype(float)
            yield batch.drop_columns(["vector"]).append_column("score", pa.array(values, pa.float64()))

    return vectors.mapInArrow(run, schema)


def drop_poor(docs: DataFrame, labels: DataFrame, accept: float = ACCEPT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of docs, with all their columns, whose score reaches ``accept``.

    Vectors are computed and scored once; what is rejected is told by 96 bits of a hash of id and text, and
    leaves docs by a join that shuffles no text while rejected rows are few enough to broadcast.
    """
    one, two = F.xxhash64(F.col(id_col), F.col(text_col)), F.crc32(F.coalesce(F.col(text_col), F.lit("")))
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), one.alias("one"), two.alias("two"))
    named = vectorize(keyed, keep=("one", "two"))
    model = fit(named.select("doc_id", "vector"), labels)
    if model is None:
        common.release(named)
        return docs
    rejected = score(named, model, keep=("one", "two")).where(F.col("score") < accept)
    rejected = common.stored(rejected.select(F.col("one").alias("__one"), F.col("two").alias("__two")).distinct(), "quality-rejected")
    common.release(named)
    return docs.join(common.small(rejected), (one == F.col("__one")) & (two == F.col("__two")), "left_anti")
