"""Alignment of two tokenizers over the same texts by an event sweep.

Every token is an event at the byte where it ends. A task encodes a document with both tokenizers and
emits its events of both sides, packed: a row holds a side's ids of up to BLOCK tokens and the byte at
which they begin; a token's end follows from its length in bytes. Events are dealt out by document and
sorted by offset within the partition, and one pass over a partition sweeps both sides at once. A byte
where tokens of both sides end closes a group; between two neighbouring events of either side lies one
link, of the tokens that cover it. The sweep keeps what has come since the last closed group, and so at
most a block of either side and the open group, however long a document is.

A pair of ids counts as often as it is linked in the corpus. The counts are a table in the shared
folder, in parts of at most PART pairs. A task that rates links reads one part and a bounded slice of the
links; a pair's links are all rated, in as many passes over the links as there are parts.

Null texts, empty texts and texts that a tokenizer doesn't give back byte by byte have no tokens: zeros, and
an empty string for the digest. Every row is a document of its own, so repeated rows, equal or null ids
give a result for each; ties for the highest count all count as best. Very long texts are encoded in one
call and swept in blocks. Columns other than the id and the text are ignored, whatever their names. An empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .token_store import Encoder

#: Tokens of a packed row of events, at most.
BLOCK = 1 << 16
#: Bytes of packed events or links that a worker takes at a time.
SLICE = 4 << 20
#: Pairs of ids whose counts a worker holds at a time, 12 bytes each.
PART = 1 << 22
A, B, NONE = 0, 1, 2
_held: dict = {}


class SideA:
    """A tokenizer of the tokenizers library; strings of special tokens are plain text."""

    def __init__(self, path: str):
        self.encoder = Encoder(path)
        self.encoder.tokenizer.encode_special_tokens = True
        self.encoder.added = ""
        # the byte-level alphabet: printable bytes stand for themselves, the others follow 255 in order
        printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
        self.tokens = [b""] * self.encoder.tokenizer.get_vocab_size()
        for token, i in self.encoder.tokenizer.get_vocab().items():
            self.tokens[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()

    def encode(self, spaced: pa.Array) -> list[np.ndarray]:
        return self.encoder.encode(spaced)


class SideB:
    """A sentencepiece model, which puts a space before a text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.tokens = [self._bytes(i) for i in range(self.model.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, spaced: pa.Array) -> list[np.ndarray]:
        texts = [t[1:] for t in spaced.to_pylist()]
        return [np.array(ids, np.int32) for ids in self.model.encode(texts, num_threads=1)]


def _sides(path_a: str, path_b: str) -> tuple[SideA, SideB, np.ndarray, np.ndarray]:
    """The worker's tokenizers and their tokens' lengths in bytes, kept between tasks."""
    if (path_a, path_b) not in _held:
        one, other = SideA(path_a), SideB(path_b)
        _held[path_a, path_b] = one, other, *(np.fromiter(map(len, s.tokens), np.int64, len(s.tokens)) for s in (one, other))
    return _held[path_a, path_b]


# -- events


def _events(path_a: str, path_b: str, wide: bool):
    code = "<u4" if wide else "<u2"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, other, len_a, len_b = _sides(path_a, path_b)
        if not wide and max(len(len_a), len(len_b)) > 1 << 16:
            raise ValueError("vocabularies of more than 65,536 tokens need wide=True")
        for batch in common.slices(batches, 2000, SLICE):
            texts = pc.fill_null(batch.column("text"), "")
            spaced = pc.binary_join_element_wise("", texts, " ")
            raw = spaced.cast(pa.binary()).to_pylist()
            at, sides, offsets, ids = [], [], [], []

            def add(k: int, side: int, offset: int, tokens: np.ndarray, at=at, sides=sides, offsets=offsets, ids=ids) -> None:
                at.append(k)
                sides.append(side)
                offsets.append(offset)
                ids.append(tokens.astype(code).tobytes())

            for k, (a, b, want) in enumerate(zip(one.encode(spaced), other.encode(spaced), raw, strict=True)):
                whole = len(want) > 1 and all(b"".join(map(s.tokens.__getitem__, x.tolist())) == want for s, x in ((one, a), (other, b)))
                if not whole:
                    add(k, NONE, 0, a[:0])
                    continue
                for side, x, sizes in ((A, a, len_a), (B, b, len_b)):
                    starts = [0, *np.cumsum(sizes[x])[BLOCK - 1 :: BLOCK].tolist()]
                    for start, lo in zip(starts, range(0, len(x), BLOCK), strict=False):
                        add(k, side, start, x[lo : lo + BLOCK])
            rows = batch.select(["key", "doc_id"]).take(pa.array(at, pa.int64()))
            sizes = pa.array(np.fromiter(map(len, raw), np.int64, len(raw))).take(pa.array(at, pa.int64()))
            columns = [*rows.columns, sizes, pa.array(sides, pa.int8()), pa.array(offsets, pa.int64()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "doc_id", "n_bytes", "side", "offset", "ids"])

    return run


def events(docs: DataFrame, path_a: str, path_b: str, wide: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key, doc_id, n_bytes (of a space and the text), side, offset, ids: the packed end events of both tokenizers."""
    docs = common.keyed(docs, id_col, text_col).withColumn("key", F.monotonically_increasing_id())
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(_events(path_a, path_b, wide), f"key bigint, doc_id {kind}, n_bytes bigint, side tinyint, offset bigint, ids binary")


# -- the sweep


class Sweep:
    """One pass over the events of a partition, whose documents lie one behind the other on one axis of bytes."""

    def __init__(self, one: SideA, other: SideB, len_a: np.ndarray, len_b: np.ndarray):
        self.len_a, self.len_b = len_a, len_b
        # a token's text in a digest, with what follows it: within its side, or at the side's end
        self.text = [f"{i}{after}".encode() for n, ends in ((len(len_a), ",|"), (len(len_b), ",;")) for i in range(n) for after in ends]
        self.pending = [np.zeros(0, np.int64)] * 2
        self.ends = [np.zeros(0, np.int64)] * 2
        self.reached = [0, 0]
        self.docs: list[tuple] = []  # key, doc_id and end of documents that aren't swept to their end
        self.latest, self.until = None, 0
        self.hash = hashlib.sha256()
        self.begun = False

    def feed(self, rows: Iterable[dict]) -> Iterator[tuple]:
        """Take sorted rows; give key, doc_id, n_a, n_b, n_groups, links (pairs of ids) and the digest where a
        document ends. A document whose events come in several feeds gives a row for each."""
        new: tuple[list, list] = ([], [])
        for row in rows:
            if row["side"] == NONE:
                yield row["key"], row["doc_id"], 0, 0, 0, np.zeros(0, np.int64), ""
                continue
            if row["key"] != self.latest:
                self.latest, self.until = row["key"], self.until + row["n_bytes"]
                self.docs.append((row["key"], row["doc_id"], self.until))
            new[row["side"]].append(row["ids"])
        for side, sizes in ((A, self.len_a), (B, self.len_b)):
            ids = np.concatenate([np.zeros(0, np.int64), *new[side]])
            ends = self.reached[side] + np.cumsum(sizes[ids])
            if len(ends):
                self.reached[side] = int(ends[-1])
            self.pending[side] = np.concatenate([self.pending[side], ids])
            self.ends[side] = np.concatenate([self.ends[side], ends])
        yield from self._close()

    def _close(self) -> Iterator[tuple]:
        ends_a, ends_b = self.ends
        at = np.searchsorted(ends_a, ends_b)  # A tokens that end before each B token does
        known = at < len(ends_a)
        both = np.zeros(len(ends_b), bool)
        both[known] = ends_a[at[known]] == ends_b[known]
        closing = np.flatnonzero(both)
        if not len(closing):
            return
        n_b, n_a = int(closing[-1]) + 1, int(at[closing[-1]]) + 1
        (a, b), (ends_a, ends_b), at, both = (self.pending[A][:n_a], self.pending[B][:n_b]), (ends_a[:n_a], ends_b[:n_b]), at[:n_b], both[:n_b]
        self.pending = [self.pending[A][n_a:], self.pending[B][n_b:]]
        self.ends = [self.ends[A][n_a:], self.ends[B][n_b:]]

        # links: one for each stretch between neighbouring ends of either side
        alone = ~both
        place = at + np.cumsum(alone) - alone
        n = n_a + int(alone.sum())
        of_a, of_b = np.ones(n, bool), np.zeros(n, bool)
        of_a[place[alone]] = False
        of_b[place] = True
        links = a[np.cumsum(of_a) - of_a] << 32 | b[np.cumsum(of_b) - of_b]

        # digests: every group's A ids, then its B ids
        upto_a, upto_b = at[closing] + 1, closing + 1
        codes = np.empty(n_a + n_b, np.int64)
        text_a, text_b = a * 2, (b + len(self.len_a)) * 2
        text_a[upto_a - 1] += 1
        text_b[upto_b - 1] += 1
        codes[np.arange(n_a) + np.repeat(np.concatenate([[0], upto_b[:-1]]), np.diff(upto_a, prepend=0))] = text_a
        codes[np.arange(n_b) + np.repeat(upto_a, np.diff(upto_b, prepend=0))] = text_b

        stops = np.array([end for _, _, end in self.docs])
        till = int(ends_a[-1])
        touched = int(np.searchsorted(stops, till)) + 1
        bounds = [np.searchsorted(x, np.minimum(stops[:touched], till), "right") for x in (ends_a, ends_b, ends_b[closing])]
        cut_a, cut_b, cut_g = ([0, *x.tolist()] for x in bounds)
        codes_of = codes.tolist()
        for k, (key, doc_id, end) in enumerate(self.docs[:touched]):
            lo, hi = cut_a[k] + cut_b[k], cut_a[k + 1] + cut_b[k + 1]
            some_a, some_b, groups = cut_a[k + 1] - cut_a[k], cut_b[k + 1] - cut_b[k], cut_g[k + 1] - cut_g[k]
            if self.begun:
                self.hash.update(b";")
            self.hash.update(b"".join(map(self.text.__getitem__, codes_of[lo:hi]))[:-1])
            self.begun, digest = True, None
            if end <= till:
                digest = self.hash.hexdigest()
                self.hash, self.begun = hashlib.sha256(), False
            yield key, doc_id, some_a, some_b, groups, links[lo - cut_g[k] : hi - cut_g[k + 1]], digest
        self.docs = self.docs[int(np.searchsorted(stops, till, "right")) :]


_SWEPT = "key bigint, doc_id {id}, n_a bigint, n_b bigint, n_groups bigint, links binary, groups_sha256 string"


def _swept(path_a: str, path_b: str, wide: bool):
    code, pair = ("<u4", "<u8") if wide else ("<u2", "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep, schema = Sweep(*_sides(path_a, path_b)), None
        for batch in common.slices(batches, 2000, SLICE):
            rows = batch.to_pylist()
            for row in rows:
                row["ids"] = np.frombuffer(row["ids"], code).astype(np.int64)
            out: list[list] = [[] for _ in range(7)]
            for found in sweep.feed(rows):
                links = found[5] if wide else found[5] >> 16 | found[5] & 0xFFFF
                for column, value in zip(out, (*found[:5], links.astype(pair).tobytes(), found[6]), strict=True):
                    column.append(value)
            schema = schema or pa.schema([("key", pa.int64()), batch.schema.field("doc_id"), *((x, pa.int64()) for x in ("n_a", "n_b", "n_groups")), ("links", pa.binary()), ("groups_sha256", pa.string())])
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, schema, strict=True)], schema=schema)

    return run


def sweep(found: DataFrame, path_a: str, path_b: str, wide: bool = False) -> DataFrame:
    """key, doc_id, n_a, n_b, n_groups, links (packed pairs of ids) and groups_sha256, a row or more for each document.

    ``wide`` is for vocabularies of more than 65,536 tokens.
    """
    kind = found.schema["doc_id"].dataType.simpleString()
    dealt = found.repartition("key").sortWithinPartitions("key", "offset", "side")
    return dealt.mapInArrow(_swept(path_a, path_b, wide), _SWEPT.format(id=kind))


# -- how often pairs of ids are linked


def _pairs(batch: pa.RecordBatch, wide: bool) -> tuple[np.ndarray, np.ndarray]:
    """All links of a slice one behind the other, and the rows' bounds."""
    packed = batch.column("links").to_pylist()
    bounds = np.cumsum([0, *map(len, packed)]) // (8 if wide else 4)
    return np.frombuffer(b"".join(packed), "<u8" if wide else "<u4").astype(np.int64), bounds


def _summed(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of equal values added up, values ascending."""
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return values[first], np.add.reduceat(counts, first)


def _counted(wide: bool, most: int = 1 << 20):
    def rows(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        values, counts = _summed(*map(np.concatenate, zip(*held, strict=True)))
        for at in range(0, len(values), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(values[at : at + 100_000]), pa.array(counts[at : at + 100_000])], ["pair", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in common.slices(batches, 2000, SLICE):
            found = pa.array(_pairs(batch, wide)[0]).value_counts()
            if len(found):
                held.append((found.field("values").to_numpy(), found.field("counts").to_numpy()))
            if sum(len(v) for v, _ in held) > 2 * most:
                held = [_summed(*map(np.concatenate, zip(*held, strict=True)))]
                if len(held[0][0]) > most:
                    yield from rows(held)
                    held = []
        if held:
            yield from rows(held)

    return run


def pair_counts(swept: DataFrame, wide: bool = False) -> DataFrame:
    """pair (A id and B id in one number), n (its links in the corpus), best (whether n is its B id's highest)."""
    shift = 32 if wide else 16
    counts = swept.select("links").mapInArrow(_counted(wide), "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = common.stored(counts, "pair-counts")
    of_b = F.col("pair").bitwiseAND((1 << shift) - 1)
    highest = counts.groupBy(of_b.alias("b")).agg(F.max("n").alias("highest"))  # a row for each token of B at most
    return counts.join(F.broadcast(highest), of_b == F.col("b")).select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def _part(path: str, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The worker's part of the counts, by ascending pair; one part is kept."""
    if _held.get("part") != (path, part):
        import pyarrow.dataset as ds

        files, inner = common.filesystem(f"{path}/part={part}")
        table = ds.dataset(inner, filesystem=files, format="parquet").to_table(["pair", "n", "best"])
        pairs = table.column("pair").to_numpy()
        order = np.argsort(pairs)
        _held["counts"] = pairs[order], table.column("n").to_numpy()[order], table.column("best").to_numpy().astype(np.int64)[order]
        _held["part"] = path, part
    return _held["counts"]


def _rated(path: str, part: int, wide: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, 2000, SLICE):
            links, bounds = _pairs(batch, wide)
            coded = pa.array(links).dictionary_encode()
            distinct, codes = coded.dictionary.to_numpy(), coded.indices.to_numpy()
            n, best = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
            if len(distinct):
                pairs, counts, tops = _part(path, part)
                at = np.minimum(np.searchsorted(pairs, distinct), len(pairs) - 1)
                known = pairs[at] == distinct
                n[known], best[known] = counts[at[known]], tops[at[known]]
            sums = (np.diff(np.concatenate([[0], np.cumsum(x[codes])])[bounds]) for x in (best, n))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(np.diff(bounds)), *map(pa.array, sums)], ["key", "n_links", "n_best", "count_sum"])

    return run


def align(docs: DataFrame, path_a: str, path_b: str, wide: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs``.

    ``path_a`` is a byte-level file of the tokenizers library, ``path_b`` a sentencepiece model.
    """
    spark = docs.sparkSession
    swept = common.stored(sweep(events(docs, path_a, path_b, wide, id_col, text_col), path_a, path_b, wide), "links")
    counts = common.stored(pair_counts(swept, wide), "rated-pairs")
    parts, path = max(1, -(-counts.count() // PART)), common.scratch(spark, "pair-parts")
    counts.withColumn("part", F.pmod(F.xxhash64("pair"), F.lit(parts)).cast("int")).repartition("part").write.partitionBy("part").parquet(path)
    passes = [swept.select("key", "links").mapInArrow(_rated(path, k, wide), "key bigint, n_links bigint, n_best bigint, count_sum bigint") for k in range(parts)]
    rated = reduce(DataFrame.unionByName, [passes[0], *(p.withColumn("n_links", F.lit(0)) for p in passes[1:])])
    counted = swept.select("key", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256")
    nothing = {name: F.lit(None).cast("bigint") for name in ("n_links", "n_best", "count_sum")}
    rows = counted.withColumns(nothing).unionByName(rated, allowMissingColumns=True)
    sums = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    return rows.groupBy("key").agg(F.max("doc_id").alias("doc_id"), *sums, F.max("groups_sha256").alias("groups_sha256")).drop("key")
