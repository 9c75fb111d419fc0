"""Byte-level BPE encoding by corpus-level merge replay, and decoding.

1. Documents are split into words (matches of the pattern) in blocks. A block's distinct words are dealt
   into parts by crc32, so a word has one place in the whole corpus; a document is kept as the numbers of
   its words.
2. Each part brings together the words of all blocks. An inverted index maps each rank to the word
   positions whose pair has it; ranks are taken in ascending order, each is applied at all its
   positions, and only the two neighbours of a merged pair enter the index anew.
3. The ids go back to the words' blocks, and the numbers of words become ids. Blocks are stored in buckets, so
   documents aren't shuffled.

A block holds at most 10,000 documents or 32 MB (a longer text is a block of its own); a part sends a
block's words and gets their ids in one packed row each, so a word that all documents have costs a part one
entry a block. A part replays up to FRESH words at once and remembers up to KEPT.

Null texts count as empty and give no ids. Rows are independent: repeated rows, null ids, very long texts
and empty tables need no special case; other columns are left out. The decoded bytes of any text are its
UTF-8 bytes. What ``encode`` returns reads a scratch table, which stays.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import common
from .pieces import encode_texts, expanded

#: Words whose merges are replayed at once, and encoded words of a part that are remembered.
FRESH, KEPT = 100_000, 400_000
#: Parts at most: a block has a row for each.
PARTS = 4096
_held: dict[tuple[str, str], Codec] = {}


class Codec:
    """Ranks of a ``.tiktoken`` file and the pattern that splits texts into words."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex

        with open(ranks_path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)])
        self.byte_pairs = np.array([[self.ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)])
        self.pairs: dict[int, int] = {}
        self.words = regex.compile(pattern)
        self.code = "H" if len(self.tokens) <= 2**16 else "I"

    def replay(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each non-empty word, by applying every merge that occurs in rank order over all of them."""
        ranks, tokens, pairs = self.ranks, self.tokens, self.pairs
        if len(pairs) > 300_000:
            pairs.clear()
        flat = np.frombuffer(b"".join(words), np.uint8)
        n, sizes = len(flat), np.fromiter(map(len, words), np.int64, len(words))
        stops = np.cumsum(sizes)
        links = np.arange(1, n + 1)
        links[stops - 1] = -1
        after = links.tolist()
        links = np.arange(-1, n - 1)
        links[stops - sizes] = -1
        before = links.tolist()
        symbols = self.of_byte[flat].tolist()

        # the inverted index: rank of a pair to the places of its left symbol
        first = np.full(n, -1)
        first[:-1] = self.byte_pairs[flat[:-1], flat[1:]]
        first[stops - 1] = -1
        pair_rank = first.tolist()
        order = np.argsort(first, kind="stable")
        order = order[np.searchsorted(first[order], 0) :]
        found, starts = np.unique(first[order], return_index=True)
        index = {r: places.tolist() for r, places in zip(found.tolist(), np.split(order, starts[1:]), strict=True)} if len(order) else {}
        heap = found.tolist()  # ascending, so a heap

        while heap:
            rank = heapq.heappop(heap)
            places = index.pop(rank)
            places.sort()
            for at in places:
                if pair_rank[at] != rank:
                    continue
                gone, left = after[at], before[at]
                symbols[at], symbols[gone], pair_rank[gone] = rank, -1, -1
                right = after[at] = after[gone]
                if right >= 0:
                    before[right] = at
                else:
                    pair_rank[at] = -1
                for place, other in ((at, right), (left, at)):  # only these two pairs are new
                    if place >= 0 and other >= 0:
                        key = symbols[place] << 20 | symbols[other]
                        new = pairs.get(key)
                        if new is None:
                            new = pairs[key] = ranks.get(tokens[symbols[place]] + tokens[symbols[other]], -1)
                        pair_rank[place] = new
                        if new >= 0:
                            if new in index:
                                index[new].append(place)
                            else:
                                index[new] = [place]
                                heapq.heappush(heap, new)
        kept = np.array(symbols)
        real = kept >= 0
        bounds = np.concatenate([[0], np.cumsum(real)])[np.concatenate([[0], stops])].tolist()
        out = kept[real].tolist()
        return [out[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def encode_words(self, words: list[bytes], known: dict[bytes, bytes]) -> None:
        """Add the packed ids of words to ``known``: those of the vocabulary at once, others by replay."""
        fresh = list({w for w in words if w not in known})
        ids = list(map(self.ranks.get, fresh))
        known.update((w, array(self.code, (i,)).tobytes()) for w, i in zip(fresh, ids, strict=True) if i is not None)
        rest = [w for w, i in zip(fresh, ids, strict=True) if i is None]
        for at in range(0, len(rest), FRESH):
            some = rest[at : at + FRESH]
            known.update((w, array(self.code, x).tobytes()) for w, x in zip(some, self.replay(some), strict=True))

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def codec(ranks_path: str, pattern: str) -> Codec:
    """The worker's codec, kept between tasks."""
    if (ranks_path, pattern) not in _held:
        _held[ranks_path, pattern] = Codec(ranks_path, pattern)
    return _held[ranks_path, pattern]


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned 32-bit numbers, each with its length before it and its bytes by significance."""
    planes = [np.array([len(a)], "<u4").tobytes() + a.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for a in arrays]
    return zstandard.compress(b"".join(planes), 1)


def _unpack(packed: bytes) -> list[np.ndarray]:
    raw, out, at = zstandard.decompress(packed), [], 0
    while at < len(raw):
        n = int.from_bytes(raw[at : at + 4], "little")
        out.append(np.frombuffer(raw, np.uint8, 4 * n, at + 4).reshape(4, n).T.copy().view("<u4").ravel())
        at += 4 + 4 * n
    return out


class _Numbers:
    """Numbers the words of a block."""

    def __init__(self, pattern: str):
        import regex

        self.find, self.of = regex.compile(pattern).findall, {}

    def each(self, texts: list[str]) -> list[np.ndarray]:
        of = self.of
        return [np.array([of.setdefault(w, len(of)) for w in self.find(t)], np.int64) for t in texts]

    def pieces(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        of, flat, counts = self.of, [], []
        for p in distinct.to_pylist():
            found = self.find(" " + p)
            flat += [of.setdefault(w, len(of)) for w in found]
            counts.append(len(found))
        return np.array(flat, np.int64), np.array(counts, np.int64)


def _split(pattern: str, parts: int):
    """A row of documents for each block (part -1: ids, numbers of words), and one for each of its parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in common.slices(batches, 10_000):
            numbers = _Numbers(pattern)
            of_text = encode_texts(batch.column("text"), numbers.pieces, numbers.each)
            codes = np.concatenate([*of_text, np.zeros(0, np.int64)])
            words = [w.encode() for w in numbers.of]
            by_count = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")  # small numbers for frequent words
            rank = np.empty(len(words), np.int64)
            rank[by_count] = np.arange(len(words))
            words = [words[k] for k in by_count.tolist()]
            part = np.fromiter((zlib.crc32(w) % parts for w in words), np.int64, len(words))
            order = np.argsort(part, kind="stable")
            present, starts = np.unique(part[order], return_index=True)
            packed = [_pack(np.array([len(x) for x in of_text]), part, rank[codes])]
            for places in np.split(order, starts[1:]) if len(words) else []:
                own = [words[k] for k in places.tolist()]
                packed.append(zstandard.compress(np.array([len(own), *map(len, own)], "<u4").tobytes() + b"".join(own), 1))
            ids = batch.column("doc_id")
            bounds = np.concatenate([[0], np.full(len(packed), len(ids))])  # only the first row has the ids
            columns = [pa.array([block] * len(packed), pa.int64()), pa.array([-1, *present.tolist()], pa.int32()), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), ids), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["block", "part", "doc_ids", "packed"])
            block += 1

    return run


def _words(packed: bytes) -> list[bytes]:
    raw = zstandard.decompress(packed)
    n = int.from_bytes(raw[:4], "little")
    stops = np.cumsum(np.frombuffer(raw, "<u4", n, 4), dtype=np.int64) + 4 + 4 * n
    bounds = [4 + 4 * n, *stops.tolist()]
    return [raw[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


def _replayed(ranks_path: str, pattern: str):
    """The words of a part's rows become their numbers of ids, and the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known, at, waiting, fresh = codec(ranks_path, pattern), {}, None, [], 0
        width = np.dtype(own.code).itemsize

        def give() -> Iterator[pa.RecordBatch]:
            own.encode_words([w for _, _, words in waiting for w in words], known)
            packed = []
            for _, _, words in waiting:
                found = [known[w] for w in words]
                packed.append(_pack(np.fromiter(map(len, found), np.int64, len(found)) // width, np.frombuffer(b"".join(found), own.code)))
            blocks, parts = pa.array([b for b, _, _ in waiting], pa.int64()), pa.array([p for _, p, _ in waiting], pa.int32())
            yield pa.RecordBatch.from_arrays([blocks, parts, pa.array(packed, pa.binary())], ["block", "part", "packed"])
            waiting.clear()

        for batch in common.slices(batches, 100, 4 << 20):
            for row in batch.to_pylist():
                if waiting and (row["part"] != at or fresh > FRESH):
                    yield from give()
                    fresh = 0
                if row["part"] != at or len(known) > KEPT:
                    at, known = row["part"], {}
                words = _words(row["packed"])
                waiting.append((row["block"], row["part"], words))
                fresh += len(words)
        if waiting:
            yield from give()

    return run


def _assembled(ranks_path: str, pattern: str):
    """The documents of a block by the ids of its words."""

    def run(docs: pa.Table, of_words: pa.Table) -> pa.Table:
        own = codec(ranks_path, pattern)
        lengths, part, codes = _unpack(docs["packed"][0].as_py())
        found = [_unpack(p) for p in of_words.sort_by("part")["packed"].to_pylist()]
        counts = np.concatenate([*(c for c, _ in found), np.zeros(0)]).astype(np.int64)
        flat = np.concatenate([*(x for _, x in found), np.zeros(0)]).astype(np.int32)
        order = np.argsort(part, kind="stable")  # words of a part keep their order
        starts, own_counts = np.empty_like(counts), np.empty_like(counts)
        starts[order], own_counts[order] = np.cumsum(counts) - counts, counts
        bounds, ids_of_docs, out = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]), docs["doc_ids"][0].values, []
        for a in range(0, len(lengths), 500):
            b = min(a + 500, len(lengths))
            ids, begins = expanded(flat, starts, own_counts, codes[bounds[a] : bounds[b]])
            edges = begins[bounds[a : b + 1] - bounds[a]]
            decoded = pa.array([own.decode(ids[x:y]) for x, y in zip(edges[:-1], edges[1:], strict=True)], pa.binary())
            lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids))
            out.append(pa.RecordBatch.from_arrays([ids_of_docs.slice(a, b - a), pa.array(np.diff(edges), pa.int64()), lists, decoded], ["doc_id", "n_tokens", "ids", "decoded"]))
        return pa.Table.from_batches(out)

    return run


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (array of int) and decoded (the bytes that the ids give) of whole texts."""
    docs = common.keyed(docs, id_col, text_col)
    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = min(PARTS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    split = docs.mapInArrow(_split(pattern, parts), f"block bigint, part int, doc_ids array<{kind}>, packed binary")
    split = common.bucketed(split, "bpe_words", "block", parts)
    words = split.where("part >= 0").select("block", "part", "packed").repartition(parts, "part").sortWithinPartitions("part")
    ids = words.mapInArrow(_replayed(ranks_path, pattern), "block bigint, part int, packed binary")
    blocks = split.where("part < 0").groupBy("block").cogroup(ids.groupBy("block"))  # only ids are shuffled
    return blocks.applyInArrow(_assembled(ranks_path, pattern), f"doc_id {kind}, n_tokens bigint, ids array<int>, decoded binary")
