"""Language-model scores by masked pseudo-likelihood.

Every word is predicted from the two words to its left and the two to its right. A window network,
trained in numpy, gives it the probability

    net = p(class | window) * p(member | class, window) * n(word) / n(code)

where code = (class, member): the FREQUENT commonest words of the corpus have a code of their own (the
last factor is 1), the others share CODES - FREQUENT codes by hash. The corpus around it then has its
say: with M other places in the corpus that have the same four neighbours, and m of them the same word,

    p(word | window) = (m + WEIGHT * net) / (M + WEIGHT)

so a place is never predicted from itself. A document's score is the sum of the logarithms.

All counts run over the whole corpus and grow with it: slices of documents send what they count, dealt
by hash, to parts of about PART keys each, and get the corpus's counts of their own keys back. The
network learns in tasks, each from its own slices, and the tasks' weights are averaged after each of
ROUNDS rounds. It learns from every place of the corpus once: a slice's places are dealt to the rounds in turn.

Null and empty texts have no words and score 0, with a null mean. Rows are independent: repeated rows
get equal scores and count as often as they occur; null ids stay. Words of equal count are ordered by
their hash. Very long texts are slices of their own. An empty table gives an empty result. Other columns
of docs are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .pieces import words

CLASSES, MEMBERS = 64, 64
CODES, FREQUENT = CLASSES * MEMBERS, 3072
EDGE = CODES  # the code beside a text's ends
EMBEDDING, HIDDEN, RATE, BATCH, SEED = 16, 32, 0.01, 4096, 7
BLOCK = 464  # places: (HIDDEN + 1) * CLASSES * BLOCK is below a million, and products of that size were fastest
ROUNDS, WEIGHT = 2, 1.0
PART, SLICE_ROWS, SLICE_BYTES = 1 << 19, 4000, 4 << 20
_END = np.uint64(0x9E3779B97F4A7C15)  # the word beside a text's ends
_SLICE = "slice string, docs array<{id}>, sizes binary, codes binary, words binary, tokens bigint"
_U64 = np.uint64


def _slice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches, SLICE_ROWS, SLICE_BYTES):
        distinct, codes, offsets = words(batch.column("text"))
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w.lower().encode()) for w in distinct), _U64, len(distinct))
        vocabulary, of = np.unique(hashes, return_inverse=True)
        found = (np.diff(offsets).astype(np.int64), of[codes].astype(np.uint16 if len(vocabulary) <= 2**16 else np.uint32), vocabulary)
        docs = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column("doc_id"))
        yield pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), docs, *(pa.array([x.tobytes()], pa.binary()) for x in found), pa.array([len(codes)], pa.int64())], ["slice", "docs", "sizes", "codes", "words", "tokens"])


class Slice:
    """The words of some documents one after another, as numbers of distinct words."""

    def __init__(self, row: dict):
        self.sizes, self.words = np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["words"], _U64)
        self.codes = np.frombuffer(row["codes"], np.uint16 if len(self.words) <= 2**16 else np.uint32).astype(np.int64)
        filled = self.sizes[self.sizes > 0]
        self.at = np.arange(len(self.codes)) + 2 + 2 * np.repeat(np.arange(len(filled)), filled)  # two ends between texts

    def padded(self, of: np.ndarray, end) -> np.ndarray:
        """of[codes] with two ends before each text and behind the last."""
        out = np.full((self.at[-1] + 3) if len(self.at) else 2, end, of.dtype)
        out[self.at] = of[self.codes]
        return out

    def windows(self) -> np.ndarray:
        """A hash of the four neighbours of each word."""
        x = self.padded(self.words, _END)
        h = np.zeros(len(self.at), _U64)
        for step in (-2, -1, 1, 2):
            h = (h ^ (h >> _U64(32))) * _U64(0xBF58476D1CE4E5B9) + x[self.at + step]
            h = (h ^ (h >> _U64(29))) * _U64(0x94D049BB133111EB)
        return h ^ (h >> _U64(32))

    def neighbours(self, codes: np.ndarray, places: slice = slice(None)) -> np.ndarray:
        """(words, 4) codes of the neighbours, of some places or all."""
        x, at = self.padded(codes, EDGE), self.at[places]
        return np.stack([x[at + step] for step in (-2, -1, 1, 2)], axis=1)

    def keyed(self, parts: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Per part of the hash range that holds windows of the slice: its number, the words' places, distinct keys, the key of
        each place and how often each key occurs. A key has 32 bits of the window, which the part's number completes, and 16 of
        the word: of PART windows one in 10,000 is taken for another, at any size of the corpus."""
        h = self.windows()
        part = _part(h, parts)
        keys = (h & _U64(0xFFFFFFFF)) << _U64(16) | (self.words & _U64(0xFFFF))[self.codes]
        order = np.argsort(part, kind="stable")
        some, starts = np.unique(part[order], return_index=True)
        for p, places in zip(some.tolist(), np.split(order, starts[1:]) if len(order) else (), strict=True):
            distinct, of, n = np.unique(keys[places], return_inverse=True, return_counts=True)
            yield p, places, distinct, of, n


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> _U64(40)) * _U64(parts) >> _U64(24)).astype(np.int64 if parts > 32767 else np.int16)


_GIVEN = "kind int, part int, slice string, high binary, low binary, n binary"


def _packed(kind: int, keys: np.ndarray) -> tuple[bytes, bytes]:
    """Whole hashes of words, or 32 and 16 bits of windows' keys."""
    return ((keys >> _U64(16)).astype(np.uint32).tobytes(), (keys & _U64(0xFFFF)).astype(np.uint16).tobytes()) if kind else (keys.tobytes(), b"")


def _unpacked(kind: int, high: bytes, low: bytes) -> np.ndarray:
    return np.frombuffer(high, np.uint32).astype(_U64) << _U64(16) | np.frombuffer(low, np.uint16) if kind else np.frombuffer(high, _U64)


def _give(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x, out = Slice(row), []
                n = np.bincount(x.codes, minlength=len(x.words))
                part = _part(x.words, parts)  # ascending, as the words are
                some, starts = np.unique(part, return_index=True)
                for p, a, b in zip(some.tolist(), starts.tolist(), np.append(starts, len(part))[1:].tolist(), strict=True):
                    out.append((0, p, row["slice"], *_packed(0, x.words[a:b]), n[a:b].astype(np.int32).tobytes()))
                out += [(1, p, row["slice"], *_packed(1, distinct), n.astype(np.int32).tobytes()) for p, _, distinct, _, n in x.keyed(parts)]
                kinds = (pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [()] * 6, kinds, strict=True)], ["kind", "part", "slice", "high", "low", "n"])

    return run


def _total(least: int):
    """Sums over all slices of a part. Words that occur ``least`` times or more are also given out as kind 2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (kind, part), rows in common.runs(batches, "kind", "part"):
            keys = _unpacked(kind, *(b"".join(r[c] for r in rows) for c in ("high", "low")))
            distinct, of = np.unique(keys, return_inverse=True)
            total = np.bincount(of, np.frombuffer(b"".join(r["n"] for r in rows), np.int32)).astype(np.int64)
            ends = np.cumsum([len(r["n"]) // 4 for r in rows]).tolist()
            back = [total]
            if kind:
                first = np.flatnonzero(np.diff(distinct >> _U64(16), prepend=~distinct[:1] >> _U64(16)))
                back = [total.astype(np.float32), np.repeat(np.add.reduceat(total, first), np.diff(first, append=len(total))).astype(np.float32)]
            out = [(kind, part, r["slice"], *(x[of[a:b]].tobytes() for x in back), *[b""] * (2 - len(back))) for r, a, b in zip(rows, [0, *ends], ends, strict=False)]
            often = np.flatnonzero(total >= least) if not kind else []
            if len(often):
                out.append((2, part, "", distinct[often].tobytes(), total[often].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.binary()), strict=True)], ["kind", "part", "slice", "total", "window"])

    return run


def _often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(row[c], np.int64)) for c in ("total", "window")], ["word", "n"])


class Corpus:
    """The slices, the corpus's counts of their keys, the number of parts, and the FREQUENT words' hashes by rank."""

    def __init__(self, slices: DataFrame, counts: DataFrame, parts: int, frequent: list[int]):
        self.slices, self.counts, self.parts, self.frequent = slices, counts, parts, np.array(frequent, np.int64).view(_U64)


def gather(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Corpus:
    """Cut docs into slices and count words and windows over the whole corpus; both tables are written once."""
    docs = common.keyed(docs, id_col, text_col)
    cut = common.stored(docs.mapInArrow(_slice, _SLICE.format(id=docs.schema["doc_id"].dataType.simpleString())), "lm-slices")
    tokens = cut.agg(F.sum("tokens")).first()[0] or 0
    parts = max(1, -(-tokens // PART))
    given = cut.select("slice", "sizes", "codes", "words").mapInArrow(_give(parts), _GIVEN)
    dealt = given.repartition("kind", "part").sortWithinPartitions("kind", "part", "slice")
    least = tokens // 1_000_000 + 1  # at most a million words are so frequent
    counts = common.stored(dealt.mapInArrow(_total(least), "kind int, part int, slice string, total binary, window binary"), "lm-counts")
    often = counts.where("kind = 2").select("total", "window").mapInArrow(_often, "word bigint, n bigint")
    frequent = [r.word for r in often.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()]
    return Corpus(cut, counts.where("kind < 2"), parts, frequent)


class Network:
    """Log-probabilities of codes from the codes of four neighbours, by a hierarchical softmax.

    All weights are one vector. A softmax's biases are its matrix's last column, for which hidden layers end in a 1. Scores
    and hidden layers have a column for each place, so that numpy's passes over them run along the places.
    """

    SHAPES = {"embedding": (CODES + 1, EMBEDDING), "inner": (4 * EMBEDDING, HIDDEN), "inner_bias": (HIDDEN,), "outer_all": (CLASSES, HIDDEN + 1), "last_all": (CLASSES, MEMBERS, HIDDEN + 1)}

    def __init__(self, mass: np.ndarray):
        """Random weights; the biases are the logarithms of the codes' frequencies."""
        rng = np.random.default_rng(SEED)
        self.vector = np.zeros(sum(int(np.prod(s)) for s in self.SHAPES.values()), np.float32)
        w = self.weights
        for k in ("embedding", "inner", "inner_bias", "outer", "outer_bias", "last"):
            w[k][:] = rng.normal(0, 0.1, w[k].shape)
        smooth = mass.reshape(CLASSES, MEMBERS) + 0.5
        w["outer_bias"][:] = np.log(smooth.sum(axis=1) / smooth.sum())
        w["last_bias"][:] = np.log(smooth / smooth.sum(axis=1, keepdims=True))
        w["inner_bias"][:] = 0

    @classmethod
    def views(cls, vector: np.ndarray) -> dict[str, np.ndarray]:
        """The parts of a vector of all weights, by name."""
        out, at = {}, 0
        for k, s in cls.SHAPES.items():
            n = int(np.prod(s))
            out[k] = vector[at : at + n].reshape(s)
            at += n
        for k in ("outer", "last"):
            both = out[f"{k}_all"]
            out[k], out[f"{k}_bias"] = both[..., :HIDDEN].swapaxes(-1, -2), both[..., HIDDEN]
        return out

    @property
    def weights(self) -> dict[str, np.ndarray]:
        return self.views(self.vector)

    def flat(self) -> np.ndarray:
        return self.vector.copy()

    def take(self, flat: np.ndarray) -> None:
        self.vector[:] = flat

    @staticmethod
    def _hidden(w: dict[str, np.ndarray], window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, 4 * EMBEDDING) and (HIDDEN + 1, places), whose last row is 1."""
        inside = w["embedding"].take(window.ravel(), axis=0).reshape(len(window), -1)
        hidden = np.ones((HIDDEN + 1, len(window)), np.float32)
        own = np.matmul(w["inner"].T, inside.T, out=hidden[:HIDDEN])
        own += w["inner_bias"][:, None]
        np.tanh(own, out=own)
        return inside, hidden

    @staticmethod
    def _shifted(scores: np.ndarray) -> np.ndarray:
        """Scores, less a number for each column where a sum of their exponentials could leave float32's range."""
        if not (scores.min() > -80 and scores.max() < 80):
            scores -= scores.max(axis=0)
        return scores

    @classmethod
    def _softmax(cls, scores: np.ndarray) -> np.ndarray:
        scores = cls._shifted(scores)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=0)
        return scores

    @classmethod
    def _log_softmax_at(cls, scores: np.ndarray, at: np.ndarray | int) -> np.ndarray:
        """Of one row of each column."""
        scores = cls._shifted(scores)
        own = scores[at, np.arange(scores.shape[1])]
        np.exp(scores, out=scores)
        return own - np.log(scores.sum(axis=0))

    @staticmethod
    def _spans(classes: np.ndarray) -> list[tuple[int, int, int]]:
        """Ascending classes, each with its first place and the one behind its last."""
        ends = np.searchsorted(classes, np.arange(CLASSES + 1)).tolist()
        return [(c, a, b) for c, (a, b) in enumerate(zip(ends, ends[1:], strict=False)) if a < b]

    def log_p(self, window: np.ndarray, codes: np.ndarray, block: int = BLOCK) -> np.ndarray:
        w, out = self.weights, np.empty(len(codes), np.float32)
        order = np.argsort(codes.astype(np.uint16), kind="stable")  # places of a class lie together
        classes = codes.take(order) // MEMBERS
        members = codes.take(order) - MEMBERS * classes
        for c, first, end in self._spans(classes):
            for a in range(first, end, block):
                places = order[a : min(a + block, end)]
                _, hidden = self._hidden(w, window.take(places, axis=0))
                outer, own = w["outer_all"] @ hidden, w["last_all"][c] @ hidden
                out[places] = self._log_softmax_at(outer, c) + self._log_softmax_at(own, members[a : a + len(places)])
        return out

    def gradients(self, window: np.ndarray, codes: np.ndarray, block: int = BLOCK) -> dict[str, np.ndarray]:
        """Of the mean negative log-probability."""
        return self.views(self._gradient(window, codes, block))

    def _gradient(self, window: np.ndarray, codes: np.ndarray, block: int = BLOCK) -> np.ndarray:
        w, n, vector = self.weights, len(codes), np.zeros_like(self.vector)
        order = np.argsort(codes.astype(np.uint16), kind="stable")  # places of a class lie together
        window, codes = window.take(order, axis=0), codes.take(order)
        grads, flat, begun = self.views(vector), np.empty((4 * EMBEDDING, n), np.float32), -1
        last, last_back, of_last = w["last_all"], w["last"], grads["last_all"]
        classes = codes // MEMBERS
        members, columns, spans = codes - MEMBERS * classes, np.arange(n), self._spans(classes)
        for first in range(0, n, block):
            places = slice(first, first + block)
            inside, hidden = self._hidden(w, window[places])
            hidden_rows = np.ascontiguousarray(hidden.T)
            out = self._softmax(w["outer_all"] @ hidden)
            out[classes[places], columns[: out.shape[1]]] -= 1
            back = w["outer"] @ out
            grads["outer_all"] += out @ hidden_rows
            own, more = out, np.empty_like(back)  # the classes' scores are done with
            here = [(c, max(a - first, 0), min(b - first, block)) for c, a, b in spans if a < first + block and b > first]
            for c, a, b in here:
                np.matmul(last[c], hidden[:, a:b], out=own[:, a:b])
            own = self._softmax(own)
            own[members[places], columns[: own.shape[1]]] -= 1
            for c, a, b in here:
                some = own[:, a:b]
                if c == begun:  # in the block before
                    of_last[c] += some @ hidden_rows[a:b]
                else:
                    np.matmul(some, hidden_rows[a:b], out=of_last[c])
                np.matmul(last_back[c], some, out=more[:, a:b])
            begun = c
            back += more
            slope = hidden[:HIDDEN]
            slope *= slope
            back *= np.subtract(1, slope, out=slope)
            grads["inner"] += inside.T @ back.T
            grads["inner_bias"] += back.sum(axis=1)
            np.matmul(w["inner"], back, out=flat[:, places])
        at, flat = window.T.ravel(), flat.reshape(4, EMBEDDING, n)
        for k in range(EMBEDDING):
            grads["embedding"][:, k] = np.bincount(at, flat[:, k].ravel(), CODES + 1)
        vector /= n
        return vector

    def learn(self, windows: Iterator[tuple[np.ndarray, np.ndarray]]) -> int:
        """Adam steps over batches of (window, codes); how many places there were."""
        m, v = np.zeros_like(self.vector), np.zeros_like(self.vector)
        step = seen = 0
        for window, codes in windows:
            for a in range(0, len(codes), BATCH):
                step += 1
                seen += len(codes[a : a + BATCH])
                self._step(self._gradient(window[a : a + BATCH], codes[a : a + BATCH]), m, v, step)
        return seen

    def _step(self, g: np.ndarray, m: np.ndarray, v: np.ndarray, step: int) -> None:
        """Adam's step ``step``. ``m`` is ten times, ``v`` a hundred times the mean that Adam keeps; ``g`` is used up."""
        root = 0.1 / np.sqrt(1 - 0.99**step).item()
        m *= 0.9
        m += g
        v *= 0.99
        g *= g
        v += g
        np.sqrt(v, out=g)
        g += 1e-8 / root
        np.divide(m, g, out=g)
        g *= RATE * 0.1 / (1 - 0.9**step) / root
        self.vector -= g


class Coder:
    """The code of any word."""

    def __init__(self, frequent: np.ndarray):
        self.order = np.argsort(frequent)
        self.sorted = frequent[self.order]

    def codes(self, vocabulary: np.ndarray) -> np.ndarray:
        out = FREQUENT + (vocabulary % _U64(CODES - FREQUENT)).astype(np.int64)
        if len(self.sorted):
            at = np.minimum(np.searchsorted(self.sorted, vocabulary), len(self.sorted) - 1)
            out = np.where(self.sorted[at] == vocabulary, self.order[at], out)
        return out


class Model:
    def __init__(self, coder: Coder, mass: np.ndarray, network: Network):
        self.coder, self.mass, self.network = coder, mass, network

    def log_p(self, x: Slice, n: np.ndarray, places: np.ndarray, same: np.ndarray) -> np.ndarray:
        """Of each word of a slice: n, the corpus's count of each distinct word; per place how many places have its window, and
        how many its window and word, itself included."""
        codes = self.coder.codes(x.words)
        share = n / np.maximum(self.mass[codes], 1)
        net = np.exp(self.network.log_p(x.neighbours(codes), codes[x.codes]).astype(np.float64)) * share[x.codes]
        return np.log((same - 1 + WEIGHT * net) / (places - 1 + WEIGHT))


def _mass(coder: Coder):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(CODES, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                x = Slice(row)
                seen += np.bincount(coder.codes(x.words)[x.codes], minlength=CODES)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["code", "n"])

    return run


_WEIGHTS, _BLOCK = "block int, n bigint, sums binary", 1 << 12


def _blocks(n: int, flat: np.ndarray) -> pa.RecordBatch:
    parts = [flat[a : a + _BLOCK].tobytes() for a in range(0, len(flat), _BLOCK)]
    return pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([n] * len(parts), pa.int64()), pa.array(parts, pa.binary())], ["block", "n", "sums"])


def _learn(shared, turn: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, mass, flat = shared.value
        network = Network(mass)
        if flat is not None:
            network.take(flat)

        def chosen():
            for batch in batches:
                for row in batch.to_pylist():
                    x = Slice(row)
                    codes = coder.codes(x.words)
                    own = slice(turn, None, ROUNDS)
                    yield x.neighbours(codes, own), codes[x.codes[own]]

        seen = network.learn(chosen())
        yield _blocks(seen, network.flat().astype(np.float64) * seen)

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, tuple[int, np.ndarray]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            n, x = sums.get(row["block"], (0, 0))
            sums[row["block"]] = n + row["n"], x + np.frombuffer(row["sums"], np.float64)
    columns = zip(*((k, n, x.tobytes()) for k, (n, x) in sums.items()), strict=True) if sums else ((), (), ())
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int64(), pa.binary()), strict=True)], ["block", "n", "sums"])


def fit(corpus: Corpus) -> Model:
    """Code counts over the whole corpus, then ROUNDS rounds of learning. The driver gets CODES rows and one set of weights a round."""
    spark, coder, mass = corpus.slices.sparkSession, Coder(corpus.frequent), np.zeros(CODES, np.int64)
    counted = corpus.slices.select("sizes", "codes", "words").mapInArrow(_mass(coder), "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))
    for r in counted.collect():
        mass[r.code] = r.n
    network, flat = Network(mass), None
    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast((coder, mass, flat))
        learnt = corpus.slices.select("sizes", "codes", "words").mapInArrow(_learn(shared, turn), _WEIGHTS)
        rows = learnt.repartition("block").mapInArrow(_summed, _WEIGHTS).orderBy("block").collect()
        if rows and rows[0].n:
            flat = np.concatenate([np.frombuffer(r.sums, np.float64) / r.n for r in rows]).astype(np.float32)
            network.take(flat)
    return Model(coder, mass, network)


def score(corpus: Corpus, model: Model) -> DataFrame:
    """doc_id, n_tokens, log_likelihood (natural logarithm) and per_token of every document."""
    kind = corpus.slices.schema["docs"].dataType.elementType.simpleString()
    shared, parts = corpus.slices.sparkSession.sparkContext.broadcast(model), corpus.parts

    def run(slices: pa.Table, counts: pa.Table) -> pa.Table:
        x = Slice(slices.select(["sizes", "codes", "words"]).to_pylist()[0])
        back = {(r["kind"], r["part"]): r for r in counts.to_pylist()}
        of = lambda key, column: np.frombuffer(back[key][column], np.float32 if key[0] else np.int64)
        n = np.concatenate([np.zeros(0, np.int64), *(of(k, "total") for k in sorted(back) if k[0] == 0)])
        places, same = np.empty(len(x.codes)), np.empty(len(x.codes))
        for p, at, _, key, _ in x.keyed(parts):
            same[at], places[at] = of((1, p), "total")[key], of((1, p), "window")[key]
        log_p = shared.value.log_p(x, n, places, same)
        sums = np.bincount(np.repeat(np.arange(len(x.sizes)), x.sizes), log_p, minlength=len(x.sizes)).astype(np.float64)
        means = pa.array(sums / np.maximum(x.sizes, 1), mask=x.sizes == 0)
        return pa.Table.from_arrays([slices.column("docs").combine_chunks().flatten(), pa.array(x.sizes), pa.array(sums), means], ["doc_id", "n_tokens", "log_likelihood", "per_token"])

    counted = corpus.counts.select("slice", "kind", "part", "total", "window")
    return corpus.slices.select("slice", "docs", "sizes", "codes", "words").groupBy("slice").cogroup(counted.groupBy("slice")).applyInArrow(run, f"doc_id {kind}, n_tokens bigint, log_likelihood double, per_token double")
