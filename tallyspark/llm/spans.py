"""Removal of repeated passages by sliding sentence spans.

Words are what ASCII white space parts, and each character from U+3000 on. A sentence ends at a word with
final punctuation and at a line end; of any WINDOW successive words of one sentence the one with the
smallest hash begins a further piece, so equal passages are cut equally whatever is around them. Pieces
count as sentences from here on. At every sentence a span begins: as many consecutive sentences as it
takes to WORDS words, of which no sentence has more than WINDOW + 1. A text of LEAST words or more that has
no such span is one span. Spans are hashed (96 bits over words with A-Z lower-cased) and compared over
the whole corpus; of the places of one hash the first, by doc_id, text (its crc32) and start, stays, and
all sentences that another place covers are removed.

WORDS is a floor: runs of sentences with fewer words together aren't hashed, so that greetings, headings and licence lines
that recur in texts of their own stay (of pairs of equal sentences in differing texts, none is found with 8 to 19 words
together, all are with 24 and more). A passage of 4 * WINDOW - 4 + WORDS words (48) or more always holds a span that doesn't depend on what is
beside it: cuts may differ in its first and last WINDOW - 1 words only.

Null and empty texts have no spans and stay as they are. Very long texts are read in stretches. Rows that
share doc_id and text count as one document and all stay alike; rows with a null doc_id are neither
compared nor changed. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import common

WORDS, WINDOW, LEAST = 20, 8, 10
#: Bytes that are looked at together, bytes of texts whose spans leave a task together, and bytes of texts to a part of the hash range.
STRETCH, FLUSH, PART_BYTES = 1 << 20, 8 << 20, 16 << 20
_U64 = np.uint64
_STEPS = (_U64(0x9E3779B97F4A7C15), _U64(0xC2B2AE3D27D4EB4F))
_FINAL = np.zeros(256, bool)
_FINAL[list(b".!?")] = True
_CLOSING = np.zeros(256, bool)
_CLOSING[list(b"\"')]")] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(31))) * _U64(0x7FB5D329728EA185)
    x = (x ^ (x >> _U64(27))) * _U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U64(33))


def _range_hashes(x: np.ndarray, starts: np.ndarray, ends: np.ndarray, step: np.uint64) -> np.ndarray:
    """A polynomial hash of x[start:end] for each range, by prefix sums."""
    n = len(x)
    sums = np.zeros(n + 1, _U64)
    np.cumsum(x * np.cumprod(np.full(n, step)), out=sums[1:])
    back = np.cumprod(np.full(n + 1, _U64(pow(int(step), -1, 2**64))))
    return _mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(_U64))


class Words:
    """The words of some texts one after another: first byte (from the text's start), text, whether a
    sentence begins, and two hashes."""

    def __init__(self, texts: list[bytes]):
        parts = [self._stretch(*x) for x in self._stretches(texts)]
        self.start, self.text, opens, closes, one, two = (np.concatenate([p[k] for p in [*parts, self._stretch([0], [0], [b""])]]) for k in range(6))
        self.hashes, self.opens = (one, two), np.ones(len(self.text), bool)
        self.opens[1:] = opens[1:] | closes[:-1] | (self.text[1:] != self.text[:-1])

    @staticmethod
    def _stretches(texts: list[bytes]) -> Iterator[tuple[list[int], list[int], list[bytes], bool]]:
        """Numbers, offsets and bytes of texts in stretches; long texts are parted behind white space."""
        some, size = ([], [], []), 0
        for i, t in enumerate(texts):
            at = 0
            while at < len(t):
                end = min(len(t), at + STRETCH)
                if end < len(t):
                    space = max(t.rfind(b" ", at, end), t.rfind(b"\n", at, end))
                    if space > at:
                        end = space + 1
                    else:
                        while end > at + 1 and t[end] & 0xC0 == 0x80:
                            end -= 1
                for column, value in zip(some, (i, at, t[at:end]), strict=True):
                    column.append(value)
                size += end - at
                at = end
                if size >= STRETCH:
                    yield some
                    some, size = ([], [], []), 0
        if some[0]:
            yield some

    @staticmethod
    def _stretch(index: list[int], offsets: list[int], pieces: list[bytes]) -> tuple[np.ndarray, ...]:
        raw = np.frombuffer(b" ".join([*pieces, b""]), np.uint8)  # a space behind each
        sizes = np.array([len(p) + 1 for p in pieces])
        stops = np.cumsum(sizes)
        word = ~_SPACE[raw]
        lead = raw >= 0xE3  # a character of three bytes or more, from U+3000 on
        begins = word.copy()
        begins[1:] = word[1:] & (~word[:-1] | lead[1:])
        if lead.any():  # what follows such a character begins a word, too
            after = np.flatnonzero(lead) + np.where(raw[lead] >= 0xF0, 4, 3)
            after = after[after < len(raw)]
            begins[after[word[after]]] = True
        start = np.flatnonzero(begins)
        if not len(start):
            none = np.zeros(0, np.int64)
            return none, none, none.astype(bool), none.astype(bool), none.astype(_U64), none.astype(_U64)
        spaces = np.flatnonzero(~word)
        end = np.minimum(spaces[np.searchsorted(spaces, start)], np.append(start[1:], len(raw)))
        last = raw[end - 1]
        ended = _FINAL[last] | (_CLOSING[last] & (end - start > 1) & _FINAL[raw[np.maximum(end - 2, 0)]])
        lines = np.append(np.cumsum(raw == 10), 0)
        lines[-1] = lines[-2]
        closes = ended | (lines[np.append(start[1:], len(raw))] != lines[start])
        owner = np.searchsorted(stops, start, side="right")
        opens = np.zeros(len(start), bool)  # a line end between a stretch's start and its first word
        opens[0] = lines[start[0]] > 0
        folded = _LOWER[raw].astype(_U64) + _U64(1)
        one, two = (_range_hashes(folded, start, end, step) for step in _STEPS)
        place = start - (stops - sizes)[owner] + np.array(offsets)[owner]
        return place, np.array(index)[owner], opens, closes, one, two


def cuts(words: Words) -> np.ndarray:
    """The words at which sentences begin."""
    n, rank = len(words.text), (words.hashes[0] >> _U64(28) << _U64(28)) | (_U64(2**28 - 1) - np.arange(len(words.text), dtype=_U64) % _U64(2**28))
    begins = words.opens.copy()
    if n >= WINDOW:
        low, span = rank, 1  # the smallest rank of each window; of equal words the last's
        while span * 2 <= WINDOW:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < WINDOW:
            low = np.minimum(low[: len(low) - (WINDOW - span)], low[WINDOW - span :])
        opened = np.concatenate([[0], np.cumsum(words.opens)])
        inside = np.flatnonzero(opened[WINDOW:] == opened[: n - WINDOW + 1])
        at = (2**28 - 1 - (low[inside] & _U64(2**28 - 1)).astype(np.int64)) + (inside >> 28 << 28)
        begins[np.where(at < inside, at + 2**28, at)] = True
    return np.flatnonzero(begins)


def spans(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Text, two hashes, first and last byte (exclusive, the white space behind it included) of each span."""
    words = Words(texts)
    begin = cuts(words)
    n = len(words.text)
    bounds = np.append(np.flatnonzero(np.diff(words.text, prepend=-1)), n)  # of the texts, in words
    stop = bounds[np.searchsorted(bounds, begin, side="right")] if n else begin
    every = np.append(begin, n)
    end = every[np.minimum(np.searchsorted(every, begin + WORDS), len(every) - 1)]
    good = (begin + WORDS <= stop) & (end <= stop)
    size = np.diff(bounds)
    short = (size < WORDS) & (size >= LEAST)
    begin, end = np.concatenate([begin[good], bounds[:-1][short]]), np.concatenate([end[good], bounds[1:][short]])
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], end[order]
    text = words.text[begin].astype(np.int64)
    ended = np.zeros(len(end), bool)
    ended[:] = (end >= n) | (words.text[np.minimum(end, n - 1)] != text) if n else ended
    last = np.where(ended, np.array([len(t) for t in texts], np.int64)[text], words.start[np.minimum(end, max(0, n - 1))] if n else 0)
    one, two = (_range_hashes(h, begin, end, step) for h, step in zip(words.hashes, _STEPS[::-1], strict=True))
    two >>= _U64(32)
    return text, one, two, words.start[begin].astype(np.int64), last.astype(np.int64)


_SENT = "part int, ids array<{id}>, rows binary, doc binary, one binary, two binary, start binary, end binary, n int"
_TYPES = {"rows": np.int64, "doc": np.int32, "one": _U64, "two": np.uint32, "start": np.uint32, "end": np.uint32}


def _scan(parts: int, kind: pa.DataType):
    """Per part of the hash range the spans of some texts (``n``) that are the first of their hash among these texts, so a part
    gets a hash once from each batch of texts. The others are repeats already; they go to parts below 0, dealt by
    batch, so a span that most texts have doesn't gather anywhere."""

    def batch_of(ids: list, rows: np.ndarray, found: list[tuple]) -> pa.RecordBatch:
        doc, one, two, start, end = (np.concatenate([f[k] for f in found]) for k in range(5))
        ranked = np.unique(np.array(ids), return_inverse=True)[1] if ids else np.zeros(0, np.int64)
        order = np.lexsort((start, rows[doc], ranked[doc], two, one))
        doc, one, two, start, end = (x[order] for x in (doc, one, two, start, end))
        lead = np.ones(len(doc), bool)
        lead[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        group = np.cumsum(lead) - 1
        first = np.flatnonzero(lead)[group] if len(doc) else group
        same = lambda x: x[first] == x  # noqa: E731  rows of one document are all first
        lead |= same(start) & same(rows[doc]) & same(ranked[doc])
        part = ((one >> _U64(40)) * _U64(parts) >> _U64(24)).astype(np.int64)
        out = []

        def send(p: int, here: np.ndarray, n: int) -> None:
            docs, number = np.unique(doc[here], return_inverse=True)
            out.append((p, [ids[d] for d in docs.tolist()], rows[docs].tobytes(), *(x.astype(t).tobytes() for x, t in ((number, np.int32), (one[here[:n]], _U64), (two[here[:n]], np.uint32), (start[here], np.uint32), (end[here], np.uint32))), n))

        heads, known = np.flatnonzero(lead), np.flatnonzero(~lead)
        some, at = np.unique(part[heads], return_index=True)  # ascending, as the hashes are
        for p, a, b in zip(some.tolist(), at.tolist(), [*at[1:].tolist(), len(heads)], strict=False):
            send(p, heads[a:b], b - a)
        if len(known):  # nothing is compared with these: they go wherever there is room
            send(-1 - int(rows[doc[known[0]]] % parts), known, 0)
        kinds = (pa.int32(), pa.list_(kind), *[pa.binary()] * 6, pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [()] * 9, kinds, strict=True)], ["part", "ids", *_TYPES, "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, found, size = [], [], [], 0
        for batch in common.slices(batches, most_bytes=STRETCH):
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            text, *rest = spans(texts)
            found.append((text + len(ids), *rest))
            ids += batch.column("doc_id").to_pylist()
            rows += [zlib.crc32(t) for t in texts]
            size += sum(map(len, texts))
            if size >= FLUSH:
                yield batch_of(ids, np.array(rows, np.int64), found)
                ids, rows, found, size = [], [], [], 0
        if found:
            yield batch_of(ids, np.array(rows, np.int64), found)

    return run


def _repeats(kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of a part, all spans but the first of each hash; of a part below 0, all."""
        for _, sent in common.runs(batches, "part"):
            of = {c: [np.frombuffer(r[c], t) for r in sent] for c, t in _TYPES.items()}
            ids = [i for r in sent for i in r["ids"]]
            shift = np.cumsum([0, *(len(r["ids"]) for r in sent[:-1])])
            sizes, heads = [len(x) for x in of["start"]], [r["n"] for r in sent]
            doc = np.concatenate([d + s for d, s in zip(of["doc"], shift.tolist(), strict=True)])
            start, end, rows = (np.concatenate(of[c]) for c in ("start", "end", "rows"))
            head = np.concatenate([np.arange(s) < h for s, h in zip(sizes, heads, strict=True)])
            gone = ~head
            one, two, at = np.concatenate(of["one"]), np.concatenate(of["two"]), np.flatnonzero(head)
            _, number, n = np.unique(one, return_inverse=True, return_counts=True)
            several = n[number] > 1
            one, two, at = one[several], two[several], at[several]
            if len(at):
                keys = np.array(ids)
                _, ranked = np.unique(keys, return_inverse=True)
                order = np.lexsort((start[at], rows[doc[at]], ranked[doc[at]], two, one))
                one, two, at = one[order], two[order], at[order]
                lead = np.ones(len(at), bool)
                lead[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
                first = at[np.flatnonzero(lead)[np.cumsum(lead) - 1]]
                own = (ranked[doc[first]] == ranked[doc[at]]) & (rows[doc[first]] == rows[doc[at]]) & (start[first] == start[at])
                gone[at[~own]] = True
            which = np.flatnonzero(gone)
            owners = pa.array(ids, kind).take(pa.array(doc[which]))
            yield pa.RecordBatch.from_arrays([owners, *(pa.array(x.astype(np.int64)) for x in (rows[doc[which]], start[which], end[which]))], ["doc_id", "row", "start", "end"])

    return run


def _left(kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of a document's repeats, what is left: where each kept stretch begins, and its length in bytes."""
        for batch in common.slices(batches):
            starts, sizes = [], []
            for ranges in batch.column("ranges").to_pylist():
                at, begins, lengths = 0, [], []
                for r in sorted(ranges, key=lambda r: (r["start"], r["end"])):
                    if r["start"] > at:
                        begins.append(at)
                        lengths.append(r["start"] - at)
                    at = max(at, r["end"])
                starts.append([*begins, at])
                sizes.append([*lengths, 2**31 - 1 - at])  # the rest
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), pa.array(starts, pa.list_(pa.int32())), pa.array(sizes, pa.list_(pa.int32()))], ["doc_id", "row", "starts", "sizes"])

    return run


def kept_ranges(docs: DataFrame) -> DataFrame:
    """doc_id, row (crc32 of the text), starts, sizes: the stretches of bytes that stay, of documents with a
    repeat."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    kind = docs.schema["doc_id"].dataType
    name, arrow = kind.simpleString(), to_arrow_type(kind)
    sent = docs.where("doc_id is not null").mapInArrow(_scan(max(1, -(-size // PART_BYTES)), arrow), _SENT.format(id=name))
    repeats = sent.repartition("part").sortWithinPartitions("part").mapInArrow(_repeats(arrow), f"doc_id {name}, row bigint, start bigint, end bigint")
    ranges = repeats.groupBy("doc_id", "row").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    return common.stored(ranges.mapInArrow(_left(arrow), f"doc_id {name}, row bigint, starts array<int>, sizes array<int>"), "kept-ranges")


def remove_repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with all their columns, repeated spans removed from the text, and removed_chars.

    A column of docs that is named removed_chars is replaced.
    """
    found = kept_ranges(common.keyed(docs, id_col, text_col))
    ids = common.small(common.stored(found.select(F.col("doc_id").alias("__id")).distinct(), "span-ids"))
    changed = docs.join(ids, docs[id_col] == F.col("__id"), "left_semi")  # only their texts are shuffled
    rest = docs.join(ids, docs[id_col] == F.col("__id"), "left_anti")
    return _stripped(changed, found, id_col, text_col).unionByName(rest.drop("removed_chars").withColumn("removed_chars", F.lit(0).cast("bigint")))


def _stripped(docs: DataFrame, kept: DataFrame, id_col: str, text_col: str) -> DataFrame:
    kept = kept.select(F.col("doc_id").alias("__doc"), F.col("row").alias("__row"), F.arrays_zip("starts", "sizes").alias("__kept"))
    row = F.crc32(F.coalesce(docs[text_col], F.lit("")))
    joined = docs.join(kept, (docs[id_col] == F.col("__doc")) & (row == F.col("__row")), "left")
    pieces = F.transform("__kept", lambda r: F.decode(F.substring(F.col(text_col).cast("binary"), r["starts"] + 1, r["sizes"]), "UTF-8"))
    found = joined.withColumn("__left", F.when(F.col("__kept").isNull(), F.col(text_col)).otherwise(F.array_join(pieces, "")))
    out = [F.col("__left").alias(c) if c == text_col else F.col(c) for c in docs.columns if c != "removed_chars"]
    gone = F.coalesce(F.length(text_col) - F.length("__left"), F.lit(0)).cast("bigint")
    return found.select(*out, gone.alias("removed_chars"))
