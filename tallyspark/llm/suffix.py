"""Removal of repeated byte strings with suffix arrays, built by Lyndon grouping.

Each byte covered by a string of LENGTH bytes that also starts earlier (smaller doc_id, or the same
document and an earlier start) goes; matches stay within documents.

1. Every window of LENGTH bytes belongs to the smallest hash among its GRAM-byte strings, the leftmost
   of ties: its anchor. Consecutive windows with one anchor form a segment of at most 2 * LENGTH - GRAM
   bytes. Equal windows have equal anchors at equal places, so they meet under the anchor's hash.
2. Segments whose anchor occurs once are dropped. Of equal segments (by 64 bits more) all but the first
   repeat it entirely; only first segments go on, and only where their anchor has several.
3. Per anchor, the suffix array of these segments brings equal windows together: all but the earliest
   of each are repeats. Anchors with more than MOST different segments are split by window instead.

Null texts count as empty. Rows that share doc_id and text are one document. Rows with a null doc_id
are left whole and compared with nothing. doc_id must be an integer.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

LENGTH, GRAM, MOST = 100, 24, 4096
BATCH_BYTES = 1 << 20
_bytes = np.random.default_rng(20240311).integers(0, 2**64, 256, np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
#: place: start (32 bits), anchor's offset (7), windows (7), 16 bits of the text's hash
_OFFSET, _WINDOWS, _ROW = 23, 16, 0


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _row(text: bytes) -> int:
    return zlib.crc32(text) & 0xFFFF


def segments(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Per segment of the texts: text's index, start, anchor's offset, windows, anchor's hash, hash of
    the segment. The texts together must be shorter than 2**24 bytes, unless there is just one."""
    flat = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    none = np.zeros(0, np.int64)
    if len(flat) < LENGTH:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    base = _bytes[flat]
    hashed, span, power = base, 1, _STEP
    wide = {1: base}
    while span * 2 <= GRAM:
        hashed = hashed[:-span] * power + hashed[span:]
        span, power = span * 2, _power(span * 2)
        wide[span] = hashed
    done, total = span, hashed
    while done < GRAM:  # the binary digits of GRAM
        part = 1 << (GRAM - done).bit_length() - 1
        m = len(flat) - done - part + 1
        total = total[:m] * _power(part) + wide[part][done : done + m]
        done += part
    hashed = _mixed(total)
    mask = np.uint64(2**24 - 1)
    low = (hashed & ~mask) | np.arange(len(hashed), dtype=np.uint64) if len(hashed) <= 2**24 else None
    if low is None:
        raise ValueError("too much text at once")
    window, span = LENGTH - GRAM + 1, 1
    while span * 2 <= window:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < window:
        low = np.minimum(low[: len(low) - (window - span)], low[window - span :])
    anchor = (low & mask).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])[: len(anchor)]
    valid = np.arange(len(anchor)) + LENGTH <= ends[owner]
    breaks = np.ones(len(anchor) + 1, bool)
    breaks[1:-1] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]) | (valid[1:] != valid[:-1])
    at = np.flatnonzero(breaks)
    first, last = at[:-1], at[1:]
    good = valid[first]
    first, last = first[good], last[good]
    powers = np.cumprod(np.full(len(flat), _BACK))
    sums = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(base * powers, out=sums[1:])
    forward = np.cumprod(np.full(len(flat), _STEP))
    stop = last + LENGTH - 1
    own = _mixed((sums[stop] - sums[first]) * forward[first] + (stop - first).astype(np.uint64) * np.uint64(2654435761) + (anchor[first] - first).astype(np.uint64))
    start = first - (ends - [len(t) for t in texts])[owner[first]]
    return owner[first], start, anchor[first] - first, last - first, hashed[anchor[first]], own


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_STEP), n, 2**64))


def _parts(texts: list[bytes]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Indices, offsets and texts in groups of about BATCH_BYTES; a very long text in overlapping parts."""
    some, size = ([], [], []), 0
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - LENGTH + 1), 4 * BATCH_BYTES):
            piece = t[at : at + 4 * BATCH_BYTES + LENGTH - 1]
            for column, value in zip(some, (i, at, piece), strict=True):
                column.append(value)
            size += len(piece)
            if size >= BATCH_BYTES:
                yield some
                some, size = ([], [], []), 0
    if some[0]:
        yield some


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches):
        ids = batch.column("doc_id")
        texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
        rows = np.array([_row(t) for t in texts], np.int64)
        for index, offsets, pieces in _parts(texts):
            owner, start, offset, windows, anchor, own = segments(pieces)
            index = np.array(index)[owner]
            place = (start + np.array(offsets)[owner]) << 30 | offset << _OFFSET | windows << _WINDOWS | rows[index]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(index)), pa.array(place), pa.array(anchor.view(np.int64)), pa.array(own.view(np.int64))], ["doc_id", "place", "anchor", "own"])


def _unpacked(place: int) -> tuple[int, int, int]:
    """Start, windows, row of a place."""
    return place >> 30, place >> _WINDOWS & 127, place & 0xFFFF


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches, 200):
        out = ([], [], [], [])
        for doc, text, anchors, places in zip(*(batch.column(k).to_pylist() for k in ("doc_id", "text", "anchors", "places")), strict=True):
            raw = (text or "").encode()
            row = _row(raw)
            for anchor, place in zip(anchors, places, strict=True):
                start, windows, own = _unpacked(place)
                if own == row:
                    for column, value in zip(out, (anchor, doc, place, raw[start : start + windows + LENGTH - 1]), strict=True):
                        column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["anchor", "doc_id", "place", "bytes"])


def suffix_array(text: list[int]) -> list[int]:
    """Start places of the suffixes of ``text`` in ascending order.

    Suffixes are first grouped by their first symbol. Groups are taken in descending order; a suffix's
    previous-smaller pointer leads to the last place before it whose group is lower still. The places
    pointed at leave their groups for new ones right above, by how often the group points at them; in
    the end a group holds the suffixes with one Lyndon prefix. Then the order within groups is read off
    from the smallest suffix upwards: placing a suffix places the one before it, and those its pointers
    lead to, as next of their groups.
    """
    text = [s + 1 for s in text] + [0]
    n = len(text)
    members: list[set[int]] = []
    first_of: dict[int, int] = {}
    for s in sorted(set(text)):
        first_of[s] = len(members)
        members.append(set())
    group = [first_of[s] for s in text]
    for i, g in enumerate(group):
        members[g].add(i)
    below, above = list(range(-1, len(members) - 1)), [*range(1, len(members)), -1]
    done, smaller = bytearray(n), [-1] * n
    g = len(members) - 1
    while g >= 0:
        own = sorted(members[g])
        for i in own:
            done[i] = 1
        counts: dict[int, int] = {}
        for i in own:
            j = i - 1
            while j >= 0 and done[j]:
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                counts[j] = counts.get(j, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for p, k in counts.items():
            moved.setdefault((k, group[p]), []).append(p)
        for k, old in sorted(moved, reverse=True):
            places = moved[k, old]
            if len(places) == len(members[old]):
                continue
            new = len(members)
            members[old].difference_update(places)
            members.append(set(places))
            for p in places:
                group[p] = new
            up = above[old]
            below.append(old)
            above.append(up)
            above[old] = new
            if up >= 0:
                below[up] = new
        g = below[g]
    start, at, g = [0] * len(members), 0, 0
    while below[g] >= 0:
        g = below[g]
    while g >= 0:
        start[g] = at
        at += len(members[g])
        g = above[g]
    order, placed = [-1] * n, bytearray(n)
    order[0], placed[n - 1] = n - 1, 1
    for i in range(n):
        s = order[i] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            order[start[g]] = s
            placed[s] = 1
            start[g] += 1
            s = smaller[s]
    return order[1:]


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    different = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (different.bit_length() + 7) // 8


def _reach(contexts: list[bytes]) -> list[int]:
    """Per context, how much of it another one shares: the more of its two neighbours in order."""
    order = sorted(range(len(contexts)), key=contexts.__getitem__)
    out = [0] * len(contexts)
    for i, j in zip(order, order[1:], strict=False):
        n = _shared(contexts[i], contexts[j])
        out[i], out[j] = max(out[i], n), max(out[j], n)
    return out


def repeats(bucket: list[tuple[int, int, bytes]]) -> list[tuple[int, int, int]]:
    """Of the segments (doc, place, bytes) of one anchor: doc, place and start of each repeated window.

    What lies beyond the bytes that a segment shares with any other, to either side of the anchor, is in
    no repeated window; the suffix array is built of the rest.
    """
    offsets = [place >> _OFFSET & 127 for _, place, _ in bucket]
    lefts = _reach([raw[:o][::-1] for o, (_, _, raw) in zip(offsets, bucket, strict=True)])
    rights = _reach([raw[o:] for o, (_, _, raw) in zip(offsets, bucket, strict=True)])
    text, owner, places = [], [], []
    for k, ((_, place, raw), o) in enumerate(zip(bucket, offsets, strict=True)):
        start, windows, _ = _unpacked(place)
        low, high = o - lefts[k], o + rights[k]
        if high - low >= LENGTH:
            text += [b + 1 for b in raw[low:high]]
            text.append(0)
            owner += [k] * (high - low + 1)
            places += [start + i if i < windows and i + LENGTH <= high else -1 for i in range(low, high + 1)]
    found, same, before = [], [], b""
    for at in [*suffix_array(text), None] if text else ():
        window = None
        if at is not None:
            if places[at] < 0:
                continue
            _, place, raw = bucket[owner[at]]
            offset = places[at] - (place >> 30)
            window = raw[offset : offset + LENGTH]
        if window != before and same:
            if len(same) > 1:
                found += sorted(same)[1:]
            same = []
        if window is not None:
            same.append((bucket[owner[at]][0], places[at], bucket[owner[at]][1]))
            before = window
    return [(doc, place, start) for doc, start, place in found]


def _ranges(found: list[tuple[int, int, int]], out: tuple[list, ...]) -> None:
    """Add runs of repeated windows of each segment as doc, row, start, end."""
    for (doc, row), starts in groupby(sorted((d, p & 0xFFFF, s) for d, p, s in found), lambda x: x[:2]):
        first = last = None
        for _, _, s in starts:
            if first is not None and s <= last + LENGTH:
                last = s
                continue
            if first is not None:
                for column, value in zip(out, (doc, row, first, last + LENGTH), strict=True):
                    column.append(value)
            first = last = s
        for column, value in zip(out, (doc, row, first, last + LENGTH), strict=True):
            column.append(value)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets come sorted by anchor; at most MOST segments of one are held."""
    bucket, at, out = [], None, ([], [], [], [])

    def packed():
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64())
        batch = pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], ["doc_id", "row", "start", "end"])
        for column in out:
            column.clear()
        return batch

    for batch in batches:
        for anchor, doc, place, raw in zip(*(batch.column(k).to_pylist() for k in ("anchor", "doc_id", "place", "bytes")), strict=True):
            if anchor != at:
                if len(bucket) > 1:
                    _ranges(repeats(bucket), out)
                bucket, at = [], anchor
            bucket.append((doc, place, raw))
        yield packed()
    if len(bucket) > 1:
        _ranges(repeats(bucket), out)
    yield packed()


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches, 2000):
        out = ([], [], [], [])
        for anchor, doc, place, raw in zip(*(batch.column(k).to_pylist() for k in ("anchor", "doc_id", "place", "bytes")), strict=True):
            start, windows, row = _unpacked(place)
            for i in range(windows):
                for column, value in zip(out, (xxhash.xxh3_128_digest(raw[i : i + LENGTH]), doc, start + i, row), strict=True):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, (pa.binary(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["window", "doc_id", "start", "row"])


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches):
        sizes, removed, runs, kept = [], [], [], []
        for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
            raw = (text or "").encode()
            parts, at, n = [], 0, 0
            for r in sorted(ranges or (), key=lambda r: (r["start"], r["end"])):
                if n == 0 or r["start"] > at:
                    parts.append(raw[at : r["start"]])
                    n, at = n + 1, r["end"]
                at = max(at, r["end"])
            parts.append(raw[at:])
            left = b"".join(parts)
            for column, value in zip((sizes, removed, runs, kept), (len(raw), len(raw) - len(left), n, left), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """doc_id, row (16 bits of the text's hash), start, end of repeated ranges; they may overlap."""
    spark = docs.sparkSession
    docs = docs.where("doc_id is not null")
    scanned = common.stored(docs.mapInArrow(_scan, "doc_id bigint, place bigint, anchor bigint, own bigint"), "segments")
    several = common.stored(scanned.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "anchors")
    again = common.stored(scanned.join(several, "anchor", "left_semi"), "repeated-anchors")
    common.release(scanned, several)

    firsts = again.groupBy("anchor", "own").agg(F.min(F.struct("doc_id", "place")).alias("first"), F.count("*").alias("n"))
    firsts = common.stored(firsts, "first-segments")
    start, windows = F.shiftright("place", 30), F.shiftright("place", _WINDOWS).bitwiseAND(127)
    later = again.join(firsts.where("n > 1"), ["anchor", "own"]).where(F.struct("doc_id", "place") != F.col("first"))
    row = F.col("place").bitwiseAND(0xFFFF)
    whole = later.select("doc_id", row.alias("row"), start.alias("start"), (start + windows + LENGTH - 1).alias("end"))

    sizes = firsts.groupBy("anchor").agg(F.count("*").alias("different")).where("different > 1")
    mixed = firsts.join(sizes, "anchor").select("anchor", "different", F.col("first.doc_id").alias("doc_id"), F.col("first.place").alias("place"))
    wanted = mixed.groupBy("doc_id").agg(F.collect_list("anchor").alias("anchors"), F.collect_list("place").alias("places"))
    cut = docs.join(wanted, "doc_id").mapInArrow(_cut, "anchor bigint, doc_id bigint, place bigint, bytes binary")
    cut = common.stored(cut.join(sizes, "anchor"), "segment-bytes")

    few = cut.where(F.col("different") <= MOST).select("anchor", "doc_id", "place", "bytes")
    compared = few.repartition("anchor").sortWithinPartitions("anchor", "doc_id", "place").mapInArrow(_compare, "doc_id bigint, row bigint, start bigint, end bigint")
    spread = common.stored(cut.where(F.col("different") > MOST).select("anchor", "doc_id", "place", "bytes").mapInArrow(_windows, "window binary, doc_id bigint, start bigint, row bigint"), "windows")
    earliest = spread.groupBy("window").agg(F.min(F.struct("doc_id", "start", "row")).alias("first"), F.count("*").alias("n")).where("n > 1")
    single = spread.join(earliest, "window").where(F.struct("doc_id", "start", "row") != F.col("first")).select("doc_id", "row", "start", (F.col("start") + LENGTH).alias("end"))
    out = common.stored(whole.unionByName(compared).unionByName(single), "repeated-ranges")
    common.release(again, firsts, cut, spread)
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (the bytes left) of every row."""
    docs = common.keyed(docs, id_col, text_col)
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    ranges = repeated_ranges(docs)
    merged = ranges.groupBy("doc_id", "row").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    tagged = docs.withColumn("row", F.crc32(F.coalesce("text", F.lit(""))).bitwiseAND(0xFFFF))
    rows = tagged.join(merged, ["doc_id", "row"], "left").select("doc_id", "text", "ranges")
    return rows.mapInArrow(_strip, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")

