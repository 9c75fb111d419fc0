"""WARC archives of pages, index first.

``write_archives`` writes gzip-per-record WARC files under ``path/data`` and, in ``path/index``, where
each record is: file, offset, length, url, digest. ``read_archives`` starts from any selection of index
rows, sorts them by place, coalesces neighbouring byte ranges and reads those alone.

A payload of at least ``least`` bytes that several pages share is stored once, as the response of the
smallest page_id; the others are revisit records that refer to it. Null html is an empty payload; a
null page_id is always a response; a null url is written as ``urn:page:<id>``. Repeated rows of one
page_id and payload are all responses. Files of failed or repeated task attempts are in no index row.
Very long html is one record, written and read alone. An empty table gives no file and an empty index.

Record ids are unique: they follow from page_id and digest, and are drawn where rows repeat or have no
page_id. A revisit names its response's record id (not if that was drawn) and page_id; reading takes
both from the record's headers, not from the index.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

DATE = "2024-01-01T00:00:00Z"
#: A new file begins beyond this; ranges closer than GAP are read at once, up to MOST bytes.
FILE_BYTES, GAP, MOST = 256 << 20, 64 << 10, 4 << 20
#: Headers of our own: page ids as JSON.
PAGE, REFERS_TO_PAGE = "X-Page-ID", "X-Refers-To-Page-ID"
_INDEX = "page_id {id}, url string, file string, offset bigint, length bigint, digest string, payload_bytes bigint, record_type string, refers_to {id}"


def _name(page_id, url: str | None) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url) if url else f"urn:page:{page_id}"


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to=None, repeated: bool = False, refers_to_repeated: bool = False) -> bytes:
    """One WARC/1.1 record, uncompressed. ``repeated``: other rows have its page_id and digest;
    ``refers_to_repeated``: its response is such a row."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>" if repeated or page_id is None else record_id(page_id, digest),
        "WARC-Date": DATE,
        "WARC-Target-URI": _name(page_id, url),
        "WARC-Payload-Digest": f"sha256:{digest}",
        PAGE: json.dumps(page_id),
    }
    if revisit:
        head |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", REFERS_TO_PAGE: json.dumps(refers_to)}
        if not refers_to_repeated:
            head["WARC-Refers-To"] = record_id(refers_to, digest)
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record (the block's body; empty for a revisit)."""
    if not raw.startswith(b"WARC/1."):
        raise ValueError("not a WARC record")
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    size = int(headers["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a WARC record has another length than its header says")
    return headers, rest[:size].partition(b"\r\n\r\n")[2]


def _write(path: str, level: int, kind: str):
    ids = pa.string() if kind == "string" else pa.int64() if kind == "bigint" else pa.int32()
    kinds = {"page_id": ids, "url": pa.string(), "file": pa.string(), "offset": pa.int64(), "length": pa.int64(), "digest": pa.string(), "payload_bytes": pa.int64(), "record_type": pa.string(), "refers_to": ids}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """An index row leaves the task only when its file is closed."""
        out, file, offset, index = None, "", 0, []
        fs, root = common.filesystem(f"{path}/data")

        def finished() -> pa.RecordBatch:
            out.close()
            columns = zip(*index, strict=True) if index else [()] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], list(kinds))

        for batch in common.slices(batches, 500):
            for r in batch.to_pylist():
                if out is None or offset > FILE_BYTES:
                    if out is not None:
                        yield finished()
                    fs.create_dir(root, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, file, offset, index = fs.open_output_stream(f"{root}/{name}", compression=None), f"{path}/data/{name}", 0, []
                packed = zlib.compressobj(level, zlib.DEFLATED, 31)
                data = packed.compress(record(r["page_id"], r["url"], (r["html"] or "").encode(), r["digest"], r["refers_to"], r["repeated"], r["refers_to_repeated"])) + packed.flush()
                out.write(data)
                index.append((r["page_id"], r["url"], file, offset, len(data), r["digest"], r["payload_bytes"], "response" if r["refers_to"] is None else "revisit", r["refers_to"]))
                offset += len(data)
        if out is not None:
            yield finished()

    return run


def write_archives(pages: DataFrame, path: str, least: int = 100, level: int = 6, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write the archives and their index. Digests are grouped on their own; only pages that revisit
    another are then joined to the payloads."""
    pages = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    pages = pages.withColumns({"digest": F.sha2(payload, 256), "payload_bytes": F.length(payload).cast("bigint")})
    counts = pages.groupBy("page_id", "digest", "payload_bytes").agg((F.count("*") > 1).alias("repeated")).where("page_id is not null")
    counts = common.stored(counts, "payload-counts")
    large = counts.where(F.col("payload_bytes") >= least)
    owners = large.groupBy("digest").agg(F.min(F.struct("page_id", "repeated")).alias("o"), F.count("*").alias("n")).where("n > 1")
    owners = common.stored(owners.select("digest", F.col("o.page_id").alias("refers_to"), F.col("o.repeated").alias("refers_to_repeated")), "payload-owners")  # the join stands alone, so Spark can split a hot payload
    revisits = large.join(owners, "digest").where("page_id != refers_to").select("page_id", "digest", "refers_to", "repeated", "refers_to_repeated")
    responses = counts.where("repeated").join(owners, "digest", "left").where((F.col("payload_bytes") < least) | F.col("refers_to").isNull() | (F.col("page_id") == F.col("refers_to")))
    marked = revisits.union(responses.select("page_id", "digest", F.lit(None).cast(pages.schema["page_id"].dataType), "repeated", F.lit(False)))
    rows = pages.join(marked, ["page_id", "digest"], "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("repeated", "refers_to_repeated")})
    kind = pages.schema["page_id"].dataType.simpleString()
    index = rows.mapInArrow(_write(path, level, kind), _INDEX.format(id=kind))
    index.write.parquet(f"{path}/index")
    common.release(counts, owners)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/index")


#: What is read of a record; the ids have the type of page_id.
_READ = {"page_id": None, "record_id": pa.string(), "refers_to": None, "refers_to_record": pa.string(), "record_type": pa.string(), "url": pa.string(), "digest": pa.string(), "payload": pa.binary()}


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    handle, at = None, None
    for batch in common.slices(batches, 500):
        rows, read = batch.to_pylist(), []
        first = 0
        while first < len(rows):
            last, end = first, rows[first]["offset"] + rows[first]["length"]
            while last + 1 < len(rows) and (nxt := rows[last + 1])["file"] == rows[first]["file"] and nxt["offset"] - end <= GAP and nxt["offset"] + nxt["length"] - rows[first]["offset"] <= MOST:
                last, end = last + 1, max(end, nxt["offset"] + nxt["length"])
            if at != rows[first]["file"]:
                if handle is not None:
                    handle.close()
                fs, name = common.filesystem(rows[first]["file"])
                handle, at = fs.open_input_file(name), rows[first]["file"]
            base = rows[first]["offset"]
            data = handle.read_at(end - base, base)
            for r in rows[first : last + 1]:
                headers, body = parse(zlib.decompress(data[r["offset"] - base : r["offset"] - base + r["length"]], 31))
                if headers["WARC-Type"] == "response" and f"sha256:{hashlib.sha256(body).hexdigest()}" != headers["WARC-Payload-Digest"]:
                    raise ValueError("a payload doesn't match its digest")
                page_id, refers_to = json.loads(headers[PAGE]), json.loads(headers.get(REFERS_TO_PAGE, "null"))
                if page_id != r["page_id"]:
                    raise ValueError("a record is of another page than the index says")
                read.append((page_id, headers["WARC-Record-ID"], refers_to, headers.get("WARC-Refers-To"), headers["WARC-Type"], headers["WARC-Target-URI"], headers["WARC-Payload-Digest"].removeprefix("sha256:"), body))
            first = last + 1
        columns = zip(*read, strict=True) if read else [()] * len(_READ)
        id_type = batch.schema.field("page_id").type
        yield pa.RecordBatch.from_arrays([pa.array(c, k or id_type) for c, k in zip(columns, _READ.values(), strict=True)], list(_READ))
    if handle is not None:
        handle.close()


def read_archives(index: DataFrame) -> DataFrame:
    """The records of the given index rows: page_id, record_id, refers_to (a page_id), refers_to_record,
    record_type, url, digest, payload, all from the records.

    Index rows are dealt by file and 16 MB stretch, so that a task reads neighbouring ranges in order.
    A response's payload is checked against its digest; a revisit has an empty payload of its own.
    """
    kind = index.schema["page_id"].dataType.simpleString()
    ordered = index.repartition("file", F.shiftright("offset", 24)).sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(_read, f"page_id {kind}, record_id string, refers_to {kind}, refers_to_record string, record_type string, url string, digest string, payload binary")
