"""Tables as CSV files by number, ``{path}/{document}/{prefix}{n}.csv``: a data source for both directions.

Writing has two phases. Tasks write their files below a folder of their own under ``{path}/_staging-...``; when all are done,
the driver moves what the tasks that count have written to its name and deletes the rest, so a failed or repeated task leaves
nothing behind. A document that one task wrote, and that has no folder yet, is moved as a folder where the file system
can; then the driver does one rename a document and lists no files. Reading packs files, which are small, into partitions of PACK bytes or MANY files. A document's id is
its folder's name, with percent signs for characters that names can't have; numbers begin with 1.
"""

from __future__ import annotations

import csv
import io
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import islice
from urllib.parse import quote, unquote

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from ..storage import arrow_files

FORMAT, SCHEMA = "numbered_csv", "doc_id string, table_idx int, rows array<array<string>>"
#: File systems that rename a folder at once.
RENAMES = ("local", "hdfs")
#: What a reading task gets at most (one larger file is alone), a file counting for OPEN bytes more than it has.
PACK, MANY, OPEN = 16 << 20, 2000, 4096


def parsed(text: str) -> list[list[str]]:
    """Cells without surrounding space; lines without cells are left out."""
    return [[c.strip() for c in row] for row in csv.reader(io.StringIO(text)) if row]


def printed(rows: list[list[str]]) -> str:
    """CSV text, every row as wide as the widest."""
    out, width = io.StringIO(), max(map(len, rows), default=0)
    csv.writer(out, lineterminator="\n").writerows([*row, *[""] * (width - len(row))] for row in rows)
    return out.getvalue()


def cells(column) -> Iterator[list[list[str]]]:
    """Each table of an Arrow column as lists of cells, nulls as empty ones; cell by cell, Arrow's own lists take most of a writer's time."""
    import pyarrow.compute as pc

    lengths = lambda lists: pc.fill_null(pc.list_value_length(lists), 0).to_pylist()
    flat = column.flatten()
    texts = pc.fill_null(flat.flatten(), "").to_numpy(zero_copy_only=False).tolist()
    rows, at, wide = lengths(column), 0, iter(lengths(flat))
    for n in rows:
        table = []
        for size in islice(wide, n):
            table.append(texts[at : at + size])
            at += size
        yield table


@dataclass
class Pack(InputPartition):
    paths: list[str]


class NumberedReader(DataSourceReader):
    def __init__(self, path: str, prefix: str):
        self.path, self.name = path, re.compile(rf"{re.escape(prefix)}(\d+)\.csv")

    def partitions(self) -> list[Pack]:
        from pyarrow import fs

        files, root = arrow_files(self.path)
        found = [f for f in files.get_file_info(fs.FileSelector(root, recursive=True)) if f.is_file and self.name.fullmatch(f.base_name) and "/_" not in f.path[len(root) :]]
        packs, held = [[]], 0
        for f in sorted(found, key=lambda f: f.path):
            if packs[-1] and (held + f.size + OPEN > PACK or len(packs[-1]) >= MANY):
                packs.append([])
                held = 0
            packs[-1].append(f.path)
            held += f.size + OPEN
        return [Pack(p) for p in packs]

    def read(self, partition: Pack) -> Iterator[tuple]:
        files, _ = arrow_files(self.path)
        for path in partition.paths:
            with files.open_input_stream(path) as stream:
                rows = parsed(stream.read().decode())
            folder, name = path.split("/")[-2:]
            if rows:
                yield unquote(folder), int(self.name.fullmatch(name)[1]) - 1, rows


@dataclass
class Staged(WriterCommitMessage):
    folder: str
    files: int
    documents: dict[str, int]  # different files by document's folder


class NumberedWriter(DataSourceArrowWriter):
    def __init__(self, path: str, prefix: str, overwrite: bool):
        self.path, self.prefix, self.overwrite = path.rstrip("/"), prefix, overwrite
        self.staging = f"_staging-{uuid.uuid4().hex}"

    def write(self, iterator) -> Staged:
        files, root = arrow_files(self.path)
        folder, n, made = f"{root}/{self.staging}/{uuid.uuid4().hex}", 0, {}
        for batch in iterator:
            for document, number, rows in zip(batch.column("doc_id").to_pylist(), batch.column("table_idx").to_pylist(), cells(batch.column("rows")), strict=True):
                if document is None or number is None:
                    raise ValueError("a table without document or number can't be named")
                own = quote(document, safe=" ")
                if own not in made:
                    files.create_dir(f"{folder}/{own}", recursive=True)
                    made[own] = set()
                made[own].add(number)
                with files.open_output_stream(f"{folder}/{own}/{self.prefix}{number + 1}.csv") as out:
                    out.write(printed(rows).encode())
                n += 1
        return Staged(folder, n, {own: len(numbers) for own, numbers in made.items()})

    def commit(self, messages: list[Staged | None]) -> None:
        from pyarrow import fs

        files, root = arrow_files(self.path)
        messages, here = [m for m in messages if m], re.compile(rf"{re.escape(self.prefix)}\d+\.csv")
        for message in messages:
            if (n := sum(message.documents.values())) != message.files:
                raise ValueError(f"{message.files} tables were written to {message.folder}, which has {n}: two have one number")
        writers = Counter(name for message in messages for name in message.documents)
        there = [f for f in files.get_file_info(fs.FileSelector(root, allow_not_found=True)) if not f.is_file and not f.base_name.startswith("_")]
        old = {f.base_name for f in there}
        whole = lambda name: files.type_name in RENAMES and writers[name] == 1 and name not in old
        moves, staged = [], []
        for message in messages:
            moves += [(f"{message.folder}/{name}", name) for name in message.documents if whole(name)]
            for name in message.documents:
                if not whole(name):
                    staged += [(f.path, f"{name}/{f.base_name}") for f in files.get_file_info(fs.FileSelector(f"{message.folder}/{name}")) if f.is_file]
        if len({name for _, name in staged}) != len(staged):
            raise ValueError("two tables of a document have one number")
        if self.overwrite:
            for folder in there:
                for f in files.get_file_info(fs.FileSelector(folder.path, recursive=True)):
                    if f.is_file and here.fullmatch(f.base_name) and "/_" not in f.path[len(folder.path) :]:
                        files.delete_file(f.path)
        for folder in {name.partition("/")[0] for _, name in staged}:
            files.create_dir(f"{root}/{folder}", recursive=True)
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda move: files.move(move[0], f"{root}/{move[1]}"), moves + staged))
        self.abort(messages)

    def abort(self, messages) -> None:
        files, root = arrow_files(self.path)
        try:
            files.delete_dir(f"{root}/{self.staging}")
        except FileNotFoundError:
            pass  # no task has written


class NumberedCsv(DataSource):
    """Options: path, and prefix ("table_")."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def _prefix(self) -> str:
        return self.options.get("prefix", "table_")

    def reader(self, schema) -> NumberedReader:
        return NumberedReader(self.options["path"], self._prefix())

    def writer(self, schema, overwrite: bool) -> NumberedWriter:
        return NumberedWriter(self.options["path"], self._prefix(), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(NumberedCsv)
