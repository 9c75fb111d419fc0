"""Readers: numbered CSV tables, holdings, page images, issue reports."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import COLUMNS, CSV_HOLDINGS
from ..storage import arrow_files, stored
from . import numbered
from .images import normalized

CSV_ROWS = T.ArrayType(T.ArrayType(T.StringType()))


@F.pandas_udf(CSV_ROWS)
def _parsed(texts):
    return texts.map(numbered.parsed)


def read_numbered_csvs(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """doc_id (the folder), table_idx (from 0), rows of files ``{prefix}{n}.csv`` in folders below ``path``, or of those that a
    glob names.

    Whole files are parsed, so quoted line ends and the order of rows hold; other files are passed over,
    and a gap in the numbers is just a gap.
    """
    if not any(c in path for c in "*?[{"):
        numbered.register(spark)
        return spark.read.format(numbered.FORMAT).option("prefix", prefix).load(path)
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    number = F.regexp_extract("file", rf"/\Q{prefix}\E(\d+)\.csv$", 1)
    found = files.withColumn("n", F.nullif(number, F.lit(""))).where("n is not null")
    unquoted = lambda c: F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    folder = unquoted(F.regexp_extract("file", r"([^/]+)/[^/]+$", 1))  # Spark quotes paths; the folder's name is quoted as well
    rows = found.select(F.coalesce(unquoted(folder), folder).alias("doc_id"), (F.col("n").cast("int") - 1).alias("table_idx"), _parsed("value").alias("rows"))
    return rows.where(F.size("rows") > 0)


def read_holdings_csv(spark: SparkSession, path: str) -> DataFrame:
    """The canonical columns; the schema is given, for an empty column has no type of its own."""
    return spark.read.schema(CSV_HOLDINGS).option("header", True).csv(path).toDF(*COLUMNS)


def read_one_table(tables: DataFrame, number: int, field: str) -> DataFrame:
    """name and value of one prepared table's rows, by table number (from 1) and the field's free-text
    name; no rows where the table or a column for the field is missing."""
    from ..operators.parse import matching_column

    one = tables.where(F.col("table_idx") == number - 1).where(F.array_contains("header", "Description"))
    names = F.transform("header", lambda h: F.when(h == "Description", "").otherwise(h))
    place = matching_column(names, F.lit(field), ("the", "a", "of"))
    rows = one.withColumn("at", place).where("at > 0").select("header", "at", F.posexplode("data").alias("row_idx", "row"))
    description = F.try_element_at("row", F.array_position("header", "Description").cast("int"))
    return rows.select("row_idx", description.alias("name"), F.try_element_at("row", F.col("at")).alias("value")).where("name <> '' and not name rlike '(?i)^\\\\s*total'")


_PAGES = "doc_id string, page_number int, image binary, media_type string"
_INDEX = "doc_id string, kind string, page_number int, name string, size bigint"
#: Bytes and pages of one document that a task reads together, about.
RUN_BYTES, RUN_PAGES = 32 << 20, 64


def _page_names(archive) -> list[str]:
    """Pages of an archive in its manifest's order, or by the first number in a page's name."""
    import json
    import re

    names = archive.namelist()
    if "manifest.json" not in names:
        images = [n for n in names if n.lower().endswith((".png", ".jpg", ".jpeg"))]
        return sorted(images, key=lambda n: (int((re.search(r"\d+", n.rpartition("/")[2]) or re.match("0", "0"))[0]), n))
    listed = json.loads(archive.read("manifest.json"))
    entries = listed.get("pages", listed) if isinstance(listed, dict) else listed
    wanted = [e.get("image", {}).get("path") or e.get("path") if isinstance(e, dict) else e for e in entries]
    here = set(names)
    return [n for n in wanted if n in here]


def _indexed(frames: Iterator) -> Iterator:
    """What each file is, by its first bytes, which count more than its name, and an archive's pages by its directory."""
    import zipfile

    import pandas as pd

    for frame in frames:
        for path in frame["path"]:
            files, inner = arrow_files(path)
            with files.open_input_file(inner) as file:
                head = file.read(4)
                if head == b"PK\x03\x04":
                    with zipfile.ZipFile(file) as archive:
                        rows = [(path, "zip", k, n, archive.getinfo(n).compress_size) for k, n in enumerate(_page_names(archive), 1)]
                elif head == b"%PDF":
                    import fitz  # optional; without it a document of this kind is an error

                    file.seek(0)
                    with fitz.open(stream=file.read(), filetype="pdf") as document:
                        rows = [(path, "pdf", k, None, RUN_BYTES // RUN_PAGES) for k in range(1, document.page_count + 1)]
                else:
                    raise ValueError(f"neither PDF nor ZIP: {path}")
            yield pd.DataFrame(rows, columns=["doc_id", "kind", "page_number", "name", "size"])


def _pages(dpi: int, largest: int):
    def run(frames: Iterator) -> Iterator:
        import itertools
        import zipfile

        import pandas as pd

        def rendered(document, k: int) -> bytes:
            import fitz

            page = document[k - 1]
            zoom = min(dpi / 72, largest / max(page.rect.width, page.rect.height))
            return page.get_pixmap(matrix=fitz.Matrix(zoom, zoom)).tobytes("png")

        for frame in frames:
            for (path, kind), some in itertools.groupby(frame.itertuples(index=False), key=lambda r: (r.doc_id, r.kind)):
                files, inner = arrow_files(path)
                with files.open_input_file(inner) as file:
                    if kind == "zip":
                        document = zipfile.ZipFile(file)
                    else:
                        import fitz

                        document = fitz.open(stream=file.read(), filetype="pdf")
                    with document:
                        for r in some:
                            raw, media = normalized(document.read(r.name) if kind == "zip" else rendered(document, r.page_number), largest)
                            media = media or ("image/png" if r.name.lower().endswith("png") else "image/jpeg")
                            yield pd.DataFrame([(path, r.page_number, raw, media)], columns=["doc_id", "page_number", "image", "media_type"])

    return run


def read_pages(spark: SparkSession, path: str, dpi: int = 350, largest: int = 2048) -> DataFrame:
    """doc_id, page_number (from 1), image, media_type of PDF and ZIP files; other files are an error.

    A first pass reads the archives' directories only. The pages it lists are dealt out in runs of RUN_PAGES or so of one
    document, and each task opens just the runs it gets, so a large archive is read by many tasks. Images are made
    PNG with no side over ``largest`` pixels (see images.normalized). PDFs are rendered at ``dpi`` or smaller; that
    needs the optional renderer on the executors.
    """
    files = spark.read.format("binaryFile").load(path).select("path")
    index = stored(files.repartition("path").mapInPandas(_indexed, _INDEX), "page-index")
    n, size = index.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    tasks = max(1, -(-n // RUN_PAGES), -(-size // RUN_BYTES))
    run = F.floor((F.col("page_number") - 1) / max(1, min(RUN_PAGES, n * RUN_BYTES // max(size, 1))))
    dealt = index.withColumn("run", run).repartition(tasks, "doc_id", "run").sortWithinPartitions("doc_id", "page_number")
    return dealt.select("doc_id", "kind", "page_number", "name").mapInPandas(_pages(dpi, largest), _PAGES)


# fixed values: section titles of a text report
SECTIONS = {
    "NEGATIVE VALUES": "negative_values",
    "ABNORMAL QUANTITIES": "abnormal_quantities",
    "MISSING SYMBOL": "missing_symbol",
    "MISSING ACCOUNT": "missing_account",
    "MISSING DATA": "missing_data",
    "TOTAL MISMATCHES": "total_mismatches",
    "EXTRACTION FAILURES": "extraction_failures",
}


# fixed values: what Windows-1252 has where Latin-1 has control characters
_CONTROLS = "".join(map(chr, (0x80, *range(0x82, 0x8D), 0x8E, *range(0x91, 0x9D), 0x9E, 0x9F)))
_WINDOWS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"


def decoded(raw: Column, valid: Column) -> Column:
    """Bytes as text: UTF-8 where ``valid``, else Windows-1252."""
    return F.when(valid, raw.cast("string")).otherwise(F.translate(F.decode(raw, "ISO-8859-1"), _CONTROLS, _WINDOWS))


#: Reports whose titles are sent to all tasks, at most.
FEW_REPORTS = 100_000


def read_issue_report(spark: SparkSession, path: str) -> DataFrame:
    """file, seq, category, message of the bullets of text reports, each under the last title above it; seq orders a
    report's bullets.

    A folder with the parts that ``writers.write_text`` made is one report, in the order of their names; any other file is one of its
    own. A report with a line that isn't UTF-8 is read as Windows-1252. Files are split like any text; a line finds its title
    among those of its report, which are few and stored, by its place.
    """
    own = F.col("_metadata.file_path")
    report = F.regexp_replace(own, r"/part-\d+-[^/]+$", "")
    place = F.struct(F.when(report != own, own).alias("part"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    lines = spark.read.text(path).select(report.alias("file"), place.alias("seq"), F.col("value").cast("binary").alias("raw"))
    valid = F.is_valid_utf8(F.col("raw").cast("string"))
    broken = _by_report(stored(lines.where(~valid).select("file").distinct(), "broken-reports").withColumn("__broken", F.lit(True)))
    text = lines.join(broken, "file", "left").select("file", "seq", F.rtrim(decoded(F.col("raw"), F.col("__broken").isNull())).alias("line"))
    title = F.coalesce(*(F.when(F.upper(F.trim("line")).startswith(t), c) for t, c in SECTIONS.items()))
    titles = text.select("file", "seq", title.alias("category")).where("category is not null")
    titles = _by_report(stored(titles.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("seq", "category")), asc=False).alias("__titles")), "titles"))
    message = F.nullif(F.regexp_extract("line", r"^\s*-\s+(.*\S)\s*$", 1), F.lit(""))
    bullets = text.withColumn("message", message).where("message is not null").join(titles, "file")
    above = F.try_element_at(F.filter("__titles", lambda t: t["seq"] < F.col("seq")), F.lit(1))["category"]
    return bullets.select("file", "seq", above.alias("category"), "message").where("category is not null")


def _by_report(rows: DataFrame) -> DataFrame:
    """A row for each report, to be joined: sent to all tasks unless there are many, so one large report isn't one task's."""
    return F.broadcast(rows) if rows.count() <= FEW_REPORTS else rows


def parse_issue(message: Column) -> dict[str, Column]:
    """Security, table number, field and expected amount that an issue's text names, as columns."""
    found = lambda p: F.nullif(F.regexp_extract(message, p, 1), F.lit(""))
    return {
        "security": F.trim(found(r"(?i)\bfor\s+(.+)$")),
        "table_number": found(r"Table\s+(\d+):").cast("int"),
        "field": F.coalesce(F.trim(found(r"Table\s+\d+:\s+(.+?)\s+(?:sum/total )?mismatch")), found(r"(?i)Negative\s+(Quantity|Cost Basis|Market Value)")),
        "expected": F.regexp_replace(found(r"Expected:\s*\$?(-?[\d,]+\.?\d*)"), ",", "").try_cast("decimal(20,6)"),
    }
