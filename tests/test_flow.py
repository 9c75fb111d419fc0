"""A whole run from page archives to views, with models that answer from a script."""

import io
import json
import zipfile

from test_statements import STATEMENT, Reviewer

from tallyspark import flow
from tallyspark.config import Config


class Scribe:
    """Reads a page's table from its bytes, in the delimited format."""

    def read(self, doc_id, pages):
        blocks = []
        for _, image in pages:
            lines = ["|" + "|".join(row) + "|" for row in json.loads(image)]
            blocks.append("===TABLE_START===\n" + "\n".join(lines) + "\n===TABLE_END===")
        return "\n".join(blocks), "STOP"


def test_run(spark, tmp_path):
    (tmp_path / "pages").mkdir()
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        for n, table in enumerate(STATEMENT, 1):
            width = max(map(len, table))
            z.writestr(f"p{n}.png", json.dumps([r + [""] * (width - len(r)) for r in table]))
    (tmp_path / "pages" / "a.zip").write_bytes(raw.getvalue())
    config = Config.of({"extraction": {"pages": str(tmp_path / "pages"), "batch_size": 3, "other": 1}, "output": str(tmp_path / "out"), "postgres": {"table_name": "flow_statement"}})
    done = flow.run(spark, config, Scribe(), Reviewer())
    names = {r.name for r in done.holdings.collect()}
    assert names == {"ORPHAN INC", "ACME CORP", "SHORT CO", "NO SYMBOL FUND", "ESCROW NOTE BOND", "DELTA CORP JR NT"}
    assert done.log.where("status = 'APPLIED'").count() > 0
    assert spark.sql("SELECT sum(holding_count) FROM v_asset_class_allocation").first()[0] == 6
    manifest = spark.read.json(f"{tmp_path}/out/manifest").first()
    assert (manifest.total_pages, manifest.total_batches, manifest.failed_page_ranges) == (7, 3, [])
    first = (tmp_path / "out" / "issues").glob("part-*")
    assert any("NEGATIVE VALUES" in p.read_text() for p in first)
    spark.sql("DROP TABLE flow_statement")


def test_config(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"output": "o", "parsing": {"table_prefix": "t"}}))
    config = Config.load(str(tmp_path / "c.json"))
    assert (config.output, config.table_prefix, config.batch_size) == ("o", "t", 7)
