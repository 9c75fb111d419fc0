"""The streamed rules give what the rules give on all rows at once, also over a restart."""

from tallyspark import schema
from tallyspark.operators.validate import record_issues
from tallyspark.streaming.issues import holdings_stream, write_issues


def test_streamed_issues(spark, sf, tmp_path):
    holdings = schema.testdata_holdings(spark, sf)
    for part in ("a", "b"):
        half = holdings.where(f"holding_id {'<' if part == 'a' else '>='} '5'")
        half.write.mode("append").parquet(f"{tmp_path}/in")
        query = write_issues(holdings_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/state")
        assert query.awaitTermination(120)
    got = sorted(map(str, spark.read.parquet(f"{tmp_path}/out").collect()))
    assert got == sorted(map(str, record_issues(holdings).collect()))
