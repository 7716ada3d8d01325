"""Appending to the change log."""

from pyspark.sql import functions as F

from support import change, change_frame
from tidemark.sinks.change_log import append_change_log
from tidemark.sources.change_log import read_change_log


def test_rows_are_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(value):
        seen.add(1)
        return value

    rows = change_frame(spark, [change("t", f"k{n:03}", n, "20180107") for n in range(200)]).withColumn("key", counted("key"))
    append_change_log(rows, str(tmp_path / "log"), 3)
    assert seen.value == 200
    assert sorted(r["key"] for r in read_change_log(spark, str(tmp_path / "log")).collect()) == [f"k{n:03}" for n in range(200)]
