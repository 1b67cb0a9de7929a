import pytest
from pyspark.sql import functions as F

from clicktide.session import scratch
from clicktide.sources import readers, writers


def test_sniff(spark):
    def write(text):
        path = scratch(spark, "sniff")
        spark.createDataFrame([(t,) for t in text], "value string").coalesce(1).write.text(path)
        return readers.sniff_csv(spark, path)

    assert write(["User_ID,x,timestamp", "1,2,3"]).columns == ["User_ID", "x", "timestamp"]
    five = write(["1,2,3,pv,5", "6,7,8,buy,9"])
    assert five.columns == list(readers.BEHAVIOR_COLUMNS) and five.count() == 2
    assert write(["a,b,c"]).columns == ["col_0", "col_1", "col_2"]
    assert write(["user_id,b,c"]).columns == ["col_0", "col_1", "col_2"]
    with pytest.raises(ValueError):
        write([])


def test_bad_cells_become_null(spark):
    path = scratch(spark, "cells")
    spark.createDataFrame([("1,2,x,pv,5",)], "value string").write.text(path)
    assert tuple(readers.read_behavior_csv(spark, path).first()) == (1, 2, None, "pv", 5)
    coded = readers.read_behavior_csv(spark, path, readers.BEHAVIOR_SCHEMA_INT)
    assert coded.schema["user_id"].dataType.simpleString() == "int"


@pytest.mark.parametrize("codec, level", [("zstd", 6), ("snappy", None), ("lz4", None), ("none", None)])
def test_codecs(spark, codec, level):
    path = scratch(spark, "codec")
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    writers.write_partitioned(df, path, "k", codec=codec, level=level)
    assert readers.read_partitioned(spark, path).where("k = 1").count() == 33
    assert readers.read_glob(spark, path).columns == ["id"]


def test_replace_reads_its_own_target(spark):
    path = scratch(spark, "self")
    writers.write_partitioned(spark.range(90).withColumn("k", F.col("id") % 3), path, "k")
    writers.replace_partitions(spark.read.parquet(path).where("id >= 30 and k < 2"), path, ["k"])
    assert spark.read.parquet(path).count() == 40


def test_storage_report(spark):
    path = scratch(spark, "sizes")
    writers.write_partitioned(spark.range(900).withColumn("k", F.col("id") % 3), path, "k")
    rows = {r["k"]: r for r in writers.storage_report(spark, path, "k", 10.0).collect()}
    assert set(rows) == {"0", "1", "2", "TOTAL"}
    assert rows["TOTAL"]["files"] == sum(rows[k]["files"] for k in "012")
    assert rows["TOTAL"]["mb"] == pytest.approx(sum(rows[k]["mb"] for k in "012"))
    assert rows["TOTAL"]["saving_pct"] == pytest.approx((1 - rows["TOTAL"]["mb"] / 10) * 100)
    assert rows["0"]["saving_pct"] is None


def test_csv_keeps_json_and_spaces(spark):
    path = scratch(spark, "csv")
    df = spark.createDataFrame([('{"a": "b, c"}', "  x "), ("line\nbreak", "y")], "j string, t string")
    writers.write_csv(df, path)
    assert sorted(map(tuple, readers.read_csv_inferred(spark, path, multi_line=True).collect())) == sorted(map(tuple, df.collect()))
