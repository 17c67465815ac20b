"""A dealt table is written, so later passes do not read it in a few tasks again."""

from pyspark.sql import functions as F

from tagwright.workspace import spread
from tests.conftest import plan_of


def test_dealt_rows_are_written(spark, tmp_path):
    spark.range(6000).withColumn("v", F.when(F.col("id") % 7 > 0, F.col("id") % 7)).coalesce(1).write.parquet(str(tmp_path / "one"))
    read = spark.read.parquet(str(tmp_path / "one"))
    dealt = spread(read, 1000)
    assert "Exchange" not in plan_of(dealt) and dealt.schema == read.schema
    assert dealt.rdd.getNumPartitions() > 1
    assert sorted(map(str, dealt.collect())) == sorted(map(str, read.collect()))
