from pyspark.sql import Window
from pyspark.sql import functions as F

from wordloom.operators.ordering import dense_index


def test_dense_index_matches_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"), F.col("id")).repartition(7)
    got = dense_index(df, ["k"], "idx", partitions=5).select("k", "idx")
    want = df.select("k", F.row_number().over(Window.orderBy("k")).alias("idx"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_running_sum_matches_window_on_skewed_key(spark):
    from wordloom.operators.ordering import running_sum

    # key 0 holds a third of the rows
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("k"),
        F.col("id").alias("o"),
        (F.col("id") % 7 + 1).alias("v"),
    )
    got = running_sum(df, "k", ["o"], "v", "lo", partitions=6).select("k", "o", "lo", "lo_total", "lo_rows")
    w = Window.partitionBy("k").orderBy("o")
    want = df.select(
        "k", "o",
        F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("lo"),
        F.sum("v").over(Window.partitionBy("k")).alias("lo_total"),
        F.count(F.lit(1)).over(Window.partitionBy("k")).alias("lo_rows"),
    )
    assert sorted(got.collect()) == sorted(want.collect())


def test_fan_out_only_when_too_few_splits(spark, tmp_path):
    from wordloom.session import ensure_parallel

    want = spark.sparkContext.defaultParallelism
    one = spark.range(0, 100).coalesce(1)
    one.write.parquet(str(tmp_path / "one"))
    scan = spark.read.parquet(str(tmp_path / "one"))
    assert scan.rdd.getNumPartitions() == 1
    assert ensure_parallel(scan, "id") is scan
    assert ensure_parallel(scan, "id", want).rdd.getNumPartitions() == want
    wide = spark.range(0, 100, numPartitions=want)
    assert ensure_parallel(wide, "id", want) is wide
