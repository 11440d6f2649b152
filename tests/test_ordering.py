"""Skew-safe ordered scans agree with plain windows, whatever the split."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from recspark.operators.ordering import bucket_count, segmented_scan


def test_segmented_scan_matches_window_on_skewed_key(spark):
    # one patient holds most rows
    df = spark.range(5000).select(
        F.when(F.col("id") % 10 < 7, F.lit(1)).otherwise(F.col("id") % 13).alias("p"),
        ((F.col("id") * 7919) % 5003).alias("t"), F.col("id").alias("k"),
        (F.col("id") % 5).alias("v"))
    w = Window.partitionBy("p").orderBy("t", "k")
    ref = (df.withColumn("rpos", F.row_number().over(w) - 1)
           .withColumn("rsum", F.coalesce(F.sum("v").over(
               w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
           .withColumn("rlag", F.lag("v").over(w)))
    for nb in (1, 7, 64):
        got = segmented_scan(df, ["p"], ["t", "k"], position="pos", sums={"s": "v"},
                             lags={"l": "v"}, n_buckets=nb)
        j = got.join(ref, ["p", "t", "k", "v"])
        bad = j.where("pos <> rpos OR s <> rsum OR NOT (l <=> rlag)").count()
        assert bad == 0 and j.count() == 5000


def test_segmented_scan_nulls_and_ties(spark):
    df = spark.range(600).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 2).alias("p"),  # a third without a key
        F.when(F.col("id") % 5 > 0, F.col("id") % 17).alias("t"), F.col("id").alias("k"),
        F.when(F.col("id") % 7 > 0, F.col("id") % 4).alias("v"))
    w = Window.partitionBy("p").orderBy("t", "k")
    ref = df.select("k", (F.row_number().over(w) - 1).alias("rpos"),
                    F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                               F.lit(0)).alias("rsum"), F.lag("v").over(w).alias("rlag"))
    for nb in (1, 7, None):
        got = segmented_scan(df, ["p"], ["t", "k"], position="pos", sums={"s": "v"},
                             lags={"l": "v"}, n_buckets=nb)
        assert got.columns == [*df.columns, "pos", "s", "l"]
        j = got.join(ref, "k")
        assert j.count() == 600
        assert j.where("NOT (pos <=> rpos) OR NOT (s <=> rsum) OR NOT (l <=> rlag)").count() == 0


def test_buckets_follow_the_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    assert bucket_count(spark.range(0)) == cores
    assert bucket_count(spark.range(1000), rows_per_bucket=10) == max(cores, 100)
