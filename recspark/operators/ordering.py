"""Ordered positions, running sums and lags without a single-task window.

``row_number() over (partition by p order by k)`` sends every row of one ``p``
(or, without ``p``, the whole table) to one task. Here the ordered rows are
cut into buckets at approximate quantiles of the leading order column; the
driver only sees the cut points. Per ``(p, bucket)`` the rows are counted and
summed (a map-side combined aggregate), those few totals are prefix-summed,
and the window then runs inside a bucket. The results are exact whatever the
cut points are: they only decide how the work is split. The number of buckets
follows the rows (``ROWS_PER_BUCKET``), at least one per core.

NULL keys form a group like any other and NULL order values come first, as in
a plain window.

The order columns must form a total order (no ties) for the output to be
deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_BUCKET = "_seg_bucket"
ROWS_PER_BUCKET = 250_000


def _numeric(df: DataFrame, colname: str):
    dtype = df.schema[colname].dataType.typeName()
    c = F.col(colname)
    if dtype == "timestamp":
        return F.unix_micros(c).cast("double")
    if dtype == "timestamp_ntz":
        # whole seconds, zone-free; ties inside a second share a bucket
        return F.unix_timestamp(c).cast("double")
    if dtype == "date":
        return F.unix_date(c).cast("double")
    return c.cast("double")


def bucket_count(df: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Buckets of about ``rows_per_bucket`` rows, at least one per core."""
    return max(df.sparkSession.sparkContext.defaultParallelism,
               -(-df.count() // rows_per_bucket))


def add_buckets(df: DataFrame, lead: str, n_buckets: int | None = None) -> DataFrame:
    """Add ``_seg_bucket``: the quantile slice of ``lead`` a row falls in (NULL: -1,
    before all others)."""
    num = df.withColumn("_seg_lead", _numeric(df, lead))
    n = n_buckets or bucket_count(num.select("_seg_lead"))
    probs = [i / n for i in range(1, n)]
    cuts = num.approxQuantile("_seg_lead", probs, min(0.01, 0.25 / n)) if probs else []
    splits = [float("-inf")] + sorted(set(cuts)) + [float("inf")]
    if len(splits) > 2:
        num = Bucketizer(splits=splits, inputCol="_seg_lead", outputCol=_BUCKET,
                         handleInvalid="keep").transform(num)
    else:
        num = num.withColumn(_BUCKET, F.lit(0.0))
    return num.withColumn(_BUCKET, F.when(F.col("_seg_lead").isNull(), F.lit(-1.0))
                          .otherwise(F.col(_BUCKET))).drop("_seg_lead")


def segmented_scan(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[str],
                   position: str | None = "position",
                   sums: dict[str, str] | None = None,
                   lags: dict[str, str] | None = None,
                   maxes: dict[str, str] | None = None,
                   n_buckets: int | None = None) -> DataFrame:
    """Add a 0-based ``position`` within ``partition_cols`` in ``order_cols`` order,
    exclusive running sums (``{out: col}``, the sum over earlier rows) and lags
    (``{out: col}``, the value of the previous row, NULL for the first) and exclusive
    running maxima (``{out: col}``, over earlier rows, NULLs left out; structs compare
    field by field).
    """
    parts = list(partition_cols)
    order = list(order_cols)
    sums = dict(sums or {})
    lags = dict(lags or {})
    maxes = dict(maxes or {})
    b = add_buckets(df, order[0], n_buckets)

    # Totals per (partition, bucket): count, sums, and the last row's lag values.
    last = F.struct(*[F.col(c) for c in order], *[F.col(c).alias(f"_lag_{o}")
                                                  for o, c in lags.items()])
    aggs = [F.count(F.lit(1)).alias("_seg_n")]
    aggs += [F.sum(c).alias(f"_seg_s_{o}") for o, c in sums.items()]
    aggs += [F.max(c).alias(f"_seg_m_{o}") for o, c in maxes.items()]
    if lags:
        aggs.append(F.max(last).alias("_seg_last"))
    tot = b.groupBy(*parts, _BUCKET).agg(*aggs)

    # Prefix over buckets: this window runs over the small totals table.
    wb = Window.partitionBy(*parts).orderBy(_BUCKET)
    before = wb.rowsBetween(Window.unboundedPreceding, -1)
    same = [f"_seg_key_{i}" for i in range(len(parts))]
    pref = tot.select(
        *[F.col(c).alias(k) for c, k in zip(parts, same)],
        F.col(_BUCKET).alias("_seg_key_b"),
        F.coalesce(F.sum("_seg_n").over(before), F.lit(0)).alias("_seg_off"),
        *[F.coalesce(F.sum(f"_seg_s_{o}").over(before), F.lit(0)).alias(f"_seg_soff_{o}")
          for o in sums],
        *[F.max(f"_seg_m_{o}").over(before).alias(f"_seg_moff_{o}") for o in maxes],
        *([F.lag("_seg_last").over(wb).alias("_seg_prev")] if lags else []))

    w = Window.partitionBy(*parts, _BUCKET).orderBy(*order)
    on = F.col(_BUCKET) == F.col("_seg_key_b")
    for c, k in zip(parts, same):
        on &= F.col(c).eqNullSafe(F.col(k))
    out = b.join(pref, on, "left")
    if position:
        out = out.withColumn(position, (F.col("_seg_off") + F.row_number().over(w) - 1)
                             .cast("bigint"))
    run = w.rowsBetween(Window.unboundedPreceding, -1)
    for o, c in sums.items():
        out = out.withColumn(o, F.col(f"_seg_soff_{o}")
                             + F.coalesce(F.sum(c).over(run), F.lit(0)))
    for o, c in maxes.items():
        out = out.withColumn(o, F.greatest(F.col(f"_seg_moff_{o}"), F.max(c).over(run)))
    first_in_bucket = F.row_number().over(w) == 1
    for o, c in lags.items():
        out = out.withColumn(o, F.when(first_in_bucket, F.col(f"_seg_prev._lag_{o}"))
                             .otherwise(F.lag(c).over(w)))
    drop = [_BUCKET, "_seg_key_b", *same, "_seg_off", *[f"_seg_soff_{o}" for o in sums],
            *[f"_seg_moff_{o}" for o in maxes]]
    if lags:
        drop.append("_seg_prev")
    return out.drop(*drop)


def first_n_per_group(df: DataFrame, partition_cols: Sequence[str],
                      order_cols: Sequence[str], n: int, rank_col: str = "rank") -> DataFrame:
    """The first ``n`` rows per group.

    ``row_number() <= n`` plans with a partial WindowGroupLimit before the
    shuffle, so every map task forwards at most ``n`` rows per group and a hot
    group costs no more than a cold one.
    """
    w = Window.partitionBy(*partition_cols).orderBy(*order_cols)
    return (df.withColumn(rank_col, F.row_number().over(w))
            .where(F.col(rank_col) <= n))
