"""Time-axis operators (W1, W4, W5, H5 in SQL form, P7/W3, S7/S8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.functions.timefmt import add_seconds, epoch_seconds
from recspark.operators.ordering import first_n_per_group, segmented_scan


def tumbling_chunks(spans: DataFrame, start: str, seconds: str, chunk_seconds: int = 1,
                    keys: Sequence[str] = ("recording_id",)) -> DataFrame:
    """``floor(seconds / chunk_seconds)`` chunks per span; a partial tail is
    dropped. Chunk ``i`` starts at ``start + i * chunk_seconds``.

    One metadata row expands to its chunk rows inside the same task (no
    shuffle); the fan-out per row is the span length, a bounded quantity.
    """
    n = F.floor(F.col(seconds) / chunk_seconds).cast("int")
    out = spans.where(n > 0).select(*keys, start, F.explode(F.sequence(F.lit(0), n - 1))
                                    .alias("chunk_idx"))
    return out.select(*keys, "chunk_idx",
                      add_seconds(start, F.col("chunk_idx") * chunk_seconds)
                      .alias("chunk_start_ts"))


def unit_norm(df: DataFrame, instant: Sequence[str], value: str, out: str = "value_norm"
              ) -> DataFrame:
    """W4 (SQL form): ``x / sqrt(sum x^2)`` over the channels of one instant;
    an all-zero instant stays zero.

    The per-instant norm is a map-side combined aggregate joined back on the
    instant key; with AQE a hot instant is split by the skew-join handling,
    where a window would hold it in one task.
    """
    inst = list(instant)
    norms = df.groupBy(*inst).agg(F.sqrt(F.sum(F.col(value) * F.col(value))).alias("_norm"))
    return (df.join(norms, inst, "left")
            .withColumn(out, F.when(F.col("_norm") == 0, F.lit(0.0))
                        .otherwise(F.col(value) / F.col("_norm")))
            .drop("_norm"))


def decimate_series(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                    taps: Sequence[float], q: int, out: str = "y") -> DataFrame:
    """H5 (SQL form): ``y[j] = sum_k taps[k] * x[q*j + k - c]`` with ``c`` the
    centre tap; samples outside the series count as zero; one output per
    input position divisible by ``q``.

    Each sample is sent to the (at most ``len(taps)``) outputs it feeds and
    summed per output: one shuffle on a near-unique key, no window over a
    whole series. Positions come from the skew-safe ordered scan.
    """
    c = len(taps) // 2
    pos = segmented_scan(df.select(*keys, *order, value), keys, order, position="_i")
    kernel = F.array(*[F.struct(F.lit(k - c).alias("off"), F.lit(float(h)).alias("h"))
                       for k, h in enumerate(taps)])
    contrib = pos.select(*keys, "_i", value, F.explode(kernel).alias("_t"))
    src = F.col("_i") - F.col("_t.off")
    contrib = contrib.where((src >= 0) & (src % q == 0)).select(
        *keys, (src / q).cast("bigint").alias("j"),
        (F.col("_t.h") * F.col(value)).alias("_v"), (F.col("_t.off") == 0).alias("_centre"))
    return (contrib.groupBy(*keys, "j")
            .agg(F.sum("_v").alias(out), F.max("_centre").alias("_has"))
            .where("_has").drop("_has"))


def recording_timeline(recordings: DataFrame, keys: Sequence[str] = ("patient_id",),
                       start: str = "start_ts", duration: str = "duration_in_sec",
                       rid: str = "recording_id") -> DataFrame:
    """Recordings of one group laid end to end.

    ``seq_no`` (0-based), ``elapsed_sec`` (total duration of the earlier
    recordings) and ``gap_sec`` (start minus the previous recording's end;
    NULL for the first).
    """
    scanned = segmented_scan(recordings, keys, (start, rid), position="seq_no",
                             sums={"elapsed_sec": duration},
                             lags={"_prev_start": start, "_prev_dur": duration})
    gap = (epoch_seconds(start) - epoch_seconds("_prev_start") - F.col("_prev_dur"))
    return (scanned.withColumn("elapsed_sec", F.col("elapsed_sec").cast("bigint"))
            .withColumn("gap_sec", gap.cast("bigint"))
            .drop("_prev_start", "_prev_dur"))


def recording_sessions(recordings: DataFrame, keys: Sequence[str] = ("patient_id", "rec_id"),
                       start: str = "start_ts", duration: str = "duration_in_sec",
                       rid: str = "recording_id") -> DataFrame:
    """A row per long recording (the recordings that share ``keys``): its first start
    and last end, the recordings in it, and whole seconds recorded, without any recording
    (``gap_sec``) and recorded more than once (``overlap_sec``: what each recording
    repeats of the time its predecessors reach to). A recording without start or
    duration is counted and has no extent; NULL keys form a group like any other.
    """
    spans = (recordings.select(*keys, rid, start, duration)
             .withColumn("_end", add_seconds(start, F.col(duration))))
    seen = segmented_scan(spans, keys, (start, rid), position=None, maxes={"_reach": "_end"})
    begin, end, reach = (epoch_seconds(c) for c in (start, "_end", "_reach"))
    zero = F.lit(0).cast("bigint")
    return seen.groupBy(*keys).agg(
        F.min(start).alias("session_start"), F.max("_end").alias("session_end"),
        F.count(F.lit(1)).alias("n_recordings"),
        F.coalesce(F.sum(F.when(F.col("_end").isNotNull(), F.col(duration))), zero)
        .cast("bigint").alias("recorded_sec"),
        F.coalesce(F.sum(F.when(begin > reach, begin - reach)), zero).alias("gap_sec"),
        F.coalesce(F.sum(F.when(reach > begin, F.least(end, reach) - begin)), zero)
        .alias("overlap_sec"))


def place_annotations(annotations: DataFrame, recordings: DataFrame, patient: str = "patient_id",
                      group: str = "rec_id", onset: str = "onset", start: str = "start_ts",
                      duration: str = "duration_in_sec", rid: str = "recording_id") -> DataFrame:
    """Every annotation with the recording its onset lies in, and its place there.

    Recordings cover ``[start, start + duration)``. Of those that hold the onset the
    one that started last counts if it is the last that started at all, else the one
    that reaches farthest (ties: larger id), so an onset that any recording holds is
    always placed. ``recording_offset_sec`` and ``session_offset_sec`` are whole seconds
    since that recording's and its long recording's first start; a recording without
    ``group`` is a long recording of its own. Outside every recording these are NULL and
    ``since_end_sec`` tells the time since the latest end (NULL before the first). NULL
    patients, onsets, starts and durations match nothing; every annotation stays.

    An as-of join as one ordered scan: recordings and annotations of a patient are
    merged in time order and the last and the farthest recording are running maxima,
    carried across the buckets of the scan, so a hot patient is spread over tasks.
    """
    spans = recordings.select(F.col(patient).alias("_p"), F.col(group).alias("_g"),
                              F.col(rid).alias("_r"), F.col(start).alias("_s"),
                              add_seconds(start, F.col(duration)).alias("_e")).where(
        F.col("_p").isNotNull() & F.col("_s").isNotNull() & F.col("_e").isNotNull())
    first = spans.groupBy("_p", "_g").agg(F.min("_s").alias("_f"))
    spans = spans.join(first, ["_p", "_g"], "left").withColumn(
        "_f", F.coalesce("_f", "_s"))
    marks = spans.select("_p", F.col("_s").alias("_at"), F.lit(0).alias("_kind"),
                         F.struct("_s", "_r", "_e", "_g", "_f").alias("_started"),
                         F.struct("_e", "_r", "_s", "_g", "_f").alias("_reaching"))
    rows = annotations.select(F.col(patient).alias("_p"), F.col(onset).alias("_at"),
                              F.lit(1).alias("_kind"), F.struct("*").alias("_row"))
    merged = rows.unionByName(marks, allowMissingColumns=True)
    seen = segmented_scan(merged, ["_p"], ["_at", "_kind"], position=None,
                          maxes={"_last": "_started", "_far": "_reaching"}).where("_kind = 1")
    fields = ("_r", "_g", "_s", "_f")

    def holding(side: str):
        return F.when(F.col(f"{side}._e") > F.col("_at"),
                      F.struct(*[F.col(f"{side}.{c}") for c in fields]))

    at = epoch_seconds("_at")
    placed = seen.select("_row.*", "_at", F.col("_far._e").alias("_end"),
                         F.coalesce(holding("_last"), holding("_far")).alias("_on"))
    return placed.select(
        *[F.col(c) for c in annotations.columns], F.col("_on._r").alias(rid),
        F.col("_on._g").alias(group),
        (at - epoch_seconds("_on._s")).alias("recording_offset_sec"),
        (at - epoch_seconds("_on._f")).alias("session_offset_sec"),
        F.when(F.col("_on").isNull(), at - epoch_seconds("_end")).alias("since_end_sec"))


def ordered_within(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   out: str = "seq_no") -> DataFrame:
    """Position of each row within its group in time order."""
    return segmented_scan(df, keys, order, position=out)


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int,
                    out: str = "rank") -> DataFrame:
    """The first ``n`` rows (e.g. recordings) per group in time order."""
    return first_n_per_group(df, keys, order, n, out)
