"""Long recordings, annotations placed on them, and running maxima across buckets."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from recspark.operators import timeline
from recspark.operators.ordering import segmented_scan

T0 = datetime(2024, 1, 1)
REC = "patient_id int, rec_id int, recording_id int, start_ts timestamp_ntz, duration_in_sec bigint"
ANN = "patient_id int, onset timestamp_ntz, offset timestamp_ntz"


def at(sec):
    return None if sec is None else T0 + timedelta(seconds=sec)


def test_running_maximum_equals_a_loop(spark):
    rng = random.Random(3)
    data = [(rng.choice([0, 0, 0, 1, None]), i, rng.choice([None, *range(50)]))
            for i in range(400)]
    df = spark.createDataFrame(data, "p int, k int, v int").repartition(4)
    got = segmented_scan(df, ["p"], ["k"], position=None, maxes={"m": "v"}, n_buckets=7)
    top, want = {}, []
    for p, k, v in data:
        want.append((p, k, v, top.get(p)))
        if v is not None:
            top[p] = max(v, top.get(p, v))
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))


def brute_place(anns, recs):
    first = {}
    for p, g, r, s, d in recs:
        if None not in (p, s, d):
            key = (p, g) if g is not None else (p, None, r)
            first[key] = min(s, first.get(key, s))
    out = []
    for p, o, f in anns:
        seen = [x for x in recs if None not in (p, o, x[3], x[4]) and x[0] == p and x[3] <= o]
        row = (None,) * 5
        if seen:
            last = max(seen, key=lambda x: (x[3], x[2]))
            far = max(seen, key=lambda x: (x[3] + x[4], x[2]))
            hit = next((x for x in (last, far) if x[3] + x[4] > o), None)
            if hit:
                key = (p, hit[1]) if hit[1] is not None else (p, None, hit[2])
                row = (hit[2], hit[1], o - hit[3], o - first[key], None)
            else:
                row = (None, None, None, None, o - far[3] - far[4])
        out.append((p, at(o), at(f), *row))
    return sorted(map(str, out))


def test_place_annotations(spark):
    rng = random.Random(5)
    recs = [(rng.choice([1, 1, 1, 2, None]), rng.choice([7, 8, None]), i,
             rng.choice([None, *range(0, 2000, 40)]), rng.choice([None, 0, 30, 60, 300]))
            for i in range(60)]
    recs += recs[:3]  # repeated rows
    anns = [(rng.choice([1, 1, 2, 3, None]), rng.choice([None, *range(-50, 2500, 10)]), 9)
            for _ in range(120)]
    rec_df = spark.createDataFrame([(p, g, r, at(s), d) for p, g, r, s, d in recs], REC)
    ann_df = spark.createDataFrame([(p, at(o), at(f)) for p, o, f in anns], ANN)
    got = timeline.place_annotations(ann_df, rec_df)
    assert got.columns == [*ann_df.columns, "recording_id", "rec_id", "recording_offset_sec",
                           "session_offset_sec", "since_end_sec"]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == brute_place(anns, recs)
    assert timeline.place_annotations(ann_df.limit(0), rec_df).count() == 0
    alone = timeline.place_annotations(ann_df, rec_df.limit(0))
    assert alone.count() == 120 and alone.where("recording_id is not null").count() == 0


def test_recording_sessions(spark):
    rows = [(1, 7, 1, at(0), 100), (1, 7, 2, at(50), 10), (1, 7, 3, at(90), 60),
            (1, 7, 4, at(200), 10), (1, 7, 5, None, 10), (2, 7, 6, at(5), 1)]
    got = timeline.recording_sessions(spark.createDataFrame(rows, REC)).orderBy("patient_id")
    first, second = (tuple(r) for r in got.collect())
    # 50..60 lies in the first, 90..100 is recorded twice, 150..200 is missing
    assert first == (1, 7, at(0), at(210), 5, 180, 50, 20)
    assert second == (2, 7, at(5), at(6), 1, 1, 0, 0)
    assert got.select(F.sum("n_recordings")).first()[0] == 6
