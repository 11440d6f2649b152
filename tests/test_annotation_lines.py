"""Annotation lines are rendered and parsed behind the deal to all cores."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from recspark.plans import catalog, standins
from recspark.sources.annotations import parse_annotation_lines


@pytest.mark.parametrize("name", ["parse_annotations", "annotation_rejects",
                                  "listing_annotations"])
def test_no_filter_on_a_line_moves_before_the_deal(spark, tmp_path, name):
    spark.createDataFrame(
        [(i, datetime(2024, 1, 1), 1, "view", 1.0, "{}") for i in range(40)],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
        "props string").write.parquet(f"{tmp_path}/events.parquet")
    plan = catalog.REGISTRY[name](spark, str(tmp_path))._jdf.queryExecution()
    text = plan.optimizedPlan().toString()
    dealt = text[text.index("Repartition"):text.index("Relation")]
    assert "regexp" not in dealt and "date_format" not in dealt
    lines = standins.annotation_lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_fields_reasons_and_nulls(spark):
    rows = [("/pat_1/seizure_list", 1, " 2024-01-01 00:00:00 2024-01-01 00:01:00.500000\t7  8 "),
            ("/pat_1/seizure_list", 2, "2024-96-01 00:00:00 2024-01-01 00:01:00 x 8"),
            ("/pat_1/seizure_list", 3, "one two"), ("/pat_1/seizure_list", 4, "# six of 1 2 3"),
            ("/pat_1/seizure_list", 5, "  "), ("/pat_1/seizure_list", 6, None)]
    lines = spark.createDataFrame(rows, "path string, line_no int, line string")
    good, bad = parse_annotation_lines(lines)
    assert [tuple(r) for r in good.collect()] == [
        (1, datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 1, 0, 500000), 7, 8)]
    got = {r.line_no: r.reasons for r in bad.orderBy(F.col("line_no")).collect()}
    assert got == {2: ["bad onset", "bad onset_sample"], 3: ["expected 6 fields, got 2"]}


def test_each_stamp_is_rendered_once_and_each_line_trimmed_once(spark, sf_dir):
    plan = catalog.REGISTRY["annotation_rejects"](spark, sf_dir)._jdf.queryExecution()
    text = plan.optimizedPlan().toString()
    # onset and offset, each in whole seconds or with the fraction, and the year of a bad onset
    assert text.count("date_format(") == 5
    assert text.count("make_dt_interval(") == 1
    assert text.count("regexp_replace(") == 1


def test_rendered_lines_with_nulls(spark, tmp_path):
    ts = datetime(2024, 1, 2, 3, 4, 5, 250000)
    spark.createDataFrame(
        [(2, ts, 5, "view", 1.5, "{}"), (3, ts, 5, "view", 1.5, "{}"),
         (14, ts, 5, "view", 1.5, "{}"), (6, None, 5, "view", 1.0, "{}"),
         (7, ts, 5, "view", None, "{}"), (8, ts, None, "view", 1.0, "{}"),
         (None, ts, 5, "view", 1.0, "{}"), (10, ts, 5, "view", 1.0, "{}"),
         (15, ts, 5, "view", 1.0, "{}")],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
        "props string").write.parquet(f"{tmp_path}/events.parquet")
    got = {r.line_no: (r.path, r.line)
           for r in standins.annotation_lines(spark, str(tmp_path)).collect()}
    path, stamp = "/data/inv/pat_5/seizure_list", "2024-01-02 03:04:05.250000"
    end = "2024-01-02 03:05:05.250000"
    assert got == {
        3: (path, "2024-01-02 03:04:05 2024-01-02 03:05:35 512 517"),
        4: (path, "2024-96-02 03:04:05.250000\t2024-01-02 03:05:35.250000\t768\t773"),
        15: (path, f"{stamp}  2024-01-02 03:05:35.250000  3584"),
        7: (path, "1536 1541"), 8: (path, f"{stamp} 1792 1797"),
        9: (None, f"{stamp}\t{end}\t2048"), None: (path, f"{stamp} {end} "),
        11: (path, "# note 10"), 16: (path, "")}
