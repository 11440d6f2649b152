"""Plan shape: pruning reaches the scan, no Python in SQL-only operators,
no cartesian products, labelling without a range join."""

import __spark_entry__ as E

from recspark.operators import store
from recspark.plans import standins as S

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_no_cartesian(spark):
    for name in ("label_chunks", "chunk_summary", "training_batches", "vector_stats",
                 "parse_headers", "recording_timeline", "decimate_short"):
        p = _plan(E.queries()[name](spark, SF))
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                    "BroadcastNestedLoopJoin"):
            assert bad not in p, (name, bad)


def test_label_join_is_equi_on_bucket(spark):
    p = _plan(E.queries()["label_chunks"](spark, SF))
    assert "_bucket" in p


def test_partition_pruning_and_column_pruning(spark, tmp_path):
    ch = S.chunks(spark, SF).join(S.patients(spark, SF), "patient_id")
    path = str(tmp_path / "store")
    store.write_partitioned(ch, path, mode="overwrite")
    df = store.read_store(spark, path).where("patient_id = 1 AND seizure_state IN (0, 2)")
    plan = _plan(df.select("recording_id"))
    assert "PartitionFilters: [isnotnull(patient_id" in plan
    assert "ReadSchema: struct<recording_id:bigint>" in plan
    full = spark.read.parquet(path).count()
    assert full == ch.count()
