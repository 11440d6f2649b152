"""Stored recordings, patients and annotations, loaded incrementally.

A load lists the tree (paths, lengths and times; no content), takes the files that the
ledger doesn't have with the same length and time (an anti-join), reads and parses only those
in tasks, and appends their rows to tables partitioned by load. Its last step is one row in
``loads``: before it, nothing of the load is visible, so a load that fails changes nothing.

    <path>/{recordings, annotations, rejects, directories, ledger}/load=<n>/   <path>/loads/

A file's rows are those of its newest load: a changed header or list replaces its old
rows, also if it no longer parses. Earlier states stay readable by load number.
Patients and datasets come from the directories of the tree, with or without a header
or a list; their ids do not change as more arrive.
"""

from __future__ import annotations

import time

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from recspark.functions.paths import dataset_dir, dataset_of_dir, patient_of_path
from recspark.operators.store import upsert_names
from recspark.session import ship_package
from recspark.sources import annotations as ann_src
from recspark.sources import headers
from recspark.sources.raw_signal import file_system

_FILE = "path string, length bigint, modified timestamp"
SCHEMAS = {
    "ledger": _FILE,
    "directories": "patient_id int, name string",
    "recordings": "path string, recording_id bigint, patient_id int, dataset_name string, "
                  "start_ts timestamp_ntz, num_samples bigint, sample_freq int, "
                  "conversion_factor double, num_channels int, elec_names string, "
                  "electrodes array<string>, adm_id int, rec_id bigint, duration_in_sec int, "
                  "sample_bytes int, data_file string",
    "annotations": "path string, patient_id int, onset timestamp_ntz, offset timestamp_ntz, "
                   "onset_sample bigint, offset_sample bigint",
    "rejects": "path string, source string, line_no int, raw string, reasons array<string>",
}


def list_tree(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, modified) of every file of a tree; no content is read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
            .select("path", "length", F.col("modificationTime").alias("modified")))


def read_texts(files: DataFrame) -> DataFrame:
    """(path, text) of the listed files, read where the rows are."""
    def run(batches):
        for batch in batches:
            paths = batch.column(0).to_pylist()
            texts = []
            for path in paths:
                fs, name = file_system(path)
                with fs.open_input_file(name) as f:
                    texts.append(f.read().decode("utf-8", errors="replace"))
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()),
                                              pa.array(texts, pa.string())], names=["path", "text"])
    ship_package(files.sparkSession)
    return files.select("path").mapInArrow(run, "path string, text string")


def _raw(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(f"{path}/{name}")
    except AnalysisException:  # a new store
        return spark.createDataFrame([], schema)


def loads(spark: SparkSession, path: str, as_of: int | None = None) -> DataFrame:
    """Loads that are visible: finished, after the last reset, up to ``as_of``."""
    done = _raw(spark, path, "loads", "load bigint, reset boolean")
    if as_of is not None:
        done = done.where(F.col("load") <= as_of)
    # a row per load: read by the driver once, as a number
    last = done.where("reset").agg(F.max("load")).first()[0]
    return done.where(F.col("load") > F.lit(-1 if last is None else last)).select("load")


def _visible(spark, path, name, as_of) -> DataFrame:
    rows = _raw(spark, path, name, SCHEMAS[name] + ", load bigint")
    return rows.join(loads(spark, path, as_of), "load", "left_semi")


def ledger(spark: SparkSession, path: str, as_of: int | None = None) -> DataFrame:
    """The newest state of every file: path, length, modified, load."""
    last = F.max(F.struct("load", "length", "modified")).alias("s")
    return _visible(spark, path, "ledger", as_of).groupBy("path").agg(last).select("path", "s.*")


def read_table(spark: SparkSession, path: str, name: str, as_of: int | None = None) -> DataFrame:
    """``recordings``, ``annotations`` or ``rejects``: rows of each file's newest load, with
    the load's number. Annotations are one per patient, onset and offset (of the first
    path), as two lists may hold the same one."""
    newest = ledger(spark, path, as_of).select("path", "load")
    rows = _visible(spark, path, name, as_of).join(newest, ["path", "load"], "left_semi")
    if name != "annotations":
        return rows
    keys = ["patient_id", "onset", "offset"]
    return rows.groupBy(*keys).agg(
        F.min(F.struct("path", "onset_sample", "offset_sample", "load")).alias("s")).select(
        *keys, "s.*")


def datasets(spark: SparkSession, path: str, as_of: int | None = None) -> DataFrame:
    """(dataset_id, name): ids in order of the loads that brought a dataset, then by name."""
    first = _visible(spark, path, "directories", as_of).where("name is not null").groupBy(
        "name").agg(F.min("load").alias("load"))
    out = spark.createDataFrame([], "dataset_id int, name string")
    # the dataset kinds are a handful: a round per load that brought a new one
    for (load,) in sorted(first.select("load").distinct().collect()):
        out = upsert_names(out, first.where(F.col("load") == load))
    return out


def patients(spark: SparkSession, path: str, as_of: int | None = None) -> DataFrame:
    """(patient_id, dataset_id): a patient below two datasets belongs to the one that came
    first, then by name."""
    rows = _visible(spark, path, "directories", as_of).where(
        "patient_id is not null and name is not null")
    one = rows.groupBy("patient_id").agg(F.min(F.struct("load", "name")).alias("s"))
    return one.select("patient_id", F.col("s.name").alias("name")).join(
        datasets(spark, path, as_of), "name").select("patient_id", "dataset_id")


def _commit(spark: SparkSession, path: str, load: int, reset: bool = False) -> None:
    spark.createDataFrame([(load, reset)], "load bigint, reset boolean").write.mode(
        "append").parquet(f"{path}/loads")


def _next_load(spark: SparkSession, path: str) -> int:
    last = _raw(spark, path, "loads", "load bigint, reset boolean").agg(F.max("load")).first()[0]
    return max((last or 0) + 1, time.time_ns() // 1000)


def load_tree(spark: SparkSession, tree: str | DataFrame, path: str) -> int | None:
    """Add what is new in a tree (its root, or a listing of ``list_tree``) to the store at
    ``path``; returns the load's number, None if nothing is new."""
    listing = list_tree(spark, tree.rstrip("/")) if isinstance(tree, str) else tree
    number = _next_load(spark, path)
    new = listing.join(ledger(spark, path).drop("load"), ["path", "length", "modified"], "left_anti")

    def append(rows: DataFrame, name: str) -> None:
        rows = rows.select([f.split()[0] for f in _names(SCHEMAS[name])])
        rows.withColumn("load", F.lit(number)).write.mode("append").partitionBy("load").parquet(
            f"{path}/{name}")

    append(new, "ledger")
    mine = _raw(spark, path, "ledger", SCHEMAS["ledger"] + ", load bigint").where(
        F.col("load") == number)
    append(mine.select(patient_of_path("path").alias("patient_id"),
                       dataset_of_dir(dataset_dir("path")).alias("name")).distinct(), "directories")

    heads = read_texts(mine.where(F.col("path").rlike(r"/pat_[^/]+/.+\.head$")))
    good, bad = headers.parse_headers(heads)
    place = F.regexp_replace("data_file", r"\.data$", ".head")
    known = F.col("dataset_name").isNotNull() & F.col("patient_id").isNotNull()
    append(good.where(known).withColumn("path", place), "recordings")
    lost = good.where(~known).select(
        place.alias("path"), F.lit("header").alias("source"), F.lit(None).cast("int").alias("line_no"),
        F.lit(None).cast("string").alias("raw"),
        F.array(F.lit("unknown dataset directory or patient id")).alias("reasons"))

    lists = ann_src.text_lines(read_texts(mine.where(F.col("path").rlike("/seizure_list$"))))
    found, wrong = ann_src.parse_annotation_lines(lists, keep_path=True)
    append(found, "annotations")
    append(bad.unionByName(lost, True).unionByName(wrong, True), "rejects")
    if mine.isEmpty():
        return None
    _commit(spark, path, number)
    return number


def reset(spark: SparkSession, path: str) -> int:
    """K7: all tables read empty from here on; earlier states stay readable by number."""
    number = _next_load(spark, path)
    _commit(spark, path, number, True)
    return number


def _names(schema: str) -> list[str]:
    return schema.split(", ")
