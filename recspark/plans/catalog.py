"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads whole driver tables (see ``standins``) and calls the
library operators; the SQL twin of each lives in ``plans/oracle.py``.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.functions import electrodes, paths
from recspark.functions.timefmt import add_seconds, epoch_seconds
from recspark.operators import (channels, labels, qc, quality, store, summary, timeline,
                                training)
from recspark.plans import standins as S
from recspark.sources import annotations, headers, pages
from recspark.session import apply_query_conf, scratch_path, stored

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_query_conf(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return run
    return wrap


def run_sql(spark: SparkSession, text: str, views: dict[str, DataFrame]) -> DataFrame:
    """Run SQL text over the given frames registered as temp views."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text)


def _counts_with_patient(spark, d) -> DataFrame:
    """Chunk counts per (recording, type, state) with the patient attached.

    Aggregating lineitem before the join shrinks the join input and leaves it
    hash-partitioned on the recording key, which the join then reuses.
    """
    per_rec = summary.chunk_counts(S.chunk_rows(spark, d),
                                   by=("recording_id", "data_type", "seizure_state"), out="n")
    rec = S.recordings(spark, d).select("recording_id", "patient_id")
    return per_rec.join(rec, "recording_id")


# --- labelling ---------------------------------------------------------------

@query("label_chunks")
def label_chunks(spark, d):
    """J3 + H8: label every non-error event second from the error intervals."""
    ch = S.timed_chunks(spark, d)
    out = labels.label_intervals(ch, S.annotations(spark, d), "patient_id",
                                 "chunk_start_ts", "chunk_end_ts")
    return out.select("event_id", "patient_id", "chunk_start_ts", "seizure_state")


@query("label_counts")
def label_counts(spark, d):
    """A6 over the labelled chunks."""
    return summary.chunk_counts(label_chunks(spark, d), by=("seizure_state",))


# --- summaries ----------------------------------------------------------------

@query("chunk_summary")
def chunk_summary(spark, d):
    """A2 + J2: dataset -> patient -> type x state counts, empty patients kept."""
    return summary.chunk_summary(_counts_with_patient(spark, d), S.patients(spark, d),
                                 S.datasets(spark, d), count_col="n")


@query("chunk_summary_rollup")
def chunk_summary_rollup(spark, d):
    """A3: subtotals per dataset and patient, grand total."""
    return summary.chunk_summary_rollup(_counts_with_patient(spark, d),
                                        S.patients(spark, d), count_col="n")


@query("patients_per_dataset")
def patients_per_dataset(spark, d):
    """A4 + J1: patients per dataset and in total."""
    return summary.patients_per_dataset(S.patients(spark, d), S.datasets(spark, d))


@query("class_ratio")
def class_ratio(spark, d):
    """Share of each state among all chunks."""
    return summary.class_ratio(S.chunk_rows(spark, d))


@query("count_by_type")
def count_by_type(spark, d):
    """Chunks per channel type."""
    return summary.chunk_counts(S.chunk_rows(spark, d), by=("data_type",))


@query("top_patients")
def top_patients(spark, d):
    """Ten largest patients by chunk count (top-k: the limit is the feature)."""
    return summary.top_patients(_counts_with_patient(spark, d), 10, count_col="n")


@query("annotations_per_patient")
def annotations_per_patient(spark, d):
    """Intervals per patient, zero when none."""
    return summary.annotations_per_patient(S.patients(spark, d), S.annotations(spark, d))


@query("table_counts")
def table_counts(spark, d):
    """A5: row count of every table."""
    return summary.table_counts({t: S.table(spark, d, t) for t in S.TABLES})


@query("filtered_count")
def filtered_count(spark, d):
    """A1 / M4: training-set length per patient with the default state filter."""
    return summary.filtered_count(S.chunks(spark, d), states=(0, 2))


# --- training sets --------------------------------------------------------------

# lineitem repeats (order, line, part) a few times; the payload breaks those ties
TRAINING_KEY = ("recording_id", "chunk_idx", "channel_idx", "data", "seizure_state",
                "data_type")


def _training_chunks(spark, d) -> DataFrame:
    return S.chunks(spark, d)


@query("training_batches")
def training_batches(spark, d):
    """M1 + W2 + L3: states 0 and 2, all types, pages of 1000 in key order."""
    return training.training_set(_training_chunks(spark, d), states=(0, 2), batch_size=1000,
                                 key=TRAINING_KEY, payload=("patient_id",))


# --- membership ----------------------------------------------------------------------

@query("patients_with_chunks")
def patients_with_chunks(spark, d):
    """J4 + A15: patients that have at least one chunk."""
    return summary.patients_with_chunks(S.patients(spark, d), S.chunks(spark, d))


@query("patients_unreviewed")
def patients_unreviewed(spark, d):
    """J5 + L4 + H3: patients with chunks not on the reviewed list.

    The reviewed list is the supplier names, whose trailing digits are the ids.
    """
    reviewed = S.table(spark, d, "supplier").select(
        electrodes.trailing_id("s_name").alias("patient_id"))
    with_chunks = summary.patients_with_chunks(S.patients(spark, d), S.chunks(spark, d))
    return summary.not_reviewed(with_chunks, reviewed)


# --- text sources ----------------------------------------------------------------------

_HEADER_OUT = ("data_file", "patient_id", "dataset_name", "start_ts", "num_samples",
               "sample_freq", "conversion_factor", "num_channels", "elec_names", "adm_id",
               "rec_id", "duration_in_sec", "sample_bytes")


@query("parse_headers")
def parse_headers(spark, d):
    """S3 + Q1 + H9 + H10: headers rendered from orders, parsed; good rows."""
    good, _ = headers.parse_headers(S.header_texts(spark, d))
    return good.select(*_HEADER_OUT, F.size("electrodes").alias("n_electrodes"),
                       F.col("extra")["site"].alias("site"))


@query("header_rejects")
def header_rejects(spark, d):
    """S3 + Q1: rejected headers with every reason."""
    _, bad = headers.parse_headers(S.header_texts(spark, d))
    return bad.select("path", F.array_join("reasons", ";").alias("reasons"))


@query("parse_annotations")
def parse_annotations(spark, d):
    """S4 + H4: annotation lines rendered from events, parsed; good rows."""
    good, _ = annotations.parse_annotation_lines(S.annotation_lines(spark, d))
    return good


@query("annotation_rejects")
def annotation_rejects(spark, d):
    """Skipped annotation lines with the reason."""
    _, bad = annotations.parse_annotation_lines(S.annotation_lines(spark, d))
    return bad.select("path", "line_no", F.array_join("reasons", ";").alias("reasons"))


# Names a listing page links to that are not patient listings (fixed list).
NON_LISTING_ANCHORS = ("The", "the", "and", "of", "to", "a", "in")


@query("page_links")
def page_links(spark, d):
    """Anchor texts of every page, minus the fixed non-listing names."""
    return pages.listing_links(S.table(spark, d, "pages"), must_contain=None,
                               exclude=NON_LISTING_ANCHORS)


@query("page_text")
def page_text(spark, d):
    """Text of the first heading of every page (pages here carry no <pre>)."""
    return pages.first_tag_text(S.table(spark, d, "pages"), tag="h1")


PACKAGES = ("inv_30", "surf_30")


@query("listing_links")
def listing_links(spark, d):
    """S10 + S12: listing names on fetched pages: anchors with ``_`` that are no packages."""
    packages = spark.createDataFrame([(p,) for p in PACKAGES], "anchor string")
    return pages.listing_links(S.listing_pages(spark, d), exclude=packages)


@query("listing_annotations")
def listing_annotations(spark, d):
    """S10 + S4: the ``<pre>`` of each patient page, parsed as an annotation list."""
    fetched = S.listing_pages(spark, d)
    text = pages.first_tag_text(fetched).where(F.col("text") != "").join(
        fetched.select("page_id", "patient_id"), "page_id")
    lines = annotations.text_lines(text.withColumn("path", F.col("page_id").cast("string")),
                                   "text")
    good, _ = annotations.parse_annotation_lines(lines, patient_col="patient_id")
    return good


@query("package_datasets")
def package_datasets(spark, d):
    """S12 + H10: datasets of packages and of directories, from suppliers named in turn
    ``inv_<n>``, ``surf_<n>``, ``other`` and kept below ``n_inv``, ``n_surf30``, ``n_raw``."""
    k = F.col("s_suppkey")
    s = S.table(spark, d, "supplier").select(
        k.alias("s_suppkey"),
        F.when(k % 3 == 0, F.concat(F.lit("inv_"), k)).when(k % 3 == 1, F.concat(
            F.lit("surf_"), k)).otherwise(F.lit("other")).alias("package"),
        F.concat(F.lit("/data/"), k, F.lit("_"),
                 F.when(k % 4 == 0, F.lit("inv")).when(k % 4 == 1, F.lit("surf30"))
                 .otherwise(F.lit("raw")),
                 F.lit("/pat_"), k, F.lit("/seizure_list")).alias("path"))
    return s.select("s_suppkey", pages.dataset_of_package("package").alias("package_dataset"),
                    paths.dataset_of_dir(paths.dataset_dir("path")).alias("dir_dataset"),
                    paths.patient_of_path("path").alias("patient_id"))


@query("resolve_patient_dirs")
def resolve_patient_dirs(spark, d):
    """Listing FR_<supplier> -> first existing of pat_<n>02, pat_<n>03.

    Existing directories are pat_<customer> of all customers; suppliers beyond a hundredth
    of the largest customer have none.
    """
    listings = S.table(spark, d, "supplier").select(
        F.concat(F.lit("FR_"), F.col("s_suppkey").cast("string")).alias("listing"))
    existing = (S.table(spark, d, "customer")
                .select(F.concat(F.lit("pat_"), F.col("c_custkey").cast("string"))
                        .alias("dir_name")))
    return pages.resolve_listing_dirs(listings, existing)


# --- electrodes ---------------------------------------------------------------------------

def _electrode_array():
    return F.array(*[F.lit(x) for x in S.STANDIN_ELECTRODES])


@query("electrode_types")
def electrode_types(spark, d):
    """H2: type code of a name per dataset; parts get a name and a dataset."""
    p = S.table(spark, d, "part")
    n = len(S.STANDIN_ELECTRODES)
    return p.select(
        "p_partkey",
        F.element_at(_electrode_array(), (F.col("p_partkey") % n + 1).cast("int"))
        .alias("electrode"),
        F.when(F.col("p_size") % 2 == 0, F.lit("inv")).otherwise(F.lit("surf"))
        .alias("dataset_name")
    ).withColumn("data_type", electrodes.electrode_type("electrode", "dataset_name"))


def _recording_electrodes(spark, d):
    """Orders with a header-style name list: ``3 + k%5`` names from position ``k%12``,
    in Python-list notation for every third order; dataset by customer nation parity."""
    o = S.table(spark, d, "orders").join(
        S.table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"),
                                             "c_nationkey"), "o_custkey", "left")
    k = F.col("o_orderkey")
    n = len(S.STANDIN_ELECTRODES)
    names = F.slice(_electrode_array(), (k % n + 1).cast("int"), (k % 5 + 3).cast("int"))
    pylist = F.concat(F.lit("['"), F.array_join(names, "', '"), F.lit("']"))
    plain = F.concat(F.lit("["), F.array_join(names, ","), F.lit("]"))
    text = F.when(k % 3 == 0, pylist).otherwise(plain)
    return o.select(
        k.alias("recording_id"),
        electrodes.parse_electrode_list(text).alias("electrodes"),
        F.when(F.col("c_nationkey") % 2 == 0, F.lit("inv")).otherwise(F.lit("surf"))
        .alias("dataset_name"))


@query("channel_map")
def channel_map(spark, d):
    """J6 + H1 + H2: lineitem channel (line - 1) paired with its recording's name."""
    ch = S.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("recording_id"),
        (F.col("l_linenumber") - 1).cast("int").alias("channel_idx"), "l_partkey")
    out = channels.attach_electrodes(ch, _recording_electrodes(spark, d))
    return out.select("recording_id", "channel_idx", "l_partkey", "electrode", "dataset_name",
                      "data_type", "missing_name")


# --- vector QC ------------------------------------------------------------------------------

@query("vector_stats")
def vector_stats(spark, d):
    """A11 + H7: per-vector length, min, max, mean, population std."""
    return qc.vector_stats(S.vectors(spark, d)).select(
        "vec_id", "patient_id", "n_values", "vmin", "vmax", "vmean", "vstd")


@query("matrix_stats")
def matrix_stats(spark, d):
    """The same statistics over all values of all vectors."""
    return qc.matrix_stats(S.vectors(spark, d))


@query("payload_size_range")
def payload_size_range(spark, d):
    """min/max payload bytes per patient."""
    return qc.payload_size_range(S.payloads(spark, d), by="patient")


@query("vector_size_stats")
def vector_size_stats(spark, d):
    """A10: describe() of payload bytes."""
    return qc.describe_sizes(S.payloads(spark, d))


@query("nan_inf")
def nan_inf(spark, d):
    """NaN / inf counts per patient."""
    return qc.nan_inf_counts(S.faulty_vectors(spark, d), by="patient_id")


@query("flatlines")
def flatlines(spark, d):
    """Flat rows and the spread of row std."""
    return qc.flatlines(S.faulty_vectors(spark, d, with_nan=False))


@query("amplitude_histogram")
def amplitude_histogram(spark, d):
    """50-bin histogram of all values."""
    return qc.amplitude_histogram(S.vectors(spark, d))


@query("multichannel")
def multichannel(spark, d):
    """Q7: all channels of one (recording, chunk) together, in channel order."""
    g = qc.same_instant_channels(S.chunk_rows(spark, d), fields=("data",))
    return g.select(
        "recording_id", "chunk_idx", F.size("channels").cast("bigint").alias("n_channels"),
        F.array_join(F.transform("channels", lambda c: c["channel_idx"].cast("string")), ",")
        .alias("channel_list"),
        F.round(F.aggregate("channels", F.lit(0.0), lambda a, c: a + c["data"]), 2)
        .alias("data_sum"))


# --- time axis ------------------------------------------------------------------------------

@query("unit_norm")
def unit_norm(spark, d):
    """Event values as channels of an hour, scaled to unit L2 norm."""
    ev = S.table(spark, d, "events").select(
        "event_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("instant"), "value")
    out = timeline.unit_norm(ev, ["instant"], "value")
    return out.select("event_id", "instant", F.round("value_norm", 9).alias("value_norm"))


@query("decimate_short")
def decimate_short(spark, d):
    """H5 (SQL form): per-user value series, taps 1/4 1/2 1/4, keep every 4th."""
    ev = S.table(spark, d, "events").select("user_id", "ts", "event_id", "value")
    out = timeline.decimate_series(ev, ["user_id"], ["ts", "event_id"], "value",
                                   taps=(0.25, 0.5, 0.25), q=4)
    return out.select("user_id", "j", F.round("y", 9).alias("y"))


@query("tumbling_chunks")
def tumbling_chunks(spark, d):
    """Each user's event span cut into whole hours, tail dropped."""
    spans = S.table(spark, d, "events").groupBy("user_id").agg(
        F.min("ts").alias("start_ts"),
        (epoch_seconds(F.max("ts")) - epoch_seconds(F.min("ts"))).alias("span_sec"))
    return timeline.tumbling_chunks(spans, "start_ts", "span_sec", 3600, keys=("user_id",))


@query("recording_timeline")
def recording_timeline(spark, d):
    """Recordings of a patient end to end: order, elapsed time, gaps."""
    return timeline.recording_timeline(S.recordings(spark, d))


@query("session_timeline")
def session_timeline(spark, d):
    """The recordings of each long recording (patient, rec_id) end to end."""
    return timeline.recording_timeline(S.grouped_recordings(spark, d),
                                       keys=("patient_id", "rec_id"))


@query("recording_sessions")
def recording_sessions(spark, d):
    """Extent, recorded, missing and repeated seconds of each long recording."""
    return timeline.recording_sessions(S.grouped_recordings(spark, d))


@query("placed_annotations")
def placed_annotations(spark, d):
    """Every annotation on its recording, or the time since the last one ended."""
    return timeline.place_annotations(S.annotations(spark, d), S.grouped_recordings(spark, d))


@query("recordings_ordered")
def recordings_ordered(spark, d):
    """S8 + L1: recordings of each patient in start order."""
    r = S.recordings(spark, d).select("patient_id", "recording_id", "start_ts")
    return timeline.ordered_within(r, ["patient_id"], ["start_ts", "recording_id"])


@query("annotations_ordered")
def annotations_ordered(spark, d):
    """S7 + L1: annotations of each patient in onset order."""
    a = S.annotations(spark, d)
    return timeline.ordered_within(a, ["patient_id"], ["onset", "offset"])


@query("first_recordings")
def first_recordings(spark, d):
    """P7 + W3: the first two recordings of each patient."""
    r = S.recordings(spark, d).select("patient_id", "recording_id", "start_ts")
    return timeline.first_per_group(r, ["patient_id"], ["start_ts", "recording_id"], 2)


# --- integrity --------------------------------------------------------------------------------

@query("pk_duplicates")
def pk_duplicates(spark, d):
    """Q2: patient ids taken twice once suppliers are loaded as patients."""
    pats = S.patients(spark, d).select("patient_id").unionByName(
        S.table(spark, d, "supplier").select(F.col("s_suppkey").alias("patient_id")))
    return quality.duplicate_keys(pats, "patient_id")


@query("fk_orphans")
def fk_orphans(spark, d):
    """Q3: recordings whose patient is not registered: every 97th order is moved to a patient
    id that no customer has (the negative of its own)."""
    recordings = S.recordings(spark, d).select("recording_id", "patient_id")
    moved = F.when(F.col("recording_id") % 97 == 0, -F.col("patient_id"))
    return quality.orphans(
        recordings.withColumn("patient_id", F.coalesce(moved, "patient_id")),
        S.table(spark, d, "customer"), "patient_id", "c_custkey")


@query("domain_rejects")
def domain_rejects(spark, d):
    """Q8: chunks typed by line number (0..6) against the 0..3 domain."""
    raw = S.chunk_rows(spark, d).withColumn(
        "data_type", (F.col("chunk_idx") - 1).cast("smallint"))
    _, bad = quality.domain_check(raw)
    return bad.select("recording_id", "chunk_idx", "channel_idx",
                      F.array_join("reasons", ";").alias("reasons"))


@query("state_rejects")
def state_rejects(spark, d):
    """Q8: chunks whose state is the line number (1..7, NULL for 7) against the domain 0..2."""
    line = F.col("chunk_idx")
    raw = S.chunk_rows(spark, d).withColumn(
        "seizure_state", F.when(line < 7, line).cast("int"))
    _, bad = quality.domain_check(raw)
    return bad.select("recording_id", "chunk_idx", "channel_idx",
                      F.array_join("reasons", ";").alias("reasons"))


# --- ad-hoc reads -------------------------------------------------------------------------------

SQL_QUERY_TEXT = """
SELECT o_orderpriority, count(*) AS n_recordings, count(DISTINCT o_custkey) AS n_patients
FROM orders GROUP BY o_orderpriority"""


@query("sql_query")
def sql_query(spark, d):
    """SQL text over registered views."""
    return run_sql(spark, SQL_QUERY_TEXT, {"orders": S.table(spark, d, "orders")})


def _top_patient_chunks(spark, d):
    top = summary.top_patients(_counts_with_patient(spark, d), 1, count_col="n")
    return S.chunks(spark, d).join(top.select("patient_id"), "patient_id", "left_semi")


@query("patient_sample_200")
def patient_sample_200(spark, d):
    """L2 + H7: 200 chunks of the largest patient in key order."""
    rows = _top_patient_chunks(spark, d)
    return qc.first_rows_matrix(rows, list(TRAINING_KEY), n=200).select(
        *TRAINING_KEY)


@query("state_sample_200")
def state_sample_200(spark, d):
    """L2 + H7: the first 200 chunks in key order of the largest state (a limit that acts)."""
    state = (summary.chunk_counts(S.chunk_rows(spark, d), by=("seizure_state",), out="n")
             .orderBy(F.desc("n"), "seizure_state").first().seizure_state)
    rows = S.chunks(spark, d).where(F.col("seizure_state") == state)
    return qc.first_rows_matrix(rows, list(TRAINING_KEY), n=200).select(*TRAINING_KEY)


@query("patient_select")
def patient_select(spark, d):
    """P1 + P2 + P3: one patient by equality (the largest), states 0 and 2, surface type,
    from a store partitioned by state and type whose files are sorted by patient: other
    partitions aren't opened, and row groups of other patients are skipped by their statistics."""
    top = summary.top_patients(_counts_with_patient(spark, d), 1, count_col="n").first()
    path = scratch_path(spark, "patient-store")
    store.write_partitioned(S.chunks(spark, d), path,
                            partition_cols=("seizure_state", "data_type"),
                            sort_cols=("patient_id", *TRAINING_KEY[:3]))
    rows = store.read_store(spark, path)
    return training.select_chunks(rows, patient_id=top.patient_id, states=(0, 2),
                                  data_types=(3,)).select(*TRAINING_KEY, "patient_id")


@query("chunk_select")
def chunk_select(spark, d):
    """P1 + P2 + P5: the largest patient's chunks in states 0 and 2."""
    rows = training.select_chunks(_top_patient_chunks(spark, d), states=(0, 2))
    return rows.select(*TRAINING_KEY)


@query("chunk_select_all_types")
def chunk_select_all_types(spark, d):
    """P2 + P3 + P4: all patients, states 0 and 2, surface channels only."""
    rows = training.select_chunks(S.chunks(spark, d), states=(0, 2), data_types=(3,))
    return rows.select(*TRAINING_KEY, "patient_id")


@query("training_all")
def training_all(spark, d):
    """M3: all patients, states 0/2, type 3, batches of 32."""
    return training.training_set(_training_chunks(spark, d), states=(0, 2), data_types=(3,),
                                 batch_size=32, key=TRAINING_KEY, payload=("patient_id",))


@query("shuffled_batches")
def shuffled_batches(spark, d):
    """M2: the pages of training_batches and their places in a seeded epoch."""
    return training.shuffle_batches(training_batches(spark, d), seed=7)


def _scale_payload(df):
    return df.withColumn("data", F.round(F.col("data") / 1000, 6))


@query("transform_hook")
def transform_hook(spark, d):
    """training_all with a user transform (payload / 1000)."""
    return training.training_set(_training_chunks(spark, d), states=(0, 2), data_types=(3,),
                                 batch_size=32, key=TRAINING_KEY, payload=("patient_id",),
                                 transform=_scale_payload)


# --- maintenance --------------------------------------------------------------------------------

@query("remove_patient_chunks")
def remove_patient_chunks(spark, d):
    """Chunks left after deleting the patients of dataset 7."""
    doomed = S.patients(spark, d).where(F.col("dataset_id") == 7)
    left = store.delete_rows(S.chunks(spark, d), doomed, "patient_id")
    return left.select("recording_id", "chunk_idx", "channel_idx", "patient_id")


@query("cascade_delete")
def cascade_delete(spark, d):
    """Delete the datasets of region 1 with their patients, recordings,
    annotations and chunks; row counts of what remains."""
    ds = S.table(spark, d, "nation").select(F.col("n_nationkey").alias("dataset_id"),
                                            F.col("n_name").alias("name"), "n_regionkey")
    tables = {"datasets": ds, "patients": S.patients(spark, d),
              "recordings": S.recordings(spark, d), "annotations": S.annotations(spark, d),
              "chunks": S.chunk_rows(spark, d)}
    links = [("datasets", "dataset_id", "patients", "dataset_id"),
             ("patients", "patient_id", "recordings", "patient_id"),
             ("patients", "patient_id", "annotations", "patient_id"),
             ("recordings", "recording_id", "chunks", "recording_id")]
    left = store.cascade_delete(tables, links, "datasets", ds.where("n_regionkey = 1"),
                                "dataset_id")
    return summary.table_counts(left)


@query("upsert_dataset")
def upsert_dataset(spark, d):
    """K1: regions are the datasets; nation and region names are loaded again."""
    existing = S.table(spark, d, "region").select(F.col("r_regionkey").alias("dataset_id"),
                                                  F.col("r_name").alias("name"))
    names = S.table(spark, d, "nation").select(F.col("n_name").alias("name")).unionByName(
        existing.select("name"))
    return store.upsert_names(existing, names)


@query("upsert_patient")
def upsert_patient(spark, d):
    """K2 + Q3: suppliers loaded as patients; new ids with a known dataset only."""
    incoming = S.table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("patient_id"), F.col("s_nationkey").alias("dataset_id"))
    incoming = incoming.join(S.datasets(spark, d).select("dataset_id"), "dataset_id",
                             "left_semi")
    return store.upsert_by_key(S.patients(spark, d), incoming.select("patient_id", "dataset_id"),
                               "patient_id")


@query("append_annotations")
def append_annotations(spark, d):
    """K3 + L5: the annotation list loaded twice plus signup intervals; idempotent."""
    ann = S.annotations(spark, d)
    ev = S.table(spark, d, "events").where(F.col("event_type") == "signup")
    signup = ev.select(F.col("user_id").alias("patient_id"), F.col("ts").alias("onset"),
                       add_seconds("ts", F.round(F.col("value") * 60, 6)).alias("offset"))
    return store.append_dedupe(ann, ann.unionByName(signup), ["patient_id", "onset", "offset"])


@query("partition_rewrite")
def partition_rewrite(spark, d):
    """Chunks written partitioned by dataset/state/type, read back whole."""
    ch = S.chunks(spark, d).join(S.patients(spark, d), "patient_id", "left")
    path = scratch_path(spark, "partition-rewrite")
    store.write_partitioned(ch, path, partition_cols=("dataset_id", "seizure_state", "data_type"),
                            sort_cols=("recording_id", "chunk_idx", "channel_idx"),
                            mode="overwrite")
    back = store.read_store(spark, path, schema=ch.schema)
    return back.select(*ch.columns)


@query("layout_rewrite")
def layout_rewrite(spark, d):
    """K9 + K10 + K11: chunks stored by dataset, then rewritten by state and type; both versions
    stay readable."""
    ch = S.chunks(spark, d).join(S.patients(spark, d), "patient_id", "left")
    path = scratch_path(spark, "layouts")
    first = store.commit_version(spark, ch, path, ["dataset_id"])
    second = store.rewrite_layout(spark, path, ["seizure_state", "data_type"])
    out = None
    for version in (first, second):
        rows = store.read_version(spark, path, version).groupBy("seizure_state", "data_type").agg(
            F.count(F.lit(1)).alias("n_chunks"), F.sum("recording_id").alias("id_sum"))
        rows = rows.select(F.lit(version).cast("bigint").alias("version"), "*")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("dense_ids")
def dense_ids(spark, d):
    """Ids 1..n without gaps over two appends (every third recording, then the others)."""
    rows = S.chunk_rows(spark, d).select("recording_id", "chunk_idx", "channel_idx")
    third = F.col("recording_id") % 3 == 0
    key = ["recording_id", "chunk_idx", "channel_idx"]
    none = rows.limit(0).withColumn("id", F.lit(0).cast("bigint"))
    first = store.append_with_ids(spark, none, rows.where(third), key,
                                  scratch_path(spark, "ids"))
    return store.append_with_ids(spark, first, rows.where(~third), key,
                                 scratch_path(spark, "ids"))


@query("add_annotations")
def add_annotations(spark, d):
    """K6: the annotations of the patient with most of them, written as a list and loaded
    twice for that patient."""
    from recspark.ingest import add_annotations as add
    ann = S.annotations(spark, d).select(F.col("patient_id").cast("int"), "onset", "offset")
    top = (ann.groupBy("patient_id").count().orderBy(F.desc("count"), "patient_id").first())
    mine = ann.where(F.col("patient_id") == top.patient_id)
    stamp = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    path = scratch_path(spark, "annotation-list")
    (mine.select(F.concat_ws("\t", F.date_format("onset", stamp), F.date_format("offset", stamp),
                             F.lit("0"), F.lit("0")).alias("value"))
     .write.option("compression", "none").text(path))
    none = spark.createDataFrame([], "patient_id int, onset timestamp_ntz, offset timestamp_ntz, "
                                     "onset_sample bigint, offset_sample bigint")
    once, _ = add(spark, none, f"{path}/*.txt", top.patient_id)
    twice, _ = add(spark, once, f"{path}/*.txt", top.patient_id)
    return twice.select("patient_id", "onset", "offset")


@query("payload_roundtrip")
def payload_roundtrip(spark, d):
    """H6: every vector as little-endian bytes and back, NaN and infinite values included."""
    from recspark.operators import signal
    v = S.faulty_vectors(spark, d).select("vec_id", signal.payload_bytes(F.col("data")).alias("b"))
    return v.select("vec_id", F.octet_length("b").alias("n_bytes"),
                    signal.payload_vector(F.col("b")).alias("back"))


@query("std_quartiles")
def std_quartiles(spark, d):
    """Exact quartiles of unrounded row stds (with ties) per group, selected by counts."""
    rows = stored(spark, S.faulty_vectors(spark, d, with_nan=False).select(
        (F.col("vec_id") % 7).alias("grp"), qc.vector_std_pop("data").alias("std")), "stds")
    return qc.exact_quantiles(rows, "std", [0.25, 0.5, 0.75], ["grp"]).select(
        "grp", "prob", F.round("value", 9).alias("value"))


@query("schema_report")
def schema_report(spark, d):
    """Q5: columns of documents with their types, defaults and NULLs."""
    return qc.schema_report(S.table(spark, d, "documents"))


@query("time_columns")
def time_columns(spark, d):
    """Q6: the columns of events whose names speak of time, with their NULLs."""
    return qc.time_columns(S.table(spark, d, "events"))


# --- raw signals ------------------------------------------------------------------------------

def _tree(spark, root: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Metadata and file lengths of a tree. Both are stored, as several steps of a load read
    them: the tree is walked and its headers parsed once."""
    from recspark.ingest import load_metadata
    from recspark.sources.discovery import data_file_sizes

    meta = load_metadata(spark, root)
    meta["recordings"] = stored(spark, meta["recordings"], "recordings-table")
    return meta, stored(spark, data_file_sizes(spark, root), "file-sizes")


def rendered(spark, d) -> tuple[dict[str, DataFrame], DataFrame]:
    """Metadata and file lengths of the recordings rendered from events."""
    from recspark.plans.recordings import render_recordings
    return _tree(spark, render_recordings(spark, d))


def waves(spark, d, root: str, users=None) -> Iterator[tuple[dict[str, DataFrame], DataFrame]]:
    """``rendered`` a part of the recordings at a time below ``root``, each of which fits the
    disk; what a query takes from the samples of one must be stored before it asks for the next."""
    from recspark.plans.recordings import rendered_waves
    for tree in rendered_waves(spark, d, root, users):
        yield _tree(spark, tree)


def run_load(spark, recordings, sizes, annotations, block_seconds: int = 60, payload=None,
             staging: str | None = None):
    """The block job on recordings; returns ``(published chunks, errors)``.

    The block job's output is staged as a table in the shared checkpoint
    folder, so the job runs once for both results and a lost executor after
    it costs nothing. With ``payload`` (columns made from ``data``) the tasks of the block
    job stage these instead of ``data``, so no copy of all payloads is stored or shuffled.
    Loads that name one ``staging`` folder add to it, and return what all of them so far staged.
    """
    from recspark.operators import signal

    out, plan_errors = signal.signal_chunks(recordings, sizes, annotations, block_seconds)
    if payload is not None:
        out = out.select(*[c for c in out.columns if c != "data"], *payload)
    staging = staging or scratch_path(spark, "signal-staging")
    out.write.mode("append").parquet(staging)
    return signal.publish(spark.read.schema(out.schema).parquet(staging), plan_errors)


def signal_load(spark, d, block_seconds: int = 60, payload=None):
    """Render recordings from events, then run discovery, header parsing and the block job, a
    wave at a time; returns the published chunks of all, and their recordings."""
    staging, names = scratch_path(spark, "signal-staging"), scratch_path(spark, "record-ids")
    marks = S.annotations(spark, d)
    for meta, sizes in waves(spark, d, scratch_path(spark, "recordings")):
        ids = meta["recordings"].select("recording_id", "rec_id")
        ids.write.mode("append").parquet(names)
        good, _ = run_load(spark, meta["recordings"], sizes, marks, block_seconds, payload,
                           staging)
    return good, spark.read.schema(ids.schema).parquet(names)


@query("signal_chunks")
def signal_chunks(spark, d):
    """S1-S3 + S5 + H5 + W4 + W1 + J3 + J6 + Q4: recordings rendered from
    events, loaded end to end; one row per (chunk, channel), payload summarised."""
    from recspark.plans.recordings import payload_summary
    good, _ = signal_load(spark, d, payload=payload_summary())
    return good.select("patient_id", "recording_id", "chunk_idx", "channel_idx", "electrode",
                       "chunk_start_ts", "seizure_state", "data_type", "n_values", "vmean", "vstd")


@query("signal_index")
def signal_index(spark, d):
    """S2 + S5 + W1 + J3 + J6: what the load stores next to the payload, for every chunk
    and channel, in the tree's own record ids."""
    meta, sizes = rendered(spark, d)
    good, _ = run_load(spark, meta["recordings"], sizes, S.annotations(spark, d),
                       payload=[F.size("data").alias("n_values")])
    return good.join(meta["recordings"].select("recording_id", "rec_id"), "recording_id").select(
        "patient_id", "rec_id", "chunk_idx", "channel_idx", "electrode", "chunk_start_ts",
        "seizure_state", "data_type", "n_values")


@query("load_replace")
def load_replace(spark, d):
    """K4 + K8: all recordings are published without annotations, then those of patients
    with an even id again with them: live chunks by recording and state. Relabelled chunks leave the
    partitions they were in, the other recordings stay."""
    from recspark.ingest import publish_signals
    marks = S.annotations(spark, d)
    path, names = scratch_path(spark, "live-store"), scratch_path(spark, "record-ids")
    root = scratch_path(spark, "recordings")
    for meta, sizes in waves(spark, d, root):
        publish_signals(spark, meta["recordings"], sizes, marks.limit(0), path,
                        scratch_path(spark, "load-plan"), max_bad=sys.maxsize)
        ids = meta["recordings"].select("recording_id", "rec_id")
        ids.write.mode("append").parquet(names)
    for meta, sizes in waves(spark, d, root, F.col("user_id") % 2 == 0):
        even = meta["recordings"].where(F.col("patient_id") % 2 == 0)
        publish_signals(spark, even, sizes, marks, path, scratch_path(spark, "load-plan"),
                        max_bad=sys.maxsize)
    return (store.read_live(spark, path)
            .join(spark.read.schema(ids.schema).parquet(names), "recording_id")
            .groupBy("rec_id", "seizure_state").agg(F.count(F.lit(1)).alias("n_chunks")))


@query("signal_norm")
def signal_norm(spark, d):
    """W4 on the load's output: squares of a chunk over all channels and its 256 instants."""
    square = F.aggregate("data", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x)
    good, ids = signal_load(spark, d, payload=[F.size("data").alias("n_values"),
                                               square.alias("square")])
    return (good.join(ids, "recording_id")
            .groupBy("rec_id", "chunk_idx")
            .agg(F.count(F.lit(1)).alias("n_channels"), F.sum("n_values").alias("n_values"),
                 F.round(F.sum("square"), 2).alias("total_square")))


@query("bad_recordings")
def bad_recordings(spark, d):
    """Q4: what the load says of recordings with faults; of each, no chunk is published.

    By patient id modulo 5 the recording has too low a rate (1), no file (2), too few names (3),
    or a listed length behind the file's end, which only the block job can notice (4).
    """
    meta, sizes = rendered(spark, d)
    fault = F.col("patient_id") % 5
    recs = (meta["recordings"]
            .withColumn("sample_freq", F.when(fault == 1, 200).otherwise(F.col("sample_freq")))
            .withColumn("electrodes", F.when(fault == 3, F.slice("electrodes", 1, 2))
                        .otherwise(F.col("electrodes"))))
    patients = meta["recordings"].select("data_file", fault.alias("fault"))
    sizes = sizes.join(patients, "data_file").where("fault <> 2").select(
        "data_file", F.when(F.col("fault") == 4, F.col("length") + 60 * 1024 * 6)
        .otherwise(F.col("length")).alias("length"))
    good, errors = run_load(spark, recs, sizes, S.annotations(spark, d), payload=[])
    chunks = good.groupBy("recording_id").agg(F.count(F.lit(1)).alias("n_chunks"))
    # a message of the block job names the error's class first
    error = F.when(F.col("error").contains(":"), F.lit("unreadable block")).otherwise(F.col("error"))
    return (recs.join(errors.select("recording_id", error.alias("error")), "recording_id", "left")
            .join(chunks, "recording_id", "left")
            .select("patient_id", "rec_id", "error",
                    F.coalesce("n_chunks", F.lit(0)).cast("bigint").alias("n_chunks")))


def _record_id(file: str):
    return F.regexp_extract(file, r"/(\d+)_\d+\.data$", 1).cast("bigint")


@query("binary_roundtrip")
def binary_roundtrip(spark, d):
    """Every sample of every recording through the raw source, per second and channel,
    with a sum that depends on the order of the samples."""
    from recspark.sources.raw_signal import read_raw
    zero = F.lit(0).cast("bigint")
    placed = F.transform("samples", lambda v, i: v.cast("bigint") * (i + 1))
    path = scratch_path(spark, "roundtrip")
    for meta, sizes in waves(spark, d, scratch_path(spark, "recordings")):
        raw = read_raw(spark, meta["recordings"], sizes)
        rows = raw.select(
            _record_id("data_file").alias("rec_id"), "second", "channel_idx",
            F.size("samples").alias("n_samples"),
            F.aggregate("samples", zero, lambda acc, v: acc + v).alias("total"),
            F.aggregate(placed, zero, lambda acc, v: acc + v).alias("placed_total"),
            F.array_min("samples").alias("lowest"), F.array_max("samples").alias("highest"))
        rows.write.mode("append").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@query("raw_seconds_cap")
def raw_seconds_cap(spark, d):
    """At most 20 seconds of each recording, of those the ones from the fifth on, and two
    channels of three; cap, range and channels are applied by the source."""
    from recspark.sources.raw_signal import read_raw
    meta, sizes = rendered(spark, d)
    raw = read_raw(spark, meta["recordings"], sizes, max_seconds=20)
    zero = F.lit(0).cast("bigint")
    return raw.where("second >= 5 AND channel_idx IN (0, 2)").select(
        _record_id("data_file").alias("rec_id"), "second", "channel_idx",
        F.aggregate("samples", zero, lambda acc, v: acc + v).alias("total"))


@query("load_seconds_cap")
def load_seconds_cap(spark, d):
    """P7 in the load: chunks per recording and channel when it stops after 20 seconds."""
    from recspark.operators import signal
    meta, sizes = rendered(spark, d)
    out, _ = signal.signal_chunks(meta["recordings"], sizes, S.annotations(spark, d),
                                  max_seconds=20)
    return (out.join(meta["recordings"].select("recording_id", "rec_id"), "recording_id")
            .groupBy("rec_id", "channel_idx")
            .agg(F.count(F.lit(1)).alias("n_chunks"), F.max("chunk_idx").alias("last_chunk")))


@query("load_append")
def load_append(spark, d):
    """K1 + K4 + S1: a tree loaded in two batches (patients with an even id, then all), read
    back with the load that brought each recording, its patient and its dataset."""
    from recspark.operators import metadata
    from recspark.plans.recordings import render_recordings
    tree = metadata.list_tree(spark, render_recordings(spark, d))
    path = scratch_path(spark, "metadata")
    even = F.regexp_extract("path", r"/pat_(\d+)/", 1).cast("int") % 2 == 0
    metadata.load_tree(spark, tree.where(even), path)
    second = metadata.load_tree(spark, tree, path)
    if metadata.load_tree(spark, tree, path) is not None:
        raise AssertionError("a tree without changes was loaded again")
    recs = metadata.read_table(spark, path, "recordings")
    return (recs.join(metadata.patients(spark, path), "patient_id")
            .join(metadata.datasets(spark, path), "dataset_id")
            .select("patient_id", "rec_id",
                    F.when(F.col("load") == second, 2).otherwise(1).alias("load_no"),
                    "dataset_id", F.col("name").alias("dataset_name")))
