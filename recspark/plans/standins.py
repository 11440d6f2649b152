"""Driver tables in the roles of the recording tables.

The driver's TPC-H-like tables have no physiological recordings, so every
operator is exercised on a table of the same shape:

==============  ==========================================================
role            driver table
==============  ==========================================================
datasets        nation (n_nationkey, n_name)
patients        customer (c_custkey -> patient, c_nationkey -> dataset)
recordings      orders (o_orderkey, o_custkey, o_orderdate)
chunks          lineitem joined to its order for the patient; l_linenumber
                is the chunk index, l_partkey the channel, l_returnflag the
                state, l_linestatus the type, l_extendedprice the payload
annotations     events of type ``error``: [ts, ts + value minutes]
timed chunks    other events: [ts, ts + 1 s]
==============  ==========================================================

The same mapping is written once more in SQL in ``plans/oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.functions.timefmt import add_seconds
from recspark.sources.headers import once

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Fixed mapping of TPC-H flags onto chunk codes.
STATE_OF_RETURNFLAG = {"N": 0, "R": 1, "A": 2}
TYPE_OF_LINESTATUS = {"O": 0, "F": 3}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _code(colname: str, mapping: dict) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(F.col(colname) == k, F.lit(v)) if expr is None
                else expr.when(F.col(colname) == k, F.lit(v)))
    return expr


def datasets(spark, d) -> DataFrame:
    return table(spark, d, "nation").select(
        F.col("n_nationkey").alias("dataset_id"), F.col("n_name").alias("name"))


def patients(spark, d) -> DataFrame:
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("patient_id"), F.col("c_nationkey").alias("dataset_id"))


def recordings(spark, d) -> DataFrame:
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("recording_id"),
        F.col("o_custkey").alias("patient_id"),
        F.col("o_orderdate").alias("start_ts"),
        F.round("o_totalprice").cast("bigint").alias("duration_in_sec"))


def chunk_rows(spark, d) -> DataFrame:
    """lineitem as chunks without the patient (no join)."""
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("recording_id"),
        F.col("l_linenumber").alias("chunk_idx"),
        F.col("l_partkey").alias("channel_idx"),
        _code("l_returnflag", STATE_OF_RETURNFLAG).cast("int").alias("seizure_state"),
        _code("l_linestatus", TYPE_OF_LINESTATUS).cast("smallint").alias("data_type"),
        F.col("l_extendedprice").alias("data"))


def chunks(spark, d) -> DataFrame:
    """Chunks with their patient: lineitem joined to its order."""
    rec = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("recording_id"), F.col("o_custkey").alias("patient_id"))
    return chunk_rows(spark, d).join(rec, "recording_id")


def annotations(spark, d) -> DataFrame:
    ev = table(spark, d, "events")
    return (ev.where(F.col("event_type") == "error")
            .select(F.col("user_id").alias("patient_id"),
                    F.col("ts").alias("onset"),
                    add_seconds("ts", F.round(F.col("value") * 60, 6)).alias("offset")))


def timed_chunks(spark, d) -> DataFrame:
    ev = table(spark, d, "events")
    return (ev.where(F.col("event_type") != "error")
            .select("event_id", F.col("user_id").alias("patient_id"),
                    F.col("ts").alias("chunk_start_ts"),
                    add_seconds("ts", 1).alias("chunk_end_ts")))


def grouped_recordings(spark, d) -> DataFrame:
    """Orders as recordings in the month of the events, three long recordings a patient.

    ``k = o_orderkey``: start ``k * 7919 % 2592000`` seconds into January 2024, ``rec_id``
    ``patient * 10 + k % 3`` (NULL where k%29=0), length the rounded price in seconds.
    """
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(
        k.alias("recording_id"), F.col("o_custkey").alias("patient_id"),
        F.when(k % 29 != 0, F.col("o_custkey") * 10 + k % 3).alias("rec_id"),
        add_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), k * 7919 % 2592000)
        .alias("start_ts"),
        F.round("o_totalprice").cast("bigint").alias("duration_in_sec"))


# --- synthesised text sources -------------------------------------------------------
#
# Header files and annotation lists are rendered from driver rows, with faults
# injected by key modulus so that every reject rule fires somewhere. The oracle
# SQL derives the expected parse directly from the same columns.

def _ts_text(c, whole_seconds=None):
    full = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if whole_seconds is None:
        return full
    return F.when(whole_seconds, F.date_format(c, "yyyy-MM-dd HH:mm:ss")).otherwise(full)


def header_texts(spark, d) -> DataFrame:
    """One header per order: ``(path, text)``.

    Faults by ``k = o_orderkey``: k%13=6 month 96 in start_ts; k%17=2 a second
    ``=`` on the rec_id line; k%19=4 conversion_factor ``n/a`` (NULL, kept);
    k%23=7 a blank line; k%7=3 no num_channels line; k%11=5 num_channels
    ``ninety-three``; k%5=1 a trailing ``#`` comment line.
    """
    # the narrow rows are dealt to all cores first: a table of one row group is one task,
    # and rendering and parsing are work per row
    o = table(spark, d, "orders").repartition(spark.sparkContext.defaultParallelism)
    k = F.col("o_orderkey")
    start = F.when(k % 13 == 6, F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-96-"),
                                         F.date_format("o_orderdate", "dd HH:mm:ss"))
                   ).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    freq = F.when(k % 3 == 0, 1024).when(k % 3 == 1, 512).otherwise(256)
    conv = F.when(k % 19 == 4, F.lit("n/a")).otherwise(
        (F.col("o_totalprice") / 1e6).cast("string"))
    rec = F.when(k % 17 == 2, F.concat(k.cast("string"), F.lit("="), k.cast("string"))
                 ).otherwise(k.cast("string"))
    nch = F.when(k % 11 == 5, F.lit("ninety-three")).otherwise((k % 90 + 3).cast("string"))
    lines = F.array_compact(F.array(
        F.concat(F.lit("start_ts="), start),
        F.concat(F.lit("num_samples="), F.floor(F.col("o_totalprice") * 10)
                 .cast("string")),
        F.concat(F.lit("sample_freq="), freq.cast("string")),
        F.concat(F.lit("conversion_factor="), conv),
        F.concat(F.lit("elec_names=[E"), k.cast("string"), F.lit(",ECG]")),
        F.concat(F.lit("pat_id="), F.col("o_custkey").cast("string")),
        F.concat(F.lit("adm_id="), (F.col("o_custkey") * 10 + 1).cast("string")),
        F.concat(F.lit("rec_id="), rec),
        F.lit("duration_in_sec=3600"),
        F.lit("sample_bytes=2"),
        F.concat(F.lit("site="), F.col("o_orderstatus")),
        F.when(k % 23 == 7, F.lit("")),
        F.when(k % 7 != 3, F.concat(F.lit("num_channels="), nch)),
        F.when(k % 5 == 1, F.lit("#checked=yes"))))
    path = F.concat(F.lit("/data/inv/pat_"), F.col("o_custkey").cast("string"),
                    F.lit("/adm_"), (F.col("o_custkey") * 10 + 1).cast("string"),
                    F.lit("/rec_"), k.cast("string"), F.lit("/"), k.cast("string"),
                    F.lit(".head"))
    return o.select(path.alias("path"),
                    F.concat(F.array_join(lines, "\n"), F.lit("\n")).alias("text"))


def annotation_lines(spark, d) -> DataFrame:
    """One annotation line per event: ``(path, line_no, line)``.

    ``e = event_id``: e%10=0 a comment, e%10=5 a blank line, e%7=2 whole-second
    stamps, e%5=3 tabs and e%5=4 double spaces between fields, e%13=1 the last
    field missing, e%17=3 month 96 in the onset.
    """
    # dealt to all cores, as the headers are: rendering and parsing are work per row. The
    # one-element explodes keep filters on the line from moving back before the deal, and
    # have each stamp rendered once, not again wherever it is used
    ev = (table(spark, d, "events").select("event_id", "ts", "user_id", "value")
          .repartition(spark.sparkContext.defaultParallelism))
    e = F.col("event_id")
    whole = e % 7 == 2
    ev = ev.select("event_id", "user_id", "ts", once(
        add_seconds("ts", F.round(F.col("value") * 60, 6)).alias("off")).alias("_o"))
    ev = ev.select("event_id", "user_id", "ts", once(
        _ts_text("ts", whole).alias("onset"), _ts_text("_o.off", whole).alias("off"),
        F.when(e % 5 == 3, F.lit("\t")).when(e % 5 == 4, F.lit("  ")).otherwise(F.lit(" "))
        .alias("sep")).alias("_t"))
    sep = F.col("_t.sep")
    onset = F.when(e % 17 == 3, F.concat(F.date_format("ts", "yyyy"), F.lit("-96-"),
                                         F.substring("_t.onset", 9, 100))
                   ).otherwise(F.col("_t.onset"))
    on_s = (e * 256).cast("string")
    off_s = (e * 256 + F.col("user_id")).cast("string")
    line = (F.when(e % 10 == 0, F.concat(F.lit("# note "), e.cast("string")))
            .when(e % 10 == 5, F.lit(""))
            .otherwise(F.concat_ws("", F.concat(onset, sep), F.concat("_t.off", sep), on_s,
                                   F.when(e % 13 == 1, F.lit(None))
                                   .otherwise(F.concat(sep, off_s)))))
    path = F.concat(F.lit("/data/inv/pat_"), F.col("user_id").cast("string"),
                    F.lit("/seizure_list"))
    return ev.select(path.alias("path"), (e + 1).cast("int").alias("line_no"),
                     F.explode(F.array(line)).alias("line"))


def listing_pages(spark, d) -> DataFrame:
    """One fetched patient page per event: ``(page_id, patient_id, html)``.

    Its anchors are ``FR_<user>``, ``inv_30`` (a package, not a listing) and ``home``; its
    ``<pre>`` holds a comment and the event's annotation line; e%19=8 has no ``<pre>``.
    """
    lines = annotation_lines(spark, d)
    user = F.regexp_extract("path", r"pat_(\d+)", 1)
    pre = F.concat(F.lit("<pre class='list'># list of "), user, F.lit("\n"),
                   F.col("line"), F.lit("\n</pre>"))
    html = F.concat(F.lit('<html><body><a href="/home">home</a><a href="/p">inv_30</a>'
                          '<A HREF="/l"><b>FR_</b>'), user, F.lit("</A>"),
                    F.when((F.col("line_no") - 1) % 19 == 8, F.lit("")).otherwise(pre),
                    F.lit("</body></html>"))
    return lines.select((F.col("line_no") - 1).cast("bigint").alias("page_id"),
                        user.cast("int").alias("patient_id"), html.alias("html"))


# Electrode names used to label stand-in channels (a mix of iEEG, surface and
# heart channels; FP1 stays iEEG in an inv dataset because names match whole).
STANDIN_ELECTRODES = ("GA1", "GA2", "ECG", "FP", "FP1", "T", "HR3", "EKG", "EMG", "TLA4",
                      "PO", "C")


# --- vectors ---------------------------------------------------------------------------------
#
# embeddings play the chunk payload; label plays the patient.

def vectors(spark, d) -> DataFrame:
    return table(spark, d, "embeddings").select(
        "vec_id", F.col("label").alias("patient_id"), F.col("embedding").alias("data"))


def faulty_vectors(spark, d, with_nan: bool = True) -> DataFrame:
    """vec_id%50=7 constant 0.25; with_nan: vec_id%61=3 a NaN at index 5,
    vec_id%67=4 +inf at index 9."""
    v = vectors(spark, d)
    k = F.col("vec_id")
    const = F.transform("data", lambda x: F.lit(0.25).cast("float"))
    data = F.when(k % 50 == 7, const)
    if with_nan:
        nan = F.transform("data", lambda x, i: F.when(i == 5, F.lit(float("nan")).cast("float"))
                          .otherwise(x))
        inf = F.transform("data", lambda x, i: F.when(i == 9, F.lit(float("inf")).cast("float"))
                          .otherwise(x))
        data = data.when(k % 61 == 3, nan).when(k % 67 == 4, inf)
    return v.withColumn("data", data.otherwise(F.col("data")))


def payloads(spark, d) -> DataFrame:
    """Payloads of varying size: whole document texts; source plays the patient."""
    return table(spark, d, "documents").select(F.col("source").alias("patient"),
                                               F.col("text").alias("data"))
