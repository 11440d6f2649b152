"""Exact dedup as a stateful stream (DataFrame and SQL functions only).

Texts are equal when identical after every run of ASCII white space became one
blank. ``add_load`` takes rows in:

1. *Content.* The load's rows (digest, identifier, place, normalised text) are written
   once. ``place`` is the content locator: the number of the file in the
   store and of the row in it, as one long integer; ``fetch`` reads content by it.
2. *State.* A structured stream over the narrow columns keeps, per SHA-256 digest, the
   smallest identifier, the first place and the number of copies. It is disk-backed
   (RocksDB) with checkpoints in the shared folder, has no watermark and so never expires.
3. *Check.* A digest that comes again is a hit. In the same micro-batch the whole bytes of
   its rows, and of the content at the place that the state holds where that is of an earlier
   load, are fetched and compared. Only texts of hits move (Spark's runtime Bloom
   filter, of bounded size, drops the others in the scan), and copies are folded in each
   task after that. A digest that stands for different bytes is a clash, split by its text.

A micro-batch publishes the keys it changed and the clashes it found as one idempotent
epoch. It takes a whole load unless ``files_per_batch`` limits it (then each one looks
through the load for its hits); very large inputs are added in several loads.

Defined results: a null text counts as empty; the empty text is a text like
any other. Null identifiers are larger than all others, so a group's
``keep_id`` is null only when all its identifiers are. Rows that repeat
identifier and text are copies of each other: ``group_size`` counts them, they
share the flags in ``duplicate_groups``, and ``drop_duplicates`` keeps one. An
empty table gives an empty result. Other columns never matter, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from recspark.llm.common import WHITE_SPACE, column, free_name, narrow, stored
from recspark.session import scratch_path

_STORE = "spark.sql.streaming.stateStore."
STATE_STORE = {
    _STORE + "providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    _STORE + "rocksdb.boundedMemoryUsage": "true",
    _STORE + "rocksdb.allowFAllocate": "false",  # no reserved space per state partition
}
# Spark's own filter on the scan of a semi-join: at most 8 MB, whatever the input
_FILTER = "spark.sql.optimizer.runtime.bloomFilter."
HIT_FILTER = {
    _FILTER + "enabled": "true",
    _FILTER + "applicationSideScanSizeThreshold": "1b",
    _FILTER + "creationSideThreshold": "1t",
    _FILTER + "numBits": str(1 << 26),
    _FILTER + "expectedNumItems": "4000000",
}
_ROW_BITS = 33  # of a place, as monotonically_increasing_id numbers rows


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, " ")


def sha256_digest(norm: Column) -> Column:
    return F.sha2(norm, 256)


def fold(entries: DataFrame) -> DataFrame:
    """State per digest: the smallest id, the first place of its content, and copies."""
    return entries.groupBy("digest").agg(F.min("id").alias("id"), F.min("place").alias("place"),
                                         F.count(F.lit(1)).alias("copies"))


def read_content(spark: SparkSession, store: str, id_type: str) -> DataFrame:
    """(digest, id, place, norm) of every row of every load."""
    return (spark.read.schema(f"digest string, id {id_type}, place bigint, norm string")
            .option("recursiveFileLookup", "true").parquet(f"{store}/content"))


def fetch(content: DataFrame, places: DataFrame) -> DataFrame:
    """The content rows at the locators in ``places`` (column ``place``)."""
    return content.join(places.select("place"), "place", "left_semi").select(*content.columns)


def _new_clashes(load: DataFrame, before: DataFrame | None, hits: DataFrame,
                 first_place: int) -> DataFrame:
    """Digests of ``hits`` whose rows in ``load``, and first content in ``before``, differ."""
    rows = load.join(hits, "digest", "left_semi").select("digest", "norm")
    if before is not None:
        old = fetch(before, hits.where(F.col("place") < first_place))
        rows = rows.unionByName(old.select("digest", "norm"))
    # one row per distinct text: its bytes are the key, copies fold in each task
    texts = rows.groupBy("norm").agg(F.min("digest").alias("digest"))
    return texts.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")


def add_load(spark: SparkSession, rows: DataFrame, store: str, digest=sha256_digest,
             files_per_batch: int | None = None) -> None:
    """Take the rows of (id, text) into ``store``: content, state, index and clashes.

    The state and the offsets are in ``store/checkpoint``: another load is compared with all
    before it. An epoch is overwritten when it is repeated after a failure.
    """
    id_type = rows.schema["id"].dataType.simpleString()
    try:
        last = read_content(spark, store, id_type).agg(F.max("place")).first()[0]
    except AnalysisException:  # a new store
        last = None
    first_file = 0 if last is None else (last >> _ROW_BITS) + 1
    first_place, path = first_file << _ROW_BITS, f"{store}/content/load={first_file}"
    norm = normalised(F.col("text"))
    (rows.select(digest(norm).alias("digest"), "id",
                 (F.monotonically_increasing_id() + first_place).alias("place"),
                 norm.alias("norm")).write.mode("overwrite")
     .option("compression", "zstd").parquet(path))

    def publish(changed: DataFrame, epoch: int) -> None:
        session = changed.sparkSession
        changed.write.mode("overwrite").parquet(f"{store}/index/epoch={epoch}")
        hits = (session.read.schema(changed.schema).parquet(f"{store}/index/epoch={epoch}")
                .where("copies > 1").select("digest", "place"))
        content = read_content(session, store, id_type)
        before = content.where(F.col("place") < first_place) if first_file else None
        load = session.read.schema(content.schema).parquet(path)
        before_conf = {k: session.conf.get(k, None) for k in HIT_FILTER}
        for k, v in HIT_FILTER.items():
            session.conf.set(k, v)
        try:
            (_new_clashes(load, before, hits, first_place)
             .write.mode("overwrite").parquet(f"{store}/clashes/epoch={epoch}"))
        finally:
            for k, v in before_conf.items():
                session.conf.unset(k) if v is None else session.conf.set(k, v)

    source = spark.readStream.schema(f"digest string, id {id_type}, place bigint")
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    entries = source.parquet(f"{store}/content/*")
    kept_conf = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        query = (fold(entries).writeStream.outputMode("update")
                 .option("checkpointLocation", f"{store}/checkpoint")
                 .foreachBatch(publish).trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        for k, v in kept_conf.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def read_index(spark: SparkSession, store: str, id_type: str) -> DataFrame:
    """The state as last published. Identifiers and places only get smaller and counts
    only grow, so the extremes over the epochs are the newest values."""
    schema = f"digest string, id {id_type}, place bigint, copies bigint"
    return (spark.read.schema(schema).option("recursiveFileLookup", "true")
            .parquet(f"{store}/index").groupBy("digest")
            .agg(F.min("id").alias("id"), F.min("place").alias("place"),
                 F.max("copies").alias("copies")))


def read_clashes(spark: SparkSession, store: str) -> DataFrame:
    """Digests that stand for more than one text."""
    return (spark.read.schema("digest string").option("recursiveFileLookup", "true")
            .parquet(f"{store}/clashes").distinct())


def _groups(spark: SparkSession, rows: DataFrame, digest,
            files_per_batch: int | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Content, the index (one row per digest: id, place, copies) and the clashes."""
    store = scratch_path(spark, "dedup-store")
    add_load(spark, rows, store, digest, files_per_batch)
    id_type = rows.schema["id"].dataType.simpleString()
    index = stored(spark, read_index(spark, store, id_type), "dedup-state")
    return read_content(spark, store, id_type), index, read_clashes(spark, store)


def duplicate_groups(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
                     text_col: str = "text", digest=sha256_digest,
                     files_per_batch: int | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, digest, locator
    (a place where the content lies)."""
    rows = narrow(docs, id=id_col, text=text_col)
    content, index, clashes = _groups(spark, rows, digest, files_per_batch)
    entries = content.select("digest", "id")
    flat = index.select("digest", F.col("id").alias("keep_id"),
                        F.col("copies").alias("group_size"), F.col("place").alias("locator"))
    if clashes.isEmpty():
        out = entries.join(flat, "digest")
    else:
        plain = entries.join(clashes, "digest", "left_anti").join(flat, "digest")
        split = content.join(clashes, "digest", "left_semi")
        per_text = split.groupBy("digest", "norm").agg(
            F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"),
            F.min("place").alias("locator"))
        out = plain.unionByName(split.drop("place").join(per_text, ["digest", "norm"])
                                .drop("norm"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size",
                      F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      "digest", "locator")


def drop_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text", digest=sha256_digest,
                    files_per_batch: int | None = None) -> DataFrame:
    """The documents with one row per text, all their columns unchanged.

    Kept rows are found by (digest, identifier); a text whose digest clashes is
    keyed by its bytes as well.
    """
    rows = narrow(docs, id=id_col, text=text_col)
    content, index, clashes = _groups(spark, rows, digest, files_per_batch)
    ident = F.coalesce(F.col("id").cast("string"), F.lit("null"))
    key = free_name(docs.columns, "dedup_key")

    def keyed(digest_col: Column, id_as_text: Column, *more: Column) -> Column:
        return F.concat_ws(":", digest_col, id_as_text, *more)

    kept = index.select(keyed(F.col("digest"), F.coalesce(F.col("id").cast("string"),
                                                          F.lit("null"))).alias(key))
    norm = normalised(column(text_col))
    own_id = F.coalesce(column(id_col).cast("string"), F.lit("null"))
    if clashes.isEmpty():
        tagged = docs.withColumn(key, keyed(digest(norm), own_id))
    else:
        split = content.join(clashes, "digest", "left_semi")
        whole = split.groupBy("digest", "norm").agg(F.min("id").alias("id"))
        kept = (index.join(clashes, "digest", "left_anti")
                .select(keyed(F.col("digest"), F.coalesce(F.col("id").cast("string"),
                                                          F.lit("null"))).alias(key))
                .unionByName(whole.select(keyed(F.col("digest"), ident, F.col("norm"))
                                          .alias(key))))
        dig, hit = free_name(docs.columns, "dedup_digest"), free_name(docs.columns, "dedup_hit")
        marks = clashes.select(F.col("digest").alias(dig), F.lit(True).alias(hit))
        tagged = (docs.withColumn(dig, digest(norm)).join(marks, dig, "left")
                  .withColumn(key, F.when(F.col(hit), keyed(F.col(dig), own_id, norm))
                              .otherwise(keyed(F.col(dig), own_id)))
                  .select(*[column(c) for c in docs.columns], key))
    return (tagged.join(kept, key, "left_semi").dropDuplicates([key])
            .select(*[column(c) for c in docs.columns]))
