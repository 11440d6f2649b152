"""Counts and summaries over the chunk store.

All of these are one declarative plan each: partial (map-side) aggregation,
one shuffle on the grouping key, small results. Where the reference issued
one query per patient (N+1), this issues one query in total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _count(count_col: str | None):
    return F.sum(count_col) if count_col else F.count(F.lit(1))


def chunk_counts(chunks: DataFrame, by=("patient_id", "data_type", "seizure_state"),
                 count_col: str | None = None, out: str = "n_chunks") -> DataFrame:
    """Chunks per key (A2, A6, A7). ``count_col`` sums pre-aggregated counts."""
    return chunks.groupBy(*by).agg(_count(count_col).cast("bigint").alias(out))


def chunk_summary(chunks: DataFrame, patients: DataFrame, datasets: DataFrame,
                  count_col: str | None = None) -> DataFrame:
    """Per dataset, patient, type and state: chunk count.

    Patients without chunks keep one row with NULL type/state and count 0.
    """
    agg = chunk_counts(chunks, count_col=count_col)
    pats = patients.join(datasets, "dataset_id", "left")
    return (pats.join(agg, "patient_id", "left")
            .select("dataset_id", F.col("name").alias("dataset_name"), "patient_id",
                    "data_type", "seizure_state",
                    F.coalesce("n_chunks", F.lit(0)).cast("bigint").alias("n_chunks")))


def chunk_summary_rollup(chunks: DataFrame, patients: DataFrame,
                         count_col: str | None = None) -> DataFrame:
    """Subtotals per dataset and patient and the grand total (A3).

    ``grouping_level`` tells a subtotal's NULL from a NULL key.
    """
    per_patient = chunk_counts(chunks, count_col=count_col)
    rows = per_patient.join(patients, "patient_id")
    return (rows.rollup("dataset_id", "patient_id", "data_type", "seizure_state")
            .agg(F.grouping_id().cast("int").alias("grouping_level"),
                 F.sum("n_chunks").cast("bigint").alias("n_chunks")))


def patients_per_dataset(patients: DataFrame, datasets: DataFrame) -> DataFrame:
    """Patients per dataset plus a true total row (A4, J1; fixes D15)."""
    rows = datasets.join(patients, "dataset_id", "left")
    return (rows.rollup(F.struct("dataset_id", "name").alias("_d"))
            .agg(F.grouping_id().cast("int").alias("is_total"),
                 F.countDistinct("patient_id").cast("bigint").alias("n_patients"))
            .select(F.col("_d.dataset_id").alias("dataset_id"),
                    F.col("_d.name").alias("dataset_name"), "is_total", "n_patients"))


def class_ratio(chunks: DataFrame, by: str = "seizure_state",
                count_col: str | None = None) -> DataFrame:
    """Share of each class in all chunks.

    The window runs over the tiny aggregate (one row per class), not over chunks.
    """
    agg = chunk_counts(chunks, by=(by,), count_col=count_col)
    total = F.sum("n_chunks").over(Window.partitionBy())
    return agg.withColumn("ratio", F.round(F.col("n_chunks") / total, 9))


def top_patients(chunks: DataFrame, n: int = 10, count_col: str | None = None) -> DataFrame:
    """The ``n`` patients with the most chunks, ties by id.

    Plans as a partial aggregate plus TakeOrderedAndProject: no global sort.
    """
    agg = chunk_counts(chunks, by=("patient_id",), count_col=count_col)
    return agg.orderBy(F.desc("n_chunks"), F.asc("patient_id")).limit(n)


def annotations_per_patient(patients: DataFrame, annotations: DataFrame) -> DataFrame:
    """Interval count per patient, zero for none."""
    agg = annotations.groupBy("patient_id").agg(F.count("onset").alias("n_annotations"))
    return (patients.select("patient_id").join(agg, "patient_id", "left")
            .select("patient_id",
                    F.coalesce("n_annotations", F.lit(0)).cast("bigint").alias("n_annotations")))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``count(*)`` of each named table as one frame (A5)."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))
               .select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def patients_with_chunks(patients: DataFrame, chunks: DataFrame) -> DataFrame:
    """Patients that own at least one chunk (J4, A15): a semi-join, no DISTINCT pass."""
    return patients.select("patient_id").join(
        chunks.select("patient_id"), "patient_id", "left_semi")


def not_reviewed(patients: DataFrame, reviewed_ids: DataFrame) -> DataFrame:
    """Patients whose id is not on a reviewed list.

    NOT EXISTS semantics: a NULL on the list (a name without digits) removes
    nobody, where SQL ``NOT IN`` would remove everybody.
    """
    ids = reviewed_ids.select(F.col("patient_id")).where(F.col("patient_id").isNotNull())
    return patients.join(ids, "patient_id", "left_anti")


def filtered_count(chunks: DataFrame, patient_id=None, states=(0, 2), data_types=None,
                   by=("patient_id",)) -> DataFrame:
    """Training-set length (A1, M4) per key after the P1-P3 filters."""
    from recspark.operators.training import select_chunks
    return chunk_counts(select_chunks(chunks, patient_id, states, data_types), by=by)
