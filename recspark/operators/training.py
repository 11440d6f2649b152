"""Filtered, batched training sets.

The reference paged with LIMIT/OFFSET and no ORDER BY, so its pages were not
deterministic (D16). Here rows are numbered in key order and a page is the
integer part of ``position / batch_size``: reading page ``k`` is a filter on
``batch_id = k`` over a stored table, never an OFFSET scan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.operators.ordering import segmented_scan

DEFAULT_KEY = ("recording_id", "chunk_idx", "channel_idx")


def select_chunks(chunks: DataFrame, patient_id=None, states: Sequence[int] | None = (0, 2),
                  data_types: Sequence[int] | None = None) -> DataFrame:
    """Patient equality and state/type membership; None means no filter.

    On the partitioned store these become PartitionFilters, so files of other
    patients, states and types are never opened.
    """
    out = chunks
    if patient_id is not None:
        out = out.where(F.col("patient_id") == F.lit(patient_id))
    if states is not None:
        out = out.where(F.col("seizure_state").isin(list(states)))
    if data_types is not None:
        out = out.where(F.col("data_type").isin(list(data_types)))
    return out


def training_set(chunks: DataFrame, patient_id=None, states: Sequence[int] | None = (0, 2),
                 data_types: Sequence[int] | None = None, batch_size: int = 1000,
                 key: Sequence[str] = DEFAULT_KEY,
                 payload: Sequence[str] = ("data", "seizure_state", "data_type"),
                 transform: Callable[[DataFrame], DataFrame] | None = None,
                 n_buckets: int | None = None) -> DataFrame:
    """M1 / M3: ``batch_id, pos_in_batch, key..., payload...`` in key order.

    ``patient_id=None`` gives the all-patient set (M3). ``transform`` is the
    user hook (U1), a ``DataFrame -> DataFrame`` function applied last.
    """
    rows = select_chunks(chunks, patient_id, states, data_types)
    rows = rows.select(*key, *[c for c in payload if c not in key])
    numbered = segmented_scan(rows, (), key, position="_pos", n_buckets=n_buckets)
    out = numbered.select(
        (F.col("_pos") / F.lit(batch_size)).cast("bigint").alias("batch_id"),
        (F.col("_pos") % F.lit(batch_size)).cast("int").alias("pos_in_batch"),
        *key, *[c for c in payload if c not in key])
    return out.transform(transform) if transform is not None else out


def shuffle_batches(batches: DataFrame, seed: int = 0) -> DataFrame:
    """M2: permute whole pages; rows of one page stay together and in order.

    ``epoch_pos`` is the 0-based place of the page in the epoch: the rank of the
    MD5 of seed and batch id, so an epoch with the same seed sees the same order
    and a new seed gives a new one. Each page has one row with ``pos_in_batch``
    0, so the pages are listed by a filter; reading an epoch is a scan in
    ``epoch_pos, pos_in_batch`` order.
    """
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col("batch_id")).cast("binary"))
    pages = batches.where(F.col("pos_in_batch") == 0).select(
        "batch_id", F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint").alias("_hash"))
    ranked = segmented_scan(pages, (), ("_hash", "batch_id"), position="epoch_pos")
    return batches.join(ranked.select("batch_id", "epoch_pos"), "batch_id")


def batch_count(n_rows: int, batch_size: int) -> int:
    """Number of pages, ``ceil(n / batch_size)``."""
    return -(-n_rows // batch_size)
