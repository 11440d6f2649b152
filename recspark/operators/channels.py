"""Channel <-> electrode pairing and channel typing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.functions.electrodes import electrode_type


def electrode_positions(recordings: DataFrame, names_col: str = "electrodes",
                        keys=("recording_id",)) -> DataFrame:
    """``(keys..., channel_idx, electrode)``: channel j is the j-th name."""
    return (recordings.select(*keys, F.posexplode(names_col).alias("channel_idx", "electrode"))
            .withColumn("channel_idx", F.col("channel_idx").cast("int")))


def attach_electrodes(channels: DataFrame, recordings: DataFrame, dataset_col: str = "dataset_name",
                      names_col: str = "electrodes", keys=("recording_id",)) -> DataFrame:
    """Give every channel row its electrode name and type (J6 + H2).

    A channel beyond the end of its recording's name list gets a NULL name and
    ``missing_name = true``; the signal job treats such recordings as bad.
    """
    pos = electrode_positions(recordings.select(*keys, names_col), names_col, keys)
    ds = recordings.select(*keys, dataset_col)
    out = channels.join(pos, [*keys, "channel_idx"], "left").join(ds, list(keys), "left")
    return (out.withColumn("data_type", electrode_type("electrode", dataset_col))
            .withColumn("missing_name", F.col("electrode").isNull()))
