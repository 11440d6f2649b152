"""Session helpers: the settings the library expects, and shared scratch paths."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every query in this package assumes. Timestamps are zone-less
# (TIMESTAMP_NTZ); UTC keeps any LTZ conversion a no-op.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str = "local[*]", shuffle_partitions: int = 8,
                app_name: str = "recspark", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster the submitter owns master, memory and checkpoint settings;
    this helper is for tests, benches and notebooks.
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_query_conf(spark: SparkSession) -> None:
    """Session settings the queries depend on for their results."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster owns this setting; only a local master without it gets a
    folder of its own, elsewhere a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = os.path.join(tempfile.gettempdir(), "recspark-checkpoints")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh directory below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/recspark-{name}-{uuid.uuid4().hex[:12]}"


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: the work before it is done
    once, and what follows survives the loss of executors."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Python tasks import it by name, wherever the session was started.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for folder, _, names in os.walk(here):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, os.path.dirname(here)))
    target = os.path.join(tempfile.mkdtemp(prefix="recspark-"), "recspark.zip")
    with open(target, "wb") as f:
        f.write(packed.getvalue())
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
