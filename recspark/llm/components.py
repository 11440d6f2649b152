"""Connected components of an edge table, by contraction on the cluster.

Each round every node takes the name of the smallest node of its closed
neighbourhood, in an order drawn anew per round by hashing, so that long chains
shrink by a constant factor as well. Edges between nodes of one name vanish.
Once at most ``FINISH`` edges are left (counted, whatever the input), one task
joins them with a union-find, which saves the long tail of small rounds. Nothing
is collected: names per round are kept as tables in the shared folder and
composed at the end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.llm.common import map_batches, stored

FINISH = 200_000


def _union(batches):
    """Arrow task over all of a bounded edge table: (node, name) of every end."""
    u, v = [], []
    for batch in batches:
        u.append(batch.column(0).to_numpy())
        v.append(batch.column(1).to_numpy())
    if not u:
        return
    u, v = np.concatenate(u), np.concatenate(v)
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b, name = at[:len(u)], at[len(u):], np.arange(len(nodes))
    while len(a):
        low = np.minimum(name[a], name[b])
        np.minimum.at(name, name[a], low)
        np.minimum.at(name, name[b], low)
        while (name[name] != name).any():
            name = name[name]
        differ = name[a] != name[b]
        a, b = a[differ], b[differ]
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[name])],
                                     names=["node", "name"])


def connected_components(spark: SparkSession, edges: DataFrame,
                         finish: int = FINISH) -> DataFrame:
    """(node, root) for every end of ``edges`` (u, v: bigint). Loops and repeated
    edges are harmless; no edges give no rows."""
    live = stored(spark, edges.where("u <> v").select(
        F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    renames = []
    while (left := live.count()) > finish:
        order = F.xxhash64(F.col("v"), F.lit(len(renames)))
        ends = live.unionByName(live.select(F.col("v").alias("u"), F.col("u").alias("v")))
        own = F.struct(F.xxhash64(F.col("u"), F.lit(len(renames))).alias("h"),
                       F.col("u").alias("n"))
        name = stored(spark, ends.groupBy("u")
                      .agg(F.min(F.struct(order.alias("h"), F.col("v").alias("n"))).alias("m"))
                      .select(F.col("u").alias("node"), F.least("m", own)["n"].alias("name")),
                      "names")
        renames.append(name)
        u = name.select(F.col("node").alias("u"), F.col("name").alias("a"))
        v = name.select(F.col("node").alias("v"), F.col("name").alias("b"))
        live = stored(spark, live.join(u, "u").join(v, "v").where("a <> b")
                      .select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
                      .distinct(), "edges")
    if left:
        renames.append(stored(spark, map_batches(live.coalesce(1), _union,
                                                 "node bigint, name bigint"), "names"))
    if not renames:
        return spark.createDataFrame([], "node bigint, root bigint")
    roots = renames[0].withColumnRenamed("name", "root")
    for name in renames[1:]:
        later = name.select(F.col("node").alias("root"), F.col("name").alias("next"))
        roots = roots.join(later, "root", "left").select(
            "node", F.coalesce("next", "root").alias("root"))
    return roots
