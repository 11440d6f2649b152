"""Merkle manifest of a dataset: a digest tree per source and one over the sources.

Method: slot pivot. Rows of a group (a source) are numbered by id. Conditional
aggregates spread the children of a parent over ``FANOUT`` columns, one per
slot; concatenating the columns and hashing them gives the parent, omitting the
own slot's column gives a child's siblings. The roots of the groups, ordered by
group, are pivoted in the same way. Then the tables are walked downwards: a
child's path is its siblings in front of its parent's path, so each level is one
equi-join of parents, and the rows themselves come out of the lowest pivot without
a join.

Every level is a table in the shared folder (``Manifest.levels``), a
``FANOUT``-th of the one below. Numbers come from a range partitioning of
(group, id) with counts per partition, so a group that holds a third of all rows is
numbered, pivoted and walked by as many tasks as its rows need. The driver sees
one number per level.

A digest is the lower-case hex SHA-256 of its parts' concatenation. A leaf digests
its columns, each ``-`` if null, else UTF-8 byte count, ``:``, value. A lone node
of a group is its root, not hashed again.

Defined results: null sources are a group of their own, before all others; null ids come
first, rows of one id are ordered by leaf, and rows equal in both are
interchangeable, one leaf each; an empty table has no levels, no proofs and no root.
Columns other than the named ones are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recspark.llm.common import column, stored

FANOUT = 16
ROWS_PER_TASK = 500_000
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_PATH = "array<struct<left: string, right: string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """One column of a leaf: ``-`` if null, else byte count, ``:``, value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    return digest(*[field(v) for v in values])


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(path, leaf, lambda node, x: digest(x["left"], node, x["right"]))


def path_text(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), "")


@dataclass
class Manifest:
    """``levels[k]`` has a row per parent of nodes of height k: grp, place, n (nodes of the
    group at height k), c0.. (structs of the children; ``node`` is a child's digest) and
    node. ``groups``: grp, node, height. ``above``: the same tables over the groups."""

    levels: list[DataFrame]
    groups: DataFrame
    above: Manifest | None = None


def positions(spark: SparkSession, rows: DataFrame, order: Sequence[str],
              rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Add ``place`` (from 0) of each row in its ``grp`` by ``order``, and ``n``, the rows of
    the group. ``rows`` is read three times, so it should be a stored table."""
    tasks = max(spark.sparkContext.defaultParallelism, -(-rows.count() // rows_per_task))
    # the last key spreads rows that are equal in all others
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    order = [*order, "tie"]
    cut = stored(spark, rows.repartitionByRange(tasks, "grp", *order)
                 .withColumn("part", F.spark_partition_id()), "ranges")
    # a row per group and range: at most groups + ranges rows
    sizes = cut.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("size"))
    group = Window.partitionBy("grp")
    before = F.sum("size").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("grp", "part", F.coalesce(before, F.lit(0)).alias("before"),
                         F.sum("size").over(group).alias("n"))
    inside = F.row_number().over(Window.partitionBy("grp", "part").orderBy(*order))
    return (cut.withColumn("inside", inside).join(sizes, ["grp", "part"])
            .withColumn("place", F.col("before") + F.col("inside") - 1)
            .drop("tie", "part", "inside", "before"))


def _pivot(nodes: DataFrame, fanout: int) -> DataFrame:
    """Parents of (grp, place, n, item); item is a struct with a field ``node``."""
    slots = [F.expr(f"max(CASE WHEN place % {fanout} = {i} THEN item END) AS c{i}")
             for i in range(fanout)]
    joined = ", ".join(f"c{i}.node" for i in range(fanout))
    return (nodes.groupBy("grp", "n", F.expr(f"place div {fanout}").alias("up")).agg(*slots)
            .selectExpr("grp", "up AS place", "n", *[f"c{i}" for i in range(fanout)],
                        f"CASE WHEN n = 1 THEN c0.node ELSE sha2(concat_ws('', {joined}), 256) "
                        "END AS node"))


def _tree(spark: SparkSession, nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """Level tables of all groups, and (grp, node, height) of their roots."""
    levels = [stored(spark, _pivot(nodes, fanout), "level")]
    roots = levels[0].where(f"n <= {fanout}").select(
        "grp", "node", F.when(F.col("n") == 1, 0).otherwise(1).alias("height"))
    # one number per level says whether any group goes on
    while (levels[-1].agg(F.max("n")).first()[0] or 0) > fanout:
        below = levels[-1].where(f"n > {fanout}")
        nodes = below.select("grp", "place", F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"),
                             F.struct("node").alias("item"))
        levels.append(stored(spark, _pivot(nodes, fanout), "level"))
        roots = roots.unionByName(levels[-1].where(f"n <= {fanout}").select(
            "grp", "node", F.lit(len(levels)).alias("height")))
    return levels, roots


def _children(level: DataFrame, fanout: int) -> DataFrame:
    """(grp, place, item, root columns, path) of the children of walked parents."""
    def text(slots):
        return "concat_ws(" + ", ".join(["''", *[f"c{i}.node" for i in slots]]) + ")"

    each = ", ".join(f"struct(c{i} AS item, array(struct({text(range(i))} AS left, "
                     f"{text(range(i + 1, fanout))} AS right)) AS own)" for i in range(fanout))
    return (level.selectExpr("grp", "place", "n", "subroot", "root", "path",
                             f"posexplode(array({each})) AS (slot, x)")
            .where("x.item IS NOT NULL")
            .selectExpr("grp", f"place * {fanout} + slot AS place", "x.item AS item", "subroot",
                        "root", "CASE WHEN n = 1 THEN path ELSE concat(x.own, path) END AS path"))


def _walk(levels: list[DataFrame], roots: DataFrame, fanout: int) -> DataFrame:
    """Lowest children with their paths; ``roots``: grp, height, subroot, root, path."""
    rows = None
    for k in range(len(levels), 0, -1):
        # a group starts at the height of its root; a lone leaf is a level of its own
        known = roots.where((F.greatest("height", F.lit(1))) == k).select(
            "grp", F.lit(0).cast("bigint").alias("place"), "subroot", "root", "path")
        if rows is not None:
            known = known.unionByName(rows.select(*known.columns))
        rows = _children(levels[k - 1].join(known, ["grp", "place"]), fanout)
    return rows


def build(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
          group_col: str = "source", columns: Sequence[str] = LEAF_COLUMNS,
          fanout: int = FANOUT, carry: dict[str, Column] | None = None,
          rows_per_task: int = ROWS_PER_TASK) -> Manifest:
    """The trees of a table. ``carry`` adds columns of a row to its leaf's item."""
    carry = carry or {}
    source = column(group_col).cast("string")
    leaves = stored(spark, docs.select(
        # '' for null sorts before every other source, bytewise
        F.coalesce(F.concat(F.lit("+"), source), F.lit("")).alias("grp"),
        column(id_col).alias("id"), leaf_digest([column(c) for c in columns]).alias("node"),
        *[c.alias(f"_{name}") for name, c in carry.items()]), "leaves")
    placed = positions(spark, leaves, ["id", "node"], rows_per_task)
    item = F.struct("node", "id", *[F.col(f"_{name}").alias(name) for name in carry])
    levels, roots = _tree(spark, placed.select("grp", "place", "n", item.alias("item")), fanout)
    groups = stored(spark, roots, "groups")
    top = positions(spark, groups.select(F.lit("").alias("grp"), F.col("grp").alias("id"), "node"),
                    ["id"], rows_per_task)
    top_levels, top_roots = _tree(spark, top.select(
        "grp", "place", "n", F.struct("node", "id").alias("item")), fanout)
    return Manifest(levels, groups, Manifest(top_levels, top_roots))


def root(manifest: Manifest) -> str | None:
    """The digest of the whole dataset; None for an empty table."""
    row = manifest.above.groups.first()
    return row["node"] if row else None


def proofs(manifest: Manifest, fanout: int = FANOUT) -> DataFrame:
    """One row per leaf: id, leaf, subroot, root, path (array of left and right siblings,
    from the leaf to the root) and the carried columns."""
    above = manifest.above
    start = above.groups.select("grp", "height", F.col("node").alias("subroot"),
                                F.col("node").alias("root"),
                                F.array().cast(_PATH).alias("path"))
    tops = _walk(above.levels, start, fanout).select(
        F.col("item.id").alias("grp"), "root", "path")
    roots = manifest.groups.withColumnRenamed("node", "subroot").join(tops, "grp")
    rows = _walk(manifest.levels, roots, fanout)
    carried = [f"item.`{f.name}`" for f in rows.schema["item"].dataType.fields[2:]]
    return rows.select("item.id", F.col("item.node").alias("leaf"), "subroot", "root", "path",
                       *carried)


def nodes(manifest: Manifest) -> DataFrame:
    """The manifest to publish: (source, height, place, node) of every inner node."""
    out = None
    for height, level in enumerate(manifest.levels, 1):
        part = level.where("n > 1").select(
            F.when(F.col("grp") != "", F.substring("grp", 2, 1 << 30)).alias("source"),
            F.lit(height).alias("height"), "place", "node")
        out = part if out is None else out.unionByName(part)
    return out
