"""Connected components of a link table by alternating large-star and small-star steps.

Each step keeps one row per link, so nothing is gathered per node: a node's smallest neighbour comes
from a pre-aggregated minimum, joined back (AQE splits the rows of a node with very many links). Before
a step each batch of links, as it lies, is replaced by the links of its nodes with their smallest node in
that batch, so that paths that lie in one batch cost no step.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import column, stage


def smallest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node that it is linked to) of the links a, b, but for the smallest ones themselves."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        now = root.copy()
        for end in (x, y):
            np.minimum.at(now, root[end], low)
        while (now[now] != now).any():
            now = now[now]
        if (now == root).all():
            break
        root = now
    linked = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[linked], nodes[root[linked]]


def _short(links: DataFrame) -> DataFrame:
    """The links of each batch by ``smallest``: the same components."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in smallest(column(x, "a").to_numpy(), column(x, "b").to_numpy())], ["a", "b"])

    return links.mapInArrow(run, "a long, b long")


def _star(links: DataFrame, large: bool) -> DataFrame:
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:  # only smaller neighbours
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    out = both.join(low, "u")
    if large:
        # Repeated links are left to the small star's.
        return out.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b")
    rows = out.select(F.explode(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("r"))
    return rows.select("r.a", "r.b").filter("a <> b").distinct()


def _open(links: DataFrame) -> int:
    """Nodes at which ``links`` (node, smaller node) are no stars yet: they have two smaller ones, or one and a larger one."""
    ends = links.select(F.col("a").alias("id"), F.col("b").alias("low"), F.lit(False).alias("root")).unionByName(links.select(F.col("b").alias("id"), F.lit(None).cast("long").alias("low"), F.lit(True).alias("root")))
    per = ends.groupBy("id").agg(F.min("low").alias("x"), F.max("low").alias("y"), F.max("root").alias("root"))
    return per.filter("x <> y or (x is not null and root)").count()


def components(links: DataFrame) -> DataFrame:
    """(id, root) of each id in ``links`` (a, b): the smallest id that it is linked to over any path.

    Links of a row with itself, repeated links and either direction are fine; links with a null are
    left out; no links give no rows. Every step is written to the shared checkpoint folder.
    """
    kinds = [F.col(c).cast("long").alias(c) for c in ("a", "b")]
    now = stage(_short(stage(links.select(*kinds).filter("a <> b"), "links")), "links")
    while _open(now):
        # Links are shortened as read back: in few tasks, not in each of the shuffle's.
        now = stage(_short(stage(_star(_star(now, True), False), "links")), "links")
    roots = now.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("root"))).distinct()
