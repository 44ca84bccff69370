"""Connected components of a table of links, by alternating large and small stars.

Every round is joins and aggregations on node ids; no component, however large,
is gathered in one task. Before the first round each partition of links is
reduced to a spanning forest where it stands, which drops most links of dense
groups. Rounds end when the table no longer changes: all nodes then point to
the smallest node of their component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import common

ROUNDS = 60
#: Nodes that a partition's forest may hold before its links are handed on.
FOREST_NODES = 1 << 20


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for the nodes of the links."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while True:  # shorten paths
            shorter = new[new]
            if np.array_equal(shorter, new):
                break
            new = shorter
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new


def _forest(links: DataFrame) -> DataFrame:
    def run(batches):
        a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            a = np.concatenate([a, batch.column(0).to_numpy()])
            b = np.concatenate([b, batch.column(1).to_numpy()])
            a, b = roots(a, b)
            a, b = a[a != b], b[a != b]
            if len(a) > FOREST_NODES:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
                a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return links.mapInArrow(run, "a bigint, b bigint")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` all have b < a."""
    low = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(low, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (columns a, b, BIGINT) that is not its component's smallest."""
    now = common.kept(_forest(links.select("a", "b").where("a <> b")), "links")
    before = None
    for _ in range(ROUNDS):
        new = common.kept(_small_star(_large_star(now)), "links")
        state = new.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        common.drop_kept(now)
        now = new
        if state == before or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
    raise RuntimeError(f"components not found in {ROUNDS} rounds")
