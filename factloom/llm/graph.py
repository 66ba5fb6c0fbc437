"""Connected components: within one block in numpy, over a whole table by alternating star contractions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest node of each node's component, for nodes 0..n-1 and links i-j."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        while not np.array_equal(up := root[root], root):
            root = up
        if np.array_equal(before, root):
            return root
    return root


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (src, dst: long); component is the smallest node that can be reached.

    Each round hangs every node's larger neighbours, then its smaller ones, under its smallest neighbour, until nothing
    changes.  A round shuffles the edges; minima are combined before the shuffle.  A node with very many edges is one key of a
    round's joins, whose partition adaptive execution splits once it is large.  Only two numbers a round come to the driver.
    Null ends and loops are ignored; repeats do not count; an empty table gives no row.
    """
    plain = edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
    now = checkpointed(plain.where("src is not null and dst is not null and u <> v").distinct())
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u").alias("a"), F.col("m").alias("b")), F.struct(F.col("v").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = checkpointed(small.select(F.col("e.a").alias("u"), F.col("e.b").alias("v")).where("u <> v").distinct())
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
    stars = now.groupBy("u").agg(F.min("v").alias("v"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
