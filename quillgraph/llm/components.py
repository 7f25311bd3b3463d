"""Connected components of a table of links, by alternating large and small stars.

The edges stay distributed; each round is two grouped minima and two joins, and is written to the shared folder. The
minima are written before they are joined, so that both sides of a join are plain exchanges and Spark may split a hub
that many links share.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import cut


def components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """node, root for every node of a link: root is the smallest node reachable.

    links: two columns of longs without nulls, in any direction, repeated or not; loops are ignored. No links: no rows.
    """
    a, b = F.least(u, v), F.greatest(u, v)
    edges = cut(links.select(b.alias("u"), a.alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = cut(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = cut(large.groupBy("u").agg(F.min("v").alias("m")))
        rest = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(rest.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def merged_labels(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spreads the least label over the links left[i]-right[j], in place, in whole arrays; returns which labels fell together.

    Labels name classes as far as they are known; the pairs returned (old, new), few even for dense links, join these classes.
    """
    old, new = [], []
    while True:
        apart = left[i] != right[j]
        if not apart.any():
            break
        i, j = i[apart], j[apart]
        low = np.minimum(left[i], right[j])
        for labels, at in ((left, i), (right, j)):
            least = labels.copy()
            np.minimum.at(least, at, low)
            changed = np.flatnonzero(least != labels)
            old.append(labels[changed])
            new.append(least[changed])
            labels[changed] = least[changed]
    if not old:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.unique(np.stack([np.concatenate(old), np.concatenate(new)], 1), axis=0)
    return pairs[:, 0], pairs[:, 1]
