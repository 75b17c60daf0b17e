"""Connected components of a link table, on Spark alone."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from estrato.session import materialise


def components(links: DataFrame, label: str) -> DataFrame:
    """(node, component) for every node of a link, ``component`` the smallest node
    of those it is connected to. ``links`` has two long columns ``a`` and ``b``.

    Alternating large-star and small-star steps (Kiveris et al., "Connected
    components in MapReduce and beyond"): minima are combined before they are
    shuffled, and a node with many links meets its minimum in a plain join, whose
    large partitions Spark splits. The links never outgrow their first number;
    each round is a written table, so a lost executor costs one round at most.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links = materialise(links, f"{label}-links")
    seen = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                links.select(F.col("v"), F.col("v")).distinct())
        seen = state
        both = links.union(links.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = materialise(small.union(low.select("u", "m")).distinct(), f"{label}-links")


class Forest:
    """Components of links among n numbered nodes of one task; keeps one label a node."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while len(a):
            x, y = label[a], label[b]
            differ = x != y
            if not differ.any():
                return
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:  # every label to its root
                up = label[label]
                if np.array_equal(up, label):
                    break
                label[:] = up
