"""Connected components of links too many for one machine."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.sinks.files import stored, stored_counted


def spanning_links(left: np.ndarray, right: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """At most one link for each of ``nodes`` that joins what the given links join."""
    if len(left) == 0:
        return left, right
    label = np.arange(nodes)
    while True:
        least = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, left, least)
        np.minimum.at(label, right, least)
        label = label[label]
        if np.array_equal(before, label):
            break
    linked = np.flatnonzero(label != np.arange(nodes))
    return linked, label[linked]


def spanning_forest(left: np.ndarray, right: np.ndarray, cost: np.ndarray, nodes: int) -> np.ndarray:
    """Which of the given links join what all of them join, at the least cost: fewer than ``nodes``, none superfluous."""
    order, label, chosen = np.argsort(cost, kind="stable"), np.arange(nodes), [np.empty(0, dtype=np.int64)]
    for at in range(0, len(order), 4 * nodes):  # most of the costly links are joined by the cheap ones before
        links = order[at : at + 4 * nodes]
        while True:
            a, b = label[left[links]], label[right[links]]
            apart = a != b
            links, a, b = links[apart], a[apart], b[apart]
            if not len(links):
                break
            best, rank = np.full(nodes, len(links)), np.arange(len(links))
            np.minimum.at(best, a, rank)
            np.minimum.at(best, b, rank)
            taken = np.unique(best[best < len(links)])
            chosen.append(links[taken])
            linked, to = spanning_links(a[taken], b[taken], nodes)
            merged = np.arange(nodes)
            merged[linked] = to
            label = merged[label]
    return np.concatenate(chosen)


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for every long in columns ``a`` and ``b``.

    Contraction: every class takes the smallest class that it touches, pointers are doubled, and the
    links between classes that remain are kept once. Classes in touch at least merge in pairs, so
    the rounds grow with the logarithm of the longest chain. Each round is written, which cuts the
    lineage; joins are between written tables, so that a class with very many members can be split.
    Links from a node to itself make it a component; an empty table gives an empty table.
    """
    pairs = links.select("a", "b")
    both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    touching, left = stored_counted(both)
    nodes = stored(touching.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
    while left:
        least = stored(touching.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to")))
        jump = least.select(F.col("a").alias("to"), F.col("to").alias("then"))
        target = stored(least.join(jump, "to").select(F.col("a").alias("was"), F.col("then").alias("now")))
        nodes = stored(
            nodes.join(target, nodes["component"] == target["was"], "left").select(
                "node", F.coalesce("now", "component").alias("component")
            )
        )
        one = touching.join(target, touching["a"] == target["was"]).select(F.col("now").alias("a"), "b")
        two = one.join(target, one["b"] == target["was"]).select("a", F.col("now").alias("b"))
        touching, left = stored_counted(two.filter("a <> b").distinct())
    return nodes
