"""Connected components by contraction and pointer jumping, in joins over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import Scratch, stored


def _roots(hooked: DataFrame, work: Scratch) -> DataFrame:
    """``hooked`` (node, label) with the last label that labels of labels lead to. Labels only
    ever fall, so the jumps end when their sum stays."""
    before = None
    while True:
        total = hooked.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if total is None or total == before:
            return hooked
        before = total
        via = hooked.select("node", F.col("label").alias("__via"))
        hooked = work(via.join(hooked.select(F.col("node").alias("__via"), "label"), "__via").select("node", "label"))


def _named(links: DataFrame, labels: DataFrame) -> DataFrame:
    """The links ``a``, ``b`` with ``la`` and ``lb``, the labels of their nodes (a node without
    one has itself), where these differ."""
    for end in ("a", "b"):
        names = labels.select(F.col("node").alias(end), F.col("label").alias(f"l{end}"))
        links = links.join(names, end, "left").withColumn(f"l{end}", F.coalesce(f"l{end}", end))
    return links.where("la <> lb")


def still_apart(links: DataFrame, labels: DataFrame) -> DataFrame:
    """The links ``a``, ``b`` between nodes of different labels."""
    return _named(links.select("a", "b"), labels).select("a", "b")


def contracted(links: DataFrame, labels: DataFrame) -> DataFrame:
    """The distinct links that are left when every node is called by its label."""
    return _named(links.select("a", "b"), labels).select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct()


def relabelled(labels: DataFrame, top: DataFrame) -> DataFrame:
    """``labels``, each replaced by the one that ``top`` (node, label) has for it, if any."""
    names = top.select(F.col("node").alias("label"), F.col("label").alias("__top"))
    return labels.join(names, "label", "left").select("node", F.coalesce("__top", "label").alias("label"))


def components(links: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, label) for every node of ``links`` (columns ``a`` and ``b``); nodes have one
    label exactly when links connect them, the smallest node of them.

    Each round a node hooks on to the smallest node next to it, and all that hang together
    become one node, called by the smallest. Only links between such nodes go on to the next
    round, each once, so a round has at most half the nodes of the one before, and most links
    are joined with labels once. Every step is written to the shared folder; both sides of each
    join come straight from there, so adaptive execution can split hot nodes. Only the labels
    are kept.
    """
    work = Scratch(links.sparkSession, purpose)
    links, rounds = work(links.select("a", "b")), []
    while not rounds or not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooked = both.groupBy("a").agg(F.min("b").alias("b"))
        rounds.append(_roots(work(hooked.select(F.col("a").alias("node"), F.least("a", "b").alias("label"))), work))
        links = work(contracted(links, rounds[-1]))
    labels = rounds.pop()
    while rounds:
        labels = relabelled(rounds.pop(), labels)
    labels = stored(labels, purpose)
    work.delete()
    return labels


def joined_components(labels: DataFrame, links: DataFrame, purpose: str = "components") -> DataFrame:
    """``labels`` as ``components`` gives them, with further ``links`` counted in. Only links
    between different labels are searched."""
    work = Scratch(links.sparkSession, purpose)
    top = components(work(contracted(links, labels)), purpose)
    new = top.join(labels.select("node"), "node", "left_anti")
    labels = stored(relabelled(labels, top).unionByName(new), purpose)
    work.delete()
    return labels
