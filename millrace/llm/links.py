"""From band keys to verified links and connected components, all in Spark.

A node is a distinct shingle set; copies share one. Nodes with an equal band key are candidates. Not all pairs of such a
bucket are made. Three rounds look for links, and each leaves out pairs that are already in one component, as those cannot
change it:

1. every node with the most central of its buckets' centres,
2. every node with the centre of each of its buckets,
3. in buckets that still hold several components, all pairs across components, once for all buckets they share.

A bucket's centre is its node that meets most nodes over all buckets: of near copies, one of the least changed, which most
others are alike. So no link between components is lost, and a large group of near copies gives about one pair a node.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node that it is connected with.

    Alternating large and small stars: each round hangs a node's neighbours onto the smallest of them, until every node
    but the smallest hangs on one that hangs on nothing. Rounds are written to the shared folder. Only minima are
    aggregated by node, so a node with very many neighbours needs no large group.
    """

    def star(edges: DataFrame, large: bool) -> DataFrame:
        if large:
            around = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = around.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
        met = around.join(low, "a")
        if large:
            out = met.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        else:
            out = met.select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select("a", F.col("low").alias("b")))
        return out.where("a <> b").distinct()

    edges = staged(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    while True:
        seen = edges.agg(F.count(F.lit(1)).alias("edges"), F.countDistinct("a").alias("nodes")).first()
        if seen["edges"] == seen["nodes"] and edges.join(edges.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            break
        edges = staged(star(star(edges, True), False), "stars")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _labelled(rows: DataFrame, groups: DataFrame, node: str, label: str) -> DataFrame:
    """``rows`` with the component of a node column; a node without links is its own."""
    named = groups.select(F.col("node").alias(node), F.col("component").alias(label))
    return rows.join(named, node, "left").withColumn(label, F.coalesce(label, node))


def _merged(groups: DataFrame, links: DataFrame) -> DataFrame:
    """The components after more links between nodes."""
    both = _labelled(_labelled(links, groups, "a", "of_a"), groups, "b", "of_b")
    grown = components(both.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")))
    old = _labelled(groups.withColumnRenamed("component", "was"), grown, "was", "component").select("node", "component")
    return staged(old.union(grown).distinct(), "components")


def linked(nodes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int, likely: Callable[[Column, Column], Column]) -> tuple[DataFrame, DataFrame]:
    """(links, components) of ``nodes``.

    ``nodes`` has a row per node or copy of it: key, bands (array of long), sig (array of long). ``likely`` says from two
    signatures whether a pair may reach the threshold. ``sets_of`` gives (key, shingles) for a table of distinct keys.
    The links are those that the rounds found: all that it takes to connect the components.
    """
    spread = nodes.select("key", F.explode("bands").alias("band"))
    shared = spread.groupBy("band").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low <> high").select("band")
    buckets = staged(spread.join(shared, "band", "left_semi").distinct(), "buckets")
    sizes = buckets.groupBy("band").agg(F.count(F.lit(1)).alias("n"))
    met = staged(buckets.join(sizes, "band").groupBy("key").agg(F.sum("n").alias("met")), "met")
    centres = buckets.join(met, "key").groupBy("band").agg(F.max(F.struct("met", "key")).alias("centre"))
    members = staged(buckets.join(centres, "band").where("key <> centre.key").select("band", "key", "centre"), "members")
    known = staged(nodes.join(met, "key", "left_semi").select("key", "sig", "bands").dropDuplicates(["key"]), "known")

    def sides(columns: list[str]) -> tuple[DataFrame, DataFrame]:
        one, other = (known.select(F.col("key").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in columns]) for x in "ab")
        return one, other

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """The pairs (a, b) whose sets have 100 * intersection >= percent * union."""
        pairs = staged(pairs.select("a", "b"), f"{name}_pairs")
        sets = staged(sets_of(pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()), f"{name}_sets")
        left, right = (sets.select(F.col("key").alias(x), F.col("shingles").alias(f"of_{x}")) for x in "ab")
        both = F.size(F.array_intersect("of_a", "of_b"))
        either = F.size("of_a") + F.size("of_b") - both
        return staged(pairs.join(left, "a").join(right, "b").where(100 * both >= percent * either).select("a", "b"), f"{name}_links")

    def signed(pairs: DataFrame) -> DataFrame:
        left, right = sides(["sig"])
        return pairs.join(left, "a").join(right, "b").where(likely(F.col("sig_a"), F.col("sig_b")))

    middle = staged(members.groupBy("key").agg(F.max("centre").alias("middle")).select("key", F.col("middle.key").alias("middle")), "middle")
    first = verified(signed(middle.select(F.col("key").alias("a"), F.col("middle").alias("b"))), "first")
    groups = components(first)

    stars = members.join(middle, "key").where("centre.key <> middle").select(F.col("key").alias("a"), F.col("centre.key").alias("b")).distinct()
    stars = _labelled(_labelled(stars, groups, "a", "of_a"), groups, "b", "of_b").where("of_a <> of_b").select("a", "b")
    second = verified(signed(stars), "second")
    groups = _merged(groups, second)

    # buckets whose nodes, but for the centre, are not yet in one component
    labelled = _labelled(members.select("band", "key"), groups, "key", "component")
    split = labelled.groupBy("band").agg(F.min("component").alias("one"), F.max("component").alias("other")).where("one <> other").select("band")
    several = labelled.join(split, "band", "left_semi")
    sizes = several.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n"))
    major = sizes.groupBy("band").agg(F.max(F.struct("n", "component")).alias("top")).select("band", F.col("top.component").alias("major"))
    several = staged(several.join(major, "band"), "several")
    shingles = sets_of(several.select("key").distinct()).select("key", F.transform("shingles", lambda s: F.shiftright(s, 32).cast("int")).alias("short"))
    several = several.join(known.join(shingles, "key"), "key")
    minor = several.where("component <> major").select("band", F.col("key").alias("a"), F.col("component").alias("of_a"), F.col("sig").alias("sig_a"), F.col("bands").alias("bands_a"), F.col("short").alias("short_a"))
    every = several.select(
        "band", F.col("key").alias("b"), F.col("component").alias("of_b"), F.col("sig").alias("sig_b"), F.col("bands").alias("bands_b"), F.col("short").alias("short_b"), (F.col("component") == F.col("major")).alias("in_major")
    )
    across = (minor["of_a"] != every["of_b"]) & (every["in_major"] | (minor["a"] < every["b"])) & likely(minor["sig_a"], every["sig_b"])
    once = F.array_intersect(minor["bands_a"], every["bands_b"])[0] == minor["band"]  # in the first band that both have
    # nearly the verdict, on half of each hash; so only pairs about to be links leave the join
    both = F.size(F.array_intersect(minor["short_a"], every["short_b"]))
    close = (100 + percent - 1) * both >= (percent - 1) * (F.size(minor["short_a"]) + F.size(every["short_b"]))
    pairs = minor.join(every, (minor["band"] == every["band"]) & across & once & close).select("a", "b").distinct()
    third = verified(pairs, "third")
    return first.union(second).union(third), _merged(groups, third)
