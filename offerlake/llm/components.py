"""Distributed union-find, and linking of banded members without all pairs.

``components`` labels every node with the smallest node it is connected to, by
alternating large-star and small-star steps.  Every step is a grouped minimum
(pre-aggregated before the shuffle) and a join that Spark may split where a node
has many neighbours; each round is written to the shared checkpoint folder, so a
lost executor costs one round at most.

``link_members`` finds the components that true links form among the members of
hash buckets.  A bucket never emits all its pairs: each round compares its members
with one hub only, and buckets whose members have reached one component are finished.
What then still differs is compared in full, so that no link between different
components is lost: by ``sweep`` if given, else as pairs; ``finish``, if given, takes the
buckets of more than SMALL_BUCKET members, of which no pairs are written then.

Members may say how many elements their set has (``size``) and how many of these any
other member has at all (``reach``).  A link at p percent needs a common part of at least
p (size + size') / (100 + p), and no common part exceeds the reach; a member whose reach
is too small even for the smallest set of its bucket is linked with nothing there and
leaves the bucket.  In a large group of edited copies these are the copies that
are edited too much, which would otherwise have to be compared with every other one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlake.llm.spark import materialize, small as hinted

PAIRS_PER_MEMBER = 8          # hub rounds go on until so few open pairs are left for each member
SMALL_BUCKET = 64             # with ``finish``, members of a bucket whose open pairs are written


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(a, b) links -> (node, label), label = smallest node of the component.

    Nodes without a link have no row.  Nulls: a link with a null end is no link.
    Links may repeat and may join a node to itself.
    """
    edges = materialize(links.where("a is not null and b is not null and a <> b")
                             .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(hinted(low, edges), "u")        # larger neighbours go to the minimum
                     .select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = materialize(large, name)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(hinted(low, large), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .union(low.select("u", F.col("m").alias("v"))).distinct())
        edges = materialize(small, name)
        if _stars(edges):
            break
    roots = edges.select("v").distinct()
    return materialize(edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots.select("v", F.col("v"))), name)


def _stars(edges: DataFrame) -> bool:
    """Does every node have one edge down, or only edges from above?"""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("root")).union(
        edges.select(F.col("v"), F.lit(0), F.lit(1)))
    ends = ends.groupBy("x").agg(F.sum("down").alias("down"), F.max("root").alias("root"))
    return ends.where("down > 1 or down = 1 and root = 1").limit(1).count() == 0


def link_members(members: DataFrame, verify: Callable[[DataFrame], DataFrame], percent: int, name: str = "links",
                 sweep: Callable[[DataFrame], DataFrame] | None = None,
                 finish: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(bucket, node, size, reach) members -> (node, label) of the components of verified links.

    ``verify`` takes distinct pairs (a, b), a < b, and returns those that are links.
    ``sweep`` takes (region, node, label) and returns links (a, b) between any two nodes
    of one region with different labels; buckets that share members are one region.
    ``finish`` takes (bucket, node, label) of large buckets that are still open after two
    rounds and returns links between any two members of a bucket with different labels.
    """
    work = materialize(members.select("bucket", "node", "size", "reach"), name)
    links = seen = None
    turn, before = 0, None
    while True:
        now = work.withColumn("label", F.col("node"))
        if links is not None:
            label = components(links, name)
            now = (work.join(hinted(label), "node", "left")
                       .select("bucket", "node", "size", "reach", F.coalesce("label", "node").alias("label")))
        if turn and sweep is None:
            now = _possible(materialize(now, name), percent)
        # Hubs first by the share of the set that others have: the least edited copy.
        order = (F.col("reach") / F.col("size") if turn == 0 else F.lit(0.0), F.xxhash64("node", F.lit(turn)), "node", "label")
        state = (now.groupBy("bucket", "label").agg(F.count("*").alias("n"), F.max(F.struct(*order)).alias("hub"))
                    .groupBy("bucket").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("within"),
                                           F.count("*").alias("parts"), F.max("hub").alias("hub"))
                    .where("parts > 1").select("bucket", "n", "within", F.col("hub.node").alias("hub"), F.col("hub.label").alias("hub_label")))
        state = materialize(state, name)
        if sweep is not None and turn:
            now = materialize(now.join(hinted(state.select("bucket"), state), "bucket", "left_semi"), name)
            found = sweep(_regions(now, percent, name))
            return components(links.union(materialize(found, name)), name)
        open_pairs, open_members = state.agg(F.sum(F.expr("(n * n - within) / 2")), F.sum("n")).first()
        if not open_members:
            break
        # Few pairs are left, or hubs no longer bring members together.
        # With a sweep, one round of hubs comes first and the sweep does the rest.
        last = sweep is None and turn > 0 and (open_pairs <= PAIRS_PER_MEMBER * open_members
                                                        or turn > 1 and (finish is not None or open_pairs > 0.9 * before))
        before = open_pairs
        now = now.join(hinted(state.select("bucket", "hub", "hub_label", "n"), state), "bucket")
        if last or sweep is None:
            now = materialize(now, name)
        swept = None
        if last and finish is not None:
            swept = materialize(finish(now.where(f"n > {SMALL_BUCKET}").select("bucket", "node", "label")), name)
            now = now.where(f"n <= {SMALL_BUCKET}")
        if last:
            other = now.select("bucket", *[F.col(c).alias(f"b_{c}") for c in ("node", "size", "reach", "label")])
            pairs = (now.join(other, "bucket").where("node < b_node and label <> b_label")
                        .where(f"{100 + percent} * least(reach, b_reach) >= {percent} * (size + b_size)")
                        .select(F.col("node").alias("a"), F.col("b_node").alias("b")))
        else:
            pairs = now.where("label <> hub_label").select("node", "hub")
            if turn == 0 and sweep is None:          # first the hub that most of a member's buckets have
                pairs = (pairs.groupBy("node", "hub").agg(F.count("*").alias("k"))
                              .groupBy("node").agg(F.max(F.struct("k", "hub")).alias("best")).select("node", "best.hub"))
            pairs = pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
        pairs = pairs.distinct()
        if seen is not None:
            pairs = pairs.join(seen, ["a", "b"], "left_anti")
        pairs = materialize(pairs, name)
        found = materialize(verify(pairs), name)
        links = found if links is None else links.union(found)
        links = links if swept is None else links.union(swept)
        seen = pairs if seen is None else seen.union(pairs)
        if last:
            break
        work = now.select("bucket", "node", "size", "reach")
        turn += 1
    if links is None:
        return members.select("node", F.col("node").alias("label")).limit(0)
    return components(links, name)


def _regions(now: DataFrame, percent: int, name: str) -> DataFrame:
    first = now.groupBy("bucket").agg(F.min("node").alias("first"))
    region = components(now.join(hinted(first, now), "bucket").select(F.col("node").alias("a"), F.col("first").alias("b")), name)
    nodes = now.select("node", "size", "reach", "label").distinct().join(hinted(region.withColumnRenamed("label", "bucket"), region), "node")
    return (_possible(materialize(nodes, name), percent).select(F.col("bucket").alias("region"), "node", "label"))


def _possible(now: DataFrame, percent: int) -> DataFrame:
    """Members that can be linked with some member of their bucket."""
    least = now.groupBy("bucket").agg(F.min("size").alias("least"))
    return (now.join(hinted(least, now), "bucket").where(f"{100 + percent} * reach >= {percent} * (size + least)").drop("least"))
