"""Groups of linked records from buckets of candidates, without pairing off a bucket.

A bucket's members are first compared with one leader each. Members that are linked share a group from
then on, and only members of different groups are compared further: with other leaders, and at the end
every member outside of a bucket's largest group with every member of another group. So each pair of a
bucket is compared or already connected, and a bucket of n alike members costs about n comparisons.

The light facts (sketches of fixed size) are tested inside the joins, so only promising pairs are made.

Joins are on keys, with each bucket's leader or each record once on one side, so the engine can split
a bucket that holds many rows. Groups come from star contractions of the links, which keep a component
as edges to its smallest member and need a few rounds whatever its size. Tables between the rounds are
written, so a lost executor costs no recomputation; only counts go to the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolog.session import materialized


def components(links: DataFrame) -> DataFrame:
    """(id, group) of every linked record: the group is the smallest id that links lead to.

    ``links`` has a and b. Each round makes large stars (neighbours above a node move to its smallest
    neighbour) and small stars (those below as well) until nothing changes.
    """
    edges = materialized(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    mark = signature(edges)
    while True:
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        centre = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(centre, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = materialized(small.select("e.u", "e.v").where("u > v").distinct())
        before, mark = mark, signature(edges)
        if mark == before:
            break
    return edges.select(F.col("u").alias("id"), F.col("v").alias("group")).union(edges.select("v", "v").distinct())


def signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first())


def crowded(members: DataFrame) -> DataFrame:
    """The (bucket, id) rows of buckets with more than one id, written."""
    shared = members.groupBy("bucket").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    return materialized(members.join(shared.select("bucket"), "bucket", "left_semi").distinct())


def with_facts(pairs: DataFrame, facts: DataFrame, fact: str) -> DataFrame:
    """Pairs with the fact of a as fact_a and that of b as fact_b."""
    for side in ("a", "b"):
        pairs = pairs.join(facts.select(F.col("id").alias(side), F.col(fact).alias(f"fact_{side}")), side)
    return pairs


def linked_groups(members: DataFrame, facts: DataFrame, near: Callable[[Column, Column], Column],
                  same: Callable[[Column, Column], Column], leaders: int = 2) -> DataFrame:
    """(id, group) of the linked records of ``members`` (bucket, id), which come from :func:`crowded`.

    ``facts`` has id, light and heavy for each member. A pair is linked if ``near`` holds for its light
    facts and ``same`` for its heavy ones. ``leaders`` rounds compare with one leader a bucket.
    """
    members = materialized(members.select("bucket", "id").join(facts.select("id", "light"), "id"))
    unresolved = members.withColumn("group", F.col("id"))
    tried = links = groups = None
    for k in range(leaders + 1):
        turn = F.col("id") if k == 0 else F.xxhash64("id", "bucket", F.lit(k))
        if k < leaders:
            spread = unresolved.groupBy("bucket").agg(
                F.min("group").alias("lo"), F.max("group").alias("hi"), F.min_by("id", turn).alias("leader"),
                F.min_by("group", turn).alias("leader_group"), F.min_by("light", turn).alias("leader_light")).where("lo < hi")
            pairs = (unresolved.join(spread, "bucket")
                     .where((F.col("group") != F.col("leader_group")) & near(F.col("light"), F.col("leader_light")))
                     .select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")).distinct())
        else:
            whole = unresolved.join(facts.select("id", "heavy"), "id")
            largest = (unresolved.groupBy("bucket", "group").agg(F.count("*").alias("n"))
                       .groupBy("bucket").agg(F.max_by("group", F.col("n")).alias("main"), F.count("*").alias("k")).where("k > 1"))
            outside = whole.join(largest, "bucket").where(F.col("group") != F.col("main")).select(
                "bucket", F.col("id").alias("o"), F.col("group").alias("o_group"), F.col("light").alias("o_light"), F.col("heavy").alias("o_heavy"))
            close = (F.col("group") != F.col("o_group")) & near(F.col("light"), F.col("o_light"))
            met = outside.join(whole, "bucket").where(close & same(F.col("heavy"), F.col("o_heavy")))
            pairs = met.select(F.least("id", "o").alias("a"), F.greatest("id", "o").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialized(pairs)
        if pairs.isEmpty():
            continue
        tried = pairs if tried is None else tried.union(pairs)
        checked = with_facts(pairs, facts, "heavy").withColumn("linked", same(F.col("fact_a"), F.col("fact_b")))
        found = materialized(checked.where("linked").select("a", "b"))
        links = found if links is None else links.union(found)
        groups = components(links)
        if k < leaders:
            known = members.join(groups, "id", "left").select("bucket", "id", "light", F.coalesce("group", "id").alias("group"))
            # buckets of two have had their comparison
            still = known.groupBy("bucket").agg(F.min("group").alias("lo"), F.max("group").alias("hi"), F.count("*").alias("n")).where("lo < hi and n > 2")
            unresolved = materialized(known.join(still.select("bucket"), "bucket", "left_semi"))
    if groups is None:
        return members.select("id", F.col("id").alias("group")).limit(0)
    return groups
