"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.session import stage


def components(edges: DataFrame) -> DataFrame:
    """(v, component) of every vertex of ``edges`` (columns a, b); a component is named by one of its vertices.

    In each round every vertex joins a neighbour or itself, and edges are drawn between what the vertices joined. Rounds take
    turns: the vertex of lowest id, which ends a star around a low id at once, and the vertex of lowest hash (new in
    each round), which shrinks chains by a constant share. Two joins are followed in each round. The minimum is taken
    before the shuffle too, so a vertex with very many edges is cheap. The names are handed back through the rounds.
    """
    left = stage(edges.select("a", "b").filter("a != b").distinct(), "edges")
    joined: list[DataFrame] = []
    while not left.isEmpty():
        turn = len(joined)
        ends = F.explode(
            F.array(*(F.struct(F.col(v).alias("v"), F.col(o).alias("other")) for v, o in ("ab", "ba", "aa", "bb")))
        )
        both = left.select(ends.alias("end")).select("end.*")
        order = F.col("other") if turn % 2 == 0 else F.xxhash64("other", F.lit(turn))
        best = F.min(F.struct(order.alias("order"), "other")).alias("best")
        once = stage(both.groupBy("v").agg(best).select("v", F.col("best.other").alias("to")), "contraction")
        twice = once.toDF("to", "on")
        to = stage(once.join(twice, "to").select("v", F.col("on").alias("to")), "contraction")
        joined.append(to)
        left = stage(
            left.join(to.toDF("a", "to_a"), "a")
            .join(to.toDF("b", "to_b"), "b")
            .filter("to_a != to_b")
            .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
            .distinct(),
            "edges",
        )
    if not joined:
        return left.select(F.col("a").alias("v"), F.col("b").alias("component"))
    named = joined[-1].toDF("v", "component")
    for to in joined[-2::-1]:
        onward = named.toDF("to", "component")
        named = to.join(onward, "to", "left").select("v", F.coalesce("component", "to").alias("component"))
    return stage(named, "components")


def extended(named: DataFrame, edges: DataFrame) -> DataFrame:
    """(v, component) of the edges that gave ``named`` and of these; only the components that these edges join are contracted."""
    met = (
        edges.select("a", "b")
        .join(named.toDF("a", "of_a"), "a", "left")
        .join(named.toDF("b", "of_b"), "b", "left")
        .select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    )
    joined = components(met)
    moved = named.join(joined.toDF("component", "onward"), "component", "left")
    moved = moved.select("v", F.coalesce("onward", "component").alias("component"))
    return stage(moved.unionByName(joined.join(named.select("v"), "v", "left_anti")), "components")
