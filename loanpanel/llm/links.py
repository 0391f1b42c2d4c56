"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanpanel.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for links ``a, b`` between longs.

    Each node points at the smallest node it knows of; in a round a node takes the smallest
    pointer among its neighbours, and then follows pointers of pointers.  Both steps are joins on
    nodes and minimums with map-side partial results, so a node with many links is one row of a task's partial
    result.  Every round is written, which cuts the lineage.  Links inside a component vanish as
    soon as their ends agree, so rounds get cheaper; their number grows with the log of the longest chain.
    """
    links = written(links.select("a", "b").where("a <> b").distinct(), "links")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    points = written(nodes.select("node", F.col("node").alias("component")), "points")
    live = links
    while not live.isEmpty():
        # Least pointer seen across the links, per pointed-at root: hooks whole trees at once.
        offers = live.select(F.greatest("a", "b").alias("root"), F.least("a", "b").alias("to"))
        hooks = written(offers.groupBy("root").agg(F.min("to").alias("to")), "hooks")
        hooks = _flatten(hooks)
        moved = points.join(hooks, points["component"] == hooks["root"], "left")
        points = written(moved.select("node", F.coalesce("to", "component").alias("component")), "points")
        ends = hooks.select("root", "to")
        live = live.join(ends, live["a"] == ends["root"], "left").select(F.coalesce("to", "a").alias("a"), "b")
        ends = hooks.select(F.col("root").alias("root_b"), F.col("to").alias("to_b"))
        live = live.join(ends, live["b"] == ends["root_b"], "left").select("a", F.coalesce("to_b", "b").alias("b"))
        live = written(live.where("a <> b").distinct(), "live")
    return points


def _flatten(hooks: DataFrame) -> DataFrame:
    """Follow ``root -> to`` to its end; each round halves the longest path."""
    while True:
        onward = hooks.select(F.col("root").alias("via"), F.col("to").alias("end"))
        joined = hooks.join(onward, hooks["to"] == onward["via"], "left")
        if joined.where(F.col("end").isNotNull()).isEmpty():
            return hooks
        hooks = written(joined.select("root", F.coalesce("end", "to").alias("to")), "hooks")
