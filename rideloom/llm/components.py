"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideloom.workspace import cut_lineage, forget


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of ``edges`` (columns ``a`` and ``b``).

    In every round each node hooks onto the neighbour, or itself, that comes first in the round's order, and
    the graph shrinks to the nodes hooked onto. The first two orders are by id, which settles stars around
    their smallest node at once; later ones are by a salted hash, new in each round, so long chains halve
    instead of losing one node. Every round is written to the shared folder. Loops only add their node; nulls are left
    out; an empty table gives an empty one.
    """
    rest = edges.select("a", "b").dropna().distinct()
    steps: list[DataFrame] = []
    while not steps or not rest.isEmpty():
        turn = len(steps)
        salt = lambda c: F.xxhash64(c, F.lit(turn)) if turn > 1 else F.lit(0).cast("long")  # noqa: B023, E731
        rank = lambda c: F.struct(salt(c).alias("h"), F.col(c).alias("id"))  # noqa: B023, E731
        both = rest.union(rest.select(F.col("b"), F.col("a")))
        hooked = both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.min(rank("b")), F.min(rank("a")))["id"].alias("to"))
        steps.append(cut_lineage(hooked, "hooked"))
        at = lambda c: steps[-1].select(F.col("node").alias(c), F.col("to").alias(f"to_{c}"))  # noqa: B023, E731
        moved = rest.join(at("a"), "a").join(at("b"), "b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
        before, rest = rest, cut_lineage(moved.filter("a <> b").distinct(), "edges")
        if turn:
            forget(before)
    home = steps[0]
    for step in steps[1:]:
        step = step.select(F.col("node").alias("to"), F.col("to").alias("next"))
        home = home.join(step, "to", "left").select("node", F.coalesce("next", "to").alias("to"))
    home = cut_lineage(home, "components")
    forget(rest, *steps)
    least = home.groupBy("to").agg(F.min("node").alias("component"))
    return home.join(least, "to").select("node", "component")
