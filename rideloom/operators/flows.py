"""Origin-destination flows. ``od`` has zone, dest, trips."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideloom.functions.classify import ZONE_GROUP_RULES, zone_group
from rideloom.functions.measures import ratio_or_zero
from rideloom.operators.dimension import enrich_od, one_per_id

# Names of the airport zones, lower case.
HUB_PATTERNS = ("jfk airport", "laguardia airport", "newark airport")


def od_year(od: DataFrame) -> DataFrame:
    """Merge monthly pairs."""
    return od.groupBy("zone", "dest").agg(F.sum("trips").alias("trips"))


def od_pair_count(od: DataFrame) -> DataFrame:
    """One row: distinct pairs and their trips."""
    return od_year(od).agg(F.count("*").alias("pairs"), F.sum("trips").alias("trips"))


def top_od(od: DataFrame, k: int) -> DataFrame:
    return od.orderBy(F.desc("trips"), "zone", "dest").limit(k)


def borough_od_matrix(od: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips between boroughs over every pair; '?' stands for an unknown zone."""
    named = enrich_od(od, zones, unknown="?")
    return named.groupBy("borough_o", "borough_d").agg(F.sum("trips").alias("trips"))


def hub_in_out(od: DataFrame, zones: DataFrame, patterns: Sequence[str] = HUB_PATTERNS) -> DataFrame:
    """Trips into and out of every zone whose name matches; hubs without trips count 0.

    Each pair is unfolded into its two ends and summed per zone, so no hub pulls pairs together.
    """
    ends = od.select(
        F.explode(
            F.array(
                F.struct(F.col("dest").alias("id"), F.col("trips").alias("inbound"), F.lit(0).cast("long").alias("outbound")),
                F.struct(F.col("zone").alias("id"), F.lit(0).cast("long").alias("inbound"), F.col("trips").alias("outbound")),
            )
        ).alias("end")
    ).select("end.*")
    sums = ends.groupBy("id").agg(F.sum("inbound").alias("inbound"), F.sum("outbound").alias("outbound"))
    matches = F.lit(False)
    for pattern in patterns:
        matches = matches | F.lower("name").rlike(pattern)
    hubs = one_per_id(zones).filter(matches).select("id", "name")
    return hubs.join(sums, "id", "left").fillna(0, ["inbound", "outbound"])


def flow_split(borough_od: DataFrame) -> DataFrame:
    """Per borough: trips inside, trips crossing its border (either way), crossing share of all trips."""
    inside = F.col("borough_o") == F.col("borough_d")
    grand_total = borough_od.agg(F.sum("trips").alias("all_trips")).scalar()
    zero = F.lit(0).cast("long")
    parts = F.when(
        inside,
        F.array(F.struct(F.col("borough_o").alias("borough"), F.col("trips").alias("intra"), zero.alias("cross"))),
    ).otherwise(
        F.array(
            F.struct(F.col("borough_o").alias("borough"), zero.alias("intra"), F.col("trips").alias("cross")),
            F.struct(F.col("borough_d").alias("borough"), zero.alias("intra"), F.col("trips").alias("cross")),
        )
    )
    sums = borough_od.select(F.explode(parts).alias("part")).select("part.*").groupBy("borough").agg(
        F.sum("intra").alias("intra"), F.sum("cross").alias("cross")
    )
    return sums.withColumn("share_pct", ratio_or_zero(F.col("cross") * F.lit(100.0), grand_total))


def od_direction(od: DataFrame) -> DataFrame:
    """The larger direction of every unordered pair (ties: smaller origin); loops dropped."""
    pairs = od.filter(F.col("zone") != F.col("dest")).groupBy(
        F.least("zone", "dest").alias("a"), F.greatest("zone", "dest").alias("b")
    ).agg(F.max(F.struct("trips", (-F.col("zone")).alias("rank"), "dest")).alias("best"))
    return pairs.select(
        (-F.col("best.rank")).alias("origin"), F.col("best.dest").alias("destination"), F.col("best.trips").alias("trips")
    )


def shortlist_size(k: int) -> int:
    """How many leading links decide the first ``k`` of an acyclic backbone.

    A link is refused only if both its ends are already linked to each other. k-1 accepted links join
    at most k zones, which have k(k-1)/2 unordered pairs, so the k-th accepted link is at rank
    k(k-1)/2 + 1 or earlier.
    """
    return k * (k - 1) // 2 + 1


def _greedy_acyclic(links: pd.DataFrame, k: int) -> pd.DataFrame:
    """Take links in order unless they close a directed cycle; at most k. ``links`` is the shortlist."""
    reachable: dict[int, set[int]] = {}
    kept = []
    ordered = links.sort_values(["trips", "origin", "destination"], ascending=[False, True, True])
    for row in ordered.itertuples(index=False):
        start, end = row.origin, row.destination
        if start in reachable.get(end, ()):
            continue
        downstream = {end} | reachable.get(end, set())
        for node in [start, *[n for n, seen in reachable.items() if start in seen]]:
            reachable.setdefault(node, set()).update(downstream)
        kept.append(row)
        if len(kept) == k:
            break
    return pd.DataFrame(kept, columns=links.columns)


def od_backbone(od: DataFrame, k: int = 25) -> DataFrame:
    """The k strongest links that form no directed cycle.

    Spark reduces the pairs and picks the shortlist, which provably holds the answer; only those
    k(k-1)/2 + 1 rows go through the greedy step.
    """
    shortlist = od_direction(od).orderBy(F.desc("trips"), "origin", "destination").limit(shortlist_size(k))
    return shortlist.groupBy().applyInPandas(
        lambda pdf: _greedy_acyclic(pdf, k), "origin int, destination int, trips long"
    )


def od_backbone_ranked(od: DataFrame, k: int = 25) -> DataFrame:
    """Acyclic by construction: keep links from a zone of larger net outflow to one of smaller.

    Ties fall to the smaller id. The top k by trips; any size of graph, no local step.
    """
    no_loops = od.filter(F.col("zone") != F.col("dest"))
    net = no_loops.select(
        F.explode(
            F.array(
                F.struct(F.col("zone").alias("id"), F.col("trips").alias("n")),
                F.struct(F.col("dest").alias("id"), (-F.col("trips")).alias("n")),
            )
        ).alias("end")
    ).groupBy("end.id").agg(F.sum("end.n").alias("net"))
    out = no_loops.join(net.select(F.col("id").alias("zone"), F.col("net").alias("net_o")), "zone").join(
        net.select(F.col("id").alias("dest"), F.col("net").alias("net_d")), "dest"
    )
    forward = (F.col("net_o") > F.col("net_d")) | ((F.col("net_o") == F.col("net_d")) & (F.col("zone") < F.col("dest")))
    return (
        out.filter(forward)
        .select(F.col("zone").alias("origin"), F.col("dest").alias("destination"), "trips")
        .orderBy(F.desc("trips"), "origin", "destination")
        .limit(k)
    )


def dedup_nodes(links: DataFrame) -> DataFrame:
    """Every endpoint of the links once."""
    return links.select(F.explode(F.array("origin", "destination")).alias("zone")).distinct()


def group_internal_share(links: DataFrame, zones: DataFrame, rules: Sequence[tuple[str, str]] = ZONE_GROUP_RULES) -> DataFrame:
    """Share of the links' trips that stay inside one zone group, in percent."""
    od = links.select(F.col("origin").alias("zone"), F.col("destination").alias("dest"), "trips")
    same = zone_group(F.col("name_o"), rules) == zone_group(F.col("name_d"), rules)
    return enrich_od(od, zones).agg(
        F.sum("trips").alias("trips"), F.sum(F.when(same, F.col("trips")).otherwise(0)).alias("internal")
    ).select("trips", "internal", ratio_or_zero(F.col("internal") * F.lit(100.0), F.col("trips")).alias("share_pct"))
