"""Backbones and rankings against brute force."""

import random

import pytest

from rideloom.operators import flows, ranking


def random_od(spark, seed, zones=9, top=50):
    rng = random.Random(seed)
    rows = [(o, d, rng.randrange(1, top)) for o in range(zones) for d in range(zones) if rng.random() < 0.8]
    return rows, spark.createDataFrame(rows, "zone int, dest int, trips long")


def brute_backbone(rows, k):
    best = {}
    for o, d, n in rows:
        if o == d:
            continue
        pair = (min(o, d), max(o, d))
        if pair not in best or (-n, o) < (-best[pair][2], best[pair][0]):
            best[pair] = (o, d, n)
    kept = []

    def reaches(start, goal):
        stack, seen = [start], set()
        while stack:
            node = stack.pop()
            if node == goal:
                return True
            if node not in seen:
                seen.add(node)
                stack.extend(d for o, d, _ in kept if o == node)
        return False

    for o, d, n in sorted(best.values(), key=lambda e: (-e[2], e[0], e[1])):
        if len(kept) < k and not reaches(d, o):
            kept.append((o, d, n))
    return set(kept)


def acyclic(edges):
    left = set(edges)
    while left:
        targets = {d for _, d in left}
        free = {e for e in left if e[0] not in targets}
        if not free:
            return False
        left -= free
    return True


@pytest.mark.parametrize("seed,k", [(1, 5), (2, 12), (3, 25), (4, 3)])
def test_backbone_equals_greedy_over_all_links(spark, seed, k):
    rows, od = random_od(spark, seed)
    got = {tuple(r) for r in flows.od_backbone(od, k).collect()}
    assert got == brute_backbone(rows, k)
    assert acyclic({(o, d) for o, d, _ in got})


def test_backbone_refuses_a_cycle(spark):
    od = spark.createDataFrame([(3, 2, 9), (2, 1, 8), (1, 3, 7), (1, 4, 6)], "zone int, dest int, trips long")
    assert {(r["origin"], r["destination"]) for r in flows.od_backbone(od, 25).collect()} == {(3, 2), (2, 1), (1, 4)}


def test_shortlist_holds_the_worst_case(spark):
    """A complete graph whose strongest links all lie among few zones uses the shortlist to its last row."""
    assert flows.shortlist_size(25) == 301
    rows = [(o, d, 1000 - 10 * o - d) for o in range(4) for d in range(o + 1, 4)] + [(0, 9, 1)]
    od = spark.createDataFrame(rows, "zone int, dest int, trips long")
    assert flows.od_backbone(od, 7).count() == 7


@pytest.mark.parametrize("seed", [5, 6])
def test_ranked_backbone_is_acyclic(spark, seed):
    _, od = random_od(spark, seed)
    edges = {(r["origin"], r["destination"]) for r in flows.od_backbone_ranked(od, 25).collect()}
    assert edges and acyclic(edges)


def test_direction_ties_and_loops(spark):
    od = spark.createDataFrame([(1, 2, 5), (2, 1, 5), (3, 3, 99), (4, 1, 2), (1, 4, 3)], "zone int, dest int, trips long")
    assert {tuple(r) for r in flows.od_direction(od).collect()} == {(1, 2, 5), (1, 4, 3)}


def test_flow_split_counts_both_ends(spark):
    matrix = spark.createDataFrame(
        [("A", "A", 10), ("A", "B", 4), ("B", "A", 6)], "borough_o string, borough_d string, trips long"
    )
    rows = {r["borough"]: r for r in flows.flow_split(matrix).collect()}
    assert (rows["A"]["intra"], rows["A"]["cross"], rows["A"]["share_pct"]) == (10, 10, 50.0)
    assert (rows["B"]["intra"], rows["B"]["cross"]) == (0, 10)


def test_run_picks(spark):
    rows = [
        ("a", "2025-01", 2, True, False, "SUCCEEDED", "2025-01-01T00", 1.0),
        ("b", "2025-01", 2, True, False, "SUCCEEDED", "2025-01-02T00", 2.0),
        ("c", "2025-01", 2, True, True, "SUCCEEDED", "2025-01-03T00", 3.0),
        ("d", "2025-01", 2, True, False, "FAILED", "2025-01-04T00", 4.0),
        ("e", "2025-02", 4, True, False, "SUCCEEDED", "2025-01-05T00", 5.0),
    ]
    runs = spark.createDataFrame(
        rows, "run_id string, month string, reducers int, combiner boolean, fail_first boolean, status string, "
        "started_at string, elapsed_seconds double"
    )
    def ids(df):
        return {r["run_id"] for r in df.collect()}

    assert ids(ranking.latest_success_per_month(runs)) == {"c", "e"}
    assert ids(ranking.earliest_run_per_month(runs)) == {"a"}
    assert ids(ranking.latest_matching_run(runs)) == {"b"}
