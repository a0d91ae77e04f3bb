"""Merging of sums, summaries, conservation, comparisons."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from rideloom.operators import cubes, summary, verify
from rideloom.operators import families as fam
from rideloom.operators.dimension import compare_keyed, enrich_zone, scope_filter
from rideloom.operators.sets import require_unique, symmetric_difference
from rideloom.schema import SUM4

SUM_SCHEMA = ", ".join(f"{name} long" for name in SUM4)


def test_merging_partial_sums_in_any_chunks(spark):
    rng = random.Random(42)
    rows = [(i // 13, rng.randrange(7), 1, *[rng.randrange(10_000) for _ in range(3)]) for i in range(400)]
    df = spark.createDataFrame(rows, f"chunk int, zone int, {SUM_SCHEMA}")
    direct = fam.additive_sum(df, ["zone"])
    merged = fam.additive_sum(fam.additive_sum(df, ["chunk", "zone"]), ["zone"])
    assert symmetric_difference(direct, merged).isEmpty()


@pytest.fixture(scope="module")
def zh(spark):
    return spark.createDataFrame(
        [(1, 8, 1, 1000, 60, 100), (1, 9, 9, 90000, 5400, 9000), (2, 8, 1, 2000, 120, 200)], f"zone int, hour int, {SUM_SCHEMA}"
    )


@pytest.fixture(scope="module")
def zones(spark):
    return spark.createDataFrame([(1, "A", "A"), (2, "B", "B")], "id int, name string, borough string")


def test_weighted_means_and_filters(zh, zones):
    a = summary.summary(zh, zones, borough="A").first()
    assert a["trips"] == 10 and a["avg_minutes"] == 9.1
    assert summary.summary(zh, zones, hour=8).first()["trips"] == 2
    empty = summary.summary(zh, zones, hour=22).first()
    assert empty["trips"] == 0 and empty["avg_minutes"] == 0


def test_profile_ignores_the_hour_and_is_dense(zh, zones):
    profile = {r["hour"]: r["trips"] for r in summary.hourly_profile(zh, zones, borough="A").collect()}
    assert len(profile) == 24 and profile[8] == 1 and profile[9] == 9 and profile[0] == 0


def test_unknown_scope_is_an_error(zh, zones):
    with pytest.raises(ValueError):
        scope_filter(zh, zones, borough="Nowhere")
    with pytest.raises(ValueError):
        scope_filter(zh, zones, hour=24)


def test_lookup_defaults_and_duplicate_dimension_rows(spark, zh):
    twice = spark.createDataFrame([(1, "A", "A"), (1, "A", "A")], "id int, name string, borough string")
    rows = enrich_zone(zh, twice).collect()
    assert len(rows) == 3
    assert {(r["zone"], r["name"], r["borough"]) for r in rows} == {(1, "A", "A"), (2, "2", "Unknown")}


def test_duplicate_keys_cannot_be_published(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (2, 0)], "zone int, hour int")
    with pytest.raises(ValueError, match="duplicate"):
        require_unique(df, ["zone", "hour"])
    assert require_unique(df.distinct(), ["zone", "hour"]).count() == 2


def _trips(spark, n=500):
    rng = random.Random(1)
    rows = [
        (rng.randrange(5), rng.randrange(5), rng.randrange(24), date(2024, 1, 1 + rng.randrange(9)),
         rng.randrange(9999), rng.randrange(9999), rng.randrange(9999))
        for _ in range(n)
    ]
    return spark.createDataFrame(
        rows, "zone int, dest int, hour int, day date, distance_milli_miles long, seconds long, cents long"
    )


def test_conservation(spark):
    families = fam.key_families(_trips(spark))
    rejects = spark.createDataFrame([("Malformed", 7)], "reason string, rows long")
    assert verify.conservation_check(families, rejects, 507).first()["ok"]
    verify.require_conservation(verify.conservation_check(families, rejects, 507))
    with pytest.raises(ValueError, match="conservation"):
        verify.require_conservation(verify.conservation_check(families, rejects, 508))
    broken = families.filter(~((F.col("kind") == "O") & (F.col("zone") == 0)))
    assert not verify.conservation_check(broken, rejects, 507).first()["ok"]


def test_hot_key_keeps_every_row(spark):
    """A third of all rows on one key: sums stay whole."""
    trips = _trips(spark, 300).unionByName(_trips(spark, 1).withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(150)))).drop("x"))
    total = fam.key_families(trips).groupBy("kind").agg(F.sum("trips").alias("n")).collect()
    assert {r["n"] for r in total} == {450}


def test_recount_and_compare(spark):
    trips = _trips(spark)
    keys = ["kind", "zone", "hour", "day", "dest"]
    families = fam.key_families(trips)
    assert compare_keyed(families, verify.independent_recount(trips), keys).isEmpty()
    one_more = trips.unionByName(trips.limit(1))
    assert compare_keyed(families, fam.key_families(one_more), keys).count() == 4


def test_partition_invariance(spark):
    assert {(r["k"], r["diff_rows"]) for r in verify.partition_invariance(_trips(spark)).collect()} == {
        (1, 0), (2, 0), (4, 0), (13, 0)}


def test_cuboid_of_classified_rows_counts_rejects(spark, sf_dir):
    from rideloom.plans.tables import Tables

    t = Tables(spark, sf_dir)
    cells = fam.classified_cuboid(t.classified)
    assert cells.agg(F.sum("trips")).first()[0] == t.events.count()
    assert cells.filter("reason IS NOT NULL").count() == 7
    valid = cells.filter("reason IS NULL").drop("reason")
    assert symmetric_difference(valid, fam.base_cuboid(t.trips).select(*valid.columns)).isEmpty()


def test_missing_months_show_in_the_spine(spark):
    months = cubes.month_spine(spark.createDataFrame([("2024-11",), ("2025-02",)], "month string"))
    assert [r["month"] for r in months.orderBy("month").collect()] == ["2024-11", "2024-12", "2025-01", "2025-02"]


def test_avg_per_year_counts_years_of_the_slot(spark):
    t = spark.createDataFrame(
        [(date(2023, 1, 1), 3), (date(2023, 1, 2), 3), (date(2024, 1, 5), 3), (date(2024, 2, 5), 3)], "day date, hour int"
    )
    rows = {r["month"]: r for r in cubes.hour_by_calendar_month(t).collect()}
    assert rows[1]["trips"] == 3 and rows[1]["avg_trips_per_year"] == 1.5
    assert rows[2]["trips"] == 1 and rows[2]["avg_trips_per_year"] == 1.0
