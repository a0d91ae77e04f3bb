"""Column functions on single values."""

import math

import pytest
from pyspark.sql import functions as F

from rideloom.functions import calendar, classify, geo, measures


@pytest.mark.parametrize("name,group", [
    ("JFK Airport", "机场"),
    ("Newark Airport", "机场"),
    ("Upper East Side North", "曼哈顿北部"),
    ("Lincoln Square East", "曼哈顿北部"),
    ("Midtown Center", "曼哈顿中城"),
    ("Times Sq/Theatre District", "曼哈顿中城"),
    ("SoHo", "曼哈顿其他"),
    ("Penn Station/Madison Sq West", "曼哈顿其他"),
    ("Queens Village", "皇后区"),
    ("Downtown Brooklyn/MetroTech", "布鲁克林"),
    ("Bronx Park", "布朗克斯"),
    ("Harbor", "其他"),
])
def test_zone_groups(spark, name, group):
    got = spark.range(1).select(classify.zone_group(F.lit(name)).alias("g")).first()["g"]
    assert got == group


def test_intensity_levels(spark):
    df = spark.createDataFrame([(0,), (1,), (9,), (30,), (99,)], "n int")
    rows = {r["n"]: r for r in classify.intensity(df, "n").collect()}
    for n, row in rows.items():
        want = math.log1p(n) / math.log1p(99)
        assert row["intensity"] == pytest.approx(want)
        assert row["level"] == sum(want >= limit for limit in (0.25, 0.5, 0.75, 0.92))
    assert classify.normalise_to_max(df.filter("n = 0"), "n").first()["ratio"] == 0


def test_clip(spark):
    df = spark.createDataFrame([(-80.0,), (3.0,), (50.5,)], "e double")
    assert [r[0] for r in df.select(measures.clip_error(F.col("e"))).collect()] == [-50.0, 3.0, 50.0]


def test_slots(spark):
    df = spark.createDataFrame([("2025-12-31 23:59:30",)], "s string").select(F.col("s").cast("timestamp_ntz").alias("ts"))
    slot = calendar.replay_slot(df, "ts")
    assert slot.first()["slot"] == 31 * 1440 - 1
    assert slot.select(calendar.slot_label(F.col("slot")).alias("l")).first()["l"] == "31 23:59"


def test_calendar(spark):
    df = spark.createDataFrame([("2025-01-05 07:00:00",)], "s string").select(F.col("s").cast("timestamp_ntz").alias("ts"))
    row = calendar.calendar_features(df, "ts").first()
    assert (row["hour"], row["month"], row["year"], row["weekday"], row["is_weekend"]) == (7, 1, 2025, 6, 1)


def test_mercator_and_elevation(spark):
    row = spark.createDataFrame([(-74.0, 40.7)], "lon double, lat double").select(
        *[c.alias(n) for n, c in geo.mercator(F.col("lon"), F.col("lat"), 11).items()],
        geo.decode_elevation(F.lit(128), F.lit(5), F.lit(64)).alias("e"),
    ).first()
    x = (-74.0 + 180) / 360 * 2048
    y = (1 - math.asinh(math.tan(math.radians(40.7))) / math.pi) / 2 * 2048
    assert (row["tile_x"], row["tile_y"]) == (int(x), int(y))
    assert row["pixel_x"] == pytest.approx(x * 256) and row["pixel_y"] == pytest.approx(y * 256)
    assert row["e"] == 5.25
