"""JSON documents and keyed text lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rideloom.functions.once import computed_once
from rideloom.operators.families import FAMILY_KEYS
from rideloom.operators.grid import DAILY_WEATHER, HOURLY_WEATHER
from rideloom.schema import SUM4

_GEOMETRY = (
    "features array<struct<properties: struct<id: int, name: string, borough: string>, "
    "geometry: struct<type: string, coordinates: string>>>"
)
_POLYGON = "array<array<array<double>>>"


def explode_columnar(docs: DataFrame, group: str, variables: Sequence[str], column: str = "value") -> DataFrame:
    """Rows from documents that hold one array per variable under ``group``.

    ``time`` becomes date and, where it has one, hour.
    """
    schema = f"{group} struct<time: array<string>, " + ", ".join(f"{v}: array<double>" for v in variables) + ">"
    block = F.from_json(column, schema)[group]
    zipped = F.arrays_zip(*[block[name].alias(name) for name in ("time", *variables)])
    rows = docs.select(F.explode(zipped).alias("r")).select("r.*")
    hour = F.try_to_number(F.substring("time", 12, 2), F.lit("99")).cast("int")
    return rows.select(
        F.to_date(F.substring("time", 1, 10)).alias("date"),
        F.when(F.length("time") > 10, hour).alias("hour"),
        *variables,
    )


def hourly_weather(docs: DataFrame) -> DataFrame:
    return explode_columnar(docs, "hourly", HOURLY_WEATHER)


def daily_weather(docs: DataFrame) -> DataFrame:
    return explode_columnar(docs, "daily", DAILY_WEATHER).drop("hour")


def _as_ring(points: Column) -> Column:
    return F.transform(points, lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat")))


def read_zone_features(spark: SparkSession, path: str) -> DataFrame:
    """One row per feature of GeoJSON collections: id, name, borough, ``rings`` and ``holes``.

    Of each polygon the first ring is its shell and goes to ``rings``, the others are its holes.
    """
    docs = spark.read.schema(_GEOMETRY).option("multiLine", True).json(path)
    feature = docs.select(F.explode("features").alias("f")).select("f.properties.*", "f.geometry.*")
    one = F.array(F.from_json("coordinates", _POLYGON))
    many = F.from_json("coordinates", f"array<{_POLYGON}>")
    polygons = F.filter(F.when(F.col("type") == "Polygon", one).otherwise(many), lambda polygon: F.size(polygon) > 0)
    return computed_once(feature.select("id", "name", "borough", "type", "coordinates"), {"polygons": polygons}).select(
        "id", "name", "borough",
        F.transform("polygons", lambda polygon: _as_ring(polygon[0])).alias("rings"),
        F.transform("polygons", lambda polygon: F.transform(F.slice(polygon, F.lit(2), F.size(polygon)), _as_ring)).alias("holes"),
    )


def features_to_dim(features: DataFrame) -> DataFrame:
    """The zone dimension: one row per id, with the shells and holes of all its features.

    Features of one id are few: they are the polygons of a single zone.
    """
    return features.groupBy("id").agg(
        F.max("name").alias("name"),
        F.max("borough").alias("borough"),
        F.collect_list(F.struct("rings", "holes")).alias("parts"),
    ).select("id", "name", "borough", F.flatten("parts.rings").alias("rings"), F.flatten("parts.holes").alias("holes"))


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    return features_to_dim(read_zone_features(spark, path))


def keyed_encode(families: DataFrame) -> DataFrame:
    """Families as key and value text: ``Z|007|08`` and ``trips,milli_miles,seconds,cents``."""
    zone, dest = F.format_string("%03d", "zone"), F.format_string("%03d", "dest")
    hour, day = F.format_string("%02d", "hour"), F.date_format("day", "yyyy-MM-dd")
    parts = {"zone": zone, "dest": dest, "hour": hour, "day": day}
    key = None
    for kind, names in FAMILY_KEYS.items():
        text = F.concat_ws("|", F.lit(kind), *[parts[name] for name in names])
        test = F.col("kind") == kind
        key = F.when(test, text) if key is None else key.when(test, text)
    return families.select(key.alias("key"), F.concat_ws(",", *SUM4).alias("value"))


def keyed_decode(lines: DataFrame) -> DataFrame:
    """Back from key / value text; also reads reject lines (``Q|reason``). Bad lines raise."""
    part, number = F.split("key", r"\|"), F.split("value", ",")
    kind = part[0]
    at = {
        name: F.coalesce(*[
            F.when(kind == family, F.element_at(part, names.index(name) + 2))
            for family, names in FAMILY_KEYS.items() if name in names
        ])
        for name in ("zone", "hour", "day", "dest")
    }
    bad = F.when(
        ~kind.isin(*FAMILY_KEYS, "Q") | (F.size(number) != len(SUM4)),
        F.raise_error(F.concat(F.lit("bad aggregate line: "), "key", F.lit("\t"), "value")),
    )
    return lines.select(
        F.coalesce(bad.cast("string"), kind).alias("kind"),
        at["zone"].cast("int").alias("zone"),
        at["hour"].cast("int").alias("hour"),
        at["day"].cast("date").alias("day"),
        at["dest"].cast("int").alias("dest"),
        F.when(kind == "Q", part[1]).alias("reason"),
        *[number[i].cast("long").alias(name) for i, name in enumerate(SUM4)],
    )


def write_keyed(families: DataFrame, path: str) -> None:
    keyed_encode(families).select(F.concat_ws("\t", "key", "value").alias("value")).write.text(path)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    halves = F.split("value", "\t")
    return keyed_decode(spark.read.text(path).select(halves[0].alias("key"), halves[1].alias("value")))
