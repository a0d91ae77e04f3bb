"""Queries through sources and sinks: written to the shared folder, read back, and compared."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rideloom.operators import families as fam
from rideloom.operators.grid import HOURLY_WEATHER
from rideloom.operators.quality import classify_rejects, reject_histogram, typed_parse
from rideloom.operators.sets import union_months
from rideloom.plans.catalog import query, r6
from rideloom.plans.q_quality import _NO_NULL_KEYS, flat_families
from rideloom.plans.sql import with_views
from rideloom.plans.tables import MONTH, RULES, Tables
from rideloom.schema import RAW_FIELDS, SUM4
from rideloom.sources import archive, documents, drift, hashtree, manifest, publish, registry, snapshots, trips
from rideloom.workspace import fresh_folder


@query("scan_projected", """
  SELECT l_orderkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate
  FROM lineitem""")
def _(t: Tables) -> DataFrame:
    return trips.read_trips(
        t.spark, t.path("lineitem"), ("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")
    )


@query("scan_raw_csv", with_views("classified", body="""
  SELECT CASE WHEN bad THEN 'Malformed' ELSE reason END AS reason, CAST(count(*) AS BIGINT) AS rows
  FROM (SELECT *, event_id % 97 = 0 OR event_id % 101 = 0 OR event_id % 103 = 0 AS bad FROM classified)
  WHERE bad OR reason IS NOT NULL GROUP BY 1"""))
def _(t: Tables) -> DataFrame:
    """Lines of five and seven fields and blank ones among the regular ones."""
    line = F.when(F.col("event_id") % 97 == 0, F.concat_ws(",", *RAW_FIELDS[:5])).when(
        F.col("event_id") % 101 == 0, F.concat_ws(",", *RAW_FIELDS, F.lit("extra"))
    ).when(F.col("event_id") % 206 == 0, "").when(F.col("event_id") % 103 == 0, " \t").otherwise(
        F.concat_ws(",", *RAW_FIELDS))
    path = fresh_folder(t.spark, "lines")
    t.raw.select(line.alias("value")).write.text(path)
    lines = trips.read_raw(t.spark, path)
    return reject_histogram(classify_rejects(typed_parse(lines), MONTH, RULES))


def _shards(t: Tables, rows: int = 1000) -> str:
    path = fresh_folder(t.spark, "shards")
    trips.write_shards(trips.as_lines(t.raw.select(*RAW_FIELDS)), path, rows)
    return path


@query("write_shards", with_views("classified", body="""
  SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (WHERE reason IS NULL) AS BIGINT) AS valid, TRUE AS bounded
  FROM classified"""))
def _(t: Tables) -> DataFrame:
    path = _shards(t)
    back = classify_rejects(typed_parse(trips.read_raw(t.spark, path)), MONTH, RULES)
    largest = manifest.shard_manifest(t.spark, path).agg(F.max("rows")).scalar()
    return back.agg(F.count("*").alias("rows"), F.count_if(F.col("reason").isNull()).alias("valid")).withColumn(
        "bounded", largest <= 1000
    )


@query("shard_manifest", """
  SELECT CAST(count(*) AS BIGINT) AS rows, TRUE AS distinct_names, TRUE AS hashed FROM events""")
def _(t: Tables) -> DataFrame:
    return manifest.shard_manifest(t.spark, _shards(t)).agg(
        F.sum("rows").alias("rows"),
        (F.count_distinct("name") == F.count("*")).alias("distinct_names"),
        F.bool_and(F.length("sha256") == 64).alias("hashed"),
    )


@query("verify_manifest", """
  SELECT status, CAST(1 AS BIGINT) AS shards FROM (VALUES ('corrupted'), ('unexpected')) v(status)""")
def _(t: Tables) -> DataFrame:
    """Differences against a manifest in which one hash was altered and one shard is unknown."""
    path = _shards(t, 200)
    true = manifest.shard_manifest(t.spark, path)
    manifest.verify_manifest(t.spark, path, true, rows=None)
    first = true.agg(F.min("name")).scalar()
    last = true.agg(F.max("name")).scalar()
    altered = true.filter(F.col("name") != last).withColumn(
        "sha256", F.when(F.col("name") == first, F.reverse("sha256")).otherwise(F.col("sha256"))
    )
    return manifest.manifest_differences(t.spark, path, altered).groupBy("status").agg(F.count("*").alias("shards"))


@query("manifest_document", f"""
  SELECT '{MONTH}' AS month, CAST(count(*) AS BIGINT) AS source_rows, CAST(least(count(*), 700) AS BIGINT) AS rows,
    CAST(700 AS INTEGER) AS requested_rows, CAST(100 AS INTEGER) AS shard_rows, '{", ".join(RAW_FIELDS)}' AS columns, TRUE AS whole, TRUE AS refused
  FROM events""")
def _(t: Tables) -> DataFrame:
    """A dataset of the first 700 rows, opened twice; a request for other rows is refused."""
    folder = fresh_folder(t.spark, "dataset")
    request = hashtree.Request(MONTH, "events", 700, 100, RAW_FIELDS)

    def make() -> int:
        trips.write_shards(trips.head_sample(t.raw, ("event_id",), 700).select(*RAW_FIELDS), folder, 100)
        return t.raw.count()

    hashtree.open_dataset(t.spark, folder, request, make, chunk_bytes=1000)
    found = hashtree.open_dataset(t.spark, folder, request, make, chunk_bytes=1000)
    try:
        hashtree.open_dataset(t.spark, folder, replace(request, requested_rows=0), make)
        refused = False
    except hashtree.OtherRequest:
        refused = True
    shards = hashtree.shard_digests(hashtree.known_chunks(t.spark, folder))
    return shards.agg(F.sum("rows").alias("rows"), (F.sum("bytes") == found["bytes"]).alias("whole")).select(
        F.lit(found["month"]).alias("month"), F.lit(found["source_rows"]).cast("long").alias("source_rows"), "rows",
        F.lit(found["requested_rows"]).alias("requested_rows"), F.lit(found["shard_rows"]).alias("shard_rows"),
        F.lit(", ".join(found["columns"])).alias("columns"), "whole", F.lit(refused).alias("refused"))


@query("chunk_differences", """
  SELECT * FROM (VALUES ('corrupted', CAST(2 AS BIGINT)), ('missing', CAST(0 AS BIGINT)), ('unexpected', CAST(1 AS BIGINT))) v(status, chunk)""")
def _(t: Tables) -> DataFrame:
    """All events as shards against a manifest with one altered, one lacking and one invented chunk."""
    folder = fresh_folder(t.spark, "dataset")
    trips.write_shards(t.raw.select(*RAW_FIELDS), folder, 5000)
    hashtree.publish_manifest(t.spark, folder, hashtree.Request(MONTH, "events", 0, 5000, RAW_FIELDS), t.raw.count(), chunk_bytes=16_000)
    known = hashtree.known_chunks(t.spark, folder)
    first = known.agg(F.min("name")).scalar()
    altered = known.filter((F.col("name") != first) | (F.col("chunk") != 1)).withColumn("sha256", F.when(
        (F.col("name") == first) & (F.col("chunk") == 2), F.reverse("sha256")).otherwise(F.col("sha256")))
    invented = known.limit(1).withColumns({"name": F.lit("part-none"), "chunk": F.lit(0).cast("long")})
    return hashtree.chunk_differences(t.spark, folder, altered.unionByName(invented)).select("status", "chunk")


@query("fingerprint_publish", with_views("trips", body="""
  SELECT event_id, zone, dest, hour, CAST(day AS VARCHAR) AS day, distance_milli_miles, seconds, cents, FALSE AS again FROM trips"""))
def _(t: Tables) -> DataFrame:
    shards = manifest.shard_manifest(t.spark, _shards(t))
    root, rows = fresh_folder(t.spark, "published"), t.trips.drop("pickup")
    manifest.publish_once(rows, shards, root)
    target, again = manifest.publish_once(rows, shards, root)
    return t.spark.read.parquet(target).withColumn("again", F.lit(again))


@query("head_sample", """
  SELECT event_id, event_type, value FROM events ORDER BY ts, event_id LIMIT 500""")
def _(t: Tables) -> DataFrame:
    return trips.head_sample(t.events, ("ts", "event_id"), 500).select("event_id", "event_type", "value")


@query("normalize_schema_drift", f"""
  SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS pickup, CAST(user_id AS DOUBLE) AS pu, round(value, 6) AS miles
  FROM events WHERE event_id % 3 < 2""")
def _(t: Tables) -> DataFrame:
    """Three generations of files: renamed, re-typed, and one lacking a column."""
    base = t.events.select("event_id", "ts", "user_id", "value")
    third = F.col("event_id") % 3
    first = base.filter(third == 0).select(
        F.col("ts").alias("tpep_pickup_datetime"), F.col("ts").alias("tpep_dropoff_datetime"),
        F.col("user_id").cast("int").alias("PULocationID"), F.col("user_id").alias("DOLocationID"),
        F.col("value").alias("trip_distance"), F.col("value").alias("total_amount"),
    )
    second = base.filter(third == 1).select(
        F.col("ts").alias("lpep_pickup_datetime"), F.col("ts").cast("string").alias("lpep_dropoff_datetime"),
        F.col("user_id").cast("double").alias("PULocationID"), F.col("user_id").cast("string").alias("DOLocationID"),
        F.col("value").cast("string").alias("trip_distance"), F.col("value").alias("total_amount"),
    )
    lacking = base.filter(third == 2).select(F.col("ts").alias("tpep_pickup_datetime"), F.col("value").alias("total_amount"))
    return archive.normalize_schema_drift([first, second, lacking]).select("pickup", "pu", r6("miles"))


@query("scan_drifting_files", f"""
  SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS pickup, CAST(user_id AS DOUBLE) AS pu, round(value, 6) AS miles
  FROM events WHERE event_id % 4 < 3""")
def _(t: Tables) -> DataFrame:
    """Some hundred small files of four schemas, one of them without the needed columns; three scans."""
    base, path = t.events, fresh_folder(t.spark, "drifting")
    kinds = [("tpep_pickup_datetime", "tpep_dropoff_datetime", "long", "double"), ("lpep_pickup_datetime", "lpep_dropoff_datetime", "double", "string"),
             ("pickup", "dropoff", "int", "float")]
    for n, (pickup, dropoff, zone, amount) in enumerate(kinds):
        rows = base.filter(F.col("event_id") % 4 == n).select(
            F.col("ts").alias(pickup), F.col("ts").alias(dropoff), F.col("user_id").cast(zone).alias("PULocationID"),
            F.col("user_id").cast(zone).alias("DOLocationID"), F.col("value").alias("trip_distance"),
            F.col("value").cast(amount).alias("total_amount"), "event_type")
        rows.repartition(60, "event_type", pickup).write.parquet(f"{path}/source-{n}")
    base.filter("event_id % 4 = 3").select(F.col("ts").alias("pickup"), "value").repartition(20).write.parquet(f"{path}/source-3")
    return drift.read_drifting(t.spark, path).select("pickup", "pu", r6("miles"))


@query("archive_snapshots", with_views("shipments", body="""
  SELECT * FROM (WITH dated AS (SELECT strftime(day, '%Y-%m') AS ym, year(day) AS y, month(day) AS m, cents FROM shipments)
  SELECT CAST(v.version AS INTEGER) AS version, CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month, CAST(count(*) AS BIGINT) AS rows,
    CAST(sum(CASE WHEN v.version >= 2 AND ym = '1997-03' THEN 2 * cents ELSE cents END) AS BIGINT) AS cents
  FROM dated CROSS JOIN (VALUES (1), (2), (3)) v(version) WHERE NOT (v.version = 3 AND ym = '1998-05') GROUP BY ALL)"""))
def _(t: Tables) -> DataFrame:
    """Three versions of an archive: all months, one month with doubled cents, another one emptied."""
    root, rows = fresh_folder(t.spark, "snapshots"), t.shipments.withColumn("hour", (F.col("cents") % 24).cast("int"))
    snapshots.replace_months(rows, root)
    march = snapshots.read_months(t.spark, root, months=("1997-03", "1997-03")).drop("year", "month")
    snapshots.replace_months(march.withColumn("cents", F.col("cents") * 2), root, ["1997-03"], based_on=1)
    snapshots.replace_months(march.limit(0), root, ["1998-05"])
    counted = [snapshots.read_months(t.spark, root, v).groupBy("year", "month").agg(
        F.count("*").alias("rows"), F.sum("cents").alias("cents")).withColumn("version", F.lit(v)) for v in (1, 2, 3)]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def _archive(t: Tables) -> str:
    path = fresh_folder(t.spark, "archive")
    hourly = t.shipments.withColumn("hour", (F.col("cents") % 24).cast("int"))
    archive.write_archive(hourly, path)
    return path


@query("write_partitioned", with_views("shipments", body="""
  SELECT kind, CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month, CAST(count(*) AS BIGINT) AS rows,
    CAST(sum(cents) AS BIGINT) AS cents FROM shipments CROSS JOIN (VALUES ('Z'), ('D'), ('O'), ('T')) k(kind) GROUP BY 1, 2, 3"""))
def _(t: Tables) -> DataFrame:
    """Every kind sees every row, of which there is one copy."""
    months = archive.read_archive(t.spark, _archive(t)).groupBy("year", "month").agg(
        F.count("*").alias("rows"), F.sum("cents").alias("cents")
    )
    return months.select(F.explode(F.array(*map(F.lit, archive.KIND_COLUMNS))).alias("kind"), "*")


@query("scan_partitioned", with_views("shipments", body=f"""
  SELECT CAST(cents % 24 AS INTEGER) AS hour, zone, CAST(count(*) AS BIGINT) AS trips FROM shipments
  WHERE year(day) BETWEEN 1996 AND 1997 GROUP BY 1, 2"""))
def _(t: Tables) -> DataFrame:
    return archive.read_archive(t.spark, _archive(t), "T", (1996, 1997)).groupBy("hour", "zone").agg(
        F.count("*").alias("trips")
    )


@query("columnar_json_explode", with_views("weather_h", body=f"""
  SELECT CAST(date AS VARCHAR) AS date, hour, {", ".join(HOURLY_WEATHER)} FROM weather_h"""))
def _(t: Tables) -> DataFrame:
    """One document per day, an array of hours per variable."""
    stamp = F.concat(F.date_format("date", "yyyy-MM-dd"), F.format_string("T%02d:00", "hour")).alias("time")
    ordered = F.array_sort(F.collect_list(F.struct(stamp, *HOURLY_WEATHER)))
    columns = F.struct(*[F.col(f"rows.{name}").alias(name) for name in ("time", *HOURLY_WEATHER)])
    docs = t.weather_h.groupBy("date").agg(ordered.alias("rows")).select(
        F.to_json(F.struct(columns.alias("hourly"))).alias("value")
    )
    path = fresh_folder(t.spark, "weather")
    docs.write.text(path)
    return documents.hourly_weather(t.spark.read.text(path))


@query("features_to_dim", with_views("zones", body=f"""
  SELECT id, name, borough, CAST(CASE WHEN id % 4 = 0 OR id = 1 THEN 2 ELSE 1 END AS INTEGER) AS rings, round(x0, 6) AS x0 FROM zones"""))
def _(t: Tables) -> DataFrame:
    """One GeoJSON collection per borough; every fourth zone is a multi-polygon, zone 1 occurs twice."""
    def ring(dx: float):
        x, y = F.col("x0") + dx, F.col("y0")
        return F.array(F.array(x, y), F.array(x + 0.05, y), F.array(x + 0.05, y + 0.05), F.array(x, y))

    single = F.struct(F.lit("Polygon").alias("type"), F.to_json(F.array(ring(0.0))).alias("coordinates"))
    many = F.struct(
        F.lit("MultiPolygon").alias("type"), F.to_json(F.array(F.array(ring(0.0)), F.array(ring(0.06)))).alias("coordinates")
    )
    shape = F.when(F.col("id") % 4 == 0, many).otherwise(single)
    feature = F.format_string(
        '{"type":"Feature","properties":%s,"geometry":{"type":"%s","coordinates":%s}}',
        F.to_json(F.struct("id", "name", "borough")), shape["type"], shape["coordinates"],
    )
    twice = F.when(F.col("id") == 1, F.concat_ws(",", feature, feature)).otherwise(feature)
    docs = t.zones.groupBy("borough").agg(F.concat_ws(",", F.collect_list(twice)).alias("f")).select(
        F.concat(F.lit('{"type":"FeatureCollection","features":['), "f", F.lit("]}")).alias("value")
    )
    path = fresh_folder(t.spark, "geojson")
    docs.write.option("maxRecordsPerFile", 1).text(path)
    dim = documents.read_zones(t.spark, path)
    first = F.element_at(F.element_at("rings", 1), 1)
    return dim.select("id", "name", "borough", F.size("rings").alias("rings"), r6(first["lon"]).alias("x0"))


@query("zone_ring_roles", with_views("zones", body="""
  SELECT id, CAST(polygon AS INTEGER) AS polygon, CAST(ring AS INTEGER) AS ring, CASE WHEN ring = 0 THEN 'shell' ELSE 'hole' END AS role,
    CAST(4 AS INTEGER) AS vertices, round(x0 + polygon * 0.06 + ring * 0.01, 6) AS lon, round(y0 + ring * 0.01, 6) AS lat
  FROM zones, range(2) p(polygon), range(3) r(ring)
  WHERE (polygon = 0 OR id % 4 = 0) AND ring <= (id + polygon) % 3"""))
def _(t: Tables) -> DataFrame:
    """GeoJSON with up to two polygons a zone and up to two holes in each, by shell and hole."""
    def polygon(k: int) -> Column:
        rings = [
            F.array(*[F.array(F.col("x0") + 0.06 * k + 0.01 * r + dx, F.col("y0") + 0.01 * r + dy)
                      for dx, dy in ((0.0, 0.0), (0.05 / (r + 1), 0.0), (0.05 / (r + 1), 0.05 / (r + 1)), (0.0, 0.0))])
            for r in range(3)]
        return F.slice(F.array(*rings), F.lit(1), (F.col("id") + k) % 3 + 1)

    multi = F.col("id") % 4 == 0
    coordinates = F.when(multi, F.to_json(F.array(polygon(0), polygon(1)))).otherwise(F.to_json(polygon(0)))
    feature = F.format_string(
        '{"type":"Feature","properties":%s,"geometry":{"type":"%s","coordinates":%s}}',
        F.to_json(F.struct("id", "name", "borough")), F.when(multi, "MultiPolygon").otherwise("Polygon"), coordinates)
    docs = t.zones.groupBy("borough").agg(F.concat_ws(",", F.collect_list(feature)).alias("f")).select(
        F.concat(F.lit('{"type":"FeatureCollection","features":['), "f", F.lit("]}")).alias("value"))
    path = fresh_folder(t.spark, "geojson")
    docs.write.option("maxRecordsPerFile", 1).text(path)
    dim = documents.read_zones(t.spark, path)
    polygons = dim.select("id", F.posexplode(F.arrays_zip("rings", "holes")).alias("polygon", "p"))
    rings = polygons.select("id", "polygon", F.posexplode(F.concat(F.array("p.rings"), "p.holes")).alias("ring", "points"))
    return rings.select(
        "id", "polygon", "ring", F.when(F.col("ring") == 0, "shell").otherwise("hole").alias("role"),
        F.size("points").alias("vertices"), F.round(F.col("points")[0]["lon"], 6).alias("lon"), F.round(F.col("points")[0]["lat"], 6).alias("lat"))


_KEYED = """SELECT CASE kind WHEN 'Z' THEN 'Z|' || lpad(CAST(zone AS VARCHAR), 3, '0') || '|' || lpad(CAST(hour AS VARCHAR), 2, '0')
    WHEN 'D' THEN 'D|' || CAST(day AS VARCHAR)
    WHEN 'O' THEN 'O|' || lpad(CAST(zone AS VARCHAR), 3, '0') || '|' || lpad(CAST(dest AS VARCHAR), 3, '0')
    ELSE 'T|' || CAST(day AS VARCHAR) || '|' || lpad(CAST(zone AS VARCHAR), 3, '0') || '|' || lpad(CAST(hour AS VARCHAR), 2, '0')
  END AS key, concat_ws(',', trips, distance_milli_miles, seconds, cents) AS value FROM families"""


@query("keyed_encode", with_views("families", body=_KEYED))
def _(t: Tables) -> DataFrame:
    return documents.keyed_encode(fam.key_families(t.trips))


@query("emit_keys", with_views("families", body=_KEYED))
def _(t: Tables) -> DataFrame:
    """Keyed lines of a monthly job's families, from cells that carry rejects too."""
    return documents.keyed_encode(fam.split_cells(fam.classified_cuboid(t.classified))[0])


@query("keyed_decode", with_views("families", body=f"SELECT {_NO_NULL_KEYS} FROM families"))
def _(t: Tables) -> DataFrame:
    path = fresh_folder(t.spark, "keyed")
    documents.write_keyed(fam.key_families(t.trips), path)
    return flat_families(documents.read_keyed(t.spark, path).drop("reason"))


@query("split_by_kind", with_views("tzh", body="""
  SELECT CAST(day AS VARCHAR) AS day, zone, hour, trips, distance_milli_miles, seconds, cents FROM tzh"""))
def _(t: Tables) -> DataFrame:
    path = fresh_folder(t.spark, "families")
    publish.write_families(fam.key_families(t.trips), path)
    return fam.family(t.spark.read.parquet(path), "T")


@query("export_zone_csv", with_views("zh", "zones", body="""
  SELECT id, name, borough, CAST(sum(trips) AS BIGINT) AS trips,
    round(sum(distance_milli_miles) / 1000 * 1.609344::DOUBLE / sum(trips), 6) AS avg_distance_km,
    round(sum(seconds) / 60 / sum(trips), 6) AS avg_minutes, round(sum(cents) / 100 / sum(trips), 6) AS avg_amount
  FROM zh JOIN zones ON zone = id WHERE borough = 'ASIA' GROUP BY 1, 2, 3"""))
def _(t: Tables) -> DataFrame:
    path = fresh_folder(t.spark, "export")
    publish.export_zone_csv(fam.zone_hour(t.trips), t.zones, path, borough="ASIA")
    back = t.spark.read.option("header", True).schema(
        "id int, name string, borough string, trips long, avg_distance_km double, avg_minutes double, avg_amount double"
    ).csv(path)
    return back.select("id", "name", "borough", "trips", r6("avg_distance_km"), r6("avg_minutes"), r6("avg_amount"))


@query("expire_runs", with_views("families", body="""
  SELECT kind, CAST(sum(trips) AS BIGINT) AS trips, CAST(count(*) AS BIGINT) AS rows, CAST(1 AS INTEGER) AS removed FROM families GROUP BY kind"""))
def _(t: Tables) -> DataFrame:
    """A month published twice: the first run is removed, the second one is whole."""
    root, families = fresh_folder(t.spark, "retention"), fam.key_families(t.trips)
    publish.publish_result(families.filter("kind = 'D'"), MONTH, root)
    publish.publish_result(families, MONTH, root)
    gone = publish.expire_runs(t.spark, root, min_age=0)
    return publish.read_result(t.spark, root, MONTH).groupBy("kind").agg(
        F.sum("trips").alias("trips"), F.count("*").alias("rows")).withColumn("removed", F.lit(len(gone)))


@query("publish_result", with_views("families", body=f"SELECT {_NO_NULL_KEYS} FROM families"))
def _(t: Tables) -> DataFrame:
    """Publish an earlier month and this one twice; read the latest."""
    root, result = fresh_folder(t.spark, "results"), fam.key_families(t.trips)
    publish.publish_result(result.filter("kind = 'D'"), "2023-12", root)
    publish.publish_result(result.filter("kind = 'Z'"), MONTH, root)
    publish.publish_result(result, MONTH, root)
    return flat_families(publish.read_result(t.spark, root).select("kind", "zone", "hour", "day", "dest", *SUM4))


@query("monthly_job", with_views("families", body=f"SELECT {_NO_NULL_KEYS} FROM families"))
def _(t: Tables) -> DataFrame:
    """The whole monthly pipeline from text fields to published families."""
    root = fresh_folder(t.spark, "month")
    publish.run_month(t.raw, MONTH, root, RULES)
    return flat_families(publish.read_result(t.spark, root, MONTH).select("kind", "zone", "hour", "day", "dest", *SUM4))


@query("republished_month", with_views("classified", body="""
  SELECT run, CAST(n AS BIGINT) AS input, CAST(v AS BIGINT) AS valid, CAST(n - v AS BIGINT) AS rejected, reasons FROM (
    SELECT 1 AS run, count(*) AS n, count(*) FILTER (WHERE reason IS NULL) AS v,
      (SELECT string_agg(reason || '=' || k, ',' ORDER BY reason) FROM (SELECT reason, count(*) AS k FROM classified
        WHERE reason IS NOT NULL GROUP BY 1)) AS reasons FROM classified
    UNION ALL SELECT 2, count(*), count(*), '' FROM classified WHERE reason IS NULL)"""))
def _(t: Tables) -> DataFrame:
    """A month with rejects, then the same month run again on its valid lines: nothing of the first run stays."""
    root = fresh_folder(t.spark, "republished")
    clean = t.classified.filter(F.col("reason").isNull()).select(*RAW_FIELDS)
    told = []
    for run, raw in enumerate((t.raw.select(*RAW_FIELDS), clean), start=1):
        publish.run_month(raw, MONTH, root, RULES)
        pairs = F.transform(F.map_entries("reasons"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
        told.append(publish.analysis(t.spark, root, t.zones)["quality"].select(
            F.lit(run).alias("run"), "input", "valid", "rejected", F.array_join(F.array_sort(pairs), ",").alias("reasons")))
    return told[0].unionByName(told[1])


@query("analysis", with_views("zh", "days", "trips", "zones", "classified", body=f"""
  SELECT 'zone' AS section, CAST(zone AS VARCHAR) AS key, CAST(sum(trips) AS BIGINT) AS trips FROM zh GROUP BY zone
  UNION ALL SELECT 'zone ASIA 8', CAST(zone AS VARCHAR), trips FROM zh JOIN zones ON zone = id WHERE borough = 'ASIA' AND hour = 8
  UNION ALL SELECT 'hour', CAST(range AS VARCHAR), CAST(coalesce(sum(trips), 0) AS BIGINT) FROM range(24)
    LEFT JOIN zh ON hour = range GROUP BY range
  UNION ALL SELECT 'day', CAST(day AS VARCHAR), trips FROM days
  UNION ALL SELECT 'od', zone || '-' || dest, n FROM (SELECT zone, dest, CAST(count(*) AS BIGINT) AS n FROM trips GROUP BY 1, 2
    ORDER BY n DESC, zone, dest LIMIT 10)
  UNION ALL SELECT 'summary', '', CAST(count(*) AS BIGINT) FROM trips
  UNION ALL SELECT 'input', '', CAST(count(*) AS BIGINT) FROM classified
  UNION ALL SELECT 'rejected', '', CAST(count(*) AS BIGINT) FROM classified WHERE reason IS NOT NULL"""))
def _(t: Tables) -> DataFrame:
    """The views of a published month in long form."""
    root = fresh_folder(t.spark, "analysis")
    publish.run_month(t.raw, MONTH, root, RULES)
    whole = publish.analysis(t.spark, root, t.zones)
    part = publish.analysis(t.spark, root, t.zones, MONTH, hour=8, borough="ASIA")

    def section(name: str, df: DataFrame, key, trips: str = "trips") -> DataFrame:
        return df.select(F.lit(name).alias("section"), key.cast("string").alias("key"), F.col(trips).alias("trips"))

    return union_months(
        section("zone", whole["zones"], F.col("id")),
        section("zone ASIA 8", part["zones"], F.col("id")),
        section("hour", whole["hourly"], F.col("hour")),
        section("day", whole["days"], F.col("day")),
        section("od", whole["top_od"], F.concat_ws("-", "zone", "dest")),
        section("summary", whole["summary"], F.lit("")),
        section("input", part["quality"], F.lit(""), "input"),
        section("rejected", part["quality"], F.lit(""), "rejected"),
    )


@query("read_runs", with_views("runs", body="""
  SELECT run_id, month, reducers, combiner, fail_first, CASE status WHEN 'RUNNING' THEN 'FAILED' ELSE status END AS status,
    started_at, elapsed_seconds FROM runs"""))
def _(t: Tables) -> DataFrame:
    path = fresh_folder(t.spark, "runs")
    t.runs.write.json(path)
    lines = t.spark.read.schema(registry.RUN_SCHEMA).json(path)
    return registry.reconcile_interrupted(lines).select(
        "run_id", "month", "reducers", "combiner", "fail_first", "status", "started_at", "elapsed_seconds"
    )
