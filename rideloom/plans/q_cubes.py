"""Queries: month and year cubes, flows, rankings, run registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideloom.operators import cubes, flows, ranking
from rideloom.operators.families import additive_sum, day_totals, day_zone_hour
from rideloom.plans.catalog import query, r6
from rideloom.plans.sql import SUMS, WALK, with_views
from rideloom.plans.tables import HUBS, MONTH, Tables
from rideloom.sources import registry
from rideloom.workspace import cut_lineage

_MONTHS = """SELECT strftime(unnest(generate_series(date_trunc('month', min(day)), date_trunc('month', max(day)),
  INTERVAL 1 MONTH)), '%Y-%m') AS month FROM shipments"""


@query("month_stats", with_views("shipments", "runs", body=f"""
  SELECT m.month, CASE WHEN trips IS NULL THEN 'MISSING' ELSE 'ok' END AS status, coalesce(trips, 0) AS trips,
    coalesce(rejected, 0) AS rejected,
    CAST(coalesce(round_even(distance_milli_miles / 1000 * 1.609344::DOUBLE, 0), 0) AS BIGINT) AS distance_km,
    CAST(coalesce(round_even(cents / 100, 0), 0) AS BIGINT) AS revenue, run_id, elapsed_seconds
  FROM ({_MONTHS} UNION SELECT '2001-12') m
  LEFT JOIN (SELECT strftime(day, '%Y-%m') AS month, {SUMS} FROM shipments GROUP BY 1) s ON m.month = s.month
  LEFT JOIN (SELECT strftime(o_orderdate, '%Y-%m') AS month, CAST(count(*) AS BIGINT) AS rejected FROM orders
    WHERE o_orderstatus = 'F' GROUP BY 1) r ON m.month = r.month
  LEFT JOIN (SELECT month, run_id, elapsed_seconds FROM runs WHERE status = 'SUCCEEDED'
    QUALIFY row_number() OVER (PARTITION BY month ORDER BY started_at DESC, run_id DESC) = 1) l ON m.month = l.month"""))
def _(t: Tables) -> DataFrame:
    rejects = t.read("orders").filter("o_orderstatus = 'F'").groupBy(
        F.date_format("o_orderdate", "yyyy-MM").alias("month")
    ).agg(F.count("*").alias("rejected"))
    until = t.spark.range(1).select(F.lit("2001-12").alias("month"))
    sums = cut_lineage(cubes.monthly_sums(t.items), "monthly-sums")
    months = cubes.month_spine(sums.select("month").union(until))
    return cubes.month_stats(sums, rejects, months, ranking.latest_success_per_month(t.runs))


@query("month_quality", with_views("classified", body="""
  SELECT '2024-01' AS month, coalesce(reason, 'Valid') AS reason, CAST(count(*) AS BIGINT) AS rows
  FROM classified GROUP BY 1, 2"""))
def _(t: Tables) -> DataFrame:
    return cubes.month_quality(t.classified, MONTH)


@query("month_quality_map", with_views("classified", body="""
  SELECT month, CAST(sum(n) FILTER (WHERE reason = 'Valid') AS BIGINT) AS valid,
    CAST(coalesce(sum(n) FILTER (WHERE reason <> 'Valid'), 0) AS BIGINT) AS rejected,
    coalesce(string_agg(reason || '=' || n, ',' ORDER BY reason) FILTER (WHERE reason <> 'Valid'), '') AS reasons
  FROM (SELECT '2024-01' AS month, coalesce(reason, 'Valid') AS reason, count(*) AS n FROM classified
    GROUP BY 2) GROUP BY month"""))
def _(t: Tables) -> DataFrame:
    pairs = F.transform(F.array_sort(F.map_entries("reasons")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return cubes.month_quality_map(t.classified, MONTH).select("month", "valid", "rejected", F.array_join(pairs, ",").alias("reasons"))


@query("month_hour_matrix", with_views("demand", body="""
  SELECT month, CAST(range AS INTEGER) AS hour, CAST(coalesce(n, 0) AS BIGINT) AS trips
  FROM (SELECT DISTINCT strftime(date, '%Y-%m') AS month FROM demand) CROSS JOIN range(24)
  LEFT JOIN (SELECT strftime(date, '%Y-%m') AS m, hour, sum(trips) AS n FROM demand GROUP BY 1, 2)
    ON m = month AND hour = range"""))
def _(t: Tables) -> DataFrame:
    return cubes.month_hour_matrix(t.demand.withColumnRenamed("date", "day"))


_PIVOT = ", ".join(f"CAST(count(*) FILTER (WHERE hour = {h}) AS BIGINT) AS h{h}" for h in range(24))


@query("month_hour_pivot", with_views("trips", body=f"""
  SELECT strftime(day, '%Y-%m') AS month, {_PIVOT} FROM trips GROUP BY 1"""))
def _(t: Tables) -> DataFrame:
    return cubes.month_hour_pivot(t.trips)


@query("weekday_hour_matrix", with_views("tzh", body="""
  SELECT CAST(w.range AS INTEGER) AS weekday, CAST(h.range AS INTEGER) AS hour, CAST(coalesce(sum(trips), 0) AS BIGINT) AS trips
  FROM range(7) w CROSS JOIN range(24) h LEFT JOIN tzh ON isodow(day) - 1 = w.range AND hour = h.range GROUP BY 1, 2"""))
def _(t: Tables) -> DataFrame:
    return cubes.weekday_hour_matrix(day_zone_hour(t.trips))


@query("zone_month_matrix", with_views("shipments", body="""
  SELECT zone, month, CAST(coalesce(n, 0) AS BIGINT) AS trips
  FROM (SELECT DISTINCT zone FROM shipments) CROSS JOIN (SELECT DISTINCT strftime(day, '%Y-%m') AS month FROM shipments)
  LEFT JOIN (SELECT zone AS z, strftime(day, '%Y-%m') AS m, count(*) AS n FROM shipments GROUP BY 1, 2)
    ON z = zone AND m = month"""))
def _(t: Tables) -> DataFrame:
    return cubes.zone_month_matrix(t.shipments)


@query("zone_year", with_views("shipments", body="""
  SELECT zone, CAST(count(*) AS BIGINT) AS trips FROM shipments GROUP BY zone"""))
def _(t: Tables) -> DataFrame:
    return cubes.zone_year(t.shipments)


@query("day_curves", with_views("shipments", body="""
  SELECT strftime(day, '%Y-%m') AS month, string_agg(CAST(day AS VARCHAR) || '=' || n, ',' ORDER BY day) AS points
  FROM (SELECT day, count(*) AS n FROM shipments GROUP BY day) GROUP BY 1"""))
def _(t: Tables) -> DataFrame:
    text = F.transform("points", lambda p: F.concat_ws("=", p["day"].cast("string"), p["trips"].cast("string")))
    return cubes.day_curves(day_totals(t.items)).select("month", F.array_join(text, ",").alias("points"))


@query("year_kpis", with_views("shipments", body="""
  SELECT CAST(count(*) AS BIGINT) AS trips, round(count(*) / count(DISTINCT day), 6) AS trips_per_day,
    round(sum(distance_milli_miles) / 1000 * 1.609344::DOUBLE, 3) AS distance_km, round(sum(cents) / 100, 2) AS revenue
  FROM shipments"""))
def _(t: Tables) -> DataFrame:
    return cubes.year_kpis(t.items).select(
        "trips", r6("trips_per_day"), r6("distance_km", 3), r6("revenue", 2)
    )


_LONG = """SELECT CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month, CAST(count(*) AS BIGINT) AS trips,
  sum(distance_milli_miles) / 1000 AS distance, sum(cents) / 100 AS revenue FROM shipments GROUP BY 1, 2"""


@query("monthly_totals_long", with_views("shipments", body=f"""
  SELECT year, month, trips, round(distance, 3) AS distance, round(revenue, 2) AS revenue FROM ({_LONG})"""))
def _(t: Tables) -> DataFrame:
    return cubes.monthly_totals_long(t.items).select(
        "year", "month", "trips", r6("distance", 3), r6("revenue", 2)
    )


def _hourly_shipments(t: Tables) -> DataFrame:
    """Shipments with an hour made from the order line (dates carry none)."""
    return t.items.withColumn("hour", (F.col("cents") % 24).cast("int"))


_BY_YEAR = """SELECT {0} AS {1}, CAST(cents % 24 AS INTEGER) AS hour, CAST(count(*) AS BIGINT) AS trips,
  round(count(*) / count(DISTINCT year(day)), 6) AS avg_trips_per_year FROM shipments GROUP BY 1, 2"""


@query("hour_by_calendar_month", with_views("shipments", body=_BY_YEAR.format("CAST(month(day) AS INTEGER)", "month")))
def _(t: Tables) -> DataFrame:
    return cubes.hour_by_calendar_month(_hourly_shipments(t)).select("month", "hour", "trips", r6("avg_trips_per_year"))


@query("weekday_hour_long", with_views("shipments", body=_BY_YEAR.format("CAST(isodow(day) - 1 AS INTEGER)", "weekday")))
def _(t: Tables) -> DataFrame:
    return cubes.weekday_hour_long(_hourly_shipments(t)).select("weekday", "hour", "trips", r6("avg_trips_per_year"))


@query("yearly_totals", with_views("shipments", body="""
  SELECT CAST(year(day) AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS trips FROM shipments GROUP BY 1"""))
def _(t: Tables) -> DataFrame:
    return cubes.yearly_totals(t.items)


_TWELVE = ", ".join(f"CAST(count(*) FILTER (WHERE month(day) = {m}) AS BIGINT) AS m{m}" for m in range(1, 13))


@query("year_month_matrix", with_views("shipments", body=f"""
  SELECT CAST(year(day) AS INTEGER) AS year, {_TWELVE} FROM shipments GROUP BY 1"""))
def _(t: Tables) -> DataFrame:
    return cubes.year_month_matrix(t.items)


@query("pct_of_base_year", with_views("shipments", body=f"""
  SELECT year, month, trips, round(100 * trips / (SELECT sum(trips) / 12 FROM ({_LONG}) WHERE year = 1995), 6) AS pct_of_base
  FROM ({_LONG}) WHERE year BETWEEN 1995 AND 1997"""))
def _(t: Tables) -> DataFrame:
    monthly = cubes.monthly_totals_long(t.items).select("year", "month", "trips")
    return cubes.pct_of_base_year(monthly, 1995, (1995, 1997)).select("year", "month", "trips", r6("pct_of_base"))


@query("archive_manifest", with_views("shipments", body="""
  SELECT coalesce(CAST(year(day) AS INTEGER), 0) AS year, coalesce(CAST(month(day) AS INTEGER), 0) AS month,
    CAST(count(*) AS BIGINT) AS rows FROM shipments GROUP BY GROUPING SETS ((year(day), month(day)), ())"""))
def _(t: Tables) -> DataFrame:
    return cubes.archive_manifest(t.items).fillna(0)


# -- flows ---------------------------------------------------------------------------------------


@query("od_year", with_views("od", body="SELECT * FROM od"))
def _(t: Tables) -> DataFrame:
    dated = t.shipments.withColumn("month", cubes.month_of(F.col("day")))
    return flows.od_year(additive_sum(dated, ["month", "zone", "dest"]))


@query("od_pair_count", with_views("od", body="SELECT CAST(count(*) AS BIGINT) AS pairs, CAST(sum(trips) AS BIGINT) AS trips FROM od"))
def _(t: Tables) -> DataFrame:
    return flows.od_pair_count(t.od)


@query("top_od", with_views("od", body="SELECT * FROM od ORDER BY trips DESC, zone, dest LIMIT 200"))
def _(t: Tables) -> DataFrame:
    return flows.top_od(t.od, 200)


_BOROUGH_OD = """SELECT a.borough AS borough_o, b.borough AS borough_d, CAST(sum(trips) AS BIGINT) AS trips
  FROM od JOIN zones a ON zone = a.id JOIN zones b ON dest = b.id GROUP BY 1, 2"""


@query("borough_od_matrix", with_views("od", "zones", body=_BOROUGH_OD))
def _(t: Tables) -> DataFrame:
    return flows.borough_od_matrix(t.od, t.zones)


@query("hub_in_out", with_views("od", "zones", body="""
  SELECT id, name, CAST(coalesce((SELECT sum(trips) FROM od WHERE dest = id), 0) AS BIGINT) AS inbound,
    CAST(coalesce((SELECT sum(trips) FROM od WHERE zone = id), 0) AS BIGINT) AS outbound
  FROM zones WHERE name IN ('NATION_1', 'NATION_13', 'NATION_19')"""))
def _(t: Tables) -> DataFrame:
    return flows.hub_in_out(t.od, t.zones, HUBS)


@query("flow_split", with_views("od", "zones", body=f"""
  SELECT borough, CAST(sum(trips) FILTER (WHERE borough_o = borough_d) AS BIGINT) AS intra,
    CAST(sum(trips) FILTER (WHERE borough_o <> borough_d) AS BIGINT) AS "cross",
    round(100 * sum(trips) FILTER (WHERE borough_o <> borough_d) / (SELECT sum(trips) FROM od), 6) AS share_pct
  FROM ({_BOROUGH_OD}) m JOIN (SELECT DISTINCT borough FROM zones) b ON borough = borough_o OR borough = borough_d
  GROUP BY borough"""))
def _(t: Tables) -> DataFrame:
    return flows.flow_split(flows.borough_od_matrix(t.od, t.zones)).select("borough", "intra", "cross", r6("share_pct"))


@query("od_direction", with_views("directed", body="SELECT * FROM directed"))
def _(t: Tables) -> DataFrame:
    return flows.od_direction(t.od)


@query("od_backbone", with_views("ranked_links", body="SELECT 1", recursive=True).replace(
    "\nSELECT 1", f",\n{WALK}\nSELECT o AS origin, d AS destination, trips FROM ranked_links "
    "WHERE list_contains((SELECT kept FROM walk ORDER BY i DESC LIMIT 1), i)"))
def _(t: Tables) -> DataFrame:
    return flows.od_backbone(t.od, 25)


_NET = """net AS (SELECT id, sum(n) AS net FROM (SELECT zone AS id, trips AS n FROM od WHERE zone <> dest
  UNION ALL SELECT dest, -trips FROM od WHERE zone <> dest) GROUP BY id),
 place AS (SELECT id, row_number() OVER (ORDER BY net DESC, id) AS p FROM net)"""


@query("od_backbone_ranked", with_views("od", body="SELECT 1").replace("\nSELECT 1", f""",\n{_NET}
  SELECT zone AS origin, dest AS destination, trips FROM od JOIN place a ON zone = a.id JOIN place b ON dest = b.id
  WHERE a.p < b.p ORDER BY trips DESC, zone, dest LIMIT 25"""))
def _(t: Tables) -> DataFrame:
    return flows.od_backbone_ranked(t.od, 25)


@query("dedup_nodes", with_views("od", body="""
  SELECT DISTINCT unnest([zone, dest]) AS zone FROM (SELECT * FROM od ORDER BY trips DESC, zone, dest LIMIT 12)"""))
def _(t: Tables) -> DataFrame:
    top = flows.top_od(t.od, 12).select(F.col("zone").alias("origin"), F.col("dest").alias("destination"))
    return flows.dedup_nodes(top)


@query("group_internal_share", with_views("od", "zones", body="""
  SELECT CAST(sum(trips) AS BIGINT) AS trips, CAST(sum(trips) FILTER (WHERE g1 = g2) AS BIGINT) AS internal,
    round(100 * sum(trips) FILTER (WHERE g1 = g2) / sum(trips), 6) AS share_pct
  FROM (SELECT trips, CASE WHEN a.name LIKE '%\\_1_' ESCAPE '\\' THEN 'teens' WHEN a.name LIKE '%\\_2_' ESCAPE '\\' THEN 'twenties' ELSE 'x' END AS g1,
      CASE WHEN b.name LIKE '%\\_1_' ESCAPE '\\' THEN 'teens' WHEN b.name LIKE '%\\_2_' ESCAPE '\\' THEN 'twenties' ELSE 'x' END AS g2
    FROM (SELECT * FROM od WHERE zone <> dest ORDER BY trips DESC, zone, dest LIMIT 25) JOIN zones a ON zone = a.id
      JOIN zones b ON dest = b.id)"""))
def _(t: Tables) -> DataFrame:
    links = flows.top_od(t.od.filter("zone <> dest"), 25).select(
        F.col("zone").alias("origin"), F.col("dest").alias("destination"), "trips"
    )
    rules = (("_1[0-9]$", "teens"), ("_2[0-9]$", "twenties"))
    return flows.group_internal_share(links, t.zones, rules).select("trips", "internal", r6("share_pct"))


# -- rankings ------------------------------------------------------------------------------------


@query("top_zones_by_hour", with_views("zh", body="""
  SELECT zone, CAST(range AS INTEGER) AS hour, CAST(coalesce(trips, 0) AS BIGINT) AS trips
  FROM (SELECT zone FROM zh GROUP BY zone ORDER BY sum(trips) DESC, zone LIMIT 20) CROSS JOIN range(24)
  LEFT JOIN (SELECT zone AS z, hour, trips FROM zh) ON z = zone AND hour = range"""))
def _(t: Tables) -> DataFrame:
    return ranking.top_zones_by_hour(t.zh, 20)


@query("argmax_zone", with_views("tzh", body="""
  SELECT CAST(day AS VARCHAR) AS day, zone, hour, trips FROM tzh
  WHERE zone = (SELECT zone FROM tzh GROUP BY zone ORDER BY sum(trips) DESC, zone LIMIT 1)"""))
def _(t: Tables) -> DataFrame:
    return ranking.argmax_zone(t.tzh).select("day", "zone", "hour", "trips")


# -- registry ------------------------------------------------------------------------------------

_RUN = "run_id, month, reducers, combiner, fail_first, status, started_at, elapsed_seconds"


@query("run_registry", with_views("runs", body="""
  SELECT run_id, month, CASE status WHEN 'RUNNING' THEN 'FAILED' ELSE status END AS status, started_at,
    CASE status WHEN 'RUNNING' THEN 'Interrupted by restart' ELSE '' END AS error
  FROM runs ORDER BY started_at DESC, run_id DESC LIMIT 30"""))
def _(t: Tables) -> DataFrame:
    return registry.run_registry(t.runs).select(
        "run_id", "month", "status", "started_at", F.coalesce("error", F.lit("")).alias("error")
    )


@query("month_catalog", with_views("manifests", body="SELECT * FROM manifests"))
def _(t: Tables) -> DataFrame:
    return registry.month_catalog(t.manifests)


@query("latest_success_per_month", with_views("runs", body=f"""
  SELECT {_RUN} FROM runs WHERE status = 'SUCCEEDED'
  QUALIFY row_number() OVER (PARTITION BY month ORDER BY started_at DESC, run_id DESC) = 1"""))
def _(t: Tables) -> DataFrame:
    return ranking.latest_success_per_month(t.runs)


@query("earliest_run_per_month", with_views("plain_runs", body=f"""
  SELECT {_RUN} FROM plain_runs QUALIFY row_number() OVER (PARTITION BY month ORDER BY started_at, run_id) = 1"""))
def _(t: Tables) -> DataFrame:
    return ranking.earliest_run_per_month(t.runs)


@query("latest_matching_run", with_views("plain_runs", body=f"""
  SELECT {_RUN} FROM plain_runs WHERE month = '1997-05'
  QUALIFY row_number() OVER (PARTITION BY month ORDER BY started_at DESC, run_id DESC) = 1"""))
def _(t: Tables) -> DataFrame:
    return ranking.latest_matching_run(t.runs, {"month": "1997-05"})


@query("runs_with_rows", with_views("plain_runs", "manifests", body="""
  SELECT r.month, elapsed_seconds, rows FROM (SELECT * FROM plain_runs
    QUALIFY row_number() OVER (PARTITION BY month ORDER BY started_at, run_id) = 1) r
  JOIN manifests m ON r.month = m.month"""))
def _(t: Tables) -> DataFrame:
    return ranking.runs_with_rows(t.runs, t.manifests)


@query("months_with_input", with_views("runs", "manifests", body="""
  SELECT DISTINCT month FROM runs WHERE month IN (SELECT month FROM manifests)"""))
def _(t: Tables) -> DataFrame:
    return cubes.months_with_input(t.runs.select("month").distinct(), t.manifests)


@query("missing_months", with_views("plain_runs", "manifests", body="""
  SELECT month FROM manifests WHERE month NOT IN (SELECT month FROM plain_runs WHERE elapsed_seconds > 100)"""))
def _(t: Tables) -> DataFrame:
    return cubes.missing_months(t.manifests.select("month"), ranking.standard_runs(t.runs).filter("elapsed_seconds > 100"))
