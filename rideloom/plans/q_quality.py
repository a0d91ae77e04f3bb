"""Queries: validation, projections, key families, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rideloom.functions import calendar, classify, measures
from rideloom.operators import families as fam
from rideloom.operators import quality, summary, verify
from rideloom.operators.dimension import compare_keyed, enrich_od, enrich_zone, scope_filter
from rideloom.operators.sets import duplicate_keys, symmetric_difference, union_months
from rideloom.plans.catalog import query, r6
from rideloom.plans.sql import SUMS, with_views
from rideloom.plans.tables import MONTH, RULES, Tables
from rideloom.schema import REASONS, month_arg_guard
from rideloom.workspace import cut_lineage

_NO_NULL_KEYS = (
    "kind, coalesce(zone, -1) AS zone, coalesce(hour, -1) AS hour, coalesce(CAST(day AS VARCHAR), '') AS day, "
    "coalesce(dest, -1) AS dest, trips, distance_milli_miles, seconds, cents"
)


def flat_families(df: DataFrame) -> DataFrame:
    """Families with -1 / '' in place of the keys a family does not have."""
    return df.withColumn("day", F.date_format("day", "yyyy-MM-dd")).fillna({"zone": -1, "hour": -1, "dest": -1, "day": ""})


@query("typed_parse", with_views("typed", body="""
  SELECT event_id, strftime(pickup, '%Y-%m-%d %H:%M:%S') AS pickup, strftime(dropoff, '%Y-%m-%d %H:%M:%S') AS dropoff,
    CASE WHEN isnan(pu) THEN -1 ELSE coalesce(pu, -2) END AS pu, do_, round(miles, 6) AS miles, round(amount, 6) AS amount
  FROM typed"""))
def _(t: Tables) -> DataFrame:
    pu = F.when(F.isnan("pu"), -1.0).otherwise(F.coalesce("pu", F.lit(-2.0)))
    return quality.typed_parse(t.raw).select("event_id", "pickup", "dropoff", pu.alias("pu"), "do_", r6("miles"), r6("amount"))


@query("classify_rejects", with_views("classified", body="""
  SELECT event_id, coalesce(reason, 'Valid') AS reason FROM classified"""))
def _(t: Tables) -> DataFrame:
    return t.classified.select("event_id", F.coalesce("reason", F.lit("Valid")).alias("reason"))


_PARSED = """ FROM typed WHERE pickup IS NOT NULL AND dropoff IS NOT NULL AND pu IS NOT NULL AND do_ IS NOT NULL
  AND miles IS NOT NULL AND amount IS NOT NULL"""


def _parsed(t: Tables) -> DataFrame:
    return quality.typed_parse(t.raw).filter(~quality.rule_malformed())


@query("rule_nonfinite", with_views("typed", body="""
  SELECT event_id, isnan(pu) OR isinf(pu) OR isnan(do_) OR isinf(do_) OR isnan(miles) OR isinf(miles)
    OR isnan(amount) OR isinf(amount) AS failed""" + _PARSED))
def _(t: Tables) -> DataFrame:
    return _parsed(t).select("event_id", quality.rule_nonfinite().alias("failed"))


@query("rule_outside_month", with_views("typed", body="""
  SELECT event_id, year(pickup) <> 2024 OR month(pickup) <> 1 AS failed""" + _PARSED))
def _(t: Tables) -> DataFrame:
    return _parsed(t).select("event_id", quality.rule_outside_month(MONTH).alias("failed"))


@query("rule_zone", with_views("typed", body="""
  SELECT event_id, NOT (pu IN (SELECT range FROM range(25)) AND do_ IN (SELECT range FROM range(25))) AS failed""" + _PARSED))
def _(t: Tables) -> DataFrame:
    return _parsed(t).select("event_id", quality.rule_zone(RULES.zone_lo, RULES.zone_hi).alias("failed"))


@query("rule_ranges", with_views("typed", body="""
  SELECT event_id, epoch_us(dropoff) - epoch_us(pickup) < 60000000 OR epoch_us(dropoff) - epoch_us(pickup) > 10800000000
    OR miles <= 0 OR miles > 100 OR amount < 0 OR amount > 1000 AS failed""" + _PARSED))
def _(t: Tables) -> DataFrame:
    return _parsed(t).select("event_id", quality.rule_ranges(RULES).alias("failed"))


@query("fixed_point", with_views("trips", body="""
  SELECT event_id, zone, dest, hour, CAST(day AS VARCHAR) AS day, distance_milli_miles, seconds, cents FROM trips"""))
def _(t: Tables) -> DataFrame:
    return t.trips.drop("pickup")


@query("fixed_point_trunc", with_views("classified", body="""
  SELECT event_id, CAST(trunc(miles * 1000) AS BIGINT) AS distance_milli_miles, CAST(trunc(amount * 100) AS BIGINT) AS cents
  FROM classified WHERE reason IS NULL"""))
def _(t: Tables) -> DataFrame:
    rows = quality.fixed_point(quality.valid_rows(t.classified), mode="trunc", keep=("event_id",))
    return rows.select("event_id", "distance_milli_miles", "cents")


@query("calendar_features", """
  SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
    CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS INTEGER) AS year, CAST(isodow(ts) - 1 AS INTEGER) AS weekday,
    CAST(CASE WHEN isodow(ts) > 5 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend FROM events""")
def _(t: Tables) -> DataFrame:
    return calendar.calendar_features(t.events.select("event_id", "ts"), "ts").drop("ts")


@query("replay_slot", """
  SELECT event_id, CAST((day(ts) - 1) * 1440 + hour(ts) * 60 + minute(ts) AS INTEGER) AS slot,
    strftime(ts, '%d %H:%M') AS label FROM events""")
def _(t: Tables) -> DataFrame:
    slots = calendar.replay_slot(t.events.select("event_id", "ts"), "ts")
    return slots.select("event_id", "slot", calendar.slot_label(F.col("slot")).alias("label"))


@query("archive_filter", with_views("typed", body="""
  SELECT event_id FROM typed WHERE year(pickup) BETWEEN 2024 AND 2025 AND pu BETWEEN 0 AND 24 AND do_ BETWEEN 0 AND 24
    AND miles > 0 AND miles <= 100 AND amount BETWEEN 0 AND 1000
    AND epoch_us(dropoff) - epoch_us(pickup) BETWEEN 60000000 AND 10800000000"""))
def _(t: Tables) -> DataFrame:
    return quality.archive_filter(quality.typed_parse(t.raw), (2024, 2025), RULES).select("event_id")


@query("month_arg_guard", """
  SELECT strftime(l_shipdate, '%Y-%m') AS month, CAST(count(*) AS BIGINT) AS rows FROM lineitem
  WHERE strftime(l_shipdate, '%Y-%m') = '2000-02' GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    month = F.date_format("l_shipdate", "yyyy-MM").alias("month")
    first = F.to_date(F.lit(f"{month_arg_guard('2000-02')}-01"))
    shipped = F.col("l_shipdate")
    wanted = t.read("lineitem").filter(
        (shipped >= first.cast("timestamp_ntz")) & (shipped < F.add_months(first, 1).cast("timestamp_ntz")))
    return wanted.groupBy(month).agg(F.count("*").alias("rows"))


@query("scope_filter", with_views("zh", "zones", body="""
  SELECT zh.* FROM zh JOIN zones ON zone = id WHERE borough = 'ASIA' AND hour = 8"""))
def _(t: Tables) -> DataFrame:
    return scope_filter(t.zh, t.zones, hour=8, borough="ASIA")


@query("unit_metrics", with_views("zh", body="""
  SELECT zone, hour, trips, round(distance_milli_miles / 1000 * 1.609344::DOUBLE, 6) AS distance_km,
    round(distance_milli_miles / 1000 * 1.609344::DOUBLE / trips, 6) AS avg_distance_km,
    round(seconds / 60 / trips, 6) AS avg_minutes, round(cents / 100 / trips, 6) AS avg_amount FROM zh"""))
def _(t: Tables) -> DataFrame:
    return measures.unit_metrics(fam.zone_hour(t.trips)).select(
        "zone", "hour", "trips", r6("distance_km"), r6("avg_distance_km"), r6("avg_minutes"), r6("avg_amount")
    )


@query("zone_group", """
  SELECT p_partkey, CASE WHEN p_name LIKE '%small%' THEN 'A' WHEN p_name LIKE '%widget%' OR p_name LIKE '%cold%' THEN 'B'
    WHEN p_name LIKE '%bolt%' THEN 'C' ELSE 'other' END AS grp FROM part""")
def _(t: Tables) -> DataFrame:
    rules = (("small", "A"), ("widget|cold", "B"), ("bolt", "C"))
    return t.read("part").select("p_partkey", classify.zone_group(F.col("p_name"), rules, "other").alias("grp"))


@query("intensity", with_views("zh", body="""
  SELECT zone, trips, round(r, 6) AS intensity, CAST(CASE WHEN r >= 0.92 THEN 4 WHEN r >= 0.75 THEN 3 WHEN r >= 0.5 THEN 2
    WHEN r >= 0.25 THEN 1 ELSE 0 END AS INTEGER) AS level
  FROM (SELECT zone, trips, round(least(1, ln(1 + trips) / ln(1 + max(trips) OVER ())), 12) AS r FROM (
    SELECT zone * 100 + hour AS zone, trips FROM zh))"""))
def _(t: Tables) -> DataFrame:
    cells = t.zh.select((F.col("zone") * 100 + F.col("hour")).alias("zone"), "trips")
    return classify.intensity(cells, "trips").select("zone", "trips", r6("intensity"), "level")


@query("normalise_to_max", with_views("zh", body="""
  SELECT zone, hour, trips, round(trips / max(trips) OVER (), 6) AS ratio FROM zh"""))
def _(t: Tables) -> DataFrame:
    return classify.normalise_to_max(t.zh.select("zone", "hour", "trips"), "trips").select(
        "zone", "hour", "trips", r6("ratio")
    )


# -- key families --------------------------------------------------------------------------------


@query("key_families", with_views("families", body=f"SELECT {_NO_NULL_KEYS} FROM families"))
def key_families(t: Tables) -> DataFrame:
    return flat_families(fam.key_families(t.trips))


@query("independent_recount", with_views("families", body=f"SELECT {_NO_NULL_KEYS} FROM families"))
def _(t: Tables) -> DataFrame:
    return flat_families(verify.independent_recount(t.trips))


@query("additive_sum", with_views("shipments", body=f"SELECT zone, {SUMS} FROM shipments GROUP BY zone"))
def _(t: Tables) -> DataFrame:
    return fam.additive_sum(fam.additive_sum(t.shipments, ["zone", "dest", "day"]), ["zone"])


@query("zone_hour", with_views("zh", body="SELECT * FROM zh"))
def _(t: Tables) -> DataFrame:
    return fam.zone_hour(t.trips)


@query("day_totals", with_views("days", body="""
  SELECT CAST(day AS VARCHAR) AS day, trips, distance_milli_miles, seconds, cents FROM days"""))
def _(t: Tables) -> DataFrame:
    return fam.day_totals(t.trips).orderBy("day")


@query("od_totals", with_views("trips", body=f"SELECT zone, dest, {SUMS} FROM trips GROUP BY zone, dest"))
def _(t: Tables) -> DataFrame:
    return fam.od_totals(t.trips)


@query("day_zone_hour", with_views("tzh", body="""
  SELECT CAST(day AS VARCHAR) AS day, zone, hour, trips, distance_milli_miles, seconds, cents FROM tzh"""))
def _(t: Tables) -> DataFrame:
    return fam.day_zone_hour(t.trips)


@query("reject_histogram", with_views("classified", body="""
  SELECT reason, CAST(count(*) AS BIGINT) AS rows FROM classified WHERE reason IS NOT NULL GROUP BY reason"""))
def _(t: Tables) -> DataFrame:
    return quality.reject_histogram(t.classified)


_COUNTERS = ", ".join(f"CAST(count(*) FILTER (WHERE reason = '{r}') AS BIGINT) AS \"{r}\"" for r in REASONS)


@query("quality_counters", with_views("classified", body=f"""
  SELECT CAST(count(*) AS BIGINT) AS input_rows, CAST(count(*) FILTER (WHERE reason IS NULL) AS BIGINT) AS valid_rows,
    {_COUNTERS} FROM classified"""))
def _(t: Tables) -> DataFrame:
    counters = Observation("quality")
    fam.day_totals(quality.fixed_point(quality.valid_rows(quality.quality_counters(t.classified, counters)))).write.format(
        "noop"
    ).mode("overwrite").save()
    names = ("input_rows", "valid_rows", *REASONS)
    return t.spark.createDataFrame([tuple(counters.get[n] for n in names)], ", ".join(f"{n} long" for n in names))


@query("quality_report", with_views("classified", body="""
  SELECT CAST(count(*) AS BIGINT) AS input, CAST(count(*) FILTER (WHERE reason IS NULL) AS BIGINT) AS valid,
    CAST(count(*) FILTER (WHERE reason IS NOT NULL) AS BIGINT) AS rejected,
    round(100 * count(*) FILTER (WHERE reason IS NULL) / count(*), 6) AS valid_pct,
    (SELECT string_agg(reason || '=' || n, ',' ORDER BY reason) FROM
      (SELECT reason, count(*) AS n FROM classified WHERE reason IS NOT NULL GROUP BY reason)) AS reasons
  FROM classified"""))
def _(t: Tables) -> DataFrame:
    pairs = F.transform(F.array_sort(F.map_entries("reasons")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return quality.quality_report(t.classified).select(
        "input", "valid", "rejected", r6("valid_pct"), F.array_join(pairs, ",").alias("reasons")
    )


# -- summaries -----------------------------------------------------------------------------------

_METRICS = """round(sum(distance_milli_miles) / 1000 * 1.609344::DOUBLE, 6) AS distance_km,
    round(sum(distance_milli_miles) / 1000 * 1.609344::DOUBLE / sum(trips), 6) AS avg_distance_km,
    round(sum(seconds) / 60 / sum(trips), 6) AS avg_minutes, round(sum(cents) / 100 / sum(trips), 6) AS avg_amount"""


@query("summary", with_views("zh", "zones", body=f"""
  SELECT 'city' AS scope, CAST(sum(trips) AS BIGINT) AS trips, {_METRICS} FROM zh
  UNION ALL SELECT 'ASIA', CAST(sum(trips) AS BIGINT), {_METRICS} FROM zh JOIN zones ON zone = id WHERE borough = 'ASIA'
  UNION ALL SELECT 'ASIA 8', CAST(sum(trips) AS BIGINT), {_METRICS} FROM zh JOIN zones ON zone = id
    WHERE borough = 'ASIA' AND hour = 8"""))
def _(t: Tables) -> DataFrame:
    zh = t.zh
    scopes = (("city", {}), ("ASIA", {"borough": "ASIA"}), ("ASIA 8", {"borough": "ASIA", "hour": 8}))
    parts = [summary.summary(zh, t.zones, **args).withColumn("scope", F.lit(name)) for name, args in scopes]
    return union_months(*parts).select(
        "scope", "trips", r6("distance_km"), r6("avg_distance_km"), r6("avg_minutes"), r6("avg_amount")
    )


@query("hourly_profile", with_views("zh", "zones", body="""
  SELECT CAST(range AS INTEGER) AS hour, CAST(coalesce(sum(trips), 0) AS BIGINT) AS trips
  FROM range(24) LEFT JOIN (SELECT * FROM zh JOIN zones ON zone = id WHERE borough = 'EUROPE') ON hour = range
  GROUP BY range"""))
def _(t: Tables) -> DataFrame:
    return summary.hourly_profile(t.zh, t.zones, borough="EUROPE")


_RANKED = f"""SELECT zone AS id, name, borough, CAST(sum(trips) AS BIGINT) AS trips, {_METRICS}
  FROM zh JOIN zones ON zone = id"""


@query("zone_ranking", with_views("zh", "zones", body=f"""
  SELECT id, name, borough, trips, avg_distance_km, avg_minutes, avg_amount
  FROM ({_RANKED} GROUP BY ALL) ORDER BY trips DESC, id LIMIT 8"""))
def _(t: Tables) -> DataFrame:
    return summary.zone_ranking(fam.zone_hour(t.trips), t.zones, 8).select(
        "id", "name", "borough", "trips", r6("avg_distance_km"), r6("avg_minutes"), r6("avg_amount")
    )


@query("top_share", with_views("zh", body="""
  SELECT zone, trips, round(100 * trips / total, 6) AS share_pct FROM
    (SELECT zone, CAST(sum(trips) AS BIGINT) AS trips, sum(sum(trips)) OVER () AS total FROM zh GROUP BY zone)
  ORDER BY trips DESC, zone LIMIT 1"""))
def _(t: Tables) -> DataFrame:
    return summary.top_share(fam.additive_sum(t.trips, ["zone"])).select("zone", "trips", r6("share_pct"))


@query("enrich_zone", with_views("zh", "zones", body="""
  SELECT zone, hour, trips, coalesce(name, CAST(zone AS VARCHAR)) AS name, coalesce(borough, 'Unknown') AS borough
  FROM zh LEFT JOIN (SELECT * FROM zones WHERE id % 5 <> 3) ON zone = id"""))
def _(t: Tables) -> DataFrame:
    partial = t.zones.filter(F.col("id") % 5 != 3)
    twice = union_months(partial, partial.filter(F.col("id") == 1))
    return enrich_zone(t.zh, twice).select("zone", "hour", "trips", "name", "borough")


@query("enrich_od", with_views("od", "zones", body="""
  SELECT zone, dest, trips, a.name AS name_o, a.borough AS borough_o, b.name AS name_d, b.borough AS borough_d
  FROM od JOIN zones a ON zone = a.id JOIN zones b ON dest = b.id"""))
def _(t: Tables) -> DataFrame:
    return enrich_od(t.od, t.zones).select("zone", "dest", "trips", "name_o", "borough_o", "name_d", "borough_d")


# -- checks --------------------------------------------------------------------------------------


@query("conservation_check", with_views("trips", "classified", body="""
  SELECT CAST(v AS BIGINT) AS z, CAST(v AS BIGINT) AS d, CAST(v AS BIGINT) AS o, CAST(v AS BIGINT) AS t,
    CAST(n - v AS BIGINT) AS q, CAST(n AS BIGINT) AS input, TRUE AS ok
  FROM (SELECT (SELECT count(*) FROM trips) AS v, (SELECT count(*) FROM classified) AS n)"""))
def _(t: Tables) -> DataFrame:
    cells = cut_lineage(fam.classified_cuboid(t.classified), "cells")
    families, rejects = fam.split_cells(cells)
    return verify.conservation_check(families, rejects, cells.agg(F.sum("trips").alias("n")))


@query("compare_keyed", with_views("zh", body="""
  SELECT zone, hour, CASE WHEN zone = 3 THEN 'missing' WHEN zone = -1 THEN 'extra' ELSE 'different' END AS status FROM
    (SELECT zone, hour FROM zh WHERE zone = 3 OR hour = 7 UNION ALL SELECT -1, hour FROM zh WHERE zone = 3)"""))
def _(t: Tables) -> DataFrame:
    truth = t.zh
    zone = F.when(F.col("zone") == 3, -1).otherwise(F.col("zone"))
    altered = truth.withColumns({"cents": F.col("cents") + (F.col("hour") == 7).cast("int"), "zone": zone})
    return compare_keyed(truth, altered, ["zone", "hour"])


@query("symmetric_difference", with_views("zh", body="""
  SELECT zone, hour, trips, 'left' AS side FROM zh WHERE hour = 7
  UNION ALL SELECT zone, hour, trips + 1, 'right' FROM zh WHERE hour = 7"""))
def _(t: Tables) -> DataFrame:
    truth = t.zh.select("zone", "hour", "trips")
    altered = truth.withColumn("trips", F.col("trips") + (F.col("hour") == 7).cast("int"))
    return symmetric_difference(truth, altered).drop("copies")


@query("duplicate_keys", """
  SELECT user_id, event_type, CAST(count(*) AS BIGINT) AS copies FROM events GROUP BY 1, 2 HAVING count(*) > 1""")
def _(t: Tables) -> DataFrame:
    return duplicate_keys(t.events, ["user_id", "event_type"])


@query("partition_invariance", """
  SELECT CAST(k AS INTEGER) AS k, CAST(0 AS BIGINT) AS diff_rows FROM (VALUES (1), (2), (4), (13)) v(k)""")
def _(t: Tables) -> DataFrame:
    return verify.partition_invariance(t.trips)


@query("reshard_balanced", """
  SELECT CAST(16 AS BIGINT) AS partitions, CAST(count(*) AS BIGINT) AS rows, TRUE AS balanced FROM lineitem""")
def _(t: Tables) -> DataFrame:
    sizes = verify.partition_sizes(verify.reshard_balanced(t.read("lineitem"), 16))
    return sizes.agg(
        F.count("*").alias("partitions"), F.sum("rows").alias("rows"),
        (F.max("rows") - F.min("rows") <= 16 + 0.1 * F.max("rows")).alias("balanced"),
    )


@query("union_months", with_views("shipments", body="""
  SELECT strftime(day, '%Y-%m') AS month, CAST(count(*) AS BIGINT) AS trips FROM shipments GROUP BY 1"""))
def _(t: Tables) -> DataFrame:
    """Ranges of ship dates, which reach the scan as filters, so that each branch reads its own part."""
    shipped = F.col("l_shipdate")

    def months(test) -> DataFrame:
        return t.read("lineitem").filter(test).select(F.date_format(shipped, "yyyy-MM").alias("month"))

    starts = [F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in range(1996, 2000)]
    whole = union_months(
        months((shipped < starts[0]) | (shipped >= starts[-1])),
        *[months((shipped >= a) & (shipped < b)) for a, b in zip(starts, starts[1:], strict=False)],
    )
    return whole.groupBy("month").agg(F.count("*").alias("trips"))
