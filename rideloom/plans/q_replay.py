"""Queries: minute replay, in batch and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideloom.operators.ranking import top_k_per_frame
from rideloom.plans.catalog import query, r6
from rideloom.plans.sql import with_views
from rideloom.plans.tables import MONTH, RULES, Tables, raw_fields
from rideloom.schema import REASONS
from rideloom.streaming import replay, streams
from rideloom.workspace import fresh_folder, is_folder

DAYS = 31
HORIZON = DAYS * 1440
DELAY = "10 minutes"


@query("minute_zone_counts", with_views("slots", body="SELECT * FROM slots"))
def _(t: Tables) -> DataFrame:
    return replay.minute_zone_counts(t.trips)


@query("minute_zone_counts_raw", """
  SELECT CAST((day(ts) - 1) * 1440 + hour(ts) * 60 + minute(ts) AS INTEGER) AS slot, user_id % 27 AS zone,
    CAST(count(*) AS BIGINT) AS trips FROM events GROUP BY 1, 2""")
def _(t: Tables) -> DataFrame:
    return replay.minute_zone_counts(t.events.select("ts", (F.col("user_id") % 27).alias("zone")), "ts")


@query("peak_minute", with_views("slot_totals", body="SELECT max(trips) AS peak FROM slot_totals"))
def _(t: Tables) -> DataFrame:
    return replay.peak_minute(replay.minute_zone_counts(t.trips))


@query("replay_meta", with_views("slot_totals", body=f"""
  SELECT CAST({HORIZON} AS BIGINT) AS minutes, max(trips) AS peak_minute_total FROM slot_totals"""))
def _(t: Tables) -> DataFrame:
    return replay.replay_meta(replay.minute_zone_counts(t.trips), DAYS)


@query("replay_frame", with_views("slots", body=f"""
  SELECT f.m, zone, CAST(sum(trips) AS BIGINT) AS trips
  FROM (VALUES (600), ({HORIZON - 20})) f(m) JOIN slots ON (slot - f.m + {HORIZON}) % {HORIZON} < 60 GROUP BY 1, 2"""))
def _(t: Tables) -> DataFrame:
    index = t.slots
    frames = [replay.replay_frame(index, m, 60, HORIZON).withColumn("m", F.lit(m % HORIZON)) for m in (600, -20)]
    return frames[0].unionByName(frames[1]).select("m", "zone", "trips")


# Where frames begin and how many minutes they show; some wrap around at the end of the month, one covers nearly all of it.
_REQUESTS = [(600, 60), (HORIZON - 20, 60), (HORIZON - 1, 1), (HORIZON - 1, 2), (0, 1), (1439, 30), (700, 1440), (HORIZON - 700, 1440),
             (20_000, HORIZON - 3), (HORIZON - 60, 60)]


@query("replay_frames", with_views("slots", body=f"""
  SELECT * FROM (WITH requests AS (SELECT * FROM (VALUES {", ".join(f"({m}, {span})" for m, span in _REQUESTS)}) r(m, span)
      UNION SELECT DISTINCT slot, 1 + slot % 60 FROM slots WHERE slot % 97 = 0),
    parts AS (SELECT m, span, zone, CAST(sum(trips) AS BIGINT) AS trips FROM requests
      JOIN slots ON slot BETWEEN m AND m + span - 1 OR slot + {HORIZON} BETWEEN m AND m + span - 1 GROUP BY ALL)
  SELECT m, span, CAST(coalesce(sum(trips) OVER (PARTITION BY m, span), 0) AS BIGINT) AS total, zone, trips
  FROM requests LEFT JOIN parts USING (m, span))"""))
def _(t: Tables) -> DataFrame:
    """Many frames with their totals, from one cumulative table."""
    index = t.slots
    fixed = t.spark.createDataFrame([(m - HORIZON if n % 2 else m + 2 * HORIZON, span) for n, (m, span) in enumerate(_REQUESTS)], "m long, span int")
    often = index.select("slot").distinct().filter("slot % 97 = 0").select(F.col("slot").cast("long").alias("m"), (1 + F.col("slot") % 60).alias("span"))
    return replay.replay_frames(replay.frame_index(index, HORIZON), fixed.unionByName(often), HORIZON, HORIZON)


@query("rolling_hour_rate", with_views("slot_totals", body="""
  SELECT slot, round(sum(trips) OVER (ORDER BY slot RANGE BETWEEN 59 PRECEDING AND CURRENT ROW) * 60.0::DOUBLE
    / least(slot + 1, 60), 6) AS rate FROM slot_totals"""))
def _(t: Tables) -> DataFrame:
    return replay.rolling_hour_rate(replay.minute_totals(replay.minute_zone_counts(t.trips))).select("slot", r6("rate"))


@query("top_k_per_frame", with_views("slots", body="""
  SELECT slot, zone, trips, CAST(row_number() OVER (PARTITION BY slot ORDER BY trips DESC, zone) AS INTEGER) AS rank
  FROM slots QUALIFY rank <= 5"""))
def _(t: Tables) -> DataFrame:
    return top_k_per_frame(replay.minute_zone_counts(t.trips), 5)


# -- streams -------------------------------------------------------------------------------------


def event_stream(t: Tables) -> DataFrame:
    """The events table as a stream of files, zone and time as the streams expect them."""
    if is_folder(t.spark, t.path("events")):
        source = streams.open_files(t.spark, t.path("events"), t.events.schema)
    else:
        source = streams.open_files(t.spark, t.sf_dir, t.events.schema, glob="events.parquet")
    return source.withColumns({"zone": F.col("user_id") % 27, "wall": F.col("ts"), "ts": F.col("ts").cast("timestamp")})


_MINUTES = """SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS minute, user_id % 27 AS zone,
  CAST(count(*) AS BIGINT) AS trips FROM events GROUP BY 1, 2"""
# In append mode a window is final once the newest event is a whole delay past its end.
_CLOSED = """date_trunc('minute', ts) + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"""


@query("stream_minute_counts", _MINUTES)
def _(t: Tables) -> DataFrame:
    bounded = streams.stream_watermark(event_stream(t), DELAY)
    return streams.run_upserts(streams.stream_minute_counts(bounded), ["minute", "zone"])


@query("stream_watermark", _MINUTES.replace("FROM events", f"FROM events WHERE {_CLOSED}", 1))
def _(t: Tables) -> DataFrame:
    late_safe = streams.stream_watermark(event_stream(t), DELAY)
    return streams.run_appends(streams.stream_minute_counts(late_safe))


@query("stream_top_zones", f"""
  SELECT minute, zone, trips, CAST(row_number() OVER (PARTITION BY minute ORDER BY trips DESC, zone) AS INTEGER) AS rank
  FROM ({_MINUTES.replace("FROM events", f"FROM events WHERE {_CLOSED}", 1)}) QUALIFY rank <= 5""")
def _(t: Tables) -> DataFrame:
    return streams.stream_top_zones(streams.stream_watermark(event_stream(t), DELAY), 5)


@query("stream_intensity", f"""
  SELECT minute, total, peak, zone, trips, rank,
    round(least(CAST(1 AS DOUBLE), ln(1 + trips) / ln(1 + greatest(peak * 2, 1) / CAST(2 AS DOUBLE))), 9) AS intensity
  FROM (SELECT minute, zone, trips, CAST(row_number() OVER (PARTITION BY minute ORDER BY trips DESC, zone) AS INTEGER) AS rank
    FROM ({_MINUTES.replace("FROM events", f"FROM events WHERE {_CLOSED}", 1)}) QUALIFY rank <= 5)
  JOIN (SELECT minute, total, CAST(max(total) OVER (ORDER BY minute) AS BIGINT) AS peak
    FROM (SELECT minute, CAST(sum(trips) AS BIGINT) AS total
      FROM ({_MINUTES.replace("FROM events", f"FROM events WHERE {_CLOSED}", 1)}) GROUP BY minute)) USING (minute)""")
def _(t: Tables) -> DataFrame:
    """The peak so far is state of the stream."""
    found = streams.stream_intensity(streams.stream_watermark(event_stream(t), DELAY), 5, span=2)
    return found.withColumn("intensity", r6("intensity", 9))


# Four files; the third holds days before those of the second, and every tenth event comes one file later.
_FILE = "least(3, CASE WHEN day(ts) <= 8 THEN 0 WHEN day(ts) <= 16 THEN 2 WHEN day(ts) <= 24 THEN 1 ELSE 3 END + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END)"


@query("stream_late_rows", f"""
  WITH filed AS (SELECT date_trunc('minute', ts) AS m, ts, user_id % 27 AS zone, {_FILE} AS f FROM events),
    marks AS (SELECT g.f, (SELECT max(ts) FROM filed b WHERE b.f < g.f) - INTERVAL 10 MINUTE AS mark FROM (SELECT DISTINCT f FROM filed) g)
  SELECT strftime(m, '%Y-%m-%d %H:%M:%S') AS minute, zone,
    CAST(count(*) FILTER (WHERE NOT coalesce(m + INTERVAL 1 MINUTE <= mark, false)) AS BIGINT) AS trips,
    CAST(count(*) FILTER (WHERE m + INTERVAL 1 MINUTE <= mark) AS BIGINT) AS late
  FROM filed JOIN marks USING (f) GROUP BY 1, 2""")
def _(t: Tables) -> DataFrame:
    """Files that arrive out of order: rows behind the watermark are counted apart."""
    source = fresh_folder(t.spark, "unordered")
    filed = t.events.withColumns({"file": F.expr(_FILE), "zone": F.col("user_id") % 27, "ts": F.col("ts").cast("timestamp")})
    for file in range(4):  # one after the other: a file source goes by age
        filed.filter(F.col("file") == file).select("ts", "zone").coalesce(1).write.mode("append").parquet(source)
    stream = streams.open_files(t.spark, source, "ts timestamp, zone long", files_per_batch=1)
    return streams.run_counting_late(stream, 10)


@query("stream_hour_rate", """
  SELECT strftime(until, '%Y-%m-%d %H:%M:%S') AS until, CAST(count(*) AS BIGINT) AS rate
  FROM (SELECT unnest(generate_series(date_trunc('minute', ts) + INTERVAL 1 MINUTE,
    date_trunc('minute', ts) + INTERVAL 60 MINUTE, INTERVAL 1 MINUTE)) AS until FROM events)
  WHERE until <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE GROUP BY until""")
def _(t: Tables) -> DataFrame:
    return streams.run_appends(streams.stream_hour_rate(streams.stream_watermark(event_stream(t), DELAY)))


@query("stream_quality", with_views("classified", body="""
  SELECT coalesce(reason, 'Valid') AS reason, CAST(count(*) AS BIGINT) AS rows FROM classified GROUP BY 1"""))
def _(t: Tables) -> DataFrame:
    fields = raw_fields(event_stream(t).withColumn("ts", F.col("wall")))
    return streams.run_upserts(streams.stream_quality(fields, MONTH, RULES), ["reason"])


@query("stream_counters", with_views("classified", "trips", body=f"""
  SELECT CAST(count(*) AS BIGINT) AS input_rows, CAST(count(*) FILTER (WHERE reason IS NULL) AS BIGINT) AS valid_rows,
    {", ".join(f"CAST(count(*) FILTER (WHERE reason = '{name}') AS BIGINT) AS {name}" for name in REASONS)},
    (SELECT CAST(count(*) AS BIGINT) FROM trips) AS written, (SELECT CAST(sum(cents) AS BIGINT) FROM trips) AS cents FROM classified"""))
def _(t: Tables) -> DataFrame:
    """Counters of all micro-batches against the trips that the same batches have written."""
    trips, counters = streams.run_validated(raw_fields(event_stream(t).withColumn("ts", F.col("wall"))), MONTH, RULES)
    told = trips.agg(F.struct(F.count("*").alias("written"), F.sum("cents").alias("cents"))).scalar()
    sums = counters.agg(*[F.sum(name).alias(name) for name in ("input_rows", "valid_rows", *REASONS)])
    return sums.withColumn("told", told).select(*sums.columns, "told.written", "told.cents")
