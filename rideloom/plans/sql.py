"""The views of ``tables`` in SQL, as common table expressions for the comparison queries."""

from __future__ import annotations

D = "CAST({} AS DOUBLE)".format

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def _view(name: str, body: str, *needs: str) -> None:
    VIEWS[name] = (needs, body)


def with_views(*names: str, body: str, recursive: bool = False) -> str:
    """``body`` preceded by the named views and whatever they need."""
    order: list[str] = []

    def visit(name: str) -> None:
        needs, _ = VIEWS[name]
        for need in needs:
            visit(need)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    head = ",\n".join(f"{name} AS ({VIEWS[name][1]})" for name in order)
    return f"WITH {'RECURSIVE ' if recursive else ''}{head}\n{body}"


SUMS = (
    "CAST(count(*) AS BIGINT) AS trips, CAST(sum(distance_milli_miles) AS BIGINT) AS distance_milli_miles, "
    "CAST(sum(seconds) AS BIGINT) AS seconds, CAST(sum(cents) AS BIGINT) AS cents"
)

_view("raw_trips", """
  SELECT event_id,
    CASE WHEN event_id % 67 = 0 THEN regexp_replace(CAST(ts - INTERVAL 6 HOUR AS VARCHAR), '.$', 'Z')
      WHEN event_id % 71 = 0 THEN regexp_replace(CAST(ts - INTERVAL 6 HOUR AS VARCHAR), '.$', ' ')
      ELSE CAST(ts - INTERVAL 6 HOUR AS VARCHAR) END AS s_pickup,
    CAST(ts + to_seconds(CAST(round_even(value * 30, 0) AS BIGINT)) - INTERVAL 6 HOUR AS VARCHAR) AS s_dropoff,
    CASE WHEN event_id % 53 = 0 THEN '' WHEN event_id % 59 = 0 THEN 'nan' WHEN event_id % 61 = 0 THEN '1.5'
         ELSE CAST(user_id % 27 AS VARCHAR) END AS s_pu,
    CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 26 AS VARCHAR) AS s_do,
    value / 3 AS miles, value * 4 AS amount
  FROM events""")
_view("typed", """
  SELECT event_id, CASE WHEN regexp_full_match(s_pickup, '[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?')
      THEN try_cast(s_pickup AS TIMESTAMP) END AS pickup, try_cast(s_dropoff AS TIMESTAMP) AS dropoff,
    try_cast(s_pu AS DOUBLE) AS pu, try_cast(s_do AS DOUBLE) AS do_, miles, amount
  FROM raw_trips""", "raw_trips")
_view("classified", """
  SELECT *, CASE
    WHEN pickup IS NULL OR dropoff IS NULL OR pu IS NULL OR do_ IS NULL OR miles IS NULL OR amount IS NULL
      THEN 'Malformed'
    WHEN NOT (isfinite(pu) AND isfinite(do_) AND isfinite(miles) AND isfinite(amount)) THEN 'NonFinite'
    WHEN strftime(pickup, '%Y-%m') <> '2024-01' THEN 'OutsideMonth'
    WHEN NOT (pu = floor(pu) AND do_ = floor(do_) AND pu BETWEEN 0 AND 24 AND do_ BETWEEN 0 AND 24)
      THEN 'UnknownZone'
    WHEN NOT (epoch_us(dropoff) - epoch_us(pickup) BETWEEN 60000000 AND 10800000000) THEN 'InvalidDuration'
    WHEN NOT (miles > 0 AND miles <= 100) THEN 'InvalidDistance'
    WHEN NOT (amount >= 0 AND amount <= 1000) THEN 'InvalidAmount'
  END AS reason
  FROM typed""", "typed")
_view("trips", """
  SELECT event_id, pickup, CAST(pu AS INTEGER) AS zone, CAST(do_ AS INTEGER) AS dest,
    CAST(hour(pickup) AS INTEGER) AS hour, CAST(pickup AS DATE) AS day,
    CAST(round_even(miles * 1000, 0) AS BIGINT) AS distance_milli_miles,
    CAST(round_even((epoch_us(dropoff) - epoch_us(pickup)) / CAST(1000000 AS DOUBLE), 0) AS BIGINT) AS seconds,
    CAST(round_even(amount * 100, 0) AS BIGINT) AS cents
  FROM classified WHERE reason IS NULL""", "classified")
_view("zh", f"SELECT zone, hour, {SUMS} FROM trips GROUP BY zone, hour", "trips")
_view("days", f"SELECT day, {SUMS} FROM trips GROUP BY day", "trips")
_view("tzh", f"SELECT day, zone, hour, {SUMS} FROM trips GROUP BY day, zone, hour", "trips")
_view("families", f"""
  SELECT 'Z' AS kind, zone, hour, NULL AS day, NULL AS dest, {SUMS} FROM trips GROUP BY zone, hour
  UNION ALL SELECT 'D', NULL, NULL, day, NULL, {SUMS} FROM trips GROUP BY day
  UNION ALL SELECT 'O', zone, NULL, NULL, dest, {SUMS} FROM trips GROUP BY zone, dest
  UNION ALL SELECT 'T', zone, hour, day, NULL, {SUMS} FROM trips GROUP BY zone, hour, day""", "trips")
_view("shipments", """
  SELECT s_nationkey AS zone, c_nationkey AS dest, CAST(l_shipdate AS DATE) AS day,
    CAST(round_even(l_quantity * 1000, 0) AS BIGINT) AS distance_milli_miles,
    CAST(l_linenumber * 600 AS BIGINT) AS seconds,
    CAST(round_even(l_extendedprice * 100, 0) AS BIGINT) AS cents
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN customer ON o_custkey = c_custkey""")
_view("od", "SELECT zone, dest, CAST(count(*) AS BIGINT) AS trips FROM shipments GROUP BY zone, dest", "shipments")
_view("directed", """
  SELECT a.zone AS origin, a.dest AS destination, a.trips FROM od a LEFT JOIN od b ON a.zone = b.dest AND a.dest = b.zone
  WHERE a.zone <> a.dest AND (b.trips IS NULL OR a.trips > b.trips OR (a.trips = b.trips AND a.zone < b.zone))""", "od")
_view("ranked_links", """
  SELECT CAST(row_number() OVER (ORDER BY trips DESC, origin, destination) AS INTEGER) AS i,
    CAST(origin AS INTEGER) AS o, CAST(destination AS INTEGER) AS d, trips FROM directed""", "directed")
_view("backbone", """
  SELECT o AS origin, d AS destination, trips FROM ranked_links
  WHERE list_contains((SELECT kept FROM walk ORDER BY i DESC LIMIT 1), i)""", "ranked_links")
# Greedy walk over the ranked links; the closure of kept links is a list of 1000 * from + to.
WALK = """walk(i, closure, kept) AS (
  SELECT 0, CAST([] AS INTEGER[]), CAST([] AS INTEGER[])
  UNION ALL
  SELECT e.i,
    CASE WHEN list_contains(w.closure, e.d * 1000 + e.o) OR len(w.kept) >= 25 THEN w.closure
      ELSE list_distinct(list_concat(w.closure, flatten(list_transform(
        list_append(list_transform(list_filter(w.closure, lambda p: p % 1000 = e.o), lambda p: p // 1000), e.o),
        lambda a: list_transform(
          list_append(list_transform(list_filter(w.closure, lambda q: q // 1000 = e.d), lambda q: q % 1000), e.d),
          lambda b: a * 1000 + b))))) END,
    CASE WHEN list_contains(w.closure, e.d * 1000 + e.o) OR len(w.kept) >= 25 THEN w.kept
      ELSE list_append(w.kept, e.i) END
  FROM walk w JOIN ranked_links e ON e.i = w.i + 1)"""
_view("zones", f"""
  SELECT n_nationkey AS id, n_name AS name, r_name AS borough,
    {D(-74.28)} + {D(0.13)} * (n_nationkey % 5) AS x0, {D(40.47)} + {D(0.09)} * (n_nationkey // 5) AS y0
  FROM nation JOIN region ON n_regionkey = r_regionkey""")
_view("points", f"""
  SELECT event_id, {D(-74.28)} + {D(0.65)} * ((event_id * 7919) % 1000) / {D(1000)} AS px,
    {D(40.47)} + {D(0.45)} * ((event_id * 104729) % 997) / {D(997)} AS py FROM events""")
_view("centers", f"""
  SELECT id AS zone, (x0 + (x0 + {D(0.12)}) + (x0 + {D(0.12)}) + x0) / 4 AS cx,
    (y0 + y0 + (y0 + {D(0.08)}) + (y0 + {D(0.08)})) / 4 AS cy FROM zones""", "zones")
_view("corners", f"""
  SELECT id AS zone, x0 + {D(0.12)} * dx AS x, y0 + {D(0.08)} * dy AS y, i FROM zones,
    (VALUES (0, 0, 0), (1, 1, 0), (2, 1, 1), (3, 0, 1)) v(i, dx, dy)""", "zones")
_view("sides", """
  SELECT a.zone, a.x AS xi, a.y AS yi, b.x AS xj, b.y AS yj
  FROM corners a JOIN corners b ON a.zone = b.zone AND b.i = (a.i + 3) % 4""", "corners")
_view("demand", """
  SELECT CAST(user_id % 25 AS INTEGER) AS zone, CAST(hour(ts) AS INTEGER) AS hour, CAST(ts AS DATE) AS date,
    CAST(count(*) AS BIGINT) AS trips FROM events GROUP BY 1, 2, 3""")
_view("grid", """
  SELECT z.zone, CAST(h.h AS INTEGER) AS hour, d.date, CAST(coalesce(c.trips, 0) AS BIGINT) AS trips
  FROM (SELECT DISTINCT zone FROM demand) z CROSS JOIN range(24) h(h)
    CROSS JOIN (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM demand) d
    LEFT JOIN demand c ON c.zone = z.zone AND c.hour = h.h AND c.date = d.date""", "demand")
_view("lagged", """
  SELECT *, lag(trips, 1) OVER s AS lag_1, lag(trips, 7) OVER s AS lag_7,
    avg(trips) OVER (PARTITION BY zone, hour ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS lag7mean
  FROM grid WINDOW s AS (PARTITION BY zone, hour ORDER BY date)""", "grid")
_view("weather_n", """
  SELECT CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour, day(CAST(ts AS DATE)) AS dom, count(*) AS n
  FROM events GROUP BY 1, 2, 3""")
_view("weather_h", f"""
  SELECT date, hour, temp AS temperature_2m, temp - 2 AS apparent_temperature, wet AS precipitation,
    CASE WHEN temp < 0 THEN wet ELSE {D(0)} END AS snowfall, {D("(n * 5) % 23")} AS wind_speed_10m,
    {D("30 + (n * 11) % 70")} AS relative_humidity_2m, {D("(n * 17) % 101")} AS cloud_cover
  FROM (SELECT *, {D("(dom * 7 + hour * 3 + n) % 45 - 10")} AS temp,
    CASE WHEN (dom * 24 + hour) % 8 = 0 THEN {D("(dom + hour + n) % 5")} / {D(10)} ELSE {D(0)} END AS wet
    FROM weather_n)""", "weather_n")
_view("weather_d", f"""
  SELECT date, max(temperature_2m) AS temperature_2m_max, min(temperature_2m) AS temperature_2m_min,
    round(sum(precipitation), 1) AS precipitation_sum, round(sum(snowfall), 1) AS snowfall_sum,
    max(wind_speed_10m) AS wind_speed_10m_max,
    {D("3600 * count(*) FILTER (WHERE cloud_cover < 50)")} AS sunshine_duration
  FROM weather_h GROUP BY date""", "weather_h")
_view("features", """
  SELECT l.*, CAST(isodow(l.date) - 1 AS INTEGER) AS weekday, CAST(month(l.date) AS INTEGER) AS month,
    CAST(CASE WHEN isodow(l.date) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
    h.* EXCLUDE (date, hour), d.* EXCLUDE (date)
  FROM lagged l JOIN weather_h h ON l.date = h.date AND l.hour = h.hour JOIN weather_d d ON l.date = d.date
  WHERE l.lag_7 IS NOT NULL""", "lagged", "weather_h", "weather_d")
# The naive forecast on the last nine days: predictions on both sides of the validation date.
_view("naive", """
  SELECT *, CAST(lag_7 AS DOUBLE) AS pred,
    CASE WHEN date <= DATE '2024-01-21' THEN 'train' WHEN date <= DATE '2024-01-25' THEN 'valid' ELSE 'test' END AS split
  FROM lagged WHERE lag_7 IS NOT NULL""", "lagged")
_view("residual_q", """
  SELECT hour, quantile_cont(round_even((trips - pred) * 1000, 0) / CAST(1000 AS DOUBLE), 0.1) AS r_lo,
    quantile_cont(round_even((trips - pred) * 1000, 0) / CAST(1000 AS DOUBLE), 0.9) AS r_hi
  FROM naive WHERE split = 'valid' GROUP BY hour""", "naive")
_view("banded", """
  SELECT n.*, greatest(CAST(0 AS DOUBLE), pred + coalesce(r_lo, 0)) AS q_lo,
    greatest(greatest(CAST(0 AS DOUBLE), pred + coalesce(r_lo, 0)), pred + coalesce(r_hi, 0)) AS q_hi
  FROM naive n LEFT JOIN residual_q r ON n.hour = r.hour WHERE split = 'test'""", "naive", "residual_q")
_view("runs", """
  SELECT 'run-' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS run_id, strftime(o_orderdate, '%Y-%m') AS month,
    CAST(1 + o_custkey % 4 AS INTEGER) AS reducers, o_orderkey % 2 = 0 AS combiner, o_orderkey % 11 = 0 AS fail_first,
    CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'P' THEN 'RUNNING' ELSE 'SUCCEEDED' END AS status,
    strftime(o_orderdate, '%Y-%m-%d') || 'T' || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':' ||
      lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') || ':00' AS started_at,
    floor(o_totalprice) / CAST(1000 AS DOUBLE) AS elapsed_seconds
  FROM orders""")
_view("plain_runs", """
  SELECT * FROM runs WHERE status = 'SUCCEEDED' AND reducers = 2 AND combiner AND NOT fail_first""", "runs")
_view("manifests", """
  SELECT strftime(l_shipdate, '%Y-%m') AS month, CAST(count(*) AS BIGINT) AS rows,
    CAST(count(*) + count(*) FILTER (WHERE l_quantity > 45) AS BIGINT) AS source_rows,
    strftime(max(l_shipdate), '%Y-%m-%d') AS created_at
  FROM lineitem GROUP BY 1""")
_view("slots", """
  SELECT CAST((day(pickup) - 1) * 1440 + hour(pickup) * 60 + minute(pickup) AS INTEGER) AS slot, zone,
    CAST(count(*) AS BIGINT) AS trips FROM trips GROUP BY 1, 2""", "trips")
_view("slot_totals", "SELECT slot, CAST(sum(trips) AS BIGINT) AS trips FROM slots GROUP BY slot", "slots")
_view("pixels", """
  SELECT 601 * 256 + (o_orderkey * 769) % 1024 AS px, 768 * 256 + (o_orderkey // 1024 * 37 + o_orderkey * 5) % 1024 AS py,
    127 + CASE WHEN o_orderkey % 3 > 0 THEN 1 ELSE 0 END AS r, o_orderkey * 37 % 256 AS g,
    CAST(floor(o_totalprice) AS BIGINT) % 256 AS b FROM orders""")
_LON, _LAT = f"({D(-74.28)} + {D(-73.62 - -74.28)} * ({{}}) / {D(32)})", f"({D(40.47)} + {D(40.95 - 40.47)} * ({{}}) / {D(32)})"
_PX = f"(({{}} + 180) / 360 * 2048 * 256)"
_PY = f"((1 - asinh(tan(radians({{}}))) / pi()) / 2 * 2048 * 256)"
_view("cells", f"""
  SELECT i.k AS i, j.k AS j, round(({_LON.format("i.k")} + {_LON.format("i.k + 1")}) / 2, 4) AS lon,
    round(({_LAT.format("j.k")} + {_LAT.format("j.k + 1")}) / 2, 4) AS lat,
    floor({_PX.format(_LON.format("i.k"))}) AS px_lo, floor({_PX.format(_LON.format("i.k + 1"))}) AS px_hi,
    floor({_PY.format(_LAT.format("j.k + 1"))}) AS py_lo, floor({_PY.format(_LAT.format("j.k"))}) AS py_hi
  FROM (SELECT CAST(range AS INTEGER) AS k FROM range(32)) i CROSS JOIN (SELECT CAST(range AS INTEGER) AS k FROM range(32)) j""")
_view("elevation", """
  SELECT i, j, lon, lat, round_even(greatest(CAST(0 AS DOUBLE),
    avg(r * CAST(256 AS DOUBLE) + g + b / CAST(256 AS DOUBLE) - 32768)), 1) AS elev
  FROM cells JOIN pixels ON px >= px_lo AND px < greatest(px_lo + 1, px_hi) AND py >= py_lo AND py < greatest(py_lo + 1, py_hi)
  GROUP BY i, j, lon, lat""", "cells", "pixels")
_E2 = "(CAST(1 AS DOUBLE) / CAST(298.257223563 AS DOUBLE) * (2 - CAST(1 AS DOUBLE) / CAST(298.257223563 AS DOUBLE)))"
_view("parcels", f"""
  SELECT s_suppkey AS zone, {D(-74.28)} + {D(0.011)} * (s_suppkey % 50) + s_acctbal / {D(10000000)} AS x0,
    {D(40.47)} + {D(0.009)} * (s_suppkey // 50 % 2000) AS y0 FROM supplier""")
_view("parcel_ll", f"""
  SELECT zone, i, x0 + {D(0.006)} * dx AS lon, y0 + {D(0.005)} * dy AS lat FROM parcels,
    (VALUES (0, 0, 0), (1, 1, 0), (2, 1, 1), (3, 0, 1)) v(i, dx, dy)""", "parcels")
_view("plots", f"""
  SELECT zone * 2 AS ring, x0, y0, {D(0.006)} AS w, {D(0.005)} AS h FROM parcels
  UNION ALL SELECT (zone + 1000000) * 2, x0 - {D(0.003)}, y0 - {D(0.0017)}, {D(0.012)}, {D(0.0084)} FROM parcels WHERE zone % 5 = 0
  UNION ALL SELECT (zone + 1000000) * 2 + 1, x0 - {D(0.0015)}, y0 - {D(0.001)}, {D(0.009)}, {D(0.007)} FROM parcels WHERE zone % 5 = 0
  UNION ALL SELECT (zone + 2000000) * 2, x0 - {D(0.003)}, y0 - {D(0.0017)}, {D(0.012)}, {D(0.0084)} FROM parcels WHERE zone % 5 = 2""",
  "parcels")
_view("plot_ll", """
  SELECT ring AS zone, i, x0 + w * dx AS lon, y0 + h * dy AS lat FROM plots,
    (VALUES (0, 0, 0), (1, 1, 0), (2, 1, 1), (3, 0, 1)) v(i, dx, dy)""", "plots")


def _metric(name: str) -> None:
    """Corners on the UTM grid, sides, and the least distance of a corner from the sides of each ring near it."""
    _view(f"{name}_t", f"""
  SELECT zone, i, radians(lat) AS phi, {_E2} AS e2, {_E2} / (1 - {_E2}) AS ep2,
    cos(radians(lat)) * radians(lon + 75) AS a, tan(radians(lat)) ** 2 AS t,
    {_E2} / (1 - {_E2}) * cos(radians(lat)) ** 2 AS c,
    6378137 / sqrt(1 - {_E2} * sin(radians(lat)) ** 2) AS n FROM {name}_ll""", f"{name}_ll")
    _view(f"{name}_xy", f"""
  SELECT zone, i,
    500000 + {D(0.9996)} * n * (a + (1 - t + c) * a ** 3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * a ** 5 / 120) AS x,
    {D(0.9996)} * (6378137 * ((1 - e2 / 4 - 3 * e2 ** 2 / 64 - 5 * e2 ** 3 / 256) * phi
      - (3 * e2 / 8 + 3 * e2 ** 2 / 32 + 45 * e2 ** 3 / 1024) * sin(2 * phi)
      + (15 * e2 ** 2 / 256 + 45 * e2 ** 3 / 1024) * sin(4 * phi) - 35 * e2 ** 3 / 3072 * sin(6 * phi))
      + n * tan(phi) * (a * a / 2 + (5 - t + 9 * c + 4 * c * c) * a ** 4 / 24
      + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * a ** 6 / 720)) AS y
  FROM {name}_t""", f"{name}_t")
    _view(f"{name}_side", f"""
  SELECT p.zone, p.x AS x1, p.y AS y1, q.x - p.x AS dx, q.y - p.y AS dy
  FROM {name}_xy p JOIN {name}_xy q ON p.zone = q.zone AND q.i = (p.i + 1) % 4""", f"{name}_xy")
    _view(f"{name}_gap", f"""
  SELECT zp, zs, min(sqrt((px - x1 - k * dx) ** 2 + (py - y1 - k * dy) ** 2)) AS gap
  FROM (SELECT p.zone AS zp, s.zone AS zs, p.x AS px, p.y AS py, s.x1, s.y1, s.dx, s.dy,
      greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE),
        ((p.x - s.x1) * s.dx + (p.y - s.y1) * s.dy) / (s.dx * s.dx + s.dy * s.dy))) AS k
    FROM {name}_xy p JOIN {name}_side s ON p.zone <> s.zone AND abs(p.x - s.x1) < 3000 AND abs(p.y - s.y1) < 3000)
  GROUP BY zp, zs""", f"{name}_xy", f"{name}_side")


_metric("parcel")
_metric("plot")
