"""Streams against the batch answer, over several files and restarts."""

import math
import random
from datetime import timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rideloom.operators.quality import classify_rejects, quality_report, typed_parse
from rideloom.operators.sets import symmetric_difference
from rideloom.plans.tables import MONTH, RULES, raw_fields
from rideloom.schema import REASONS
from rideloom.streaming import replay, streams
from rideloom.workspace import exists, fresh_folder, remove


def _source(spark, sf_dir, files=4):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("ts").cast("timestamp").alias("ts"), (F.col("user_id") % 27).alias("zone")
    )
    path = fresh_folder(spark, "test-events")
    events.repartitionByRange(files, "ts").sortWithinPartitions("ts").write.parquet(path)
    return events, path


def _batch(events):
    return events.groupBy(F.date_trunc("minute", "ts").alias("minute"), "zone").agg(F.count("*").alias("trips"))


def test_minute_counts_over_several_batches(spark, sf_dir):
    events, path = _source(spark, sf_dir)
    stream = streams.open_files(spark, path, events.schema, files_per_batch=1)
    got = streams.run_upserts(streams.stream_minute_counts(stream), ["minute", "zone"])
    assert symmetric_difference(_batch(events), got).isEmpty()


def test_restart_continues_and_repeats_nothing(spark, sf_dir):
    events, path = _source(spark, sf_dir)
    root = fresh_folder(spark, "test-restart")

    def run():
        stream = streams.open_files(spark, path, events.schema, files_per_batch=2)
        return streams.run_upserts(streams.stream_minute_counts(stream), ["minute", "zone"], root)

    run()
    late = events.limit(50)
    late.write.mode("append").parquet(path)
    got = run()
    assert got.agg(F.sum("trips")).first()[0] == events.count() + 50


def test_watermark_holds_back_only_open_minutes(spark, sf_dir):
    events, path = _source(spark, sf_dir)
    stream = streams.stream_watermark(streams.open_files(spark, path, events.schema), "10 minutes")
    got = streams.run_appends(streams.stream_minute_counts(stream))
    newest = events.agg((F.max("ts") - F.expr("interval 10 minutes")).alias("m")).scalar()
    closed = _batch(events).filter(F.col("minute") + F.expr("interval 1 minute") <= newest)
    assert symmetric_difference(closed, got).isEmpty()


def test_late_rows_are_dropped(spark):
    root = fresh_folder(spark, "test-late")
    rows = [("2024-01-01 10:00:00", 1), ("2024-01-01 12:00:00", 1)]
    late = [("2024-01-01 10:00:30", 1), ("2024-01-01 12:30:00", 1)]
    schema = "ts string, zone int"
    for part in (rows, late):
        spark.createDataFrame(part, schema).withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode(
            "append").parquet(f"{root}/in")
        stream = streams.open_files(spark, f"{root}/in", "ts timestamp, zone int")
        got = streams.run_appends(
            streams.stream_minute_counts(streams.stream_watermark(stream, "10 minutes")), path=f"{root}/out"
        )
    assert sorted((str(r["minute"]), r["trips"]) for r in got.collect()) == [
        ("2024-01-01 10:00:00", 1), ("2024-01-01 12:00:00", 1)]


def test_rolling_rate_crosses_midnight(spark):
    slots = [0, 30, 59, 60, 1400, 1439, 1440, 1441, 1498, 1499, 2879, 2880, 2939]
    totals = spark.createDataFrame([(s, 1 + s % 7) for s in slots], "slot int, trips long")
    got = {r["slot"]: r["rate"] for r in replay.rolling_hour_rate(totals).collect()}
    for s in slots:
        window = sum(1 + x % 7 for x in slots if s - 59 <= x <= s)
        assert abs(got[s] - window * 60 / min(s + 1, 60)) < 1e-9
    assert len(got) == len(slots)


def test_replay_frame_wraps(spark):
    counts = spark.createDataFrame([(0, 1, 5), (9, 1, 7), (5, 2, 1)], "slot int, zone int, trips long")
    got = {r["zone"]: r["trips"] for r in replay.replay_frame(counts, 9, 3, 10).collect()}
    assert got == {1: 12}
    assert {r["zone"] for r in replay.replay_frame(counts, 24, 2, 10).collect()} == {2}
    assert replay.peak_minute(counts.limit(0)).first()["peak"] == 0


def test_changes_are_folded(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(streams, "FOLD_EVERY", 2)
    events, path = _source(spark, sf_dir, files=5)
    root = fresh_folder(spark, "test-fold")
    stream = streams.open_files(spark, path, events.schema, files_per_batch=1)
    got = streams.run_upserts(streams.stream_minute_counts(stream), ["minute", "zone"], root)
    assert symmetric_difference(_batch(events), got).isEmpty()
    assert exists(spark, f"{root}/folded") and not exists(spark, f"{root}/changes/batch=0")


def test_source_without_rows(spark, sf_dir):
    events, _ = _source(spark, sf_dir)
    empty = fresh_folder(spark, "test-empty")
    events.limit(0).write.parquet(empty)
    open_stream = lambda: streams.stream_watermark(streams.open_files(spark, empty, events.schema))
    assert streams.run_upserts(streams.stream_minute_counts(open_stream()), ["minute", "zone"]).count() == 0
    assert streams.run_appends(streams.stream_minute_counts(open_stream())).count() == 0


def _intensity_by_hand(events, k, span):
    minutes = {}
    for r in _batch(events).collect():
        minutes.setdefault(r["minute"], []).append((-r["trips"], r["zone"]))
    newest = events.agg(F.max("ts")).first()[0]
    peak, out = 0, []
    for minute in sorted(minutes):
        if minute + timedelta(minutes=11) > newest:
            continue
        total = -sum(n for n, _ in minutes[minute])
        peak = max(peak, total)
        for rank, (n, zone) in enumerate(sorted(minutes[minute])[:k], start=1):
            share = min(1.0, math.log1p(-n) / math.log1p(max(peak * span, 1) / 2))
            out.append((minute, total, peak, zone, -n, rank, round(share, 9)))
    return sorted(out)


def _rows(df):
    return sorted((r["minute"], r["total"], r["peak"], r["zone"], r["trips"], r["rank"], round(r["intensity"], 9)) for r in df.collect())


def test_intensity_goes_on_after_a_restart(spark, sf_dir):
    """The same rows whether the stream runs through, in several batches, or stops in the middle."""
    events, path = _source(spark, sf_dir, files=4)
    want = _intensity_by_hand(events, 3, 4)
    stream = lambda p, n=None: streams.stream_watermark(streams.open_files(spark, p, events.schema, files_per_batch=n))
    assert _rows(streams.stream_intensity(stream(path), 3, 4)) == want
    split, root = fresh_folder(spark, "test-halves"), fresh_folder(spark, "test-peak")
    middle = events.agg(F.expr("percentile_approx(ts, 0.5)")).first()[0]
    for half in (F.col("ts") <= middle, F.col("ts") > middle):  # one after the other: a file source goes by age
        events.filter(half).coalesce(1).write.mode("append").parquet(split)
        got = streams.stream_intensity(stream(split), 3, 4, path=root)
    assert _rows(got) == want
    assert _rows(streams.stream_intensity(stream(split, 1), 3, 4)) == want
    assert len({r[2] for r in want}) > 1


def test_late_rows_are_counted_apart(spark):
    root = fresh_folder(spark, "test-late-side")
    parts = [[("10:00:00", 1), ("12:00:00", 1)], [("10:00:30", 1), ("11:50:10", 2), ("11:49:59", 2), ("12:30:00", 1)], [], [("12:19:30", 1), (None, 1)]]
    for n, part in enumerate(parts):
        rows = [(t and f"2024-01-01 {t}", z) for t, z in part]
        spark.createDataFrame(rows, "ts string, zone int").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode(
            "append").parquet(f"{root}/in")
        if n in (0, 3):  # the second run gets three files one by one
            stream = streams.open_files(spark, f"{root}/in", "ts timestamp, zone int", files_per_batch=1)
            got = streams.run_counting_late(stream, 10, path=f"{root}/out")
    rows = {(str(r["minute"])[11:16] if r["minute"] else None, r["zone"]): (r["trips"], r["late"]) for r in got.collect()}
    assert rows == {("10:00", 1): (1, 1), ("12:00", 1): (1, 0), ("11:50", 2): (1, 0), ("11:49", 2): (0, 1), ("12:30", 1): (1, 0),
                    ("12:19", 1): (0, 1), (None, 1): (1, 0)}
    assert sum(a + b for a, b in rows.values()) == sum(map(len, parts))


def test_intensity_and_late_rows_of_an_empty_source(spark, sf_dir):
    events, _ = _source(spark, sf_dir)
    empty = fresh_folder(spark, "test-empty")
    events.limit(0).write.parquet(empty)
    open_stream = lambda: streams.open_files(spark, empty, events.schema)
    assert streams.stream_intensity(streams.stream_watermark(open_stream())).count() == 0
    assert streams.run_counting_late(open_stream()).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_replay_frames_against_slots(spark, seed):
    """Random counts and requests, spans over the wrap, the whole horizon, frames without trips."""
    rng, horizon = random.Random(seed), 50
    counts = [(rng.randrange(horizon), rng.randrange(4), rng.randrange(1, 9)) for _ in range(40)] + [(60, 1, 5)]
    requests = [(rng.randrange(-120, 120), rng.randrange(1, 51)) for _ in range(60)] + [(49, 1), (49, 2), (0, 50), (7, 50), (None, 3), (3, None)]
    index = replay.frame_index(spark.createDataFrame(counts, "slot int, zone int, trips long"), horizon)
    got = replay.replay_frames(index, spark.createDataFrame(requests, "m int, span int"), horizon)
    want = set()
    for m, span in requests:
        if m is None or span is None:
            continue
        frame = {}
        for slot, zone, n in counts:
            if slot < horizon and (slot - m) % horizon < span:
                frame[zone] = frame.get(zone, 0) + n
        want |= {(m % horizon, span, sum(frame.values()), z, n) for z, n in frame.items()} or {(m % horizon, span, 0, None, None)}
    rows = got.collect()
    assert len(rows) == len(want) and {tuple(r) for r in rows} == want
    with pytest.raises(PySparkException, match="span must be"):
        replay.replay_frames(index, spark.createDataFrame([(1, 61)], "m int, span int"), horizon).collect()


def test_counters_are_kept_once_a_batch(spark, sf_dir):
    """Two runs over growing input, one batch repeated after its commit is lost: sums equal the report of all rows."""
    fields = raw_fields(spark.read.parquet(f"{sf_dir}/events.parquet"))
    source, root = fresh_folder(spark, "test-fields"), fresh_folder(spark, "test-counters")
    for part in range(3):
        fields.filter(F.col("event_id") % 3 == part).coalesce(1).write.mode("append").parquet(source)
        if part:
            stream = streams.open_files(spark, source, fields.schema, files_per_batch=1)
            trips, counters = streams.run_validated(stream, MONTH, RULES, root)
    remove(spark, f"{root}/checkpoint/commits/2")
    remove(spark, f"{root}/checkpoint/commits/.2.crc")
    trips, counters = streams.run_validated(streams.open_files(spark, source, fields.schema, files_per_batch=1), MONTH, RULES, root)
    report = quality_report(classify_rejects(typed_parse(fields), MONTH, RULES)).first()
    rows = counters.collect()
    assert sorted(r["batch"] for r in rows) == [0, 1, 2]
    assert sum(r["input_rows"] for r in rows) == report["input"] == fields.count()
    assert sum(r["valid_rows"] for r in rows) == report["valid"] == trips.count()
    assert {name: n for name in REASONS if (n := sum(r[name] for r in rows))} == report["reasons"]
