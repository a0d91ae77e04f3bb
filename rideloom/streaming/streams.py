"""The replay as Structured Streaming: an event source in, per-minute tables out."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from rideloom.operators.quality import classify_rejects, fixed_point, quality_counters, typed_parse, valid_rows
from rideloom.operators.ranking import top_k_per_frame
from rideloom.schema import REASONS, Rules
from rideloom.workspace import exists, fresh_folder, read_text, remove, replace_text


def open_files(spark: SparkSession, path: str, schema, glob: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """A Parquet folder as a stream."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def stream_watermark(sdf: DataFrame, delay: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """Rows older than the newest event minus ``delay`` count as too late; state behind it is dropped."""
    return sdf.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def stream_minute_counts(sdf: DataFrame, ts: str = "ts") -> DataFrame:
    """Trips per tumbling minute and zone."""
    minute = F.window(ts, "1 minute").alias("w")
    return sdf.groupBy(minute, "zone").agg(F.count("*").alias("trips")).select(
        F.col("w.start").alias("minute"), "zone", "trips"
    )


def stream_hour_rate(sdf: DataFrame, ts: str = "ts") -> DataFrame:
    """Trips per hour over the trailing 60 minutes, for every minute.

    Minutes are counted first; only those totals, not the events, enter the sixty windows each.
    The stream must carry a watermark; results appear once a window is closed.
    """
    minutes = sdf.groupBy(F.window(ts, "1 minute").alias("minute")).agg(F.count("*").alias("trips"))
    sliding = F.window(F.window_time("minute"), "60 minutes", "1 minute").alias("w")
    return minutes.groupBy(sliding).agg(F.sum("trips").alias("rate")).select(F.col("w.end").alias("until"), "rate")


def stream_quality(sdf: DataFrame, month: str, rules: Rules = Rules()) -> DataFrame:
    """Rows per reject reason on a stream of text fields; ``Valid`` counts the rest."""
    classified = classify_rejects(typed_parse(sdf), month, rules)
    return classified.groupBy(F.coalesce("reason", F.lit("Valid")).alias("reason")).agg(F.count("*").alias("rows"))


def _start(df: DataFrame, mode: str, handle, checkpoint: str) -> StreamingQuery:
    return (
        df.writeStream.outputMode(mode)
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


#: Micro-batches after which the changes of a stream are folded into one table.
FOLD_EVERY = 20


def run_upserts(df: DataFrame, keys: Sequence[str], path: str | None = None) -> DataFrame:
    """Run a stream to the end of its input in update mode; return the final value of every key.

    Each micro-batch writes its changed rows to a folder of its own, so a repeated batch replaces
    itself; the result keeps the row of the latest batch per key. Every ``FOLD_EVERY`` batches the changes so
    far become one table, named by a pointer that is replaced in one step, and are removed.
    """
    spark = df.sparkSession
    root = path or fresh_folder(spark, "upserts")
    schema = _with_batch(df.schema)
    values = [name for name in df.columns if name not in keys]

    def folded() -> int:
        return int(read_text(spark, f"{root}/folded")) if exists(spark, f"{root}/folded") else -1

    def latest() -> DataFrame:
        done = folded()
        rows = spark.createDataFrame([], schema)
        if exists(spark, f"{root}/changes"):
            rows = spark.read.schema(schema).parquet(f"{root}/changes").filter(F.col("batch") > done)
        if done >= 0:
            rows = rows.unionByName(
                spark.read.schema(df.schema).parquet(f"{root}/base-{done}").withColumn("batch", F.lit(done).cast("long")))
        return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("v")).select(*keys, "v.*")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/changes/batch={batch_id}")
        if batch_id % FOLD_EVERY == FOLD_EVERY - 1 and folded() < batch_id:
            before = folded()
            latest().select(*df.columns).write.mode("overwrite").parquet(f"{root}/base-{batch_id}")
            replace_text(spark, f"{root}/folded", str(batch_id))
            for old in range(before + 1, batch_id):
                remove(spark, f"{root}/changes/batch={old}")
            remove(spark, f"{root}/base-{before}")

    _start(df, "update", write, f"{root}/checkpoint").awaitTermination()
    return latest().select(*df.columns)


def run_appends(df: DataFrame, shape=None, path: str | None = None) -> DataFrame:
    """Run a stream to the end of its input in append mode; return all rows written.

    ``shape`` turns the rows of one micro-batch into what is stored. Closed windows arrive in one
    batch with all their rows.
    """
    spark = df.sparkSession
    root = path or fresh_folder(spark, "appends")
    schema = shape(spark.createDataFrame([], df.schema)).schema if shape else df.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        out = shape(batch) if shape else batch
        out.write.mode("overwrite").parquet(f"{root}/rows/batch={batch_id}")

    _start(df, "append", write, f"{root}/checkpoint").awaitTermination()
    if not exists(spark, f"{root}/rows"):  # a source without rows starts no batch
        return spark.createDataFrame([], schema)
    return spark.read.schema(_with_batch(schema)).parquet(f"{root}/rows").drop("batch")


def _with_batch(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField("batch", LongType())])


def stream_top_zones(sdf: DataFrame, k: int = 5, path: str | None = None) -> DataFrame:
    """The k busiest zones of every closed minute. The stream must carry a watermark."""
    counts = stream_minute_counts(sdf)

    def rank(batch: DataFrame) -> DataFrame:
        frames = batch.select(F.col("minute").alias("slot"), "zone", "trips")
        return top_k_per_frame(frames, k).withColumnRenamed("slot", "minute")

    return run_appends(counts, rank, path)


_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def _keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which arbitrary state needs."""
    before = spark.conf.get(_STATE_STORE)
    spark.conf.set(_STATE_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_STATE_STORE, before)


class RunningPeak(StatefulProcessor):
    """Adds to every closed minute the largest minute total seen up to it.

    One row a minute arrives, whatever the number of trips; the state is one number.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._peak = handle.getValueState("peak", "total long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        minutes = pd.concat(list(rows)).sort_values("minute")  # one micro-batch may close many
        peak = minutes["total"].cummax().clip(lower=self._peak.get()[0] if self._peak.exists() else 0)
        self._peak.update((int(peak.iloc[-1]),))
        yield minutes.assign(peak=peak)[["minute", "total", "zones", "trips", "peak"]]

    def close(self) -> None:
        pass


def stream_intensity(sdf: DataFrame, k: int = 5, span: int = 1, path: str | None = None) -> DataFrame:
    """The k busiest zones of every closed minute with their intensity.

    Columns ``minute``, ``total``, ``peak`` (the largest total of a minute so far), ``zone``, ``trips``, ``rank``,
    ``intensity``: log1p(trips) / log1p(max(peak * span, 1) / 2), at most 1. The stream must carry a watermark; the
    peak is state of the stream, so a restart goes on with it.
    """
    counts = sdf.groupBy(F.window("ts", "1 minute").alias("w"), "zone").agg(F.count("*").alias("trips"))
    ranked = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("trips")).alias("less"), F.col("zone").cast("long").alias("zone")))), 1, k)
    minutes = counts.groupBy(F.window(F.window_time("w"), "1 minute").alias("w")).agg(
        F.sum("trips").alias("total"), ranked.alias("top")
    ).select(
        F.col("w.start").alias("minute"), "total", F.col("top.zone").alias("zones"),
        F.transform("top.less", lambda n: -n).alias("trips"), F.lit(0).alias("all"))
    schema = "minute timestamp, total long, zones array<long>, trips array<long>, peak long"
    peaked = minutes.groupBy("all").transformWithStateInPandas(RunningPeak(), schema, "append", "none")

    def shape(batch: DataFrame) -> DataFrame:
        half = F.log1p(F.greatest(F.col("peak") * span, F.lit(1)) / F.lit(2.0))
        return batch.select("minute", "total", "peak", F.posexplode(F.arrays_zip("zones", "trips")).alias("at", "t")).select(
            "minute", "total", "peak", F.col("t.zones").alias("zone"), F.col("t.trips").alias("trips"),
            (F.col("at") + 1).alias("rank"),
            F.round(F.least(F.lit(1.0), F.log1p("t.trips") / half), 12).alias("intensity"))

    with _keyed_state(sdf.sparkSession):
        return run_appends(peaked, shape, path)


def run_counting_late(sdf: DataFrame, delay_minutes: int = 10, ts: str = "ts", path: str | None = None) -> DataFrame:
    """Run a stream to the end of its input; trips per minute and zone, with those that came too late by themselves.

    Columns ``minute``, ``zone``, ``trips`` (on time), ``late``; on time and late together are the input. A row is too
    late if its minute had ended by the watermark of its micro-batch: the newest event of all batches before, less
    the delay. Counts of both kinds come from the same batch and are stored together in a folder named after it, so
    a repeated batch replaces itself; the newest event of each batch is noted beside them.
    """
    spark = sdf.sparkSession
    root = path or fresh_folder(spark, "late")
    minute = F.date_trunc("minute", ts)

    def newest_before(batch_id: int) -> str | None:
        return read_text(spark, f"{root}/newest-{batch_id - 1}") or None if batch_id else None

    def write(batch: DataFrame, batch_id: int) -> None:
        before = newest_before(batch_id)
        mark = F.lit(before).cast("timestamp") - F.make_dt_interval(mins=F.lit(delay_minutes))
        late = F.coalesce(minute + F.expr("interval 1 minute") <= mark, F.lit(False))
        batch.groupBy(minute.alias("minute"), "zone").agg(
            F.count_if(~late).alias("trips"), F.count_if(late).alias("late"), F.max(ts).alias("newest"),
        ).write.mode("overwrite").parquet(f"{root}/counts/batch={batch_id}")
        newest = spark.read.parquet(f"{root}/counts/batch={batch_id}").agg(F.max("newest").cast("string")).first()[0]
        replace_text(spark, f"{root}/newest-{batch_id}", max(filter(None, (before, newest)), default=""))

    _start(sdf, "append", write, f"{root}/checkpoint").awaitTermination()
    schema = StructType([StructField("minute", TimestampType()), sdf.schema["zone"], StructField("trips", LongType()), StructField("late", LongType())])
    if not exists(spark, f"{root}/counts"):
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(_with_batch(schema)).parquet(f"{root}/counts")
    return stored.groupBy("minute", "zone").agg(F.sum("trips").alias("trips"), F.sum("late").alias("late"))


def run_validated(fields: DataFrame, month: str, rules: Rules = Rules(), path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Run a stream of text fields to its end; typed valid trips, and the counters of every micro-batch.

    The counters (``batch``, ``input_rows``, ``valid_rows``, one column per reason) are observed while the batch's trips are
    written, so no row is read twice, and stored under the batch's id before the batch is committed: a batch that is
    repeated after a failure replaces its trips and its counters, and none is counted twice or lost.
    """
    spark = fields.sparkSession
    root = path or fresh_folder(spark, "validated")
    names = ("input_rows", "valid_rows", *REASONS)

    def typed(batch: DataFrame, seen: Observation) -> DataFrame:
        return fixed_point(valid_rows(quality_counters(classify_rejects(typed_parse(batch), month, rules), seen)))

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation("batch")
        typed(batch, seen).write.mode("overwrite").parquet(f"{root}/trips/batch={batch_id}")
        replace_text(spark, f"{root}/counters/{batch_id:020d}", json.dumps({"batch": batch_id, **{n: seen.get[n] for n in names}}))

    _start(fields, "append", write, f"{root}/checkpoint").awaitTermination()
    trips = typed(spark.createDataFrame([], fields.schema), Observation("none")).schema
    counters = ", ".join(f"{name} long" for name in ("batch", *names))
    if not exists(spark, f"{root}/counters"):
        return spark.createDataFrame([], trips), spark.createDataFrame([], counters)
    return (spark.read.schema(_with_batch(trips)).parquet(f"{root}/trips").drop("batch"),
            spark.read.schema(counters).json(f"{root}/counters"))
