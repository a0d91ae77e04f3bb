"""Sources and sinks: shards, manifests, documents, archive, publishing."""

from dataclasses import replace
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rideloom.operators import families as fam
from rideloom.operators.quality import classify_rejects, typed_parse
from rideloom.operators.sets import symmetric_difference
from rideloom.plans.tables import MONTH, RULES, Tables
from rideloom.schema import RAW_FIELDS, SUM4
from rideloom.sources import archive, documents, drift, hashtree, manifest, publish, registry, snapshots, trips
from rideloom.workspace import create_text, exists, fresh_folder, list_names, shared_root


@pytest.fixture(scope="module")
def t(spark, sf_dir):
    return Tables(spark, sf_dir)


@pytest.fixture
def shards(spark, t):
    path = fresh_folder(spark, "test-shards")
    trips.write_shards(t.raw.select(*RAW_FIELDS), path, 128)
    return path


def test_shards_are_bounded_and_whole(spark, t, shards):
    rows = manifest.shard_manifest(spark, shards)
    assert rows.agg(F.max("rows")).first()[0] <= 128
    totals = manifest.manifest_totals(rows).first()
    assert totals["rows"] == t.events.count() and totals["shards"] >= 8
    back = trips.read_raw(spark, shards).drop("bad_shape")
    # an empty field comes back as null; both are malformed
    assert symmetric_difference(t.raw.select(*RAW_FIELDS).replace("", None), back.replace("", None)).isEmpty()


def test_hash_is_sha256(spark, tmp_path):
    import hashlib

    text = "a,b\nc,d\n"
    (tmp_path / "part-0.csv").write_text(text)
    row = manifest.shard_manifest(spark, str(tmp_path)).first()
    assert (row["rows"], row["sha256"]) == (2, hashlib.sha256(text.encode()).hexdigest())


def test_verify_detects_changes(spark, shards):
    known = manifest.shard_manifest(spark, shards).collect()
    schema = "name string, rows long, bytes long, sha256 string"
    manifest.verify_manifest(spark, shards, spark.createDataFrame(known, schema), rows=1000)
    with pytest.raises(ValueError, match="rows"):
        manifest.verify_manifest(spark, shards, spark.createDataFrame(known, schema), rows=999)
    with pytest.raises(ValueError, match="unexpected"):
        manifest.verify_manifest(spark, shards, spark.createDataFrame(known[1:], schema))
    forged = [known[0].__class__(*known[0][:3], "0" * 64), *known[1:]]
    with pytest.raises(ValueError, match="corrupted"):
        manifest.verify_manifest(spark, shards, spark.createDataFrame(forged, schema))


def test_publish_once(spark, shards):
    rows, root = manifest.shard_manifest(spark, shards), fresh_folder(spark, "test-publish")
    first, written = manifest.publish_once(spark.range(5).toDF("n"), rows, root)
    second, again = manifest.publish_once(spark.range(9).toDF("n"), rows, root)
    assert (written, again) == (True, False) and first == second
    assert spark.read.parquet(second).count() == 5
    other = manifest.fingerprint(rows.withColumn("sha256", F.reverse("sha256"))).first()[0]
    assert not first.endswith(other)
    assert manifest.fingerprint(rows.orderBy(F.desc("name"))).first()[0] == manifest.fingerprint(rows).first()[0]


def test_quoted_fields_and_wrong_counts(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        '"2025-01-02 12:00:00",2025-01-02 12:10:00,161,"162",2.5,12.34\n'
        "2025-01-02 12:00:00,2025-01-02 12:10:00,161,162,2.5\n"
        "2025-01-02 12:00:00,2025-01-02 12:10:00,161,162,2.5,12.34,7\n"
        "\n"
        "  \t\n"
        "2025-01-02 12:00:0Z,2025-01-02 12:10:00,161,162,2.5,12.34\n"
        "2025-01-02 12:00:5 ,2025-01-02 12:10:00,161,162,2.5,12.34\n"
    )
    lines = classify_rejects(typed_parse(trips.read_raw(spark, str(tmp_path))), "2025-01")
    assert [r["reason"] for r in lines.collect()] == [None, *["Malformed"] * 6]


def test_projection_reaches_the_scan(spark, sf_dir):
    df = trips.read_trips(spark, f"{sf_dir}/events.parquet", ("ts", "value")).filter("value > 10")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in plan
    assert "GreaterThan(value,10.0)" in plan


def test_head_sample(spark):
    df = spark.range(100).select((F.lit(99) - F.col("id")).alias("k"))
    assert [r["k"] for r in trips.head_sample(df, ("k",), 3).collect()] == [0, 1, 2]
    assert trips.head_sample(df, ("k",), 0).count() == 0


def test_schema_drift(spark):
    old = spark.createDataFrame([(datetime(2019, 1, 1), datetime(2019, 1, 1, 1), 5, 6, 1.5, 10.0)], [
        "lpep_pickup_datetime", "lpep_dropoff_datetime", "PULocationID", "DOLocationID", "trip_distance", "total_amount"])
    lacking = spark.createDataFrame([(1,)], ["PULocationID"])
    got = archive.normalize_schema_drift([lacking, old])
    assert got.columns == list(archive.TYPES) and got.count() == 1
    with pytest.raises(ValueError):
        archive.normalize_schema_drift([lacking])


def test_archive_prunes_folders(spark, t):
    path = fresh_folder(spark, "test-archive")
    hourly = t.trips.drop("pickup", "event_id")
    archive.write_archive(hourly, path)
    part = archive.read_archive(spark, path, "Z", (2024, 2024))
    assert part.count() == hourly.count() == archive.read_archive(spark, path).count()
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "dest" not in plan.split("ReadSchema")[1]


def test_hot_month_is_written_by_several_tasks(spark):
    """Nine rows of ten lie in one month: its folder gets several files, the others one each."""
    day = F.when(F.col("id") % 10 > 0, F.lit(date(2024, 3, 5))).otherwise(F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 50).cast("int")))
    rows = spark.range(0, 200_000, 1, 8).select(day.alias("day"), F.lit("D").alias("kind"), F.xxhash64("id").alias("cents"))
    path = fresh_folder(spark, "test-hot")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    try:
        archive.write_archive(rows, path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    back = archive.read_archive(spark, path)
    names = back.select("month", F.input_file_name().alias("name")).distinct()
    files = {r["month"]: r["count"] for r in names.groupBy("month").count().collect()}
    assert back.count() == 200_000 and files[3] > 2 and min(files[1], files[2]) <= 2


def test_columnar_json(spark):
    doc = '{"hourly":{"time":["2025-01-01T00:00","2025-01-01T13:00"],"temperature_2m":[1.5,null]}}'
    docs = spark.createDataFrame([(doc,)], "value string")
    rows = documents.explode_columnar(docs, "hourly", ("temperature_2m",)).collect()
    assert [tuple(r) for r in rows] == [(date(2025, 1, 1), 0, 1.5), (date(2025, 1, 1), 13, None)]
    daily = '{"daily":{"time":["2025-01-01"],"precipitation_sum":[3.0]}}'
    rows = documents.explode_columnar(spark.createDataFrame([(daily,)], "value string"), "daily", ("precipitation_sum",))
    assert tuple(rows.first()) == (date(2025, 1, 1), None, 3.0)


def test_keyed_lines(spark):
    lines = spark.createDataFrame(
        [("Z|001|08", "1,2,3,4"), ("Q|Malformed", "7,0,0,0"), ("T|2025-01-02|161|12", "1,2500,600,1234")], "key string, value string"
    )
    rows = {r["kind"]: r for r in documents.keyed_decode(lines).collect()}
    assert (rows["Z"]["zone"], rows["Z"]["hour"], rows["Z"]["cents"]) == (1, 8, 4)
    assert (rows["Q"]["reason"], rows["Q"]["trips"]) == ("Malformed", 7)
    assert (rows["T"]["day"], rows["T"]["zone"], rows["T"]["hour"]) == (date(2025, 1, 2), 161, 12)
    for bad in (("X|1", "1,2,3,4"), ("Z|001|08", "1,2,3")):
        with pytest.raises(PySparkException, match="bad aggregate line"):
            documents.keyed_decode(spark.createDataFrame([bad], "key string, value string")).collect()


def test_monthly_job_publishes_and_replaces(spark, t):
    root = fresh_folder(spark, "test-month")
    assert publish.run_month(t.raw, MONTH, root, RULES).first()["ok"]
    publish.publish_result(fam.key_families(t.trips).filter("kind = 'D'"), "2023-12", root)
    again = publish.read_result(spark, root, MONTH).select("kind", "zone", "hour", "day", "dest", *SUM4)
    assert symmetric_difference(fam.key_families(t.trips), again).isEmpty()
    assert publish.read_result(spark, root).select("month").distinct().first()[0] == "2023-12"
    rejects = {r["reason"]: r["rows"] for r in publish.read_rejects(spark, root, MONTH).collect()}
    assert sum(rejects.values()) == t.classified.filter("reason is not null").count()
    assert publish.read_rejects(spark, root).isEmpty()
    clean = publish.analysis(spark, root, t.zones, "2023-12")["quality"].first()
    assert (clean["rejected"], clean["reasons"]) == (0, {})
    with pytest.raises(ValueError):
        publish.publish_result(t.trips, "24-01", root)


def test_run_records(spark, tmp_path):
    (tmp_path / "a.json").write_text('{\n "run_id": "a", "month": "2025-01", "status": "RUNNING", "started_at": "2"\n}')
    (tmp_path / "b.json").write_text('{"run_id": "b", "month": "2025-01", "status": "SUCCEEDED", "started_at": "3"}')
    rows = registry.run_registry(registry.read_runs(spark, str(tmp_path))).collect()
    assert [(r["run_id"], r["status"]) for r in rows] == [("b", "SUCCEEDED"), ("a", "FAILED")]
    assert rows[1]["error"] == registry.INTERRUPTED
    assert len(registry.run_registry(registry.read_runs(spark, str(tmp_path)), 1).collect()) == 1


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


def _months(spark, root, version=None):
    rows = snapshots.read_months(spark, root, version).groupBy("year", "month").agg(F.sum("cents").alias("c")).collect()
    return {f"{r['year']}-{r['month']:02d}": r["c"] for r in rows}


def _days(spark, first, n, cents):
    return spark.range(n).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("day"), F.lit(cents).cast("long").alias("cents"))


def test_a_month_is_replaced_while_others_read(spark):
    """A reader that has begun, and one pinned to the old version, see none of the new files."""
    root = fresh_folder(spark, "test-snapshots")
    first = snapshots.replace_months(_days(spark, date(2024, 1, 15), 60, 1), root)
    assert first.version == 1 and sorted(first.months) == ["2024-01", "2024-02", "2024-03"]
    begun = snapshots.read_months(spark, root).repartition(8).toLocalIterator()
    rows = [next(begun) for _ in range(5)]
    second = snapshots.replace_months(_days(spark, date(2024, 2, 1), 3, 100), root, ["2024-02"])
    rows += list(begun)
    assert len(rows) == 60 and sum(r["cents"] for r in rows) == 60
    assert _months(spark, root, 1) == {"2024-01": 17, "2024-02": 29, "2024-03": 14}
    assert _months(spark, root) == {"2024-01": 17, "2024-02": 300, "2024-03": 14}
    assert {m for m in second.months if second.months[m] == first.months.get(m)} == {"2024-01", "2024-03"}


def test_two_writers(spark):
    root = fresh_folder(spark, "test-writers")
    base = snapshots.replace_months(_days(spark, date(2024, 1, 1), 60, 1), root).version
    snapshots.replace_months(_days(spark, date(2024, 1, 1), 1, 5), root, based_on=base)
    snapshots.replace_months(_days(spark, date(2024, 2, 1), 1, 7), root, based_on=base)  # another month: no conflict
    with pytest.raises(snapshots.MonthChanged):
        snapshots.replace_months(_days(spark, date(2024, 1, 1), 1, 9), root, based_on=base)
    assert _months(spark, root) == {"2024-01": 5, "2024-02": 7} and snapshots.versions(spark, root) == [1, 2, 3]
    assert not create_text(spark, f"{root}/log/{3:020d}", "{}")
    assert len(list_names(spark, f"{root}/log")) == 3


def test_empty_and_foreign_months(spark):
    root = fresh_folder(spark, "test-months")
    snapshots.replace_months(_days(spark, date(2024, 1, 1), 60, 1), root)
    snapshots.replace_months(_days(spark, date(2024, 1, 1), 0, 1), root, ["2024-01"])
    assert _months(spark, root) == {"2024-02": 29}
    for rows, months in ((_days(spark, date(2024, 3, 1), 2, 1), ["2024-02"]), (spark.sql("select cast(null as date) day, 1L cents"), None)):
        with pytest.raises(PySparkException, match="no month to replace"):
            snapshots.replace_months(rows, root, months)
    with pytest.raises(ValueError, match="yyyy-MM"):
        snapshots.replace_months(_days(spark, date(2024, 3, 1), 2, 1), root, ["2024-3"])
    assert _months(spark, root) == {"2024-02": 29} and snapshots.snapshot(spark, root).version == 2
    plan = snapshots.read_months(spark, root, 1, months=("2024-02", "2024-02"))
    assert plan.count() == 29 and len(plan.inputFiles()) <= 2
    assert snapshots.read_months(spark, root, 1, months=("2031-01", "2031-02")).count() == 0


def test_old_versions_are_expired(spark):
    root = fresh_folder(spark, "test-expire")
    for n in range(4):
        snapshots.replace_months(_days(spark, date(2024, 1, 1), 40 if n == 0 else 3, n), root)
    gone = snapshots.expire(spark, root, keep=2)
    assert len(gone) == 2 and not any(exists(spark, folder) for folder in gone)
    assert snapshots.versions(spark, root) == [3, 4]
    assert _months(spark, root, 3) == {"2024-01": 6, "2024-02": 0} and _months(spark, root) == {"2024-01": 9, "2024-02": 0}
    assert snapshots.expire(spark, root, keep=2) == []
    with pytest.raises(ValueError):
        snapshots.expire(spark, root, keep=0)


def test_thousands_of_files_give_one_scan_a_schema(spark):
    """2,000 files of three usable schemas and some that lack columns: three scans."""
    path = fresh_folder(spark, "test-drift")
    kinds = [("tpep_", "int", "double"), ("lpep_", "double", "double"), ("tpep_", "long", "string")]
    for n, (prefix, zone, amount) in enumerate(kinds):
        spark.range(n * 10_000, (n + 1) * 10_000, 1, 1).select(
            F.lit(datetime(2024, 1, 1)).alias(f"{prefix}pickup_datetime"), F.lit(datetime(2024, 1, 2)).alias(f"{prefix}dropoff_datetime"),
            F.col("id").cast(zone).alias("PULocationID"), F.col("id").cast(zone).alias("DOLocationID"),
            F.col("id").cast("double").alias("trip_distance"), F.col("id").cast(amount).alias("total_amount"), F.lit(n).alias(f"note_{n % 2}"),
        ).write.option("maxRecordsPerFile", 15).parquet(f"{path}/{n}")
    spark.range(3).write.parquet(f"{path}/other")
    df = drift.read_drifting(spark, path)
    assert len(df.inputFiles()) == 2001
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 3
    sums = df.agg(F.count("*"), F.sum("pu"), F.sum("amount"), F.count("amount")).first()
    assert tuple(sums) == (30_000, 449_985_000.0, 449_985_000.0, 30_000)
    assert drift.file_schemas(spark, path).select("signature").distinct().count() == 4
    with pytest.raises(ValueError):
        drift.read_drifting(spark, f"{path}/other")


def test_hash_tree_by_hand(spark, tmp_path, monkeypatch):
    import hashlib

    monkeypatch.setattr(hashtree, "FAN_OUT", 3)
    sha = lambda x: hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()
    content = {"part-0": b"a,b\n" * 57, "part-1": b"", "part-2": b"x\n" * 5}
    for name, raw in content.items():
        (tmp_path / name).write_bytes(raw)
    chunks = hashtree.chunk_hashes(spark, str(tmp_path), 10)
    del content["part-1"]  # no rows, no chunks
    want = {(n, i, raw[i * 10 : i * 10 + 10]) for n, raw in content.items() for i in range(max(1, -(-len(raw) // 10)))}
    assert {tuple(r) for r in chunks.collect()} == {(n, i, len(b), b.count(b"\n"), sha(b)) for n, i, b in want}

    def root(raw):
        level = [sha(raw[i : i + 10]) for i in range(0, max(len(raw), 1), 10)]
        for _ in range(3):  # all shards have the height of the tallest
            level = [sha("\n".join(level[i : i + 3])) for i in range(0, len(level), 3)]
        return level[0]

    got = {r["name"]: (r["chunks"], r["bytes"], r["rows"], r["digest"]) for r in hashtree.shard_digests(chunks).collect()}
    assert got == {n: (max(1, -(-len(raw) // 10)), len(raw), raw.count(b"\n"), root(raw)) for n, raw in content.items()}


def test_dataset_is_checked_before_it_is_used_again(spark, t):
    folder, made = fresh_folder(spark, "test-dataset"), []
    request = hashtree.Request(MONTH, "events", 0, 300, RAW_FIELDS)

    def make():
        made.append(1)
        trips.write_shards(t.raw.select(*RAW_FIELDS), folder, 300)
        return t.raw.count()

    first = hashtree.open_dataset(spark, folder, request, make, 5000)
    assert hashtree.open_dataset(spark, folder, request, make, 5000) == first and made == [1]
    assert (first["rows"], first["source_rows"], first["sampling"]) == (t.events.count(), t.events.count(), "all rows")
    for other in ({"requested_rows": 5}, {"shard_rows": 301}, {"columns": RAW_FIELDS[:5]}, {"source": "x"}):
        with pytest.raises(hashtree.OtherRequest, match=next(iter(other))):
            hashtree.open_dataset(spark, folder, replace(request, **other), make)
    path = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).agg(F.min("path")).first()[0]
    local = path.removeprefix("file:")
    raw = bytearray(open(local, "rb").read())
    raw[7000] ^= 1
    open(local, "wb").write(raw)
    Path(local).with_name(f".{Path(local).name}.crc").unlink(missing_ok=True)
    name = local.rsplit("/", 1)[1]
    with pytest.raises(hashtree.Corrupted, match=rf"{name}', 1, 'corrupted'"):
        hashtree.open_dataset(spark, folder, request, make)
    Path(local).unlink()
    assert {r["status"] for r in hashtree.chunk_differences(spark, folder).collect()} == {"missing"}
    with pytest.raises(ValueError, match="requested_rows"):
        hashtree.Request(MONTH, "events", -1, 300, RAW_FIELDS)


def test_runs_without_a_pointer_are_expired(spark, t):
    """An open reader finishes on the old run; without it, and once old enough, the run goes."""
    root = fresh_folder(spark, "test-retention")
    families = fam.key_families(t.trips)
    publish.publish_result(families, MONTH, root)
    with publish.reading(spark, root, MONTH) as old:
        publish.publish_result(families.filter("kind = 'D'"), MONTH, root)
        assert publish.expire_runs(spark, root, min_age=0) == []
        assert old.count() == families.count() and set(old.columns) == set(publish.read_result(spark, root).columns)
    publish.publish_result(families.filter("kind = 'Z'"), "2023-12", root)
    assert list_names(spark, f"{root}/leases") == []
    assert publish.expire_runs(spark, root, min_age=3600) == []
    gone = publish.expire_runs(spark, root, min_age=0)
    assert len(gone) == 1 and not exists(spark, gone[0])
    assert publish.read_result(spark, root, MONTH).select("kind").distinct().collect() == [("D",)]
    assert publish.read_result(spark, root).select("kind").distinct().collect() == [("Z",)]


def test_leases_of_lost_readers_end(spark, t):
    root, lost = fresh_folder(spark, "test-leases"), []
    for _ in range(2):
        publish.publish_result(fam.key_families(t.trips).filter("kind = 'D'"), MONTH, root)
        lost.append(publish.reading(spark, root))
        lost[-1].__enter__()
    assert publish.expire_runs(spark, root, min_age=0) == []
    assert len(publish.expire_runs(spark, root, min_age=0, lease_age=-1)) == 1
    assert publish.read_result(spark, root).count() > 0
