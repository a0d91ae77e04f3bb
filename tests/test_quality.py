"""Validation rules, fixed point and key families on single rows."""

from datetime import date

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from rideloom.operators import families as fam
from rideloom.operators import quality
from rideloom.schema import RAW_FIELDS, Rules, month_arg_guard

GOOD = ("2025-01-02 12:00:00", "2025-01-02 12:10:00", "161", "162", "2.50", "12.34")
FIELDS = dict(zip(RAW_FIELDS, range(6)))
SCHEMA = ", ".join(f"{name} string" for name in RAW_FIELDS)


def line(**changes):
    row = list(GOOD)
    for name, value in changes.items():
        row[FIELDS[f"s_{name}"]] = value
    return tuple(row)


CASES = [
    (dict(pu="264"), "UnknownZone"),
    (dict(pu="1.5"), "UnknownZone"),
    (dict(pu="0"), "UnknownZone"),
    (dict(do="263"), None),
    (dict(pu="161.0"), None),
    (dict(miles="nan"), "NonFinite"),
    (dict(miles="NaN"), "NonFinite"),
    (dict(amount="inf"), "NonFinite"),
    (dict(amount="-Infinity"), "NonFinite"),
    (dict(dropoff="2025-01-02 11:00:00"), "InvalidDuration"),
    (dict(dropoff="2025-01-02 12:00:59"), "InvalidDuration"),
    (dict(dropoff="2025-01-02 12:00:59.999999"), "InvalidDuration"),
    (dict(dropoff="2025-01-02 12:01:00"), None),
    (dict(dropoff="2025-01-02 15:00:00"), None),
    (dict(dropoff="2025-01-02 15:00:01"), "InvalidDuration"),
    (dict(miles="0"), "InvalidDistance"),
    (dict(miles="100"), None),
    (dict(miles="1e2"), None),
    (dict(miles="100.001"), "InvalidDistance"),
    (dict(amount="-1"), "InvalidAmount"),
    (dict(amount="0"), None),
    (dict(amount="1000"), None),
    (dict(amount="1000.01"), "InvalidAmount"),
    (dict(pickup="2024-12-31 23:59:00"), "OutsideMonth"),
    (dict(pickup="2025-02-01 00:00:00", dropoff="2025-02-01 00:10:00"), "OutsideMonth"),
    (dict(pickup=""), "Malformed"),
    (dict(pickup="2025"), "Malformed"),
    (dict(pickup="2025-1-2 12:00:00.1"), "Malformed"),
    (dict(pickup="2025-01-02 12:00:00Z"), "Malformed"),
    (dict(pickup="2025-01-02T12:00:00"), None),
    (dict(pickup="2025-02-30 12:00:00"), "Malformed"),
    (dict(miles="1.0d"), "Malformed"),
    (dict(miles="0x1p3"), "Malformed"),
    (dict(miles="1 mile"), "Malformed"),
    (dict(miles=" 2.5 "), None),
    (dict(miles=".5"), None),
    (dict(miles="5."), None),
    (dict(amount=""), "Malformed"),
    (dict(pu=None), "Malformed"),
    # two rules broken: the earlier one is reported
    (dict(pu="264", miles="nan"), "NonFinite"),
    (dict(pu="264", pickup="2024-12-31 23:59:00"), "OutsideMonth"),
    (dict(pu="264", miles="0"), "UnknownZone"),
    (dict(miles="0", amount="-1"), "InvalidDistance"),
]


def test_rule_cases(spark):
    rows = [(i, *line(**changes)) for i, (changes, _) in enumerate(CASES)]
    raw = spark.createDataFrame(rows, f"i int, {SCHEMA}")
    classified = quality.classify_rejects(quality.typed_parse(raw), "2025-01")
    found = {row["i"]: row["reason"] for row in classified.select("i", "reason").collect()}
    assert {i: found[i] for i in range(len(CASES))} == {i: want for i, (_, want) in enumerate(CASES)}


def test_wrong_field_count_is_malformed(spark):
    raw = spark.createDataFrame([(*GOOD, True), (*GOOD, False)], f"{SCHEMA}, bad_shape boolean")
    reasons = [r["reason"] for r in quality.classify_rejects(quality.typed_parse(raw), "2025-01").collect()]
    assert reasons == ["Malformed", None]


def test_known_trip(spark):
    raw = spark.createDataFrame([GOOD], SCHEMA)
    trips = quality.valid_trips(raw, "2025-01")
    assert trips.first() == (161, 162, 12, date(2025, 1, 2), 2500, 600, 1234)
    rows = {row["kind"]: row for row in fam.key_families(trips).collect()}
    sums = (1, 2500, 600, 1234)
    assert tuple(rows["Z"]) == ("Z", 161, 12, None, None, *sums)
    assert tuple(rows["D"]) == ("D", None, None, date(2025, 1, 2), None, *sums)
    assert tuple(rows["O"]) == ("O", 161, None, None, 162, *sums)
    assert tuple(rows["T"]) == ("T", 161, 12, date(2025, 1, 2), None, *sums)


@pytest.mark.parametrize("value", [0.0005, 0.0015, 0.0025, 1.0005, 2.675, 33.3335, 99.9995, 0.1, 12.345])
def test_half_even_is_round(spark, value):
    from rideloom.functions.measures import half_even

    got = spark.range(1).select(half_even(F.lit(value), 1000).alias("v")).first()["v"]
    assert got == round(value * 1000)


def test_counters_come_with_another_action(spark):
    raw = spark.createDataFrame([line(), line(pu="265"), line(miles="nan")], SCHEMA)
    counters = Observation("q")
    observed = quality.quality_counters(quality.classify_rejects(quality.typed_parse(raw), "2025-01"), counters)
    assert observed.count() == 3
    assert counters.get["input_rows"] == 3 and counters.get["valid_rows"] == 1
    assert counters.get["UnknownZone"] == 1 and counters.get["NonFinite"] == 1


def test_limits_are_parameters(spark):
    raw = spark.createDataFrame([line(pu="300", do="1", amount="5000")], SCHEMA)
    loose = Rules(zone_hi=500, amount_hi=10_000)
    assert quality.classify_rejects(quality.typed_parse(raw), "2025-01", loose).first()["reason"] is None


@pytest.mark.parametrize("month", ["2025-13", "1999-01", "2025-1", "2025-01-01", "", "x2025-01"])
def test_month_guard(month):
    with pytest.raises(ValueError):
        month_arg_guard(month)


def test_parsed_fields_are_evaluated_once(spark):
    """No parsing or pattern may be repeated by the filter on valid rows."""
    raw = spark.createDataFrame([GOOD], SCHEMA).repartition(2)
    plan = quality.valid_trips(raw, "2025-01")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast(s_miles") == 1


def test_rejected_rows_cannot_fail_a_later_join(spark):
    """Conversions may run before the filter on valid rows; NaN must not stop the job there."""
    raw = spark.createDataFrame([line(), line(pu="nan"), line(miles="inf"), line(pu="1e300")], SCHEMA).repartition(3)
    trips = quality.valid_trips(raw, "2025-01")
    wanted = spark.createDataFrame([(161,)], "zone int").hint("merge")
    assert trips.join(wanted, "zone", "left_semi").count() == 1
    assert trips.filter("zone + dest + distance_milli_miles > 0").count() == 1
