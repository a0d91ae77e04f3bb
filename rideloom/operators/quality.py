"""Row validation: parse, classify, convert to integer fixed point."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rideloom.functions.measures import elapsed_seconds, half_even, ratio_or_zero, truncated
from rideloom.functions.once import computed_once
from rideloom.schema import RAW_FIELDS, REASONS, TYPED_FIELDS, Rules, month_arg_guard

# What counts as a time or a number; casts alone accept more ("2025", "1.0d", "0x1p3").
_TIME_TEXT = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?)?$"
_NUMBER_TEXT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:nan|inf|infinity))\s*$"


def _time(text: str) -> Column:
    """The usual ``yyyy-MM-dd HH:mm:ss`` is told by its separators and digits; other text goes by the pattern."""
    col = F.col(text)
    usual = (F.length(col) == 19) & (F.translate(col, "0123456789", "") == "-- ::")
    for place, mark in ((5, "-"), (8, "-"), (11, " "), (14, ":"), (17, ":")):
        usual = usual & (F.substring(col, place, 1) == mark)
    return F.when(usual | col.rlike(_TIME_TEXT), col.try_cast("timestamp_ntz"))


def _number(text: str) -> Column:
    """A last digit and no hexadecimal x settle the usual case; other text goes by the pattern."""
    col = F.col(text)
    usual = F.substring(col, -1, 1).between("0", "9") & ~col.contains("x") & ~col.contains("X")
    return F.when(usual | col.rlike(_NUMBER_TEXT), col.try_cast("double"))


def typed_parse(raw: DataFrame) -> DataFrame:
    """Add the typed form of the six text fields; what does not parse is null."""
    parsers = (_time, _time, _number, _number, _number, _number)
    return computed_once(raw, {
        typed: parse(text) for text, typed, parse in zip(RAW_FIELDS, TYPED_FIELDS, parsers)
    })


def rule_malformed() -> Column:
    broken = F.lit(False)
    for name in TYPED_FIELDS:
        broken = broken | F.col(name).isNull()
    return broken


def rule_nonfinite() -> Column:
    bad = F.lit(False)
    for name in ("pu", "do_", "miles", "amount"):
        bad = bad | F.isnan(name) | (F.abs(F.col(name)) == float("inf"))
    return bad


def rule_outside_month(month: str) -> Column:
    year, number = map(int, month_arg_guard(month).split("-"))
    first = date(year, number, 1)
    following = date(year + number // 12, number % 12 + 1, 1)
    pickup = F.col("pickup")
    return ~(
        (pickup >= F.lit(first.isoformat()).cast("timestamp_ntz"))
        & (pickup < F.lit(following.isoformat()).cast("timestamp_ntz"))
    )


def rule_zone(lo: int, hi: int) -> Column:
    def known(name: str) -> Column:
        col = F.col(name)
        return (col == F.floor(col)) & col.between(lo, hi)

    return ~(known("pu") & known("do_"))


def rule_duration(lo: float, hi: float) -> Column:
    return ~elapsed_seconds(F.col("pickup"), F.col("dropoff")).between(lo, hi)


def rule_distance(hi: float) -> Column:
    return ~((F.col("miles") > 0) & (F.col("miles") <= hi))


def rule_amount(hi: float) -> Column:
    return ~F.col("amount").between(0, hi)


def rule_ranges(rules: Rules = Rules()) -> Column:
    """True where duration, distance or amount lies outside its range."""
    return (
        rule_duration(rules.seconds_lo, rules.seconds_hi)
        | rule_distance(rules.miles_hi)
        | rule_amount(rules.amount_hi)
    )


def classify_rejects(df: DataFrame, month: str, rules: Rules = Rules()) -> DataFrame:
    """Add ``reason``: the first failing rule, null for a valid trip.

    A boolean column ``bad_shape`` (from the line reader) marks lines with a wrong field count.
    """
    malformed = rule_malformed()
    if "bad_shape" in df.columns:
        malformed = F.col("bad_shape") | malformed
    checks = (
        malformed,
        rule_nonfinite(),
        rule_outside_month(month),
        rule_zone(rules.zone_lo, rules.zone_hi),
        rule_duration(rules.seconds_lo, rules.seconds_hi),
        rule_distance(rules.miles_hi),
        rule_amount(rules.amount_hi),
    )
    reason = F
    for name, failed in zip(REASONS, checks):
        reason = reason.when(failed, F.lit(name))
    return computed_once(df, {"reason": reason})


def valid_rows(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("reason").isNull())


def fixed_point(df: DataFrame, mode: str = "half_even", keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed valid rows to trips with integer measures.

    ``mode="trunc"`` cuts instead of rounding; it exists for parity with archives written that way.
    """
    if mode not in ("half_even", "trunc"):
        raise ValueError(f"unknown mode {mode!r}")
    to_int = half_even if mode == "half_even" else truncated
    return df.select(
        *keep,
        F.col("pu").try_cast("int").alias("zone"),
        F.col("do_").try_cast("int").alias("dest"),
        F.hour("pickup").alias("hour"),
        F.to_date("pickup").alias("day"),
        to_int(F.col("miles"), 1000).alias("distance_milli_miles"),
        to_int(elapsed_seconds(F.col("pickup"), F.col("dropoff"))).alias("seconds"),
        to_int(F.col("amount"), 100).alias("cents"),
    )


def valid_trips(raw: DataFrame, month: str, rules: Rules = Rules(), keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw text lines to typed trips, rejects dropped."""
    return fixed_point(valid_rows(classify_rejects(typed_parse(raw), month, rules)), keep=keep)


def reject_histogram(classified: DataFrame) -> DataFrame:
    return (
        classified.filter(F.col("reason").isNotNull())
        .groupBy("reason")
        .agg(F.count("*").alias("rows"))
    )


def quality_counters(classified: DataFrame, observation: Observation) -> DataFrame:
    """Count input, valid and rejected rows while another action reads the frame."""
    reason = F.col("reason")
    return classified.observe(
        observation,
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(reason.isNull()).alias("valid_rows"),
        *[F.count_if(reason == name).alias(name) for name in REASONS],
    )


def quality_report(classified: DataFrame) -> DataFrame:
    """One row over the whole dataset; filters of later queries do not touch it."""
    reason = F.col("reason")
    counts = classified.agg(
        F.count(F.lit(1)).alias("input"),
        F.count_if(reason.isNull()).alias("valid"),
        *[F.count_if(reason == name).alias(name) for name in REASONS],
    )
    return counts.select(
        "input",
        "valid",
        (F.col("input") - F.col("valid")).alias("rejected"),
        ratio_or_zero(F.col("valid") * F.lit(100.0), F.col("input")).alias("valid_pct"),
        F.map_filter(
            F.create_map(*[part for name in REASONS for part in (F.lit(name), F.col(name))]),
            lambda _, rows: rows > 0,
        ).alias("reasons"),
    )


def archive_filter(df: DataFrame, years: tuple[int, int], rules: Rules = Rules()) -> DataFrame:
    """Typed rows inside every range and inside the year window; no reasons kept.

    The bounds also drop nulls and NaN (NaN sorts above every number).
    """
    first = F.lit(f"{years[0]:04d}-01-01").cast("timestamp_ntz")
    after = F.lit(f"{years[1] + 1:04d}-01-01").cast("timestamp_ntz")
    return df.filter(
        (F.col("pickup") >= first)
        & (F.col("pickup") < after)
        & F.col("pu").between(rules.zone_lo, rules.zone_hi)
        & F.col("do_").between(rules.zone_lo, rules.zone_hi)
        & (F.col("miles") > 0)
        & (F.col("miles") <= rules.miles_hi)
        & F.col("amount").between(0, rules.amount_hi)
        & elapsed_seconds(F.col("pickup"), F.col("dropoff")).between(rules.seconds_lo, rules.seconds_hi)
    )
