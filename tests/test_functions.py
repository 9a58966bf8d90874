import math
from datetime import datetime, timedelta, timezone
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pulseframe.functions import (
    bucket, classify, clip, display_number, display_percent, as_fraction, escape_html, hash_long, iso_millis, log_loss,
    parse_double, parse_int, safe_ratio, to_fixed,
)


def one(spark, values, schema, *cols):
    df = spark.createDataFrame([v if isinstance(v, tuple) else (v,) for v in values], schema)
    return [tuple(r) for r in df.coalesce(1).select(*cols).collect()]


def column(spark, values, schema, col):
    return [r[0] for r in one(spark, values, schema, col)]


def test_parse_int(spark):
    texts = ["72", " 72 ", "72.5", "-3.9", "+4", "5.", "", " ", "abc", "7x", "1e3", "NaN", "99999999999", None, "-", ".", ".5", "-.7"]
    assert column(spark, texts, "x string", parse_int(F.col("x"))) == [
        72, 72, 72, -3, 4, 5, None, None, None, None, None, None, None, None, None, 0, 0, 0,
    ]


def test_parse_double(spark):
    got = column(spark, ["0.95", " 1e3 ", "", "x", None, "NaN"], "x string", parse_double(F.col("x")))
    assert got[:5] == [0.95, 1000.0, None, None, None]
    assert math.isnan(got[5])


def test_clip_keeps_null(spark):
    got = column(spark, [0.2, 0.85, 0.9, 1.0, 1.2, None], "x double", clip(F.col("x"), 0.85, 1.0))
    assert got == [0.85, 0.85, 0.9, 1.0, 1.0, None]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=20))
def test_clip_is_idempotent(spark, values):
    once = clip(F.col("x"), -2.5, 7.0)
    for a, b in one(spark, values, "x double", once.alias("a"), clip(once, -2.5, 7.0).alias("b")):
        assert a == b and -2.5 <= a <= 7.0


def test_safe_ratio(spark):
    rows = [(10, 4), (10, 0), (10, -1), (None, 4), (10, None)]
    got = column(spark, rows, "n int, d int", safe_ratio(F.col("n"), F.col("d")))
    assert got == [2.5, 0.0, 0.0, None, 0.0]


def test_bucket_bounds(spark):
    rule = bucket(F.col("x"), [("<", 60, "low"), ("<=", 100, "mid")], "high")
    assert column(spark, [59, 60, 100, 101, None], "x int", rule) == ["low", "mid", "mid", "high", "high"]


def test_classify(spark):
    got = column(spark, [0.0, 0.49, 0.5, 1.0, float("nan"), None], "p double", classify(F.col("p")))
    assert got == ["healthy", "healthy", "unhealthy", "unhealthy", "unhealthy", None]


def exact_text(x, digits):
    """Rounds the exact binary value, ties away from zero."""
    step = Decimal(1).scaleb(-digits)
    text = str(abs(Decimal(x)).quantize(step, ROUND_HALF_UP))
    return ("-" if x < 0 else "") + text


TRICKY = [
    1.005, 0.125, 0.375, 2.675, 1.255, 8.345, 0.005, 0.015, -0.001, -1.005, 95.25, 95.45, 0.0, 1e9 + 0.125,
    1234567.885, 0.285, 4.35, 99.995, 1 / 3, 2**39 + 0.375, 5e-324, 1500000000000.5, 2.0**40 + 0.25, 2.0**53, -(2.0**52) - 0.5,
    2.0**64, 123456789012345680000.0, 999999999999999868928.0, 0.9999, 1.9996,
]


@pytest.mark.parametrize("digits", [1, 2, 3])
def test_to_fixed_tricky_values(spark, digits):
    got = column(spark, TRICKY, "x double", to_fixed(F.col("x"), digits))
    assert got == [exact_text(x, digits) for x in TRICKY]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(
    st.floats(min_value=-1e9, max_value=1e9),
    st.integers(-(10**9), 10**9).map(lambda n: n / 1000),
), min_size=1, max_size=50))
def test_to_fixed_matches_exact_decimal(spark, values):
    values = [v + 0.0 for v in values]
    got = one(spark, values, "x double", to_fixed(F.col("x"), 1), to_fixed(F.col("x"), 2))
    assert got == [(exact_text(x, 1), exact_text(x, 2)) for x in values]


def test_display(spark):
    numbers = column(spark, [80.0, 7.25, 7.255, -0.0, None, 7.0], "x double", display_number(F.col("x")))
    assert numbers == ["80", "7.25", exact_text(7.255, 2), "0", "-", "7"]
    assert column(spark, [80, None], "x int", display_number(F.col("x"))) == ["80", "-"]
    shares = column(spark, [0.95, 1.0, 0.9525, None], "x double", display_percent(F.col("x")))
    assert shares == ["95.0%", "100.0%", "95.3%", "-"]


def test_display_of_very_large_numbers(spark):
    """As a browser prints them: digits up to 1e21, then an exponent."""
    values = [1500000000000.5, 2.0**40 + 0.25, 2.0**53, 2.0**60, 123456789012345680000.0, 1e20, -1e20, 1e21, 1.5e300, float("inf"), float("-inf")]
    assert column(spark, values, "x double", display_number(F.col("x"))) == [
        "1500000000000.50", "1099511627776.25", "9007199254740992", "1152921504606847000",
        "123456789012345680000", "100000000000000000000",
        "-100000000000000000000", "1e+21", "1.5e+300", "Infinity", "-Infinity",
    ]
    assert column(spark, [1e21, -1.5e300, float("nan")], "x double", to_fixed(F.col("x"), 2)) == ["1e+21", "-1.5e+300", "NaN"]


def test_escape_html(spark):
    assert column(spark, ["<b>&\"x'", None], "x string", escape_html(F.col("x"))) == ["&lt;b&gt;&amp;\"x'", None]


def test_iso_millis_is_utc_in_any_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        zoned = iso_millis(F.timestamp_micros(F.col("x")))
        # the second one lies in the hour that is skipped in spring
        got = column(spark, [0, 1710052200000000, -1, None], "x bigint", zoned)
        assert got == ["1970-01-01T00:00:00.000Z", "2024-03-10T06:30:00.000Z", "1969-12-31T23:59:59.999Z", None]
        plain = iso_millis(F.to_timestamp_ntz(F.col("x")))
        assert column(spark, ["2024-03-10 02:30:00.1239"], "x string", plain) == ["2024-03-10T02:30:00.123Z"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_iso_millis(spark):
    plus_two = timezone(timedelta(hours=2))
    moment = datetime(2024, 1, 31, 23, 59, 59, 999999, tzinfo=plus_two)
    assert column(spark, [1], "x int", iso_millis(moment)) == ["2024-01-31T21:59:59.999Z"]
    stamped = iso_millis(F.timestamp_micros(F.col("x")))
    assert column(spark, [1706738399999999], "x bigint", stamped) == ["2024-01-31T21:59:59.999Z"]


def test_hash_fraction_is_uniform_and_stable(spark):
    df = spark.range(20000).select("id", as_fraction(hash_long([F.col("id")], 42)).alias("u"))
    low, high, mean = df.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= low < 0.01 and 0.99 < high < 1 and abs(mean - 0.5) < 0.01
    again = spark.range(0, 20000, 1, 3).select("id", as_fraction(hash_long([F.col("id")], 42)).alias("u"))
    assert df.exceptAll(again).isEmpty()


def test_log_loss(spark):
    rows = [(1, 0.9), (0, 0.2), (1, 0.0), (0, 1.0)]
    got = column(spark, rows, "y int, p double", log_loss(F.col("y"), F.col("p")))[0]
    cut = [(y, min(max(p, 1e-15), 1 - 1e-15)) for y, p in rows]
    want = sum(-math.log(p if y else 1 - p) for y, p in cut) / 4
    assert got == pytest.approx(want, rel=1e-9)
