"""Display text."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F

from pulseframe.functions.numeric import EXPONENT_FROM, exponential, to_fixed, whole_text

def iso_millis(moment: Column | datetime) -> Column:
    """UTC time as ISO text with milliseconds (finer digits cut off), in any session time zone.

    Zoned timestamps are moved to UTC; those without a zone are taken as UTC.
    """
    if isinstance(moment, datetime):
        utc = moment.astimezone(timezone.utc)
        return F.lit(f"{utc:%Y-%m-%dT%H:%M:%S}.{utc.microsecond // 1000:03d}Z")
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    utc = F.timestamp_add("MICROSECOND", F.unix_micros(moment.cast("timestamp")), epoch)
    # the type is known when the plan is made, so only one branch is left of it
    plain = F.when(F.typeof(moment) == "timestamp", utc).otherwise(moment.cast("timestamp_ntz")).cast("string")
    millis = F.rpad(F.substring(plain, 21, 3), 3, "0")
    return F.concat(F.replace(F.substring(plain, 1, 19), F.lit(" "), F.lit("T")), F.lit("."), millis, F.lit("Z"))


def display_number(col: Column) -> Column:
    """Whole numbers as they are, others with two places, '-' for NULL."""
    x = col.cast("double")
    whole = whole_text(F.when(F.abs(x) < EXPONENT_FROM, x))
    return (
        F.when(x.isNull(), "-")
        .when(F.abs(x) >= EXPONENT_FROM, exponential(x))
        .when((F.abs(x) >= 2.0**53) | (F.floor(x) == x), whole)
        .otherwise(to_fixed(x, 2))
    )


def escape_html(text: Column) -> Column:
    """Text as it may stand between the tags of a page."""
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def display_percent(col: Column) -> Column:
    """A fraction as percent with one place, '-' for NULL."""
    x = col.cast("double")
    return F.when(x.isNull(), "-").otherwise(F.concat(to_fixed(x * 100.0, 1), F.lit("%")))
