"""Numeric column expressions. All are built-in expressions, so they stay inside
whole-stage code generation."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

# whole or decimal text without an exponent: the text forms an integer column accepts
_INTEGER_TEXT = r"^\s*[+-]?(\d+(\.\d*)?|\.\d*)\s*$"
# from here on a browser prints numbers with an exponent
EXPONENT_FROM = 1e21


def parse_int(col: Column) -> Column:
    """Text -> INT; a fraction is cut off ('72.5' -> 72, '.5' -> 0), anything else is NULL."""
    whole = F.substring_index(F.trim(col), ".", 1)
    digits = F.when(whole.isin("", "+", "-"), "0").otherwise(whole)
    return F.when(col.rlike(_INTEGER_TEXT), digits.try_cast("int"))


def parse_double(col: Column) -> Column:
    """Text -> DOUBLE, unreadable text is NULL instead of an ANSI error."""
    return F.trim(col).try_cast("double")


def clip(col: Column, low: float, high: float) -> Column:
    """Move values outside [low, high] onto the nearer bound; NULL stays NULL
    (``greatest``/``least`` would skip the NULL and return the bound)."""
    return F.when(col < low, F.lit(low)).when(col > high, F.lit(high)).otherwise(col)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator where the denominator is positive, else 0.0."""
    return (
        F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0)).cast("double")
    )


def log_loss(label: Column, probability: Column, eps: float = 1e-15) -> Column:
    """Mean binary cross-entropy (an aggregate expression)."""
    p = clip(probability.cast("double"), eps, 1.0 - eps)
    return F.avg(-F.when(label == 1, F.log(p)).when(label == 0, F.log(1.0 - p)))


def exponential(x: Column) -> Column:
    """The text of very large, infinite and undefined numbers: 1.5e+21, Infinity, NaN."""
    return F.replace(F.replace(x.cast("string"), F.lit(".0E"), F.lit("E")), F.lit("E"), F.lit("e+"))


def _halves(size: Column) -> tuple[Column, Column]:
    """The whole part of a double from 0 to EXPONENT_FROM as high * 2**32 + low."""
    high = F.floor(size / 2.0**32)
    return high, F.floor(size - high.cast("double") * 2.0**32)


def _joined(high: Column, low: Column) -> Column:
    return high.cast("decimal(12,0)") * F.lit(Decimal(2**32)) + low.cast("decimal(11,0)")


def _bound(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, however often it is used; the code stays small."""
    return F.element_at(F.transform(F.array(value), then), 1)


def whole_text(x: Column) -> Column:
    """Text of a whole number below EXPONENT_FROM: the fewest digits that name the double, then zeros."""

    def shortest(exact: Column) -> Column:
        n, text = F.length(exact.cast("string")), exact
        for digits in (17, 16, 15):  # beyond 2**53 the last digits say nothing
            step = F.rpad(F.lit("1"), F.greatest(n - digits + 1, F.lit(1)), "0").cast("decimal(22,0)")
            rounded = F.floor((exact + F.floor(step / 2)) / step) * step
            same = (exact >= 2**53) & (rounded.cast("double") == exact.cast("double"))
            text = F.when(same, rounded).otherwise(text)
        return text.cast("decimal(22,0)").cast("string")

    exact = _bound(F.abs(x), lambda size: _joined(*_halves(size)))
    return F.concat(F.when(x < 0, "-").otherwise(""), _bound(exact, shortest))


def to_fixed(value: Column, digits: int) -> Column:
    """Decimal text with ``digits`` places of the exact binary value, ties away from
    zero - what a browser prints. ``format_string`` rounds the shortest decimal form
    instead and differs there (1.005 -> 1.01 rather than 1.00).

    The whole part is exact as two halves of 32 bits and more. y counts half steps of the
    fraction's last place, so rounding is (floor(y) + 1) / 2. The double y can only
    mislead where it is an odd integer, a tie, while the exact product lies just below;
    the product's error shows that, and splitting x in two halves whose products are
    exact gives the error exactly.
    """
    q = 2.0 * 10**digits

    def parts(size: Column) -> Column:
        high, low = _halves(size)
        x = (size - high.cast("double") * 2.0**32) - low.cast("double")
        return F.struct(high.alias("high"), low.alias("low"), x.alias("x"))

    def steps(p: Column) -> Column:
        x = p["x"]
        y = x * q
        spread = x * 134217729.0  # 2**27 + 1
        high = spread - (spread - x)
        error = (high * q - y) + (x - high) * q
        false_tie = (y % 2.0 == 1.0) & (error < 0)
        rounded = F.shiftright(F.floor(y) + 1, 1) - F.when(false_tie, 1).otherwise(0)
        return F.struct(p["high"].alias("high"), p["low"].alias("low"), rounded.alias("steps"))

    def text(p: Column) -> Column:
        carry = F.when(p["steps"] == 10**digits, 1).otherwise(0)
        whole = _joined(p["high"], p["low"] + carry)
        places = F.lpad((p["steps"] - carry * 10**digits).cast("string"), digits, "0")
        return F.concat(whole.cast("string"), F.lit("."), places)

    size = F.abs(value.cast("double"))
    small = F.when(size < EXPONENT_FROM, size)
    sign = F.when(value < 0, "-").otherwise("")
    return F.coalesce(F.concat(sign, _bound(_bound(_bound(small, parts), steps), text)), exponential(value.cast("double")))
