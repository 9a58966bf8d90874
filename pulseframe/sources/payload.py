"""Stream payloads: topic routing, decoding, validation. All functions take batch and
streaming frames alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pulseframe import fixed

KEPT, ANOMALY, ERROR = "kept", "anomaly", "error"
OUT_OF_RANGE = "heart rate out of range"
_FIELDS = (
    f"{fixed.CITIZEN}: string, {fixed.TIMESTAMP}: bigint, {fixed.HEART_RATE}: double, "
    f"{fixed.O2}: double, {fixed.SLEEP}: double, {fixed.CALORIES}: int"
)
_FLAT_OBJECT = r"^[ \t\r\n]*+\{[^{}]*+\}[ \t\r\n]*+$"
# else an object with a repeated key is no object, and the session would decide about a message's route
_DUPLICATES = "spark.sql.variant.allowDuplicateKeys"
# strict JSON: no quoted or bare NaN as a number, no single quotes
_STRICT = {"allowNonNumericNumbers": "false", "allowSingleQuotes": "false", "columnNameOfCorruptRecord": "_bad"}


def select_topic(df: DataFrame, topic: str = fixed.TOPIC, topic_col: str = "topic") -> DataFrame:
    """Every field of the messages on one topic."""
    return df.where(F.col(topic_col) == topic).drop(topic_col)


def _text(data: Column) -> Column:
    """base64 -> UTF-8 text, NULL when it is neither. Characters outside the base64
    alphabet are skipped, like common lenient decoders do; the cleaning runs only for
    text that is not plain base64."""
    strict = F.try_to_binary(data, F.lit("base64"))
    lenient = F.try_to_binary(F.regexp_replace(data, "[^A-Za-z0-9+/=]", ""), F.lit("base64"))
    return F.try_validate_utf8(F.coalesce(strict, lenient).cast("string"))


def _object(text: Column) -> Column:
    """The text as VARIANT if it is exactly one JSON object, else NULL.

    Spark's parsers stop at the end of the first value. An object without inner braces
    cannot be followed by anything. Else the text must parse inside an array, alone, and
    inside an object: whatever follows the value breaks one of the two.
    """
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    held = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))).isNotNull()
    opens = text.rlike(r"^[ \t\r\n]*\{")
    return F.when(text.rlike(_FLAT_OBJECT) | (opens & alone & held), F.try_parse_json(text))


def decode_payload(df: DataFrame, col: str = "data", out: str = "payload") -> DataFrame:
    """base64 -> UTF-8 -> JSON object as VARIANT; anything else gives NULL."""
    decoded = df.withColumn("_text", _text(F.col(col)))
    return decoded.withColumn(out, _object(F.col("_text"))).drop("_text")


def read_fields(df: DataFrame, payload: str = "payload") -> DataFrame:
    """The record's fields from a decoded payload; unreadable values are NULL."""
    read = df.withColumn("_record", F.try_variant_get(payload, "$", f"struct<{_FIELDS}>"))
    return read.withColumns({c: F.col("_record")[c] for c in fixed.RAW_COLUMNS}).drop("_record")


def route(df: DataFrame, col: str = "data") -> DataFrame:
    """Add the record's fields, ``route`` (kept / anomaly / error) and ``reason``.

    Order of the checks: unreadable payload -> error; heart rate absent or boolean ->
    anomaly (it counts as 0 or 1); not a number -> error; outside the valid range ->
    anomaly; no citizen or timestamp -> error; else kept.

    A message whose fields all have their types is read directly. Only the others are
    parsed as VARIANT, whose types tell an absent value from a null and a number from a
    quoted number.
    """
    if df.sparkSession.conf.get(_DUPLICATES, "false") != "true":
        raise ValueError(f"set {_DUPLICATES} to true: repeated JSON keys keep their last value")
    text = F.col("_text")
    direct = F.when(text.rlike(_FLAT_OBJECT), F.from_json(text, f"struct<{_FIELDS}, _bad: string>", _STRICT))
    read = df.withColumn("_text", _text(F.col(col))).withColumn("_direct", direct)
    typed = F.col("_direct._bad").isNull() & F.col(f"_direct.{fixed.HEART_RATE}").isNotNull()
    read = read.withColumn("_typed", typed).withColumn("_payload", F.when(~typed, _object(text)))

    v = F.col("_payload")
    rate_type = F.schema_of_variant(F.try_variant_get(v, f"$.{fixed.HEART_RATE}", "variant"))
    read = read.withColumns(
        {
            "_kind": F.when(F.col("_typed"), "DOUBLE").otherwise(rate_type),
            "_record": F.when(~F.col("_typed"), F.try_variant_get(v, "$", f"struct<{_FIELDS}>")),
        }
    )
    fields = read.withColumns(
        {
            c: F.when(F.col("_typed"), F.col(f"_direct.{c}")).otherwise(F.col(f"_record.{c}"))
            for c in fixed.RAW_COLUMNS
        }
    )

    kind, rate = F.col("_kind"), F.col(fixed.HEART_RATE)
    numeric = kind.isin("DOUBLE", "BIGINT", "FLOAT") | kind.startswith("DECIMAL")
    reason = (
        F.when(numeric & ~rate.between(*fixed.HEART_RATE_RANGE), OUT_OF_RANGE)
        .when(numeric & F.col(fixed.CITIZEN).isNull(), "no citizen")
        .when(numeric & F.col(fixed.TIMESTAMP).isNull(), "no timestamp")
        .when(numeric, None)
        .when(v.isNull(), "payload is not a JSON object")
        .when(kind.isNull() | (kind == "BOOLEAN"), OUT_OF_RANGE)
        .otherwise("heart rate is not a number")
    )
    judged = fields.withColumn("reason", reason)
    side = F.when(F.col("reason").isNull(), KEPT).when(F.col("reason") == OUT_OF_RANGE, ANOMALY).otherwise(ERROR)
    return judged.withColumn("route", side).drop("_text", "_direct", "_typed", "_payload", "_kind", "_record")


def route_counts(df: DataFrame) -> DataFrame:
    """Records stored and dropped, and records that failed."""
    count = lambda name: F.count_if(F.col("route") == name)
    return df.agg(
        count(KEPT).alias("stored"), count(ANOMALY).alias("dropped"), count(ERROR).alias("failed")
    )
