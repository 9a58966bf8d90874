"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger row keeps the measurements and one long whose
bit i says that rule i failed. Policies are versioned masks over those bits, so a new policy, or the
question what one rule costs, needs no second look at the texts.

Only DataFrame functions are used. Nothing is shuffled except the few rows of ``ablations``.

Defined cases: a null text counts as empty; a text without words has zero measurements and fails
``too_few_words``; repeated rows, null ids and extra columns pass through unchanged; an empty table
gives an empty ledger. Ledger columns replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SPACES = " \t\n\x0b\x0c\r"
GAP = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"
NOT_SYMBOL, NOT_LETTER, NOT_CAPITAL = r"[^#*$%&|<>]+", r"[^A-Za-z]+", r"[^A-Z]+"

#: rule name -> SQL condition for failing it; the position is the bit. Append only: ledgers on disk keep their meaning.
RULES = {
    "too_few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > 2 * n_words",
    "duplicate_lines": "2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
    "shouting": "n_letters > 0 AND 10 * n_capitals > 6 * n_letters",
}

BASE_RULES = ("too_few_words", "repeated_words")

#: version -> rules that reject
POLICIES = {
    "base": BASE_RULES,
    "v1": (*BASE_RULES, "symbols", "duplicate_lines", "short_words", "long_words", "shouting"),
}
CURRENT = "v1"

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_capitals",
)

# The key of a window is its hash with the lowest bits replaced by its position, so that sorting longs
# brings equal windows together; equal keys are confirmed on the words themselves.
_KEYS = """
transform(slice(_words, 1, size(_words) - 2),
  (w, i) -> (xxhash64(w, get(_words, i + 1), get(_words, i + 2)) & ~_mask) | cast(i AS BIGINT))"""

_SAME = """
coalesce((k & ~_mask) = (get(_keys, j {side} 1) & ~_mask)
  AND get(_words, cast(k & _mask AS INT)) = get(_words, cast(get(_keys, j {side} 1) & _mask AS INT))
  AND get(_words, cast(k & _mask AS INT) + 1) = get(_words, cast(get(_keys, j {side} 1) & _mask AS INT) + 1)
  AND get(_words, cast(k & _mask AS INT) + 2) = get(_words, cast(get(_keys, j {side} 1) & _mask AS INT) + 2), false)"""

_REPEATED = f"""
sort_array(transform(filter(_keys, (k, j) -> {_SAME.format(side='-')} OR {_SAME.format(side='+')}), k -> k & _mask))"""

_COVERED = """
aggregate(_at, struct(cast(-3 AS BIGINT) AS last, 0L AS n),
  (a, p) -> struct(p AS last, a.n + least(3L, p - a.last) AS n), a -> a.n)"""


def words(text: Column) -> Column:
    """The words of a text: runs without ASCII white space."""
    stripped = F.btrim(text, F.lit(SPACES))
    return F.when(stripped != "", F.split(stripped, GAP)).otherwise(F.array().cast("array<string>"))


def count_others(text: Column, pattern: str) -> Column:
    """Characters that are left without the matches of ``pattern``. Counting matches by ``regexp_count`` would
    list each of them, here almost every character of a text, as an object."""
    return F.char_length(F.regexp_replace(text, pattern, "")).cast("long")


def settled(df: DataFrame) -> DataFrame:
    """``df`` with its columns computed before any filter above: a filter that is pushed into expressions
    over arrays would repeat them for every element. A row number cannot be moved, nor what tests it."""
    return df.withColumn("_row", F.monotonically_increasing_id()).where("_row >= 0").drop("_row")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns MEASURES (all long)."""
    kept = [c for c in docs.columns if c not in MEASURES]
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    df = docs.select(*kept, body.alias("_body"), words(body).alias("_words"), lines.alias("_lines"))
    # as many position bits as the text needs, the rest is hash
    mask = F.expr("shiftleft(1L, cast(ceil(log2(size(_words) + 1)) AS INT)) - 1L")
    df = df.withColumn("_mask", mask)
    none = F.array().cast("array<bigint>")
    df = df.withColumn("_keys", F.when(F.size("_words") > 3, F.sort_array(F.expr(_KEYS))).otherwise(none))
    df = df.withColumn("_at", F.when(F.size("_keys") > 0, F.expr(_REPEATED)).otherwise(none))
    return settled(df.select(
        *kept,
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        count_others(F.col("_body"), NOT_SYMBOL).alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr(_COVERED).alias("n_repeat_words"),
        count_others(F.col("_body"), NOT_LETTER).alias("n_letters"),
        count_others(F.col("_body"), NOT_CAPITAL).alias("n_capitals"),
    ))


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def mask(policy: str) -> int:
    """The bits that a policy version rejects."""
    return sum(bit(rule) for rule in POLICIES[policy])


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with MEASURES and ``failures``, the bits of all failed rules."""
    bits = [F.when(F.expr(condition), bit(rule)).otherwise(0).cast("long") for rule, condition in RULES.items()]
    failures = bits[0]
    for other in bits[1:]:
        failures = failures.bitwiseOR(other)
    return measure(docs, text).withColumn("failures", failures)


def fails(policy: str, failures: str = "failures") -> Column:
    """Whether a policy version rejects a ledger row."""
    return F.col(failures).bitwiseAND(F.lit(mask(policy)).cast("long")) != 0


def ablations(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents that fail it, and those that only it rejects.

    The ledger is first counted per failure mask; there are at most 2^rules of them, whatever the corpus.
    """
    per_mask = rows.groupBy("failures").agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(bit(r)).cast("long").alias("bit")) for r in POLICIES[policy]])
    each = per_mask.select("failures", "n", F.explode(rules).alias("r"))
    rejected = F.col("failures").bitwiseAND(F.lit(mask(policy)).cast("long"))
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("failures").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(rejected == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
        F.bit_or(rejected).alias("seen"),
    )


def keep_good(docs: DataFrame, policy: str = CURRENT, text: str = "text") -> DataFrame:
    """The documents that a policy version accepts, with their own columns."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(text).alias("_text"))
    return ledger(whole, "_text").where(~fails(policy)).select("_doc.*")
