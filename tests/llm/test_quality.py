from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pulseframe.llm import quality
from tests.llm.texts import frame, words


def plain(text):
    w, body = words(text), text or ""
    lines = [x for x in body.split("\n") if words(x)]
    seen = Counter(zip(w, w[1:], w[2:]))
    covered = {j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    symbols = sum(c in "#*$%&|<>" for c in body)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def measured(spark, texts):
    rows = quality.measure(frame(spark, list(enumerate(texts)))).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return {r["doc_id"]: tuple(r[c] for c in names) for r in rows}


EDGES = [
    None, "", " \n\t", "one", "a b", "a b c", "a a a a", "a b c a b c", "a b c b c a b c", "x\ny\nx\n\n\nx", "é 😀 é 😀 é 😀",
    "a b c", "# | <> % $ & *", "w " * 30_000, "\x0b\x0c", "a\r\nb\r\na\r\n",
]


def test_measurements(spark):
    assert measured(spark, EDGES) == {i: plain(t) for i, t in enumerate(EDGES)}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab \n|é", max_size=60), min_size=1, max_size=30))
def test_measurements_of_any_text(spark, texts):
    assert measured(spark, texts) == {i: plain(t) for i, t in enumerate(texts)}


GOOD = " ".join(f"word{i}" for i in range(60))


def test_policies_and_ablations(spark):
    texts = [GOOD, "short", GOOD.replace(" ", "$$$ "), GOOD.upper(), ("same line of text\n" + GOOD + "\n") * 3, "ho " * 80]
    rows = quality.ledger(frame(spark, list(enumerate(texts)))).persist()
    bits = {r["doc_id"]: r["failures"] for r in rows.collect()}
    assert bits[0] == 0 and bits[1] == quality.bit("too_few_words") and bits[2] == quality.bit("symbols")
    assert bits[3] == quality.bit("shouting") and bits[5] & quality.bit("repeated_words")
    verdict = {r["doc_id"]: (r["b"], r["v"]) for r in rows.select("doc_id", quality.fails("base").alias("b"), quality.fails("v1").alias("v")).collect()}
    assert verdict[0] == (False, False) and verdict[1] == (True, True) and verdict[2] == (False, True)
    cost = {r["rule"]: (r["n_failed"], r["n_only"]) for r in quality.ablations(rows).collect()}
    for rule in quality.POLICIES["v1"]:
        mine = quality.bit(rule)
        failed = [b for b in bits.values() if b & mine]
        assert cost.get(rule, (0, 0)) == (len(failed), sum(b & quality.mask("v1") == mine for b in bits.values()))


def test_keep_good_keeps_columns(spark):
    docs = frame(spark, [(1, GOOD, 7, "x"), (1, GOOD, 7, "x"), (None, GOOD, 8, None), (2, None, 9, "y")], "doc_id long, text string, n_words int, failures string")
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and sorted(r["n_words"] for r in kept.collect()) == [7, 7, 8]
    assert quality.keep_good(docs.limit(0)).count() == 0


def test_filter_does_not_repeat_the_measurements(spark):
    plan = quality.keep_good(frame(spark, [(1, GOOD)]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") <= 3 and "PythonUDF" not in plan


def test_characters_are_counted_without_a_list_of_them(spark):
    texts = ["Ab# é😀 $Z\n<|>", "", "ÀÉ", "😀", "&" * 5 + "q" * 70_000 + "Q"]
    df = quality.measure(frame(spark, list(enumerate(texts))))
    got = {r["doc_id"]: (r["n_symbols"], r["n_letters"], r["n_capitals"]) for r in df.collect()}
    letters = lambda t: sum(c.isascii() and c.isalpha() for c in t)
    assert got == {i: (sum(c in "#*$%&|<>" for c in t), letters(t), sum("A" <= c <= "Z" for c in t)) for i, t in enumerate(texts)}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "regexp_count" not in plan


@pytest.mark.parametrize("policy", sorted(quality.POLICIES))
def test_masks_name_their_rules(policy):
    assert quality.mask(policy) == sum(1 << i for i, rule in enumerate(quality.RULES) if rule in quality.POLICIES[policy])


def test_query_equals_plain(spark, tmp_path):
    from pulseframe.llm import queries
    from tests.llm.texts import table

    sf = table(spark, tmp_path, list(enumerate(EDGES)))
    rows = queries.op4_quality_rules(spark, sf).where(F.col("base_failed") & F.col("kept"))
    assert rows.count() == 0 and queries.op4_quality_rules(spark, sf).count() == len(EDGES)
