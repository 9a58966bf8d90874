import random
import zlib

import numpy as np
import pytest

from pulseframe.llm import language, queries
from tests.llm.texts import frame, table

PARTS = {
    "en": ["the", "thing", "ing", "and", "that", "with", "over", "under"],
    "de": ["der", "ung", "schaft", "lich", "über", "und", "nicht", "straße"],
    "ru": ["при", "вет", "мир", "нет", "да", "хорошо"],
}


def document(rng, lang, n=40):
    return " ".join("".join(rng.choice(PARTS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def corpus(n=400):
    rng = random.Random(5)
    return [(i, document(rng, lang), lang) for i in range(n) for lang in [rng.choice(list(PARTS))]]


@pytest.fixture(scope="module")
def model(spark):
    return language.fit(frame(spark, corpus(), "doc_id long, text string, lang string"))


def test_held_out_accuracy(spark, tmp_path):
    rows = corpus()
    sf = table(spark, tmp_path, [*rows, (9000, None, "en"), (9001, "123 !?", None), (9002, "的 是", None), (9003, "ሰላም", None)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in queries.op2_language_id(spark, sf).collect()}
    for i, _, lang in rows:
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert got[i]["lang_pred"] == lang and 0 <= got[i]["score"] <= 1
    assert [(got[i]["lang_pred"], got[i]["score"]) for i in (9000, 9001)] == [("und", 0.0)] * 2
    # letters of a script that nobody taught still get a learned language
    assert got[9002]["lang_pred"] in PARTS and got[9003]["lang_pred"] in PARTS and got[9003]["score"] == 0.0


def test_spans_of_mixed_text(spark, model):
    rng = random.Random(8)
    text = " ".join([document(rng, "en", 30), document(rng, "ru", 20), document(rng, "de", 40)])
    row = language.label(frame(spark, [(1, text)]), model).first()
    assert [(s["start"], s["end"], s["lang"]) for s in row["spans"]] == [(0, 30, "en"), (30, 50, "ru"), (50, 90, "de")]
    assert row["lang_pred"] in ("de", "ru", "en")


def test_scripts_narrow_the_candidates(model):
    bits = dict(zip(model.languages, model.scripts.tolist()))
    names = list(language.SCRIPTS)
    assert bits["ru"] == 1 << names.index("cyrillic") and bits["en"] == bits["de"] == 1 << names.index("latin")


def test_viterbi_is_optimal():
    rng = np.random.default_rng(1)
    for n_langs in (1, 2, 4, 16, 17, 200):
        sizes = rng.integers(0, 200, 20)
        offset = np.concatenate([[0], np.cumsum(sizes)])
        scores = (3 * rng.normal(size=(offset[-1], n_langs))).astype(np.float32)
        path = language.viterbi(scores, offset, 4.0)
        for a, b in zip(offset[:-1], offset[1:]):
            if a == b:
                continue
            best = scores[a].astype(float)
            for t in range(a + 1, b):
                best = (best[:, None] - 4.0 * (1 - np.eye(n_langs))).max(axis=0) + scores[t]
            mine = path[a:b]
            value = scores[range(a, b), mine].astype(float).sum() - 4.0 * (mine[1:] != mine[:-1]).sum()
            assert abs(value - best.max()) < 1e-3 * (b - a)


def test_without_labels(spark):
    docs = frame(spark, [(1, "abc", None), (2, None, None)], "doc_id long, text string, lang string")
    model = language.fit(docs)
    rows = language.label(docs, model).collect()
    assert {(r["lang_pred"], r["score"]) for r in rows} == {("und", 0.0)}


def test_columns_pass_through(spark, model):
    docs = frame(spark, [(1, "the thing", 3), (1, "the thing", 3), (None, "", None)], "doc_id long, text string, score int")
    out = language.label(docs, model)
    assert out.columns == ["doc_id", "text", "lang_pred", "score", "spans"] and out.count() == 3
    assert language.label(docs.limit(0), model).count() == 0


def test_languages_of_any_script(spark):
    words = {"te": "తెలుగు భాష మంచి రోజు", "kn": "ಕನ್ನಡ ಭಾಷೆ ಒಳ್ಳೆಯ ದಿನ", "am": "ሰላም ለዓለም ቋንቋ", "ti": "ሰላም ንዓለም ትግርኛ እዩ", "bo": "བོད་སྐད་ ཡིག་ བཀྲ་ཤིས་"}
    words |= {"zh2": "𠀀𠀁𠀂 𠀃𠀄", "hw": "ｱｲｳ ｴｵｶ", "pf": "ﺍﺐ ﺕﺚ", "vai": "ꔀꔁꔂ ꔃꔄ", "en": "the thing and that"}
    docs = [(i, " ".join([text] * 5), lang) for i, (lang, text) in enumerate(words.items())]
    model = language.fit(frame(spark, docs, "doc_id long, text string, lang string"))
    bits = dict(zip(model.languages, model.scripts.tolist()))
    assert bits["te"] != bits["kn"] and bits["vai"] == 1 << list(language.SCRIPTS).index("other")
    mixed = [(100 + i, f"{text} the", lang) for i, (lang, text) in enumerate(words.items())]
    rows = language.label(frame(spark, docs + mixed, "doc_id long, text string, lang string"), model).collect()
    assert [r["lang_pred"] for r in rows] == [r["lang"] for r in rows]
    assert all(r["score"] == 1.0 for r in rows if r["doc_id"] < 100)


def test_only_letters_count(spark, model):
    texts = ["the ١٢٣٤٥٦٧٨९", "१२ ××", "ሰላም ሰላም", "the ሰላም"]
    rows = language.label(frame(spark, list(enumerate(texts))), model).collect()
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows}
    assert got[0] == ("en", 1.0) and got[1] == ("und", 0.0) and got[2] == ("de", 0.0) and got[3] == ("en", 1.0)


def test_two_hundred_languages(spark):
    """Every language has words of its own, and they are told apart in mixed texts too."""
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [["".join(rng.choice(letters) for _ in range(6)) for _ in range(8)] for _ in range(200)]
    say = lambda k, n: " ".join(rng.choice(words[k]) for _ in range(n))
    docs = [(k * 3 + j, say(k, 30), f"l{k:03d}") for k in range(200) for j in range(3)]
    model = language.fit(frame(spark, docs, "doc_id long, text string, lang string"))
    assert len(model.languages) == 200
    mixed = [(k, say(k, 20) + " " + say(k - 1, 10)) for k in range(1, 200)]
    for r in language.label(frame(spark, mixed), model).collect():
        k = r["doc_id"]
        assert r["lang_pred"] == f"l{k:03d}" and [(s["start"], s["end"], s["lang"]) for s in r["spans"]] == [(0, 20, f"l{k:03d}"), (20, 30, f"l{k - 1:03d}")]


def test_the_sample_has_rare_languages(spark):
    """Of a large language a part is taken, of rare ones all; a text that many rows repeat is one text."""
    rows = [(i, f"the thing {i}", "en") for i in range(20_000)] + [(i, "copied text", "en") for i in range(10_000)]
    rows += [(i, f"при вет {i}", "ru") for i in range(5)] + [(1, "nothing", None), (2, None, "de")]
    chosen = language.choose(frame(spark, rows, "doc_id long, text string, lang string"), "text", "lang", 1000).collect()
    n = {lang: sum(r["lang"] == lang for r in chosen) for lang in ("en", "ru")}
    assert n["ru"] == 5 and 800 < n["en"] < 1200 and len(chosen) == len(set(chosen)) == sum(n.values())
    again = language.choose(frame(spark, rows[::-1], "doc_id long, text string, lang string").repartition(9), "text", "lang", 1000).collect()
    assert set(again) == set(chosen)
    assert language.shares({"a": 10, "b": 1000, "c": 1000}, 210) == {"a": 1.0, "b": 0.1, "c": 0.1}


def test_scores_in_parts(spark, model, monkeypatch):
    rows = [(i, t) for i, t, _ in corpus(40)] + [(99, "x" * 5000 + " the thing")]
    whole = {r["doc_id"]: r for r in language.label(frame(spark, rows), model).collect()}
    texts = [t for _, t in rows]
    words = next(language.wordhash.word_slices(language.pa.array(texts)))[2]
    scores = language._word_scores(words, model)[0]
    monkeypatch.setattr(language, "_CELLS", 300)
    assert np.allclose(language._word_scores(words, model)[0], scores, rtol=1e-4) and len(whole) == 41
