import os

import pytest

import corpus_pipeline
from pulseframe.llm import near, pack
from pulseframe.session import materialize, scratch_path
from tests import compare as side_by_side
from tests.llm.test_pack import PATH, checked
from tests.llm.texts import sha, words

SF = "/root/testdata/sf0.001"


def documents():
    good = lambda k: " ".join(f"w{k}x{i}" for i in range(80))
    shared = "this very line is in many documents"
    rows = [(i, f"{good(i)}\n{shared}\nmail me at a{i}@b.org", "en", f"s{i % 2}") for i in range(30)]
    rows += [(100, good(0) + "\n" + shared + "\nmail me at a0@b.org", "en", "s0")]  # a copy
    rows += [(101, good(1).replace("w1x5 ", "changed "), "en", "s1")]  # nearly one
    rows += [(102, "too short", "en", "s0"), (103, None, "en", "s1"), (104, "ho " * 90, "en", None)]
    return [(i, t, lang, s, len(t or "")) for i, t, lang, s in rows]


def test_stages(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(documents(), schema)
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(materialize(stage(spark, kept[-1], "unused"), scratch_path(spark, name)))
        assert kept[-1].columns == docs.columns
        assert all(r["n_chars"] == len(r["text"]) for r in kept[-1].collect())
    ids = [sorted(r["doc_id"] for r in k.collect()) for k in kept]
    assert ids[1] == [*range(30), 100, 101] == ids[2]  # short, empty and repetitive ones go
    lines = {r["doc_id"]: r["text"] for r in kept[2].collect()}
    assert "many documents" in lines[0] and not any("many documents" in t for i, t in lines.items() if i)
    # the copy lost all its lines before, the near copy is found
    assert ids[3] == [*range(30), 100]
    redacted = {r["doc_id"]: r["text"] for r in kept[4].collect()}
    assert redacted[3].endswith("<EMAIL>") and "@" not in "".join(redacted.values())
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept[4], "unused").collect()
    order = {d: n for n, d in enumerate(sorted(redacted))}
    rows = [{**r.asDict(), "doc_id": order[r["doc_id"]]} for r in pieces]
    checked(rows, [redacted[d] for d in sorted(redacted)], pack.CAPACITY)


def test_stage_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "pii_redaction", "packing"]
    assert (near.SHINGLE, near.SIMILARITY) == (5, 80) and os.path.exists(PATH)
    assert sha("x") and words("a b") == ["a", "b"]


def test_stages_take_empty_tables_and_further_columns(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars int, spans string, failures int, part string, n_lines int, pii string, _text string"
    some = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(60)), "en", "s", 1, "x", 2, "y", 3, "z", "t"), (None,) * 11], schema)
    for docs in (some, some.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, "unused"), scratch_path(spark, name))
            if name != "packing":
                assert docs.columns == some.columns
                assert all((r["n_lines"], r["pii"], r["_text"]) in ((3, "z", "t"), (None, None, None)) for r in docs.collect())


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
class TestContract:
    @pytest.fixture(scope="class")
    def db(self):
        return side_by_side.connect(SF)

    def test_queries_equal_their_sql(self, spark, db):
        from pulseframe.llm import oracle

        for name in oracle.ORACLE:
            assert side_by_side.compare(spark, db, name, SF) == [], name

    def test_pipeline_runs(self, spark):
        assert corpus_pipeline.run(spark, SF).count() > 0

    def test_all_thirteen_are_registered(self):
        names = side_by_side.contract.queries()
        assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 14)) and "pipeline" in names
