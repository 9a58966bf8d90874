import random
from itertools import permutations

import pytest

from pulseframe.llm import filter_audit, queries
from tests.llm.texts import frame, passages, words

LABELS = "doc_id long, quality int, toxic int"


def plain(rows, labels):
    """Every order applied filter by filter to every document."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)

    def failing(i, t):
        t, w = t or "", words(t)
        tests = {
            "A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
            "D": any(c in "#$%&*|" for c in t), "E": i is not None and first[t] < i,
        }
        return {f for f, bad in tests.items() if bad}

    docs = [(part or "", failing(i, t), max([q == 1 for d, q, _ in labels if d == i is not None], default=False),
             max([x == 1 for d, _, x in labels if d == i is not None], default=False)) for i, t, part in rows]
    out, shapley = [], {}
    for part in {d[0] for d in docs}:
        for order in permutations("ABCDE"):
            left = [d for d in docs if d[0] == part]
            every = left
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                fails = sum(f in d[1] for d in every)
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
                out.append([part, "".join(order), step, len(left), len(gone), fails - len(gone), sum(d[1] == {f} for d in every),
                            sum(d[2] for d in gone), sum(d[3] for d in gone), (part, f)])
    return sorted((*r[:-1], shapley[r[-1]]) for r in out)


def documents():
    rng = random.Random(8)
    long = lambda k: " ".join(f"w{rng.randrange(k)}" for _ in range(rng.choice([99, 100, 130])))
    rows = [(i, t) for i, t in passages(4, 60)] + [(100 + i, long(rng.choice([60, 5000]))) for i in range(60)]
    rows += [(200 + i, rng.choice(["WORDS ", "Words ", "a | b ", "cost $5 ", "né "]) * rng.choice([1, 40, 120])) for i in range(60)]
    rows += [(300 + i, rng.choice(rows)[1]) for i in range(40)] + [(7, "again"), (7, "again"), (8, "again"), (None, "again"), (None, None)]
    return [(i, t, rng.choice(["en", "de", "", None])) for i, t in rows]


def test_brute_force(spark, tmp_path):
    rows, rng = documents(), random.Random(9)
    labels = [(rng.randrange(340), rng.choice([0, 1, None]), rng.choice([0, 0, 1, None])) for _ in range(150)]
    labels += [(None, 1, 1), (9999, 1, 1), (7, 0, 0), (7, 1, 0)]
    frame(spark, rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    frame(spark, labels, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.op13_filter_audit(spark, str(tmp_path))
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, labels)


@pytest.mark.parametrize("k", [1, 3, 5])
def test_rank_intervals(k):
    orders = list(permutations(range(k)))
    for mask in range(1 << k):
        want = {(rank, 1 + next(i for i, f in enumerate(o) if mask >> f & 1)) for rank, o in enumerate(orders) if mask}
        spots = [(rank, step) for step, low, high in filter_audit.rank_intervals(mask, k) for rank in range(low, high)]
        assert sorted(spots) == sorted(want)


def test_limits_of_the_filters(spark):
    cases = {1: "a " * 79 + "b", 2: " ".join(f"w{i}" for i in range(100)), 3: "A" + "b" * 9, 4: "AB" + "c" * 9, 5: " ".join(["x"] * 21 + [f"w{i}" for i in range(79)])}
    cases |= {6: " ".join(["x"] * 20 + [f"w{i}" for i in range(80)]), 7: "É" * 5, 8: "&", 9: "", 10: ""}
    docs = frame(spark, [(i, t, "p", 3) for i, t in cases.items()], "doc_id long, text string, lang string, n int")
    got = {r["doc_id"]: r["mask"] for r in filter_audit.failure_masks(docs).collect()}
    assert got == {1: 1 + 2, 2: 0, 3: 1, 4: 1 + 4, 5: 0, 6: 0, 7: 1, 8: 1 + 8, 9: 1, 10: 1 + 16}


def test_empty_tables_and_clashing_columns(spark):
    docs = frame(spark, [(1, "x", "en", 1, "m", True)], "doc_id long, text string, lang string, mask int, key string, earliest boolean")
    labels = frame(spark, [], LABELS + ", n int")
    assert filter_audit.audit_filters(docs.limit(0), labels).count() == 0
    rows = filter_audit.audit_filters(docs, labels).collect()
    assert len(rows) == 600 and {r["removed"] for r in rows if r["filter_order"][r["step"] - 1] == "A"} == {1}
