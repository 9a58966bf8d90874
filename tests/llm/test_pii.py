import random
import re
from collections import Counter

from pulseframe.llm import pii, queries
from tests.llm.texts import frame, sha, table


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def digits(text):
    return re.sub("[^0-9]", "", text)


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
]


def plain(text):
    found = []
    for rank, (kind, pattern, check) in enumerate(BASE):
        for m in re.finditer(pattern, text or ""):
            if check(m.group()):
                found.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(found)]


def fuzz(n=1500):
    rng = random.Random(4)
    alphabet = "0123456789   -..+@@ab%(:\n4é\U0001f600"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 150))) for _ in range(n)]


EDGES = [
    None, "", "4111 1111 1111 1111", "4111 1111 1111 1112", "5500005555555559x", "user@a.b.c", "a@b.cd%x@e.f", "1.2.3.4.5.6.7.8",
    "256.1.1.1", "0001.02.3.4", "+49 (30) 123-456-78", "é😀 a@b.c", "1 " * 4000, "9" * 30_000, "a." * 9000 + "@x.y",
    "x@" + "a." * 9000 + "b", "+1" + " " * 9000, "0" * 16, "a@b.c a@b.c",
]


def test_base_spans(spark, tmp_path):
    texts = EDGES + fuzz()
    rows = queries.op10_pii(spark, table(spark, tmp_path, list(enumerate(texts)))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain(texts[r["doc_id"]])
        assert r["base_sha256"] == sha(",".join(want))
        counts = Counter(x.split(":")[0] for x in want)
        assert all(r[f"n_{kind}"] == counts[kind] for kind in pii.BASE)
        assert set(want) <= set(r["spans"].split(","))


def spans(spark, text):
    row = pii.find_spans(frame(spark, [(1, text)])).first()
    return {(s["kind"], text[s["start"] : s["end"]]): s["score"] for s in row["pii"]}


def test_checksums_and_context(spark):
    assert ("iban", "DE89 3704 0044 0532 0130 00") in spans(spark, "pay to DE89 3704 0044 0532 0130 00 now")
    assert not spans(spark, "pay to DE88 3704 0044 0532 0130 00 now")
    assert ("ssn", "123-45-6789") in spans(spark, "my SSN: 123-45-6789") and not spans(spark, "part 123-45-6789")
    key = "a1b2c3d4e5f6a7b8c9d0e1f2"
    assert ("secret", key) in spans(spark, f'token = "{key}"') and not spans(spark, f'colour = "{key}"')
    far, near = spans(spark, "1.2.3.4"), spans(spark, "the server 1.2.3.4")
    assert far["ip", "1.2.3.4"] < near["ip", "1.2.3.4"]


def test_redaction(spark):
    docs = frame(spark, [(1, "é a@b.c, 1.2.3.4!", "p"), (2, None, "q"), (None, "clean", "r"), (None, "clean", "r")], "doc_id long, text string, pii string")
    rows = sorted((tuple(r) for r in pii.redact(docs).collect()), key=str)
    assert rows == [(1, "é <EMAIL>, <IP>!", "p"), (2, None, "q"), (None, "clean", "r"), (None, "clean", "r")]
    assert pii.find_spans(docs).columns == ["doc_id", "text", "pii"] and pii.redact(docs.limit(0)).count() == 0


def test_no_python_on_the_path(spark):
    plan = pii.find_spans(frame(spark, [(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange hashpartitioning" not in plan


def test_context_around_other_matches(spark):
    numbers = ["123-45-6789", "234-56-7891", "345-67-8912"]
    for text in ("SSN: " + ", ".join(numbers), " / ".join(numbers) + " (SSN)", "é😀 SSN " + " 😀 ".join(numbers)):
        assert set(spans(spark, text)) == {("ssn", n) for n in numbers}
    near, far = "x" * (pii.CONTEXT - 4), "x" * (pii.CONTEXT - 3)
    for text, n in ((f"ssn {near} {numbers[0]}", 0), (f"ssn{near} {numbers[0]}", 1), (f"{numbers[0]} {near}ssn", 1), (f"{numbers[0]} {far}ssn", 0)):
        assert len(spans(spark, text)) == n
    assert pii.redact(frame(spark, [(1, "SSN: " + ", ".join(numbers))])).first()["text"] == "SSN: <SSN>, <SSN>, <SSN>"


def iban(country, rest):
    """The IBAN with these characters after its check digits."""
    value = int("".join(str(int(c, 36)) for c in f"{rest}{country}00"))
    return f"{country}{98 - value % 97:02d}{rest}"


def test_iban_before_other_words(spark):
    solid, apart = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00"
    layouts = [
        (f"IBAN {solid} BIC COBADEFFXXX", [solid]), (f"{apart} BIC: COBADEFFXXX", [apart]), (f"{solid} 2024-01-01", [solid]),
        (f"{solid} GB82WEST12345698765432 X", [solid, "GB82WEST12345698765432"]), (f"AB12 {apart} 5", [apart]),
        (f"REF NO12 3456 7890 {apart}", [apart]), (f"é😀 {apart} BIC", [apart]), (f"{solid}X", []), (f"{solid}9 BIC", []),
    ]
    for text, want in layouts:
        assert [text[s["start"] : s["end"]] for s in pii.find_spans(frame(spark, [(1, text)])).first()["pii"] if s["kind"] == "iban"] == want
    assert pii.redact(frame(spark, [(1, layouts[0][0])])).first()["text"] == "IBAN <IBAN> BIC COBADEFFXXX"


def test_iban_of_every_length(spark):
    listed = [(country, n) for n, countries in pii.IBAN_LENGTHS.items() for country in countries.split()]
    texts = [f"{iban(country, ('12345678' * 4)[: n - 4])} BIC 12" for country, n in [*listed, ("ZZ", 34), ("QQ", 15)]]
    rows = pii.find_spans(frame(spark, list(enumerate(texts)))).collect()
    for r in rows:
        assert [(s["start"], s["end"]) for s in r["pii"] if s["kind"] == "iban"] == [(0, len(texts[r["doc_id"]]) - 7)]


def cut(text, found):
    """The text with spans (start, end, kind), by start, replaced."""
    out, at = "", 0
    for start, end, kind in found:
        if start >= at:
            out += text[at:start] + f"<{kind.upper()}>"
        at = max(at, end)
    return out + text[at:]


def test_many_matches(spark):
    """More matches than are listed at a time, some overlapping; found and replaced as by hand."""
    rng = random.Random(14)
    kinds = ["é a@b.c", "1.2.3.4", "+1 (23) 456 7890.1.2.3", "4111 1111 1111 1111", "x 😀 words", "ssn 123-45-6789", "me@1.2.3.4", "256.1.1.1", "DE89370400440532013000"]
    texts = [" ".join(rng.choice(kinds) for _ in range(n)) for n in (1, 127, 128, 129, 256, 257, 700, 3000)]
    docs = frame(spark, list(enumerate(texts)))
    found = {r["doc_id"]: [(s["start"], s["end"], s["kind"]) for s in r["pii"]] for r in pii.find_spans(docs).collect()}
    for k, text in enumerate(texts):
        own = [f"{kind}:{start}:{end}" for start, end, kind in found[k] if kind in pii.BASE]
        assert own == plain(text)
        assert sum(kind == "ssn" for _, _, kind in found[k]) == text.count("ssn ")
        assert sum(kind == "iban" for _, _, kind in found[k]) == text.count("DE89")
    assert len(found[7]) > 2000
    for r in pii.redact(docs).collect():
        assert r["text"] == cut(texts[r["doc_id"]], found[r["doc_id"]])
