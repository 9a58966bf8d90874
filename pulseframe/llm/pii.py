"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Only DataFrame functions are used, row by row; nothing is shuffled. Offsets are code points, the end
is exclusive. Per kind the leftmost non-overlapping matches are taken; a match that fails its check is
dropped and its characters are not searched again. An IBAN has the length of its country and is tried
wherever one may start; for letters that are no listed country, all ends of words are tried, the last first.
Spans of different kinds may overlap.

The patterns use possessive groups and start where a run starts (or the last match ended), so that very
long runs of digits or letters cost linear time and no deep recursion.

Defined cases: a null text counts as empty and has no spans; repeated rows and null ids are independent
rows; an empty table gives an empty result; the result columns replace input columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pulseframe.llm.quality import settled

_LOCAL = "A-Za-z0-9._%+-"

#: characters before and after a match in which context words count, whatever other matches lie there
CONTEXT = 48
#: least score of a span
THRESHOLD = 0.5

# Checks are SQL over the matched text `v`.
_DIGITS = "regexp_replace(v, '[^0-9]', '')"
_PARTS = r"forall(split(v, '[.]'), p -> length(ltrim('0', p)) < 3 OR length(ltrim('0', p)) = 3 AND ltrim('0', p) <= '255')"
_LUHN = """aggregate(reverse(split({d}, '')), struct(0 AS s, 0 AS i), (a, c) -> struct(
  a.s + CASE WHEN a.i % 2 = 0 THEN cast(c AS INT) WHEN c < '5' THEN 2 * cast(c AS INT)
        ELSE 2 * cast(c AS INT) - 9 END AS s, a.i + 1 AS i), a -> a.s % 10 = 0)""".format(d=_DIGITS)
_IBAN = "replace(v, ' ', '')"
_MOD97 = """aggregate(split(concat(substring({x}, 5), left({x}, 4)), ''), 0,
  (a, c) -> CASE WHEN c <= '9' THEN (10 * a + cast(c AS INT)) % 97 ELSE (100 * a + ascii(c) - 55) % 97 END,
  a -> a = 1)""".format(x=_IBAN)

#: characters of an IBAN -> its countries
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN_SIZES = "CASE {} ELSE sequence(30, 11, -1) END".format(
    " ".join(f"WHEN left(s.v, 2) IN ('{"', '".join(countries.split())}') THEN array({n - 4})" for n, countries in IBAN_LENGTHS.items())
)
#: characters after the first four of an IBAN: 30, a space before each
_IBAN_REST = 60

#: kind -> (must occur, pattern, check, score, context pattern, score with context)
KINDS = {
    "email": ("@", rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "true", 0.9,
              "mail|contact", 0.1),
    "ip": (".", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _PARTS, 0.6, "ip|host|server|address", 0.3),
    "card": (None, r"[0-9](?:[\x20-]?[0-9])++", f"length({_DIGITS}) BETWEEN 14 AND 19 AND {_LUHN}", 0.8,
             "card|visa|credit|payment|karte|carte|tarjeta", 0.2),
    "phone": ("+", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 10 AND 15", 0.6,
              "phone|call|tel|mobile|fax|handy", 0.3),
    "iban": (None, r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]){11})", _MOD97, 0.8,
             "iban|account|bank|konto|compte|cuenta", 0.2),
    "ssn": ("-", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
            "left(v, 1) <> '9' AND left(v, 3) NOT IN ('000', '666')", 0.3, "ssn|social|security", 0.4),
    "secret": (None, r"(?<=[=:]\x20{0,2}[\x22\x27]?)[A-Za-z0-9_/+-]{20,}+", "true", 0.3,
               "token|secret|password|passwd|key", 0.4),
}

BASE = ("email", "ip", "card", "phone")

_MATCHES = "array<struct<start:int,end:int,v:string,before:string,after:string>>"
_SPAN = "array<struct<start:int,rank:int,kind:string,end:int,score:double>>"


#: matches that are listed at a time; a match has a character at least, so CONTEXT of them hold the context
_CHUNK = 128
assert _CHUNK >= CONTEXT


def _chunks(items: str) -> str:
    """SQL for an array cut into arrays of _CHUNK."""
    return f"transform(sequence(0, greatest((size({items}) - 1) div {_CHUNK}, 0)), i -> slice({items}, cast(i * {_CHUNK} + 1 AS INT), {_CHUNK}))"


def _found(kind: str) -> str:
    """SQL for the valid spans of one kind in `_text`. Positions are running sums over the pieces between
    matches, the characters before a match are carried along, those after it are looked ahead to. The pattern
    of an IBAN only matches its first four characters; the rest is taken from those after it."""
    must, pattern, check, score, context, more = KINDS[kind]
    some = f"_text RLIKE r'{pattern}'" + (f" AND instr(_text, '{must}') > 0" if must else "")
    after = rf"(?:{pattern})(?=([\s\S]{{0,{CONTEXT + (_IBAN_REST if kind == "iban" else 0)}}}))"
    # an array that grows by one element at a time is copied for each: matches are listed in chunks, whose
    # starts and the characters before them come first
    size = "char_length(x.p) + char_length(x.v)"
    found = f"""
    transform(array(filter(zip_with(
        zip_with(regexp_extract_all(_text, r'{pattern}', 0), regexp_extract_all(_text, r'{after}', 1),
          (v, n) -> named_struct('v', v, 'after', n)),
        split(_text, r'{pattern}', -1),
        (m, p) -> named_struct('v', m.v, 'after', m.after, 'p', p)), x -> x.v IS NOT NULL)), items ->
    transform(array({_chunks('items')}), chunks ->
    flatten(transform(
      aggregate(chunks, named_struct('pos', 0, 'out', cast(array() AS array<int>)),
        (a, c) -> named_struct('pos', a.pos + aggregate(c, 0, (n, x) -> n + {size}), 'out', concat(a.out, array(a.pos))), a -> a.out),
      (first, i) -> aggregate(chunks[i],
        named_struct('pos', first, 'near', CASE WHEN i = 0 THEN '' ELSE right(array_join(
          transform(slice(chunks[i - 1], {_CHUNK - CONTEXT + 1}, {CONTEXT}), x -> concat(x.p, x.v)), ''), {CONTEXT}) END,
          'out', cast(array() AS {_MATCHES})),
        (a, x) -> named_struct('pos', a.pos + {size},
          'near', right(concat(a.near, x.p, x.v), {CONTEXT}), 'out', concat(a.out, array(named_struct(
            'start', a.pos + char_length(x.p), 'end', a.pos + {size}, 'v', x.v,
            'before', right(concat(a.near, x.p), {CONTEXT}), 'after', x.after)))),
        a -> a.out))))[0])[0]"""
    valid = _whole_ibans(found) if kind == "iban" else f"filter({found},\n    s -> exists(array(s.v), v -> {check}))"
    return f"""
CASE WHEN {some} THEN
  filter(transform({valid},
    s -> named_struct('start', s.start, 'rank', {list(KINDS).index(kind)}, 'kind', '{kind}', 'end', s.end,
      'score', {score}D + CASE WHEN lower(s.before) RLIKE '{context}' OR lower(s.after) RLIKE '{context}' THEN {more}D ELSE 0D END)),
  s -> s.score >= {THRESHOLD}D)
ELSE cast(array() AS {_SPAN}) END"""


def _whole_ibans(found: str) -> str:
    """SQL for the IBANs that begin with the matches ``found``: of the length of their country, or of the greatest
    valid one if it has none, and not inside the one before."""
    return f"""
    aggregate(transform({found},
      s -> transform(array(get(filter(
          transform({_IBAN_SIZES}, n -> regexp_extract(s.after, concat(r'^(?:\x20?[A-Z0-9]){{', n, r'}}(?![A-Za-z0-9])'), 0)),
          r -> r <> '' AND exists(array(concat(s.v, r)), v -> {_MOD97})), 0)),
        r -> named_struct('start', s.start, 'end', s.end + char_length(r), 'v', concat(s.v, r), 'before', s.before,
          'after', substring(s.after, char_length(r) + 1, {CONTEXT})))[0]),
      cast(array() AS {_MATCHES}),
      (a, s) -> CASE WHEN s.v IS NULL THEN a WHEN size(a) = 0 THEN array(s)
        WHEN element_at(a, -1).end <= s.start THEN concat(a, array(s)) ELSE a END)"""


def find_spans(docs: DataFrame, text: str = "text", kinds: tuple[str, ...] = tuple(KINDS)) -> DataFrame:
    """``docs`` with ``pii``: its spans ordered by start, then kind."""
    kept = [c for c in docs.columns if c != "pii"]
    df = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    df = df.select(*kept, *[F.expr(_found(kind)).alias(f"_{kind}") for kind in kinds])
    return settled(df.select(*kept, F.sort_array(F.concat(*[F.col(f"_{kind}") for kind in kinds])).alias("pii")))


def count_kind(kind: str, spans: str = "pii") -> Column:
    return F.size(F.filter(F.col(spans), lambda s: s["kind"] == kind)).cast("long")


def listed(kinds: tuple[str, ...], spans: str = "pii") -> Column:
    """kind:start:end of the spans of some kinds, joined by commas."""
    chosen = F.filter(F.col(spans), lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; overlapping spans become one. Null stays null."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(text).alias("_body"))
    found = find_spans(whole, "_body")
    # a chunk of spans cuts its own part of the text, which begins where the spans before it end
    cut = F.expr(f"""
transform(array({_chunks('pii')}), chunks ->
  array_join(transform(
    aggregate(chunks, named_struct('pos', 0, 'out', array(0)),
      (a, c) -> named_struct('pos', greatest(a.pos, array_max(c.end)), 'out', concat(a.out, array(greatest(a.pos, array_max(c.end))))),
      a -> slice(a.out, 1, size(chunks))),
    (first, i) -> transform(array(CASE WHEN i + 1 < size(chunks)
        THEN substring(_body, first + 1, greatest(array_max(chunks[i].end) - first, 0)) ELSE substring(_body, first + 1) END), body ->
      aggregate(chunks[i], named_struct('out', cast(array() AS array<string>), 'pos', first),
        (a, s) -> CASE
          WHEN s.start >= a.pos THEN named_struct(
            'out', concat(a.out, array(substring(body, a.pos - first + 1, s.start - a.pos), concat('<', upper(s.kind), '>'))), 'pos', s.end)
          ELSE named_struct('out', a.out, 'pos', greatest(a.pos, s.end)) END,
        a -> concat(array_join(a.out, ''), substring(body, a.pos - first + 1))))[0]), ''))[0]""")
    clean = F.when(F.size("pii") > 0, cut).otherwise(F.col("_body"))
    return found.select(*[clean.alias(c) if c == text else F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])
