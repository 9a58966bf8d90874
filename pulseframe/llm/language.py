"""Language identification of mixed-language text.

Every word gets a score per language: the log-likelihood of its character trigrams (bytes of the
lower-cased word with its borders, hashed into BUCKETS). The scripts of the word narrow the languages
down first. Viterbi over the words of a text, with a penalty for switching, labels spans; the language
with the most letters in its spans is the text's.

The model is fitted on about SAMPLE distinct labelled texts, however many there are: every language gets an equal
part of them (what a rare one leaves goes to the others), chosen by a hash of the text. It is a table of
BUCKETS times languages and a few script shares.

Texts are worked on in slices that get smaller with the number of languages. Beyond a slice's text a task holds
words x languages x 6 bytes for Viterbi, or up to PIECE_LANGUAGES languages words x languages^2 bytes, and
256 MB at most for the scores of trigrams.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; in a script that no learned
language uses all of them stay candidates; where nothing speaks for any, and in ties, the first language
in alphabetical order is taken, with score 0 if no letter is of a script of the labelled texts; documents
without label teach nothing; without any labelled text everything is ``und``; repeated rows and null ids have no
effect on each other; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, functions as F

from pulseframe.llm import wordhash
from pulseframe.llm.batches import bound_batches

BUCKETS = 1 << 15
#: labelled documents that teach the model: the bound on the sample (its expected size)
SAMPLE = 10_000
SEED = 7
#: up to so many languages long texts are labelled in pieces, all pieces together
PIECE_LANGUAGES = 16
#: trigrams x languages whose scores are held at a time
_CELLS = 1 << 25
#: log-odds that a change of language costs
SWITCH = 12.0
UNKNOWN = "und"

# ------------------------------------------------------------------------------- scripts

#: script -> the Unicode scripts of its letters; ``other`` has the letters of all that are not listed
SCRIPTS = {
    **{name: (name,) for name in ("latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "devanagari", "bengali", "tamil")},
    **{name: (name,) for name in ("thai", "georgian", "hangul")},
    "kana": ("hiragana", "katakana"),
    "han": ("han",),
    **{name: (name,) for name in ("telugu", "kannada", "malayalam", "gujarati", "gurmukhi", "oriya", "sinhala", "khmer", "lao")},
    **{name: (name,) for name in ("myanmar", "ethiopic", "tibetan", "mongolian", "thaana", "syriac", "nko", "tifinagh")},
    **{name: (name,) for name in ("cherokee", "canadian_aboriginal", "yi", "bopomofo", "javanese", "balinese", "ol_chiki")},
    "common": ("common", "inherited"),  # letters of several scripts
    "other": (),
}
#: a language uses a script that has at least this share of its letters
SCRIPT_SHARE = 0.01

_LETTER = regex.compile(r"\p{L}")
#: letters that Unicode counts as common, but that only one script uses
_OWN = {"kana": "\u30fc\uff70"}


@functools.cache
def _script_table() -> np.ndarray:
    """Per code point its place in SCRIPTS, 255 for all but letters."""
    table = np.full(0x110000, 255, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    letters = "".join(regex.findall(r"\p{L}+", every))
    points = lambda text: np.frombuffer(text.encode("utf-32-le"), np.uint32)
    table[points(letters)] = list(SCRIPTS).index("other")
    for i, scripts in enumerate(SCRIPTS.values()):
        for script in scripts:
            table[points("".join(regex.findall(rf"\p{{Script={script}}}+", letters)))] = i
    for name, own in _OWN.items():
        table[points(own)] = list(SCRIPTS).index(name)
    return table


def _code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(byte position, code point) of the characters of valid UTF-8."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int32)
    a, b, c, d = (padded[at + i] for i in range(4))
    two = (a & 0x1F) << 6 | b & 0x3F
    three = (a & 0x0F) << 12 | (b & 0x3F) << 6 | c & 0x3F
    four = (a & 0x07) << 18 | (b & 0x3F) << 12 | (c & 0x3F) << 6 | d & 0x3F
    return at, np.select([a < 0x80, a < 0xE0, a < 0xF0], [a, two, three], four)


def _scripts(words: wordhash.Words) -> tuple[np.ndarray, np.ndarray]:
    """Per word the bits of its scripts, and its number of letters."""
    at, point = _code_points(words.data)
    script = _script_table()[point]
    letter = np.flatnonzero(script != 255)
    owner = np.searchsorted(words.start, at[letter], "right") - 1
    bits = np.zeros(len(words), np.uint64)
    np.bitwise_or.at(bits, owner, np.uint64(1) << script[letter].astype(np.uint64))
    return bits, np.bincount(owner, minlength=len(words))


# ---------------------------------------------------------------------------------- model


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # BUCKETS x languages, float32
    scripts: np.ndarray  # bits of the scripts of each language
    taught: np.uint64  # bits of the scripts of all letters it was fitted on


def _grams(words: wordhash.Words) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word) of all trigrams; a word's borders count as characters."""
    size = words.stop - words.start
    at = wordhash.ranges(words.start - 1, size)  # first byte of each trigram; the border before the word
    owner = np.repeat(np.arange(len(words)), size)
    padded = np.concatenate([[32], words.data, [32, 32]]).astype(np.uint64)
    inside = (at[:, None] + 1 + np.arange(3)).T
    a, b, c = padded[inside[0]], padded[inside[1]], padded[inside[2]]
    a = np.where(at < words.start[owner], 32, a)
    c = np.where(at + 2 >= words.stop[owner], 32, c)
    key = wordhash.mix(a << np.uint64(16) | b << np.uint64(8) | c)
    return (key >> np.uint64(64 - 15)).astype(np.int64), owner


def _lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts)


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts (bucket >= 0) and letters per script (bucket < 0) of each language in a task."""
    grams: dict[str, np.ndarray] = {}
    letters: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column(1).to_pylist(), object)
        for low, high, words in wordhash.word_slices(_lowered(wordhash.strings(batch.column(0)))):
            bucket, owner = _grams(words)
            text = np.searchsorted(words.offset, np.arange(len(words)), "right") - 1
            bits, n = _scripts(words)
            present = np.bitwise_or.reduce(bits)
            for lang in set(langs[low:high]):
                mine = np.isin(text, np.flatnonzero(langs[low:high] == lang))
                found = np.bincount(bucket[mine[owner]], minlength=BUCKETS)
                grams[lang] = grams.get(lang, 0) + found
                per = np.array([n[mine & (bits >> i & 1 == 1)].sum() if present >> i & 1 else 0 for i in range(len(SCRIPTS))])
                letters[lang] = letters.get(lang, 0) + per
    for lang, found in grams.items():
        some = np.flatnonzero(found)
        bucket = np.concatenate([some, -1 - np.arange(len(SCRIPTS))])
        n = np.concatenate([found[some], letters[lang]])
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n)), pa.array(bucket), pa.array(n.astype(np.int64))], ["lang", "bucket", "n"])


def shares(counts: dict[str, int], sample: int) -> dict[str, float]:
    """The share of each language's texts to choose: as many of each, as far as they have them, ``sample`` in all."""
    left, open_ = float(sample), sorted(counts, key=lambda x: counts[x])
    found = {}
    for i, lang in enumerate(open_):
        part = min(float(counts[lang]), left / (len(open_) - i))
        found[lang] = part / counts[lang] if counts[lang] else 1.0
        left -= part
    return found


def choose(labelled: DataFrame, text: str, lang: str, sample: int) -> DataFrame:
    """About ``sample`` distinct (text, lang) of the labelled texts; copies of a text are one text."""
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    rows = rows.withColumn("_hash", F.xxhash64(F.lit(SEED), "text"))
    counted = rows.groupBy("lang").agg(F.approx_count_distinct("_hash").alias("n")).collect()  # one row per language
    place, chosen = F.pmod("_hash", F.lit(1 << 30)), F.lit(False)
    for name, share in shares({r["lang"]: r["n"] for r in counted}, sample).items():
        chosen = F.when(F.col("lang") == name, place < int(share * (1 << 30))).otherwise(chosen)
    return rows.where(chosen).groupBy("lang", "_hash").agg(F.min("text").alias("text")).select("text", "lang")


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """A model of the languages of ``labelled`` from about ``sample`` of its texts (all, if fewer)."""
    bound_batches(labelled.sparkSession)
    chosen = choose(labelled, text, lang, sample)
    counts = chosen.mapInArrow(_counting, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counts.toArrow()  # languages x (BUCKETS + scripts) rows at most
    languages = sorted(set(table["lang"].to_pylist()))
    where = np.array([languages.index(x) for x in table["lang"].to_pylist()], np.int64)
    bucket, n = table["bucket"].to_numpy(), table["n"].to_numpy()
    grams = np.zeros((BUCKETS, len(languages)))
    letters = np.zeros((len(SCRIPTS), len(languages)))
    grams[bucket[bucket >= 0], where[bucket >= 0]] = n[bucket >= 0]
    letters[-1 - bucket[bucket < 0], where[bucket < 0]] = n[bucket < 0]
    logs = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * BUCKETS))
    used = letters >= SCRIPT_SHARE * np.maximum(letters.sum(axis=0), 1)
    scripts = (used * (1 << np.arange(len(SCRIPTS)))[:, None]).sum(axis=0).astype(np.uint64)
    taught = np.uint64((letters.any(axis=1) * (1 << np.arange(len(SCRIPTS)))).sum())
    return Model(languages, (logs - logs.max(axis=1, keepdims=True)).astype(np.float32) if languages else logs, scripts, taught)


# ------------------------------------------------------------------------------- labelling

_AGAINST = np.float32(-1000.0)


def _word_scores(words: wordhash.Words, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score per word and language, letters per word, and whether any of them is of a script that the model
    was fitted on. Words without such a letter say nothing."""
    bits, letters = _scripts(words)
    bucket, owner = _grams(words)
    scores = np.zeros((len(words), len(model.languages)), np.float32)
    step = _CELLS // max(1, len(model.languages))
    for low in range(0, len(bucket), step):
        mine = owner[low : low + step]
        first = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
        scores[mine[first]] += np.add.reduceat(model.scores[bucket[low : low + step]], first, axis=0)
    speaks = bits & model.taught != 0
    scores[~speaks] = 0
    narrowed = bits[:, None] & model.scripts
    fits = narrowed != 0
    some = fits.any(axis=1)  # a script that no learned language uses narrows nothing
    scores[some] += np.where(fits[some], np.float32(0), _AGAINST)
    return scores, letters, speaks


#: words that are worked through one after the other; longer texts are cut into pieces of this size
_STEP = 64


def viterbi(scores: np.ndarray, offset: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of each word, where a change between neighbours costs ``switch``."""
    return (_in_pieces if scores.shape[1] <= PIECE_LANGUAGES else _by_words)(scores, offset, switch)


def _by_words(scores: np.ndarray, offset: np.ndarray, switch: float) -> np.ndarray:
    """For many languages: the first words of all texts, then their second ones, and so on."""
    sizes, n_langs = np.diff(offset), scores.shape[1]
    order = np.argsort(-sizes, kind="stable")
    begin, size = offset[:-1][order], sizes[order]
    came = np.empty((len(scores), n_langs), np.int16)
    own = np.arange(n_langs, dtype=np.int16)
    best = np.zeros((len(order), n_langs), np.float32)
    running = np.searchsorted(-size, -np.arange(1, size.max(initial=0) + 1), "right")  # texts with a word at each place
    for t, n in enumerate(running.tolist()):
        at, now = begin[:n] + t, best[:n]
        top = now.argmax(axis=1)[:, None]
        through = np.take_along_axis(now, top, 1) - np.float32(switch)
        stay = now >= through
        came[at] = np.where(stay, own, top)
        best[:n] = np.where(stay, now, through) + scores[at]
    state, path = best.argmax(axis=1), np.zeros(len(scores), np.int64)
    for t in range(len(running) - 1, -1, -1):
        at = begin[: running[t]] + t
        path[at] = state[: running[t]]
        state[: running[t]] = came[at, state[: running[t]]]
    return path


def _in_pieces(scores: np.ndarray, offset: np.ndarray, switch: float) -> np.ndarray:
    """For few languages. Texts are cut into pieces of _STEP words. All pieces of all texts take their first step together, then
    their second, for every language that may come before the piece; then the pieces of each text are
    joined. So the number of steps does not grow with the longest text.
    """
    n_langs, sizes = scores.shape[1], np.diff(offset)
    if not len(scores):
        return np.zeros(0, np.int64)
    n_pieces = -(-sizes // _STEP)
    first = np.cumsum(n_pieces) - n_pieces  # piece of each text
    word = np.arange(len(scores)) - np.repeat(offset[:-1], sizes)
    place = (np.repeat(first, sizes) + word // _STEP) * _STEP + word % _STEP
    pieces = int(n_pieces.sum())
    padded = np.zeros((pieces * _STEP, n_langs), np.float32)  # words that say nothing fill the last piece
    padded[place] = scores
    padded = padded.reshape(pieces, _STEP, 1, n_langs)
    best = np.full((pieces, n_langs, n_langs), -1e9, np.float32)  # piece, language before, language now
    best[:, range(n_langs), range(n_langs)] = 0
    came = np.empty((_STEP, pieces, n_langs, n_langs), np.int8)
    own = np.arange(n_langs, dtype=np.int8)
    for t in range(_STEP):
        top = best.argmax(axis=2)[:, :, None]
        through = np.take_along_axis(best, top, 2) - np.float32(switch)
        stay = best >= through
        came[t] = np.where(stay, own, top)
        best = np.where(stay, best, through) + padded[:, t]
    # join the pieces of each text; texts with many pieces first, so that those that go on are a prefix
    order = np.argsort(-n_pieces, kind="stable")
    order = order[n_pieces[order] > 0]
    begin, count = first[order], n_pieces[order]
    running = np.searchsorted(-count, -np.arange(1, count[0] + 1), "right")
    total = np.zeros((len(order), n_langs))
    before = np.empty((pieces, n_langs), np.int8)  # language before a piece, by the language at its end
    for t in range(int(count[0])):
        n = int(running[t])
        ways = total[:n, :, None] + best[begin[:n] + t]
        before[begin[:n] + t] = ways.argmax(axis=1)
        total[:n] = ways.max(axis=1)
    state, entry, end = total.argmax(axis=1), np.empty(pieces, np.int64), np.empty(pieces, np.int64)
    for t in range(int(count[0]) - 1, -1, -1):
        n = int(running[t])
        piece = begin[:n] + t
        end[piece] = state[:n]
        entry[piece] = before[piece, state[:n]]
        state[:n] = entry[piece]
    path = np.empty((pieces, _STEP), np.int64)
    every = np.arange(pieces)
    for t in range(_STEP - 1, -1, -1):
        path[:, t] = end
        end = came[t][every, entry, end].astype(np.int64)
    return path.reshape(-1)[place]


_LABELLED = "lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>"


def _labelling(model: Model, text: int, switch: float):
    limit = wordhash.SLICE_BYTES * PIECE_LANGUAGES // max(PIECE_LANGUAGES, len(model.languages))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _lowered(wordhash.strings(batch.column(text)))
            for low, high, words in wordhash.word_slices(texts, limit=limit):
                part = batch.slice(low, high - low)
                columns = _label(words, model, switch, texts.slice(low, high - low))
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], [*part.schema.names, "lang_pred", "score", "spans"])

    return of_batches


def _label(words: wordhash.Words, model: Model, switch: float, texts: pa.Array) -> list[pa.Array]:
    n_texts, n_langs = len(words.offset) - 1, len(model.languages)
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])
    if not n_langs:
        none = pa.array([UNKNOWN] * n_texts), pa.array([0.0] * n_texts), pa.array([[] for _ in range(n_texts)], pa.list_(span))
        return list(none)
    scores, letters, speaks = _word_scores(words, model)
    path = viterbi(scores, words.offset, switch)
    text = np.repeat(np.arange(n_texts), np.diff(words.offset))
    mass = np.bincount(text * n_langs + path, letters, n_texts * n_langs).reshape(n_texts, n_langs)
    best, total = mass.argmax(axis=1), mass.sum(axis=1)
    score = np.divide(mass[np.arange(n_texts), best], total, out=np.zeros(n_texts), where=total > 0)
    names = [model.languages[b] if _LETTER.search(x.as_py()) else UNKNOWN for b, x in zip(best, texts)]
    score[np.bincount(text, speaks, n_texts) == 0] = 0.0
    new = np.ones(len(path), bool)
    new[1:] = (path[1:] != path[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(path))
    base = words.offset[text[begin]]
    ends = np.searchsorted(begin, words.offset)
    langs = pa.array(model.languages).take(pa.array(path[begin].astype(np.int32)))
    flat = pa.StructArray.from_arrays(
        [pa.array((begin - base).astype(np.int32)), pa.array((end - base).astype(np.int32)), langs], fields=list(span)
    )
    return [pa.array(names), pa.array(score), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat)]


def label(docs: DataFrame, model: Model, text: str = "text", switch: float = SWITCH) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (share of the letters in spans of that language) and ``spans`` of words."""
    bound_batches(docs.sparkSession)
    docs = docs.drop("lang_pred", "score", "spans")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields), _LABELLED])
    return docs.mapInArrow(_labelling(model, docs.columns.index(text), switch), schema)


def held_out(doc_id: Column) -> Column:
    """A quarter of the documents, by the checksum of their id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
