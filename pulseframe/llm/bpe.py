"""Byte-pair encoding with a word-level BPE vocabulary file, in the manner of contiguous rank arrays.

Each distinct word piece of a batch keeps its parts and the merge ranks of neighbouring parts in two
contiguous arrays. Again and again the smallest rank is looked for by a scan, the boundary it stands
for is deleted, and the ranks on both sides are refreshed. Pieces are short, so a scan beats a heap; the
arrays of many pieces lie below each other as rows of a matrix, so one scan serves them all.

Supported files: tokenizers JSON with a BPE model with an end-of-word suffix, whose normaliser
composes (NFC) and lower-cases, whose pre-tokeniser keeps the matches of one pattern as bytes, and
without decoder: decoding joins token strings by spaces. Special tokens in a text are recognised.

Since neither pieces nor special tokens span white space, texts are encoded word by word, and words by
their hash: every distinct word of a slice of texts is encoded once.

Defined cases: a null text counts as empty and has no ids; texts of any length are cut nowhere; rows
are independent of each other, so repeated rows and null ids have no effect; an empty table gives an
empty result.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from pulseframe.llm import wordhash
from pulseframe.llm.batches import bound_batches

_NO_RANK = np.int32(2**31 - 1)
#: pieces of one length that are merged together
ROWS = 65536
_TABLE_BITS = 19


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: its own where it has one."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(256 + others.index(b)) for b in range(256)]


class Vocabulary:
    """Ids, merge ranks and rules of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        ids, suffix = model["vocab"], model["end_of_word_suffix"]
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [b""] * (1 + max([*ids.values(), *specials.values()]))
        for token, i in [*ids.items(), *specials.items()]:
            self.tokens[i] = token.encode()
        symbols = _byte_symbols()
        self.inner = np.array([ids[s] for s in symbols], np.int32)
        self.final = np.array([ids[s + suffix] for s in symbols], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self._index(
            np.array([ids[a] for a, _ in pairs]), np.array([ids[b] for _, b in pairs]), np.array([ids[a + b] for a, b in pairs])
        )
        self.specials = specials
        self.special = regex.compile("|".join(regex.escape(t) for t in specials)) if specials else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.library = Tokenizer.from_file(path)
        self.byte = {symbol: byte for byte, symbol in enumerate(symbols)}

    def _index(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray) -> None:
        """Open addressing: slot -> pair, rank, merged id."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        size = 1 << _TABLE_BITS
        self.pair = np.full(size, 2**64 - 1, np.uint64)
        self.rank = np.full(size, _NO_RANK, np.int32)
        self.merged = np.zeros(size, np.int32)
        slot = self._slot(keys)
        todo = np.arange(len(keys))
        self.most_probes = 0
        while len(todo):
            self.most_probes += 1
            free = self.pair[slot[todo]] == np.uint64(2**64 - 1)
            _, first = np.unique(slot[todo], return_index=True)
            mine = np.zeros(len(todo), bool)
            mine[first] = True
            put = todo[mine & free]
            self.pair[slot[put]], self.rank[slot[put]], self.merged[slot[put]] = keys[put], put, merged[put]
            todo = todo[~(mine & free)]
            slot[todo] = (slot[todo] + 1) % size

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (wordhash.mix(keys) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged id) of pairs of ids; a pair without a merge has the rank _NO_RANK."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slot = self._slot(keys)
        found = self.pair[slot]
        rank = np.where(found == keys, self.rank[slot], _NO_RANK)
        merged = self.merged[slot]
        todo = np.flatnonzero((found != keys) & (found != np.uint64(2**64 - 1)))
        while len(todo):
            slot[todo] = (slot[todo] + 1) % len(self.pair)
            found = self.pair[slot[todo]]
            hit = found == keys[todo]
            rank[todo[hit]], merged[todo[hit]] = self.rank[slot[todo[hit]]], self.merged[slot[todo[hit]]]
            todo = todo[~hit & (found != np.uint64(2**64 - 1))]
        return rank, merged

    # ------------------------------------------------------------------------- merging

    def merge(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Apply the merges to rows of initial ids of one length: (ids, number of ids per row)."""
        n, width = parts.shape
        parts = parts.copy()
        left_over = np.full(n, width)
        if width == 1:
            return parts, left_over
        rank = np.full((n, width), _NO_RANK, np.int32)
        merged = np.zeros((n, width), np.int32)
        a, b = self.ranks(parts[:, :-1].ravel(), parts[:, 1:].ravel())
        rank[:, :-1], merged[:, :-1] = a.reshape(n, -1), b.reshape(n, -1)
        rows = np.arange(n)
        columns = np.arange(width)
        while len(rows):
            at = rank[rows].argmin(axis=1)  # the leftmost of the smallest
            some = rank[rows, at] != _NO_RANK
            rows, at = rows[some], at[some]
            if not len(rows):
                break
            new = merged[rows, at]
            # delete the boundary behind `at`: what follows moves one to the left
            source = columns + (columns > at[:, None])
            source[:, -1] = np.minimum(source[:, -1], width - 1)
            moved = parts[rows[:, None], source]
            moved[np.arange(len(rows)), at] = new
            parts[rows] = moved
            source = columns + (columns >= at[:, None])
            beyond = source == width
            source[beyond] = width - 1
            moved_rank = rank[rows[:, None], source]
            moved_rank[beyond] = _NO_RANK
            rank[rows] = moved_rank
            merged[rows] = merged[rows[:, None], source]
            left_over[rows] -= 1
            last = left_over[rows]
            # refresh the ranks on both sides
            for where, ok in ((at - 1, at > 0), (at, at + 1 < last)):
                r, c = rows[ok], where[ok]
                rank[r, c], merged[r, c] = self.ranks(parts[r, c], parts[r, c + 1])
            rank[rows, last - 1] = _NO_RANK
        return parts, left_over

    def merge_pieces(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of byte pieces, one after the other, and how many each has."""
        counts = np.zeros(len(start), np.int64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        order = np.argsort(size, kind="stable")
        cuts = np.flatnonzero(np.diff(size[order])) + 1
        for group in np.split(order, cuts) if len(order) else []:
            width = int(size[group[0]])
            step = max(1, min(ROWS, (8 << 20) // (width * 8)))
            for low in range(0, len(group), step):
                mine = group[low : low + step]
                raw = data[start[mine][:, None] + np.arange(width)]
                parts = self.inner[raw]
                parts[:, -1] = self.final[raw[:, -1]]
                ids, n = self.merge(parts) if width <= _LONG else self._merge_long(parts)
                counts[mine] = n
                found.append((mine, ids, n))
        begin = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.int32)
        for mine, ids, n in found:
            keep = np.arange(ids.shape[1]) < n[:, None]
            out[wordhash.ranges(begin[mine], n)] = ids[keep]
        return out, counts

    def _merge_long(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``merge`` for very long pieces (one at a time): all places of the smallest rank are merged in one scan."""
        rows = [self._merge_one(row) for row in parts]
        n = np.array([len(r) for r in rows])
        out = np.zeros((len(rows), int(n.max())), np.int32)
        for i, row in enumerate(rows):
            out[i, : len(row)] = row
        return out, n

    def _merge_one(self, ids: np.ndarray) -> np.ndarray:
        while len(ids) > 1:
            rank, merged = self.ranks(ids[:-1], ids[1:])
            least = rank.min()
            if least == _NO_RANK:
                break
            at = np.flatnonzero(rank == least)
            # equal pairs that overlap (aaa) are merged from the left
            run = np.concatenate([[True], np.diff(at) > 1])
            first = np.maximum.accumulate(np.where(run, at, 0))
            at = at[(at - first) % 2 == 0]
            ids = ids.copy()
            ids[at] = merged[at]
            ids = np.delete(ids, at + 1)
        return ids

    # ------------------------------------------------------------------------- splitting

    def pieces(self, word: bytes) -> list[bytes | int]:
        """The pieces of one word as bytes; special tokens as ids."""
        text = word.decode("utf-8", "replace")
        out: list[bytes | int] = []
        past = 0
        for match in self.special.finditer(text) if self.special else ():
            out += self._plain(text[past : match.start()])
            out.append(self.specials[match.group()])
            past = match.end()
        return out + self._plain(text[past:])

    def _plain(self, text: str) -> list[bytes]:
        if text and max(text) >= "\u0250":
            # letters are not the same in every Unicode version: the library's own rules
            found = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            return [bytes(self.byte[c] for c in piece) for piece, _ in found]
        text = unicodedata.normalize("NFC", text).lower()
        return [m.group().encode() for m in self.pattern.finditer(text)]


_LONG = 256


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@functools.cache
def _lexicon(path: str) -> Lexicon:
    return Lexicon(vocabulary(path))


# ----------------------------------------------------------------------------- documents

_KIND = np.zeros(256, np.uint8)  # 0: needs a closer look, 1: letter, 2: digit, 3: other
_KIND[33:127] = 3
_KIND[48:58] = 2
_KIND[65:91] = 1
_KIND[97:123] = 1
_KIND[[39, 60]] = 0  # apostrophes may begin a contraction, < a special token
_KIND[0x80:0xC0] = 1  # second byte of
_KIND[0xC3] = 1  # the letters U+00C0 to U+00FF
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER_C3 = np.arange(256, dtype=np.uint8)
_LOWER_C3[0x80:0x9F] += 32


class Lexicon:
    """Ids of words seen before, by hash, for one task after another; it starts anew when it is full."""

    SIZE = 600_000  # words
    IDS = 8_000_000

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self._clear()

    def _clear(self) -> None:
        self.key = np.empty(0, np.uint64)
        self.size = np.empty(0, np.int32)
        self.begin = np.empty(0, np.int64)
        self.counts = np.empty(0, np.int32)
        self.ids = np.empty(0, np.uint16 if len(self.vocab.tokens) <= 1 << 16 else np.int32)

    def look_up(self, data: np.ndarray, key: np.ndarray, start: np.ndarray, stop: np.ndarray):
        """(begin, counts, ids) of distinct words with ascending hashes."""
        size = (stop - start).astype(np.int32)
        at = np.searchsorted(self.key, key)
        at[at == len(self.key)] = 0
        known = self.key[at] == key if len(self.key) else np.zeros(len(key), bool)
        new = np.flatnonzero(~known)
        # a hash is taken for a word only if the length agrees as well
        clash = known.copy()
        clash[known] = self.size[at[known]] != size[known]
        if clash.any():
            self._clear()
            return self.look_up(data, key, start, stop)
        if (len(self.key) + len(new) > self.SIZE or len(self.ids) > self.IDS) and len(self.key):
            self._clear()
            return self.look_up(data, key, start, stop)
        if len(new):
            ids, counts = encode_words(self.vocab, data, start[new], stop[new])
            place = np.searchsorted(self.key, key[new])
            self.begin = np.insert(self.begin, place, len(self.ids) + np.cumsum(counts) - counts)
            self.counts = np.insert(self.counts, place, counts)
            self.size = np.insert(self.size, place, size[new])
            self.key = np.insert(self.key, place, key[new])
            self.ids = np.concatenate([self.ids, ids.astype(self.ids.dtype)])
            at = np.searchsorted(self.key, key)
        return self.begin[at], self.counts[at].astype(np.int64), self.ids


def encode_words(vocab: Vocabulary, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words, one after the other, and how many each has."""
    size = stop - start
    owner = np.repeat(np.arange(len(start)), size)
    raw = data[wordhash.ranges(start, size)]
    kind = _KIND[raw]
    accent = np.zeros(len(raw), bool)  # behind the byte C3
    accent[1:] = raw[:-1] == 0xC3
    closer = (kind == 0) | (accent & ((raw == 0x97) | (raw == 0xB7)))
    odd = np.zeros(len(start), bool)
    odd[owner[closer]] = True
    # plain words: pieces end where the kind changes; a digit is a piece of its own
    raw = np.where(accent, _LOWER_C3[raw], _LOWER[raw])
    plain = ~odd[owner]
    raw, kind, owner = raw[plain], kind[plain], owner[plain]
    new = np.ones(len(raw), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    begin = np.flatnonzero(new)
    width = np.diff(np.append(begin, len(raw)))
    buffer = [raw.tobytes()]
    at = len(raw)
    starts, sizes, owners, special = [], [], [], []
    for word in np.flatnonzero(odd).tolist():
        for piece in vocab.pieces(data[start[word] : stop[word]].tobytes()):
            owners.append(word)
            if isinstance(piece, int):
                special.append((len(begin) + len(starts), piece))
                piece = b"!"
            buffer.append(piece)
            starts.append(at)
            sizes.append(len(piece))
            at += len(piece)
    owner = np.concatenate([owner[begin], np.array(owners, np.int64)])
    begin = np.concatenate([begin, np.array(starts, np.int64)])
    width = np.concatenate([width, np.array(sizes, np.int64)])
    ids, counts = vocab.merge_pieces(np.frombuffer(b"".join(buffer), np.uint8), begin, width)
    place = np.cumsum(counts) - counts
    for i, token in special:
        ids[place[i]] = token
    by_word = np.argsort(owner, kind="stable")
    out = ids[wordhash.ranges(place[by_word], counts[by_word])]
    return out, np.bincount(owner, counts, len(start)).astype(np.int64)


class Encoded:
    """Ids of a slice of texts: distinct words with their ids, and the word at each place."""

    def __init__(self, words: wordhash.Words, lexicon: Lexicon):
        self.offset = words.offset
        key, first, self.which = np.unique(words.lanes[0], return_index=True, return_inverse=True)
        start, stop = words.start, words.stop
        size = stop - start
        if (size[first][self.which] != size).any():  # two words of one hash: only this slice without the lexicon
            first = self.which = np.arange(len(start))
            self.ids, self.counts = encode_words(lexicon.vocab, words.data, start, stop)
            self.begin = np.cumsum(self.counts) - self.counts
        else:
            self.begin, self.counts, self.ids = lexicon.look_up(words.data, key, start[first], stop[first])

    def text_ids(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the offset of each text's ids."""
        counts = self.counts[self.which]
        ids = self.ids[wordhash.ranges(self.begin[self.which], counts)]
        ends = np.concatenate([[0], np.cumsum(counts)])
        return ids, ends[self.offset]

    def joined(self, strings: list[bytes]) -> list[bytes]:
        """Per text the strings of its ids, joined by spaces; ``strings`` is indexed by id."""
        flat = [strings[i] for i in self.ids[wordhash.ranges(self.begin, self.counts)].tolist()]
        end = np.cumsum(self.counts)
        words = [b" ".join(flat[a:b]) for a, b in zip((end - self.counts).tolist(), end.tolist())]
        empty = bool((self.counts == 0).any())
        out = []
        which = self.which.tolist()
        offset = self.offset.tolist()
        for low, high in zip(offset[:-1], offset[1:]):
            parts = [words[w] for w in which[low:high]]
            out.append(b" ".join([p for p in parts if p] if empty else parts))
        return out


def encode_slices(texts: pa.Array, path: str) -> Iterator[tuple[int, int, Encoded]]:
    """(first text, end text, Encoded) for each slice of a string array without nulls."""
    lexicon = _lexicon(path)
    for low, high, words in wordhash.word_slices(texts):
        yield low, high, Encoded(words, lexicon)


def encode_documents(docs: DataFrame, path: str, derive: Callable, schema: str, text: str = "text") -> DataFrame:
    """Encode the texts of ``docs`` and return what ``derive`` makes of them.

    ``derive(rows, encoded)`` gets the rows of a slice (a record batch with the columns of ``docs``) and
    their Encoded, inside the task, and returns a record batch of ``schema``. ``ids_column`` and
    ``decoded_column`` are ready-made results.
    """
    bound_batches(docs.sparkSession)
    at = docs.columns.index(text)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, encoded in encode_slices(wordhash.strings(batch.column(at)), path):
                yield derive(batch.slice(low, high - low), encoded)

    return docs.mapInArrow(of_batches, schema)


def ids_column(encoded: Encoded) -> pa.Array:
    """The ids of each text as a list."""
    ids, offset = encoded.text_ids()
    return pa.ListArray.from_arrays(pa.array(offset.astype(np.int32)), pa.array(ids.astype(np.int32)))


def decode(ids: list[int], path: str) -> str:
    """What the library's decode gives without a decoder, special tokens kept; ids beyond the vocabulary are skipped."""
    tokens = vocabulary(path).tokens
    return b" ".join(tokens[i] for i in ids if 0 <= i < len(tokens)).decode()
