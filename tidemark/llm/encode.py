"""Whole-text tokenization inside tasks, with the work shared between equal words.

The ids of a text are exactly those of ``Tokenizer.encode``. For the two
vocabularies whose pre-tokenizer never joins a non-space character to the
white space after it, nor a letter to the punctuation marks that end a
word, a text falls apart into units that encode independently: words led by
their white space (``space_led``) or bare words (``bare``). Each distinct unit
is encoded once and looked up afterwards, once for each slice of texts. Any other tokenizer (``whole``), and
any text with the separators U+001C..U+001F (white space to Python, not to
the tokenizer), is encoded whole.
"""

from __future__ import annotations

import os
import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

FIRST = "\x1f"  # marks the first unit of a text, which has no white space before it
ODD_SEPARATORS = "\x1c\x1d\x1e\x1f"
UNEVEN_SPACE = re.compile(r"\s[ \n]")
WORD_WITH_SPACE = re.compile(r"\s*\S+|\s+")
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII punctuation that ends a word; an apostrophe may belong to its letters


def space_led(text: str) -> list[str]:
    """Units of a text: ``word`` stands for the word after one space, any other white space is spelled out."""
    if UNEVEN_SPACE.search(text):
        out = WORD_WITH_SPACE.findall(text)
        return [FIRST + out[0], *(u[1:] if u[0] == " " and len(u) > 1 and not u[1].isspace() else FIRST + u for u in out[1:])]
    out = text.replace("\n", " \n").split(" ")  # a unit that begins with a line end has no space before it
    out[0] = FIRST + out[0]
    return out


def spelled(unit: str) -> str:
    return unit[1:] if unit[:1] == FIRST else unit if unit[:1] == "\n" else " " + unit


def byte_characters() -> dict[int, int]:
    """Byte -> printable character, the rule of byte-level vocabularies: printable bytes stand for themselves."""
    printable = [b for b in range(256) if 33 <= b <= 126 or (161 <= b and b != 173)]
    others = (b for b in range(256) if b not in set(printable))
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}


BYTE_CHARACTERS = byte_characters()
BYTE_SPACE = chr(BYTE_CHARACTERS[ord(" ")])


def byte_level(word: str) -> str:
    if word.isalpha() and word.isascii():
        return word
    return word.encode().decode("latin-1").translate(BYTE_CHARACTERS)


def lower_byte_level(word: str) -> str:
    return byte_level(word.lower())


def is_plain(word: str) -> bool:
    """A word of Latin letters in normal form: one piece to either pre-tokenizer."""
    return word.isalpha() and (word.isascii() or (max(word) < "\u0250" and unicodedata.is_normalized("NFC", word)
                                                   and word.lower().isalpha()))


# How to split a text into units, what a unit stands for, and what a plain word is to the model.
SPLIT = {"space_led": (space_led, spelled, lambda w: BYTE_SPACE + byte_level(w)), "bare": (str.split, str, lower_byte_level),
         "whole": (None, None, None)}


class UnitEncoder:
    """Encodes texts to little-endian uint32 bytes; keeps at most ``limit`` units between calls."""

    def __init__(self, path: str, units: str = "whole", limit: int = 800_000):
        from tokenizers import Tokenizer  # noqa: PLC0415 -- loaded in the tasks

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True  # their strings in a text are ordinary text
        self.split, self.spelled, self.for_model = SPLIT[units]
        self.model = self.tok.model
        self.limit = limit
        self.known: dict[str, bytes] = {}
        # A second instance reads its last special token as a mark between units: one call encodes them all.
        self.marked = Tokenizer.from_file(path)
        special = [(i, t.content) for i, t in self.marked.get_added_tokens_decoder().items() if t.special]
        self.mark_id, self.mark = max(special, default=(None, None))
        self.specials = [t for _, t in special]

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, dtype="<u4").tobytes()
                for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_units(self, units: list[str]) -> list[bytes]:
        """The ids of each unit. Plain words go straight to the vocabulary's model; where another
        unit spells a special token, those others are encoded one by one."""
        plain, rest = [], []
        for u in units:
            (plain if is_plain(u) else rest).append(u)
        if rest:
            known = dict(zip(rest, self._encode_spelled([self.spelled(u) for u in rest])))
        tokenize, words, ids, ends = self.model.tokenize, map(self.for_model, plain), [], [0]
        for w in words:
            ids += [t.id for t in tokenize(w)]
            ends.append(4 * len(ids))
        coded = np.asarray(ids, dtype="<u4").tobytes()
        out = [coded[a:b] for a, b in zip(ends, ends[1:])]
        if rest:
            known.update(zip(plain, out))
            out = [known[u] for u in units]
        return out

    def _encode_spelled(self, units: list[str]) -> list[bytes]:
        if not units:
            return []
        if self.mark is None or any(t in "\n".join(units) for t in self.specials):
            return self._whole(units)
        ids = np.asarray(self.marked.encode_batch_fast([self.mark.join(units)], add_special_tokens=False)[0].ids, dtype="<u4")
        cuts = 4 * np.flatnonzero(ids == self.mark_id)
        coded = ids.tobytes()
        return [coded[a:b] for a, b in zip([0, *(cuts + 4).tolist()], [*cuts.tolist(), len(coded)])]

    def _learn(self, new: list[str]) -> list[str]:
        """Add the ids of new units to ``known``; returns what was added."""
        known, parts, need = self.known, [], set()
        for u in new:
            stem = u.rstrip(MARKS) if u and u[-1] in MARKS else u
            if stem is not u and stem and is_plain(stem[-1]):
                tail = self.tail(u[len(stem):])
                parts.append((u, stem, tail))
                need.update((stem, tail))
            else:
                need.add(u)
        need = [u for u in need if u not in known]
        known.update(zip(need, self._encode_units(need)))
        for u, stem, tail in parts:
            known[u] = known[stem] + known[tail]
        return need + [p[0] for p in parts]

    def tail(self, marks: str) -> str:
        """Punctuation marks that end a word, as a unit."""
        return FIRST + marks if self.split is space_led else marks

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.split is None:
            return self._whole(texts)
        odd = {i for i, t in enumerate(texts) if any(c in t for c in ODD_SEPARATORS)}
        even = [i for i, t in enumerate(texts) if t and i not in odd and self.split is space_led and not UNEVEN_SPACE.search(t)]
        alone = set(even)
        rest = [i for i, t in enumerate(texts) if t and i not in odd and i not in alone]
        # What space_led() does to a text of single spaces, for all of them at once.
        spaced = pc.split_pattern(pa.array([FIRST + texts[i].replace("\n", " \n") for i in even], pa.large_string()), " ")
        split = [self.split(texts[i]) for i in rest]
        # Each distinct unit of the slice is looked up once; its ids are then copied to where it occurs.
        occurring = pa.concat_arrays([spaced.flatten(), pa.array(list(chain.from_iterable(split)), pa.large_string())]).dictionary_encode()
        units, at = occurring.dictionary.to_numpy(zero_copy_only=False).tolist(), occurring.indices.to_numpy(zero_copy_only=False)
        known = self.known
        coded = list(map(known.get, units))
        new = [i for i, c in enumerate(coded) if c is None]
        added = self._learn([units[i] for i in new])
        for i in new:
            coded[i] = known[units[i]]
        size = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        first, n = (np.cumsum(size) - size)[at], size[at]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = np.frombuffer(b"".join(coded), dtype="<u4")[np.repeat(first - ends[:-1], n) + np.arange(ends[-1])].tobytes()
        cuts = (4 * ends[np.cumsum([0, *pc.list_value_length(spaced).to_pylist(), *map(len, split)])]).tolist()
        out = [b""] * len(texts)
        for i, a, b in zip(even + rest, cuts, cuts[1:]):
            out[i] = ids[a:b]
        whole = sorted(odd)
        for i, coded in zip(whole, self._whole([texts[i] for i in whole])):
            out[i] = coded
        if len(known) > self.limit:  # frequent units came early and stay; the rest are encoded again when met
            for u in added:
                del known[u]
        return out


_ENCODERS: dict[tuple, UnitEncoder] = {}


def encoder(path: str, units: str) -> UnitEncoder:
    """The encoder of this Python worker."""
    if (path, units) not in _ENCODERS:
        _ENCODERS[path, units] = UnitEncoder(path, units)
    return _ENCODERS[path, units]


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer  # noqa: PLC0415

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def slices(texts: list[str], chars: int = 6_000_000):
    """Index ranges of about ``chars`` characters of text each (one text at least)."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
