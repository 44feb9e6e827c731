"""Unit-wise encoding equals encoding whole texts."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.encode import UnitEncoder, slices

PIECES = ["a", "Th", "é", "ß", "İ", "Σ", "ς", ".", " ", "  ", "\n", "\n\n", ",", "..", "!", "'s", "'", "1", "22", "½", "\t", "\r\n", "\xa0",
          " ", "́", "<|endoftext|>", "\x1c", "　", "中", "-", "_", "😀", ",,", "\x85", "word", "The"]
CASES = [("byte_bpe_50k.json", "space_led"), ("word_bpe_49k.json", "bare")]


@pytest.mark.parametrize("name,units", CASES)
def test_units_encode_as_the_whole_text(name, units):
    enc = UnitEncoder(public_tokenizers.path(name), units, limit=200)

    @settings(max_examples=150, deadline=None)
    @given(st.lists(st.lists(st.one_of(st.sampled_from(PIECES), st.text(max_size=4)), max_size=25).map("".join), max_size=8))
    def same(texts):
        assert enc.encode(texts) == enc._whole(texts)

    same()


def test_whole_units_and_slices():
    enc = UnitEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert enc.encode(["one two", ""]) == enc._whole(["one two", ""])
    texts = ["x" * n for n in (5, 1, 0, 30, 2, 2)]
    assert [texts[a:b] for a, b in slices(texts, 6)] == [texts[:2], texts[2:4], texts[4:]]
    assert list(slices([])) == []


@pytest.mark.parametrize("name,units", CASES)
def test_marks_that_end_a_word_are_no_units_of_their_own_with_it(name, units):
    enc, spelled = UnitEncoder(public_tokenizers.path(name), units), []
    encode = enc._encode_units
    enc._encode_units = lambda new: spelled.extend(new) or encode(new)
    texts = ["some word### word,$$$ word!\nword&&& word", "word;", "word  word-- don't!!"]
    assert enc.encode(texts) == enc._whole(texts)
    assert not any("word" in u and u.endswith(("#", "$", "!", "&", ";", "-")) for u in spelled)
    assert len(spelled) == len(set(spelled))
