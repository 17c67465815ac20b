"""The library's fixed values are those the checks expect."""

from checks import expected
from tagwright.functions import charsets, wordlists
from tagwright.functions.text import word_pattern


def test_fixed_values():
    names = [n for n in vars(wordlists) if n.isupper()]
    assert names and all(getattr(wordlists, n) == getattr(expected, n) for n in names)
    assert (charsets.SPACE, charsets.UPPER, charsets.WORD) == (expected.SPACE, expected.UPPER, expected.WORD)
    assert charsets.digit_class() == expected.DIGIT and word_pattern(["a", "b"]) == expected.word_pattern(["a", "b"])
