"""Work saved in the fourth round gives what it gave before."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tagwright.llm import packing

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def test_marks_and_case_are_looked_up_once():
    encoder = packing.WordEncoder(WORD_BPE, 2)
    list(encoder.encode([b"Red. red, RED red., green", b"GREEN, green."]))
    assert set(encoder.known) == {b"", b"red", b"green", b".", b",", b".,"}


@pytest.mark.parametrize("texts", [
    ["Red. red, RED red., green", "", "GREEN, green."], ["", " \t"], ["... .a a... a.,.,., ,"],
    ["a....... b.c. É. é, é\u0301. Zo\u0301. x\u0301., 漢. 5. 5, a5.,"], ["x" * 3000 + "." * 3000],
])
def test_pieces_give_the_librarys_ids(texts):
    library = Tokenizer.from_file(WORD_BPE)
    library.no_truncation()
    library.no_padding()
    found = packing.WordEncoder(WORD_BPE, 2).encode([t.encode() for t in texts])
    want = [[*library.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == want
