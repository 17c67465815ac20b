"""Measures of every line of a batch of texts, on byte arrays."""

from __future__ import annotations

import numpy as np

from tagwright.llm.words import Words, covered, mix, per_text, repeated, window_starts, windows

#: fixed values: the characters counted as symbols
SYMBOLS = b"#*$%&|<>"

_CLASSES = {
    "symbol": SYMBOLS,
    "shout": b"!?",
    "other": b"\"()+/:;=@[\\]^_`{}~",
    "upper": bytes(range(65, 91)),
    "letter": bytes([*range(65, 91), *range(97, 123), *range(128, 256)]),
    "digit": b"0123456789",
}
_TABLES = {name: np.isin(np.arange(256), list(members)) for name, members in _CLASSES.items()}
#: the first byte of each character
_CHAR = (np.arange(256) & 0xC0) != 0x80

#: the measures of a line, in the order of the columns of :func:`measure`
MEASURES = (
    "symbols", "shouts", "others", "uppers", "digits", "log_words", "word_length",
    "echoes", "repeats", "bare", "copy", "ended", "empty",
)


class Lines:
    """The ``\\n``-split lines of a batch: bounds in bytes, words and texts."""

    def __init__(self, texts: list[bytes]):
        self.words = w = Words(texts)
        self.ends = np.flatnonzero(w.data == 10)
        self.starts = np.concatenate([[0], self.ends[:-1] + 1]) if len(self.ends) else self.ends
        #: text ``i`` has the lines ``ptr[i]`` to ``ptr[i + 1]``
        self.ptr = np.searchsorted(self.starts, w.text_start)
        bounds = np.concatenate([self.starts, [len(w.data)]])
        self.bounds = bounds
        self.word_ptr = np.searchsorted(w.starts, bounds)
        self.n_words = np.diff(self.word_ptr)
        self.n_chars = per_text(_CHAR[w.data] & (w.data > 32) | (w.data < 9) | (w.data > 13) & (w.data < 32), bounds)

    def count(self, name: str) -> np.ndarray:
        """Bytes of a class per line."""
        return per_text(_TABLES[name][self.words.data], self.bounds)

    def copies(self, hashes: np.ndarray) -> np.ndarray:
        """Marks lines with a word that equal an earlier line of their text, byte for byte."""
        data, out = self.words.data, np.zeros(len(self.starts), bool)
        text = np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))
        # lines that agree in length and words may be equal; the bytes decide
        key = np.zeros(len(self.starts), np.uint64)
        some = np.flatnonzero(self.n_words)
        if not len(some):
            return out
        place = np.arange(len(hashes)) - np.repeat(self.word_ptr[:-1], self.n_words)
        key[some] = np.add.reduceat(mix(hashes + place.astype(np.uint64)), self.word_ptr[:-1][some])
        key = mix(key ^ mix((text.astype(np.uint64) << np.uint64(32)) + (self.ends - self.starts).astype(np.uint64)))
        maybe = some[repeated(key[some])]
        seen: dict[int, set[bytes]] = {}
        for i in maybe.tolist():
            line = data[self.starts[i] : self.ends[i]].tobytes()
            lines = seen.setdefault(int(text[i]), set())
            out[i] = line in lines
            lines.add(line)
        return out


def repeats(words: Words, hashes: np.ndarray, size: int) -> np.ndarray:
    """Marks words inside a window of ``size`` words found twice or more in its text."""
    found = windows(hashes, size)
    at = np.flatnonzero(window_starts(words.ptr, size))
    if not len(at):
        return np.zeros(len(hashes), bool)
    text = np.repeat(np.arange(len(words.ptr) - 1), np.diff(words.ptr))[at]
    marked = np.zeros(len(found), bool)
    marked[at] = repeated(found[at] ^ mix(text.astype(np.uint64)))
    return covered(marked, len(hashes), size)


def measure(lines: Lines, window: int = 4) -> np.ndarray:
    """One row of :data:`MEASURES` per line, each about between 0 and 1."""
    w, chars = lines.words, np.maximum(lines.n_chars, 1)
    hashes = w.hashes()
    n = np.maximum(lines.n_words, 1)
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    named = np.concatenate([[0], np.cumsum(_TABLES["letter"][w.data] | _TABLES["digit"][w.data])])
    bare = named[w.ends] == named[w.starts]
    last = w.data[np.maximum(lines.ends - 1, 0)]
    out = np.stack([
        lines.count("symbol") / chars,
        lines.count("shout") / chars,
        lines.count("other") / chars,
        lines.count("upper") / np.maximum(lines.count("letter"), 1),
        lines.count("digit") / chars,
        np.log1p(lines.n_words) / 5,
        chars / n / 10,
        per_text(same, lines.word_ptr) / n,
        per_text(repeats(w, hashes, window), lines.word_ptr) / n,
        per_text(bare, lines.word_ptr) / n,
        lines.copies(hashes),
        np.isin(last, list(b".!?")) & (lines.n_words > 0),
        lines.n_words == 0,
    ], axis=1)
    return np.minimum(out, 4.0)
