"""Ids of byte-level vocabularies by the ``tokenizers`` library, each distinct word asked for once.

Byte-level pre-tokens never reach across a single space between two characters
that are not white space: the space goes with what follows. A batch of texts is
one byte array, cut there; its distinct pieces are looked up, and the new ones
are encoded in one call. Every token stands for a known number of bytes, so the
ids of the call are cut at the pieces' ends by their byte lengths.

Added tokens are found by the library before anything else; a text that holds
one is cut at it. Memory is bounded in entries and bytes: pieces beyond
``_LONGEST`` bytes are forgotten with their batch.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa

#: fixed values: white space of ASCII, and the rest of the property White_Space in UTF-8
_NARROW = b"\t\n\v\f\r "
_WIDE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
#: what some of them start with
_WIDE_STARTS = b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80"
#: pieces remembered by a worker, and the bytes of the longest of them
_REMEMBERED, _LONGEST = 1_000_000, 48
#: bytes encoded in one call
_CALL_BYTES = 1 << 20

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(_NARROW)] = True


def gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs ``values[start : start + size]``, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(values)) < 1 << 31 else np.int64
    return values[np.repeat((starts - (ends - sizes)).astype(kind), sizes) + np.arange(total, dtype=kind)]


def values_of(array: pa.Array) -> list[bytes]:
    """The values of a binary array that starts at its buffers' start."""
    data, at = array.buffers()[2].to_pybytes(), np.frombuffer(array.buffers()[1], np.int32, len(array) + 1).tolist()
    return [data[a:b] for a, b in zip(at, at[1:])]


class ByteWords:
    """Encoder of one byte-level vocabulary file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary, added = spec["model"]["vocab"], spec.get("added_tokens", [])
        #: bytes each id stands for: byte-level tokens have one character a byte
        self.width = np.zeros(1 + max([*vocabulary.values(), *[t["id"] for t in added]]), np.int64)
        self.width[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.added = {t["content"].encode(): t["id"] for t in added}
        self._split = re.compile(b"(" + b"|".join(map(re.escape, self.added)) + b")") if added else None
        level = spec.get("pre_tokenizer") or {}
        #: whether words may be looked up: byte-level, split by its own pattern, nothing else done to the text
        self.by_word = (
            level.get("type") == "ByteLevel" and level.get("use_regex", True) and not level.get("add_prefix_space")
            and not spec.get("normalizer") and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
        )
        self.known: dict[bytes, bytes] = {}
        self.tails: dict[bytes, bytes] = {}

    def _library(self, texts: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _encode_pieces(self, pieces: list[bytes]) -> None:
        """Encode pieces, each with the space it starts with."""
        at, known = 0, self.known
        while at < len(pieces):
            some, size = [], 0
            while at < len(pieces) and size < _CALL_BYTES:
                some.append(pieces[at])
                size += len(pieces[at])
                at += 1
            ids = np.frombuffer(self._library([b"".join(some)])[0], "<u4")
            ends = np.concatenate([[0], np.cumsum(self.width[ids])])
            wanted = np.cumsum([0, *map(len, some)])
            bounds = np.searchsorted(ends, wanted)
            if not np.array_equal(ends[bounds], wanted):
                raise ValueError("a token reaches across words: not a byte-level vocabulary")
            data, bounds = ids.tobytes(), (4 * bounds).tolist()
            known.update(zip(some, [data[a:b] for a, b in zip(bounds, bounds[1:])]))

    def _learn(self, new: list[bytes]) -> None:
        """What is not known yet, cut before the full stops and commas at its end: after a letter they are a
        pre-token of their own, so each word is encoded once."""
        known, cut, stems = self.known, [], set()
        for piece in new:
            stem = piece.rstrip(b".,")
            if len(stem) == len(piece) or not (stem[-1:].isalpha() or stem[-4:].decode(errors="ignore")[-1:].isalpha()):
                stems.add(piece)
            else:
                tail = piece[len(stem):]
                if tail not in self.tails:
                    self.tails[tail] = self._library([tail])[0]
                cut.append((piece, stem, tail))
                stems.add(stem)
        self._encode_pieces(list(stems.difference(known)))
        known.update([(piece, known[stem] + self.tails[tail]) for piece, stem, tail in cut])

    def _forget(self, new: list[bytes]) -> None:
        known = self.known
        for piece in new:
            if len(piece) > _LONGEST:
                known.pop(piece, None)
                known.pop(piece.rstrip(b".,"), None)
        if len(self.tails) > 1000:
            self.tails.clear()
        if len(known) > _REMEMBERED:
            # what was learned first stays: frequent words come early
            for _ in range(len(known) - _REMEMBERED // 2):
                known.popitem()

    def _pieces(self, parts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
        """The parts' pieces, each with a space in front, and which of them start a part."""
        data = b" ".join([b"", *parts])
        view = np.frombuffer(data, np.uint8)
        starts = np.cumsum([0, *[len(p) + 1 for p in parts]])
        space = np.flatnonzero(view == 32)
        before, after = view[np.maximum(space - 1, 0)], view[np.minimum(space + 1, len(view) - 1)]
        bad = _IS_SPACE[before] | _IS_SPACE[after]
        if any(w in data for w in _WIDE_STARTS):
            wide = np.zeros(len(view) + 2, bool)
            for m in _WIDE.finditer(data):
                wide[m.start() : m.end()] = True
            bad |= wide[np.maximum(space - 1, 0)] | wide[space + 1]
        first = np.zeros(len(view) + 1, bool)
        first[starts[:-1]] = True
        first = first[space]
        cuts = space[first | ~bad]
        # a space next to a part's bounds is none to cut at: the part's own bound is one
        offsets = np.append(cuts, len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        return pieces, first[first | ~bad]

    def _encode_parts(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts, and where each part starts."""
        pieces, first = self._pieces(parts)
        coded = pieces.filter(pa.array(~first)).dictionary_encode()
        distinct = values_of(coded.dictionary) if len(coded) else []
        found = list(map(self.known.get, distinct))
        if None in found:
            new = [p for p, ids in zip(distinct, found) if ids is None]
            self._learn(new)
            found = list(map(self.known.__getitem__, distinct))
            self._forget(new)
        starting = self._library([p[1:] for p in pieces.filter(pa.array(first)).to_pylist()])
        values = np.frombuffer(b"".join([*found, *starting]), "<u4")
        size = np.fromiter(map(len, [*found, *starting]), np.int64, len(found) + len(starting)) // 4
        which = np.empty(len(pieces), np.int64)
        which[~first] = coded.indices.to_numpy()
        which[first] = len(found) + np.arange(len(starting))
        sizes = size[which]
        at = np.concatenate([[0], np.cumsum(sizes)])
        return gather(values, (np.cumsum(size) - size)[which], sizes), np.append(at[:-1][first], at[-1])

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and the bounds of each text's among them."""
        if not self.by_word:
            found = self._library(texts)
            return np.frombuffer(b"".join(found), "<u4"), np.cumsum([0, *[len(x) // 4 for x in found]])
        parts, of, marks = [], [], []
        for i, text in enumerate(texts):
            for part in self._split.split(text) if self._split and any(a in text for a in self.added) else [text]:
                if part:
                    marks.append(self.added.get(part, -1))
                    parts.append(b"" if marks[-1] >= 0 else part)
                    of.append(i)
        if not parts:
            return np.zeros(0, "<u4"), np.zeros(len(texts) + 1, np.int64)
        ids, at = self._encode_parts(parts)
        marks, sizes = np.array(marks), np.diff(at)
        if (marks >= 0).any():
            ids = np.insert(ids, at[:-1][marks >= 0], marks[marks >= 0].astype("<u4"))
            sizes[marks >= 0] = 1
        return ids, np.concatenate([[0], np.cumsum(np.bincount(of, sizes, len(texts)).astype(np.int64))])
