"""Byte-level BPE as a streaming transducer with bounded lookahead, and back.

Encoding reads the bytes of a pre-token from left to right. For every prefix it
knows the last token of that prefix's encoding: the one token that ends there
and may follow the last token of what lies before it. Two tokens may be
neighbours if no merge reaches across their boundary at a time when both its
parts exist, which the merge list alone decides.

Lookahead: a token of a later prefix starts at most ``lookahead`` bytes back,
that being the longest token of the merge list. So any later encoding passes
through one of the last ``lookahead`` boundaries; what the chains of all of
them have in common is stable, is emitted and forgotten. Memory depends on the
merge list, not on the length of the text.

Decoding feeds the tokens' bytes piece by piece to an incremental UTF-8 state
machine, which replaces ill-formed parts by U+FFFD.

Null texts are empty: no ids, an empty decoded text. Repeated rows are encoded
each by itself, null keys stay, other columns are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tagwright.llm.frames import forget_late, held, map_texts

#: fixed values: the characters with the property White_Space
_SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: fixed value: the pre-token pattern of byte-level BPE vocabularies
_PRETOKEN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACES}\p{{L}}\p{{N}}]+|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
)
#: white space and what follows it up to the next white space: no pre-token crosses their ends
_STRETCH = regex.compile(rf"[{_SPACES}]*[^{_SPACES}]+|[{_SPACES}]+")
_IS_SPACE = regex.compile(rf"[{_SPACES}]")
#: encodings remembered by a worker, of pre-tokens and of pieces, and the characters of the longest of them
_REMEMBERED, _LONGEST = 700_000, 64
#: ids decoded at once
_DECODE_IDS = 1 << 16


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Transducer:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of, model = _byte_of_char(), spec["model"]
        as_bytes = lambda token: bytes(byte_of[c] for c in token)
        self.id_of = {as_bytes(t): i for t, i in model["vocab"].items() if all(c in byte_of for c in t)}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        for text in self.added:
            self.id_of.pop(text.encode(), None)
        self.bytes_of = {i: t for t, i in self.id_of.items()} | {i: t.encode() for t, i in self.added.items()}
        self.rank: dict[tuple[int, int], int] = {}
        #: the two tokens each merged token is made of, and the rank at which it is
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = (as_bytes(t) for t in (pair.split(" ") if isinstance(pair, str) else pair))
            left, right = self.id_of[a], self.id_of[b]
            self.rank.setdefault((left, right), rank)
            self.made.setdefault(self.id_of[a + b], (left, right, rank))
        #: tokens by their bytes, and -1 for bytes that only start one
        usable = [t for t, i in self.id_of.items() if len(t) == 1 or i in self.made]
        self.walk: dict[bytes, int] = {t[:n]: -1 for t in usable for n in range(1, len(t))}
        self.walk.update((t, self.id_of[t]) for t in usable)
        self.lookahead = max(map(len, usable))
        self._split = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        self._meets: dict[tuple[int, int], bool] = {}
        self._pretokens: dict[str, bytes] = {}
        self._after_space: dict[str, bytes | None] = {}

    # ------------------------------------------------------------ one pre-token
    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens that touch a token's left (0) or right (1) end over time,
        each with the rank of the merge that takes it up."""
        out, until = [], float("inf")
        while True:
            out.append((token, until))
            if token not in self.made:
                return out
            until, token = self.made[token][2], self.made[token][side]

    def may_meet(self, a: int, b: int) -> bool:
        """Whether no merge reaches across the boundary of two neighbours.

        A merge of rank r reaches across while both its parts wait to be taken
        up. Of merges of the same rank the left one comes first.
        """
        if a < 0:
            return True
        return not any(
            r < taken and r <= taken_right
            for x, taken in self._edge(a, 1) for y, taken_right in self._edge(b, 0)
            if (r := self.rank.get((x, y))) is not None
        )

    def emit(self, data: bytes) -> Iterator[int]:
        """The ids of one pre-token, each as soon as it is stable."""
        get, known, ahead, size = self.walk.get, self._meets, self.lookahead, len(data)
        check = 8 * ahead
        #: by boundary, counted from the last stable one: the token that ends there, and where it starts
        token, start = [-1] * (min(size, check + ahead) + 1), [0] * (min(size, check + ahead) + 1)
        done = i = 0
        while done + i < size:
            before = token[i]
            for j in range(i + 1, min(size - done, i + ahead) + 1):
                t = get(data[done + i : done + j])
                if t is None:
                    break
                if t >= 0 and token[j] < 0:
                    meets = known.get((before, t))
                    if meets is None:
                        meets = known[before, t] = self.may_meet(before, t)
                    if meets:
                        token[j], start[j] = t, i
            i += 1
            if i == check:
                # boundaries before the stable one are in no later encoding and forgotten
                stable = self._common(start, i)
                yield from self._chain(token, start, stable)
                token, start = token[stable:] + [-1] * stable, [x - stable for x in start[stable:]] + [0] * stable
                done, i = done + stable, i - stable
                if not stable:
                    check += check
                    token, start = token + [-1] * check, start + [0] * check
        yield from self._chain(token, start, size - done)
        if len(known) > 2_000_000:
            known.clear()

    def _common(self, start: list[int], now: int) -> int:
        """The last boundary that the encodings of all recent prefixes share."""
        at = set(range(max(0, now - self.lookahead + 1), now + 1))
        while len(at) > 1:
            high = max(at)
            at.remove(high)
            at.add(max(0, start[high]))
        return at.pop()

    @staticmethod
    def _chain(token: list[int], start: list[int], end: int) -> list[int]:
        out = []
        while end > 0:
            out.append(token[end])
            end = start[end]
        return out[::-1]

    # ------------------------------------------------------------ whole texts
    def _pretoken(self, text: str) -> bytes:
        ids = self._pretokens.get(text)
        if ids is None:
            ids = np.array([*self.emit(text.encode())], "<u4").tobytes()
            if len(text) <= _LONGEST:
                forget_late(self._pretokens, _REMEMBERED)
                self._pretokens[text] = ids
        return ids

    def _stretch(self, text: str) -> bytes:
        return b"".join(map(self._pretoken, _PRETOKEN.findall(text)))

    def _piece(self, piece: str, lead: str) -> bytes | None:
        """Ids of what stands between two spaces, with the space before; None where
        it must not be looked at alone."""
        if not piece or _IS_SPACE.match(piece[-1]):
            return None
        stem = piece.rstrip(".,")
        if stem.isalpha():
            # letters, then full stops and commas: two pre-tokens
            return self._pretoken(lead + stem) + (self._pretoken(piece[len(stem):]) if len(stem) < len(piece) else b"")
        return self._stretch(lead + piece)

    def _plain(self, text: str) -> bytes:
        """Ids of a text without added tokens, 4 bytes each.

        The text is cut before each space that follows something else; what
        lies between is looked up. Where spaces meet other white space it is
        cut into stretches instead.
        """
        first, *pieces = text.split(" ")
        known = self._after_space
        forget_late(known, _REMEMBERED)
        long = []
        for piece in set(pieces):
            if piece not in known:
                known[piece] = self._piece(piece, " ")
                if len(piece) > _LONGEST:
                    long.append(piece)
        found = [self._piece(first, ""), *map(known.__getitem__, pieces)]
        for piece in long:
            del known[piece]
        if None in found:
            return b"".join(map(self._stretch, _STRETCH.findall(text)))
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if not self._split or not any(t in text for t in self.added):
            return self._plain(text) if text else b""
        return b"".join(
            np.array([self.added[part]], "<u4").tobytes() if part in self.added else self._plain(part)
            for part in self._split.split(text) if part
        )

    def decode(self, ids: bytes) -> Iterator[str]:
        """The text of the ids, piece by piece."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for at in range(0, len(ids), 4 * _DECODE_IDS):
            some = np.frombuffer(ids[at : at + 4 * _DECODE_IDS], "<u4").tolist()
            yield machine.decode(b"".join(map(self.bytes_of.__getitem__, some)))
        yield machine.decode(b"", True)


def _load(path: str) -> Transducer:
    return held(path, lambda: Transducer(path))


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids`` (array of int) of every row; ``path`` must exist on all executors."""
    def make():
        machine = _load(path)
        return lambda texts: {"ids": [np.frombuffer(machine.encode(t.decode()), "<i4") for t in texts]}

    return map_texts(docs, make, "ids array<int>", key, text, holds=True)


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and ``text`` of every row of ids; null ids give an empty text."""
    schema = T.StructType([encoded.schema[key], T.StructField("text", T.StringType())])

    def run(batches):
        machine = _load(path)
        for batch in batches:
            texts = ["".join(machine.decode(np.array(i or [], "<u4").tobytes())) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return encoded.select(key, ids).mapInArrow(run, schema)


def round_trip_digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Number and digest of each text's ids, and the digest of what they decode to.

    Ids and decoded text stay in the task, so that only digests are written.
    """
    def make():
        machine = _load(path)

        def run(texts):
            out = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for t in texts:
                ids, back = machine.encode(t.decode()), hashlib.sha256()
                for part in machine.decode(ids):
                    back.update(part.encode())
                out["n_tokens"].append(len(ids) // 4)
                out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                out["decoded_sha256"].append(back.hexdigest())
            return out

        return run

    return map_texts(docs, make, "n_tokens long, ids_sha256 string, decoded_sha256 string", key, text, holds=True)
