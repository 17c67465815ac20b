"""Packs documents into token sequences: first-fit decreasing over random groups.

A document is its ids and one end id. It is cut into pieces of the sequence
length from its start; full pieces are sequences of their own. The remainders
are dealt into groups by a hash and packed group by group, longest first, each
into the first sequence with room. A tournament tree over the sequences' room
finds it in logarithmic time. What does not reach ``length`` is padded, except
where a sequence's fill is a power of two.

Null texts are empty: their document is the end id alone. Repeated rows are
packed each by itself and null keys stay null. The number of groups follows the
number of rows, so a group has about ``group_docs`` rows at any size: a task
holds the lengths of one group, never ids. An empty table gives no pieces.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagwright.llm.byte_words import gather, values_of
from tagwright.llm.frames import forget_late, held, map_texts
from tagwright.llm.words import Words

#: encodings remembered by a worker, 200 bytes each
_REMEMBERED = 550_000
#: stems encoded in one call
_CALL = 5_000
#: full stops and commas at a word's end that are a piece of their own
_MARKS = 3
_IS_MARK = np.zeros(256, bool)
_IS_MARK[list(b".,")] = True


def _ends_plainly(stem: bytes) -> bool:
    """Whether the last character is a small Latin letter: no normalisation joins it with a mark."""
    c = stem[-4:].decode(errors="ignore")[-1:]
    return c.isalpha() and c < "\u0250" and c.lower() == c


class WordEncoder:
    """Ids by the ``tokenizers`` library, word by word.

    For vocabularies that drop white space and case, cut words where letters
    meet marks, and never join across white space. Words are lower-cased and
    cut into a stem and the full stops and commas at its end. Each distinct
    piece of a batch is looked up once, and each distinct stem encoded once.
    """

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.end = np.array([end_id], "<u4").tobytes()
        self.known: dict[bytes, bytes] = {b"": b""}

    def _encode_stems(self, stems: list[bytes]) -> None:
        """Many in one call, cut by the numbers of their pieces where each is one piece."""
        for at in range(0, len(stems), _CALL):
            some = stems[at : at + _CALL]
            found = self.tokenizer.encode(b" ".join(some).decode(), add_special_tokens=False)
            ids, piece = np.array(found.ids, "<u4"), np.array(found.word_ids, np.int64)
            bounds = np.append(np.flatnonzero(np.diff(piece, prepend=-1)), len(ids)).tolist()
            if len(bounds) != len(some) + 1:
                self._encode_each(some)
                continue
            data = ids.tobytes()
            self.known.update((s, data[4 * a : 4 * b]) for s, a, b in zip(some, bounds, bounds[1:]))

    def _encode_each(self, stems: list[bytes]) -> None:
        found = self.tokenizer.encode_batch([s.decode() for s in stems], add_special_tokens=False)
        self.known.update((s, np.array(e.ids, "<u4").tobytes()) for s, e in zip(stems, found))

    def _learn(self, words: list[bytes]) -> None:
        known, cut, plain, other = self.known, [], set(), set()
        for word in words:
            low = word.lower()
            stem = low.rstrip(b".,")
            if len(stem) < len(low) and not (stem and (97 <= stem[-1] <= 122 or _ends_plainly(stem))):
                stem = low
            if stem not in known:
                # letters alone are one piece each
                (plain if stem.isalpha() or stem.decode().isalpha() else other).add(stem)
            if stem is not word and stem != word:
                tail = low[len(stem):]
                if tail not in known:
                    other.add(tail)
                cut.append((word, stem, tail))
        self._encode_stems(list(plain))
        rest = list(other)
        for at in range(0, len(rest), _CALL):
            self._encode_each(rest[at : at + _CALL])
        known.update([(word, known[stem] + known[tail]) for word, stem, tail in cut])

    @staticmethod
    def _pieces(words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Sizes of words cut before the full stops and commas after a small letter, and each text's bounds among them.

        More marks than ``_MARKS`` stay with their word.
        """
        marked, n = np.arange(len(words.starts)), np.zeros(len(words.starts), np.int64)
        for k in range(1, _MARKS + 2):
            at = words.ends[marked] - k
            marked = marked[(at > words.starts[marked]) & _IS_MARK[words.data[at]]]
            n[marked] = k
        before = words.data[words.ends - n - 1]
        n[(n > _MARKS) | (before < 97) | (before > 122)] = 0
        cut = n > 0
        after = np.cumsum(cut)
        place = np.arange(len(n)) + after - cut
        sizes = np.empty(len(n) + int(cut.sum()), np.int64)
        sizes[place] = words.ends - words.starts - n
        sizes[place[cut] + 1] = n[cut]
        return sizes, words.ptr + np.concatenate([[0], after])[words.ptr]

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """Each text's ids with the end id, as little-endian unsigned 32-bit integers."""
        known, words = self.known, Words([t.lower() for t in texts])
        size, ptr = self._pieces(words)
        coded = words.array(size).dictionary_encode()
        distinct = values_of(coded.dictionary) if len(coded) else []
        forget_late(known, _REMEMBERED)
        found = list(map(known.get, distinct))
        new = [i for i, ids in enumerate(found) if ids is None]
        if new:
            self._learn([distinct[i] for i in new])
            for i in new:
                found[i] = known[distinct[i]]
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        which = coded.indices.to_numpy()
        sizes = size[which]
        ids = gather(np.frombuffer(b"".join(found), "<u4"), (np.cumsum(size) - size)[which], sizes).tobytes()
        at = 4 * np.concatenate([[0], np.cumsum(sizes)])[ptr]
        for a, b in zip(at.tolist(), at[1:].tolist()):
            yield ids[a:b] + self.end


def _load(path: str, end_id: int) -> WordEncoder:
    return held((path, end_id), lambda: WordEncoder(path, end_id))


class Room:
    """A tournament tree over the room left in sequences: the first with enough room wins."""

    def __init__(self, n: int, length: int):
        self.size = 1 << max(0, n - 1).bit_length()
        self.tree = [length] * (2 * self.size)

    def put(self, need: int) -> tuple[int, int]:
        """Take ``need`` from the first sequence that has it: its number and the room it had."""
        tree, at = self.tree, 1
        while at < self.size:
            at *= 2
            at += tree[at] < need
        had = tree[at]
        tree[at] = had - need
        slot = at - self.size
        while at > 1:
            at //= 2
            tree[at] = max(tree[2 * at], tree[2 * at + 1])
        return slot, had


def first_fit_decreasing(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence of each size and its offset there; ties go by position."""
    where, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    room = Room(len(sizes), length)
    for i in np.argsort(-sizes, kind="stable").tolist():
        slot, had = room.put(int(sizes[i]))
        where[i], offset[i] = slot, length - had
    return where, offset


def pack(
    docs: DataFrame, path: str, length: int = 4096, end_id: int = 2, group_docs: int = 8192, seed: int = 1,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per piece: where it lies in its document and in which sequence."""
    step = 4 * length

    def make():
        encoder = _load(path, end_id)

        def run(texts):
            tokens, sums = [], []
            for ids in encoder.encode(texts):
                tokens.append(len(ids) // 4)
                sums.append([zlib.crc32(ids[at : at + step]) for at in range(0, len(ids), step)])
            return {"doc_tokens": tokens, "sums": sums}

        return run

    groups = max(1, -(-docs.count() // group_docs))
    cut = map_texts(docs, make, "doc_tokens long, sums array<long>", key, text, holds=True)
    # the hash tells documents apart, the place those that are equal: a task gets its rows in the same order again
    group = F.xxhash64(F.lit(seed), F.col(key), "doc_tokens", "sums", F.monotonically_increasing_id())
    cut = cut.withColumn("__part", F.pmod(group, F.lit(groups)))

    out = T.StructType([docs.schema[key], *T.StructType.fromDDL(
        "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )])

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_tokens", key], kind="stable", na_position="last")
        tokens = rows["doc_tokens"].to_numpy()
        pieces = -(-tokens // length)
        doc = np.repeat(np.arange(len(rows)), pieces)
        start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * length
        size = np.minimum(tokens[doc] - start, length)
        full = size == length
        where, offset = np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64)
        where[~full], offset[~full] = first_fit_decreasing(size[~full], length)
        where[full] = where[~full].max(initial=-1) + 1 + np.arange(full.sum())
        return pd.DataFrame({
            key: rows[key].to_numpy()[doc], "start": start, "length": size,
            "ids_crc32": np.concatenate([np.asarray(s, np.int64) for s in rows["sums"]]),
            "doc_tokens": tokens[doc], "sequence_id": where + (int(rows["__part"].iloc[0]) << 32), "offset": offset,
        })

    return cut.groupBy("__part").applyInPandas(place, out)


def sequences(
    docs: DataFrame, path: str, length: int = 4096, end_id: int = 2, pad_id: int = 0, group_docs: int = 8192,
    seed: int = 1, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``sequence_id, n_tokens, ids``: the packed ids themselves, padded to ``length``
    unless their number is a power of two. ``key`` must be unique and not null.
    A row holds one sequence; ids travel once, as pieces."""
    def make():
        encoder = _load(path, end_id)
        return lambda texts: {"ids": [np.frombuffer(ids, "<i4") for ids in encoder.encode(texts)]}

    pieces = pack(docs, path, length, end_id, group_docs, seed, key, text)
    ids = map_texts(docs, make, "ids array<int>", key, text, holds=True)
    cut = pieces.join(ids, key).select(
        "sequence_id", F.struct("offset", F.slice("ids", F.col("start").cast("int") + 1, F.col("length").cast("int")).alias("ids")).alias("p")
    )
    joined = cut.groupBy("sequence_id").agg(F.sort_array(F.collect_list("p")).alias("p")).select(
        "sequence_id", F.flatten(F.transform("p", lambda p: p["ids"])).alias("ids")
    )
    n = F.size("ids")
    padding = F.when((n == length) | (n.bitwiseAND(n - 1) == 0), 0).otherwise(length - n)
    return joined.select(
        "sequence_id", n.alias("n_tokens"), F.concat("ids", F.array_repeat(F.lit(pad_id), padding)).alias("ids")
    )
