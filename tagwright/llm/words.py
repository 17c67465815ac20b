"""Words, word windows and their 64-bit hashes, found on whole byte buffers.

A batch of texts is one byte array. Words are runs of bytes outside the space
class, so nothing is decoded, and a hash of any length costs a few array
operations per eight bytes. Hashes depend on fixed constants alone, hence agree
between executors. Words and runs of words are mixed block by block, so that no
pattern of theirs makes two of them agree but by chance, in 2**-64 of cases;
windows, of a few words each, are sums of mixed words weighted by place.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: fixed values: the bytes that separate words, ``[\x20\x09-\x0D]``
SPACE = b" \t\n\v\f\r"
#: bytes of text worked on at once, dozens of bytes of memory each; a longer document is worked on alone
CHUNK_BYTES = 600_000
#: values whose powers are kept
_SEGMENT = 1 << 17
#: blocks of a word that are mixed one into the next; the rest of a longer word is mixed by place and summed
_CHAIN = 8

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TO_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())

WORD_BYTES = np.ones(256, bool)
WORD_BYTES[list(SPACE)] = False


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE, _STEP = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
#: what is left of eight bytes when only the first ones count
_FIRST = np.array([0, *[(1 << 8 * n) - 1 for n in range(1, 9)]], np.uint64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    size = max(_SEGMENT, 1 << (n - 1).bit_length())
    if size not in _POWERS:
        up, down = np.full(size, _STEP, np.uint64), np.full(size, pow(_STEP, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        pair = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if size > _SEGMENT:
            return pair
        _POWERS[size] = pair
    return _POWERS[size]


def lower(text: bytes) -> bytes:
    """A-Z in lower case, all else as it is."""
    return text.translate(_TO_LOWER)


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return freed memory to the machine: Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


class Words:
    """The words of a batch of texts: ``starts`` and ``ends`` in ``data``;
    text ``i`` has the words ``ptr[i]`` to ``ptr[i + 1]``."""

    def __init__(self, texts: list[bytes], word_bytes: np.ndarray = WORD_BYTES):
        self.bytes = b"\n".join([*texts, b""])
        self.data = np.frombuffer(self.bytes, np.uint8)
        self.text_start = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=self.text_start[1:])
        inside = word_bytes[self.data]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edges = np.concatenate([[0], edges])
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.ptr = np.searchsorted(self.starts, self.text_start)

    def hashes(self, length: int | None = None, tail: bool = False, some: np.ndarray | None = None) -> np.ndarray:
        """One value per word, or per word of ``some``; with ``length``, of its first bytes only, or of its last (``tail``)."""
        starts, ends = (self.starts, self.ends) if some is None else (self.starts[some], self.ends[some])
        if length is not None and tail:
            starts = np.maximum(starts, ends - length)
        elif length is not None:
            ends = np.minimum(ends, starts + length)
        size = ends - starts
        # eight bytes from any place on
        padded = self.bytes + bytes(8)
        eight = np.ndarray(len(self.bytes) + 1, "<u8", padded, strides=(1,))
        out = mix(size.astype(np.uint64) * np.uint64(_BASE) + np.uint64(1))
        out = mix(out ^ (eight[starts] & _FIRST[np.minimum(size, 8)]))
        left = np.flatnonzero(size > 8)
        for k in range(1, _CHAIN):
            if not len(left):
                return out
            at = starts[left] + 8 * k
            out[left] = mix(out[left] ^ (eight[at] & _FIRST[np.minimum(ends[left] - at, 8)]))
            left = left[size[left] > 8 * (k + 1)]
        if len(left):
            blocks = -(-size[left] // 8) - _CHAIN
            first = np.cumsum(blocks) - blocks
            k = np.arange(blocks.sum()) - np.repeat(first, blocks) + _CHAIN
            at = np.repeat(starts[left], blocks) + 8 * k
            value = eight[at] & _FIRST[np.minimum(np.repeat(ends[left], blocks) - at, 8)]
            value = mix(value ^ mix(k.astype(np.uint64) * np.uint64(_STEP)))
            out[left] = mix(out[left] ^ np.add.reduceat(value, first))
        return out

    def text_of(self) -> np.ndarray:
        """The index of each word's text."""
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))

    def array(self, sizes: np.ndarray) -> pa.Array:
        """All words, one after the other, cut into pieces of these sizes."""
        edge = np.zeros(len(self.data) + 1, np.int8)
        edge[self.starts], edge[self.ends] = 1, -1
        inside = np.cumsum(edge[:-1], dtype=np.int8).view(bool)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(self.data[inside])])

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def run_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each run of values ``starts[i]`` to ``ends[i]`` (one at least): of its values alone, wherever it stands."""
    size = ends - starts
    if not len(size):
        return np.zeros(0, np.uint64)
    first = np.cumsum(size) - size
    place = np.arange(size.sum()) - np.repeat(first, size)
    value = mix(hashes[np.repeat(starts, size) + place] ^ mix(place.astype(np.uint64) * np.uint64(_STEP)))
    return mix(np.add.reduceat(value, first) ^ mix(size.astype(np.uint64)))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` values, at the place where it starts."""
    n = max(0, len(hashes) - size + 1)
    up, down = _powers(len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=total[1:])
    return mix((total[size : size + n] - total[:n]) * down[:n])


def window_starts(ptr: np.ndarray, size: int) -> np.ndarray:
    """Which places start a window that ends in the same text; as long as :func:`windows`."""
    n = max(0, int(ptr[-1]) - size + 1)
    text = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))[:n]
    return np.arange(size, n + size) <= ptr[text + 1]


def repeated(values: np.ndarray) -> np.ndarray:
    """Marks the values found twice or more."""
    s = np.sort(values)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return np.zeros(len(values), bool)
    twice = np.unique(twice)
    at = np.searchsorted(twice, values)
    at[at == len(twice)] = 0
    return twice[at] == values


def find(wanted: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of ``values`` that are among the sorted ``wanted``, and where there."""
    mask = np.zeros(1 << 16, bool)
    mask[wanted & np.uint64(0xFFFF)] = True
    at = np.flatnonzero(mask[values & np.uint64(0xFFFF)])
    some = values[at]
    place = np.minimum(np.searchsorted(wanted, some), len(wanted) - 1)
    hit = wanted[place] == some
    return at[hit], place[hit]


def covered(marked: np.ndarray, n: int, size: int) -> np.ndarray:
    """Marks the ``n`` places inside a marked window of ``size`` places."""
    edge = np.zeros(n + 1, np.int32)
    at = np.flatnonzero(marked)
    edge[at] += 1
    np.subtract.at(edge, at + size, 1)
    return np.cumsum(edge[:n]) > 0


def per_text(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between neighbouring bounds."""
    total = np.zeros(len(values) + 1, np.int64 if values.dtype.kind in "biu" else np.float64)
    np.cumsum(values, out=total[1:])
    return total[ptr[1:]] - total[ptr[:-1]]


def chunks(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows of batches whose column ``text`` comes as bytes, null as empty.

    Each piece holds whole rows of about ``limit`` bytes of text.
    """
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("text")).cast(pa.binary())
        ends = np.cumsum(pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        first = 0
        while first < len(ends):
            before = ends[first - 1] if first else 0
            to = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(first, to - first), [t or b"" for t in column.slice(first, to - first).to_pylist()]
            first = to
        del batch, column, ends
        give_back()
