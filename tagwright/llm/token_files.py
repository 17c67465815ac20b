"""Token ids in binary files of patched frame-of-reference blocks, in the order of the documents' keys.

A file holds the ids of a run of documents, cut into blocks of 1,024. A block
stores its smallest id, and every id's distance from it packed at a width that
some percentile of the block fits into: the percentile that makes the block
smallest. Distances beyond that width are exceptions, listed with their places.
An index of the blocks' starts lets a reader go to any id without the ones
before. Layout, little-endian:

    "TWPFOR01"
    blocks:     smallest u32 | ids u16 | exceptions u16 | width u8, then packed
                distances, places of exceptions u16, their distances u32
    documents:  Arrow stream of the column ``key`` and ``n_tokens``
    index:      place of each block in the file u64
    footer:     ids u64 | blocks u64 | place of documents u64 | place of index u64 | "TWPFOR01"

Documents are range-partitioned and sorted by key, nulls first; rows of equal
keys follow a hash of their text and then their place in the input, so that a
key of a third of all rows is spread too. Each task encodes its range as it
streams by and writes files of bounded size, under a name no other attempt has.
A table of the files, written by Spark, names those of the attempts that
counted; it is all that readers look at, so a lost executor leaves unread files
at most. The folder must be one that pyarrow opens (file, hdfs, s3, gs).

Null and empty texts have the end id alone. Repeated rows are written each by
itself, other columns are ignored. An empty table gives no files and no rows.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tagwright.llm.byte_words import ByteWords
from tagwright.llm.frames import held
from tagwright.llm.words import give_back

MAGIC = b"TWPFOR01"
_HEAD, _FOOT = struct.Struct("<IHHB"), struct.Struct("<QQQQ8s")
BLOCK = 1024
#: blocks packed or unpacked at once
_SPAN = 256
#: shares of a block that may be packed without exceptions; the one that makes it smallest is taken
PERCENTILES = (50, 75, 85, 90, 95, 98, 100)
#: bytes of an exception: its place and its distance
_PATCH = 6
#: bytes of text encoded at once, and ids after which a task starts its next file
_TEXT_BYTES, FILE_IDS = 6_000_000, 1 << 26


# ------------------------------------------------------------ blocks
_BITS = np.zeros(1 << 16, np.uint8)
for _w in range(16):
    _BITS[1 << _w : 2 << _w] = _w + 1


def _bits(values: np.ndarray) -> np.ndarray:
    """The bits that each 32-bit value needs."""
    if not len(values) or values.max() < 1 << 16:
        return _BITS[values]
    high = values >> np.uint32(16)
    return np.where(high > 0, _BITS[high] + np.uint8(16), _BITS[values & np.uint32(0xFFFF)])


def _widths(far: np.ndarray) -> np.ndarray:
    """The width of each row of distances: of the percentile that gives the fewest bytes."""
    rows, n = far.shape
    of = _bits(far.reshape(-1)).astype(np.int64) + np.repeat(np.arange(rows) * 33, n)
    within = np.cumsum(np.bincount(of, minlength=rows * 33).reshape(rows, 33), axis=1)
    choice = np.stack([(within < -(-n * p // 100)).sum(axis=1) for p in PERCENTILES], axis=1)
    cost = choice * n // 8 + _PATCH * (n - np.take_along_axis(within, choice, axis=1))
    return choice[np.arange(rows), cost.argmin(axis=1)]


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of values below ``2**width`` as rows of bytes: bit ``i * width`` starts value ``i``.

    64 values fill ``width`` words; place by place for all rows at once.
    """
    of = np.ascontiguousarray(values.reshape(-1, 64).T.astype(np.uint64))
    words = np.zeros((width, of.shape[1]), np.uint64)
    for j in range(64 if width else 0):
        at, shift = divmod(j * width, 64)
        words[at] |= of[j] << np.uint64(shift)
        if shift + width > 64:
            words[at + 1] |= of[j] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).astype("<u8").view(np.uint8).reshape(len(values), -1)


def _unpack(packed: np.ndarray, width: int, n: int) -> np.ndarray:
    words = np.ascontiguousarray(np.ascontiguousarray(packed).view("<u8").reshape(-1, width).T) if width else None
    out = np.zeros((64, len(packed) * n // 64), "<u4")
    for j in range(64 if width else 0):
        at, shift = divmod(j * width, 64)
        value = words[at] >> np.uint64(shift)
        if shift + width > 64:
            value |= words[at + 1] << np.uint64(64 - shift)
        out[j] = value & np.uint64((1 << width) - 1)
    return np.ascontiguousarray(out.T).reshape(len(packed), n)


def pack_blocks(ids: np.ndarray) -> list[bytes]:
    """Blocks of 1,024 ids each, the last one may be shorter."""
    count = -(-len(ids) // BLOCK)
    if not count:
        return []
    tail = len(ids) - (count - 1) * BLOCK
    # a short last block is filled up with its last id
    rows = np.pad(ids, (0, count * BLOCK - len(ids)), mode="edge").reshape(count, BLOCK)
    least = rows.min(axis=1)
    far = rows - least[:, None]
    width = _widths(far)
    out: list[bytes] = [b""] * count
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        mine = far[at]
        most = np.uint32((1 << w) - 1)
        over = mine > most
        packed = _pack(mine & most, w)
        for k, i in enumerate(at.tolist()):
            n = tail if i == count - 1 else BLOCK
            place = np.flatnonzero(over[k, :n])
            out[i] = b"".join([
                _HEAD.pack(int(least[i]), n, len(place), w), packed[k, : -(-n * w // 8)].tobytes(),
                place.astype("<u2").tobytes(), mine[k, place].astype("<u4").tobytes(),
            ])
    return out


def unpack_blocks(data: bytes, starts: list[int]) -> np.ndarray:
    """The ids of the blocks at ``starts`` in ``data``, one after the other."""
    heads = [_HEAD.unpack_from(data, at) for at in starts]
    out = np.zeros((len(heads), BLOCK), "<u4")
    counts, widths = np.array([h[1] for h in heads], np.int64), np.array([h[3] for h in heads])
    view = np.frombuffer(data, np.uint8)
    for w in np.unique(widths).tolist():
        at = np.flatnonzero(widths == w)
        packed = np.zeros((len(at), BLOCK * w // 8), np.uint8)
        for k, i in enumerate(at.tolist()):
            size = -(-int(counts[i]) * w // 8)
            packed[k, :size] = view[starts[i] + _HEAD.size : starts[i] + _HEAD.size + size]
        out[at] = _unpack(packed, w, BLOCK)
    for i, (least, n, patches, w) in enumerate(heads):
        if patches:
            at = starts[i] + _HEAD.size - (-n * w // 8)
            out[i, np.frombuffer(data, "<u2", patches, at)] = np.frombuffer(data, "<u4", patches, at + 2 * patches)
    out += np.array([h[0] for h in heads], "<u4")[:, None]
    return out.reshape(-1) if (counts == BLOCK).all() else out[np.arange(BLOCK) < counts[:, None]]


# ------------------------------------------------------------ files
class Writer:
    """Writes one file, front to back."""

    def __init__(self, stream):
        self.stream, self.place, self.n_ids, self.n_docs = stream, 0, 0, 0
        self.waiting: list[np.ndarray] = []
        self.held, self.index, self.documents = 0, [], []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.place += len(data)

    def add(self, keys: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Documents and their ids, in order."""
        self.documents.append(pa.record_batch([keys, pa.array(sizes, pa.int64())], names=["key", "n_tokens"]))
        self.n_docs, self.n_ids = self.n_docs + len(keys), self.n_ids + len(ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= _SPAN * BLOCK:
            ready = np.concatenate(self.waiting)
            whole = len(ready) // BLOCK * BLOCK
            self._blocks(ready[:whole])
            self.waiting, self.held = [ready[whole:]], len(ready) - whole

    def _blocks(self, ids: np.ndarray) -> None:
        for at in range(0, len(ids), _SPAN * BLOCK):
            blocks = pack_blocks(ids[at : at + _SPAN * BLOCK])
            self.index.append(self.place + np.cumsum([0, *map(len, blocks)], dtype=np.uint64)[:-1])
            self._put(b"".join(blocks))

    def close(self) -> None:
        if self.waiting:
            self._blocks(np.concatenate(self.waiting))
        index = np.concatenate(self.index) if self.index else np.zeros(0, np.uint64)
        documents = self.place
        data = io.BytesIO()
        with pa.ipc.new_stream(data, self.documents[0].schema) as out:
            for batch in self.documents:
                out.write_batch(batch)
        self._put(data.getvalue())
        starts = self.place
        self._put(index.astype("<u8").tobytes())
        self._put(_FOOT.pack(self.n_ids, len(index), documents, starts, MAGIC))
        self.stream.close()


class Reader:
    """Reads one file, from any place."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        self.n_ids, blocks, self.documents_at, index_at, magic = _FOOT.unpack(self._get(size - _FOOT.size, _FOOT.size))
        if magic != MAGIC:
            raise ValueError("not a file of token blocks, or one that was not written to its end")
        starts = np.frombuffer(self._get(index_at, 8 * blocks), "<u8").astype(np.int64)
        self.bounds = np.append(starts, self.documents_at)
        self.index_at = index_at

    def _get(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def documents(self) -> pa.Table:
        return pa.ipc.open_stream(self._get(self.documents_at, self.index_at - self.documents_at)).read_all()

    def spans(self, first: int = 0, last: int | None = None) -> Iterator[np.ndarray]:
        """The ids of blocks ``first`` to ``last``, some blocks at a time."""
        last = len(self.bounds) - 1 if last is None else last
        for at in range(first, last, _SPAN):
            some = self.bounds[at : min(last, at + _SPAN) + 1]
            yield unpack_blocks(self._get(int(some[0]), int(some[-1] - some[0])), (some[:-1] - some[0]).tolist())

    def ids(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from the place ``start`` on; reads only the blocks that hold them."""
        first, last = start // BLOCK, min(-(-(start + count) // BLOCK), len(self.bounds) - 1)
        found = [*self.spans(first, last)]
        return np.concatenate(found)[start - first * BLOCK :][:count] if found else np.zeros(0, "<u4")


def open_file(folder: str, name: str) -> Reader:
    store, path = pa.fs.FileSystem.from_uri(folder)
    return Reader(store.open_input_file(f"{path}/{name}"))


# ------------------------------------------------------------ Spark
_FILES = "part int, seq int, file string, n_docs long, n_ids long"
_FILES_ARROW = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches joined, or cut, to about ``_TEXT_BYTES`` of text."""
    waiting, size = [], 0
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = min(batch.num_rows, int(np.searchsorted(ends, before + _TEXT_BYTES - size, side="right")) + 1)
            waiting.append(batch.slice(at, to - at))
            size += int(ends[to - 1]) - before
            at = to
            if size >= _TEXT_BYTES:
                yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                waiting, size = [], 0
                give_back()
    if waiting:
        yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]


def write_ids(
    docs: DataFrame, path: str, folder: str, end_id: int = 2, key: str = "doc_id", text: str = "text",
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Encode all texts with the tokenizer file ``path`` and write them to ``folder``; the table of its files."""
    def write(batches):
        words = held(("byte words", path), lambda: ByteWords(path))
        part, seq, out, name = TaskContext.get().partitionId(), 0, None, ""
        store, at = pyarrow.fs.FileSystem.from_uri(folder)

        def done():
            out.close()
            return pa.RecordBatch.from_pylist(
                [{"part": part, "seq": seq, "file": name, "n_docs": out.n_docs, "n_ids": out.n_ids}],
                schema=_FILES_ARROW,
            )

        for batch in _gathered(batches):
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            ids, bounds = words.encode(texts)
            ids = np.insert(ids, bounds[1:], np.uint32(end_id))
            sizes = np.diff(bounds) + 1
            ends, first = np.concatenate([[0], np.cumsum(sizes)]), 0
            while first < len(sizes):
                if out is None:
                    store.create_dir(at, recursive=True)
                    name = f"ids-{part:05d}-{seq:03d}-{uuid.uuid4().hex}.pfor"
                    out = Writer(store.open_output_stream(f"{at}/{name}"))
                # whole documents, up to the one that fills the file
                to = min(len(sizes), int(np.searchsorted(ends[1:], ends[first] + file_ids - out.n_ids)) + 1)
                out.add(batch.column(0).slice(first, to - first), sizes[first:to], ids[ends[first] : ends[to]])
                first = to
                if out.n_ids >= file_ids:
                    yield done()
                    seq, out = seq + 1, None
        if out is not None:
            yield done()

    order = [F.col("key").asc_nulls_first(), F.col("hash"), F.col("place")]
    rows = docs.select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("hash"),
        F.monotonically_increasing_id().alias("place"),
    )
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")
    ordered.mapInArrow(write, _FILES).write.parquet(f"{folder}/files")
    return files(docs.sparkSession, folder)


def files(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a folder, one row each, with the number of ids before them."""
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    listed = spark.read.schema(_FILES).parquet(f"{folder}/files")
    return listed.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _read(table: DataFrame, folder: str, kind: T.DataType, key: str, out: str, column: Callable[[Iterator, np.ndarray], Iterator]):
    """``key``, ``start``, ``n_tokens`` and a column made from each document's ids."""
    schema = T.StructType([T.StructField(key, kind), *T.StructType.fromDDL(f"start long, n_tokens long, {out}")])

    def read(batches):
        arrow = to_arrow_schema(schema)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader = open_file(folder, name)
                documents = reader.documents().combine_chunks()
                sizes = documents["n_tokens"].to_numpy()
                begins = start + np.cumsum(sizes) - sizes
                at = 0
                for values in column(reader.spans(), sizes):
                    to = at + len(values)
                    yield pa.RecordBatch.from_arrays([
                        documents["key"].slice(at, to - at).combine_chunks().cast(arrow.field(0).type),
                        pa.array(begins[at:to], pa.int64()), pa.array(sizes[at:to], pa.int64()),
                        pa.array(values, arrow.field(3).type),
                    ], schema=arrow)
                    at = to
                give_back()

    n = table.count()
    return table.select("file", "start").repartition(max(1, min(n, 10_000))).mapInArrow(read, schema)


def _per_document(spans: Iterator[np.ndarray], sizes: np.ndarray, begin, add) -> Iterator[list]:
    """What ``add`` makes of each document's ids, documents of each span together."""
    ends, i, place, state, out = np.cumsum(sizes), 0, 0, begin(), []
    for span in spans:
        at = 0
        while i < len(ends) and at < len(span):
            take = min(len(span) - at, int(ends[i]) - place)
            state = add(state, span[at : at + take])
            at, place = at + take, place + take
            if place == ends[i]:
                out.append(state)
                state, i = begin(), i + 1
        if out:
            yield out
            out = []


def read_checksums(table: DataFrame, folder: str, kind: T.DataType, key: str = "doc_id") -> DataFrame:
    """``key, start, n_tokens, ids_crc32`` of every document in the files of ``table``."""
    return _read(table, folder, kind, key, "ids_crc32 long", lambda spans, sizes: _per_document(
        spans, sizes, lambda: 0, lambda crc, ids: zlib.crc32(ids.tobytes(), crc)))


def read_ids(table: DataFrame, folder: str, kind: T.DataType, key: str = "doc_id") -> DataFrame:
    """``key, start, n_tokens, ids`` of every document in the files of ``table``."""
    def column(spans, sizes):
        for found in _per_document(spans, sizes, list, lambda parts, ids: [*parts, ids]):
            yield [np.concatenate(parts).astype(np.int32) for parts in found]

    return _read(table, folder, kind, key, "ids array<int>", column)
