"""Documents dealt into blocks of bounded size, and lookups by value from block to block.

Some questions about a document depend on all others: in how many documents is
this value found? Instead of one row per value, each block sends its distinct
values, sorted and packed, one row per block and value range; the answers come
back packed in the same order. The order is that of the values, so it does not
depend on how rows arrive, and a value that a third of all documents hold is
sent once per block, not once per document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: bytes of text in a block, and in a range of values
BLOCK_BYTES, RANGE_BYTES = 1_500_000, 16_000_000
MIN_RANGES = 256


@dataclass(frozen=True)
class Layout:
    n_blocks: int
    n_ranges: int


def layout(docs: DataFrame, text: str = "text") -> Layout:
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return Layout(max(1, -(-size // BLOCK_BYTES)), max(MIN_RANGES, -(-size // RANGE_BYTES)))


def deal(docs: DataFrame, n_blocks: int, key: str = "doc_id", text: str = "text", name: str = "block") -> DataFrame:
    """The rows with the number of their block, by a hash of key and text."""
    return docs.withColumn(name, F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(n_blocks)).cast("int"))


def by_range(values: np.ndarray, n_ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of sorted values by range, and the bounds of the ranges in it."""
    of = (values % np.uint64(n_ranges)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    return order, np.searchsorted(of[order], np.arange(n_ranges + 1))
