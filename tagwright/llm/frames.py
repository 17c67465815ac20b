"""Applies functions on batches of texts to DataFrames."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tagwright.llm.words import chunks


def crc_part(key: str | Column, parts: int) -> Column:
    """crc32 of the key as text modulo ``parts``; null for a null key."""
    c = F.col(key) if isinstance(key, str) else key
    return F.crc32(c.cast("string").cast("binary")) % parts


#: rows of an Arrow batch and of a Parquet reader's batch: texts are long, Spark's 10,000 and 4,096 of them fill
#: tens of megabytes; and bytes that a Parquet writer gathers in each task
BATCH_ROWS, READ_ROWS, WRITE_BYTES = 500, 256, 16 << 20


def small_batches(spark: SparkSession) -> None:
    """Set the session's batches, of rows sent to Python, read and written, to sizes fit for texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", READ_ROWS)
    spark.conf.set("parquet.block.size", WRITE_BYTES)


_HELD: dict[object, object] = {}


def held(key: object, make: Callable[[], object]):
    """One large helper per Python worker, kept from task to task while the same
    is asked for; work that holds none lets it go."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def forget_late(known: dict, most: int) -> None:
    """Cut a full memory to half. What was learned first stays: frequent words come early."""
    if len(known) > most:
        for _ in range(len(known) - most // 2):
            known.popitem()


def map_texts(
    docs: DataFrame, make: Callable[[], Callable[[list[bytes]], dict[str, object]]], out: str, key: str = "doc_id",
    text: str = "text", holds: bool = False,
) -> DataFrame:
    """``key`` and the columns ``out`` (DDL), found from each row's text.

    ``make`` runs once per task; what it returns takes a list of texts as
    UTF-8 (null: empty) and returns a list or array for each column.
    ``holds``: it uses :func:`held`.
    """
    schema = T.StructType([docs.schema[key], *T.StructType.fromDDL(out)])

    def run(batches):
        if not holds:
            _HELD.clear()
        arrow, fn = to_arrow_schema(schema), make()
        for batch, texts in chunks(batches):
            made = fn(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(arrow.field(0).type), *[pa.array(made[f.name], f.type) for f in list(arrow)[1:]]],
                schema=arrow,
            )

    return docs.select(F.col(key), F.col(text).alias("text")).mapInArrow(run, schema)


def filter_texts(
    docs: DataFrame, make: Callable[[], Callable[[list[bytes]], object]], text: str = "text"
) -> DataFrame:
    """The rows, all columns as they are, whose text the function marks true."""
    def run(batches):
        _HELD.clear()
        keep = make()
        for batch, texts in chunks(pa.RecordBatch.from_arrays(
            [*b.columns, b.column(at)], names=[*[f"c{i}" for i in range(b.num_columns)], "text"],
        ) for b in batches):
            mask = pa.array(keep(texts), pa.bool_())
            kept = batch.filter(mask)
            yield pa.RecordBatch.from_arrays(kept.columns[:-1], schema=arrow())

    def arrow():
        return to_arrow_schema(schema)

    at, schema = docs.columns.index(text), docs.schema
    return docs.mapInArrow(run, schema)
