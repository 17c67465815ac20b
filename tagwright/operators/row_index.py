"""Positions in a global order, found without sorting into one task.

The keys alone are range-partitioned and sorted, and each row's place inside
its partition is written down with them. One count per partition (as many
numbers as partitions) then gives every partition its offset. The written
table is what later stages read, so a re-run task cannot renumber anything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwright.workspace import materialize

_POS_BITS = 33  # monotonically_increasing_id keeps the place in its low 33 bits


def key_index(df: DataFrame, key: str, order: Sequence[Column] = (), name: str = "row_index") -> DataFrame:
    """``key`` and its 0-based position when sorted by ``order`` then ``key``.

    ``key`` is unique, so ties in ``order`` (one value may hold most rows)
    still spread over partitions.
    """
    spark = df.sparkSession
    keys = df.select(F.col(key), *[c.alias(f"_o{i}") for i, c in enumerate(order)])
    sort_by = [*[f"_o{i}" for i in range(len(order))], key]
    placed = materialize(
        keys.repartitionByRange(*sort_by)
        .sortWithinPartitions(*sort_by)
        .select(key, F.monotonically_increasing_id().alias("_place")),
        name,
    ).select(
        key,
        F.shiftrightunsigned("_place", _POS_BITS).alias("_part"),
        F.col("_place").bitwiseAND(F.lit((1 << _POS_BITS) - 1)).alias("_pos"),
    )
    counts = placed.groupBy("_part").count().orderBy("_part").collect()
    offsets, total = [], 0
    for row in counts:
        offsets.append((row["_part"], total))
        total += row["count"]
    table = spark.createDataFrame(offsets, "_part long, _offset long")
    return placed.join(F.broadcast(table), "_part").select(
        key, (F.col("_offset") + F.col("_pos")).alias(name)
    )


def with_row_index(
    df: DataFrame, key: str = "sample_id", order: Sequence[Column] = (), name: str = "row_index"
) -> DataFrame:
    """``df`` with its row's position, joined back on the key."""
    return df.join(key_index(df, key, order, name), key)


def chunk_counts(df: DataFrame, size: int = 1000, key: str = "sample_id") -> DataFrame:
    """Rows per chunk when the table is cut into runs of ``size`` in key order."""
    idx = key_index(df, key)
    chunk = F.floor(F.col("row_index") / F.lit(size)).cast("long")
    return idx.groupBy(chunk.alias("chunk")).agg(F.count(F.lit(1)).alias("rows"))


def map_chunks(df: DataFrame, fn, schema: str, key: str = "sample_id") -> DataFrame:
    """Run ``fn`` over pandas batches in key order.

    Batch size is ``spark.sql.execution.arrow.maxRecordsPerBatch``, so a task
    holds one batch, never its partition.
    """
    ordered = df.repartitionByRange(key).sortWithinPartitions(key)

    def run(batches):
        for batch in batches:
            yield fn(batch)

    return ordered.mapInPandas(run, schema)
