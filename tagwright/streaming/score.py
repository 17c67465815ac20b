"""Score catalog files as they arrive, with a plan fitted on a batch.

Features and member models are projections, so a fitted plan takes a streaming
table as it is; only source and sink differ from a batch run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tagwright.plans.training import FittedPlan
from tagwright.sources.catalog_csv import UNLABELLED


def catalog_stream(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """New Parquet catalog files in a folder, as a stream."""
    reader = spark.readStream.schema(UNLABELLED).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def score_stream(
    fitted: FittedPlan, stream: DataFrame, out: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Append ``sample_id, price`` to a Parquet folder; restarts from ``checkpoint``."""
    writer = (
        fitted.predict(stream).writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()
