"""Where intermediate tables go: the shared folder the cluster names; how rows are dealt over its tasks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """Folder from ``spark.checkpoint.dir``, made the checkpoint folder too.

    Without the setting it lies under the warehouse, which all executors share;
    a cluster whose warehouse is a local folder must name one.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not folder:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        local = sc.master == "local" or sc.master.startswith("local[")
        if not local and (warehouse.startswith(("file:", "/")) and not sc.getConf().contains("spark.sql.warehouse.dir")):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = f"{warehouse.rstrip('/')}/tagwright-scratch"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one intermediate table."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write the rows once as Parquet and read them back.

    Cuts the lineage: later stages, and stages re-run after a lost executor,
    read this table and see the very same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: tasks per core over which rows are dealt
_TASKS_A_CORE = 3


def spread(df: DataFrame, least: int = 20_000) -> DataFrame:
    """A table as it was read, its rows dealt evenly where its files leave most of them to a few tasks.

    A Parquet file is split at row groups, so a table in one file may be the work of one task, however many cores there
    are. Rows per task are counted from the files' footers. A task of at most ``least`` rows is left as it is. Dealt rows
    are written once: whatever passes follow, the few tasks read the table one time.
    """
    held = df.groupBy(F.spark_partition_id().alias("task")).count()
    most, rows = held.agg(F.max("count"), F.sum("count")).first()
    cores = df.sparkSession.sparkContext.defaultParallelism
    if not rows or most <= max(least, rows / cores):
        return df
    return materialize(df.repartition(min(_TASKS_A_CORE * cores, -(-rows // least) * cores)), "dealt")
