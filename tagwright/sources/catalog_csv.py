"""Catalog files: read and write, with fixed schemas and no inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ID = T.StructField("sample_id", T.LongType())
_TEXT = T.StructField("catalog_content", T.StringType())
_LINK = T.StructField("image_link", T.StringType())
_PRICE = T.StructField("price", T.DoubleType())

LABELLED = T.StructType([_ID, _TEXT, _LINK, _PRICE])
UNLABELLED = T.StructType([_ID, _TEXT, _LINK])
ANSWERS = T.StructType([_ID, _PRICE])

# descriptions hold line breaks and doubled quotes; an empty cell is a null,
# quoted or not
_FORMAT = {"header": "true", "quote": '"', "escape": '"'}
_READ = {
    **_FORMAT, "multiLine": "true", "mode": "FAILFAST", "enforceSchema": "false",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}
_WRITE = {
    **_FORMAT, "quoteAll": "false", "emptyValue": '""',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and quoted, possibly multi-line cells.

    A multi-line file is not splittable, so keep a catalog in many files or
    convert it once with :func:`to_parquet`. The header must name the schema.
    """
    return spark.read.options(**_READ).schema(schema).csv(path)


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, LABELLED)


def read_unlabelled(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, UNLABELLED)


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, ANSWERS)


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files, one per partition, each with a header."""
    df.write.options(**_WRITE).csv(path)


def write_predictions(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """``sample_id, price`` as CSV, or as Parquet for large results."""
    out = df.select("sample_id", "price")
    if fmt == "csv":
        write_csv(out, path)
    else:
        out.write.format(fmt).save(path)


def to_parquet(spark: SparkSession, csv_path: str, out: str, schema: T.StructType) -> DataFrame:
    """Convert a catalog once; everything after reads splittable columns."""
    read_csv(spark, csv_path, schema).write.parquet(out)
    return spark.read.schema(schema).parquet(out)


def preview(df: DataFrame, n: int = 5, key: str = "sample_id") -> DataFrame:
    """The first ``n`` rows in key order; a top-n, not a sort of the table."""
    return df.orderBy(key).limit(n)


def column_table(df: DataFrame) -> DataFrame:
    """Position, name and type of every column, with the table's width."""
    rows = [
        (i, f.name, f.dataType.simpleString(), len(df.columns))
        for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position long, column string, type string, width long"
    )


def required_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """One row per required column: is it there? Reads the plan, not the data."""
    rows = [(name, int(name in df.columns)) for name in required]
    return df.sparkSession.createDataFrame(rows, "column string, present long")


def check_columns(df: DataFrame, required: list[str]) -> DataFrame:
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def check_not_empty(**frames: DataFrame) -> None:
    """Raise when any of the named tables has no row."""
    empty = [name for name, df in frames.items() if df.isEmpty()]
    if empty:
        raise ValueError(f"empty input: {', '.join(empty)}")


def row_counts(**frames: DataFrame) -> DataFrame:
    """One row per table: its name and number of rows."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in frames.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
