"""Collects queries and their SQL; shared input tables and SQL fragments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwright.workspace import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without ``sql`` only its rows are checked."""
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is already there")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


# ------------------------------------------------------------ input tables
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CATALOG_SELECT = """
SELECT p_partkey AS sample_id,
  concat(p_name, ', ', p_type, ' ', p_brand, '. ',
    CASE p_size % 7 WHEN 0 THEN 'Organic snack' WHEN 1 THEN 'Gourmet chocolate' WHEN 2 THEN 'Beauty lotion'
      WHEN 3 THEN 'Dish soap' WHEN 4 THEN 'Vitamin supplement' WHEN 5 THEN 'Digital charger' ELSE 'Budget item' END,
    ' ', CAST(p_size AS STRING),
    CASE p_size % 4 WHEN 0 THEN ' oz' WHEN 1 THEN ' fl oz' WHEN 2 THEN ' count' ELSE ' lb' END,
    '. Pack of ', CAST(p_partkey % 13 AS STRING)) AS catalog_content,
  CASE WHEN p_partkey % 97 = 0 THEN NULL
    ELSE concat('http://img.example.com/', CAST(p_partkey % 500 AS STRING), '.jpg') END AS image_link,
  p_retailprice + p_size * 3 + CASE WHEN p_partkey % 50 = 0 THEN 5000 ELSE 0 END AS price
FROM {part}"""
_NULLED = """
SELECT sample_id, CASE WHEN sample_id % 31 = 0 THEN NULL ELSE catalog_content END AS catalog_content,
  image_link, price FROM {catalog}"""
_TEXTS = """
SELECT 'd' AS src, doc_id AS id, text FROM {documents}
UNION ALL SELECT 'c' AS src, sample_id AS id, catalog_content AS text FROM {catalog_null}"""
# stand-ins for models, so that blends and metrics can be checked in SQL
_PREDICTIONS = """
SELECT sample_id, 'ridge' AS model, (SELECT avg(price) FROM {priced}) AS prediction, price FROM {priced}
UNION ALL SELECT b.sample_id, 'rf', g.v, b.price FROM {priced} b
  JOIN (SELECT p_type, avg(price) AS v FROM {priced} GROUP BY p_type) g ON b.p_type = g.p_type
UNION ALL SELECT b.sample_id, 'et', g.v, b.price FROM {priced} b
  JOIN (SELECT p_brand, avg(price) AS v FROM {priced} GROUP BY p_brand) g ON b.p_brand = g.p_brand
UNION ALL SELECT b.sample_id, 'xgb',
  (SELECT regr_intercept(price, CAST(p_size AS DOUBLE)) FROM {priced})
  + (SELECT regr_slope(price, CAST(p_size AS DOUBLE)) FROM {priced}) * b.p_size, b.price FROM {priced} b"""
_PRICED = """
SELECT p_partkey AS sample_id, p_type, p_brand, p_size,
  p_retailprice + p_size * 3 + CASE WHEN p_partkey % 50 = 0 THEN 5000 ELSE 0 END AS price
FROM {part}"""
_IMAGE_FILES = "SELECT DISTINCT concat(CAST(vec_id % 400 AS STRING), '.jpg') AS file_name FROM {embeddings}"


def catalog(spark, sf_dir) -> DataFrame:
    return spark.sql(CATALOG_SELECT, part=spread(table(spark, sf_dir, "part")))


def catalog_null(spark, sf_dir) -> DataFrame:
    return spark.sql(_NULLED, catalog=catalog(spark, sf_dir))


def texts(spark, sf_dir) -> DataFrame:
    return spark.sql(
        _TEXTS, documents=table(spark, sf_dir, "documents"), catalog_null=catalog_null(spark, sf_dir)
    )


def priced(spark, sf_dir) -> DataFrame:
    return spark.sql(_PRICED, part=table(spark, sf_dir, "part"))


def predictions(spark, sf_dir) -> DataFrame:
    return spark.sql(_PREDICTIONS, priced=priced(spark, sf_dir))


def image_files(spark, sf_dir) -> DataFrame:
    return spark.sql(_IMAGE_FILES, embeddings=table(spark, sf_dir, "embeddings"))


def image_vectors(spark, sf_dir) -> DataFrame:
    """The vector with the smallest id per file name."""
    named = table(spark, sf_dir, "embeddings").withColumn(
        "file_name", F.concat((F.col("vec_id") % 400).cast("string"), F.lit(".jpg"))
    )
    first = named.groupBy("file_name").agg(F.min("vec_id").alias("vec_id"))
    return named.join(first, ["file_name", "vec_id"]).select("file_name", "embedding")


# ------------------------------------------------------------ SQL fragments
def _named(sql: str) -> str:
    for name in ("part", "catalog", "documents", "catalog_null", "priced", "embeddings"):
        sql = sql.replace("{" + name + "}", name)
    return sql


_CTES = {
    "catalog": _named(CATALOG_SELECT),
    "catalog_null": _named(_NULLED),
    "texts": _named(_TEXTS),
    "priced": _named(_PRICED),
    "predictions": _named(_PREDICTIONS),
    "image_files": _named(_IMAGE_FILES),
    "image_vectors": (
        "SELECT file_name, embedding FROM (SELECT concat(CAST(vec_id % 400 AS STRING), '.jpg') AS file_name, "
        "embedding, row_number() OVER (PARTITION BY vec_id % 400 ORDER BY vec_id) AS rn FROM embeddings) "
        "WHERE rn = 1"
    ),
}
_NEEDS = {
    "catalog_null": ["catalog"], "texts": ["catalog", "catalog_null"],
    "predictions": ["priced"],
}


def with_tables(*names: str, **more: str) -> str:
    """A WITH clause for the named fixtures, then for ``more``."""
    order: list[str] = []
    for name in names:
        for part in [*_NEEDS.get(name, []), name]:
            if part not in order:
                order.append(part)
    ctes = [f"{n} AS ({_CTES[n]})" for n in order] + [f"{n} AS ({s})" for n, s in more.items()]
    return "WITH " + ",\n".join(ctes) + "\n"


# ---------------------------------------------------------------- rounding
# from 1e9 on a double has too few decimals left: there, round in steps of 1e6
def r6(c: Column | str, digits: int = 6) -> Column:
    c = (F.col(c) if isinstance(c, str) else c).cast("double")
    large = F.round(c / 1e9, 3) * 1e9
    # adding 0.0 turns a rounded -0.0 into 0.0
    return F.when(F.abs(c) >= 1e9, large).otherwise(F.round(c, digits)) + F.lit(0.0)


def s6(expr: str, digits: int = 6) -> str:
    x = f"CAST({expr} AS DOUBLE)"
    return f"(CASE WHEN abs({x}) >= 1e9 THEN round({x} / 1e9, 3) * 1e9 ELSE round({x}, {digits}) END + 0.0)"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All floating columns rounded, order of columns kept."""
    return df.select(*[
        r6(f"`{f.name}`" if "." in f.name else f.name, digits).alias(f.name)
        if f.dataType.simpleString() in ("double", "float") else F.col(f.name)
        for f in df.schema.fields
    ])
