"""Keyed joins between catalog tables.

Left sides may be lopsided: a third of the rows can share one file name, or
have none. AQE may split such a partition, but a plan must not rest on it, so
rows of a key with more than its share are dealt over several salts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwright.functions.text import url_file_name

#: salts for each share of a hot key
_SALTS = 8


def with_answers(df: DataFrame, answers: DataFrame, key: str = "sample_id") -> DataFrame:
    return df.join(answers, key, "inner")


def join_blocks(left: DataFrame, *blocks: DataFrame, key: str = "sample_id") -> DataFrame:
    """Feature blocks side by side, matched on the key and never by position."""
    out = left
    for block in blocks:
        out = out.join(block, key, "inner")
    return out


def with_file_name(df: DataFrame, link: str = "image_link", name: str = "file_name") -> DataFrame:
    return df.withColumn(name, url_file_name(F.col(link)))


def missing_files(df: DataFrame, files: DataFrame, link: str = "image_link") -> DataFrame:
    """Rows whose link names a file that is not there (null links are skipped).

    The names are made distinct before they meet the listing, so a link used
    by a third of the rows reaches the join once per task.
    """
    named = with_file_name(df.where(F.col(link).isNotNull()), link)
    names = named.select("file_name").distinct().join(files, "file_name", "left_anti")
    return left_join_unique(
        named, names.withColumn("_gone", F.lit(1)), "file_name"
    ).where(F.col("_gone") == 1).drop("_gone")


def missing_file_count(df: DataFrame, files: DataFrame, link: str = "image_link") -> DataFrame:
    """Rows with a missing file and how many names are missing.

    Counts per name first, then anti-joins the counts: one row per name.
    """
    named = with_file_name(df.where(F.col(link).isNotNull()), link)
    per_name = named.groupBy("file_name").agg(F.count(F.lit(1)).alias("n"))
    return per_name.join(files, "file_name", "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("missing_rows"),
        F.count(F.lit(1)).alias("missing_names"),
    )


def left_join_unique(left: DataFrame, right: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """Left join to a table with one row per ``key``, whatever the left's skew.

    Null keys match nothing and never enter the shuffle. A key with more than
    one ``parts``-th of the rows (default: the session's shuffle partitions) is
    dealt over ``_SALTS`` salts for each share it holds (salts fall on partitions
    by hash, so many small ones fill them evenly), and its right row is copied to
    each. There are fewer such keys than ``parts``, so their table is small by
    arithmetic. Salts go by a row's place among its task's rows,
    ordered by a hash of all columns: rows that are equal get different salts,
    and a task that runs again gives the same ones.
    """
    parts = parts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    extra = [f for f in right.schema.fields if f.name != key]
    counts = left.where(F.col(key).isNotNull()).groupBy(key).count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    shares = [
        (r[key], -(-r["count"] * parts * _SALTS // total))
        for r in counts.where(F.col("count") * parts > total).collect()
    ]
    kind = left.schema[key].dataType.simpleString()
    salts = F.broadcast(left.sparkSession.createDataFrame(shares, f"`{key}` {kind}, _salts long"))
    no_key = left.where(F.col(key).isNull()).select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in extra]
    )
    hashed = [f.name for f in left.schema.fields if "map<" not in f.dataType.simpleString()]
    many = F.coalesce("_salts", F.lit(1))
    keyed = left.where(F.col(key).isNotNull())
    if not shares:
        return keyed.join(right, key, "left").select(*left.columns, *[f.name for f in extra]).unionByName(no_key)
    keyed = keyed.join(salts, key, "left")
    hot = keyed.where("_salts > 1").withColumn("_hash", F.xxhash64(*hashed)).sortWithinPartitions("_hash").drop("_hash")
    keyed = keyed.where("_salts IS NULL OR _salts = 1").withColumn("_salt", F.lit(0).cast("long")).unionByName(
        hot.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), many)))
    copied = right.join(salts, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), many - 1)))
    joined = keyed.drop("_salts").join(copied.drop("_salts"), [key, "_salt"], "left")
    return joined.select(*left.columns, *[f.name for f in extra]).unionByName(no_key)


def zero_vector(width: int) -> Column:
    return F.array_repeat(F.lit(0.0).cast("float"), width)


def attach_vectors(
    df: DataFrame, vectors: DataFrame, width: int, link: str = "image_link",
    vector: str = "embedding",
) -> DataFrame:
    """Each row with the vector of its image file; zeros where there is none."""
    joined = left_join_unique(
        with_file_name(df, link), vectors.select("file_name", vector), "file_name"
    )
    return joined.withColumn(vector, F.coalesce(F.col(vector), zero_vector(width)))


def known_terms(terms: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Keep the terms the vocabulary knows; Spark chooses how, by its size."""
    return terms.join(vocabulary, "term", "inner")
