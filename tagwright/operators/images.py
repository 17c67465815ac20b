"""Images: which to fetch, fetching, guards and embedding.

Fetching and embedding are the user's functions; the work here is to spread
links and files over tasks, to batch them, and to keep a failure to its row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwright.functions.text import url_file_name
from tagwright.operators.joins import attach_vectors, with_file_name
from tagwright.workspace import materialize

WIDTH = 2048
MAX_BYTES = 10 * 1024 * 1024
MIN_SIDE = 32
EXTENSIONS = ("jpg", "jpeg", "png")


def list_images(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """``path, file_name, length, content``; the bytes are read only if used."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return files.select("path", url_file_name(F.col("path")).alias("file_name"), "length", "content")


def count_by_extension(files: DataFrame, name: str = "file_name") -> DataFrame:
    """Files per image extension, case ignored."""
    ext = F.regexp_extract(F.lower(name), r"\.([a-z0-9]+)$", 1)
    return (
        files.select(ext.alias("extension")).where(F.col("extension").isin(*EXTENSIONS))
        .groupBy("extension").agg(F.count(F.lit(1)).alias("files"))
    )


def fetch_plan(
    df: DataFrame, present: DataFrame | None = None, link: str = "image_link",
    tasks: int | None = None,
) -> DataFrame:
    """``file_name, image_link, links``: what is still to be fetched.

    Links that share a file name are one file: the smallest link stands for
    it and ``links`` says how many different ones there were.
    """
    links = df.where(F.col(link).isNotNull()).select(F.col(link).alias("image_link")).distinct()
    names = links.withColumn("file_name", url_file_name(F.col("image_link"), strip_slash=True))
    plan = names.groupBy("file_name").agg(
        F.min("image_link").alias("image_link"), F.count(F.lit(1)).alias("links")
    )
    if present is not None:
        plan = plan.join(present.select("file_name"), "file_name", "left_anti")
    return plan.repartition(tasks, "file_name") if tasks else plan


def fetch(plan: DataFrame, get: Callable[[str], bytes]) -> DataFrame:
    """Run the plan: ``image_link, file_name, content, error``, one row per file.

    Write the result before using it, so that nothing is fetched twice.
    """
    def one(url: str) -> tuple[bytes | None, str | None]:
        try:
            return get(url), None
        except Exception as exc:  # a dead link is a row, not a failed job
            return None, f"{type(exc).__name__}: {exc}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = [one(url) for url in batch["image_link"]]
            yield pd.DataFrame({
                "image_link": batch["image_link"], "file_name": batch["file_name"],
                "content": [c for c, _ in got], "error": [e for _, e in got],
            })

    return plan.select("image_link", "file_name").mapInPandas(
        run, "image_link string, file_name string, content binary, error string"
    )


def map_batches(
    df: DataFrame, column: str, infer: Callable[[Sequence], Sequence], schema: str, output: str,
    keep: Sequence[str], batch_size: int = 32,
    load: Callable[[], Callable[[Sequence], Sequence]] | None = None,
) -> DataFrame:
    """``keep`` columns and ``infer``'s result for every row.

    ``infer`` sees at most ``batch_size`` values; ``load`` makes it, once per
    task, when a model has to be opened first.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = load() if load else infer
        for batch in batches:
            for at in range(0, len(batch), batch_size):
                part = batch.iloc[at:at + batch_size]
                out = part[list(keep)].copy()
                out[output] = list(call(part[column].tolist()))
                yield out

    return df.select(*keep, column).mapInPandas(run, schema)


def read_file(path: str) -> bytes | None:
    """The bytes of a listed file, read where the row is; None if it is gone or may not be read."""
    if path.startswith("file:") or "://" not in path:
        store, place = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    else:
        store, place = fs.FileSystem.from_uri(quote(path, safe=":/@"))
    try:
        with store.open_input_stream(place) as stream:
            return stream.read()
    except (FileNotFoundError, PermissionError):
        return None


def embed_images(
    files: DataFrame, embed: Callable[[list[bytes]], Sequence[Sequence[float]]],
    width: int = WIDTH, batch_size: int = 32, max_bytes: int = MAX_BYTES, min_side: int = MIN_SIDE,
    size_of: Callable[[bytes], tuple[int, int] | None] | None = None,
) -> DataFrame:
    """``file_name, embedding, status``; zeros for files that are no usable image.

    ``embed`` decodes and embeds, so it decides which formats there are.
    ``size_of``, if given, tells width and height: images with a side below
    ``min_side`` are ``small``, files it raises for or knows no size of
    ``unreadable``. Too large files are set aside by their length before their
    bytes are read. A batch that fails is done again file by file: only the
    files that fail alone, or give a vector of another width, are ``failed``.
    Files without a column ``content`` are read from their ``path``, a batch at a time.
    """
    column, read = ("content", bytes) if "content" in files.columns else ("path", read_file)
    zeros = [0.0] * width

    def guard(content: bytes | None) -> str:
        if not content:
            return "unreadable"
        if size_of is None:
            return "ok"
        try:
            size = size_of(content)
        except Exception:  # not an image: a row, not a failed job
            size = None
        return "unreadable" if size is None else "small" if min(size) < min_side else "ok"

    def vectors(contents: list[bytes]) -> list[list[float]]:
        found = [[float(x) for x in v] for v in embed(contents)]
        if len(found) != len(contents) or any(len(v) != width for v in found):
            raise ValueError(f"expected {len(contents)} vectors of {width} values")
        return found

    def alone(content: bytes) -> list[float] | None:
        try:
            return vectors([content])[0]
        except Exception:
            return None

    def run_batch(contents: list[bytes | None]) -> list[tuple[list[float], str]]:
        status = [guard(c) for c in contents]
        good = [c for c, s in zip(contents, status) if s == "ok"]
        try:
            found = iter(vectors(good) if good else [])
        except Exception:
            found = iter([alone(c) for c in good])
        out = []
        for s in status:
            v = next(found) if s == "ok" else None
            out.append((v, s) if v is not None else (zeros, "failed" if s == "ok" else s))
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), batch_size):
                part = batch.iloc[at:at + batch_size]
                done = run_batch([None if c is None else read(c) for c in part[column]])
                yield pd.DataFrame({
                    "file_name": part["file_name"].to_numpy(),
                    "embedding": [v for v, _ in done], "status": [s for _, s in done],
                })

    # plain comparisons reach the scan; a file of unknown length is read
    length = F.col("length")
    fits = files.where(length <= max_bytes).unionByName(files.where(length.isNull()))
    done = fits.select("file_name", column).mapInPandas(
        run, "file_name string, embedding array<float>, status string"
    )
    oversized = files.where(length > max_bytes).select(
        "file_name", F.array_repeat(F.lit(0.0).cast("float"), width).alias("embedding"),
        F.lit("large").alias("status"),
    )
    return done.unionByName(oversized)


def attach_images(
    df: DataFrame, files: DataFrame, embed: Callable[[list[bytes]], Sequence[Sequence[float]]],
    width: int = WIDTH, link: str = "image_link", **settings,
) -> DataFrame:
    """From links and image files to rows with a vector: embed, write, attach.

    Only files that a link names are embedded, each once (of several paths with one name the smallest); rows without
    a usable image get zeros. Where ``files`` has a ``path``, files are chosen on the listing alone and read where they
    are embedded, so no bytes are shuffled. Train on the result with ``image=("embedding", width)``.
    """
    names = with_file_name(df.select(link), link).select("file_name").distinct()
    if "path" in files.columns:
        listed = files.select("file_name", "path", "length").join(names, "file_name", "left_semi")
        chosen = materialize(
            listed.groupBy("file_name").agg(F.min(F.struct("path", "length")).alias("f")).select("file_name", "f.path", "f.length"),
            "paths",
        )
        tasks = max(1, min(chosen.count(), 4 * df.sparkSession.sparkContext.defaultParallelism))
        wanted = chosen.repartition(tasks)
    else:
        wanted = files.join(names, "file_name", "left_semi").dropDuplicates(["file_name"])
    vectors = materialize(embed_images(wanted, embed, width, **settings), "vectors")
    return attach_vectors(df, vectors, width, link)
