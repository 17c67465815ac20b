"""Terms, vocabulary and TF-IDF weights.

Fitting a capped vocabulary reads the texts twice: summaries of frequent items,
one per task, name candidates, then only these are counted. What is shuffled is
bounded by the summaries' size, not by the distinct n-grams. Where counts of all
terms are asked for, they are made inside the row (sort its terms, measure the
runs) and combined per task. The capped vocabulary is small by construction and
travels as a broadcast. Vectors for models are made row by row without any shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel, StopWordsRemover
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagwright.functions import text as tx
from tagwright.functions.charsets import WORD
from tagwright.functions.cleaning import KEPT, clean

TOKEN_PATTERN = f"[{WORD}]{{2,}}"
#: tokens of a cleaned text, found in the lower-cased one: what the cleaner blanks out is in none of them
_UNCLEANED = {"ascii": f"[{KEPT['ascii']}]{{2,}}", "word": TOKEN_PATTERN, "word_dash_dot": TOKEN_PATTERN}


def english_stop_words() -> list[str]:
    """The list that comes with Spark; pass another one to use it instead."""
    return StopWordsRemover.loadDefaultStopWords("english")


class NotFittedError(ValueError):
    """The vocabulary was asked for terms before it was fitted."""


@dataclass(frozen=True)
class TfidfSettings:
    max_features: int = 1500
    ngrams: tuple[int, int] = (1, 3)
    min_df: int = 3
    max_df: float | None = 0.95
    sublinear: bool = True
    cleaner: str = "ascii"
    #: None means the English list that comes with Spark
    stop_words: tuple[str, ...] | None = None

    @property
    def stop_list(self) -> list[str]:
        return english_stop_words() if self.stop_words is None else list(self.stop_words)


# ------------------------------------------------------------------- terms
def tokens(cleaned: Column, stop_words: Sequence[str] = (), pattern: str = TOKEN_PATTERN) -> Column:
    found = F.regexp_extract_all(cleaned, F.lit(pattern), F.lit(0))
    if not stop_words:
        return found
    return F.filter(found, lambda w: ~w.isin(list(stop_words)))


def cleaned_tokens(text: Column, settings: TfidfSettings) -> Column:
    """Tokens of the cleaned text.

    Only ``strict`` is cleaned first: the others blank out what parts tokens anyway, and replacing takes ten times
    as long as finding.
    """
    if settings.cleaner in _UNCLEANED:
        return tokens(F.lower(text), settings.stop_list, _UNCLEANED[settings.cleaner])
    return tokens(clean(text, settings.cleaner), settings.stop_list)


def ngrams(toks: Column, low: int, high: int) -> Column:
    """All runs of ``low`` to ``high`` tokens, joined by one blank."""
    grams = [toks]
    for n in range(2, high + 1):
        grams.append(_longer(grams[-1], toks, n))
    return _listed(grams[low - 1:])


def _longer(shorter: Column, toks: Column, n: int) -> Column:
    """Runs of n from runs of n - 1 and the tokens after them.

    Lambdas see single strings only, never the array: should a filter be pushed through
    the projection that makes ``toks``, its work is repeated, not multiplied.
    """
    left = F.greatest(F.size(toks) - (n - 1), F.lit(0))
    return F.zip_with(
        F.slice(shorter, F.lit(1), left), F.slice(toks, F.lit(n), left), lambda a, b: F.concat(a, F.lit(" "), b))


def _listed(grams: Sequence[Column]) -> Column:
    return F.concat(*grams) if len(grams) > 1 else grams[0]


def with_terms(
    df: DataFrame, settings: TfidfSettings, text: str, keep: Sequence[str], name: str = "terms"
) -> DataFrame:
    """``keep`` columns and the array of a text's terms, repeats included."""
    made = df.select(*keep, cleaned_tokens(tx.as_text(F.col(text)), settings).alias("_1"))
    low, high = settings.ngrams
    # runs of n are a column of their own: inside one expression, those of n - 1 would be made again for them
    for n in range(2, high + 1):
        made = made.select("*", _longer(F.col(f"_{n - 1}"), F.col("_1"), n).alias(f"_{n}"))
    return made.select(*keep, _listed([F.col(f"_{n}") for n in range(low, high + 1)]).alias(name))


def term_counts(terms: DataFrame, key: str, name: str = "terms") -> DataFrame:
    """``key, term, tf``: run lengths of the sorted terms, found inside the row."""
    # no filter on the arrays: it would be pushed below the projections that
    # make them and repeat their work inside the lambdas
    ordered = terms.select(key, F.sort_array(name).alias("_t"))
    starts = ordered.select(
        key, "_t",
        F.when(F.size("_t") > 0, F.filter(
            F.sequence(F.lit(0), F.size("_t") - 1),
            lambda i: (i == 0) | (F.get("_t", i) != F.get("_t", i - 1)),
        )).otherwise(F.array().cast("array<int>")).alias("_s"),
    )
    ends = F.concat(F.slice("_s", F.lit(2), F.size("_s")), F.array(F.size("_t")))
    # an empty text has no start but one end: cut back to the starts
    ends = F.slice(ends, F.lit(1), F.size("_s"))
    runs = F.zip_with(
        "_s", ends,
        lambda a, b: F.struct(F.get("_t", a).alias("term"), (b - a).cast("long").alias("tf")),
    )
    return starts.select(key, F.explode(runs).alias("r")).select(key, "r.term", "r.tf")


# -------------------------------------------------------------- vocabulary
def term_statistics(counts: DataFrame) -> DataFrame:
    """``term, df, total``; hot terms are combined before the shuffle."""
    return counts.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total")
    )


def limit_frequency(
    stats: DataFrame, rows: int, min_df: int = 1, max_df: float | None = None
) -> DataFrame:
    """Terms in at least ``min_df`` texts and at most a ``max_df`` share of them."""
    kept = stats.where(F.col("df") >= min_df)
    if max_df is not None:
        if max_df * rows < min_df:
            raise ValueError("max_df corresponds to fewer texts than min_df")
        kept = kept.where(F.col("df") <= max_df * rows)
    return kept


def top_terms(stats: DataFrame, max_features: int) -> DataFrame:
    """The most frequent terms; equal totals in alphabetical order."""
    return stats.orderBy(F.desc("total"), "term").limit(max_features)


def idf(df: Column, rows: int) -> Column:
    """``ln((1 + rows) / (1 + df)) + 1``."""
    return F.log((F.lit(1.0) + rows) / (F.lit(1.0) + df)) + 1.0


def term_weight(tf: Column, sublinear: bool) -> Column:
    return (F.log(tf.cast("double")) + 1.0) if sublinear else tf.cast("double")


@dataclass(frozen=True)
class Vocabulary:
    """Fitted terms in alphabetical order, with document frequencies and IDF."""

    settings: TfidfSettings
    terms: tuple[str, ...]
    df: tuple[int, ...]
    idf: tuple[float, ...]
    rows: int

    def __len__(self) -> int:
        return len(self.terms)

    def table(self, spark: SparkSession) -> DataFrame:
        rows = list(zip(self.terms, range(len(self)), self.df, self.idf))
        return spark.createDataFrame(rows, "term string, idx int, df long, idf double")


#: terms a summary keeps in each task; a second, larger try (Spark's limit)
TRACKED = (1 << 18, 1_000_000)
#: a summary of m terms may be off by this share of all occurrences, divided by m
_OFF = 3.5 * 0.75
#: tasks that merge summaries before the last one does
_MERGERS = 12


def heavy_terms(terms: DataFrame, tracked: int, name: str = "terms") -> tuple[list[tuple[str, int]], int, float]:
    """Frequent terms with counts they do not exceed, all occurrences, and how far such a count may be too high.

    Each task keeps a summary of frequent items, whose size does not grow with the distinct terms; summaries merge.
    A term that is not listed occurs at most twice as often as a count may be off.
    """
    # explode would put a filter on the array below the projections that make it
    found = terms.select(F.explode_outer(name).alias("t")).where("t IS NOT NULL")
    # a summary per task, merged by groups of tasks first: one task merges no more than the groups'
    parts = found.groupBy((F.spark_partition_id() % _MERGERS).alias("g")).agg(
        F.expr(f"approx_top_k_accumulate(t, {tracked})").alias("s"), F.count("t").alias("n"))
    # grouped, so that no term at all gives no row
    found = parts.groupBy(F.lit("all")).agg(F.expr(f"approx_top_k_combine(s, {tracked})").alias("s"), F.sum("n").alias("n"))
    found = found.select(F.expr(f"approx_top_k_estimate(s, {tracked})").alias("top"), "n")
    rows = found.select(F.col("top.item").alias("item"), F.col("top.count").alias("count"), "n").toArrow()
    if not rows.num_rows:
        return [], 0, 0.0
    off = _OFF * rows["n"][0].as_py() / tracked
    return list(zip(rows["item"][0].as_py() or [], rows["count"][0].as_py() or [])), rows["n"][0].as_py(), off


def recount(terms: DataFrame, candidates: Sequence[str], name: str = "terms") -> list[tuple[str, int, int]]:
    """``term, df, total`` of the candidates that occur, counted exactly; only pairs of numbers leave a task."""
    counted = CountVectorizerModel.from_vocabulary(list(candidates), name, "_counts").transform(terms.select(name))
    parts = counted.select(F.unwrap_udt("_counts").alias("c")).select(F.explode_outer(F.arrays_zip("c.indices", "c.values")).alias("e"))
    stats = parts.where("e IS NOT NULL").groupBy(F.col("e.indices").alias("idx")).agg(
        F.count(F.lit(1)).alias("df"), F.sum("e.values").cast("long").alias("total")).toArrow()
    return list(zip(
        [candidates[i] for i in stats["idx"].to_pylist()], stats["df"].to_pylist(), stats["total"].to_pylist()))


def _allowed(df: int, rows: int, settings: TfidfSettings) -> bool:
    return df >= settings.min_df and (settings.max_df is None or df <= settings.max_df * rows)


def frequent_terms(
    terms: DataFrame, rows: int, settings: TfidfSettings, tracked: Sequence[int] = TRACKED, name: str = "terms"
) -> list[tuple[str, int, int]] | None:
    """``term, df, total`` of the vocabulary's terms, or None where no summary of these sizes can prove them.

    Proven means: all occurrences are those of counted terms, or the last term that is taken occurs more often than
    any term that was not counted can.
    """
    for size in tracked:
        listed, occurrences, off = heavy_terms(terms, size, name)
        if not occurrences:
            return []
        if not listed:
            continue
        # first those that may be among twice as many as wanted, then all that are listed
        enough = sorted((n for _, n in listed), reverse=True)[: 2 * settings.max_features][-1] - off
        for least in (enough, 0):
            candidates = [t for t, n in listed if n >= least]
            stats = recount(terms, candidates, name)
            kept = sorted((s for s in stats if _allowed(s[1], rows, settings)), key=lambda s: (-s[2], s[0]))
            kept = kept[: settings.max_features]
            others = max([2 * off, *[n for _, n in listed if n < least]])
            if len(kept) == settings.max_features and kept[-1][2] > others or sum(s[2] for s in stats) == occurrences:
                return kept
            if len(candidates) == len(listed) or 2 * off >= (kept[-1][2] if kept else 0):
                break
    return None


def fit_vocabulary(
    df: DataFrame, settings: TfidfSettings, *, text: str = "catalog_content", key: str = "sample_id",
    tracked: Sequence[int] = TRACKED,
) -> Vocabulary:
    """Vocabulary of all rows; what reaches the driver is bounded by ``tracked`` and ``max_features``.

    Summaries name candidates, whose counts are then taken exactly, so what is shuffled does not grow with the
    distinct n-grams. Where no summary can prove its candidates, every term is counted.
    """
    rows = df.count()
    terms = with_terms(df, settings, text, [key])
    if settings.max_df is not None and settings.max_df * rows < settings.min_df:
        raise ValueError("max_df corresponds to fewer texts than min_df")
    top = frequent_terms(terms, rows, settings, tracked)
    if top is None:
        kept = limit_frequency(term_statistics(term_counts(terms, key)), rows, settings.min_df, settings.max_df)
        top = [(r["term"], r["df"], r["total"]) for r in top_terms(kept, settings.max_features).collect()]
    if not top:
        raise ValueError("no term is left; lower min_df or raise max_df")
    names, counts, _ = zip(*sorted(top))
    weights = df.sparkSession.createDataFrame([(c,) for c in sorted(set(counts))], "df long").select("df", idf(F.col("df"), rows).alias("idf"))
    idf_of = {r["df"]: r["idf"] for r in weights.collect()}
    return Vocabulary(settings, names, counts, tuple(idf_of[c] for c in counts), rows)


# ----------------------------------------------------------------- weights
def tfidf_weights(
    df: DataFrame, vocabulary: Vocabulary | None, *,
    text: str = "catalog_content", key: str = "sample_id",
) -> DataFrame:
    """``key, idx, weight`` in long form, each text scaled to length 1.

    One row becomes its own entries: there is no join and no shuffle.
    """
    counted = _counted(df, vocabulary, text, [key])
    entries = _entries(counted, vocabulary, [key])
    return entries.select(key, F.explode(F.arrays_zip("indices", "values")).alias("e")).select(
        key, F.col("e.indices").alias("idx"), F.col("e.values").alias("weight")
    )


def _counted(df: DataFrame, vocabulary: Vocabulary | None, text: str, keep: Sequence[str]) -> DataFrame:
    if vocabulary is None:
        raise NotFittedError("fit the vocabulary first")
    counter = CountVectorizerModel.from_vocabulary(list(vocabulary.terms), "_terms", "_counts")
    return counter.transform(with_terms(df, vocabulary.settings, text, keep, "_terms"))


def vocabulary_counts(
    df: DataFrame, vocabulary: Vocabulary | None, *, text: str = "catalog_content", key: str = "sample_id",
) -> DataFrame:
    """``key, idx, tf`` of the vocabulary's terms: one row becomes its own entries, other terms are never listed."""
    parts = _counted(df, vocabulary, text, [key]).select(key, F.unwrap_udt("_counts").alias("_c"))
    return parts.select(key, F.explode(F.arrays_zip("_c.indices", "_c.values")).alias("e")).select(
        key, F.col("e.indices").alias("idx"), F.col("e.values").cast("long").alias("tf"))


def _entries(counted: DataFrame, vocabulary: Vocabulary, keep: Sequence[str]) -> DataFrame:
    """``keep`` and a count vector's ``size``, ``indices`` and ``values``, weighted, of length 1."""
    # one constant, not an expression per term
    idfs = F.from_json(F.lit(json.dumps([float(x) for x in vocabulary.idf])), "array<double>")
    parts = counted.select(*keep, F.unwrap_udt("_counts").alias("_c")).select(*keep, "_c.size", "_c.indices", F.zip_with(
        "_c.values", "_c.indices", lambda n, i: term_weight(n, vocabulary.settings.sublinear) * F.get(idfs, i)
    ).alias("_w"))
    norm = F.sqrt(F.aggregate("_w", F.lit(0.0), lambda total, x: total + x * x))
    # a norm named inside the lambda would be added up again for every entry
    norms = F.array_repeat(norm, F.size("_w"))
    return parts.select(*keep, "size", "indices", F.zip_with("_w", norms, lambda x, n: x / n).alias("values"))


def tfidf_vectors(
    df: DataFrame, vocabulary: Vocabulary | None, *, text: str = "catalog_content",
    keep: Sequence[str] = ("sample_id",), name: str = "tfidf",
) -> DataFrame:
    """``keep`` columns and one sparse vector per row, without a shuffle.

    Counting is a Spark ML stage, weights and length 1 are expressions on the
    entries that are not zero; the vector is read back from its parts.
    """
    entries = _entries(_counted(df, vocabulary, text, keep), vocabulary, keep)
    parts = F.struct(F.lit(0).alias("type"), F.col("size"), F.col("indices"), F.col("values"))
    schema = T.StructType([T.StructField("v", VectorUDT())])
    read = F.from_json(F.to_json(F.struct(parts.alias("v"))), schema)["v"]
    return entries.select(*keep, read.alias(name))


def vector_cells(df: DataFrame, vector: str, keep: Sequence[str]) -> DataFrame:
    """``keep, idx, weight`` of a vector's entries that are not zero; a sparse vector is not filled up."""
    v = F.unwrap_udt(vector)
    places = F.when(v["type"] == 0, v["indices"]).otherwise(
        F.when(F.size(v["values"]) > 0, F.sequence(F.lit(0), F.size(v["values"]) - 1)))
    parts = df.select(*keep, places.alias("_i"), v["values"].alias("_v"))
    # explode would put a filter on the array below the projections that make it
    cells = parts.select(*keep, F.explode_outer(F.arrays_zip("_i", "_v")).alias("_e"))
    return cells.select(*keep, F.col("_e._i").alias("idx"), F.col("_e._v").alias("weight")).where("weight != 0")
