"""Text -> number features as column expressions.

Every function takes a text column (lower-cased already where that matters)
or an array column made by :func:`words` / :func:`numbers`, and returns a
column. Nothing here leaves the JVM. Callers put the arrays into an inner
projection so that a text is split and scanned once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagwright.functions import wordlists as wl
from tagwright.functions.charsets import SPACE, UPPER, WORD, decimal_digits, digit_class


def as_text(text: Column, null_text: str = "nan") -> Column:
    """Null becomes the text ``nan`` (or ``""`` when ``null_text=""``)."""
    return F.coalesce(text.cast("string"), F.lit(null_text))


# ------------------------------------------------------------------ counts
def text_length(t: Column) -> Column:
    return F.length(t).cast("long")


def _count_of(t: Column, char_class: str) -> Column:
    return F.length(F.regexp_replace(t, f"[^{char_class}]+", "")).cast("long")


def letter_count(t: Column) -> Column:
    return _count_of(t, r"\p{L}")


def digit_count(t: Column) -> Column:
    # most of a text goes by a cheap class before the long one sees the rest
    rest = F.regexp_replace(t, r"[\x00-/:-\x7f\p{L}]+", "")
    return _count_of(rest, digit_class())


def upper_count(raw: Column) -> Column:
    """Capitals of the text as given, before lower-casing."""
    return _count_of(raw, UPPER)


# ------------------------------------------------------------------- words
def words(t: Column) -> Column:
    """White-space words; no empty strings at the ends."""
    return F.array_remove(F.split(t, f"[{SPACE}]+"), "")


def word_count(w: Column) -> Column:
    return F.size(w).cast("long")


def avg_word_length(w: Column) -> Column:
    """Characters in words, per word; 0 without words."""
    letters = F.length(F.array_join(w, "")).cast("double")
    return F.coalesce(F.try_divide(letters, F.size(w)), F.lit(0.0))


def unique_word_ratio(w: Column) -> Column:
    distinct = F.size(F.array_distinct(w)).cast("double")
    return F.coalesce(F.try_divide(distinct, F.size(w)), F.lit(0.0))


def sentence_count(t: Column) -> Column:
    """Pieces between full stops that hold more than white space."""
    solid = f"[^{SPACE}]"
    return F.size(F.filter(F.split(t, r"\."), lambda s: s.rlike(solid))).cast("long")


# ----------------------------------------------------------------- numbers
def numbers(t: Column, keep_zero: bool = False) -> Column:
    """Unsigned numbers in reading order; ``1,000`` gives 1 and 0."""
    foreign, ascii_form = decimal_digits()
    plain = F.when(
        t.rlike(r"[\p{Nd}&&[^0-9]]"), F.translate(t, foreign, ascii_form)
    ).otherwise(t)
    found = F.regexp_extract_all(plain, F.lit(r"[0-9]+\.?[0-9]*"), F.lit(0)).cast("array<double>")
    return found if keep_zero else F.filter(found, lambda x: x > 0)


def max_number(n: Column) -> Column:
    return F.coalesce(F.array_max(n), F.lit(0.0))


def min_number(n: Column) -> Column:
    return F.coalesce(F.array_min(n), F.lit(0.0))


def number_count(n: Column) -> Column:
    return F.size(n).cast("long")


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)


def avg_number(n: Column) -> Column:
    return F.coalesce(F.try_divide(_total(n), F.size(n)), F.lit(0.0))


def std_number(n: Column) -> Column:
    """Population deviation, two passes over the array; 0 below two numbers."""
    mean = F.try_divide(_total(n), F.size(n))
    squares = F.aggregate(
        n,
        F.struct(F.lit(0.0).alias("s"), mean.alias("m")),
        lambda acc, x: F.struct(
            (acc["s"] + (x - acc["m"]) * (x - acc["m"])).alias("s"), acc["m"].alias("m")
        ),
        lambda acc: acc["s"],
    )
    return F.when(F.size(n) > 1, F.sqrt(F.try_divide(squares, F.size(n)))).otherwise(F.lit(0.0))


def number_range(n: Column) -> Column:
    return F.when(F.size(n) > 1, F.array_max(n) - F.array_min(n)).otherwise(F.lit(0.0))


# ------------------------------------------------------------------- flags
def contains_any(t: Column, terms: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [t.contains(w) for w in terms])


def flag_any(t: Column, terms: list[str]) -> Column:
    """1 when any term occurs anywhere in the text, else 0."""
    return contains_any(t, terms).cast("long")


def flag_word(t: Column, terms: list[str]) -> Column:
    """1 when any term stands as a word of its own, else 0."""
    return t.rlike(word_pattern(terms)).cast("long")


def word_pattern(terms: list[str]) -> str:
    return f"(?:^|[^{WORD}])(?:{'|'.join(terms)})(?:$|[^{WORD}])"


def term_score(t: Column, terms: list[str]) -> Column:
    """How many of the terms occur."""
    return reduce(lambda a, b: a + b, [t.contains(w).cast("long") for w in terms])


def category_label(t: Column) -> Column:
    """One label per text: Food, else Beauty, else Cleaning, else Other."""
    return (
        F.when(contains_any(t, wl.LABEL_FOOD), "Food")
        .when(contains_any(t, wl.LABEL_BEAUTY), "Beauty")
        .when(contains_any(t, wl.LABEL_CLEANING), "Cleaning")
        .otherwise("Other")
    )


def price_mentions(t: Column) -> dict[str, Column]:
    """Occurrences of each way to write a price."""
    return {
        name: F.regexp_count(t, F.lit(pattern)).cast("long")
        for name, pattern in wl.PRICE_PATTERNS.items()
    }


def measures(t: Column, pattern: str) -> Column:
    """``array<struct<qty, unit>>`` of the captures of a size or pack pattern."""
    return F.arrays_zip(
        F.regexp_extract_all(t, F.lit(pattern), F.lit(1)).cast("array<double>").alias("qty"),
        F.regexp_extract_all(t, F.lit(pattern), F.lit(2)).alias("unit"),
    )


# -------------------------------------------------------------- file names
def url_file_name(url: Column, strip_slash: bool = False) -> Column:
    """Last part of a URL, query string included.

    ``strip_slash`` ignores slashes at the end, so ``a/b/`` gives ``b``.
    """
    path = F.regexp_replace(url, "/+$", "") if strip_slash else url
    return F.element_at(F.split(path, "/"), -1)
