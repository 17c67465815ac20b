"""Named sets of text features, each one narrow projection of the input.

The words and numbers of a text are computed in an inner projection; Catalyst
keeps it apart from the outer one because its columns are used many times, so
every text is split and scanned once. No shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwright.functions import text as tx
from tagwright.functions import wordlists as wl

_RAW, _LOW, _WORDS, _NUMS = "_raw", "_low", "_words", "_nums"

_BASICS = ["text_length", "word_count", "char_count", "digit_count"]
_NUMBERS = ["max_number", "min_number", "avg_number", "std_number", "number_count"]
_SHAPE = ["avg_word_length", "unique_word_ratio"]


def _scalar(name: str) -> Column:
    low, w, n = F.col(_LOW), F.col(_WORDS), F.col(_NUMS)
    return {
        "text_length": lambda: tx.text_length(low),
        "raw_length": lambda: tx.text_length(F.col(_RAW)),
        "word_count": lambda: tx.word_count(w),
        "char_count": lambda: tx.letter_count(low),
        "digit_count": lambda: tx.digit_count(low),
        "upper_count": lambda: tx.upper_count(F.col(_RAW)),
        "max_number": lambda: tx.max_number(n),
        "min_number": lambda: tx.min_number(n),
        "avg_number": lambda: tx.avg_number(n),
        "std_number": lambda: tx.std_number(n),
        "number_count": lambda: tx.number_count(n),
        "number_range": lambda: tx.number_range(n),
        "avg_word_length": lambda: tx.avg_word_length(w),
        "unique_word_ratio": lambda: tx.unique_word_ratio(w),
        "sentence_count": lambda: tx.sentence_count(low),
    }[name]()


def _scalars(names: Sequence[str]) -> dict[str, Column]:
    return {name: _scalar(name) for name in names}


def _any(prefix: str, groups: dict[str, list[str]]) -> dict[str, Column]:
    return {f"{prefix}_{g}": tx.flag_any(F.col(_LOW), terms) for g, terms in groups.items()}


def _each(terms: list[str]) -> dict[str, Column]:
    return _any("has", {term: [term] for term in terms})


def _base() -> dict[str, Column]:
    return {
        "text_length": _scalar("raw_length"),
        **_scalars(["word_count", "max_number", "min_number", "avg_number", "number_count"]),
        **_each(wl.UNITS_BASE),
        **_each(wl.BRAND_FLAGS_BASE),
        **_any("is", {"food": wl.FOOD_BASE, "beauty": wl.BEAUTY_BASE}),
    }


def _fast() -> dict[str, Column]:
    return {
        **_scalars(["text_length", "word_count", "digit_count"]),
        **_scalars(["max_number", "avg_number", "number_count"]),
        **_each(wl.UNITS_FAST),
        **_each(wl.QUALITY_FLAGS_FAST),
        **_any("is", {"food": wl.FOOD_FAST, "beauty": wl.BEAUTY_FAST}),
    }


_QUALITY_GROUPS = {
    "premium": wl.PREMIUM, "natural": wl.NATURAL, "brand": wl.BRAND, "quality": wl.QUALITY,
}


def _enhanced() -> dict[str, Column]:
    return {
        **_scalars(_BASICS + _NUMBERS + ["number_range"]),
        **_any("has", {
            "weight": wl.WEIGHT, "volume": wl.VOLUME, "count": wl.COUNT_BOX, "size": wl.SIZE,
        }),
        **_any("has", _QUALITY_GROUPS),
        **_any("is", {
            "food": wl.FOOD, "beauty": wl.BEAUTY, "cleaning": wl.CLEANING,
            "health": wl.HEALTH, "electronics": wl.ELECTRONICS,
        }),
        **_scalars(_SHAPE + ["sentence_count"]),
        "has_price_keywords": tx.flag_any(F.col(_LOW), wl.PRICE_WORDS),
    }


def _enhanced_gpu() -> dict[str, Column]:
    # capitals are counted after lower-casing there, so the column is always 0
    return {**_enhanced(), "upper_count": F.lit(0).cast("long")}


def _enhanced_opt() -> dict[str, Column]:
    return {
        **_scalars(_BASICS + ["upper_count"] + _NUMBERS + ["number_range"]),
        **_any("has", {
            "weight": wl.WEIGHT, "volume": wl.VOLUME_OPT, "count": wl.COUNT, "size": wl.SIZE_OPT,
        }),
        **_any("has", _QUALITY_GROUPS),
        **_any("is", {
            "food": wl.FOOD_OPT, "beauty": wl.BEAUTY_OPT, "cleaning": wl.CLEANING,
            "health": wl.HEALTH_OPT, "electronics": wl.ELECTRONICS_OPT,
        }),
        **_scalars(["sentence_count"] + _SHAPE),
        "has_price_keywords": tx.flag_any(F.col(_LOW), wl.PRICE_WORDS_OPT),
    }


def _compact() -> dict[str, Column]:
    low = F.col(_LOW)
    return {
        **_scalars(_BASICS + _NUMBERS),
        "has_weight": tx.flag_word(low, wl.WEIGHT),
        "has_volume": tx.flag_word(low, wl.VOLUME),
        "has_count": tx.flag_word(low, wl.COUNT),
        "quality_score": tx.term_score(low, wl.QUALITY_SCORE),
        **_any("is", {
            "food": wl.FOOD_COMPACT, "beauty": wl.BEAUTY_FAST, "health": wl.HEALTH_COMPACT,
        }),
        **_scalars(_SHAPE),
    }


def _quick_stats() -> dict[str, Column]:
    return {
        "length": _scalar("raw_length"),
        **_scalars(["word_count", "number_count"]),
    }


def _quantity_profile() -> dict[str, Column]:
    return {
        "max_number": _scalar("max_number"),
        **_any("with", {
            "oz": ["oz", "ounce"], "lb": ["lb", "pound"],
            "count": ["count", "pack"], "fl_oz": ["fl oz"],
        }),
    }


_BUILDERS = {
    "base": _base,
    "fast": _fast,
    "enhanced": _enhanced,
    "enhanced_gpu": _enhanced_gpu,
    "enhanced_opt": _enhanced_opt,
    "compact": _compact,
    "quick_stats": _quick_stats,
    "quantity_profile": _quantity_profile,
}
PRESETS = ("base", "fast", "enhanced", "enhanced_gpu", "enhanced_opt", "compact")
#: presets whose numbers include zeros
_KEEPS_ZERO = {"base", "quick_stats", "quantity_profile"}


def feature_names(preset: str) -> list[str]:
    """Feature columns of a preset, in their fixed order."""
    return list(_BUILDERS[preset]())


def text_features(
    df: DataFrame,
    preset: str,
    *,
    text: str = "catalog_content",
    keep: Sequence[str] = ("sample_id",),
    null_text: str = "nan",
) -> DataFrame:
    """``keep`` columns plus the features of ``preset`` for every row."""
    if preset not in _BUILDERS:
        raise ValueError(f"unknown preset {preset!r}, expected one of {sorted(_BUILDERS)}")
    raw = df.select(*keep, tx.as_text(F.col(text), null_text).alias(_RAW))
    low = raw.withColumn(_LOW, F.lower(_RAW))
    parts = low.withColumns({
        _WORDS: tx.words(F.col(_LOW)),
        _NUMS: tx.numbers(F.col(_LOW), keep_zero=preset in _KEEPS_ZERO),
    })
    return parts.select(*keep, *[c.alias(name) for name, c in _BUILDERS[preset]().items()])


def measures_table(
    df: DataFrame, pattern: str, *, text: str = "catalog_content", key: str = "sample_id"
) -> DataFrame:
    """One row per measured size or pack count found: ``key, qty, unit``."""
    low = df.select(key, F.lower(tx.as_text(F.col(text))).alias(_LOW))
    # explode would add a filter on the array below it and search every text twice
    found = low.select(key, F.explode_outer(tx.measures(F.col(_LOW), pattern)).alias("m"))
    return found.where(F.col("m").isNotNull()).select(
        key, F.col("m.qty").alias("qty"), F.col("m.unit").alias("unit")
    )
