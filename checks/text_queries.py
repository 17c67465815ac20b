"""Text features, cleaners, terms and weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import expected as wl
from checks.expected import DIGIT, SPACE, UPPER, WORD, word_pattern
from checks.registry import (
    catalog, catalog_null, query, r6, rounded, s6, table, texts, with_tables,
)
from tagwright.functions import text as tx
from tagwright.functions.cleaning import clean
from tagwright.operators import text_features as tf
from tagwright.operators import tfidf as tv
from tagwright.workspace import spread

# --------------------------------------------------- SQL for single features
_SQL_TEXT = {
    "t": "SELECT src, id, coalesce(text, 'nan') AS raw, lower(coalesce(text, 'nan')) AS low FROM texts",
    "f": (
        f"SELECT *, regexp_extract_all(low, '[^{SPACE}]+') AS w, list_transform("
        r"regexp_extract_all(low, '[0-9]+\.?[0-9]*'), lambda x: CAST(x AS DOUBLE)) AS n0 FROM t"
    ),
    "g": "SELECT *, list_filter(n0, lambda x: x > 0) AS n FROM f",
}
_WITH = with_tables("texts", **_SQL_TEXT)


def _chars(expr: str, cls: str) -> str:
    return f"CAST(length(regexp_replace({expr}, '[^{cls}]', '', 'g')) AS BIGINT)"


def _any(terms: list[str]) -> str:
    return "CAST(" + " OR ".join(f"contains(low, '{w}')" for w in terms) + " AS BIGINT)"


def _word(terms: list[str]) -> str:
    return f"CAST(regexp_matches(low, '{word_pattern(terms)}') AS BIGINT)"


def _score(terms: list[str]) -> str:
    return " + ".join(f"CAST(contains(low, '{w}') AS BIGINT)" for w in terms)


SCALARS = {
    "raw_length": "CAST(length(raw) AS BIGINT)",
    "text_length": "CAST(length(low) AS BIGINT)",
    "word_count": "CAST(len(w) AS BIGINT)",
    "char_count": _chars("low", r"\p{L}"),
    "digit_count": _chars("low", DIGIT),
    "upper_count": _chars("raw", UPPER),
    "max_number": s6("coalesce(list_max(n), 0)"),
    "min_number": s6("coalesce(list_min(n), 0)"),
    "avg_number": s6("coalesce(list_avg(n), 0)"),
    "std_number": s6("CASE WHEN len(n) > 1 THEN list_aggregate(n, 'stddev_pop') ELSE 0 END"),
    "number_count": "CAST(len(n) AS BIGINT)",
    "number_range": s6("CASE WHEN len(n) > 1 THEN list_max(n) - list_min(n) ELSE 0 END"),
    "avg_word_length": s6(
        "CASE WHEN len(w) = 0 THEN 0 ELSE list_sum(list_transform(w, lambda x: length(x))) / len(w) END"
    ),
    "unique_word_ratio": s6("CASE WHEN len(w) = 0 THEN 0 ELSE len(list_distinct(w)) / len(w) END"),
    "sentence_count": (
        "CAST(len(list_filter(string_split(low, '.'), "
        f"lambda x: regexp_matches(x, '[^{SPACE}]'))) AS BIGINT)"
    ),
}


def _keep_zero(expr: str) -> str:
    return expr.replace("(n)", "(n0)").replace("(n,", "(n0,")


def _each(terms):
    return {f"has_{w}": _any([w]) for w in terms}


def _groups(prefix, **groups):
    return {f"{prefix}_{g}": _any(terms) for g, terms in groups.items()}


_QUALITY = _groups("has", premium=wl.PREMIUM, natural=wl.NATURAL, brand=wl.BRAND, quality=wl.QUALITY)
_NUMBERS = ["max_number", "min_number", "avg_number", "std_number", "number_count"]
_ENHANCED_SCALARS = [
    "text_length", "word_count", "char_count", "digit_count", *_NUMBERS, "number_range",
    "avg_word_length", "unique_word_ratio", "sentence_count",
]


def _pick(*names):
    return {n: SCALARS[n] for n in names}


PRESET_SQL = {
    "base": {
        "text_length": SCALARS["raw_length"], "word_count": SCALARS["word_count"],
        **{n: _keep_zero(SCALARS[n]) for n in ("max_number", "min_number", "avg_number", "number_count")},
        **_each(wl.UNITS_BASE), **_each(wl.BRAND_FLAGS_BASE),
        **_groups("is", food=wl.FOOD_BASE, beauty=wl.BEAUTY_BASE),
    },
    "fast": {
        **_pick("text_length", "word_count", "digit_count", "max_number", "avg_number", "number_count"),
        **_each(wl.UNITS_FAST), **_each(wl.QUALITY_FLAGS_FAST),
        **_groups("is", food=wl.FOOD_FAST, beauty=wl.BEAUTY_FAST),
    },
    "enhanced": {
        **_pick(*_ENHANCED_SCALARS), **_QUALITY,
        **_groups("has", weight=wl.WEIGHT, volume=wl.VOLUME, count=wl.COUNT_BOX, size=wl.SIZE),
        **_groups("is", food=wl.FOOD, beauty=wl.BEAUTY, cleaning=wl.CLEANING, health=wl.HEALTH,
                  electronics=wl.ELECTRONICS),
        "has_price_keywords": _any(wl.PRICE_WORDS),
    },
    "enhanced_opt": {
        **_pick(*_ENHANCED_SCALARS, "upper_count"), **_QUALITY,
        **_groups("has", weight=wl.WEIGHT, volume=wl.VOLUME_OPT, count=wl.COUNT, size=wl.SIZE_OPT),
        **_groups("is", food=wl.FOOD_OPT, beauty=wl.BEAUTY_OPT, cleaning=wl.CLEANING,
                  health=wl.HEALTH_OPT, electronics=wl.ELECTRONICS_OPT),
        "has_price_keywords": _any(wl.PRICE_WORDS_OPT),
    },
    "compact": {
        **_pick("text_length", "word_count", "char_count", "digit_count", *_NUMBERS,
                "avg_word_length", "unique_word_ratio"),
        "has_weight": _word(wl.WEIGHT), "has_volume": _word(wl.VOLUME), "has_count": _word(wl.COUNT),
        "quality_score": _score(wl.QUALITY_SCORE),
        **_groups("is", food=wl.FOOD_COMPACT, beauty=wl.BEAUTY_FAST, health=wl.HEALTH_COMPACT),
    },
}
PRESET_SQL["enhanced_gpu"] = {**PRESET_SQL["enhanced"], "upper_count": "CAST(0 AS BIGINT)"}


def _select(columns: dict[str, str]) -> str:
    return _WITH + "SELECT src, id, " + ", ".join(f"{e} AS {n}" for n, e in columns.items()) + " FROM g"


def _add_preset(preset: str) -> None:
    @query(f"text_features_{preset}_F32", _select(PRESET_SQL[preset]))
    def run(spark, sf_dir):
        return rounded(tf.text_features(texts(spark, sf_dir), preset, text="text", keep=("src", "id")))


for _p in tf.PRESETS:
    _add_preset(_p)


# --------------------------------------------------------- single features
def _parts(spark, sf_dir, keep_zero=False):
    raw = texts(spark, sf_dir).select("src", "id", tx.as_text(F.col("text")).alias("raw"))
    low = raw.withColumn("low", F.lower("raw"))
    return low.withColumns({"w": tx.words(F.col("low")), "n": tx.numbers(F.col("low"), keep_zero)})


def _add_feature(name: str, columns: dict, sql: dict[str, str]) -> None:
    @query(name, _select(sql))
    def run(spark, sf_dir):
        made = [make().alias(c) for c, make in columns.items()]
        return rounded(_parts(spark, sf_dir).select("src", "id", *made))


_RAW, _LOW, _W, _N = (lambda: F.col("raw")), (lambda: F.col("low")), (lambda: F.col("w")), (lambda: F.col("n"))
_SINGLE = {
    "text_length_F1": {"text_length": lambda: tx.text_length(_LOW()), "raw_length": lambda: tx.text_length(_RAW())},
    "word_count_F2": {"word_count": lambda: tx.word_count(_W())},
    "letter_count_F3": {"char_count": lambda: tx.letter_count(_LOW())},
    "digit_count_F4": {"digit_count": lambda: tx.digit_count(_LOW())},
    "upper_count_F5": {"upper_count": lambda: tx.upper_count(_RAW())},
    "max_number_F8": {"max_number": lambda: tx.max_number(_N())},
    "min_number_F9": {"min_number": lambda: tx.min_number(_N())},
    "avg_number_F10": {"avg_number": lambda: tx.avg_number(_N())},
    "std_number_F11": {"std_number": lambda: tx.std_number(_N())},
    "number_count_F12": {"number_count": lambda: tx.number_count(_N())},
    "number_range_F13": {"number_range": lambda: tx.number_range(_N())},
    "avg_word_length_F22": {"avg_word_length": lambda: tx.avg_word_length(_W())},
    "unique_word_ratio_F23": {"unique_word_ratio": lambda: tx.unique_word_ratio(_W())},
    "sentence_count_F24": {"sentence_count": lambda: tx.sentence_count(_LOW())},
}
for _name, _cols in _SINGLE.items():
    _add_feature(_name, _cols, {c: SCALARS[c] for c in _cols})


def _flags(name: str, lists: dict[str, list[str]]) -> None:
    _add_feature(
        name,
        {c: (lambda terms=terms: tx.flag_any(_LOW(), terms)) for c, terms in lists.items()},
        {c: _any(terms) for c, terms in lists.items()},
    )


_flags("unit_flags_F14", {f"has_{u}": [u] for u in wl.UNITS_BASE})
_flags("unit_groups_F15", {
    "has_weight": wl.WEIGHT, "has_volume": wl.VOLUME, "has_count": wl.COUNT_BOX, "has_size": wl.SIZE,
})
_flags("quality_groups_F17", {
    "has_premium": wl.PREMIUM, "has_natural": wl.NATURAL, "has_brand": wl.BRAND, "has_quality": wl.QUALITY,
})
_flags("quality_flags_F18", {f"has_{q}": [q] for q in dict.fromkeys(wl.QUALITY_FLAGS_FAST + wl.BRAND_FLAGS_BASE)})
_flags("category_flags_F20", {
    "is_food": wl.FOOD, "is_beauty": wl.BEAUTY, "is_cleaning": wl.CLEANING,
    "is_health": wl.HEALTH, "is_electronics": wl.ELECTRONICS,
})
_flags("price_keywords_F25", {"has_price_keywords": wl.PRICE_WORDS, "has_price_keywords_opt": wl.PRICE_WORDS_OPT})
_flags("brand_words_F29", {"has_brand_word": wl.BRAND_WORDS})

_add_feature(
    "unit_words_F16",
    {"has_weight": lambda: tx.flag_word(_LOW(), wl.WEIGHT), "has_volume": lambda: tx.flag_word(_LOW(), wl.VOLUME),
     "has_count": lambda: tx.flag_word(_LOW(), wl.COUNT)},
    {"has_weight": _word(wl.WEIGHT), "has_volume": _word(wl.VOLUME), "has_count": _word(wl.COUNT)},
)
_add_feature(
    "quality_score_F19", {"quality_score": lambda: tx.term_score(_LOW(), wl.QUALITY_SCORE)},
    {"quality_score": _score(wl.QUALITY_SCORE)},
)
_LABEL_SQL = (
    "CASE WHEN " + " WHEN ".join(
        " OR ".join(f"contains(low, '{w}')" for w in terms) + f" THEN '{label}'"
        for label, terms in (("Food", wl.LABEL_FOOD), ("Beauty", wl.LABEL_BEAUTY), ("Cleaning", wl.LABEL_CLEANING))
    ) + " ELSE 'Other' END"
)
_add_feature("category_label_F21", {"category": lambda: tx.category_label(_LOW())}, {"category": _LABEL_SQL})
_add_feature(
    "price_mentions_F27",
    {n: (lambda n=n: tx.price_mentions(_LOW())[n]) for n in wl.PRICE_PATTERNS},
    {n: f"CAST(len(regexp_extract_all(low, '{p}')) AS BIGINT)" for n, p in wl.PRICE_PATTERNS.items()},
)


def _number_rows(name: str, keep_zero: bool) -> None:
    column = "n0" if keep_zero else "n"

    @query(name, _WITH + f"SELECT src, id, CAST(i AS BIGINT) AS place, {s6(f'{column}[i]')} AS number FROM "
           f"(SELECT src, id, {column}, unnest(range(1, len({column}) + 1)) AS i FROM g)")
    def run(spark, sf_dir):
        rows = _parts(spark, sf_dir, keep_zero).select("src", "id", F.posexplode("n"))
        return rows.select("src", "id", (F.col("pos") + 1).cast("long").alias("place"), r6("col").alias("number"))


_number_rows("numbers_F6", True)
_number_rows("positive_numbers_F7", False)


@query("quantity_profile_F26", _select({
    "max_number": _keep_zero(SCALARS["max_number"]),
    "with_oz": _any(["oz", "ounce"]), "with_lb": _any(["lb", "pound"]),
    "with_count": _any(["count", "pack"]), "with_fl_oz": _any(["fl oz"]),
}))
def quantity_profile(spark, sf_dir):
    return rounded(tf.text_features(texts(spark, sf_dir), "quantity_profile", text="text", keep=("src", "id")))


@query("quick_stats_F30", _select({
    "length": SCALARS["raw_length"], "word_count": SCALARS["word_count"],
    "number_count": _keep_zero(SCALARS["number_count"]),
}))
def quick_stats(spark, sf_dir):
    return tf.text_features(texts(spark, sf_dir), "quick_stats", text="text", keep=("src", "id"))


def _add_measures(name: str, pattern: str) -> None:
    @query(name, with_tables("texts", t=_SQL_TEXT["t"], m=(
        f"SELECT src, id, unnest(regexp_extract_all(low, '{pattern}', 1)) AS qty, "
        f"unnest(regexp_extract_all(low, '{pattern}', 2)) AS unit FROM t"
    )) + f"SELECT src, id, {s6('qty')} AS qty, unit FROM m")
    def run(spark, sf_dir):
        keyed = texts(spark, sf_dir).withColumn("key", F.concat_ws(":", "src", "id"))
        rows = tf.measures_table(keyed, pattern, text="text", key="key")
        parts = F.split("key", ":")
        return rows.select(
            parts[0].alias("src"), parts[1].cast("long").alias("id"), r6("qty").alias("qty"), "unit"
        )


_add_measures("measured_sizes_F28", wl.SIZE_PATTERN)
_add_measures("pack_counts_F28", wl.PACK_PATTERN)


@query("url_file_names_F31", with_tables("catalog") + """
SELECT 'p' AS src, page_id AS id, string_split(url, '/')[-1] AS file_name,
  string_split(regexp_replace(url, '/+$', ''), '/')[-1] AS path_name FROM pages
UNION ALL SELECT 'c', sample_id, string_split(image_link, '/')[-1],
  string_split(regexp_replace(image_link, '/+$', ''), '/')[-1] FROM catalog""")
def url_file_names(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.lit("p").alias("src"), F.col("page_id").alias("id"), "url")
    links = catalog(spark, sf_dir).select(
        F.lit("c").alias("src"), F.col("sample_id").alias("id"), F.col("image_link").alias("url")
    )
    return pages.unionByName(links).select(
        "src", "id", tx.url_file_name(F.col("url")).alias("file_name"),
        tx.url_file_name(F.col("url"), strip_slash=True).alias("path_name"),
    )


# ---------------------------------------------------------------- cleaners
_KEPT_SQL = {"ascii": "a-zA-Z0-9", "word": WORD, "word_dash_dot": WORD + r"\-.", "strict": WORD + r"\-."}


def clean_sql(mode: str, text: str = "low") -> str:
    if mode == "strict":
        text = f"regexp_replace({text}, 'http[^{SPACE}]+|www[^{SPACE}]+', '', 'g')"
    done = f"trim(regexp_replace({text}, '[^{_KEPT_SQL[mode]}]+', ' ', 'g'))"
    if mode != "strict":
        return done
    return f"array_to_string(list_filter(string_split({done}, ' '), lambda x: length(x) > 2), ' ')"


def _add_cleaner(name: str, mode: str) -> None:
    @query(name, with_tables("texts", t=_SQL_TEXT["t"]) + f"""
SELECT src, id, CAST(length(c) AS BIGINT) AS length, md5(c) AS digest
FROM (SELECT src, id, {clean_sql(mode)} AS c FROM t)""")
    def run(spark, sf_dir):
        done = texts(spark, sf_dir).select("src", "id", clean(tx.as_text(F.col("text")), mode).alias("c"))
        return done.select("src", "id", F.length("c").cast("long").alias("length"), F.md5("c").alias("digest"))


_add_cleaner("clean_ascii_T1", "ascii")
_add_cleaner("clean_word_T2", "word")
_add_cleaner("clean_word_dash_dot_T3", "word_dash_dot")
_add_cleaner("clean_strict_T4", "strict")

# ------------------------------------------------------------------- terms
_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers "
    "herself it its itself they them their theirs themselves what which who whom this that these those am is "
    "are was were be been being have has had having do does did doing a an the and but if or because as until "
    "while of at by for with about against between into through during before after above below to from up "
    "down in out on off over under again further then once here there when where why how all any both each "
    "few more most other some such no nor not only own same so than too very s t can will just don should now "
    "i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're "
    "they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't "
    "won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's "
    "there's what's when's where's who's why's would"
).split())


def _tokens_sql(clean_expr: str, stop: bool) -> str:
    found = rf"regexp_extract_all({clean_expr}, '[{WORD}]{{2,}}')"
    return f"list_filter({found}, lambda x: x NOT IN ({_STOP}))" if stop else found


_GRAMS = {
    1: "t", 2: "list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])",
    3: "list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])",
}


def tfidf_ctes(source: str, key: str, text: str, s: tv.TfidfSettings) -> dict[str, str]:
    """CTEs up to ``weights`` for the given settings."""
    grams = _GRAMS[1]
    for n in range(2, s.ngrams[1] + 1):
        grams = f"list_concat({grams}, {_GRAMS[n]})"
    tf_expr = "1 + ln(tf)" if s.sublinear else "tf"
    limit = f"AND df <= {s.max_df} * (SELECT count(*) FROM {source})" if s.max_df else ""
    cleaned = clean_sql(s.cleaner, f"lower(coalesce({text}, 'nan'))")
    return {
        "tok": f"SELECT {key} AS id, {_tokens_sql(cleaned, True)} AS t FROM {source}",
        "occ": f"SELECT id, unnest({grams}) AS term FROM tok",
        "dt": "SELECT id, term, count(*) AS tf FROM occ GROUP BY id, term",
        "st": "SELECT term, count(*) AS df, sum(tf) AS total FROM dt GROUP BY term",
        "lim": f"SELECT * FROM st WHERE df >= {s.min_df} {limit}",
        "top": f"SELECT * FROM lim ORDER BY total DESC, term LIMIT {s.max_features}",
        "vocab": (
            "SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx, df, total, "
            f"ln((1.0 + (SELECT count(*) FROM {source})) / (1.0 + df)) + 1 AS idf FROM top"
        ),
        "raww": f"SELECT dt.id, v.idx, dt.tf, CAST(({tf_expr}) AS DOUBLE) * v.idf AS w FROM dt JOIN vocab v ON dt.term = v.term",
        "norms": "SELECT id, sqrt(sum(w * w)) AS norm FROM raww GROUP BY id",
        "weights": "SELECT r.id, r.idx, r.w / n.norm AS weight FROM raww r JOIN norms n ON r.id = n.id",
    }


ENHANCED = tv.TfidfSettings(1500, (1, 3), 3, 0.95, True, "ascii")
FAST = tv.TfidfSettings(1000, (1, 2), 2, 0.95, False, "ascii")
WORDS = tv.TfidfSettings(1500, (1, 3), 3, 0.95, True, "word")


def _doc_sql(s: tv.TfidfSettings) -> str:
    return with_tables(**tfidf_ctes("documents", "doc_id", "text", s))


def _documents(spark, sf_dir):
    return spread(table(spark, sf_dir, "documents"), 2000)


_TOKEN_SUMMARY = "CAST(len(t) AS BIGINT) AS tokens, md5(array_to_string(t, ' ')) AS digest"


def _add_tokens(name: str, stop: bool) -> None:
    @query(name, f"WITH tok AS (SELECT doc_id, {_tokens_sql(clean_sql('word', 'text').replace('text', 'lower(text)', 1), stop)} AS t "
           f"FROM documents) SELECT doc_id, {_TOKEN_SUMMARY} FROM tok")
    def run(spark, sf_dir):
        words = tv.english_stop_words() if stop else ()
        toks = _documents(spark, sf_dir).select("doc_id", tv.tokens(clean(F.col("text"), "word"), words).alias("t"))
        return toks.select(
            "doc_id", F.size("t").cast("long").alias("tokens"), F.md5(F.array_join("t", " ")).alias("digest")
        )


_add_tokens("tokens_V1", False)
_add_tokens("stop_words_V2", True)


@query("ngrams_V3", _doc_sql(WORDS) + """
SELECT id AS doc_id, CAST(count(*) AS BIGINT) AS terms, md5(string_agg(term, '|' ORDER BY term)) AS digest
FROM occ GROUP BY id""")
def ngrams(spark, sf_dir):
    terms = tv.with_terms(_documents(spark, sf_dir), WORDS, "text", ["doc_id"])
    counted = terms.select(
        "doc_id", F.size("terms").cast("long").alias("terms"),
        F.md5(F.array_join(F.sort_array("terms"), "|")).alias("digest"),
    )
    return counted.where(F.col("terms") > 0)


def _stats(spark, sf_dir, s):
    return tv.term_statistics(tv.term_counts(tv.with_terms(_documents(spark, sf_dir), s, "text", ["doc_id"]), "doc_id"))


@query("frequency_limits_V4", _doc_sql(WORDS) + "SELECT term, CAST(df AS BIGINT) AS df, CAST(total AS BIGINT) AS total FROM lim")
def frequency_limits(spark, sf_dir):
    rows = _documents(spark, sf_dir).count()
    return tv.limit_frequency(_stats(spark, sf_dir, WORDS), rows, WORDS.min_df, WORDS.max_df)


@query("top_terms_V5", _doc_sql(ENHANCED) + "SELECT term, CAST(df AS BIGINT) AS df, CAST(total AS BIGINT) AS total FROM top")
def top_terms(spark, sf_dir):
    rows = _documents(spark, sf_dir).count()
    kept = tv.limit_frequency(_stats(spark, sf_dir, ENHANCED), rows, ENHANCED.min_df, ENHANCED.max_df)
    return tv.top_terms(kept, ENHANCED.max_features)


@query("term_frequency_V6", _doc_sql(ENHANCED) + f"""
SELECT id AS doc_id, CAST(idx AS BIGINT) AS idx, CAST(tf AS BIGINT) AS tf, {s6('1 + ln(tf)')} AS sublinear
FROM raww""")
def term_frequency(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    vocabulary = tv.fit_vocabulary(docs, ENHANCED, text="text", key="doc_id")
    return tv.vocabulary_counts(docs, vocabulary, text="text", key="doc_id").select(
        "doc_id", F.col("idx").cast("long").alias("idx"), "tf",
        r6(tv.term_weight(F.col("tf"), True)).alias("sublinear"),
    )


@query("idf_V7", _doc_sql(ENHANCED) + f"SELECT term, CAST(idx AS BIGINT) AS idx, CAST(df AS BIGINT) AS df, {s6('idf')} AS idf FROM vocab")
def idf(spark, sf_dir):
    vocabulary = tv.fit_vocabulary(_documents(spark, sf_dir), ENHANCED, text="text", key="doc_id")
    return vocabulary.table(spark).select("term", F.col("idx").cast("long").alias("idx"), "df", r6("idf").alias("idf"))


@query("row_norms_V8", _doc_sql(ENHANCED) + f"""
SELECT w.id AS doc_id, {s6('sqrt(sum(w.weight * w.weight))')} AS length, CAST(count(*) AS BIGINT) AS entries
FROM weights w GROUP BY w.id""")
def row_norms(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    vocabulary = tv.fit_vocabulary(docs, ENHANCED, text="text", key="doc_id")
    return tv.tfidf_weights(docs, vocabulary, text="text", key="doc_id").groupBy("doc_id").agg(
        r6(F.sqrt(F.sum(F.col("weight") * F.col("weight")))).alias("length"),
        F.count(F.lit(1)).alias("entries"),
    )


def _add_weights(name: str, s: tv.TfidfSettings) -> None:
    @query(name, _doc_sql(s) + f"SELECT id AS doc_id, CAST(idx AS BIGINT) AS idx, {s6('weight')} AS weight FROM weights")
    def run(spark, sf_dir):
        docs = _documents(spark, sf_dir)
        vocabulary = tv.fit_vocabulary(docs, s, text="text", key="doc_id")
        found = tv.tfidf_weights(docs, vocabulary, text="text", key="doc_id")
        return found.select("doc_id", F.col("idx").cast("long").alias("idx"), r6("weight").alias("weight"))


_add_weights("tfidf_sublinear_V9", ENHANCED)
_add_weights("tfidf_plain_V9", FAST)


def _add_vectors(name: str, s: tv.TfidfSettings) -> None:
    """The vector form, taken apart again, must equal the long form."""
    @query(name, with_tables("catalog", **tfidf_ctes("catalog", "sample_id", "catalog_content", s)) + f"""
SELECT id AS sample_id, CAST(count(*) AS BIGINT) AS entries, {s6('sum(weight)')} AS total,
  {s6('sum(weight * (idx + 1))', 4)} AS moment FROM weights GROUP BY id""")
    def run(spark, sf_dir):
        rows = catalog(spark, sf_dir)
        vocabulary = tv.fit_vocabulary(rows, s)
        cells = tv.vector_cells(tv.tfidf_vectors(rows, vocabulary), "tfidf", ["sample_id"])
        return cells.groupBy("sample_id").agg(
            F.count(F.lit(1)).alias("entries"), r6(F.sum("weight")).alias("total"),
            r6(F.sum(F.col("weight") * (F.col("idx") + 1)), 4).alias("moment"),
        )


_add_vectors("tfidf_vectors_sublinear_V9", ENHANCED)
_add_vectors("tfidf_vectors_plain_V9", FAST)


@query("unfitted_vocabulary_V10", with_tables("catalog", "catalog_null") + "SELECT CAST(count(*) AS BIGINT) AS rows, 1 AS refused FROM catalog_null")
def unfitted_vocabulary(spark, sf_dir):
    """Weighting before fitting is refused; one row tells so."""
    rows = catalog_null(spark, sf_dir)
    try:
        tv.tfidf_weights(rows, None)
        refused = 0
    except tv.NotFittedError:
        refused = 1
    return rows.agg(F.count(F.lit(1)).alias("rows")).withColumn("refused", F.lit(refused))
