"""Sources, row work, joins, profiles, splits, scaling, blends, metrics, images."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import expected as wl
from checks.registry import (
    catalog, catalog_null, image_files, image_vectors, predictions, priced, query, r6, rounded, s6,
    table, with_tables,
)
from tagwright.operators import ensemble as en
from tagwright.operators import images as im
from tagwright.operators import joins as jo
from tagwright.operators import metrics as me
from tagwright.operators import profile as pr
from tagwright.operators import row_index as ri
from tagwright.operators import rows as ro
from tagwright.operators import scaling as sc
from tagwright.operators import splits as sp
from tagwright.operators import userfn as uf
from tagwright.operators.text_features import text_features
from tagwright.sources import catalog_csv as cs
from tagwright.workspace import scratch_path

CAT = with_tables("catalog")
CATN = with_tables("catalog", "catalog_null")
_LOW = "lower(coalesce(catalog_content, 'nan'))"
_LABEL = (
    "CASE WHEN " + " WHEN ".join(
        " OR ".join(f"contains({_LOW}, '{w}')" for w in terms) + f" THEN '{label}'"
        for label, terms in (("Food", wl.LABEL_FOOD), ("Beauty", wl.LABEL_BEAUTY), ("Cleaning", wl.LABEL_CLEANING))
    ) + " ELSE 'Other' END"
)
_IQR = (
    "SELECT q1, q3, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM "
    "(SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM catalog)"
)
IQR = with_tables("catalog", b=_IQR)
_LABELLED = with_tables("catalog", lab=f"SELECT *, {_LABEL} AS category FROM catalog")


# ------------------------------------------------------------- the flagship
@query("category_price_profile", with_tables(
    "catalog", b=_IQR,
    kept="SELECT c.* FROM catalog c, b WHERE c.price BETWEEN b.low AND b.high",
    lab=f"SELECT *, {_LABEL} AS category, lower(catalog_content) AS lo FROM kept",
) + f"""
SELECT category, CAST(count(*) AS BIGINT) AS products, {s6('avg(price)')} AS mean_price,
  {s6('avg(length(lo))')} AS mean_length,
  {s6("avg(coalesce(list_max(list_filter(list_transform(regexp_extract_all(lo, '[0-9]+[.]?[0-9]*'), lambda x: CAST(x AS DOUBLE)), lambda x: x > 0)), 0))")} AS mean_max_number,
  CAST(sum(CAST(contains(lo, 'organic') OR contains(lo, 'natural') OR contains(lo, 'pure') OR contains(lo, 'fresh') OR contains(lo, 'raw') AS BIGINT)) AS BIGINT) AS natural_products
FROM lab GROUP BY category""")
def category_price_profile(spark, sf_dir):
    kept = pr.with_category(pr.drop_outliers(catalog(spark, sf_dir)))
    made = text_features(kept, "enhanced", keep=("sample_id", "category", "price"))
    return made.groupBy("category").agg(
        F.count(F.lit(1)).alias("products"), r6(F.avg("price")).alias("mean_price"),
        r6(F.avg("text_length")).alias("mean_length"),
        r6(F.avg("max_number")).alias("mean_max_number"),
        F.sum("has_natural").alias("natural_products"),
    ).orderBy("category")


# ------------------------------------------------------------------ sources
def _messy(spark, sf_dir):
    """Catalog rows with line breaks, quotes, commas and empty texts."""
    text = F.col("catalog_content")
    return catalog_null(spark, sf_dir).withColumn(
        "catalog_content",
        F.when(F.col("sample_id") % 3 == 0, F.concat(text, F.lit('\nsays "best, by far"\n')))
        .when(F.col("sample_id") % 41 == 0, F.lit("")).otherwise(text),
    )


_MESSY = (
    "SELECT sample_id, CASE WHEN sample_id % 3 = 0 THEN catalog_content || chr(10) || 'says \"best, by far\"' || chr(10) "
    "WHEN sample_id % 41 = 0 THEN '' ELSE catalog_content END AS catalog_content, image_link, price FROM catalog_null"
)
MESSY = with_tables("catalog_null", messy=_MESSY)


@query("labelled_csv_S1", MESSY + f"SELECT sample_id, nullif(catalog_content, '') AS catalog_content, image_link, {s6('price')} AS price FROM messy")
def labelled_csv(spark, sf_dir):
    path = scratch_path(spark, "labelled")
    cs.write_csv(_messy(spark, sf_dir), path)
    return rounded(cs.read_labelled(spark, path))


@query("unlabelled_csv_S2", MESSY + "SELECT sample_id, nullif(catalog_content, '') AS catalog_content, image_link FROM messy")
def unlabelled_csv(spark, sf_dir):
    path = scratch_path(spark, "unlabelled")
    cs.write_csv(_messy(spark, sf_dir).drop("price"), path)
    return cs.read_unlabelled(spark, path)


@query("answers_csv_S3", CAT + f"SELECT sample_id, {s6('price')} AS price FROM catalog")
def answers_csv(spark, sf_dir):
    path = scratch_path(spark, "answers")
    cs.write_csv(ro.price_table(catalog(spark, sf_dir)), path)
    return rounded(cs.read_answers(spark, path))


@query("write_predictions_S4", CAT + f"SELECT sample_id, {s6('price')} AS price FROM catalog")
def write_predictions(spark, sf_dir):
    path = scratch_path(spark, "predictions")
    cs.write_predictions(catalog(spark, sf_dir), path)
    return rounded(cs.read_answers(spark, path))


@query("write_predictions_parquet_S4", CAT + f"SELECT sample_id, {s6('price')} AS price FROM catalog")
def write_predictions_parquet(spark, sf_dir):
    path = scratch_path(spark, "predictions")
    cs.write_predictions(catalog(spark, sf_dir), path, "parquet")
    return rounded(spark.read.schema(cs.ANSWERS).parquet(path))


_REQUIRED = ["sample_id", "catalog_content", "image_link", "price", "brand"]


def _filled(name: str) -> str:
    return f"(SELECT CAST(count(*) FILTER (WHERE {name} IS NULL) AS BIGINT) FROM catalog_null)"


@query("required_columns_S5", CATN + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({int(c != 'brand')} AS BIGINT) AS present, "
    f"{_filled(c) if c != 'brand' else 'CAST(NULL AS BIGINT)'} AS nulls" for c in _REQUIRED))
def required_columns(spark, sf_dir):
    """Are the columns there, and how many cells do they lack?"""
    rows = catalog_null(spark, sf_dir)
    return cs.required_columns(rows, _REQUIRED).join(pr.null_counts(rows), "column", "left")


@query("preview_S6", CAT + f"SELECT sample_id, catalog_content, image_link, {s6('price')} AS price FROM catalog ORDER BY sample_id LIMIT 5")
def preview(spark, sf_dir):
    return rounded(cs.preview(catalog(spark, sf_dir)))


_TYPES = {"sample_id": "bigint", "catalog_content": "string", "image_link": "string", "price": "double"}


@query("column_table_S6", CATN + " UNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS \"column\", '{t}' AS type, CAST(4 AS BIGINT) AS width, {_filled(c)} AS nulls"
    for i, (c, t) in enumerate(_TYPES.items())))
def column_table(spark, sf_dir):
    rows = catalog_null(spark, sf_dir)
    return cs.column_table(rows).join(pr.null_counts(rows), "column")


@query("empty_input_S7", CAT + "SELECT CAST(count(*) AS BIGINT) AS rows, 'empty input: test' AS refused FROM catalog")
def empty_input(spark, sf_dir):
    """A table without rows is refused; the others pass."""
    rows = catalog(spark, sf_dir)
    try:
        cs.check_not_empty(train=rows, test=rows.where(F.col("price") < 0))
        message = None
    except ValueError as exc:
        message = str(exc)
    return rows.agg(F.count(F.lit(1)).alias("rows")).withColumn("refused", F.lit(message))


@query("chunks_S11", CAT + """
SELECT chunk, CAST(count(*) AS BIGINT) AS rows FROM (
  SELECT CAST((row_number() OVER (ORDER BY sample_id) - 1) // 1000 AS BIGINT) AS chunk FROM catalog) GROUP BY chunk""")
def chunks(spark, sf_dir):
    return ri.chunk_counts(catalog(spark, sf_dir))


# ----------------------------------------------------------------- row work
@query("price_table_P1", CAT + f"SELECT sample_id, {s6('price')} AS price FROM catalog")
def price_table(spark, sf_dir):
    return rounded(ro.price_table(catalog(spark, sf_dir)))


@query("first_rows_P2", CAT + f"SELECT sample_id, catalog_content, image_link, {s6('price')} AS price FROM catalog ORDER BY sample_id LIMIT 1000")
def first_rows(spark, sf_dir):
    return rounded(ro.first_rows(catalog(spark, sf_dir), 1000))


_DRAW = "md5(concat(CAST(sample_id AS VARCHAR), '|42'))"
_DRAW_NUMBER = f"CAST(('0x' || substr({_DRAW}, 1, 7)) AS BIGINT)"


@query("sample_rows_P3", CAT + f"SELECT sample_id, {s6('price')} AS price FROM catalog ORDER BY {_DRAW}, sample_id LIMIT 500")
def sample_rows(spark, sf_dir):
    return rounded(ro.sample_rows(ro.price_table(catalog(spark, sf_dir)), 500))


@query("iqr_bounds_P4", IQR + f"SELECT {s6('q1')} AS q1, {s6('q3')} AS q3, {s6('low')} AS low, {s6('high')} AS high FROM b")
def iqr_bounds(spark, sf_dir):
    return rounded(pr.iqr_bounds_table(catalog(spark, sf_dir)))


@query("drop_outliers_P5", IQR + f"SELECT sample_id, {s6('price')} AS price FROM catalog, b WHERE price BETWEEN low AND high")
def drop_outliers(spark, sf_dir):
    return rounded(pr.drop_outliers(ro.price_table(catalog(spark, sf_dir))))


@query("outlier_summary_P6", IQR + f"""
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (WHERE price < low OR price > high) AS BIGINT) AS removed,
  {s6('count(*) FILTER (WHERE price < low OR price > high) * 100.0 / count(*)')} AS removed_percent FROM catalog, b""")
def outlier_summary(spark, sf_dir):
    return rounded(pr.outlier_summary(catalog(spark, sf_dir)))


@query("null_text_P7", CATN + "SELECT sample_id, coalesce(catalog_content, 'nan') AS catalog_content FROM catalog_null")
def null_text(spark, sf_dir):
    return ro.fill_text(catalog_null(spark, sf_dir)).select("sample_id", "catalog_content")


@query("empty_text_P8", CATN + "SELECT sample_id, coalesce(catalog_content, '') AS catalog_content FROM catalog_null")
def empty_text(spark, sf_dir):
    return ro.fill_text(catalog_null(spark, sf_dir), null_text="").select("sample_id", "catalog_content")


@query("fill_numbers_P9", CATN + "SELECT sample_id, CAST(coalesce(length(catalog_content), 0) AS BIGINT) AS n FROM catalog_null")
def fill_numbers(spark, sf_dir):
    rows = catalog_null(spark, sf_dir).select("sample_id", F.length("catalog_content").cast("long").alias("n"))
    return ro.fill_numbers(rows, ["n"])


@query("keep_first_P10", "SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text")
def keep_first(spark, sf_dir):
    return ro.keep_first(table(spark, sf_dir, "documents"), ["text"], "doc_id").select("doc_id", "text")


@query("clip_P11", CAT + f"SELECT sample_id, {s6('greatest(0.1, least(10000.0, (price - 1000) * 10))')} AS price FROM catalog")
def clip(spark, sf_dir):
    return catalog(spark, sf_dir).select("sample_id", r6(ro.clip((F.col("price") - 1000) * 10)).alias("price"))


@query("floor_P12", CAT + f"SELECT sample_id, {s6('greatest(0.1, (price - 1000) * 10)')} AS price FROM catalog")
def floor(spark, sf_dir):
    return catalog(spark, sf_dir).select(
        "sample_id", r6(ro.clip((F.col("price") - 1000) * 10, high=None)).alias("price")
    )


@query("parse_fallback_P13", f"""
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(sum(CASE WHEN TRY_CAST(w AS DOUBLE) IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS failed
FROM (SELECT CASE WHEN p_partkey % 5 = 0 THEN p_name ELSE CAST(p_retailprice AS VARCHAR) END AS w FROM part)""")
def parse_fallback(spark, sf_dir):
    mixed = table(spark, sf_dir, "part").select(
        F.when(F.col("p_partkey") % 5 == 0, F.col("p_name")).otherwise(F.col("p_retailprice").cast("string")).alias("w")
    )
    return ro.failure_count(ro.parse_numbers(mixed, "w", "number"))


# -------------------------------------------------------------------- joins
@query("answers_join_J1", CAT + f"SELECT sample_id, catalog_content, image_link, {s6('price')} AS price FROM catalog")
def answers_join(spark, sf_dir):
    rows = catalog(spark, sf_dir)
    return rounded(jo.with_answers(rows.drop("price"), ro.price_table(rows)))


@query("feature_blocks_J2", CAT + """
SELECT sample_id, CAST(length(lower(catalog_content)) AS BIGINT) AS text_length,
  CAST(contains(lower(catalog_content), 'oz') AS BIGINT) AS has_oz,
  CAST(contains(lower(catalog_content), 'organic') AS BIGINT) AS has_organic FROM catalog""")
def feature_blocks(spark, sf_dir):
    rows = catalog(spark, sf_dir)
    stats = text_features(rows, "fast").select("sample_id", "text_length", "has_oz")
    flags = text_features(rows, "base").select("sample_id", "has_organic")
    return jo.join_blocks(stats, flags)


FILES = with_tables("catalog", "image_files", "image_vectors")
_NAME = "string_split(image_link, '/')[-1]"


@query("missing_files_J3", FILES + f"""
SELECT sample_id, {_NAME} AS file_name FROM catalog
WHERE image_link IS NOT NULL AND {_NAME} NOT IN (SELECT file_name FROM image_files)""")
def missing_files(spark, sf_dir):
    return jo.missing_files(catalog(spark, sf_dir), image_files(spark, sf_dir)).select("sample_id", "file_name")


@query("missing_file_count_J3", FILES + f"""
SELECT CAST(count(*) AS BIGINT) AS missing_rows, CAST(count(DISTINCT {_NAME}) AS BIGINT) AS missing_names FROM catalog
WHERE image_link IS NOT NULL AND {_NAME} NOT IN (SELECT file_name FROM image_files)""")
def missing_file_count(spark, sf_dir):
    return jo.missing_file_count(catalog(spark, sf_dir), image_files(spark, sf_dir))


@query("image_vectors_J4", FILES + f"""
SELECT c.sample_id, CAST(v.file_name IS NOT NULL AS BIGINT) AS found,
  {s6('coalesce(list_sum(list_transform(v.embedding, lambda x: CAST(x AS DOUBLE))), 0)', 4)} AS total,
  {s6('coalesce(v.embedding[1], 0)')} AS first
FROM catalog c LEFT JOIN image_vectors v ON string_split(c.image_link, '/')[-1] = v.file_name""")
def attach_vectors(spark, sf_dir):
    vectors = image_vectors(spark, sf_dir)
    width = vectors.select(F.size("embedding").alias("n")).first()["n"]
    joined = jo.attach_vectors(catalog(spark, sf_dir), vectors, width)
    v = F.col("embedding").cast("array<double>")
    return joined.select(
        "sample_id", F.exists(v, lambda x: x != 0).cast("long").alias("found"),
        r6(F.aggregate(v, F.lit(0.0), lambda a, x: a + x), 4).alias("total"),
        r6(F.element_at(v, 1)).alias("first"),
    )


@query("known_terms_J5", """
WITH w AS (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS term FROM documents),
v AS (SELECT term FROM w GROUP BY term ORDER BY count(*) DESC, term LIMIT 200)
SELECT doc_id, w.term, CAST(count(*) AS BIGINT) AS n FROM w JOIN v ON w.term = v.term GROUP BY doc_id, w.term""")
def known_terms(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select(
        "doc_id", F.explode(F.split(F.lower("text"), " ")).alias("term")
    )
    top = words.groupBy("term").count().orderBy(F.desc("count"), "term").limit(200).select("term")
    return jo.known_terms(words, top).groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("n"))


# ----------------------------------------------------------------- profiles
_STATS_CTE = (
    "SELECT sample_id, price, CAST(length(catalog_content) AS BIGINT) AS length, "
    r"CAST(len(regexp_extract_all(catalog_content, '\S+')) AS BIGINT) AS word_count, "
    r"CAST(len(regexp_extract_all(catalog_content, '[0-9]+\.?[0-9]*')) AS BIGINT) AS number_count FROM catalog"
)
STATS = with_tables("catalog", stats=_STATS_CTE)
_STAT_COLUMNS = ["price", "length", "word_count", "number_count"]


def _stats(spark, sf_dir):
    return text_features(catalog(spark, sf_dir), "quick_stats", keep=("sample_id", "price"))


def _corr(a: str, b: str) -> str:
    x, y = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
    return f"CASE WHEN stddev_pop({x}) = 0 OR stddev_pop({y}) = 0 THEN NULL ELSE corr({x}, {y}) END"


def _describe_sql(column: str, source: str) -> str:
    x = f"CAST({column} AS DOUBLE)"
    return (
        f"SELECT '{column}' AS \"column\", CAST(count({column}) AS BIGINT) AS count, {s6(f'avg({x})')} AS mean, "
        f"{s6(f'stddev_samp({x})')} AS std, {s6(f'min({x})')} AS min, {s6(f'quantile_cont({x}, 0.25)')} AS p25, "
        f"{s6(f'quantile_cont({x}, 0.5)')} AS p50, {s6(f'quantile_cont({x}, 0.75)')} AS p75, "
        f"{s6(f'max({x})')} AS max FROM {source}"
    )


@query("describe_A1", STATS + " UNION ALL ".join(_describe_sql(c, "stats") for c in _STAT_COLUMNS))
def describe(spark, sf_dir):
    return rounded(pr.describe(_stats(spark, sf_dir), _STAT_COLUMNS))


_MONEY = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("describe_lineitem_A1", " UNION ALL ".join(_describe_sql(c, "lineitem") for c in _MONEY))
def describe_lineitem(spark, sf_dir):
    return rounded(pr.describe(table(spark, sf_dir, "lineitem"), _MONEY))


@query("mean_by_category_A2", _LABELLED + f"SELECT category, {s6('avg(price)')} AS mean_price FROM lab GROUP BY category")
def mean_by_category(spark, sf_dir):
    return rounded(pr.mean_by(pr.with_category(catalog(spark, sf_dir)), "category"))


@query("category_counts_A3", _LABELLED + "SELECT category, CAST(count(*) AS BIGINT) AS count FROM lab GROUP BY category")
def category_counts(spark, sf_dir):
    return pr.value_counts(pr.with_category(catalog(spark, sf_dir)), "category")


@query("correlation_A4", CAT + f"""
SELECT {s6("corr(price, list_max(list_transform(regexp_extract_all(catalog_content, '[0-9]+[.]?[0-9]*'), lambda x: CAST(x AS DOUBLE))))")}
  AS correlation FROM catalog""")
def correlation(spark, sf_dir):
    rows = text_features(catalog(spark, sf_dir), "quantity_profile", keep=("sample_id", "price"))
    return rounded(pr.correlation(rows, "max_number", "price"))


@query("correlation_matrix_A5", STATS + " UNION ALL ".join(
    f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", {s6(_corr(a, b))} AS correlation FROM stats"
    for a in _STAT_COLUMNS for b in _STAT_COLUMNS))
def correlation_matrix(spark, sf_dir):
    return rounded(pr.correlation_matrix(_stats(spark, sf_dir), _STAT_COLUMNS))


@query("price_correlations_A6", STATS + " UNION ALL ".join(
    f"SELECT '{a}' AS \"column\", {s6(_corr(a, 'price'))} AS correlation FROM stats" for a in _STAT_COLUMNS))
def price_correlations(spark, sf_dir):
    return rounded(pr.correlations_with(_stats(spark, sf_dir), "price", _STAT_COLUMNS))


@query("flag_totals_A7", CAT + """
SELECT CAST(sum(CAST(contains(lo, 'oz') OR contains(lo, 'ounce') AS BIGINT)) AS BIGINT) AS with_oz,
  CAST(sum(CAST(contains(lo, 'count') OR contains(lo, 'pack') AS BIGINT)) AS BIGINT) AS with_count,
  CAST(sum(CAST(contains(lo, 'fl oz') AS BIGINT)) AS BIGINT) AS with_fl_oz
FROM (SELECT lower(catalog_content) AS lo FROM catalog)""")
def flag_totals(spark, sf_dir):
    rows = text_features(catalog(spark, sf_dir), "quantity_profile")
    return pr.flag_totals(rows, ["with_oz", "with_count", "with_fl_oz"])


@query("null_counts_A8", CATN + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulls FROM catalog_null"
    for c in ("sample_id", "catalog_content", "image_link", "price")))
def null_counts(spark, sf_dir):
    return pr.null_counts(catalog_null(spark, sf_dir))


@query("price_summary_A9", CAT + f"""
SELECT {s6('min(price)')} AS min_price, {s6('max(price)')} AS max_price, {s6('avg(price)')} AS mean_price,
  {s6('median(price)')} AS median_price FROM catalog""")
def price_summary(spark, sf_dir):
    return rounded(pr.price_summary(catalog(spark, sf_dir)))


@query("negative_prices_A10", "SELECT CAST(count(*) FILTER (WHERE c_acctbal < 0) AS BIGINT) AS negative_prices FROM customer")
def negative_prices(spark, sf_dir):
    return pr.negative_count(table(spark, sf_dir, "customer"), "c_acctbal")


@query("length_summary_A11", f"""
SELECT CAST(min(length(text)) AS BIGINT) AS min_length, CAST(max(length(text)) AS BIGINT) AS max_length,
  {s6('avg(length(text))')} AS mean_length FROM documents""")
def length_summary(spark, sf_dir):
    return rounded(pr.length_summary(table(spark, sf_dir, "documents"), "text"))


@query("valid_links_A12", CAT + """
SELECT CAST(count(*) FILTER (WHERE coalesce(contains(image_link, 'http'), false)) AS BIGINT) AS valid_links,
  CAST(count(*) AS BIGINT) AS rows FROM catalog""")
def valid_links(spark, sf_dir):
    return pr.valid_link_count(catalog(spark, sf_dir))


def _histogram_sql(prefix: str, column: str, source: str) -> str:
    return prefix + f"""
SELECT CAST(g.bin AS BIGINT) AS bin, {s6('lo + g.bin * w')} AS low, {s6('lo + (g.bin + 1) * w')} AS high,
  CAST(coalesce(n, 0) AS BIGINT) AS rows
FROM (SELECT unnest(range(30)) AS bin) g CROSS JOIN ends
LEFT JOIN (SELECT least(CAST(floor(({column} - lo) / w) AS BIGINT), 29) AS bin, count(*) AS n FROM {source}, ends GROUP BY 1) h
  ON g.bin = h.bin"""


def _ends(column: str, source: str) -> str:
    return f"SELECT min({column}) AS lo, (max({column}) - min({column})) / 30 AS w FROM {source}"


@query("price_histogram_A13", _histogram_sql(with_tables("catalog", ends=_ends("price", "catalog")), "price", "catalog"))
def price_histogram(spark, sf_dir):
    return rounded(pr.histogram(catalog(spark, sf_dir), "price"))


@query("lineitem_histogram_A13", _histogram_sql(
    with_tables(ends=_ends("l_extendedprice", "lineitem")), "l_extendedprice", "lineitem"))
def lineitem_histogram(spark, sf_dir):
    return rounded(pr.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice"))


def _box_sql(prefix: str, source: str, column: str, by: str | None) -> str:
    group, pick = (f"GROUP BY {by}", f"{by}, ") if by else ("", "")
    join = f"JOIN q ON s.{by} = q.{by}" if by else "CROSS JOIN q"
    x = f"s.{column}"
    inside = f"{x} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"
    return prefix + f""", q AS (SELECT {pick}quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.5) AS q2,
  quantile_cont({column}, 0.75) AS q3 FROM {source} {group})
SELECT {'s.' + by + ',' if by else ''} {s6('first(q1)')} AS q1, {s6('first(q2)')} AS median, {s6('first(q3)')} AS q3,
  {s6(f'min({x}) FILTER (WHERE {inside})')} AS whisker_low, {s6(f'max({x}) FILTER (WHERE {inside})')} AS whisker_high,
  CAST(count(*) FILTER (WHERE NOT ({inside})) AS BIGINT) AS outliers
FROM {source} s {join} {'GROUP BY s.' + by if by else ''}"""


@query("box_plot_A14", _box_sql(CAT, "catalog", "price", None))
def box_plot(spark, sf_dir):
    return rounded(pr.box_plot(catalog(spark, sf_dir)))


@query("box_plot_by_category_A15", _box_sql(_LABELLED, "lab", "price", "category"))
def box_plot_by_category(spark, sf_dir):
    return rounded(pr.box_plot(pr.with_category(catalog(spark, sf_dir)), by="category"))


@query("box_plot_by_status_A15", _box_sql(
    "WITH lab AS (SELECT l_returnflag, l_extendedprice FROM lineitem)", "lab", "l_extendedprice", "l_returnflag"))
def box_plot_by_status(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return rounded(pr.box_plot(rows, "l_extendedprice", "l_returnflag"))


PREDICTIONS = with_tables("predictions")


def _summary_sql(by: str) -> str:
    return (
        f"SELECT {by} CAST(count(prediction) AS BIGINT) AS predictions, {s6('min(prediction)')} AS min_prediction, "
        f"{s6('max(prediction)')} AS max_prediction, {s6('avg(prediction)')} AS mean_prediction FROM predictions"
    )


@query("prediction_summary_A16", PREDICTIONS + _summary_sql("model,") + " GROUP BY model")
def prediction_summary(spark, sf_dir):
    return rounded(pr.prediction_summary(predictions(spark, sf_dir)))


@query("overall_prediction_summary_A16", PREDICTIONS + _summary_sql(""))
def overall_prediction_summary(spark, sf_dir):
    return rounded(pr.prediction_summary(predictions(spark, sf_dir), None))


@query("row_counts_A17", """
SELECT 'train' AS "table", CAST(count(*) AS BIGINT) AS rows FROM part
UNION ALL SELECT 'test', CAST(count(*) AS BIGINT) FROM documents""")
def row_counts(spark, sf_dir):
    return cs.row_counts(train=catalog(spark, sf_dir), test=table(spark, sf_dir, "documents"))


@query("scatter_bins_A18", with_tables(
    "catalog", stats=_STATS_CTE,
    e="SELECT min(length) AS xl, (max(length) - min(length)) / 50.0::DOUBLE AS xw, min(price) AS yl, (max(price) - min(price)) / 50 AS yw FROM stats",
) + """
SELECT least(CAST(floor((length - xl) / xw) AS BIGINT), 49) AS x_bin, least(CAST(floor((price - yl) / yw) AS BIGINT), 49) AS y_bin,
  CAST(count(*) AS BIGINT) AS rows FROM stats, e GROUP BY 1, 2""")
def scatter_bins(spark, sf_dir):
    return pr.binned_pairs(_stats(spark, sf_dir), "length", "price")


# ---------------------------------------------------------- index and folds
@query("row_index_W1", "SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS row_index FROM documents")
def row_index(spark, sf_dir):
    return ri.key_index(table(spark, sf_dir, "documents"), "doc_id")


@query("time_index_W1", "SELECT event_id, CAST(row_number() OVER (ORDER BY ts, event_id) - 1 AS BIGINT) AS row_index FROM events")
def time_index(spark, sf_dir):
    return ri.key_index(table(spark, sf_dir, "events"), "event_id", [F.col("ts")])


_INDEXED = with_tables(
    "catalog", ix="SELECT *, row_number() OVER (ORDER BY sample_id) - 1 AS i, count(*) OVER () AS n FROM catalog"
)


@query("positional_split_K1", _INDEXED + """
SELECT sample_id, CASE WHEN i < CAST(floor(0.7::DOUBLE * n) AS BIGINT) THEN 'train' ELSE 'test' END AS split FROM ix""")
def positional_split(spark, sf_dir):
    return sp.positional_split(catalog(spark, sf_dir)).select("sample_id", "split")


_DRAWN = with_tables(
    "catalog", ix=f"SELECT *, row_number() OVER (ORDER BY {_DRAW}, sample_id) - 1 AS i, count(*) OVER () AS n FROM catalog"
)


@query("random_split_K2", _DRAWN + """
SELECT sample_id, CASE WHEN i < CAST(ceil(0.2::DOUBLE * n) AS BIGINT) THEN 'test' ELSE 'train' END AS split FROM ix""")
def random_split(spark, sf_dir):
    return sp.random_split(catalog(spark, sf_dir)).select("sample_id", "split")


def _time_split_sql(source: str, key: str, time: str) -> str:
    return f"""
WITH q AS (SELECT quantile_cont(CAST(epoch_us({time}) AS DOUBLE), 0.8) AS cut FROM {source})
SELECT {key}, CASE WHEN epoch_us({time}) <= cut THEN 'train' ELSE 'test' END AS split FROM {source}, q"""


@query("time_split_K3", _time_split_sql("events", "event_id", "ts"))
def time_split(spark, sf_dir):
    return sp.time_split(table(spark, sf_dir, "events"), "ts").select("event_id", "split")


@query("order_date_split_K3", _time_split_sql("orders", "o_orderkey", "o_orderdate"))
def order_date_split(spark, sf_dir):
    return sp.time_split(table(spark, sf_dir, "orders"), "o_orderdate").select("o_orderkey", "split")


_BINS = (
    "SELECT sample_id, price, greatest(0, CAST(ceil((price - lo) / w) AS BIGINT) - 1) AS bin FROM catalog, "
    "(SELECT min(price) AS lo, (max(price) - min(price)) / 5 AS w FROM catalog)"
)


@query("price_bins_K4", with_tables("catalog", bins=_BINS) + "SELECT sample_id, bin FROM bins")
def price_bins(spark, sf_dir):
    return sp.price_bins(catalog(spark, sf_dir)).select("sample_id", "bin")


@query("stratified_folds_K5", with_tables("catalog", bins=_BINS) + f"""
SELECT sample_id, bin, CAST((row_number() OVER (PARTITION BY bin ORDER BY {_DRAW}, sample_id) - 1) % 5 AS BIGINT) AS fold FROM bins""")
def stratified_folds(spark, sf_dir):
    return sp.stratified_folds(catalog(spark, sf_dir)).select("sample_id", "bin", "fold")


@query("contiguous_folds_C1", _INDEXED + """
SELECT sample_id, CAST(CASE WHEN i < (n % 3) * (n // 3 + 1) THEN i // (n // 3 + 1)
  ELSE (i - (n % 3) * (n // 3 + 1)) // (n // 3) + n % 3 END AS BIGINT) AS fold FROM ix""")
def contiguous_folds(spark, sf_dir):
    return sp.contiguous_folds(catalog(spark, sf_dir)).select("sample_id", F.col("fold").cast("long").alias("fold"))


@query("shuffled_folds_C2", _DRAWN + """
SELECT sample_id, CAST(CASE WHEN i < (n % 5) * (n // 5 + 1) THEN i // (n // 5 + 1)
  ELSE (i - (n % 5) * (n // 5 + 1)) // (n // 5) + n % 5 END AS BIGINT) AS fold FROM ix""")
def shuffled_folds(spark, sf_dir):
    return sp.shuffled_folds(catalog(spark, sf_dir)).select("sample_id", F.col("fold").cast("long").alias("fold"))


@query("time_folds_C3", """
WITH ix AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS i, count(*) OVER () AS n FROM events),
sp AS (SELECT event_id, i, n - 5 * (n // 6) + s * (n // 6) AS a, n // 6 AS size, s FROM ix CROSS JOIN (SELECT unnest(range(5)) AS s))
SELECT event_id, CAST(s AS BIGINT) AS split, CASE WHEN i < a THEN 'train' ELSE 'test' END AS role FROM sp WHERE i < a + size""")
def time_folds(spark, sf_dir):
    blocks = sp.time_blocks(table(spark, sf_dir, "events"), "ts", "event_id")
    return sp.time_split_rows(blocks, "event_id").select("event_id", F.col("split").cast("long").alias("split"), "role")


# -------------------------------------------------------- scaling and scores
_SCALED = ["price", "length", "word_count", "number_count"]


def _robust(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    iqr = f"(quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25))"
    return f"quantile_cont({x}, 0.5) AS m_{c}, CASE WHEN {iqr} = 0 THEN 1 ELSE {iqr} END AS s_{c}"


@query("robust_scale_Z1", with_tables(
    "catalog", stats=_STATS_CTE, q="SELECT " + ", ".join(_robust(c) for c in _SCALED) + " FROM stats",
) + "SELECT sample_id, " + ", ".join(f"{s6(f'({c} - m_{c}) / s_{c}')} AS {c}" for c in _SCALED) + " FROM stats, q")
def robust_scale(spark, sf_dir):
    rows = _stats(spark, sf_dir)
    return rounded(sc.apply_scales(rows, sc.fit_robust(rows, _SCALED)))


@query("standard_scale_Z2", with_tables(
    "catalog", stats=_STATS_CTE,
    q="SELECT " + ", ".join(f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS s_{c}" for c in _SCALED) + " FROM stats",
) + "SELECT sample_id, " + ", ".join(f"{s6(f'({c} - m_{c}) / s_{c}')} AS {c}" for c in _SCALED) + " FROM stats, q")
def standard_scale(spark, sf_dir):
    rows = _stats(spark, sf_dir)
    return rounded(sc.apply_scales(rows, sc.fit_standard(rows, _SCALED)))


@query("regression_scores_L1", STATS + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {s6(f"pow({_corr(c, 'price')}, 2) / (1 - pow({_corr(c, 'price')}, 2)) * (count(*) - 2)")} AS score FROM stats"
    for c in _SCALED[1:]))
def regression_scores(spark, sf_dir):
    return rounded(sc.f_scores(_stats(spark, sf_dir), _SCALED[1:]))


# --------------------------------------------------------- blends and errors
_BLEND = {"rf": 0.35, "et": 0.25, "xgb": 0.25, "ridge": 0.15}
_BASE_BLEND = {"rf": 0.3, "xgb": 0.3, "et": 0.25, "ridge": 0.15}
_OPT_RULES = [
    (4, {"rf": 0.25, "et": 0.2, "xgb": 0.25, "lgb": 0.15, "gb": 0.1, "en": 0.05}),
    (3, {"rf": 0.35, "et": 0.25, "xgb": 0.25, "gb": 0.15}),
]
_MEMBERS = ["rf", "et", "xgb", "ridge"]


def _weights(w: dict[str, float]) -> str:
    return "CASE model " + " ".join(f"WHEN '{m}' THEN {v}::DOUBLE" for m, v in w.items()) + " END"


@query("fixed_blend_E1", PREDICTIONS + f"SELECT sample_id, {s6(f'sum(prediction * {_weights(_BASE_BLEND)})')} AS prediction FROM predictions GROUP BY sample_id")
def fixed_blend(spark, sf_dir):
    return rounded(en.weighted_sum(predictions(spark, sf_dir), _BASE_BLEND, _MEMBERS))


def _mean_sql(w: dict[str, float]) -> str:
    x = _weights(w)
    return f"SELECT sample_id, {s6(f'sum(prediction * {x}) / sum({x})')} AS prediction FROM predictions GROUP BY sample_id"


@query("weighted_blend_E2", PREDICTIONS + _mean_sql(_BLEND))
def weighted_blend(spark, sf_dir):
    weights = en.pick_weights(_MEMBERS, [(3, _BLEND)])
    return rounded(en.weighted_mean(predictions(spark, sf_dir), weights))


@query("unweighted_member_blend_E2", PREDICTIONS + _mean_sql({"rf": 0.25, "et": 0.2, "xgb": 0.25}))
def unweighted_member_blend(spark, sf_dir):
    """Four members, of which ridge has no weight under the rule for four."""
    weights = en.pick_weights(_MEMBERS, _OPT_RULES)
    return rounded(en.weighted_mean(predictions(spark, sf_dir), weights))


@query("two_member_blend_E2", PREDICTIONS + "SELECT sample_id, " + s6("avg(prediction)") + " AS prediction FROM predictions WHERE model IN ('rf', 'et') GROUP BY sample_id")
def two_member_blend(spark, sf_dir):
    """Too few members for any rule: equal weights."""
    members = ["rf", "et"]
    rows = predictions(spark, sf_dir).where(F.col("model").isin(members))
    return rounded(en.weighted_mean(rows, en.pick_weights(members, _OPT_RULES)))


@query("mean_blend_E3", PREDICTIONS + f"SELECT sample_id, {s6('avg(prediction)')} AS prediction FROM predictions GROUP BY sample_id")
def mean_blend(spark, sf_dir):
    return rounded(en.plain_mean(predictions(spark, sf_dir)))


@query("performance_weights_E4", with_tables(
    "predictions", e="SELECT model, avg(abs(prediction - price)) AS mae FROM predictions GROUP BY model",
) + f"SELECT model, {s6('mae')} AS mae, {s6('(1 / (1 + mae)) / sum(1 / (1 + mae)) OVER ()')} AS weight FROM e")
def performance_weights(spark, sf_dir):
    return rounded(en.performance_weights(predictions(spark, sf_dir)))


@query("no_member_E6", PREDICTIONS + "SELECT CAST(count(*) AS BIGINT) AS rows, 'no models available for prediction' AS refused FROM predictions")
def no_member(spark, sf_dir):
    """Blending nothing is refused before any job."""
    try:
        en.pick_weights([], _OPT_RULES)
        message = None
    except en.NoModelError as exc:
        message = str(exc)
    return predictions(spark, sf_dir).agg(F.count(F.lit(1)).alias("rows")).withColumn("refused", F.lit(message))


_METRIC_SQL = {
    "mae": "avg(abs(prediction - price))",
    "rmse": "sqrt(avg(pow(prediction - price, 2)))",
    "smape": "avg(CASE WHEN abs(prediction) + abs(price) = 0 THEN 0 ELSE abs(prediction - price) / ((abs(prediction) + abs(price)) / 2) END) * 100",
    "r2": "1 - sum(pow(prediction - price, 2)) / (var_pop(price) * count(*))",
}


def _add_metric(name: str, metrics: tuple[str, ...]) -> None:
    columns = ", ".join(f"{s6(_METRIC_SQL[m])} AS {m}" for m in metrics)

    @query(name, PREDICTIONS + f"SELECT model, {columns} FROM predictions GROUP BY model")
    def run(spark, sf_dir):
        return rounded(me.score(predictions(spark, sf_dir), metrics))


_add_metric("mae_Q1", ("mae",))
_add_metric("rmse_Q2", ("rmse",))
_add_metric("smape_Q3", ("smape",))
_add_metric("r2_Q4", ("r2",))


@query("score_report_Q5", PREDICTIONS + "SELECT model, " + ", ".join(f"{s6(e)} AS {m}" for m, e in _METRIC_SQL.items()) + " FROM predictions GROUP BY model")
def score_report(spark, sf_dir):
    rows = predictions(spark, sf_dir)
    return rounded(me.score_against(rows.drop("price"), priced(spark, sf_dir)))


@query("random_prices_M7", CAT + f"SELECT sample_id, {s6(f'round(5.0::DOUBLE + 495.0::DOUBLE * ({_DRAW_NUMBER} / 268435456.0::DOUBLE), 2)')} AS price FROM catalog")
def random_prices(spark, sf_dir):
    return rounded(uf.random_prices(catalog(spark, sf_dir)))


# --------------------------------------------------------------- user hooks
@query("row_predictor_U1", CAT + f"SELECT sample_id, {s6('length(catalog_content) + coalesce(length(image_link), 0) + sample_id % 7')} AS price FROM catalog")
def row_predictor(spark, sf_dir):
    def predictor(sample_id, catalog_content, image_link):
        return len(catalog_content) + len(image_link or "") + sample_id % 7

    return rounded(uf.predict_rows(catalog(spark, sf_dir), predictor))


@query("row_function_U2", "SELECT doc_id, CAST(length(text) AS BIGINT) AS length, CAST(len(string_split(text, ' ')) AS BIGINT) AS pieces FROM documents")
def row_function(spark, sf_dir):
    def measure(text):
        return {"length": len(text), "pieces": len(text.split(" "))}

    return uf.map_rows(table(spark, sf_dir, "documents"), measure, "text", "doc_id", "doc_id long, length long, pieces long")


@query("chunk_function_S11", "SELECT doc_id, CAST(length(text) AS BIGINT) AS length FROM documents")
def chunk_function(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ri.map_chunks(
        docs, lambda b: b.assign(length=b["text"].str.len())[["doc_id", "length"]], "doc_id long, length long", "doc_id"
    )


@query("batched_inference_U3", "SELECT vec_id, " + s6("list_max(embedding)") + " AS score FROM embeddings")
def batched_inference(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")

    def load():
        return lambda batch: [float(max(v)) for v in batch]

    return rounded(im.map_batches(rows, "embedding", None, "vec_id long, score double", "score", ["vec_id"], 32, load))


# ------------------------------------------------------------------- images
@query("fetch_plan_I1", FILES + f"""
SELECT file_name, min(image_link) AS image_link, CAST(count(DISTINCT image_link) AS BIGINT) AS links
FROM (SELECT image_link, {_NAME} AS file_name FROM catalog WHERE image_link IS NOT NULL)
WHERE file_name NOT IN (SELECT file_name FROM image_files) GROUP BY file_name""")
def fetch_plan(spark, sf_dir):
    return im.fetch_plan(catalog(spark, sf_dir), image_files(spark, sf_dir), tasks=8)


@query("page_fetch_plan_I1", """
SELECT file_name, min(url) AS image_link, CAST(count(DISTINCT url) AS BIGINT) AS links
FROM (SELECT url, string_split(regexp_replace(url, '/+$', ''), '/')[-1] AS file_name FROM pages) GROUP BY file_name""")
def page_fetch_plan(spark, sf_dir):
    return im.fetch_plan(table(spark, sf_dir, "pages"), link="url")


@query("fetch_I2", CAT + """
SELECT image_link, string_split(image_link, '/')[-1] AS file_name,
  CASE WHEN number % 10 = 0 THEN NULL ELSE CAST(length(image_link) AS BIGINT) END AS bytes,
  CASE WHEN number % 10 = 0 THEN 'OSError: gone' ELSE NULL END AS error
FROM (SELECT DISTINCT image_link, CAST(regexp_extract(image_link, '([0-9]+).jpg', 1) AS BIGINT) AS number FROM catalog WHERE image_link IS NOT NULL)""")
def fetch(spark, sf_dir):
    """A stand-in for the network that fails on every tenth name."""
    def get(url: str) -> bytes:
        if url.endswith("0.jpg"):
            raise OSError("gone")
        return url.encode()

    got = im.fetch(im.fetch_plan(catalog(spark, sf_dir)), get)
    return got.select("image_link", "file_name", F.length("content").cast("long").alias("bytes"), "error")


def _headers(spark, sf_dir):
    """PNG headers whose sides come from the parts, some broken, some small."""
    side = F.lpad(F.hex(F.col("p_size") + 10), 8, "0")
    png = F.unhex(F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), side, side))
    return table(spark, sf_dir, "part").select(
        F.concat(F.col("p_partkey").cast("string"), F.lit(".png")).alias("file_name"),
        F.when(F.col("p_partkey") % 11 == 0, F.lit(20 * 1024 * 1024)).otherwise(F.col("p_size")).cast("long").alias("length"),
        F.when(F.col("p_partkey") % 7 == 0, F.encode(F.lit("no image"), "utf-8")).otherwise(png).alias("content"),
        "p_size",
    )


_STATUS = (
    "SELECT concat(CAST(p_partkey AS VARCHAR), '.png') AS file_name, p_size, CASE WHEN p_partkey % 11 = 0 THEN 'large' "
    "WHEN p_partkey % 7 = 0 THEN 'unreadable' WHEN p_size + 10 < 32 THEN 'small' ELSE 'ok' END AS status FROM part"
)


def _size_of(content: bytes) -> tuple[int, int] | None:
    """Width and height of the stand-in images."""
    return (int.from_bytes(content[16:20], "big"), int.from_bytes(content[20:24], "big")) if content[:4] == b"\x89PNG" else None


@query("image_guards_I3", f"WITH s AS ({_STATUS}) SELECT status, CAST(count(*) AS BIGINT) AS files FROM s GROUP BY status")
def image_guards(spark, sf_dir):
    done = im.embed_images(_headers(spark, sf_dir), lambda contents: [[1.0] * 4 for _ in contents], width=4, size_of=_size_of)
    return done.groupBy("status").agg(F.count(F.lit(1)).alias("files"))


@query("image_embedding_I4", f"WITH s AS ({_STATUS}) SELECT file_name, CASE WHEN status = 'ok' THEN CAST(p_size + 10 AS DOUBLE) ELSE 0.0 END + 0.0 AS first, CAST(8 AS BIGINT) AS width FROM s")
def image_embedding(spark, sf_dir):
    def embed(contents):
        return [[float(_size_of(c)[0])] * 8 for c in contents]

    done = im.embed_images(_headers(spark, sf_dir), embed, width=8, size_of=_size_of)
    return done.select(
        "file_name", (F.element_at("embedding", 1).cast("double") + 0.0).alias("first"),
        F.size("embedding").cast("long").alias("width"),
    )


@query("image_path_J4", with_tables("catalog") + f"""
, files AS (SELECT DISTINCT p_partkey % 400 AS n FROM part),
linked AS (SELECT sample_id, CAST(regexp_extract(image_link, '([0-9]+).jpg', 1) AS BIGINT) AS n FROM catalog)
SELECT sample_id, CASE WHEN f.n IS NULL OR f.n % 50 = 7 THEN 0.0::DOUBLE ELSE CAST(f.n AS DOUBLE) + 1 END AS first
FROM linked LEFT JOIN files f USING (n)""")
def image_path(spark, sf_dir):
    """From links and files to a vector per row; images that cannot be decoded give zeros alone."""
    number = F.col("p_partkey") % 400
    files = table(spark, sf_dir, "part").select(number.alias("n")).distinct().select(
        F.concat(F.col("n").cast("string"), F.lit(".jpg")).alias("file_name"),
        F.length(F.col("n").cast("string")).cast("long").alias("length"),
        F.encode(F.col("n").cast("string"), "utf-8").alias("content"),
    )

    def embed(contents):
        numbers = [int(c) for c in contents]
        if any(n % 50 == 7 for n in numbers):
            raise ValueError("cannot decode")
        return [[n + 1.0, 0.5] for n in numbers]

    out = im.attach_images(catalog(spark, sf_dir), files, embed, 2)
    return out.select("sample_id", F.element_at("embedding", 1).cast("double").alias("first"))


@query("image_extensions_I5", """
WITH f AS (SELECT lower(['jpg', 'PNG', 'jpeg', 'txt'][p_size % 4 + 1]) AS extension FROM part)
SELECT extension, CAST(count(*) AS BIGINT) AS files FROM f WHERE extension IN ('jpg', 'jpeg', 'png') GROUP BY extension""")
def image_extensions(spark, sf_dir):
    names = table(spark, sf_dir, "part").select(
        F.concat(F.col("p_partkey").cast("string"), F.lit("."),
                 F.element_at(F.array(*[F.lit(x) for x in ("jpg", "PNG", "jpeg", "txt")]), (F.col("p_size") % 4 + 1).cast("int"))).alias("file_name")
    )
    return im.count_by_extension(names)


@query("image_listing_S8")
def image_listing(spark, sf_dir):
    """Files in a folder with path, name and length; here the table's own files."""
    files = im.list_images(spark, sf_dir, "*.parquet")
    return files.select("file_name", "length")
