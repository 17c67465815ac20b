"""Row work, joins, quantiles, indexes and folds, with the skewed cases forced."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagwright import workspace
from tagwright.operators import ensemble, images, joins, metrics, profile, quantiles, row_index, rows, splits
from tagwright.operators.quantiles import exact_quantiles, group_quantiles
from tagwright.sources import catalog_csv as cs
from tests.conftest import plan_of

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def numbers(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, x double").repartition(5)


SERIES = {
    "uniform": [random.Random(1).random() for _ in range(3001)],
    "ties": [5.0] * 2000 + [random.Random(2).random() * 10 for _ in range(1000)],
    "few": [1.0, 2.0],
    "one": [3.0],
    "same": [4.0] * 50,
    "heavy tail": [10 ** random.Random(i).uniform(-8, 12) for i in range(1500)],
    "with nulls": [None, 1.0, None, 2.5, 9.0],
}


@pytest.mark.parametrize("name", SERIES)
@pytest.mark.parametrize("sketch", [10_000, 20])
def test_quantiles(spark, name, sketch, monkeypatch):
    """Also with a sketch so coarse that many values lie inside its brackets."""
    monkeypatch.setattr(quantiles, "_SKETCH", sketch)
    monkeypatch.setattr(quantiles, "_SLACK", 2.0 / sketch)
    values = SERIES[name]
    got = exact_quantiles(numbers(spark, values), ["x"], PROBS)["x"]
    known = [v for v in values if v is not None]
    assert got == pytest.approx(list(np.quantile(known, PROBS)), rel=1e-12)


def test_quantiles_when_the_sketch_misses(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "_sketch", lambda v, probs: F.array(*[F.max(v)] * (2 * len(probs))))
    values = SERIES["uniform"]
    assert exact_quantiles(numbers(spark, values), ["x"], PROBS)["x"] == pytest.approx(list(np.quantile(values, PROBS)), rel=1e-12)
    got = group_quantiles(numbers(spark, values).withColumn("g", F.lit("a")), "x", PROBS, "g").first()["quantiles"]
    assert got == pytest.approx(list(np.quantile(values, PROBS)), rel=1e-12)


def test_quantiles_of_nothing(spark):
    empty = numbers(spark, [None, None])
    assert exact_quantiles(empty, ["x"], [0.5])["x"] == [None]
    assert [r["quantiles"] for r in group_quantiles(empty.withColumn("g", F.lit(1)), "x", [0.5], "g").collect()] == [None]


def test_group_quantiles(spark):
    rng = random.Random(3)
    data = [("hot", rng.gauss(0, 1)) for _ in range(2000)] + [("cold", rng.random()) for _ in range(50)]
    data += [(None, rng.random()) for _ in range(500)] + [("none", None)]
    df = spark.createDataFrame(data, "g string, x double")
    got = {r["g"]: r["quantiles"] for r in group_quantiles(df, "x", [0.25, 0.5], "g").collect()}
    for g in ("hot", "cold", None):
        want = np.quantile([x for k, x in data if k == g], [0.25, 0.5])
        assert got[g] == pytest.approx(list(want), rel=1e-12)
    assert got["none"] is None


def _jobs(spark, group, work):
    """Jobs started under ``group`` while ``work`` runs."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_jobs_do_not_grow_with_groups_or_columns(spark):
    df = spark.range(20_000).select((F.col("id") % 1000).alias("many"), (F.col("id") % 10).alias("few"), F.rand(1).alias("x"))
    few, many = (_jobs(spark, g, lambda g=g: group_quantiles(df, "x", [0.5], g).collect()) for g in ("few", "many"))
    assert abs(few - many) <= 2  # adaptive execution may read a shuffle once more
    wide = df.select("x", *[(F.col("x") + i).alias(f"x{i}") for i in range(29)])
    assert _jobs(spark, "wide", lambda: exact_quantiles(wide, wide.columns, [0.5])) <= _jobs(
        spark, "narrow", lambda: exact_quantiles(wide, ["x"], [0.5])) + 2


def test_folds_are_projections(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n = docs.count()
    for make in (splits.contiguous_folds, splits.shuffled_folds):
        df = make(docs, 3, "doc_id")
        assert "Exchange" not in plan_of(df)
        assert sorted(r["count"] for r in df.groupBy("fold").count().collect()) == sorted(n // 3 + (i < n % 3) for i in range(3))
    for df in (splits.positional_split(docs, 0.7, "doc_id"), splits.random_split(docs, 0.2, "doc_id")):
        assert "Exchange" not in plan_of(df)


def test_row_index_any_partitioning_with_one_hot_order_value(spark):
    data = [(i, 0 if i % 3 else i) for i in range(2000)]
    random.Random(4).shuffle(data)
    want = {k: n for n, (_, k) in enumerate(sorted((o, k) for k, o in data))}
    for parts in (1, 7):
        df = spark.createDataFrame(data, "sample_id long, o long").repartition(parts)
        got = row_index.key_index(df, "sample_id", [F.col("o")]).collect()
        assert {r["sample_id"]: r["row_index"] for r in got} == want


def test_no_single_task_windows(spark, catalog):
    for df in (
        row_index.key_index(catalog, "sample_id"), splits.stratified_folds(catalog),
        splits.contiguous_folds(catalog), splits.time_blocks(catalog, "price", "sample_id"),
    ):
        plan = plan_of(df)
        assert "Window" not in plan and "CartesianProduct" not in plan


def test_stratified_folds_are_even(spark, catalog):
    sizes = splits.stratified_folds(catalog).groupBy("bin", "fold").count().collect()
    for b in {r["bin"] for r in sizes}:
        counts = [r["count"] for r in sizes if r["bin"] == b]
        assert max(counts) - min(counts) <= 1


def test_price_bins_of_equal_prices(spark):
    df = numbers(spark, [4.0] * 5)
    assert {r["bin"] for r in splits.price_bins(df, 5, "x").collect()} == {2}


def test_keep_first_with_a_hot_text(spark):
    data = [(i, "hot" if i % 3 else f"t{i % 50}") for i in range(1, 900)] + [(1000, None), (1001, None)]
    df = spark.createDataFrame(data, "sample_id long, catalog_content string")
    first = {}
    for i, t in data:
        first.setdefault(t, i)
    got = {r["catalog_content"]: r["sample_id"] for r in rows.keep_first(df, ["catalog_content"]).collect()}
    assert got == first


def test_sample_is_repeatable(spark, catalog):
    one = {r[0] for r in rows.sample_rows(catalog, 50).select("sample_id").collect()}
    two = {r[0] for r in rows.sample_rows(catalog.repartition(7), 50).select("sample_id").collect()}
    other = {r[0] for r in rows.sample_rows(catalog, 50, seed=7).select("sample_id").collect()}
    assert one == two and len(one) == 50 and one != other


@pytest.mark.parametrize("parts", [1, 8, 100])
def test_left_join_unique_keeps_every_row(spark, parts):
    left = spark.createDataFrame(
        [(i, None if i % 5 == 0 else "hot" if i % 3 else f"k{i % 40}") for i in range(600)], "id long, k string"
    )
    right = spark.createDataFrame([("hot", 1), *[(f"k{i}", i) for i in range(0, 40, 2)]], "k string, v long")
    got = joins.left_join_unique(left, right, "k", parts)
    want = left.join(right, "k", "left").select("id", "k", "v")
    assert got.count() == 600
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_vocabulary_join_keeps_known_terms(spark):
    terms = spark.createDataFrame([("a",), ("b",), ("a",)], "term string")
    assert [r[0] for r in joins.known_terms(terms, terms.where("term = 'a'").distinct()).collect()] == ["a", "a"]


def test_iqr_filter_reaches_the_scan(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    plan = plan_of(profile.drop_outliers(df.select("l_orderkey", "l_extendedprice"), "l_extendedprice"))
    assert "GreaterThanOrEqual(l_extendedprice" in plan and "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in plan


def test_correlation_without_spread_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert profile.correlation(df, "a", "b").first()[0] is None


def test_histogram_closes_its_last_bin(spark):
    h = profile.histogram(numbers(spark, [0.0, 1.0, 2.0, 3.0]), "x", 3).orderBy("bin").collect()
    assert [r["rows"] for r in h] == [1, 1, 2]
    same = profile.histogram(numbers(spark, [7.0] * 4), "x", 4).collect()
    assert sum(r["rows"] for r in same) == 4


def test_smape_of_zero_pairs(spark):
    df = spark.createDataFrame([("m", 0.0, 0.0), ("m", 1.0, 0.0), ("m", 0.0, 1.0)], "model string, prediction double, price double")
    assert metrics.score(df, ("smape",)).first()["smape"] == pytest.approx(400 / 3)


def test_weight_rules():
    rules = [(4, {"a": 0.5, "b": 0.5}), (3, {"a": 1.0})]
    assert ensemble.pick_weights(["a", "b", "c", "d"], rules) == {"a": 0.5, "b": 0.5}
    assert ensemble.pick_weights(["a", "b", "c"], rules) == {"a": 1.0}
    assert ensemble.pick_weights(["b", "c"], rules) == {"b": 0.5, "c": 0.5}
    with pytest.raises(ensemble.NoModelError):
        ensemble.pick_weights([], rules)


def test_fixed_weights_need_all_members(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "sample_id long, model string, prediction double")
    with pytest.raises(ensemble.NoModelError):
        ensemble.weighted_sum(df, {"a": 0.5, "b": 0.5}, ["a"])


def test_csv_round_trip(spark):
    data = [(1, 'a "quoted", text\nwith lines', None, 2.5), (2, "  padded  ", "http://x/1.jpg", -1.0), (3, None, "", None)]
    df = spark.createDataFrame(data, cs.LABELLED)
    path = workspace.scratch_path(spark, "csv")
    cs.write_csv(df, path)
    got = [tuple(r) for r in cs.read_labelled(spark, path).orderBy("sample_id").collect()]
    assert got == [data[0], data[1], (3, None, None, None)]
    table = cs.to_parquet(spark, path, workspace.scratch_path(spark, "pq"), cs.LABELLED)
    assert table.count() == 3


def test_checks(spark, catalog):
    assert cs.check_columns(catalog, ["price"]) is catalog
    with pytest.raises(ValueError, match="brand"):
        cs.check_columns(catalog, ["brand"])
    with pytest.raises(ValueError, match="empty input: b"):
        cs.check_not_empty(a=catalog, b=catalog.limit(0))


def test_shared_folder_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = workspace.shared_folder(spark)
    assert folder == named if named else folder
    assert workspace.scratch_path(spark, "x") != workspace.scratch_path(spark, "x")
    assert spark.sparkContext.getCheckpointDir()


def test_shared_folder_without_the_setting_is_under_the_warehouse(spark):
    if not spark.conf.get("spark.checkpoint.dir", None):
        assert workspace.shared_folder(spark).startswith(spark.conf.get("spark.sql.warehouse.dir").rstrip("/"))


# ------------------------------------------------------------------- images
def png(width, height):
    return b"\x89PNG\r\n\x1a\n\x00\x00\x00\rIHDR" + width.to_bytes(4, "big") + height.to_bytes(4, "big")


def size_of(content):
    if content[:4] != b"\x89PNG":
        raise ValueError("not a PNG")
    return int.from_bytes(content[16:20], "big"), int.from_bytes(content[20:24], "big")


def test_images_from_files(spark, tmp_path):
    for name, content in {"a.png": png(64, 64), "b.jpg": png(10, 10), "c.jpeg": b"x", "d.txt": b"y", "e.png": png(99, 99)}.items():
        (tmp_path / name).write_bytes(content)
    files = images.list_images(spark, str(tmp_path))
    counts = {r["extension"]: r["files"] for r in images.count_by_extension(files).collect()}
    assert counts == {"png": 2, "jpg": 1, "jpeg": 1}

    def run(embed, **more):
        return {r["file_name"]: (r["status"], r["embedding"]) for r in images.embed_images(files, embed, width=2, **more).collect()}

    ones, none = [1.0, 2.0], [0.0, 0.0]
    got = run(lambda cs_: [ones for _ in cs_], size_of=size_of)
    assert got == {"a.png": ("ok", ones), "b.jpg": ("small", none), "c.jpeg": ("unreadable", none),
                   "d.txt": ("unreadable", none), "e.png": ("ok", ones)}
    # without a guard the decoder decides what it can read
    assert run(lambda cs_: [ones for _ in cs_])["c.jpeg"] == ("ok", ones)

    def picky(contents):
        if any(c == png(99, 99) for c in contents):
            raise RuntimeError("cannot decode")
        return [ones for _ in contents]

    # one bad file does not take its batch along
    assert {n: s for n, (s, _) in run(picky).items()} == {
        "a.png": "ok", "b.jpg": "ok", "c.jpeg": "ok", "d.txt": "ok", "e.png": "failed"}
    assert run(lambda cs_: [[1.0] for _ in cs_])["a.png"] == ("failed", none)
    assert run(lambda cs_: [ones])["a.png"] == ("ok", ones)
    large = run(lambda cs_: [ones for _ in cs_], max_bytes=1)
    assert large["a.png"] == ("large", none) and large["c.jpeg"] == ("ok", ones)


def test_length_filter_reaches_the_scan(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(png(64, 64))
    plan = plan_of(images.embed_images(images.list_images(spark, str(tmp_path)), lambda c: c, width=2))
    assert "LessThanOrEqual(length" in plan


def test_images_from_links_to_rows(spark, tmp_path):
    (tmp_path / "1.png").write_bytes(png(64, 64))
    df = spark.createDataFrame([(1, "http://x/1.png"), (2, "http://y/1.png"), (3, "http://x/2.png"), (4, None)], "sample_id long, image_link string")
    out = images.attach_images(df, images.list_images(spark, str(tmp_path)), lambda cs_: [[3.0, 4.0] for _ in cs_], 2)
    assert {r["sample_id"]: r["embedding"] for r in out.collect()} == {1: [3.0, 4.0], 2: [3.0, 4.0], 3: [0.0, 0.0], 4: [0.0, 0.0]}


def test_fetch_plan_counts_colliding_names(spark):
    links = [("http://a/1.jpg",), ("http://b/1.jpg",), ("http://a/2.jpg",), ("http://a/2.jpg",), (None,), ("http://c/x/",)]
    df = spark.createDataFrame(links, "image_link string")
    plan = {r["file_name"]: (r["image_link"], r["links"]) for r in images.fetch_plan(df).collect()}
    assert plan == {"1.jpg": ("http://a/1.jpg", 2), "2.jpg": ("http://a/2.jpg", 1), "x": ("http://c/x/", 1)}


def test_images_are_chosen_before_they_are_read(spark, tmp_path):
    """Two folders with one name, a file that no link names, one that is gone: no exchange carries bytes."""
    for folder, name, data in (("b", "x.jpg", b"22"), ("a", "x.jpg", b"1"), ("a", "no link.jpg", b"3"), ("a", "y z.jpg", b"4444")):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_bytes(data)
    files = images.list_images(spark, f"{tmp_path}/*")
    df = spark.createDataFrame([(1, "http://h/x.jpg"), (2, "http://h/y z.jpg"), (3, "http://h/none.jpg"), (4, None)], "sample_id long, image_link string")
    lengths = lambda contents: [[float(len(c)), 0.0] for c in contents]
    got = {r["sample_id"]: r["embedding"][0] for r in images.attach_images(df, files, lengths, 2).collect()}
    assert got == {1: 1.0, 2: 4.0, 3: 0.0, 4: 0.0}
    listing = files.select("file_name", "path", "length")
    done = images.embed_images(listing, lengths, 2)
    assert "content" not in plan_of(done)
    gone = spark.createDataFrame([("q.jpg", f"file:{tmp_path}/a/q.jpg", 4)], "file_name string, path string, length long")
    assert [r["status"] for r in images.embed_images(gone, lengths, 2).collect()] == ["unreadable"]
