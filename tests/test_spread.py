"""Work dealt over tasks, and done once a row."""

import re

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from checks import model_queries as mq
from tagwright.operators import tfidf as tv
from tagwright.plans import models as mo
from tagwright.workspace import spread
from tests.conftest import plan_of

SETTINGS = tv.TfidfSettings(50, (1, 3), 1, None, True, "word")


@pytest.fixture(scope="module")
def docs(spark):
    texts = ["red green blue red", "green blue", None, "", "red red red green blue yellow", "blue yellow green red"]
    return spark.createDataFrame(list(enumerate(texts)), "sample_id long, catalog_content string").repartition(5)


def test_a_table_in_one_row_group_is_dealt(spark, tmp_path):
    spark.range(6000).withColumn("v", F.col("id") % 7).coalesce(1).write.parquet(str(tmp_path / "one"))
    read = spark.read.parquet(str(tmp_path / "one"))
    dealt = spread(read, 1000)
    held = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert max(held) < 1000 and sum(held) == 6000
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, read.collect()))
    assert "Exchange" not in plan_of(spread(read, 6000))


def test_cells_of_vectors_are_their_entries(spark):
    rows = [(1, Vectors.sparse(6, [1, 4], [0.5, 0.0])), (2, Vectors.dense([0.0, 2.0, 3.0])), (3, Vectors.sparse(6, [], [])),
            (4, Vectors.dense([])), (5, Vectors.sparse(6, [0, 5], [-1.0, 7.0]))]
    df = spark.createDataFrame(rows, ["k", "v"])
    full = df.select("k", F.posexplode(vector_to_array("v")).alias("idx", "weight")).where("weight != 0")
    assert sorted(map(tuple, tv.vector_cells(df, "v", ["k"]).collect())) == sorted(map(tuple, full.collect()))


def test_query_does_not_fill_vectors_up(spark, sf_dir):
    from checks.registry import QUERIES

    assert "vector_to_array" not in QUERIES["tfidf_vectors_plain_V9"](spark, sf_dir)._jdf.queryExecution().toString()


def test_length_is_added_up_once_a_row(spark, docs):
    vocabulary = tv.fit_vocabulary(docs, SETTINGS)
    plan = tv.tfidf_weights(docs, vocabulary)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 1
    assert not re.search(r"lambdafunction\(\(lambda \w+#\d+ / SQRT", plan)


def test_shorter_runs_are_made_once(spark, docs):
    plan = tv.with_terms(docs, SETTINGS, "catalog_content", ["sample_id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("zip_with(") == 2


@pytest.mark.parametrize("tasks", [1, 40])
def test_summaries_of_many_tasks_merge(spark, docs, tasks):
    terms = tv.with_terms(docs.repartition(tasks), SETTINGS, "catalog_content", ["sample_id"])
    listed, occurrences, _ = tv.heavy_terms(terms, 64)
    counts = {r["t"]: r["count"] for r in terms.select(F.explode("terms").alias("t")).groupBy("t").count().collect()}
    assert dict(listed) == counts and occurrences == sum(counts.values())
    assert tv.heavy_terms(terms.where("false"), 64)[:2] == ([], 0)


def test_deep_trees_remember_nodes():
    assert mo.random_forest(50, 30).getCacheNodeIds() and mo.extra_trees(80, 20).getCacheNodeIds()
    assert not mo.random_forest(8, 5).getCacheNodeIds()


def test_text_features_of_models_are_written_once(spark, sf_dir):
    assert "regexp" not in mq._vectors(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString().lower()
