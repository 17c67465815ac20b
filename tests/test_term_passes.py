"""Terms are found without replacing first, and terms outside the vocabulary are never listed."""

from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from checks import text_queries as tq
from tagwright.functions import text as tx
from tagwright.functions.cleaning import clean
from tagwright.operators import tfidf as tv
from tests.conftest import plan_of

TEXTS = [
    None, "", "   ", "a", "ab", "A.B-cd 12 x", "ÉTÉ Crème_Brûlée 250ml", "İstanbul ſtraße KELVIN K1", "a😀bc d ef\tgh\nij",
    "x" * 70 + " the and it's don't", "http://a.b/c?d=1 www.x.y now-and.then", "٣٤ ½½ __ _a", "été näive",
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")


@pytest.mark.parametrize("cleaner", ["ascii", "word", "word_dash_dot", "strict"])
@pytest.mark.parametrize("stop", [(), None])
def test_tokens_are_those_of_the_cleaned_text(odd, cleaner, stop):
    s = tv.TfidfSettings(cleaner=cleaner, stop_words=stop)
    text = tx.as_text(F.col("text"))
    both = odd.select("id", tv.cleaned_tokens(text, s).alias("now"), tv.tokens(clean(text, cleaner), s.stop_list).alias("cleaned"))
    rows = both.collect()
    assert len(rows) == len(TEXTS) and any(r["now"] for r in rows)
    assert all(r["now"] == r["cleaned"] for r in rows)


@pytest.mark.parametrize("settings", [tq.ENHANCED, tq.FAST, tq.WORDS])
def test_nothing_is_replaced_before_terms_are_found(odd, settings):
    assert "regexp_replace" not in plan_of(tv.with_terms(odd, settings, "text", ["id"]))


def test_counts_of_the_vocabulary_are_those_of_each_row(spark):
    texts = ["red green blue red", "green blue", None, "", "red red red green blue yellow", "zz top", "red green"]
    # a key that comes twice and one that is null keep rows of their own
    keys = [1, 2, 3, 4, 2, 5, None]
    df = spark.createDataFrame(list(zip(keys, texts)), "id long, t string")
    s = replace(tq.ENHANCED, max_features=6, min_df=1, max_df=None)
    vocabulary = tv.fit_vocabulary(df, s, text="t", key="id")
    want = Counter()
    for key, text in zip(keys, texts):
        w = ("nan" if text is None else text).split()
        counts = Counter(" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1))
        want.update((key, vocabulary.terms.index(t), n) for t, n in counts.items() if t in vocabulary.terms)
    found = tv.vocabulary_counts(df, vocabulary, text="t", key="id")
    assert Counter(map(tuple, found.collect())) == want
    assert found.dtypes == [("id", "bigint"), ("idx", "int"), ("tf", "bigint")]


def test_term_frequency_sorts_and_joins_nothing(spark, tmp_path):
    rows = [(i, "red green blue red" if i % 2 else "green yellow") for i in range(8)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = tq.term_frequency(spark, str(tmp_path))
    plan = plan_of(found)
    assert "sort_array" not in plan and "Join" not in plan
    assert {(r["doc_id"], r["tf"]) for r in found.collect() if r["tf"] > 1} == {(i, 2) for i in (1, 3, 5, 7)}
