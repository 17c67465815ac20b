"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwright.llm import (
    bpe, conversation_trie, line_rules, lm_scoring, ngram_join, packing, pii, quality_crf, substring, token_files, top_k, toxicity_fm, whitening,
)
from tagwright.llm.frames import small_batches
from tagwright.workspace import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_lm_scoring")
def op1(spark, sf_dir):
    return lm_scoring.score_texts(table(spark, sf_dir, "documents"))


_TOP_K_SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.w, c.w) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""


@query("op2_exact_top_k", _TOP_K_SQL)
def op2(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", top_k.whole_weights(F.col("embedding")).alias("weights"))
    return top_k.top_k(vectors, vectors.where("vec_id % 100 = 0"))


@query("op3_substring_dedup")
def op3(spark, sf_dir):
    marked = substring.mark_repeated(table(spark, sf_dir, "documents").select("doc_id", "text"), join_all=True)
    return marked.select(
        "doc_id", F.col("__substring_n_words").alias("n_words"), F.col("__substring_n_removed").alias("n_removed"),
        F.sha2(F.col("__substring_kept").cast("binary"), 256).alias("kept_sha256"),
    )


@query("op4_bpe_round_trip")
def op4(spark, sf_dir):
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op5_quality_classifier")
def op5(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality_crf.score_quality(docs, quality_crf.train_quality(docs, table(spark, sf_dir, "labels")))


@query("op6_quality_rules")
def op6(spark, sf_dir):
    return line_rules.line_rules(table(spark, sf_dir, "documents")).drop("boilerplate")


@query("op7_toxicity")
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity_fm.score_toxicity(docs, toxicity_fm.train_toxicity(docs, table(spark, sf_dir, "labels")))


@query("op8_packing")
def op8(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


#: the secret of the registered query; a production run brings its own
PII_KEY = "tagwright-demo-key"


@query("op9_pii")
def op9(spark, sf_dir):
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


_JACCARD_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'
  ), lambda x: x <> '') AS w FROM documents
), shingles AS (
  SELECT doc_id, s FROM (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i+4], ' ')) END)) AS s FROM words)
), sizes AS (
  SELECT d.doc_id, count(s.s) AS n FROM documents d LEFT JOIN shingles s USING (doc_id) GROUP BY d.doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * c >= 75 * (a.n + b.n - c)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other
)
SELECT r.doc_id, ANY_VALUE(z.n) AS n_shingles, min(r.other) AS component_id
FROM reach r JOIN sizes z ON z.doc_id = r.doc_id GROUP BY r.doc_id"""


@query("op10_ngram_jaccard", _JACCARD_SQL)
def op10(spark, sf_dir):
    return ngram_join.similar_components(table(spark, sf_dir, "documents"))


@query("op13_token_files")
def op13(spark, sf_dir):
    docs, folder = table(spark, sf_dir, "documents"), scratch_path(spark, "token_files")
    written = token_files.write_ids(docs, public_tokenizers.path("byte_bpe_50k.json"), folder)
    return token_files.read_checksums(written, folder, docs.schema["doc_id"].dataType)


@query("op11_conversation_trie")
def op11(spark, sf_dir):
    numbered = conversation_trie.numbered_turns(table(spark, sf_dir, "conversations"))
    return conversation_trie.prefix_trie(*conversation_trie.rebuilt_turns(numbered))


@query("op12_embedding_whitening")
def op12(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", whitening.whole_vectors(F.col("embedding")).alias("vector"))
    return whitening.whiten(vectors, whitening.fit_whitening(vectors))
