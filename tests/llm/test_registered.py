"""The registered queries and the pipeline on the smallest tables, against plain Python."""

import math
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tagwright.llm import pii
from tagwright.llm.queries import ORACLES, PII_KEY, QUERIES
from tests.llm import plain

BYTE_BPE, WORD_BPE = (Tokenizer.from_file(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


def run(name, spark, sf_dir):
    found = QUERIES[name](spark, sf_dir).collect()
    return found if name == "op8_packing" else {r.doc_id: r for r in found}


def test_one_query_each():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


def test_lm_scoring(spark, sf_dir, rows):
    got, want = run("op1_lm_scoring", spark, sf_dir), plain.base_scores(rows)
    assert len(got) == len(rows)
    for i, (n, known, total, base) in want.items():
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (n, known, total)
        assert math.isclose(got[i].base_score, base, rel_tol=1e-9)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_substring(spark, sf_dir, rows):
    got = run("op3_substring_dedup", spark, sf_dir)
    assert {i: (r.n_words, r.n_removed, r.kept_sha256) for i, r in got.items()} == {
        i: (n, gone, plain.sha(kept)) for i, (n, gone, kept) in plain.substring(rows).items()}


def test_bpe(spark, sf_dir, rows):
    got = run("op4_bpe_round_trip", spark, sf_dir)
    for i, t in rows:
        ids = BYTE_BPE.encode(t or "", add_special_tokens=False).ids
        import hashlib

        want = len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), plain.sha(t or "")
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == want


@pytest.mark.parametrize("name, label, least", [("op5_quality_classifier", "quality", 0.9), ("op7_toxicity", "toxic", 0.85)])
def test_held_out_accuracy(spark, sf_dir, rows, name, label, least):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    got = run(name, spark, folder)
    known = {r.doc_id: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [i for i in known if got[i].held_out]
    assert sum(got[i].predicted == known[i] for i in held) >= least * len(held)


def test_line_counts(spark, sf_dir, rows):
    for i, t in rows:
        r = (got := run("op6_quality_rules", spark, sf_dir) if i == rows[0][0] else got)[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain.line_counts(t)


def test_packing(spark, sf_dir, rows):
    check_pieces(run("op8_packing", spark, sf_dir), rows)


def check_pieces(pieces, rows):
    ids = {i: WORD_BPE.encode(t or "", add_special_tokens=False).ids + [2] for i, t in rows}
    fill, seen = {}, {i: 0 for i in ids}
    for r in pieces:
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
        seen[r.doc_id] += r.length
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert seen == {i: len(x) for i, x in ids.items()} and max(fill.values()) <= 4096
    assert len(fill) <= sum(seen.values()) / 4096 + 2


def test_pii_leaves_no_address(spark, sf_dir, rows):
    import re

    got = run("op9_pii", spark, sf_dir)
    for i, t in rows:
        for found in re.findall(r"[\w.]+@[\w.]+\w|\b\d{1,3}(?:\.\d{1,3}){3}\b|\+\d \(\d{3}\) \d{3}-\d{4}", t):
            assert found not in got[i].text


def test_ngram_components(spark, sf_dir, rows):
    got = run("op10_ngram_jaccard", spark, sf_dir)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == plain.link_components(rows)


def test_pipeline(spark, sf_dir, rows):
    accepted = {i for i, r in run("op5_quality_classifier", spark, sf_dir).items() if r.predicted}
    kept = [(i, t) for i, t in rows if i in accepted]
    groups = plain.link_components(kept)
    kept = [(i, t) for i, t in kept if groups[i][1] == i]
    cut = plain.substring(kept)
    kept = [(i, cut[i][2] if cut[i][1] else t) for i, t in kept]
    masked = pii.pseudonymise(spark.createDataFrame(kept, "doc_id long, text string"), PII_KEY)
    check_pieces(corpus_pipeline.run(spark, sf_dir).collect(), [(r.doc_id, r.text) for r in masked.collect()])


def test_stages_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        bad = out.where("n_chars <> length(text)") if name != "quality classifier" else out.limit(0)
        assert bad.count() == 0, name


def test_conversation_trie(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = QUERIES["op11_conversation_trie"](spark, sf_dir).select(*plain.NODE).collect()
    assert sorted(map(tuple, got), key=str) == plain.trie(plain.rebuilt(map(tuple, turns)))


def test_embedding_whitening(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    plain.check_whitened(QUERIES["op12_embedding_whitening"](spark, sf_dir).collect(), [(r.vec_id, r.embedding) for r in rows])


def test_token_files(spark, sf_dir, rows):
    got, start = run("op13_token_files", spark, sf_dir), 0
    for i, t in sorted(rows):
        ids = BYTE_BPE.encode(t or "", add_special_tokens=False).ids + [2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), crc)
        start += len(ids)


def test_attention_beats_its_bias(spark, sf_dir):
    """What attention learned counts for more than the classes' shares alone, on texts that it did not see."""
    from tagwright.llm import lm_scoring

    docs = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet")
    full, bias = (
        lm_scoring.score_texts(docs, attend=attend).where("held_out").selectExpr("sum(score) / sum(n_tokens)").first()[0]
        for attend in (True, False)
    )
    assert full > bias + 0.1
