"""Toxicity: a factorization machine over hashed terms.

Terms are the hashes of words and of their first four and five bytes, so that
families of inflected words share a term. The machine scores a document from
the terms it holds: a bias, a weight for each term and, for each pair of terms,
the inner product of their factors. The pairs see what single weights miss, an
insult next to the mention of a group.

Terms are chosen by how unevenly they occur over the labels of the training
sample: at most ``train_docs`` documents per label, by a hash of the key. That
sample and the number of terms are bounds of the model; scoring takes every
row's whole text. Null texts are empty and score the bias; keys with null or
contradicting labels teach nothing; repeated rows are scored each by itself;
without both labels every score is the share of toxic documents seen (else 0).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.llm.blocks import by_range
from tagwright.llm.frames import crc_part, map_texts
from tagwright.llm.quality_crf import labelled_sample
from tagwright.llm.words import Words, chunks, find, lower, mix

#: letters, digits and all bytes of characters beyond ASCII make up a term
_TERM_BYTES = np.zeros(256, bool)
_TERM_BYTES[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_PREFIXES = (4, 5)


@dataclass(frozen=True)
class ToxicitySettings:
    threshold: float = 0.7
    #: documents whose crc32(key) modulo ``folds`` is 1 teach nothing
    folds: int = 3
    train_docs: int = 5000
    n_terms: int = 1024
    min_docs: int = 5
    factors: int = 8
    rounds: int = 200


def terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct terms of each text: hashes, and the indices of their texts."""
    words = Words([lower(t) for t in texts], _TERM_BYTES)
    text = words.text_of()
    hashes, texts_of = [words.hashes()], [text]
    for length in _PREFIXES:
        long = words.ends - words.starts > length
        hashes.append(mix(words.hashes(length)[long] ^ np.uint64(length)))
        texts_of.append(text[long])
    return np.concatenate(hashes), np.concatenate(texts_of)


@dataclass(frozen=True)
class ToxicityModel:
    #: sorted hashes of the terms
    chosen: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def found(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Chosen terms in the texts, each once per text: text indices in order, term numbers."""
        if not len(self.chosen):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hashes, text = terms(texts)
        at, term = find(self.chosen, hashes)
        pairs = np.unique(text[at] * len(self.chosen) + term)
        return pairs // len(self.chosen), pairs % len(self.chosen)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        text, term = self.found(texts)
        logit = _logits(self.bias, self.weights, self.factors, text, term, len(texts))[0]
        return 1 / (1 + np.exp(-logit))


def _logits(bias, weights, factors, row, term, n):
    """The machine's output for each row, and its sums of factors."""
    logit = bias + np.bincount(row, weights[term], n)
    total = np.stack([np.bincount(row, factors[term, f], n) for f in range(factors.shape[1])], axis=1)
    square = np.bincount(row, (factors**2).sum(1)[term], n)
    return np.clip(logit + ((total**2).sum(1) - square) / 2, -40, 40), total


def fit(row, term, y, weight, n_terms, settings: ToxicitySettings):
    """Bias, weights and factors by Adam on the weighted logistic loss."""
    rng = np.random.default_rng(7)
    n, k = len(y), settings.factors
    params = np.concatenate([[0.0], np.zeros(n_terms), rng.normal(0, 0.05, n_terms * k)])
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, settings.rounds + 1):
        w, v = params[1 : n_terms + 1], params[n_terms + 1 :].reshape(n_terms, k)
        logit, total = _logits(params[0], w, v, row, term, n)
        error = (1 / (1 + np.exp(-logit)) - y) * weight
        by_term = np.bincount(term, error[row], n_terms)
        pull = np.stack([np.bincount(term, (error[:, None] * total)[row, f], n_terms) for f in range(k)], axis=1)
        grad = np.concatenate([[error.sum()], by_term, (pull - by_term[:, None] * v).ravel()]) / weight.sum()
        grad[1:] += 1e-5 * params[1:]
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        params = params - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return params[0], params[1 : n_terms + 1], params[n_terms + 1 :].reshape(n_terms, k)


#: value ranges of terms, each counted by one task
_RANGES = 64


def _best_terms(sizes: dict[int, int], settings: ToxicitySettings):
    """Of one range's terms those that occur most unevenly over the labels."""
    def run(table: pa.Table) -> pa.Table:
        join = lambda name, t: np.concatenate([np.frombuffer(b.as_py(), t) for b in table[name]])
        each, at = np.unique(join("terms", np.uint64), return_inverse=True)
        bad, good = (np.bincount(at, join(c, np.int64), len(each)) for c in ("bad", "good"))
        often = bad + good >= settings.min_docs
        each, b, g = each[often].view(np.int64), bad[often] / sizes[1], good[often] / sizes[0]
        score = (b - g) ** 2 / (b + g)
        best = np.lexsort((each, -score))[: settings.n_terms]
        return pa.table({"term": each[best], "score": score[best]})

    return run


def train_toxicity(
    docs: DataFrame, labels: DataFrame, settings: ToxicitySettings = ToxicitySettings(), key: str = "doc_id",
    text: str = "text", label: str = "toxic",
) -> ToxicityModel:
    held_out = lambda c: crc_part(c, settings.folds) == 1
    sample = labelled_sample(labels, label, key, held_out, settings.train_docs)
    share = labels.where(~held_out(F.col(key))).agg(F.avg(F.col(label).cast("double"))).first()[0]
    known = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    # at most 2 * train_docs rows of two numbers
    rows = known.join(F.broadcast(sample), "key").select("label", "text")

    def counts(batches):
        for batch, texts in chunks(batches):
            label = np.asarray(batch.column(0).to_numpy(zero_copy_only=False), np.int64)
            hashes, text_of = terms(texts)
            order = np.lexsort((hashes, text_of))
            hashes, text_of = hashes[order], text_of[order]
            new = np.ones(len(hashes), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (text_of[1:] != text_of[:-1])
            hashes, toxic = hashes[new], label[text_of[new]]
            each, at = np.unique(hashes, return_inverse=True)
            bad = np.bincount(at, toxic, len(each)).astype(np.int64)
            good = np.bincount(at, minlength=len(each)) - bad
            order, bounds = by_range(each, _RANGES)
            some = np.flatnonzero(np.diff(bounds))
            cut = lambda x: pa.array([x[order][bounds[r] : bounds[r + 1]].tobytes() for r in some], pa.binary())  # noqa: E731,B023
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), cut(each), cut(bad), cut(good)], names=["range", "terms", "bad", "good"]
            )

    sizes = {int(r["label"]): r["count"] for r in sample.groupBy("label").count().collect()}
    empty = ToxicityModel(np.zeros(0, np.uint64), -40.0, np.zeros(0), np.zeros((0, settings.factors)))
    if len(sizes) < 2:
        p = min(max(share or 0.0, 1e-9), 1 - 1e-9)
        return ToxicityModel(empty.chosen, float(np.log(p / (1 - p))), empty.weights, empty.factors)
    chosen = (
        rows.mapInArrow(counts, "range int, terms binary, bad binary, good binary").groupBy("range")
        .applyInArrow(_best_terms(sizes, settings), "term long, score double")
        .orderBy(F.desc("score"), "term").limit(settings.n_terms).select("term").collect()
    )
    hashes = np.sort(np.array([r["term"] for r in chosen], np.int64).view(np.uint64))
    chooser = ToxicityModel(hashes, 0.0, np.zeros(len(hashes)), np.zeros((len(hashes), 1)))

    def describe():
        def run(texts):
            text, term = chooser.found(texts)
            bounds = np.searchsorted(text, np.arange(len(texts) + 1))
            return {"terms": [term[a:b] for a, b in zip(bounds[:-1], bounds[1:])]}
        return run

    got = map_texts(rows, describe, "terms array<int>", "label").collect()
    got = sorted(((int(r["label"]), list(r["terms"])) for r in got))
    y = np.array([label for label, _ in got], float)
    row = np.repeat(np.arange(len(got)), [len(t) for _, t in got])
    term = np.array([t for _, ts in got for t in ts], np.int64)
    # the sample holds equal numbers of both labels: weights restore their shares
    weight = np.where(y == 1, share / max(1, y.sum()), (1 - share) / max(1, (1 - y).sum()))
    bias, w, v = fit(row, term, y, weight * len(y), len(hashes), settings)
    return ToxicityModel(hashes, float(bias), w, v)


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, settings: ToxicitySettings = ToxicitySettings(), key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``key``, held_out, score and predicted of every row."""
    scored = map_texts(docs, lambda: lambda texts: {"score": model.scores(texts)}, "score double", key, text)
    return scored.select(
        key, (crc_part(key, settings.folds) == 1).alias("held_out"), "score",
        F.when(F.col("score") >= settings.threshold, 1).otherwise(0).alias("predicted"),
    )
