"""Quality classifier: a linear-chain CRF labels lines, lines make the document's score.

Each line is described by its own measures and those of the lines before and
after it. The chain is trained by maximum likelihood on labelled documents,
whose lines all carry the document's label. A document's score is the mean of
its lines' forward-backward probabilities of being good, weighted by their
characters; documents without characters get the share of good ones seen in
training.

Training takes at most ``train_docs`` labelled documents per label, chosen by a
hash of their key, of at most ``train_lines`` lines: a bounded sample, collected
to the driver. Keys with a null or with different labels teach nothing. Scoring
takes every row, null texts as empty, repeated rows each by itself, null keys as
they are. Without any usable label every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.llm import crf
from tagwright.llm.frames import crc_part, filter_texts, map_texts
from tagwright.llm.lines import MEASURES, Lines, measure
from tagwright.llm.words import per_text


@dataclass(frozen=True)
class QualitySettings:
    threshold: float = 0.3
    #: documents whose crc32(key) modulo ``folds`` is 0 teach nothing
    folds: int = 5
    train_docs: int = 3000
    train_lines: int = 200
    rounds: int = 250


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    pair: np.ndarray
    prior: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        lines = Lines(texts)
        logit = line_features(lines) @ self.weights
        p, _, _ = crf.marginals(np.stack([np.zeros(len(logit)), logit], axis=1), lines.ptr, self.pair)
        chars = lines.n_chars.astype(float)
        total = per_text(chars, lines.ptr)
        good = per_text(chars * p[:, 1], lines.ptr)
        return np.clip(np.where(total > 0, good / np.maximum(total, 1), self.prior), 0.0, 1.0)


def line_features(lines: Lines) -> np.ndarray:
    """A constant, the line's measures, and those of its neighbours (0 where there is none)."""
    own = measure(lines)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    size = np.diff(lines.ptr)
    before[lines.ptr[:-1][size > 0]] = 0
    after[lines.ptr[1:][size > 0] - 1] = 0
    return np.concatenate([np.ones((len(own), 1)), own, before, after], axis=1)


def labelled_sample(labels: DataFrame, label: str, key: str, held_out, per_label: int) -> DataFrame:
    """At most ``per_label`` keys of each label, in the order of a hash of the key."""
    agreed = (
        labels.select(F.col(key).alias("key"), F.col(label).alias("label")).dropna()
        .where(~held_out(F.col("key"))).groupBy("key")
        .agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").select("key", "label")
    )
    order = F.xxhash64("key")
    parts = [agreed.where(F.col("label") == v).orderBy(order, "key").limit(per_label) for v in (0, 1)]
    # at most 2 * per_label rows of two values: gathered once, used several times; as Arrow, which starts no worker
    return labels.sparkSession.createDataFrame(pa.concat_tables([p.toArrow() for p in parts]), agreed.schema)


def train_quality(
    docs: DataFrame, labels: DataFrame, settings: QualitySettings = QualitySettings(), key: str = "doc_id",
    text: str = "text", label: str = "quality",
) -> QualityModel:
    held_out = lambda c: crc_part(c, settings.folds) == 0
    sample = labelled_sample(labels, label, key, held_out, settings.train_docs)
    known = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    # at most 2 * train_docs rows of two numbers
    rows = known.join(F.broadcast(sample), "key")
    limit = settings.train_lines

    def describe():
        def run(texts):
            lines = Lines(texts)
            found = line_features(lines).astype(np.float32)
            fits = np.diff(lines.ptr) <= limit
            return {"found": [
                found[a:b].tobytes() if ok else None for a, b, ok in zip(lines.ptr[:-1], lines.ptr[1:], fits)
            ]}
        return run

    # the label travels as the key of the map
    got = map_texts(rows, describe, "found binary", "label").dropna().collect()
    got = sorted(got, key=lambda r: (r["label"], bytes(r["found"])))
    width = 1 + 3 * len(MEASURES)
    if len({r["label"] for r in got}) < 2:
        return QualityModel(np.zeros(width), np.zeros((2, 2)), got[0]["label"] * 1.0 if got else 0.5)
    chains = [np.frombuffer(r["found"], np.float32).reshape(-1, width) for r in got]
    sizes = np.array([len(c) for c in chains])
    ptr = np.concatenate([[0], np.cumsum(sizes)])
    # each document counts alike, however many lines it has
    weight = 1.0 / 2 ** np.round(np.log2(np.maximum(sizes, 1)))
    y = np.repeat([int(r["label"]) for r in got], sizes)
    good = labels.where(~held_out(F.col(key))).agg(F.avg(F.col(label).cast("double"))).first()[0]
    w, pair = crf.fit(np.concatenate(chains).astype(float), ptr, y, weight, settings.rounds)
    return QualityModel(w, pair, float(good))


def score_quality(
    docs: DataFrame, model: QualityModel, settings: QualitySettings = QualitySettings(), key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``key``, held_out, score and predicted of every row."""
    scored = map_texts(docs, lambda: lambda texts: {"score": model.scores(texts)}, "score double", key, text)
    return scored.select(
        key, (crc_part(key, settings.folds) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= settings.threshold, 1).otherwise(0).alias("predicted"),
    )


def keep_good(docs: DataFrame, model: QualityModel, settings: QualitySettings = QualitySettings(), text: str = "text") -> DataFrame:
    """The rows the classifier accepts, all columns unchanged."""
    return filter_texts(docs, lambda: lambda texts: model.scores(texts) >= settings.threshold, text)
