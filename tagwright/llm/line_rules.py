"""Quality rules: a two-state chain over lines tells content from boilerplate.

Every line gets a score for being content from fixed weights on its measures
(symbols, shouting, capitals, repetition, copies of earlier lines). Viterbi
decoding finds the best labelling of the whole line sequence, in which a change
of state costs; a document is kept if enough of its words lie in content lines
and it passes the base rules.

Null and empty texts have no words: all counts 0, failed, not kept. A line
without words never counts as a copy. Repeated rows are judged each by itself,
null keys are kept as keys, other columns are ignored; an empty table gives an
empty table. Long texts are whole: time and memory grow with their length.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame

from tagwright.llm import crf
from tagwright.llm.frames import map_texts
from tagwright.llm.lines import MEASURES, Lines, measure, repeats
from tagwright.llm.words import per_text

#: how much each measure speaks for content
WEIGHTS = {
    "symbols": -20.0, "shouts": -20.0, "others": -10.0, "uppers": -4.0, "digits": -6.0, "log_words": 0.0,
    "word_length": 0.0, "echoes": -8.0, "repeats": -1.0, "bare": -8.0, "copy": -4.0, "ended": 0.5, "empty": -2.0,
}


@dataclass(frozen=True)
class LineRules:
    """Parameters; the first three are the base rules."""

    min_words: int = 20
    repeat_window: int = 8
    max_repeat_percent: int = 30
    bias: float = 2.0
    change: float = -1.5
    min_content: float = 0.5
    weights: dict[str, float] = field(default_factory=lambda: dict(WEIGHTS))


_OUT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, content_share double, boilerplate array<int>"
)


def _judge(rules: LineRules):
    weights = np.array([rules.weights[name] for name in MEASURES])

    def judge(texts: list[bytes]) -> dict[str, object]:
        lines = Lines(texts)
        w, ptr = lines.words, lines.ptr
        found = measure(lines)
        repeat = repeats(w, w.hashes(), rules.repeat_window)
        n_words = np.diff(w.ptr)
        n_repeat = per_text(repeat, w.ptr)
        score = found @ weights + rules.bias
        state = crf.viterbi(np.stack([np.zeros(len(score)), score], axis=1), ptr, rules.change)
        content = per_text(np.where(state == 1, lines.n_words, 0), ptr)
        failed = (n_words < rules.min_words) | (100 * n_repeat > rules.max_repeat_percent * n_words)
        share = content / np.maximum(n_words, 1)
        place = np.arange(len(state)) - np.repeat(ptr[:-1], np.diff(ptr))
        return {
            "n_words": n_words,
            "word_chars": per_text(lines.n_chars, ptr),
            "n_symbols": per_text(lines.count("symbol"), ptr),
            "n_dup_lines": per_text(lines.copies(w.hashes()), ptr),
            "n_repeat_words": n_repeat,
            "base_failed": failed,
            "kept": ~failed & (share >= rules.min_content),
            "content_share": share,
            "boilerplate": [place[a:b][state[a:b] == 0] for a, b in zip(ptr[:-1], ptr[1:])],
        }

    return judge


def line_rules(docs: DataFrame, rules: LineRules = LineRules(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts, verdict and the numbers of the boilerplate lines (from 0) of each document."""
    return map_texts(docs, lambda: _judge(rules), _OUT, key, text)
