"""Found by the third round's check: work that the language model did twice."""

import numpy as np

from tagwright.llm import attention as A
from tagwright.llm import lm_scoring
from tagwright.llm.words import Words


def test_full_trainers_see_each_window_once():
    """A trainer has ``_TRAINER`` windows in a round: enough batches, so none comes twice."""
    windows = 40 * lm_scoring._TRAINER
    each = windows // lm_scoring._ROUNDS // lm_scoring._trainers(windows)
    assert each == lm_scoring._TRAINER and -(-each // 64) >= 300
    assert lm_scoring._trainers(0) == lm_scoring._trainers(1) == 1
    assert lm_scoring._trainers(windows + 1) == lm_scoring._trainers(windows) + 1


def test_a_word_needs_the_powers_of_one_group(monkeypatch):
    """Powers of the output: all groups' and those of the target's group, not all classes'."""
    rng = np.random.default_rng(1)
    p = {k: v.astype(float) * 2 for k, v in A.initial(rng.random(A.CLASSES)).items()}
    lead, tail = rng.integers(0, A.INPUTS, (3, 20)), rng.integers(0, A.TAILS + 1, (3, 20))
    target, skip = rng.integers(0, A.CLASSES, (3, 20)), np.array([8, 8, 11])
    # the plain way: every class of every group
    last = A._forward(p, lead, tail)[-1].reshape(3, 20, -1)
    softmax = lambda x: np.exp(x) / np.exp(x).sum(-1, keepdims=True)
    group = softmax(last @ np.vstack([p["groups"], p["bias"]]))
    inside = softmax((last @ np.vstack([p["u"], p["b"]])).reshape(3, 20, A.GROUPS, A.SPAN))
    every = np.log((group[..., None] * inside).reshape(3, 20, A.CLASSES))
    want = np.concatenate([every[i, np.arange(s, 20), target[i, s:]] for i, s in enumerate(skip)])
    taken, exp = [], np.exp
    monkeypatch.setattr(np, "exp", lambda x, **more: (taken.append(x.shape), exp(x, **more))[1])
    got = A.log_probabilities(p, lead, tail, target, skip)
    assert np.allclose(got, want)
    # context has no queries: windows of 20 places, the last 12 of which ask
    assert taken[0] == (3, 12, 20)
    assert sum(a * b for a, b in taken[1:]) == len(want) * (A.GROUPS + A.SPAN)


def test_distinct_words_are_those_of_a_sort():
    words = Words([b"b a b", b"", b"a longer-than-eight-bytes word", b"word b " + b"x" * 200])
    values, first, at = lm_scoring._distinct(words)
    want, back = np.unique(words.hashes(), return_inverse=True)
    assert (values == want).all() and (at == back).all() and (words.hashes()[first] == values).all()
    assert (words.hashes(3, some=first) == words.hashes(3)[first]).all()
    assert (words.hashes(3, tail=True, some=first) == words.hashes(3, tail=True)[first]).all()
    assert all(len(x) == 0 for x in lm_scoring._distinct(Words([b"", b" "])))
