"""A small causal self-attention model in numpy: scoring and training."""

from __future__ import annotations

from functools import cache

import numpy as np

#: width of the model, of its inner layer, and words seen at once
WIDTH, INNER, CONTEXT = 16, 32, 32
#: output classes; the last but one is any other leading piece, the last the end of a text
CLASSES = 128
OTHER, END = CLASSES - 2, CLASSES - 1
#: input ids: classes and the start; buckets of final pieces
INPUTS, TAILS = CLASSES + 1, 512
START = CLASSES
#: classes of a group: the output gives a group its probability, and a class its share of the group's
SPAN = 16
GROUPS = CLASSES // SPAN

_SHAPES = {
    "lead": (INPUTS, WIDTH), "tail": (TAILS + 1, WIDTH), "place": (CONTEXT, WIDTH),
    "q": (WIDTH, WIDTH), "k": (WIDTH, WIDTH), "v": (WIDTH, WIDTH), "o": (WIDTH, WIDTH),
    "w1": (WIDTH, INNER), "w2": (INNER, WIDTH), "u": (WIDTH, CLASSES), "b": (CLASSES,),
    "groups": (WIDTH, GROUPS), "bias": (GROUPS,),
}
#: logits above it are moved down before powers are taken
_LARGEST = 60.0
_TRI = np.tri(CONTEXT, dtype=np.float32)

Params = dict[str, np.ndarray]


def initial(class_counts: np.ndarray, seed: int = 3) -> Params:
    """Small random weights; the output's biases hold the shares of classes and groups."""
    rng = np.random.default_rng(seed)
    out = {n: rng.normal(0, 0.1 if n in ("lead", "tail", "place") else 0.25, s).astype(np.float32) for n, s in _SHAPES.items()}
    out["u"] *= 0.2
    share = (class_counts + 1.0) / (class_counts + 1.0).sum()
    out["b"] = np.log(share).astype(np.float32)
    out["groups"] *= 0.2
    out["bias"] = np.log(share.reshape(GROUPS, SPAN).sum(1)).astype(np.float32)
    return out


def flat(params: Params) -> np.ndarray:
    return np.concatenate([params[n].ravel() for n in _SHAPES])


def shaped(values: np.ndarray) -> Params:
    sizes = np.cumsum([int(np.prod(s)) for s in _SHAPES.values()])[:-1]
    values = values.astype(np.float32, copy=False)
    return {n: part.reshape(s) for (n, s), part in zip(_SHAPES.items(), np.split(values, sizes))}


@cache
def touch_buffers() -> None:
    """One square product, once a process. BLAS packs into buffers that narrow products never fill, and those take
    three times as long while the rest of the buffers is untouched memory."""
    square = np.ones((512, 512), np.float32)
    square @ square


def _mixers(p: Params) -> np.ndarray:
    """The weights of queries, with their scale, keys and values side by side."""
    return np.concatenate([p["q"] * np.float32(WIDTH**-0.5), p["k"], p["v"]], axis=1)


def _forward(p: Params, lead: np.ndarray, tail: np.ndarray, skip: int = 0):
    """All layers up to the last hidden one for windows of input ids; places of all windows are rows.

    Products with weights take all rows at once, only attention goes window by window. Its powers are never
    divided: what they bring together is, by their sums. The first ``skip`` places of each window are context:
    they have keys and values, and no rows from the queries on. The last layer has a one behind, for the bias.
    """
    windows, n = lead.shape
    x = np.take(p["lead"], lead.ravel(), axis=0)
    x += np.take(p["tail"], tail.ravel(), axis=0)
    x.reshape(windows, n, WIDTH)[:] += p["place"][:n]
    qkv = (x @ _mixers(p)).reshape(windows, n, 3 * WIDTH)
    a = qkv[:, skip:, :WIDTH] @ qkv[:, :, WIDTH : 2 * WIDTH].transpose(0, 2, 1)
    if a.max(initial=0) > _LARGEST:
        np.minimum(a, _LARGEST, out=a)
    np.exp(a, out=a)
    a *= _TRI[skip:n, :n]
    sums = (a.reshape(-1, n) @ np.ones(n, a.dtype))[:, None]
    c = (a @ qkv[:, :, 2 * WIDTH :]).reshape(-1, WIDTH)
    c /= sums
    h = c @ p["o"]
    h += x.reshape(windows, n, WIDTH)[:, skip:].reshape(-1, WIDTH)
    g = h @ p["w1"]
    np.maximum(g, 0, out=g)
    last = np.empty((len(h), WIDTH + 1), h.dtype)
    np.add(g @ p["w2"], h, out=last[:, :WIDTH])
    last[:, WIDTH] = 1
    return x, qkv, a, sums, c, h, g, last


def _output(p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the groups, and of each group's classes, biases in the last row."""
    classes = np.concatenate([p["u"], p["b"][None]]).reshape(WIDTH + 1, GROUPS, SPAN)
    return np.concatenate([p["groups"], p["bias"][None]]), np.ascontiguousarray(classes.transpose(1, 0, 2))


def _by_group(target: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order of targets by group, and each group with its bounds in it."""
    group = (target // SPAN).astype(np.int16)
    order = np.argsort(group, kind="stable")
    bounds = np.searchsorted(group[order], np.arange(GROUPS + 1)).tolist()
    return order, [(g, a, b) for g, (a, b) in enumerate(zip(bounds, bounds[1:])) if a < b]


def _powers(logits: np.ndarray, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logits of the columns ``hit``, and sums of powers, which stand in ``logits`` then.

    Logits are moved down where needed to keep powers in range.
    """
    if len(logits) and logits.max() > _LARGEST:
        logits -= logits.max(1)[:, None]
    found = np.take(logits.reshape(-1), hit)
    np.exp(logits, out=logits)
    return found, logits @ np.ones(logits.shape[1], logits.dtype)


def _levels(last: np.ndarray, target: np.ndarray, output, groups):
    """For the output of groups and the output of their classes: logits, and the places of targets in them.

    A row has logits of all groups and of the classes in its target's group, no others. Rows lie by group.
    """
    of_groups, of_classes = output
    inside = np.empty((len(last), SPAN), last.dtype)
    for g, a, b in groups:
        np.matmul(last[a:b], of_classes[g], out=inside[a:b])
    row = np.arange(len(last))
    return (last @ of_groups, row * GROUPS + target // SPAN), (inside, row * SPAN + target % SPAN)


def log_probabilities(p: Params, lead: np.ndarray, tail: np.ndarray, target: np.ndarray, skip: np.ndarray) -> np.ndarray:
    """Natural logarithms of the targets' probabilities; the first ``skip`` places
    of each window are context alone and left out, in the order of the rest."""
    context = int(skip.min(initial=lead.shape[1]))
    last = _forward(p, lead, tail, context)[-1]
    scored = np.flatnonzero(np.arange(context, lead.shape[1]) >= skip[:, None])
    target = target[:, context:].reshape(-1)[scored]
    order, groups = _by_group(target)
    out, total = np.empty(len(order), last.dtype), 0
    for logits, hit in _levels(np.take(last, scored[order], axis=0), target[order], _output(p), groups):
        found, powers = _powers(logits, hit)
        total = total + found - np.log(powers)
    out[order] = total
    return out


def gradient(p: Params, lead: np.ndarray, tail: np.ndarray, target: np.ndarray, weight: np.ndarray) -> Params:
    """Of the weighted mean cross-entropy; ``weight`` is 0 at places without a target."""
    x, qkv, a, sums, c, h, g, last = _forward(p, lead, tail)
    # places without a target have no share in the output layer
    some = np.flatnonzero(weight)
    order, groups = _by_group(target.reshape(-1)[some])
    some = some[order]
    share = weight.reshape(-1)[some] / np.float32(max(1.0, weight.sum()))
    output, ones = _output(p), np.take(last, some, axis=0)
    levels = _levels(ones, target.reshape(-1)[some], output, groups)
    for logits, hit in levels:
        _, powers = _powers(logits, hit)
        logits *= (share / powers)[:, None]
        logits.reshape(-1)[hit] -= share
    (of_groups, _), (inside, _) = levels
    both, part = ones.T @ of_groups, of_groups @ output[0][:WIDTH].T
    out = {"groups": both[:WIDTH], "bias": both[WIDTH]}
    both = np.zeros_like(output[1])
    for i, first, to in groups:
        np.matmul(ones[first:to].T, inside[first:to], out=both[i])
        part[first:to] += inside[first:to] @ output[1][i, :WIDTH].T
    both = both.transpose(1, 0, 2).reshape(WIDTH + 1, CLASSES)
    out |= {"u": both[:WIDTH], "b": both[WIDTH]}
    d_last = np.zeros_like(h)
    d_last[some] = part
    out["w2"] = g.T @ d_last
    d_g = d_last @ p["w2"].T
    d_g *= g > 0
    out["w1"] = h.T @ d_g
    d_h = d_g @ p["w1"].T
    d_h += d_last
    out["o"] = c.T @ d_h
    d_c = d_h @ p["o"].T
    d_c /= sums
    own = np.einsum("ij,ij->i", d_c, c).reshape(*lead.shape, 1)
    d_c = d_c.reshape(*lead.shape, WIDTH)
    d_a = d_c @ qkv[:, :, 2 * WIDTH :].transpose(0, 2, 1)
    d_a -= own
    d_a *= a
    d_qkv = np.empty_like(qkv)
    np.matmul(d_a, qkv[:, :, WIDTH : 2 * WIDTH], out=d_qkv[:, :, :WIDTH])
    np.matmul(d_a.transpose(0, 2, 1), qkv[:, :, :WIDTH], out=d_qkv[:, :, WIDTH : 2 * WIDTH])
    np.matmul(a.transpose(0, 2, 1), d_c, out=d_qkv[:, :, 2 * WIDTH :])
    d_qkv = d_qkv.reshape(-1, 3 * WIDTH)
    mixed = x.T @ d_qkv
    mixed[:, :WIDTH] *= np.float32(WIDTH**-0.5)
    out |= {name: mixed[:, i * WIDTH : (i + 1) * WIDTH] for i, name in enumerate("qkv")}
    d_x = d_qkv @ _mixers(p).T
    d_x += d_h
    for name, ids in (("lead", lead), ("tail", tail)):
        # numbers of two bytes are sorted by their digits
        ids = ids.ravel().astype(np.int16)
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        out[name] = np.zeros(_SHAPES[name], d_x.dtype)
        out[name][ids[first]] = np.add.reduceat(np.take(d_x, order, axis=0), first)
    out["place"] = np.zeros(_SHAPES["place"], d_x.dtype)
    out["place"][: lead.shape[1]] = d_x.reshape(*lead.shape, WIDTH).sum(0)
    return out


def train(
    p: Params, lead: np.ndarray, tail: np.ndarray, target: np.ndarray, weight: np.ndarray,
    batch: int = 64, min_steps: int = 300, max_epochs: int = 8, rate: float = 0.01, seed: int = 5,
) -> Params:
    """Adam over shuffled windows: each at least once; again while fewer than
    ``min_steps`` batches were seen, but not more than ``max_epochs`` times."""
    touch_buffers()
    rng, n = np.random.default_rng(seed), len(lead)
    once = -(-n // batch)
    steps = max(once, min(min_steps, max_epochs * once))
    # all weights in one array, which the model's arrays are views of
    values = flat(p)
    p, order, at = shaped(values), rng.permutation(n), 0
    m, s = np.zeros_like(values), np.zeros_like(values)
    for step in range(1, steps + 1):
        if at >= n:
            order, at = rng.permutation(n), 0
        some = order[at : at + batch]
        at += batch
        g = flat(gradient(p, lead[some], tail[some], target[some], weight[some]))
        now = rate * (1 - 0.9 * step / steps)
        m += np.float32(0.1) * (g - m)
        s += np.float32(0.02) * (g * g - s)
        values -= np.float32(now / (1 - 0.9**step)) * m / (np.sqrt(s * np.float32(1 / (1 - 0.98**step))) + np.float32(1e-6))
    return p
