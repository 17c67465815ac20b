"""The operators' results in plain Python, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def words(text):
    return WORD.findall(text or "")


def lower_words(text):
    return words((text or "").translate(_LOWER))


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def base_scores(rows):
    """doc_id -> (n_tokens, n_known, N, base score)."""
    counts, ends = Counter(), 0
    for i, t in rows:
        if crc(i) % 7 != 2:
            counts.update(lower_words(t))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
    out = {}
    for i, t in rows:
        w = lower_words(t)
        score = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w) + math.log10((ends + 1) / (n + v + 1))
        out[i] = len(w) + 1, sum(counts[x] > 0 for x in w) + (ends > 0), n, score
    return out


def top_k(vectors, k=10):
    """(query, rank) -> (vec_id, score) of whole-number vectors."""
    out = {}
    for q, v in vectors:
        if q % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in vectors if i != q)[:k]
            out.update({(q, r): (i, -s) for r, (s, i) in enumerate(scored, 1)})
    return out


def substring(rows, size=13):
    """doc_id -> (n_words, n_removed, kept words)."""
    first = {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        w = words(t)
        for k in range(len(w) - size + 1):
            first.setdefault(tuple(w[k : k + size]), i)
    out = {}
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < i:
                gone[k : k + size] = [True] * size
        out[i] = len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def line_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = words(text)
    seen_windows = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    covered = [False] * len(w)
    for k in range(len(w) - 7):
        if seen_windows[tuple(w[k : k + 8])] > 1:
            covered[k : k + 8] = [True] * 8
    seen, copies = set(), 0
    for line in text.split("\n"):
        if words(line):
            copies += line in seen
            seen.add(line)
    n, r = len(w), sum(covered)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), copies, r, n < 20 or 100 * r > 30 * n


def shingles(text, size=5):
    w = lower_words(text)
    if not w:
        return set()
    return {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))}


def link_components(rows, percent=75):
    """doc_id -> (n_shingles, component_id), every pair of rows compared."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            common = len(s & t)
            if common and 100 * common >= percent * (len(s) + len(t) - common):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


# ------------------------------------------------------------ conversations
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations(rows):
    """conv_id -> its turns (role, text) in order; of equal numbers as the operator orders them, by a digest."""
    found = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            found.setdefault(c, []).append((turn is not None, turn or 0, digest, (role, text)))
    return {c: [t[-1] for t in sorted(turns)] for c, turns in found.items()}


def rebuilt(rows):
    own = conversations(rows)
    out = {}
    for c, turns in own.items():
        h = crc(c) % 6
        out[c] = own.get(int(c / 100) * 100, [])[:h] + turns[h:]
    return out


def trie(convs):
    """All nodes, as tuples in the order of :data:`NODE`."""
    members, below = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for path in members:
        if path:
            below.setdefault(path[:-1], []).append(path)
    leaves, saved, out = {}, {}, []
    for path in sorted(members, key=len, reverse=True):
        under = below.get(path, [])
        leaves[path] = sum(leaves[x] for x in under) or 1
        saved[path] = sum(saved[x] for x in under) + ((len(members[path]) - 1) * len(path[-1][1]) if path else 0)
    for path, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(path))))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(m), len(path), parent, len(m), len(below.get(path, [])), leaves[path], saved[path], sha(ends)))
    return sorted(out, key=str)


# ------------------------------------------------------------ embeddings
def check_whitened(got, rows, components=4):
    """Compares with numpy's eigenvectors, up to the components' signs."""
    import numpy as np

    rows = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in rows), default=0)
    x = np.array([[math.floor(256 * float(c)) for c in v] + [0] * (width - len(v)) for _, v in rows], np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    values, vectors = np.linalg.eigh(np.cov(fit.T, bias=True).reshape(width, width))
    order = np.argsort(-values)[: min(components, int((values > 1e-9).sum()))]
    want = (x - s / n) @ vectors[:, order] / np.sqrt(values[order])
    assert len(got) == len(rows) * len(order)
    found = {}
    for r in got:
        found.setdefault((r["vec_id"], r["component"]), []).append(r)
    for j in range(len(order)):
        mine = np.array([found[i, j + 1][0]["whitened"] for i, _ in rows])
        flip = np.sign(mine @ want[:, j])
        assert np.abs(mine - flip * want[:, j]).max() < 1e-7
        assert abs(found[rows[0][0], j + 1][0]["explained"] / (values[order[j]] / values.sum()) - 1) < 1e-9
    for (i, _), v in zip(rows, x):
        r = found[i, 1][0]
        assert r["deviation"] == int(((n * v - s) ** 2).sum()) and r["n"] == n and r["identity_error"] < 1e-9
