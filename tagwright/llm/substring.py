"""Substring dedup: suffix automata over shards of reference passages.

A window of ``size`` words that also starts in a document with a smaller id is
repeated; every word under a repeated window goes, the first document keeps it.
Windows are judged on the input.

1. Every window has an anchor, the least hash among its short word runs. Equal
   windows have equal anchors, so neighbouring windows with one anchor form a
   *stretch* that is compared only with stretches of that anchor. Blocks of
   documents ask which anchors lie in two documents or more (packed lookup).
2. Stretches with such an anchor, each distinct one once per block, go to the
   shard of their anchor. A shard builds a suffix automaton of its distinct
   stretches whose states know the smallest document id, streams the stretches
   through it for matching statistics, and answers with the first document of
   each window.
3. Blocks mark the windows first found in a smaller document and cut the text.

Shards stand in place of a broadcast of all references, which would grow with
the corpus. Their size is bounded: an anchor with very many distinct stretches
is routed window by window, by the window itself. Stretches are compared as
words; hashes only route them.

Null and empty texts, and texts shorter than a window, lose nothing. Rows with a
null id neither lose words nor count as first. Rows with one id never repeat
each other. Ids are whole numbers. Texts that lose nothing stay as they are,
others become the kept words joined by one space. An empty table stays empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tagwright.llm.automaton import SuffixAutomaton
from tagwright.llm.blocks import by_range, deal, layout
from tagwright.llm.words import Words, chunks, covered, find, give_back, per_text, run_hashes, window_starts, windows

#: words in the runs that anchors are chosen from
_RUN = 5
#: windows in a stretch
_STRETCH = 12
#: distinct stretches of an anchor above which its windows are routed one by one
_CROWDED = 20_000
_SHARD_BYTES, _MIN_SHARDS = 750_000, 256

_FLAG = np.uint16(1 << 15)


class _Passages:
    """The windows of some texts and the stretches they form."""

    def __init__(self, texts: list[bytes], size: int):
        self.words, self.size = Words(texts), size
        w = self.words
        hashes = w.hashes()
        runs = windows(hashes, _RUN)
        least, span = runs, 1
        while span * 2 <= size - _RUN + 1:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        rest = size - _RUN + 1 - span
        if rest:
            least = np.minimum(least[:-rest], least[rest:])
        #: places where a window starts, and their anchors
        self.at = np.flatnonzero(window_starts(w.ptr, size))
        self.anchor = least[self.at]
        self.text = w.text_of()[self.at]
        new = np.ones(len(self.at), bool)
        new[1:] = (self.anchor[1:] != self.anchor[:-1]) | (self.at[1:] != self.at[:-1] + 1)
        starts = np.flatnonzero(new)
        runs_of = np.diff(np.append(starts, len(self.at)))
        # long runs, of repeated words, are cut
        pieces = -(-runs_of // _STRETCH)
        offset = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        #: stretches: their first window and number of windows
        self.first = np.repeat(starts, pieces) + offset * _STRETCH
        self.count = np.minimum(np.repeat(starts + runs_of, pieces) - self.first, _STRETCH)
        begin = self.at[self.first]
        self.hash = run_hashes(hashes, begin, begin + size - 1 + self.count)
        self.word_hashes = hashes

    def stretch(self, i: int) -> bytes:
        """The words of a stretch, joined by one space."""
        a = self.at[self.first[i]]
        return self.run(a, a + self.size + self.count[i] - 1)

    def run(self, a: int, b: int) -> bytes:
        w = self.words
        return b" ".join(w.bytes[w.starts[a] : w.ends[b - 1]].split())


def _known(table: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    """The ids of the rows that have one, and their texts."""
    ids, texts = table["doc_id"].to_pylist(), table["text"].combine_chunks().cast(pa.binary()).to_pylist()
    rows = [(i, t) for i, t in zip(ids, texts) if i is not None and t]
    return np.array([i for i, _ in rows], np.int64), [t for _, t in rows]


def _anchors(p: _Passages, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct anchors, and for each the number of distinct stretches, with a flag for two documents."""
    anchor, text = p.anchor[p.first], p.text[p.first]
    order = np.lexsort((p.hash, anchor))
    a, h, d = anchor[order], p.hash[order], ids[text[order]]
    new = np.ones(len(a), bool)
    new[1:] = a[1:] != a[:-1]
    at = np.flatnonzero(new)
    if not len(at):
        return a, np.zeros(0, np.uint16)
    distinct = new.copy()
    distinct[1:] |= h[1:] != h[:-1]
    number = np.minimum(np.add.reduceat(distinct.astype(np.int64), at), _FLAG - 1).astype(np.uint16)
    several = np.minimum.reduceat(d, at) != np.maximum.reduceat(d, at)
    return a[at], np.where(several, number | _FLAG, number)


def _ask(size: int, n_ranges: int):
    def ask(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ids, texts = _known(table)
        values, number = _anchors(_Passages(texts, size), ids)
        order, bounds = by_range(values, n_ranges)
        values, number = values[order], number[order]
        some = np.flatnonzero(np.diff(bounds))
        return pa.table({
            "block": pa.array(np.full(len(some), key[0].as_py()), pa.int32()),
            "range": pa.array(some, pa.int32()),
            "anchors": pa.array([values[bounds[r] : bounds[r + 1]].tobytes() for r in some], pa.binary()),
            "numbers": pa.array([number[bounds[r] : bounds[r + 1]].tobytes() for r in some], pa.binary()),
        })

    return ask


def _answer(table: pa.Table) -> pa.Table:
    """0: only one document; 1: several; 2: several and very many stretches."""
    parts = [np.frombuffer(b.as_py(), np.uint64) for b in table["anchors"]]
    values = np.concatenate(parts)
    numbers = np.concatenate([np.frombuffer(b.as_py(), np.uint16) for b in table["numbers"]])
    order = np.argsort(values, kind="stable")
    s = values[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    at, group = np.flatnonzero(new), np.cumsum(new) - 1
    several = np.maximum.reduceat((numbers[order] & _FLAG) > 0, at) | (np.diff(np.append(at, len(s))) > 1)
    crowd = np.add.reduceat((numbers[order] & ~_FLAG).astype(np.int64), at) > _CROWDED
    state = np.empty(len(values), np.uint8)
    state[order] = (several.astype(np.uint8) + (several & crowd))[group]
    cuts = np.cumsum([len(p) for p in parts])[:-1]
    return pa.table({
        "block": table["block"], "range": table["range"],
        "states": pa.array([p.tobytes() for p in np.split(state, cuts)], pa.binary()),
    })


def _send(size: int, n_ranges: int, n_shards: int):
    """Distinct stretches with a shared anchor, packed by shard, with their least id in the block."""
    def send(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        ids, texts = _known(docs)
        p = _Passages(texts, size)
        values, _ = _anchors(p, ids)
        order, bounds = by_range(values, n_ranges)
        state = np.zeros(len(values), np.uint8)
        for r, b in zip(answers["range"].to_pylist(), answers["states"].to_pylist()):
            state[order[bounds[r] : bounds[r + 1]]] = np.frombuffer(b, np.uint8)
        of = state[np.searchsorted(values, p.anchor[p.first])]
        out: dict[tuple[int, bool], dict[bytes, list[int]]] = {}

        def put(route: int, text: bytes, tag: int, owner: int, single: bool = False) -> None:
            found = out.setdefault((route % n_shards, single), {})
            had = found.get(text)
            if had is None:
                found[text] = [tag, owner]
            elif owner < had[1]:
                had[1] = owner

        whole = np.flatnonzero(of == 1)
        # of equal stretches only the one with the least id is looked at
        owner = ids[p.text[p.first[whole]]]
        least = whole[np.lexsort((owner, p.hash[whole]))]
        keep = np.ones(len(least), bool)
        keep[1:] = p.hash[least][1:] != p.hash[least][:-1]
        for i in least[keep].tolist():
            put(int(p.anchor[p.first[i]]), p.stretch(i), int(p.hash[i]), int(ids[p.text[p.first[i]]]))
        single = windows(p.word_hashes, size) if (of == 2).any() else None
        for i in np.flatnonzero(of == 2).tolist():
            for j in range(p.first[i], p.first[i] + p.count[i]):
                a = int(p.at[j])
                put(int(single[a]), p.run(a, a + size), int(single[a]), int(ids[p.text[j]]), True)
        rows = [(route, sorted(found.items())) for route, found in out.items()]
        give_back()
        return pa.table({
            "block": pa.array([key[0].as_py()] * len(rows), pa.int32()),
            "shard": pa.array([r[0] for r, _ in rows], pa.int32()),
            "single": pa.array([r[1] for r, _ in rows], pa.bool_()),
            "texts": pa.array([[t for t, _ in f] for _, f in rows], pa.list_(pa.binary())),
            "tags": pa.array([np.array([v[0] for _, v in f], np.uint64).tobytes() for _, f in rows], pa.binary()),
            "owners": pa.array([[v[1] for _, v in f] for _, f in rows], pa.list_(pa.int64())),
        })

    return send


def _match(size: int):
    """One shard: the first document of every window of its stretches."""
    def match(table: pa.Table) -> pa.Table:
        least: dict[bytes, int] = {}
        rows = list(zip(table["texts"].to_pylist(), table["owners"].to_pylist()))
        for texts, owners in rows:
            for text, owner in zip(texts, owners):
                if owner < least.get(text, 1 << 63):
                    least[text] = owner
        machine = SuffixAutomaton()
        for text, owner in least.items():
            machine.add(text.split(b" "), owner)
        machine.finish()
        first = {text: machine.owners(text.split(b" "), size) for text in least}
        del machine
        give_back()
        same = {text: f[0] if min(f) == max(f) else None for text, f in first.items()}
        return pa.table({
            "block": table["block"],
            "single": table["single"],
            "tags": table["tags"],
            "firsts": pa.array([[same[t] for t in texts] for texts, _ in rows], pa.list_(pa.int64())),
            # per window only where they differ
            "each": pa.array(
                [[None if same[t] is not None else first[t] for t in texts] for texts, _ in rows],
                pa.list_(pa.list_(pa.int64())),
            ),
        })

    return match


def _cut(size: int, join_all: bool, schema: T.StructType):
    def cut(docs: pa.Table, answers: pa.Table) -> pa.Table:
        #: hash of a stretch, and of a single window: the first document, one for each window if they differ
        stretches, singles = {}, {}
        for single, tags, firsts, each in zip(*(answers[c].to_pylist() for c in ("single", "tags", "firsts", "each"))):
            known = singles if single else stretches
            for tag, first, own in zip(np.frombuffer(tags, np.uint64).tolist(), firsts, each):
                known[tag] = first if own is None else own
        tags, single_tags = (np.sort(np.array(list(k), np.uint64)) for k in (stretches, singles))
        n_words, n_removed, kept = [], [], []
        for batch, texts in chunks(docs.select(["doc_id", "text"]).combine_chunks().to_batches()):
            p = _Passages(texts, size)
            ids = batch.column(0).to_pylist()
            marked = np.zeros(len(p.words.starts), bool)
            if len(tags):
                for i, tag in zip(*(x.tolist() for x in find(tags, p.hash))):
                    first, owner, j = stretches[int(tags[tag])], ids[p.text[p.first[i]]], p.first[i]
                    if owner is not None and isinstance(first, list):
                        marked[p.at[j : j + p.count[i]][np.array(first) < owner]] = True
                    elif owner is not None and first < owner:
                        marked[p.at[j : j + p.count[i]]] = True
            if len(single_tags):
                for j, tag in zip(*(x.tolist() for x in find(single_tags, windows(p.word_hashes, size)[p.at]))):
                    owner = ids[p.text[j]]
                    if owner is not None and singles[int(single_tags[tag])] < owner:
                        marked[p.at[j]] = True
            gone = covered(marked, len(marked), size)
            ptr, w = p.words.ptr, p.words
            n_words += np.diff(ptr).tolist()
            removed = per_text(gone, ptr)
            n_removed += removed.tolist()
            for t, text in enumerate(texts):
                if not removed[t]:
                    kept.append(b" ".join(text.split()) if join_all else None)
                    continue
                stay = ~gone[ptr[t] : ptr[t + 1]]
                edge = np.flatnonzero(np.diff(np.concatenate([[False], stay, [False]])))
                kept.append(b" ".join(
                    word for a, b in zip(edge[0::2] + ptr[t], edge[1::2] + ptr[t])
                    for word in w.bytes[w.starts[a] : w.ends[b - 1]].split()
                ))
        arrow = to_arrow_schema(schema)
        made = {"n_words": n_words, "n_removed": n_removed, "kept": kept}
        columns = [
            docs[f.name].combine_chunks().cast(f.type) if f.name in docs.column_names
            else pa.array(made[f.name.removeprefix(_OWN)], pa.binary() if f.name == f"{_OWN}kept" else f.type).cast(f.type)
            for f in arrow
        ]
        return pa.Table.from_arrays(columns, schema=arrow)

    return cut


#: names that no column of the input has
_OWN = "__substring_"


def mark_repeated(
    docs: DataFrame, size: int = 13, key: str = "doc_id", text: str = "text", join_all: bool = False
) -> DataFrame:
    """All columns, and ``__substring_n_words``, ``_n_removed`` and ``_kept``: the words that
    stay, joined by one space, null where none goes unless ``join_all``."""
    plan = layout(docs, text)
    n_shards = max(_MIN_SHARDS, plan.n_blocks * 1_500_000 // _SHARD_BYTES)
    names = [f"c{i}" for i in range(len(docs.columns))]
    names[docs.columns.index(key)], names[docs.columns.index(text)] = "doc_id", "text"
    dealt = deal(docs.toDF(*names), plan.n_blocks)
    blocks = dealt.groupBy("block")
    # all three steps read the same blocks, so that the documents are dealt once
    answers = blocks.applyInArrow(
        _ask(size, plan.n_ranges), "block int, range int, anchors binary, numbers binary"
    ).groupBy("range").applyInArrow(_answer, "block int, range int, states binary")
    firsts = blocks.cogroup(answers.groupBy("block")).applyInArrow(
        _send(size, plan.n_ranges, n_shards), "block int, shard int, single boolean, texts array<binary>, tags binary, owners array<long>"
    ).groupBy("shard").applyInArrow(_match(size), "block int, single boolean, tags binary, firsts array<long>, each array<array<long>>")
    schema = T.StructType([
        *[T.StructField(n, f.dataType) for n, f in zip(names, docs.schema)],
        *T.StructType.fromDDL(f"{_OWN}n_words long, {_OWN}n_removed long, {_OWN}kept string"),
    ])
    cut = blocks.cogroup(firsts.groupBy("block")).applyInArrow(_cut(size, join_all, schema), schema)
    return cut.toDF(*docs.columns, *cut.columns[len(names):])


def remove_repeated(docs: DataFrame, size: int = 13, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with repeated passages cut from their text; ``n_chars``, where there, follows the text."""
    marked = mark_repeated(docs, size, key, text)
    out = marked.withColumn(text, F.when(F.col(f"{_OWN}n_removed") > 0, F.col(f"{_OWN}kept")).otherwise(F.col(text)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(
            F.col(f"{_OWN}n_removed") > 0, F.length(text).cast(docs.schema["n_chars"].dataType)
        ).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
