"""Language-model scoring: causal self-attention over subword ids, with word counts of the corpus.

Tokens are lower-cased words and an end for each text. A word's subword ids are
its leading piece (up to three bytes) and its final piece. The model reads the
ids of the words before and predicts the class of the next word: one of the most
frequent leading pieces, any other, or the end. It does so in two steps, the
class's group and the class within it, so that a word needs the powers of one
group and not of all classes. Within its class a word has the
probability (c + 1) / (C + V + 1): c its count, C the tokens and V the distinct
words of the class in training documents, 1 for all words never seen. The
product is the word's probability, and a text's score the sum of logarithms.

Long texts are cut into overlapping windows. Every token is scored once: the
first places of a window that an earlier one has scored are context only, with
keys and values but no query.
Windows run in batches through masked attention.

What comes from the corpus: counts of leading pieces, and counts of all words,
over all training documents, and training windows over the whole of their texts.
Windows are dealt to trainers of bounded size, whose parameters are averaged,
twice, half of the windows each time; so training grows with the corpus and no
task holds all of it. A corpus with enough for one trainer is seen once. Word
counts are packed lookups from block to block, never a broadcast.

Null and empty texts are an end alone. Rows with a null key belong to the
training documents. Repeated rows count and are scored each by itself. With no
training documents every class and word is unseen: counts are 0. An empty table
gives an empty table.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tagwright.llm import attention as A
from tagwright.llm.blocks import by_range, deal, layout
from tagwright.llm.frames import crc_part
from tagwright.llm.words import Words, chunks, find, lower
from tagwright.workspace import materialize

_PIECE = 3
#: words a window moves on, and windows scored at once
_MOVE, _BATCH = 24, 128
#: training windows of one trainer in a round, and rounds of averaging
_TRAINER, _ROUNDS = 25_000, 2
#: training windows written at once
_ROWS = 10_000


def _pieces(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the leading pieces, and ids of the final pieces (0 is for the start)."""
    return words.hashes(_PIECE), _tails(words)


def _tails(words: Words, some: np.ndarray | None = None) -> np.ndarray:
    return (words.hashes(_PIECE, tail=True, some=some) % np.uint64(A.TAILS)).astype(np.int64) + 1


def _distinct(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted distinct hashes, a word of each, and where in them each word's is."""
    values, at = np.unique(words.hashes(), return_inverse=True)
    first = np.empty(len(values), np.int64)
    first[at] = np.arange(len(at))
    return values, first, at


def _classes(leads: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    out = np.full(len(leads), A.OTHER, np.int64)
    if len(chosen):
        at, place = find(chosen, leads)
        out[at] = place
    return out


# ------------------------------------------------------------ statistics and windows
def _gather(batches):
    """Counts of leading pieces."""
    for _, texts in chunks(batches):
        leads = Words([lower(t) for t in texts]).hashes(_PIECE)
        found = pc.value_counts(pa.array(leads.view(np.int64)))
        yield pa.RecordBatch.from_arrays([found.field(0), found.field(1)], names=["lead", "number"])


def _windows(chosen: np.ndarray):
    """Consecutive windows over the whole of each text: every word and the end is a target once.

    A window is packed into ``_PACKED`` bytes: whether it starts inside the text, whether the text ends in it, its
    words with the one before it, their classes and their final pieces.
    """
    def run(batches):
        for _, texts in chunks(batches):
            words = Words([lower(t) for t in texts])
            leads, tails = _pieces(words)
            classes = np.append(_classes(leads, chosen), 0).astype(np.uint8)
            tails = np.append(tails, 0).astype("<u2")
            n = np.diff(words.ptr)
            many = n // A.CONTEXT + 1
            text = np.repeat(np.arange(len(n)), many)
            at = (np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)) * A.CONTEXT
            first = words.ptr[:-1][text] + np.maximum(0, at - 1)
            last = words.ptr[:-1][text] + np.minimum(n[text], at + A.CONTEXT)
            for i in range(0, len(text), _ROWS):
                some = slice(i, i + _ROWS)
                place = first[some, None] + np.arange(A.CONTEXT + 1)
                place = np.where(place < last[some, None], place, len(classes) - 1)
                rows = np.empty((len(place), _PACKED), np.uint8)
                rows[:, 0], rows[:, 1] = at[some] > 0, n[text][some] < at[some] + A.CONTEXT
                rows[:, 2] = last[some] - first[some]
                rows[:, 3 : 4 + A.CONTEXT] = classes[place]
                rows[:, 4 + A.CONTEXT :] = tails[place].view(np.uint8)
                offsets = np.arange(0, rows.size + 1, _PACKED, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(
                    pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())])], names=["window"])

    return run


#: bytes of a packed window
_PACKED = 3 + 3 * (A.CONTEXT + 1)


def _unpack(windows: list[bytes]):
    """Inputs, targets and weights of training windows."""
    rows = np.frombuffer(b"".join(windows), np.uint8).reshape(-1, _PACKED)
    inside, ends, size = rows[:, 0].astype(bool), rows[:, 1].astype(np.int64), rows[:, 2].astype(np.int64)
    classes = rows[:, 3 : 4 + A.CONTEXT].astype(np.int64)
    tails = np.ascontiguousarray(rows[:, 4 + A.CONTEXT :]).view("<u2").astype(np.int64)
    # from the start of a text on, inputs are the start and then the words
    none = np.zeros((len(rows), 1), np.int64)
    lead = np.where(inside[:, None], classes[:, :-1], np.hstack([none + A.START, classes[:, :-2]]))
    tail = np.where(inside[:, None], tails[:, :-1], np.hstack([none, tails[:, :-2]]))
    target = np.where(inside[:, None], classes[:, 1:], classes[:, :-1])
    place, words = np.arange(A.CONTEXT), size - inside
    target[(place == words[:, None]) & (ends[:, None] == 1)] = A.END
    weight = place < np.minimum(words + ends, A.CONTEXT)[:, None]
    return np.where(weight, lead, A.START), np.where(weight, tail, 0), np.where(weight, target, 0), weight.astype(np.float32)


def _trainers(windows: int) -> int:
    """Trainers of a round, which share its part of the windows."""
    return max(1, -(-windows // (_ROUNDS * _TRAINER)))


def _train(start: np.ndarray, rate: float):
    def run(table: pa.Table) -> pa.Table:
        # in the order of the bytes, so that a trainer run again gives the same
        windows = sorted(table["window"].to_pylist())
        trained = A.flat(A.train(A.shaped(start), *_unpack(windows), rate=rate))
        return pa.table({"place": np.arange(len(trained)), "value": trained.astype(np.float64)})

    return run


# ------------------------------------------------------------ word counts
def _ask(chosen: np.ndarray, n_ranges: int):
    """A block's distinct words with their counts in training documents, and their classes."""
    def ask(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        words, learn = _words(table)
        values, first, at = _distinct(words)
        # a block's text, and so a word's number in it, is far below 2**32
        counts = np.bincount(at, learn[words.text_of()], len(values)).astype(np.uint32)
        classes = _classes(words.hashes(_PIECE, some=first), chosen).astype(np.uint8)
        order, bounds = by_range(values, n_ranges)
        some = np.flatnonzero(np.diff(bounds))
        cut = lambda x: pa.array([part.tobytes() for part in np.split(x[order], bounds[1:-1]) if len(part)], pa.binary())
        return pa.table({
            "block": pa.array(np.full(len(some), key[0].as_py()), pa.int32()), "range": pa.array(some, pa.int32()),
            "values": cut(values), "counts": cut(counts), "classes": cut(classes),
        })

    return ask


def _words(table: pa.Table) -> tuple[Words, np.ndarray]:
    texts = [lower(t) if t else b"" for t in table["text"].combine_chunks().cast(pa.binary()).to_pylist()]
    return Words(texts), table["learn"].to_numpy().astype(bool)


def _numbers(counts: np.ndarray) -> bytes:
    """Counts in four bytes each, or in eight where one needs them; their number tells which."""
    return counts.astype(np.uint32 if counts.max(initial=0) < 1 << 32 else np.uint64).tobytes()


def _answer(table: pa.Table) -> pa.Table:
    """Total counts for every block that asked; and, without a block, tokens and words of each class."""
    parts = [np.frombuffer(b.as_py(), np.uint64) for b in table["values"]]
    values = np.concatenate(parts)
    counts, classes = (np.concatenate([np.frombuffer(b.as_py(), t) for b in table[c]]) for c, t in (("counts", np.uint32), ("classes", np.uint8)))
    order = np.argsort(values, kind="stable")
    s = values[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    at = np.flatnonzero(new)
    total = np.add.reduceat(counts[order].astype(np.int64), at)
    back = np.empty(len(values), np.int64)
    back[order] = total[np.cumsum(new) - 1]
    cuts = np.cumsum([len(p) for p in parts])[:-1]
    of = classes[order][at]
    tokens = np.bincount(of, total, A.CLASSES).astype(np.int64)
    distinct = np.bincount(of, total > 0, A.CLASSES).astype(np.int64)
    return pa.table({
        "block": pa.array([*table["block"].to_pylist(), None], pa.int32()),
        "range": pa.array([*table["range"].to_pylist(), None], pa.int32()),
        "counts": pa.array([*[_numbers(p) for p in np.split(back, cuts)], None], pa.binary()),
        "tokens": pa.array([*[None] * len(parts), tokens], pa.list_(pa.int64())),
        "distinct": pa.array([*[None] * len(parts), distinct], pa.list_(pa.int64())),
    })


# ------------------------------------------------------------ scores
def class_scores(params: A.Params, lead: np.ndarray, tail: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Log10 probabilities of the classes ``lead``, and of each text's end after its words.

    Text ``i`` has the words ``ptr[i]`` to ``ptr[i + 1]``; its values, one more
    than its words, start at ``ptr[i] + i``.
    """
    A.touch_buffers()
    size = np.diff(ptr) + 1
    starts = ptr[:-1] + np.arange(len(size))
    # inputs run one place behind targets: the start, then the words
    total = int(size.sum())
    first = np.zeros(total, bool)
    first[starts] = True
    target, before, before_tail = np.full(total, A.END), np.full(total, A.START), np.zeros(total, np.int64)
    ends = np.zeros(total, bool)
    ends[starts + size - 1] = True
    target[~ends] = lead
    before[~first], before_tail[~first] = lead, tail
    # windows: the first of a text scores all its places, the next ones the last ``_MOVE``
    more = np.maximum(0, -(-(size - A.CONTEXT) // _MOVE))
    text = np.repeat(np.arange(len(size)), more + 1)
    number = np.arange(len(text)) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
    at = starts[text] + number * _MOVE
    skip = np.where(number == 0, 0, A.CONTEXT - _MOVE)
    length = np.minimum(A.CONTEXT, starts[text] + size[text] - at)
    out = np.zeros(total)
    for width, later in product((4, 8, 16, A.CONTEXT), (False, True)):
        # short windows are not padded to the full context; those of one batch have the same context
        of = np.flatnonzero((length <= width) & (length > (0 if width == 4 else width // 2)) & ((number > 0) == later))
        for i in range(0, len(of), _BATCH):
            some = of[i : i + _BATCH]
            place = np.minimum(at[some, None] + np.arange(width), (starts + size - 1)[text[some], None])
            found = A.log_probabilities(params, before[place], before_tail[place], target[place], skip[some])
            kept = np.arange(width) >= skip[some, None]
            inside = (np.arange(width) < length[some, None])[kept]
            out[place[kept][inside]] = found[inside]
    return out / np.log(10)


def _score(params, chosen, tokens, distinct, n_ends: int, n_ranges: int, schema: T.StructType):
    n_train = int(tokens.sum()) + n_ends
    n_distinct = int(distinct.sum()) + (n_ends > 0)
    all_base = np.log10(n_train + n_distinct + 1)
    in_class = np.log10(tokens + distinct + 1.0)

    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        words, _ = _words(docs)
        # what a word is read as, once for each distinct word
        values, first, at = _distinct(words)
        classes, tails = _classes(words.hashes(_PIECE, some=first), chosen)[at], _tails(words, first)[at]
        order, bounds = by_range(values, n_ranges)
        counts = np.zeros(len(values), np.int64)
        for r, data in zip(answers["range"].to_pylist(), answers["counts"].to_pylist()):
            n = bounds[r + 1] - bounds[r]
            counts[order[bounds[r] : bounds[r + 1]]] = np.frombuffer(data, np.uint32 if len(data) == 4 * n else np.uint64)
        own = np.log10(counts + 1.0)[at]
        ptr, n = words.ptr, np.diff(words.ptr) + 1
        total = lambda x, p: (c := np.concatenate([[0.0], np.cumsum(x)]))[p[1:]] - c[p[:-1]]
        base = total(own, ptr) + np.log10(n_ends + 1.0) - n * all_base
        by_class = class_scores(params, classes, tails, ptr)
        model = total(by_class, ptr + np.arange(len(ptr))) + total(own - in_class[classes], ptr)
        known = total((counts > 0)[at], ptr) + (n_ends > 0)
        made = {
            "n_tokens": n, "n_known": known.astype(np.int64), "train_tokens": np.full(len(n), n_train),
            "base_score": base, "score": model,
        }
        arrow = to_arrow_schema(schema)
        return pa.Table.from_arrays([
            docs[f.name].combine_chunks().cast(f.type) if f.name in docs.column_names else pa.array(made[f.name], f.type)
            for f in arrow
        ], schema=arrow)

    return score


def score_texts(
    docs: DataFrame, folds: int = 7, held_out: int = 2, key: str = "doc_id", text: str = "text", attend: bool = True,
) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Documents whose crc32(key) modulo ``folds`` is ``held_out`` teach nothing. Without ``attend`` the classes have
    their shares in training documents as probabilities, whatever stands before: what attention is measured against.
    """
    left_out = F.coalesce(crc_part(key, folds) == held_out, F.lit(False))
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), left_out.alias("held_out"))
    plan = layout(docs)
    learn = docs.where(~F.col("held_out"))

    gathered = materialize(learn.select("text").mapInArrow(_gather, "lead long, number long").groupBy("lead").agg(
        F.sum("number").alias("number")), "leads")
    top = gathered.orderBy(F.desc("number"), "lead").limit(A.CLASSES - 2)
    best = {r["lead"]: r["number"] for r in top.collect()}
    chosen = np.sort(np.array(list(best), np.int64).view(np.uint64))
    windows = materialize(learn.select("text").mapInArrow(_windows(chosen), "window binary"), "windows")
    n_ends = learn.count()

    shares = np.zeros(A.CLASSES)
    shares[: len(chosen)] = [best[int(c)] for c in chosen.view(np.int64)]
    everything = gathered.agg(F.sum("number")).first()[0] or 0
    shares[A.OTHER], shares[A.END] = everything - shares.sum(), n_ends
    params = A.initial(shares)
    if not attend:
        params["u"] *= 0
        params["groups"] *= 0
    params = A.flat(params)
    trainers = _trainers(windows.count())
    # dealt by place in the written table, so that copies of one text do not meet in one trainer
    dealt = windows.withColumn("place", F.monotonically_increasing_id()).select(
        "window", F.pmod(F.xxhash64("place"), F.lit(trainers)).alias("trainer"),
        F.pmod(F.xxhash64("place", F.lit(1)), F.lit(_ROUNDS)).alias("turn"),
    )
    for turn in range(_ROUNDS if attend else 0):
        part = dealt.where(F.col("turn") == turn)
        mean = part.groupBy("trainer").applyInArrow(
            _train(params, 0.01 / (turn + 1)), "place long, value double"
        ).groupBy("place").agg(F.avg("value").alias("value")).collect()
        for row in mean:
            params[row["place"]] = row["value"]

    blocks = deal(docs.withColumn("learn", ~F.col("held_out")), plan.n_blocks, "key").groupBy("block")
    answers = materialize(
        blocks.applyInArrow(
            _ask(chosen, plan.n_ranges), "block int, range int, values binary, counts binary, classes binary"
        ).groupBy("range").applyInArrow(
            _answer, "block int, range int, counts binary, tokens array<long>, distinct array<long>"
        ), "counts",
    )
    tokens, distinct = np.zeros(A.CLASSES, np.int64), np.zeros(A.CLASSES, np.int64)
    sums = answers.where("block is null").select(
        F.posexplode(F.arrays_zip("tokens", "distinct")).alias("class", "n")
    ).groupBy("class").agg(F.sum("n.tokens").alias("tokens"), F.sum("n.distinct").alias("distinct"))
    for row in sums.collect():
        tokens[row["class"]], distinct[row["class"]] = row["tokens"], row["distinct"]

    schema = T.StructType([docs.schema["key"], *T.StructType.fromDDL(
        "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )])
    counts = answers.where("block is not null").select("block", "range", "counts").groupBy("block")
    scored = blocks.cogroup(counts).applyInArrow(
        _score(A.shaped(params), chosen, tokens, distinct, n_ends, plan.n_ranges, schema), schema
    )
    return scored.withColumnRenamed("key", key)
