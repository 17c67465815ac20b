"""Similarity join on word n-grams: prefix lists, size bands, bitmap bounds, exact sets.

A document's set holds the hashes of its distinct ``size``-word shingles
(lower-cased); with fewer words its whole sequence is the one element. Documents
link if their Jaccard similarity is at least ``percent`` per cent.

1. Documents with equal sets form a class; all further work is on classes, so
   copies cost nothing. Each class has its size and a bitmap: bit i is the parity
   of its elements that hash to i, with two bits or more per element.
2. Of its elements in a global order a set shows only a prefix, short enough
   that two similar sets must share an element of their prefixes. Values seen
   often come last in that order, so shared boilerplate rarely shows. Prefixes
   travel packed by value range, not as one row per element.
3. In a value's list classes lie in bands of comparable size. First every class
   meets three leaders of its band (a few pairs per class, however large the band). What
   that links forms components. Then each class outside the main component of its
   lists meets its most promising partner, and last all classes of one list that are
   still in different components meet, bitmap against bitmap within the list: no
   pair within a component is looked at again, no pair that shares a prefix element
   and may link is left out, and only pairs whose bitmaps let them link come out.
4. A pair of bitmaps differs in at most as many bits as the sets differ in
   elements, which bounds the overlap from above. Pairs that may still link are
   put into tiles of a leader and a bounded number of partners, where the sorted
   sets are intersected.

Null and empty texts have no elements, link with nothing and are their own
component. Rows with a null id get a null component and link nothing. Several
rows with one id are judged each by its text; repeated rows are copies. An empty
table stays empty. The bitmap of wanted documents and the list of frequent
values are bounded by parameters; they save work and decide nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.llm.blocks import layout
from tagwright.llm.components import components
from tagwright.llm.words import Words, chunks, find, give_back, lower, mix, windows
from tagwright.workspace import materialize

#: frequent values that come last in the order: at most so many, seen so often
_FREQUENT, _OFTEN = 1 << 17, 4
#: bytes of text whose prefixes are held at once
_PREFIX_BYTES = 1_000_000
#: bytes of text in which values are counted together: what is seen once in so much is not frequent
_SEEN_BYTES = 2_000_000
#: marks a size where the value is early enough for the set to be the smaller of a pair
_EARLY = 1 << 30
#: bits of the broadcast bitmap of wanted documents
_WANTED_BITS = 1 << 23
#: pairs of a leader in one tile, rows of a group of tiles, members of a list in one tile
_TILE, _GROUP, _LIST_TILE = 256, 256, 4096


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's shingles."""
    words = Words([lower(t) for t in texts])
    hashes = words.hashes()
    found = windows(hashes, size)
    out = []
    for a, b in zip(words.ptr[:-1].tolist(), words.ptr[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(found[a : b - size + 1]))
        elif b > a:
            out.append(mix(windows(hashes[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(found[:0])
    return out


def class_of(values: np.ndarray) -> int:
    """A 64-bit digest of a set, as a signed number."""
    total = np.array([len(values)], np.uint64) + mix(values).sum(dtype=np.uint64)
    return int(mix(total).view(np.int64)[0])


def bitmap(values: np.ndarray) -> bytes:
    """Parities of the set's elements by hash, in a power of two of bits: two to four for an element, 64 at least."""
    bits = max(64, 2 << max(0, len(values) - 1).bit_length())
    counts = np.bincount((values % np.uint64(bits)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def differing_bits(a: bytes, b: bytes) -> int:
    """In how many bits two bitmaps differ, the longer one folded to the length of the other."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    n = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(v.reshape(-1, n), axis=0) for v in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


# ------------------------------------------------------------ 1. classes
def _describe(size: int):
    def run(batches):
        for batch, texts in chunks(batches, _SEEN_BYTES):
            sets = shingle_sets(texts, size)
            sizes = np.array([len(s) for s in sets], np.int64)
            classes = [class_of(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(pa.int64()), pa.array(sizes), pa.array(classes, pa.int64()),
                pa.array([bitmap(s) if len(s) else None for s in sets], pa.binary()),
                pa.nulls(len(sets), pa.int64()), pa.nulls(len(sets), pa.int64()),
            ], names=_DESCRIBED)
            # values found in two different sets of the batch
            distinct = list({c: s for c, s in zip(classes, sets) if c is not None}.values())
            if distinct:
                values, seen = np.unique(np.concatenate(distinct), return_counts=True)
                values, seen = values[seen > 1], seen[seen > 1]
                none = lambda t: pa.nulls(len(values), t)
                yield pa.RecordBatch.from_arrays([
                    none(pa.int64()), none(pa.int64()), none(pa.int64()), none(pa.binary()),
                    pa.array(values.view(np.int64)), pa.array(seen.astype(np.int64)),
                ], names=_DESCRIBED)

    return run


_DESCRIBED = ["doc_id", "n", "class", "bits", "value", "seen"]


# ------------------------------------------------------------ 2. prefixes
def _prefixes(size: int, percent: int, frequent: np.ndarray, n_ranges: int):
    def run(batches):
        for _, texts in chunks(batches, _PREFIX_BYTES):
            values, classes, sizes, seen = [], [], [], set()
            for s in shingle_sets(texts, size):
                n = len(s)
                c = class_of(s) if n else None
                if c is None or c in seen:
                    continue
                seen.add(c)
                if len(frequent):
                    often = np.zeros(n, bool)
                    often[find(frequent, s)[0]] = True
                    s = np.concatenate([s[~often], s[often]])
                # two similar sets share a value among the first of each; the smaller one has
                # it earlier, as the overlap must be 2p / (1 + p) of its size or more
                s = s[: n - -(-percent * n // 100) + 1]
                early = n - -(-2 * percent * n // (100 + percent)) + 1
                values.append(s)
                classes.append(np.full(len(s), c, np.int64))
                sizes.append(np.where(np.arange(len(s)) < early, n | _EARLY, n).astype(np.int32))
            if not values:
                continue
            v, c, n = map(np.concatenate, (values, classes, sizes))
            of = (v % np.uint64(n_ranges)).astype(np.int32)
            order = np.argsort(of, kind="stable")
            v, c, n, of = v[order], c[order], n[order], of[order]
            bounds = np.searchsorted(of, np.arange(n_ranges + 1))
            some = np.flatnonzero(np.diff(bounds))
            cut = lambda x: pa.array([x[bounds[r] : bounds[r + 1]].tobytes() for r in some], pa.binary())  # noqa: E731,B023
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), cut(v), cut(c), cut(n)], names=["range", "values", "classes", "sizes"]
            )

    return run


# ------------------------------------------------------------ 3. lists and pairs
def _lists(percent: int):
    """The lists of two classes and more in one value range, and each class with its band's leader."""
    def run(table: pa.Table) -> pa.Table:
        join = lambda name, t: np.concatenate([np.frombuffer(b.as_py(), t) for b in table[name]])
        v, c, n = join("values", np.uint64), join("classes", np.int64), join("sizes", np.int32).astype(np.int64)
        early, n = n >= _EARLY, n % _EARLY
        order = np.lexsort((c, n, v))
        v, c, n, early = v[order], c[order], n[order], early[order]
        new = np.ones(len(v), bool)
        new[1:] = (v[1:] != v[:-1]) | (c[1:] != c[:-1])
        v, c, n, early = v[new], c[new], n[new], early[new]
        starts = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        lengths = np.diff(np.append(starts, len(v)))
        rank = mix(c.view(np.uint64))
        ranks = rank, mix(rank), mix(mix(rank))
        two = starts[lengths == 2]
        two = two[early[two] & (percent * n[two + 1] <= 100 * n[two])]
        pairs, lists = [np.stack([c[two], c[two + 1]], axis=1)], []
        for a, size in zip(starts[lengths > 2].tolist(), lengths[lengths > 2].tolist()):
            # a member stays if it may be the smaller one of a pair or has such a partner
            f, m = early[a : a + size], n[a : a + size]
            smaller = np.concatenate([[0], np.maximum.accumulate(np.where(f, m, 0))[:-1]])
            larger = np.append(percent * m[1:] <= 100 * m[:-1], False)
            at = a + np.flatnonzero((percent * m <= 100 * smaller) | f & larger)
            if len(at) < 2:
                continue
            if len(at) == 2:
                pairs.append(c[None, at])
                continue
            lists.append((c[at], n[at] + _EARLY * early[at]))
            sizes, first = n[at], 0
            while first < len(at):
                # a band reaches from its smallest size to the largest that may link with it
                to = int(np.searchsorted(sizes, sizes[first] * 100 // percent, side="right"))
                band = at[first:to]
                for order in ranks:
                    lead = int(np.argmin(order[band]))
                    others = np.delete(c[band], lead)
                    pairs.append(np.stack([np.full(len(others), c[band[lead]]), others], axis=1))
                first = to
        found = np.unique(np.sort(np.concatenate(pairs), axis=1), axis=0)
        del v, c, n, early, order, new, rank, ranks
        give_back()
        k = len(lists)
        return pa.table({
            "a": pa.concat_arrays([pa.array(found[:, 0]), pa.nulls(k, pa.int64())]),
            "b": pa.concat_arrays([pa.array(found[:, 1]), pa.nulls(k, pa.int64())]),
            "classes": pa.concat_arrays([pa.nulls(len(found), _LONGS), pa.array([x for x, _ in lists], _LONGS)]),
            "sizes": pa.concat_arrays([pa.nulls(len(found), _LONGS), pa.array([x for _, x in lists], _LONGS)]),
        })

    return run


_LONGS = pa.list_(pa.int64())


def _meetings(percent: int, best: bool):
    """Pairs of one list that are not in one component and that size and bitmaps
    let link; with ``best`` only each member's most promising one."""
    def meet(n, early, root, bits):
        # by size, so bitmaps of one length stand together; the next length is twice as long or more
        lengths = np.array([len(b) for b in bits])
        blocks = {}
        for size in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == size)
            own = np.frombuffer(b"".join(bits[i] for i in at), np.uint64).reshape(len(at), -1)
            blocks[size] = int(at[0]), own
        reach = np.searchsorted(n, n * 100 // percent, side="right")
        for i in np.flatnonzero(early[:-1]).tolist():
            size = int(lengths[i])
            first, own = blocks[size]
            mine = own[i - first]
            differ = [np.bitwise_count(own[i + 1 - first : reach[i] - first] ^ mine).sum(1, dtype=np.int64)]
            if reach[i] > first + len(own):
                # comparable sets have at most twice the bits: fold those
                after, longer = blocks[2 * size]
                folded = longer[: reach[i] - after, : size // 8] ^ longer[: reach[i] - after, size // 8 :]
                differ.append(np.bitwise_count(folded ^ mine).sum(1, dtype=np.int64))
            total = n[i] + n[i + 1 : reach[i]]
            overlap = (total - np.concatenate(differ)) // 2
            may = (root[i + 1 : reach[i]] != root[i]) & (100 * overlap >= percent * (total - overlap))
            j = np.flatnonzero(may)
            if len(j):
                yield np.full(len(j), i), j + i + 1, overlap[j] / (total[j] - overlap[j])

    def run(batches):
        for batch in batches:
            pairs = []
            for members in batch.column(0).to_pylist():
                members.sort(key=lambda m: (m["n"] % _EARLY, m["class"]))
                c, n, root = (np.array([m[k] for m in members], np.int64) for k in ("class", "n", "root"))
                met = list(meet(n % _EARLY, n >= _EARLY, root, [m["bits"] for m in members]))
                if not met:
                    continue
                x, y, bound = map(np.concatenate, zip(*met))
                if best:
                    both, at = np.concatenate([x, y]), np.tile(np.arange(len(x)), 2)
                    order = np.lexsort((at, -bound[at], both))
                    keep = np.unique(at[order][np.unique(both[order], return_index=True)[1]])
                    x, y = x[keep], y[keep]
                pairs.append(np.sort(np.stack([c[x], c[y]], axis=1), axis=1))
            if pairs:
                found = np.unique(np.concatenate(pairs), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    return run


def _apart(members: DataFrame, classes: DataFrame, roots: DataFrame, percent: int, best: bool) -> DataFrame:
    """Pairs (a, b) of classes of one list that ``_meetings`` finds.

    A list's main component is that of most of its members. Members in it lie in
    one tile of the list each, the others in all of its tiles: every pair of two
    components meets, and a tile holds a bounded share of the main component.
    With ``best`` two lists are enough for each class outside the main component.
    """
    rooted = materialize(
        members.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class")),
        "members",
    )
    lists = rooted.groupBy("list", "root").agg(F.count("*").alias("k")).groupBy("list").agg(
        F.sum("k").alias("size"), F.max_by("root", F.struct("k", "root")).alias("main"), F.count("*").alias("roots")
    ).where("roots > 1").select("list", "main", F.ceil(F.col("size") / _LIST_TILE).alias("tiles"))
    split = rooted.join(lists, "list")
    if best:
        # by a hash of the list, so that members of one group choose the same lists
        least = lambda i: F.min_by("list", F.xxhash64("list", F.lit(i)))
        chosen = split.where("root <> main").groupBy("class").agg(F.array(least(0), least(1)).alias("list"))
        split = split.join(chosen.select(F.explode("list").alias("list")).distinct(), "list")
    own = F.array(F.pmod(F.xxhash64("class"), F.col("tiles")))
    every = F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)
    tiled = split.withColumn("tile", F.explode(F.when(F.col("root") == F.col("main"), own).otherwise(every)))
    return tiled.join(classes.select("class", "bits"), "class").groupBy("list", "tile").agg(
        F.collect_list(F.struct("class", "n", "root", "bits")).alias("members")
    ).select("members").mapInArrow(_meetings(percent, best), "a long, b long").distinct()


# ------------------------------------------------------------ 4. bounds and exact sets
def _may_link(percent: int):
    def run(batches):
        for batch in batches:
            na, nb = (batch.column(i).to_numpy() for i in (2, 3))
            differ = np.array([
                differing_bits(x, y) for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())
            ], np.int64)
            overlap = (na + nb - differ) // 2
            ok = 100 * overlap >= percent * (na + nb - overlap)
            yield batch.filter(pa.array(ok)).select([0, 1, 6, 7])

    return run


def _only(bits: np.ndarray):
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            mask = bits[np.mod(ids, len(bits))]
            yield batch.filter(pa.array(mask))

    return run


def _intersect(size: int, percent: int):
    def run(table: pa.Table) -> pa.Table:
        wanted = set(table["class"].to_pylist())
        rows, texts = table.select(["lead", "class"]).to_pylist(), table["text"].combine_chunks().cast(pa.binary()).to_pylist()
        sets = {}
        # several rows may have one id: the class tells which text is meant
        distinct = list({t for t in texts if t})
        for at in range(0, len(distinct), 200):
            for s in shingle_sets(distinct[at : at + 200], size):
                if len(s) and (c := class_of(s)) in wanted:
                    sets[c] = s
        out = set()
        for row in rows:
            a, b = row["lead"], row["class"]
            if a != b and a in sets and b in sets and (a, b) not in out:
                x, y = sets[a], sets[b]
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= percent * (len(x) + len(y) - common):
                    out.add((a, b))
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return run


def _verify(docs: DataFrame, classes: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that link."""
    side = lambda s: classes.select(
        F.col("class").alias(s), F.col("n").alias(f"n{s}"), F.col("bits").alias(f"bits{s}"), F.col("doc_id").alias(f"doc{s}")
    )
    pairs = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "bitsa", "bitsb", "doca", "docb")
    left = materialize(pairs.mapInArrow(_may_link(percent), "a long, b long, doca long, docb long"), "pairs")
    n_pairs = left.count()
    if not n_pairs:
        return left.select("a", "b")
    tiles = left.groupBy("a").agg(F.ceil(F.count("*") / _TILE).alias("tiles"))
    put = left.join(tiles, "a").withColumn("tile", F.pmod(F.xxhash64("b"), "tiles"))
    rows = put.select(F.col("a").alias("lead"), "tile", F.col("docb").alias("doc_id"), F.col("b").alias("class")).union(
        put.select("a", "tile", "doca", "a").distinct()
    )
    words = left.select(F.explode(F.array("doca", "docb")).alias("d")).select(
        F.pmod("d", F.lit(_WANTED_BITS)).alias("bit")
    ).groupBy(F.floor(F.col("bit") / 64).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits")
    ).collect()
    bits = np.zeros(_WANTED_BITS // 64, np.int64)
    for row in words:
        bits[row["word"]] = row["bits"]
    wanted = np.unpackbits(bits.view(np.uint8), bitorder="little").astype(bool)
    texts = docs.where("doc_id is not null").mapInArrow(_only(wanted), docs.schema)
    n_groups = max(1, 2 * n_pairs // _GROUP)
    group = F.pmod(F.xxhash64("lead", "tile"), F.lit(n_groups)).alias("part")
    return (
        rows.join(texts, "doc_id").select(group, "lead", "class", "text").groupBy("part")
        .applyInArrow(_intersect(size, percent), "a long, b long")
    )


def similar_components(
    docs: DataFrame, size: int = 5, percent: int = 75, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    n_ranges = layout(docs).n_ranges
    described = materialize(docs.mapInArrow(
        _describe(size), "doc_id long, n long, class long, bits binary, value long, seen long"
    ), "sets")
    rows = described.where("n is not null")
    often = described.where("value is not null").groupBy("value").agg(F.sum("seen").alias("seen"))
    often = often.where(F.col("seen") >= _OFTEN).orderBy(F.desc("seen"), "value").limit(_FREQUENT)
    frequent = np.sort(np.array([r["value"] for r in often.select("value").collect()], np.int64).view(np.uint64))

    # copies are one class; its text is that of the smallest id
    classes = materialize(
        rows.where("class is not null and doc_id is not null").groupBy("class")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bits").alias("bits")), "classes",
    )
    known = docs.where("doc_id is not null")
    shared = materialize(
        known.mapInArrow(
            _prefixes(size, percent, frequent, n_ranges), "range int, values binary, classes binary, sizes binary"
        ).groupBy("range").applyInArrow(_lists(percent), "a long, b long, classes array<long>, sizes array<long>"), "lists",
    )
    # values with the same classes are one list; a class is early in it if it is for one of them
    members = shared.where("a is null").select(
        F.xxhash64("classes").alias("list"), F.xxhash64("sizes").alias("flags"), "classes", "sizes"
    ).dropDuplicates(["list", "flags"]).select("list", F.explode(F.arrays_zip("classes", "sizes")).alias("m")).groupBy(
        "list", F.col("m.classes").alias("class")).agg(F.max("m.sizes").alias("n"))
    tested = shared.where("a is not null").select("a", "b").distinct()
    roots = components(_verify(known, classes, tested, size, percent))
    # leaders first, then the most promising partners, then all that are still apart
    for best in (True, False):
        pairs = _apart(members, classes, roots, percent, best)
        pairs = materialize(pairs.join(tested, ["a", "b"], "left_anti"), "apart")
        tested = tested.union(pairs)
        # what was linked before stands as one star a component, so that only new links take rounds
        linked = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = components(linked.union(_verify(known, classes, pairs, size, percent)))

    joined = classes.select("class", F.col("doc_id").alias("first")).join(
        roots.withColumnRenamed("node", "class"), "class", "left"
    ).withColumn("root", F.coalesce("root", "class"))
    least = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    found = joined.join(least, "root").select("class", "component_id")
    return rows.select("doc_id", F.col("n").alias("n_shingles"), "class").join(found, "class", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def keep_first(docs: DataFrame, size: int = 5, percent: int = 75, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of the smallest id of each component, all columns as they are; rows with a null id stay."""
    gone = similar_components(docs, size, percent, key, text).where("component_id != doc_id")
    gone = materialize(gone.select(F.col("doc_id").alias("__gone")).distinct(), "gone")
    return docs.join(gone, docs[key] == gone["__gone"], "left_anti")
