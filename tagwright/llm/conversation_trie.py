"""The prefix tree of conversations: one row per distinct beginning, with what sharing it saves.

A turn (role and text) is known by a digest, and the distinct digests by number
(the dictionary), so texts are read once and never shuffled. A conversation is
a sequence of such numbers, in rows of at most 1,024 of them ("segments"), so a
conversation of any length is in no single row or task. The distinct segments
that follow the same beginning are sorted and range-partitioned; runs of them
with at most ``SHARD_IDS`` numbers are the shards. Each shard builds a ternary
search tree (medians first, so it is balanced), and one pass without recursion
adds up members, children, leaves and savings from the leaves to the root.

Only the nodes on a shard's first and last path can lie in other shards too.
Those are merged by key: members add up, and each border between neighbouring
shards corrects what both counted. Let the last path of one and the first of
the next share p turns. A shared node at depth d then has one child too many if
d < p, one leaf too many if the last path ends at depth p (the next goes on),
and its savings lack the length of the shared turns from d to p: (a - 1) +
(b - 1) is one less than (a + b) - 1 for each of them.

Conversations of more than one segment go on below the node where the segment
ends. Deeper trees are built first and hand their totals up. A conversation
that no other shares its beginning with is a chain: its nodes are written down
directly, so levels are as many as the longest *shared* beginning needs.

Rows without ``conv_id`` are left out. A null turn comes first; turns of equal
number follow the digest of role and text. Null role or text is empty, so a
null and an empty text are the same turn. Repeated rows are turns of their own.
Texts may have any length, other columns are ignored. An empty table has no
conversations and so no nodes, not even the root.
"""

from __future__ import annotations

import hashlib
import struct

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagwright.llm.ternary import TernaryTree
from tagwright.workspace import materialize

#: turns in one row, and numbers of turns in one shard
SEGMENT, SHARD_IDS = 1024, 100_000
#: conversations whose numbers are joined into one text before hashing
_CHUNK = 4096
_POS_BITS = 33

_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
_PIECE = (
    f"{_NODE}, key binary, parent_key binary, class_key binary, tree binary, part int, shard int, "
    "first_keys array<binary>, last_keys array<binary>, lengths array<long>"
)
_PIECE_ARROW = pa.schema([
    *[(n, pa.int64()) for n in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")],
    *[(n, pa.binary()) for n in ("key", "parent_key", "class_key", "tree")], ("part", pa.int32()), ("shard", pa.int32()),
    ("first_keys", pa.list_(pa.binary())), ("last_keys", pa.list_(pa.binary())), ("lengths", pa.list_(pa.int64())),
])
_SUMS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]


# ------------------------------------------------------------ turns by number
def _positions(placed: DataFrame, place: str) -> DataFrame:
    """``index``: rows before this one in a written table whose parts are in order."""
    part = F.shiftrightunsigned(place, _POS_BITS)
    counts = placed.groupBy(part.alias("part")).count().orderBy("part").collect()
    offsets, total = [], 0
    for row in counts:
        offsets.append((row["part"], total))
        total += row["count"]
    table = placed.sparkSession.createDataFrame(offsets, "part long, offset long")
    at = F.col(place).bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    # one row per written part
    return placed.join(F.broadcast(table), part == F.col("part")).withColumn("index", F.col("offset") + at).drop(
        "part", "offset", place)


def numbered_turns(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv_id, index, id, chars``: all turns in a global order by conversation and turn, and the number of each
    distinct turn in the dictionary."""
    who, said = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "digest"]
    turns = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        F.unhex(F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256)).alias("digest"),
        F.length(said).cast("long").alias("chars"),
    )
    placed = materialize(
        turns.repartitionByRange(*order).sortWithinPartitions(*order).select(
            "conv_id", "digest", "chars", F.monotonically_increasing_id().alias("place")),
        "turns",
    )
    dictionary = materialize(
        placed.select("digest").distinct().select("digest", F.monotonically_increasing_id().alias("id")), "turn_ids"
    )
    return _positions(placed, "place").join(dictionary, "digest").select("conv_id", "index", "id", "chars")


def own_turns(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, depth, id, chars`` and ``conv_id, length`` of the conversations as they are."""
    members = materialize(numbered.groupBy("conv_id").agg(F.min("index").alias("first"), F.count("id").alias("length")), "members")
    turns = numbered.join(members, "conv_id").select("conv_id", (F.col("index") - F.col("first") + 1).alias("depth"), "id", "chars")
    return turns, members.select("conv_id", "length")


def rebuilt_turns(numbered: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """As :func:`own_turns`, of conversations whose first turns are those of their group's first conversation.

    Conversation c begins with the first h turns of c - c % ``group`` (h: crc32 of c's decimals modulo ``most``; the
    remainder has the sign of c, as in SQL) and
    goes on with its own after its first h.
    """
    c = F.col("conv_id")
    counted = numbered.groupBy("conv_id").agg(F.min("index").alias("first"), F.count("id").alias("n"))
    counted = materialize(counted.select(
        "*", (F.crc32(c.cast("string").cast("binary")) % most).alias("h"), (c - c % group).alias("base")), "members")
    bases = counted.where(c == F.col("base")).select("base", F.col("n").alias("n_base"))
    taken = F.least("h", F.coalesce("n_base", F.lit(0).cast("long")))
    members = materialize(counted.join(bases, "base", "left").withColumn("taken", taken).withColumn(
        "length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "members")
    position = (F.col("index") - F.col("first") + 1).alias("position")
    own = numbered.join(members.select("conv_id", "first", "h", "taken"), "conv_id").select("*", position).where(
        F.col("position") > F.col("h")).select("conv_id", (F.col("taken") + F.col("position") - F.col("h")).alias("depth"), "id", "chars")
    heads = numbered.where(c % group == 0).join(members.select("conv_id", "first"), "conv_id").select(
        F.col("conv_id").alias("base"), position, "id", "chars").where(F.col("position") < most)
    # fewer than ``most`` turns a conversation, given to at most ``group`` others
    heads = heads.groupBy("base").agg(F.collect_list(F.struct("position", "id", "chars")).alias("head"))
    given = members.where("taken > 0").join(heads, "base").select(
        "conv_id", F.explode(F.filter("head", lambda t: t["position"] <= F.col("taken"))).alias("t")).select(
        "conv_id", F.col("t.position").alias("depth"), "t.id", "t.chars")
    return own.unionByName(given), members.select("conv_id", "length")


# ------------------------------------------------------------ segments
def _segments(turns: DataFrame, members: DataFrame, longest: int, size: int) -> DataFrame:
    """``conv_id, seg, ids, chars, last, root_key, class_key``: the rows of each conversation.

    The last one has fewer than ``size`` turns, maybe none. ``root_key`` stands for all turns before the segment,
    ``class_key`` for those up to its end.
    """
    rows = turns.groupBy("conv_id", F.floor((F.col("depth") - 1) / size).alias("seg")).agg(
        F.sort_array(F.collect_list(F.struct("depth", "id", "chars"))).alias("t")
    ).select("conv_id", "seg", F.transform("t", lambda t: t["id"]).alias("ids"), F.transform("t", lambda t: t["chars"]).alias("chars"))
    none = F.array().cast("array<long>")
    rows = rows.unionByName(members.where(F.col("length") % size == 0).select(
        "conv_id", F.floor(F.col("length") / size).alias("seg"), none.alias("ids"), none.alias("chars")))
    digest = F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)
    rows = rows.withColumns({f"h{k}": F.xxhash64("seg", digest, F.lit(k)).cast("decimal(38,0)") for k in (1, 2)})

    def key(number: Column, *sums: Column) -> Column:
        return F.unhex(F.sha2(F.concat_ws("|", number.cast("string"), *[s.cast("string") for s in sums]), 256))

    zero = F.lit(0).cast("decimal(38,0)")
    start, last = key(F.lit(0), zero, zero), F.size("ids") < size
    columns = ["conv_id", "seg", "ids", "chars", last.alias("last")]

    def keyed(df, before, upto):
        root = F.when(F.col("seg") == 0, start).otherwise(key(F.col("seg"), *before))
        return df.select(*columns, root.alias("root_key"), F.when(F.size("ids") == 0, root).otherwise(
            key(F.col("seg") + 1, *upto)).alias("class_key"))

    short = rows if longest < size else rows.where((F.col("seg") == 0) & last)
    out = keyed(short, [zero, zero], [F.col("h1"), F.col("h2")])
    if longest >= size:
        run = Window.partitionBy("conv_id").orderBy("seg")
        upto = [F.sum(f"h{k}").over(run).cast("decimal(38,0)").alias(f"s{k}") for k in (1, 2)]
        sums = rows.where((F.col("seg") > 0) | ~last).select("*", *upto)
        # an empty segment adds nothing to the turns before it, and its own key is its root's
        out = out.unionByName(keyed(sums, [F.col("s1") - F.col("h1"), F.col("s2") - F.col("h2")], [F.col("s1"), F.col("s2")]))
    return out


# ------------------------------------------------------------ trees
def _chain(tree: bytes, ids: list[int]) -> list[bytes]:
    keys = [hashlib.sha256(b"tree" + tree).digest()]
    for i in ids:
        keys.append(hashlib.sha256(keys[-1] + struct.pack("<q", i)).digest())
    return keys


def shard_rows(tree: bytes, rows: list[dict], depth: int, part: int, shard: int) -> pa.RecordBatch:
    """Nodes of one shard, totals below included; those on its first and last path with keys, for merging."""
    sequences = [r["ids"] for r in rows]
    t = TernaryTree.balanced(sequences)
    size = len(t.symbol)
    order, parent, below = t.above()
    first, last = (t.path(s) for s in (sequences[0], sequences[-1]))
    length, key = [0] * size, {}
    keys = [_chain(tree, s) for s in (sequences[0], sequences[-1])]
    for path, chain in zip((first, last), keys):
        key.update(zip(path, chain))
    n, least, children, leaves, saved, ends = [0] * size, [None] * size, [0] * size, [0] * size, [0] * size, [None] * size
    # a symbol's length is that of any sequence through it
    for number in range(size):
        if t.end[number] >= 0:
            at, row = number, rows[t.end[number]]
            for chars in reversed(row["chars"]):
                if length[at]:
                    break
                length[at], at = chars, parent[at]
    for at in [*reversed(order), 0]:
        if t.end[at] >= 0:
            row = rows[t.end[at]]
            n[at] += row["n"]
            least[at] = row["conv"] if least[at] is None else min(least[at], row["conv"])
            ends[at] = row["class_key"]
            if not row["last"]:
                children[at], leaves[at], saved[at] = row["n_children"], row["n_leaves"], row["saved_tokens"]
        if not children[at] and not leaves[at]:
            leaves[at] = 1
        if at:
            saved[at] += (n[at] - 1) * length[at]
            up = parent[at]
            n[up] += n[at]
            least[up] = least[at] if least[up] is None else min(least[up], least[at])
            children[up] += 1
            leaves[up] += leaves[at]
            saved[up] += saved[at]
    nodes = [0, *order]
    border = [at in key for at in nodes]
    up_key = [key.get(parent[at]) if at else None for at in nodes]
    lengths = [0]
    for at in last[1:]:
        lengths.append(lengths[-1] + length[at])
    pick = lambda values: [*[values[at] for at in nodes], None]
    empty = [None] * len(nodes)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip([
        pick(least), [*[depth + below[at] for at in nodes], None],
        [*[None if k is not None or not at else least[parent[at]] for at, k in zip(nodes, up_key)], None],
        pick(n), pick(children), pick(leaves), pick(saved),
        [*[key.get(at) for at in nodes], None], [*up_key, None], pick(ends),
        [*[tree if b else None for b in border], tree], [*empty, part], [*empty, shard],
        [*empty, keys[0]], [*empty, keys[1]], [*empty, lengths],
    ], _PIECE_ARROW)], schema=_PIECE_ARROW)


def _forest(rows: DataFrame, depth: int, shard_ids: int) -> tuple[DataFrame, DataFrame]:
    """Nodes within shards, with ``parent_key`` where their parent is merged; and merged nodes, with ``key``."""
    def run(batches):
        part, shard, tree, held, size = TaskContext.get().partitionId(), 0, None, [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if held and (row["root_key"] != tree or size + len(row["ids"]) > shard_ids):
                    yield shard_rows(tree, held, depth, part, shard)
                    shard, held, size = shard + 1, [], 0
                tree = row["root_key"]
                held.append(row)
                size += 1 + len(row["ids"])
        if held:
            yield shard_rows(tree, held, depth, part, shard)

    order = ["root_key", "ids"]
    pieces = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, _PIECE), "trie")
    inside = pieces.where(F.col("conv_id").isNotNull() & F.col("key").isNull())
    parts = pieces.where(F.col("key").isNotNull())
    # one row per shard
    borders = pieces.where(F.col("first_keys").isNotNull()).withColumn(
        "next", F.lead("first_keys").over(Window.partitionBy("tree").orderBy("part", "shard"))).where(F.col("next").isNotNull())
    shared = borders.withColumn("p", F.size(F.array_intersect("last_keys", "next")) - 1).select(
        "p", "lengths", "last_keys", F.posexplode(F.slice("last_keys", 1, F.col("p") + 1)).alias("d", "key"))
    minus = lambda when: F.when(when, F.lit(-1)).otherwise(F.lit(0)).cast("long")
    fixes = shared.select(
        "key", F.lit(0).cast("long").alias("n_convs"), minus(F.col("d") < F.col("p")).alias("n_children"),
        minus(F.size("last_keys") == F.col("p") + 1).alias("n_leaves"),
        (F.get("lengths", F.col("p")) - F.get("lengths", F.greatest(F.col("d") - 1, F.lit(0)))).alias("saved_tokens"),
    )
    merged = parts.unionByName(fixes, allowMissingColumns=True).groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), *[F.sum(c).alias(c) for c in _SUMS],
        F.max("parent_key").alias("parent_key"), F.max("class_key").alias("class_key"), F.max("tree").alias("tree"),
    )
    return inside, merged


def _digests(members: DataFrame) -> DataFrame:
    """``class_key`` and the digest of its conversations' numbers, rising, joined by commas.

    Numbers are sorted over all tasks and joined into chunks; one task takes a class's chunks in order, which the
    digest's definition asks for, holding one at a time.
    """
    def chunk(batches):
        key, first, held = None, None, []

        def out():
            return pa.RecordBatch.from_pylist(
                [{"class_key": key, "first": first, "text": ",".join(held)}],
                schema=pa.schema([("class_key", pa.binary()), ("first", pa.int64()), ("text", pa.string())]))

        for batch in batches:
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != key or len(held) >= _CHUNK:
                    if held:
                        yield out()
                    key, first, held = k, c, []
                held.append(str(c))
        if held:
            yield out()

    def digest(batches):
        key, state, done = None, None, []
        schema = pa.schema([("class_key", pa.binary()), ("ends_sha256", pa.string())])
        for batch in batches:
            for k, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if k == key:
                    state.update(b",")
                else:
                    if key is not None:
                        done.append({"class_key": key, "ends_sha256": state.hexdigest()})
                    key, state = k, hashlib.sha256()
                state.update(text.encode())
            yield pa.RecordBatch.from_pylist(done, schema=schema)
            done = []
        if key is not None:
            yield pa.RecordBatch.from_pylist([{"class_key": key, "ends_sha256": state.hexdigest()}], schema=schema)

    order = ["class_key", "conv_id"]
    chunks = members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        chunk, "class_key binary, first long, text string")
    return chunks.repartition("class_key").sortWithinPartitions("class_key", "first").mapInArrow(
        digest, "class_key binary, ends_sha256 string")


def prefix_trie(
    turns: DataFrame, members: DataFrame, segment: int = SEGMENT, shard_ids: int = SHARD_IDS
) -> DataFrame:
    """The nodes of the conversations ``members`` (``conv_id, length``) with ``turns`` (``conv_id, depth, id, chars``).

    ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256`` of those that end there.
    """
    longest = members.agg(F.max("length")).first()[0] or 0
    rows = materialize(_segments(turns, members, longest, segment), "segments")
    columns = ["conv_id", "depth", "parent_conv_id", *_SUMS]
    ended = _digests(rows.where("last"))
    chain, levels = None, 1
    if longest >= segment:
        deep = rows.where("seg > 0")
        alone = deep.groupBy("root_key").agg(F.count("conv_id").alias("sharing"))
        rows = materialize(rows.join(alone, "root_key", "left").withColumn("alone", F.coalesce(F.col("sharing") == 1, F.lit(False))), "segments")
        levels = 1 + (rows.where(~F.col("alone")).agg(F.max("seg")).first()[0] or 0)
        one = F.lit(1).cast("long")
        chain = rows.where("alone").select("conv_id", "seg", "last", F.size("ids").alias("size"), F.posexplode("ids").alias("i", "id")).select(
            "conv_id", (F.col("seg") * segment + F.col("i") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"),
            one.alias("n_convs"), (F.col("last") & (F.col("i") + 1 == F.col("size"))).alias("ends"),
            one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"))
        # a chain's conversation goes on at each node unless its next segment is empty
        full = rows.where("alone").where(F.size("ids") == 0).select("conv_id", (F.col("seg") * segment).alias("depth"), F.lit(True).alias("stops"))
        chain = chain.join(full, ["conv_id", "depth"], "left").withColumn("ends", F.col("ends") | F.coalesce("stops", F.lit(False)))
        chain = chain.select(
            *columns[:3], "n_convs", F.when(F.col("ends"), 0).otherwise(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
            F.sha2(F.when(F.col("ends"), F.col("conv_id").cast("string")).otherwise(F.lit("")).cast("binary"), 256).alias("ends_sha256"))
    nodes, totals = None, None
    for level in reversed(range(levels)):
        own = rows if longest < segment else rows.where((F.col("seg") == level) & ~F.col("alone"))
        distinct = own.groupBy("root_key", "ids").agg(
            F.count("conv_id").alias("n"), F.min("conv_id").alias("conv"), F.first("chars").alias("chars"),
            F.first("last").alias("last"), F.first("class_key").alias("class_key"))
        if longest >= segment:
            # alone in the next segment: a chain, of one leaf; else what the tree there added up to
            next_one = rows.where((F.col("seg") == level + 1) & F.col("alone")).select(
                F.col("root_key").alias("class_key"), F.when(F.size("ids") > 0, 1).otherwise(0).cast("long").alias("n_children"),
                F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"))
            below = next_one if totals is None else next_one.unionByName(totals)
            distinct = distinct.join(below, "class_key", "left")
        else:
            distinct = distinct.select("*", *[F.lit(None).cast("long").alias(c) for c in _SUMS[1:]])
        inside, merged = _forest(distinct, level * segment, shard_ids)
        merged = materialize(merged, "trie_merged")
        totals = merged.where(F.col("parent_key").isNull()).select(F.col("tree").alias("class_key"), *_SUMS[1:])
        names = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("merged_conv_id"))
        kept = merged if not level else merged.where(F.col("parent_key").isNotNull())
        both = inside.where(F.col("parent_key").isNotNull()).unionByName(kept, allowMissingColumns=True).join(
            names, "parent_key", "left").withColumn("parent_conv_id", F.col("merged_conv_id"))
        found = inside.where(F.col("parent_key").isNull()).select(*columns, "class_key").unionByName(
            both.select(*columns, "class_key"))
        nodes = found if nodes is None else nodes.unionByName(found)
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    out = nodes.where(F.col("class_key").isNull()).select(*columns, nothing.alias("ends_sha256")).unionByName(
        nodes.where(F.col("class_key").isNotNull()).join(ended, "class_key", "left").select(
            *columns, F.coalesce("ends_sha256", nothing).alias("ends_sha256")))
    return out if chain is None else out.unionByName(chain)
