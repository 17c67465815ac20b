"""Conversation trie, whitening and token files on odd rows, against plain Python."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tagwright.llm import char_poly, conversation_trie, token_files, whitening
from tagwright.llm.byte_words import ByteWords
from tagwright.llm.ternary import TernaryTree
from tagwright.llm.words import Words, run_hashes
from tagwright.workspace import scratch_path
from tests.llm import plain
from tests.llm.conftest import SCHEMA, frame

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(BYTE_BPE)


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


# ------------------------------------------------------------ 11
def odd_conversations():
    """Null and equal turns, null and empty parts, shared beginnings, copies, long and missing conversations."""
    rng, rows = random.Random(2), []
    for c in range(230):
        if rng.random() < 0.1:
            continue
        base = rng.choice([0, 1, 2])
        for t in range(rng.choice([1, 2, 4, 5, 8, 8, 9, 12, 30])):
            text = f"{base if t < 8 else rng.choice([base, c])} {'é' * t}" if t != 3 else None
            rows.append((c, t if t else None, "u" if t % 2 else None, text))
    rows += [(None, 1, "u", "x"), (1000, 5, "a", ""), (1000, 5, "a", "b"), (1000, 5, "a", "b"), (-7, 1, "u", "q"), (-100, 1, "u", "z")]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def talks(spark):
    rows = odd_conversations()
    table = spark.createDataFrame(
        [(c, t, r, x, "extra", 1) for c, t, r, x in rows],
        "conv_id long, turn long, role string, text string, depth string, id int").repartition(3)
    return rows, conversation_trie.numbered_turns(table)


def nodes(df):
    return sorted((tuple(r[c] for c in plain.NODE) for r in df.collect()), key=str)


@pytest.mark.parametrize("segment, shard", [(1024, 100_000), (1024, 30), (4, 25)])
def test_trie_of_odd_conversations(talks, segment, shard):
    rows, numbered = talks
    turns, members = conversation_trie.own_turns(numbered)
    assert nodes(conversation_trie.prefix_trie(turns, members, segment, shard)) == plain.trie(plain.conversations(rows))


def test_trie_of_rebuilt_conversations(talks):
    rows, numbered = talks
    got = conversation_trie.prefix_trie(*conversation_trie.rebuilt_turns(numbered), segment=7, shard_ids=40)
    assert nodes(got) == plain.trie(plain.rebuilt(rows))


def test_trie_of_nothing(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    numbered = conversation_trie.numbered_turns(empty)
    assert conversation_trie.prefix_trie(*conversation_trie.rebuilt_turns(numbered)).collect() == []


@settings(max_examples=50, deadline=None)
@given(st.sets(st.lists(st.integers(0, 4), max_size=6).map(tuple), min_size=1))
def test_ternary_tree_holds_what_was_put_in(sequences):
    ordered = sorted(sequences)
    tree = TernaryTree.balanced(ordered)
    assert [tree.end[tree.path(s)[-1]] for s in ordered] == list(range(len(ordered)))
    order, parent, depth = tree.above()
    assert len(order) + 1 == len(tree.symbol) == len({s[:d] for s in ordered for d in range(len(s) + 1)})
    assert all(depth[at] == depth[parent[at]] + 1 for at in order)


def test_ternary_tree_is_balanced():
    tree = TernaryTree.balanced([(i,) for i in range(1023)])
    depth, level = 0, [tree.down[0]]
    while level:
        depth, level = depth + 1, [n for at in level for n in (tree.low[at], tree.high[at]) if n >= 0]
    assert depth == 10


# ------------------------------------------------------------ 12
def whitened(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, n string")
    vectors = df.select("vec_id", "n", whitening.whole_vectors(df["embedding"]).alias("vector")).repartition(3)
    fit = whitening.fit_whitening(vectors, **kw)
    return whitening.whiten(vectors, fit).collect(), fit


def test_whitening_of_odd_rows(spark):
    """Nulls, non-finite parts, shorter vectors, repeated rows, one vector under several ids, far-away columns."""
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6) * [1, 2, 3, 0.1, 0, 5] + [0, 50, 0, 0, 0, -9]]) for i in range(60)]
    rows += [(60, rows[0][1]), (0, rows[0][1]), (61, rows[3][1][:4]), (62, []), (None, rows[5][1])]
    rows += [(70, None), (71, [1.0, None, 2.0, 0.0, 0.0, 0.0]), (72, [float("nan")] * 6), (73, [float("inf")] * 6)]
    got, fit = whitened(spark, rows)
    known = [r for r in got if r["vec_id"] is not None]
    assert len(got) - len(known) == 4 and len(known) == 4 * 64
    distinct = {(i, tuple(v)) for i, v in rows if v is not None and i is not None}
    seen, single = set(), []
    for r in known:
        if (r["vec_id"], r["component"]) not in seen:
            seen.add((r["vec_id"], r["component"]))
            single.append(r)
    plain.check_whitened(single, [(i, list(v)) for i, v in distinct])


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3, [(1, None)], [(1, [])]])
def test_whitening_without_spread(spark, rows):
    assert whitened(spark, rows)[0] == []


def test_whitening_with_equal_variances(spark):
    """Four corners of a square and a flat third dimension: any two orthonormal axes, and no third component."""
    rows = [(i, [x, y, 1.0]) for i, (x, y) in enumerate([(1, 1), (1, -1), (-1, 1), (-1, -1)])]
    got, fit = whitened(spark, [(i, [float(c) for c in v]) for i, v in rows])
    assert len(got) == 8 and fit.explained == pytest.approx([0.5, 0.5]) and fit.identity_error < 1e-12
    white = np.array([r["whitened"] for r in sorted(got, key=lambda r: (r["component"], r["vec_id"]))]).reshape(2, 4)
    assert white @ white.T / 4 == pytest.approx(np.eye(2), abs=1e-12)


def test_whitening_of_large_numbers(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=3) * 1e9]) for i in range(20)]
    got, _ = whitened(spark, rows)
    assert len(got) == 60 and all(r["deviation"] is None for r in got) and got[0]["identity_error"] < 1e-9


@pytest.mark.parametrize("size", [1, 2, 7])
def test_polynomial_is_exact(size):
    rng = np.random.default_rng(size)
    x = rng.integers(-50, 50, (20, size)).astype(object)
    matrix = x.T @ x
    primes = char_poly.primes_below(1 << 31, 2 + char_poly.coefficient_bits(int(np.trace(matrix)), size) // 30)
    found = char_poly.combine({p: char_poly.polynomial_modulo(matrix, p) for p in primes})
    # the polynomial of a matrix is zero at the matrix
    total, power = np.zeros((size, size), object), np.eye(size, dtype=int).astype(object)
    for c in found:
        total, power = total + c * power, power @ matrix
    assert not total.any() and found[-1] == 1 and found[-2] == -int(np.trace(matrix))


def test_roots_with_multiplicity():
    matrix = np.diag([5, 5, 5, 3, 0, 0]).astype(object)
    roots = char_poly.Roots(char_poly.combine({p: char_poly.polynomial_modulo(matrix, p) for p in char_poly.primes_below(1 << 31, 3)}))
    bounds = [roots.largest(k) for k in range(1, 5)]
    assert roots.positive == 4 and bounds[0] == bounds[1] == bounds[2]
    assert [float(b) for _, b in bounds] == pytest.approx([5, 5, 5, 3])
    space = char_poly.null_vectors(matrix, sum(bounds[0]) / 2, 3)
    assert space @ space.T == pytest.approx(np.eye(3)) and np.abs(space[:, 3:]).max() < 1e-12


def test_primes():
    assert char_poly.primes_below(30, 4) == [29, 23, 19, 17]


# ------------------------------------------------------------ 13
@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=2500))
def test_blocks_come_back(ids):
    ids = np.array(ids, "<u4")
    blocks = token_files.pack_blocks(ids)
    starts = np.cumsum([0, *map(len, blocks)])[:-1].tolist()
    assert np.array_equal(token_files.unpack_blocks(b"".join(blocks), starts), ids) if len(ids) else not blocks


def test_outliers_are_patches():
    """A few large ids cost their own bytes, not everyone's width."""
    ids = np.arange(1024, dtype="<u4") % 16
    ids[::100] = 1 << 30
    assert len(token_files.pack_blocks(ids)[0]) < 1024 * 4 // 8 + 11 * 6 + 16


def test_a_file_from_any_place(tmp_path):
    ids = np.random.default_rng(2).integers(0, 50_000, 700_000).astype("<u4")
    path = tmp_path / "x.pfor"
    writer = token_files.Writer(path.open("wb"))
    for at in range(0, len(ids), 70_000):
        writer.add(pa.array([at]), np.array([70_000]), ids[at : at + 70_000])
    writer.close()
    reader = token_files.open_file(str(tmp_path), "x.pfor")
    for start, count in ((0, 5), (1023, 2), (345_678, 4000), (699_990, 50), (700_000, 1)):
        assert np.array_equal(reader.ids(start, count), ids[start : start + count])
    assert reader.documents()["n_tokens"].to_pylist() == [70_000] * 10
    path.write_bytes(path.read_bytes()[:-1])
    with pytest.raises(ValueError, match="not a file of token blocks"):
        token_files.open_file(str(tmp_path), "x.pfor")


@pytest.mark.parametrize("file_ids", [token_files.FILE_IDS, 5_000])
def test_token_files_of_odd_rows(spark, odd_rows, file_ids):
    """In the order of keys, nulls first; equal keys in some order, each once; small files too."""
    rows = [*odd_rows, (None, "no key"), (7, "a second seven"), (4, "one")]
    folder = scratch_path(spark, "odd_tokens")
    written = token_files.write_ids(frame(spark, rows).repartition(3), BYTE_BPE, folder, file_ids=file_ids)
    got = token_files.read_ids(written, folder, SCHEMA["doc_id"].dataType).collect()
    assert len(got) == len(rows) and (written.count() > 1) == (file_ids < 10_000)
    want = sorted((i is not None, i or 0, library(t) + [2]) for i, t in rows)
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, list(r["ids"])) for r in got) == want
    ordered, start = sorted(got, key=lambda r: r["start"]), 0
    assert [r["doc_id"] or -1 for r in ordered] == sorted(r["doc_id"] or -1 for r in got)
    sums = {r["start"]: r["ids_crc32"] for r in token_files.read_checksums(written, folder, SCHEMA["doc_id"].dataType).collect()}
    for r in ordered:
        assert r["start"] == start and sums[start] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        start += r["n_tokens"]


def test_token_files_of_nothing(spark):
    folder = scratch_path(spark, "no_tokens")
    written = token_files.write_ids(spark.createDataFrame([], SCHEMA), BYTE_BPE, folder)
    assert token_files.read_checksums(written, folder, SCHEMA["doc_id"].dataType).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(list("ab.,'s \n\t\x85  　é3<!") + ["<|endoftext|>"]), max_size=40).map("".join), min_size=1, max_size=4))
def test_words_give_the_librarys_ids(texts):
    ids, bounds = WORDS.encode([t.encode() for t in texts])
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [library(t) for t in texts]


WORDS = ByteWords(BYTE_BPE)


# ------------------------------------------------------------ hashes
def thue_morse(n, letters):
    return [letters[bin(i).count("1") % 2] for i in range(n)]


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_no_pattern_makes_hashes_agree(n):
    """Sums weighted by powers of an odd number agree on these two; block by block they do not."""
    a, b = ("".join(thue_morse(n, x)) for x in ("ab", "ba"))
    first, second = Words([f"{a} {b}".encode()]).hashes()
    assert first != second
    found = Words([" ".join([*a, *b]).encode()]).hashes()
    runs = run_hashes(found, np.array([0, n]), np.array([n, 2 * n]))
    assert runs[0] != runs[1]


def test_hashes_depend_on_the_word_alone():
    words = [b"a", b"abcdefgh", b"abcdefghi", b"x" * 64, b"x" * 65, b"x" * 1000, b"x" * 1001, "é漢".encode()]
    found = Words([b" ".join(words), b"q " + b"\n".join(words[::-1])])
    by = {}
    for i, h in enumerate(found.hashes().tolist()):
        by.setdefault(found.word(i), set()).add(h)
    assert all(len(v) == 1 for v in by.values()) and len({h for v in by.values() for h in v}) == len(words) + 1
    assert Words([b"abcdef"]).hashes(3)[0] == Words([b"abc"]).hashes()[0]
    assert Words([b"abcdef"]).hashes(3, tail=True)[0] == Words([b"def"]).hashes()[0]


def test_counts_beyond_32_bits():
    from tagwright.llm import attention as A
    from tagwright.llm import lm_scoring

    value = np.array([77], np.uint64).tobytes()
    table = pa.table({
        "block": pa.array([1, 2], pa.int32()), "range": pa.array([0, 0], pa.int32()), "values": [value, value],
        "counts": [np.array([3_000_000_000], np.uint32).tobytes()] * 2, "classes": [np.array([A.OTHER], np.uint8).tobytes()] * 2,
    })
    answer = lm_scoring._answer(table)["counts"][0].as_py()
    assert np.frombuffer(answer, np.uint64).tolist() == [6_000_000_000]
