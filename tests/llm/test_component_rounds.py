"""Components of edges that are stars already, and rounds that are left out."""

import numpy as np


def _rounds(monkeypatch, edges):
    """Roots of all nodes, and how many tables were written on the way."""
    from tagwright.llm import components as C

    written, write = [], C.materialize
    monkeypatch.setattr(C, "materialize", lambda df, name: (written.append(name), write(df, name))[1])
    found = C.components(edges).collect()
    assert len({r.node for r in found}) == len(found)
    return {r.node: r.root for r in found}, len(written)


def test_stars_take_no_rounds(spark, monkeypatch):
    """What was linked before comes as stars: without new links nothing is contracted, nor twice to see that it is done."""
    star = spark.createDataFrame([(i, i % 3 - 5) for i in range(30)], "a long, b long")
    roots, written = _rounds(monkeypatch, star)
    assert roots == {i: i % 3 - 5 for i in range(30)} | {i: i for i in (-5, -4, -3)} and written == 1
    assert _rounds(monkeypatch, star.where("a < 0")) == ({}, 1)


def test_new_links_join_stars(spark, monkeypatch):
    rng = np.random.default_rng(4)
    edges = [tuple(map(int, e)) for e in rng.integers(-60, 60, (90, 2))] + [(i, i + 1) for i in range(100, 130)] + [(7, 7), (200, 200)]
    want = {n: n for e in edges if e[0] != e[1] for n in e}
    for _ in want:
        for a, b in edges:
            if a != b:
                want[a] = want[b] = min(want[a], want[b])
    old, new = (spark.createDataFrame(e, "a long, b long") for e in (edges[::2], edges[1::2]))
    from tagwright.llm import components as C

    linked = C.components(old).selectExpr("node AS a", "root AS b")
    assert _rounds(monkeypatch, linked.union(new))[0] == want
