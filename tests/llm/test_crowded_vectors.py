"""Groups of many different near copies that link to each other, against brute force."""

import numpy as np
import pytest

from tradewind.llm import flatgraph


def unit(x):
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def planted(size, pairs, others, seed=5, spread=0.05):
    """Pairs of groups about 0.97 apart, members about 0.99 apart or less, and random vectors."""
    rng = np.random.default_rng(seed)
    out = [unit(rng.normal(size=(others, 64)))]
    for _ in range(pairs):
        centre, side = unit(rng.normal(size=(2, 64)))
        for middle in (centre, unit(centre + 0.25 * side)):
            out.append(unit(middle + spread / 8 * rng.normal(size=(size, 64)) * rng.uniform(0.5, 2.5, (size, 1))))
    x = np.concatenate(out)
    return x[rng.permutation(len(x))]


def truth(x, least=0.93):
    near = x @ x.T >= least
    np.fill_diagonal(near, False)
    root = np.arange(len(x))
    while True:
        after = np.array([min(root[i], root[near[i]].min(initial=len(x))) for i in range(len(x))])
        if (after == root).all():
            return near.sum(axis=1), root
        root = after


@pytest.mark.parametrize("size,pairs,others,shard,block", [
    (100, 5, 300, 2048, 4096), (300, 1, 100, 2048, 4096), (300, 1, 200, 200, 4096), (90, 2, 150, 2048, 120),
])
def test_groups_that_link(spark, monkeypatch, size, pairs, others, shard, block):
    monkeypatch.setattr(flatgraph, "SHARD", shard)
    monkeypatch.setattr(flatgraph, "BLOCK", block)
    x = planted(size, pairs, others)
    # Without the last resort: the graph itself has to find them.
    monkeypatch.setattr(flatgraph, "compare_all", None)
    n_links, root = truth(x)
    assert n_links.max() > size
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    out = flatgraph.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    got = {r.vec_id: (r.n_links, r.component_id) for r in out.collect()}
    assert got == {i: (int(n_links[i]), int(root[i])) for i in range(len(x))}


def test_failed_audit_compares_all(spark, monkeypatch):
    """A graph that finds nothing fails its audit, and blocks are compared with blocks."""
    none = np.zeros(0, np.int64)
    monkeypatch.setattr(flatgraph, "range_search", lambda *_: (none, none))
    monkeypatch.setattr(flatgraph, "BLOCK", 100)
    x = planted(60, 1, 200)
    n_links, root = truth(x)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)] + [(9000, [1.0] * 65, 1)]
    out = flatgraph.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    got = {r.vec_id: (r.n_links, r.component_id) for r in out.collect()}
    assert got.pop(9000) == (0, 9000)
    assert got == {i: (int(n_links[i]), int(root[i])) for i in range(len(x))}
