"""Near vectors against the cosines of all pairs."""

import numpy as np
import pytest

from metricwatch.llm import collisions
from metricwatch.llm.queries import QUERIES


def plain(rows, threshold=0.95):
    """n_links and component of every row by all pairs; rows are (id, vector)."""
    usable = [i for i, (_, v) in enumerate(rows) if v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    longest = max((len(rows[i][1]) for i in usable), default=0)
    usable = [i for i in usable if len(rows[i][1]) == longest]
    links = {i: set() for i in range(len(rows))}
    if usable:
        x = np.array([rows[i][1] for i in usable], np.float64)
        x /= np.abs(x).max(1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for p, i in enumerate(usable):
            links[i] = {usable[q] for q in np.flatnonzero(x @ x[p] >= threshold - 1e-12).tolist() if q != p}
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        out.append((rows[i][0], len(links[i]), min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)))
    return sorted(out, key=str)


def clustered(rng, n, clusters, size=24):
    """Random vectors, and groups around some of them that reach over the threshold."""
    x = rng.normal(size=(n, size))
    for k in range(clusters):
        base = x[k] / np.linalg.norm(x[k])
        members = base + rng.normal(size=(rng.integers(2, 40), size)) * rng.uniform(0.01, 0.06)
        x = np.vstack([x, members * rng.uniform(0.1, 10, (len(members), 1))])
    return x


def frame(spark, rows, extra="x"):
    schema = "vec_id long, embedding array<double>, label int, key string, cell long, n_links int"
    return spark.createDataFrame([(i, v, 1, extra, 2, 3) for i, v in rows], schema).repartition(3)


def got(found):
    rows = found.collect()
    assert all(r.kept == (r.component_id is None or r.vec_id == r.component_id) for r in rows)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in rows), key=str)


@pytest.mark.parametrize("cell, block, n", [(4096, 4096, 400), (32, 50, 900)])
def test_links_are_those_of_all_pairs(spark, monkeypatch, cell, block, n):
    monkeypatch.setattr(collisions, "CELL", cell)
    monkeypatch.setattr(collisions, "BLOCK", block)
    monkeypatch.setattr(collisions, "COUNTED", 700)
    monkeypatch.setattr(collisions, "VERIFIED", 11)
    rng = np.random.default_rng(n)
    x = clustered(rng, n, 12)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(5000 + i, rows[7][1]) for i in range(60)]  # a large class of equal vectors
    found, wanted = got(collisions.near_vectors(frame(spark, rows))), plain(rows)
    pairs = [sum(r[1] for r in side) for side in (found, wanted)]
    assert 0.98 * pairs[1] <= pairs[0] <= pairs[1] and pairs[1] > 5000
    assert sum(a[2] == b[2] for a, b in zip(found, wanted, strict=True)) >= 0.99 * len(rows)
    assert all(a[1] <= b[1] for a, b in zip(found, wanted, strict=True))  # none below the threshold


def test_rows_that_cannot_be_compared(spark):
    some = [1.0, 2.0, 3.0]
    rows = [(1, some), (2, [2.0, 4.0, 6.0]), (2, some), (3, None), (4, []), (5, [0.0] * 3), (6, [1.0, None, 3.0])]
    rows += [(7, [1.0, float("nan"), 3.0]), (8, [float("inf"), 1.0, 1.0]), (9, [1.0, 2.0]), (None, some), (10, [1e-200, 2e-200, 3e-200])]
    rows += [(11, [1e200, 2e200, 3e200]), (None, [-1.0, 5.0, 0.0]), (12, [0.0, -0.0, 1.0]), (13, [-0.0, 0.0, 1.0])]
    assert got(collisions.near_vectors(frame(spark, rows))) == plain(rows)


def test_empty_tables(spark):
    assert collisions.near_vectors(frame(spark, [])).collect() == []
    assert got(collisions.near_vectors(frame(spark, [(1, None), (None, None)]))) == [(1, 0, 1), (None, 0, None)]


def test_collisions_are_those_of_all_windows():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(40, 6)), rng.normal(size=(60, 6))
    counts = (np.abs(a[:, None] - b[None]) <= 0.4).sum(2)
    assert set(zip(*map(np.ndarray.tolist, collisions.collided(a, b, 0.4, 3)), strict=True)) == set(zip(*map(np.ndarray.tolist, np.nonzero(counts >= 3)), strict=True))


def test_pairs_at_the_threshold_pass():
    """Of fresh pairs with exactly the threshold's cosine, in 40,000 vectors' cells, nearly all pass."""
    rng = np.random.default_rng(8)
    sample = collisions._unit(rng.normal(size=(6000, 64)) + 0.2)
    fitted = collisions.learn(sample, 40_000, 0.95)
    x = collisions._unit(rng.normal(size=(3000, 64)) + 0.2)
    aside = rng.normal(size=x.shape)
    aside = collisions._unit(aside - (aside * x).sum(1, keepdims=True) * x)
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * aside
    together = (fitted.cells(x) == fitted.cells(y)).any(1)
    counted = (np.abs(fitted.counted(x) - fitted.counted(y)) <= fitted.width).sum(1) >= fitted.need
    assert fitted.cuts.shape[1] == 4 and (together & counted).mean() >= 0.97
    others = (np.abs(fitted.counted(x) - fitted.counted(x[::-1])) <= fitted.width).sum(1) >= fitted.need
    assert others.mean() < 0.02


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = QUERIES["op12_embedding_near_dedup"](spark, sf_dir)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert got(found) == plain(rows)
