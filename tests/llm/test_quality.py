"""The quality model against the optimum over all labelled documents, worked out in memory."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from metricwatch.llm import quality


def documents(n, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [rng.choice(["plain", "words", "of", "Prose", "1234", "a|b", "more!!"]) for _ in range(rng.randint(1, 40))]
        label = int(rng.random() < 0.85 - 0.4 * (words.count("more!!") > len(words) / 6))
        rows.append((i, " ".join(words), label))
    return rows


def learnt(rows):
    kept = [r for r in rows if zlib.crc32(str(r[0]).encode()) % quality.FOLDS]
    return quality.features(pa.array([r[1] for r in kept])), np.array([r[2] for r in kept])


def fitted(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int").repartition(3)
    return quality.fit(frame.select("doc_id", "text"), frame.select("doc_id", "quality"))


def test_all_labelled_documents_are_learnt_from(spark, monkeypatch):
    monkeypatch.setattr(quality, "START", 40)
    rows = documents(700)
    model = fitted(spark, rows)
    x, label = learnt(rows)
    spread = np.where(x.std(0) > 1e-9, x.std(0), 1.0)
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.spread, spread)
    z = quality._expanded(x, model.mean, model.spread)
    better, worse = (i.ravel() for i in np.meshgrid(np.flatnonzero(label == 1), np.flatnonzero(label == 0)))
    gap = z[better] - z[worse]
    slope = -gap.T @ (1 / (1 + np.exp(np.clip(gap @ model.weights, -500, 500)))) / len(gap) + 1e-3 * model.weights
    assert np.abs(slope).max() < 1e-8
    assert model.threshold == pytest.approx(np.quantile(z @ model.weights, (label == 0).mean()), abs=1e-9)


def test_threshold_counts_documents_beyond_twenty_thousand(spark):
    rows = [(i, "plain words " * (1 + i % 7) + "!" * (i % 3), int(i % 11 > 0)) for i in range(26_000)]
    model = fitted(spark, rows)
    x, label = learnt(rows)
    assert len(x) > 20_000 and np.allclose(model.mean, x.mean(0), rtol=1e-12)
    raw = quality._expanded(x, model.mean, model.spread) @ model.weights
    assert model.threshold == pytest.approx(np.quantile(raw, (label == 0).mean()), abs=1e-9)


def test_every_document_meets_the_other_label(spark, monkeypatch):
    monkeypatch.setattr(quality, "BLOCK", 50)
    rows = [(i, int(i % 100 > 0), [float(i)]) for i in range(3000)]
    found = spark.createDataFrame(rows, "id long, label int, x array<double>")
    dealt = quality._dealt(found, {0: 30, 1: 2970}).collect()
    labels = {}
    for r in dealt:
        labels.setdefault(r.block, set()).add(r.label)
    assert len(labels) == 60 and all(found == {0, 1} for found in labels.values())
    assert sorted(r.id for r in dealt if r.label) == [i for i, label, _ in rows if label]
    assert {r.id for r in dealt if not r.label} == set(range(0, 3000, 100)) and len({(r.block, r.id) for r in dealt}) == len(dealt)


def test_sums_over_blocks_are_those_over_gaps(monkeypatch):
    monkeypatch.setattr(quality, "STRIP", 7)
    rng = np.random.default_rng(1)
    good, bad, w = rng.normal(size=(30, 5)), rng.normal(size=(11, 5)), rng.normal(size=5)
    gap = (good[:, None] - bad[None]).reshape(-1, 5)
    p = 1 / (1 + np.exp(gap @ w))
    loss, slope, curve, n = quality._block_sums(good, bad, w)
    assert n == 330 and loss == pytest.approx(-np.log1p(-p).sum()) and np.allclose(slope, -gap.T @ p) and np.allclose(curve, (gap * (p * (1 - p))[:, None]).T @ gap)


def test_scores_of_a_rank(spark):
    rng = np.random.default_rng(2)
    raw = np.concatenate([rng.normal(size=50), [0.0, -0.0, 1e300, -1e300, 5e-324, -5e-324], np.repeat(0.25, 20)])
    found = spark.createDataFrame([([float(v)],) for v in raw], "x array<double>").repartition(3)
    model = quality.Model(np.zeros(1), np.ones(1), np.array([1.0, 0.0]), 0.0)
    keys = quality._raw(found, model)
    ordered = np.sort(np.clip(raw, -8, 8))
    assert [quality._ranked(keys, i) for i in (0, 1, 25, 40, 74, 75)] == [ordered[i] for i in (0, 1, 25, 40, 74, 75)]
    assert quality._quantile(keys, 19, len(raw)) == pytest.approx(np.quantile(ordered, 19 / len(raw)), abs=1e-15)


def test_scores_are_those_of_the_model(spark):
    rows = documents(200)
    frame = spark.createDataFrame([*rows, (900, None, None), (None, "plain", None), (901, "", None), (3, "again", None)], "doc_id long, text string, quality int")
    docs, labels = frame.select("doc_id", "text"), frame.select("doc_id", "quality")
    given = lambda df: sorted((r.doc_id is None, r.doc_id or 0, round(r.score, 9)) for r in df.collect())
    got = quality.scores(docs, labels)
    assert got.columns == ["doc_id", "score"] and given(got) == given(quality.with_score(docs, quality.fit(docs, labels)))
    assert quality.scores(docs.limit(0), labels).count() == 0 and given(quality.scores(docs, labels.limit(0)))[0][2] == quality.ACCEPT
