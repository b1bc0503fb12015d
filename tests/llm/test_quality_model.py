"""Boosted trees: held-out accuracy, and batch traversal against single steps."""

import zlib

import numpy as np

from rankstream.llm import catalog, quality_model as m


def test_traversal_equals_single_steps():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, len(m.FEATURES)))
    x[:, 3] = np.round(x[:, 3])
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0)).astype(float)
    trees = m.fit(x, y, trees=15)
    scores = trees.scores(x)
    for row, score in zip(x[:50], scores):
        margin = trees.base
        for node in trees.roots:
            while trees.left[node] != node:
                side = trees.left if row[trees.feature[node]] <= trees.threshold[node] else trees.right
                node = side[node]
            margin += trees.value[node]
        assert abs(1 / (1 + np.exp(-margin)) - score) < 1e-9
    assert ((scores > 0.5) == y).mean() > 0.95


def direct_split(x, g, h, cuts):
    """(feature, threshold) of the largest gain over every cut, rows masked one cut at a time."""
    best, found = 1e-6, None
    total = g.sum() ** 2 / (h.sum() + m.SHRINK)
    for f, bounds in enumerate(cuts):
        for c in bounds:
            low = x[:, f] <= c
            if min(low.sum(), (~low).sum()) < m.LEAST:
                continue
            gain = sum(g[s].sum() ** 2 / (h[s].sum() + m.SHRINK) for s in (low, ~low)) - total
            if gain > best + 1e-9:
                best, found = gain, (f, c)
    return found


def test_histogram_splits_are_the_best_of_all_cuts():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 6))
    x[:, 2] = rng.integers(0, 3, 400)
    y = ((x[:, 0] + x[:, 2] > 1) ^ (rng.random(400) < 0.1)).astype(float)
    bins, depth, rate = 12, 3, 0.2
    trees = m.fit(x, y, trees=4, depth=depth, bins=bins, rate=rate)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(6)]
    margin, splits = np.full(len(x), trees.base), 0
    for root in trees.roots:
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        update = np.zeros(len(x))
        open_ = [(int(root), np.arange(len(x)), depth)]
        while open_:
            node, rows, left = open_.pop()
            best = direct_split(x[rows], g[rows], h[rows], cuts) if left and len(rows) >= 2 * m.LEAST else None
            if best is None:
                assert trees.left[node] == node
                update[rows] = rate * g[rows].sum() / (h[rows].sum() + m.SHRINK)
                assert abs(trees.value[node] - update[rows[0]]) < 1e-12
                continue
            splits += 1
            assert (trees.feature[node], trees.threshold[node]) == best
            low = x[rows, best[0]] <= best[1]
            open_ += [(int(trees.left[node]), rows[low], left - 1), (int(trees.right[node]), rows[~low], left - 1)]
        margin = margin + update
    assert splits > 8


def test_degenerate_labels():
    x = np.zeros((30, len(m.FEATURES)))
    assert m.fit(x[:0], np.zeros(0)).scores(x[:2]).tolist() == [0.5, 0.5]
    assert (m.fit(x, np.ones(30)).scores(x) > 0.9).all()


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, 0), (2, "", 0), (None, "some words", 0), (3, "a" * 300_000, 0), (3, "a" * 300_000, 0)],
        "doc_id long, text string, label int",
    )
    labels = spark.createDataFrame([(1, None), (None, 1), (77, 1), (1, 1), (1, 0), (3, 0)], "doc_id long, quality int")
    rows = m.scored(docs, labels).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert m.scored(docs.limit(0), labels).collect() == []
    assert {r.score for r in m.scored(docs, labels.limit(0)).collect()} == {0.5}


def test_held_out_accuracy(spark, sf_dir):
    rows = catalog.QUERIES["op3_boosted_quality"](spark, sf_dir).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.predicted == (r.score >= 0.7)
    judged = [r for r in rows if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in judged)
    assert right >= 0.9 * len(judged)


def test_held_out_labels_teach_nothing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    seen = labels.filter("crc32(encode(cast(doc_id as string), 'utf-8')) % 4 <> 2")
    x1, y1 = m.training_rows(docs, labels)
    x2, y2 = m.training_rows(docs, seen)
    assert np.array_equal(x1, x2) and np.array_equal(y1, y2)
    assert len(m.training_rows(docs, labels, most=10)[1]) <= 10
