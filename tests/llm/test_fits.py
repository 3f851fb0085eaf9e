"""The fitted models against plain loops, and what they are fitted on."""

from __future__ import annotations

import math

import numpy as np
import pytest

from salesnet.llm import mil_quality, rules_forest


def network():
    rng = np.random.default_rng(3)
    owner = np.array([0, 0, 0, 1, 2, 2])
    x = rng.normal(0, 1, (len(owner), mil_quality.N_FEATURES))
    label = np.array([1.0, 0.0, 1.0])
    return mil_quality.GatedAttention(x, owner, label, epochs=3), x, owner, label


def test_attention_equals_a_loop_over_documents():
    net, x, owner, _ = network()
    p, scaled = net.p, net._scaled(x)
    for doc, got in enumerate(net.score(x, owner)):
        states, energy = [], []
        for row in scaled[owner == doc]:
            h = [math.tanh(sum(row[d] * p["W"][d][k] for d in range(len(row))) + p["a"][k]) for k in range(mil_quality.HIDDEN)]
            gated = [math.tanh(sum(h[m] * p["V"][m][k] for m in range(len(h))))
                     / (1 + math.exp(-sum(h[m] * p["G"][m][k] for m in range(len(h))))) for k in range(len(h))]
            states.append(h)
            energy.append(math.exp(sum(g * u for g, u in zip(gated, p["u"]))))
        z = [sum(e * h[k] for e, h in zip(energy, states)) / sum(energy) for k in range(mil_quality.HIDDEN)]
        assert got == pytest.approx(1 / (1 + math.exp(-sum(a * c for a, c in zip(z, p["c"])) - p["b"][0])), abs=1e-12)


def test_gradient_equals_differences():
    net, x, owner, label = network()
    scaled, starts = net._scaled(x), np.array([0, 3, 4])

    def loss():
        y = net._forward(scaled, owner, starts)[-1]
        decay = 1e-5 / 2 * ((net.p["W"] ** 2).sum() + (net.p["c"] ** 2).sum())
        return -(label * np.log(y) + (1 - label) * np.log(1 - y)).mean() + decay

    for name, gradient in net._gradient(scaled, owner, starts, label).items():
        flat = net.p[name].reshape(-1)
        for at in range(0, len(flat), max(1, len(flat) // 7)):
            kept, step = flat[at], 1e-5
            flat[at] = kept + step
            up = loss()
            flat[at] = kept - step
            down = loss()
            flat[at] = kept
            assert gradient.reshape(-1)[at] == pytest.approx((up - down) / (2 * step), abs=1e-6)


def test_the_fit_takes_whole_documents(spark, monkeypatch):
    monkeypatch.setattr(mil_quality, "FIT_PASSAGES", 12)
    monkeypatch.setattr(mil_quality, "PASSAGE_WORDS", 4)
    rows = [(1, "a " * 400), (2, "b " * 20), (2, "b " * 20), (3, ""), (4, None), (5, "c " * 21), (6, "d " * 8)]
    got = dict(mil_quality.fit_documents(spark.createDataFrame(rows, "doc_id long, text string")))
    size = {1: 100, 2: 5, 3: 1, 4: 1, 5: 6, 6: 2}
    assert 1 not in got and sum(size[i] for i in got) <= 12
    assert all(size[i] > 12 - sum(size[k] for k in got) for i in size if i not in got)
    assert mil_quality.fit_documents(spark.createDataFrame([], "doc_id long, text string")) == []


def test_a_very_long_labelled_text_leaves_the_others(spark):
    words = "some good words of a plain sentence , and then a few more of them"
    rows = [(i, words if i % 2 else "#$% <> | " * 12) for i in range(40)] + [(100, "w " * 200_000)]
    docs = spark.createDataFrame(rows + rows[:5], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(100, 0)], "doc_id long, quality int")
    score = {r["doc_id"]: r["score"] for r in mil_quality.quality_scores(docs, labels).collect()}
    assert min(score[i] for i in range(1, 40, 2)) > 0.7 > max(score[i] for i in range(0, 40, 2))


def path_length(nodes, row):
    feature, cut, left, right, path = nodes
    at, steps = 0, 0
    while feature[at] >= 0:
        at, steps = (left[at] if row[feature[at]] < cut[at] else right[at]), steps + 1
    return path[at], steps


def test_path_lengths_against_a_walk_from_the_root():
    rng = np.random.default_rng(8)
    x = rng.random((300, len(rules_forest.FEATURES)))
    forest = rules_forest.IsolationForest(x, x, trees=20, rows=64)
    probe = np.concatenate([x[:40], x[:5] + 3])

    def expected(n):
        return 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else n - 1

    for row, got in zip(probe, forest.score(probe)):
        walks = [path_length(t, row) for t in forest.trees]
        assert all(steps <= path and steps <= forest.depth for path, steps in walks)
        assert got == pytest.approx(2 ** -(np.mean([w for w, _ in walks]) / expected(64)), rel=1e-12)
    # the rows of a tree's leaves are its sample: what a leaf adds to its depth is the expected path of its rows
    own = x[:50]
    tree = forest._grow(own, own.min(axis=0), own.max(axis=0), np.random.default_rng(1))
    walks = [path_length(tree, row) for row in own]
    for path, steps in set(walks):
        assert min(abs(path - steps - expected(n)) for n in range(1, walks.count((path, steps)) + 1)) < 1e-9


def test_the_verdict_does_not_depend_on_repeated_ids(spark):
    text = "one two three four five six seven eight nine ten eleven {} twelve"
    rows = [(i, text.format(i)) for i in range(30)] + [(30 + i, "| | # $ % * & < > ! AA BB CC {}".format(i)) for i in range(10)]
    labels = spark.createDataFrame([(i, int(i < 30)) for i in range(40)], "doc_id long, quality int")
    out = []
    for extra in ([], rows[:12] * 3 + [(3, rows[3][1])] * 50):
        docs = spark.createDataFrame(rows + extra, "doc_id long, text string").repartition(7)
        forest, _ = rules_forest.fit_rules(docs, labels)
        out.append(forest.score(np.tile(np.linspace(0, 1, 9)[:, None], (1, len(rules_forest.FEATURES)))))
    assert (out[0] == out[1]).all()
