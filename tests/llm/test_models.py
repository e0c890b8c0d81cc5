"""The learnt models against plain versions of their arithmetic: boosted trees, the recurrent network and its gradients."""

import math

import numpy as np
from pyspark.sql import functions as F

from hitscope.llm import language_id, quality


def soft(x: float) -> float:
    return x / (1 + abs(x))


def test_trees_are_followed_as_drawn():
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(5000, 6)), 1)  # rounded, so that many values equal a threshold
    y = (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(float)
    trees = quality.fit_trees(x, y, trees=12, depth=3)
    scores = trees.score(x)
    for row, score in zip(x[:400].tolist(), scores.tolist()):
        margin = trees.start
        for feature, threshold, leaf in zip(trees.feature.tolist(), trees.threshold.tolist(), trees.leaf.tolist()):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            margin += leaf[node - len(feature)]
        assert math.isclose(score, 1 / (1 + math.exp(-margin)), rel_tol=1e-12)


def test_the_first_split_is_the_one_of_most_gain():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 12, (300, 3)).astype(float)
    y = ((x[:, 1] > 6) ^ (rng.random(300) < 0.1)).astype(float)
    trees = quality.fit_trees(x, y, trees=1, depth=1, rate=1.0)
    p = 1 / (1 + np.exp(-trees.start))
    grad, hess = p - y, np.full(len(y), p * (1 - p))

    def gain(rows):
        return grad[rows].sum() ** 2 / (hess[rows].sum() + 1)

    best = max((gain(x[:, f] <= t) + gain(x[:, f] > t), f, t) for f in range(3) for t in range(11))
    assert (trees.feature[0, 0], trees.threshold[0, 0]) == best[1:]
    for side, rows in enumerate((x[:, best[1]] <= best[2], x[:, best[1]] > best[2])):
        assert math.isclose(trees.leaf[0, side], -grad[rows].sum() / (hess[rows].sum() + 1))


def test_the_sample_is_that_of_the_smallest_hashes(spark, monkeypatch):
    """Looking only below a hash changes nothing."""
    seen = []
    monkeypatch.setattr(quality, "fit_trees", lambda x, y: seen.append((x, y)))
    width = len(quality.STATISTICS)
    stats = spark.range(3000).select(F.col("id").alias("doc_id"), F.array_repeat(F.col("id").cast("double"), width).alias("stats"))
    labels = spark.range(6000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    quality.train(stats, labels, max_rows=200)
    learnt = stats.filter(quality.id_bucket(F.col("doc_id"), 3) != 1).orderBy(F.xxhash64("doc_id")).limit(200)
    expected = [r["doc_id"] for r in learnt.collect()]
    assert seen[0][0][:, 0].tolist() == expected and seen[0][1].tolist() == [i % 2 for i in expected]


def test_probabilities_are_those_of_a_plain_network():
    """Position by position in doubles, both ways, from a zero state at each stretch; behind its end a text reads as blanks."""
    rng = np.random.default_rng(3)
    net = language_id.new_network(["a", "b", "c"], 3, rng)
    texts = [b"", b"x", bytes(rng.integers(0, 256, 100).tolist()), bytes(rng.integers(97, 123, 2 * language_id.STRETCH + 9).tolist())]
    offsets = np.cumsum([0, *map(len, texts)])
    found = language_id.document_probabilities(net, np.frombuffer(b"".join(texts), np.uint8), offsets)
    units = 3

    def states(way: int, data: bytes) -> list[list[float]]:
        table, weights = net.tables[way].astype(float), net.recurrent[way].astype(float)
        h, out = [0.0] * units, []
        for byte in data:
            pre = lambda i: sum(h[j] * weights[j, i] for j in range(units))
            z = [(soft(table[byte, i] + pre(i)) + 1) / 2 for i in range(units)]
            r = [(soft(table[byte, units + i] + pre(units + i)) + 1) / 2 for i in range(units)]
            n = [soft(table[byte, 2 * units + i] + r[i] * pre(2 * units + i)) for i in range(units)]
            h = [h[i] + z[i] * (n[i] - h[i]) for i in range(units)]
            out.append(h)
        return out

    for text, row in zip(texts, found):
        total = np.zeros(3)
        for low in range(0, len(text), language_id.STRETCH):
            part = text[low : low + language_id.STRETCH]
            padded = part.ljust(language_id.STRETCH, b" ")
            onward, backward = states(0, padded), states(1, padded[::-1])[::-1]
            for t in range(len(part)):
                logits = np.array([*onward[t], *backward[t]]) @ net.out + net.bias
                total += np.exp(logits) / np.exp(logits).sum()
        assert np.allclose(row, total / max(1, len(text)), atol=1e-5)


def test_gradients_are_those_of_small_steps():
    rng = np.random.default_rng(4)
    net = language_id.new_network(["a", "b"], 3, rng)
    table, recurrent = net.tables[0].astype(float), net.recurrent[0].astype(float)
    x = rng.integers(97, 101, (7, 5)).astype(np.uint8)  # few bytes, so that rows of the table add up
    weights = rng.normal(size=(7, 5, 3))
    states, steps = language_id._forward_training(table, recurrent, x)
    found = language_id._backward_training(table, recurrent, x, states, steps, weights)

    def loss() -> float:
        return float((language_id._forward_training(table, recurrent, x)[0][1:] * weights).sum())

    for parameter, gradient in zip((table, recurrent), found):
        cells = [(r, c) for r in (range(97, 101) if parameter is table else range(3)) for c in range(9)]
        for cell in cells:
            kept, sides = parameter[cell], []
            for step in (1e-5, -1e-5):
                parameter[cell] = kept + step
                sides.append(loss())
            parameter[cell] = kept
            assert math.isclose(gradient[cell], (sides[0] - sides[1]) / 2e-5, rel_tol=1e-3, abs_tol=1e-5)
