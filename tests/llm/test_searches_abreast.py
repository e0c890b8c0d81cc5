"""Many searches in one R-tree at once, against one scan each."""

import numpy as np
import pytest

from hitscope.llm import hard_negatives as hn


@pytest.mark.parametrize("seed, coarse", [(1, False), (2, True), (3, True)])
def test_equal_to_a_scan(seed, coarse):
    rng = np.random.default_rng(seed)
    points = np.floor(rng.normal(size=(1500, 5)) * (2 if coarse else 300))
    ids, labels = rng.permutation(9000)[:1500], rng.integers(0, 4, 1500)
    tree = hn.RTree(points, ids, labels, leaf=16, fanout=4)
    asked = np.arange(0, 1500, 30)
    own, label, queries = ids[asked], labels[asked], points[asked]
    least, most = -400.0 * rng.random((len(asked), 3)), 900.0 * rng.random((len(asked), 3))
    windows = np.stack([least, most], axis=2)
    windows[::2, 2] = np.inf, -np.inf  # no score lies there
    windows[:, 0] = -np.inf, np.inf
    at, j, scores, found = tree.search_all(queries, lambda l, i, at: (l != label[at]) & (i != own[at]), windows, 4)
    for q in range(len(asked)):
        every = points @ queries[q]
        for w in range(3):
            fits = np.flatnonzero((every >= windows[q, w, 0]) & (every <= windows[q, w, 1]) & (labels != label[q]) & (ids != own[q]))
            first = fits[np.lexsort((ids[fits], -every[fits]))][:4]
            mine = (at == q) & (j == w)
            assert found[mine].tolist() == ids[first].tolist() and scores[mine].tolist() == every[first].tolist()


def test_leaves_are_read_for_many_searches_at_once():
    """Vectors in all directions, where boxes rule out little: products of a leaf are taken for many anchors together."""

    class Counted(np.ndarray):
        products = 0

        def __matmul__(self, other):
            Counted.products += 1
            return np.asarray(self) @ np.asarray(other)

    rng = np.random.default_rng(4)
    points = np.floor(rng.normal(size=(2048, 32)) * 100)
    tree = hn.RTree(points, np.arange(2048), np.zeros(2048, np.int64))
    tree.points = tree.points.view(Counted)
    windows = np.broadcast_to([-np.inf, np.inf], (128, 1, 2))
    tree.search_all(points[:128], lambda l, i, at: i != at, windows, 5)
    assert tree.opened > 128 * 16 and Counted.products < tree.opened / 8
