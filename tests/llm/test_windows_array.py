"""The suffix array of op8: repeated windows only, in order to the segments' ends, and no more sorting than that takes."""

import random

import numpy as np
import pytest

from hitscope.llm import suffix_dedup


@pytest.mark.parametrize("length", [1, 2, 3, 4, 5, 7, 8, 13])
def test_order_and_shared_lengths(length):
    r = random.Random(length)
    for _ in range(60):
        segments = [bytes(r.choices(b"ab\xff\x00", weights=[8, 4, 1, 1], k=r.randint(length, 3 * length + 2))) for _ in range(r.randint(1, 6))]
        array = suffix_dedup.windows_array(segments, length)
        suffixes = [s[at:] for s in segments for at in range(len(s) - length + 1)]
        heads = [x[:length] for x in suffixes]
        # Ends of segments share nothing, so only suffixes with an equal window are there.
        assert len(array.order) == sum(heads.count(h) > 1 for h in heads)
        found = []
        for p, own in zip(array.order.tolist(), array.owner[array.order].tolist()):
            found.append(segments[own][p - int(array.starts[own]) :])
        assert sorted(found) == sorted(x for x in suffixes if heads.count(x[:length]) > 1)
        for i, common in enumerate(array.shared.tolist()):
            both = zip(found[i - 1], found[i]) if i else ()
            assert common == next((k for k, (x, y) in enumerate(both) if x != y), min(map(len, found[i - 1 : i + 1])) if i else 0)
        # Suffixes that share a prefix of a window or more stand side by side.
        for i in range(len(found)):
            for j in range(i + 1, len(found)):
                a, b = found[i], found[j]
                common = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
                if common >= length:
                    assert array.shared[i + 1 : j + 1].min() == common


def test_suffixes_that_differ_are_not_sorted_again(monkeypatch):
    r = random.Random(1)
    segments = [r.randbytes(560) for _ in range(200)]
    sorted_rows, real = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda a, *args, **more: sorted_rows.append(len(a)) or real(a, *args, **more))
    assert not len(suffix_dedup.windows_array(segments, 400).order)
    assert sum(sorted_rows) < 2 * sum(map(len, segments))
