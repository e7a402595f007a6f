from itertools import combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import packing
from ledgerlens.llm.tokens import encoder, vocabulary_path


def padded(bounds, histogram):
    return sum(n * (min(b for b in bounds if b >= size) - size) for size, n in histogram.items())


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 50), min_size=1, max_size=8), st.integers(1, 5))
def test_boundaries_are_optimal(histogram, buckets):
    got = packing.optimal_boundaries(list(histogram), list(histogram.values()), buckets)
    assert len(got) <= buckets and max(got) == max(histogram) and set(got) <= set(histogram)
    top = max(histogram)
    best = min(padded([*c, top], histogram) for k in range(min(buckets, len(histogram)))
               for c in combinations([x for x in histogram if x != top], k))
    assert padded(got, histogram) == best


def test_no_lengths():
    assert packing.optimal_boundaries([], [], 4) == []


@pytest.mark.parametrize("budget", [64, 1])
def test_every_token_is_packed_once(frame, budget):
    packed = encoder(vocabulary_path()).packed
    rows = [(i, f"word {i} " * (i % 37)) for i in range(120)] + [(None, None), (3, "again"), (500, "long " * 700)]
    got = packing.pack(frame(rows), max_length=100, buckets=4, batch_tokens=budget).collect()
    sizes = {}
    for i, t in rows:
        sizes.setdefault(i, []).append(len(packed(t or "")) // 4 + 1)
    total = {}
    for r in got:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
        assert r.start == 100 * r.segment and r.length <= r.bucket_length and r.padding == r.bucket_length - r.length
    assert total == {i: sum(n) for i, n in sizes.items()}
    histogram = {}
    for r in got:
        histogram[r.length] = histogram.get(r.length, 0) + 1
    bounds = packing.optimal_boundaries(list(histogram), list(histogram.values()), 4)
    assert {r.bucket_length for r in got} == set(bounds)
    batches = {}
    for r in got:
        batches.setdefault((r.bucket, r.batch), []).append(r)
    for (bucket, batch), members in batches.items():
        rows_each = max(1, budget // members[0].bucket_length)
        assert sorted(m.position for m in members) == list(range(len(members)))
        assert len(members) <= rows_each
        assert len(members) == rows_each or (bucket, batch + 1) not in batches
    assert packing.pack(frame([])).count() == 0
