from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from agrolith.llm import pack


@given(st.dictionaries(st.integers(1, 30), st.integers(1, 9), min_size=1, max_size=9), st.integers(1, 4))
@settings(max_examples=150, deadline=None)
def test_boundaries_are_optimal(hist, k):
    from itertools import combinations

    lengths, counts = np.array(sorted(hist)), np.array([hist[x] for x in sorted(hist)])
    cost = lambda ends: sum(n * (min(e for e in ends if e >= x) - x) for x, n in hist.items())
    got = pack.boundaries(lengths, counts, k)
    best = min(cost([*c, lengths[-1]]) for r in range(k) for c in combinations(lengths[:-1].tolist(), min(r, len(lengths) - 1)))
    assert len(got) <= k and got[-1] == lengths[-1] and cost(got.tolist()) == best


@given(st.dictionaries(st.integers(1, 50), st.integers(1, 99), min_size=1, max_size=12))
@settings(max_examples=150, deadline=None)
def test_layouts_hold_all_items(hist):
    sizes = np.array(sorted(hist))
    counts = np.array([hist[x] for x in sizes])
    plan = pack.layouts(sizes, counts, 50)
    used = np.zeros(len(sizes), int)
    for layout, times in plan:
        assert sum(sizes[k] * c for k, c in layout.items()) <= 50 and times > 0
        for k, c in layout.items():
            used[k] += c * times
    assert (used == counts).all()


@pytest.mark.parametrize("salt", [200_000, 7])
def test_containers(spark, monkeypatch, salt):
    monkeypatch.setattr(pack, "ROWS_PER_SALT", salt)
    rng = np.random.default_rng(5)
    sizes = {i: int(x) for i, x in enumerate(np.minimum(rng.geometric(0.01, 1500), 900))}
    sizes |= {5000: 0, 5001: None, 5002: -3, 5003: 256, 5004: 257, 5005: 5121}
    df = spark.createDataFrame([(k, v, 1) for k, v in sizes.items()], "doc_id bigint, n bigint, piece int")
    rows = pack.fill_containers(df, "doc_id", "n", 256).collect()
    load, parts = defaultdict(int), defaultdict(list)
    for r in rows:
        load[r["container_id"]] += r["tokens"]
        parts[r["doc_id"]].append((r["piece"], r["first_token"], r["tokens"]))
    assert max(load.values()) <= 256 and min(load.values()) > 0
    assert parts.keys() == {k for k, v in sizes.items() if v and v > 0}
    for k, ps in parts.items():
        ps.sort()
        assert sum(t for *_, t in ps) == sizes[k] and [p for p, *_ in ps] == list(range(len(ps))) and all(f == 256 * p for p, f, _ in ps)
        assert len(ps) == 1 or sizes[k] > 256
    assert sum(load.values()) / (256 * len(load)) > 0.97
    assert pack.fill_containers(df.limit(0), "doc_id", "n", 256).count() == 0


def test_documents(spark, data):
    from agrolith.llm.queries import p9_containers, p9_fill

    rows = p9_containers(spark, data).groupBy("budget_id", "container_id").sum("tokens").collect()
    capacity = {1: 256, 2: 1024, 3: 4096}
    assert all(0 < r[2] <= capacity[r[0]] for r in rows)
    assert p9_fill(spark, data).count() == 3


def test_topping_up_needs_no_more_containers():
    rng = np.random.default_rng(4)
    for capacity in (10, 64, 1000):
        lengths, counts = np.unique(rng.integers(1, capacity + 1, 500), return_counts=True)
        ends = pack.boundaries(lengths, counts, 8)
        per = np.bincount(np.searchsorted(ends, lengths), weights=counts, minlength=len(ends)).astype(int)
        plain, topped = pack.plain_containers(ends, per, capacity), sum(t for _, t in pack.layouts(ends, per, capacity))
        assert int((lengths * counts).sum()) <= topped * capacity and topped <= plain
