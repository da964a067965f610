from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from agrolith.operators.copydiff import diff_copies, unequal

SCHEMA = "id bigint, name string, xs array<string>, x double, row_key int, loaded_at timestamp"


def frame(spark, rows):
    from datetime import datetime

    return spark.createDataFrame([(*r, datetime(2024, 1, 1 + i % 9)) for i, r in enumerate(rows)], SCHEMA)


def test_every_case(spark):
    a = [(1, "a", ["p", "q"], 1.0, 5), (1, "a", ["p", "q"], 1.0, 5), (2, None, None, None, None), (3, "é", [], float("nan"), 1), (4, "only main", None, 1.0, 1), (6, "a", ["p", None], 1.0, 1), (None, "no key", None, None, None), (7, "", None, 0.0, 1)]
    b = [(1, "a", ["q", "p"], 1.0, 5), (2, "", None, None, None), (3, "é", [], float("nan"), 1), (5, "only copy", None, 1.0, 1), (6, "a", ["p", None], 2.0, None), (7, None, [], 0.0, 1)]
    got = Counter(map(tuple, diff_copies(frame(spark, a), frame(spark, b), "id").collect()))
    want = [(1, "differs", "xs"), (2, "differs", "name"), (3, "differs", "name"), (4, "missing_in_copy", ""), (5, "missing_in_main", ""), (6, "differs", "x"), (6, "differs", "row_key"), (7, "differs", "name"), (7, "differs", "xs")]
    assert got == Counter(want)


def test_empty_sides_and_hot_key(spark):
    a = frame(spark, [(1, "a", None, 1.0, 1)] * 3000 + [(2, "b", None, None, None)])
    assert sorted(map(tuple, diff_copies(a, a.limit(0), "id").collect())) == [(1, "missing_in_copy", ""), (2, "missing_in_copy", "")]
    assert diff_copies(a, a, "id").count() == 0
    assert diff_copies(a.limit(0), a.limit(0), "id").count() == 0


@given(st.lists(st.tuples(st.one_of(st.none(), st.lists(st.one_of(st.none(), st.sampled_from("ab")), max_size=3)), st.one_of(st.none(), st.lists(st.one_of(st.none(), st.sampled_from("ab")), max_size=3))), max_size=12))
@settings(max_examples=150, deadline=None)
def test_unequal_lists(pairs):
    a, b = (pa.chunked_array([pa.array([p[i] for p in pairs], pa.list_(pa.string()))]) for i in (0, 1))
    assert list(unequal(a, b)) == [x != y for x, y in pairs]


def test_unequal_numbers():
    a, b = (pa.chunked_array([pa.array(x, pa.float64())]) for x in ([1.0, None, float("nan"), 2.0, None], [1.0, None, float("nan"), None, 3.0]))
    assert list(unequal(a, b)) == [False, False, False, True, True]
    assert unequal(a, b).dtype == np.bool_


def test_nulls_that_change_places_are_differences(spark):
    schema = "id bigint, a string, b string, xs array<string>, loaded_at timestamp"
    left = spark.createDataFrame([(1, "x", None, None, None), (2, "x", "y", [None, "a"], None), (3, None, "", [], None), (4, "ab", "c", ["a,b"], None)], schema)
    right = spark.createDataFrame([(1, None, "x", None, None), (2, "x", "y", ["a", None], None), (3, "", None, None, None), (4, "a", "bc", ["a", "b"], None)], schema)
    got = Counter(map(tuple, diff_copies(left, right, "id").collect()))
    assert got == Counter([(1, "differs", "a"), (1, "differs", "b"), (2, "differs", "xs"), *[(k, "differs", c) for k in (3, 4) for c in ("a", "b", "xs")]])
    assert diff_copies(left, left.union(left), "id").count() == 0


def test_the_last_version_counts(spark):
    left = frame(spark, [(1, "old", None, 1.0, 1), (1, "new", None, 1.0, 1), (2, "b", None, 2.0, 1)])  # loaded on the first, second and third day
    right = frame(spark, [(2, "b", None, 2.0, 1), (1, "old", None, 1.0, 1), (1, "new", None, 1.0, 1)])
    assert diff_copies(left, right, "id").count() == 0
    assert [tuple(r) for r in diff_copies(left, right.where("name <> 'new'"), "id").collect()] == [(1, "differs", "name")]
