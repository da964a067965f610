import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from agrolith.operators import packed as p

PHRASES = ["vouchers for seed, feed or fertiliser", "radio/SMS advice", "plot mapping", "herd records", 'advice in "village" speech']
FOUND = p.automaton(PHRASES)
phrases = lambda t: p.segment_phrases(t, lambda x: p.occurrences(FOUND, x), set(PHRASES).__contains__)
CODES = p.automaton(["1.10", "6.13", "ADVY", "S2B-need"])
codes = lambda t: p.segment_codes(t, lambda x: p.occurrences(CODES, x))


@pytest.mark.parametrize(
    ("text", "items"),
    [
        (None, []), ("", []), ("  \t ", []), ("1.10", ["1.10"]), (";1.10;;6.13;", ["1.10", "6.13"]), ("1.10 and 6.13", ["1.10", "6.13"]), ('"1.10"', ["1.10"]), ("['1.10', '9.9']", ["1.10", "9.9"]),
        ('["S2B-need", "ADVY"]', ["S2B-need", "ADVY"]), ("1.10; 1.10", ["1.10", "1.10"]), ("2.4 + 1.5", ["2.4", "1.5"]), ("1.10、X.3", ["1.10", "X.3"]), ("1.10\r\n6.13", ["1.10", "6.13"]), ("61.101", ["61.101"]), (";;;", []),
    ],
)
def test_codes(text, items):
    assert codes(text) == items


@pytest.mark.parametrize(
    ("text", "items"),
    [
        (None, []), (" ", []), ("plot mapping", ["plot mapping"]), ("radio/SMS advice", ["radio/SMS advice"]), ("plot mapping / herd records", ["plot mapping", "herd records"]), ("plot mapping,radio/SMS advice", ["plot mapping", "radio/SMS advice"]),
        ("vouchers for seed, feed or fertiliser, plot mapping", ["vouchers for seed, feed or fertiliser", "plot mapping"]), ("; plot mapping ;; herd records ;", ["plot mapping", "herd records"]), ('"plot mapping";"radio/SMS advice"', ["plot mapping", "radio/SMS advice"]),
        ('"advice in ""village"" speech",plot mapping', ['advice in "village" speech', "plot mapping"]), ('["advice in \\"village\\" speech", "a, b"]', ['advice in "village" speech', "a, b"]), ("['a, b', 'c']", ["a, b", "c"]),
        ("plot mapping\n- herd records\n- radio/SMS advice", ["plot mapping", "herd records", "radio/SMS advice"]), ("a || b || b", ["a", "b", "b"]), ("x • y, z", ["x", "y, z"]), ("it's fine; ok", ["it's fine", "ok"]), ('"open; end', ['"open', "end"]), ("cats/dogs", ["cats/dogs"]),
        ("plot mapping；vouchers for seed, feed or fertiliser", ["plot mapping", "vouchers for seed, feed or fertiliser"]), ("plot mapping;", ["plot mapping"]),
    ],
)
def test_phrases(text, items):
    assert phrases(text) == items


@given(st.lists(st.tuples(st.integers(0, 20), st.integers(1, 6)), max_size=9))
@settings(max_examples=200, deadline=None)
def test_best_cover_is_best(raw):
    from itertools import combinations

    spans = sorted({(a, a + n) for a, n in raw})
    got = p.best_cover(spans)
    assert all(got[i][1] <= got[i + 1][0] for i in range(len(got) - 1))
    fits = lambda c: all(c[i][1] <= c[i + 1][0] for i in range(len(c) - 1))
    best = max((sum(b - a for a, b in c) for k in range(len(spans) + 1) for c in combinations(spans, k) if fits(sorted(c))), default=0)
    assert sum(b - a for a, b in got) == best


@given(st.lists(st.sampled_from([x for x in PHRASES if '"' not in x]), min_size=2, max_size=6), st.sampled_from(["; ", ";", " | ", "\n", " • ", ",", ", ", " / "]))
@settings(max_examples=150, deadline=None)
def test_round_trip(items, mark):
    assert phrases(mark.join(items)) == items


def test_unpack_and_join_agree(spark):
    rows = [(1, "plot mapping; radio/SMS advice"), (1, "plot mapping; radio/SMS advice"), (2, "herd records,radio/SMS advice"), (3, None), (4, ""), (5, '"radio/SMS advice"'), (6, "radio/SMS advice"), (7, "x" * 20000 + ";y")]
    df = spark.createDataFrame([(k, t, "noise", k) for k, t in rows], "id bigint, uc string, item string, pos bigint")
    d = {"uc": ("phrases", p.phrase_dictionary(df, "uc"))}
    got = sorted(map(tuple, p.unpack(df, "t", "id", d).collect()))
    assert got == sorted(map(tuple, p.unpack(df, "t", "id", d, bound=1).collect()))
    assert [r[3:] for r in got if r[2] == 1] == [(1, "plot mapping"), (2, "radio/SMS advice")]
    assert [r[4] for r in got if r[2] == 2] == ["herd records", "radio/SMS advice"]
    assert {r[2] for r in got} == {1, 2, 5, 6, 7}
    assert p.unpack(df.limit(0), "t", "id", d).count() == 0


KNOWN = ["A/1", "S2B need", "1.10", "need", "a, b", 'say "a", b', "x/y", "-x", "b; c", "it's", "1) z", "a" * 30 + ", " + "b" * 20]
PIECES = ["A/1", "S2B need", "1.10", "a, b", "a", "b", "c", "x/y", "-x", "z", "it's", "and", '"', "'", "\\\\", "[", "]", "(", ")", ", ", ",", ";", "; ", " / ", "\n", "\n- ", " ", "1) ", '\\"', "“", "”", "|"]


@given(st.lists(st.sampled_from([*PIECES, *KNOWN]), max_size=10).map("".join), st.sets(st.sampled_from(KNOWN)))
@settings(max_examples=600, deadline=None)
def test_joined_dictionary_gives_what_the_broadcast_one_gives(text, known):
    longest = max(map(len, known), default=0)
    for kind, candidates in (("codes", p.code_candidates), ("phrases", p.phrase_candidates)):
        hit = sorted(known & set(candidates(text, longest)))
        joined = p.segment_codes(text, p._found_in(hit)) if kind == "codes" else p.segment_phrases(text, p._found_in(hit), set(hit).__contains__)
        assert joined == p._segmenter(kind, sorted(known))(text)


def test_phrases_of_any_length_and_codes_of_any_signs_by_both_ways(spark):
    long = "vouchers " * 60 + "for seed, feed " + "or fertiliser " * 30 + "end"
    df = spark.createDataFrame([(1, f'"{long}"; plot mapping'), (2, f"{long}, plot mapping"), (3, f'["say \\"a\\", b", "{long}"]'), (4, 'say "a", b, plot mapping'), (5, "plot mapping")], "id bigint, uc string")
    d = {"uc": ("phrases", p.phrase_dictionary(df, "uc"))}
    got = sorted(map(tuple, p.unpack(df, "t", "id", d).collect()))
    assert [r[4] for r in got if r[2] == 2] == [long, "plot mapping"] and [r[4] for r in got if r[2] == 4] == ['say "a", b', "plot mapping"]
    assert got == sorted(map(tuple, p.unpack(df, "t", "id", d, bound=1).collect()))
    codes_df = spark.createDataFrame([(1, "A/1; S2B need and 1.10"), (2, "A/1/S2B need"), (3, "S2B needs")], "id bigint, m string")
    c = {"m": ("codes", spark.createDataFrame([("A/1",), ("S2B need",), ("1.10",)], "value string"))}
    got = sorted(map(tuple, p.unpack(codes_df, "t", "id", c).collect()))
    assert [r[4] for r in got] == ["A/1", "S2B need", "1.10", "A/1", "S2B need", "S2B", "needs"]
    assert got == sorted(map(tuple, p.unpack(codes_df, "t", "id", c, bound=1).collect()))
