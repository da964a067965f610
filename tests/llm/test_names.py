import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from agrolith.llm import names as n

GENERIC = frozenset("water development bank soil project initiative institute for research francis robert cold chain phase department digital farming".split())


def linked(a, b):
    return n.alignment(sorted(n.tokens_of(a)), sorted(n.tokens_of(b)), GENERIC)


@pytest.mark.parametrize(
    ("a", "b"),
    [
        ("Kongorkonar Water Development Bank", "KWDB — Kongorkonar Water Dev. Bank"), ("Kongorkonar Water Development Bank", "Water Development Bank, Kóngórkónár *"), ("Kongorkonar Water Development Bank (KWDB)", "kongorkkonar water deveoopment bank"),
        ("Francis Nanvarantan", "NANVARANTAN, Frank"), ("Francis D. Nanvarantan", "Dr F. Nanvarantan"), ("Nathaniel Sankerfason", "Nate Sankerfason"), ("Kwabenor Zegitafe", "Kwabs Zegitafe"), ("Linodanzo Land Ledger Programme", "Linodanzo L& Ledger Prog."), ("Pesanermor Cold Chain Platform Phase II", "Pesanermoor Cold Chain Pltf. Phase 2"),
        ("Vumarmonno Institute for Digital Research", "Vumarmonno Inst. f. Dig. Res."),
    ],
)
def test_same(a, b):
    assert linked(a, b) and linked(b, a)


@pytest.mark.parametrize(
    ("a", "b"),
    [
        ("Kongorkonar Water Development Bank", "Kongorkonar Soil Development Bank"), ("Renarfivu Drone Survey Project", "Renarfivu Land Ledger Platform"), ("Pesanermor Cold Chain Platform Phase II", "Pesanermor Cold Chain Platform"), ("Pesanermor Cold Chain Platform Phase II", "Pesanermor Cold Chain Platform Phase III"),
        ("Mirabel Kotentofi", "Patricia Kotentofi"), ("Mirabel Kotentofi", "Kotentofi"), ("Water Development Bank", "Soil Development Bank"), ("Nanvarantan Water Project", "Gobodepi Water Project"), ("", "x y"),
    ],
)
def test_different(a, b):
    assert not linked(a, b)


@given(st.text("abcd", max_size=6), st.text("abcd", max_size=6))
@settings(max_examples=300, deadline=None)
def test_distance(a, b):
    def slow(i, j):
        if not i or not j:
            return i + j
        best = min(slow(i - 1, j) + 1, slow(i, j - 1) + 1, slow(i - 1, j - 1) + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            best = min(best, slow(i - 2, j - 2) + 1)
        return best

    d = slow(len(a), len(b))
    assert n.distance(a, b, 10) == d and n.distance(a, b, 2) == min(d, 3)


@given(st.integers(1, 4).flatmap(lambda k: st.lists(st.lists(st.integers(0, 9), min_size=k + 1, max_size=k + 1), min_size=k, max_size=k)))
@settings(max_examples=150, deadline=None)
def test_assignment_is_optimal(cost):
    from itertools import permutations

    pick = n.assignment([[float(x) for x in r] for r in cost])
    assert len(set(pick)) == len(pick)
    assert sum(r[j] for r, j in zip(cost, pick, strict=True)) == min(sum(r[j] for r, j in zip(cost, p, strict=False)) for p in permutations(range(len(cost[0])), len(cost)))


def test_links_in_tables(spark):
    rows = [("X", "lead", t) for t in ("Kongorkonar Water Development Bank", "KONGORKONAR WATER DEV. BANK", "Kongorkonar Water Development Bank", "Kongorkonar Soil Development Bank", None, "", "  ", "***", "Francis Nanvarantan", "F. Nanvarantan", "w " * 3000)]
    rows += [(None, "lead", "Francis Nanvarantan"), (None, "lead", "Frank Nanvarantan"), ("X", None, "Francis Nanvarantan"), ("X", None, "Frank Nanvarantan")]
    rows += [("Y", "lead", "Kongorkonar Water Dev Bank"), ("X", "name", "Kongorkonar Water Dev Bank")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "subject string, field string, text string, token string")
    got = {(r["subject"], r["field"], r["text_a"], r["text_b"]) for r in n.link_variants(df).collect()}
    assert got == {("X", "lead", "KONGORKONAR WATER DEV. BANK", "Kongorkonar Water Development Bank"), ("X", "lead", "F. Nanvarantan", "Francis Nanvarantan")}
    assert n.link_variants(df.limit(0)).count() == 0


def test_against_all_pairs(spark, data):
    """Every pair of texts of a group, compared directly: the index must lose next to none of them, and add only chains."""
    from itertools import combinations

    from agrolith.llm.queries import _typed_names

    typed = _typed_names(spark, data.replace("sf0.001", "sf0.01")).where("text is not null and trim(text) <> ''").distinct()
    got = {(r["subject"], r["field"], r["text_a"], r["text_b"]) for r in n.link_variants(typed).collect()}
    assert all(a < b for _, _, a, b in got) and len(got) == n.link_variants(typed).count()
    groups, tokens = {}, {}
    for r in typed.collect():
        groups.setdefault((r["subject"], r["field"]), []).append(r["text"])
        for t in set(n.tokens_of(r["text"])):
            tokens.setdefault((r["field"], t), set()).add(r["subject"])
    slow = set()
    for (subject, field), texts in groups.items():
        generic = frozenset(t for (f, t), s in tokens.items() if f == field and len(s) >= n.generic_from(len({g for g, x in groups if x == field})))
        for a, b in combinations(sorted(texts), 2):
            if n.alignment(sorted(n.tokens_of(a)), sorted(n.tokens_of(b)), generic):
                slow.add((subject, field, a, b))
    assert len(slow) > 100
    assert len(slow & got) >= 0.99 * len(slow)
    assert len(got - slow) <= 0.1 * len(got)


def pairs_of(spark, rows):
    df = spark.createDataFrame(rows, "subject string, field string, text string")
    return {(r["subject"], r["text_a"], r["text_b"]) for r in n.link_variants(df).collect()}


def test_names_of_any_number_of_tokens():
    long = [f"word{chr(97 + i)}{chr(97 + i)}" for i in range(26)]
    for size in (21, 26):
        a, b = long[:size], [long[0] + "x", *long[1:size]]
        assert n.alignment(sorted(a), sorted(b), frozenset()) and not n.alignment(sorted(a), sorted([*b[:-1], "elsewhere"]), frozenset())
    many = [f"w{i:04d}x" for i in range(3000)]
    assert not n.alignment(many, [t + "q" for t in many], frozenset())  # beyond what a pair may cost


def test_names_of_generic_tokens_alone(spark):
    plain = ("Ministry of Agriculture", "Min. of Agric.", "Ministry of Water", "Agriculture Ministry", "Bank of Agriculture")
    rows = [(f"S{i}", "lead", t) for i in range(12) for t in plain]
    got = pairs_of(spark, rows)
    same = {(a, b) for s, a, b in got if s == "S3"}
    assert same == {("Agriculture Ministry", "Min. of Agric."), ("Agriculture Ministry", "Ministry of Agriculture"), ("Min. of Agric.", "Ministry of Agriculture")}
    assert len(got) == 12 * 3


def test_links_do_not_depend_on_how_often_a_spelling_occurs_or_how_many_subjects_there_are(spark):
    few = [("X", "lead", t) for t in ("Kongorkonar Water Bank", "Kongrkonra Water Bank", "Zegitafengo Water Bank")]
    many = few + [("X", "lead", f"Kongorkonar {w}") for w in ("Water Bank Ltd", "Soil Board", "Seed Union", "Mill Office", "Port Trust", "Rice Fund", "Map House", "Road Works", "Tax Agency", "Fish Market")]
    # a word of two subjects in twenty-five is still a word of its own
    spread = few + [(f"Y{i}", "lead", f"Kongorkonar {i} Water Bank" if i < 1 else f"Body{chr(97 + i)}{chr(97 + i)} Water Bank") for i in range(24)]
    for rows in (few, many, spread):
        assert ("X", "Kongorkonar Water Bank", "Kongrkonra Water Bank") in pairs_of(spark, rows)
    assert not any("Zegitafengo" in a + b for _, a, b in pairs_of(spark, many))


def test_long_words(spark):
    word = "llanfairpwllgwyngyllgogerychwyrndrobwllllantysiliogogogoch"
    slip = word[:30] + word[31:]
    assert len(word) > n.LONG
    assert ("X", f"{slip} Council", f"{word} Council") in pairs_of(spark, [("X", "lead", f"{word} Council"), ("X", "lead", f"{slip} Council"), ("X", "lead", "w" * 5000)])
