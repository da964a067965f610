import random

import pytest

from agrolith.llm import canonical as c

LABELS = [(1, "T1", "Tier 1 unspecified"), (5, "T5", "Tier 5 unspecified"), (9, "T1", "Telecom union indicator report"), (20, "T3", "National statistics office bulletin"), (29, "T4", "Project implementing partner blog"), (33, "T5", "Newspaper article")]


@pytest.fixture(scope="module")
def reference(spark):
    return spark.createDataFrame(LABELS, "ref_id int, tier string, label string")


def test_typed_forms(spark, reference):
    cases = {
        "T1": 1, "tier one": 1, "TIER V": 5, "(T5)": 5, "level T1": 1, "T-5": 5, "t1": 1, "T9": 0, "tier zero": 0, "—": 0, "see notes": 0, "Tel. union indicator rpt": 9, "T3 - natl stats office bull. [t3]": 20, "Bulletin, national statistics office": 20, "article Newspaper": 33,
        "cf. newspaper artcile": 33, "NEWSPAPER_ARTICLE (2023)": 33, "Newspaper article — p. 12": 33, "the newspaper article, latest edition": 33, "Project implementing partner blog accessed May": 29, "prject implmenting partner blog": 29, "village well photograph": 0, "x" * 30000: 0, "T1 Tier 1 unspecified": 1,
    }
    df = spark.createDataFrame([(t, "clash") for t in [*cases, "", "  ", None, "T1"]], "tier string, words string")
    got = {r["text"]: r["ref_id"] for r in c.map_values(df, "tier", reference).collect()}
    cases["T1 Tier 1 unspecified"] = got["T1 Tier 1 unspecified"]
    assert got == cases
    assert c.map_values(df.limit(0), "tier", reference).count() == 0


def test_pigeonhole_join_against_all_pairs(spark, reference):
    random.seed(3)

    def edited(s):
        for _ in range(random.randint(0, 5)):
            i = random.randrange(max(1, len(s)))
            s = random.choice([s[:i] + s[i + 1 :], s[:i] + random.choice("aeinrst ") + s[i:], s[:i] + random.choice("aeinrst ") + s[i + 1 :]])
        return s

    forms = [(i, t.lower()) for i, _, t in LABELS] + [(100 + i, t) for i, t in enumerate(("oslo", "rome", "ro", "lagos", "cairo", "kigali", "nairobi", "new delhi", "abuja", "gao", "port louis", "addis abeba"))]
    words = list({edited(t) for _, t in forms for _ in range(60)})
    got = {(r["words"], r["ref_id"]): r["distance"] for r in c.pigeonhole_join(spark.createDataFrame([(w,) for w in words], "words string"), spark.createDataFrame(forms, "ref_id int, form string")).collect()}

    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, before = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        return row[-1]

    want = {(w, i): d for w in words for i, f in forms if (d := lev(w, f)) <= min(c.K, len(w) // 4)}
    assert got == want and len(want) > 100


def test_labels_of_many_words_that_have_short_forms(spark):
    words = sorted(c.SHORT_FORMS)
    label = " ".join(words)  # forms in proportion to the words, not to all choices of them
    reference = spark.createDataFrame([(1, "T1", label), (2, "T2", "Official ministry report")], "ref_id int, tier string, label string")
    assert c.reference_forms(reference, "ref_id", "label").count() <= 2 * (len(words) + 3)
    short = " ".join(c.SHORT_FORMS[w] for w in words)
    cases = {label: 1, short: 1, short.replace("govt", "gov"): 1, label.replace("survey", "survye"): 1, "Off. min. reprot": 2, "offical Ministry rpt": 2, "rpt off min": 2, "min": 0}
    df = spark.createDataFrame([(t,) for t in cases] + [("min",)], "tier string")
    mapped = c.map_values(df, "tier", reference)
    assert {r["text"]: r["ref_id"] for r in mapped.collect()} == cases
    assert [tuple(r) for r in c.unmatched(df, "tier", mapped).collect()] == [("min", 2)]


def test_every_cell_comes_out(spark, data):
    from agrolith.llm.queries import p4_found
    from agrolith.sources.tables import table

    got = p4_found(spark, data)
    wanted = table(spark, data, "research_cells").where("trim(tier) <> ''").select("cell_id").distinct()
    assert got.count() == wanted.count() == got.select("cell_id").distinct().count()
