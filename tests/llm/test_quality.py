import base64
import random
import textwrap

import pytest

from agrolith.llm import quality as q

PROSE = "The committee met 40 times and its minutes are public; none of them mentions the pest alert. Growers in Rusobi told us that they trust a neighbour more than a short-code menu. "
random.seed(1)
NOISE = "".join(random.choice("!@#$%^&*()_+{}|:<>?,./;'[]=-~0123456789") for _ in range(600))
CASES = [
    (None, None), ("", None), (" \n\t ", None), ("Background", None), (PROSE, None), (PROSE.upper(), None), ("Table 9. Background\n\n" + PROSE * 3, None), ("1. " + PROSE + "\n\n2. " + PROSE, None), ("<p>" + PROSE + "</p>\r\n\r\n" + PROSE, None),
    ("\n".join(PROSE[i : i + 46] for i in range(0, len(PROSE), 46)), None), (PROSE * 4 + "\n\n- maize 2015\n- pest map\n- soil kits", None), ("Local radio hosts planted sesame instead.", None), ("Die Prüfer fanden keinen Beleg dafür, dass das Flurbuch außerhalb von Zifumer genutzt wird.", None),
    ("- maize 2015\n- pest map\n- weather notices\n- citrus 2024", "list"), ("Next steps:\n\n1) buyer list\n\n2) soil list (Gonson)\n\n3) millet 2026", "list"), ("potatoes 2022\nseed notice\nrice 2017\nwater meters near Perdars\nweather notices", "list"), ("[x] fee plan\r\n[ ] soil records\r\n[x] rice", "list"), ("registre des parcelles\nligne vocale (Gonson)\nmenu par code court\nmil 2019", "list"),
    ("place,year,ha\nMerenga,2018,n/a\nGorkupa,2017,66%", "table"), ("| a | 2 | n/a |\n|---|---|---|\n| b | 3 | 5% |", "table"), ("place\tyear\nRonvove\t2015\nPunanga\t2025", "table"), ("<tr><td>x</td><td>5</td></tr>\n<tr><td>y</td><td>6</td></tr>", "table"), ("place ....... ha  members\nPonbanl ........... -  n/a\nGererno ......... 87.6  n/a", "table"), ("place         year          ha\nVirevo        2016          80%\nGadardo       2024          26%", "table"),
    (base64.b64encode(random.randbytes(500)).decode(), "junk"), (NOISE, "junk"), ("null\n" * 60, "junk"), ("click here " * 50, "junk"), (PROSE * 40, "junk"), ("Top · About · Next » · Share · Print · Login · Top · About · Search", "junk"), ('{"k17": 629915, "v": "f4d86750"}\n{"k4": 104431, "v": "f3dcc863"}', "junk"),
    ("2023-02-21 10:38:05 WARN worker-6 retry=6\n2025-08-18 19:03:44 ERR worker-7 retry=1", "junk"), ("46 21 35 e3 57 44 ea ea 25 65 cf aa 1d bc e9 f5", "junk"), ("spidn1qx lgjwgwg|k1 kx1sna 10lhbdadle cbaksxt0 vbjxzl i||q1nlklb plannb0nvlh0 lwcgkwz0ijs m vcb", "junk"), ("Le� age��s �� dÃ\x83Â©p�t o�t v�ndu t�op t�t fa�te de �la�e", "junk"),
]


@pytest.mark.parametrize(("text", "kind"), CASES)
def test_kinds(text, kind):
    assert q.classify(text) == kind


def of(spark, texts):
    """The rows of quality() by the texts' positions; the table has columns with the names of results."""
    df = spark.createDataFrame([(i, t, "clash", 5) for i, t in enumerate(texts)], "doc_id long, text string, kind string, n_words int")
    return {r["doc_id"]: r.asDict() for r in q.quality(df).collect()}


def test_statistics(spark):
    got = of(spark, ["One two two.\nOne two two.\n\nfoo!", None, " \u00a0\n", "7", "One two two.\nOne two two.\n\nfoo!", "a-b\r\n\r\na-b\r\rc"])
    s = got[0]
    assert s["n_words"] == 7 and s["n_lines"] == 3 and s["punctuated_line_share"] == 1.0 and s["duplicate_line_share"] == 12 / 28 and s["mean_word_length"] == 3.0
    assert s["top_2gram_share"] == 12 / 21 and s["symbol_share"] == 3 / 24 and s["prose_chars"] == 28 and s["kind"] is None
    assert {**s, "doc_id": 4} == got[4]
    for i in (1, 2):
        assert all(v == 0 if k.startswith("n_") or k.endswith("_chars") else v is None for k, v in got[i].items() if k != "doc_id")
    assert got[3]["n_words"] == 0 and got[3]["digit_share"] == 1.0 and got[3]["mean_word_length"] is None and got[3]["top_2gram_share"] is None
    assert got[5]["n_lines"] == 3 and got[5]["duplicate_paragraph_share"] == 3 / 7
    assert q.quality(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_the_kind_is_a_rule_on_the_columns(spark):
    texts = [t for t, _ in CASES] + ["\n".join([LONG] * 40), (PROSE + LONG) * 7]
    got = of(spark, texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert r["kind"] == q.classify(t) == (q.kind_of({k: r[f"{k}_chars"] for k in q.READINGS}))
    assert got[len(CASES)]["repeated_chars"] > 0 and got[len(CASES)]["duplicate_line_share"] == 39 / 40 and got[len(CASES) + 1]["looped_chars"] > 0


def test_dominant_ngram_counts_overlaps_once():
    assert q.top_ngram_share(["a"] * 5, 2) == 4 / 5 and q.top_ngram_share("a b a b a".split(), 2) == 4 / 5 and q.top_ngram_share("x y z".split(), 2) == 0
    pick = random.Random(8)
    for _ in range(300):
        words = [pick.choice(["a", "bb", "ccc"]) for _ in range(pick.randint(3, 14))]
        for n in (2, 4):
            best = 0
            for gram in {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}:
                i = times = 0
                while i + n <= len(words):
                    hit = tuple(words[i : i + n]) == gram
                    times, i = times + hit, i + (n if hit else 1)
                best = max(best, times * len("".join(gram)) if times > 1 else 0)
            assert q.top_ngram_share(words, n) == best / len("".join(words))


def test_long_texts_are_read_whole():
    assert q.classify("- item 1\n" * 3 + "\n".join(f"{PROSE} {i}" for i in range(3000))) is None
    assert q.classify(PROSE + "\n" + "\n".join(f"- maize {i}" for i in range(3000))) == "list"


LONG = "The committee that looks after the water meters of Gorkupa told us in its last letter that most of the growers would rather wait for another season than pay for a service that none of their neighbours has tried. "


def test_repeated_lines_and_paragraphs_are_junk():
    others = [" ".join(random.Random(i).sample(LONG.split(), 30)) + "." for i in range(12)]
    blocks = [LONG + "\n" + PROSE, PROSE + "\n" + LONG]
    for text in (
        "\n".join([LONG] * 40), "\r\n\r\n".join([LONG] * 9), "\n\n".join(blocks * 6), "\n".join(others[:3] * 10), "\n".join(others[:2] + [LONG] * 12),
        "\n\n".join(textwrap.fill(LONG, w) for w in (100, 110, 120, 130, 140, 150)),
    ):
        assert q.classify(text) == "junk", text
    for text in ("\n".join([LONG] * 4), "\n\n".join(others), "\n".join(others + [LONG] * 5)):
        assert q.classify(text) is None, text


def test_dominant_ngrams_are_junk():
    pick = random.Random(3)
    rest = [w for w in LONG.lower().split() if len(w) < 6]
    lines = [" ".join("agricultural insurance " + " ".join(pick.sample(rest, pick.randint(1, 5))) for _ in range(9)) + "." for _ in range(20)]
    assert q.classify(" ".join(lines)) == "junk" and q.classify("\n".join(lines)) == "junk"
    for words in (("agricultural insurance of the " * 7).split(), LONG.split() * 3, ["a"] * 30, list("abcd") * 9):
        words = [w for w in q.words_of(" ".join(words))]
        assert q.dominated(words) == (max(q.top_ngram_share(words, 2), q.top_ngram_share(words, 4)) > q.DOMINANT)


def test_repetition_at_any_distance_is_junk():
    far = PROSE + LONG
    assert len(q.words_of(far)) > 64
    for text in (far * 5, far * 40, LONG + far * 9, " ".join([far, LONG, PROSE, LONG] * 6)):
        assert q.classify(text) == "junk", text
    assert q.classify(far * 4) is None  # as four copies of a shorter passage
    assert q.repeated_share(list("abcdefghij") * 5) == 0.8 and q.repeated_share([]) == 0 == q.repeated_share(list("abcdefghijk"))
    pick = random.Random(5)
    for _ in range(200):
        words = [pick.choice("abcdef") for _ in range(pick.randint(30, 90))]
        assert q.periodic_share(words) == max(sum(x == y for x, y in zip(words[p:], words, strict=False)) / (len(words) - p) for p in range(1, min(64, len(words) // 5) + 1))


def test_documents(spark, data):
    from agrolith.llm.queries import p10_found, p10_quality

    found = {r["doc_id"]: r["kind"] for r in p10_found(spark, data).collect()}
    full = {r["doc_id"]: r["kind"] for r in p10_quality(spark, data).collect()}
    assert {k: v for k, v in full.items() if v} == found and set(found.values()) <= set(q.KINDS)
    from agrolith.sources.tables import table

    assert len(full) == table(spark, data, "documents").count()
    assert q.quality(table(spark, data, "documents").limit(0)).count() == 0
