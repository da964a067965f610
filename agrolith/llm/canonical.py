"""Free-entered values mapped to a canonical list: a partition-based pigeonhole join, in SQL only.

A typed string of n letters may differ from an entry by k = min(4, n / 4) edits. For each k that typed strings near its length have, a
reference string is cut into k + 1 segments; a typed string within k edits of it contains one of them unchanged, at a position the
pigeonhole argument narrows down (multi-match-aware windows). Segments and substrings meet in an equality join on (length, k,
segment, text), candidates are verified by the built-in levenshtein, and what finds no partner is reported through an anti-join.
So short strings are cut into few and long segments, and short entries take part.

Entries enter as written and with all their words in the short form, both in all turns (last word first and so on); a typed string
enters as written, with its short forms written out, and with all words in the short form. That is linear in the number of words.

Each distinct text is mapped once, whatever its number of rows. Defined results: null and blank values give no row; a value
that fits nothing gets 0; of several entries at the same distance the one of the tier that the text names wins, then the
lowest id. Texts far longer than every reference string find no partner. A tier without words takes no part in the join: it means
the entry of its tier that is called unspecified.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrolith.session import checkpointed

#: Most edits of one string, and the letters that each of them takes.
K, LETTERS = 4, 4

#: Short forms of words in names of sources. Apostrophes and full stops are dropped before comparing.
SHORT_FORMS = {
    "administration": "admin", "agricultural": "agric", "agriculture": "agric", "analysis": "anal", "announcement": "announc", "article": "art", "association": "assoc",
    "bulletin": "bull", "centre": "ctr", "center": "ctr", "committee": "cttee", "completion": "compl", "conference": "conf", "database": "db", "department": "dept",
    "development": "dev", "diagnostic": "diag", "directorate": "dir", "evaluation": "eval", "government": "govt", "household": "hh", "independent": "indep",
    "industry": "ind", "institute": "inst", "international": "intl", "journal": "jnl", "magazine": "mag", "ministry": "min", "multilateral": "multilat",
    "national": "natl", "newspaper": "newsp", "office": "off", "official": "off", "paper": "ppr", "parliament": "parl", "programme": "prog", "project": "proj",
    "provincial": "prov", "regional": "reg", "regulator": "reg", "release": "rel", "report": "rpt", "research": "res", "reviewed": "revd", "statistical": "stat",
    "statistics": "stats", "survey": "surv", "telecom": "tel", "transcript": "transcr", "university": "univ",
}

_NUMERALS = {"i": 1, "ii": 2, "iii": 3, "iv": 4, "v": 5, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5}
_LEAD = r"^[\s(\[]*(?:level\s+)?(?:t(?:ier)?[\s.\-]*([0-9]+)|tier[\s.\-]*(iii|ii|iv|i|v|one|two|three|four|five|[a-z]+)(?=[^a-z]*$))(?![a-z0-9])[\s:.,\-–—()\[\]]*"
_TAIL = r"[\[(]\s*t(?:ier)?[\s.\-]*([0-9])\s*[\])]\s*$"
_REMARKS = r"[(\[][^()\[\]]*\d{4}[^()\[\]]*[)\]]|,?\s*(?:latest|new|old|first|second|third|revised|updated)\s+(?:edition|version)\s*$|[\s,]+(?:accessed|retrieved|dated|as of)\b.*$|[\s,—–-]+pp?\.\s*\d+.*$|,\s*copy\s*$"
_OPENERS = r"^(?:(?:cf|see|from|source|via|according to|the|an?)[\s.:]+)+"


def plain_text(column):
    """Lower case, one form of blanks and dashes, accents of Latin letters taken off."""
    t = F.translate(F.lower(column), "_’‘`´ \t\r\nàáâãäåçèéêëìíîïñòóôõöùúûüý", " ''''    aaaaaaceeeeiiiinooooouuuuy")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def read_tier(values: DataFrame, column: str = "tier") -> DataFrame:
    """text, tier_no (the tier that the text names, else null), words (what it says besides, in plain words), all_words (opening words kept)."""
    t = values.select(F.col(column).alias("text"), plain_text(F.col(column)).alias("t"))
    lead, tail = F.regexp_extract("t", _LEAD, 1), F.regexp_extract("t", _TAIL, 1)
    numeral = F.regexp_extract("t", _LEAD, 2)
    names = F.create_map(*[F.lit(x) for pair in _NUMERALS.items() for x in pair])
    t = t.select("text", F.coalesce(F.when(lead != "", lead.try_cast("int")), F.when(numeral != "", F.try_element_at(names, numeral)), F.when(tail != "", tail.try_cast("int"))).alias("tier_no"), F.regexp_replace(F.regexp_replace("t", _LEAD, ""), _TAIL, "").alias("t"))
    t = t.select("text", "tier_no", F.regexp_replace(F.trim(F.regexp_replace(F.translate("t", "()[]", "    "), r"\s+\d{4}(?:\s+season)?\s*$", "")), _REMARKS, "").alias("t"))
    bare = lambda c: F.trim(F.regexp_replace(F.regexp_replace(F.translate(c, "'", ""), r"[^\p{L}\p{N}]+", " "), r"\s+", " "))
    return t.select("text", "tier_no", bare(F.regexp_replace(F.trim("t"), _OPENERS, "")).alias("words"), bare(F.trim("t")).alias("all_words"))


def _mapped(words: Column, table: dict[str, str]) -> Column:
    """An array of words, each replaced by what the table has for it."""
    literal = F.create_map(*[F.lit(x) for pair in sorted(table.items()) for x in pair])
    return F.transform(words, lambda w: F.coalesce(F.try_element_at(literal, w), w))


def _written_out(last: bool) -> dict[str, str]:
    """The word that a short form stands for, the first or the last of several."""
    return dict(sorted(((s, w) for w, s in SHORT_FORMS.items()), reverse=not last))


def reference_forms(reference: DataFrame, key: str, label: str) -> DataFrame:
    """key, form: every label as written and with its words in the short form, in all turns."""
    base = reference.select(F.col(key).alias("ref_id"), F.trim(F.regexp_replace(F.translate(plain_text(F.col(label)), "'", ""), r"[^\p{L}\p{N}]+", " ")).alias("form")).where("form <> ''")
    words = base.select("ref_id", F.split("form", " ").alias("w"))
    both = words.select("ref_id", F.explode(F.array(F.col("w"), _mapped(F.col("w"), SHORT_FORMS))).alias("w"))
    turned = both.select("ref_id", F.explode(F.transform(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.concat(F.slice("w", i + 1, F.greatest(F.size("w") - i, F.lit(1))), F.slice("w", 1, i)))).alias("w"))
    return turned.select("ref_id", F.array_join("w", " ").alias("form")).distinct()


def typed_forms(words: Column) -> Column:
    """A typed string as written, with short forms written out (the first and the last meaning), and with all words short."""
    w = F.split(words, " ")
    return F.array_distinct(F.array(words, *[F.array_join(_mapped(w, t), " ") for t in (_written_out(False), _written_out(True), SHORT_FORMS)]))


def pigeonhole_join(typed: DataFrame, forms: DataFrame, k: int = K) -> DataFrame:
    """words, ref_id, distance: pairs of typed strings and reference forms within min(k, a quarter of the typed length) edits."""
    # segment i (from 0) of a string of len letters cut into n: the last len % n ones have a letter more
    cut = "1 + i * (len div n) + greatest(0, i - (n - len % n)) AS at, (len div n) + if(i >= n - len % n, 1, 0) AS size"
    allowed = f"least({k}, w div {LETTERS})"
    return typed.sparkSession.sql(f"""
      WITH refs AS (SELECT ref_id, form, length(form) AS len FROM {{forms}}),
      lengths AS (SELECT len, explode(array_distinct(transform(filter(sequence(len - {k}, len + {k}), w -> w > 0 AND abs(w - len) <= {allowed}), w -> {allowed}))) AS k FROM (SELECT DISTINCT len FROM refs)),
      shapes AS (SELECT len, k, i, {cut} FROM (SELECT len, k, k + 1 AS n, explode(sequence(0, k)) AS i FROM lengths)),
      index AS (SELECT ref_id, form, s.len, s.k, s.i, substring(form, at, size) AS seg FROM refs JOIN shapes s ON refs.len = s.len),
      strings AS (SELECT words, w AS wlen, {allowed} AS k, explode(sequence(w - {allowed}, w + {allowed})) AS len FROM (SELECT words, length(words) AS w FROM {{typed}}) WHERE w > 0),
      windows AS (
        SELECT words, s.len, s.k, i, size, explode(sequence(
          greatest(1, at - i, at + (wlen - s.len) - (s.k - i)), least(wlen - size + 1, at + i, at + (wlen - s.len) + (s.k - i)))) AS p
        FROM strings JOIN shapes s ON s.len = strings.len AND s.k = strings.k
        WHERE greatest(1, at - i, at + (wlen - s.len) - (s.k - i)) <= least(wlen - size + 1, at + i, at + (wlen - s.len) + (s.k - i))),
      pieces AS (SELECT DISTINCT words, len, k, i, substring(words, p, size) AS seg FROM windows),
      candidates AS (SELECT DISTINCT p.words, p.k, x.ref_id, x.form FROM pieces p JOIN index x ON p.len = x.len AND p.k = x.k AND p.i = x.i AND p.seg = x.seg)
      SELECT words, ref_id, min(distance) AS distance
      FROM (SELECT words, ref_id, k, levenshtein(words, form, {k}) AS distance FROM candidates)
      WHERE distance BETWEEN 0 AND k GROUP BY words, ref_id
    """, typed=typed, forms=forms)


def map_values(values: DataFrame, column: str, reference: DataFrame, key: str = "ref_id", group: str = "tier", label: str = "label", k: int = K) -> DataFrame:
    """text, ref_id for every distinct non-blank text of the column, 0 where it fits no entry."""
    # read and parsed once; what follows works on distinct texts
    texts = checkpointed(read_tier(values.select(column).where(F.trim(F.regexp_replace(column, r"\s", " ")) != "").distinct(), column))
    groups = reference.select(F.col(key).alias("ref_id"), F.regexp_extract(group, r"(\d+)", 1).try_cast("int").alias("group_no"), plain_text(F.col(label)).alias("label"))
    bare = texts.where("words rlike '^(unspecified|unknown|not specified)?$' and tier_no is not null")
    by_tier = bare.join(groups.where("label like '%unspecified%'"), F.col("tier_no") == F.col("group_no")).select("text", "ref_id")
    # an opening word may also be a slip of a name's first word, so that both readings are looked up
    worded = texts.where("words <> ''").select("text", "tier_no", F.explode(F.array_distinct(F.concat(typed_forms(F.col("words")), typed_forms(F.col("all_words"))))).alias("words"))
    forms = checkpointed(reference_forms(reference.where(~F.lower(label).contains("unspecified")), key, label))
    words = worded.select("words").distinct()
    exact = words.join(forms, words["words"] == forms["form"]).select("words", "ref_id", F.lit(0).alias("distance"))
    fuzzy = pigeonhole_join(words.join(forms, words["words"] == forms["form"], "left_anti"), forms, k)
    scored = worded.join(exact.unionByName(fuzzy), "words").join(groups.select("ref_id", "group_no"), "ref_id")
    best = scored.groupBy("text").agg(F.min_by("ref_id", F.struct("distance", F.when(F.col("tier_no") == F.col("group_no"), 0).otherwise(1), "ref_id")).alias("ref_id"))
    # written, as what fits and what doesn't both rest on it
    matched = checkpointed(by_tier.unionByName(best).groupBy("text").agg(F.min("ref_id").alias("ref_id")))
    unmatched = texts.select("text").join(matched, "text", "left_anti").select("text", F.lit(0).alias("ref_id"))
    return matched.unionByName(unmatched)


def unmatched(values: DataFrame, column: str, mapped: DataFrame) -> DataFrame:
    """column, rows: the texts that fit no entry, with the number of rows that have them; ``mapped`` is what :func:`map_values` gives."""
    return values.groupBy(column).agg(F.count("*").alias("rows")).join(mapped.where("ref_id = 0").select(F.col("text").alias(column)), column)
