"""Text scalars as column expressions, and the few that need Arrow."""

from __future__ import annotations

import json
import re
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Openings that deny evidence.
NEGATIONS = ("none found", "no ", "not ", "n/a", "unpublished", "unmeasured", "unverified", "no published")
#: Words that identify no programme on their own.
NOISE = ("the", "el", "al", "programme", "program", "project", "platform", "app", "application", "system", "initiative", "service", "digital", "national", "smart")


def normal_form(c: Column) -> Column:
    """One blank between words, lower case."""
    return F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))


def dedupe_key(c: Column, noise: tuple[str, ...] = NOISE) -> Column:
    """Letters and digits of a name without its noise words."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"\b(" + "|".join(noise) + r")\b", ""), "[^a-z0-9]", "")


def substantive(c: Column, least: int = 40) -> Column:
    """Whether a text says something: long enough, and not opening with a denial."""
    t = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return (F.length(t) >= least) & ~reduce(lambda a, b: a | b, [t.startswith(n) for n in NEGATIONS])


def tier_token(c: Column) -> Column:
    """The first T1 to T5 in a verbose text, null if there is none."""
    t = F.regexp_extract(c, r"(T[1-5])", 1)
    return F.when(t != "", t)


def parse_number(c: Column) -> Column:
    """A number written with thousands commas or a percent sign, else null."""
    t = F.regexp_replace(c, r"[,%\s]", "")
    return F.when(t.rlike(r"^[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)$"), t.try_cast("double"))


def host(url: Column) -> Column:
    """The host of a URL in lower case, without port and www."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/@]*@)?([^/:?#]+)", 1)), r"^www\.", "")


def host_suffixes(h: Column) -> Column:
    """The host and what follows each of its dots, the longest first: an equality join replaces endswith on needles."""
    parts = F.split(h, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def mentions(c: Column, terms: list[str]) -> Column:
    """The terms that a text contains as words (no letter beside them), case ignored; longest first."""
    ordered = sorted(set(terms), key=lambda t: (-len(t), t))
    pairs = [F.when(c.rlike(r"(?iu)(?<![A-Za-z])" + re.escape(t) + r"(?![A-Za-z])"), F.lit(t)) for t in ordered]
    return F.array_compact(F.array(*pairs))


def excerpt(c: Column, most: int) -> Column:
    """struct(start, middle, end): three windows that share ``most`` characters; a shorter text is all start."""
    third = most // 3
    first = most - 2 * third
    n = F.length(c)
    whole = n <= most
    mid = F.floor((n - third) / 2).cast("int")
    return F.struct(
        F.when(whole, c).otherwise(F.substring(c, 1, first)).alias("start"),
        F.when(whole, F.lit("")).otherwise(F.substring(c, mid + 1, F.lit(third))).alias("middle"),
        F.when(whole, F.lit("")).otherwise(F.substring(c, n - third + 1, F.lit(third))).alias("end"),
    )


def guard_spreadsheet(c: Column) -> Column:
    """A text that a spreadsheet would run as a formula gets an apostrophe; characters that XML forbids are replaced."""
    clean = F.regexp_replace(c, "[\\u0000-\\u0008\\u000b\\u000c\\u000e-\\u001f\\ufffe\\uffff]", "�")
    return F.when(clean.rlike("^[\\s\\x00-\\x1f]*[=+\\-@]"), F.concat(F.lit("'"), clean)).otherwise(clean)


def strip_html(c: Column) -> Column:
    """Tags out, the five common entities back to characters, blanks collapsed."""
    t = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"(?is)<script\b.*?</script>", " "), r"(?is)<style\b.*?</style>", " "), r"<[^>]*>", " ")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def reference_ids(c: Column) -> Column:
    """Ids such as 3.11 that a prose text cites, in order of appearance, each once."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"(?:^|[^0-9.])([1-9][0-9]?\.[1-9][0-9]?)(?=$|[^0-9.]|\.(?:$|[^0-9]))"), 1))


_QUOTES = str.maketrans({"‘": "'", "’": "'", "‚": "'", "“": '"', "”": '"', "„": '"', "«": '"', "»": '"', "–": "-", "—": "-", "−": "-", "‐": "-", "‑": "-"})


def folded(text: str) -> str:
    return re.sub(r"\s+", " ", unicodedata.normalize("NFKC", text).translate(_QUOTES)).strip().lower()


def quote_holds(quote: str | None, page: str | None, least: int = 8) -> bool:
    """Whether a page contains a quotation, compatibility forms, quotes, dashes and blanks aside, or in its letters and digits alone."""
    if not quote or not page or len(quote.strip()) < least:
        return False
    q, p = folded(quote), folded(page)
    if q in p:
        return True
    bare = lambda t: "".join(ch for ch in t if ch.isalnum())
    return bool(bare(q)) and bare(q) in bare(p)


def quote_verified(quote: Column, page: Column) -> Column:
    """NFKC has no built-in expression, so this is an Arrow UDF; it never sees more than a batch of rows."""

    @F.pandas_udf(T.BooleanType())
    def verify(q: pd.Series, p: pd.Series) -> pd.Series:
        return pd.Series([quote_holds(a, b) for a, b in zip(q, p, strict=True)], dtype=bool)

    return verify(quote, page)


def accent_folded(c: Column) -> Column:
    """Accents off, lower case, everything but letters, digits and blanks to blanks."""

    @F.pandas_udf(T.StringType())
    def fold(t: pd.Series) -> pd.Series:
        return t.map(lambda x: None if x is None else re.sub(r"[^a-z0-9 ]", " ", "".join(ch for ch in unicodedata.normalize("NFKD", x) if not unicodedata.combining(ch)).lower()))

    return fold(c)


#: Words of numbers and scales in prose.
_UNITS = {w: i for i, w in enumerate("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split())}
_TENS = {w: 10 * (i + 2) for i, w in enumerate("twenty thirty forty fifty sixty seventy eighty ninety".split())}
_SCALES = {"hundred": 1e2, "thousand": 1e3, "million": 1e6, "billion": 1e9}
_MENTION = re.compile(
    r"(?P<sign>[-−+])?(?P<cur>US\$|[$€£])?\s?(?P<num>\d{1,3}(?:[,   ]\d{3})+(?:\.\d+)?|\d+(?:\.\d+)?)\s?(?P<scale>hundred|thousand|million|billion|mn|bn|k)?\b\s?(?P<unit>%|per cent|percent|hectares?|ha|km|kg|t|members?|households?|years?|times|names?|entries|sales)?"
    r"|\b(?P<words>(?:(?:" + "|".join([*_UNITS, *_TENS]) + r")(?:[- ](?:" + "|".join([*_UNITS, *_TENS, *_SCALES]) + r"|and))*))\b",
    re.I,
)


def word_number(text: str) -> float | None:
    """twenty-five -> 25; None if the words make no number."""
    total, part = 0.0, 0.0
    for w in re.split(r"[-\s]+", text.lower()):
        if w in _UNITS:
            part += _UNITS[w]
        elif w in _TENS:
            part += _TENS[w]
        elif w == "hundred":
            part = (part or 1) * 100
        elif w in _SCALES:
            total, part = total + (part or 1) * _SCALES[w], 0.0
        elif w != "and":
            return None
    return total + part


def numeric_mentions_of(text: str | None) -> list[dict]:
    """The numbers of a prose text: raw, number, currency, unit, start, end."""
    out = []
    for m in _MENTION.finditer(text or ""):
        if m["words"]:
            value, currency, unit = word_number(m["words"]), None, None
        else:
            value = float(re.sub(r"[^\d.]", "", m["num"]))
            scale = (m["scale"] or "").lower()
            value *= _SCALES.get(scale, {"mn": 1e6, "bn": 1e9, "k": 1e3}.get(scale, 1.0))
            value = -value if m["sign"] in ("-", "−") else value
            currency, unit = m["cur"], (m["unit"] or "").lower() or None
        if value is not None:
            out.append({"raw": m[0].strip(), "number": value, "currency": currency, "unit": unit, "start": m.start(), "end": m.end()})
    return out


MENTIONS = "array<struct<raw:string,number:double,currency:string,unit:string,start:int,end:int>>"


def numeric_mentions(c: Column) -> Column:
    @F.pandas_udf(MENTIONS)
    def extract(t: pd.Series) -> pd.Series:
        return t.map(numeric_mentions_of)

    return extract(c)


_PLAIN_KEY = re.compile(r"[A-Za-z0-9_]+")


def _not_json(constant: str) -> None:
    raise ValueError(constant)


def leaf_paths_of(payload: str | None) -> list[dict] | None:
    """path and type of every leaf of a JSON text, None if it isn't valid.

    Keys are joined by dots, items have their number in brackets; a key with other characters than ASCII letters, digits and
    underscores is quoted as in JSON. Empty arrays and objects are leaves. The path of a bare value is empty.
    """
    try:
        # objects come as tuples of pairs, so that a key that stands twice is kept; numbers only matter as such
        root = json.loads(payload or "", object_pairs_hook=tuple, parse_int=float, parse_constant=_not_json)
    except (ValueError, RecursionError):
        return None
    out, rest = [], [("", root)]
    while rest:
        path, v = rest.pop()
        if isinstance(v, (tuple, list)) and v:
            if isinstance(v, tuple):
                keys = [k if _PLAIN_KEY.fullmatch(k) else json.dumps(k, ensure_ascii=False) for k, _ in v]
                inner = [(f"{path}.{k}" if path else k, x) for k, (_, x) in zip(keys, v, strict=True)]
            else:
                inner = [(f"{path}[{i}]", x) for i, x in enumerate(v)]
            rest += reversed(inner)
        else:
            kind = "null" if v is None else {str: "string", bool: "boolean", float: "number", list: "array", tuple: "object"}[type(v)]
            out.append({"path": path, "type": kind})
    return out


def leaf_paths(c: Column) -> Column:
    @F.pandas_udf("array<struct<path:string,type:string>>")
    def extract(t: pd.Series) -> pd.Series:
        return t.map(leaf_paths_of)

    return extract(c)


#: Source keywords and the tier of what they name, the first that fits decides.
PUBLIC_TIERS = (("yearbook", "T1"), ("census", "T1"), ("survey", "T1"), ("journal", "T2"), ("gazette", "T3"), ("ministry", "T3"), ("bulletin", "T3"), ("brief", "T4"), ("programme", "T4"), ("note", "T4"))


def public_tier(source: Column, url: Column) -> Column:
    """The tier that a source's name suggests; without one, government hosts are T3 and the rest T4."""
    t = F.lower(F.coalesce(source, F.lit("")))
    out = F.when(t.contains(PUBLIC_TIERS[0][0]), PUBLIC_TIERS[0][1])
    for word, tier in PUBLIC_TIERS[1:]:
        out = out.when(t.contains(word), tier)
    return out.when(F.coalesce(url, F.lit("")).contains(".gov"), "T3").otherwise("T4")


#: Spellings rewritten in prose.
SPELLINGS = (("programme", "program"), ("labour", "labor"), ("centre", "center"), ("fertiliser", "fertilizer"), ("neighbour", "neighbor"), ("organis", "organiz"))


_SPELT = re.compile("|".join(old for old, _ in SPELLINGS), re.I)


def _other_spelling(m: re.Match) -> str:
    new = dict(SPELLINGS)[m[0].lower()]
    return new[0].upper() + new[1:] if m[0][0].isupper() else new


def respelled(text: str | None) -> str | None:
    """Rewrites spellings word by word, case kept, with URLs and names in capitals left alone."""
    if text is None:
        return None
    # URLs and names in capitals are every second part
    parts = re.split(r"(https?://\S+|\b[A-Z][A-Z0-9]{2,}\b)", text)
    parts[::2] = [_SPELT.sub(_other_spelling, p) for p in parts[::2]]
    return "".join(parts)


def respell(c: Column) -> Column:
    @F.pandas_udf(T.StringType())
    def rewrite(t: pd.Series) -> pd.Series:
        return t.map(respelled)

    return rewrite(c)


def supported(number: float, places: int, known: list[float]) -> bool:
    """Whether a written figure is a known one at the precision it is written in, or a sum, difference, product or ratio of two of them."""
    same = lambda x: abs(round(x, places) - number) < 10 ** -(places + 6)
    if any(same(k) for k in known):
        return True
    return any(same(v) for a in known for b in known for v in (a + b, a - b, a * b, *((a / b, 100 * a / b) if b else ())))
