"""Several values packed in one field: dictionary-guided segmentation.

A multi-pattern automaton finds the known whole values in a text, dynamic programming picks the cover with the most
characters, and marks inside a covered value are protected. Two kinds of field:

* ``codes``: items consist of letters, digits, dots and hyphens; all else separates, also a joining word between two codes.
* ``phrases``: one kind of mark separates; other marks, and all marks inside enclosing quotes, belong to the phrase.

Defined results: null, blank and empty texts have no items; empty pieces take no position; repeated items stay, in order;
a text without a mark is one item; an unclosed quote is an ordinary character. Very long texts cost time in proportion to
their length (the automaton and the cover are both linear in text plus matches).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agrolith.session import checkpointed

#: Separating marks, the most telling first: a mark that rarely stands inside a phrase comes before one that often does.
STRONG = ("\n", ";", "；", "|", "•", "·", "、", "\t")
WEAK = (",", "/", "&", "+")
MARKS = frozenset(STRONG + WEAK + ("\r",))
_LIST_MARK = re.compile(r"^(?:[-*•·–—▪]+(?:\s+|$)|\d{1,3}[.)]\s+)+")
_CODE = re.compile(r"[^\W_](?:(?:[^\W_]|[.\-])*[^\W_])?")
_BRACKETS = {"[": "]", "(": ")", "{": "}"}
#: With more known values than this, or more bytes in them, the dictionary is joined instead of broadcast; the result is the same.
DICTIONARY_BOUND = 50_000
DICTIONARY_BYTES = 16 << 20

Spans = list[tuple[int, int]]


def best_cover(spans: Iterable[tuple[int, int]]) -> Spans:
    """Of the spans, a set that doesn't overlap and covers the most characters; of equals the one with fewer spans."""
    ends: list[tuple[int, int]] = sorted(set(spans), key=lambda s: (s[1], s[0]))
    best: list[tuple[int, int, int, int]] = [(0, 0, -1, -1)]  # covered, -count, index of the span, row before it
    at = [0]
    import bisect

    for i, (a, b) in enumerate(ends):
        j = bisect.bisect_right(at, a, 1) - 1
        covered, count, _, _ = best[j]
        take = (covered + b - a, count - 1, i, j)
        best.append(take if take[:2] > best[-1][:2] else (*best[-1][:2], -1, len(best) - 1))
        at.append(b)
    out, k = [], len(best) - 1
    while k > 0:
        _, _, i, j = best[k]
        if i >= 0:
            out.append(ends[i])
        k = j
    return out[::-1]


def automaton(values: Iterable[str]):
    """An Aho-Corasick automaton of the values; None of none."""
    import ahocorasick

    a = ahocorasick.Automaton()
    n = 0
    for v in values:
        a.add_word(v, len(v))
        n += 1
    if not n:
        return None
    a.make_automaton()
    return a


def occurrences(found, text: str) -> Iterator[tuple[int, int]]:
    if found is not None:
        for end, length in found.iter(text):
            yield end + 1 - length, end + 1


def _is_code_char(c: str) -> bool:
    return c.isalnum() or c in ".-"


def segment_codes(text: str | None, known: Callable[[str], Iterable[tuple[int, int]]]) -> list[str]:
    """Items of a field of codes. Known codes are covered first; the rest is cut at what no code can hold."""
    if not text:
        return []
    n = len(text)
    cover = best_cover((a, b) for a, b in known(text) if not (a and _is_code_char(text[a - 1])) and not (b < n and _is_code_char(text[b])))
    tokens: list[tuple[str, bool]] = []
    at = 0
    for a, b in [*cover, (n, n)]:
        tokens += [(m.group(), False) for m in _CODE.finditer(text, at, a)]
        if a < b:
            tokens.append((text[a:b], True))
        at = b
    word = [not sure and t.isalpha() and t.islower() for t, sure in tokens]
    return [t for i, (t, _) in enumerate(tokens) if not (word[i] and 0 < i < len(tokens) - 1 and any(not w for w in word[:i]) and any(not w for w in word[i + 1 :]))]


def _quoted(text: str) -> list[tuple[int, int]]:
    """Spans of enclosing quotes, quotes included: one opens where an item can begin, and closes where one can end."""
    out, i, n, may_open = [], 0, len(text), True
    while i < n:
        c = text[i]
        if may_open and c in "\"'“":
            close = "”" if c == "“" else c
            j = i + 1
            while j < n:
                if text[j] == "\\" and j + 1 < n:
                    j += 2
                elif text[j] == close:
                    if j + 1 < n and text[j + 1] == close and close == '"':
                        j += 2
                        continue
                    k = j + 1
                    while k < n and text[k] in "  ":
                        k += 1
                    if k >= n or text[k] in MARKS or text[k] in "])}":
                        break
                    j += 1
                else:
                    j += 1
            if j < n:
                out.append((i, j + 1))
                i, may_open = j + 1, False
                continue
        if c in MARKS or c in "[({":
            may_open = True
        elif not c.isspace() and not (may_open and c in "-*–—"):
            may_open = False
        i += 1
    return out


def _clean(piece: str, escaped: bool) -> str:
    piece = piece.strip()
    if not (len(piece) > 1 and piece[0] in "\"'“"):
        piece = _LIST_MARK.sub("", piece).strip()
    for _ in range(2):
        if len(piece) > 1 and piece[0] + piece[-1] in ('""', "''", "“”") and _quoted(piece) == [(0, len(piece))]:
            q = piece[0]
            piece = piece[1:-1]
            if escaped:
                piece = re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), piece)
            elif q == '"':
                piece = piece.replace('""', '"')
            piece = piece.strip()
        elif len(piece) > 1 and _BRACKETS.get(piece[0]) == piece[-1] and not any(c in "()[]{}" for c in piece[1:-1]):
            piece = piece[1:-1].strip()
        else:
            break
    return piece


def _unwrapped(text: str) -> tuple[str, bool]:
    t = text.strip()
    if len(t) > 1 and t[0] == "[" and t[-1] == "]":
        return t[1:-1], True
    if len(t) > 1 and _BRACKETS.get(t[0]) == t[-1] and not any(c in "()[]{}" for c in t[1:-1]):
        return t[1:-1], False
    return t, False


def _cut(text: str, mark: str, shut: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Pieces between the marks that no shut span holds."""
    out, start, k = [], 0, 0
    i = text.find(mark)
    while i >= 0:
        while k < len(shut) and shut[k][1] <= i:
            k += 1
        if not (k < len(shut) and shut[k][0] <= i):
            out.append((start, i))
            start = i + len(mark)
        i = text.find(mark, i + len(mark))
    return [*out, (start, len(text))]


def segment_phrases(text: str | None, known: Callable[[str], Iterable[tuple[int, int]]], is_known: Callable[[str], bool]) -> list[str]:
    """Items of a field of phrases whose separator isn't known beforehand."""
    if text is None or not text.strip():
        return []
    body, escaped = _unwrapped(text)
    body = body.replace("\r\n", "\n").replace("\r", "\n")
    quoted = _quoted(body)
    n = len(body)

    def free(a: int, b: int) -> bool:
        """Whether a value found at a..b is a whole piece: marks or ends beside it."""
        left = body[:a].rstrip("  ") if a else ""
        if left and left[-1] in "-*–—" and (len(left) == 1 or left[:-1].rstrip(" ")[-1:] in MARKS or not left[:-1].strip()):
            left = left[:-1].rstrip(" ")
        right = body[b:].lstrip("  ")
        return (not left or left[-1] in MARKS) and (not right or right[0] in MARKS)

    inside = lambda a, b: any(s < b and a < e for s, e in quoted)
    whole = body.strip()
    if not quoted and is_known(whole):
        return [whole]
    shut = sorted([*quoted, *best_cover((a, b) for a, b in known(body) if not inside(a, b) and free(a, b))])
    choices = []
    for rank, mark in enumerate((*STRONG, *WEAK)):
        pieces = _cut(body, mark, shut)
        if len(pieces) > 1:
            items = [x for x in (_clean(body[a:b], escaped) for a, b in pieces) if x]
            sure = sum(is_known(x) for x in items)
            if mark in WEAK and not escaped and not quoted and not sure:
                spaced = any(a and body[a - 2 : a - 1].isspace() for a, _ in pieces[1:])
                if mark != "," and not spaced:
                    continue
            choices.append((-sure, mark in WEAK, rank, items))
    if not choices:
        item = _clean(body, escaped)
        return [item] if item else []
    return min(choices, key=lambda c: c[:3])[3]


def certain_phrases(text: str | None) -> list[str]:
    """Pieces that need no dictionary: of quoted lists, between strong marks, and texts without any mark."""
    if text is None or not text.strip():
        return []
    body, escaped = _unwrapped(text)
    body = body.replace("\r\n", "\n").replace("\r", "\n")
    quoted = _quoted(body)
    marks = [m for m in STRONG if len(_cut(body, m, quoted)) > 1]
    if escaped or (quoted and not marks):
        return [x for x in (_clean(body[a:b], escaped) for a, b in quoted) if x]
    if len(marks) == 1:
        return [x for x in (_clean(body[a:b], escaped) for a, b in _cut(body, marks[0], quoted)) if x]
    if not marks and not any(m in body for m in WEAK):
        return [x for x in [_clean(body, escaped)] if x]
    return []


_ITEMS = T.ArrayType(T.StringType())


def phrase_dictionary(df: DataFrame, column: str, min_support: int = 1) -> DataFrame:
    """Known whole values of a column with their number of occurrences, counted over all rows."""

    @F.pandas_udf(_ITEMS)
    def pieces(texts: pd.Series) -> pd.Series:
        return texts.map(certain_phrases)

    found = df.select(F.explode(pieces(F.col(column))).alias("value"))
    return found.groupBy("value").agg(F.count("*").alias("support")).where(F.col("support") >= min_support)


def code_dictionary(*columns: tuple[DataFrame, str]) -> DataFrame:
    out = None
    for df, c in columns:
        one = df.select(F.col(c).alias("value")).where(F.col(c).isNotNull() & (F.col(c) != ""))
        out = one if out is None else out.unionByName(one)
    return out.distinct()


def bounded(dictionary: DataFrame, bound: int = DICTIONARY_BOUND, most_bytes: int = DICTIONARY_BYTES) -> list[str] | None:
    """The dictionary's values if neither they nor their bytes are more than the bounds, else None; only what is within reaches the driver."""
    n, size = dictionary.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("value")), F.lit(0))).first()
    return None if n > bound or size > most_bytes else sorted(r[0] for r in dictionary.select("value").collect())


def _segmenter(kind: str, values: list[str]) -> Callable[[str | None], list[str]]:
    found, members = automaton(values), frozenset(values)
    spans = lambda text: occurrences(found, text)
    if kind == "codes":
        return lambda text: segment_codes(text, spans)
    return lambda text: segment_phrases(text, spans, members.__contains__)


def segment_column(column, kind: str, values: list[str]):
    """A column of item arrays, by the broadcast dictionary."""
    cache: list = []

    @F.pandas_udf(_ITEMS)
    def items(texts: pd.Series) -> pd.Series:
        if not cache:
            cache.append(_segmenter(kind, values))
        return texts.map(lambda t: cache[0](None if t is None else str(t)))

    return items(column)


def code_candidates(text: str | None, longest: int) -> list[str]:
    """Every stretch of a text, up to the longest known value, that a known code could cover: no letter, digit, dot or hyphen goes on beside it."""
    if not text:
        return []
    n = len(text)
    starts = [a for a in range(n) if not a or not _is_code_char(text[a - 1])]
    ends = [b for b in range(1, n + 1) if b == n or not _is_code_char(text[b])]
    out, first = set(), 0
    for a in starts:
        while first < len(ends) and ends[first] <= a:
            first += 1
        k = first
        while k < len(ends) and ends[k] - a <= longest:
            out.add(text[a : ends[k]])
            k += 1
    return list(out)


_OPENING = re.compile(r"(?:[\s\-*•·–—▪]|\d{1,3}[.)])*")


def phrase_candidates(text: str | None, longest: int) -> list[str]:
    """Every stretch between two marks or ends that can be looked up as a known phrase, as it stands and cleaned.

    Cleaning takes off outer blanks, list marks, two layers of brackets or quotes and their escapes, so that a stretch of more than
    four times the longest phrase behind its opening can't become one.
    """
    if text is None or not text.strip():
        return []
    body, escaped = _unwrapped(text)
    body = body.replace("\r\n", "\n").replace("\r", "\n")
    cuts = [-1, *(i for i, c in enumerate(body) if c in MARKS), len(body)]
    out = set()
    for i, a in enumerate(cuts[:-1]):
        limit = _OPENING.match(body, a + 1).end() + 4 * longest + 16
        for b in cuts[i + 1 :]:
            if b > limit and body[limit:b].strip():
                break
            raw = body[a + 1 : b].strip()
            out.update((raw, _clean(raw, escaped)))
            if raw[:1] in ("-", "*", "–", "—"):
                out.add(raw[1:].strip())
    out.discard("")
    return [x for x in out if len(x) <= longest]


def _found_in(values: list[str]) -> Callable[[str], Iterator[tuple[int, int]]]:
    """Occurrences of the few known values of one text, looked for one by one."""

    def spans(text: str) -> Iterator[tuple[int, int]]:
        for v in values:
            at = text.find(v)
            while at >= 0:
                yield at, at + len(v)
                at = text.find(v, at + 1)

    return spans


def segment_by_join(df: DataFrame, column: str, kind: str, dictionary: DataFrame) -> DataFrame:
    """Adds ``items`` by the same cover, with the dictionary joined: for one that is too large to broadcast.

    Every stretch of a distinct text that can be a known value is looked up by an equality join; what is found goes back to its
    text, whose cover is then picked as in :func:`segment_column`.
    """
    longest = dictionary.agg(F.max(F.length("value"))).first()[0] or 0
    candidates = code_candidates if kind == "codes" else phrase_candidates

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def stretches(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: candidates(t, longest))

    texts = df.select(F.col(column).alias("text")).where(F.col(column).isNotNull()).distinct()
    hits = texts.select("text", F.explode(stretches("text")).alias("value")).join(dictionary.select("value"), "value", "left_semi")
    per = texts.join(hits.groupBy("text").agg(F.collect_set("value").alias("known")), "text", "left")

    @F.pandas_udf(_ITEMS)
    def items(texts: pd.Series, known: pd.Series) -> pd.Series:
        def of(t: str, k) -> list[str]:
            values = [] if k is None else list(k)
            return segment_codes(t, _found_in(values)) if kind == "codes" else segment_phrases(t, _found_in(values), frozenset(values).__contains__)

        return pd.Series([of(t, k) for t, k in zip(texts, known, strict=True)], dtype=object)

    return df.join(per.select(F.col("text").alias(column), items("text", "known").alias("items")), column, "left")


def unpack(df: DataFrame, table_name: str, key: str, fields: dict[str, tuple[str, DataFrame]], bound: int = DICTIONARY_BOUND) -> DataFrame:
    """One row per item: table_name, field, row_key, pos, item. ``fields``: name -> (kind, dictionary of known values)."""
    rows = df.select(key, *fields).distinct()
    arrays, large = [], []
    for name, (kind, counted) in fields.items():
        dictionary = checkpointed(counted) if kind == "phrases" else counted  # counted once, then sized and read
        values = bounded(dictionary, bound)
        if values is None:
            large.append(segment_by_join(rows.select(key, name), name, kind, dictionary).select(F.col(key).alias("row_key"), F.lit(name).alias("field"), "items"))
        else:
            arrays.append(F.struct(F.lit(name).alias("field"), segment_column(F.col(name), kind, values).alias("items")))
    out = None
    if arrays:
        out = rows.select(F.col(key).alias("row_key"), F.inline(F.array(*arrays)))
    for one in large:
        out = one.select("row_key", "field", "items") if out is None else out.unionByName(one)
    exploded = out.select("row_key", "field", F.posexplode("items").alias("pos", "item"))
    return exploded.select(F.lit(table_name).alias("table_name"), "field", "row_key", (F.col("pos") + 1).alias("pos"), "item")
