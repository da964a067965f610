"""Quantities in prose: a scanner over tokens that reads figures and number words with sign, currency, scale, per cent and measure, and checks of claims against known quantities.

A quantity is, in this order: a sign or "minus"; a currency; a figure (grouped by commas, with decimals, exponent or raised exponent) or
number words ("two hundred and five", "a third", "two thirds", "two and a half", "half a", "three dozen"); a scale; per cent; a
currency; a measure. Dates, versions and codes such as 2019-05-01, 1.2.3 or A1 are no quantities. Defined results: null and empty texts
have no quantities; a figure too great for a double is infinite and supported by nothing.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words of numbers, fractions, scales and currencies, and what is counted.
_SMALL = {w: i for i, w in enumerate("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split())}
_TENS = {w: 10 * (i + 2) for i, w in enumerate("twenty thirty forty fifty sixty seventy eighty ninety".split())}
_PARTS = {"half": 2, "third": 3, "quarter": 4, "fourth": 4, "fifth": 5, "sixth": 6, "seventh": 7, "eighth": 8, "ninth": 9, "tenth": 10}
_SCALES = {"thousand": 1e3, "k": 1e3, "million": 1e6, "mn": 1e6, "m": 1e6, "billion": 1e9, "bn": 1e9, "trillion": 1e12}
_SCALE_NAME = {"k": "thousand", "mn": "million", "m": "million", "bn": "billion"}
_CURRENCIES = {"us$": "USD", "$": "USD", "usd": "USD", "dollar": "USD", "dollars": "USD", "€": "EUR", "eur": "EUR", "euro": "EUR", "euros": "EUR", "£": "GBP", "gbp": "GBP", "pound": "GBP", "pounds": "GBP"}
_MEASURES = {x: m for m, xs in {
    "people": "people person persons", "farmers": "farmer farmers", "households": "household households", "members": "member members", "villages": "village villages", "districts": "district districts", "hectares": "hectare hectares ha", "acres": "acre acres",
    "tonnes": "tonne tonnes ton tons", "kg": "kg kilogram kilograms", "km": "km kilometre kilometres kilometer kilometers", "years": "year years", "months": "month months", "days": "day days", "rows": "row rows entry entries indicator indicators", "plots": "plot plots",
    "records": "record records", "sales": "sale sales", "names": "name names", "times": "times", "sites": "site sites", "pages": "page pages", "sources": "source sources", "projects": "project projects", "users": "user users",
}.items() for x in xs.split()}
_RAISED = str.maketrans("⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻", "0123456789+-")
_TOKEN = re.compile(r"(?P<figure>(?:\d{1,3}(?:,\d{3})+(?!\d)|\d+)(?:\.\d+)?|\.\d+)(?P<power>[eE][+-]?\d+(?![\w])|[⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻]+)?|(?P<word>US\$|[^\W\d_]+(?:'[^\W\d_]+)?)|(?P<mark>[^\s\w])|_")


@dataclass
class Token:
    kind: str
    text: str
    start: int
    end: int
    power: str = ""


def _tokens(text: str) -> list[Token]:
    return [Token("figure" if m["figure"] else "word" if m["word"] else "mark", m[0], m.start(), m.end(), m["power"] or "") for m in _TOKEN.finditer(text)]


def _figure(t: Token) -> float:
    base = float(t.text.removesuffix(t.power).replace(",", ""))
    try:
        if t.power[:1] in ("e", "E"):
            return float(t.text.replace(",", ""))
        return base ** int(t.power.translate(_RAISED)) if t.power else base
    except (OverflowError, ValueError, ZeroDivisionError):
        return math.inf


class _Scanner:
    def __init__(self, text: str):
        self.text, self.t = text, _tokens(text)

    def low(self, i: int) -> str:
        return self.t[i].text.lower() if i < len(self.t) else ""

    def near(self, i: int) -> bool:
        """Whether only blanks, or a hyphen that was skipped, stand before token i."""
        gap = self.text[self.t[i - 1].end : self.t[i].start] if 0 < i < len(self.t) else "\n"
        return gap.strip() == "" and "\n\n" not in gap

    def step(self, i: int) -> int:
        """i, or the token behind a hyphen that joins words."""
        return i + 1 if self.low(i) == "-" and i + 1 < len(self.t) and self.t[i].end == self.t[i + 1].start and self.t[i - 1].end == self.t[i].start else i

    def words(self, i: int) -> tuple[float, int] | None:
        """A run of number words at i: its value and the token behind it."""
        total = part = 0.0
        at, seen, last = i, False, ""
        while at < len(self.t) and (at == i or self.near(at)):
            w = self.low(at)
            if w == "and" and seen and self.low(at + 1) in _SMALL.keys() | _TENS.keys() and last == "hundred":
                at += 1
                continue
            if w in _SMALL and last not in _SMALL and (last not in _TENS or 0 < _SMALL[w] < 10):
                part += _SMALL[w]
            elif w in _TENS and last not in _SMALL and last not in _TENS:
                part += _TENS[w]
            elif w == "hundred" and last in _SMALL.keys() | _TENS.keys():
                total, part = total + part * 100, 0.0
            else:
                break
            seen, last = True, w
            at = self.step(at + 1)
        if not seen:
            return None
        # a hyphen behind the last word belongs to what follows
        if self.t[at - 1].text == "-":
            at -= 1
        return total + part, at

    def number(self, i: int) -> tuple[float, int, bool] | None:
        """Value, token behind, whether it is written in figures."""
        if i >= len(self.t):
            return None
        t = self.t[i]
        if t.kind == "figure":
            return _figure(t), i + 1, True
        w = self.low(i)
        one = w in ("a", "an", "one")
        j = self.step(i + 1)
        if one and self.low(j) in _PARTS and (j > i + 1 or self.fraction_ends(j + 1)):
            return 1 / _PARTS[self.low(j)], j + 1, False
        if w == "half" and self.low(j) in ("a", "an") and self.low(j + 1) in _SCALES:
            return 0.5, j + 1, False
        if w == "half" and self.fraction_ends(i + 1):
            return 0.5, i + 1, False
        if one and w != "one" and self.low(j) == "dozen" or w == "dozen":
            return 12.0, (i if w == "dozen" else j) + 1, False
        if w in ("a", "an") and self.low(i + 1) in ("thousand", "million", "billion", "trillion"):
            return 1.0, i + 1, False
        got = self.words(i)
        if got is None:
            return None
        value, at = got
        k = self.step(at)
        if self.low(k) == "and" and self.low(k + 1) in ("a", "an") and self.low(k + 2) in _PARTS and not self.glued(k + 3):
            return value + 1 / _PARTS[self.low(k + 2)], k + 3, False
        part = self.low(k).removesuffix("s")
        if self.low(k) == "halves" or part in _PARTS and self.low(k).endswith("s"):
            return value / (2 if self.low(k) == "halves" else _PARTS[part]), k + 1, False
        if self.low(k) == "dozen" or self.low(k) == "a" and self.low(k + 1) == "dozen":
            return value * 12, k + (1 if self.low(k) == "dozen" else 2), False
        return value, at, False

    def fraction_ends(self, i: int) -> bool:
        return i >= len(self.t) or self.low(i) in ("of", "percent", "per", *_SCALES) or self.t[i].kind == "mark" and not self.glued(i)

    def glued(self, i: int) -> bool:
        """Whether token i is a hyphen that joins the word before it to another one."""
        return self.low(i) == "-" and i + 1 < len(self.t) and self.t[i - 1].end == self.t[i].start and self.t[i].end == self.t[i + 1].start

    def code(self, i: int, behind: int) -> bool:
        """Whether the figure at i is glued to letters or is part of a date, a version or a range of digits."""
        before = self.text[self.t[i].start - 1] if self.t[i].start else " "
        after = self.text[self.t[behind - 1].end :][:2]
        if before.isalnum() or before in "_./:#" or before == "-" and self.t[i].start > 1 and self.text[self.t[i].start - 2].isalnum():
            return True
        return bool(re.match(r"[./:\-–]\d|_", after)) or bool(after[:1].isalpha() and not re.match(r"(?i)(?:k|m|mn|bn|kg|km|ha|million|billion)\b", self.text[self.t[behind - 1].end :]))

    def quantity(self, i: int) -> tuple[dict, int] | None:
        start, sign, currency, at = i, 1.0, None, i
        if self.low(at) in ("minus", "negative", "-", "−", "+") and at + 1 < len(self.t):
            if self.low(at) in ("-", "−", "+") and self.t[at].start and not self.text[self.t[at].start - 1].isspace() and self.text[self.t[at].start - 1] not in "([":
                return None
            sign, at = (1.0 if self.low(at) == "+" else -1.0), at + 1
        if self.low(at) in _CURRENCIES and at + 1 < len(self.t):
            currency, at = _CURRENCIES[self.low(at)], at + 1
        got = self.number(at)
        if got is None:
            return None
        value, behind, figures = got
        if figures and self.code(at, behind):
            return None
        shown = self.t[at].text.removesuffix(self.t[at].power) if figures else ""
        scale = unit = measure = None
        end = behind
        k = self.step(end)
        if self.low(k) in _SCALES and (self.near(k) or k > end) and not (self.low(k) in ("k", "m") and not figures):
            scale, end = _SCALE_NAME.get(self.low(k), self.low(k)), k + 1
            value *= _SCALES[self.low(k)]
        if self.low(end) in ("%", "percent"):
            unit, end = "percent", end + 1
        elif self.low(end) == "per" and self.low(end + 1) == "cent":
            unit, end = "percent", end + 2
        if currency is None and self.low(end + 1) in ("dollar", "dollars") and self.low(end) == "us":
            currency, end = "USD", end + 2
        elif currency is None and self.low(end) in _CURRENCIES and self.t[end].kind == "word" and self.low(end) != "us$":
            currency, end = _CURRENCIES[self.low(end)], end + 1
        k = self.step(end)
        of = 2 if self.low(k) == "of" and self.low(k + 1) == "the" else 1 if self.low(k) == "of" else 0
        if self.low(k + of) in _MEASURES and (not of or not figures):
            measure, end = _MEASURES[self.low(k + of)], k + of + 1
            if measure in ("kg", "tonnes") and (self.low(end), self.low(end + 1)) in (("/", "ha"), ("per", "hectare"), ("per", "ha")):
                measure, end = measure + "/ha", end + 2
        a, b = self.t[start].start, self.t[end - 1].end
        places = len(shown.partition(".")[2])
        return {"raw": self.text[a:b], "number": sign * value, "currency": currency, "scale": scale, "unit": unit, "measure": measure, "places": places, "start": a, "end": b}, end


def quantities_of(text: str | None) -> list[dict]:
    """The quantities of a text in their order: raw, number, currency, scale, unit, measure, places (decimals written), start, end."""
    s, out, i = _Scanner(text or ""), [], 0
    while i < len(s.t):
        got = s.quantity(i)
        if got is None:
            i += 1
        else:
            out.append(got[0])
            i = got[1]
    return out


_SCHEMA = "array<struct<raw:string,number:double,currency:string,scale:string,unit:string,measure:string,places:int,start:int,end:int>>"


def quantities(c: Column) -> Column:
    @F.pandas_udf(_SCHEMA)
    def extract(texts: pd.Series) -> pd.Series:
        return texts.map(quantities_of)

    return extract(c)


def dimension(q: dict) -> tuple:
    """What must be the same in two quantities that are compared: currency, per cent, measure."""
    return q["currency"], q["unit"], q["measure"]


def agrees(claim: dict, known: float, words: str = "") -> bool:
    """Whether a claimed quantity is a known number at the precision it is written in; "more than" and "less than" before it count."""
    if not (math.isfinite(claim["number"]) and math.isfinite(known)):
        return False
    if re.search(r"\b(?:more than|over|above|at least)\s*$", words, re.I):
        return known >= claim["number"]
    if re.search(r"\b(?:less than|under|below|at most)\s*$", words, re.I):
        return known <= claim["number"]
    unit = _SCALES.get(claim["scale"] or "", 1.0)
    step = unit * 10.0 ** -claim["places"]
    # half up at the last written place
    return math.isclose(math.floor(known / step + 0.5 + 1e-9) * step, claim["number"], rel_tol=1e-9, abs_tol=1e-12)


def calculation_holds(operation: str, a: dict, b: dict, result: dict, words: str = "") -> bool:
    """Whether result is the sum, difference, product, ratio or percentage of two quantities, dimensions included.

    Sums and differences keep the dimension; a product is of pure numbers; a ratio of two quantities of one dimension is pure, a percentage per cent.
    """
    x, y = a["number"], b["number"]
    if operation in ("sum", "difference"):
        return dimension(a) == dimension(b) == dimension(result) and agrees(result, x + y if operation == "sum" else x - y, words)
    pure = (None, None, None)
    if operation == "product":
        return dimension(a) == dimension(b) == dimension(result) == pure and agrees(result, x * y, words)
    if operation in ("ratio", "percentage") and y and dimension(a) == dimension(b):
        wanted = pure if operation == "ratio" else (None, "percent", None)
        return dimension(result) == wanted and agrees(result, x / y * (100 if operation == "percentage" else 1), words)
    return False


def supported_of(text: str | None, known: list[dict]) -> list[bool]:
    """For each quantity of a text, whether a known quantity of the same dimension agrees with it."""
    return [any(dimension(q) == dimension(k) and agrees(q, k["number"], (text or "")[: q["start"]]) for k in known) for q in quantities_of(text)]


def support_counts(text: Column, known: Column) -> Column:
    """struct(claimed, supported): the quantities of a text, and those that a quantity of another text supports."""

    @F.pandas_udf("claimed int, supported int")
    def count(texts: pd.Series, others: pd.Series) -> pd.DataFrame:
        found = [supported_of(t, quantities_of(o)) for t, o in zip(texts, others, strict=True)]
        return pd.DataFrame({"claimed": [len(f) for f in found], "supported": [sum(f) for f in found]}, dtype="int32")

    return count(text, known)
