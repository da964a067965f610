"""Per-document text quality statistics, and rules that tell lists, tables and junk from natural prose.

Three groups of columns come out, and the kind is a rule on them:

* counts and shares (words, symbols, punctuated and marked lines, common and distinct words, duplicate lines and paragraphs):
  Spark expressions;
* the characters that the dominant 2-gram and 4-gram of words cover, occurrences that overlap counted once;
* the characters of the text by what they are read as: prose, list, table, odd (symbols, encodings, machine formats, navigation),
  repeated (of lines or paragraphs that stand REPEATS times or more) and looped (of a passage in which one n-gram covers more than
  DOMINANT, or whose words return at a fixed or any distance).

``kind``: prose (null) if at least half of the characters are prose, else the greatest of list, table and junk, junk being odd,
repeated and looped together; ties go to list, then table. Lines are read by cells and their agreement from line to line, list marks,
length and wording of items, and the share of common words of the four languages. Prose in any layout (wrapped, numbered
paragraphs, headings, upper case, simple markup, a short list or table in it) stays prose; fewer copies than REPEATS are prose.

Defined results: null and blank texts have zero counts, null shares and no kind; a text too short to judge (under MIN_WORDS
words and in no layout) counts as prose. Texts are read whole, at a cost in proportion to their length; one row comes out for
each row that goes in. No shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from operator import mul

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Common words of English, French, German and Spanish.
COMMON = frozenset(
    """a about after all although an and any are as asked at be because been before behind but by can could do does down even for from had has have he her his how i if in into is it its just last like made many may more most
    much near never no nor not now of off on one only or other our out over own said same says she should since so some still such than that the their them then there these they this those to too two under until up us use was we
    well were what when where whether which while who whole whom whose why will with within without would yet you your
    à au aucun aucune aussi autre autres aux avait avant avec avoir car ce ces cet cette ceux chez comme contre dans de depuis des dont du elle elles en encore entre est et été être fait faut fois il ils jamais je la le les leur leurs lors lui
    mais même ne ni non nos notre nous on ont ou où par parce pas peu plus plutôt pour près qu quand que qui sa sans se ses si soit son sont sous sur tard tous tout toute toujours très trop tôt un une vers voir vos votre y
    ab aber alle allen als also am an andere anderes auch auf aus außerhalb bei beim bis da damit dass dem den denn der des dessen deren die dies diese dieser doch durch ein eine einem einen einer eines er es etwas für gegen haben hat hatte hatten ihr
    ihre ihren im immer in ist ja je jede jeder kann kein keine keinen man mehr mit nach nach nicht nie noch nur ob oder ohne schon sehr sei sein seine seit sich sie sind so über um und uns unter vom von vor war waren was weil wenn wenige wer werden wie wieder wir wird
    wurde zu zum zur zwischen
    al algo alguna ante antes aquí así aún aunque cada casi como con contra cual cuando de del desde después donde dos durante el ella ellas ellos en entre era es esa ese eso esta están estas este esto estos fin fue fuera ha hace hacia han hasta hay la las le les lo los
    más me mi mientras misma mismo muy nadie ni no nos nunca o otra otras otro otros para pero poco pocos por porque pronto que qué quien quién se según ser si sido sin sobre solo son su sus también tan tiene toda todavía todo todos tras tres un una uno unos usa veces y ya""".split()
)
MIN_WORDS = 6
#: The number of equal lines or paragraphs that makes them junk; the share of a passage's words that repeat what stands before above which it is (between those of four
#: and of five equal parts); and the share of a text's words (by characters) above which one n-gram makes them junk.
REPEATS = 5
REPEATED = 0.77
DOMINANT = 0.5
_WORD = re.compile(r"[^\W\d_]+")
_BULLET = re.compile(r"^\s*(?:[-*+•–—·▪◦‣●○□☐☑]|o(?=\s)|\[[ xX]?\]|\(?(?:\d{1,3}|[a-zA-Z]|[ivxIVX]{1,5})[.)])\s+")
_TAG = re.compile(r"</?(?:p|br|div|span|b|i|em|strong|h[1-6]|li|ul|ol|section|article|body|html|a)\b[^<>]*>", re.I)
_ROW_TAG = re.compile(r"</?(?:tr|td|th|table|tbody|thead)\b", re.I)
_EMPTYISH = re.compile(r"^(?:[-–—]|n/?a|null|none|nan|\.{2,}|\?|x|[+\-~<>≈]?[$€£]?\s*\d[\d.,'  ]*\s*(?:%|‰|[a-z]{1,4})?|[$€£]?\s?\d+|[±+\-]?\d+(?:[/:\-.]\d+)+)$", re.I)
_LOG = re.compile(r"^\W*(?:\d{4}-\d\d-\d\d[T ]\d\d:\d\d|\d\d:\d\d:\d\d|\d{10,13}\b|\[?(?:debug|info|warn|warning|error|err|trace|fatal)\b)", re.I)
_MACHINE = re.compile(r'^\s*[{\[<].*["=:].*[}\]>],?\s*$|^\s*(?:at [\w.$]+\(|0x[0-9a-f]{4,}|[0-9a-f]{6,8}:?\s+[0-9a-f]{2} )|^\s*[\w.\-]+\s*[=:]\s*(?:0x)?[0-9a-f]{6,}\s*$', re.I)
_CLOSING = "\"'”’»)"
_INNER_STOP = re.compile(r"[^\W\d_]{2,}[.!?…][\"'”’»)]*\s+[\"'“‘«(¿¡]?[^\W\d_]")
_LABELS = re.compile(r"\s+(?:>|›|»(?=\s+[^\s>·|])|·|•|\||/|→)\s+")
_ODD = re.compile("[�\x80-\x9f\x00-\x08\x0b\x0e-\x1f]")
_DOUBLE = re.compile("[ÃÂâ][\x80-\xbf€™œž‚ƒ„…†‡ˆ‰Š‹Œ‘’“”•–—˜š›Ÿ]")
_SUSPECT = re.compile("[�\x80-\x9f\x00-\x08\x0b\x0e-\x1fÃÂâ]")
_DIGITS = re.compile(r"\d+")
_HEX = re.compile(r"(?:0x)?[0-9a-fA-F]{2,8}|[01]{6,}")
_ODD_TOKEN = re.compile(r"[^\W\d_]\d[^\W\d_]|\d[^\W\d_]{2,}\d|[^\W\d_]\|[^\W_]|[bcdfghjklmnpqrstvwxz]{6,}|^[bcdfghjklmnpqrstvwxz]{4,}$")
_ODD_CELL = re.compile(r"[^\w\s.,;:%‰()/'’&+|\-–—\"$€£]")
_GAP = re.compile(r"\s\s|\.{4}")
_PAIR = re.compile(r"(?:^|[;,|]\s*)([^\W\d_][\w ]{0,24})\s*[:=]\s*([^;,|:=]{1,30})")
_LABEL_SIGN = re.compile(r"\s[>›»·•|/→]\s")
_VOWEL = re.compile("[aeiouyàáâäãåéèêëíìîïóòôöõúùûüæœ]")
_CELL_SIGN = re.compile(r"[|\t<;]|\s{2}|\.{4}|,.*,|[:=].*[:=].*[:=]", re.S)
KINDS = ("list", "table", "junk")
#: What the characters of a text are read as.
READINGS = ("prose", "list", "table", "odd", "repeated", "looped")


def ended(line: str, stops: str = ".!?…") -> bool:
    """Whether a line ends with a stop, closing quotes and brackets aside."""
    last = line.rstrip(_CLOSING)[-1:]
    return bool(last) and last in stops


def common_share(words: list[str]) -> float:
    return len(list(filter(COMMON.__contains__, words))) / len(words) if words else 0.0


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def garbled_share(text: str) -> float:
    """Share of characters that come of wrong decoding: replacement marks, C1 controls, and Ã or Â before another odd character."""
    if not text or not _SUSPECT.search(text):
        return 0.0
    return (len(_ODD.findall(text)) + 2 * len(_DOUBLE.findall(text))) / len(text)


def _cells(line: str) -> tuple[str, int]:
    """(separator, number of cells) by which a line reads as a row of a table, ("", 0) if it doesn't."""
    s = line.strip()
    if not _CELL_SIGN.search(s):
        return "", 0
    if "<" in s and _ROW_TAG.search(s):
        return "<", max(2, len(re.findall(r"<t[dh]\b", s, re.I)))
    found = _split_cells(s)
    return found if found[0] and len(_ODD_CELL.findall(s)) <= 0.1 * len(s) else ("", 0)


def _few_words(cells: list[str], most: int) -> bool:
    """Whether no cell has more than so many words."""
    return all(len(words_of(c)) <= most for c in cells)


def _split_cells(s: str) -> tuple[str, int]:
    if s.count("|") >= 2 or s.startswith("|"):
        cells = s.strip("|").split("|")
        if len(cells) >= 2 and max(map(len, cells)) <= 60 and _few_words(cells, 6):
            return "|", len(cells)
    if "\t" in s:
        cells = s.split("\t")
        if len(cells) >= 2 and _few_words(cells, 8):
            return "\t", len(cells)
    if _GAP.search(s):
        gaps = re.split(r"\s{2,}|\s*\.{4,}\s*", s)
        if len(gaps) >= 2 and (len(gaps) >= 3 or re.search(r"\.{4,}", s)) and _few_words(gaps, 5):
            return " ", len(gaps)
    for sep in (";", ","):
        if s.count(sep) < 2:
            continue
        cells = [c.strip() for c in s.split(sep)]
        if max(map(len, cells)) <= 40 and _few_words(cells, 3):
            plain = sum(bool(_EMPTYISH.match(c)) for c in cells)
            if plain * 2 >= len(cells) or (not s.endswith(".") and all(c and " " not in c for c in cells) and ", " not in s):
                return sep, len(cells)
    if s.count(":") + s.count("=") >= 3:
        pairs = _PAIR.findall(s)
        if len(pairs) >= 3:
            return ":", len(pairs)
    return "", 0


def _junk_line(s: str, words: list[str], common: float, suspect: bool) -> bool:
    """Whether a line can't be read by anyone: symbols, encodings, dumps, navigation. ``common``: its share of common words; ``suspect``: whether its text has odd characters."""
    tokens = s.split()
    dense = sum(map(len, tokens))
    if not dense:
        return False
    if suspect and garbled_share(s) > 0.04:
        return True
    letters = sum(map(len, words))
    if dense >= 8 and dense - letters > 0.45 * dense and (dense - letters - sum(map(len, _DIGITS.findall(s)))) / dense > 0.45:
        return True
    longest = max(map(len, tokens), default=0)
    if longest >= 40 and not re.match(r"\W*(?:https?:|www\.)", max(tokens, key=len)) and longest > 0.4 * len(s):
        return True
    if common >= 0.4:
        return False
    if common < 0.25 and _LOG.match(s) or _MACHINE.match(s) and common_share([w for w in words if len(w) > 1]) < 0.2:
        return True
    # navigation: many short labels between separators
    labels = _LABELS.split(s.strip()) if _LABEL_SIGN.search(s) else ()
    if len(labels) >= 5 and all(len(x.split()) <= 3 for x in labels) and not any(ended(x, ".!?…:") for x in labels[:-1]) and not any(_EMPTYISH.match(x.strip()) for x in labels):
        return True
    spaced = re.split(r"\s{2,}", s.strip()) if _GAP.search(s) else ()
    if len(spaced) >= 8 and len(set(spaced)) < len(spaced) and all(len(x.split()) <= 3 for x in spaced) and not any(_EMPTYISH.match(x) for x in spaced):
        return True
    if len(tokens) >= 6:
        if sum(bool(_HEX.fullmatch(t)) and (len(t) != 4 or not t.isdigit()) for t in tokens) > 0.8 * len(tokens) and not words_of(" ".join(t for t in tokens if len(t) > 4)):
            return True
        if common < 0.2 and sum(bool(_ODD_TOKEN.search(t)) for t in s.lower().split()) > 0.3 * len(tokens):
            return True
    return False


def periodic_share(words: list[str], longest: int = 64) -> float:
    """The greatest share of words that equal the word a fixed distance before, over all distances up to ``longest``; repeated_share knows no distance."""
    n = len(words)
    if n < 10:
        return 0.0
    top = min(longest, n // 5)
    if len(set(words)) > 0.4 * n + top:
        return 0.6  # more different words than a share above this allows
    ids: dict[str, int] = {}
    a = np.array([ids.setdefault(w, len(ids)) for w in words], np.int32)
    return max(np.count_nonzero(a[p:] == a[:-p]) / (n - p) for p in range(1, top + 1))


def repeated_share(words: list[str], n: int = 8) -> float:
    """Share of words in n-grams that occur before, at any distance; of k equal parts it is (k - 1) / k."""
    seen: set[tuple[str, ...]] = set()
    covered = end = 0
    for i, gram in enumerate(zip(*[words[j:] for j in range(n)], strict=False)):
        if gram in seen:
            covered += i + n - max(i, end)
            end = i + n
        seen.add(gram)
    return covered / len(words) if words else 0.0


def _item_like(content: str, words: list[str]) -> bool:
    """Whether a line can be an item of a list: short, and no sentence."""
    if len(content) > 70 or len(words) > 9:
        return False
    return len(words) <= 4 or common_share(words) < 0.34 and not _INNER_STOP.search(content)


def weigh(text: str) -> dict[str, int]:
    """Characters of the text by READINGS; headings count for nothing."""
    weight = dict.fromkeys(READINGS, 0)
    body = text.replace("\r\n", "\n").replace("\r", "\n").replace("\u2028", "\n").replace("\x0b", "\n").replace("\x0c", "\n")
    lines: list[str] = []
    paragraphs: list[list[int]] = [[]]
    for x in body.split("\n"):
        l = _TAG.sub(" ", x) if "<" in x and not _ROW_TAG.search(x) else x
        if l.strip():
            paragraphs[-1].append(len(lines))
            lines.append(l)
        elif paragraphs[-1]:
            paragraphs.append([])
    words = [words_of(l) for l in lines]
    common = [common_share(w) for w in words]
    n = len(lines)
    rows = [_cells(l) for l in lines]
    suspect = bool(_SUSPECT.search(body))
    kinds: list[str] = [""] * n
    # tables: rows beside rows with the same separator and about as many cells
    for i in range(n):
        sep, cells = rows[i]
        if sep:
            beside = [rows[j] for j in (i - 2, i - 1, i + 1, i + 2) if 0 <= j < n]
            if any(r[0] == sep and (abs(r[1] - cells) <= 1 or sep in "<|") for r in beside) or sep == "<":
                kinds[i] = "table"
    # lines without sense
    repeats = Counter(l.strip() for l in lines)
    for i in range(n):
        if not kinds[i]:
            if _junk_line(lines[i], words[i], common[i], suspect):
                kinds[i] = "odd"
            elif n >= 8 and repeats[lines[i].strip()] > max(4, 0.2 * n) and len(words[i]) < 12:
                kinds[i] = "repeated"
    # list items: with a mark, or short lines in a row that don't make sentences together
    i = 0
    while i < n:
        if kinds[i]:
            i += 1
            continue
        mark = _BULLET.match(lines[i])
        content = lines[i][mark.end() :].strip() if mark else lines[i].strip()
        if mark and _item_like(content, words[i]):
            kinds[i] = "list"
            i += 1
            continue
        j = i
        while j < n and not kinds[j] and len(lines[j].strip()) <= 90 and not (_BULLET.match(lines[j]) and _item_like(_BULLET.sub("", lines[j], count=1).strip(), words[j])):
            j += 1
        if j - i >= 1:
            _run(lines, words, kinds, i, j)
            i = max(j, i + 1)
            continue
        kinds[i] = "prose"
        i += 1
    for i in range(n):
        if not kinds[i]:
            kinds[i] = "prose"
    # what is left as prose must read as prose
    prose = [i for i in range(n) if kinds[i] == "prose"]
    start = 0
    while start < len(prose):
        end = start + 1
        while end < len(prose) and prose[end] == prose[end - 1] + 1 and (len(lines[prose[end - 1]].strip()) <= 90 or len(lines[prose[end]].strip()) <= 90):
            end += 1
        part = [w for i in prose[start:end] for w in words[i]]
        found = _reading(part, ended(lines[prose[end - 1]].strip()))
        if found != "prose":
            for i in prose[start:end]:
                kinds[i] = found
        start = end
    # repetition over the whole text
    for i in _repeated(lines, paragraphs):
        if kinds[i] == "prose":
            kinds[i] = "repeated"
    prose = [i for i in range(n) if kinds[i] == "prose"]
    if len(prose) > 1 and dominated([w for i in prose for w in words[i]]):
        for i in prose:
            kinds[i] = "looped"
    for i in range(n):
        weight[kinds[i] if kinds[i] != "head" else "prose"] += 0 if kinds[i] == "head" else len(lines[i].strip())
    return weight


def _repeated(lines: list[str], paragraphs: list[list[int]]) -> set[int]:
    """Numbers of the lines that stand REPEATS times or are part of a paragraph that does, however it is wrapped."""
    found: set[int] = set()
    for parts in ([[i] for i in range(len(lines))], paragraphs):
        if len(parts) < REPEATS:
            continue
        texts = [" ".join(" ".join(lines[i] for i in p).split()) for p in parts]
        times = Counter(texts)
        found.update(i for p, t in zip(parts, texts, strict=True) if times[t] >= REPEATS for i in p)
    return found


def dominated(words: list[str]) -> bool:
    """Whether one 2-gram or 4-gram covers more than DOMINANT of 24 words or more."""
    if len(words) < 24:
        return False
    # an n-gram covers no more than its words do, so that one word must have a quarter of DOMINANT
    times = Counter(words)
    if max(map(mul, times.values(), map(len, times))) * 4 <= DOMINANT * sum(map(len, words)):
        return False
    return max(top_ngram_share(words, 2), top_ngram_share(words, 4)) > DOMINANT


def _reading(words: list[str], ended: bool) -> str:
    """What the words of a passage read as: prose, if there are common words among them and no endless repetition; else looped or odd.

    A short passage that ends like a sentence, with varied pronounceable words, needs no common word.
    """
    if len(words) < MIN_WORDS:
        return "prose"
    distinct = len(set(words))
    if common_share(words) < 0.12:
        long = [w for w in words if len(w) > 2]
        fine = ended and len(words) <= 30 and distinct > 0.7 * len(words) and sum(bool(_VOWEL.search(w)) for w in long) > 0.9 * len(long)
        return "prose" if fine else "odd"
    if len(words) >= 24 and periodic_share(words) > 0.6 or dominated(words):
        return "looped"
    # words that repeat stand before, each of them
    if len(words) >= 24 and distinct < (1 - REPEATED) * len(words) and repeated_share(words) > REPEATED:
        return "looped"
    return "looped" if len(words) >= 40 and distinct <= 8 else "prose"


def _run(lines: list[str], words: list[list[str]], kinds: list[str], i: int, j: int) -> None:
    """Reads lines i..j of at most 90 characters without list marks: a list, wrapped prose, or headings and single lines."""
    short = [k for k in range(i, j) if _item_like(lines[k].strip(), words[k])]
    stripped = [lines[k].strip() for k in range(i, j)]
    flat = [w for k in range(i, j) for w in words[k]]
    ends = sum(ended(s) for s in stripped)
    inner = sum(bool(_INNER_STOP.search(s)) for s in stripped)
    mean = sum(map(len, stripped)) / len(stripped)
    if j - i >= 3 and len(short) >= 0.7 * (j - i):
        listed = inner <= 0.1 * (j - i) and mean <= 40 and (ends <= 0.2 * (j - i) or common_share(flat) < 0.2) and common_share(flat) < 0.42
        if listed and not (ends and mean > 34 and common_share(flat) > 0.3):
            for k in range(i, j):
                kinds[k] = "list"
            # a sentence at either end is none of the items
            for k in (i, j - 1):
                if k not in short and ended(lines[k].strip(), ".!?…:"):
                    kinds[k] = "prose"
            return
    for k in range(i, j):
        s = lines[k].strip()
        alone = not ended(s, ".!?…:") or s.endswith(":")
        kinds[k] = "head" if alone and len(words[k]) <= 7 and (j - i == 1 or k in (i, j - 1)) and (k == i or j - i == 1) and not (j - i > 2 and ends >= 1 and k != i) else "prose"


def kind_of(weight: dict[str, int]) -> str | None:
    """The rule on the characters by READINGS, as :func:`kind` has it."""
    total = sum(weight.values())
    if weight["prose"] * 2 >= total:
        return None
    of = {"list": weight["list"], "table": weight["table"], "junk": weight["odd"] + weight["repeated"] + weight["looped"]}
    return max(KINDS, key=lambda k: of[k])


def classify(text: str | None) -> str | None:
    """``list``, ``table``, ``junk``, or None for prose, null and blank texts."""
    return None if text is None or not text.strip() else kind_of(weigh(text))


def top_ngram_share(words: list[str], n: int) -> float:
    """Share of the words' characters that one n-gram covers at most, if it occurs more than once; occurrences that overlap count once."""
    if len(words) <= n:
        return 0.0
    best = 0
    covers = ((times * sum(map(len, gram)), gram) for gram, times in Counter(zip(*[words[i:] for i in range(n)], strict=False)).items() if times > 1)
    for cover, gram in sorted(covers, reverse=True):
        if cover <= best:
            break
        if any(gram[d:] == gram[:-d] for d in range(1, n)):  # it can overlap itself
            times, i = 0, 0
            while i + n <= len(words):
                hit = tuple(words[i : i + n]) == gram
                times += hit
                i += n if hit else 1
            cover = times * sum(map(len, gram)) if times > 1 else 0
        best = max(best, cover)
    return best / sum(map(len, words))


@F.pandas_udf(T.StructType([T.StructField(r, T.LongType()) for r in READINGS]))
def _weights(texts: pd.Series) -> pd.DataFrame:
    none = dict.fromkeys(READINGS, 0)
    return pd.DataFrame([weigh(t) if t is not None and t.strip() else none for t in texts], columns=list(READINGS))


# declared nondeterministic: else a filter on the kind would have every text read twice
_weights = _weights.asNondeterministic()


@F.pandas_udf(T.StructType([T.StructField(n, T.DoubleType()) for n in ("two", "four")]))
def _ngrams(words: pd.Series) -> pd.DataFrame:
    lists = [[] if w is None else list(w) for w in words]
    return pd.DataFrame({"two": [top_ngram_share(w, 2) for w in lists], "four": [top_ngram_share(w, 4) for w in lists]}, dtype="float64")


def kind(weight: Column) -> Column:
    """The rule on the characters by READINGS."""
    of = {"list": weight["list"], "table": weight["table"], "junk": weight["odd"] + weight["repeated"] + weight["looped"]}
    prose = weight["prose"] >= of["list"] + of["table"] + of["junk"]
    most = F.greatest(*of.values())
    return F.when(~prose, F.when(of["list"] == most, "list").when(of["table"] == most, "table").otherwise("junk"))


#: Characters taken off both ends of lines and paragraphs.
_OUTER = " \t\n\x0b\x0c\r\u00a0\u2003\u2009\u202f\u3000"


def statistics(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, the words, and the counts and shares that Spark's expressions give."""
    t = F.col(text)
    blank = t.isNull() | (F.btrim(t, F.lit(_OUTER)) == "")
    t = F.when(~blank, t)
    body = F.regexp_replace(t, r"\r\n?", "\n")
    cut = lambda mark: F.filter(F.transform(F.split(body, mark), lambda x: F.btrim(x, F.lit(_OUTER))), lambda x: x != "")
    # a generator between the texts and what is counted in their parts: so each text is cut once
    parts = F.struct(
        F.regexp_extract_all(F.lower(t), F.lit(r"\p{L}+"), 0).alias("_words"), cut("\n").alias("_lines"), cut(r"\n\s*\n").alias("_paragraphs"),
        F.length(F.regexp_replace(t, r"\s+", "")).alias("_dense"), F.length(F.regexp_replace(t, "[^0-9]+", "")).alias("_digits"), F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")).alias("_upper"),
        (F.length(F.regexp_replace(t, f"[^{_ODD.pattern[1:-1]}]+", "")) + 2 * F.regexp_count(t, F.lit(_DOUBLE.pattern))).alias("_garbled"), F.length(t).alias("_chars"),
    )
    cells = df.select(*keep, F.inline(F.array(parts)))
    letters = lambda c: F.length(F.array_join(c, ""))
    n_words, n_lines = F.coalesce(F.size("_words"), F.lit(0)), F.coalesce(F.size("_lines"), F.lit(0))
    share = lambda a, b: F.when(b > 0, a / b)
    in_lines = lambda pattern: F.size(F.filter("_lines", lambda x: F.concat(x, F.lit(" ")).rlike(pattern)))
    duplicate = lambda c: share(letters(c) - letters(F.array_distinct(c)), letters(c))
    return cells.select(
        *keep, "_words", F.when(n_words > 0, n_words).otherwise(0).cast("bigint").alias("n_words"), F.when(n_lines > 0, n_lines).otherwise(0).cast("bigint").alias("n_lines"),
        share(letters("_words"), n_words).alias("mean_word_length"), share(F.col("_dense") - letters("_words") - F.col("_digits"), F.col("_dense")).alias("symbol_share"), share(F.col("_digits"), F.col("_dense")).alias("digit_share"),
        share(F.col("_upper"), letters("_words")).alias("upper_share"), share(in_lines(r"[.!?…:][\"'”’»)]* $"), n_lines).alias("punctuated_line_share"),
        share(in_lines(r"^(?:[-*+•–—·▪◦‣●○□☐☑]|o|\[[ xX]?\]|\(?(?:\d{1,3}|[a-zA-Z]|[ivxIVX]{1,5})[.)])\s"), n_lines).alias("marked_line_share"),
        share(F.size(F.filter("_words", lambda w: w.isin(*sorted(COMMON)))), n_words).alias("common_word_share"), share(F.size(F.array_distinct("_words")), n_words).alias("distinct_word_share"),
        F.when(n_lines > 0, F.col("_garbled") / F.col("_chars")).alias("garbled_share"), duplicate("_lines").alias("duplicate_line_share"), duplicate("_paragraphs").alias("duplicate_paragraph_share"),
    )


def readings(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, the text, its characters by READINGS and ``kind`` (list, table, junk, or null for prose and blank texts)."""
    return df.select(*keep, F.col(text).alias("_text"), _weights(text).alias("_w")).withColumn("kind", kind(F.col("_w")))


def quality(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns with all statistics and ``kind``."""
    counted = statistics(readings(df, text, keep), "_text", (*keep, "_w", "kind"))
    columns = [c for c in counted.columns if c not in (*keep, "_words", "_w", "kind")]
    shares = [F.when(F.col("n_words") > 0, F.col(f"_n.{k}")).alias(f"top_{i}gram_share") for i, k in ((2, "two"), (4, "four"))]
    return counted.select("*", _ngrams("_words").alias("_n")).select(*keep, *columns, *shares, *[F.col(f"_w.{r}").alias(f"{r}_chars") for r in READINGS], "kind")


def kinds(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The rows of :func:`quality` that have a kind, and it alone; what it doesn't rest on isn't computed."""
    return readings(df, text, keep).where("kind is not null").select(*keep, "kind")
