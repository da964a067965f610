"""Variant spellings of names typed by people.

1. Texts become tokens: case, accents, punctuation, articles, titles and bracketed or leading acronyms go, joining words too.
2. A symmetric-delete neighbourhood index over the vocabulary (not over the texts) finds small edit distances and maps rare
   spellings to the frequent one beside them, so that typos cost nothing further on: texts with the same tokens are one form.
3. Forms that share a distinctive token, or have two that the index found to be neighbours, are candidates. They meet by hashed
   token, as pairs of 64-bit ids, and only distinct pairs fetch their forms.
4. Candidates are aligned by optimal assignment of their tokens, which permits initials, short forms, nicknames and small edits;
   every token of weight must find a partner.
5. Linked forms, and forms surely linked to the same third one, are expanded to pairs of texts.

The work follows the number of distinct texts and links. Tokens used in a share GENERIC_SHARE of the groups ("bank", "Francis") make no
candidates; a form of such tokens alone meets those with the same first letters, one token more or less, and is linked if all its
tokens agree closely. Nothing depends on the absolute number of texts or groups, nor is any number of tokens too many: a pair's costs
are bounded, so that forms that differ in more tokens than the bound allows end at once. Defined results: null and blank texts, texts
without any letter or digit, and texts without group or field are linked to nothing; repeated rows count once; ties between
spellings go to the more frequent, then to the greater text; words of more than LONG letters are mended if their first or last
LONG / 3 letters are right; numbers are never mended.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agrolith.session import broadcast_if_small, checkpointed

#: A token that occurs in such a share of the groups (subjects), and in three at least, says little about who is meant.
GENERIC_SHARE = 0.1
#: Words of more letters are indexed by their ends, not by deletions, whose number grows with the square of the length.
LONG = 39
#: What the tokens of two forms may cost together, and the least cost of a token that isn't the same in both.
MOST, LEAST = 2.6, 0.2
#: A spelling is taken for a slip of another one that has so many times its texts.
DOMINANCE = 3
_INF = 1e9
#: Cost of reading an initial as a name.
INITIAL = 0.4

#: Words and titles without weight.
JOINERS = frozenset("of for and the de la du des der die das und et le les el los las y in on at to".split())
TITLES = frozenset("dr mr mrs ms mx miss prof professor eng engr ing hon sir dame rev".split())
_PART = frozenset(("phase", "stage", "round", "part", "lot", "tranche", "cycle"))
_ROMAN = {"i": "1", "ii": "2", "iii": "3", "iv": "4", "v": "5", "vi": "6", "vii": "7", "viii": "8", "ix": "9", "x": "10"}

#: Given names and their short or pet forms (those that merely begin the name need no entry).
NICKNAMES = {
    "alexander": "sandy sasha xander lex", "andrew": "drew", "anthony": "tony", "benjamin": "benny", "catherine": "kate kathy katie kit cathy", "charles": "chuck charlie",
    "christopher": "kit topher", "daniela": "ella dany", "dorothy": "dot dolly dottie dora", "edward": "ted teddy ned eddie", "eleanor": "nell nora ellie", "elizabeth": "liz beth lizzie betty bess libby betsy lisa",
    "francis": "frank frankie fran", "frederick": "fred", "gabriel": "gabe", "harold": "harry hal", "henry": "harry hank", "isabella": "bella izzy belle", "james": "jim jimmy jamie", "john": "jack johnny", "jonathan": "jon jonny johnny nathan",
    "joseph": "joe joey", "katherine": "kate kathy katie kit kitty", "leonard": "lenny leo", "margaret": "maggie meg peggy greta madge", "mary": "molly polly", "matilda": "tilly tilda mattie",
    "michael": "mike mick mikey micky", "nathaniel": "nate", "nicholas": "nick", "patricia": "trish tricia patty", "patrick": "paddy", "philippa": "pippa pip", "rebecca": "becky becca",
    "richard": "dick rick", "robert": "bob bobby rob", "samuel": "sammy", "sarah": "sally", "stephen": "steve", "susannah": "sue susie sukey suzie zanna hannah", "susan": "sue susie", "theodore": "ted teddy", "theresa": "tess tessa terry tessie",
    "thomas": "tommy", "victoria": "vicky tori", "vincent": "vince vinnie", "william": "bill billy will willy liam", "zacharie": "zack zac",
}
_FULL: dict[str, frozenset[str]] = {}
for _full, _forms in NICKNAMES.items():
    for _f in (_full, *_forms.split()):
        _FULL[_f] = _FULL.get(_f, frozenset()) | {_full}


def tokens_of(text: str | None) -> list[str]:
    """The tokens of a name in their order."""
    if not text:
        return []
    t = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).casefold()
    t = re.sub(r"(?<=\w)&|&(?=\w)", "and", t).replace("&", " ").replace("'", "").replace("’", "")
    t = re.sub(r"^\s*[^\W\d_]{2,8}\s+[—–-]+\s+(?=\S+\s+\S)", " ", t)
    t = re.sub(r"[(\[]\s*[^\W\d_]{2,8}\s*[)\]]", lambda m: m[0] if m[0].strip("()[] ") in _ROMAN else " ", t)
    raw = re.findall(r"[^\W_]+", t)
    words = [w for w in raw if w not in JOINERS and w not in TITLES] or raw
    for i, w in enumerate(words):
        if w in _ROMAN and (len(w) > 1 and w not in ("vi", "ix") or i and distance(words[i - 1], "phase", 1) <= 1 or i and words[i - 1] in _PART):
            words[i] = _ROMAN[w]
    return words


def distance(a: str, b: str, most: int) -> int:
    """Edits (insertion, deletion, substitution, swap of neighbours) from a to b, or most + 1."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            v = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, older[j - 2] + 1)
            row[j] = v
        if min(row) > most:
            return most + 1
    return min(row[-1], most + 1)


def edits_allowed(length: int) -> int:
    return 0 if length < 4 else 1 if length < 6 else 2


def _subsequence(a: str, b: str) -> bool:
    it = iter(b)
    return all(c in it for c in a)


@lru_cache(maxsize=1 << 18)
def token_cost(a: str, b: str, both_generic: bool) -> float:
    """What it costs to read a and b as one word; _INF if they can't be."""
    if a == b:
        return 0.0
    if a.isdigit() or b.isdigit():
        return _INF
    if _FULL.get(a, frozenset()) & _FULL.get(b, frozenset()):
        return 0.2
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if len(short) == 1:
        return INITIAL if long[0] == short or any(full[0] == short for full in _FULL.get(long, ())) else _INF
    if any(len(full) > 1 and distance(long, full, 1) <= 1 for full in _FULL.get(short, ())):
        return 0.4
    if len(long) - len(short) >= 2 and long.startswith(short) and (len(short) > 2 or short == "co"):
        return 0.3
    if len(long) - len(short) >= 2 and len(short) > 3 and short[-1] in "iysoe" and long.startswith(short[:-1]):
        return 0.4
    if len(long) - len(short) >= 2 and short[0] == long[0] and 3 <= len(short) <= 5 and _subsequence(short, long) and sum(c in "aeiou" for c in short) <= 1:
        return 0.4
    if both_generic:
        return _INF
    most = edits_allowed(len(long))
    d = distance(a, b, most)
    if d <= most:
        return 0.5 * d
    if len(short) >= 4 and len(long) - len(short) >= 3 and distance(short, long[: len(short)], 1) <= 1:
        return 0.9
    return _INF


def assignment(cost: list[list[float]]) -> list[int]:
    """The column of each row at least total cost (Hungarian method); rows are no more than columns."""
    n, m = len(cost), len(cost[0])
    u, v, match, way = [0.0] * (n + 1), [0.0] * (m + 1), [0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        low, used = [float("inf")] * (m + 1), [False] * (m + 1)
        while True:
            used[j0] = True
            i0, delta, j1 = match[j0], float("inf"), 0
            for j in range(1, m + 1):
                if not used[j]:
                    c = cost[i0 - 1][j - 1] - u[i0] - v[j]
                    if c < low[j]:
                        low[j], way[j] = c, j0
                    if low[j] < delta:
                        delta, j1 = low[j], j
            for j in range(m + 1):
                if used[j]:
                    u[match[j]] += delta
                    v[j] -= delta
                else:
                    low[j] -= delta
            j0 = j1
            if not match[j0]:
                break
        while j0:
            j1 = way[j0]
            match[j0], j0 = match[j1], j1
    out = [0] * n
    for j in range(1, m + 1):
        if match[j]:
            out[match[j] - 1] = j - 1
    return out


@lru_cache(maxsize=1 << 16)
def _spare(token: str) -> float:
    """What it costs to leave a token without a partner."""
    if len(token) == 1 and token.isalpha():
        return 0.3
    if len(token) <= 4 and any(distance(token, j, 1) <= 1 for j in ("of", "for", "and", "the")) and token not in _ROMAN and not token.isdigit():
        return 0.3
    return _INF


def alignment(a: list[str], b: list[str], generic: frozenset[str]) -> int:
    """How two token lists name one entity: 0 not at all, 1 with an initial read as a name, 2 without.

    All tokens of weight are aligned at small cost, a distinctive one among them. Two names of generic tokens alone need closer agreement.
    """
    if not a or not b:
        return 0
    common = Counter(t for t in a if len(t) > 1) & Counter(t for t in b if len(t) > 1)
    ra, rb = list((Counter(a) - common).elements()), list((Counter(b) - common).elements())
    anchored = any(t not in generic and len(t) > 3 for t in common)
    aligned, total, sure = sum(common.values()), 0.0, 2
    if ra or rb:
        if LEAST * max(len(ra), len(rb)) > MOST:
            return 0
        # square matrix: rows are a's tokens and empty places, columns b's
        n, m = len(ra), len(rb)
        cost = [[token_cost(x, y, x in generic and y in generic) for y in rb] for x in ra]
        left, right = [_spare(x) for x in ra], [_spare(y) for y in rb]
        # most pairs end here: a token that can be neither aligned nor left out
        if any(s >= _INF and all(c >= _INF for c in row) for s, row in zip(left, cost, strict=True)) or any(s >= _INF and all(row[j] >= _INF for row in cost) for j, s in enumerate(right)):
            return 0
        big = [row + [s] * n for row, s in zip(cost, left, strict=True)]
        big += [right + [0.0] * n for _ in range(m)]
        pick = assignment(big)
        total = sum(big[i][j] for i, j in enumerate(pick))
        if total >= _INF:
            return 0
        for i, j in enumerate(pick[:n]):
            if j < m:
                aligned += 1
                anchored |= min(len(ra[i]), len(rb[j])) > 3 and not (ra[i] in generic and rb[j] in generic)
                if (len(ra[i]) == 1) != (len(rb[j]) == 1):
                    sure = 1
    if not anchored and all(t in generic or len(t) < 4 for t in (*a, *b)):
        return sure if sure == 2 and aligned >= 2 and total <= 0.4 * aligned else 0
    return sure if anchored and aligned >= min(2, len(a), len(b)) and total <= MOST else 0


def deletes(token: Column, twice_from: int = 8, once_from: int = 4) -> Column:
    """The token and what is left of it after one deletion (from 4 letters on) or two (from 8 on); of more than LONG letters, its ends."""
    one = lambda t: F.transform(F.sequence(F.lit(1), F.length(t)), lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t))))
    none = F.array().cast("array<string>")
    long = F.length(token) > LONG
    d1 = F.when(~long & (F.length(token) >= once_from), one(token)).otherwise(none)
    d2 = F.when(~long & (F.length(token) >= twice_from), F.flatten(F.transform(one(token), one))).otherwise(none)
    # a word just beyond LONG may be a slip of one just below
    ends = F.when(F.length(token) > LONG - 2, F.array(F.concat(F.lit("<"), F.left(token, F.lit(LONG // 3))), F.concat(F.lit(">"), F.right(token, F.lit(LONG // 3))))).otherwise(none)
    return F.array_distinct(F.concat(F.array(token), d1, d2, ends))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _tokens(texts: pd.Series) -> pd.Series:
    return texts.map(tokens_of)


@F.pandas_udf(T.BooleanType())
def _near(a: pd.Series, b: pd.Series) -> pd.Series:
    def ok(x: str, y: str) -> bool:
        most = 1 if min(len(x), len(y)) < 8 else 2
        return distance(x, y, most) <= most

    return pd.Series([ok(x, y) for x, y in zip(a, b, strict=True)], dtype=bool)


# Both tests are declared nondeterministic: else Catalyst pushes them below the distinct that spares them repeated pairs.
_near = _near.asNondeterministic()

#: Marks the generic tokens of a form.
_COMMON = "~"


@F.pandas_udf(T.IntegerType())
def _aligned(a: pd.Series, b: pd.Series) -> pd.Series:
    def read(form: str) -> tuple[list[str], list[str]]:
        marked = form.split(" ")
        return [t.removeprefix(_COMMON) for t in marked], [t[1:] for t in marked if t[0] == _COMMON]

    def of(x: str, y: str) -> int:
        (tx, gx), (ty, gy) = read(x), read(y)
        return alignment(tx, ty, frozenset(gx) | frozenset(gy))

    return pd.Series([of(x, y) for x, y in zip(a, b, strict=True)], dtype="int32")


_aligned = _aligned.asNondeterministic()


def generic_from(groups: int) -> int:
    """In how many of the groups a token must occur to be generic."""
    return max(3, math.ceil(GENERIC_SHARE * groups))


def vocabulary(texts: DataFrame, group: str) -> DataFrame:
    """field, group, token, n (texts of the group), total, groups, generic; from field, group, text, tokens."""
    local = texts.select("field", group, F.explode(F.array_distinct("tokens")).alias("token")).groupBy("field", group, "token").agg(F.count("*").alias("n"))
    over = local.groupBy("field", "token").agg(F.sum("n").alias("total"), F.count("*").alias("groups"))
    fields = local.select("field", group).distinct().groupBy("field").agg(F.greatest(F.lit(3), F.ceil(F.count("*") * GENERIC_SHARE)).alias("_from"))
    return local.join(over, ["field", "token"]).join(fields, "field").withColumn("generic", F.col("groups") >= F.col("_from")).drop("_from")


def spread(written: DataFrame) -> DataFrame:
    """A written frame over at least so many partitions as there are cores: each of its few rows is about to become many."""
    n = written.sparkSession.sparkContext.defaultParallelism
    return written if written._jdf.queryExecution().toRdd().getNumPartitions() >= n else written.repartition(n)


def neighbours(vocab: DataFrame, group: str) -> DataFrame:
    """field, group, token, other, n, m: words of one group and field that are one slip apart, or two (from eight letters on), in both orders; generic ones aside."""
    key = F.explode(F.transform(deletes(F.col("token")), lambda k: F.xxhash64("field", group, k))).alias("key")
    own = vocab.where("not generic and length(token) > 2").select("field", group, "token", "n", key)
    other = own.select("key", F.col("field").alias("_f"), F.col(group).alias("_g"), F.col("token").alias("other"), F.col("n").alias("m"))
    met = own.join(other, "key").where((F.col("token") < F.col("other")) & (F.abs(F.length("token") - F.length("other")) <= 2) & (F.col("field") == F.col("_f")) & (F.col(group) == F.col("_g")))
    near = met.select("field", group, "token", "other", "n", "m").distinct().where(_near("token", "other"))
    turn = F.array(F.struct("token", "other", "n", "m"), F.struct(F.col("other").alias("token"), F.col("token").alias("other"), F.col("m").alias("n"), F.col("n").alias("m")))
    return near.select("field", group, F.inline(turn))


def spellings(vocab: DataFrame, near: DataFrame, group: str, dominance: int = DOMINANCE) -> DataFrame:
    """field, group, token, canon: rare spellings and the frequent one that each is a slip of.

    Against words used everywhere by their total counts, else against the words of the same group. A slip that could be
    of several words used everywhere comes out as its own canon: it is no generic word, however often it occurs.
    """
    words = vocab.where("token rlike '^[^0-9]{3,}$'")
    over = words.select("field", "token", "total", "groups", "generic").distinct()
    hashed = lambda c: F.explode(F.transform(deletes(F.col(c)), lambda k: F.xxhash64("field", k))).alias("key")
    left = over.select("field", F.col("token"), F.col("total"), hashed("token"))
    right = over.where("generic").select(F.col("field").alias("_f"), F.col("token").alias("canon"), F.col("total").alias("ctotal"), hashed("token"))
    # the generic words are few; if they prove so, the vocabulary isn't shuffled by its keys
    slips = left.join(broadcast_if_small(checkpointed(right)), "key").where((F.col("field") == F.col("_f")) & (F.col("ctotal") >= F.col("total") * 2 * dominance) & (F.col("token") != F.col("canon"))).select("field", "token", "canon", "ctotal").distinct().where(_near("token", "canon"))
    # a spelling of three letters, or near two such words, is left as it is for the alignment to decide; wide is null then
    common = checkpointed(slips.groupBy("field", "token").agg(F.when((F.count("*") == 1) & (F.length(F.min("token")) > 3), F.min("canon")).alias("wide")))
    frequent = near.where((F.col("m") >= dominance) & (F.col("m") >= F.col("n") * dominance) & ~F.col("token").rlike("[0-9]") & ~F.col("other").rlike("[0-9]"))
    free = frequent.join(common, ["field", "token"], "left_anti").join(common.select("field", F.col("token").alias("other")), ["field", "other"], "left_anti")
    local = free.groupBy("field", group, "token").agg(F.max_by("other", F.struct("m", "other")).alias("canon"))
    wide = words.select("field", group, "token").join(common, ["field", "token"]).select("field", group, "token", F.coalesce("wide", "token").alias("canon"))
    return wide.unionByName(local)


def candidates(forms: DataFrame, near: DataFrame, group: str) -> DataFrame:
    """a, b (a < b): ids of distinct forms (id, field, group, own, sign) that share a distinctive token or two neighbouring ones, or, without any, first letters."""
    at = forms.select(F.col("id").alias("a"), F.explode(F.transform("own", lambda t: F.xxhash64("field", group, t))).alias("tid"))
    beside = near.where("token < other").select(F.xxhash64("field", group, "token").alias("tid"), F.xxhash64("field", group, "other").alias("to"))
    visits = at.join(beside, "tid").select(F.col("to").alias("tid"), F.col("a").alias("b"))
    met = at.join(at.select("tid", F.col("a").alias("b")), "tid").where("a < b").select("a", "b").unionByName(at.join(visits, "tid").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    # forms of generic tokens alone: by the first letters of their tokens, one of them left out or none
    letters = lambda keep: F.xxhash64("field", group, F.array_join(keep, ""))
    less = F.transform(F.sequence(F.lit(1), F.size("sign")), lambda i: letters(F.concat(F.slice("sign", F.lit(1), i - 1), F.slice("sign", i + 1, F.size("sign")))))
    plain = forms.where("size(own) = 0 and size(sign) > 0").select("id", F.explode(F.array_distinct(F.concat(F.array(letters(F.col("sign"))), less))).alias("key"))
    signs = plain.select("key", F.col("id").alias("a")).join(plain.select("key", F.col("id").alias("b")), "key").where("a < b").select("a", "b")
    return met.unionByName(signs).distinct()


def link_variants(names: DataFrame, group: str = "subject") -> DataFrame:
    """group, field, text_a, text_b (a < b): pairs of different texts of one group and field that name one entity.

    ``names`` has the columns group, field, text; repeated rows count once.
    """
    given = names.where(F.col("text").isNotNull() & (F.trim("text") != "") & F.col(group).isNotNull() & F.col("field").isNotNull()).select(group, "field", "text").distinct()
    texts = checkpointed(given.withColumn("tokens", _tokens("text")).where(F.size("tokens") > 0))
    vocab = spread(checkpointed(vocabulary(texts, group)))
    near = checkpointed(neighbours(vocab, group))
    canon = checkpointed(spellings(vocab, near, group))
    # the form of a text: its tokens, slips mended, generic ones marked, in alphabetical order
    slips = canon.where("canon = token").select("field", group, "token", F.lit(True).alias("slip"))
    kinds = vocab.join(slips, ["field", group, "token"], "left").select("field", group, F.col("token").alias("mended"), (F.col("generic") & F.col("slip").isNull()).alias("generic"))
    flat = texts.select(group, "field", "text", F.explode("tokens").alias("token")).join(canon, ["field", group, "token"], "left").select(group, "field", "text", F.coalesce("canon", "token").alias("mended"))
    known = flat.join(kinds, ["field", group, "mended"], "left").select(group, "field", "text", F.when(F.coalesce("generic", F.lit(True)), F.concat(F.lit(_COMMON), "mended")).otherwise(F.col("mended")).alias("m"))
    per = known.groupBy(group, "field", "text").agg(F.array_join(F.sort_array(F.collect_list("m")), " ").alias("form"))
    members = checkpointed(per.select(F.xxhash64(group, "field", "form").alias("id"), group, "field", "text", "form"))
    forms = checkpointed(members.select("id", group, "field", "form").distinct())
    marked = forms.select("id", group, "field", F.split("form", " ").alias("t"))
    own = F.array_distinct(F.filter("t", lambda x: ~x.startswith(_COMMON) & (F.length(x) > 3)))
    sign = F.array_sort(F.transform(F.filter("t", lambda x: F.length(F.ltrim(x, F.lit(_COMMON))) > 1), lambda x: F.left(F.ltrim(x, F.lit(_COMMON)), F.lit(1))))
    pairs = candidates(marked.select("id", group, "field", own.alias("own"), sign.alias("sign")), near, group)
    side = lambda n: forms.select(F.col("id").alias(n), F.col("form").alias(f"form_{n}"), F.struct(group, "field").alias(f"of_{n}"))
    read = pairs.join(side("a"), "a").join(side("b"), "b").where("of_a = of_b")
    direct = checkpointed(read.select("a", "b", _aligned("form_a", "form_b").alias("sure")).where("sure > 0"))
    # two forms that are both surely a third one are the same: that reaches slips on either side of the right spelling
    sure = direct.where("sure = 2")
    both = sure.select("a", "b").unionByName(sure.select(F.col("b").alias("a"), F.col("a").alias("b")))
    over = both.join(both.select(F.col("b").alias("c"), F.col("a").alias("b")), "b").where("a < c").select("a", F.col("c").alias("b"))
    links = direct.select("a", "b").unionByName(over).distinct()
    left, right = (members.select(F.col("id").alias(n), group, "field", F.col("text").alias(t)) for n, t in (("a", "x"), ("b", "y")))
    across = links.join(left, "a").join(right.select("b", "y"), "b").select(group, "field", "x", "y")
    within = left.join(right.select(F.col("b").alias("a"), "y"), "a").where("x < y").select(group, "field", "x", "y")
    return across.unionByName(within).select(group, "field", F.least("x", "y").alias("text_a"), F.greatest("x", "y").alias("text_b"))
