"""Encoding of texts with a byte-level BPE tokenizer, in numpy.

Texts are cut into words by the tokenizer's pattern; each distinct word of a batch is encoded once. Words are sorted into
buckets by length, each bucket a padded matrix of token ids; every round looks up the ranks of all neighbouring pairs in a
hashed pair table, each row merges its leftmost pair of minimum rank (and the further occurrences of that very pair, left to
right, which the sequential rule would merge next), and the matrix is compacted. Rows without a known pair leave the matrix.

Defined results: null and empty texts have no tokens; no special tokens are added, and their strings in a text are ordinary
text; lone surrogates can't occur in UTF-8 columns. Texts are processed whole; a word's cost grows with its length times the
number of its distinct merges, so that very long words are one row of a narrow bucket. The vocabulary file is a parameter and
is read by each Python worker from its own path, or from the files shipped with the session.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Where the vocabulary files lie; a path on every node.
TOKENIZER_DIR = os.environ.get("AGROLITH_TOKENIZERS", "/opt/tokenizers")
DEFAULT = "byte_bpe_50k"
#: Fixed value: the pattern that cuts text into words before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words kept between batches, so that frequent ones are encoded once per worker.
CACHE_WORDS = 200_000
CACHE_WORD_CHARS = 64
_NONE = np.int64(1 << 40)


def byte_symbols() -> dict[str, int]:
    """The printable symbol that stands for each byte in byte-level vocabularies: visible Latin-1 characters stand for themselves, the rest follow from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class PairTable:
    """Open addressing from (left id, right id) to (rank, merged id), probed for whole arrays at once."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(max(1, len(left)) * 4))))
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.rank, self.merged = np.full(1 << bits, _NONE, np.int64), np.zeros(1 << bits, np.int64)
        key = (left.astype(np.int64) << 32) | right
        at, todo, self.probes = self._slot(key), np.arange(len(key)), 0
        while len(todo):
            self.probes += 1
            free = self.keys[at[todo]] < 0
            slots, first = np.unique(at[todo[free]], return_index=True)
            won = todo[free][first]
            self.keys[slots], self.rank[slots], self.merged[slots] = key[won], rank[won], merged[won]
            todo = todo[self.keys[at[todo]] != key[todo]]
            at[todo] = (at[todo] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slot of each pair, or of an empty place (rank _NONE)."""
        key = ((left.astype(np.int64) << 32) | right).ravel()
        at = self._slot(key)
        held = self.keys[at]
        miss = np.flatnonzero((held != key) & (held >= 0))
        while len(miss):
            at[miss] = (at[miss] + 1) & self.mask
            held = self.keys[at[miss]]
            miss = miss[(held != key[miss]) & (held >= 0)]
        return at.reshape(left.shape)


class Encoder:
    """A byte-level BPE encoder of a vocabulary file (JSON with merges, or a list of ranks)."""

    def __init__(self, path: str):
        import regex

        self.cut = regex.compile(PATTERN).findall
        self.byte_ids = np.zeros(256, np.int64)
        if path.endswith(".json"):
            model = json.load(open(path, encoding="utf-8"))["model"]
            vocab = model["vocab"]
            for symbol, byte in byte_symbols().items():
                self.byte_ids[byte] = vocab[symbol]
            pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
            left, right, merged = (np.array([vocab[f(p)] for p in pairs], np.int64) for f in (lambda p: p[0], lambda p: p[1], lambda p: p[0] + p[1]))
            rank = np.arange(len(pairs), dtype=np.int64)
        else:
            import base64

            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
            for b in range(256):
                self.byte_ids[b] = ranks[bytes([b])]
            found = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
            left, right, merged = np.array(found, np.int64).reshape(-1, 3).T
            rank = merged
        self.table = PairTable(left, right, rank, merged)
        self.cache: dict[str, np.ndarray] = {}

    def words(self, words: list[str]) -> list[np.ndarray]:
        """Token ids of each word; the words are distinct."""
        raw = [w.encode("utf-8") for w in words]
        size = np.array([len(r) for r in raw], np.int64)
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(raw)
        order = np.argsort(size, kind="stable")
        at = 0
        while at < len(order):
            # a bucket: lengths up to a quarter above its shortest, and no more than about a million cells
            shortest = size[order[at]]
            end = int(np.searchsorted(size[order], max(shortest + 1, shortest + shortest // 4), "right"))
            end = min(end, at + max(1, (1 << 20) // max(1, int(size[order[end - 1]]))))
            for i, ids in zip(order[at:end], self._bucket([raw[i] for i in order[at:end]]), strict=True):
                out[i] = ids
            at = end
        return out

    def _bucket(self, raw: list[bytes]) -> list[np.ndarray]:
        n, size = len(raw), np.array([len(r) for r in raw], np.int64)
        width = int(size.max(initial=0))
        m = np.full((n, width + 1), -1, np.int64)
        inside = np.arange(width + 1) < size[:, None]
        m[inside] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        out: list[np.ndarray | None] = [None] * n
        rows = np.arange(n)
        left, right = m[:, :-1], m[:, 1:]
        slot = np.where(right >= 0, self.table.find(left, np.maximum(right, 0)), -1)
        while True:
            rank = np.where(slot >= 0, self.table.rank[slot], _NONE)
            best = rank.min(axis=1, initial=_NONE)
            done = best >= _NONE
            if done.any():
                for i in np.flatnonzero(done):
                    out[rows[i]] = m[i, : size[i]].copy()
                keep = ~done
                if not keep.any():
                    return out  # type: ignore[return-value]
                m, rows, size, slot, rank, best = m[keep], rows[keep], size[keep], slot[keep], rank[keep], best[keep]
            # the leftmost best pair of each row; more of the same pair go with it unless they overlap
            hit = rank == best[:, None]
            lead = hit.argmax(axis=1)
            hit &= slot == slot[np.arange(len(m)), lead][:, None]
            both = hit[:, 1:] & hit[:, :-1]
            if both.any():
                # a run of overlapping hits (one token repeated): every second one counts, from the run's start
                columns = np.arange(hit.shape[1])
                start = np.where(hit & ~np.concatenate([np.zeros((len(m), 1), bool), hit[:, :-1]], axis=1), columns, 0)
                run = columns - np.maximum.accumulate(start, axis=1)
                hit &= run % 2 == 0
            r, c = np.nonzero(hit)
            m[r, c] = self.table.merged[slot[r, c]]
            gone = np.zeros(m.shape, bool)
            gone[r, c + 1] = True
            merged_at = np.zeros(m.shape, bool)
            merged_at[r, c] = True
            size = size - hit.sum(axis=1)
            width = int(size.max())
            # compaction: what stays moves left, in order
            stay = ~gone & (m >= 0)
            to = np.cumsum(stay, axis=1) - 1
            rr, cc = np.nonzero(stay)
            fresh, moved, old = np.full((len(m), width + 1), -1, np.int64), np.zeros((len(m), width + 1), bool), np.full((len(m), width), -1, np.int64)
            tt = to[rr, cc]
            fresh[rr, tt], moved[rr, tt] = m[rr, cc], merged_at[rr, cc]
            narrow = cc < slot.shape[1]
            ok = narrow & (tt < width)
            old[rr[ok], tt[ok]] = slot[rr[ok], cc[ok]]
            # only pairs beside a merged token are looked up anew; a pair whose right part is gone had a merged left part
            new = (moved[:, :-1] | moved[:, 1:]) & (fresh[:, 1:] >= 0)
            old[fresh[:, 1:] < 0] = -1
            nr, nc = np.nonzero(new)
            old[nr, nc] = self.table.find(fresh[nr, nc], fresh[nr, nc + 1])
            m, slot = fresh, old

    def texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, offsets): null and empty texts have none."""
        cut = [self.cut(t) if t else [] for t in texts]
        unknown = list({w for ws in cut for w in ws} - self.cache.keys())
        known = self.cache
        if unknown:
            fresh = dict(zip(unknown, self.words(unknown), strict=True))
            if len(self.cache) + len(fresh) > CACHE_WORDS:
                known = {**self.cache, **fresh}
                self.cache = {}
            self.cache.update((w, i) for w, i in fresh.items() if len(w) <= CACHE_WORD_CHARS and len(self.cache) < CACHE_WORDS)
            if known is self.cache:
                long = {w: i for w, i in fresh.items() if w not in self.cache}
                known = {**self.cache, **long} if long else self.cache
        parts = [known[w] for ws in cut for w in ws]
        lengths = np.array([sum(len(known[w]) for w in ws) for ws in cut], np.int64)
        ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        return ids, np.concatenate([[0], np.cumsum(lengths)])


_ENCODERS: dict[str, Encoder] = {}


def encoder(name: str = DEFAULT, folder: str | None = None) -> Encoder:
    """The encoder of a vocabulary, read once per process."""
    path = os.path.join(folder or TOKENIZER_DIR, name if "." in name else f"{name}.json")
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


#: Texts encoded at a time, by their characters: bounds what a worker holds besides its Arrow batch.
CHUNK_CHARS = 1 << 20


def _chunks(texts: list[str | None]) -> Iterator[list[str | None]]:
    out, n = [], 0
    for t in texts:
        out.append(t)
        n += len(t or "")
        if n >= CHUNK_CHARS:
            yield out
            out, n = [], 0
    if out:
        yield out


def encode(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), name: str = DEFAULT, folder: str | None = None) -> DataFrame:
    """The kept columns with ``ids`` (array of int): token ids of the text, empty for null and empty texts. No shuffle."""
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(name, folder)
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            at = 0
            for chunk in _chunks(texts):
                ids, offsets = enc.texts(chunk)
                part = batch.slice(at, len(chunk))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(len(keep))], lists], names=[*keep, "ids"])
                at += len(chunk)

    return df.select(*keep, text).mapInArrow(run, schema)


def token_count(text: Column, name: str = DEFAULT, folder: str | None = None) -> Column:
    """The number of tokens of a text, 0 for null and empty ones."""

    @F.pandas_udf(T.LongType())
    def count(texts: pd.Series) -> pd.Series:
        enc = encoder(name, folder)
        return pd.Series([n for chunk in _chunks([None if t is None else str(t) for t in texts]) for n in np.diff(enc.texts(chunk)[1])], dtype="int64")

    return count(text)
