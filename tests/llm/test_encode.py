import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from agrolith.llm import encode as e

FILE = os.path.join(e.TOKENIZER_DIR, "byte_bpe_50k.json")
pytestmark = pytest.mark.skipif(not os.path.exists(FILE), reason="no vocabulary files")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    return lambda texts: [x.ids for x in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def ours(texts, name=e.DEFAULT):
    ids, at = e.encoder(name).texts(texts)
    return [ids[at[i] : at[i + 1]].tolist() for i in range(len(texts))]


TEXTS = ["", None, " ", "a", "Hello  world\n\n\n x", "a" * 5000, "ab" * 3000, "aaa aaaa  aaaaa", "<|endoftext|> hi", "é" * 999, "日本語テキスト" * 50, "\u0000\u0001", "😀" * 100, "I'll we've 12345 3.14 !!!??", " leading", "trailing  ", "\r\n\t mixed   blanks", "the " * 4000]


def test_cases(library):
    assert ours(TEXTS) == library(TEXTS)


@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), max_size=5))
@settings(max_examples=150, deadline=None)
def test_any_text(library, texts):
    assert ours(texts) == library(texts)


@given(st.text("ab ", max_size=200))
@settings(max_examples=100, deadline=None)
def test_runs(library, text):
    assert ours([text]) == library([text])


def test_rank_file(library):
    assert ours(TEXTS, "byte_bpe_50k.tiktoken") == library(TEXTS)


def test_documents(spark, data, library):
    from agrolith.llm.queries import p8_ids
    from agrolith.sources.tables import table

    got = {r["doc_id"]: r["ids"] for r in p8_ids(spark, data).collect()}
    docs = table(spark, data, "documents").select("doc_id", "text").collect()
    assert got == dict(zip([r["doc_id"] for r in docs], library([r["text"] for r in docs]), strict=True))
    assert e.encode(table(spark, data, "documents").limit(0)).count() == 0


def test_round_trip():
    back = {i: bytes([b]) for b, i in enumerate(e.encoder().byte_ids)}
    import json

    symbols = e.byte_symbols()
    for token, i in json.load(open(FILE, encoding="utf-8"))["model"]["vocab"].items():
        if all(s in symbols for s in token):
            back[i] = bytes(symbols[s] for s in token)
    for t, ids in zip(TEXTS, ours(TEXTS), strict=True):
        assert b"".join(back[i] for i in ids).decode() == (t or "")
