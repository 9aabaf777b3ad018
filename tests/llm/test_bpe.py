"""BPE encoding and decoding, against the tokenizers library."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from ledgerline.llm import bpe, queries
from ledgerline.llm.tokens import tokenizer_path
from llm.helpers import DOCS, SF, edge_docs, edge_rows, no_docs

tokenizers = pytest.importorskip("tokenizers")

ODD = ["", " ", "a  b", "x\n\ny", " lead", "\nlead", "trail ", "trail\n", "don't  we'll\tx", "it's, x's.", "a\x1cb c",
       "é ́a", "<|endoftext|> hi", "x<|endoftext|><|startoftext|>y's <|ENDOFTEXT|>", "ΑΣ. Σ", "12 5,6 7.", "a\0b",
       ".. y., z!? é. ×. ÷, «a». —.", "İstanbul ß.", "日本語。 テスト", "a　b", "'s 's. t's", "\u0085 x", "é ́e 가",
       "word, Word. WORD! word", "a" * 5000, "½ Ⅷ ①", "a​b᠎c⁠d", "ǅ ﬁ K Å", "﻿x", "🙂👍🏽 ok", "a b\x1f"]


@pytest.fixture(scope="module")
def file_text():
    with open(tokenizer_path(bpe.VOCABULARY), encoding="utf-8") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(file_text):
    return tokenizers.Tokenizer.from_str(file_text)


def check(coder, library, text):
    want = library.encode(text, add_special_tokens=False).ids
    got = coder.encode(text)
    assert np.frombuffer(got, "<u4").tolist() == want
    assert coder.decode(got).decode() == library.decode(want, skip_special_tokens=False)


def test_odd_texts(spark, file_text, library):
    coder = bpe.Bpe(file_text)
    texts = ODD + [r[1] or "" for r in edge_rows()]
    for text in texts + texts:  # the second time from memory
        check(coder, library, text)


def test_small_memory_and_pieces_change_nothing(spark, file_text, library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 8)
    monkeypatch.setattr(bpe, "PIECE", 5)
    monkeypatch.setattr(bpe, "LONGEST", 4)
    coder = bpe.Bpe(file_text)
    for text in ODD + ["one two one three two one four five one two" * 3]:
        check(coder, library, text)


@settings(max_examples=150, deadline=None)
@given(text=st.text(alphabet=st.sampled_from(list("abehinost 'sTHE.,<|>\néΣ́中7")), max_size=60))
def test_any_text(text):
    with open(tokenizer_path(bpe.VOCABULARY), encoding="utf-8") as f:
        raw = f.read()
    check(bpe.coder(raw), _library(raw), text)


_MADE = {}


def _library(raw):
    if "t" not in _MADE:
        _MADE["t"] = tokenizers.Tokenizer.from_str(raw)
    return _MADE["t"]


def test_another_kind_of_file_is_refused():
    with open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as f:
        text = f.read()
    with pytest.raises((ValueError, KeyError, TypeError)):
        bpe.Bpe(text)


def expected(library, rows):
    out = []
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        out.append((doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256(back.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_query_against_the_library(spark, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op11_bpe(spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(library, docs)


def test_edges_of_the_table(spark, library):
    queries.importable(spark)
    got = bpe.digests(edge_docs(spark, clash=True)).collect()
    assert sorted(map(tuple, got), key=repr) == expected(library, [(r[0], r[1]) for r in edge_rows()])
    assert bpe.digests(no_docs(spark)).count() == 0


def test_encoded_rows_decode(spark, library):
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(ODD)], DOCS)
    coded = bpe.encode(df)
    back = {r.doc_id: r.text for r in bpe.decode(coded).collect()}
    for i, t in enumerate(ODD):
        assert back[i] == library.decode(library.encode(t, add_special_tokens=False).ids, skip_special_tokens=False)
    nothing = spark.createDataFrame([(1, None)], "doc_id bigint, ids binary")
    assert [tuple(r) for r in bpe.decode(nothing).collect()] == [(1, "")]
