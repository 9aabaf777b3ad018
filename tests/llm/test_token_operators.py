"""Token files, separator scans and packing: exact round trips through the tokenizers library."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm.helpers import DOCS, SF, edge_docs, edge_rows, no_docs
from ledgerline.llm import packing, queries, tokenfiles, tokens, words
from ledgerline.llm.common import Scratch
from ledgerline.llm.tokens import Encoder, encode_batch, tokenizer_path

tokenizers = pytest.importorskip("tokenizers")

ODD = ["", " ", "a  b", "x\n\ny", " lead", "\nlead", "trail ", "trail\n", "don't  we'll\tx", "it's, x's.", "a\x1cb c",
       "é ́a", "<|endoftext|> hi", "ΑΣ. Σ", "12 5,6 7.", "a\0b", ".. y., z!? é. ×. ÷, «a». —.", "İstanbul ß.",
       "日本語。 テスト", "a　b", "a b  c", "'s 's. t's", "\u0085 x", "word, Word. WORD! word", "a" * 5000]


def whole(name, texts, end, ordinary=False):
    """Ids by plain library calls; ``ordinary``: special strings in a text are ordinary text."""
    t = tokenizers.Tokenizer.from_file(tokenizer_path(name))
    t.encode_special_tokens = ordinary
    return [np.array(e.ids + [end], "<u4") for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("name,kind", [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_pieces_give_the_ids_of_whole_texts(spark, name, kind):
    texts = ODD + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    with open(tokenizer_path(name), encoding="utf-8") as f:
        raw = f.read()
    for ordinary in (False, True):
        enc = Encoder(raw, kind, ordinary)
        for _ in range(2):  # the second time from memory
            got = [np.frombuffer(ids, "<u4").tolist() for _, ids in encode_batch(enc, pa.array(texts))]
            assert got == [ids[:-1].tolist() for ids in whole(name, texts, 0, ordinary)]


def morse(first, second, n):
    """Two words that a polynomial hash modulo 2**64 can not tell apart, whatever its base."""
    return "".join(first if bin(i).count("1") % 2 else second for i in range(n))


@pytest.mark.parametrize("name,kind", [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_words_are_told_apart_by_their_bytes(name, kind, monkeypatch):
    texts = [f"x {morse('a', 'b', 1024)} y", f"x {morse('b', 'a', 1024)} y", "one two", "two one three."]
    with open(tokenizer_path(name), encoding="utf-8") as f:
        raw = f.read()
    want = [ids[:-1].tolist() for ids in whole(name, texts, 0)]
    assert [np.frombuffer(x, "<u4").tolist() for _, x in encode_batch(Encoder(raw, kind), pa.array(texts))] == want
    hashes, _ = words.word_hashes(np.frombuffer(" ".join(texts[:2]).encode(), np.uint8), np.array([0, 2057]))
    assert len(set(hashes.tolist())) == 4
    # Even a hash that takes all words for the same gives the right ids.
    monkeypatch.setattr(words, "span_hashes", lambda flat, starts, ends: np.zeros(len(starts), np.uint64))
    assert [np.frombuffer(x, "<u4").tolist() for _, x in encode_batch(Encoder(raw, kind), pa.array(texts))] == want


@pytest.mark.parametrize("name,kind", [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_long_texts_are_cut_where_it_does_not_matter(name, kind, monkeypatch):
    monkeypatch.setattr(tokens, "SLICE_BYTES", 40)
    texts = ["it's one two three " * 9, "a" * 200, "x  y \n z   " * 12, "日本語 の 文 です 。" * 8, "<|endoftext|> hi " * 9,
             "no-space" * 20 + " end", "tail " * 30 + " ", "é è\u00a0 ü'll " * 12, "1 2 3 " * 20]
    with open(tokenizer_path(name), encoding="utf-8") as f:
        enc = Encoder(f.read(), kind)
    got = [np.frombuffer(x, "<u4").tolist() for _, x in encode_batch(enc, pa.array(texts))]
    assert got == [ids[:-1].tolist() for ids in whole(name, texts, 0)]


class Watched:
    """A library tokenizer that notes what it is asked to encode."""

    def __init__(self, tokenizer, seen):
        self._tokenizer, self._seen = tokenizer, seen

    def __getattr__(self, name):
        return getattr(self._tokenizer, name)

    def encode_batch(self, texts, **how):
        self._seen.extend(texts)
        return self._tokenizer.encode_batch(texts, **how)

    def encode_batch_fast(self, texts, **how):
        self._seen.extend(texts)
        return self._tokenizer.encode_batch_fast(texts, **how)


def watched(name, kind, **how):
    with open(tokenizer_path(name), encoding="utf-8") as f:
        enc = Encoder(f.read(), kind, **how)
    seen = []
    for part in ("_tokenizer", "_beside"):
        setattr(enc, part, Watched(getattr(enc, part, None), seen))
    return enc, seen


def test_words_of_all_kinds_go_to_the_library_in_long_lines():
    numbers = [f"w{i}" for i in range(1000)]
    letters = ["".join(chr(97 + int(c)) for c in str(i)) + "é" for i in range(1000)]
    texts = ["\n".join(["x", *numbers]), "\n".join(["x", *letters]), " ".join(["x", *numbers, *letters])]
    enc, seen = watched("byte_bpe_50k.json", "byte")
    got = [np.frombuffer(ids, "<u4").tolist() for _, ids in encode_batch(enc, pa.array(texts))]
    assert got == [ids[:-1].tolist() for ids in whole("byte_bpe_50k.json", texts, 0)]
    assert len(seen) < 40


@pytest.mark.parametrize("name,kind", [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_a_full_memory_forgets_the_older_half(name, kind, monkeypatch):
    monkeypatch.setattr(tokens, "SLICE_BYTES", 300)
    texts = [" ".join(f"word{i % n}x, {i}. é{i % n}ü\nИ{i % n}" for i in range(60)) for n in (3, 50, 7, 60, 5)] * 3
    want = [ids[:-1].tolist() for ids in whole(name, texts, 0)]
    with open(tokenizer_path(name), encoding="utf-8") as f:
        enc = Encoder(f.read(), kind, memory=100)
    assert [np.frombuffer(x, "<u4").tolist() for _, x in encode_batch(enc, pa.array(texts))] == want
    assert 0 < enc._newer.n < 400 and enc._older.n > 0
    # Words of one hash, met in different slices.
    monkeypatch.setattr(words, "span_hashes", lambda flat, starts, ends: np.zeros(len(starts), np.uint64))
    assert [np.frombuffer(x, "<u4").tolist() for _, x in encode_batch(enc, pa.array(texts))] == want


def expected_places(rows, end):
    rows = sorted(((d is not None, d or 0, t or "", d) for d, t in rows))
    ids = whole("byte_bpe_50k.json", [t for _, _, t, _ in rows], end)
    out, at = [], 0
    for (_, _, _, d), own in zip(rows, ids):
        out.append((d, at, len(own), zlib.crc32(own)))
        at += len(own)
    return out


def places(df):
    return [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in sorted(df.collect(), key=lambda r: r.start)]


def test_wavelet_files_round_trip(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert places(queries.op2_token_output(spark, SF)) == expected_places(docs, 2)
    rows = [(r[0], r[1]) for r in edge_rows()]
    assert places(tokenfiles.wavelet_documents(edge_docs(spark, clash=True), shard_tokens=500)) == \
        expected_places(rows, 2)
    assert tokenfiles.wavelet_documents(no_docs(spark)).count() == 0


def check_counts(rows, docs):
    rows = sorted(rows, key=lambda r: r.start)
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    ids = whole("byte_bpe_50k.json", [t or "" for _, t in docs], 0, ordinary=True)
    want = Counter((d, len(own)) for (d, _), own in zip(docs, ids))
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == want


def test_separator_scan_counts_tokens(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check_counts(queries.op5_token_counts(spark, SF).collect(), docs)
    rows = [(r[0], r[1]) for r in edge_rows()]
    for block in (7, 64, 1 << 18):  # documents across many blocks, blocks of many documents
        got = tokenfiles.count_tokens(edge_docs(spark, clash=True), file_tokens=300, block_tokens=block)
        check_counts(got.collect(), rows)
    assert tokenfiles.count_tokens(no_docs(spark)).count() == 0


def test_wavelet_matrix_against_the_plain_array():
    rng = np.random.default_rng(3)
    for n, top in ((1, 1), (5, 2), (1000, 9), (5000, 50257), (513, 1)):
        ids = rng.integers(0, top, n).astype(np.uint32)
        wm = tokenfiles.WaveletMatrix.build(ids, max(1, int(ids.max()).bit_length()))
        assert (wm.tokens() == ids).all()
        at = rng.integers(0, n, 200)
        assert (wm.access(at) == ids[at]).all()
        for symbol in {int(ids[0]), int(ids[-1]), int(ids.max())}:
            own = np.flatnonzero(ids == symbol)
            assert wm.occurrences(symbol).tolist() == own.tolist() and wm.count(symbol) == len(own)
            assert wm.select(symbol, len(own) // 2) == own[len(own) // 2]
            with pytest.raises(IndexError):
                wm.select(symbol, len(own))
            stop = int(rng.integers(0, n + 1))
            assert wm.rank(symbol, stop) == int((ids[:stop] == symbol).sum())


def check_packing(rows, docs, capacity):
    ids = {}
    for (d, t), own in zip(docs, whole("word_bpe_49k.json", [t or "" for _, t in docs], 1)):
        ids.setdefault(d, []).append(own)
    total, sequences = 0, {}
    seen = {}
    for r in rows:
        assert any(r.start == capacity * r.piece and r.length == len(own[r.start: r.start + capacity])
                   and r.ids_crc32 == zlib.crc32(own[r.start: r.start + capacity]) for own in ids[r.doc_id])
        seen[(r.doc_id, r.piece)] = seen.get((r.doc_id, r.piece), 0) + 1
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        total += r.length
    assert total == sum(len(own) for many in ids.values() for own in many)
    assert sum(seen.values()) == sum(-(-len(own) // capacity) for many in ids.values() for own in many)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), total / capacity


def test_packing_is_exact_and_tight(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    n, least = check_packing(queries.op10_packing(spark, sf).collect(), docs, 4096)
    assert n <= 1.03 * least
    docs = [(r[0], r[1]) for r in edge_rows()]
    check_packing(packing.pack_documents(edge_docs(spark, clash=True), capacity=64).collect(), docs, 64)
    assert packing.pack_documents(no_docs(spark)).count() == 0


def test_dissolved_sequences_are_packed_again(spark):
    from ledgerline.llm.common import Scratch

    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 101, 3000).tolist()
    df = spark.createDataFrame([(i, 0, 0, int(n), 0) for i, n in enumerate(lengths)],
                               "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
    rows = packing.pack(df, Scratch(spark, "test"), capacity=100, group_pieces=200).collect()
    assert sorted(r.doc_id for r in rows) == list(range(3000))
    fill = {}
    for r in rows:
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 100
    assert len(fill) <= 1.05 * sum(lengths) / 100


def test_sum_of_squares_choices():
    """Each choice against a plain evaluation of the sum over all gaps."""
    rng = np.random.default_rng(5)
    capacity = 12
    lengths = rng.integers(1, 13, 200)
    bins = packing.sum_of_squares(lengths, capacity)
    level = {}

    def cost(levels):
        gaps = [capacity - v for v in levels.values() if v < capacity]
        return sum(gaps.count(g) ** 2 for g in set(gaps))

    for s, b in zip(lengths.tolist(), bins.tolist()):
        options = [cost({**level, o: v + s}) for o, v in level.items() if v < capacity and v + s <= capacity]
        options.append(cost({**level, -1: s}))
        level[b] = level.get(b, 0) + s
        assert level[b] <= capacity and cost(level) == min(options)


def test_any_long_is_an_id_and_special_strings_are_tokens(spark):
    rows = [(None, "none"), (-2**63, "least"), (2**63 - 1, "most <|endoftext|> x"), (0, "<|endoftext|>")]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    queries.importable(spark)
    assert places(tokenfiles.wavelet_documents(df)) == expected_places(rows, 2)
    check_packing(packing.pack_documents(df, capacity=8).collect(), rows, 8)


def test_shard_files_answer_queries(spark):
    """Access, rank and select from a file as it was written."""
    df = spark.createDataFrame([(1, "one two one two one", None, None, None)], DOCS)
    queries.importable(spark)
    path = Scratch(spark, "test").path("shards")
    tokenfiles.write_wavelet(df, path, tokenizer=tokenizer_path("byte_bpe_50k.json"), end_id=2)
    row = spark.read.parquet(path).collect()[0].asDict()
    wm = tokenfiles.open_shard(row)
    ids = whole("byte_bpe_50k.json", ["one two one two one"], 2)[0]
    assert wm.access(np.arange(wm.n)).tolist() == ids.tolist() and wm.tokens().tolist() == ids.tolist()
    two = int(ids[1])
    assert wm.count(two) == 2 and wm.select(two, [0, 1]).tolist() == [1, 3] and wm.rank(two, 2) == 1
    assert wm.count(7) == 0 and wm.occurrences(7).tolist() == []


def test_documents_longer_than_a_shard(spark):
    long = " ".join(f"word{i}" for i in range(5000))
    df = spark.createDataFrame([(2, long, None, None, None), (1, "short", None, None, None)], DOCS)
    assert places(tokenfiles.wavelet_documents(df, shard_tokens=100)) == expected_places([(1, "short"), (2, long)], 2)
