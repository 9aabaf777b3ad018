"""Importance resampling against plain counting, hashing and sorting."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from ledgerline.llm import queries, resample
from ledgerline.llm.common import Scratch, importable
from llm.helpers import DOCS, SF, edge_docs, edge_rows, no_docs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def features(text):
    w = words(text)
    return [zlib.crc32(" ".join(w[i: i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def plain(rows, target, percent=5, least=20, seed=42):
    corpus, wanted = [0] * 10000, [0] * 10000
    for _, text in rows:
        for b in features(text):
            corpus[b] += 1
    for text in target:
        for b in features(text):
            wanted[b] += 1
    s, t = sum(corpus), sum(wanted)
    gain = [math.floor(1000 * math.log((b + 1) * (s + 10000) / ((a + 1) * (t + 10000)))) for a, b in zip(corpus, wanted)]
    out = []
    for doc, text in rows:
        own = features(text)
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in own)
        out.append([doc, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = [r for r, (_, text) in zip(out, rows) if len(words(text)) >= least]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = i
    return sorted(map(tuple, out), key=repr)


def collected(df):
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted(map(tuple, df.collect()), key=repr)


def table(spark, name, *columns):
    return [tuple(r[c] for c in columns) for r in spark.read.parquet(f"{SF}/{name}.parquet").collect()]


def test_query_against_plain_version(spark):
    target = [t for t, in table(spark, "benchmark", "text")]
    assert collected(queries.op13_resample(spark, SF)) == plain(table(spark, "documents", "doc_id", "text"), target)


@pytest.mark.parametrize("percent,run_rows,slice_bytes", [(50, 3, 64), (100, 2, 1 << 20), (0, 100, 7)])
def test_edges_of_the_table(spark, monkeypatch, percent, run_rows, slice_bytes):
    importable(spark)
    target = spark.createDataFrame([(1, "one two three four"), (2, None), (3, "É É é 日本語")], "item_id int, text string")
    rows = [(r[0], r[1]) for r in edge_rows()] + [(20 + i, r[1]) for i, r in enumerate(edge_rows()) if r[1]]
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS)
    got = resample.resample(docs, target, percent=percent, least_words=2, run_rows=run_rows)
    assert collected(got) == plain(rows, [r.text for r in target.collect()], percent, 2)


def test_clashing_columns_empty_tables(spark):
    importable(spark)
    target = spark.createDataFrame([("x",)], "text string")
    rows = [(r[0], r[1]) for r in edge_rows()]
    assert collected(resample.resample(edge_docs(spark, clash=True), target, percent=60)) == plain(rows, ["x"], 60)
    assert resample.resample(no_docs(spark), target).count() == 0
    assert collected(resample.resample(edge_docs(spark), target.limit(0), percent=60)) == plain(rows, [], 60)


def test_runs_of_slices_and_long_words(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(resample, "SLICE_BYTES", 16)
    texts = ["", "one", "a b c d e f g h i j k l m n o p", "x" * 100 + " y " + "z" * 33 + " w", "日本語 " * 9, "...", "ab-cd_ef",
             "w" * 32 + " " + "v" * 31, " ".join(f"Word{i}é" for i in range(60))]
    found = [[] for _ in texts]
    counted = [0] * len(texts)
    for start, number, bucket, counts in resample.batch_runs(pa.array(texts)):
        for i, b in zip(number.tolist(), bucket.tolist()):
            found[start + i].append(b)
        for i, n in enumerate(counts.tolist()):
            counted[start + i] += n
    assert [sorted(x) for x in found] == [sorted(features(t)) for t in texts]
    assert counted == [len(words(t)) for t in texts]


def test_ranks_by_regular_sampling(spark):
    importable(spark)
    rng = np.random.default_rng(8)
    n = 5000
    score = rng.integers(-50, 50, n) * rng.choice([1, 10**15], n)
    ids = [None if i % 97 == 0 else int(x) for i, x in enumerate(rng.integers(-300, 300, n))]
    rows = [(int(i), ids[i], int(score[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "row long, doc_id long, score long").repartition(5)
    want = {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (-r[2], r[1] is None, r[1] or 0, r[0])), 1)}
    for run_rows in (10_000, 700, 301):
        got = resample.ranked(df, Scratch(spark, "test"), run_rows=run_rows).collect()
        assert {r.row: r.rank for r in got} == want and len(got) == n


def test_merged_pieces():
    rng = np.random.default_rng(1)
    for pieces in (1, 2, 3, 7):
        parts = [np.sort(rng.integers(0, 20, rng.integers(0, 30))) for _ in range(pieces)]
        assert resample.merged(parts).tolist() == sorted(np.concatenate(parts).tolist())
