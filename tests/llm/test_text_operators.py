"""Fingerprints, near duplicates and quality scores against brute force, with edge tables."""

import hashlib
import zlib

import numpy as np
import pytest
import xxhash
from llm.helpers import BASE, DOCS, SF, edge_docs, edge_rows, groups, no_docs, shingles, words
from ledgerline.llm import fingerprints, graph, neardup, quality, queries
from ledgerline.llm.common import Scratch
from pyspark.sql import functions as F

M = 1 << 64


def _long(x):
    return x - M if x >= M >> 1 else x


def _hash_longs(values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest((v % M).to_bytes(8, "little"), seed=seed)
    return _long(seed)


def _rotated(x, by):
    by %= 64
    return (x << by | x >> 64 - by) % M


def _rolled(h, k):
    """Cyclic polynomial: each word leaves and enters the running hash."""
    now = 0
    for x in h[:k]:
        now = _rotated(now, 1) ^ x
    out = [now]
    for gone, new in zip(h, h[k:]):
        now = _rotated(now, 1) ^ _rotated(gone, k) ^ new
        out.append(now)
    return out


def winnow(text, k=5, window=8):
    """Brute force: (hash, position) of every window's rightmost minimum; hashes rolled on one word at a time."""
    import re

    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text.lower()) if x]
    h = [_long(xxhash.xxh64_intdigest(x.encode(), seed=42)) for x in w]
    if not h:
        return []
    g = [_long(x) for x in _rolled([x % M for x in h], k)] if len(h) >= k else [_hash_longs(h)]
    kept = []
    for i in range(max(1, len(g) - window + 1)):
        span = range(i, min(i + window, len(g)))
        at = min(span, key=lambda j: (g[j], -j))
        if (g[at], at) not in kept[-1:]:
            kept.append((g[at], at))
    return kept


def _likeness(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def _as_text(kept):
    return " ".join(f"{h % M:x}@{p}" for h, p in kept)


def check_edited(rows, docs):
    docs = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0)))
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert len(rows) == len(docs)
    for i, (key, text) in enumerate(docs):
        if sum(d[0] == key for d in docs) > 1 or sum(d[0] == docs[(i + 1) % len(docs)][0] for d in docs) > 1:
            continue
        (r,) = by_id[key]
        after = docs[(i + 1) % len(docs)][1]
        cut = len(text) // 2
        edited = text[: len(text) - cut] + after[:cut]
        own, changed = winnow(text), winnow(edited)
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == _as_text(own) and r.edited_fingerprint == _as_text(changed)
        assert r.near_edited == pytest.approx(_likeness(own, changed), abs=1e-12)
        assert r.near_next == pytest.approx(_likeness(own, winnow(after)), abs=1e-12)


def test_fingerprints_match_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check_edited(queries.op1_fingerprints(spark, SF).collect(), docs)


def test_fingerprints_of_edge_rows(spark):
    rows = fingerprints.compare_edited(edge_docs(spark, clash=True)).collect()
    check_edited(rows, [(r[0], r[1] or "") for r in edge_rows()])
    one = [r.fingerprint for r in rows if r.doc_id == 7]
    assert len(one) == 2 and one[0] == one[1]
    assert fingerprints.compare_edited(no_docs(spark)).count() == 0
    single = spark.createDataFrame([(1, "a b c d e f", None, None, None)], DOCS)
    assert fingerprints.compare_edited(single).collect()[0].near_next == 1.0


@pytest.mark.parametrize("k, window", [(1, 1), (2, 3), (3, 6), (7, 12), (8, 8), (66, 5)])
def test_runs_and_windows_of_other_lengths(spark, k, window):
    texts = [" ".join(f"w{i * i % m}" for i in range(n)) for n, m in ((k, 7), (k + window, 5), (300, 11), (300, 97))]
    texts += ["same " * 90, "one", "", " ".join(["tie", "tie", "break"] * 60)]
    docs = spark.createDataFrame([(i, x, None, None, None) for i, x in enumerate(texts)], DOCS)
    rows = fingerprints.fingerprint_documents(docs, k=k, window=window).collect()
    assert {r.doc_id: list(zip(r.fingerprint.hashes, r.fingerprint.positions)) for r in rows} == {
        i: winnow(x, k, window) for i, x in enumerate(texts)}


def test_shared_passage_leaves_a_shared_hash(spark):
    passage = " ".join(BASE[:12])  # k + window - 1 words
    rows = [(i, f"{'p%d ' % i * i}{passage} {'q%d ' % i * (9 - i)}", None, None, None) for i in range(8)]
    fp = fingerprints.fingerprint_documents(spark.createDataFrame(rows, DOCS))
    kept = [set(r.h) for r in fp.select(F.expr(fingerprints.hashes("fingerprint")).alias("h")).collect()]
    assert set.intersection(*kept)


def brute_groups(texts, percent):
    sets = [shingles(t) for t in texts]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    return groups(len(sets), pairs), [len(s) for s in sets]


def test_near_duplicates_match_brute_force(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    component, sizes = brute_groups([t for _, t in docs], 85)
    rows = sorted(queries.op6_minhash(spark, SF).collect())
    assert [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows] == [
        (d, n, docs[c][0], docs[c][0] == d) for (d, _), n, c in zip(docs, sizes, component)]


def test_near_duplicate_chains_and_hot_groups(spark):
    """Chains of near copies whose ends do not link, copies by the hundred, and unlike texts of one bucket."""
    base = [f"t{i}" for i in range(120)]
    texts = []
    for step in range(30):  # each step changes two words: neighbours link, far ones do not
        own = list(base)
        own[: 2 * step] = [f"c{j}" for j in range(2 * step)]
        texts.append(" ".join(own))
    texts += [" ".join(base[:60])] * 200
    texts += [" ".join(base[:60] + [f"tail{i}"]) for i in range(100)]
    texts += ["", " ", "one two", "ONE two", "one  two\n"]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    component, sizes = brute_groups(texts, 80)
    got = sorted(neardup.group_documents(spark.createDataFrame(rows, DOCS), percent=80, bands=24, band_rows=5,
                                         block=32).collect())
    assert [r.component_id for r in got] == component and [r.n_shingles for r in got] == sizes


def test_near_duplicates_of_edge_rows(spark):
    rows = neardup.group_documents(edge_docs(spark, clash=True), percent=80).collect()
    assert len(rows) == len(edge_rows())
    by = {r.doc_id: r for r in rows}
    assert by[1].component_id == by[2].component_id == by[3].component_id == -5 and by[8].component_id == 7
    assert by[4].n_shingles == by[5].n_shingles == by[6].n_shingles == 0 and by[4].kept and by[6].kept
    assert by[None].component_id is None and by[None].kept
    assert neardup.group_documents(no_docs(spark)).count() == 0


def test_super_minhash_estimates_similarity():
    rng = np.random.default_rng(0)
    shared = rng.integers(0, 2**63, 300, dtype=np.uint64)
    a = np.concatenate([shared, rng.integers(0, 2**63, 50, dtype=np.uint64)])
    b = np.concatenate([shared, rng.integers(0, 2**63, 50, dtype=np.uint64)])
    h = neardup.super_minhash(np.concatenate([a, b, a[:1]]), np.array([350, 350, 1, 0]), 256)
    assert abs((h[0] == h[1]).mean() - 300 / 400) < 0.1
    # One element visits every slot once, with its rounds as a permutation; an empty set holds the largest number.
    assert sorted((h[2] >> np.uint64(32)).tolist()) == list(range(256))
    assert (h[3] == np.iinfo(np.uint64).max).all()


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(i, i + 1) for i in range(500, 600)]
    expected = {i: c for i, c in enumerate(groups(601, pairs)) if any(i in p and p[0] != p[1] for p in pairs)}
    df = spark.createDataFrame(pairs, "u bigint, v bigint")
    got = {r.node: r.component for r in graph.components(df, Scratch(spark, "test")).collect()}
    assert {i: got.get(i, i) for i in expected} == expected
    assert graph.components(df.limit(0), Scratch(spark, "test")).count() == 0


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries.op4_quality(spark, sf).collect()}
    assert len(rows) == 1000
    right = total = 0
    for r in spark.read.parquet(f"{sf}/labels.parquet").collect():
        assert rows[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        if rows[r.doc_id].held_out:
            total += 1
            right += rows[r.doc_id].predicted == r.quality
    assert right / total > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows.values())


def test_quality_of_edge_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (9, 0, 0), (None, 1, 0), (3, None, 0), (3, 1, 1), (3, 0, 1), (12, 0, 0)],
                                   "doc_id bigint, quality int, toxic int")
    rows = quality.score_documents(edge_docs(spark, clash=True), labels).collect()
    assert len(rows) == len(edge_rows()) and all(0 <= r.score <= 1 for r in rows)
    one = [r.score for r in rows if r.doc_id == 7]
    assert one[0] == one[1]
    assert quality.score_documents(no_docs(spark), labels).count() == 0
    assert {r.score for r in quality.score_documents(edge_docs(spark), labels.limit(0)).collect()} == {0.5}


def test_discriminant_is_the_gaussian_log_density():
    rng = np.random.default_rng(2)
    x = [rng.normal(0, 1, (400, 3)), rng.normal(1, 2, (600, 3))]
    model = quality.Discriminant.fit(np.array([400.0, 600.0]), np.array([a.sum(0) for a in x]),
                                     np.array([a.T @ a for a in x]))
    cov = [np.cov(a.T, bias=True) for a in x]
    pooled = (400 * cov[0] + 600 * cov[1]) / 1000
    point = np.array([0.3, -0.2, 1.0])
    density = []
    for c, n in ((0, 400), (1, 600)):
        s = (1 - quality.POOLED) * cov[c] + quality.POOLED * pooled
        s = (1 - quality.DIAGONAL) * s + quality.DIAGONAL * np.diag(np.diag(s))
        d = point - x[c].mean(0)
        density.append(np.log((n + 1) / 1002) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * d @ np.linalg.solve(s, d))
    assert model.logit(point[None])[0] == pytest.approx(density[1] - density[0], rel=1e-4)


def test_words_of_texts_never_cross():
    assert words("A b\tC") == ["a", "b", "c"]
