"""Sharding, mixing, vectors, scoring and the pipeline against brute force."""

import math
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from llm.helpers import DOCS, SF, edge_docs, edge_rows, groups, no_docs, words
from ledgerline.llm import attention, embeddings, lm, mixing, queries, sharding
from pyspark.sql import functions as F


def check_shards(rows, docs, n_shards):
    assert len(rows) == len(docs)
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < n_shards
    counts = [len(slots.get(s, [])) for s in range(n_shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    per_source = Counter((r.source, r.shard) for r in rows)
    for source, n in Counter(r.source for r in rows).items():
        assert all(abs(per_source[(source, s)] - n / n_shards) < 2 for s in range(n_shards))


def test_shards_follow_the_mixture(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    first = queries.op8_sharding(spark, sf).collect()
    check_shards(first, docs, 24)
    assert sorted(first) == sorted(queries.op8_sharding(spark, sf).collect())
    check_shards(sharding.interleave(edge_docs(spark, clash=True), n_shards=3).collect(),
                 [(r[0], r[1]) for r in edge_rows()], 3)
    assert sharding.interleave(no_docs(spark)).count() == 0


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """Shares by weight; what a full source can not give is shared again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, rest, left = {}, set(names), float(sum(sizes.values()))
    while True:
        level = left / sum(weight[s] for s in rest) if rest else 0
        full = [s for s in rest if weight[s] * level > most * sizes[s]]
        if not full:
            return {**target, **{s: weight[s] * level for s in rest}}
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
            rest.discard(s)


def check_mix(rows, block):
    sizes = Counter()
    for r in rows:
        sizes[r.source] += r.size
    target = brute_targets(sizes)
    taken = Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source], rel=1e-9, abs=1e-9)
        assert 0 <= r.taken <= 3 * r.size and 0 <= r.copies <= 3
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 3 * block
    return target


def seats_one_by_one(target, sizes, seats, block, most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    won = dict.fromkeys(names, 0)
    for _ in range(seats):
        open_ = [s for s in names if won[s] < most * sizes[s] // block]
        if not open_:
            break
        best = max(open_, key=lambda s: (target[s] / (2 * won[s] + 1), -names.index(s)))
        won[best] += 1
    return won


def test_mix_meets_targets(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op9_mixing(spark, sf).collect()
    check_mix(rows, 16)
    assert sorted(rows) == sorted(queries.op9_mixing(spark, sf).collect())
    check_mix(mixing.mix(edge_docs(spark, clash=True), block_words=2).collect(), 2)
    assert mixing.mix(no_docs(spark)).count() == 0
    empty = mixing.mix(edge_docs(spark).filter("doc_id IN (4, 5, 6)")).collect()
    assert [(r.size, r.target, r.taken) for r in empty] == [(0, 0.0, 0)] * 3


def test_sources_below_a_block_are_taken(spark):
    five, many = "a b c d e", " ".join(f"w{i}" for i in range(700))
    alone = mixing.mix(spark.createDataFrame([(1, five, None, "s", None)], DOCS)).collect()
    assert [(r.target, r.taken, r.copies, r.shards) for r in alone] == [(5.0, 5, 1, [7])]
    rows = [(1, five, None, "a", None), (2, "one", None, "b", None), *[(i, many, None, "c", None) for i in range(3, 9)]]
    got = mixing.mix(spark.createDataFrame(rows, DOCS)).collect()
    for source, size in (("a", 5), ("b", 1)):  # weights 5 and 2 ask for far more than three times these
        own, = [r for r in got if r.source == source]
        assert (own.target, own.taken, own.copies, len(own.shards)) == (3.0 * size, 3 * size, 3, 3)
    kept = mixing.repeat_documents(spark.createDataFrame(rows, DOCS)).collect()
    assert Counter(r.doc_id for r in kept)[1] == 3


def test_shards_follow_their_quotas(spark):
    """Words of the copies that begin in a shard, against the shard's quota of blocks: at most a document off at each end."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = mixing.mix(docs, n_shards=4).collect()
    sizes = {r.source: r.source_size for r in rows}
    df = spark.createDataFrame([(f"s{s}" if s is not None else "n", s, n) for s, n in sizes.items()],
                               "stratum string, source string, source_size bigint")
    quota = {(r.stratum, r.shard): 16 * r.blocks for r in
             mixing.quotas(mixing.targets(df), block_words=16, n_shards=4).collect()}
    for source in sizes:
        own = [r for r in rows if r.source == source]
        longest = max(r.size for r in own)
        name = f"s{source}" if source is not None else "n"
        for shard in range(4):
            got = sum(r.size for r in own for s in r.shards if s == shard)
            assert abs(got - quota[name, shard]) <= 2 * longest + 16
        assert all(len(r.shards) == r.copies for r in own)


def test_quotas_are_sainte_lague_seats(spark):
    rng = np.random.default_rng(6)
    sizes = {f"s{i:02d}": int(n) for i, n in enumerate(rng.integers(1, 4000, 17))} | {"s17": 3, "s18": 0, None: 700}
    df = spark.createDataFrame([(f"s{s}" if s is not None else "n", s, n) for s, n in sizes.items()],
                               "stratum string, source string, source_size bigint")
    sized = mixing.targets(df)
    target = brute_targets(sizes)
    assert {r.source: r.target for r in sized.collect()} == pytest.approx(target)
    block, shards = 8, 5
    rows = mixing.quotas(sized, block_words=block, n_shards=shards).collect()
    seats = sum(sizes.values()) // block
    before = dict.fromkeys(sizes, 0)
    for shard in range(shards):
        won = seats_one_by_one(target, sizes, seats * (shard + 1) // shards, block)
        got = {(None if r.stratum == "n" else r.stratum[1:]): (r.blocks, r.blocks_before)
               for r in rows if r.shard == shard}
        assert got == {s: (won[s] - before[s], before[s]) for s in sizes}
        before = won


def test_repeated_documents_keep_their_columns(spark):
    docs = edge_docs(spark, clash=True)
    mixed = mixing.repeat_documents(docs, block_words=2)
    assert mixed.columns == docs.columns and mixed.schema == docs.schema
    want = Counter()
    for r in mixing.mix(docs, block_words=2).collect():
        want[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in mixed.collect()) == +want


def brute_vectors(rows, threshold):
    ok = [r[1] is not None and r[2] is not None and len(r[1]) > 0 and all(x is not None and math.isfinite(x)
          for x in r[1]) and any(r[1]) for r in rows]
    links = [0] * len(rows)
    pairs = []
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    pairs.append((i, j))
    return links, groups(len(rows), pairs)


def test_vectors_of_very_large_and_small_size_link(spark):
    way = np.random.default_rng(8).normal(size=12)
    near, far = way + 0.01, way[::-1].copy()
    rows = [(i, 1, [float(c) for c in v * size]) for i, (v, size) in enumerate(
        [(way, 1e300), (near, 1e-300), (way, 1.0), (far, 1e300), (near, 1e200)])]
    rows.append((9, 1, [5e-324] + [0.0] * 11))
    df = spark.createDataFrame(rows, "vec_id long, label long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(df).collect()}
    assert got == {0: (3, 0), 1: (3, 0), 2: (3, 0), 3: (0, 3), 4: (3, 0), 9: (0, 9)}


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(7)
    rows = []
    for label in (0, 1, None):
        centre = rng.normal(size=(6, 8))
        for i in range(60):
            v = centre[i % 6] + rng.normal(scale=0.12, size=8)
            rows.append([len(rows), v.astype(np.float32).tolist(), label])
    rows += [[len(rows) + i, rows[3][1], 0] for i in range(40)]
    rows += [[500, None, 0], [501, [0.0] * 8, 0], [502, [float("nan")] * 8, 0], [503, [float("inf")] + [0.0] * 7, 0],
             [504, [None] + [1.0] * 7, 0], [505, [], 0], [506, [1.0, 2.0], 0], [507, [2.0, 4.0], 0], [507, [2.0, 4.0], 0]]
    df = spark.createDataFrame([tuple(r) for r in rows], "vec_id bigint, embedding array<float>, label int")
    links, component = brute_vectors(rows, 0.98)
    got = sorted(embeddings.near_duplicates(df.withColumn("links", F.lit(1)), tile=16).collect())
    assert [(r.vec_id, r.n_links, r.component_id) for r in got] == \
        sorted((r[0], n, rows[c][0]) for r, n, c in zip(rows, links, component))
    assert max(links) > 40
    assert embeddings.near_duplicates(df.limit(0)).count() == 0
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    links, component = brute_vectors(table[:150], 0.98)
    got = sorted(embeddings.near_duplicates(spark.createDataFrame(table[:150], df.schema)).collect())
    assert [r.n_links for r in got] == links


def test_error_bound_holds():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(200, 64))
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    q, scale, error, size = embeddings.quantise(unit)
    product = (q @ q.T) * scale[:, None] * scale[None, :]
    assert (np.abs(unit @ unit.T - product) <= error[None, :] + error[:, None] * size[None, :] + 1e-12).all()


def brute_base(docs):
    tokens = [words(t) + [None] for _, t in docs]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1 for d, _ in docs]
    count = Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    n, v = sum(count.values()), len(count)
    return [(d, h, len(ws), sum(count[w] > 0 for w in ws), n,
             sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
            for (d, _), ws, h in zip(docs, tokens, held)]


def check_scores(rows, docs):
    def key(r):
        return (r[0] is not None, r[0] or 0, r[2])

    for r, want in zip(sorted(rows, key=key), sorted(brute_base(docs), key=key), strict=True):
        assert tuple(r)[:5] == want[:5]
        assert r.base_score == pytest.approx(want[5], rel=1e-9) and r.score < 0


def test_scores_against_brute_force_counts(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = queries.op3_lm_scoring(spark, SF).collect()
    check_scores(rows, docs)
    train = [r for r in rows if not r.held_out]
    assert sum(r.score for r in train) > sum(r.base_score for r in train)
    check_scores(lm.score_documents(edge_docs(spark, clash=True)).collect(), [(r[0], r[1]) for r in edge_rows()])
    assert lm.score_documents(no_docs(spark)).count() == 0


def test_scores_of_a_word_of_many_ids(spark):
    tokenizers = pytest.importorskip("tokenizers")
    unbroken = "".join(chr(c) for c in np.random.default_rng(12).integers(0x4E00, 0x9FA5, 30_000))
    encoder = tokenizers.Tokenizer.from_file(lm.tokenizer_path(lm.VOCABULARY))
    assert len(encoder.encode(unbroken, add_special_tokens=False).ids) > 65_535
    rows = [*edge_rows(), (14, unbroken, "zh", "a", 30_000), (15, unbroken + "x", "zh", "a", 30_001)]
    check_scores(lm.score_documents(spark.createDataFrame(rows, DOCS)).collect(), [(r[0], r[1]) for r in rows])


def test_a_word_is_encoded_once_whatever_closes_it():
    from llm.test_token_operators import watched, whole

    texts = ["Alpha beta. gamma, alpha! alpha; BETA, 12. 12 é. x's ... !", "alpha. gamma 日本語。 日本語", "", "beta?"]
    enc, seen = watched(lm.VOCABULARY, "byte", ordinary=True)
    part = pa.RecordBatch.from_pydict({"doc_id": list(range(4)), "text": texts, "trained": [True, False, True, True]})
    row = lm._block(part, enc)
    asked = " ".join(seen).split()
    assert all(asked.count(w) == 1 for w in ("alpha", "beta", "gamma", "12", "é")) and "alpha." not in asked
    tokens, lengths, counts, per_word = lm._texts(row)
    # Each word as it is after a space.
    want = [[int(i) for w in words(t) for i in whole(lm.VOCABULARY, [" " + w], 0, ordinary=True)[0][:-1]] for t in texts]
    assert tokens.tolist() == [i for ids in want for i in (lm.END, *ids, lm.END)]
    assert lengths.tolist() == [len(ids) + 2 for ids in want] and per_word.sum() == sum(map(len, want))
    assert counts.tolist() == [len(words(t)) for t in texts]


def test_training_windows_hold_all_training_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").withColumn(
        "trained", F.col("doc_id") % 5 != 1)
    edge = edge_docs(spark).select("doc_id", "text", F.lit(True).alias("trained"))
    saved = lm.blocks(docs.coalesce(1).union(edge.coalesce(1)), lm.tokenizer_path(lm.VOCABULARY)).persist()
    want = Counter()
    for row in saved.collect():
        tokens = lm._texts(row.asDict(), only_trained=True)[0].tolist()
        want.update(zip(tokens[:-1], tokens[1:]))
    for turns in (1, 2):
        got = Counter()
        for turn in range(turns):
            for r in lm.training_windows(saved, turn, turns).collect():
                w = np.frombuffer(r.value, "<u2").reshape(-1, attention.WIDTH + 1)
                use = w[:, 1:] != attention.MISSING
                got.update(zip(w[:, :-1][use].tolist(), w[:, 1:][use].tolist()))
        assert got == want
    saved.unpersist()
    for n in range(2, 70):  # tails
        w = lm.cut_windows(np.arange(n))
        assert w[:, 1:][w[:, 1:] != attention.MISSING].tolist() == list(range(1, n))
    assert len(lm.cut_windows(np.arange(1))) == len(lm.cut_windows(np.arange(0))) == 0


def test_a_pass_trains_on_every_window(monkeypatch):
    rng, vectors, classes_of, flat = _tiny()
    tokens = rng.integers(0, 50, (300, attention.WIDTH + 1)).astype(np.uint16)
    tokens[:, 5] = 7
    tokens[-1, 4:] = attention.MISSING
    seen = []
    gradient = attention.loss_and_gradient

    def watch(p, x, target, valid, classes):
        seen.extend(x[valid][:, 0].tolist())
        return gradient(p, x, target, valid, classes)

    monkeypatch.setattr(attention, "loss_and_gradient", watch)
    attention.train(flat, tokens, vectors, classes_of, 7, steps=-(-300 // attention.BATCH))
    inputs = np.concatenate([tokens[:-1, :-1].ravel(), tokens[-1, :3]])
    assert Counter(seen) == Counter(vectors[inputs][:, 0].tolist())


def _tiny(classes=7, seed=9):
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(50, 4)).astype(np.float32)
    classes_of = np.concatenate([np.arange(classes), rng.integers(0, classes, 50 - classes)])
    flat = attention.initial(4, np.ones(classes)) + rng.normal(scale=0.2, size=sum(
        int(np.prod(s)) for s in attention.shapes(4, classes).values())).astype(np.float32)
    return rng, vectors, classes_of, flat


def test_attention_gradient():
    rng, vectors, classes_of, flat = _tiny()
    tokens = rng.integers(0, 50, (3, attention.WIDTH + 1))
    x, y = vectors[tokens[:, :-1]].astype(np.float64), classes_of[tokens[:, 1:]]
    flat = flat.astype(np.float64)
    valid = np.ones(y.shape, bool)
    _, g = attention.loss_and_gradient(flat, x, y, valid, 7)
    for i in rng.integers(0, len(flat), 40):
        e = np.zeros_like(flat)
        e[i] = 1e-5
        up, down = (attention.loss_and_gradient(flat + s * e, x, y, valid, 7)[0] for s in (1, -1))
        assert g[i] == pytest.approx((up - down) / 2e-5, abs=2e-4)


def test_windows_score_each_token_once_and_see_only_the_past():
    rng, vectors, classes_of, flat = _tiny()
    lengths = np.array([1, 2, 17, 40, 100])
    tokens = rng.integers(0, 50, lengths.sum()).astype(np.uint16)
    got = attention.score(flat, tokens, lengths, vectors, classes_of, 7, step=3)
    at = 0
    for n in lengths:
        own = tokens[at: at + n]
        assert got[at] == 0
        for t in range(1, n):  # the window whose last STRIDE inputs hold t - 1
            start = (t - 1) // attention.STRIDE * attention.STRIDE - (attention.WIDTH - attention.STRIDE)
            seen = own[max(0, start): t]
            x = np.zeros((1, attention.WIDTH, 4), np.float32)
            x[0, : len(seen)] = vectors[seen]
            valid = np.zeros((1, attention.WIDTH), bool)
            valid[0, len(seen) - 1] = True
            target = np.zeros((1, attention.WIDTH), int)
            target[0, len(seen) - 1] = classes_of[own[t]]
            keys = np.zeros((1, attention.WIDTH), bool)
            keys[0, : len(seen)] = True
            p = attention.unpack(flat, 4, 7)
            h0 = x @ p["win"] + p["bin"]
            s = (h0 @ p["wq"])[0, len(seen) - 1] @ (h0 @ p["wk"])[0, : len(seen)].T / np.sqrt(attention.HEAD)
            s = s + p["bias"][np.arange(len(seen))[::-1]]
            a = np.exp(s - s.max())
            h = h0[0, len(seen) - 1] + (a / a.sum()) @ (h0 @ p["wv"])[0, : len(seen)] @ p["wo"]
            f = np.concatenate([h, np.maximum(h @ p["w1"] + p["b1"], 0)])
            logit = f @ p["wc"] + p["bc"]
            want = logit[classes_of[own[t]]] - np.log(np.exp(logit - logit.max()).sum()) - logit.max()
            assert got[at + t] == pytest.approx(want, abs=1e-3)
        at += n


def test_scores_with_entries_made_before(monkeypatch):
    rng, vectors, classes_of, flat = _tiny()
    lengths = np.array([1, 2, 40, 17, 100])
    tokens = rng.integers(0, 50, lengths.sum()).astype(np.uint16)
    want = attention.score(flat, tokens, lengths, vectors, classes_of, 7)
    table = attention.entries(flat, vectors, 7)
    monkeypatch.setattr(attention, "entries", None)  # a task makes them once for all its blocks
    got = attention.score(flat, tokens, lengths, vectors, classes_of, 7, step=4, table=table)
    assert got == pytest.approx(want, abs=1e-5) and (got != 0).sum() == lengths.sum() - len(lengths)


def test_large_scores_and_logits():
    rng, vectors, classes_of, flat = _tiny()
    tokens = rng.integers(0, 50, 40).astype(np.uint16)
    x, y = vectors[tokens[None, :32]], classes_of[tokens[None, 1:33]]
    valid = np.ones(y.shape, bool)
    for factor in (1, 100):
        large = flat.copy()
        attention.unpack(large, 4, 7)["wc"][:] *= factor
        likely = []
        for c in range(7):  # id c is of class c
            tokens[-1] = c
            likely.append(attention.score(large, tokens, np.array([40]), vectors, classes_of, 7)[-1])
        assert np.exp(np.array(likely, float)).sum() == pytest.approx(1, abs=1e-4)
        assert np.isfinite(attention.loss_and_gradient(large, x, y, valid, 7)[1]).all()
    for factor in (5, 20):  # attention scores
        large = flat * np.float32(factor)
        assert np.isfinite(attention.loss_and_gradient(large, x, y, valid, 7)[1]).all()
        assert (attention.score(large, tokens, np.array([40]), vectors, classes_of, 7) <= 0).all()


def test_training_lowers_the_loss():
    rng, vectors, classes_of, _ = _tiny()
    tokens = np.cumsum(np.ones((64, attention.WIDTH + 1), int), axis=1) + rng.integers(0, 50, (64, 1))
    tokens %= 50  # each token follows from the one before
    start = attention.initial(4, np.ones(7))
    x, y = vectors[tokens[:, :-1]], classes_of[tokens[:, 1:]]
    got = attention.train(start, tokens, vectors, classes_of, 7, steps=400)
    valid = np.ones(y.shape, bool)
    assert attention.loss_and_gradient(got, x, y, valid, 7)[0] < \
        0.7 * attention.loss_and_gradient(start, x, y, valid, 7)[0]


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    from llm import test_text_operators as text
    from llm import test_token_operators as tok

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "mixing", "packing"]
    outs = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        outs.append(docs.collect())
    every, good, unique, mixed, packed = outs
    assert {tuple(r) for r in good} <= {tuple(r) for r in every}
    gone = {r.doc_id for r in every} - {r.doc_id for r in good}
    assert sum(labels.get(d) == 1 for d in gone) <= 0.05 * sum(v == 1 for v in labels.values())
    assert sum(labels.get(r.doc_id) == 0 for r in good) <= 0.2 * sum(v == 0 for v in labels.values())
    rows = sorted((r.doc_id, r.text) for r in good)
    component, _ = text.brute_groups([t for _, t in rows], 80)
    assert sorted(r.doc_id for r in unique) == [d for i, (d, _) in enumerate(rows) if component[i] == i]
    target = brute_targets(Counter({s: sum(len(words(r.text)) for r in unique if r.source == s)
                                    for s in {r.source for r in unique}}))
    longest = {s: max(len(words(r.text)) for r in unique if r.source == s) for s in target}
    for s in target:
        assert abs(sum(len(words(r.text)) for r in mixed if r.source == s) - target[s]) <= longest[s] + 16
    assert max(Counter(r.doc_id for r in mixed).values()) <= 3
    n, least = tok.check_packing(packed, [(r.doc_id, r.text) for r in mixed], 4096)
    assert n <= least * 1.05 + 1
    again = corpus_pipeline.run(spark, sf).collect()
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in again) == \
        Counter((r.doc_id, r.piece, r.ids_crc32) for r in packed)


def test_two_texts_of_one_id_both_stay(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base, None, "a", None), (1, "another text of the same id " * 3, None, "a", None),
            (2, base + " end", None, "a", None), (2, base, None, "b", None), (3, "", None, "a", None),
            (3, "", None, "a", None), (1, base, None, "a", None), (None, base, None, "a", None)]
    df = spark.createDataFrame(rows, DOCS)
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, df, SF).collect())
    assert got == Counter([(1, base), (1, rows[1][1]), (3, ""), (None, base)])


def test_pipeline_on_edge_rows(spark):
    docs = edge_docs(spark, clash=True)
    for name, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), docs.schema)
        else:
            assert out.count() > 0
    filtered = corpus_pipeline.STAGES[0][1](spark, edge_docs(spark), SF)
    assert filtered.columns == [f.name for f in DOCS.fields] and filtered.count() <= len(edge_rows())
    empty = no_docs(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
