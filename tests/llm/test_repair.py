"""Conversation repair against a plain search over edits."""

import hashlib
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest
from ledgerline.llm import queries, repair
from ledgerline.llm.common import importable
from llm.helpers import SF

ROWS = "conv_id long, turn long, role string, text string"
GOOD = re.compile(r"(s?(ua)+)?")


def spoil(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        m = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if m == 0:
            continue
        text = "" if m == 1 else re.sub("[.!?]", "", text) if m == 2 else text
        role = "user" if m == 4 else role
        out += [(conv, turn, role, text)] * (2 if m == 3 else 1)
    return out


def plain(convs, rows):
    """One row per conversation, by a recursive search that compares (cost, audit)."""
    result = []
    for conv in convs:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, faults, kinds = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, []
        for _, _, role, text in own:
            core = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = ("blank" if not core else "duplicate" if (role, text) in seen else
                     "truncated" if core[-1] not in ".!?" else None)
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            kinds.append(fault)
        turns = {r[1] for r in own if r[1] is not None}
        initials = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))

        # A state is what the kept initials end with; every legal string has one of these.
        def moves(state, initial):
            return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))

        @lru_cache(None)
        def best(i, state, inserted):
            options = [(0, "")] if i == len(own) and state in ("", "a") else []
            if inserted < 3:
                for initial in "ua":
                    to = moves(state, initial)
                    if to:
                        c, a = best(i, to, inserted + 1)
                        options.append((c + 2, "I" + a))
            if i < len(own):
                c, a = best(i + 1, state, 0)
                options.append((c + 3, "D" + a))
                if kinds[i] not in ("blank", "duplicate"):
                    more = kinds[i] == "truncated"
                    for cost, letter, initial in ((0, "K", initials[i]), (2, "R", "u"), (2, "R", "a")):
                        to = moves(state, initial) if initial else None
                        if to:
                            c, a = best(i + 1, to, 0)
                            options.append((c + cost + more, letter + a))
            return min(options) if options else (10**9, "")

        for i in range(len(own), -1, -1):  # from the end, so that no call goes deep
            for state in ("", "s", "u", "a"):
                best(i, state, 0)
        cost, audit = best(0, "", 0)
        lines, state, i = [], "", 0
        for letter in audit:
            if letter in "IR":
                state = next(moves(state, x) for x in "ua" if moves(state, x))
                role = {"u": "user", "a": "assistant"}[state]
                lines.append(f"{role}:{own[i][3] if letter == 'R' else ''}")
            elif letter == "K":
                state = initials[i]
                lines.append(f"{own[i][2]}:{own[i][3]}")
            i += letter != "I"
        assert GOOD.fullmatch("".join(x[0] for x in lines))
        result.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *faults.values(), illegal, cost,
                       audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(result, key=repr)


def collected(df):
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                          "repaired_sha256"]
    return sorted(map(tuple, df.collect()), key=repr)


def test_query_against_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert collected(queries.op12_repair(spark, SF)) == plain({r[0] for r in rows}, spoil(rows))


def random_rows(rng, n_convs, longest):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "User"]
    texts = ["Yes.", "No!", "cut", "Who?", "", " \n", None, "a\x0b", "é?", "。", "x. \t", "Yes.", "long " * 30 + "."]
    rows = []
    for c in range(n_convs):
        for t in range(int(rng.integers(0, longest))):
            turn = None if rng.random() < 0.05 else int(t + (rng.random() < 0.2) * rng.integers(0, 4))
            role = roles[t % 2] if rng.random() < 0.6 else roles[rng.integers(len(roles))]
            text = f"unlike {c} {t}." if rng.random() < 0.6 else texts[rng.integers(len(texts))]
            rows.append((None if c == 3 else c, turn, role, text))
    return rows + rows[::17]


@pytest.mark.parametrize("chunk", [2, 7, 4096])
def test_random_conversations(spark, monkeypatch, chunk):
    """Also cut into very short chunks, and across partitions."""
    importable(spark)
    monkeypatch.setattr(repair, "CHUNK_ROWS", chunk)
    rng = np.random.default_rng(chunk)
    rows = random_rows(rng, 40, 40) + [(900, i, "user" if i % 2 else "assistant", f"t{i}.") for i in range(300)]
    assert collected(repair.audit(repair.damaged(spark.createDataFrame(rows, ROWS)))) == \
        plain({r[0] for r in rows}, spoil(rows))


def test_chunks_are_cut_as_asked(monkeypatch):
    monkeypatch.setattr(repair, "CHUNK_ROWS", 3)
    rows = [(1, i, "user", f"t{i}.", 2, 1, False, False, False) for i in range(4)] + [(2, 0, "user", "x", 0, 1, False, True, False)]
    found = [(c, bytes(k.symbols), no, whole) for c, k, no, whole in repair._chunks(0, rows)]
    assert found == [(1, b"\4\1\4", 0, False), (1, b"\1\4\1", 1, False), (1, b"\4\1", 2, False), (2, b"", 0, False)]


def test_edges(spark):
    importable(spark)
    nothing = spark.createDataFrame([], ROWS)
    assert repair.audit(repair.damaged(nothing)).count() == 0
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(dropped, 0, "user", "Hi.")], ROWS)
    assert collected(repair.audit(repair.damaged(df))) == [
        (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    rows = [(5, 2**62, "user", "a."), (5, -2**62, "assistant", "b."), (6, None, None, None), (6, None, None, None),
            (None, None, "user", "x" * 3_000_000), (None, None, "assistant", "fine.")]
    clash = spark.createDataFrame(rows, ROWS)
    for name in ("copies", "kind", "digest", "part", "no", "symbols", "c", "audit", "cost"):
        clash = clash.selectExpr("*", f"'clash' AS {name}")
    assert collected(repair.audit(repair.damaged(clash))) == plain({5, 6, None}, spoil(rows))


def test_repaired_rows(spark, monkeypatch):
    importable(spark)
    monkeypatch.setattr(repair, "CHUNK_ROWS", 5)
    rows = random_rows(np.random.default_rng(2), 20, 30)
    df = repair.damaged(spark.createDataFrame(rows, ROWS))
    hashes = {r.conv_id: r.repaired_sha256 for r in repair.audit(df).collect()}
    lines = {}
    for r in sorted(repair.repaired(df).collect(), key=lambda r: (r.part, r.no, r.place)):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv, want in hashes.items():
        assert hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == want


def test_block_tables():
    """Blocks against single symbols, for every vector."""
    t = repair.Tables()
    assert 1 < len(t.vectors) < 100
    rng = np.random.default_rng(0)
    for code in rng.integers(0, repair.SYMBOLS ** repair.BLOCK, 300).tolist():
        for i, v in enumerate(t.vectors):
            for d in range(repair.BLOCK):
                v = repair.before_symbol(v, code // repair.SYMBOLS ** d % repair.SYMBOLS)
            assert tuple(c + int(t.add[i, code]) for c in t.vectors[t.to[i, code]]) == v
