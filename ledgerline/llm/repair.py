"""Conversation repair: cheapest edits to a legal order of roles, by Four-Russians block tables.

A conversation is a string of symbols, one a row: what its role begins with,
whether it is cut off, or that it must go.  Walking from the end, a vector
holds the least cost from each of four states (nothing yet, system, user,
assistant).  Less its smallest entry it is one of a few vectors, so for every
block of ``BLOCK`` symbols and every such vector a table holds the vector
before the block and the cost that the block adds.

1. Rows are damaged and marked with Spark functions.  Equal rows are counted
   first, so that copies of one row never gather.
2. Rows are range-partitioned by conversation and turn, and sorted: a
   conversation may lie across any number of tasks.  A task cuts it into
   chunks.  One that begins and ends inside the task is finished there, block
   by block; every other chunk keeps its rows and what it makes of each
   possible vector (its blocks' entries, chained).
3. Chunks' entries, chained from the last to the first, give each chunk the
   vector on its right.  Chunks are then traced in order: a block is expanded
   backward from the vector on its right, and walked forward, taking the
   least letter among the cheapest edits.

A conversation's audit and hash are sequential by nature: its chunks stream
through one task, which holds one chunk and the audit.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Scratch, pick, shuffle_parts

BLOCK = 4
CHUNK_ROWS = 4096
CHUNK_BYTES = 1 << 20
SPACE = " \t\n\x0b\x0c\r"

# States: nothing yet, after system, after user, after assistant (the first and last may end a conversation).
NEXT = (2, 2, 3, 2)                                     # state after an inserted or re-roled row
KEPT = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})         # by role (system, user, assistant, other): state before -> after
NAMES = {2: "user", 3: "assistant"}
LEGAL = frozenset([(0, 1), (1, 2), (2, 1)])             # adjacent roles
# Symbols: 0 no row (fills up the first block), 1 must be deleted, 2 + 2 * role + cut off.
GONE, SYMBOLS = 1, 10
INSERT, REROLE, DELETE, CUT_OFF = 2, 2, 3, 1


def _with_inserts(v: list[int]) -> tuple[int, ...]:
    for _ in range(3):
        v = [min(c, INSERT + v[NEXT[q]]) for q, c in enumerate(v)]
    return tuple(v)


FINAL = _with_inserts([0, 99, 99, 0])


def before_symbol(v: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Least costs before a row, from those after it."""
    if symbol == 0:
        return v
    out = [DELETE + c for c in v]
    if symbol != GONE:
        role, more = divmod(symbol - 2, 2)
        for q in range(4):
            out[q] = min(out[q], REROLE + more * CUT_OFF + v[NEXT[q]])
            if q in KEPT[role]:
                out[q] = min(out[q], more * CUT_OFF + v[KEPT[role][q]])
    return _with_inserts(out)


class Tables:
    """Transitions of normalised cost vectors for every symbol and every block of ``BLOCK`` symbols."""

    def __init__(self):
        self.vectors: list[tuple[int, ...]] = []
        number: dict[tuple[int, ...], int] = {}

        def known(v):
            least = min(v)
            v = tuple(c - least for c in v)
            if v not in number:
                number[v] = len(self.vectors)
                self.vectors.append(v)
            return number[v], least

        self.final, base = known(FINAL)
        assert base == 0
        to: list[list[int]] = []
        add: list[list[int]] = []
        while len(to) < len(self.vectors):  # the list grows until no symbol makes a new vector
            found = [known(before_symbol(self.vectors[len(to)], s)) for s in range(SYMBOLS)]
            to.append([i for i, _ in found])
            add.append([c for _, c in found])
        self.one = to
        one_to, one_add = np.array(to), np.array(add)
        codes = np.arange(SYMBOLS ** BLOCK)
        self.to = np.empty((len(to), len(codes)), np.int16)
        self.add = np.empty((len(to), len(codes)), np.int16)
        for i in range(len(to)):
            at, cost = np.full(len(codes), i), np.zeros(len(codes), np.int64)
            for digit in range(BLOCK):  # the last symbol is the lowest digit
                symbol = codes // SYMBOLS ** digit % SYMBOLS
                cost += one_add[at, symbol]
                at = one_to[at, symbol]
            self.to[i], self.add[i] = at, cost
        self._to, self._add = self.to.tolist(), self.add.tolist()
        self.trace = lru_cache(1 << 17)(self._trace)

    def codes(self, symbols: bytes) -> list[int]:
        """Blocks of a chunk as numbers; the first is filled up from the left."""
        fill = -len(symbols) % BLOCK
        grid = np.frombuffer(bytes(fill) + symbols, np.uint8).reshape(-1, BLOCK).astype(np.int64)
        return (grid @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))).tolist()

    def chain(self, codes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """For every vector on the right of the blocks: the vector on their left, and the cost added."""
        at, cost = np.arange(len(self.vectors)), np.zeros(len(self.vectors), np.int64)
        for code in reversed(codes):
            cost += self.add[at, code]
            at = self.to[at, code].astype(np.int64)
        return at, cost

    def rights(self, codes: list[int], right: int) -> tuple[list[int], int, int]:
        """(vector on the right of each block, vector on the left of all, cost added)."""
        out, cost = [], 0
        for code in reversed(codes):
            out.append(right)
            cost += self._add[right][code]
            right = self._to[right][code]
        out.reverse()
        return out, right, cost

    def _trace(self, code: int, right: int, state: int) -> tuple[str, int]:
        """(edits of a block's rows, state after it), the ASCII-least of the cheapest."""
        symbols = [code // SYMBOLS ** d % SYMBOLS for d in range(BLOCK - 1, -1, -1)]
        costs = [self.vectors[right]]
        for s in reversed(symbols):  # expanded backward
            costs.append(before_symbol(costs[-1], s))
        costs.reverse()
        letters = ""
        for i, s in enumerate(symbols):
            done = s == 0
            while not done:
                here, after = costs[i], costs[i + 1]
                more = (s - 2) % 2 * CUT_OFF
                kept = None if s == GONE else KEPT[(s - 2) // 2].get(state)
                if here[state] == DELETE + after[state]:
                    letters, done = letters + "D", True
                elif here[state] == INSERT + here[NEXT[state]]:
                    letters, state = letters + "I", NEXT[state]
                elif kept is not None and here[state] == more + after[kept]:
                    letters, state, done = letters + "K", kept, True
                else:
                    letters, state, done = letters + "R", NEXT[state], True
        return letters, state

    def edits(self, codes: list[int], right: int, state: int) -> tuple[str, int]:
        """(edits of a chunk, state after it)."""
        out = []
        for code, r in zip(codes, self.rights(codes, right)[0]):
            letters, state = self.trace(code, r, state)
            out.append(letters)
        return "".join(out), state


_TABLES: list[Tables] = []


def tables() -> Tables:
    """The worker's tables (made once per worker process; they depend on the costs alone)."""
    if not _TABLES:
        _TABLES.append(Tables())
    return _TABLES[0]


def last_inserts(state: int) -> str:
    """Inserts after the last row."""
    return "I" * (FINAL[state] // INSERT)


def rebuilt(letters: str, state: int, symbols: bytes, roles: list[str], texts: list[str]):
    """(role, text) of every row that the edits leave or insert."""
    row = 0
    for letter in letters:
        if letter == "I":
            state = NEXT[state]
            yield NAMES[state], ""
            continue
        if letter == "K":
            state = KEPT[(symbols[row] - 2) // 2][state]
            yield roles[row], texts[row]
        elif letter == "R":
            state = NEXT[state]
            yield NAMES[state], texts[row]
        row += 1


# --- damage and marks ------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``: rows after damage; ``copies`` 0 is a dropped row, 2 a repeated one.

    NULLs count as one space, in roles and texts and in the checksum's text.
    """
    rows = pick(conversations, conv_id="conv_id", turn="turn", role="role", text="text").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                     F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = rows.withColumn("kind", F.crc32(place.cast("binary")) % 20)
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"))


def marked(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Distinct rows with ``copies`` summed, ``role_kind`` (0 to 3), ``blank``, ``cut_off``, ``seen`` (earlier in the conversation).

    Earlier means a smaller turn: rows equal in turn as well are one row here.
    """
    own = rows.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    key = ["conv_id", "turn", "role", "digest"]
    whole = scratch.save(own.groupBy(*key).agg(F.sum("copies").alias("copies"), F.first("text").alias("text")), "rows")
    when = F.struct(F.col("turn").isNotNull(), "turn")  # NULL turns first
    first = (whole.filter("copies > 0").groupBy("conv_id", "role", "digest").agg(F.min(when).alias("first_turn"))
             .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first_turn"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    return whole.join(first, same, "left").select(
        "conv_id", "turn", "role", "text", "copies",
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("role_kind"),
        (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut_off"),
        F.coalesce(when > F.col("first_turn"), F.lit(False)).alias("seen"))


# --- chunks ----------------------------------------------------------------------

COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")


class Chunk:
    """Consecutive rows of one conversation inside a task."""

    def __init__(self, last_role: int | None = None):
        self.symbols, self.roles, self.texts = bytearray(), [], []
        self.counts = dict.fromkeys(COUNTS, 0)
        self.first_role = self.last_role = None
        self.first_turn = self.last_turn = None
        self.size = 0

    def full(self) -> bool:
        return len(self.symbols) >= CHUNK_ROWS or self.size >= CHUNK_BYTES

    def add(self, turn, role: str, text: str, kind: int, blank: bool, cut_off: bool, seen: bool) -> None:
        """One row; ``seen`` rows are duplicates."""
        fault = "blank" if blank else "duplicate" if seen else "truncated" if cut_off else None
        if fault:
            self.counts[fault] += 1
        gone = blank or seen
        self.symbols.append(GONE if gone else 2 + 2 * kind + cut_off)
        self.roles.append(role)
        self.texts.append("" if gone else text)
        self.size += 0 if gone else len(text)
        if self.last_role is None:
            self.first_role = kind
        elif (self.last_role, kind) not in LEGAL:
            self.counts["illegal"] += 1
        self.last_role = kind
        if turn is not None and turn != self.last_turn:
            self.counts["turns"] += 1
            if self.first_turn is None:
                self.first_turn = turn
            self.last_turn = turn


class Result:
    """A conversation's counts, audit and hash, from its chunks in order."""

    def __init__(self):
        self.counts = dict.fromkeys(COUNTS, 0)
        self.last_role = self.first_turn = self.last_turn = None
        self.state, self.audit, self.cost = 0, [], 0
        self._hash, self._some = hashlib.sha256(), False

    def rows(self, symbols: bytes, roles: list, texts: list, right: int):
        """Edits the next chunk; returns its repaired rows."""
        letters, after = tables().edits(tables().codes(symbols), right, self.state)
        out = list(rebuilt(letters, self.state, symbols, roles, texts))
        self._take(letters, out)
        self.state = after
        return out

    def end(self):
        letters = last_inserts(self.state)
        out = list(rebuilt(letters, self.state, b"", [], []))
        self._take(letters, out)
        return out

    def _take(self, letters: str, rows: list) -> None:
        self.audit.append(letters)
        for role, text in rows:
            self._hash.update((("\n" if self._some else "") + f"{role}:{text}").encode())
            self._some = True

    def join(self, counts: dict, first_role, last_role, first_turn, last_turn) -> None:
        for name in COUNTS:
            self.counts[name] += counts[name]
        if first_role is not None:
            if self.last_role is not None and (self.last_role, first_role) not in LEGAL:
                self.counts["illegal"] += 1
            self.last_role = last_role
        if first_turn is not None:
            if self.last_turn == first_turn:
                self.counts["turns"] -= 1
            if self.first_turn is None:
                self.first_turn = first_turn
            self.last_turn = last_turn

    def row(self, conv_id) -> dict:
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.counts["turns"]
        return {"conv_id": conv_id, "gaps": gaps if gaps < 1 << 63 else None, "blank": self.counts["blank"],
                "duplicate": self.counts["duplicate"], "truncated": self.counts["truncated"],
                "illegal": self.counts["illegal"], "cost": self.cost, "audit": "".join(self.audit),
                "repaired_sha256": self._hash.hexdigest()}


_RESULT = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
           "cost bigint, audit string, repaired_sha256 string")
_OPEN = ("part int, no int, symbols binary, roles array<string>, texts array<string>, first_role int, last_role int, "
         "first_turn bigint, last_turn bigint, turns bigint, chained binary, added binary")
_TURNS = "conv_id bigint, part int, no int, place int, role string, text string"


def _schema(text: str):
    import pyarrow as pa

    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(),
             "array<string>": pa.list_(pa.string())}
    return pa.schema([(n, kinds[k]) for n, k in (f.split(" ", 1) for f in text.split(", "))])


def _batches(rows, schema, size: int = 512):
    """Record batches of dicts; missing keys are NULL."""
    import pyarrow as pa

    held: list = []
    for row in rows:
        held.append(row)
        if len(held) >= size or len(row.get("texts") or ()) >= 64:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _whole(conv_id, chunk: Chunk) -> Result:
    t = tables()
    out = Result()
    _, left, out.cost = t.rights(t.codes(bytes(chunk.symbols)), t.final)
    out.cost += t.vectors[left][0]
    out.join(chunk.counts, chunk.first_role, chunk.last_role, chunk.first_turn, chunk.last_turn)
    return out


def _chunks(part: int, rows):
    """Rows of a sorted partition -> (conv_id, chunk, no, whether it is the whole conversation)."""
    conv, chunk, no, first_conv = None, None, 0, True
    for conv_id, turn, role, text, copies, kind, blank, cut_off, seen in rows:
        if chunk is not None and conv_id != conv:
            yield conv, chunk, no, no == 0 and not first_conv
            chunk, no, first_conv = None, 0, False
        if chunk is None:
            conv, chunk = conv_id, Chunk()
        for _ in range(copies):
            if chunk.full():
                yield conv, chunk, no, False
                chunk, no = Chunk(), no + 1
            chunk.add(turn, role, text, kind, blank, cut_off, seen)
            seen = True
    if chunk is not None:  # the next partition may hold more of it
        yield conv, chunk, no, False


def _cut(batches):
    """Finished conversations, and open chunks."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    t = tables()

    def out():
        rows = (r for b in batches for r in zip(*[c.to_pylist() for c in b.columns]))
        for conv_id, chunk, no, whole in _chunks(part, rows):
            symbols = bytes(chunk.symbols)
            if whole:
                result = _whole(conv_id, chunk)
                result.rows(symbols, chunk.roles, chunk.texts, t.final)
                result.end()
                yield result.row(conv_id)
                continue
            at, cost = t.chain(t.codes(symbols))
            yield {"conv_id": conv_id, "part": part, "no": no, "symbols": symbols, "roles": chunk.roles,
                   "texts": chunk.texts, "first_role": chunk.first_role, "last_role": chunk.last_role,
                   "first_turn": chunk.first_turn, "last_turn": chunk.last_turn,
                   "chained": at.astype("<i2").tobytes(), "added": cost.astype("<i8").tobytes(),
                   **chunk.counts}

    yield from _batches(out(), _schema(f"{_RESULT}, {_OPEN}"))


def _chain(key, table):
    """The vector on the right of every open chunk of a conversation, and the conversation's cost."""
    import pyarrow as pa

    t = tables()
    order = np.lexsort([table.column("no").to_numpy(), table.column("part").to_numpy()])[::-1].tolist()
    chained, added = table.column("chained").to_pylist(), table.column("added").to_pylist()
    rights, right, cost = np.empty(len(order), np.int64), t.final, 0
    for i in order:
        rights[i] = right
        cost += int(np.frombuffer(added[i], "<i8")[right])
        right = int(np.frombuffer(chained[i], "<i2")[right])
    n = len(order)
    return pa.table({"c": pa.array([key[0].as_py()] * n, pa.int64()), "p": table.column("part"), "m": table.column("no"),
                     "right": pa.array(rights), "total": pa.array([cost + t.vectors[right][0]] * n, pa.int64())})


def _stitch(turns: bool):
    """Open chunks in order -> results, or with ``turns`` the repaired rows."""

    def run(batches):
        names = [f.split(" ")[0] for f in f"{_RESULT}, {_OPEN}".split(", ")] + ["right", "total"]
        schema = _schema(_TURNS if turns else _RESULT)

        def out():
            conv, result, place = None, None, None
            for batch in batches:
                columns = [c.to_pylist() for c in batch.columns]
                for values in zip(*columns):
                    r = dict(zip(names, values))
                    if result is None or r["conv_id"] != conv:
                        if result is not None:
                            yield from finish(conv, result, place)
                        conv, result = r["conv_id"], Result()
                        result.cost = r["total"]
                    result.join({n: r[n] for n in COUNTS}, r["first_role"], r["last_role"], r["first_turn"],
                                r["last_turn"])
                    place = (r["part"], r["no"])
                    rows = result.rows(r["symbols"], r["roles"], r["texts"], r["right"])
                    if turns:
                        yield from numbered(conv, place, 0, rows)
                        place += (len(rows),)
            if result is not None:
                yield from finish(conv, result, place)

        def finish(conv, result, place):
            rows = result.end()
            if turns:
                yield from numbered(conv, place[:2], place[2], rows)
            else:
                yield result.row(conv)

        def numbered(conv, place, start, rows):
            for i, (role, text) in enumerate(rows, start):
                yield {"conv_id": conv, "part": place[0], "no": place[1], "place": i, "role": role, "text": text}

        yield from _batches(out(), schema)

    return run


def _ordered(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Marked rows, sorted by conversation, turn (NULLs first), role and text across and inside partitions."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"]
    sorted_rows = marked(rows, scratch).repartitionByRange(shuffle_parts(rows.sparkSession), *order)
    return sorted_rows.sortWithinPartitions(*order).select(
        "conv_id", "turn", "role", "text", "copies", "role_kind", "blank", "cut_off", "seen")


def _in_order(chunks: DataFrame, scratch: Scratch) -> DataFrame:
    """Open chunks with their right vectors, each conversation's in one partition and in order."""
    rights = scratch.save(chunks.select("conv_id", "part", "no", "chained", "added").groupBy("conv_id").applyInArrow(
        _chain, "c bigint, p int, m int, right bigint, total bigint"), "rights")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("no") == F.col("m"))
    joined = chunks.join(rights, same).drop("c", "p", "m")
    return joined.repartition("conv_id").sortWithinPartitions("conv_id", "part", "no")


def audit(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` -> one row per conversation.

    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256``.  A conversation's rows are taken by turn, NULL turns
    first, rows of one turn by role and text; ``copies`` says how often a row
    stands there (0: not at all, but its conversation is listed).  NULL ids
    are one conversation.  Rows whose role is empty can not be kept as they
    are.  No rows left: zeros, an empty audit and the empty text's hash.
    Empty table: no rows.  Long conversations lie across tasks; only the
    audit itself is held whole.  ``gaps`` beyond a long is NULL.
    """
    scratch = Scratch(rows.sparkSession, "repair")
    made = scratch.save(_ordered(rows, scratch).mapInArrow(_cut, f"{_RESULT}, {_OPEN}"), "chunks")
    names = [f.split(" ")[0] for f in _RESULT.split(", ")]
    chunks = _in_order(made.filter("part IS NOT NULL"), scratch)
    return made.filter("part IS NULL").select(*names).unionByName(chunks.mapInArrow(_stitch(False), _RESULT))


def repaired(rows: DataFrame) -> DataFrame:
    """``conv_id, part, no, place, role, text``: the repaired rows themselves, in order of ``part, no, place``."""
    scratch = Scratch(rows.sparkSession, "repair")

    def keep_open(batches):
        """Every chunk open, with its rows."""
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        t = tables()

        def out():
            found = (r for b in batches for r in zip(*[c.to_pylist() for c in b.columns]))
            for conv_id, chunk, no, _ in _chunks(part, found):
                at, cost = t.chain(t.codes(bytes(chunk.symbols)))
                yield {"conv_id": conv_id, "part": part, "no": no, "symbols": bytes(chunk.symbols),
                       "roles": chunk.roles, "texts": chunk.texts, "chained": at.astype("<i2").tobytes(),
                       "added": cost.astype("<i8").tobytes(), **chunk.counts}

        yield from _batches(out(), _schema(f"{_RESULT}, {_OPEN}"))

    made = scratch.save(_ordered(rows, scratch).mapInArrow(keep_open, f"{_RESULT}, {_OPEN}"), "chunks")
    return _in_order(made, scratch).mapInArrow(_stitch(True), _TURNS)
