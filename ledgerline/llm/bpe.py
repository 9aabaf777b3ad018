"""BPE encoding by a priority queue of merge ranks, and decoding from the vocabulary's strings.

A word starts as a doubly linked list of one symbol per byte.  The queue holds
(rank, place) of every neighbouring pair that may merge; the lowest rank, and
of equal ranks the leftmost place, merges first.  A merge puts the pairs it
makes into the queue and leaves the pairs it breaks there: an entry whose
place no longer holds a pair of that rank is stale and skipped.

The file says which strings are tokens of their own wherever a text holds
them, how texts are normalised and where words begin and end.  All of that
stays inside runs between white space, so a worker keeps the ids of the runs
it has met, by their whole text.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from heapq import heapify, heappop, heappush

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import pick, text_or_empty
from ledgerline.llm.tokens import broadcast_file, tokenizer_path

VOCABULARY = "word_bpe_49k.json"
MEMORY = 800_000        # runs, and as many words, that a worker remembers
LONGEST = 64            # characters of a run that is remembered
PIECE = 1 << 20         # characters of a text that are taken at once, up to the next white space
SLICE_BYTES = 1 << 21   # text bytes of a result batch

# The characters with the Unicode property White_Space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPLIT = re.compile(f"[{WHITE}]+")
_MORE_SPACE = re.compile("[\x1c-\x1f]")  # Python splits at these too, the tokenizer does not
_BREAK = re.compile("[ \t\n\r]")

_CODERS: dict[str, "Bpe"] = {}


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves, the others for the
    characters from 256 on, in ascending order.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


class Memory:
    """A bounded dict in two halves: what is asked for again moves to the newer half."""

    def __init__(self, size: int):
        self._half = size // 2
        self.new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def turn(self) -> None:
        if len(self.new) > self._half:
            self._old, self.new = self.new, {}

    def older(self, key: str) -> bytes | None:
        found = self._old.get(key)
        if found is not None:
            self.new[key] = found
        return found


class Bpe:
    """Encoder and decoder of a byte-level BPE file whose words are kept by a pattern and end in a suffix."""

    def __init__(self, file_text: str):
        spec = json.loads(file_text)
        model = spec["model"]
        vocabulary: dict[str, int] = model["vocab"]
        self._expect(spec)
        suffix = model["end_of_word_suffix"] or ""
        self._bits = max(max(vocabulary.values()), len(model["merges"])).bit_length()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self._rank = {vocabulary[a] << self._bits | vocabulary[b]: r << 32 for r, (a, b) in enumerate(pairs)}
        self._made = {r << 32: vocabulary[a + b] for r, (a, b) in enumerate(pairs)}
        shown = byte_characters()
        self._open = [vocabulary[c] for c in shown]
        self._close = [vocabulary[c + suffix] for c in shown]
        pattern = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        import regex

        # The file's \s is White_Space; spelt out, since Python's is wider.
        self._word = regex.compile(pattern.replace(r"\s", WHITE) + "| ")
        self._token: dict[int, bytes] = {i: piece.encode() for piece, i in vocabulary.items()}
        added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self._token.update((i, piece.encode()) for piece, i in added.items())
        self._added = {piece: np.array([i], "<u4").tobytes() for piece, i in added.items()}
        self._own = re.compile("|".join(re.escape(p) for p in sorted(added, key=len, reverse=True)) or r"(?!)")
        self._runs, self._words = Memory(MEMORY), Memory(MEMORY)

    @staticmethod
    def _expect(spec: dict) -> None:
        """Raises for a file whose rules are not those written here."""
        model, before = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        rules = [n["type"] for n in spec["normalizer"]["normalizers"]]
        ok = (model["type"] == "BPE" and not model["dropout"] and not model["continuing_subword_prefix"]
              and not model.get("byte_fallback") and not model.get("ignore_merges") and spec["decoder"] is None
              and spec["post_processor"] is None and rules == ["NFC", "Replace", "Lowercase"]
              and [p["type"] for p in before] == ["Split", "ByteLevel"]
              and before[0]["behavior"] == "Removed" and before[0]["invert"]
              and not before[1]["add_prefix_space"] and not before[1]["use_regex"]
              and not any(a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"]
                          for a in spec["added_tokens"]))
        if not ok:
            raise ValueError("not a byte-level BPE file with word ends, NFC and lower case")

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word (its bytes, at least one)."""
        n = len(word)
        symbol = [self._open[b] for b in word]
        symbol[-1] = self._close[word[-1]]
        rank, made, bits = self._rank.get, self._made, self._bits  # a rank is held as a multiple of 2**32
        queue = []
        left = symbol[0]
        for i in range(1, n):
            right = symbol[i]
            r = rank(left << bits | right)
            if r is not None:
                queue.append(r + i - 1)
            left = right
        if not queue:
            return symbol
        heapify(queue)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while queue:
            entry = heappop(queue)
            i = entry & 0xFFFFFFFF
            j = after[i]
            if j >= n or rank(symbol[i] << bits | symbol[j]) != entry - i:
                continue  # stale: one of the two symbols has merged since
            new = symbol[i] = made[entry - i]
            symbol[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = rank(new << bits | symbol[k])
                if r is not None:
                    heappush(queue, r + i)
            h = before[i]
            if h >= 0:
                r = rank(symbol[h] << bits | new)
                if r is not None:
                    heappush(queue, r + h)
        return [s for s in symbol if s >= 0]

    def _word_ids(self, word: str) -> bytes:
        ids = self._words.older(word)
        if ids is None:
            ids = np.array(self.merge(word.encode()), "<u4").tobytes()
            if len(word) <= LONGEST:
                self._words.new[word] = ids
        return ids

    def _plain(self, runs: list[str]) -> list[bytes]:
        """Ids of runs without strings that are tokens of their own, all in one go."""
        text = " ".join(runs)
        if not text.isascii():
            # Letter by letter: a capital sigma has one lower case wherever it stands.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        known = self._words.new.get
        out, own = [], []
        for word in self._word.findall(text.lower()):
            if word == " ":
                out.append(b"".join(own))
                own = []
            else:
                own.append(known(word) or self._word_ids(word))
        out.append(b"".join(own))
        return out

    def _apart(self, run: str) -> bytes:
        """Ids of a run with strings that are tokens of their own."""
        out: list[bytes] = []
        at = 0
        for found in self._own.finditer(run):
            out += self._plain([run[at: found.start()]])
            out.append(self._added[found.group()])
            at = found.end()
        return b"".join(out + self._plain([run[at:]]))

    def _runs_ids(self, runs: list[str]) -> list[bytes]:
        """Ids of runs without white space."""
        if not self._own.search(" ".join(runs)):
            return self._plain(runs)
        return [self._apart(run) for run in runs]

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit numbers."""
        out = []
        for piece in pieces(text):
            runs = list(filter(None, _SPLIT.split(piece))) if _MORE_SPACE.search(piece) else piece.split()
            memory = self._runs
            memory.turn()
            self._words.turn()
            ids = list(map(memory.new.get, runs))
            if None in ids:
                missing = [i for i, x in enumerate(ids) if x is None]
                new = []
                for i in missing:
                    ids[i] = memory.older(runs[i])
                    if ids[i] is None:
                        new.append(i)
                for i, found in zip(new, self._runs_ids([runs[i] for i in new]) if new else []):
                    ids[i] = found
                    if len(runs[i]) <= LONGEST:
                        memory.new[runs[i]] = found
            out.append(b"".join(ids))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The vocabulary's strings of the ids, one space between two; ids outside the vocabulary are left out."""
        token = self._token.get
        out = []
        for at in range(0, len(ids), 4 * PIECE):
            found = map(token, np.frombuffer(ids[at: at + 4 * PIECE], "<u4").tolist())
            out.append(b" ".join([x for x in found if x is not None]))
        return b" ".join(filter(None, out))


def pieces(text: str):
    """The text in pieces of about ``PIECE`` characters, cut at white space."""
    at = 0
    while len(text) - at > PIECE:
        cut = _BREAK.search(text, at + PIECE)
        if cut is None:
            break
        yield text[at: cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def coder(file_text: str) -> Bpe:
    """The worker's coder for this file (made once per worker process)."""
    key = hashlib.sha1(file_text.encode()).hexdigest()
    if key not in _CODERS:
        _CODERS[key] = Bpe(file_text)
    return _CODERS[key]


def _slices(column):
    """(first row, texts) of about ``SLICE_BYTES`` at a time."""
    start, held, texts = 0, 0, []
    for i in range(len(column)):
        texts.append(column[i].as_py() or "")
        held += len(texts[-1])
        if held >= SLICE_BYTES:
            yield start, texts
            start, held, texts = i + 1, 0, []
    if texts:
        yield start, texts


def encode(docs: DataFrame, *, tokenizer: str | None = None, decoded: bool = False, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids``: every text's ids (little-endian unsigned 32-bit, as binary).

    With ``decoded`` also ``decoded``, the text that the ids give back.  NULL and
    empty text: no ids.  NULL ids of documents and repeated rows are kept, ties
    do not matter, extra columns are not read; an empty table gives no rows.
    A very long text is taken in pieces between white space; a single run
    without white space costs about 130 bytes a byte while its symbols merge.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    file = broadcast_file(docs.sparkSession, tokenizer or tokenizer_path(VOCABULARY))

    def code(batches):
        import pyarrow as pa

        bpe = coder(file.value)
        for batch in batches:
            for start, texts in _slices(batch.column(1)):
                ids = [bpe.encode(t) for t in texts]
                columns = [batch.column(0).slice(start, len(ids)), pa.array([len(x) // 4 for x in ids], pa.int64()),
                           pa.array(ids, pa.binary())]
                if decoded:
                    columns.append(pa.array([bpe.decode(x) for x in ids], pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids", "decoded"][: len(columns)])

    return rows.mapInArrow(code, "doc_id bigint, n_tokens bigint, ids binary" + (", decoded string" if decoded else ""))


def decode(rows: DataFrame, *, tokenizer: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text``: the vocabulary's strings of every row's ids, joined by spaces; NULL ids give an empty text."""
    file = broadcast_file(rows.sparkSession, tokenizer or tokenizer_path(VOCABULARY))

    def back(batches):
        import pyarrow as pa

        bpe = coder(file.value)
        for batch in batches:
            texts = [bpe.decode(batch.column(1)[i].as_py() or b"").decode() for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return pick(rows, doc_id=id_col, ids=ids_col).select(F.col("doc_id").cast("long"), "ids").mapInArrow(
        back, "doc_id bigint, text string")


def digests(docs: DataFrame, *, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text's ids and of what they decode to."""
    coded = encode(docs, tokenizer=tokenizer, decoded=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
