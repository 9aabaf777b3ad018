"""Encoding whole texts with a public tokenizer file, inside tasks.

The tokenizer's file is read once on the driver and sent to the tasks as a
broadcast string (a vocabulary file: its size does not depend on the data).

Texts are cut into words by array operations, each distinct word is encoded
by the library, and the ids are put together again by array operations.  Cuts
are made only where the tokenizer itself always cuts; a text where that is
not sure goes to the library whole.  A worker remembers the ids of the words
it has met, by their bytes.  Inside a block words are told apart by a hash,
and every occurrence is compared with the word whose ids it gets.
"""

from __future__ import annotations

import hashlib
import json
import os
from itertools import chain

import numpy as np

from ledgerline.llm import words
from ledgerline.llm.common import string_bytes

CACHE_WORDS = 1_200_000  # words a worker remembers, in two halves; the older half goes when the newer is full
CACHE_BYTES = 64       # longer words are not remembered
LINE = 256             # words encoded side by side
SLICE_BYTES = 1 << 21  # texts are encoded in slices of about this size; longer ones are cut between words

_ENCODERS: dict[tuple[str, str, bool], "Encoder"] = {}

_TAILS = b".,;:!?"
_TAIL = np.zeros(256, np.int64)
_TAIL[list(_TAILS)] = np.arange(1, len(_TAILS) + 1)
_PLAIN = np.zeros(256, bool)
_PLAIN[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")] = True
_OTHER_SPACE = np.zeros(256, bool)
_OTHER_SPACE[[9, 11, 12, 13]] = True


_LEAD = np.zeros(256, np.uint8)
_LEAD[32], _LEAD[10] = 1, 2
_LEAD_STEP = np.uint64(0x9E3779B97F4A7C15)
_LETTER = np.zeros(256, bool)
_LETTER[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
_VISIBLE = np.zeros(256, bool)
_VISIBLE[33:127] = True


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many places of each text are set."""
    at = np.flatnonzero(mask)
    return np.diff(np.searchsorted(at, offsets))


def _wide_space(flat: np.ndarray) -> np.ndarray:
    """Where a white-space character outside ASCII begins."""
    out = np.zeros(len(flat), bool)
    at = np.flatnonzero((flat == 0xC2) | ((flat >= 0xE1) & (flat <= 0xE3)))  # few places need a closer look
    if not len(at):
        return out
    last = len(flat) - 1
    first = flat[at]
    after = np.where(at < last, flat[np.minimum(at + 1, last)], 0)
    third = np.where(at + 1 < last, flat[np.minimum(at + 2, last)], 0)
    found = (first == 0xC2) & ((after == 0x85) | (after == 0xA0))
    found |= (first == 0xE1) & (after == 0x9A) & (third == 0x80)
    found |= (first == 0xE2) & (after == 0x80) & ((third <= 0x8A) | (third == 0xA8) | (third == 0xA9) | (third == 0xAF))
    found |= (first == 0xE2) & (after == 0x81) & (third == 0x9F)
    found |= (first == 0xE3) & (after == 0x80) & (third == 0x80)
    out[at] = found
    return out


def _latin_letters(flat: np.ndarray) -> np.ndarray:
    """Bytes of ASCII letters and of Latin-1 letters in two bytes (U+00C0 to U+00FF without the signs)."""
    out = _LETTER[flat]
    lead = np.flatnonzero(flat[:-1] == 0xC3)
    after = flat[lead + 1]
    lead = lead[(after >= 0x80) & (after < 0xC0) & (after != 0x97) & (after != 0xB7)]
    out[lead] = out[lead + 1] = True
    return out


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all ranges, one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def _flat_ids(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(length of each list, all ids one after another)."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return sizes, np.fromiter(chain.from_iterable(lists), np.dtype("<u4"), int(sizes.sum()))


class _Gather:
    """Puts ids of words together that come in parts."""

    def __init__(self, n: int):
        self._per = np.zeros(n, np.int64)
        self._parts: list = []

    def put(self, own: np.ndarray, per: np.ndarray, ids: np.ndarray) -> None:
        self._per[own] = per
        self._parts.append((own, per, ids))

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        """(ids per word, all ids in the words' order)."""
        starts = np.cumsum(self._per) - self._per
        out = np.empty(int(self._per.sum()), "<u4")
        for own, per, ids in self._parts:
            out[_ranges(starts[own], per)] = ids
        return self._per, out


class _Memory:
    """Words and their ids: a hash table with open addressing over arrays, searched for many words at once."""

    def __init__(self):
        self.n = 0
        self._bytes_used = self._ids_used = 0
        self._slots = np.full(1 << 13, -1, np.int32)  # number of the word, by the low bits of its hash
        self._keys = np.zeros(1 << 12, np.uint64)
        self._starts, self._per_start = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self._sizes, self._per = np.zeros(1 << 12, np.int32), np.zeros(1 << 12, np.int32)
        self._bytes, self._ids = np.zeros(1 << 16, np.uint8), np.zeros(1 << 14, "<u4")

    def find(self, keys: np.ndarray, flat: np.ndarray, starts: np.ndarray, stops: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray]:
        """(number of each word, -1 if it is not here; whether another word of its hash is here)."""
        low = np.uint64(len(self._slots) - 1)
        out = np.full(len(keys), -1, np.int64)
        going, slot = np.arange(len(keys)), (keys & low).astype(np.int64)
        while len(going):
            entry = self._slots[slot]
            used = entry >= 0
            same = used & (self._keys[entry] == keys[going])
            out[going[same]] = entry[same]
            on = used & ~same
            going, slot = going[on], (slot[on] + 1) & (len(self._slots) - 1)
        hit = np.flatnonzero(out >= 0)
        entry = out[hit]
        at = self._starts[entry]
        differ = hit[~words.same_bytes(flat, starts[hit], stops[hit], at, at + self._sizes[entry], self._bytes)]
        out[differ] = -1
        other = np.zeros(len(keys), bool)
        other[differ] = True
        return out, other

    def ids_of(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids per word, all ids) of the words of these numbers."""
        per = self._per[entry].astype(np.int64)
        return per, self._ids[_ranges(self._per_start[entry], per)]

    def add(self, keys: np.ndarray, flat: np.ndarray, starts: np.ndarray, stops: np.ndarray, per: np.ndarray,
            ids: np.ndarray) -> None:
        """Remembers words that are not here."""
        if not len(keys):
            return
        size = stops - starts
        n, used, ids_used = self.n + len(keys), self._bytes_used + int(size.sum()), self._ids_used + len(ids)
        for name in ("_keys", "_starts", "_sizes", "_per_start", "_per"):
            setattr(self, name, _roomy(getattr(self, name), n))
        self._bytes, self._ids = _roomy(self._bytes, used + 8), _roomy(self._ids, ids_used)
        own = slice(self.n, n)
        self._keys[own], self._sizes[own], self._per[own] = keys, size, per
        self._starts[own] = self._bytes_used + np.cumsum(size) - size
        self._per_start[own] = self._ids_used + np.cumsum(per) - per
        self._bytes[self._bytes_used: used] = flat[_ranges(starts, size)]
        self._ids[self._ids_used: ids_used] = ids
        entry = np.arange(self.n, n)
        self.n, self._bytes_used, self._ids_used = n, used, ids_used
        if 2 * n > len(self._slots):
            self._slots = np.full(1 << (2 * n).bit_length(), -1, np.int32)
            entry = np.arange(n)
        slot = (self._keys[entry] & np.uint64(len(self._slots) - 1)).astype(np.int64)
        while len(entry):
            free = self._slots[slot] < 0
            self._slots[slot[free]] = entry[free]  # of several words the last stays, the others go on
            on = self._slots[slot] != entry
            entry, slot = entry[on], (slot[on] + 1) & (len(self._slots) - 1)


def _roomy(array: np.ndarray, n: int) -> np.ndarray:
    """The array, or a larger copy, with room for ``n``."""
    if n <= len(array):
        return array
    out = np.zeros(max(n, len(array) + len(array) // 2), array.dtype)
    out[: len(array)] = array
    return out


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    ``byte`` files (byte-level, white space kept): a word goes with the single
    space or line feed before it; texts with other or repeated white space go
    to the library whole.  ``word`` files (white space dropped) treat each
    white-space-separated word by itself.  A closing mark after a letter or
    digit is a token of its own in both.

    Strings of special tokens inside a text give these tokens, as in a plain
    library call (such texts go to the library whole); with ``ordinary`` they
    are ordinary text, so that no text can yield a special id.
    """

    def __init__(self, file_text: str, kind: str, ordinary: bool = False, memory: int = CACHE_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(file_text)
        self._tokenizer.encode_special_tokens = ordinary
        self._special = [] if ordinary else [
            t["content"].encode() for t in json.loads(file_text).get("added_tokens", [])]
        self._kind = kind
        self._half = memory // 2
        self._newer, self._older = _Memory(), _Memory()
        self._beside = self._letters_beside(json.loads(file_text)) if kind == "byte" else self._tokenizer
        vocabulary = self._tokenizer.get_vocab()
        self._mark = np.zeros(max(vocabulary.values()) + 1, bool)
        self._mark[[i for piece, i in vocabulary.items()
                    if (piece.startswith("Ġ") if kind == "byte" else piece.endswith("</w>"))]] = True
        self._line_mark = np.zeros(len(self._mark), bool)
        self._line_mark[[i for piece, i in vocabulary.items() if piece.startswith("Ċ")]] = True
        tails = [np.frombuffer(x, "<u4") for x in self._ids([chr(c) for c in _TAILS])]
        self._tail_ids = np.array([0] + [int(x[0]) for x in tails], np.uint32)
        self._tail_ok = np.array([False] + [len(x) == 1 for x in tails])

    def _letters_beside(self, file: dict):
        """The file's model for lines of Latin letters and single spaces.

        Its byte-level pattern cuts such a line before every space and nowhere
        else; here the line is mapped to bytes whole and cut there, so that
        words are not matched and mapped one by one.  Other files: as they are.
        """
        from tokenizers import Tokenizer, pre_tokenizers

        cutter = file.get("pre_tokenizer") or {}
        if (file.get("normalizer") is not None or cutter.get("type") != "ByteLevel" or cutter.get("add_prefix_space")
                or not cutter.get("use_regex", True)
                or any(t["content"].strip().isalpha() for t in file.get("added_tokens", []))):
            return self._tokenizer
        out = Tokenizer(self._tokenizer.model)
        out.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            pre_tokenizers.Split("Ġ", "merged_with_next")])
        return out

    def _ids(self, pieces: list[str]) -> list[bytes]:
        done = self._tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in done]

    def _each(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids per word, all ids) of words encoded one by one."""
        return _flat_ids([e.ids for e in self._tokenizer.encode_batch_fast(pieces, add_special_tokens=False)])

    def _by_marks(self, tokenizer, lines: list[bytes], sizes: np.ndarray, mark: np.ndarray, singles
                  ) -> tuple[np.ndarray, np.ndarray]:
        """(ids per word, all ids) of lines of words: a word begins (``word`` files: ends) where ``mark`` says so.

        ``sizes`` are the words of each line, ``singles`` gives the words of a
        line whose marks do not tell them apart.
        """
        done = tokenizer.encode_batch_fast([x.decode("utf-8", "replace") for x in lines], add_special_tokens=False)
        per_line, ids = _flat_ids([e.ids for e in done])
        marked = mark[ids]
        ends = np.cumsum(per_line)
        seen = np.concatenate([[0], np.cumsum(marked)])
        good = (per_line > 0) & (seen[ends] - seen[ends - per_line] == sizes)
        outer = ends - per_line if self._kind == "byte" else ends - 1
        good[good] = marked[outer[good]]

        def cut(own):
            at = np.flatnonzero(own)
            return np.diff(np.append(at, len(own)) if self._kind == "byte" else np.concatenate([[-1], at]))

        if good.all():
            return cut(marked), ids
        parts = []
        for i, (a, b) in enumerate(zip((ends - per_line).tolist(), ends.tolist())):
            parts.append((cut(marked[a:b]), ids[a:b]) if good[i] else self._each(singles(i)))
        return np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])

    def _lines(self, tokenizer, flat: np.ndarray, starts: np.ndarray, stops: np.ndarray, mark: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray]:
        """(ids per word, all ids) of words that keep their ids side by side, many in one call."""
        gap = int(self._kind == "word")  # a space between them; ``byte`` words bring their own
        parts = []
        for k in range(0, len(starts), 1 << 16):
            a, b = starts[k: k + (1 << 16)], stops[k: k + (1 << 16)]
            size = b - a
            to = np.cumsum(size + gap)
            text = np.full(int(to[-1]), 32, np.uint8)
            text[_ranges(to - size - gap, size)] = flat[_ranges(a, size)]
            raw = text.tobytes()
            first = np.arange(0, len(a), LINE)
            last = np.minimum(first + LINE, len(a))
            begin, end = (to - size - gap)[first], to[last - 1] - gap

            def singles(i):
                return [flat[x:y].tobytes().decode("utf-8", "replace")
                        for x, y in zip(a[first[i]: last[i]].tolist(), b[first[i]: last[i]].tolist())]

            lines = [raw[x:y] for x, y in zip(begin.tolist(), end.tolist())]
            parts.append(self._by_marks(tokenizer, lines, last - first, mark, singles))
        return np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])

    def _joined_ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids per word, all ids) of ``word`` files' words that begin and end with visible ASCII characters.

        Such words are encoded by themselves wherever a single space stands
        before them: many in one call, cut by the ids' places.
        """
        parts = []
        lines = [pieces[i: i + LINE] for i in range(0, len(pieces), LINE)]
        done = self._tokenizer.encode_batch([" ".join(x) for x in lines], add_special_tokens=False)
        for line, e in zip(lines, done):
            ids = np.array(e.ids, "<u4")
            places = np.fromiter((a for a, _ in e.offsets), np.int64, len(ids))
            size = np.fromiter(map(len, line), np.int64, len(line)) + 1
            cuts = np.searchsorted(places, np.concatenate([[0], np.cumsum(size)]))
            if not len(ids) or (np.diff(places) < 0).any() or (np.diff(cuts) <= 0).any():
                parts.append(self._each(line))
            else:
                parts.append((np.diff(cuts), ids))
        return np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])

    def _words(self, flat: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids per word, all ids) of words, each with the white space that goes with it, by the library."""
        lead = _LEAD[flat[starts]] if self._kind == "byte" else np.ones(len(starts), np.uint8)
        cores = starts + (lead > 0) if self._kind == "byte" else starts
        odd = np.flatnonzero(~_latin_letters(flat))
        letters = np.searchsorted(odd, stops) == np.searchsorted(odd, cores)
        latin = letters.copy()
        visible = (_VISIBLE[flat[cores]] & _VISIBLE[flat[stops - 1]] & (stops - cores <= CACHE_BYTES))
        for i in np.flatnonzero(~letters & ~visible & (lead > 0)).tolist():  # letters of other scripts
            letters[i] = flat[cores[i]: stops[i]].tobytes().decode("utf-8", "replace").isalpha()
        out = _Gather(len(starts))
        if self._kind == "byte":
            beside = letters | visible
            for tokenizer, which, mark in ((self._beside, latin & (lead == 1), self._mark),
                                           (self._tokenizer, beside & ~latin & (lead == 1), self._mark),
                                           (self._tokenizer, beside & (lead == 2), self._line_mark)):
                own = np.flatnonzero(which)
                if len(own):
                    out.put(own, *self._lines(tokenizer, flat, starts[own], stops[own], mark))
            rest = np.flatnonzero(~beside | (lead == 0))
        else:
            own = np.flatnonzero(letters)
            if len(own):
                out.put(own, *self._lines(self._tokenizer, flat, starts[own], stops[own], self._mark))
            rest = np.flatnonzero(~letters)
        for beside, step in ((True, 1 << 14), (False, 1 << 12)):
            by = rest[(visible[rest] == beside) if self._kind == "word" else np.full(len(rest), not beside)]
            for k in range(0, len(by), step):
                own = by[k: k + step]
                pieces = [flat[x:y].tobytes().decode("utf-8", "replace")
                          for x, y in zip(starts[own].tolist(), stops[own].tolist())]
                out.put(own, *(self._joined_ids if beside else self._each)(pieces))
        return out.all()

    def lookup(self, flat: np.ndarray, starts: np.ndarray, stops: np.ndarray, keys: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray]:
        """(ids per word, all ids in the words' order) of distinct words, each with the white space that goes with it.

        ``keys`` are 64-bit hashes of the words; a remembered word is taken
        only if its bytes are the same.
        """
        if self._newer.n > self._half:
            self._older, self._newer = self._newer, _Memory()
        out = _Gather(len(keys))
        known = stops - starts <= CACHE_BYTES  # words that may be remembered
        missing = np.arange(len(keys))
        new = []
        for memory in (self._newer, self._older):
            own = missing[known[missing]]
            if not len(own) or not memory.n:
                continue
            entry, other = memory.find(keys[own], flat, starts[own], stops[own])
            hit = entry >= 0
            per, ids = memory.ids_of(entry[hit])
            out.put(own[hit], per, ids)
            if memory is self._newer:
                known[own[other]] = False
            elif hit.any():
                new.append((own[hit], per, ids))
            left = np.ones(len(keys), bool)
            left[own[hit]] = False
            missing = missing[left[missing]]
        if len(missing):
            per, ids = self._words(flat, starts[missing], stops[missing])
            out.put(missing, per, ids)
            keep = known[missing]
            new.append((missing[keep], per[keep], ids[np.repeat(keep, per)]))
        for own, per, ids in new:
            self._newer.add(keys[own], flat, starts[own], stops[own], per, ids)
        return out.all()

    def _tails(self, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the mark that is cut off each word, 0 if none; end of the word without it).

        Cut off is a closing mark after a letter or digit (ASCII, or Latin-1 letters in two bytes).
        """
        size = ends - starts
        tail = _TAIL[flat[ends - 1]]
        before = flat[np.maximum(ends - 2, 0)]
        wide = ((before >= 0x80) & (before != 0x97) & (before != 0xB7) & (size >= 3)
                & (flat[np.maximum(ends - 3, 0)] == 0xC3))
        cut = (size >= 2) & self._tail_ok[tail] & (_PLAIN[before] | wide)
        tail[~cut] = 0
        return tail, ends - cut

    def _with_tails(self, per: np.ndarray, table: np.ndarray, index: np.ndarray, tail: np.ndarray
                    ) -> tuple[np.ndarray, np.ndarray]:
        """(ids per word, all ids) of words that have the ids of entry ``index`` and their closing mark's."""
        core = per[index]
        n = core + (tail > 0)
        to = np.cumsum(n)
        out = np.empty(int(to[-1]) if len(to) else 0, "<u4")
        marked = np.flatnonzero(tail)
        out[to[marked] - 1] = self._tail_ids[tail[marked]]
        passed = np.cumsum(core) - core
        step = np.arange(int(core.sum()))
        out[step + np.repeat(to - n - passed, core)] = table[step + np.repeat((np.cumsum(per) - per)[index] - passed, core)]
        return n, out

    def spaced(self, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids per word, all ids) of words (runs without white space), each with one space before it."""
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, "<u4")
        tail, stops = self._tails(flat, starts, ends)
        keys = words.span_hashes(flat, starts, stops)
        first, index = words.distinct(keys)
        if not words.same_bytes(flat, starts, stops, starts[first][index], stops[first][index]).all():
            tail, stops, first = np.zeros_like(tail), ends, np.arange(len(starts))  # words that only share a hash
            index = first
        begins, size = starts[first], (stops - starts)[first]
        to = np.cumsum(size + 1)
        text = np.full(int(to[-1]), 32, np.uint8)
        text[_ranges(to - size, size)] = flat[_ranges(begins, size)]
        per, table = self.lookup(text, to - size - 1, to, words.mix(keys[first] + _LEAD_STEP))
        return self._with_tails(per, table, index, tail)

    def encode(self, flat: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Ids of every text of a block (bytes and offsets)."""
        texts = len(offsets) - 1
        starts, ends, counts = words.word_spans(flat, offsets)
        if not len(starts):
            return self._whole(flat, offsets, range(texts), {})
        tail, stops = self._tails(flat, starts, ends)
        keys = words.span_hashes(flat, starts, stops)
        slow = np.zeros(texts, bool)
        if self._kind == "byte":
            lead = _LEAD[flat[np.maximum(starts - 1, 0)]]
            firsts = np.searchsorted(starts, offsets[:-1])
            firsts = firsts[firsts < len(starts)]
            lead[firsts[np.isin(starts[firsts], offsets[:-1])]] = 0  # words that open their text
            keys = words.mix(keys + lead.astype(np.uint64) * _LEAD_STEP)
            slow = self._unsure(flat, offsets, starts, ends)
        froms = starts - (lead > 0) if self._kind == "byte" else starts  # with the white space that goes with it
        first, index = words.distinct(keys)
        same = words.same_bytes(flat, froms, stops, froms[first][index], stops[first][index])
        if not same.all():  # words that only share a hash
            slow[np.searchsorted(offsets, starts[~same], side="right") - 1] = True
        raw = flat.tobytes()
        for special in self._special:
            at = raw.find(special)
            while at >= 0:
                slow[np.searchsorted(offsets, at, side="right") - 1] = True
                at = raw.find(special, at + 1)
        per, table = self.lookup(flat, froms[first], stops[first], keys[first])
        n, out = self._with_tails(per, table, index, tail)
        to = np.cumsum(n)
        text_end = np.concatenate([[0], to])[np.cumsum(counts)] * 4
        raw_ids = out.tobytes()
        bounds = np.concatenate([[0], text_end]).tolist()
        done = {t: raw_ids[bounds[t]: bounds[t + 1]] for t in np.flatnonzero(~slow & (counts > 0)).tolist()}
        return self._whole(flat, offsets, range(texts), done)

    def _whole(self, flat, offsets, texts, done: dict[int, bytes]) -> list[bytes]:
        """Fills in the texts that are not done: by the library, whole."""
        rest = [t for t in texts if t not in done and offsets[t + 1] > offsets[t]]
        for at in range(0, len(rest), 64):
            part = rest[at: at + 64]
            strings = [flat[offsets[t]: offsets[t + 1]].tobytes().decode("utf-8", "replace") for t in part]
            done.update(zip(part, self._ids(strings)))
        return [done.get(t, b"") for t in texts]

    @staticmethod
    def _unsure(flat, offsets, starts, ends) -> np.ndarray:
        """Texts whose white space is more than single spaces and line feeds between words."""
        a, b = offsets[:-1], offsets[1:]
        space = _per_text((flat == 32) | (flat == 10), offsets)
        odd = _per_text(_OTHER_SPACE[flat] | _wide_space(flat), offsets)
        n_words = np.searchsorted(starts, b) - np.searchsorted(starts, a)
        full = b > a
        first, last = flat[np.minimum(a, len(flat) - 1)], flat[np.maximum(b - 1, 0)]
        opening = full & ((first == 32) | (first == 10))
        closing = full & ((last == 32) | (last == 10))
        # One separator before each word but the first (or before all, if the text opens with one).
        return (odd > 0) | closing | (space != np.maximum(n_words - 1, 0) + opening)


def encoder(file_text: str, kind: str, ordinary: bool = False, memory: int = CACHE_WORDS) -> Encoder:
    """The worker's encoder for this file (made once per worker process), which remembers ``memory`` words."""
    key = (hashlib.sha1(file_text.encode()).hexdigest(), kind, ordinary)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(file_text, kind, ordinary, memory)
    return _ENCODERS[key]


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


def broadcast_file(spark, path: str):
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def safe_cuts(flat: np.ndarray, most: int) -> list[int]:
    """Cuts of one text into parts of about ``most`` bytes that both kinds of tokenizers encode by themselves.

    A cut lies before a single space between two visible ASCII characters,
    where every tokenizer here begins a token.
    """
    cuts = [0]
    at = most
    while at < len(flat) - 1:
        near = flat[at - 1: at + most + 1]
        places = np.flatnonzero((near[1:-1] == 32) & _VISIBLE[near[:-2]] & _VISIBLE[near[2:]])
        if len(places):
            cuts.append(at + int(places[0]))
            at = cuts[-1] + most
        else:
            at += most
    return cuts + [len(flat)]


def encode_batch(enc: Encoder, column):
    """(row, ids as bytes) of an Arrow string column, in slices of about ``SLICE_BYTES``; NULL is empty."""
    flat, offsets = string_bytes(column.fill_null(""))
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + SLICE_BYTES, side="right")) - 1
        base = offsets[start]
        if stop > start:
            yield from enumerate(enc.encode(flat[base: offsets[stop]], offsets[start: stop + 1] - base), start)
            start = stop
            continue
        text = flat[base: offsets[start + 1]]
        cuts = safe_cuts(text, SLICE_BYTES)
        yield start, b"".join([enc.encode(text[a:b], np.array([0, b - a]))[0] for a, b in zip(cuts[:-1], cuts[1:])])
        start += 1
