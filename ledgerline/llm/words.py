"""Vectorised word and shingle hashes of a block of texts (numpy, inside tasks).

Words are runs of anything but space, tab, LF, VT, FF and CR; A-Z count as
a-z.  Hashes are 64 bits wide and depend on the word's bytes alone.
"""

from __future__ import annotations

import hashlib

import numpy as np

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
LONG = 256  # bytes; longer words are hashed one by one
PIECE_BYTES = 1 << 20  # a longer text is hashed in pieces cut at white space
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)  # the lowest n bytes


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (shift, xor, multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, words per text) of every word; words never cross texts."""
    n = len(flat)
    texts = len(offsets) - 1
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(texts, np.int64)
    letter = ~_SPACE[flat]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = letter[:-1]
    inner = offsets[(offsets > 0) & (offsets < n)]
    before[inner] = False
    starts = np.flatnonzero(letter & ~before)
    last = np.empty(n, bool)
    last[-1] = True
    last[:-1] = ~letter[1:]
    last[inner - 1] = True
    ends = np.flatnonzero(letter & last) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, counts


def _eights(flat: np.ndarray, padded: bool = False) -> np.ndarray:
    """The eight bytes from every place on as one number (zeros after the end).

    A view of a padded copy, or of ``flat`` itself if that has eight bytes of padding.
    """
    if padded:
        return np.ndarray((len(flat) - 7,), "<u8", flat, strides=(1,))
    padded = np.zeros(len(flat) + 8, np.uint8)
    padded[: len(flat)] = flat
    return np.ndarray((len(flat) + 1,), "<u8", padded, strides=(1,))


def span_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of every span: its pieces of eight bytes, mixed in one after another."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    eights = _eights(flat)
    size = ends - starts
    h = size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    rest = np.minimum(size, 8)
    h = mix(h ^ (eights[starts] & _KEEP[rest]))
    going = np.flatnonzero((size > 8) & (size <= LONG))
    at = 8
    while len(going):
        rest = np.minimum(size[going] - at, 8)
        h[going] = mix(h[going] * np.uint64(0xD6E8FEB86659FD93) ^ (eights[starts[going] + at] & _KEEP[rest]))
        at += 8
        going = going[size[going] > at]
    for i in np.flatnonzero(size > LONG).tolist():
        digest = hashlib.blake2b(flat[starts[i]: ends[i]].tobytes(), digest_size=8).digest()
        h[i] = int.from_bytes(digest, "little")
    return h


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of each distinct key's first occurrence, number of its key for every place), in order of appearance."""
    import pyarrow as pa

    index = pa.array(keys).dictionary_encode().indices.to_numpy()
    if not len(index):
        return np.zeros(0, np.int64), index
    upto = np.maximum.accumulate(index)
    return np.concatenate([[0], np.flatnonzero(np.diff(upto)) + 1]), index


def same_bytes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, as_starts: np.ndarray, as_ends: np.ndarray,
               other: np.ndarray | None = None) -> np.ndarray:
    """Whether each span holds the same bytes as the span beside it (of ``other``, which ends with padding)."""
    size = ends - starts
    same = size == as_ends - as_starts
    eights = _eights(flat)
    as_eights = eights if other is None else _eights(other, padded=True)
    other = flat if other is None else other
    going = np.flatnonzero(same & (size <= LONG))
    at = 0
    while len(going):
        rest = np.minimum(size[going] - at, 8)
        differ = ((eights[starts[going] + at] ^ as_eights[as_starts[going] + at]) & _KEEP[np.maximum(rest, 0)]) != 0
        same[going[differ]] = False
        at += 8
        going = going[(size[going] > at) & ~differ]
    for i in np.flatnonzero(same & (size > LONG)).tolist():
        same[i] = np.array_equal(flat[starts[i]: ends[i]], other[as_starts[i]: as_ends[i]])
    return same


def pieces(flat: np.ndarray, most: int) -> list[int]:
    """Cuts of one text into pieces of about ``most`` bytes, at white space; only a single word may be longer."""
    cuts = [0]
    while len(flat) - cuts[-1] > most:
        at = cuts[-1] + most
        while at < len(flat):
            gap = np.flatnonzero(_SPACE[flat[at: at + most]])
            if len(gap):
                at += int(gap[0])
                break
            at += most
        if at >= len(flat):
            break
        cuts.append(at)
    return cuts + [len(flat)]


def word_hashes(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every lower-cased word, words per text)."""
    if len(offsets) == 2 and len(flat) > PIECE_BYTES:  # one long text: only its hashes are held whole
        cuts = pieces(flat, PIECE_BYTES)
        found = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            part = LOWER[flat[a:b]]
            starts, ends, _ = word_spans(part, np.array([0, b - a]))
            found.append(span_hashes(part, starts, ends))
        hashes = np.concatenate(found)
        return hashes, np.array([len(hashes)])
    starts, ends, counts = word_spans(flat, offsets)
    return span_hashes(LOWER[flat], starts, ends), counts


def shingle_sets(hashes: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct k-word shingle hashes of each text, set sizes).

    A text of 1 to k - 1 words has its whole sequence as one shingle; a text
    without words has none.
    """
    texts = len(counts)
    ends = np.cumsum(counts)
    starts = ends - counts
    per_text = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    total = int(per_text.sum())
    if total == 0:
        return np.zeros(0, np.uint64), np.zeros(texts, np.int64)
    factors = mix(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    padded = np.concatenate([hashes, np.zeros(k, np.uint64)])
    rolling = padded[: len(hashes)] * factors[0]
    for j in range(1, k):
        rolling += padded[j: j + len(hashes)] * factors[j]
    out_ends = np.cumsum(per_text)
    out_starts = out_ends - per_text
    place = np.arange(total) - np.repeat(out_starts, per_text) + np.repeat(starts, per_text)
    values = rolling[place]
    for t in np.flatnonzero((counts > 0) & (counts < k)):
        n = counts[t]
        own = hashes[starts[t]: ends[t]]
        values[out_starts[t]] = (own * factors[:n]).sum(dtype=np.uint64) + np.uint64(n)
    values = mix(values)
    for t in range(texts):
        values[out_starts[t]: out_ends[t]].sort()
    keep = np.empty(total, bool)
    keep[0] = True
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    keep[out_starts[per_text > 0]] = True
    sizes = np.zeros(texts, np.int64)
    full = np.flatnonzero(per_text > 0)
    sizes[full] = np.add.reduceat(keep, out_starts[full])
    return values[keep], sizes
