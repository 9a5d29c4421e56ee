"""Words of whole texts as byte spans, and their 64-bit hashes, for Arrow batches in numpy.

A word is a run of ASCII digits, ASCII letters and characters beyond ASCII; A-Z count as a-z. In UTF-8 such a run is a run
of the bytes kept by `FOLD`, so words are found without decoding, and the memory for a text is a small multiple of its bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Each byte as it stands in a word, 0 where it ends one.
FOLD = np.zeros(256, np.uint8)
for _b in (*b"0123456789abcdefghijklmnopqrstuvwxyz", *range(0x80, 0x100)):
    FOLD[_b] = _b
FOLD[65:91] = FOLD[97:123]

#: The five primes of xxHash64.
P1, P2, P3, P4, P5 = (
    np.uint64(p) for p in (
        11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261,
    )
)


@dataclass
class Words:
    """Words of a batch of texts: word i is `folded[starts[i]:ends[i]]` and belongs to text `row[i]`."""

    folded: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray


def find_words(texts: pa.Array) -> Words:
    """The words of every text in order; NULL has none."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or not len(texts) or offsets[0] == offsets[-1]:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint8), none, none, none)
    folded = FOLD[np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]]
    opens = (offsets - offsets[0])[:-1]
    inside = folded != 0
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    before[opens[opens < len(folded)]] = False  # a text's first byte follows nothing
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    after[-1] = False
    after[opens[opens > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(folded, starts, ends, np.searchsorted(opens, starts, "right") - 1)


def joined(words: Words, first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the words first..last with one space between neighbours of a text, and where each begins and ends there."""
    low, high = int(words.starts[first]), int(words.ends[last - 1])
    part = words.folded[low:high]
    inside = part != 0
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    place = np.cumsum(keep) - 1
    text = part[keep]
    text[text == 0] = 0x20
    return text, place[words.starts[first:last] - low], place[words.ends[first:last] - 1 - low] + 1


def lanes(data: np.ndarray) -> np.ndarray:
    """The little-endian 8 bytes that begin at each place; zeros follow the end."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    view = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(data) + 1,), (1,))
    return np.ascontiguousarray(view)


def _rotate(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotate(acc + lane * P2, 31) * P1


def xxh64(data: np.ndarray, lane: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """xxHash64 (seed 0) of the slices data[at:at+size]; `lane` is lanes(data). Very long slices are hashed one by one."""
    found = np.empty(len(at), np.uint64)
    order = np.argsort(-np.minimum(size, 1025).astype(np.int16), kind="stable")
    at, size = at[order], size[order]
    n_huge = int(np.count_nonzero(size > 1024))
    if n_huge:
        import xxhash

        for i in range(n_huge):
            found[order[i]] = xxhash.xxh64_intdigest(data[at[i] : at[i] + size[i]].tobytes())
        order, at, size = order[n_huge:], at[n_huge:], size[n_huge:]
    below = -size  # sizes fall, so the slices with a size of n or more are the first of all
    h = np.full(len(at), P5)
    n = int(np.searchsorted(below, -32, "right"))
    stripes = np.zeros(len(at), np.int64)
    if n:
        acc = [np.full(n, np.uint64(v)) for v in ((int(P1) + int(P2)) % 2**64, int(P2), 0, 2**64 - int(P1))]
        stripes[:n] = size[:n] // 32
        for k in range(int(stripes[0])):
            m = int(np.searchsorted(below, -32 * (k + 1), "right"))
            for i in range(4):
                acc[i][:m] = _round(acc[i][:m], lane[at[:m] + (32 * k + 8 * i)])
        merged = _rotate(acc[0], 1) + _rotate(acc[1], 7) + _rotate(acc[2], 12) + _rotate(acc[3], 18)
        for a in acc:
            merged = (merged ^ _round(np.zeros(n, np.uint64), a)) * P1 + P4
        h[:n] = merged
    h += size.astype(np.uint64)
    place, rest = at + 32 * stripes, size - 32 * stripes
    for _ in range(3):
        rows = np.flatnonzero(rest >= 8)
        h[rows] = _rotate(h[rows] ^ _round(np.zeros(len(rows), np.uint64), lane[place[rows]]), 27) * P1 + P4
        place[rows] += 8
        rest[rows] -= 8
    rows = np.flatnonzero(rest >= 4)
    h[rows] = _rotate(h[rows] ^ ((lane[place[rows]] & np.uint64(0xFFFFFFFF)) * P1), 23) * P2 + P3
    place[rows] += 4
    rest[rows] -= 4
    for _ in range(3):
        rows = np.flatnonzero(rest >= 1)
        h[rows] = _rotate(h[rows] ^ (data[place[rows]].astype(np.uint64) * P5), 11) * P1
        place[rows] += 1
        rest[rows] -= 1
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    found[order] = h ^ (h >> np.uint64(32))
    return found


def same_bytes(lane: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the slices that begin at a and at b, of one size per pair, are equal byte by byte."""
    short = np.minimum(size, 8).astype(np.uint64)
    equal = ((lane[a] ^ lane[b]) << (np.uint64(64) - np.uint64(8) * short)) == 0
    rows = np.flatnonzero(equal & (size > 8))
    step = 8
    while len(rows):
        place = np.minimum(step, size[rows] - 8)  # the last lane may overlap the one before
        differ = lane[a[rows] + place] != lane[b[rows] + place]
        equal[rows[differ]] = False
        step += 8
        rows = rows[~differ & (size[rows] > step)]
    return equal
