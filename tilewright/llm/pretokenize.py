"""The cutting of texts into pieces for whole batches, in arrays.

Gives what the pattern in vocab.PIECE gives: runs of letters, of numbers and of other characters, each with
one space before it if there is one; contractions after an apostrophe that begins a piece; and runs of
white space, of which the last character stands apart (as the space of the next piece, or alone) where
something follows."""

from __future__ import annotations

import functools
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex

WHITE, LETTER, NUMBER, OTHER = range(4)

#: Bytes of the longest piece that two words hold; longer ones are numbered one by one.
SHORT = 16

#: Of a word, the first k bytes; fixed multipliers of the hash.
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_MIX, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


@functools.lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of each code point, as the pattern's own properties have it."""
    points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)])
    every, table = "".join(map(chr, points.tolist())), np.full(0x110000, OTHER, np.uint8)
    for k, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, r"\s+")):
        for m in regex.finditer(pattern, every):
            table[points[m.start() : m.end()]] = k
    return table


def starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether a piece begins at each code point; first: whether a text begins there."""
    n = len(points)
    kind = classes()[points]
    start = first.copy()
    if n:
        start[0] = True
    start[1:] |= kind[1:] != kind[:-1]
    begins = np.flatnonzero((kind[1:] != WHITE) & (kind[:-1] == WHITE) & ~first[1:]) + 1
    before = begins - 1
    start[begins[points[before] == 0x20]] = False  # the space belongs to the piece
    start[before] = True
    # Contractions: an apostrophe that begins a piece, and one or two letters after it in the same text.
    quote = np.flatnonzero(start & (points == 0x27))
    padded = np.append(points, [0, 0, 0])
    fresh = np.append(first, [True, True, True])
    one, two = padded[quote + 1], padded[quote + 2]
    inside = ~fresh[quote + 1]
    short = inside & np.isin(one, [ord(c) for c in "stmd"])
    long = inside & ~short & ~fresh[quote + 2] & (((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l"))))
    out = np.append(start, [False, False, False])
    out[quote[short] + 1] = False
    out[quote[short] + 2] = True
    out[quote[long] + 1] = False
    out[quote[long] + 3] = True
    return out[:n]


class Pieces(NamedTuple):
    """All texts' bytes in a row, where each piece begins, its size, and where each text's pieces end."""

    data: bytes
    low: np.ndarray
    size: np.ndarray
    cuts: np.ndarray

    def of(self, at: np.ndarray) -> list[bytes]:
        low = self.low[at]
        return [self.data[a:b] for a, b in zip(low.tolist(), (low + self.size[at]).tolist())]


def cut(texts: list[str]) -> Pieces:
    whole = "".join(texts)
    data = whole.encode()
    points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths)
    first = np.zeros(len(points), bool)
    first[(ends - lengths)[lengths > 0]] = True
    at = np.flatnonzero(starts(points, first))
    cuts = np.searchsorted(at, ends)
    if len(data) == len(points):
        low = at
    else:
        width = np.ones(len(points), np.uint8)
        for least in (0x80, 0x800, 0x10000):
            width += points >= least
        low = (np.cumsum(width, dtype=np.int64) - width)[at]
    return Pieces(data, low, np.diff(np.append(low, len(data))), cuts)


def names(p: Pieces, long: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Three numbers for each piece, equal for equal pieces only: up to SHORT bytes its bytes as two words and its
    size; beyond that its number in `long` (where new ones are added), 0 and 0."""
    words = np.frombuffer(p.data + bytes(32 - len(p.data) % 8), "<u8")
    at, bits = p.low >> 3, ((p.low & 7) << 3).astype(np.uint64)
    a, b, c = words[at], words[at + 1], words[at + 2]
    back = np.uint64(63) - bits
    one = (a >> bits) | ((b << np.uint64(1)) << back)
    two = (b >> bits) | ((c << np.uint64(1)) << back)
    one &= _MASKS[np.minimum(p.size, 8)]
    two &= _MASKS[np.clip(p.size - 8, 0, 8)]
    size = np.where(p.size <= SHORT, p.size, 0).astype(np.uint8)
    far = np.flatnonzero(size == 0)
    if len(far):
        one[far] = [long.setdefault(x, len(long)) for x in p.of(far)]
        two[far] = 0
    return one, two, size


def keys_of(one: np.ndarray, two: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of each piece's three numbers."""
    h = (one ^ (size * _STEP)) * _MIX
    h ^= h >> np.uint64(32)
    h ^= two * _STEP
    h *= _MIX
    h ^= h >> np.uint64(29)
    return h


def distinct(keys: np.ndarray, *named: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, which): the first place of each different piece, and which of them stands at each place.  The hashes
    are checked; where two pieces share one, all are sorted instead."""
    coded = pa.array(keys).dictionary_encode()
    which = coded.indices.to_numpy().astype(np.int64)
    first = np.empty(len(coded.dictionary), np.int64)
    first[which[::-1]] = np.arange(len(keys))[::-1]
    if all((x[first][which] == x).all() for x in named):
        return first, which
    order = np.lexsort(named)
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([x[order[1:]] != x[order[:-1]] for x in named])
    which[order] = np.cumsum(new) - 1
    return order[new], which


def distinct_pieces(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(pieces, which, cuts): the different pieces of all texts, which of them stands at each place, and where
    each text's places end."""
    p = cut(texts)
    named = names(p, {})
    first, which = distinct(keys_of(*named), *named)
    return [x.decode() for x in p.of(first)], which, p.cuts
