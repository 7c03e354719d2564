"""Words of many texts at once, as positions and 64-bit hashes in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_BLANKS = [32, *range(9, 14)]


def byte_table(members: list[int] | range) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


#: Bytes of words that end only at ASCII white space.
NOT_BLANK = ~byte_table(_BLANKS)
#: Bytes of words of ASCII letters and digits and anything beyond ASCII.
ALNUM = byte_table([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])


def mixed(h: np.ndarray) -> np.ndarray:
    """The finalizer of murmur3: every bit of the input reaches every bit of the output."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


@dataclass
class Words:
    data: np.ndarray  # bytes of all texts
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray  # which text a word is of
    counts: np.ndarray  # words per text
    hashes: np.ndarray


def words(texts: list[bytes], member: np.ndarray) -> Words:
    """Runs of member bytes, none across two texts.  Equal words have equal hashes."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    inside = member[data]
    inside[np.cumsum(sizes) - 1] = False
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    starts, ends = edge[::2], edge[1::2]
    text = np.searchsorted(np.cumsum(sizes), starts, "right")
    if not len(starts):
        empty = np.zeros(0, np.uint64)
        return Words(data, starts, ends, text, np.zeros(len(texts), np.int64), empty)
    lengths = ends - starts
    power = np.cumprod(np.full(int(lengths.max()), _FACTOR, np.uint64))
    begin = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum())) - np.repeat(begin, lengths)
    value = (data[inside[:len(data)]].astype(np.uint64) + np.uint64(1)) * power[within]
    hashes = mixed(np.add.reduceat(value, begin))
    return Words(data, starts, ends, text, np.bincount(text, minlength=len(texts)), hashes)
