"""Word-shingle sets of many texts at once, as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np

#: ASCII white space: what bytes.split() splits at.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_draw = np.random.default_rng(20)
#: Random words for hashing: one for each byte at each of 64 places in a word, multipliers for
#: what lies further on, and for the places of a shingle.
_BYTES = _draw.integers(0, 1 << 64, (64, 256), np.uint64)
_FAR = _draw.integers(0, 1 << 63, 1, np.uint64)[0] * np.uint64(2) + np.uint64(1)
_MIX = _draw.integers(0, 1 << 63, 3, np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * _MIX[0]
    x = (x ^ (x >> np.uint64(29))) * _MIX[1]
    return x ^ (x >> np.uint64(32))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and the number of words of each text."""
    whole = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[whole], [True]]).astype(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    firsts = np.cumsum([0] + [len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, firsts))
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    lengths = ends - starts
    kept = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
    place = kept - np.repeat(starts, lengths)
    value = _BYTES[place & 63, whole[kept]]
    far = place > 63
    if far.any():
        value[far] = mix(value[far] + (place[far] >> 6).astype(np.uint64) * _FAR)
    sums = np.add.reduceat(value, np.concatenate([[0], np.cumsum(lengths)[:-1]]))
    return mix(sums + lengths.astype(np.uint64)), counts


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text. A text with fewer words than ``size`` has
    one shingle of all its words; one without words has none."""
    words, counts = word_hashes(texts)
    runs = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        runs = mix(runs + words[k:len(words) - size + 1 + k]) if len(runs) else runs
    out, at = [], 0
    for n in counts.tolist():
        if n >= size:
            out.append(np.unique(runs[at:at + n - size + 1]))
        elif n:
            one = np.full(1, n, np.uint64)
            for w in words[at:at + n]:
                one = mix(one * _MIX[2] + w)
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def signature(hashes: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """For each seed the lowest 16 bits of the smallest re-hashed value (b-bit minwise hash)."""
    out = np.empty(len(seeds), np.uint64)
    if len(hashes) <= 2048:
        out[:] = ((hashes[None, :] ^ seeds[:, :1]) * seeds[:, 1:]).min(axis=1)
    else:
        for i, (flip, times) in enumerate(seeds):
            out[i] = ((hashes ^ flip) * times).min()
    return (mix(out) & np.uint64(0xFFFF)).astype(np.uint16)


def make_seeds(n: int, seed: int = 8) -> np.ndarray:
    draw = np.random.default_rng(seed)
    return np.stack([draw.integers(0, 1 << 64, n, np.uint64),
                     draw.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)], axis=1)
