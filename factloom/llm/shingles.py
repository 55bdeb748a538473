"""Hashed word-shingle sets of whole texts, many texts at a time in numpy."""

from __future__ import annotations

import numpy as np

_MUL = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MUL, -1, 1 << 64)
KEPT = 1 << 20  # bytes looked at together, unless one text is longer
_POWERS: list[np.ndarray] = []
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, np.int64).astype(np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _POWERS and len(_POWERS[0]) >= n:
        return _POWERS[0], _POWERS[1]
    size = max(n, KEPT)
    with np.errstate(over="ignore"):
        made = [np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, base, np.uint64), dtype=np.uint64)]) for base in (_MUL, _INVERSE)]
    if size == KEPT:  # longer ones are made for one text and go with it
        _POWERS[:] = made
    return made[0], made[1]


def mixed(z: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser over uint64."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word (A-Z lowered; words end at ASCII white space), and where each text's words begin."""
    joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    space = _SPACE[joined]
    before = np.concatenate([[True], space[:-1]])
    begin, end = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
    up, down = _powers(len(joined))
    with np.errstate(over="ignore"):
        running = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[_LOWER[joined]] * up[: len(joined)], dtype=np.uint64)])
        words = mixed((running[end] - running[begin]) * down[begin] + (end - begin).astype(np.uint64))
    starts = np.cumsum([0] + [len(t) + 1 for t in texts])
    return words, np.searchsorted(begin, starts)


def shingle_sets(texts: list[bytes], width: int = 3) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's shingles of ``width`` words; of all its words, if they are fewer."""
    words, starts = word_hashes(texts)
    with np.errstate(over="ignore"):
        total = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for k in range(width):
            total = mixed(total * np.uint64(0xD1342543DE82EF95) + words[k : len(words) - width + 1 + k])
        out = []
        for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            if hi - lo >= width:
                out.append(np.unique(total[lo : hi - width + 1]))
            elif hi > lo:
                h = np.full(1, hi - lo, np.uint64)
                for w in words[lo:hi]:
                    h = mixed(h * np.uint64(0xA0761D6478BD642F) + w)
                out.append(h)
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def slices(sizes: list[int]):
    """(from, to) of runs of rows whose sizes come to KEPT at most, or of one row."""
    at, held = 0, 0
    for i, size in enumerate(sizes):
        if i > at and held + size + 1 > KEPT:
            yield at, i
            at, held = i, 0
        held += size + 1
    if at < len(sizes):
        yield at, len(sizes)


def set_identity(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set (as two signed 64-bit numbers)."""
    with np.errstate(over="ignore"):
        a, b = mixed(hashes).sum(dtype=np.uint64), mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(np.int64(a.view(np.int64))), int(np.int64(b.view(np.int64)))
