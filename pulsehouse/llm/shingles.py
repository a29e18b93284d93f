"""Word-shingle sets of whole texts, as sorted 64-bit hashes (numpy, a batch at a time).

Words are runs of bytes other than space and \\t \\n \\v \\f \\r of the UTF-8 text
with A-Z lower-cased. A shingle's hash is a sum of its words' hashes times
fixed odd numbers, finished by a mixer; equal hashes count as equal shingles
(two different ones agree with probability 2**-64).
"""
from __future__ import annotations

import numpy as np

K = 5
U = np.uint64
_RNG = np.random.default_rng(20_240_229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | U(1)
_STEP = U(0x5851F42D4C957F2D)
_PLACE = _RNG.integers(1, 2**63, K, dtype=np.uint64) | U(1)
_SHORT = _RNG.integers(1, 2**63, K, dtype=np.uint64) | U(1)
_INVERSE = U(pow(int(_STEP), -1, 2**64))
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(1 << 20, n)
        _POWERS[:] = [np.cumprod(np.append(U(1), np.full(size, b, np.uint64))) for b in (_STEP, _INVERSE)]
    return _POWERS[0], _POWERS[1]


def byte_sums(raw: np.ndarray) -> np.ndarray:
    """Sums from which :func:`string_hash` reads the hash of any substring."""
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _powers(len(raw) + 1)[0][:len(raw)], out=total[1:])
    return total


def string_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the substrings [start, end)."""
    return mix((sums[end] - sums[start]) * _powers(len(sums))[1][start])


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in order, number of words before each text)."""
    raw = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
    space = _SPACE[raw]
    start = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    end = np.flatnonzero(~space[:-1] & space[1:]) + 1
    words = string_hash(byte_sums(raw), start, end)
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts]) + 1
    return words, np.searchsorted(start, bounds)


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Per text its distinct shingles, sorted; empty for a text without words."""
    words, at = word_hashes([(t or "").encode("utf-8", "surrogatepass").lower() for t in texts])
    n = len(words) - K + 1
    rolled = np.zeros(max(0, n), np.uint64)
    for k in range(K if n > 0 else 0):
        rolled += words[k:k + n] * _PLACE[k]
    rolled = mix(rolled)
    out = []
    for a, z in zip(at[:-1].tolist(), at[1:].tolist()):
        if z - a >= K:
            s = np.sort(rolled[a:z - K + 1])
            out.append(s[np.append(True, s[1:] != s[:-1])])
        elif z > a:
            out.append(mix((words[a:z] * _SHORT[:z - a]).sum(dtype=np.uint64, keepdims=True) + U(z - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out
