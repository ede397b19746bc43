"""Word hashes of many texts at once, with numpy.

A word is a run of bytes other than space and 0x09-0x0D. Its hash is a 64-bit
polynomial over per-byte random numbers, taken from running sums, so no Python
object is made per word.
"""

from __future__ import annotations

import numpy as np

SEED = 20240501
_rng = np.random.default_rng(SEED)
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_tables = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
#: Bytes hashed in one go; longer texts are cut between words.
PIECE = 1 << 20


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables["up"]) < n:
        size = max(n, 2 * len(_tables["up"]))
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _tables[key] = np.multiply.accumulate(steps)
    return _tables["up"], _tables["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _piece(data: np.ndarray, spaces: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    space = spaces[data]
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, ends = edge[::2], edge[1::2]
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return hashes, starts, ends


def word_hashes(text: bytes, spaces: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start byte, end byte) of every word, in order.

    ``spaces`` says for each byte whether it parts words.
    """
    data = np.frombuffer(text, np.uint8)
    if len(data) <= PIECE:
        return _piece(data, spaces)
    parts, at = [], 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data) and not spaces[data[end]]:
            rest = np.flatnonzero(spaces[data[end : end + PIECE]])
            end = end + int(rest[0]) if len(rest) else min(end + PIECE, len(data))
        h, s, e = _piece(data[at:end], spaces)
        parts.append((h, s + at, e + at))
        at = end
    return tuple(np.concatenate(x) for x in zip(*parts))  # type: ignore[return-value]


def batch_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts: hashes, starts, ends (in the joined bytes) and the
    position of each text's first word, with the total at the end."""
    joined = b"\n".join(texts)
    hashes, starts, ends = word_hashes(joined)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    begins = np.concatenate([[0], np.cumsum(sizes)])
    return hashes, starts, ends, np.searchsorted(starts, begins)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on (the last n - 1 have none)."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    out = mix(hashes[:size] + np.uint64(n))
    for k in range(1, n):
        out = (out ^ hashes[k : k + size]) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return mix(out)
