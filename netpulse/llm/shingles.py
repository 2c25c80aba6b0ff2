"""Word-shingle sets and minwise signatures, computed for many texts at once with numpy."""

from __future__ import annotations

import numpy as np

WIDTH = 5
COORDINATES = 64
# Bytes of text worked on together: intermediate arrays take some ten times as much.
CHUNK_BYTES = 1 << 21

_rng = np.random.default_rng(20240501)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_JOIN = np.uint64(0xC2B2AE3D27D4EB4F)
_XOR = _rng.integers(0, 2**63, COORDINATES, dtype=np.uint64)
_MULTIPLY = _rng.integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i up to n."""
    if not _powers or len(_powers["up"]) <= n:
        size = max(n + 1, CHUNK_BYTES + (1 << 16))
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(values, counts): the distinct shingle hashes of each text, ascending, one text after the other.

    Words are runs of bytes other than white space, with A-Z lowered; shingles are
    ``WIDTH`` words in a row; a text of fewer words is one shingle, one without
    words has none.
    """
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    text_starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])[:-1]]).astype(np.int64)
    space = _SPACE[raw]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edges = np.concatenate([[0], edges])
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    up, down = power_tables(len(raw))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[raw] * up[: len(raw)], dtype=np.uint64)])
    words = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    owner = np.searchsorted(text_starts, starts, side="right") - 1
    n_words = np.bincount(owner, minlength=len(texts))

    m = len(words) - WIDTH + 1
    if m > 0:
        joined = words[:m].copy()
        for k in range(1, WIDTH):
            joined = joined * _JOIN + words[k : m + k]
        whole = owner[:m] == owner[WIDTH - 1 :]
        values, of = mixed(joined[whole]), owner[:m][whole]
    else:
        values, of = np.empty(0, np.uint64), np.empty(0, np.int64)
    short = np.flatnonzero((n_words > 0) & (n_words < WIDTH))
    if len(short):
        first = np.concatenate([[0], np.cumsum(n_words)])[short]
        extra = np.zeros(len(short), np.uint64)
        for k in range(WIDTH - 1):
            has = n_words[short] > k
            extra[has] = extra[has] * _JOIN + words[first[has] + k]
        values = np.concatenate([values, mixed(extra ^ n_words[short].astype(np.uint64))])
        of = np.concatenate([of, short])
    order = np.lexsort((values, of))
    values, of = values[order], of[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
    return values[fresh], np.bincount(of[fresh], minlength=len(texts))


def chunked(texts: list[bytes]):
    """Consecutive slices of ``texts`` of about ``CHUNK_BYTES``; a longer text stands alone."""
    at, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > CHUNK_BYTES:
            yield texts[at:i]
            at, held = i, 0
        held += len(t) + 1
    if at < len(texts):
        yield texts[at:]


def summaries(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Per text: set size, two 64-bit fingerprints of the set, and its minwise values (32 bits each, as bytes)."""
    sizes, first, second, signatures = [], [], [], []
    for part in chunked(texts):
        values, counts = shingle_sets(part)
        filled = np.flatnonzero(counts)
        starts = (np.cumsum(counts) - counts)[filled]
        a, b = np.zeros(len(part), np.uint64), np.zeros(len(part), np.uint64)
        least = np.zeros((len(part), COORDINATES), np.uint32)
        if len(filled):
            a[filled] = np.add.reduceat(mixed(values + _XOR[0]), starts)
            b[filled] = np.add.reduceat(mixed(values ^ _XOR[1]), starts)
            for j in range(COORDINATES):
                least[filled, j] = np.minimum.reduceat((values ^ _XOR[j]) * _MULTIPLY[j], starts) >> np.uint64(32)
        sizes.append(counts)
        first.append(a.view(np.int64))
        second.append(b.view(np.int64))
        signatures += [row.tobytes() for row in least]
    if not sizes:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), []
    return np.concatenate(sizes), np.concatenate(first), np.concatenate(second), signatures
