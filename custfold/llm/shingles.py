"""Word shingles of whole texts as 64-bit hashes, vectorised with numpy.

Words are those of ``common.WORD`` with A-Z lowered: in UTF-8 the ASCII
digits and letters and every byte from 0x80 on.  A text of fewer words than a
shingle, but not none, has one shingle of all its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SIZE = 5
SEGMENT = 1 << 22  # bytes hashed at once

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[0x30:0x3A] = _IS_WORD[0x41:0x5B] = _IS_WORD[0x61:0x7B] = _IS_WORD[0x80:] = True
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(int(_RNG.integers(0, 1 << 62)) * 2 + 1)
_PLACE = _RNG.integers(0, 1 << 63, SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_C1, _C2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S = [np.uint64(k) for k in (33, 29, 32)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> _S[0])
    x = x * _C1
    x = x ^ (x >> _S[1])
    x = x * _C2
    return x ^ (x >> _S[2])


def _word_hashes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start positions of the words in a run of bytes."""
    inside = _IS_WORD[buf]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    lengths = ends - starts
    at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    power = np.cumprod(np.full(lengths.max(), _BASE, dtype=np.uint64))
    values = _BYTE[_LOWER[buf[inside]]] * power[at]
    return mix(np.add.reduceat(values, np.cumsum(lengths) - lengths)), starts


def words_by_text(texts: list[str]) -> Iterator[np.ndarray]:
    """Word hashes of each text; many short texts are hashed in one go."""
    group: list[bytes] = []
    size = 0

    def flush() -> Iterator[np.ndarray]:
        if group:
            hashes, starts = _word_hashes(np.frombuffer(b"\0".join(group), np.uint8))
            ends = np.cumsum([len(g) + 1 for g in group])
            yield from np.split(hashes, np.searchsorted(starts, ends[:-1]))
            group.clear()

    for t in texts:
        raw = t.encode("utf-8", "surrogatepass")
        if len(raw) > SEGMENT:
            yield from flush()
            size = 0
            buf, parts, lo = np.frombuffer(raw, np.uint8), [], 0
            while lo < len(buf):
                hi = min(len(buf), lo + SEGMENT)
                if hi < len(buf):  # cut where no word is cut
                    gap = np.flatnonzero(~_IS_WORD[buf[lo:hi]])
                    hi = lo + int(gap[-1]) + 1 if len(gap) else len(buf)
                parts.append(_word_hashes(buf[lo:hi])[0])
                lo = hi
            yield np.concatenate(parts)
            continue
        if size + len(raw) > SEGMENT:
            yield from flush()
            size = 0
        group.append(raw)
        size += len(raw) + 1
    yield from flush()


def shingle_set(words: np.ndarray, k: int = SIZE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles."""
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    if n < k:
        return mix(np.sum(words * _PLACE[:n], keepdims=True, dtype=np.uint64) + np.uint64(n))
    total = words[: n - k + 1] * _PLACE[0]
    for i in range(1, k):
        total = total + words[i: n - k + 1 + i] * _PLACE[i]
    return np.unique(mix(total))


def shingle_sets(texts: list[str]) -> Iterator[np.ndarray]:
    for words in words_by_text(texts):
        yield shingle_set(words)
