"""Hashes of words, many at a time and without anything kept between calls."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import xxhash

# Bytes beyond which words are hashed one by one.
LONG_WORD = 256
_WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_STREAMS = ((np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA5A5A5A5A5A5A5A5)),
            (np.uint64(0xCA5A826395121157), np.uint64(0x5851F42D4C957F2D)))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def joined(left: np.ndarray, right: np.ndarray, stream: int = 0) -> np.ndarray:
    """Hashes of two neighbours made one; the two streams are independent of each other."""
    multiply, shift = _STREAMS[stream]
    return mixed(left * multiply + mixed(right ^ shift))


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash pairs of all words of the texts, one after another, and the number of words of each text.

    Words are runs of bytes other than 20 and 09 to 0D. Eight bytes of all words are taken at a time.
    """
    raw = np.frombuffer(b"\n".join(texts) + b"\n" * 8, np.uint8)
    edges = np.flatnonzero(np.diff(_WHITE[raw], prepend=True))
    starts, sizes = edges[::2], np.diff(edges)[::2]
    ends = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))
    words = np.diff(np.searchsorted(starts, ends), prepend=0)
    eights = np.ndarray((len(raw) - 7,), "<u8", raw.tobytes(), strides=(1,))
    hashes = np.zeros((len(starts), 2), np.uint64)
    hashes[:] = sizes.astype(np.uint64)[:, None]
    for word in np.flatnonzero(sizes > LONG_WORD).tolist():
        digest = xxhash.xxh3_128_digest(raw[starts[word]:starts[word] + sizes[word]])
        hashes[word] = np.frombuffer(digest, np.uint64)
    left = np.flatnonzero(sizes <= LONG_WORD)
    for at in range(0, int(sizes[left].max(initial=0)), 8):
        left = left[sizes[left] > at]
        # What lies beyond the word's end is cut off.
        beyond = np.maximum(8 - (sizes[left] - at), 0).astype(np.uint64) * np.uint64(8)
        taken = eights[starts[left] + at] << beyond
        for stream in (0, 1):
            hashes[left, stream] = joined(hashes[left, stream], taken, stream)
    return hashes, words
