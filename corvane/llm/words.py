"""Hashes of words and shingles for whole batches of texts, with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

MULTIPLIER = 0x9E3779B97F4A7C15
MIX = np.uint64(0xBF58476D1CE4E5B9)
PIECE = 1 << 22
"""A text beyond this many bytes is hashed in pieces that are cut between words."""

WHITE_SPACE = np.zeros(256, bool)
WHITE_SPACE[[9, 10, 11, 12, 13, 32]] = True
NOT_ALNUM = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
_POWERS = np.array([pow(MULTIPLIER, i + 1, 1 << 64) for i in range(4096)], np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * MIX
    return h ^ (h >> np.uint64(29))


def _pieces(data: bytes, separators: np.ndarray) -> Iterator[bytes]:
    start = 0
    while len(data) - start > PIECE:
        window = separators[np.frombuffer(data, np.uint8, PIECE, start)]
        cuts = np.flatnonzero(window)
        if len(cuts):
            end = start + int(cuts[-1]) + 1
        else:  # one word longer than a piece: up to its end
            rest = np.flatnonzero(separators[np.frombuffer(data, np.uint8, -1, start + PIECE)])
            end = start + PIECE + int(rest[0]) + 1 if len(rest) else len(data)
        yield data[start:end]
        start = end
    yield data[start:]


def _hash_piece(data: bytes, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word."""
    raw = np.frombuffer(data, np.uint8)
    inside = ~separators[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at = np.flatnonzero(first)
    if not len(at):
        return np.empty(0, np.uint64), at
    letters = raw[inside].astype(np.uint64) + np.uint64(1)
    words = np.cumsum(inside)[at] - 1  # place of each word's first byte among the letters
    place = np.arange(len(letters)) - np.repeat(words, np.diff(np.append(words, len(letters))))
    letters *= _POWERS[place & 4095]
    if place.max() > 4095:
        letters *= ((place >> 12) * 2 + 1).astype(np.uint64)
    return mixed(np.add.reduceat(letters, words)), at


def word_hashes(texts: list[str | None], separators: np.ndarray = WHITE_SPACE,
                lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and where each text's words begin.

    The second array has one entry more than there are texts.  A null text has no word.
    """
    raw = [(t or "") for t in texts]
    raw = [(t.lower() if lower else t).encode("utf-8", "surrogatepass") for t in raw]
    ends = np.cumsum([len(r) + 1 for r in raw])
    hashes, firsts, start = [], [], 0
    for piece in _pieces(b"\n".join(raw), separators):
        h, at = _hash_piece(piece, separators)
        hashes.append(h)
        firsts.append(at + start)
        start += len(piece)
    offsets = np.searchsorted(np.concatenate(firsts), ends)
    return np.concatenate(hashes), np.concatenate(([0], offsets)).astype(np.int64)


def shingles(texts: list[str | None], size: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's runs of ``size`` words.

    Words are lower-cased and parted by white space.  A text of fewer words is one shingle, a text
    without words has none.
    """
    words, offsets = word_hashes(texts)
    if len(words) >= size:
        runs = np.zeros(len(words) - size + 1, np.uint64)
        for k in range(size):
            runs = runs * np.uint64(MULTIPLIER) + words[k:len(words) - size + 1 + k]
        runs = mixed(runs)
    out = []
    for a, b in zip(offsets[:-1], offsets[1:]):
        if b - a >= size:
            out.append(np.unique(runs[a:b - size + 1]))
        elif b > a:
            one = np.array([b - a], np.uint64)
            for k in range(a, b):
                one = one * np.uint64(MULTIPLIER) + words[k]
            out.append(mixed(one))
        else:
            out.append(np.empty(0, np.uint64))
    return out
