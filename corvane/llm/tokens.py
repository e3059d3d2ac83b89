"""Byte-level BPE over whole batches: pre-tokens by numpy, each distinct pre-token encoded once.

The ids are those of ``tokenizers`` with the given file; a special token that a text spells is
one id there.  Tests compare both.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np

from corvane.llm.words import MULTIPLIER, mixed

# The pre-token pattern of this tokenizer file, and the White_Space code points.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACES = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
          0x205F, 0x3000]

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
LONG = 48
"""Longer pre-tokens are encoded without the table."""
_POWERS = np.array([pow(MULTIPLIER, i + 1, 1 << 64) for i in range(LONG)], np.uint64)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _classes() -> np.ndarray:
    kinds = np.full(0x110000, OTHER, np.uint8)
    of = {"L": LETTER, "N": NUMBER}
    for point in range(0x110000):
        kinds[point] = of.get(unicodedata.category(chr(point))[0], OTHER)
    kinds[SPACES] = SPACE
    return kinds


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Pre-tokens and ids of texts.  One per Python worker and file, see ``encoder``."""

    def __init__(self, path: str, cache: int = 1_000_000):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = _byte_alphabet()
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(alphabet[c] for c in word): i for word, i in spec["model"]["vocab"].items()
                 if word not in self.special}
        self.bpe = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.widths = np.zeros(max(ranks.values()) + 1, np.int64)  # bytes of each id
        for word, i in ranks.items():
            self.widths[i] = len(word)
        self.kinds = _classes()
        self.cache = cache
        self._forget()

    def _forget(self) -> None:
        self.keys = np.empty(0, np.uint64)  # sorted hashes of known pre-tokens, and their entries
        self.entries = np.empty(0, np.int32)
        self.lengths = np.empty(0, np.int32)
        self.starts = np.empty(0, np.int32)
        self.flat = np.empty(0, np.uint16 if len(self.widths) <= 1 << 16 else np.uint32)

    def _add(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Entries for pre-tokens of these ids."""
        first = len(self.lengths)
        self.starts = np.append(self.starts, (len(self.flat) + np.cumsum(lengths) - lengths).astype(np.int32))
        self.lengths = np.append(self.lengths, lengths.astype(np.int32))
        self.flat = np.append(self.flat, ids.astype(self.flat.dtype))
        return np.arange(first, len(self.lengths), dtype=np.int32)

    def cuts(self, points: np.ndarray, firsts: np.ndarray | None = None) -> np.ndarray:
        """Where pre-tokens begin.  ``firsts``: where texts begin, if there are several."""
        n = len(points)
        if not n:
            return np.empty(0, np.int64)
        kinds = self.kinds[points]
        new = np.ones(n, bool)
        new[1:] = kinds[1:] != kinds[:-1]
        ends_text = np.zeros(n, bool)  # the last code point of a text
        ends_text[-1] = True
        if firsts is not None:
            new[firsts] = True
            ends_text[firsts[firsts > 0] - 1] = True
        space = kinds == SPACE
        last = np.ones(n, bool)  # of a run
        last[:-1] = new[1:]
        last_space = space & last & ~ends_text  # something else follows
        begins = new | last_space
        prefix = np.flatnonzero(last_space & (points == 0x20))
        begins[prefix + 1] = False
        lone = np.flatnonzero((points == 0x27) & new & last & begins & ~ends_text)
        if len(lone):  # an apostrophe on its own that starts a pre-token
            lone = lone[kinds[lone + 1] == LETTER]
            padded = np.concatenate([points, [0, 0]])
            same = np.concatenate([~new, [False, False]])
            one, two = padded[lone + 1], padded[lone + 2]
            single = np.isin(one, [ord(c) for c in "stmd"])
            double = same[lone + 2] & (((one == ord("r")) & (two == ord("e")))
                                       | ((one == ord("v")) & (two == ord("e")))
                                       | ((one == ord("l")) & (two == ord("l"))))
            for at, width in ((lone[single], 2), (lone[double], 3)):
                begins[at + 1] = False
                after = at + width
                after = after[after < n]
                begins[after] = True
                # a space run that begins there keeps its own rule
        return np.flatnonzero(begins)

    def slots(self, points: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """The table entry of each pre-token."""
        if len(self.lengths) > self.cache:
            self._forget()
        if not len(cuts):
            return np.empty(0, np.int64)
        widths = np.diff(np.append(cuts, len(points)))
        place = np.arange(len(points)) - np.repeat(cuts, widths)
        values = (points.astype(np.uint64) + np.uint64(1)) * _POWERS[np.minimum(place, LONG - 1)]
        hashes = mixed(np.add.reduceat(values, cuts) + widths.astype(np.uint64))
        distinct, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        slots = np.full(len(distinct), -1, np.int32)
        if len(self.keys):
            found = np.minimum(np.searchsorted(self.keys, distinct), len(self.keys) - 1)
            slots = np.where(self.keys[found] == distinct, self.entries[found], slots)
        short = widths[at] <= LONG
        new = np.flatnonzero((slots < 0) & short)
        first = cuts[at[new]]
        joins = (points[first] == 0x20) & (widths[at[new]] > 1)
        joins &= self.kinds[points[np.minimum(first + 1, len(points) - 1)]] == LETTER
        for part, together in ((new[joins], True), (new[~joins], False)):
            slots[part] = self._learn([_text(points, cuts[i], widths[i]) for i in at[part]], together)
        self.entries = np.insert(self.entries, where := np.searchsorted(self.keys, distinct[new]), slots[new])
        self.keys = np.insert(self.keys, where, distinct[new])
        out = slots[back]
        rest = np.flatnonzero((out < 0) | (widths > LONG))
        out[rest] = self._learn([_text(points, cuts[i], widths[i]) for i in rest], False)
        return out

    def _learn(self, words: list[str], together: bool) -> np.ndarray:
        """Entries for pre-tokens.  Those of a space and letters stay apart when they are joined."""
        if not words:
            return np.empty(0, np.int32)
        if together:
            ids = np.array(self.bpe.encode_ordinary("".join(words)), np.int64)
            ends = np.cumsum([len(w.encode("utf-8", "surrogatepass")) for w in words])
            last = np.searchsorted(np.cumsum(self.widths[ids]), ends) + 1
            return self._add(ids, np.diff(last, prepend=0))
        found = [self.bpe.encode_ordinary(w) for w in words]
        return self._add(np.array([i for ids in found for i in ids], np.int64), np.array([len(f) for f in found], np.int64))

    def ids(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each pre-token has."""
        lengths = self.lengths[slots].astype(np.int64)
        total = int(lengths.sum())
        before = np.cumsum(lengths) - lengths
        return self.flat[np.arange(total) + np.repeat(self.starts[slots] - before, lengths)].astype(np.uint32), lengths

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and where each text's ids begin (one entry more than texts)."""
        if not any(word in text for text in texts for word in self.special):
            return self._encode_ordinary(texts)
        between = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        split = [between.split(text) for text in texts]  # odd places hold special tokens
        flat, begins = self._encode_ordinary([part for parts in split for part in parts[::2]])
        ids, starts, total, k = [], [0], 0, 0
        for parts in split:
            for j, part in enumerate(parts):
                if j % 2:
                    ids.append(np.array([self.special[part]], np.uint32))
                else:
                    ids.append(flat[begins[k]:begins[k + 1]])
                    k += 1
                total += len(ids[-1])
            starts.append(total)
        return np.concatenate(ids), np.array(starts)

    def _encode_ordinary(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        points, firsts = code_points(texts)
        cuts = self.cuts(points, firsts[firsts < len(points)])
        flat, lengths = self.ids(self.slots(points, cuts))
        before = np.concatenate(([0], np.cumsum(lengths)))
        return flat, before[np.searchsorted(cuts, np.append(firsts, len(points)))]


def _text(points: np.ndarray, start: int, width: int) -> str:
    return points[start:start + width].tobytes().decode("utf-32-le", "surrogatepass")


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, and where each text begins."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) for t in texts], np.int64)
    return points, np.cumsum(sizes) - sizes


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of this file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
