"""Distinct cuts of many texts at once, for tokenizers whose pattern is
``'s|...| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.

No match of that pattern crosses the places cut here: before a white space run, before the
run's last character if a word follows, before a word unless one space precedes it, and
between an ASCII letter and ASCII punctuation other than the apostrophe. A text's tokens are therefore those of its cuts one after another, and each distinct cut needs
encoding only once.
"""

from __future__ import annotations

import numpy as np

from skein.llm.common import word_names

_ASCII = np.zeros(256, bool)
_ASCII[[0x20, 9, 10, 11, 12, 13]] = True
# 1: letter, 2: punctuation but the apostrophe, 0: anything else.
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = 2


def _wide_spaces(data: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(width, places) of the white space characters beyond ASCII, in UTF-8."""
    n, out = len(data), []
    at = np.flatnonzero(data[:-1] == 0xC2) if n > 1 else np.zeros(0, np.int64)
    out.append((2, at[(data[at + 1] == 0x85) | (data[at + 1] == 0xA0)]))
    at = np.flatnonzero((data[:-2] >= 0xE1) & (data[:-2] <= 0xE3)) if n > 2 else np.zeros(0, np.int64)
    code = data[at].astype(np.int64) << 16 | data[at + 1].astype(np.int64) << 8 | data[at + 2]
    known = [0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080]
    out.append((3, at[np.isin(code, known)]))
    return out


def cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start of every cut, first cut of each document and the number of cuts)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    plain = _ASCII[data]
    space, wide = plain.copy(), _wide_spaces(data)
    for width, at in wide:
        for j in range(width):
            space[at + j] = True
    heads = offsets[:-1][np.diff(offsets) > 0]
    last = np.zeros(n + 1, bool)  # bytes after which a document ends
    last[np.append(heads[1:] - 1, n - 1)] = True
    word_next = np.zeros(n + 1, bool)
    word_next[:n - 1] = ~space[1:]
    word_next &= ~last
    cut = np.zeros(n, bool)
    cut[1:] = space[1:] & ~space[:-1] | ~space[1:] & space[:-1] & (data[:-1] != 0x20)
    cut |= plain & word_next[:n]
    kind = _KIND[data]
    cut[1:] |= kind[1:] + kind[:-1] == 3
    for width, at in wide:
        cut[at[word_next[at + width - 1]]] = True
    cut[heads] = True
    starts = np.flatnonzero(cut)
    return starts, np.searchsorted(starts, offsets)


def distinct(data: np.ndarray, starts: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """(the distinct cuts, the number of its distinct cut for every cut)."""
    if len(starts) == 0:
        return [], np.zeros(0, np.int64)
    stops = np.append(starts[1:], len(data))
    _, one, which = np.unique(word_names(data, starts, stops, 3), return_index=True, return_inverse=True)
    size, like = stops - starts, one[which]
    raw = data.tobytes()
    same = np.array_equal(size, size[like])
    if same:  # names are hashes: hold every cut against the one it is taken for
        first = np.cumsum(size) - size
        shift = np.repeat(starts[like] - first, size)
        same = np.array_equal(data, data[shift + np.arange(len(data))])
    if not same:
        found: dict[bytes, int] = {}
        which = np.array([found.setdefault(raw[a:b], len(found)) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)])
        return list(found), which
    return [raw[a:b] for a, b in zip(starts[one].tolist(), stops[one].tolist(), strict=True)], which


def spell(coded: list[bytes], which: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all documents, offsets) from the ids of the distinct cuts (32-bit packed)."""
    size = np.fromiter((len(x) // 4 for x in coded), np.int64, len(coded))
    flat = np.frombuffer(b"".join(coded), "<u4")
    begin = np.cumsum(size) - size
    n = size[which]
    total = np.concatenate([[0], np.cumsum(n)])
    ids = flat[np.repeat(begin[which] - total[:-1], n) + np.arange(int(total[-1]))]
    return ids, total[first]


class Recent:
    """A bounded map of two generations: entries that are met again survive."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def missing(self, keys: list[bytes]) -> list[bytes]:
        young, old, out = self.young, self.old, []
        for k in keys:
            if k not in young:
                if k in old:
                    young[k] = old[k]
                else:
                    out.append(k)
        return out

    def values(self, keys: list[bytes], new: dict[bytes, bytes]) -> list[bytes]:
        """Values of all keys, those of ``new`` added; then the older generation may go."""
        self.young.update(new)
        young = self.young
        out = [young[k] for k in keys]
        if len(young) > self.limit:
            self.old, self.young = young, {}
        return out
