"""Sets of word shingles of texts: as sorted 64-bit hashes for search, and exact ones for confirmation."""

from __future__ import annotations

import numpy as np

from tallgrass.llm.common import LOWER, mix, pieces, text_buffer, word_hashes, word_spans

_ODD = np.random.default_rng(0x5417).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(column, k: int):
    """Of each text of an Arrow string column, in order: the sorted distinct hashes of its k-word shingles.

    A-Z count as a-z. A text of fewer than k words has one shingle, of all its words; one without words has none.
    """
    data, offsets = text_buffer(column)
    for i, j in pieces(offsets):
        lo, hi = offsets[i], offsets[j]
        starts, ends = word_spans(data[lo:hi], offsets[i : j + 1] - lo)
        words = word_hashes(data[lo:hi], starts, ends, lower=True)
        at = np.searchsorted(starts, offsets[i : j + 1] - lo)
        if len(words) >= k:
            whole = np.zeros(len(words) - k + 1, dtype=np.uint64)
            for x in range(k):
                whole += words[x : len(words) - k + 1 + x] * _ODD[x]
            whole = mix(whole)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if b - a >= k:
                yield np.unique(whole[a : b - k + 1])
            elif b > a:
                yield mix(np.atleast_1d((words[a:b] * _ODD[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)))
            else:
                yield np.zeros(0, dtype=np.uint64)


def normalised(column):
    """Of each text of an Arrow string column, in order: its words in lower case (A-Z), joined by single spaces, as bytes."""
    data, offsets = text_buffer(column)
    for i, j in pieces(offsets):
        part = data[offsets[i] : offsets[j]]
        bounds = offsets[i : j + 1] - offsets[i]
        starts, ends = word_spans(part, bounds)
        stay = np.zeros(len(part) + 1, dtype=np.int64)
        stay[starts] += 1
        stay[ends] -= 1
        stay = np.cumsum(stay[:-1]) > 0
        out = LOWER[part]
        out[~stay] = 0x20
        # Of what stands between two words of one text, the first byte stays; the pieces below lose what is before or after all words.
        stay[ends[ends < len(part)]] = True
        kept = out[stay].tobytes()
        at = np.concatenate(([0], np.cumsum(stay)))[bounds]
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            yield kept[a:b].strip(b" ")


class WordSets:
    """Exact shingle sets: words are numbered by a dictionary that compares them, and a shingle is the bytes of its numbers.

    Sets of one object compare with one another as long as `epoch` stays; the dictionary begins anew when it is large.
    """

    def __init__(self, k: int, most: int = 300_000) -> None:
        self.k, self.most, self.epoch, self.numbers = k, most, 0, {}

    def renew(self) -> None:
        if len(self.numbers) > self.most:
            self.numbers, self.epoch = {}, self.epoch + 1

    def of(self, words: bytes) -> set[bytes]:
        """The set of a normalised text."""
        parts = words.split(b" ") if words else []
        numbers = self.numbers
        x = np.array([numbers.setdefault(w, len(numbers)) for w in parts], dtype=np.uint32).tobytes()
        if len(parts) < self.k:
            return {x} if x else set()
        return {x[i : i + 4 * self.k] for i in range(0, len(x) - 4 * self.k + 1, 4)}
