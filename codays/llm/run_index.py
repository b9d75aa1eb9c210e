"""A run-length index over many short strings, and what repeats in them.

The strings are sorted by all their suffixes; the characters before the sorted
suffixes are the Burrows-Wheeler transform, which repetitive strings turn into
few long runs. How far a suffix agrees with its neighbours in that order is
compared in full only for suffixes at the ends of runs. Inside a run both
suffixes are preceded by the same character, so the agreement of the suffix one
place further left is one more, and the statistics of all other places follow
in one pass through the text.
"""

import numpy as np


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by doubling the compared length.

    ``text`` holds non-negative numbers and should end in one of its own.
    """
    _, rank = np.unique(text, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    length = 1
    while True:
        further = np.zeros_like(rank)
        further[:-length or None] = rank[length:]
        both = rank * (int(rank.max()) + 1) + further
        order = np.argsort(both, kind="stable")
        ordered = both[order]
        steps = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        rank = np.empty_like(rank)
        rank[order] = np.cumsum(steps)
        if steps.all() or length >= len(text):
            return order
        length *= 2


def agreement(text: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """How many characters the suffixes at ``one`` and ``two`` have in common."""
    length = np.zeros(len(one), np.int64)
    active = np.arange(len(one))
    while len(active):
        a, b = one[active] + length[active], two[active] + length[active]
        inside = (a < len(text)) & (b < len(text))
        same = np.zeros(len(active), bool)
        same[inside] = text[a[inside]] == text[b[inside]]
        active = active[same]
        length[active] += 1
    return length


class RunIndex:
    """Runs of the transform, with the suffixes at their ends."""

    def __init__(self, text: np.ndarray):
        self.text = text
        order = suffix_order(text)
        before = text[order - 1]
        before[order == 0] = -1
        changes = before[1:] != before[:-1]
        heads = np.flatnonzero(np.concatenate(([True], changes)))
        tails = np.flatnonzero(np.concatenate((changes, [True])))
        self.run_symbols, self.run_lengths = before[heads], tails - heads + 1
        self.heads, self.tails = order[heads], order[tails]
        self._before_heads = order[heads[1:] - 1]
        self._after_tails = order[tails[:-1] + 1]

    def _streamed(self, places: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Carry sampled agreements through the text, one less at every step."""
        sampled = np.full(len(self.text), -1, np.int64)
        sampled[places] = places + lengths
        reach = sampled
        last = np.maximum.accumulate(np.where(sampled >= 0, np.arange(len(self.text)), -1))
        reach = np.where(last >= 0, sampled[np.maximum(last, 0)], 0)
        return np.maximum(reach - np.arange(len(self.text)), 0)

    def matching_statistics(self) -> np.ndarray:
        """For every place the longest match of what starts there with any other place."""
        first, final = self.heads[:1], self.tails[-1:]
        up = self._streamed(
            np.concatenate((self.heads[1:], first)),
            np.concatenate((agreement(self.text, self.heads[1:], self._before_heads), [0])),
        )
        down = self._streamed(
            np.concatenate((self.tails[:-1], final)),
            np.concatenate((agreement(self.text, self.tails[:-1], self._after_tails), [0])),
        )
        return np.maximum(up, down)


def joined(strings: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The strings one after the other, each ended by a number of its own; and their starts."""
    lengths = np.array([len(s) + 1 for s in strings], np.int64)
    ends = np.cumsum(lengths) - 1
    top = max(int(s.max(initial=0)) for s in strings) + 1
    text = np.empty(int(lengths.sum()), np.int64)
    text[ends] = top + np.arange(len(strings))
    inside = np.ones(len(text), bool)
    inside[ends] = False
    text[inside] = np.concatenate(strings)
    return text, ends - lengths + 1
