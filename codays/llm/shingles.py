"""Word shingles of whole texts as 64-bit numbers."""

from itertools import chain

import numpy as np
import pandas as pd

WORDS_PER_SHINGLE = 5
MOST_REMEMBERED = 150_000
_known: dict[str, int] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread unsigned 64-bit numbers evenly over their range."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def word_numbers(words: list[str]) -> np.ndarray:
    """The same 64-bit number for the same word in every process."""
    unknown = list(set(words).difference(_known))
    if unknown:
        if len(_known) + len(unknown) > MOST_REMEMBERED:
            _known.clear()
            unknown = list(set(words))
        numbers = pd.util.hash_array(np.array(unknown, dtype=object), categorize=False)
        _known.update(zip(unknown, numbers.tolist()))
    return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))


def forget_words() -> None:
    """For the end of a task: its worker lives on beside those of later steps."""
    _known.clear()


def shingles(texts: list[str], size: int = WORDS_PER_SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of all texts in one array, and how many each text has.

    Words are runs without white space, as they are. A text of fewer than ``size`` words but one at
    least is one shingle; a text without words has none. Repeated shingles stay.
    """
    words = [text.split() for text in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    numbers = mixed(word_numbers(list(chain.from_iterable(words))))
    ends = np.cumsum(lengths)
    counts = np.where(lengths >= size, lengths - size + 1, np.minimum(lengths, 1))
    rolled = np.zeros(len(numbers), np.uint64)
    within = np.repeat(ends, lengths) - np.arange(len(numbers))
    for k in range(min(size, int(lengths.max(initial=0)))):
        # Words past the end of a short text add nothing.
        there = np.flatnonzero(within > k)
        rolled[there] = mixed(rolled[there] + numbers[there + k])
    starts = ends - lengths
    offset = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return rolled[np.repeat(starts, counts) + offset], counts


def in_parts(texts: list[str], characters: int = 1_000_000) -> list[list[int]]:
    """Numbers of texts in parts of about so many characters, one text at least."""
    parts: list[list[int]] = [[]]
    held = 0
    for k, text in enumerate(texts):
        if parts[-1] and held + len(text) > characters:
            parts.append([])
            held = 0
        parts[-1].append(k)
        held += len(text)
    return parts if parts[-1] else []
