"""Subword ids as symbols that a small attention model can predict one by one.

A softmax over all subword ids would cost far more than the attention. So every id
that a word can hold gets a code of one to three symbols, frequent ids the short
ones, and no code begins another. The first symbol tells whether the id begins a
word or goes on with one; further symbols are digits. Reading the codes of a text is
reading its ids, and the probability of an id is the product of those of its symbols.
"""

from collections.abc import Iterable

import numpy as np

from codays.llm import attention

END = attention.CLASSES - 1
#: Symbols that stand second and third in a code, and first symbols of codes of two.
DIGITS, PAIRED = 48, 20
BEGINS, GOES_ON, DIGIT = range(3)


class SubwordCode:
    """Codes from how often training words hold each id; of bounded size whatever the corpus.

    Words are in lower case, hold no white space and follow a blank, so other ids get
    no code. ``groups`` tells which symbols begin words (the end of a text with them),
    go on with words, and are digits.
    """

    def __init__(self, ranks: dict[bytes, int], times: Iterable[tuple[int, int]], documents: int):
        counts = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
        for subword, n in times:
            counts[subword] = n
        begins: dict[int, bool] = {}
        for piece, subword in ranks.items():
            lower = piece == piece.lower() and len((b"." + piece[1:]).split()) == 1
            if lower and (piece[:1] == b" " or not piece.isspace()):
                begins[subword] = piece[:1] == b" "
        order = sorted(begins, key=lambda i: (-counts[i], i))
        digit = END - DIGITS
        thirds = sum(-(-sum(b == side for b in begins.values()) // DIGITS**2) for side in (True, False))
        single = digit - thirds - PAIRED - 1
        if single < 0:
            raise ValueError(f"{len(order)} subwords do not fit into codes of three symbols")
        paired = single + PAIRED * DIGITS
        self.codes: list[bytes] = [b""] * len(counts)
        self.groups = np.zeros((attention.CLASSES, 3))
        self.groups[END, BEGINS] = 1
        self.groups[digit:END, DIGIT] = 1
        at = 0
        for side in (True, False):
            first = at
            for part, length in ((order[:single], 1), (order[single:paired], 2), (order[paired:], 3)):
                own = [i for i in part if begins[i] == side]
                for k, subword in enumerate(own):
                    digits = [digit + k // DIGITS**p % DIGITS for p in reversed(range(length - 1))]
                    self.codes[subword] = bytes([at + k // DIGITS ** (length - 1), *digits])
                at += -(-len(own) // DIGITS ** (length - 1))
            self.groups[first:at, BEGINS if side else GOES_ON] = 1
        symbols = np.full(attention.CLASSES, 0.5)
        for subword in np.flatnonzero(counts):
            for symbol in self.codes[subword]:
                symbols[symbol] += counts[subword]
        symbols[END] += documents
        self.frequencies = symbols / symbols.sum()
        #: Symbols of all training documents.
        self.tokens = int(symbols.sum() - 0.5 * attention.CLASSES)

    def word(self, pieces: Iterable[int]) -> bytes:
        return b"".join(map(self.codes.__getitem__, pieces))


def log_of_words(
    chosen: np.ndarray, masses: np.ndarray, targets: np.ndarray, groups: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What the probabilities of symbols say of whole words, as natural logarithms.

    ``targets`` are texts one after the other, each with its end; ``chosen`` are their
    probabilities and ``masses`` those of the groups, place by place. Only symbols that
    can stand at a place share its probability. Returns, for every word and every end of
    a text in order: its place; that of its first id, given that a word begins (or of the end,
    likewise); that of its further ids and of no more of them, given the first; and whether
    it is a word.
    """
    group = groups.argmax(axis=1)[targets]
    begin, onward, digit = np.log(masses).T
    either = np.logaddexp(begin, onward)
    own = np.log(chosen) - np.choose(group, (begin, either, digit))
    places = np.flatnonzero(group == BEGINS)
    head = np.maximum.accumulate(np.where(group == DIGIT, 0, np.arange(len(group))))
    of_first = group[head] == BEGINS
    first = np.add.reduceat(np.where(of_first, own, 0.0), places)
    further = np.add.reduceat(np.where(of_first, 0.0, own), places)
    # A word ends where the next one begins, or the text ends.
    further[:-1] += (begin - either)[places[1:]]
    return places, first, further, targets[places] != END
