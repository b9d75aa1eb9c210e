"""Token counts of whole texts under a public BPE vocabulary with word ends.

The vocabulary file is read by each Python worker once. Texts are cut at the
vocabulary's added tokens, normalised, and split into pre-tokens as the file
says. Distinct pre-tokens of a batch are merged together: all of them lie in
one ragged array of symbol ids, and in each round every sequence applies its own
lowest-ranked pair at all places at once. What survives is counted.

Counting is a map over the scan: nothing is shuffled, a task holds one Arrow
batch and a bounded table of the words met so far, and a lost task is simply
run again.
"""

import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codays.llm.common import ids_and_texts

#: Chunks whose counts a worker remembers before it starts anew.
MOST_REMEMBERED = 400_000
OVER_LIMIT = 2048
NO_RANK = np.iinfo(np.int32).max
#: Texts without these need no Unicode normalisation and lower-case alike everywhere.
UNUSUAL = re.compile("[\x1c-\x1fɐ-\U0010ffff]")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves, the rest are numbered
    from 256 on in byte order.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in printable)
    letters = {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}
    return [letters[b] for b in range(256)]


class RankedMerges:
    """Merges of a vocabulary as sorted arrays, applied to many sequences at once."""

    def __init__(self, vocabulary: dict):
        model = vocabulary["model"]
        ids, end = model["vocab"], model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.first = np.array([ids[x] for x in letters], np.int64)
        self.last = np.array([ids[x + end] for x in letters], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.width = max(ids.values()) + 1
        keys = np.array([ids[a] * self.width + ids[b] for a, b in merges], np.int64)
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), made[order]

    def symbols_left(self, words: list[bytes]) -> np.ndarray:
        """How many symbols are left of each word, none of which is empty."""
        lengths = np.array([len(w) for w in words], np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.first[raw]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[raw[ends]]
        counts = lengths.copy()
        owner = np.repeat(np.arange(len(words)), lengths)
        while len(symbols) > 1:
            found, ranks = self._pairs(symbols, owner)
            starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            lowest = np.minimum.reduceat(ranks, starts)
            sizes = np.diff(np.append(starts, len(symbols)))
            best = np.repeat(lowest, sizes)
            joins = self._apart((ranks == best) & (best != NO_RANK))
            symbols[joins] = self.made[found[joins]]
            keep = best != NO_RANK
            keep[joins + 1] = False
            np.subtract.at(counts, owner[joins], 1)
            symbols, owner = symbols[keep], owner[keep]
        return counts

    def _pairs(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place among the merges, and rank, of the pair that starts at each symbol."""
        wanted = symbols[:-1] * self.width + symbols[1:]
        found = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        known = (self.keys[found] == wanted) & (owner[:-1] == owner[1:])
        ranks = np.append(np.where(known, self.ranks[found], NO_RANK), np.int32(NO_RANK))
        return np.append(found, 0), ranks

    @staticmethod
    def _apart(marked: np.ndarray) -> np.ndarray:
        """Marked places, every second one only where they follow one another."""
        places = np.flatnonzero(marked)
        if not len(places):
            return places
        opens = np.concatenate(([True], np.diff(places) != 1))
        first = np.maximum.accumulate(np.where(opens, np.arange(len(places)), 0))
        return places[(np.arange(len(places)) - first) % 2 == 0]


class TokenCounter:
    """Counts the tokens of texts as the vocabulary's own library does."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)
        self.merges = RankedMerges(vocabulary)
        self.normalise = Tokenizer.from_file(path).normalizer.normalize_str
        split = vocabulary["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words_in = regex.compile(split).findall
        added = [regex.escape(t["content"]) for t in vocabulary["added_tokens"]]
        self.added = regex.compile("|".join(added)) if added else None
        self.known: dict[str, int] = {}

    def _chunks(self, text: str) -> list[str]:
        if not UNUSUAL.search(text):
            return text.lower().split()
        return [c for c in self.normalise(text).split(" ") if c]

    def _learn(self, chunks: list[str]) -> None:
        words = [self.words_in(c) for c in chunks]
        distinct = list(dict.fromkeys(chain.from_iterable(words)))
        counts: dict[str, int] = {}
        if distinct:
            left = self.merges.symbols_left([w.encode() for w in distinct])
            counts = dict(zip(distinct, left.tolist()))
        for chunk, parts in zip(chunks, words):
            self.known[chunk] = sum(map(counts.__getitem__, parts))

    def counts(self, texts: list[str]) -> list[int]:
        if len(self.known) > MOST_REMEMBERED:
            self.known = {}
        added, pieces = [], []
        for text in texts:
            cut = self.added.split(text) if self.added and "<|" in text else [text]
            added.append(len(cut) - 1)
            pieces.append(list(chain.from_iterable(map(self._chunks, cut))))
        unknown = set(chain.from_iterable(pieces)).difference(self.known)
        if unknown:
            self._learn(list(unknown))
        return [n + sum(map(self.known.__getitem__, p)) for n, p in zip(added, pieces)]


_counters: dict[str, TokenCounter] = {}


def counter(path: str) -> TokenCounter:
    """One counter per worker process and vocabulary."""
    if path not in _counters:
        _counters[path] = TokenCounter(path)
    return _counters[path]


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = OVER_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: a row per row of ``docs``.

    Null and empty texts have no bytes and no tokens. Null ids and repeated rows
    pass through as they are; an empty table gives no rows; columns other than
    doc_id and text are not read. ``vocabulary`` is a path on every executor.
    """
    rows = ids_and_texts(docs)
    doc_id = rows.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            counts = counter(vocabulary).counts(texts) if texts else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    sized = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    counted = sized.mapInArrow(count, f"doc_id {doc_id}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
