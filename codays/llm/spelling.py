"""Spelling variants of words by partition-and-enumerate signatures.

The letters of a word, as a multiset, are a set: of a letter that comes three
times the first, the second and the third are three members. As a binary vector
over all members, two words that differ by one inserted, deleted or replaced
letter have a Hamming distance of at most two. The members are partitioned into
``parts``; two such words then agree on all parts but two, whichever these are.
So every word enumerates its signatures, one for each choice of two parts to
leave out, and near words have a signature in common.

Signatures are equi-joined. Words of five letters or more that are one edit apart
also share their first or their last two letters, so a signature comes once with
either pair of letters, which cuts the groups of a common signature. What meets
is verified by edit distance.

Every table here grows with the words, so joins are merge joins whatever sizes are
expected: a table of signatures is sized like its words, though it has up to 132 rows for each.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codays.session import staged

TYPO_STEP = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A form occurs at least so many times as often as its variant.
FORM_SHARE = 2
LEFT_OUT = 2
#: Fewest and most parts; there is one more for every tenfold of words from so many on.
LEAST_PARTS, MOST_PARTS, WORDS_OF_LEAST_PARTS = 6, 12, 1_000_000
MOST_HELD = 300_000
LONG_TEXT = 4_000_000
#: ASCII letters are lower-cased before.
RUN = re.compile("[a-zÀ-ÿ]+")


def runs_of(text: bytes) -> Counter:
    """How often each run of letters occurs in a text, with A to Z lower-cased."""
    lowered = text.lower().decode()
    if len(lowered) <= LONG_TEXT:
        return Counter(RUN.findall(lowered))
    return Counter(found.group() for found in RUN.finditer(lowered))


def counted_words(documents: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n: runs of letters, some of them with a letter lost, that occur often enough.

    A run loses the letter at ``h % length`` where 97 divides ``h``, the crc32 of the
    document's id, a colon and the run. A null id counts as the empty text.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"]
            )
            held.clear()
            return out

        crc32 = zlib.crc32
        for batch in batches:
            for own_id, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                base = crc32(f"{own_id}:".encode())
                for run, n in runs_of(text.as_buffer().to_pybytes()).items():
                    h = crc32(run.encode(), base)
                    if not h % TYPO_STEP:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                    if len(run) >= least_length:
                        held[run] += n
                if len(held) > MOST_HELD:
                    yield rows()
        if held:
            yield rows()

    texts = documents.where(F.col("text").isNotNull()).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.col("text").cast("string").alias("text")
    )
    counts = texts.mapInArrow(count, "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def parts_for(words: int) -> int:
    """More words share a signature by chance, so more words take finer parts."""
    parts, reach = LEAST_PARTS, WORDS_OF_LEAST_PARTS
    while words > reach and parts < MOST_PARTS:
        parts, reach = parts + 1, reach * 10
    return parts


def _spread(x: int) -> int:
    """A fixed 63-bit number for a small one."""
    x = (x + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
    x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 % (1 << 64)
    return (x ^ x >> 29) >> 1


class Signatures:
    """The signatures of words for a number of parts."""

    def __init__(self, parts: int):
        self.parts = parts
        self.choices = list(combinations(range(parts), LEFT_OUT))
        self.salts = [_spread(1 << 40 | k) for k in range(len(self.choices))]
        self.members: dict[str, list[tuple[int, int]]] = {}

    def _members(self, letter: str, times: int) -> list[tuple[int, int]]:
        """Part and number of the first ``times`` members that a letter makes."""
        known = self.members.setdefault(letter, [])
        while len(known) < times:
            number = _spread(ord(letter) << 24 | len(known))
            known.append((number % self.parts, number))
        return known[:times]

    def of(self, word: str) -> list[int]:
        """One number for every choice of parts to leave out."""
        held = [0] * self.parts
        for letter, times in Counter(word).items():
            for part, number in self._members(letter, times):
                held[part] ^= number
        whole = 0
        for part in held:
            whole ^= part
        return [whole ^ held[a] ^ held[b] ^ salt for (a, b), salt in zip(self.choices, self.salts)]


def signed_words(words: DataFrame, parts: int) -> DataFrame:
    """word, signature: a row for every signature of every word."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signatures = Signatures(parts)
        for batch in batches:
            lists = [signatures.of(word) for word in batch.column("word").to_pylist()]
            numbers = np.array(lists, np.int64).reshape(-1)
            offsets = np.arange(len(lists) + 1, dtype=np.int32) * len(signatures.choices)
            arrays = pa.ListArray.from_arrays(pa.array(offsets), pa.array(numbers))
            yield pa.RecordBatch.from_arrays([batch.column("word"), arrays], ["word", "signatures"])

    listed = words.select("word").mapInArrow(sign, "word string, signatures array<bigint>")
    return listed.select("word", F.explode("signatures").alias("signature"))


def near_words(words: DataFrame, parts: int | None = None) -> DataFrame:
    """one, two: pairs of words one edit apart, each pair once and in order.

    ``words`` holds distinct words of five letters or more.
    """
    signed = signed_words(words, parts or parts_for(words.count()))
    ends = F.array(
        F.struct(F.lit(True).alias("first"), F.substring("word", 1, 2).alias("letters")),
        F.struct(F.lit(False).alias("first"), F.substring("word", -2, 2).alias("letters")),
    )
    rows = signed.select("signature", "word", F.inline(ends))
    keys = ["signature", "first", "letters"]
    met = rows.withColumnRenamed("word", "one").join(rows.withColumnRenamed("word", "two").hint("merge"), keys)
    # Pairs with equal first letters meet by these alone.
    once = F.col("first") | (F.substring("one", 1, 2) != F.substring("two", 1, 2))
    alike = F.abs(F.length("one") - F.length("two")) <= 1
    near = F.levenshtein("one", "two", 1) == 1
    return met.where((F.col("one") < F.col("two")) & alike & once & near).select("one", "two").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word, root for every row of word, form: the last word that forms lead to.

    The way from word to root is halved in every round; as a form occurs at least
    twice as often as its variant, it is short.
    """
    reached = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = staged(
            reached.join(onward.hint("merge"), "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "roots",
        )
        reached = further.select("word", "root")
        if further.where("moved").isEmpty():
            return reached


def variants(words: DataFrame, parts: int | None = None, share: int = FORM_SHARE) -> DataFrame:
    """word, form, root, n, n_near, form_n for every row of word, n.

    Near words are one inserted, deleted or replaced letter apart. A word's form is
    its most frequent near word, the first in code-point order among equals, if it
    occurs at least ``share`` times as often; the root is where forms lead to.
    """
    words = staged(words.select("word", "n"), "words")
    pairs = staged(near_words(words, parts), "near")
    both = pairs.toDF("word", "near").union(pairs.select(F.col("two"), F.col("one")))
    best = (
        both.join(words.toDF("near", "near_n").hint("merge"), "near")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("near_n"), F.col("near"))).alias("best"))
        .select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.col1")).alias("near_n"))
    )
    often = F.col("near_n") >= share * F.col("n")
    known = staged(
        words.join(best.hint("merge"), "word", "left").select(
            "word",
            F.when(often, F.col("near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(often, F.col("near_n")).alias("form_n"),
        ),
        "forms",
    )
    led = roots(known.where(F.col("form").isNotNull()))
    return known.join(led.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(documents: DataFrame) -> DataFrame:
    """What the registered query returns: the words of all texts with their forms and roots.

    Null and empty texts have no words; repeated rows count as often as they come;
    a table without words gives no rows. Columns other than doc_id and text are not
    looked at.
    """
    return variants(counted_words(documents))
