"""Spelling variants against brute force."""

import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from codays.llm import spelling
from codays.llm.common import table
from codays.llm.spelling import Signatures, parts_for, runs_of, spelling_variants, variants
from codays.session import staged

SCHEMA = "doc_id long, text string, word string, n int, signature string, root string"


def one_edit(a: str, b: str) -> bool:
    """By definition: replace, insert or delete exactly one code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_words(docs) -> Counter:
    counts = Counter()
    for doc_id, text in docs:
        if text is None:
            continue
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return Counter({w: n for w, n in counts.items() if len(w) >= 5 and n >= 3})


def brute_variants(words: Counter, pairs: set | None = None) -> dict:
    """Pairs are sought among words that agree when a letter of either is left out."""
    near = defaultdict(set)
    shapes = defaultdict(set)
    for word in words:
        shapes[word].add(word)
        for k in range(len(word)):
            shapes[word[:k] + word[k + 1 :]].add(word)
    for group in shapes.values():
        for a in group:
            near[a] |= {b for b in group if a != b and one_edit(a, b)}
    form = {}
    for word, n in words.items():
        best = min(near[word], key=lambda w: (-words[w], w), default=None)
        form[word] = best if best is not None and words[best] >= 2 * n else None
    out = {}
    for word, n in words.items():
        root = word
        while form[root] is not None:
            root = form[root]
        out[word] = (form[word], root, n, len(near[word]), words[form[word]] if form[word] else None)
    return out


def as_dict(frame) -> dict:
    rows = frame.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_given_documents(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    words = brute_words([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert len(words) > 1000
    got = spelling_variants(docs)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert as_dict(got) == brute_variants(words)


def test_odd_rows(spark):
    rows = [
        (1, "Straße STRASSE straÃe étéàé ÉTÉÀÉ", "x", 1, "y", "z"),
        (1, "Straße STRASSE straÃe étéàé ÉTÉÀÉ", "x", 1, "y", "z"),
        (None, "Straße words wordy words wordy", None, None, None, None),
        (None, None, None, None, None, None),
        (2, "", "", 0, "", ""),
        (3, "12 34 中文 a b", "", 0, "", ""),
        (4, "words " * 40 + "wordz " * 20 + "wordy " * 10 + "xordy " * 5, "", 0, "", ""),
        (5, "ab" * 40_000 + " " + "ab" * 40_000 + " " + "ab" * 40_000 + "c " + "ab" * 40_000, "", 0, "", ""),
    ]
    expected = brute_words([r[:2] for r in rows])
    got = as_dict(spelling_variants(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute_variants(expected)
    assert len(got) > 5


def test_texts_in_pieces_count_alike(monkeypatch):
    text = "One two ÀÉone twoĀthree tWo".encode()
    whole = runs_of(text)
    monkeypatch.setattr(spelling, "LONG_TEXT", 3)
    assert runs_of(text) == whole == {"one": 1, "two": 3, "ÀÉone": 1, "three": 1}


@pytest.mark.parametrize("parts", [4, 6, 9])
def test_near_words_share_a_signature(parts):
    signatures = Signatures(parts)
    words = ["letter", "lettre", "leter", "aaaaa", "aaaaaa", "abcde", "abcdf", "zzzzzzzz", "zzzzzzzzz"]
    for a in words:
        for b in words:
            if one_edit(a, b):
                assert set(signatures.of(a)) & set(signatures.of(b)), (a, b)


def test_crowded_signatures_and_long_ways_to_the_root(spark):
    """Words of few letters crowd the signatures; a chain of forms doubles at each step."""
    words = Counter({"aaaaa" + "".join(c): 3 + i for i, c in enumerate((a, b) for a in "abcdefgh" for b in "abcdefgh")})
    for k in range(12):
        words["q" * (5 + k)] = 3 * 2**k
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    got = as_dict(variants(frame, parts=4))
    assert got == brute_variants(words)
    assert got["qqqqq"][1] == "q" * 16


def test_ties_go_to_the_first_word(spark):
    words = {"stone": 3, "stony": 6, "stonz": 6, "stonè": 6}
    got = as_dict(variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got["stone"][:2] == ("stony", "stony")


def test_more_words_take_finer_parts():
    assert [parts_for(n) for n in (0, 10**6, 10**6 + 1, 10**8, 10**30)] == [6, 6, 7, 8, 12]


def test_empty_table(spark):
    assert spelling_variants(spark.createDataFrame([], SCHEMA)).collect() == []
    assert spelling_variants(spark.range(3).select(F.col("id").alias("doc_id"), F.lit("a bc").alias("text"))).count() == 0


def test_no_table_of_words_is_broadcast(spark, monkeypatch):
    """Sizes are expected too low after an explode, so no join may follow them."""
    seen = []

    def noted(df, *rest, **named):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return staged(df, *rest, **named)

    monkeypatch.setattr(spelling, "staged", noted)
    words = {"stone": 3, "stones": 6, "stonesx": 12, "other": 4}
    rows = variants(spark.createDataFrame(list(words.items()), "word string, n long"))
    seen.append(rows._jdf.queryExecution().executedPlan().toString())
    assert as_dict(rows) == brute_variants(Counter(words))
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").removesuffix("b")) > 1_000_000
    assert sum(plan.count("SortMergeJoin") for plan in seen) >= 5
    assert not any("Broadcast" in plan for plan in seen)
