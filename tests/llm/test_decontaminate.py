"""Decontamination against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from codays.llm import decontaminate as module
from codays.llm.common import table
from codays.llm.decontaminate import Texts, decontaminate, words_of

DOCS = "doc_id long, text string, row long, h string, place int, n int"
ITEMS = "item_id long, text string, window string, key string, length int"


def words_in(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)


def brute(docs, items, size=10):
    windows = {}
    for item_id, text in items:
        words = words_in(text)
        n = min(size, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[k : k + n]), set()).add(item_id)
    out = []
    for doc_id, text in docs:
        words, hit, named = words_in(text), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                own = tuple(words[k : k + n])
                if own in windows:
                    hit |= set(range(k, k + n))
                    named |= {str(i) for i in windows[own] if i is not None}
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(named), digest, bool(hit)))
    return sorted(out, key=str)


def rows_of(frame):
    assert frame.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted(map(tuple, frame.collect()), key=str)


def test_given_documents(spark, sf_small):
    docs, items = table(spark, sf_small, "documents"), table(spark, sf_small, "benchmark")
    expected = brute(
        [tuple(r) for r in docs.select("doc_id", "text").collect()],
        [tuple(r) for r in items.select("item_id", "text").collect()],
    )
    assert any(r[5] for r in expected) and not all(r[5] for r in expected)
    assert rows_of(decontaminate(docs, items)) == expected


def made_tables():
    """Texts over few words, so that shingles repeat, items overlap and windows meet everywhere."""
    rng = random.Random(12)
    say = lambda n, k: " ".join(rng.choice("abcdefghij"[:k]) for _ in range(n))
    items = [(i, say(rng.randint(0, 14), 3)) for i in range(40)]
    items += [(100, "Ünder-the Bridge"), (101, "one"), (102, None), (103, ""), (None, "null named item here"), (7, say(12, 3))]
    items += [(104, items[3][1]), (105, items[3][1]), (100, "another text of hundred")]
    docs = [(i, say(rng.randint(0, 60), 3 + i % 4)) for i in range(80)]
    docs += [(90, "ünder the bridge"), (91, "x Ünder,THE  bridge"), (92, "ONE two"), (93, None), (94, "")]
    docs += [(95, "so null NAMED item here it is"), (None, "one"), (None, "one"), (5, docs[5][1]), (5, "other text of five")]
    docs += [(96, say(30_000, 3)), (97, "z" * 50_000 + " one"), (98, "another text of hundred")]
    return docs, items


def test_overlaps_ties_odd_and_long_texts(spark, monkeypatch):
    docs, items = made_tables()
    expected = brute(docs, items)
    d = spark.createDataFrame([(*r, 1, "h", 2, 3) for r in docs], DOCS)
    i = spark.createDataFrame([(*r, "w", "k", 4) for r in items], ITEMS)
    assert rows_of(decontaminate(d, i)) == expected


def test_a_full_bitmap_changes_nothing(spark, monkeypatch):
    """With every bit set, all places are looked up in the join."""
    docs, items = made_tables()
    monkeypatch.setattr(module, "_bitmap", lambda shingles, bits: np.full(bits // 8, 255, np.uint8))
    docs = [r for r in docs if len(r[1] or "") < 1000]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(decontaminate(d, i)) == brute(docs, items)


def test_empty_tables(spark):
    docs = [(1, "some words"), (2, None)]
    none = spark.createDataFrame([], ITEMS)
    given = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows_of(decontaminate(given, none)) == brute(docs, [])
    assert rows_of(decontaminate(spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "some words")], "item_id long, text string"))) == []


@pytest.mark.parametrize("piece", [16, 50, 1 << 10])
def test_words_in_pieces(monkeypatch, piece):
    """A word has one number wherever pieces are cut, and if it is longer than a piece."""
    long = "y" * 200
    text = f"aa bbb,cc {long} aa  {long}zz {long} {'w ' * 40} end".encode()
    monkeypatch.setattr(module, "PIECE", piece)
    monkeypatch.setattr(module, "_tables", {})
    starts, ends, numbers = words_of(np.frombuffer(text, np.uint8))
    spoken = [text[a:b].decode() for a, b in zip(starts, ends)]
    assert spoken == words_in(text.decode())
    by_word = {}
    for word, number in zip(spoken, numbers.tolist()):
        assert by_word.setdefault(word, number) == number
    assert len(set(by_word.values())) == len(by_word)


def test_shingles_stay_within_their_text():
    texts = Texts([b"a b c", b"", b"d e", b"A b c"])
    places, numbers = texts.shingles(2)
    assert texts.text[places].tolist() == [0, 0, 2, 3, 3]
    assert numbers[0] == numbers[3] and numbers[1] == numbers[4] and len(set(numbers.tolist())) == 3
