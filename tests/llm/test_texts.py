"""Toxicity, Jaccard join, mixing, byte-level BPE and language model on small tables."""

import collections
import hashlib
import random
import tracemalloc
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from codays.llm import attention, lm
from codays.llm.buckets import compressed, packed, unpacked
from codays.llm.byte_bpe import (
    _slices,
    decode_documents,
    encoded_word,
    joined,
    merge_long,
    pack_words,
    parts_of,
    read_ranks,
    round_trip,
    unpacked_words,
    with_ids,
    words_of_parts,
)
from codays.llm.forest import (
    jaccard_join,
    keep_one_each,
    links_at,
    meetings,
    near_texts as near_classes,
    not_alone,
    pairs_to_compare,
    prefix_length,
    share_found,
    with_labels,
)
from codays.llm.lm import score_texts, words_of
from codays.llm.subword_code import SubwordCode, log_of_words
from codays.llm.mixing import MOST_REPEATS, mixture, mixture_sql
from codays.llm.common import remainder
from codays.llm.toxicity import (
    _labelled,
    count_classes,
    evidence,
    fit_logistic,
    keys_of,
    learn_names,
    maximal_segments,
    toxicity,
    train,
)
from codays.llm.toxicity import words_of as toxicity_words

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
SCHEMA = "doc_id long, text string, lang string, source string, size string, key string"


def frame(spark, texts):
    """Rows of (doc_id, text) with sources, a null among them, and columns that clash."""
    rows = [(i, t, None, None if k % 5 == 4 else f"s{k % 5}", "x", "y") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def smallest_parts(scores):
    """Maximal segments by their definition: the best one, then left and right of it."""
    found = []

    def split(a, b):
        best = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += scores[j]
                if total > 1e-12 and (best is None or total > best[2] + 1e-12):
                    best = i, j + 1, total
        if best:
            found.append(best)
            split(a, best[0])
            split(best[1], b)

    split(0, len(scores))
    return sorted(found)


def test_maximal_segments():
    rng = np.random.default_rng(0)
    for _ in range(200):
        scores = rng.normal(size=rng.integers(0, 25)) - 0.1
        got, expected = maximal_segments(scores), smallest_parts(scores)
        assert [s[:2] for s in got] == [s[:2] for s in expected]
        assert np.allclose([s[2] for s in got], [s[2] for s in expected])


def test_toxicity_finds_held_out_documents(spark):
    random.seed(3)
    common = [f"word{k}" for k in range(300)]
    texts, labels = [], []
    for i in range(1500):
        words = random.choices(common, k=random.randrange(30, 200))
        toxic = i % 6 == 0
        if toxic:
            for _ in range(5):
                words.insert(random.randrange(len(words)), random.choice(["vilest", "scumful", "scummy", "rotten"]))
        texts.append((i, " ".join(words)))
        labels.append((i, int(toxic), "z"))
    texts += [(9_001, None), (9_002, ""), (None, "vilest scummy rotten vilest rotten scumful"), (9_003, "ok " * 50_000)]
    labels += [(None, 1, "z"), (9_002, None, "z"), (0, 1, "z")]
    given = spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    rows = toxicity(frame(spark, texts), given).collect()
    assert len(rows) == len(texts)
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 1500]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows if r.doc_id is not None)
    assert np.mean([r.predicted == (r.doc_id % 6 == 0) for r in held]) > 0.98
    by_id = {r.doc_id: r for r in rows}
    assert by_id[None].predicted == 1
    assert [by_id[i].predicted for i in (9_001, 9_002, 9_003)] == [0, 0, 0]
    assert all(0 <= r.score <= 1 for r in rows)


def test_no_two_words_share_a_count(spark):
    """A toxic word keeps its log-odds beside a frequent clean word of the same checksum."""
    cell = zlib.crc32(b"vilest") % (1 << 18)
    other = next(w for w in (f"calm{k}" for k in range(10**8)) if zlib.crc32(w.encode()) % (1 << 18) == cell)
    random.seed(12)
    common = [f"word{k}" for k in range(200)]
    texts = [
        (i, " ".join([*random.choices(common, k=40), "vilest" if i % 6 == 0 else other, "été"])) for i in range(600)
    ]
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i, _ in texts], "doc_id long, toxic int")
    model = train(frame(spark, texts), labels)
    scores = [model.word_score(word) for word in ("vilest", other, "été", "word7")]
    assert scores[0] > 2 and max(scores[1:]) < 0


def defined_score(word, toxic, clean, scale):
    """A word's score straight from the counts of its stems and of itself."""
    share = 0.5
    for name in keys_of(word):
        t, c = toxic[name] + 4 * share, clean[name] * scale + 4 * (1 - share)
        odds, share = np.log(t / c), min(max(t / (t + c), 1e-6), 1 - 1e-6)
    own = f"0{word}"
    spread = np.sqrt(1 / (toxic[own] + 2) + 1 / (clean[own] + 2))
    return (odds if odds > 2 and odds > 3 * spread else 0.0) - 0.1


def test_words_score_as_their_counts_say(spark):
    """Counted and uncounted words, below telling stems and elsewhere, whatever is broadcast."""
    random.seed(21)
    letters = "abcdéf"
    words = sorted({"".join(random.choices(letters, k=random.randint(1, 9))) for _ in range(1500)})
    bad = [w for w in words if w[:3] in ("abc", "dea", "faf")] + random.sample(words, 40) + ["abcd" + x for x in letters]
    texts = []
    for i in range(500):
        text = random.choices(words, k=60)
        texts.append((i, " ".join(text + (random.choices(bad, k=25) if i % 3 == 0 else []))))
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in texts], "doc_id long, toxic int")
    model = train(frame(spark, texts), labels)
    counts = collections.Counter(), collections.Counter()
    for i, text in texts:
        if zlib.crc32(str(i).encode()) % 5:
            counts[i % 3 == 0].update({name for word in set(toxicity_words(text)) for name in keys_of(word)})
    clean, toxic = counts
    whole = [sum(n for name, n in c.items() if name[0] == "0") for c in (toxic, clean)]
    scale = (whole[0] + 1) / (whole[1] + 1)
    asked = words + [w[:k] + x for w in bad for k in (2, 4, 6, 8) for x in ("q", "é", "")] + ["", "zzzzzzzzz"]
    expected = [defined_score(w, toxic, clean, scale) for w in asked]
    assert [model.word_score(w) for w in asked] == pytest.approx(expected)
    uncounted = [e for w, e in zip(asked, expected) if f"0{w}" not in toxic | clean]
    assert max(expected) > 2 and max(uncounted) > 2 and min(uncounted) < 0
    assert len(model.telling) + len(model.plain) < len(toxic | clean) / 2


def test_scores_follow_from_words_law_and_calibration(spark):
    """The score of a text, from the words' scores by definition of segments and law."""
    random.seed(22)
    common = [f"word{k}" for k in range(200)]
    texts = [(i, " ".join([*random.choices(common, k=50), *(["vilest", "vilely"] if i % 5 == 0 else [])])) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in texts], "doc_id long, toxic int")
    docs = frame(spark, texts)
    model = train(docs, labels)
    got = {r.doc_id: r.score for r in toxicity(docs, labels).collect()}
    for i, text in texts[:60]:
        words = toxicity_words(text)
        parts = smallest_parts([model.word_score(w) for w in words])
        told = [e for e in (model.decay * s - model.log_rate - np.log(len(words)) for _, _, s in parts) if e > 0]
        features = [1.0, np.log1p(max(told, default=0.0)), np.log1p(sum(told))]
        assert got[i] == pytest.approx(1 / (1 + np.exp(-np.dot(model.weights, features))), abs=1e-9)


def test_toxicity_is_calibrated_on_all_passages(spark):
    random.seed(13)
    common = [f"word{k}" for k in range(200)]
    texts = []
    for i in range(300):
        passages = (100 if i % 60 == 0 else 2) if i % 6 == 0 else 0
        words = random.choices(common, k=40)
        for _ in range(passages):
            words += [*["vilest"] * 4, *random.choices(common, k=600)]
        texts.append((i, " ".join(words)))
    given = spark.createDataFrame([(i, int(i % 6 == 0)) for i, _ in texts], "doc_id long, toxic int")
    docs, training = frame(spark, texts), remainder(5) != 0
    model = train(docs, given)
    labelled = _labelled(docs, given, 1000, training)
    partial = learn_names(count_classes(labelled))
    passages, marks = [], []
    for r in labelled.collect():
        without = partial[r.fold]
        without.decay, without.log_rate = model.decay, model.log_rate
        passages.append(without.passages(without.token_scores(toxicity_words(r.text))))
        marks.append(float(r.toxic))
    assert max(map(len, passages)) > 64
    expected = fit_logistic(np.array([evidence(p) for p in passages]), np.array(marks))
    assert model.weights == pytest.approx(tuple(expected), rel=1e-3)


def test_toxicity_without_rows_or_labels(spark):
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity(frame(spark, []), empty).collect() == []
    assert [r.predicted for r in toxicity(frame(spark, [(1, "a")]), empty).collect()] == [0]


def near_texts():
    random.seed(4)
    words = [f"w{k}" for k in range(2000)]
    texts = []
    for i in range(60):
        base = random.choices(words, k=random.randrange(40, 120))
        texts.append(base)
        for _ in range(i % 4):
            near = list(base)
            for _ in range(random.randrange(1, 5)):
                near[random.randrange(len(near))] = random.choice(words)
            texts.append(near)
    hot = random.choices(words, k=150)
    for _ in range(120):
        near = list(hot)
        near[random.randrange(150)] = random.choice(words)
        texts.append(near)
    plain = [" ".join(t) for t in texts] + ["a b c", "a b c", "a b", "", None, " ", "  ", texts[0][0]]
    plain += [" ".join(texts[0])] * 40
    return list(enumerate(plain)) + [(None, " ".join(texts[5])), (3, " ".join(texts[3]))]


def brute_links(rows):
    sets = []
    for _, text in rows:
        w = (text or "").split()
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    linked = collections.defaultdict(set)
    for a in range(len(rows)):
        for b in range(a):
            same = (rows[a][1] or "") == (rows[b][1] or "")
            union = len(sets[a] | sets[b])
            if same or (union and len(sets[a] & sets[b]) >= 0.8 * union):
                linked[a].add(b)
                linked[b].add(a)
    return linked


def test_jaccard_join_against_brute_force(spark):
    rows = near_texts()
    linked = brute_links(rows)
    expected = []
    for a in range(len(rows)):
        reach, todo = {a}, [a]
        while todo:
            new = linked[todo.pop()] - reach
            reach |= new
            todo += new
        ids = [rows[b][0] for b in reach if rows[b][0] is not None]
        expected.append((rows[a][0], min(ids), len(linked[a]), rows[a][0] == min(ids)))
    got = jaccard_join(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    kept = keep_one_each(frame(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept) == sorted({e[1] for e in expected})


def chained_texts(n, near_every):
    """Texts of which neighbours share 53 of 67 shingles; some have a copy with another last word."""
    words = [f"c{k}" for k in range(7 * n + 64)]
    texts = [" ".join(words[7 * i : 7 * i + 64]) for i in range(n)]
    texts += [texts[i].rsplit(" ", 1)[0] + " else" for i in range(0, n, near_every)]
    return list(enumerate(texts))


def texts_met(docs):
    texts = with_labels(docs).groupBy("key").agg(F.count("*").alias("copies"), F.first("labels").alias("labels"))
    return not_alone(docs, texts, prefix_length())


def test_long_chains_meet_at_their_nodes(spark):
    met = texts_met(frame(spark, chained_texts(5_000, 10_000)))
    # Blocks of a chain of a thousand texts would move each text 17 times, of a longer one more often.
    for depth in (8, 5):
        times = meetings(met, depth, 64).groupBy("key").agg(
            F.sum("blocks").alias("times"), F.max(F.length("meeting") != 16).alias("split")
        )
        most, split = times.agg(F.max("times"), F.avg(F.col("split").cast("int"))).first()
        assert most <= 20 and split > 0.9


def test_node_by_node_equals_brute_force(spark):
    rows = chained_texts(400, 20) + [(500 + i, text) for i, text in enumerate(t for _, t in near_texts()[:100])]
    expected = brute_links(rows)
    docs = frame(spark, rows)
    widths = {len(r.meeting) == 16 for r in meetings(texts_met(docs), 5, 16).collect()}
    assert widths == {True, False}
    found, classes = near_classes(docs, texts_per_block=16)
    got = found.join(classes, "key").select("doc_id", "n_links").collect()
    assert {r.doc_id: r.n_links for r in got} == {rows[k][0]: len(expected[k]) for k in range(len(rows))}


def test_every_pair_is_compared_at_one_depth():
    draws = np.random.default_rng(1)
    labels = draws.integers(0, 2, (40, 20, 8)).astype(np.uint16)
    places = np.arange(40)
    same = np.cumprod(labels[:, None] == labels[None, :], axis=3).sum(axis=3)
    for depth in range(1, 9):
        meet = pairs_to_compare(labels, places, places, depth)
        assert (meet == (same.max(axis=2) == depth)).all()
        # Over the trees, each such pair is told once where it shares the node.
        told = sum(
            (pairs_to_compare(labels, places, places, depth, tree) & (same[:, :, tree] >= depth)).astype(int)
            for tree in range(20)
        )
        assert (told == meet).all()


def test_descent_ends_when_enough_is_found(spark):
    base = [" ".join(f"d{k}_{i}" for i in range(200)) for k in range(40)]
    alike = frame(spark, list(enumerate([*base, *[t + " more" for t in base]])))
    met = texts_met(alike)
    found = links_at(met, 8, 0.8)
    assert found.agg(F.sum("pairs")).first()[0] == 40 and share_found(found, 8) > 0.9999
    # Pairs that just link are found at the longest prefix less often, and the estimate tells.
    changed = [t.rsplit(" ", 20)[0] + "".join(f" e{k}_{i}" for i in range(20)) for k, t in enumerate(base)]
    weak = frame(spark, list(enumerate([*base, *changed])))
    few = links_at(texts_met(weak), 8, 0.8)
    assert share_found(few, 8) < 0.99
    found, classes = near_classes(weak)
    assert found.join(classes, "key").where("n_links = 1").count() == 80


def test_prefixes_are_as_long_as_the_recall_allows():
    length = prefix_length(0.8, 20, 8, 0.999)
    assert 1 - (1 - 0.8**length) ** 20 >= 0.999 > 1 - (1 - 0.8 ** (length + 1)) ** 20


def mixed_texts():
    random.seed(5)
    texts = [(i, " \t".join("w" * random.randrange(1, 4) for _ in range(random.randrange(0, 400)))) for i in range(300)]
    return [*texts, (7, "a b c"), (7, "a b c"), (None, "d e"), (8, None), (9, "x " * 5_000)]


@pytest.mark.parametrize("texts", [mixed_texts(), [], [(1, None), (2, "")]])
def test_mixture_equals_sql(spark, texts):
    docs = frame(spark, texts)
    got = sorted(map(tuple, mixture(docs).collect()), key=repr)
    connection = duckdb.connect()
    table = docs.select("doc_id", "text", "source").toArrow()
    connection.register("documents", table)
    assert got == sorted(connection.execute(mixture_sql()).fetchall(), key=repr)
    assert all(0 <= r[4] <= MOST_REPEATS * r[1] for r in got)
    by_source = collections.defaultdict(int)
    for r in got:
        by_source[r[2], r[3]] += r[4]
    assert all(abs(taken - target) <= 64 for (_, target), taken in by_source.items())


def test_byte_bpe_equals_the_library(spark, sf_small):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()[:60]]
    texts += [(10**9, None), (10**9, ""), (None, "日本語 😀😀 don't  \t x1234'll"), (5, "<|endoftext|>" + "ab" * 2000)]
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})
    expected = []
    for i, text in texts:
        ids = library.encode_ordinary(text or "")
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        expected.append((i, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    got = round_trip(frame(spark, texts), RANKS, PATTERN).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    assert round_trip(frame(spark, []), RANKS, PATTERN).collect() == []
    cut = round_trip(frame(spark, texts), RANKS, PATTERN, cut_at_blanks=True).collect()
    assert sorted(map(tuple, cut), key=repr) == sorted(expected, key=repr)
    assert round_trip(frame(spark, []), RANKS, PATTERN, cut_at_blanks=True).collect() == []


def test_parts_have_the_words_of_the_text():
    """Cuts never divide a word or change one, whatever the white space; and a word alone is that word."""
    random.seed(8)
    words_in = regex.compile(PATTERN).findall
    spaces = [c for c in map(chr, range(0x3100)) if c.isspace() or regex.match(r"\s", c)]
    letters = [*"ab.1'sl", *spaces, *" \n\r\t" * 6, "\0", "é", "日", "'ll", "😀"]
    texts = ["", *("".join(random.choices(letters, k=random.randint(0, 12))) for _ in range(20_000))]
    for text, parts in zip(texts, parts_of(pa.array(texts)).to_pylist(), strict=True):
        assert "".join(parts) == text and sum(map(words_in, parts), []) == words_in(text)
    words = {w for text in texts for w in words_in(text)}
    assert all(words_in(w) == [w] for w in words)


def test_each_part_is_searched_and_looked_up_once():
    """Work in Python goes with the distinct parts of a bucket, not with all its words."""
    blocks = [pa.array([" aa b," * 50, "x", ""]), pa.array([], pa.string()), pa.array(["x aa b, aa c" * 30])]
    searched, asked = [], []

    def words_in(part):
        searched.append(part)
        return regex.findall(PATTERN, part)

    parts = [parts_of(b) for b in blocks]
    words = words_of_parts([p.flatten() for p in parts], words_in)
    assert len(searched) == len(set(searched)) == 6
    whole = [t for b in blocks for t in b.to_pylist()]
    assert set(words.to_pylist()) == {w for t in whole for w in regex.findall(PATTERN, t)}
    ids = pa.array([w.encode("utf-32-le") for w in words.to_pylist()], pa.binary())

    def made(given):
        asked.extend(given)
        return pa.array([p.encode("utf-32-le") for p in given], pa.binary())

    got = [i.decode("utf-32-le") for block in joined(parts, words, ids, made) for i in block.to_pylist()]
    assert got == whole
    assert sorted(asked) == sorted(set(searched) - set(words.to_pylist()))


def test_ids_are_decoded_in_slices(spark):
    """A batch is decoded a bounded slice at a time, and no row or column is lost or moved."""
    ids = [np.arange(n, dtype="<u4").tobytes() for n in (0, 5, 1_000, 2, 0, 700, 700, 1)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(8)), "ids": pa.array(ids, pa.binary())})
    parts = list(_slices(batch, 1, 3_000))
    assert [p.num_rows for p in parts] == [2, 1, 3, 2]
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()
    assert list(_slices(batch.slice(0, 0), 1)) == []
    rows = spark.createDataFrame([(None, b"old", ids[1], "a"), (3, None, ids[3], None)], "k int, ids2 binary, ids binary, z string")
    got = decode_documents(rows, RANKS, "ids2")
    pieces = {rank: piece for piece, rank in read_ranks(RANKS).items()}
    assert got.columns == rows.columns
    whole = {n: b"".join(pieces[i] for i in range(n)) for n in (5, 2)}
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(None, whole[5], ids[1], "a"), (3, whole[2], ids[3], None)], key=repr
    )


def test_long_words_merge_alike():
    ranks = read_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    random.seed(6)
    for n in (1, 2, 50, 3000):
        word = "".join(random.choice("theingaosr") for _ in range(n))
        assert merge_long(word.encode(), ranks) == library.encode_ordinary(word)


def test_language_model(spark):
    random.seed(7)
    words = {lang: [f"{lang}{random.choice('aeiou')}{k}" for k in range(60)] for lang in ("ba", "de", "ti")}
    texts = [(i, " ".join(random.choices(words[random.choice("ba de ti".split())], k=80))) for i in range(300)]
    texts += [(901, None), (902, ""), (None, "Ba never seen"), (903, "bao1 " * 3_000)]
    rows = score_texts(frame(spark, texts), RANKS, PATTERN).collect()
    assert len(rows) == len(texts)
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in texts}
    counts, ends = collections.Counter(), 0
    for i, text in texts:
        if not held[i]:
            counts.update(words_of(text or ""))
            ends += 1
    total, distinct = sum(counts.values()) + ends, len(counts) + 1

    def base(c):
        return np.log10((c + 0.1) / (total + 0.1 * (distinct + 1)))

    given = dict(texts)
    for r in rows:
        tokens = words_of(given[r.doc_id] or "")
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(tokens) + 1, total)
        assert r.n_known == 1 + sum(counts[t] > 0 for t in tokens)
        assert r.base_score == pytest.approx(sum(base(counts[t]) for t in tokens) + base(ends))
        assert np.isfinite(r.score) and r.score < 0
    test = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert sum(r.score for r in test) > sum(r.base_score for r in test)
    assert score_texts(frame(spark, []), RANKS, PATTERN).collect() == []


def test_no_pair_of_subwords_is_cut(spark, monkeypatch):
    """Scores are the same whatever bound is set on pairs, and in any number of parts."""
    random.seed(9)
    words = ["".join(random.choices("kzvxqwyj", k=9)) for _ in range(150)]
    docs = frame(spark, [(i, " ".join(random.choices(words, k=30)) + f" {words[i][:6]}") for i in range(60)])
    whole = {r.doc_id: r.score for r in score_texts(docs, RANKS, PATTERN).collect()}
    monkeypatch.setattr(lm, "MOST_PAIRS", 5, raising=False)
    monkeypatch.setattr(lm, "WORDS_PER_PART", 20, raising=False)
    cut = {r.doc_id: r.score for r in score_texts(docs, RANKS, PATTERN).collect()}
    assert cut == pytest.approx(whole, rel=1e-3)


def test_subwords_and_pairs_are_counted_as_arrays(spark, monkeypatch):
    """Counts of subwords and pairs by hand, over training words, in one run and in many."""
    random.seed(31)
    rows = [(b"w%d" % k, random.choice([0, 1, 5]), [1], random.choices(range(7), k=random.randint(1, 5))) for k in range(300)]
    words = spark.createDataFrame(rows, "word binary, n long, buckets array<int>, pieces array<int>").repartition(3)
    expected, pairs = np.zeros((9, 6), int), collections.Counter()
    for _, n, _, pieces in rows:
        if n:
            np.add.at(expected[:, 0], pieces, n)
            expected[pieces[0], 1:3] += n, 1
            expected[pieces[-1], 3] += 1
            np.add.at(expected[:, 4], pieces[:-1], 1)
            np.add.at(expected[:, 5], pieces[1:], 1)
            pairs.update(zip(pieces, pieces[1:]))
    for most in (lm.PAIRS_AT_ONCE, 10):
        monkeypatch.setattr(lm, "PAIRS_AT_ONCE", most)
        counts = lm.tallies(words, 9)
        assert counts.tolist() == expected.tolist()
        vocabulary, met = lm.learn_vocabulary(words, counts, 4)
        assert {(r.one, r.two): r.times for r in met.collect()} == pairs
        assert vocabulary.begun.tolist() == expected[:, 1].tolist()
        asked = lm._neighbours(words, F.length("word") % 2, 9).select("part", "one", "two").distinct().collect()
        assert {tuple(r) for r in asked} == {(len(w) % 2, *p) for w, _, _, ps in rows for p in zip(ps, ps[1:])}
    assert lm.tallies(words.where("n < 0"), 9).sum() == 0


def test_spellings_sum_to_one():
    pairs = [(0, 1, 4), (0, 2, 1), (1, 1, 2)]
    onward, arrived = [(0, 5), (1, 2)], [(1, 6), (2, 1)]
    vocabulary = lm.Vocabulary([(0, 5, 3)], [(1, 3)], onward, arrived, 3, 1)
    known = np.array([3 * a + b for a, b, _ in pairs]), np.array([n for _, _, n in pairs])
    for one in range(3):
        shares = vocabulary._follows(np.full(3, one), np.arange(3), known) - vocabulary.goes_on[one]
        assert (10**shares).sum() == pytest.approx(1)


def test_attention_learns_from_every_window_in_any_layout(spark):
    """The steps by hand, one round after the other, are those of any number of partitions."""

    class Given:
        frequencies = np.full(attention.CLASSES, 1 / attention.CLASSES)
        tokens = 30_000

    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 120, n).astype(np.uint8).tobytes() for n in (3_000, 20, 700, 5, 0, 64, 128, 900, 900)]
    rows = [(i, t, False) for i, t in enumerate(texts)] + [(99, texts[0], True), (None, texts[1], False)]
    encoded = spark.createDataFrame(rows, "doc_id long, classes binary, held_out boolean")
    training, _ = lm.training_rounds(encoded, Given.tokens, 4)
    values = attention.flat(attention.initial(Given.frequencies))
    steps, seen = attention.Adam(values, 4), 0
    for number in range(4):
        own = [bytes(r.classes) for r in training.where(f"round = {number}").collect()]
        slope, n = attention.summed_gradient(steps.values, *lm._sequences(own)) if own else (None, 0)
        seen += n
        if n:
            steps.follow(slope / n)
    assert seen == sum(len(t) + 1 for t in [*texts, texts[1]])
    expected = attention.shaped(steps.values)
    for partitions in (1, 7):
        got = lm.train_attention(encoded.repartition(partitions), Given, 4)
        assert np.allclose(got.output, expected["output"], atol=1e-4)
        assert np.allclose(got.embedding, expected["embedding"], atol=1e-4)
    assert not np.allclose(expected["output"], attention.initial(Given.frequencies)["output"], atol=1e-2)


def test_attention_reads_every_subword(spark):
    """Which of two words that begin alike comes next depends on later subwords only."""
    rare = [w for w in (f"zq{a}{b}" for a in "bdgkm" for b in "bdgkm")]
    ids = dict(zip(rare, lm.subwords([w.encode() for w in rare], RANKS, PATTERN)))
    begin = collections.Counter(i[0] for i in ids.values()).most_common(1)[0][0]
    one, two, three, four = [w for w in rare if ids[w][0] == begin and len(ids[w]) > 1][:4]
    random.seed(21)

    def text(follow):
        return " ".join(f"{w} {follow[w]}" for w in random.choices([one, two], k=60))

    fits, swapped = {one: three, two: four}, {one: four, two: three}
    held = [i for i in range(3_000) if zlib.crc32(str(i).encode()) % 10 == 0]
    training = [i for i in range(3_000) if zlib.crc32(str(i).encode()) % 10]
    texts = [(i, text(fits)) for i in training[:600]] + [(i, text(fits)) for i in held[:20]]
    words = dict(texts)
    texts += [(i, " ".join({three: four, four: three}.get(w, w) for w in words[k].split())) for k, i in zip(held, held[20:40])]
    score = {r.doc_id: r.score for r in score_texts(frame(spark, texts), RANKS, PATTERN).collect()}
    # Counts and first subwords hardly tell the two apart.
    for good, bad in zip(held, held[20:40]):
        assert score[good] > score[bad] + 5


def test_codes_of_subwords():
    """Every id that a word can hold has a code, no code begins another, and probabilities sum to one."""
    ranks = read_ranks(RANKS)
    times = [(i, 10_000 // (1 + k)) for k, i in enumerate(range(300, 3_000))]
    code = SubwordCode(ranks, times, 7)
    words = [w.encode().lower() for w in ("The", "caf\u00e9", "x\u00a0y", "don't", "\U0001f600\U0001f600", "a1b2", "\x1c", "'", "zqxv" * 9)]
    for pieces in lm.subwords(words, RANKS, PATTERN):
        assert all(code.codes[i] for i in pieces)
    given = sorted(c for c in code.codes if c)
    assert len(given) == len(set(given))
    assert not any(b.startswith(a) for a, b in zip(given, given[1:]))
    assert {len(c) for c in given} == {1, 2, 3}
    groups = np.array([code.groups[c[0]].argmax() for c in given])
    begins = np.array([p[:1] == b" " for p in sorted((p for p, i in ranks.items() if code.codes[i]), key=lambda p: code.codes[ranks[p]])])
    assert ((groups == 0) == begins).all()

    rng = np.random.default_rng(8)
    scorer = attention.Scorer.of(attention.initial(code.frequencies), code.frequencies)
    prefix = np.concatenate(([255], rng.integers(0, 100, 10)))
    p = np.array([scorer.places(prefix, np.append(prefix[1:], k), np.array([11]), code.groups)[0][-1] for k in range(256)])
    _, masses = scorer.places(prefix, np.append(prefix[1:], 0), np.array([11]), code.groups)
    assert p @ code.groups == pytest.approx(masses[-1], rel=1e-4)


def test_words_from_symbols():
    """First and further subwords of words, and ends, by hand."""
    groups = np.zeros((256, 3))
    groups[[1, 2, 255], 0] = groups[[3, 4], 1] = groups[[5, 6], 2] = 1
    targets = np.array([1, 5, 3, 6, 2, 255, 255, 2, 255])
    rng = np.random.default_rng(3)
    masses = rng.dirichlet(np.ones(3), len(targets))
    chosen = masses[np.arange(9), groups[targets].argmax(1)] * rng.random(9)
    places, first, further, is_word = log_of_words(chosen, masses, targets, groups)
    a, c, d = masses.T
    stop = a / (a + c)
    assert places.tolist() == [0, 4, 5, 6, 7, 8] and is_word.tolist() == [True, True, False, False, True, False]
    assert np.exp(first) == pytest.approx([chosen[0] / a[0] * chosen[1] / d[1], *(chosen[[4, 5, 6, 7, 8]] / a[[4, 5, 6, 7, 8]])])
    assert np.exp(further[[0, 1, 4]]) == pytest.approx([chosen[2] / (a + c)[2] * chosen[3] / d[3] * stop[4], stop[5], stop[8]])


def test_scores_do_not_follow_the_layout(spark):
    """The same scores with 1, 8 and 40 buckets, each better than the base on held-out documents."""
    random.seed(17)
    phrases = ["the cat sat on the mat", "a dog ran after the cat", "rain fell on the old town", "we sat by the sea"]
    texts = [(i, " ".join(random.choices(phrases, k=random.randint(1, 25)))) for i in range(400)]
    size = sum(len(t) for _, t in texts)
    docs, scores = frame(spark, texts), []
    for buckets in (1, 8, 40):
        rows = score_texts(docs, RANKS, PATTERN, bytes_per_bucket=-(-size // buckets)).collect()
        scores.append({r.doc_id: r.score for r in rows})
        held = [r for r in rows if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert scores[1] == pytest.approx(scores[0], rel=1e-3)
    assert scores[2] == pytest.approx(scores[0], rel=1e-3)


def test_all_training_documents_decide_on_the_share(spark):
    """The share of likeliest training documents, whatever part of them a bound would leave."""
    rng = np.random.default_rng(12)
    frequencies = rng.dirichlet(np.ones(attention.CLASSES))
    scorer = attention.Scorer.of(attention.initial(frequencies), frequencies)

    class Given:
        groups = np.eye(3)[[0] * 100 + [1] * 100 + [2] * 55 + [0]]
        tokens = 40 * lm.CLASSES_AT_ONCE

    rows = []
    for i in range(60):
        words = [bytes([rng.integers(0, 100), *rng.integers(100, 200, rng.integers(0, 4))]) for _ in range(30)]
        # Counts say little of most texts, much of a few, and more of held-out ones.
        counted = rng.normal(-1 if i % 10 == 0 else -25, 1, len(words)) * (i >= 5)
        rows.append((i, i >= 55, b"".join(words), counted.astype("<f4").tobytes(), 31, 31, -1.0))
    rows.append((None, False, b"", b"", 1, 1, -1.0))
    kinds = "doc_id long, held_out boolean, classes binary, counted binary, n_tokens long, n_known long, base_score double"
    scored = lm.scored_by_share(spark.createDataFrame(rows, kinds).repartition(3), scorer, Given)
    got = {r.doc_id: r.scores for r in scored.collect()}
    total = np.zeros(len(lm.SHARES))
    for i, held_out, classes, counted, *_ in rows:
        expected = np.zeros(len(lm.SHARES))
        for alone, text, by_attention, by_counts in lm.words_by_both([classes], [counted], scorer, Given.groups):
            mixed = [np.logaddexp(np.log(s) + by_attention, np.log(1 - s) + by_counts).sum() for s in lm.SHARES]
            expected += alone.sum() + np.array(mixed)
        assert got[i] == pytest.approx(expected, rel=1e-5)
        total += expected * (not held_out)
    assert lm.best_share(scored) == total.argmax()
    assert 0 < total.argmax() < len(lm.SHARES) - 1
    assert lm.best_share(scored.where("held_out")) == 0


def test_products_of_many_words_do_not_vanish():
    """A text of many unlikely words, texts without words, and probabilities far below what a double holds."""
    rng = np.random.default_rng(5)
    text = np.repeat([0, 2, 3], [1_000, 1, 250])
    both = rng.normal(-500, 200, (2, len(text)))
    both[1, 7] = -np.inf
    got = lm.logs_by_share(*both, text, 5)
    for k, share in enumerate(lm.SHARES):
        mixed = np.logaddexp(np.log(share) + both[0], np.log1p(-share) + both[1])
        assert got[:, k] == pytest.approx(np.bincount(text, weights=mixed, minlength=5), rel=1e-12)
    assert lm.logs_by_share(*both[:, :0], text[:0], 2).tolist() == np.zeros((2, len(lm.SHARES))).tolist()


def test_a_score_follows_from_counts_and_weights():
    """Class by class over overlapping windows, from the weights themselves."""
    rng = np.random.default_rng(2)
    frequencies = rng.dirichlet(np.ones(attention.CLASSES))
    w = attention.initial(frequencies)
    w["lag"] = rng.normal(size=attention.WINDOW) * 0.3
    classes = rng.integers(0, 126, 150).astype(np.uint8).tobytes()
    inputs, targets, lengths = lm._sequences([classes])
    total = 0.0
    for place in range(len(inputs)):
        first = 0 if place < 64 else (place - 16) // 48 * 48
        seen = inputs[first : place + 1]
        e = w["embedding"][seen]
        lags = w["lag"][place - first - np.arange(len(seen))]
        logits = (e[-1] @ w["query"]) @ (e @ w["key"]).T / 4 + lags
        share = np.exp(logits - logits.max())
        h = share / share.sum() @ (e @ w["value"]) + e[-1]
        guess = np.exp(h @ w["output"] + w["bias"])
        p = 0.95 * guess[targets[place]] / guess.sum() + 0.05 * frequencies[targets[place]]
        total += np.log10(p)
    assert attention.Scorer.of(w, frequencies).log10(inputs, targets, lengths)[0] == pytest.approx(total, rel=1e-4)


def test_attention_gradient_and_windows():
    rng = np.random.default_rng(0)
    w = attention.initial(np.full(attention.CLASSES, 1 / attention.CLASSES))
    w["lag"] = rng.normal(size=attention.WINDOW) * 0.1
    x, y = (rng.integers(0, attention.CLASSES, (3, attention.WINDOW)) for _ in range(2))
    counted = np.arange(attention.WINDOW) < np.array([64, 30, 5])[:, None]
    _, slopes = attention.gradient(w, x, y, counted)
    for name, shape in attention.SHAPES.items():
        at = (x[0, 0], 3) if name == "embedding" else (2,) if len(shape) == 1 else (1, 2)
        value, step = w[name][at], 1e-5
        w[name][at] = value + step
        above = attention.gradient(w, x, y, counted)[0]
        w[name][at] = value - step
        below = attention.gradient(w, x, y, counted)[0]
        w[name][at] = value
        assert slopes[name][at] == pytest.approx((above - below) / (2 * step), abs=1e-7)
    lengths = np.array([1, 64, 65, 200, 0, 113])
    starts, held, first = attention.windows(lengths)
    scored = np.concatenate([s + np.arange(f, h) for s, h, f in zip(starts, held, first)])
    assert sorted(scored.tolist()) == list(range(int(lengths.sum())))


def test_windows_are_no_longer_than_what_they_hold(monkeypatch):
    """Short texts are learned and scored in short windows, with the same results."""
    rng = np.random.default_rng(6)
    frequencies = rng.dirichlet(np.ones(attention.CLASSES))
    w = attention.initial(frequencies)
    w["lag"] = rng.normal(size=attention.WINDOW) * 0.2
    scorer, groups = attention.Scorer.of(w, frequencies), np.eye(3)[np.arange(attention.CLASSES) % 3]
    texts = [rng.integers(0, 255, n).astype(np.uint8).tobytes() for n in (*[9] * 70, 3, 0, 64, 200, 75, 15, 16, 17)]
    sequences = lm._sequences(texts)
    shapes, rows = set(), attention.Scratch.rows

    def noted(self, name, table, at):
        shapes.add((name, at.shape[-1]))
        return rows(self, name, table, at)

    monkeypatch.setattr(attention.Scratch, "rows", noted)
    values = attention.flat(w)
    total, n = attention.summed_gradient(values, *sequences)
    chosen, masses = scorer.places(*sequences, groups)
    assert {size for name, size in shapes if name in ("e", "keys")} >= {10, 64}
    one = [attention.summed_gradient(values, *lm._sequences([t])) for t in texts]
    assert n == sum(m for _, m in one) == len(sequences[0])
    assert total == pytest.approx(sum(slope for slope, _ in one), abs=2e-3)
    alone = [scorer.places(*lm._sequences([t]), groups) for t in texts]
    assert chosen == pytest.approx(np.concatenate([c for c, _ in alone]), rel=1e-4)
    assert masses == pytest.approx(np.concatenate([m for _, m in alone]), rel=1e-4)
    empty = scorer.places(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), groups)
    assert [len(a) for a in empty] == [0, 0]


@pytest.mark.parametrize("size", [1, 60])
def test_large_weights_give_the_same_gradient(size, monkeypatch):
    """Exponentials get a factor where single precision would not hold them."""
    rng = np.random.default_rng(7)
    w = attention.initial(np.full(attention.CLASSES, 1 / attention.CLASSES))
    w["query"] = w["query"] * size
    w["output"] = w["output"] * size
    x, y = (rng.integers(0, attention.CLASSES, (3, attention.WINDOW)) for _ in range(2))
    counted = np.arange(attention.WINDOW) < np.array([64, 30, 5])[:, None]
    loss, slopes = attention.gradient({k: v.astype(np.float32) for k, v in w.items()}, x, y, counted)
    monkeypatch.setattr(attention, "SAFE_POWER", 1e9 if size == 1 else -1)
    expected, wanted = attention.gradient(w, x, y, counted)
    assert np.isfinite(loss) and loss == pytest.approx(expected, rel=1e-3)
    for name in attention.SHAPES:
        assert slopes[name] == pytest.approx(wanted[name], abs=1e-4 * size)


def test_scores_are_probabilities_of_the_model():
    """Tables give what the trained weights give, and the next class has probability one in all."""
    rng = np.random.default_rng(1)
    frequencies = rng.dirichlet(np.ones(attention.CLASSES))
    w = attention.initial(frequencies)
    scorer = attention.Scorer.of(w, frequencies)
    prefix = rng.integers(0, attention.CLASSES, 20)
    total = 0.0
    for guess in range(attention.CLASSES):
        inputs, targets = np.append([127], prefix), np.append(prefix, guess)
        whole = scorer.log10(inputs, targets, np.array([21]))[0]
        part = scorer.log10(inputs[:20], targets[:20], np.array([20]))[0]
        total += 10 ** (whole - part)
    assert total == pytest.approx(1, abs=1e-3)


def test_known_words_travel_compressed(spark):
    """What is known of words, and texts, are shuffled as blocks far below their size, and nothing is lost."""
    rng = np.random.default_rng(9)
    names = ["bucket", "word", "n", "symbols", "counted"]
    kinds = [pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.float32()]
    rows = [(k % 3, b"word%d" % (k // 3), k % 7, bytes([k % 5, 1]), -float(k % 50)) for k in range(30_000)]
    rows = [rows[k] for k in rng.permutation(len(rows))]
    whole = pa.table([pa.array([r[n] for r in rows], kind) for n, kind in enumerate(kinds)], names)
    batches = whole.to_batches(7_000)
    packed_rows = list(lm._pack_known(iter([batches[0].slice(0, 0), *batches])))
    found = [
        (bucket, *row.values())
        for out in packed_rows
        for bucket, block in zip(out.column("bucket").to_pylist(), out.column("block"))
        for row in next(unpacked([block])).to_pylist()
    ]
    assert sorted(found) == sorted((b, w, n, y, c) for b, w, n, y, c in whole.to_pandas().itertuples(index=False))
    assert sum(out.nbytes for out in packed_rows) < 0.3 * whole.nbytes
    docs = frame(spark, [(k, f"text {k} " + "of many words " * 20) for k in range(500)] + [(None, None)])
    blocks, buckets, doc_id = packed(docs, 50_000, F.lit(True).alias("held_out"))
    got = [(b.bucket, *row.values()) for b in blocks.collect() for row in next(unpacked(pa.array([bytes(b.block)]))).to_pylist()]
    assert (buckets, doc_id) == (3, "bigint") and {b for b, *_ in got} == {0, 1, 2}
    assert sorted((r[1:] for r in got), key=repr) == sorted(((r.doc_id, r.text or "", True) for r in docs.collect()), key=repr)


def test_packed_words_come_back():
    ids = np.arange(9, dtype="<u4")
    rows = [(1, "é", ids[:1]), (0, "b\0c", ids[:2]), (1, "a" * 512, np.resize(ids, 512)), (1, "", ids[:0])]
    columns = [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string())]
    batch = pa.RecordBatch.from_arrays(
        [*columns, pa.array([r[2].tobytes() for r in rows], pa.binary())], ["bucket", "word", "ids"]
    )
    found = [
        (bucket.as_py(), word, given)
        for out in pack_words(iter([batch.slice(0, 0), batch.slice(1), batch.slice(0, 1)]))
        for bucket, block in zip(out.column("bucket"), out.column("block"))
        for word, given in unpacked_words(block.as_py())
    ]
    assert sorted(found) == sorted((b, w, i.tobytes()) for b, w, i in rows)
    assert list(pack_words(iter([]))) == []


def merged_plainly(word, ranks):
    pieces = [word[i : i + 1] for i in range(len(word))]
    while True:
        pairs = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(pieces, pieces[1:])) if a + b in ranks]
        if not pairs:
            return [ranks.get(p, 2**31 - 1) for p in pieces]
        at = min(pairs)[1]
        pieces[at : at + 2] = [pieces[at] + pieces[at + 1]]


def test_the_fold_merges_numbers(spark):
    random.seed(9)
    words = {"".join(random.choice(letters) for _ in range(n)) for letters in ("ab", "the ", "é\0z") for n in range(1, 30)}
    words |= {"a" * 512, " internationalization", "\U0001f600"}
    # With gaps between the ids, pieces of several cuts, and without most bytes.
    pieces = [b"a", b"b", b"ba", b"aa", b"ab", b"aab", b"aba", b"abab", b"xt", b"th", b"the"]
    few = {piece: 7 * k + 3 for k, piece in enumerate(pieces)}
    for ranks in (read_ranks(RANKS), few):
        given = spark.createDataFrame([(w,) for w in sorted(words)], "word string")
        for word, ids in given.select("word", encoded_word(F.col("word"), ranks).alias("ids")).collect():
            assert ids == merged_plainly(word.encode(), ranks), word


def test_plans_do_not_hold_the_ranks(spark):
    words = [" the", "internationalization", "é\0z", " "]
    given = spark.createDataFrame([(w, 1) for w in words], "word string, n int")
    read = with_ids(given, read_ranks(RANKS))
    plan = read._jdf.queryExecution()
    for step in (plan.optimizedPlan(), plan.executedPlan()):
        assert len(step.toString()) < 200_000  # 108,299 pairs take millions
        assert " AS slots" not in step.toString()  # no row holds the array
    assert read.columns == ["word", "n", "ids"]
    for word, _, ids in read.collect():
        assert ids == merged_plainly(word.encode(), read_ranks(RANKS)), word


def test_no_ranks_encode_no_words(spark):
    given = spark.createDataFrame([("ab",)], "word string")
    assert [ids for _, ids in with_ids(given, {}).collect()] == [[2**31 - 1] * 2]


def test_words_of_many_texts_at_once():
    random.seed(4)
    letters = " \t\n\r\x0b\x0caBÉé\x1c\x85\xa0Z\0x"
    texts = ["", " ", "  a", "a ", "\x0b"]
    texts += ["".join(random.choices(letters, k=random.randrange(40))) for _ in range(300)]
    lists = lm.word_lists(pa.array(texts))
    assert lists.to_pylist() == [words_of(t) for t in texts]
    assert lm.word_lists(pa.array(texts).slice(7, 50)).to_pylist() == [words_of(t) for t in texts[7:57]]
    arrays = [lists.flatten(), pa.array([], pa.binary()), lists.flatten().slice(5, 9)]
    distinct, numbers = lm.numbered(arrays)
    assert len(set(distinct.to_pylist())) == len(distinct)
    assert [distinct.take(pa.array(n)).to_pylist() for n in numbers] == [a.to_pylist() for a in arrays]


def bucket_of(texts, words):
    """A bucket as ``looked_up`` gets it; the n-th word occurred n times and has n % 3 + 1 symbols."""
    numbers = np.arange(len(words))
    rows = {
        "word": pa.array(words, pa.binary()),
        "n": pa.array(numbers),
        "symbols": pa.array([bytes([n % 256]) * (n % 3 + 1) for n in numbers], pa.binary()),
        "counted": pa.array(-numbers.astype(np.float32)),
    }
    own = pa.table({"doc_id": pa.array(range(len(texts))), "text": texts, "held_out": [False] * len(texts)})
    blocks = [compressed(own.slice(0, 2)), compressed(own.slice(2))]
    halves = [pa.table(rows).slice(len(words) // 2), pa.table(rows).slice(0, len(words) // 2)]
    return pa.table({"block": pa.array(blocks)}), pa.table({"block": pa.array([compressed(h) for h in halves])})


GIVEN = [("doc_id", pa.int64()), ("held_out", pa.bool_())]


def test_a_bucket_is_looked_up_text_by_text():
    vocabulary = lm.Vocabulary([(0, 10, 4)], [], [], [], 1, 3)
    texts, known = bucket_of(["b A b", "", " c\n", "a c"], [b"a", b"b", b"c"])
    found = lm.looked_up(texts, known, vocabulary, GIVEN).to_pylist()
    symbols, n = {"a": b"\0", "b": b"\1\1", "c": b"\2\2\2"}, {"a": 0, "b": 1, "c": 2}
    for row, words in zip(found, ["bab", "", "c", "ac"], strict=True):
        assert row["classes"] == b"".join(symbols[w] for w in words)
        assert np.frombuffer(row["counted"], "<f4").tolist() == [-n[w] for w in words]
        assert (row["n_tokens"], row["n_known"]) == (len(words) + 1, sum(n[w] > 0 for w in words) + 1)
        counts = np.array([n[w] for w in words] + [3])
        assert row["base_score"] == pytest.approx(vocabulary.base(counts).sum())
    texts, known = bucket_of(["b d", "", ""], [b"b"])
    with pytest.raises(KeyError):
        lm.looked_up(texts, known, vocabulary, GIVEN)
    texts, known = bucket_of(["", " ", ""], [])
    assert [r["n_tokens"] for r in lm.looked_up(texts, known, vocabulary, GIVEN).to_pylist()] == [1, 1, 1]


def test_a_bucket_of_many_words_takes_little_memory():
    words = [f"w{i}" for i in range(100_000)]
    texts, known = bucket_of([" ".join(words[k::10]) for k in range(10)], [w.encode() for w in words])
    vocabulary = lm.Vocabulary([(0, 10, 4)], [], [], [], 1, 3)
    tracemalloc.start()
    lm.looked_up(texts, known, vocabulary, GIVEN)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 12_000_000  # as objects in a dictionary and a list the words took 16 MB
