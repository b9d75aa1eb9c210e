"""Toxic passages as maximum-scoring segments of token log-odds.

Counting: a Spark table holds, by class, how many labelled training documents
have a word, and the same by stem; counting documents keeps one text that repeats
itself from speaking for its class. The log-odds of a word between toxic and clean
documents have a Dirichlet prior that follows its beginning of seven letters, whose
own prior follows that of six, and so on down to three, so rare and unseen words
take after their stems.

Searching: words whose log-odds are large and significant keep them, all others
have none, and a drift is taken off every word, which makes clean text score
below zero. One linear scan finds all maximal scoring segments of a text. A segment of score S in n words has the extreme-value tail
``K n exp(-lambda S)`` in clean text; lambda and K are fitted to the best
segments of clean training documents. The evidence ``lambda S - ln(K n)`` of the
best segment, and of all significant ones together, gives a probability by a
logistic calibration, for which documents are scored by counts without those of
their own third.

Log-odds are computed where the counts are, all names with one beginning of three
letters together. The model that is broadcast has the telling words, the stems that
make a word tell which was never counted, and the counted names below such stems that
do not tell: any other word, counted or not, scores minus the drift. Documents are only
mapped over, whole, and never shuffled. Labels are joined as a broadcast sample
of at most ``LABELLED_ROWS`` rows; calibration takes ``CALIBRATION_ROWS`` of
these. Everything else is computed over all documents.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codays.llm.buckets import give_back
from codays.llm.common import ids_and_texts, remainder, text_of, whole_row
from codays.session import staged

LABELLED_ROWS = 200_000
CALIBRATION_ROWS = 20_000
HELD_OUT_MODULUS = 5
STEMS = (3, 4, 5, 6, 7)
PRIOR = 4.0
#: A word counts as toxic from this log-odds and this many standard deviations on.
LEAST_LOG_ODDS, SIGNIFICANCE = 2.0, 3.0
DRIFT = 0.1
MOST_REMEMBERED = 400_000
#: Names whose counts a worker holds before it hands them on, about 30 MB.
MOST_COUNTED = 200_000
#: Parts of the labelled documents; each is scored by counts of the others.
FOLDS = 3
#: Counts of all parts are kept in one number, so many bits for each; there may be fewer labelled rows than that.
BITS = 21
GROUPS = 96
WORDS = re.compile(r"\w+").findall


def keys_of(word: str) -> list[str]:
    """Names of the stems of a word and of the word itself, widest class first.

    A word that is shorter than a stem is the only one with it.
    """
    return [f"{n}{word[:n]}" if len(word) >= n else f"0{word}" for n in STEMS] + [f"0{word}"]


def words_of(text: str) -> list[str]:
    return WORDS(text.lower())


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, stop, score), in one scan.

    A segment is maximal when no shorter or longer overlapping one scores more.
    Neighbouring positive scores are taken as one step.
    """
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    total = np.concatenate(([0.0], np.cumsum(scores)))
    breaks = np.flatnonzero(np.diff(positive) > 1)
    starts = positive[np.concatenate(([0], breaks + 1))].tolist()
    stops = (positive[np.concatenate((breaks, [len(positive) - 1]))] + 1).tolist()
    found: list[tuple[int, int, float, float]] = []
    links: list[int] = []  # the nearest earlier segment that begins lower
    for start, stop in zip(starts, stops):
        low, high = float(total[start]), float(total[stop])
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j = links[j]
            if j < 0 or found[j][3] >= high:
                break
            start, low = found[j][0], found[j][2]
            del found[j:], links[j:]
        found.append((start, stop, low, high))
        links.append(j)
    return [(start, stop, high - low) for start, stop, low, high in found]


@dataclass
class ToxicityModel:
    """Log-odds of telling names, the extreme-value law and the calibration.

    ``telling`` has the log-odds of telling words (with a 0 in front) and of stems
    (with their length) whose words tell when they were not counted themselves;
    ``plain`` has the counted names below such a stem that do not tell.
    """

    telling: dict[str, float]
    plain: frozenset[str]
    decay: float = 1.0
    log_rate: float = 0.0
    weights: tuple[float, ...] = (-2.0, 1.0, 0.0)
    known: dict[str, float] = field(default_factory=dict)

    def word_score(self, word: str) -> float:
        """The log-odds of a word, or of its longest counted stem, less the drift."""
        name = f"0{word}"
        odds = self.telling.get(name)
        if odds is None and name not in self.plain:
            for n in reversed(STEMS):
                if len(word) >= n:
                    stem = f"{n}{word[:n]}"
                    odds = self.telling.get(stem)
                    if odds is not None or stem in self.plain:
                        break
        return (odds or 0.0) - DRIFT

    def token_scores(self, words: list[str]) -> np.ndarray:
        unknown = set(words).difference(self.known)
        if unknown:
            self.known.update((word, self.word_score(word)) for word in unknown)
        return np.fromiter(map(self.known.__getitem__, words), np.float64, len(words))

    def forget(self) -> None:
        if len(self.known) > MOST_REMEMBERED:
            self.known = {}

    def passages(self, scores: np.ndarray) -> list[tuple[int, int, float]]:
        """Significant segments with their evidence: less than one is expected by chance."""
        n = max(1, len(scores))
        judged = [
            (start, stop, self.decay * s - self.log_rate - float(np.log(n)))
            for start, stop, s in maximal_segments(scores)
        ]
        return [p for p in judged if p[2] > 0]

    def probability(self, passages: list[tuple[int, int, float]]) -> float:
        x = self.weights[0] + sum(w * f for w, f in zip(self.weights[1:], evidence(passages)))
        return float(1 / (1 + np.exp(-np.clip(x, -500, 500))))


def evidence(passages: list[tuple[int, int, float]]) -> tuple[float, float]:
    """Of the best passage and of all together, on a scale of logarithms."""
    best = max((p[2] for p in passages), default=0.0)
    return float(np.log1p(best)), float(np.log1p(sum(p[2] for p in passages)))


def fit_extreme_values(best: np.ndarray, sizes: np.ndarray) -> tuple[float, float]:
    """lambda and ln K of the law of best segment scores among clean texts.

    Fitted to the quartiles, so that a few mislabelled texts do not bend it.
    """
    decay = 1.0
    if len(best) < 2:
        return decay, 0.0
    low, middle, high = (-np.log(-np.log(q)) for q in (0.25, 0.5, 0.75))
    for _ in range(50):
        below, above = np.quantile(best - np.log(sizes) / decay, [0.25, 0.75])
        now = float((high - low) / max(above - below, 1e-3))
        if abs(now - decay) < 1e-6:
            break
        decay = (decay + now) / 2
    return decay, float(decay * np.quantile(best - np.log(sizes) / decay, 0.5) - middle)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic regression by Newton steps, the constant first."""
    design = np.column_stack((np.ones(len(x)), x))
    weights = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -500, 500)))
        slope = design.T @ (y - p) - ridge * weights
        curve = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _labelled(docs: DataFrame, labels: DataFrame, rows: int, training: Column) -> DataFrame:
    """toxic, fold and text of at most ``rows`` labelled training documents, by seeded draw."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).select(
        "doc_id", (F.col("toxic") != 0).alias("toxic")
    )
    drawn = usable.where(training).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = drawn.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    fold = F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(FOLDS)).cast("int").alias("fold")
    # At most ``rows`` ids and flags, a few megabytes whatever the corpus.
    return ids_and_texts(docs).join(F.broadcast(sample), "doc_id").select("toxic", fold, "text")


def count_classes(labelled: DataFrame) -> DataFrame:
    """name, toxic, clean: how many toxic and clean documents of each fold have a word or stem.

    The counts of all folds share one number, ``BITS`` for each. The table is
    staged.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: tuple[dict[str, int], dict[str, int]] = ({}, {})
        keys: dict[str, list[str]] = {}

        def told() -> pa.RecordBatch:
            clean, toxic = sums
            names = list(clean.keys() | toxic.keys())
            columns = [pa.array([own.get(name, 0) for name in names], pa.int64()) for own in (toxic, clean)]
            clean.clear(), toxic.clear(), keys.clear()
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *columns], ["name", "toxic", "clean"])

        for batch in batches:
            for toxic, fold, text in zip(*(batch.column(c).to_pylist() for c in ("toxic", "fold", "text"))):
                own, one, found = sums[toxic], 1 << (BITS * fold), set()
                for word in set(words_of(text)):
                    if word not in keys:
                        keys[word] = keys_of(word)
                    found.update(keys[word])
                for name in found:
                    own[name] = own.get(name, 0) + one
                if len(sums[0]) + len(sums[1]) > MOST_COUNTED or len(keys) > MOST_COUNTED:
                    yield told()
        yield told()
        give_back()

    counted = labelled.mapInArrow(count, "name string, toxic bigint, clean bigint")
    return staged(
        counted.groupBy("name").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "class-counts"
    )


def by_fold(packed: np.ndarray) -> np.ndarray:
    """Counts without each fold, and of all folds, as columns."""
    folds = np.stack([packed >> (BITS * k) & ((1 << BITS) - 1) for k in range(FOLDS)], axis=1).astype(np.float64)
    whole = folds.sum(axis=1, keepdims=True)
    return np.concatenate((whole - folds, whole), axis=1)


def log_odds(names: list[str], toxic: np.ndarray, clean: np.ndarray, scale: np.ndarray):
    """Log-odds, telling, and below a telling stem, for names by set of counts.

    ``names`` are all that begin with the same three letters, in any order; counts
    have a column for each set. A stem counts as telling if it makes an uncounted
    word tell.
    """
    place = {name: k for k, name in enumerate(names)}
    odds = np.zeros(toxic.shape)
    share = np.full(toxic.shape, 0.5)
    telling, below = np.zeros(toxic.shape, bool), np.zeros(toxic.shape, bool)

    def apply(at: np.ndarray) -> None:
        prior = PRIOR * share[at], PRIOR * (1 - share[at])
        t, c = toxic[at] + prior[0], clean[at] * scale + prior[1]
        odds[at] = np.log(t / c)
        share[at] = np.clip(t / (t + c), 1e-6, 1 - 1e-6)

    def follow(at: np.ndarray, above: list[str | None]) -> None:
        has = np.array([stem in place for stem in above], bool)
        if has.any():
            up = np.array([place[stem] for stem, there in zip(above, has) if there])
            share[at[has]] = share[up]
            below[at[has]] = below[up] | telling[up]

    by_level: dict[int, list[int]] = {}
    for k, name in enumerate(names):
        by_level.setdefault(int(name[0]), []).append(k)
    for n in STEMS:
        at = np.array(by_level.get(n, []), np.int64)
        if len(at):
            follow(at, [f"{n - 1}{names[k][1:n]}" for k in at])
            apply(at)
            telling[at] = odds[at] > max(LEAST_LOG_ODDS, SIGNIFICANCE * (4 / PRIOR) ** 0.5)
    at = np.array(by_level.get(0, []), np.int64)
    if len(at):
        depth = np.array([sum(len(names[k]) - 1 >= n for n in STEMS) for k in at])
        follow(at, [f"{STEMS[d - 1]}{names[k][1 : STEMS[d - 1] + 1]}" if d else None for k, d in zip(at, depth)])
        # A word that is shorter than a stem stands in for it as well.
        for times in range(len(STEMS) + 1):
            apply(at[times <= len(STEMS) - depth])
        spread = np.sqrt(1 / (toxic[at] + PRIOR / 2) + 1 / (clean[at] + PRIOR / 2))
        telling[at] = (odds[at] > LEAST_LOG_ODDS) & (odds[at] > SIGNIFICANCE * spread)
    return odds, telling, below


def learn_names(counts: DataFrame) -> list[ToxicityModel]:
    """A model without each fold, and one of all counts. Only names that matter reach the driver."""
    whole = counts.where(F.col("name").startswith("0"))
    mask = (1 << BITS) - 1
    folds = [F.sum(F.shiftright(c, BITS * k).bitwiseAND(F.lit(mask))) for c in ("toxic", "clean") for k in range(FOLDS)]
    sums = np.array([n or 0 for n in whole.agg(*folds).first()], np.float64).reshape(2, FOLDS)
    sums = np.append(sums.sum(axis=1, keepdims=True) - sums, sums.sum(axis=1, keepdims=True), axis=1)
    scale = (sums[0] + 1) / (sums[1] + 1)

    def judge(table: pa.Table) -> pa.Table:
        names = table.column("name").to_pylist()
        toxic, clean = (by_fold(table.column(c).to_numpy()) for c in ("toxic", "clean"))
        odds, telling, below = log_odds(names, toxic, clean, scale)
        rows, sets = np.nonzero(telling | below)
        return pa.table(
            {
                "name": pa.array([names[k] for k in rows], pa.string()),
                "counts": pa.array(sets.astype(np.int32)),
                "odds": pa.array(odds[rows, sets], mask=~telling[rows, sets]),
            }
        )

    root = F.left(F.substring("name", 2, 3), F.lit(3))
    group = F.pmod(F.xxhash64(root), F.lit(GROUPS)).cast("int").alias("group")
    judged = counts.select(group, "name", "toxic", "clean").groupBy("group").applyInArrow(
        judge, "name string, counts int, odds double"
    )
    found = judged.collect()
    models = []
    for k in range(FOLDS + 1):
        own = [r for r in found if r["counts"] == k]
        models.append(
            ToxicityModel(
                {r.name: r.odds for r in own if r.odds is not None}, frozenset(r.name for r in own if r.odds is None)
            )
        )
    return models


def train(
    docs: DataFrame,
    labels: DataFrame,
    training: Column | None = None,
    labelled_rows: int = LABELLED_ROWS,
    calibration_rows: int = CALIBRATION_ROWS,
) -> ToxicityModel:
    """Learn from labelled documents where ``training`` holds for the doc_id.

    Labels with a null id or class are left out, and an id labelled twice is
    toxic if either label says so; a document that comes several times counts as
    often. Without any labelled document of either class every text is scored as
    clean.
    """
    if training is None:
        training = remainder(HELD_OUT_MODULUS) != 0
    *partial, model = learn_names(count_classes(_labelled(docs, labels, labelled_rows, training)))
    shared = docs.sparkSession.sparkContext.broadcast(partial)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for is_toxic, fold, text in zip(*(batch.column(c).to_pylist() for c in ("toxic", "fold", "text"))):
                words, without = words_of(text), shared.value[fold]
                without.forget()
                found = maximal_segments(without.token_scores(words))
                rows.append((is_toxic, max(1, len(words)), [s for _, _, s in found]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.bool_(), pa.int64(), pa.list_(pa.float64())))],
                ["toxic", "n", "scores"],
            )

    sample = _labelled(docs, labels, calibration_rows, training)
    described = staged(
        sample.mapInArrow(describe, "toxic boolean, n bigint, scores array<double>"), "segments"
    )
    seen = described.select("toxic", "n", F.coalesce(F.array_max("scores"), F.lit(0.0)).alias("best")).toPandas()
    is_toxic = seen["toxic"].to_numpy(dtype=bool)
    if not is_toxic.any() or is_toxic.all():
        return model
    best, size = seen["best"].to_numpy(), seen["n"].to_numpy()
    calm = ~is_toxic & (best > 0)
    model.decay, model.log_rate = fit_extreme_values(best[calm], size[calm])
    # Two numbers a text reach the driver, however many segments it has.
    judged = F.transform("scores", lambda s: model.decay * s - model.log_rate - F.log("n"))
    told = F.filter(judged, lambda e: e > 0)
    none = F.lit(0.0)
    seen = described.select(
        "toxic",
        F.log1p(F.coalesce(F.array_max(told), none)).alias("best"),
        F.log1p(F.aggregate(told, none, lambda total, e: total + e)).alias("together"),
    ).toPandas()
    is_toxic, features = seen["toxic"].to_numpy(dtype=bool), seen[["best", "together"]].to_numpy()
    model.weights = tuple(fit_logistic(features, is_toxic.astype(float)).tolist())
    return model


def score_texts(
    docs: DataFrame, model: ToxicityModel, score: str, passages: str, text: str = "text"
) -> DataFrame:
    """``docs`` with the probability that ``text`` is toxic and its toxic passages.

    Passages are (start, stop, evidence) in words, in order. Null and empty texts
    have none. All columns and rows pass through; ``score`` and ``passages`` name
    the new columns and must not be taken.
    """
    if {score, passages} & set(docs.columns):
        raise ValueError(f"columns {score!r} and {passages!r} must be new")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = "struct<start:int,stop:int,evidence:double>"

    @F.arrow_udf(f"struct<score:double,passages:array<{span}>>")
    def judge(texts: pa.Array) -> pa.Array:
        judge_model = shared.value
        judge_model.forget()
        rows = []
        for text in texts.to_pylist():
            found = judge_model.passages(judge_model.token_scores(words_of(text)))
            rows.append(
                {
                    "score": judge_model.probability(found),
                    "passages": [{"start": a, "stop": b, "evidence": e} for a, b, e in found],
                }
            )
        kind = pa.struct(
            [
                ("score", pa.float64()),
                (
                    "passages",
                    pa.list_(
                        pa.struct(
                            [("start", pa.int32()), ("stop", pa.int32()), ("evidence", pa.float64())]
                        )
                    ),
                ),
            ]
        )
        return pa.array(rows, kind)

    # Names stay apart from those of ``docs``, whatever these are.
    inner = docs.select(whole_row(docs), judge(text_of(text)).alias("judged"))
    return inner.select("row.*", F.col("judged.score").alias(score), F.col("judged.passages").alias(passages))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What the registered query returns, one row per row of ``docs``.

    doc_id, held_out, score, predicted, n_passages. Null ids are scored like any
    other, null and empty texts have no passage, repeated rows are scored alike;
    an empty table gives no rows. Only doc_id and text are read.
    """
    model = train(docs, labels)
    scored = score_texts(docs.select("doc_id", "text"), model, "score", "passages")
    return scored.select(
        "doc_id",
        (remainder(HELD_OUT_MODULUS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").cast("long").alias("n_passages"),
    )
