"""Hard negatives of anchors by Four-Russians scoring.

An anchor's vector is cut into groups of eight dimensions. For each group a table
holds the sums of all 256 subsets of its eight numbers. A candidate is kept as
bit planes: plane ``k`` holds bit ``k`` of every component in two's complement,
packed into one byte for each group. Such a byte is the place of a subset in the
group's table, so the inner product is made of look-ups alone: from the top
plane, which counts negatively, down to the lowest one, the total is doubled and
the looked-up sums of the plane are added. Scores are whole and exact.

Anchors and candidates meet in blocks of bounded size, twice: first for the best
rows of an anchor's own label, its positives, then, when their scores are known
from all blocks, for rows of other labels below each positive's score. Only the
best few of every block go on. Equal vectors of one label are one entry, of whose
copies only the smallest ids can appear in an answer.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codays.session import staged

SCALE = 256
ANCHOR_STEP = 50
POSITIVES = 5
NEGATIVES = 3
#: A negative scores between these hundredths of its positive's score.
LEAST_SHARE, MOST_SHARE = 50, 95
ANCHORS_PER_BLOCK = 1024
CANDIDATES_PER_BLOCK = 4096
GROUP = 8
TABLE_BYTES = 1 << 22
NUMBERS_AT_ONCE = 1 << 18


def whole_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label and q = floor(scale * x) of every row that takes part.

    Rows without id, label or vector and vectors with a null or non-finite
    component take no part. Components whose products could leave 64 bits (beyond
    2^28 for 64 dimensions) count as the last number that cannot.
    """
    x = F.col("embedding")
    usable = x.isNotNull() & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf"))
    )
    most = F.floor(F.sqrt(F.lit(2.0**62) / F.greatest(F.size(x), F.lit(1)))).cast("double")

    def whole(v):
        return F.greatest(F.least(F.floor(F.lit(float(scale)) * v.cast("double")).cast("double"), most), -most)

    known = F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    return embeddings.where(known & usable).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.transform(x, lambda v: whole(v).cast("long")).alias("q"),
    )


def bit_planes(vectors: np.ndarray, bits: int) -> np.ndarray:
    """Bytes by row, plane and group of eight dimensions."""
    rows, width = vectors.shape
    groups = -(-width // GROUP)
    padded = np.zeros((rows, groups * GROUP), np.int64)
    padded[:, :width] = vectors
    planes = ((padded[:, None, :] >> np.arange(bits)[:, None]) & 1).astype(np.uint8)
    return np.packbits(planes, axis=2, bitorder="little")


class SubsetSums:
    """Tables of the subset sums of every group of eight dimensions, for some anchors side by side."""

    def __init__(self, anchors: np.ndarray, bits: int):
        n, width = anchors.shape
        groups = -(-width // GROUP)
        padded = np.zeros((n, groups * GROUP), np.int64)
        padded[:, :width] = anchors
        largest = int(np.abs(padded).max(initial=0)) * max(1, width) << bits
        self.type = np.int32 if largest < 2**31 else np.int64
        parts = padded.T.reshape(groups, GROUP, n).astype(self.type)
        self.tables = np.zeros((groups, 1 << GROUP, n), self.type)
        for bit in range(GROUP):
            np.add(self.tables[:, : 1 << bit], parts[:, bit : bit + 1], out=self.tables[:, 1 << bit : 2 << bit])

    def scores(self, planes: np.ndarray) -> np.ndarray:
        """Inner products by row and anchor, from bytes by row, plane and group."""
        rows, bits, groups = planes.shape
        total = np.zeros((rows, self.tables.shape[2]), self.type)
        found = np.empty_like(total)
        for plane in reversed(range(bits)):
            np.left_shift(total, 1, out=total)
            add = np.subtract if plane == bits - 1 else np.add
            for group in range(groups):
                np.take(self.tables[group], planes[:, plane, group], axis=0, out=found, mode="clip")
                add(total, found, out=total)
        return total


def _score_columns(anchors: np.ndarray, planes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(place of an anchor, its scores of all rows), with tables of bounded size at a time."""
    bits, groups = planes.shape[1:]
    step = max(1, TABLE_BYTES // (8 * (1 << GROUP) * max(1, groups)))
    for start in range(0, len(anchors), step):
        scores = SubsetSums(anchors[start : start + step], bits).scores(planes).T
        for k, column in enumerate(np.ascontiguousarray(scores)):
            yield start + k, column


def _best(places: np.ndarray, scores: np.ndarray, ids: list, most: int) -> list[tuple[int, int]]:
    """(score, id) of the ``most`` best among the rows at ``places``, ties to the smaller id."""
    if len(places) > most:
        own = scores[places]
        places = places[own >= np.partition(own, len(own) - most)[len(own) - most]]
    rows = sorted((-int(scores[p]), int(x)) for p in places.tolist() for x in ids[p])
    return [(-s, x) for s, x in rows[:most]]


def bars(positive: int, least: int = LEAST_SHARE, most: int = MOST_SHARE) -> tuple[int, int]:
    """The lowest and highest score of a negative beside a positive of this score."""
    return -(-least * positive // 100), most * positive // 100


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.int64).reshape(len(column), -1)


def _planes(column: pd.Series, bits: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(len(column), bits, -1)


def _entries(rows: DataFrame, bits: int, copies: int) -> DataFrame:
    """length, label, ids (the smallest ``copies`` ones) and packed planes of each vector and label."""
    first = Window.partitionBy("q", "label").orderBy("vec_id")
    distinct = (
        rows.distinct()
        .withColumn("n", F.row_number().over(first))
        .where(F.col("n") <= copies)
        .groupBy("q", "label")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(F.size("q").alias("length"), "label", "ids", "q")
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            lengths = batch.column("length").to_pylist()
            while start < len(lengths):
                width, stop = lengths[start], start + 1
                while stop < len(lengths) and lengths[stop] == width and (stop - start) * width * bits < NUMBERS_AT_ONCE:
                    stop += 1
                part = batch.slice(start, stop - start)
                numbers = part.column("q").flatten().to_numpy().reshape(stop - start, width)
                planes = [row.tobytes() for row in bit_planes(numbers, bits)]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in ("length", "label", "ids")], pa.array(planes, pa.binary())],
                    ["length", "label", "ids", "planes"],
                )
                start = stop

    return distinct.mapInArrow(pack, "length int, label bigint, ids array<bigint>, planes binary")


def _every(n: int):
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def _block(n: int, *columns: str):
    return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")


def _meet(asking: DataFrame, offered: DataFrame, blocks: tuple[int, int], work, schema: str) -> DataFrame:
    """``work`` on every block of anchors with every block of candidates of their length."""
    rows, columns = blocks
    left = asking.select(_block(rows, "q", "label").alias("i"), _every(columns).alias("j"), *asking.columns)
    right = offered.select(_every(rows).alias("i"), _block(columns, "planes", "label").alias("j"), *offered.columns)
    keys = ["i", "j", "length"]

    def dealt(side: DataFrame):
        cell = F.col("i") * columns + F.col("j")
        return side.withColumn("cell", cell.cast("int")).repartitionById(rows * columns, "cell").groupBy("cell", *keys)

    return dealt(left).cogroup(dealt(right)).applyInPandas(work, schema)


def mine(
    rows: DataFrame,
    anchors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    shares: tuple[int, int] = (LEAST_SHARE, MOST_SHARE),
    anchors_per_block: int = ANCHORS_PER_BLOCK,
    candidates_per_block: int = CANDIDATES_PER_BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Both tables hold vec_id, label and an integer array q; ``anchors`` is a part of
    ``rows``. An anchor's positives are the ``positives`` best other rows of its
    label by inner product; negatives are the ``negatives`` best rows of other
    labels whose score lies between ``shares`` hundredths of the positive's score.
    Ties go to the smaller vec_id. Only vectors of an anchor's length meet it.
    Repeated rows are one; rows with the anchor's own id are no positives of it.
    Anchors without positives, and positives without negatives, give no rows, and
    so do empty tables.
    """
    rows = staged(rows.select("vec_id", "label", "q"), "vectors")
    largest = rows.agg(F.max(F.array_max(F.transform("q", lambda v: F.abs(v))))).first()[0] or 0
    bits = int(largest).bit_length() + 1
    entries = staged(_entries(rows, bits, max(positives + 1, negatives)), "entries")
    asked = staged(anchors.select(F.col("vec_id").alias("anchor_id"), "label", "q").distinct(), "anchors")
    vectors = asked.groupBy("q", "label").agg(F.min("anchor_id").alias("first"))
    named = staged(asked.join(vectors, ["q", "label"]).select("anchor_id", "first", "label"), "named")
    asking = vectors.select("first", "label", "q", F.size("q").alias("length"))
    blocks = (
        max(1, -(-named.select("first", "label").distinct().count() // anchors_per_block)),
        max(1, -(-entries.count() // candidates_per_block)),
    )

    def own_label(anchor: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(anchor) and len(offered):
            planes, ids = _planes(offered["planes"], bits), offered["ids"].tolist()
            labels, own = offered["label"].to_numpy(), anchor["label"].to_numpy()
            vectors, firsts = _matrix(anchor["q"]), anchor["first"].tolist()
            for label in np.unique(own).tolist():
                places, asks = np.flatnonzero(labels == label), np.flatnonzero(own == label)
                those = [ids[p] for p in places.tolist()]
                for k, scores in _score_columns(vectors[asks], planes[places]):
                    best = _best(np.arange(len(places)), scores, those, positives + 1)
                    out += [(firsts[asks[k]], label, x, s) for s, x in best]
        return pd.DataFrame(out, columns=["first", "label", "vec_id", "score"]).astype("int64")

    offers = _meet(asking, entries, blocks, own_label, "first bigint, label bigint, vec_id bigint, score bigint")
    # Rows with an anchor's own id are passed over, so one more than is wanted goes on.
    per_vector = Window.partitionBy("first", "label").orderBy(F.desc("score"), "vec_id")
    merged = offers.withColumn("n", F.row_number().over(per_vector)).where(F.col("n") <= positives + 1)
    per_anchor = Window.partitionBy("anchor_id", "first", "label").orderBy(F.desc("score"), "vec_id")
    found = staged(
        named.join(merged, ["first", "label"])
        .where(F.col("vec_id") != F.col("anchor_id"))
        .withColumn("n", F.row_number().over(per_anchor))
        .where(F.col("n") <= positives)
        .select("anchor_id", "first", "label", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")),
        "positives",
    )
    # At most positives + 1 different scores for a vector, as its anchors share their best rows.
    wanted = found.groupBy("first", "label").agg(F.collect_set("positive_score").alias("wanted"))

    def other_labels(anchor: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(anchor) and len(offered):
            planes, ids = _planes(offered["planes"], bits), offered["ids"].tolist()
            labels, own = offered["label"].to_numpy(), anchor["label"].tolist()
            firsts, scored = anchor["first"].tolist(), anchor["wanted"].tolist()
            for k, scores in _score_columns(_matrix(anchor["q"]), planes):
                differ = labels != own[k]
                for positive in map(int, scored[k]):
                    low, high = bars(positive, *shares)
                    if low > high:
                        continue
                    places = np.flatnonzero(differ & (scores >= low) & (scores <= high))
                    best = _best(places, scores, ids, negatives)
                    out += [(firsts[k], own[k], positive, x, s) for s, x in best]
        columns = ["first", "label", "positive_score", "negative_id", "negative_score"]
        return pd.DataFrame(out, columns=columns).astype("int64")

    below = _meet(
        asking.join(wanted, ["first", "label"]),
        entries,
        blocks,
        other_labels,
        "first bigint, label bigint, positive_score bigint, negative_id bigint, negative_score bigint",
    )
    per_score = Window.partitionBy("first", "label", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    ranked = below.withColumn("rank", F.row_number().over(per_score)).where(F.col("rank") <= negatives)
    return found.join(ranked, ["first", "label", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """What the registered query returns: every 50th id is an anchor, every 7th has the next label.

    Rows with a null in vec_id, label, vector or component, or with a component
    that is not finite, take no part; other columns are not looked at. For the
    rest see ``whole_vectors`` and ``mine``.
    """
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = staged(whole_vectors(embeddings).withColumn("label", moved), "quantised")
    return mine(rows, rows.where(F.col("vec_id") % ANCHOR_STEP == 0))


def hard_negatives_sql() -> str:
    """The same in DuckDB SQL."""
    return f"""
    WITH usable AS (
      SELECT DISTINCT vec_id,
        CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label,
        list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
      SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
        CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
      FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
      WHERE a.vec_id % {ANCHOR_STEP} = 0),
    positives AS (
      SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
        SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM scored WHERE same)
      WHERE n <= {POSITIVES}),
    ranked AS (
      SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS n
      FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
        AND {LEAST_SHARE} * p.positive_score <= 100 * s.score
        AND 100 * s.score <= {MOST_SHARE} * p.positive_score)
    SELECT anchor_id, positive_id, CAST(n AS INTEGER) AS rank, negative_id, positive_score, negative_score
    FROM ranked WHERE n <= {NEGATIVES}"""
