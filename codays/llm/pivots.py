"""Near-duplicate vectors through a pivot-permutation index.

A vector is described by its nearest pivots, nearest first. Inverted lists hold,
for every pivot, the vectors that name it. Two vectors are candidates when they
have at least ``shared`` named pivots in common, and a candidate pair is verified
by its cosine in double precision. A pair meets in the list of every pivot it
shares but belongs to the smallest of them, so it is counted once and nothing
has to be made distinct afterwards.

Pivots are a bounded sample, the distinct vectors with the smallest seeded
hashes, and grow in number with the square root of the rows up to a stated
bound, which keeps lists short. Vectors and pivots are compared as seen from the
mean of the drawn ones, so a direction that all vectors share tells nothing. Of
drawn vectors that are close together only the first becomes a pivot: many pivots
inside one dense group would be ordered by each member's own noise, and its members
would name unrelated ones. How many pivots are named follows from the recall of
made pairs that just link. Lists are cut into
blocks and each pair of blocks is a group of its own, so a list may hold any share
of all vectors.
Pairs are never written: a group returns how many links each vector has in it
and, for each vector, one edge to the smallest vector it hangs together with.
Equal vectors are one entry with a number of copies.
"""

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codays.llm.components import components, smallest_linked
from codays.session import shuffle_width, staged

LEAST_COSINE = 0.9
#: Named at least, and at most; more than the least where pairs that just link need it.
NAMED_PIVOTS, MOST_NAMED = 12, 48
SHARED_PIVOTS = 2
TARGET_RECALL = 0.998
#: Rows that come to the driver and go to the tasks, 16 MB for 64 dimensions.
LEAST_PIVOTS, MOST_PIVOTS = 64, 32_768
ROWS_PER_BLOCK = 1024
SEED = 11


def _usable() -> Column:
    x = F.col("embedding")
    finite = F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))
    )
    return F.coalesce(F.col("vec_id").isNotNull() & finite & F.exists(x, lambda c: c != 0), F.lit(False))


def _keyed(embeddings: DataFrame) -> DataFrame:
    """vec_id, key (a digest of the vector), v (its doubles) of usable rows."""
    x = F.col("embedding")
    return embeddings.where(_usable()).select(
        "vec_id",
        F.sha2(F.to_json(x), 256).alias("key"),
        F.transform(x, lambda c: c.cast("double")).alias("v"),
    )


def distinct_vectors(embeddings: DataFrame) -> DataFrame:
    """key, node (smallest vec_id), v, copies for each usable vector."""
    return (
        _keyed(embeddings)
        .groupBy("key")
        .agg(
            F.min("vec_id").alias("node"), F.first("v").alias("v"), F.count(F.lit(1)).alias("copies")
        )
    )


def unit_rows(vectors: list | pd.Series) -> np.ndarray:
    """Vectors as rows of length one; scaled first, so that no square overflows."""
    rows = np.array([np.asarray(v, np.float64) for v in vectors])
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


class Pivots(NamedTuple):
    """Unit rows about ``centre``, the mean of the drawn rows, and how many of them a vector names."""

    centre: np.ndarray
    rows: np.ndarray
    named: int


def about(rows: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Unit rows as seen from the centre; a row on the centre stays a zero."""
    apart = rows - centre
    lengths = np.linalg.norm(apart, axis=1, keepdims=True)
    return apart / np.where(lengths > 1e-12, lengths, 1)


def thinned(rows: np.ndarray, least: float) -> np.ndarray:
    """Places of unit rows, in order, without those too close to one that is kept.

    Rows closer than twice the linking angle go, so that all that links with one
    vector has a pivot or two among it, however many were drawn there. Where this
    leaves less than half of the rows, as they are all close together, only rows
    closer than that go, by the widest of a few angles that leaves half.
    """
    widest = np.cos(min(2 * np.arccos(np.clip(least, -1, 1)), np.pi / 2))
    for closest in (widest, *(1 - (1 - widest) * 0.5**k for k in range(1, 6)), 1.0):
        free, kept = np.ones(len(rows), bool), []
        for k in range(len(rows)):
            if free[k]:
                kept.append(k)
                free &= rows @ rows[k] < closest
        if 2 * len(kept) >= len(rows):
            break
    return np.array(kept, np.int64)


def named_pivots(rows: np.ndarray, pivots: Pivots) -> np.ndarray:
    """Numbers of the nearest pivots of each unit row, nearest first."""
    near = about(rows, pivots.centre) @ pivots.rows.T
    return np.argsort(-near, axis=1, kind="stable")[:, : pivots.named].astype(np.int32)


def enough_named(rows: np.ndarray, centre: np.ndarray, pivots: np.ndarray, least: float, named: int, shared: int) -> int:
    """How many pivots a vector must name for pairs that just link to share ``shared`` of them.

    Partners are made for drawn rows, at the least cosine, in the directions in
    which other drawn rows differ from each other.
    """
    draws = np.random.default_rng(SEED)
    ones = rows[draws.integers(0, len(rows), 1024)]
    ways = rows[draws.integers(0, len(rows), 1024)] - rows[draws.integers(0, len(rows), 1024)]
    ways -= (ways * ones).sum(1, keepdims=True) * ones
    lengths = np.linalg.norm(ways, axis=1)
    usable = lengths > 1e-9
    ones, ways = ones[usable], ways[usable] / lengths[usable, None]
    twos = least * ones + np.sqrt(1 - least**2) * ways
    while named < len(pivots) and len(ones):
        first, second = (named_pivots(side, Pivots(centre, pivots, named)) for side in (ones, twos))
        common = (first[:, :, None] == second[:, None, :]).sum((1, 2))
        if (common >= shared).mean() >= TARGET_RECALL:
            break
        named += 4
    return min(named, MOST_NAMED)


def choose_pivots(vectors: DataFrame, rows: int, least: float, named: int, shared: int) -> dict[int, Pivots]:
    """Pivots for each length of vector: at most ``MOST_PIVOTS`` rows reach the driver."""
    wanted = min(MOST_PIVOTS, max(LEAST_PIVOTS, int(rows**0.5)))
    drawn = vectors.orderBy(F.xxhash64("key", F.lit(SEED)), "key").limit(wanted).select("v").collect()
    by_length: dict[int, list] = {}
    for row in drawn:
        by_length.setdefault(len(row.v), []).append(row.v)
    out = {}
    for length, v in by_length.items():
        own = unit_rows(v)
        centre = own.mean(axis=0)
        pivots = about(own, centre)
        pivots = pivots[thinned(pivots, least)]
        out[length] = Pivots(centre, pivots, enough_named(own, centre, pivots, least, named, shared))
    return out


def block_links(
    group: pd.DataFrame, pivot: int, same: bool, least: float, shared: int
) -> pd.DataFrame:
    """node, links, root of the vectors in a pair of blocks of one pivot's list.

    ``first`` marks rows of the first block; both are the same block when ``same``.
    """
    group = group.sort_values("node", ignore_index=True)
    rows = unit_rows(group["v"])
    named = np.array(group["named"].tolist())
    copies = group["copies"].to_numpy()
    sides = (np.arange(len(group)),) * 2 if same else tuple(
        np.flatnonzero(group["first"].to_numpy() == side) for side in (True, False)
    )
    a, b = sides
    used = np.unique(named)
    holds = np.zeros((len(group), len(used)), np.float32)
    holds[np.arange(len(group))[:, None], np.searchsorted(used, named)] = 1
    before = int(np.searchsorted(used, pivot))
    ones, twos = [], []
    for start in range(0, len(a), 512):
        part = a[start : start + 512]
        candidates = holds[part] @ holds[b].T >= shared
        # A smaller pivot in common owns the pair.
        candidates &= holds[part, :before] @ holds[b, :before].T == 0
        if same:
            candidates &= part[:, None] < b[None, :]
        one, two = np.nonzero(candidates & (rows[part] @ rows[b].T >= least))
        ones.append(part[one])
        twos.append(b[two])
    one, two = np.concatenate(ones or [np.array([], int)]), np.concatenate(twos or [np.array([], int)])
    links = np.bincount(one, weights=copies[two], minlength=len(group))
    links += np.bincount(two, weights=copies[one], minlength=len(group))
    root = smallest_linked(one, two, len(group))
    linked = links > 0
    node = group["node"].to_numpy()
    return pd.DataFrame(
        {"node": node[linked], "links": links[linked].astype(np.int64), "root": node[root[linked]]}
    )


def near_duplicates(
    embeddings: DataFrame,
    least: float = LEAST_COSINE,
    named: int = NAMED_PIVOTS,
    shared: int = SHARED_PIVOTS,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """vec_id, n_links, component_id, kept: a row per row of ``embeddings``.

    Vectors that are null, zero or hold null or non-finite components link with
    nothing and are components of their own; so are rows without an id, whose
    component is null. Vectors of different lengths do not link. Rows that
    repeat an id are further copies. An empty table gives no rows. Only vec_id
    and embedding are read. With few pivots every vector names them all.
    """
    vectors = staged(distinct_vectors(embeddings), "vectors")
    rows = vectors.count()
    pivots = choose_pivots(vectors, rows, least, named, shared)
    named = max([named, *(p.named for p in pivots.values())])

    def describe(frames):
        for frame in frames:
            lengths = frame["v"].map(len)
            # A length that no pivot has is so rare that its vectors form one list.
            said = pd.Series([np.zeros(1, np.int32)] * len(frame), index=frame.index)
            for length, own in frame.groupby(lengths):
                if length in pivots:
                    near = named_pivots(unit_rows(own["v"]), pivots[length])
                    said.loc[own.index] = pd.Series(list(near), index=own.index)
            yield frame[["node", "v", "copies"]].assign(length=lengths.astype("int32"), named=said)

    described = staged(
        vectors.select("node", "v", "copies").mapInPandas(
            describe, "node bigint, v array<double>, copies bigint, length int, named array<int>"
        ),
        "described",
    )
    entries = described.select("length", "node", "copies", "named", F.explode("named").alias("pivot"))
    sizes = entries.groupBy("length", "pivot").agg(F.count(F.lit(1)).alias("entries"))
    cut = sizes.select(
        "length", "pivot", F.ceil(F.col("entries") / rows_per_block).cast("int").alias("blocks")
    )
    block = F.pmod(F.xxhash64("node", F.lit(SEED)), F.col("blocks")).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = (
        described.select("length", "node", "v", "copies", "named", F.explode("named").alias("pivot"))
        .join(cut, ["length", "pivot"])
        .withColumn("block", block)
        .withColumn("other", others)
        .select(
            "length",
            "pivot",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            "node",
            "v",
            "copies",
            "named",
            (F.col("block") <= F.col("other")).alias("first"),
        )
    )

    def links_of(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        _, pivot, i, j = key
        wanted = min(shared, group["named"].map(len).min())
        return block_links(group, int(pivot), i == j, least, wanted)

    keys = ["length", "pivot", "i", "j"]
    width = max(shuffle_width(embeddings.sparkSession), -(-rows * named // (8 * rows_per_block)))
    found = staged(
        met.repartition(width, *keys)
        .groupBy(*keys)
        .applyInPandas(links_of, "node bigint, links bigint, root bigint"),
        "links",
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = components(found.select("node", "root"))
    summary = (
        vectors.select("key", "node", "copies")
        .join(links, "node", "left")
        .join(parts, "node", "left")
        .select(
            F.col("key").alias("own_key"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    usable = (
        _keyed(embeddings)
        .select("vec_id", "key")
        .join(summary, F.col("key") == F.col("own_key"))
        .select("vec_id", "n_links", "component_id")
    )
    unusable = embeddings.where(~_usable()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return usable.union(unusable).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
