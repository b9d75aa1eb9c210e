"""N-gram Jaccard join by a MinHash LSH forest.

A text has a signature of ``LONGEST_PREFIX`` MinHash labels in each of ``TREES``
trees. The signatures of a tree are a trie: texts with the same d labels in
front lie below the same node of depth d. Two texts of similarity s meet at depth
d or deeper in some of L trees with probability ``1 - (1 - s^d)^L``.

Texts are compared at the longest prefix first, and prefixes are shortened by one
label at a time; a node whose texts all came from one longer prefix brings
nothing new. Each link found stands for ``1 / p`` links, p being its own
probability to be found so far, and the descent ends when the links found are the
wanted share of these. It goes no deeper than the prefix at which even pairs
of the least similarity reach the target recall. Texts alone at every node of
that prefix are left out at once.

Texts below a node are hung on the smallest of them, so a node with any number
of texts gives as many edges as texts. What hangs together is verified exactly:
the texts of a component meet block by block, pairs whose longest common
prefix has the length at hand are compared by their shingle sets, and each block
pair returns links counted per text and edges to the smallest text it is linked
with. Pairs are never written. Equal texts are one entry with a number of copies.

Many texts may hang together through chance alone, each sharing nodes with few
others. Where that moves fewer texts, those of a component meet node by node
instead, and a pair is compared in the first tree in which it shares one.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codays.llm.buckets import give_back
from codays.llm.common import ids_and_texts, text_of, whole_row
from codays.llm.components import components, smallest_linked
from codays.llm.shingles import forget_words, in_parts, mixed, shingles
from codays.session import shuffle_width, staged

LEAST_SIMILARITY = 0.8
TREES, LONGEST_PREFIX = 20, 8
#: Recall of pairs of the least similarity that the shortest prefix must have,
#: and share of all links, as estimated from those found, that ends the descent before.
TARGET_RECALL, ENOUGH_LINKS = 0.999, 0.9999
BYTES_PER_LABEL = 2
TEXTS_PER_BLOCK, PARTS = 256, 16
SEED = 8


def chance_to_meet(similarity: float | np.ndarray, depth: int | np.ndarray, trees: int = TREES):
    """Probability that two texts share a prefix of this length in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def prefix_length(
    similarity: float = LEAST_SIMILARITY,
    trees: int = TREES,
    longest: int = LONGEST_PREFIX,
    recall: float = TARGET_RECALL,
) -> int:
    """The longest prefix that finds the target share of pairs of this similarity."""
    length = longest
    while length > 1 and chance_to_meet(similarity, length, trees) < recall:
        length -= 1
    return length


def tree_labels(
    texts: list[str], trees: int = TREES, longest: int = LONGEST_PREFIX
) -> tuple[np.ndarray, np.ndarray]:
    """Labels by text, tree and depth, and how many shingles each text has."""
    draws = np.random.default_rng(SEED)
    factors = draws.integers(0, 1 << 31, (trees, longest), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shifts = draws.integers(0, 1 << 32, (trees, longest), dtype=np.uint32)
    labels = np.zeros((len(texts), trees, longest), np.uint16)
    sizes = np.zeros(len(texts), np.int64)
    for part in in_parts(texts):
        numbers, counts = shingles([texts[k] for k in part])
        sizes[part] = counts
        told = np.array(part)[counts > 0]
        if not len(told):
            continue
        starts = (np.cumsum(counts) - counts)[counts > 0]
        numbers = (numbers >> np.uint64(32)).astype(np.uint32)
        scratch = np.empty_like(numbers)
        for place in np.ndindex(trees, longest):
            np.multiply(numbers, factors[place], out=scratch)
            np.bitwise_xor(scratch, shifts[place], out=scratch)
            # Smallest values are alike in their upper bits, so they are spread again.
            least = mixed(np.minimum.reduceat(scratch, starts).astype(np.uint64))
            labels[(told, *place)] = (least >> np.uint64(40)).astype(np.uint16)
    return labels, sizes


def text_key(column: str = "text") -> Column:
    """Sixteen bytes that stand for the text."""
    return F.unhex(F.md5(F.encode(text_of(column), "utf-8")))


def with_labels(docs: DataFrame) -> DataFrame:
    """doc_id, key, labels of every row; labels are null where the text has no words."""
    rows = ids_and_texts(docs).select("doc_id", text_key().alias("key"), "text")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, sizes = tree_labels(batch.column(2).to_pylist())
            listed = [one.tobytes() if size else None for one, size in zip(labels, sizes)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(listed, pa.binary())], ["doc_id", "key", "labels"]
            )
        forget_words()
        give_back()

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(describe, f"doc_id {kind}, key binary, labels binary")


def _label(tree: int, depth: int, length: int) -> Column:
    """``length`` labels of a tree from a depth on."""
    return F.substring("labels", (tree * LONGEST_PREFIX + depth) * BYTES_PER_LABEL + 1, length * BYTES_PER_LABEL)


def node_name(tree: int, depth: int) -> Column:
    """The node of a tree above a text: a byte for the tree and the prefix, never sixteen bytes."""
    return F.concat(F.lit(bytes([tree])), _label(tree, 0, depth))


def jaccard_links(
    sets: list[np.ndarray], one: np.ndarray, two: np.ndarray, least: float
) -> tuple[np.ndarray, np.ndarray]:
    """Which of the pairs (one, two) of sorted distinct shingle sets are similar enough, and how similar."""
    sizes = np.array([len(s) for s in sets])
    # A pair whose sizes differ too much cannot reach the least similarity.
    small, large = np.minimum(sizes[one], sizes[two]), np.maximum(sizes[one], sizes[two])
    possible = np.flatnonzero(small >= least * large)
    shared = np.zeros(len(one))
    if len(possible) <= 1000:
        for k in possible:
            shared[k] = len(np.intersect1d(sets[one[k]], sets[two[k]], assume_unique=True))
    else:
        owner = np.repeat(np.arange(len(sets)), sizes)
        _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        kept = np.flatnonzero(times > 1)
        place = np.full(len(times), -1)
        place[kept] = np.arange(len(kept))
        column = place[column]
        together = np.zeros((len(sets), len(sets)), np.float32)
        for start in range(0, len(kept), 4096):
            here = (column >= start) & (column < start + 4096)
            holds = np.zeros((len(sets), min(4096, len(kept) - start)), np.float32)
            holds[owner[here], column[here] - start] = 1
            together += holds @ holds.T
        shared[possible] = together[one[possible], two[possible]]
    union = sizes[one] + sizes[two] - shared
    return (shared > 0) & (shared >= least * union - 1e-9), shared / np.maximum(union, 1)


def pairs_to_compare(
    labels: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int, tree: int | None = None
) -> np.ndarray:
    """Which pairs of rows ``a`` by rows ``b`` have a longest common prefix of ``depth`` labels.

    At the greatest depth all pairs that share the prefix are told. With a tree
    given, only pairs that share no prefix of this length in an earlier tree.
    """
    meet, deeper, earlier = (np.zeros((len(a), len(b)), bool) for _ in range(3))
    for number in range(labels.shape[1]):
        if number == tree:
            earlier = meet.copy()
        # Places in the sorted list of prefixes stand for these.
        _, node = np.unique(labels[:, number, :depth], axis=0, return_inverse=True)
        node = node.ravel()
        meet |= node[a][:, None] == node[b][None, :]
        if depth < labels.shape[2]:
            _, child = np.unique(
                np.column_stack([node, labels[:, number, depth]]), axis=0, return_inverse=True
            )
            child = child.ravel()
            deeper |= child[a][:, None] == child[b][None, :]
    return meet & ~deeper & ~earlier


def block_links(
    group: pd.DataFrame, same: bool, least: float, depth: int, tree: int | None = None
) -> pd.DataFrame:
    """Linked texts of a pair of blocks that meet at this depth, of this tree if one is given.

    key, links and root as for ``near_texts``; pairs, the links of a text to
    greater ones, and expected, the links these stand for at every depth.
    """
    group = group.sort_values("key", ignore_index=True)
    labels = np.frombuffer(b"".join(group["labels"]), np.uint16).reshape(len(group), TREES, LONGEST_PREFIX)
    first = group["first"].to_numpy(dtype=bool)
    places = np.arange(len(group))
    a, b = (places, places) if same else (places[first], places[~first])
    meet = pairs_to_compare(labels, a, b, depth, tree)
    if same:
        meet &= a[:, None] < b[None, :]
    at_a, at_b = np.nonzero(meet)
    one, two = a[at_a], b[at_b]
    if not len(one):
        return pd.DataFrame(columns=["key", "links", "root", "pairs", "expected"], dtype=object)
    numbers, counts = shingles(group["text"].tolist())
    sets = [np.unique(s) for s in np.split(numbers, np.cumsum(counts)[:-1])]
    linked, similarity = jaccard_links(sets, one, two, least)
    one, two, similarity = one[linked], two[linked], similarity[linked]
    copies = group["copies"].to_numpy()
    links = np.bincount(one, weights=copies[two], minlength=len(group))
    links += np.bincount(two, weights=copies[one], minlength=len(group))
    root = smallest_linked(one, two, len(group))
    pairs = np.bincount(one, minlength=len(group))
    expected = np.zeros((len(group), LONGEST_PREFIX))
    np.add.at(expected, one, 1 / chance_to_meet(similarity[:, None], np.arange(1, LONGEST_PREFIX + 1)))
    told = links > 0
    key = group["key"].to_numpy()
    return pd.DataFrame(
        {
            "key": key[told],
            "links": links[told].astype(np.int64),
            "root": key[root[told]],
            "pairs": pairs[told],
            "expected": pd.Series(list(expected[told]), dtype=object),
        }
    )


def not_alone(docs: DataFrame, texts: DataFrame, shortest: int) -> DataFrame:
    """key, component, copies, labels, text of ``texts`` that share a prefix of the shortest length."""
    nodes = F.array(*[F.xxhash64(node_name(tree, shortest)) for tree in range(TREES)])
    below = texts.where("labels is not null").select("key", F.explode(nodes).alias("node"))
    tops = below.groupBy("node").agg(F.min("key").alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1")
    placed = components(below.join(tops, "node").select("key", "low")).toDF("key", "component")
    # Copies are folded before anything meets, so a text with very many gathers nowhere.
    bodies = ids_and_texts(docs).groupBy(text_key().alias("key")).agg(F.first("text").alias("text"))
    return staged(bodies.join(placed.join(texts, "key"), "key"), "not-alone")


def meetings(met: DataFrame, depth: int, texts_per_block: int = TEXTS_PER_BLOCK) -> DataFrame:
    """key, meeting, blocks: where texts (key, component, labels) are compared at a depth, in how many blocks.

    A meeting is a component, named by sixteen bytes, or a node, named as by
    ``node_name``. Of the two ways a component takes the one that moves fewer texts.
    """
    blocks = F.ceil(F.col("n") / texts_per_block).cast("int")
    places = F.array(
        *[
            F.struct(
                node_name(tree, depth).alias("node"),
                # One longer prefix for all has been dealt with; at the greatest depth every text is one.
                (F.crc32(_label(tree, depth, 1)) if depth < LONGEST_PREFIX else F.xxhash64("key")).alias("child"),
            )
            for tree in range(TREES)
        ]
    )
    below = met.select("key", "component", F.explode(places).alias("at")).select("key", "component", "at.*")
    tops = below.groupBy("node").agg(
        F.count(F.lit(1)).alias("n"), F.min("child").alias("least"), F.max("child").alias("most")
    )
    tops = tops.where("least < most").select("node", "n")
    members = staged(below.drop("child").join(tops, "node"), "members")
    placed = members.groupBy("component", "key").agg(F.sum(blocks).alias("times"))
    # The texts of one component are read in parts, as it may hold very many.
    part = F.pmod(F.xxhash64("key"), F.lit(PARTS))
    ways = placed.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum("times").alias("by_node"))
    ways = ways.select("component", blocks.alias("wide"), (F.col("by_node") < F.col("n") * blocks).alias("split"))
    ways = ways.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))))
    whole = placed.withColumn("part", part).join(ways.where("not split"), ["component", "part"]).select(
        "key", F.col("component").alias("meeting"), F.col("wide").alias("blocks")
    )
    split = members.withColumn("part", part).join(ways.where("split"), ["component", "part"]).select("key", F.col("node").alias("meeting"), blocks)
    return whole.union(split)


def links_at(met: DataFrame, depth: int, least: float, texts_per_block: int = TEXTS_PER_BLOCK) -> DataFrame:
    """Links between texts of ``not_alone`` whose longest common prefix has this length."""
    block = F.pmod(F.xxhash64("key", F.lit(SEED)), F.col("blocks")).cast("int")
    pairs = (
        met.drop("component")
        .join(meetings(met, depth, texts_per_block), "key")
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "meeting",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            "key",
            "text",
            "copies",
            "labels",
            (F.col("block") <= F.col("other")).alias("first"),
        )
    )

    def links_of(names: tuple, group: pd.DataFrame) -> pd.DataFrame:
        meeting, i, j = names
        return block_links(group, i == j, least, depth, None if len(meeting) == 16 else meeting[0])

    keys = ["meeting", "i", "j"]
    return (
        pairs.repartition(4 * shuffle_width(met.sparkSession), *keys)
        .groupBy(*keys)
        .applyInPandas(links_of, "key binary, links bigint, root binary, pairs bigint, expected array<double>")
    )


def share_found(found: DataFrame, depth: int) -> float:
    """Share of all links that were found down to this depth, as those found let expect; 0 without any."""
    pairs, expected = found.agg(F.sum("pairs"), F.sum(F.element_at("expected", depth))).first()
    return pairs / expected if pairs else 0.0


def near_texts(
    docs: DataFrame,
    least: float = LEAST_SIMILARITY,
    recall: float = TARGET_RECALL,
    texts_per_block: int = TEXTS_PER_BLOCK,
    enough: float = ENOUGH_LINKS,
) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, key) and classes (key, class_key, copies, n_links) of ``docs``.

    Every distinct text has one row among the classes; class_key is the smallest
    key that it reaches by links.
    """
    described = staged(with_labels(docs), "signatures")
    texts = staged(
        described.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.first("labels").alias("labels")),
        "texts",
    )
    shortest = prefix_length(least, recall=recall)
    met = not_alone(docs, texts, shortest)
    depth = LONGEST_PREFIX
    found = staged(links_at(met, depth, least, texts_per_block), "links")
    while depth > shortest and share_found(found, depth) < enough:
        depth -= 1
        found = found.union(staged(links_at(met, depth, least, texts_per_block), "links"))
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    parts = components(found.select("key", "root")).toDF("key", "class_key")
    classes = (
        texts.select("key", "copies")
        .join(links, "key", "left")
        .join(parts, "key", "left")
        .select(
            "key",
            F.coalesce("class_key", "key").alias("class_key"),
            "copies",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        )
    )
    return described.select("doc_id", "key"), classes


def jaccard_join(docs: DataFrame, least: float = LEAST_SIMILARITY) -> DataFrame:
    """doc_id, class_id, n_links, kept: a row per row of ``docs``.

    class_id is the smallest doc_id of the class, n_links the number of other
    rows linked directly, kept whether the row's id is the class_id. Equal texts
    are similar, empty and null ones among them; different texts without words
    link with nothing. Null ids take part; a class of null ids alone has a null
    class_id. Repeated rows are copies of one another. An empty table gives no
    rows. Only doc_id and text are read.
    """
    rows, classes = near_texts(docs, least)
    placed = staged(rows.join(classes, "key").select("doc_id", "class_key", "n_links"), "placed")
    names = placed.groupBy("class_key").agg(F.min("doc_id").alias("class_id"))
    return (
        placed.join(names, "class_key")
        .select("doc_id", "class_id", "n_links")
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))
    )


def keep_one_each(docs: DataFrame, least: float = LEAST_SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class: of the smallest doc_id, then text key.

    All columns stay, whatever their names and types; null and empty texts are one
    class. Of rows with the same id and text the one stays whose JSON has the
    smallest checksum, so of rows that repeat one another entirely one is kept. An
    empty table gives no rows.
    """
    rows, classes = near_texts(docs, least)
    placed = rows.join(classes.select("key", "class_key"), "key")
    chosen = placed.groupBy("class_key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key")).alias("one")
    )
    chosen = chosen.select(F.col("one.doc_id").alias("one_id"), F.col("one.key").alias("one_key"))
    found = docs.select(whole_row(docs), text_key().alias("key"))
    found = found.join(chosen, (F.col("key") == F.col("one_key")) & F.col("row.doc_id").eqNullSafe(F.col("one_id")))
    one_of = found.groupBy("key").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return one_of.select("row.*")
