"""Remove bytes of long strings that occur more than once in a corpus.

Every window of ``WINDOW`` bytes names one of its ``GRAM``-byte strings as its
anchor, by a rule that looks at nothing but the window, so equal windows have
equal anchors in equal places. Anchors that occur once rule their windows out
without moving any text. For anchors that occur again, what remains to be
compared is the few bytes around them: the anchor is one symbol, and the bytes
that its windows have before and after it are its context.

Contexts that occur twice are repeated in whole. All others of an anchor go
through a run-length index over the contexts of many anchors, whose matching
statistics tell which windows occur again in part. An anchor with more than
``MOST_CONTEXTS`` different contexts would be too much for one task; its windows
are counted one by one instead, which any number of tasks can share.

Work is moved by anchor, by context and by text, never by document group, and
only texts with a repeated anchor are moved at all after the first pass.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from codays.llm.buckets import give_back
from codays.llm.common import text_of
from codays.llm.forest import text_key
from codays.llm.run_index import RunIndex, joined
from codays.llm.shingles import mixed
from codays.session import shuffle_width, staged

WINDOW, GRAM = 400, 240
#: Anchors are chosen among so many places of a window.
CHOICES = WINDOW - GRAM + 1
MOST_CONTEXTS = 20_000
BYTES_PER_INDEX = 2_000_000
PIECE = 1 << 19
_FACTOR = 0x9E3779B97F4A7C15 | 1
_tables: dict[str, np.ndarray] = {}


def _powers() -> dict[str, np.ndarray]:
    """Fixed tables of the rolling checksum, built once in a process."""
    if not _tables:
        size = PIECE + WINDOW
        inverse = pow(_FACTOR, -1, 1 << 64)
        for name, factor in (("up", _FACTOR), ("down", inverse)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _tables[name] = np.multiply.accumulate(steps)
        _tables["bytes"] = np.random.default_rng(6).integers(1, 1 << 63, 256, dtype=np.uint64)
    return _tables


def gram_checksums(data: np.ndarray) -> np.ndarray:
    """A checksum of the gram at every place of at most one piece of text."""
    tables = _powers()
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(tables["bytes"][data] * tables["up"][: len(data)], out=sums[1:])
    places = len(data) - GRAM + 1
    return mixed((sums[GRAM:] - sums[:-GRAM]) * tables["down"][:places])


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, checksum, first and last window of each run of windows with one anchor.

    A window's anchor is the gram with the smallest checksum in it, the
    leftmost of equals. Long texts are gone through piece by piece.
    """
    found = []
    data = np.frombuffer(text, np.uint8)
    for start in range(0, len(data) - WINDOW + 1, PIECE):
        part = data[start : start + PIECE + WINDOW - 1]
        checksums = gram_checksums(part)
        # The upper bits decide; the lower ones are the place, so that equals go by place.
        low_bits = np.uint64((PIECE + WINDOW).bit_length())
        least = checksums >> low_bits << low_bits | np.arange(len(checksums), dtype=np.uint64)
        reach = 1
        while reach * 2 <= CHOICES:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < CHOICES:
            least = np.minimum(least[: -(CHOICES - reach)], least[CHOICES - reach :])
        places = (least & ((np.uint64(1) << low_bits) - np.uint64(1))).astype(np.int64)
        begins = np.flatnonzero(np.concatenate(([True], places[1:] != places[:-1])))
        ends = np.append(begins[1:], len(places)) - 1
        at = places[begins]
        found.append((at + start, checksums[at].view(np.int64), begins + start, ends + start))
    if not found:
        none = np.array([], np.int64)
        return none, none, none, none
    return tuple(np.concatenate(columns) for columns in zip(*found))


def once_or_twice(checksums: np.ndarray) -> np.ndarray:
    """Every checksum, and a second time where it occurs again."""
    distinct, times = np.unique(checksums, return_counts=True)
    return np.concatenate((distinct, distinct[times > 1]))


def _anchored(docs: DataFrame) -> DataFrame:
    """doc_id, key, n_bytes, whole_sha256 and the checksums of anchors of every row."""
    text = text_of()
    rows = docs.select("doc_id", text.alias("text"))
    described = rows.select(
        "doc_id",
        text_key().alias("key"),
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.sha2(F.encode("text", "utf-8"), 256).alias("whole_sha256"),
        "text",
    )
    names = ["doc_id", "key", "n_bytes", "whole_sha256", "anchors"]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [once_or_twice(anchors(t.as_py().encode())[1]) for t in batch.column(4)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(marks, pa.list_(pa.int64()))], names
            )
        give_back()

    kind = rows.schema["doc_id"].dataType.simpleString()
    return described.mapInArrow(
        describe, f"doc_id {kind}, key binary, n_bytes bigint, whole_sha256 string, anchors array<bigint>"
    )


def _repeated_anchors(anchored: DataFrame) -> DataFrame:
    """key, copies, and the anchors of the text that occur elsewhere or again in it."""
    places = anchored.select("key", F.explode("anchors").alias("anchor"))
    twice = places.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    shared = places.join(twice, "anchor").groupBy("key").agg(F.collect_set("anchor").alias("again"))
    copies = anchored.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    return shared.join(copies, "key")


def _contexts_of(suspects: DataFrame) -> DataFrame:
    """gram, left, right, key, first (window) and copies of every repeated anchor."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, copies, again, text in zip(*[c.to_pylist() for c in batch.columns]):
                data = text.encode()
                at, checksum, first, last = anchors(data)
                wanted = np.flatnonzero(np.isin(checksum, np.array(again, np.int64)))
                for start in range(0, len(wanted), 20_000):
                    own = wanted[start : start + 20_000]
                    spans = list(zip(at[own].tolist(), first[own].tolist(), last[own].tolist()))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([hashlib.md5(data[a : a + GRAM]).digest() for a, _, _ in spans], pa.binary()),
                            pa.array([data[f:a] for a, f, _ in spans], pa.binary()),
                            pa.array([data[a + GRAM : z + WINDOW] for a, _, z in spans], pa.binary()),
                            pa.array([key] * len(own), pa.binary()),
                            pa.array([f for _, f, _ in spans], pa.int64()),
                            pa.array([copies] * len(own), pa.int64()),
                        ],
                        ["gram", "left", "right", "key", "first", "copies"],
                    )
        give_back()

    return suspects.select("key", "copies", "again", "text").mapInArrow(
        cut, "gram binary, left binary, right binary, key binary, first bigint, copies bigint"
    )


def windows_again(group: pa.Table) -> pa.Table:
    """context, start, stop: runs of windows that occur in another context of the same gram."""
    grams = group.column("gram").to_pylist()
    number = {gram: 256 + k for k, gram in enumerate(dict.fromkeys(grams))}
    strings = []
    for gram, left, right in zip(grams, group.column("left").to_pylist(), group.column("right").to_pylist()):
        symbols = np.frombuffer(left + b"\0" + right, np.uint8).astype(np.int64)
        symbols[len(left)] = number[gram]
        strings.append(symbols)
    out: list[tuple] = []
    if strings:
        text, starts = joined(strings)
        longest = RunIndex(text).matching_statistics()
        names, twice = group.column("context").to_pylist(), group.column("twice").to_pylist()
        for name, known, begin, string in zip(names, twice, starts, strings):
            if not known:
                again = longest[begin : begin + len(string) - CHOICES + 1] >= CHOICES
                edges = np.flatnonzero(np.diff(np.concatenate(([0], again.astype(np.int8), [0]))))
                out += [(name, int(a), int(b)) for a, b in edges.reshape(-1, 2)]
        del text, longest
    give_back()
    columns = zip(*out) if out else ([], [], [])
    kinds = (pa.binary(), pa.int64(), pa.int64())
    return pa.table(dict(zip(("context", "start", "stop"), [pa.array(list(c), k) for c, k in zip(columns, kinds)])))


def _counted_windows(contexts: DataFrame) -> DataFrame:
    """The same for grams with very many contexts, by counting their windows."""
    size = F.octet_length("left")
    windows = size + F.octet_length("right") - CHOICES + 2
    each = contexts.select(
        "context", "gram", "left", "right", F.explode(F.sequence(F.lit(0), windows - 1)).alias("start")
    )
    before = F.expr("substring(left, start + 1, octet_length(left) - start)")
    after = F.expr(f"substring(right, 1, {CHOICES - 1} - octet_length(left) + start)")
    content = F.md5(F.concat("gram", before, after))
    named = each.select("context", "start", F.octet_length(before).alias("reach"), content.alias("content"))
    again = named.groupBy("content", "reach").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return named.join(again, ["content", "reach"]).select(
        "context", F.col("start").cast("long").alias("start"), (F.col("start") + 1).cast("long").alias("stop")
    )


def covered(windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of bytes under windows given as [start, stop) runs of their first bytes."""
    runs: list[tuple[int, int]] = []
    for start, stop in sorted(windows):
        end = stop - 1 + WINDOW
        if runs and start <= runs[-1][1]:
            runs[-1] = runs[-1][0], max(runs[-1][1], end)
        else:
            runs.append((start, end))
    return runs


def _cut_texts(marked: DataFrame) -> DataFrame:
    """key, removed (spans in bytes), kept (bytes) of texts with marked windows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept = [], []
            for text, marks in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = text.encode()
                spans = covered([(m["start"], m["stop"]) for m in marks])
                edges = [0, *[e for span in spans for e in span], len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
                removed.append([{"start": a, "stop": b} for a, b in spans])
            span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(removed, pa.list_(span)), pa.array(kept, pa.binary())],
                ["key", "removed", "kept"],
            )
        give_back()

    return marked.mapInArrow(cut, "key binary, removed array<struct<start:bigint,stop:bigint>>, kept binary")


def repeated_spans(docs: DataFrame, most_contexts: int = MOST_CONTEXTS) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, key, n_bytes, whole_sha256) and cuts (key, removed, kept).

    ``removed`` are the spans of bytes covered by repeated windows and ``kept``
    what is left; texts without such spans have no row among the cuts.
    """
    spark = docs.sparkSession
    anchored = staged(_anchored(docs), "anchored")
    again = _repeated_anchors(anchored)
    bodies = docs.select(text_key().alias("key"), text_of().alias("text"))
    suspects = staged(bodies.join(again, "key").dropDuplicates(["key"]), "suspects")
    name = F.unhex(F.md5(F.concat("gram", F.hex("left"), F.encode(F.lit("|"), "utf-8"), F.hex("right"))))
    members = staged(_contexts_of(suspects).withColumn("context", name), "contexts")
    contexts = members.groupBy("context").agg(
        F.first("gram").alias("gram"),
        F.first("left").alias("left"),
        F.first("right").alias("right"),
        ((F.count(F.lit(1)) > 1) | (F.max("copies") > 1)).alias("twice"),
    )
    contexts = staged(contexts, "distinct-contexts")
    sizes = contexts.groupBy("gram").agg(
        F.count(F.lit(1)).alias("contexts"), F.min("twice").alias("settled")
    ).where("contexts > 1 AND NOT settled")
    open_contexts = contexts.join(sizes, "gram")
    total = contexts.agg(F.sum(F.octet_length("left") + F.octet_length("right"))).first()[0] or 0
    indexes = max(1, -(-total // BYTES_PER_INDEX))
    bucket: Column = F.pmod(F.xxhash64("gram"), F.lit(indexes)).cast("int")
    indexed = (
        open_contexts.where(F.col("contexts") <= most_contexts)
        .select(bucket.alias("bucket"), "context", "gram", "left", "right", "twice")
        .repartition(max(indexes, shuffle_width(spark)), "bucket")
        .groupBy("bucket")
        .applyInArrow(windows_again, "context binary, start bigint, stop bigint")
    )
    counted = _counted_windows(open_contexts.where(F.col("contexts") > most_contexts))
    whole = contexts.where("twice").select(
        "context",
        F.lit(0).cast("long").alias("start"),
        (F.octet_length("left") + F.octet_length("right") - CHOICES + 2).cast("long").alias("stop"),
    )
    found = indexed.union(counted).union(whole)
    marks = (
        members.select("context", "key", "first")
        .join(found, "context")
        .groupBy("key")
        .agg(
            F.collect_list(
                F.struct((F.col("first") + F.col("start")).alias("start"), (F.col("first") + F.col("stop")).alias("stop"))
            ).alias("marks")
        )
    )
    cuts = _cut_texts(suspects.select("key", "text").join(marks, "key").select("key", "text", "marks"))
    return anchored.select("doc_id", "key", "n_bytes", "whole_sha256"), cuts


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """UTF-8 text without the spans of bytes, which are widened to whole characters first."""

    def inside(at: int) -> bool:
        return 0 < at < len(text) and text[at] & 0xC0 == 0x80

    kept, end = [], 0
    for start, stop in spans:
        while inside(start):
            start -= 1
        while inside(stop):
            stop += 1
        kept.append(text[end : max(start, end)])
        end = max(stop, end)
    return b"".join([*kept, text[end:]])


@F.arrow_udf(StringType())
def text_without(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """Texts without their spans, in characters; null where there are none."""
    cut = [
        None if own is None else without_spans(text.encode(), [(s["start"], s["stop"]) for s in own])
        for text, own in zip(texts.to_pylist(), spans.to_pylist())
    ]
    return pa.array([None if c is None else c.decode() for c in cut], pa.string())


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: a row per row of ``docs``.

    Null and empty texts have no bytes. Null ids and repeated rows are documents
    like others, so copies of a long text are removed from each other. Texts
    shorter than the window stay. An empty table gives no rows. Only doc_id and
    text are read.
    """
    rows, cuts = repeated_spans(docs)
    length = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    digests = cuts.select(
        "key",
        length.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
    none = F.lit(0).cast("long")
    return rows.join(digests, "key", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
    )
