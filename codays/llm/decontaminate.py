"""Which words of documents repeat a window of a benchmark item.

A window of an item occurs in a document when the document holds all of its
shingles of five words in order, so it is found by a set join with containment 1:
shingles are ordered by how often they occur in the documents, and the prefix that
such a join has to look at is a window's rarest shingle alone. Places of
documents that hold a rarest shingle meet the windows of that shingle in an
equi-join; the shingle's offset in the window and the document's number of words
say whether the window fits there, and the words around the place whether it is
there. A window of fewer than five words is its own shingle.

Documents are scanned twice, once for the frequency of the items' shingles and once
for places of the rarest ones. Either scan gets the shingles it looks for as a
bitmap of at most ``MOST_BITS`` bits, whatever the number of items, and only what
passes it is shuffled. False positives of the bitmap end in the joins.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codays.llm.common import text_of
from codays.llm.shingles import WORDS_PER_SHINGLE, mixed
from codays.session import staged

WORDS_PER_WINDOW = 10
#: Bounds of a bitmap, and bits for each shingle between them.
LEAST_BITS, MOST_BITS, BITS_PER_SHINGLE = 1 << 15, 1 << 27, 64
PIECE = 1 << 19
BYTES_AT_ONCE = 1 << 20
ROWS_AT_ONCE = 20_000
MOST_COUNTED = 1 << 20
_FACTOR = 0x9E3779B97F4A7C15 | 1
_tables: dict[str, np.ndarray] = {}


def _fixed() -> dict[str, np.ndarray]:
    """Tables over bytes, and powers for checksums, built once in a process."""
    if not _tables:
        every = np.arange(256)
        upper = (every >= 0x41) & (every <= 0x5A)
        lower = np.where(upper, every + 32, every).astype(np.uint8)
        digit, small = (lower >= 0x30) & (lower <= 0x39), (lower >= 0x61) & (lower <= 0x7A)
        _tables["lower"] = lower
        _tables["word"] = digit | small | (lower >= 0x80)
        _tables["bytes"] = np.random.default_rng(12).integers(1, 1 << 63, 256, dtype=np.uint64)
        for name, factor in (("up", _FACTOR), ("down", pow(_FACTOR, -1, 1 << 64))):
            steps = np.full(PIECE + 1, factor, np.uint64)
            steps[0] = 1
            _tables[name] = np.multiply.accumulate(steps)
    return _tables


def _word_sums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The same number for the same bytes between starts and ends of at most one piece."""
    tables = _fixed()
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(tables["bytes"][data] * tables["up"][: len(data)], out=sums[1:])
    return (sums[ends] - sums[starts]) * tables["down"][starts]


def _long_word_sum(data: np.ndarray) -> np.uint64:
    """``_word_sums`` of one word of any length, piece by piece."""
    total, factor = 0, 1
    for start in range(0, len(data), PIECE):
        part = data[start : start + PIECE]
        own = int(_word_sums(part, np.array([0]), np.array([len(part)]))[0])
        total = (total + own * factor) % (1 << 64)
        factor = factor * pow(_FACTOR, len(part), 1 << 64) % (1 << 64)
    return np.uint64(total)


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and numbers of the words in lower-cased bytes, which are gone through in pieces."""
    word, found, at = _fixed()["word"], [], 0
    while at < len(data):
        inside = word[data[at : at + PIECE]]
        if at + PIECE < len(data) and inside[-1]:
            gaps = np.flatnonzero(~inside)
            if not len(gaps):
                end = at + PIECE
                while end < len(data) and word[data[end]]:
                    ahead = np.flatnonzero(~word[data[end : end + PIECE]])
                    end += int(ahead[0]) if len(ahead) else len(data[end : end + PIECE])
                found.append((np.array([at]), np.array([end]), np.array([_long_word_sum(data[at:end])], np.uint64)))
                at = end
                continue
            inside = inside[: int(gaps[-1]) + 1]
        part = data[at : at + len(inside)]
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, ends = edges[0::2], edges[1::2]
        found.append((starts + at, ends + at, _word_sums(part, starts, ends)))
        at += len(part)
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    starts, ends, numbers = (np.concatenate(columns) for columns in zip(*found))
    return starts, ends, mixed(numbers)


class Texts:
    """The words of some texts, lower-cased, as one array, none of which crosses from text to text."""

    def __init__(self, texts: list[bytes]):
        joined = np.frombuffer(b"\0".join(texts), np.uint8)
        self.data = _fixed()["lower"][joined]
        self.starts, self.ends, self.numbers = words_of(self.data)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.firsts = np.searchsorted(self.starts, np.cumsum(lengths + 1) - lengths - 1)
        self.counts = np.diff(self.firsts, append=len(self.starts))
        self.text = np.repeat(np.arange(len(texts)), self.counts)

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and numbers of all shingles of so many words."""
        places = np.arange(max(0, len(self.numbers) - size + 1))
        places = places[self.text[places] == self.text[places + size - 1]]
        numbers = np.full(len(places), size, np.uint64)
        for k in range(size):
            numbers = mixed(numbers + self.numbers[places + k])
        return places, numbers

    def words(self, start: int, stop: int) -> list[str]:
        return [self.data[a:b].tobytes().decode() for a, b in zip(self.starts[start:stop], self.ends[start:stop])]


def _in_parts(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of a batch in parts of bounded size, one text at least, with the number of the first."""
    part, first, held = [], 0, 0
    for number, text in enumerate(batch.column("text")):
        own = text.as_buffer()
        if part and held + own.size > BYTES_AT_ONCE:
            yield first, part
            part, first, held = [], number, 0
        part.append(own.to_pybytes())
        held += own.size
    if part:
        yield first, part


def _windows(items: DataFrame, words: int) -> DataFrame:
    """key, window, length, shingles of every window of every text of ``items`` (key, text)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in _in_parts(batch):
                texts = Texts(part)
                for number, (start, count) in enumerate(zip(texts.firsts.tolist(), texts.counts.tolist())):
                    length = min(words, count)
                    size = min(WORDS_PER_SHINGLE, length)
                    if not length:
                        continue
                    own = Texts(part[number : number + 1]) if len(part) > 1 else texts
                    shingles = own.shingles(size)[1].view(np.int64)
                    inside = length - size + 1
                    for begin in range(0, count - length + 1, ROWS_AT_ONCE):
                        stop = min(begin + ROWS_AT_ONCE, count - length + 1)
                        spoken = own.words(begin, stop + length - 1)
                        rows = range(stop - begin)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.repeat(batch.column("key")[first + number], len(rows)),
                                pa.array([" ".join(spoken[k : k + length]) for k in rows], pa.string()),
                                pa.repeat(pa.scalar(length, pa.int32()), len(rows)),
                                pa.array([shingles[begin + k : begin + k + inside] for k in rows], pa.list_(pa.int64())),
                            ],
                            ["key", "window", "length", "shingles"],
                        )

    return items.mapInArrow(cut, "key binary, window string, length int, shingles array<bigint>")


def _bits_for(shingles: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, 1 << (shingles * BITS_PER_SHINGLE).bit_length()))


def _bitmap(shingles: DataFrame, bits: int) -> np.ndarray:
    """The upper bits of the numbers ``h`` as a bitmap; its size is bounded, so it may come to the driver."""
    upper = F.shiftrightunsigned("h", 64 - (bits.bit_length() - 1)) + 1
    parts = (
        shingles.select(F.bitmap_bucket_number(upper).alias("n"), F.bitmap_bit_position(upper).alias("at"))
        .groupBy("n")
        .agg(F.bitmap_construct_agg("at").alias("bitmap"))
    )
    whole = np.zeros(bits // 8, np.uint8)
    for n, part in parts.collect():
        whole[(n - 1) * 4096 : n * 4096] = np.frombuffer(part, np.uint8)
    return whole


def _passing(bitmap: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Which numbers may be among those of the bitmap."""
    upper = (numbers >> np.uint64(64 - (len(bitmap) * 8).bit_length() + 1)).astype(np.int64)
    return np.flatnonzero((bitmap[upper >> 3] >> (upper & 7).astype(np.uint8)) & 1)


def _frequencies(texts: DataFrame, sizes: list[int], bitmap: np.ndarray) -> DataFrame:
    """h, n: how often the shingles that pass the bitmap occur in ``texts``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def folded() -> tuple[np.ndarray, np.ndarray]:
            numbers, places = np.unique(np.concatenate([n for n, _ in held]), return_inverse=True)
            return numbers, np.bincount(places, np.concatenate([k for _, k in held])).astype(np.int64)

        def rows() -> pa.RecordBatch:
            numbers, counts = folded()
            return pa.RecordBatch.from_arrays([pa.array(numbers.view(np.int64)), pa.array(counts)], ["h", "n"])

        for batch in batches:
            for _, part in _in_parts(batch):
                found = Texts(part)
                for size in sizes:
                    numbers = found.shingles(size)[1]
                    held.append(np.unique(numbers[_passing(bitmap, numbers)], return_counts=True))
            if len(held) > 64:
                held[:] = [folded()]
                if len(held[0][0]) > MOST_COUNTED:
                    yield rows()
                    held.clear()
        if held:
            yield rows()

    return texts.mapInArrow(count, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))


def _places(docs: DataFrame, sizes: list[int], bitmap: np.ndarray, words: int) -> DataFrame:
    """One row for each document (h null) and one for each place whose shingle passes the bitmap.

    A place has the words before it, as many as a window may have before one of
    its shingles, and the words from it on, as many as a window has.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row bigint, doc_id {kind}, n_words bigint, h bigint, place bigint, before string, onward string"
    names = ["row", "doc_id", "n_words", "h", "place", "before", "onward"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in _in_parts(batch):
                found = Texts(part)
                mine = batch.slice(first, len(part))
                none = pa.nulls(len(part), pa.int64())
                blank = pa.nulls(len(part), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [mine.column("row"), mine.column("doc_id"), pa.array(found.counts), none, none, blank, blank], names
                )
                for size in sizes:
                    places, numbers = found.shingles(size)
                    hits = _passing(bitmap, numbers)
                    for begin in range(0, len(hits), ROWS_AT_ONCE):
                        some = hits[begin : begin + ROWS_AT_ONCE]
                        at, texts = places[some], found.text[places[some]]
                        firsts = found.firsts[texts]
                        lows = np.maximum(firsts, at - words + size).tolist()
                        highs = np.minimum(firsts + found.counts[texts], at + words).tolist()
                        around = [(found.words(a, b), p - a) for a, p, b in zip(lows, at.tolist(), highs)]
                        own = mine.take(pa.array(texts))
                        yield pa.RecordBatch.from_arrays(
                            [
                                own.column("row"),
                                own.column("doc_id"),
                                pa.array(found.counts[texts]),
                                pa.array(numbers[some].view(np.int64)),
                                pa.array(at - firsts),
                                pa.array([" ".join(w[:k]) for w, k in around], pa.string()),
                                pa.array([" ".join(w[k:]) for w, k in around], pa.string()),
                            ],
                            names,
                        )

    return docs.mapInArrow(search, schema)


def _key() -> Column:
    return F.unhex(F.sha2(F.encode("text", "utf-8"), 256))


def _rarest(windows: DataFrame, frequencies: DataFrame) -> DataFrame:
    """h, offset, window, length: every window that can occur, with its rarest shingle and its place.

    Ties go to the smaller number, then to the earlier place. The window's words
    are cut at that place.
    """
    shingles = windows.select("window", "length", F.posexplode("shingles").alias("offset", "h"))
    known = shingles.join(frequencies, "h", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    least = known.groupBy("window", "length").agg(F.min(F.struct("n", "h", "offset")).alias("least"))
    words = F.split("window", " ")
    return least.where("least.n > 0").select(
        F.col("least.h").alias("h"),
        F.col("least.offset").alias("offset"),
        "window",
        "length",
        F.array_join(F.slice(words, F.lit(1), F.col("least.offset")), " ").alias("head"),
        F.array_join(F.slice(words, F.col("least.offset") + 1, F.col("length")), " ").alias("tail"),
    )


def _occurrences(places: DataFrame, rarest: DataFrame) -> DataFrame:
    """row, start, stop, window of every occurrence of a window in a document."""
    start = F.col("place") - F.col("offset")
    stop = start + F.col("length")
    fits = (start >= 0) & (stop <= F.col("n_words"))

    def apart(text: str) -> Column:
        return F.concat(F.lit(" "), F.col(text), F.lit(" "))

    head = (F.col("offset") == 0) | F.endswith(apart("before"), apart("head"))
    there = head & F.startswith(apart("onward"), apart("tail"))
    met = places.where(F.col("h").isNotNull()).join(rarest, "h").where(fits & there)
    return met.select("row", start.alias("start"), stop.alias("stop"), "window")


def decontaminate(documents: DataFrame, benchmark: DataFrame, words_per_window: int = WORDS_PER_WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of ``documents``.

    A word is hit when it lies in an occurrence of a window: ``words_per_window``
    consecutive words of an item, or all words of an item that has fewer. Null and
    empty texts have no words, and items without words have no window. Every row of
    ``documents`` gives a row, also repeated ones and those without an id. Items
    of one text are one item with several ids; an id on several rows counts once;
    an item without an id has windows but no name, so it hits words and is not
    listed. Without documents the result is empty, without items nothing is hit.
    Columns other than doc_id, item_id and text are not looked at.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), text_of().alias("text"))
    keyed = items.withColumn("key", _key())
    ids = keyed.where(F.col("item_id").isNotNull()).select("key", "item_id").distinct()
    texts = keyed.groupBy("key").agg(F.first("text").alias("text"))
    cut = staged(_windows(texts, words_per_window), "item-windows")
    windows = staged(cut.groupBy("window", "length").agg(F.first("shingles").alias("shingles")), "windows")
    shingles = windows.select("length", F.explode("shingles").alias("h"))
    by_size = shingles.groupBy(F.least("length", F.lit(WORDS_PER_SHINGLE)).alias("size")).agg(F.count(F.lit(1)))
    sizes = {size: n for size, n in by_size.collect()}  # five rows at most
    bits = _bits_for(sum(sizes.values()))

    docs = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", text_of().alias("text"))
    frequencies = _frequencies(docs.select("text"), sorted(sizes), _bitmap(shingles, bits))
    rarest = staged(_rarest(windows, frequencies), "rarest")
    # Rows get their numbers as they are written, and keep them.
    places = staged(_places(docs, sorted(sizes), _bitmap(rarest, bits), words_per_window), "places")
    found = staged(_occurrences(places, rarest), "occurrences")

    in_order = Window.partitionBy("row").orderBy("start", "stop")
    covered = F.coalesce(F.max("stop").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    added = F.greatest(F.col("stop") - F.greatest("start", covered), F.lit(0))
    hit = found.select("row", "start", "stop").distinct().select("row", added.alias("added"))
    hit = hit.groupBy("row").agg(F.sum("added").alias("n_hit"))

    texts_met = found.select("row", "window").distinct().join(cut.select("window", "key").distinct(), "window")
    named = texts_met.select("row", "key").distinct().join(ids, "key").select("row", "item_id").distinct()
    listed = named.groupBy("row").agg(
        F.count(F.lit(1)).alias("n_items"), F.array_join(F.array_sort(F.collect_list("item_id")), ",").alias("items")
    )
    rows = places.where(F.col("h").isNull()).select("row", "doc_id", "n_words")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return rows.join(hit.join(listed, "row", "left"), "row", "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.encode(F.coalesce("items", F.lit("")), "utf-8"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def decontaminate_sql() -> str:
    """The same in DuckDB SQL."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def words(text: str) -> str:
        pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
        return f"regexp_extract_all(translate(coalesce({text}, ''), '{upper}', '{lower}'), '{pattern}')"

    return f"""
    WITH d AS MATERIALIZED (
      SELECT row_number() OVER () AS r, doc_id, {words("text")} AS w FROM documents),
    items AS MATERIALIZED (
      SELECT item_id, w, least(len(w), {WORDS_PER_WINDOW}) AS n FROM (
        SELECT item_id, {words("text")} AS w FROM benchmark) WHERE len(w) > 0),
    windows AS MATERIALIZED (
      SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS spoken FROM (
        SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM items)),
    grams AS (
      SELECT r, k, n, array_to_string(w[k:k + n - 1], ' ') AS spoken FROM (
        SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k
        FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
    found AS MATERIALIZED (SELECT r, k, n, item_id FROM grams JOIN windows USING (n, spoken)),
    hits AS (
      SELECT r, count(DISTINCT place) AS n_hit FROM (
        SELECT r, unnest(range(k, k + n)) AS place FROM found) GROUP BY r),
    named AS (
      SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM found WHERE item_id IS NOT NULL) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
      CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
      coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hits USING (r) LEFT JOIN named USING (r)"""
