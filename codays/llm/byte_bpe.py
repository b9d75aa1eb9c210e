"""Byte-level BPE: encode whole texts by ranked merges, and decode the ids.

Merging is done once per distinct word of the corpus, by Spark's higher-order
functions: a word is an array with a number for each piece, made of the rank of the piece
with the next one, its place and its id, and a fold with at most one merge for each of its
bytes finds the lowest-ranked pair, the leftmost among equals, and replaces it by one piece.
Ranks of pairs of ids stand in one array of small maps, because a look-up in one large
map would go through all of its entries. The array is the only row of a table that the fold
reads as a subquery: as a literal it would be written out in every plan that the driver keeps.

Texts are dealt into buckets of bounded size. Every bucket lists its own
distinct words; these meet in one shuffle by word, are encoded, and return to
the buckets that asked for them. There each text is put together from
its words, in order, by look-up. So words are merged once however frequent they
are, nothing is broadcast but the ranks, and a task holds one bucket.
"""

import base64
import heapq
import json
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from codays.llm.buckets import give_back, packed, unpacked

#: A worker holds a bucket's texts, its words and all ids at once.
BYTES_PER_BUCKET = 16_000_000
#: Every task reads the array again, and empty maps cost as much to read as full ones.
SLOTS = 32_749
#: Bits of an id, of a place in a word and of a rank.
BITS = 21
NOTHING = (1 << BITS) - 1
NO_RANK = NOTHING << 2 * BITS
EDGE = NO_RANK | NOTHING
#: For bytes that no piece has.
NO_ID = 2**31 - 1
#: The fold takes time with the square of a word; longer ones are merged with a heap.
LONG_WORD = 512
#: Words that a task packs together on their way back to the buckets.
ROWS_AT_ONCE = 200_000
#: White space but for blank, line feed, CR and tab.
RARE_SPACE = r"[\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks by piece from lines of a base64 piece and its rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def _numbers(ranks: dict[bytes, int]) -> dict[bytes, int]:
    """Ids by piece; bytes that are no piece get numbers above all ids, so that they can still be merged."""
    top = max(ranks.values(), default=-1)
    missing = [b for b in (bytes([i]) for i in range(256)) if b not in ranks]
    numbers = ranks | {b: top + 1 + k for k, b in enumerate(missing)}
    if max(numbers.values()) >= NOTHING:
        raise ValueError(f"ids do not fit into {BITS} bits")
    return numbers


def rank_slots(spark: SparkSession, ranks: dict[bytes, int]) -> DataFrame:
    """One row with the array: small maps from pairs of ids to the rank of both together, in its upper bits."""
    numbers = _numbers(ranks)
    pairs, merged = [], []
    for piece, rank in ranks.items():
        for cut in range(1, len(piece)):
            one, two = numbers.get(piece[:cut]), numbers.get(piece[cut:])
            if one is not None and two is not None:
                pairs.append(one << BITS | two)
                merged.append(rank << 2 * BITS)
    keys, values = np.array(pairs, np.int64), np.array(merged, np.int64)
    order = np.argsort(keys % SLOTS, kind="stable")
    starts = np.searchsorted((keys % SLOTS)[order], np.arange(SLOTS + 1)).astype(np.int32)
    maps = pa.MapArray.from_arrays(starts, keys[order], values[order])
    return spark.createDataFrame(pa.table({"slots": pa.ListArray.from_arrays(np.array([0, SLOTS], np.int32), maps)}))


def _rank(slots: Column, one: Column, two: Column) -> Column:
    """The rank of two ids next to each other, in its upper bits."""
    pair = F.shiftleft(one, BITS).bitwiseOR(two)
    slot = (F.pmod(pair, F.lit(SLOTS)) + 1).cast("int")
    return F.coalesce(F.element_at(F.element_at(slots, slot), pair), F.lit(NO_RANK))


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once, as the end of a fold over nothing, which copies neither."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda held, _: held, body)


def merged_ids(word: Column, first: Column, slots: Column) -> Column:
    """The ids of a word after all merges.

    The state is an array with one number for each piece: the rank of the piece with the
    next one in the upper bits, then the place where the piece starts, then its id. So the smallest
    number is the lowest-ranked pair, the leftmost among equals, and as an id is
    its rank, it also names the merged piece. The array begins and ends with a number that no pair has.
    """

    def id_of(number: Column) -> Column:
        return number.bitwiseAND(F.lit(NOTHING))

    def start(letters: Column) -> Column:
        each = F.transform(
            F.sequence(F.lit(1), F.length(letters)), lambda i: F.element_at(first, F.ascii(F.substring(letters, i, 1)) + 1)
        )

        def ranked(ids: Column) -> Column:
            def number(one: Column, k: Column) -> Column:
                place = F.shiftleft(k.cast("long"), BITS)
                return _rank(slots, one, F.element_at(ids, k + 2)).bitwiseOR(place).bitwiseOR(one)

            own = F.transform(F.slice(ids, F.lit(1), F.size(ids) - 1), number)
            return F.concat(F.array(F.lit(EDGE)), own, F.array(F.lit(EDGE)))

        return _bound(F.concat(each, F.array(F.lit(NOTHING))), ranked)

    def merged(numbers: Column, least: Column, at: Column) -> Column:
        new, before = F.shiftright(least, 2 * BITS), F.element_at(numbers, at - 1)
        left = before.bitwiseAND(F.lit((1 << 2 * BITS) - 1)).bitwiseOR(_rank(slots, id_of(before), new))
        place = least.bitwiseAND(F.lit(NOTHING << BITS))
        right = _rank(slots, new, id_of(F.element_at(numbers, at + 2))).bitwiseOR(place).bitwiseOR(new)
        return F.concat(
            F.slice(numbers, F.lit(1), at - 2), F.array(left, right), F.slice(numbers, at + 2, F.size(numbers))
        )

    def step(numbers: Column, _: Column) -> Column:
        def merge(least: Column) -> Column:
            at = F.array_position(numbers, least).cast("int")
            return F.when(least >= NO_RANK, numbers).otherwise(_bound(at, lambda k: merged(numbers, least, k)))

        return _bound(F.array_min(numbers), merge)

    # A letter for each byte.
    letters = F.decode(word.cast("binary"), "ISO-8859-1")
    steps = F.sequence(F.lit(1), F.octet_length(word))
    numbers = F.aggregate(steps, _bound(letters, start), step)
    return _bound(numbers, lambda all_: F.transform(F.slice(all_, F.lit(2), F.size(all_) - 2), id_of))


def with_ids(words: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``words`` with the ids of each ``word``, an array of integers."""
    # Subqueries may not stand inside the fold. The optimiser joins the two selections, so no row holds the array.
    met = words.select("*", rank_slots(words.sparkSession, ranks).scalar().alias("slots"))
    return met.select(*words.columns, encoded_word(F.col("word"), ranks, F.col("slots")).alias("ids"))


def encoded_word(word: Column, ranks: dict[bytes, int], slots: Column | None = None) -> Column:
    """The ids of a word, an array of integers; ``slots`` is the column of ``rank_slots``, or a literal of the same."""
    numbers = _numbers(ranks)
    first = F.from_json(F.lit(json.dumps([numbers[bytes([i])] for i in range(256)])), "array<bigint>")
    top = max(ranks.values(), default=-1)

    def known(number: Column) -> Column:
        return number.cast("int") if len(numbers) == len(ranks) else F.when(number <= top, number.cast("int")).otherwise(NO_ID)

    if slots is None:
        maps = rank_slots(SparkSession.active(), ranks).select(F.to_json("slots")).first()[0]
        slots = F.from_json(F.lit(maps), "array<map<string,bigint>>").cast("array<map<bigint,bigint>>")
    # Bound to a name, the array stands in the plan once.
    return _bound(slots, lambda held: F.transform(merged_ids(word, first, held), known))


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for one long word, by a heap of pairs over linked pieces."""
    pieces: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
    after = list(range(1, len(word) + 1))
    before = list(range(-1, len(word) - 1))
    heap: list[tuple[int, int, bytes]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < len(word):
            pair = pieces[i] + pieces[after[i]]
            if pair in ranks:
                heapq.heappush(heap, (ranks[pair], i, pair))

    for i in range(len(word)):
        offer(i)
    while heap:
        _, i, pair = heapq.heappop(heap)
        j = after[i]
        if pieces[i] is None or j >= len(word) or pieces[i] + pieces[j] != pair:
            continue
        pieces[i], pieces[j] = pair, None
        after[i] = after[j]
        if after[i] < len(word):
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [ranks[p] for p in pieces if p is not None]


def parts_of(texts: pa.Array) -> pa.Array:
    """Lists of the parts of texts, cut before each blank and line feed that follows no white space.

    A text with NUL in it, or with a blank or line feed after rare white space, is one part.
    """
    cut = texts
    for space in (" ", "\n"):
        cut = pc.replace_substring(cut, space, "\0" + space)
    for space in (" ", "\n", "\r", "\t"):
        cut = pc.replace_substring(cut, space + "\0", space)
    whole = pc.or_(pc.match_substring(texts, "\0"), pc.match_substring_regex(texts, RARE_SPACE + r"[ \n]"))
    lists = pc.split_pattern(cut, "\0")
    return pc.if_else(whole, whole_texts(texts), lists) if pc.any(whole).as_py() else lists


def whole_texts(texts: pa.Array) -> pa.Array:
    """Lists of one part, the text."""
    return pa.ListArray.from_arrays(np.arange(len(texts) + 1, dtype=np.int32), texts)


def words_of_parts(parts: list[pa.Array], words_in: Callable[[str], list[str]], size: int = 100_000) -> pa.Array:
    """The distinct words of all parts, ``size`` distinct parts at a time."""
    distinct = pa.chunked_array(parts, pa.string()).unique()
    found = []
    for start in range(0, len(distinct), size):
        own = distinct.slice(start, size).to_numpy(zero_copy_only=False)
        found.append(pa.array(set(chain.from_iterable(map(words_in, own))), pa.string()))
    return pa.chunked_array(found, pa.string()).unique()


def distinct_words(blocks: DataFrame, pattern: str, cut_at_blanks: bool = False) -> DataFrame:
    """(bucket, word) once per task that holds the bucket, words up to ``LONG_WORD`` bytes."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_in, cut = regex.compile(pattern).findall, parts_of if cut_at_blanks else whole_texts
        found: dict[int, list[pa.Array]] = {}
        for batch in batches:
            for bucket, table in zip(batch.column(0).to_pylist(), unpacked(batch.column(1))):
                own = found.setdefault(bucket, [])
                own += [cut(texts).flatten().unique() for texts in table.column("text").chunks]
        while found:
            bucket, parts = found.popitem()
            words = words_of_parts(parts, words_in)
            short = words.filter(pc.less_equal(pc.binary_length(words), LONG_WORD))
            del parts, words
            give_back()
            for start in range(0, len(short), 50_000):
                part = short.slice(start, 50_000)
                buckets = pa.array(np.full(len(part), bucket, np.int32))
                yield pa.RecordBatch.from_arrays([buckets, part], ["bucket", "word"])
            short = part = None
        give_back()

    return blocks.mapInArrow(find, "bucket int, word string")


def with_id_bytes(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(bucket, word, ids) with lists of ids as little-endian unsigned 32-bit numbers."""
    ids = batch.column("ids")
    bounds = ids.offsets.to_numpy().astype(np.int64) - ids.offsets[0].as_py()
    columns = [batch.column("bucket"), batch.column("word"), _binary(bounds * 4, ids.flatten().to_numpy().astype("<u4"))]
    return pa.RecordBatch.from_arrays(columns, ["bucket", "word", "ids"])


def pack_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, block) of (bucket, word, ids): the rows of a bucket among ``ROWS_AT_ONCE``, compressed.

    Words are sorted and id bytes put together by their place in the id, as both compress better so.
    """
    codec = pa.Codec("zstd", 6)

    def parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        _, offsets, data = column.buffers()
        bounds = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
        return bounds, np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)

    def blocks(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        rows = rows.take(pc.sort_indices(rows, [("bucket", "ascending"), ("word", "ascending")])).combine_chunks()
        own = rows.column("bucket").to_numpy()
        (words, letters), (ids, numbers) = (parts(rows.column(c).chunk(0)) for c in ("word", "ids"))
        starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        made = []
        for a, b in zip(starts, [*starts[1:], len(own)]):
            lengths = np.concatenate((np.diff(words[a : b + 1]), np.diff(ids[a : b + 1]))).astype("<u2").tobytes()
            planes = numbers[ids[a] : ids[b]].reshape(-1, 4).T.tobytes()
            raw = int(b - a).to_bytes(4, "little") + lengths + letters[words[a] : words[b]].tobytes() + planes
            made.append(len(raw).to_bytes(4, "little") + codec.compress(raw, asbytes=True))
        columns = [pa.array(own[starts], pa.int32()), pa.array(made, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["bucket", "block"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= ROWS_AT_ONCE:
            yield blocks(held)
            held = []
    if held:
        yield blocks(held)
    del held
    give_back()


def unpacked_words(block: bytes) -> Iterator[tuple[str, bytes]]:
    """The (word, ids) rows of a block of ``pack_words``."""
    return zip(*(c.to_pylist() for c in unpacked_columns(block)))


def unpacked_columns(block: bytes) -> tuple[pa.Array, pa.Array]:
    """The same as two arrays."""
    raw = pa.Codec("zstd").decompress(block[4:], int.from_bytes(block[:4], "little"), asbytes=True)
    rows = int.from_bytes(raw[:4], "little")
    lengths = np.frombuffer(raw, "<u2", 2 * rows, 4).astype(np.int32).reshape(2, rows)
    words, ids = (np.concatenate(([0], np.cumsum(x))).astype(np.int32) for x in lengths)
    first = 4 + 4 * rows
    letters, planes = raw[first : first + words[-1]], np.frombuffer(raw, np.uint8, -1, first + words[-1])
    numbers = np.ascontiguousarray(planes.reshape(4, -1).T)
    return (
        pa.StringArray.from_buffers(rows, pa.py_buffer(words), pa.py_buffer(letters)),
        pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(ids), pa.py_buffer(numbers)]),
    )


def _runs(array: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the numbers of ``width`` bytes of each binary value start, how many it has, and all numbers."""
    _, offsets, data = array.buffers()
    bounds = np.frombuffer(offsets, np.int32, len(array) + 1, array.offset * 4).astype(np.int64) // width
    return bounds[:-1], np.diff(bounds), np.frombuffer(data or b"", f"<u{width}")


def _chosen(starts: np.ndarray, sizes: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``numbers`` one after the other, and where they end, from 0 on."""
    ends = np.concatenate(([0], np.cumsum(sizes)))
    kind = np.int32 if max(int(ends[-1]), len(numbers)) < 2**31 else np.int64
    places = np.repeat((starts - ends[:-1]).astype(kind), sizes)
    places += np.arange(ends[-1], dtype=kind)
    return numbers[places], ends


def _binary(bounds: np.ndarray, numbers: np.ndarray) -> pa.Array:
    """Binary values that end at the given bytes of ``numbers``."""
    if bounds[-1] >= 2**31:
        raise ValueError("the rows of one block do not fit into an array")
    buffers = [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(numbers)]
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, buffers)


def joined(
    parts: Iterable[pa.Array], words: pa.Array, ids: pa.Array, made: Callable[[np.ndarray], pa.Array]
) -> Iterator[pa.Array]:
    """The ids of lists of parts, one part after the other; those of parts that are no words are ``made``.

    Each distinct part is looked up once.
    """
    own_parts, numbered = [], []
    for lists in parts:
        own = lists.flatten().dictionary_encode()
        own_parts.append(own.dictionary)
        numbered.append((lists.value_lengths().to_numpy(), own.indices.to_numpy(), len(own.dictionary)))
    every = pa.chunked_array(own_parts, pa.string()).dictionary_encode()
    distinct = every.chunk(0).dictionary if every.num_chunks else pa.array([], pa.string())
    # Chunks without parts are left out by the encoding.
    of_parts = np.concatenate([np.zeros(0, np.int32), *(own.indices.to_numpy() for own in every.chunks)])
    del own_parts, every
    found = pc.index_in(distinct, value_set=words)
    unknown = found.is_null().to_numpy(zero_copy_only=False)
    at = pc.fill_null(found, 0).to_numpy().astype(np.int64)
    if unknown.any():
        at[unknown] = len(ids) + np.arange(unknown.sum())
        ids = pa.concat_arrays([ids, made(distinct.filter(pa.array(unknown)).to_numpy(zero_copy_only=False))])
    starts, sizes, numbers = _runs(ids, 4)
    starts, sizes = starts[at], sizes[at]
    first = 0
    for count, indices, size in numbered:
        of = of_parts[first : first + size][indices]
        first += size
        own, ends = _chosen(starts[of], sizes[of], numbers)
        yield _binary(ends[np.concatenate(([0], np.cumsum(count)))] * 4, own)


def encode_documents(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    bytes_per_bucket: int = BYTES_PER_BUCKET,
    cut_at_blanks: bool = False,
) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit numbers) of every row.

    ``cut_at_blanks`` says that ``pattern`` finds the same words in a text and in its
    ``parts_of``, and a word alone as that word. It holds where no match goes on from other
    characters to white space and only white space is matched by what follows it. Texts
    are then looked up part by part, and only parts that are no single word are searched.

    Null and empty texts have no ids. Null ids and repeated rows pass through;
    an empty table gives no rows. Only doc_id and text are read.
    """
    ranks = read_ranks(ranks_path)
    # Word lists and look-up read one shuffle of the texts, in compressed blocks.
    blocks, buckets, doc_id = packed(docs, bytes_per_bucket)
    # A bucket is in one task, so no pair of word and bucket comes twice.
    asked = distinct_words(blocks, pattern, cut_at_blanks).groupBy("word").agg(F.collect_list("bucket").alias("buckets"))
    known = with_ids(asked, ranks).select(F.explode("buckets").alias("bucket"), "word", "ids")
    known = known.mapInArrow(
        lambda batches: pack_words(with_id_bytes(b) for b in batches if b.num_rows), "bucket int, block binary"
    )
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    doc_id_type = to_arrow_type(docs.schema["doc_id"].dataType)

    def put_together(texts: pa.Table, words: pa.Table) -> pa.Table:
        words_in = regex.compile(pattern).findall
        columns = [unpacked_columns(block.as_py()) for block in words.column("block")]
        columns.append((pa.array([], pa.string()), pa.array([], pa.binary())))
        known = [pa.concat_arrays(c) for c in zip(*columns)]

        def of_long_words(long: np.ndarray) -> pa.Array:
            return pa.array([np.array(merge_long(w.encode(), shared.value), "<u4").tobytes() for w in long], pa.binary())

        def of_parts(given: np.ndarray) -> pa.Array:
            lists = pa.array(map(words_in, given), pa.list_(pa.string()))
            return next(joined([lists], *known, of_long_words))

        cut = parts_of if cut_at_blanks else whole_texts
        doc_ids = []

        def parts() -> Iterator[pa.Array]:
            for table in unpacked(texts.column("block")):
                for batch in table.to_batches():
                    doc_ids.append(batch.column("doc_id"))
                    yield cut(batch.column("text"))

        # A chunk for each block, so nothing holds all ids of a bucket in one piece.
        made = [pa.table({"doc_id": pa.array([], doc_id_type), "ids": pa.array([], pa.binary())})]
        for ids in joined(parts(), *known, of_parts):
            made.append(pa.table({"doc_id": doc_ids[len(made) - 1], "ids": ids}))
        # What the look-up took goes back before the ids are sent.
        give_back()
        return pa.concat_tables(made)

    return (
        blocks.groupBy("bucket")
        .cogroup(known.repartitionById(buckets, "bucket").groupBy("bucket"))
        .applyInArrow(put_together, f"doc_id {doc_id}, ids binary")
    )


def _slices(batch: pa.RecordBatch, column: int, size: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices with about ``size`` bytes in a binary column, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(start, end - start)
        start = end


def decode_documents(encoded: DataFrame, ranks_path: str, column: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes that its ids stand for, piece after piece."""
    pieces = {rank: piece for piece, rank in read_ranks(ranks_path).items()}
    shared = encoded.sparkSession.sparkContext.broadcast([pieces.get(i, b"") for i in range(max(pieces, default=-1) + 1)])
    names = encoded.columns

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, sizes, data = _runs(pa.array(shared.value, pa.binary()), 1)
        for batch in batches:
            for part in _slices(batch, names.index("ids")):
                first, count, ids = _runs(part.column(names.index("ids")), 4)
                own = ids[first[0] : first[-1] + count[-1]]
                if not sizes[own].all():
                    raise KeyError("an id that no piece has")
                decoded, ends = _chosen(starts[own], sizes[own], data)
                texts = _binary(ends[np.append(first, first[-1] + count[-1]) - first[0]], decoded)
                columns = dict(zip(names, part.columns)) | {column: texts}
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return encoded.mapInArrow(decode, encoded.withColumn(column, F.lit(None).cast("binary")).schema)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, cut_at_blanks: bool = False) -> DataFrame:
    """What the registered query returns: sizes and digests of ids and decoded bytes."""
    encoded = encode_documents(docs, ranks_path, pattern, cut_at_blanks=cut_at_blanks)
    decoded = decode_documents(encoded, ranks_path)
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
