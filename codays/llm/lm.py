"""Score texts with a causal self-attention model over subword ids.

A word is the subwords that it has after a blank under a public byte-level
vocabulary. The attention model reads and predicts the ids of all of them, over
overlapping windows that score every id once; ``subword_code`` gives it each id as one
to three symbols. It gives the probability that a word begins with its first
subword, and a share of that of the others. The rest of their share comes from counts:
words that begin alike have discounted counts over all training documents, and what the
discount frees goes to chains of subwords counted over distinct words. So every word
has a probability. The share is the one that makes training documents likeliest.

Nothing that grows with the corpus is broadcast or collected. Distinct words are
counted by bucket of documents, summed in one shuffle, and return to the
buckets that asked; each text becomes the symbols of its words, a number for each word
and two sums, and the text itself is not needed again. Statistics by subword are bounded by the
vocabulary; counts of subword pairs stay a table, which words are joined to. The
attention model takes a fixed number of steps, each along the gradient summed over
a fixed part of the training documents, so scores do not follow the task layout.
"""

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from codays.llm import attention
from codays.llm.buckets import BYTES_PER_BUCKET, compressed, give_back, packed, unpacked
from codays.llm.byte_bpe import _binary, _chosen, _runs, read_ranks
from codays.llm.common import remainder
from codays.llm.subword_code import END, SubwordCode, log_of_words
from codays.session import shuffle_width, staged

HELD_OUT_MODULUS = 10
DISCOUNT = 0.75
WORDS_PER_PART = 200_000
#: Steps of the training, each over its own part of the training documents.
ROUNDS = 32
TOKENS_PER_TASK = 750_000
CLASSES_AT_ONCE = 1_000_000
#: Fewer when texts are scored, as each symbol then takes some 150 bytes.
SCORED_AT_ONCE = 250_000
#: Words that a task packs together on their way back to the buckets.
ROWS_AT_ONCE = 400_000
#: Pairs of subwords that a task counts together.
PAIRS_AT_ONCE = 1_000_000
#: Shares of the attention in the subwords of a word after the first, of which the best is taken.
SHARES = np.array([0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.99])
#: So many factors of a word, each the least of ``SHARES`` or more, have a product that a double holds.
FACTORS_AT_ONCE = 100
_encodings: dict[tuple[str, str], object] = {}


def words_of(text: str) -> list[bytes]:
    """Words of the text with A-Z in lower case, cut at blank, tab, LF, VT, FF and CR."""
    return text.encode().lower().split()


def word_lists(texts: pa.Array) -> pa.ListArray:
    """The same words of many texts, as lists of binary values."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = lists.flatten().cast(pa.binary())
    # White space at either end of a text leaves an empty word there.
    full = pc.greater(pc.binary_length(words), 0)
    bounds = np.concatenate(([0], np.cumsum(full.to_numpy(zero_copy_only=False))))
    ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
    return pa.ListArray.from_arrays(bounds[ends].astype(np.int32), words.filter(full))


def numbered(words: Iterable[pa.Array]) -> tuple[pa.Array, list[np.ndarray]]:
    """The distinct words of all arrays, and the numbers of each array's words among them."""
    encoded = [own.dictionary_encode() for own in words]
    every = pa.chunked_array([own.dictionary for own in encoded], pa.binary()).dictionary_encode()
    distinct = every.chunk(0).dictionary if every.num_chunks else pa.array([], pa.binary())
    # Chunks without words are left out by the encoding.
    places = np.concatenate([np.zeros(0, np.int32), *(own.indices.to_numpy() for own in every.chunks)])
    ends = np.cumsum([len(own.dictionary) for own in encoded])
    return distinct, [
        places[end - len(own.dictionary) : end][own.indices.to_numpy()] for own, end in zip(encoded, ends)
    ]


def subwords(words: list[bytes], ranks_path: str, pattern: str) -> list[list[int]]:
    """Subword ids of each word, as it stands after a blank."""
    import tiktoken

    if (ranks_path, pattern) not in _encodings:
        _encodings[ranks_path, pattern] = tiktoken.Encoding(
            "words", pat_str=pattern, mergeable_ranks=read_ranks(ranks_path), special_tokens={}
        )
    encode = _encodings[ranks_path, pattern].encode_ordinary
    return [encode(" " + w.decode()) for w in words]


class Vocabulary:
    """Statistics of subwords, of bounded size whatever the corpus.

    beginnings: (subword, words counted, distinct words); endings: (subword,
    distinct words); onward: (subword, times it goes on); arrived: (subword,
    times it follows another), all over training words. Pairs of subwords are not
    held here. What is left of a subword's pairs goes to single subwords.
    """

    def __init__(self, beginnings, endings, onward, arrived, size: int, documents: int):
        counts, types = np.zeros(size), np.ones(size)
        for subword, n, distinct in beginnings:
            counts[subword], types[subword] = n, distinct + 1
        last, further = np.zeros(size), np.zeros(size)
        for subword, n in endings:
            last[subword] = n
        for subword, n in onward:
            further[subword] = n
        self.tokens = counts.sum() + documents
        self.distinct = float((types - 1).sum() + (documents > 0))
        self.ends = float(documents)
        self.begun = counts
        self.freed = np.where(counts > 0, DISCOUNT * (types - 1) / np.maximum(counts, 1), 1.0)
        usual = (last.sum() + 1) / (last.sum() + further.sum() + 2)
        stop = (last + 2 * usual) / (last + further + 2)
        self.stop, self.goes_on = np.log10(stop), np.log10(1 - stop)
        self.size, self.further = size, further
        #: Of a subword's continuations, the share left to single subwords.
        self.loose = 2 / (further + 2)
        follows = np.full(size, 0.1)
        for subword, n in arrived:
            follows[subword] += n
        self.singles = follows / follows.sum()

    def _follows(self, one: np.ndarray, two: np.ndarray, pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """log10 of the probability that subword ``one`` goes on with ``two``.

        ``pairs`` are the numbers ``one * size + two`` of the pairs met in training
        among those that are asked for, in order, and how often each was met.
        """
        share = self.loose[one] * self.singles[two]
        known, times = pairs
        if len(known):
            wanted = one * self.size + two
            at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            share = share + np.where(known[at] == wanted, times[at] / (self.further[one] + 2), 0)
        return self.goes_on[one] + np.log10(share)

    def counted(
        self, pieces: list[np.ndarray], counts: np.ndarray, pairs: tuple[np.ndarray, np.ndarray]
    ) -> np.ndarray:
        """Logarithm of each word's probability by counts, given its first subword."""
        lengths = np.array([len(p) for p in pieces])
        every = np.concatenate(pieces).astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        chains = self._follows(np.concatenate((every[:1], every[:-1])), every, pairs)
        chains[starts] = 0
        spelled = np.add.reduceat(chains, starts) + self.stop[every[starts + lengths - 1]]
        first = every[starts]
        seen = np.maximum(counts - DISCOUNT, 0) / np.maximum(self.begun[first], 1)
        freed = np.log10(np.maximum(self.freed[first], 1e-12)) + spelled
        # Spellings of long words are far below what a double holds.
        with np.errstate(divide="ignore"):
            return np.logaddexp(np.log(seen), freed * np.log(10))

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.tokens + 0.1 * (self.distinct + 1)))


def _count_words(blocks: DataFrame) -> DataFrame:
    """bucket, word, n: training counts of every word of a bucket, once per task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[tuple[pa.Array, np.ndarray]]] = {}
        for batch in batches:
            for bucket, table in zip(batch.column(0).to_pylist(), unpacked(batch.column(1))):
                for texts in table.to_batches():
                    lists = word_lists(texts.column("text"))
                    trained = ~texts.column("held_out").to_numpy(zero_copy_only=False)
                    words, (places,) = numbered([lists.flatten()])
                    weights = np.repeat(trained, lists.value_lengths().to_numpy())
                    counts = np.bincount(places, weights=weights, minlength=len(words))
                    found.setdefault(bucket, []).append((words, counts))
        while found:
            bucket, own = found.popitem()
            words, places = numbered(words for words, _ in own)
            numbers = np.zeros(len(words), np.int64)
            for at, (_, counts) in zip(places, own):
                numbers[at] += counts.astype(np.int64)
            del own, places
            for start in range(0, len(words), 50_000):
                part = words.slice(start, 50_000)
                buckets = pa.array(np.full(len(part), bucket, np.int32))
                columns = [buckets, part, pa.array(numbers[start : start + 50_000])]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "word", "n"])
            words = part = None
        give_back()

    return blocks.mapInArrow(count, "bucket int, word binary, n bigint")


def _with_subwords(words: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = subwords(batch.column(0).to_pylist(), ranks_path, pattern)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pieces, pa.list_(pa.int32()))], ["word", "n", "buckets", "pieces"]
            )

    return words.select("word", "n", "buckets").mapInArrow(
        cut, "word binary, n bigint, buckets array<int>, pieces array<int>"
    )


def _flat_pieces(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All subwords of a batch of words, how many each word has, and which of them go on with a word."""
    pieces = batch.column("pieces")
    every, lengths = pieces.flatten().to_numpy().astype(np.int64), pieces.value_lengths().to_numpy()
    onward = np.ones(len(every), bool)
    onward[np.cumsum(lengths) - lengths] = False
    return every, lengths, onward


def _neighbours(words: DataFrame, part: Column, size: int) -> DataFrame:
    """part, one, two, times: adjacent subwords of words, counted by part, ``PAIRS_AT_ONCE`` together."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def rows() -> pa.RecordBatch:
            numbers, times = np.unique(np.concatenate([np.zeros(0, np.int64), *held]), return_counts=True)
            held.clear()
            parts, pairs = np.divmod(numbers, size * size)
            columns = [pa.array(x, pa.int32()) for x in (parts, *np.divmod(pairs, size))]
            return pa.RecordBatch.from_arrays([*columns, pa.array(times)], ["part", "one", "two", "times"])

        for batch in batches:
            every, lengths, onward = _flat_pieces(batch)
            two = np.flatnonzero(onward)
            parts = np.repeat(batch.column("part").to_numpy().astype(np.int64), lengths)[two]
            held.append((parts * size + every[two - 1]) * size + every[two])
            if sum(map(len, held)) > PAIRS_AT_ONCE:
                yield rows()
        if held:
            yield rows()
        give_back()

    return words.select(part.cast("int").alias("part"), "pieces").mapInArrow(
        count, "part int, one int, two int, times bigint"
    )


def tallies(words: DataFrame, size: int) -> np.ndarray:
    """A row for each subword: times held, words begun, and distinct words begun and ended, times it goes on and follows.

    The first two are counted over all training words, the others over distinct ones.
    """
    names = ["held", "begun", "types", "last", "onward", "arrived"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((len(names), size), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            every, lengths, onward = _flat_pieces(batch)
            n = batch.column("n").to_numpy()
            first, last = every[~onward], every[np.cumsum(lengths) - 1]
            two = np.flatnonzero(onward)
            given = ((every, np.repeat(n, lengths)), (first, n), (first,), (last,), (every[two - 1],), (every[two],))
            for own, counted in zip(found, given):
                own += np.bincount(*counted, minlength=size).astype(np.int64)
        met = np.flatnonzero(found[0])
        columns = [pa.array(met), *(pa.array(own[met]) for own in found)]
        yield pa.RecordBatch.from_arrays(columns, ["subword", *names])

    counted = words.where("n > 0").select("n", "pieces").mapInArrow(
        count, ", ".join(f"{name} bigint" for name in ["subword", *names])
    )
    out = np.zeros((size, len(names)), np.int64)
    for subword, *sums in counted.groupBy("subword").agg(*[F.sum(name) for name in names]).collect():
        out[subword] = sums
    return out


def _rows(counts: np.ndarray, *columns: int) -> list[tuple[int, ...]]:
    """Subword and the given columns of ``tallies`` where the last of them is not zero."""
    met = np.flatnonzero(counts[:, columns[-1]])
    return list(zip(met.tolist(), *(counts[met, k].tolist() for k in columns)))


def learn_code(counts: np.ndarray, documents: int, ranks: dict[bytes, int]) -> SubwordCode:
    """Codes by how often training documents hold each subword; a row per id of the public vocabulary."""
    return SubwordCode(ranks, _rows(counts, 0), documents)


def learn_vocabulary(words: DataFrame, counts: np.ndarray, documents: int) -> tuple[Vocabulary, DataFrame]:
    """Statistics by subword, a row per id of the public vocabulary; and one, two, times of all pairs."""
    size = len(counts)
    pairs = _neighbours(words.where("n > 0"), F.lit(0), size)
    met = staged(pairs.groupBy("one", "two").agg(F.sum("times").alias("times")), "pairs")
    statistics = _rows(counts, 1, 2), _rows(counts, 3), _rows(counts, 4), _rows(counts, 5)
    return Vocabulary(*statistics, size, documents), met


def _described(
    words: DataFrame, met: DataFrame, vocabulary: Vocabulary, code: SubwordCode, words_per_part: int
) -> DataFrame:
    """word, n, buckets, symbols, counted of each word.

    Words are dealt into parts of bounded size; a part asks for its distinct pairs
    of subwords once, and what was counted of them comes back to it.
    """
    shared = words.sparkSession.sparkContext.broadcast((vocabulary, code))
    parts = max(1, -(-words.count() // words_per_part))
    dealt_words = words.withColumn("part", F.pmod(F.xxhash64("word"), F.lit(parts)).cast("int"))
    asked = _neighbours(dealt_words, F.col("part"), vocabulary.size)
    asked = asked.select(F.col("part").alias("asked"), "one", "two").distinct()
    answers = asked.join(met, ["one", "two"]).select("asked", "one", "two", "times")

    def describe(own: pa.Table, answers: pa.Table) -> pa.Table:
        vocabulary, code = shared.value
        one, two, times = (answers.column(c).to_numpy().astype(np.int64) for c in ("one", "two", "times"))
        numbers = one * vocabulary.size + two
        order = np.argsort(numbers, kind="stable")
        pairs = numbers[order], times[order]
        symbols, counted = [], [np.array([])]
        for batch in own.to_batches(max_chunksize=10_000):
            if batch.num_rows:
                pieces = batch.column("pieces").to_pylist()
                symbols += map(code.word, pieces)
                counted.append(vocabulary.counted(list(map(np.array, pieces)), batch.column("n").to_numpy(), pairs))
        return pa.table(
            {
                **{name: own.column(name) for name in ("word", "n", "buckets")},
                "symbols": pa.array(symbols, pa.binary()),
                "counted": pa.array(np.concatenate(counted).astype(np.float32)),
            }
        )

    return (
        dealt_words.groupBy("part")
        .cogroup(answers.groupBy("asked"))
        .applyInArrow(describe, "word binary, n bigint, buckets array<int>, symbols binary, counted float")
    )


def _pack_known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, block) of rows with a bucket: those of a bucket among ``ROWS_AT_ONCE``, compressed, in order of words."""

    def blocks(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).sort_by([("bucket", "ascending"), ("word", "ascending")]).combine_chunks()
        own, rows = rows.column("bucket").to_numpy(), rows.drop_columns("bucket")
        starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        made = [compressed(rows.slice(a, b - a)) for a, b in zip(starts, [*starts[1:], len(own)])]
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


def looked_up(texts: pa.Table, known: pa.Table, vocabulary: Vocabulary, given: list[tuple]) -> pa.Table:
    """The rows of ``_encode`` for one bucket; words stay in Arrow arrays, as objects they take ten times as much."""
    kinds = [("word", pa.binary()), ("n", pa.int64()), ("symbols", pa.binary()), ("counted", pa.float32())]
    words = pa.concat_tables([pa.schema(kinds).empty_table(), *unpacked(known.column("block"))])
    word, n, symbols, counted = (pa.concat_arrays(words.column(name).chunks) for name, _ in kinds)
    del words
    counts, counted = n.to_numpy(), counted.to_numpy().astype("<f4")
    starts, sizes, every = _runs(symbols, 1)
    base = vocabulary.base(counts)
    end_base = float(vocabulary.base(np.array([vocabulary.ends]))[0])
    end_known = int(vocabulary.ends > 0)
    rows, bounds = [], []

    def all_words() -> Iterator[pa.Array]:
        for table in unpacked(texts.column("block")):
            for batch in table.to_batches():
                lists = word_lists(batch.column("text"))
                rows.append(batch.select(["doc_id", "held_out"]))
                bounds.append(np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy()))).astype(np.int64))
                yield lists.flatten()

    # Each distinct word of the bucket is looked up once.
    distinct, numbers = numbered(all_words())
    at = pc.index_in(distinct, value_set=word)
    if at.null_count:
        raise KeyError("a word that nothing is known of")
    at = at.to_numpy()
    del distinct, word
    kinds = [("classes", pa.binary()), ("counted", pa.binary()), ("n_tokens", pa.int64())]
    kinds = pa.schema([*given, *kinds, ("n_known", pa.int64()), ("base_score", pa.float64())])
    made = [kinds.empty_table()]
    for ids, ends, own in zip(rows, bounds, numbers):
        places = at[own]
        classes, last = _chosen(starts[places], sizes[places], every)
        known_before = np.concatenate(([0], np.cumsum(counts[places] > 0)))
        by_text = [float(base[places[a:b]].sum()) + end_base for a, b in zip(ends, ends[1:])]
        columns = [
            _binary(last[ends], classes),
            _binary(ends * 4, counted[places]),
            pa.array(np.diff(ends) + 1),
            pa.array(np.diff(known_before[ends]) + end_known),
            pa.array(by_text, pa.float64()),
        ]
        made.append(pa.Table.from_arrays([*ids.columns, *columns], schema=kinds))
    del rows, numbers
    # What the look-up took goes back before the rows are sent.
    give_back()
    return pa.concat_tables(made)


def _encode(bucketed: DataFrame, known: DataFrame, vocabulary: Vocabulary, doc_id: str) -> DataFrame:
    """doc_id, held_out, classes, counted, n_tokens, n_known, base_score per document.

    ``classes`` are the symbols of all subwords, a byte each; ``counted`` has a little-endian
    32-bit float for each word.
    """
    shared = bucketed.sparkSession.sparkContext.broadcast(vocabulary)
    types = StructType.fromDDL(f"doc_id {doc_id}, held_out boolean")
    given = [(field.name, to_arrow_type(field.dataType)) for field in types]

    def encode(texts: pa.Table, known: pa.Table) -> pa.Table:
        return looked_up(texts, known, shared.value, given)

    return (
        bucketed.groupBy("bucket")
        .cogroup(known.groupBy("bucket"))
        .applyInArrow(
            encode,
            f"doc_id {doc_id}, held_out boolean, classes binary, counted binary, n_tokens bigint, n_known bigint,"
            " base_score double",
        )
    )


def _in_pieces(classes: list[bytes], size: int = CLASSES_AT_ONCE) -> Iterator[slice]:
    """Texts in runs of about ``size`` classes, one text at least."""
    start, held = 0, 0
    for k, own in enumerate(classes):
        if k > start and held + len(own) > size:
            yield slice(start, k)
            start, held = k, 0
        held += len(own)
    if start < len(classes):
        yield slice(start, len(classes))


def _sequences(classes: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, targets and lengths: every text stands between two ends."""
    lengths = np.array([len(c) + 1 for c in classes], np.int64)
    end = bytes([END])
    targets = np.frombuffer(b"".join(chain.from_iterable((c, end) for c in classes)), np.uint8)
    inputs = np.frombuffer(b"".join(chain.from_iterable((end, c) for c in classes)), np.uint8)
    return inputs.astype(np.int64), targets.astype(np.int64), lengths


def training_rounds(encoded: DataFrame, tokens: int, rounds: int) -> tuple[DataFrame, int]:
    """round, classes of the training documents, staged by round; and the tasks of a round.

    A document's round follows from its id and its classes, wherever it lies. A
    round is spread over tasks by the same two, so copies do not crowd one.
    """
    width = shuffle_width(encoded.sparkSession)
    tasks = max(1, min(width, -(-tokens // (rounds * TOKENS_PER_TASK))))
    of = F.pmod(F.xxhash64("doc_id", "classes", F.lit(5)), F.lit(rounds)).cast("int")
    part = F.pmod(F.xxhash64("doc_id", "classes", F.lit(6)), F.lit(tasks)).cast("int")
    dealt_rows = (
        encoded.where("NOT held_out")
        .select("classes", of.alias("round"), part.alias("part"))
        .withColumn("at", F.col("round") * tasks + F.col("part"))
        .repartitionById(rounds * tasks, "at")
    )
    return staged(dealt_rows.select("classes", "round"), "rounds", "round", compression="zstd"), tasks


def round_gradient(own: DataFrame, values: np.ndarray) -> tuple[np.ndarray, int]:
    """The gradient summed over all targets of a round's documents, and how many these are."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(values)), 0
        for batch in batches:
            classes = batch.column(0).to_pylist()
            for part in _in_pieces(classes):
                slope, counted = attention.summed_gradient(values, *_sequences(classes[part]))
                total += slope
                n += counted
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(values) + 1)), pa.array(np.append(total, n))], ["place", "value"]
            )

    sums = own.select("classes").mapInArrow(learn, "place bigint, value double").groupBy("place").agg(F.sum("value"))
    summed = np.zeros(len(values) + 1)
    for place, value in sums.collect():  # one number for each weight
        summed[place] = value
    return summed[:-1], int(summed[-1])


def train_attention(encoded: DataFrame, code: SubwordCode, rounds: int = ROUNDS) -> attention.Scorer:
    """Synchronous rounds: each is one step along the gradient of a fixed part of the training documents.

    Every training document is in one round. Gradients are summed by Spark, the
    weights and what the steps remember, a few thousand numbers, stay on the driver.
    So the result is the same in any number of files, buckets and tasks, but for
    the order in which numbers are added.
    """
    training, _ = training_rounds(encoded, int(code.tokens), rounds)
    steps = attention.Adam(attention.flat(attention.initial(code.frequencies)), rounds)
    for number in range(rounds):
        slope, n = round_gradient(training.where(F.col("round") == number), steps.values)
        if n:
            steps.follow(slope / n)
    return attention.Scorer.of(attention.shaped(steps.values), code.frequencies)


def words_by_both(
    classes: list[bytes], counted: list[bytes], scorer: attention.Scorer, groups: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of texts as four arrays; natural logarithms.

    For each text the attention's part that counts do not touch: first subwords and its end.
    For each word: the number of its text in the run, and the probability of its other
    subwords by the attention and by counts.
    """
    for part in _in_pieces(classes, SCORED_AT_ONCE):
        inputs, targets, lengths = _sequences(classes[part])
        chosen, masses = scorer.places(inputs, targets, lengths, groups)
        places, first, further, is_word = log_of_words(chosen, masses, targets, groups)
        text = np.repeat(np.arange(len(lengths)), lengths)[places]
        alone = np.bincount(text, weights=first, minlength=len(lengths))
        by_counts = np.frombuffer(b"".join(counted[part]), "<f4").astype(np.float64)
        yield alone, text[is_word], further[is_word], by_counts


def logs_by_share(
    by_attention: np.ndarray, by_counts: np.ndarray, text: np.ndarray, texts: int
) -> np.ndarray:
    """For each of ``texts`` texts and each of ``SHARES``, the sum of the logarithms of its words' mixed probabilities.

    ``text`` tells the number of each word's text, in order.
    """
    total = np.zeros((texts, len(SHARES)))
    if len(text):
        larger = np.maximum(by_attention, by_counts)
        one, other = np.exp(by_attention - larger), np.exp(by_counts - larger)
        # Of the two one is 1, so a word's factor is the least share at least, and few enough make one product.
        begins = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
        within = np.arange(len(text)) - np.repeat(begins, np.diff(np.append(begins, len(text))))
        starts = np.flatnonzero(within % FACTORS_AT_ONCE == 0)
        for k, share in enumerate(SHARES):
            products = np.log(np.multiply.reduceat(share * one + (1 - share) * other, starts))
            total[:, k] = np.bincount(text[starts], weights=products, minlength=texts)
        total += np.bincount(text, weights=larger, minlength=texts)[:, None]
    return total


def scored_by_share(encoded: DataFrame, scorer: attention.Scorer, code: SubwordCode) -> DataFrame:
    """The rows of ``encoded`` with ``scores``, natural logarithms of each text's probability under each of ``SHARES``."""
    shared = encoded.sparkSession.sparkContext.broadcast((scorer, code.groups))

    @F.arrow_udf("array<double>")
    def logs(classes: pa.Array, counted: pa.Array) -> pa.Array:
        scores = [np.zeros((0, len(SHARES)))]
        for alone, text, *both in words_by_both(classes.to_pylist(), counted.to_pylist(), *shared.value):
            scores.append(alone[:, None] + logs_by_share(*both, text, len(alone)))
        give_back()
        every = np.concatenate(scores)
        ends = pa.array(np.arange(len(every) + 1, dtype=np.int32) * len(SHARES))
        return pa.ListArray.from_arrays(ends, pa.array(every.ravel()))

    return encoded.select(
        "doc_id", "held_out", "n_tokens", "n_known", "base_score", logs("classes", "counted").alias("scores")
    )


def best_share(scored: DataFrame) -> int:
    """The place of the one of ``SHARES`` under which the training documents, all of them, are likeliest."""
    sums = [F.sum(F.col("scores")[k]) for k in range(len(SHARES))]
    total = scored.where("NOT held_out").agg(*sums).first()
    return int(np.argmax([x or 0.0 for x in total]))


def score_texts(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    modulus: int = HELD_OUT_MODULUS,
    bytes_per_bucket: int = BYTES_PER_BUCKET,
) -> DataFrame:
    """A row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Documents are held out where crc32 of the id modulo ``modulus`` is 0; null
    ids count as the empty text. Null and empty texts are their end alone.
    Repeated rows are documents of their own. An empty table, or one without
    training documents, gives scores from the vocabulary alone. Only doc_id and
    text are read.
    """
    held_out = (remainder(modulus) == 0).alias("held_out")
    # Texts and what is known of their words are shuffled as compressed blocks.
    bucketed, buckets, doc_id = packed(docs, bytes_per_bucket, held_out)
    summed = (
        _count_words(bucketed)
        .groupBy("word")
        .agg(F.sum("n").alias("n"), F.collect_set("bucket").alias("buckets"))
    )
    words = staged(_with_subwords(summed, ranks_path, pattern), "words", compression="zstd")
    documents = docs.where(remainder(modulus) != 0).count()
    ranks = read_ranks(ranks_path)
    counts = tallies(words, len(ranks))
    vocabulary, met = learn_vocabulary(words, counts, documents)
    code = learn_code(counts, documents, ranks)
    known = (
        _described(words, met, vocabulary, code, WORDS_PER_PART)
        .select(F.explode("buckets").alias("bucket"), "word", "n", "symbols", "counted")
        .mapInArrow(_pack_known, "bucket int, block binary")
        .repartitionById(buckets, "bucket")
    )
    encoded = staged(_encode(bucketed, known, vocabulary, doc_id), "encoded", compression="zstd")
    scorer = train_attention(encoded, code)
    # Texts are read once: what each share makes of them tells the best share and the scores.
    scored = staged(scored_by_share(encoded, scorer, code), "scored", compression="zstd")
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(int(vocabulary.tokens)).cast("long").alias("train_tokens"),
        "base_score",
        (F.col("scores")[best_share(scored)] / float(np.log(10))).alias("score"),
    )
