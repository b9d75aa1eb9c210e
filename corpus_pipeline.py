"""A corpus pipeline: each stage works on all that the one before kept.

Stages take (spark, docs, sf_dir) and return a frame with the columns of
``docs``; the last one returns what the encoder made. ``run`` writes every
stage's result as Parquet below the cluster's shared folder and reads it again.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codays.llm.byte_bpe import BYTES_PER_BUCKET, decode_documents, encode_documents
from codays.llm.common import WORD_PATTERN, table, text_of, whole_row
from codays.llm.forest import keep_one_each, text_key
from codays.llm.mixing import draw, mix, text_size
from codays.llm.suffix_dedup import repeated_spans, text_without
from codays.llm.toxicity import score_texts, train
from codays.session import batches_of, staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on their labels, does not reject.

    Null and empty texts stay, repeated rows are judged alike, and an empty table
    stays empty. All columns pass through, whatever their names.
    """
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = score_texts(docs.select(whole_row(docs)), model, "toxicity", "passages", "row.text")
    return scored.where("toxicity < 0.5").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates.

    Null and empty texts are copies of each other, so one of them stays, and so
    does one of rows that repeat each other; an empty table stays empty. All columns
    pass through, whatever their names and types.
    """
    return keep_one_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the long strings that occur more than once.

    What is left of a text must be valid text, so spans are widened to whole
    characters. A document of which no word is left goes as well, and n_chars
    follows the text where the column is there. Null and empty texts stay as they
    are, repeated rows are cut alike, and an empty table stays empty. Other columns
    pass through, whatever their names.
    """
    _, cuts = repeated_spans(docs)
    joined = docs.select(whole_row(docs), text_key().alias("key")).join(cuts.select("key", "removed"), "key", "left")
    left = joined.select("row", text_without(text_of("row.text"), "removed").alias("left"))
    changed = F.col("left").isNotNull()
    kept = left.where(~changed | F.col("left").rlike(WORD_PATTERN))
    new = {"text": F.coalesce("left", "row.text")}
    if "n_chars" in docs.columns:
        length = F.when(changed, F.length("left")).otherwise(F.col("row.n_chars"))
        new["n_chars"] = length.cast(docs.schema["n_chars"].dataType)
    return kept.select(*[new.get(name, F.col(f"row.`{name}`")).alias(name) for name in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them.

    The words taken of a document make a number of copies with a fraction; a
    seeded draw rounds it up or down in proportion, so that sources keep their
    shares. Documents without words, null and empty texts among them, are taken
    once, as nothing was decided on them. Null ids and sources are ordinary values;
    rows that repeat id, source and size are taken equally often; an empty table
    stays empty. All columns pass through, whatever their names.
    """
    taken = mix(docs.select("doc_id", "text", "source")).groupBy("doc_id", "source", "size").agg(
        F.max("taken").alias("taken")
    )
    part = draw(F.col("doc_id"), F.lit("copies")) % 1_000_000 / 1_000_000
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + part)).otherwise(1)
    taken = taken.select("doc_id", "source", "size", times.cast("int").alias("times")).where("times > 0")
    met = docs.select(whole_row(docs), text_size().alias("words")).join(
        taken,
        F.col("row.doc_id").eqNullSafe(F.col("doc_id"))
        & F.col("row.source").eqNullSafe(F.col("source"))
        & (F.col("words") == F.col("size")),
    )
    copies = met.select("row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"))
    return copies.select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number and digest of the ids, and digest of the decoded bytes: a row per row of ``docs``.

    Null and empty texts have no ids; null ids and repeated rows are rows like
    others; an empty table gives none. Only doc_id and text are read.
    """
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    # The stages before leave idle workers beside those of this one, so these get half of the usual buckets.
    encoded = encode_documents(
        docs, ranks, public_tokenizers.PATTERN, bytes_per_bucket=BYTES_PER_BUCKET // 2, cut_at_blanks=True
    )
    # Written before they are read again, as a task that also decodes needs two Python workers at once.
    decoded = decode_documents(staged(encoded, "ids", compression="zstd"), ranks)
    digests = decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
    # 10,000 rows of ids are 40 MB, which the JVM holds outside its heap and the worker once more.
    with batches_of(spark, 4_000_000):
        return staged(digests, "digests")


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]

#: Trained scores and signatures cannot be expressed in SQL; tests check the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
