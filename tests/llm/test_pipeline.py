"""The registered queries of this part and the stages of the pipeline."""

import hashlib

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from codays.llm import shingles
from codays.llm.buckets import give_back
from codays.llm.queries import LLM_QUERIES, LLM_SQL
from codays.llm.shingles import forget_words, word_numbers
from codays.llm.suffix_dedup import remove_repeats, without_spans
from codays.session import batches_of


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_query_equals_sql(spark, sf_small, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_small}/{table}.parquet'")
    expected = connection.execute(LLM_SQL[name])
    columns = [c[0] for c in expected.description]
    got = LLM_QUERIES[name](spark, sf_small).select(*columns).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(expected.fetchall(), key=repr)


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES) == list(range(1, 14))


def test_stages(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").withColumn("key", F.lit("k")).cache()
    stages = [stage for _, stage in corpus_pipeline.STAGES]
    fine = stages[0](spark, docs, sf_small).cache()
    assert fine.columns == docs.columns and 0.7 * docs.count() < fine.count() <= docs.count()
    single = stages[1](spark, fine, sf_small).cache()
    assert single.columns == docs.columns
    assert single.select("text").distinct().count() == single.count() <= fine.select("text").distinct().count()
    cut = stages[2](spark, single, sf_small).cache()
    assert cut.columns == docs.columns and cut.count() <= single.count()
    expected = remove_repeats(single).agg(F.sum("n_removed")).first()[0]
    length = F.sum(F.octet_length("text"))
    gone = single.agg(length).first()[0] - cut.agg(length).first()[0]
    assert expected <= gone <= expected + 6 * single.count()
    assert cut.where(F.col("n_chars") != F.length("text")).count() == single.where(F.col("n_chars") != F.length("text")).count()
    mixed = stages[3](spark, cut, sf_small).cache()
    assert mixed.columns == docs.columns
    assert mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    encoded = stages[4](spark, mixed, sf_small)
    same = encoded.join(mixed.select("doc_id", F.sha2(F.encode("text", "utf-8"), 256).alias("own")).distinct(), "doc_id")
    assert encoded.count() == mixed.count()
    assert same.where(F.col("own") != F.col("decoded_sha256")).count() == 0


def test_stages_take_empty_tables_and_nulls(spark, sf_small):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for rows in ([], [(None, None, None, None, None)] * 2 + [(1, "", "en", None, 0)]):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf_small)
        assert docs.count() <= len(rows)


def test_stages_keep_columns_of_any_name_and_type(spark, sf_small):
    """Names that stages use for themselves are only names in the table given."""
    taken = ["row", "key", "left", "removed", "toxicity", "passages", "judged", "one_id", "one_key", "class_key"]
    taken += ["words", "size", "times", "copy", "taken", "_key", "_copy", "_again", "a.b"]
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").where("doc_id % 2 = 0")
    for name in taken:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name}-"), F.col("doc_id").cast("string")))
    docs = docs.withColumn("map", F.create_map(F.lit("k"), F.col("doc_id"))).cache()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_small).cache()
        assert {*taken, "map"} <= set(docs.columns) and docs.count() > 0
        right = F.col("map")["k"] == F.col("doc_id")
        for name in taken:
            right &= F.col(f"`{name}`") == F.concat(F.lit(f"{name}-"), F.col("doc_id").cast("string"))
        assert docs.where(~right).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_small).count() == docs.count()


def test_cuts_widen_to_whole_characters_and_spare_replacement_marks(spark):
    """Only what the spans touch goes, also where the text held U+FFFD before."""
    shared = "é" * 250
    texts = ["\ufffd a" + shared + "ü one \ufffd", "b" + shared + "ö two", "word " * 3]
    docs = spark.createDataFrame([(i, t, None, "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.cut_repeats(spark, docs, "").collect()}
    assert got == {0: ("\ufffd a one \ufffd", 9), 1: ("b two", 5), 2: (texts[2], 15)}
    assert without_spans("aéz".encode(), [(2, 3)]) == b"az"
    assert without_spans("aéözb".encode(), [(0, 2), (4, 5)]) == "zb".encode()


def test_a_task_of_the_decoding_has_one_worker(spark, monkeypatch):
    """Texts are put together and decoded in steps of their own, so that no task holds two Python workers."""
    texts = ["a b a b", None, "� don't\n é", "a b a b"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    plans, write = [], corpus_pipeline.staged
    monkeypatch.setattr(corpus_pipeline, "staged", lambda df, *a, **b: plans.append(df) or write(df, *a, **b))
    encoded = corpus_pipeline.encode(spark, docs, "")
    last = plans[-1]._jdf.queryExecution().executedPlan().toString()
    assert last.count("InArrow") == 1 and "FlatMapCoGroups" not in last, last
    rows = {r.doc_id: r.decoded_sha256 for r in encoded.collect()}
    assert rows == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in enumerate(texts)}


def test_batches_are_bounded_in_bytes(spark):
    """Wide rows reach Python in small batches, and the session's setting comes back."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    wide = spark.range(0, 2000, 1, 1).select(F.expr("cast(repeat('x', 2000) AS binary)").alias("b"))

    def rows(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    with batches_of(spark, 500_000):
        sizes = [r.n for r in wide.mapInArrow(rows, "n long").collect()]
    assert sum(sizes) == 2000 and 100 < max(sizes) <= 250
    assert spark.conf.get(name, None) == before


def test_words_are_forgotten_at_the_end_of_a_task():
    word_numbers(["a", "b"])
    forget_words()
    assert not shingles._known and word_numbers(["b"]) == word_numbers(["a", "b"])[1:]
    give_back()
