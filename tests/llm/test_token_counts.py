import public_tokenizers
from tokenizers import Tokenizer

from codays.llm.token_counts import count_tokens, counter

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "",
    None,
    "don't we'll 'S I'M",
    "<|endoftext|>x<|startoftext|> y <|endoftext",
    "a" * 20_000 + " " + "é" * 50,
    "Ünïcode ΣΑΣ ﬁ ́e \x1c \x85x\xa0y 12345 日本語テスト 😀😀 İI",
    " \t\n",
    "aaaa'" * 50,
]


def expected(texts):
    library = Tokenizer.from_file(PATH)
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_counts_equal_the_library(spark, sf_small):
    texts = [r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("text").collect()]
    assert counter(PATH).counts(texts) == expected(texts)


def test_edge_texts_and_columns(spark):
    rows = [(None if k == 2 else k, t, "clash") for k, t in enumerate(TEXTS)] * 2
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = count_tokens(frame, PATH, limit=100).collect()
    wanted = [
        (i, len((t or "").encode()), n, n > 100) for (i, t, _), n in zip(rows, expected([r[1] for r in rows]))
    ]
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)


def test_empty_table(spark):
    assert count_tokens(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
