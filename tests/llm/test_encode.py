import pytest
from pyspark.sql import functions as F

from quire.llm import encode as E

TEXTS = ["", "Hello, world", "  two  spaces \n\n tab\t end ", "naïve 東京 🙂 \u200b\x00\x1c", "<|endoftext|>'ll 123abc", "a" * 5000, "\r\n x\x85y", "İstanbul ﬁ"]


@pytest.fixture(scope="module")
def enc():
    return E.Encoder(E.tokenizer_path())


def test_ids_equal_the_public_tokenizer(enc):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(E.tokenizer_path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    assert enc.encode_batch(TEXTS) == [x.ids for x in t.encode_batch(TEXTS, add_special_tokens=False)]


def test_multilingual_ranks_too():
    import base64

    import tiktoken

    path = E.tokenizer_path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=E.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert E.Encoder(path).encode_batch(TEXTS) == [own.encode_ordinary(t) for t in TEXTS]


def test_round_trip_nulls_and_counts(spark, enc):
    rows = [(i, t) for i, t in enumerate([*TEXTS, None])]
    df = spark.createDataFrame(rows, "doc_id int, text string").withColumn("ids", F.lit("clash"))
    got = {r.doc_id: list(r.ids) for r in E.encode(df, "doc_id", "text").collect()}
    assert got[len(TEXTS)] == [] and got[0] == []
    assert [enc.decode(got[i]) for i in range(len(TEXTS))] == TEXTS
    n = {r.doc_id: r.n for r in df.select("doc_id", E.count_column(F.col("text")).alias("n")).collect()}
    assert n == {k: len(v) for k, v in got.items()}
    assert E.encode(df.limit(0), "doc_id", "text").count() == 0
