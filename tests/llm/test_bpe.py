import pytest

pytest.importorskip("tiktoken")
import public_tokenizers  # noqa: E402
import tiktoken  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from crateflow.llm.bpe import ByteBpe  # noqa: E402

TEXTS = [None, "", " ", "\n\n  a", "Hello world, it's 12345!", "naïve café — 東京 フシ・ノミシ 🎵", "x" * 3000, "ab" * 400, "don't  stop\tnow   end ", "<|endoftext|>", "o̵̼̪͚͖ͦ͆͐ zalgo", "\x00\x07 bell", "word " * 5000, "Hello world, it's 12345!", "=" * 900 + "aaaab" * 300, "qZ9x" * 500]


@pytest.fixture(scope="module")
def coder():
    return ByteBpe()


@pytest.mark.parametrize("file", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_ids_equal_the_public_encoder(spark, file):
    coder = ByteBpe(public_tokenizers.path(file))
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(TEXTS)], "doc_id bigint, text string, ids string")
    got = {r.doc_id: list(r.ids) for r in coder.encode(docs, "doc_id", "text").collect()}
    assert got == {i: enc.encode_ordinary(t or "") for i, t in enumerate(TEXTS)}
    assert {r.doc_id: r.tokens for r in coder.count(docs, "doc_id", "text").collect()} == {i: len(v) for i, v in got.items()}


def test_decoding_gives_the_text_again(spark, coder):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id bigint, text string")
    back = coder.encode(docs, "doc_id", "text").select("doc_id", coder.decode(F.col("ids")).alias("t"))
    assert {r.doc_id: r.t for r in back.collect()} == {i: t or "" for i, t in enumerate(TEXTS)}


def test_repeated_and_null_keys_and_empty_table(spark, coder):
    docs = spark.createDataFrame([(1, "zyzzyva quux"), (1, "zyzzyva quux"), (None, "zyzzyva"), (2, "")], "doc_id bigint, text string")
    assert coder.encode(docs, "doc_id", "text").count() == 4
    assert coder.encode(docs.limit(0), "doc_id", "text").count() == 0


def test_a_long_word_takes_seconds(spark, coder):
    import random
    import time

    rnd = random.Random(4)
    text = "".join(rnd.choices("ABCDEFabcdefghijklmnopqrstuvwxyz+/", k=30_000))
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    began = time.time()
    got = coder.encode(spark.createDataFrame([(1, text + " " + "abcdefgh" * 12_500)], "doc_id bigint, text string"), "doc_id", "text").collect()[0]
    assert list(got.ids) == enc.encode_ordinary(text + " " + "abcdefgh" * 12_500) and time.time() - began < 60
