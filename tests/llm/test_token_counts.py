"""Token counts against the library itself, cold and warm."""

import messy
import public_tokenizers
import pytest
from tokenizers import Tokenizer as Library

from starlattice.llm import token_counts
from starlattice.llm.common import new_folder

FAST = token_counts.Tokenizer(
    public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
    public_tokenizers.PATTERN, (("<|endoftext|>", 50256),),
)
WORDS = token_counts.Tokenizer(public_tokenizers.path("word_bpe_49k.json"))
TRICKY = ["<|endoftext|>a<|endoftext|>", "  two  spaces \n\n\t x", "don't I'LL", "\x85\x1c\u2028 \u3000日本語", "\x00\x07", "ﬁ😀é", "a\r\nb "]


def expected(tokenizer, text):
    return len(Library.from_file(tokenizer.path).encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("tokenizer", [FAST, WORDS])
def test_as_the_library_counts(spark, tokenizer):
    docs = messy.documents(spark, rows=20).select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(900 + i, t) for i, t in enumerate(TRICKY)], "doc_id long, text string"))
    got = token_counts.count_tokens(docs, tokenizer, new_folder(spark, "cache"), keep=("doc_id", "text")).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_bytes, r.n_tokens) == (len((r.text or "").encode()), expected(tokenizer, r.text)), r.text


@pytest.mark.parametrize("limit", [token_counts.BROADCAST_DIGESTS, 0])
def test_only_misses_are_encoded_and_appended(spark, monkeypatch, limit):
    monkeypatch.setattr(token_counts, "BROADCAST_DIGESTS", limit)
    cache = new_folder(spark, "cache")
    first = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, None)], "doc_id long, text string")
    token_counts.count_tokens(first, FAST, cache).collect()
    stored = lambda: spark.read.parquet(f"{cache}/{FAST.digest()}")
    assert stored().count() == 2
    # A wrong count in the cache shows that hits are not encoded again; a repeated row does not multiply.
    stored().selectExpr("digest", "n_tokens + 1000 as n_tokens").write.mode("append").parquet(f"{cache}/{FAST.digest()}")
    more = spark.createDataFrame([(1, "a b"), (4, "new one"), (5, "new one")], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(more, FAST, cache).collect()}
    assert got == {1: 1002, 4: 2, 5: 2}
    assert stored().count() == 5


def test_no_rows(spark):
    assert token_counts.count_tokens(messy.empty(spark), FAST, new_folder(spark, "cache")).count() == 0
