"""Token counts of whole texts, kept in a cache of content digests."""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from starlattice.llm.common import stored

# Up to this many missing digests are broadcast: 32 bytes each, at most about 30 MB.
BROADCAST_DIGESTS = 500_000
# Characters whose classes all versions of Unicode agree on; other texts go to the slower library.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa0-ɏ]*")


@dataclass(frozen=True)
class Tokenizer:
    """A vocabulary: the `tokenizers` file, and if there is one the same ranks for the faster `tiktoken`.

    `special` are strings that stand for one token inside a text.
    """

    path: str
    ranks: str | None = None
    pattern: str | None = None
    special: tuple[tuple[str, int], ...] = ()

    def digest(self) -> str:
        with open(self.path, "rb") as file:
            return hashlib.sha256(file.read()).hexdigest()


@functools.lru_cache(maxsize=2)
def _counter(tokenizer: Tokenizer):
    """A function from a text to its number of tokens; loaded once in each worker."""
    from tokenizers import Tokenizer as Library

    library = Library.from_file(tokenizer.path)
    library.no_padding()
    library.no_truncation()

    def count(text: str) -> int:
        return len(library.encode(text, add_special_tokens=False))

    if tokenizer.ranks is None:
        return count
    import tiktoken

    with open(tokenizer.ranks, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    fast = tiktoken.Encoding(
        "ranks", pat_str=tokenizer.pattern, mergeable_ranks=ranks, special_tokens=dict(tokenizer.special)
    )
    return lambda text: len(fast.encode(text, allowed_special="all")) if _PLAIN.fullmatch(text) else count(text)


def _encoder(tokenizer: Tokenizer):
    @F.pandas_udf("long")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = _counter(tokenizer)
        for texts in batches:
            yield pd.Series([count(text) for text in texts], dtype="int64")

    return encode


def _cached(docs: DataFrame, path: str) -> DataFrame | None:
    """The stored counts, one per digest even if two runs appended the same; None if there are none yet."""
    try:
        rows = docs.sparkSession.read.schema("digest binary, n_tokens long").parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def content(text: Column) -> Column:
    """The normalised content: this vocabulary has no normaliser, so the text itself, null as empty."""
    return F.coalesce(text, F.lit(""))


def count_tokens(docs: DataFrame, tokenizer: Tokenizer, cache: str, *, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Tokens of every whole text; only contents that the cache lacks are encoded, each once.

    The cache is a folder of Parquet tables, one for each vocabulary digest, with
    the digest and token count of each content; new counts are appended, never
    rewritten. Returns the `keep` columns, n_bytes and n_tokens for every row of docs,
    repeated rows included. Null and empty texts have 0 bytes and 0 tokens. No rows: no
    rows. Further columns of docs are not read.
    """
    folder = f"{cache.rstrip('/')}/{tokenizer.digest()}"
    text = content(F.col("text"))
    digested = docs.select(F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("content"))
    known = _cached(docs, folder)
    if known is None:
        missing = digested.dropDuplicates(["digest"])
    else:
        lacking = stored(digested.select("digest").distinct().join(known, "digest", "left_anti"), "missing-digests")
        if lacking.count() <= BROADCAST_DIGESTS:
            missing = digested.join(F.broadcast(lacking), "digest", "left_semi").dropDuplicates(["digest"])
        else:
            # Copies fold before the shuffle, so that no content gathers in one task.
            missing = digested.dropDuplicates(["digest"]).join(lacking, "digest", "left_semi")
    counted = missing.select("digest", _encoder(tokenizer)("content").alias("n_tokens"))
    counted.write.mode("append").parquet(folder)
    rows = docs.select(
        *keep, F.octet_length(text).cast("long").alias("n_bytes"), F.unhex(F.sha2(text, 256)).alias("digest")
    )
    # Stored, so that the join stands alone and skew handling can split the rows of a hot content.
    counts = stored(_cached(docs, folder), "token-counts")
    return rows.join(counts, "digest").select(*keep, "n_bytes", "n_tokens")
