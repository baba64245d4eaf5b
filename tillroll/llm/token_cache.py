"""Token counts with a digest cache.

A text's normalised content and the tokenizer's file each have a SHA-256 digest. White
space is normalised where the tokenizer's counts do not depend on it, else nothing is. The
cache is a Parquet table (content, tokenizer, n_tokens) that only grows. Counting joins
the texts' digests to it; of the texts not found, one for each distinct digest is encoded
and its count appended. Copies are thus encoded once, and a text seen in an earlier call
not at all. A new tokenizer file has a new digest, so it never meets old counts.
"""

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.arrays import Chunk, span_hashes, text_chunks, words
from tillroll.llm.common import SPACE, text_or_empty
from tillroll.sources.paths import folder_exists, new_shared_folder

CACHE_SCHEMA = "content binary, tokenizer string, n_tokens long"
#: Words whose count a Python worker remembers; it starts afresh beyond.
MEMORY_WORDS = 2_000_000
#: Bytes of the chunks of texts here: a Python worker keeps the room that one took.
CHUNK_BYTES = 256 << 10
#: Words or texts handed to the tokenizer at once; what it returns for each takes about 1 KB.
ENCODED_AT_ONCE = 5_000


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.file_digest(file, "sha256").hexdigest()


class _Encoder:
    """A tokenizer and the counts of the words it met; one for each Python worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.forget()

    def forget(self) -> None:
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def count(self, texts: list[str]) -> list[int]:
        counts = []
        for i in range(0, len(texts), ENCODED_AT_ONCE):
            some = texts[i : i + ENCODED_AT_ONCE]
            encoded = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            counts += [len(x.ids) for x in encoded]
        return counts

    def count_words(self, chunk: Chunk) -> np.ndarray:
        """Token count of each text of the chunk, as the sum over its words."""
        found = words(chunk)
        distinct, first, back = np.unique(
            span_hashes(chunk.data, found.starts, found.ends),
            return_index=True,
            return_inverse=True,
        )
        if len(self.hashes) + len(distinct) > MEMORY_WORDS:
            self.forget()
        at = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), dtype=bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == distinct[inside]
        counts = np.zeros(len(distinct), dtype=np.int64)
        counts[known] = self.counts[at[known]]
        new = ~known
        if new.any():
            spans = zip(found.starts[first[new]], found.ends[first[new]], strict=True)
            counts[new] = self.count([chunk.data[a:b].tobytes().decode() for a, b in spans])
            self.hashes = np.insert(self.hashes, at[new], distinct[new])
            self.counts = np.insert(self.counts, at[new], counts[new])
        sums = np.concatenate([[0], np.cumsum(counts[back])])
        return sums[found.stop] - sums[found.first]


@lru_cache(maxsize=1)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


def _totals(path: str, by_word: bool, texts: pa.RecordBatch) -> pa.Array:
    encoder = _encoder(path)
    totals = np.zeros(texts.num_rows, dtype=np.int64)
    for chunk in text_chunks(texts, "text", CHUNK_BYTES):
        if by_word:
            counts = encoder.count_words(chunk)
        else:
            spans = zip(chunk.starts, chunk.ends, strict=True)
            counts = encoder.count([chunk.data[a:b].tobytes().decode() for a, b in spans])
        totals[chunk.first : chunk.first + len(chunk.starts)] = counts
    return pa.array(totals)


def _count(path: str, by_word: bool):
    """Function for mapInArrow: (content, text) to (content, n_tokens)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("content"), _totals(path, by_word, batch)],
                names=["content", "n_tokens"],
            )

    return count


def token_number(text: str, tokenizer_path: str, by_word: bool = True) -> Column:
    """The number of tokens of a text column, as ``token_counts`` gives it, without a cache."""
    if by_word:
        refuse_across_words(tokenizer_path)

    @F.arrow_udf("long")
    def number(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        return _totals(tokenizer_path, by_word, batch)

    return number(text_or_empty(text))


@lru_cache(maxsize=8)
def refuse_across_words(path: str) -> None:
    """Raise ValueError if the tokenizer counts words otherwise in a text than each alone.

    It is tried on all pairs of a few words and single characters with every ASCII white
    space and runs of it between, before and behind them.
    """
    encoder = _Encoder(path)
    words = ["word", "Words", "x", "1", "2024", "'s", "...", "-", "(", "\u00e9t\u00e9", "\u4e2d\u6587"]
    gaps = [" ", "\t", "\n", "\v", "\f", "\r", "  ", " \n", "\n\n", "\r\n", "\t "]
    alone = dict(zip(words, encoder.count(words), strict=True))
    texts, expected = [], []
    for a in words:
        for b in words:
            for gap in gaps:
                texts += [f"{a}{gap}{b}", f"{gap}{a}{gap}{b}{gap}"]
                expected += [alone[a] + alone[b]] * 2
    if encoder.count(texts) != expected:
        raise ValueError(f"{path} has tokens that depend on white space: use by_word=False")


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    if folder_exists(spark, path):
        return spark.read.schema(CACHE_SCHEMA).parquet(path)
    return spark.createDataFrame([], CACHE_SCHEMA)


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    cache_path: str | None = None,
    id_column: str = "doc_id",
    text: str = "text",
    by_word: bool = True,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens; one row for each row, repeated or null ids included.

    ``by_word`` is for tokenizers that never look across ASCII white space: a text's count
    is then the sum over its words, and a worker encodes a word once. Set it to False for
    any other: each distinct text is then encoded as it is. A tokenizer that shows in a trial
    that it does look across is refused. Both kinds of counts may share a cache. ``tokenizer_path`` is a file of the tokenizers library that every executor has. A
    null text is empty and has no tokens. Counts leave out begin, end and other added
    tokens; special strings inside a text are what the library makes of them by default.
    ``cache_path`` is the cache, made if missing; without it the counts of this call go
    to a new one. Counts are appended before they are used; a failed run may have
    appended some, which is harmless, as a count is the same whoever finds it.
    """
    spark = docs.sparkSession
    path = cache_path or f"{new_shared_folder(spark, 'token-cache')}/counts"
    version = tokenizer_digest(tokenizer_path)
    content = F.col("text")
    if by_word:
        refuse_across_words(tokenizer_path)
        content = F.trim(F.regexp_replace(content, SPACE, " "))
    else:
        version += "-whole"
    raw = docs.select(F.col(id_column).alias("doc_id"), text_or_empty(text).alias("text"))
    keyed = raw.withColumn("content", F.unhex(F.sha2(F.encode(content, "UTF-8"), 256)))
    # A cache written by two calls at once can hold a digest twice.
    cached = (
        read_cache(spark, path)
        .filter(F.col("tokenizer") == version)
        .groupBy("content")
        .agg(F.max("n_tokens").alias("n_tokens"))
    )
    misses = keyed.select("content", "text")
    if folder_exists(spark, path):
        misses = misses.join(cached.select("content"), "content", "left_anti")
    (
        misses.dropDuplicates(["content"])
        .mapInArrow(_count(tokenizer_path, by_word), "content binary, n_tokens long")
        .select("content", F.lit(version).alias("tokenizer"), "n_tokens")
        .write.mode("append")
        .parquet(path)
    )
    stored = (
        read_cache(spark, path)
        .filter(F.col("tokenizer") == version)
        .groupBy("content")
        .agg(F.max("n_tokens").alias("n_tokens"))
    )
    return keyed.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "content").join(
        stored, "content"
    ).select("doc_id", "n_bytes", "n_tokens")
