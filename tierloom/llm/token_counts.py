"""Token counts through a cache of digests.

The cache is a Parquet folder of ``tokenizer, content, n_tokens``: a digest of the tokenizer (file, library version, options), a
digest of the normalised text and its count. A run joins the digests of its texts to the cache, encodes one text for each
digest that is not there, appends these counts and reads all counts from the cache.
"""

from __future__ import annotations

import hashlib
import os

import public_tokenizers
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.llm.common import staged, whole_text, words_of

#: A worker's remembered words are dropped beyond this count; the counts stay the same.
MOST_WORDS = 400_000
CACHE = "content binary, n_tokens long, tokenizer string"


class JsonCounter:
    """Counts with ``tokenizers``. If the tokenizer drops white space (``by_word``), a text's count is the sum of its words'
    counts, and words seen before are looked up: neither its pattern nor its normal forms reach across one of the six
    separators, and no special string holds one."""

    def __init__(self, path: str, by_word: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.by_word = Tokenizer.from_file(path), by_word
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[bytes, int] = {}

    def _encoded(self, texts: list[bytes]) -> list[int]:
        found = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [len(f.ids) for f in found]

    def counts(self, texts: list[bytes]) -> list[int]:
        if not self.by_word:
            return self._encoded(texts)
        if len(self.known) > MOST_WORDS:
            self.known.clear()
        split = [words_of(text) for text in texts]
        new = list({word for words in split for word in words if word not in self.known})
        self.known.update(zip(new, self._encoded(new)))
        return [sum(map(self.known.__getitem__, words)) for words in split]


class PieceCounter:
    """Counts with ``sentencepiece``, whole texts only."""

    def __init__(self, path: str, by_word: bool):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def counts(self, texts: list[bytes]) -> list[int]:
        return [len(ids) for ids in self.model.encode([t.decode() for t in texts], num_threads=1)]


def counter(path: str, by_word: bool):
    return (PieceCounter if path.endswith(".model") else JsonCounter)(path, by_word)


def tokenizer_digest(path: str, by_word: bool) -> str:
    """Name of a tokenizer's version: its file, the library that runs it and the options."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    version = __import__(library).__version__
    with open(path, "rb") as file:
        return hashlib.sha256(f"{library} {version} {by_word}\n".encode() + file.read()).hexdigest()


def content_digest(text: Column, by_word: bool) -> Column:
    """Digest of the normalised text. Runs of separators become one space only where the tokenizer drops them anyway."""
    text = F.coalesce(text, F.lit(""))
    return F.unhex(F.sha2(F.trim(F.regexp_replace(text, r"[ \t-\r]+", " ")) if by_word else text, 256))


def read_cache(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """``content, n_tokens`` for one tokenizer; two runs at a time may have appended the same digest, so one row each."""
    try:
        cache = spark.read.schema(CACHE).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        cache = spark.createDataFrame([], CACHE)
    return cache.where(F.col("tokenizer") == tokenizer).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(
    docs: DataFrame,
    cache: str,
    tokenizer_path: str = public_tokenizers.path("word_bpe_49k.json"),
    by_word: bool = True,
    limit: int = 2048,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` for every row of ``docs``; new counts are appended to the folder ``cache``.

    ``by_word`` says that the tokenizer drops white space. A null text counts as empty, an empty text has 0 tokens. Repeated
    rows come back as often as they came in, null keys included; only ``key`` and ``text`` are read, whatever other columns
    are called. An empty table gives an empty result and leaves the cache as it was. If a run dies while it appends,
    Spark's commit leaves nothing half-written that a later run would read as counts.
    """
    spark, version = docs.sparkSession, tokenizer_digest(tokenizer_path, by_word)
    texts = docs.select(
        F.col(key).alias("_key"), F.col(text).alias("_text"), content_digest(F.col(text), by_word).alias("content")
    )
    rows = staged(texts.select("_key", "content", F.octet_length(F.coalesce("_text", F.lit(""))).cast("long").alias("n_bytes")),
                  "token-digests")
    # One keeper for each digest: copies of it elsewhere are neither shuffled by digest alone nor encoded.
    missing = rows.groupBy("content").agg(F.min("_key").alias("_first"))
    missing = missing.join(read_cache(spark, cache, version), "content", "left_anti")
    missing = staged(missing, "token-misses").withColumnRenamed("content", "_digest")
    to_encode = texts.join(missing, (F.col("content") == F.col("_digest")) & F.col("_key").eqNullSafe(F.col("_first")))

    def run(batches):
        encoder = None
        for batch in batches:
            encoder = encoder or counter(tokenizer_path, by_word)
            for at in range(0, batch.num_rows, 250):
                part = batch.slice(at, 250)
                counts = encoder.counts(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64())], names=["content", "n_tokens"])

    encoded = to_encode.select("content", whole_text(F.col("_text")).alias("_text")).mapInArrow(run, "content binary, n_tokens long")
    encoded = encoded.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))  # rows repeated with their key
    encoded.withColumn("tokenizer", F.lit(version)).write.mode("append").partitionBy("tokenizer").parquet(cache)
    # Written, so that the rows of a frequent digest can be split.
    known = staged(read_cache(spark, cache, version).join(rows.select("content").distinct(), "content", "left_semi"), "token-counts")
    counted = rows.join(known, "content")
    return counted.select(F.col("_key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
