"""Token counts with a digest cache.

The cache is a Parquet dataset partitioned by tokenizer version, one row per distinct normalised text:
``digest`` (SHA-256), ``n_tokens``. Texts are joined to it by digest; only distinct texts that it does not hold
are encoded, and their counts are appended. A change of the tokenizer file or library is another version.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from importlib.metadata import version

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import text_blocks
from .chunks import byte_bpe, file_digest
from .tables import documents, stage

CACHE_SCHEMA = "digest binary, n_tokens long, version string"


def tokenizer_version(path: str) -> str:
    return f"{file_digest(path)[:32]}-{version('tokenizers')}"


def read_cache(spark: SparkSession, cache: str, name: str) -> DataFrame:
    """Stored ``digest, n_tokens`` of one tokenizer version, each digest once; empty if there is no cache yet."""
    try:
        stored = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "digest binary, n_tokens long")
    # Two runs at a time may have appended the same text; their counts are equal.
    return stored.filter(F.col("version") == name).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _encode(texts: DataFrame, tokenizer: str, ranks: str | None) -> DataFrame:
    schema = pa.schema([("digest", pa.binary()), ("n_tokens", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe(tokenizer, ranks)
        for batch in batches:
            for first, block in text_blocks(batch.column(1)):
                counts = pa.array(encoder.counts(block), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(block)), counts], schema=schema)

    return texts.mapInArrow(work, "digest binary, n_tokens long")


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    cache: str,
    ranks: str | None = None,
    limit: int = 1024,
    normalise: Callable[[Column], Column] = lambda text: text,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row; appends what was missing to ``cache``.

    ``cache`` is a folder that all executors share. ``normalise`` may only undo differences that the tokenizer
    does not see (it sees them all where it has no normaliser of its own). A null text counts as empty: 0
    bytes, 0 tokens. Repeated rows are encoded once and returned as often as they occur.
    """
    spark, name = docs.sparkSession, tokenizer_version(tokenizer)
    texts = documents(docs, id_col, text_col).select(
        "doc_id", normalise(F.col("text")).alias("text"), F.octet_length("text").cast("long").alias("n_bytes")
    )
    keyed = texts.select("doc_id", "n_bytes", F.unhex(F.sha2("text", 256)).alias("digest"), "text")
    rows = stage(keyed.drop("text"), "digests")
    # One shuffle of the distinct texts; a text with very many copies is cut down to one per task before it.
    misses = keyed.select("digest", "text").dropDuplicates(["digest"]).join(read_cache(spark, cache, name), "digest", "left_anti")
    new = _encode(misses, tokenizer, ranks).withColumn("version", F.lit(name))
    new.write.mode("append").partitionBy("version").parquet(cache)
    counted = rows.join(read_cache(spark, cache, name), "digest")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
