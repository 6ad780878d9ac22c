"""From raw documents to packed training sequences: quality rules, quality classifier, near duplicates, packing.

Each stage gets the documents that the one before it kept, as a written table, and returns those that it keeps
with all their columns; the last one returns the packed pieces. Every row is judged by itself, not by its id:
ids may repeat or be missing. The first two stages decide where the rows are; near duplicates are told apart by
the file of the table that a row stands in and its place there.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.llm import ordinal, outliers, packing, simhash
from larder.llm.tables import documents, read, ready, stage

# SQL has neither the iterated estimates, the fitted classifier nor the tokenizer; see tests/llm/test_pipeline.py.
ORACLE_SQL = None

_PLACES = 40  # bits for the place of a row in its file


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a number for each row, and the name of its column.

    A table of files has the number already: file and place. Anything else is written first.
    """
    number = "_number"
    while any(c.lower().startswith(number) for c in docs.columns):
        number = f"_{number}"
    path, file, row = (f"{number}_{x}" for x in ("path", "file", "row"))
    plain = docs._jdf.queryExecution().analyzed().children().isEmpty()
    try:
        place = docs.metadataColumn("_metadata") if plain else None
        if place is not None:
            docs.select(place["row_index"])
    except AnalysisException:
        place = None
    if place is None:
        docs = stage(docs, "documents")
        place = docs.metadataColumn("_metadata")
    # One row for each file.
    files = docs.select(place["file_path"].alias(path)).distinct()
    files = stage(files.withColumn(file, F.row_number().over(Window.orderBy(path)).cast("long")), "files")
    rows = docs.select("*", place["file_path"].alias(path), place["row_index"].alias(row)).join(F.broadcast(files), path)
    return rows.select(*[f"`{c}`" for c in docs.columns], (F.shiftleft(file, _PLACES) + F.col(row)).alias(number)), number


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or are robust outliers of their language and source.

    Null, empty and short texts fail the base rules; rows with equal texts, languages and sources are judged alike.
    """
    return outliers.kept_rows(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are less likely than not to be of grade 1 or better; equal texts are judged alike.

    The classifier learns from the rated documents of the whole table: the rules before it have left few poor ones.
    A null text counts as empty. Without a rated document all rows have the same grade.
    """
    model = ordinal.fit(documents(read(spark, sf_dir, "documents")), ordinal.graded(read(spark, sf_dir, "labels")))
    return ordinal.kept_rows(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates: SimHashes of three-word shingles within two bits.

    It is the one with the smallest id, of several with that id the first; one without an id if no row has one.
    All rows without a word (null, empty or blank texts) are one group, together with fingerprints near zero.
    """
    rows, number = _numbered(docs)
    found = simhash.simhash_components(rows, simhash.SHINGLE, id_col=number)
    found = stage(found.select(F.col("doc_id").alias(number), "component_id"), "found")
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", F.col(number).alias("row"))
    least = rows.select(number, "doc_id").join(found, number).groupBy("component_id").agg(F.min(order).alias("least"))
    dropped = found.join(least.select(F.col("least.row").alias(number)), number, "left_anti").select(number)
    return rows.join(stage(dropped, "dropped"), number, "left_anti").drop(number)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences of at most 2048 tokens; null and empty texts are packed as their end token."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def _with_session(function):
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return function(ready(spark), docs, sf_dir)

    call.__doc__ = function.__doc__
    return call


STAGES = [(f.__name__, _with_session(f)) for f in (quality_rules, quality_classifier, near_duplicates, pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents; each one's result is written to the shared folder and read again."""
    docs = read(ready(spark), sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
