"""What the operators share: narrow inputs, written intermediate tables, training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship, tune
from ..sources.staging import stage

__all__ = ["documents", "read", "ready", "remainder", "stage"]


def ready(spark: SparkSession) -> SparkSession:
    """Sets the runtime options and sends this package to the executors, where it may not be installed."""
    ship(spark)
    return tune(spark)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more: str) -> DataFrame:
    """Only the columns an operator works on, under its own names; other columns cannot clash with them.

    The id becomes ``doc_id`` (long), the text ``text`` with an empty text in place of null.
    """
    kept = [F.col(c).alias(name) for name, c in more.items()]
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *kept)


def remainder(id_column: str | Column, divisor: int) -> Column:
    """The CRC-32 of an id in decimal, modulo ``divisor``: a fixed fold for hold-outs; null for a null id."""
    return F.crc32(F.col(id_column).cast("string") if isinstance(id_column, str) else id_column.cast("string")) % divisor
