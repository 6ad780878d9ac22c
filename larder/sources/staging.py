"""Intermediate tables written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import fresh_folder


def stage(df: DataFrame, label: str = "stage", folder: str | None = None) -> DataFrame:
    """Write a frame to the shared folder, or to a ``folder`` that the caller will remove, and read it back.

    Used where a frame is read several times or is looked up against a large table. It cuts the lineage
    in a way that outlives lost executors, later passes read only the columns they need, and the
    planner knows the true size: it broadcasts the table when that is below its threshold and otherwise
    shuffles, splitting skewed partitions.
    """
    folder = folder or fresh_folder(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
