"""A panel written by series: rows of one series stand together, so work on series needs no shuffle.

The table is bucketed by the series keys and sorted inside each bucket. Lags, rolling statistics, profiles and the
lookup of profiles then run bucket by bucket. It is for series that one task can hold, such as weeks of the
calendar: a longer one is refused, because a bucket is read by one task. Rows without a full key belong to no series; they
are kept apart in plain files, so they do not fill one bucket.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.heavy import LIGHT_ROWS, _all_set, heavy_groups

ROWS_PER_BUCKET = 500_000


@dataclass(frozen=True)
class SeriesTable:
    """``folder`` holds the buckets, the rows without a key and the layout, which a later session reads."""

    spark: SparkSession
    folder: str
    name: str  # in the session's catalog
    keys: tuple[str, ...]
    buckets: int

    @classmethod
    def write(
        cls,
        df: DataFrame,
        folder: str,
        keys: Sequence[str] = ("center_id", "meal_id"),
        order: Sequence[str] = ("week",),
        buckets: int | None = None,
        light_rows: int = LIGHT_ROWS,
    ) -> "SeriesTable":
        """Write a panel; one shuffle deals the series to the buckets, and each task writes one file.

        ``df`` is read three times: for its sizes, its series and the rows apart. Without ``buckets`` there is one
        for each half million rows. An existing folder is an error.
        """
        spark, keys, order = df.sparkSession, list(keys), list(order)
        known = _all_set(keys)
        long = heavy_groups(df.filter(known).select(*keys), keys, light_rows)
        sizes = long.agg(F.count(F.lit(1)).alias("n"), F.max("group_rows").alias("most")).first()
        if sizes["n"]:
            raise ValueError(
                f"{sizes['n']} series have more than {light_rows} rows, the longest {sizes['most']}; "
                "use write_features and let history_features cut them"
            )
        if buckets is None:
            buckets = max(1, -(-df.filter(known).count() // ROWS_PER_BUCKET))
        name = _new_name()
        writer = df.filter(known).repartition(buckets, *keys).write.format("parquet").mode("errorifexists")
        writer.bucketBy(buckets, *keys).sortBy(*keys, *order).option("path", f"{folder}/series").saveAsTable(name)
        df.filter(~known).write.mode("errorifexists").parquet(f"{folder}/apart")
        layout = spark.createDataFrame([(keys, order, buckets)], "keys array<string>, order array<string>, buckets int")
        layout.coalesce(1).write.mode("errorifexists").json(f"{folder}/layout")
        return cls(spark, folder, name, tuple(keys), buckets)

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> "SeriesTable":
        """A table that was written before, by this session or another one."""
        layout = spark.read.schema("keys array<string>, order array<string>, buckets int").json(f"{folder}/layout").first()
        columns = spark.read.parquet(f"{folder}/series").schema
        name = _new_name()
        spark.sql(
            f"CREATE TABLE {name} ({columns.toDDL()}) USING parquet "
            f"CLUSTERED BY ({_quoted(layout['keys'])}) SORTED BY ({_quoted([*layout['keys'], *layout['order']])}) "
            f"INTO {layout['buckets']} BUCKETS LOCATION '{folder}/series'"
        )
        return cls(spark, folder, name, tuple(layout["keys"]), layout["buckets"])

    def series(self) -> DataFrame:
        """The rows with a full key; grouping, windows and joins by the keys need no shuffle."""
        return self.spark.table(self.name)

    def apart(self) -> DataFrame:
        """The rows without a full key."""
        return self.spark.read.schema(self.series().schema).parquet(f"{self.folder}/apart")

    def forget(self) -> None:
        """Take the table out of the session's catalog; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def _new_name() -> str:
    return f"series_{uuid.uuid4().hex}"


def _quoted(names: Sequence[str]) -> str:
    return ", ".join(f"`{name}`" for name in names)
