"""Loading the input tables from CSV or Parquet."""

from __future__ import annotations

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import clean
from .contracts import CONTRACTS, DataContractError, TableContract

MANDATORY = ("train", "centers", "meals")


def _whole(name: str, kind: str):
    """An integer column from text; "3.0" is accepted, "3.5" is an error and not silently cut off."""
    number = F.col(name).cast("double")
    wrong = F.raise_error(F.concat(F.lit(f"{name} is not a whole number: "), F.col(name)))
    return F.when(number.isNull() | F.isnan(number), None).when(number == F.floor(number), number.cast(kind)).otherwise(wrong)


def typed(df: DataFrame, contract: TableContract) -> DataFrame:
    """Cast the known columns by name and turn NaN into NULL; other columns are kept as they are."""
    text = {name for name, kind in df.dtypes if kind == "string"}

    def one(name: str):
        kind = contract.columns.get(name)
        if kind is None:
            return F.col(name)
        if kind == "double":
            return clean(name).alias(name)
        if kind in ("int", "bigint") and name in text:
            return _whole(name, kind).alias(name)
        return F.col(name).cast(kind).alias(name)

    return df.select(*[one(c) for c in df.columns])


def read_table(spark: SparkSession, path: str, contract: TableContract) -> DataFrame:
    """One input file or folder. CSV columns are matched by header name, never by position."""
    if path.endswith(".parquet"):
        return typed(spark.read.parquet(path), contract)
    # Without inferSchema only the header is read here; the values are cast by the plan.
    raw = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    return typed(raw, contract)


def load_tables(
    spark: SparkSession,
    folder: str,
    include_test: bool = True,
    validate: bool = True,
    extension: str = "csv",
) -> dict[str, DataFrame]:
    """All input tables of a folder, checked against their contracts unless told otherwise.

    A missing mandatory table raises ``FileNotFoundError``; a missing ``test`` table is left out. A checked table
    is parsed once: it is written typed to the shared folder, where its rows are counted against the rules on the
    way, and comes back as Parquet. Without the checks the frames read the input whenever they are used.
    """
    from ..operators.quality import check_columns, check_observed, check_relationships, observe_table

    tables: dict[str, DataFrame] = {}
    for key in (*MANDATORY, "test") if include_test else MANDATORY:
        contract = CONTRACTS[key]
        file = contract.file if extension == "csv" else contract.file.replace(".csv", f".{extension}")
        try:
            tables[key] = read_table(spark, f"{folder.rstrip('/')}/{file}", contract)
        except AnalysisException as err:
            if "PATH_NOT_FOUND" not in str(err.getCondition()):
                raise DataContractError(f"cannot read {file}: {err}") from err
            if key in MANDATORY:
                raise FileNotFoundError(f"{file} is required in {folder}") from err
    if validate:
        try:
            for key, df in tables.items():
                check_columns(df, CONTRACTS[key])
                seen = observe_table(df, CONTRACTS[key])
                check_observed(seen)
                tables[key] = seen.table
            check_relationships(tables)
        except PySparkException as err:
            raise DataContractError(f"cannot read the tables in {folder}: {err}") from err
    return tables
