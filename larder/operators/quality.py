"""Data-quality checks.

Rules on single rows are counted while a table is written (``observe_table``), so its source is scanned once;
duplicates and unknown keys are then found in the written key columns. Only the counts reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.contracts import CONTRACTS, RelationshipError, SchemaError, TableContract
from ..sources.staging import stage

REPORT_SCHEMA = "table string, check string, column string, violations bigint"


def missing_columns(df: DataFrame, required) -> list[str]:
    return sorted(set(required) - set(df.columns))


def extra_columns(df: DataFrame, known) -> list[str]:
    return sorted(set(df.columns) - set(known))


def require_columns(df: DataFrame, required) -> None:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing required columns: {missing}")


Rule = tuple[str, str, Column | None]  # (check, column, condition of a bad row)


def _rules(df: DataFrame, contract: TableContract) -> list[Rule]:
    """In the order in which an error is to be raised; no condition on a single row tells a duplicate."""
    here = set(df.columns)
    rules: list[Rule] = []
    for c in contract.primary_key:
        if c in here:
            rules.append(("pk_null", c, F.col(c).isNull()))
            rules.append(("pk_duplicate", c, None))
    rules += [("not_binary", c, ~F.col(c).isin(0, 1)) for c in contract.binary if c in here]
    rules += [("not_positive", c, F.col(c) <= 0) for c in contract.positive if c in here]
    rules += [("negative", c, F.col(c) < 0) for c in contract.non_negative if c in here]
    return rules


def _counted(rule: Rule) -> Column:
    _, column, bad = rule
    return F.count(column) - F.count_distinct(F.col(column)) if bad is None else F.count_if(bad).cast("bigint")


def _counts(df: DataFrame, contract: TableContract, rules: list[Rule]) -> DataFrame:
    """(table, check, column, violations) of the rules, from one pass over the frame."""
    if not rules:
        return df.sparkSession.createDataFrame([], REPORT_SCHEMA)
    counted = df.agg(*[_counted(rule).alias(f"r{i}") for i, rule in enumerate(rules)])
    rows = [
        F.struct(
            F.lit(contract.name).alias("table"),
            F.lit(check).alias("check"),
            F.lit(column).alias("column"),
            F.col(f"r{i}").alias("violations"),
        )
        for i, (check, column, _) in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*rows)))


def table_violations(df: DataFrame, contract: TableContract) -> DataFrame:
    """(table, check, column, violations), one row per rule, from one pass over the table."""
    return _counts(df, contract, _rules(df, contract))


@dataclass(frozen=True)
class Observed:
    """A written table with the broken rules that were counted on the way."""

    table: DataFrame
    contract: TableContract
    rules: list[Rule]
    rows: int
    found: dict[tuple[str, str], int]

    def violations(self) -> DataFrame:
        """(table, check, column, violations); only the key columns are read, for the duplicates."""
        name = self.contract.name
        seen = [(name, check, column, n) for (check, column), n in self.found.items()]
        spark = self.table.sparkSession
        rest = [rule for rule in self.rules if rule[2] is None]
        return spark.createDataFrame(seen, REPORT_SCHEMA).unionByName(_counts(self.table, self.contract, rest))


def observe_table(df: DataFrame, contract: TableContract, columns: Sequence[str] | None = None) -> Observed:
    """Write a table, or the named columns of it, as Parquet and count the broken rules in the same pass.

    The tasks that write do the counting. Each partition counts once, however often its task is tried.
    """
    rules = _rules(df, contract)
    single = [rule for rule in rules if rule[2] is not None]
    seen = Observation()
    counts = [_counted(rule).alias(f"r{i}") for i, rule in enumerate(single)]
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)
    written = stage(watched.select(*columns) if columns else watched, contract.name)
    got = seen.get
    found = {(check, column): got[f"r{i}"] for i, (check, column, _) in enumerate(single)}
    return Observed(written, contract, rules, got["rows"], found)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """The keys that occur more than once, with their number of rows beyond the first."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg((F.count(F.lit(1)) - 1).alias("duplicates"))
        .filter("duplicates > 0")
    )


def binary_outliers(df: DataFrame, column: str) -> DataFrame:
    """The values outside {0, 1} and how often they occur."""
    return (
        df.filter(~F.col(column).isin(0, 1))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def unmapped_keys(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Distinct non-null child keys without a parent row.

    Both sides are reduced to distinct keys first, so a hot key is one row by the time it is joined; the
    planner broadcasts the parent keys if their size allows it.
    """
    keys = child.select(F.col(key).alias("key")).filter("key IS NOT NULL").distinct()
    known = parent.select(F.col(parent_key or key).alias("key")).distinct()
    return keys.join(known, "key", "left_anti")


def unmapped_sample(unmapped: DataFrame, n: int = 5) -> DataFrame:
    return unmapped.orderBy("key").limit(n)


def _links(tables: dict[str, DataFrame], contracts: dict[str, TableContract]):
    for name, df in tables.items():
        for column, (parent, parent_key) in (contracts[name].foreign_keys if name in contracts else {}).items():
            if parent in tables and column in df.columns and parent_key in tables[parent].columns:
                yield name, column, parent, unmapped_keys(df, tables[parent], column, parent_key)


def relationship_violations(
    tables: dict[str, DataFrame], contracts: dict[str, TableContract] = CONTRACTS
) -> DataFrame | None:
    parts = [
        missing.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(name).alias("table"),
            F.lit("foreign_key").alias("check"),
            F.lit(column).alias("column"),
            "violations",
        )
        for name, column, _, missing in _links(tables, contracts)
    ]
    return reduce(DataFrame.unionByName, parts) if parts else None


def _key_columns(name: str, df: DataFrame, contracts: dict[str, TableContract]) -> list[str]:
    """Columns by which rows of the table are told apart, point to others or are pointed to."""
    wanted = {*contracts[name].primary_key, *contracts[name].foreign_keys}
    for contract in contracts.values():
        wanted |= {key for parent, key in contract.foreign_keys.values() if parent == name}
    return [c for c in df.columns if c in wanted]


def violation_report(tables: dict[str, DataFrame], contracts: dict[str, TableContract] = CONTRACTS) -> DataFrame:
    """Every check of every table as rows (table, check, column, violations).

    Each table is read once: its key columns are written, and rules on single rows are counted meanwhile.
    A table without key columns is only counted.
    """
    parts, keyed = [], dict(tables)
    for name, df in tables.items():
        if name not in contracts:
            continue
        keys = _key_columns(name, df, contracts)
        if not keys:
            parts.append(table_violations(df, contracts[name]))
            continue
        seen = observe_table(df, contracts[name], keys)
        keyed[name] = seen.table
        parts.append(seen.violations())
    links = relationship_violations(keyed, contracts)
    return reduce(DataFrame.unionByName, [*parts, links] if links is not None else parts)


def check_columns(df: DataFrame, contract: TableContract, strict: bool = False) -> None:
    """Raise ``SchemaError`` for missing columns, or with ``strict`` for unknown ones; reads no rows."""
    missing = missing_columns(df, contract.columns)
    if missing:
        raise SchemaError(f"[{contract.name}] missing required columns: {missing}")
    extra = extra_columns(df, contract.columns) if strict else []
    if extra:
        raise SchemaError(f"[{contract.name}] unexpected columns: {extra}")


def _raise_first(violations: DataFrame, contract: TableContract, rules: list[Rule]) -> None:
    # One row per rule.
    found = {(r["check"], r["column"]): r["violations"] for r in violations.collect()}
    for check, column, _ in rules:
        if found[check, column]:
            raise SchemaError(f"[{contract.name}] {check} on '{column}': {found[check, column]} violation(s)")


def check_table(df: DataFrame, contract: TableContract, strict: bool = False) -> None:
    """Raise ``SchemaError`` for the first broken rule."""
    check_columns(df, contract, strict)
    _raise_first(table_violations(df, contract), contract, _rules(df, contract))


def check_observed(seen: Observed) -> None:
    """``check_table`` of a table that was counted while it was written."""
    _raise_first(seen.violations(), seen.contract, seen.rules)


def check_relationships(
    tables: dict[str, DataFrame], contracts: dict[str, TableContract] = CONTRACTS
) -> None:
    """Raise ``RelationshipError`` for the first broken key, with its count and 5 smallest keys."""
    for name, column, parent, missing in _links(tables, contracts):
        row = missing.agg(F.count(F.lit(1)).alias("n")).first()
        if row.n:
            sample = [r.key for r in unmapped_sample(missing).collect()]
            raise RelationshipError(
                f"[{name}] '{column}': {row.n} key(s) not found in '{parent}', for example {sample}"
            )
