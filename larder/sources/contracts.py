"""What each input table must look like."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


class DataContractError(ValueError):
    """The data breaks a structural or relational rule."""


class SchemaError(DataContractError):
    """Columns, nullability or value ranges are wrong."""


class RelationshipError(DataContractError):
    """A key points to a row that does not exist."""


@dataclass(frozen=True)
class TableContract:
    """Rules for one table; ``foreign_keys`` maps a column to (parent table, parent column)."""

    name: str
    file: str
    primary_key: tuple[str, ...]
    columns: dict[str, str]
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)
    binary: tuple[str, ...] = ()
    positive: tuple[str, ...] = ()
    non_negative: tuple[str, ...] = ()

    @property
    def struct(self) -> T.StructType:
        return T._parse_datatype_string(", ".join(f"{c} {t}" for c, t in self.columns.items()))


_KEYS = {"id": "bigint", "week": "int", "center_id": "bigint", "meal_id": "int"}
_OFFER = {
    "checkout_price": "double",
    "base_price": "double",
    "emailer_for_promotion": "int",
    "homepage_featured": "int",
}
_PARENTS = {"center_id": ("centers", "center_id"), "meal_id": ("meals", "meal_id")}
_FLAGS = ("emailer_for_promotion", "homepage_featured")
_PRICES = ("checkout_price", "base_price")

# Table names, file names, columns and rules of the input data set.
CONTRACTS: dict[str, TableContract] = {
    "train": TableContract(
        name="train",
        file="train.csv",
        primary_key=("id",),
        columns={**_KEYS, **_OFFER, "num_orders": "double"},
        foreign_keys=_PARENTS,
        binary=_FLAGS,
        positive=_PRICES,
        non_negative=("num_orders",),
    ),
    "test": TableContract(
        name="test",
        file="test.csv",
        primary_key=("id",),
        columns={**_KEYS, **_OFFER},
        foreign_keys=_PARENTS,
        binary=_FLAGS,
        positive=_PRICES,
    ),
    "centers": TableContract(
        name="centers",
        file="fulfilment_center_info.csv",
        primary_key=("center_id",),
        columns={
            "center_id": "bigint",
            "city_code": "int",
            "region_code": "int",
            "center_type": "string",
            "op_area": "double",
        },
        positive=("op_area",),
    ),
    "meals": TableContract(
        name="meals",
        file="meal_info.csv",
        primary_key=("meal_id",),
        columns={"meal_id": "int", "category": "string", "cuisine": "string"},
    ),
}

FEEDBACK_SCHEMA = (
    "batch_id bigint, week int, center_id bigint, meal_id int, forecast_orders double, "
    "actual_orders double, error double, percentage_error double, recorded_at timestamp"
)
