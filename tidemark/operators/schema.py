"""Additive schema evolution as a projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType, IntegerType, LongType, StructField, StructType

from tidemark.functions.keys import BOOKKEEPING


@dataclass(frozen=True)
class Change:
    """``ADD`` of a column, or ``WIDEN`` of its type."""

    kind: str
    column: str
    type: DataType


def can_widen(old: DataType, new: DataType) -> bool:
    match old, new:
        case (IntegerType(), LongType()) | (FloatType(), DoubleType()):
            return True
        case DecimalType(), DecimalType():
            return old.scale == new.scale and new.precision > old.precision
    return False


def can_cast(source: DataType, target: DataType) -> bool:
    return source == target or can_widen(source, target)


def plan_evolution(target: StructType, source: StructType, exclude: tuple[str, ...] = ()) -> tuple[list[Change], StructType]:
    """Changes that let ``target`` take rows of ``source``, and the schema after them."""
    given = {f.name: f for f in source.fields if f.name not in exclude}
    changes, after = [], []
    for field in target.fields:
        own = given.pop(field.name, None)
        kind = field.dataType
        if own and own.dataType != kind:
            if can_widen(kind, own.dataType):
                kind = own.dataType
                changes.append(Change("WIDEN", field.name, kind))
            elif not can_cast(own.dataType, kind):
                raise TypeError(f"column {field.name}: {own.dataType.simpleString()} does not fit {kind.simpleString()}")
        after.append(StructField(field.name, kind, field.nullable))
    for field in source.fields:
        if field.name in given:
            changes.append(Change("ADD", field.name, field.dataType))
            after.append(StructField(field.name, field.dataType, True))
    return changes, StructType(after)


def mirror_evolution(current: StructType, source: StructType) -> tuple[list[Change], StructType]:
    """The same for the current table, which has no bookkeeping columns."""
    return plan_evolution(current, source, BOOKKEEPING)


def align(df: DataFrame, target: StructType) -> DataFrame:
    """``df`` with the columns, types and order of ``target``; missing columns are null."""
    own = {f.name: f.dataType for f in df.schema.fields}

    def column(f: StructField):
        if f.name not in own:
            return F.lit(None).cast(f.dataType).alias(f.name)
        return F.col(f.name) if own[f.name] == f.dataType else F.col(f.name).cast(f.dataType).alias(f.name)

    return df.select(*map(column, target.fields))


def widest(schemas: list[StructType]) -> StructType:
    """One schema that holds rows of all, in order of time."""
    out = schemas[0]
    for s in schemas[1:]:
        out = plan_evolution(out, s)[1]
    return out


def apply_changes(spark, table: str, changes: list[Change]) -> None:
    """Runs planned changes on a catalog table; widening needs a format that can change types.

    Where none is at hand, read with the schema that ``plan_evolution`` returns instead.
    """
    quoted = ".".join(f"`{p}`" for p in table.split("."))
    for c in changes:
        name = "`" + c.column.replace("`", "``") + "`"
        action = "ADD COLUMNS ({} {})" if c.kind == "ADD" else "ALTER COLUMN {} TYPE {}"
        spark.sql(f"ALTER TABLE {quoted} {action.format(name, c.type.simpleString())}")
