"""Which columns and tables take part."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import PROTECTED

ENTRY = re.compile(r"^(?:([^:]+):)?([^:]+)$")


class ColumnExclusion:
    """Columns to leave out, from a list like ``ssn, customer:phone``."""

    def __init__(self, spec: str | None, protected: tuple[str, ...] = PROTECTED):
        self.everywhere: set[str] = set()
        self.by_table: dict[str, set[str]] = {}
        for raw in (spec or "").split(","):
            item = raw.strip().lower()
            if not item:
                continue
            m = ENTRY.match(item)
            table, column = (m.group(1) or "").strip() if m else "", m.group(2).strip() if m else ""
            if not column or (m.group(1) is not None and not table):
                raise ValueError(f"malformed exclusion: {raw!r}")
            if column in protected:
                raise ValueError(f"column {column!r} is protected")
            (self.by_table.setdefault(table, set()) if table else self.everywhere).add(column)

    def columns_for(self, table: str) -> set[str]:
        return self.everywhere | self.by_table.get(table.lower(), set())

    def apply(self, df: DataFrame, table: str) -> DataFrame:
        return df.drop(*self.columns_for(table))


def names(spec: Column) -> Column:
    """The names of a comma-separated list, trimmed and in lower case."""
    return F.filter(F.transform(F.split(spec, ","), lambda x: F.lower(F.trim(x))), lambda x: x != "")


def exclude_tables(tables: DataFrame, spec: str, column: str = "table_name") -> DataFrame:
    """Rows whose table is not in the comma-separated list."""
    return tables.where(~F.array_contains(names(F.lit(spec)), F.lower(F.trim(F.col(column)))))


def restricted_view(df: DataFrame, allowed: list[str], name: str | None = None) -> DataFrame:
    """Only ``allowed`` columns; registered as a view if named. The data stays."""
    out = df.select(*[c for c in df.columns if c in allowed])
    if name:
        out.createOrReplaceTempView(name)
    return out
