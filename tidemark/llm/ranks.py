"""Places of rows in the order of their group, without a group ever being in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import Scratch

PART_BITS = 33  # of monotonically_increasing_id, which holds the partition above them


def ranked(rows: DataFrame, scratch: Scratch, name: str, by: list[str], then: list[str], numbered: bool = False) -> DataFrame:
    """``rows`` with ``place`` (from 0, by ``then``, nulls first) in their group of equal ``by``, and
    the group's ``size``; if ``numbered``, also ``number``, the group's place among all groups.

    Rows are dealt by ranges of (by, then) and numbered within their range, so a group with a
    third of all rows is many ranges. What is summed up are spans: a row for each group and range.
    Rows that are equal in ``by`` and ``then`` are placed in any order. Null is a group of its own.
    """
    order = [F.col(c).asc_nulls_first() for c in (*by, *then)]
    laid = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    laid = scratch.write(laid.withColumn("__seq", F.monotonically_increasing_id()), f"{name}_laid")
    part = F.shiftright("__seq", PART_BITS)
    spans = laid.groupBy(*by, part.alias("__part")).agg(F.min("__seq").alias("__first"), F.count(F.lit(1)).alias("__n"))
    spans = scratch.write(spans, f"{name}_spans")
    own = Window.partitionBy(*by)  # at most a span for each range
    before = (F.sum("__n").over(own.orderBy("__first")) - F.col("__n")).alias("__before")
    held = spans.select(*[F.col(c).alias(f"__by{k}") for k, c in enumerate(by)], "__part", "__first", before, F.sum("__n").over(own).alias("size"))
    on = [F.col(c).eqNullSafe(F.col(f"__by{k}")) for k, c in enumerate(by)]
    if numbered:
        first = spans.groupBy(*by).agg(F.min("__first").alias("__start"))
        groups = ranked(first, scratch, f"{name}_groups", [], ["__start"]).select(*[F.col(c).alias(f"__g{k}") for k, c in enumerate(by)], F.col("place").alias("number"))
        same = [F.col(f"__by{k}").eqNullSafe(F.col(f"__g{k}")) for k in range(len(by))]
        held = held.join(groups, same).drop(*[f"__g{k}" for k in range(len(by))])
    held = scratch.write(held, f"{name}_held").withColumnRenamed("__part", "__own")
    out = laid.join(held, [*on, F.shiftright("__seq", PART_BITS) == F.col("__own")])
    place = F.col("__before") + F.col("__seq") - F.col("__first")
    return out.select(*rows.columns, place.alias("place"), "size", *(["number"] if numbered else []))
