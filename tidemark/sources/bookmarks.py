"""Bookmarks: how far each table has been read and merged, and what to launch.

Long form: table_name, fingerprint (null for the table's high-water mark), kind (cursor,
hwm, merge_watermark), value (text or number; compared as numbers).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import epoch_ms, size_class
from tidemark.functions.scope import exclude_tables


def bookmark_max_merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """Bookmarks only move forward."""
    both = old.select("table_name", "fingerprint", "kind", "value").unionByName(new.select("table_name", "fingerprint", "kind", "value"))
    return both.groupBy("table_name", "fingerprint", "kind").agg(F.max(epoch_ms(F.col("value").cast("string"))).alias("value"))


def effective_cursor(bookmarks: DataFrame, fingerprints: DataFrame) -> DataFrame:
    """Of each table and fingerprint: the cursor, else the table's mark, else null; and the
    merge watermark, which falls back on nothing."""
    of = lambda kind, name: bookmarks.where(F.col("kind") == kind).select("table_name", "fingerprint", F.col("value").alias(name))
    out = fingerprints.select("table_name", "fingerprint")
    out = out.join(of("cursor", "own"), ["table_name", "fingerprint"], "left").join(of("merge_watermark", "merge_watermark"), ["table_name", "fingerprint"], "left")
    out = out.join(of("hwm", "hwm").drop("fingerprint"), "table_name", "left")
    return out.select("table_name", "fingerprint", F.coalesce("own", "hwm").alias("cursor"), "merge_watermark")


def detect_reset(manifest: DataFrame, bookmarks: DataFrame) -> DataFrame:
    """Tables whose source was reset: the mark went back, else a bookmarked fingerprint is gone."""
    marks = bookmarks.where("kind = 'hwm'").groupBy(F.lower("table_name").alias("t")).agg(F.max(epoch_ms(F.col("value"))).alias("old"))
    cursors = bookmarks.where("kind = 'cursor'").groupBy(F.lower("table_name").alias("t2")).agg(F.collect_set("fingerprint").alias("fps"))
    m = manifest.select("table_name", F.lower("table_name").alias("t"), epoch_ms(F.col("hwm")).alias("now"), F.map_keys("schema_history").alias("known"))
    both = m.join(marks, "t", "left").join(cursors, F.col("t") == F.col("t2"), "left")
    pruned = F.sort_array(F.array_except(F.coalesce("fps", F.array().cast("array<string>")), F.coalesce("known", F.array().cast("array<string>"))))
    back = F.coalesce(F.col("now") < F.col("old"), F.lit(False))
    kind = F.when(back, "hwm_regression").when(F.size(pruned) > 0, "fingerprint_pruned")
    detail = F.when(back, F.concat_ws("<", F.col("now").cast("string"), F.col("old").cast("string"))).otherwise(F.array_join(pruned, ","))
    return both.select("table_name", kind.alias("kind"), detail.alias("detail")).where("kind is not null")


def changed_tables(manifest: DataFrame, bookmarks: DataFrame, exclude: str = "") -> DataFrame:
    """Tables whose mark moved past ours, or that are new."""
    marks = bookmarks.where("kind = 'hwm'").groupBy(F.lower("table_name").alias("__t")).agg(F.max(epoch_ms(F.col("value"))).alias("old"))
    m = exclude_tables(manifest, exclude).withColumn("now", epoch_ms(F.col("hwm")))
    both = m.join(marks, F.lower("table_name") == F.col("__t"), "left")
    return both.where(F.col("old").isNull() | (F.col("now") > F.col("old"))).select("table_name", F.col("now").alias("ts"), "record_count")


def launch_decision(manifest: DataFrame, bookmarks: DataFrame, exclude: str = "", medium: int = 100_000_000, large: int = 1_000_000_000) -> DataFrame:
    """RESET (no tables) if any source was reset, STOP if nothing changed, else START with a row per table."""
    resets = detect_reset(exclude_tables(manifest, exclude), bookmarks).select(F.lit(1).alias("reset"))
    tables = changed_tables(manifest, bookmarks, exclude).select("table_name", "ts", size_class(F.col("record_count"), medium, large).alias("size_class"))
    facts = resets.union(tables.select(F.lit(0))).agg(F.sum("reset").alias("resets"))
    status = F.when(F.col("resets") > 0, "RESET").when(F.col("resets").isNull(), "STOP").otherwise("START")
    head = facts.select(status.alias("status"))  # one row
    start = tables.where(head.scalar() == "START").select(F.lit("START").alias("status"), "*")
    none = [F.lit(None).cast(t).alias(c) for c, t in tables.dtypes]
    return start.union(head.where("status <> 'START'").select("status", *none))
