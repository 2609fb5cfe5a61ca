"""Stored history: a partition for each batch, which is written as a whole.

A batch that is written again replaces what is there of it, so one that was cut short in the
middle of an append is whole after the retry. Ids that were erased are kept as digests beside the
table, and rows of theirs are left out of whatever is written later.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources import landing
from tidemark.sources.landing import literal_path
from tidemark.sources.shared import Plan, decoded, delete, exists, few, found, move
from tidemark.sources.state import BUCKET, OF, StateTable, with_filters

PARTS = ("fingerprint", "batch_ts")
IN_FILTER = 10  # so many ids are pushed down to the files' filters


def write_history(df: DataFrame, path: str) -> None:
    """Writes the batches of ``df``, each in place of what is stored of it."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS).parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows with the planned schema, whichever types their files have; None if there are none."""
    schema, _ = Plan(spark, path).read()
    if schema is None or not exists(spark, f"{path}/fingerprint=*"):
        return None
    return spark.read.schema(landing.with_bookkeeping(schema)).parquet(path)


def beyond(marks: dict[str, int]) -> Column:
    """Batches past each fingerprint's mark, as a condition on partitions; all of those without one."""
    past = [(F.col("fingerprint") == fp) & (F.col("batch_ts") > ts) for fp, ts in sorted(marks.items())]
    return reduce(lambda a, b: a | b, past, ~F.col("fingerprint").isin(sorted(marks)) if marks else F.lit(True))


def of_batches(batches: dict[str, list[int]]) -> Column:
    """Rows of the given batches of each fingerprint."""
    each = [(F.col("fingerprint") == fp) & F.col("batch_ts").isin(sorted(ts)) for fp, ts in sorted(batches.items())]
    return reduce(lambda a, b: a | b, each, F.lit(False))


# Erasure


def subject(keys: tuple[str, ...]) -> Column:
    """A digest of a row's key; the list of erased ids holds no id itself."""
    return F.sha2(F.to_json(F.array(*[F.col(k).cast("string") for k in keys])), 256)


def erased(spark: SparkSession, path: str) -> DataFrame | None:
    where = f"{path.rstrip('/')}_erased"
    return spark.read.schema("subject string").parquet(where) if exists(spark, f"{where}/part-*") else None


def without_erased(rows: DataFrame, path: str, keys: tuple[str, ...]) -> DataFrame:
    """``rows`` without those of ids that were erased from the history at ``path``."""
    gone = erased(rows.sparkSession, path)
    if gone is None:
        return rows
    return rows.withColumn("subject__", subject(keys)).join(few(gone.withColumnRenamed("subject", "subject__").distinct(), gone.count()), "subject__", "left_anti").select(rows.columns)


def erase(spark: SparkSession, ids: DataFrame, history_path: str, state_path: str, keys: tuple[str, ...] = ("id",)) -> dict[str, int]:
    """Removes all rows of the ids from history and state, for good; how many files were rewritten in each.

    The ids are noted first, so that no run brings them back from the landing area; then the files that
    hold them are rewritten, and no others. A call that was cut short is completed by the next.
    """
    ids = ids.select(*keys).distinct()
    ids.select(subject(keys).alias("subject")).coalesce(1).write.mode("append").parquet(f"{history_path.rstrip('/')}_erased")
    out, state = {}, StateTable(spark, state_path, keys)
    for path in (history_path, state_path):
        finish_rewrite(spark, path.rstrip("/"))
    state._finish()
    rows = read_history(spark, history_path)
    out["history"] = 0 if rows is None else rewrite_without(rows, history_path, ids, keys, PARTS)
    rows = state.read_with_buckets()
    out["state"] = 0 if rows is None else rewrite_without(rows, state_path, ids, keys, (OF, BUCKET))
    return out


def rewrite_without(rows: DataFrame, path: str, ids: DataFrame, keys: tuple[str, ...], parts: tuple[str, ...]) -> int:
    """Rewrites the files of the table at ``path``, read as ``rows``, that hold rows of ``ids``; how many there were."""
    spark, path = rows.sparkSession, path.rstrip("/")
    n = ids.count()
    named = ids.select(*[F.col(k).cast(rows.schema[k].dataType).alias(k) for k in keys])
    held = rows.select(*keys, F.col("_metadata.file_path").alias("__file"))
    if n <= IN_FILTER and len(keys) == 1:
        held = held.where(F.col(keys[0]).isin([r[0] for r in named.collect()]))
    files = [r[0] for r in held.join(few(named, n), list(keys), "left_semi").select("__file").distinct().collect()]  # names only
    if not files:
        return 0
    numbered = spark.createDataFrame([(f, i, decoded(spark, f)) for i, f in enumerate(sorted(files))], "__file string, __number int, path string")
    numbered.select("__number", "path").coalesce(1).write.mode("overwrite").parquet(f"{path}_rewrite_files")
    old = spark.read.schema(rows.schema).option("basePath", path).parquet(*[r["path"] for r in numbered.collect()])
    old = old.select("*", F.col("_metadata.file_path").alias("__file")).join(F.broadcast(numbered.drop("path")), "__file")
    kept = old.join(few(named, n), list(keys), "left_anti").drop("__file", *parts)
    writer = kept.write.mode("overwrite").partitionBy("__number")
    (with_filters(writer, keys) if BUCKET in parts else writer).parquet(f"{path}_rewrite")
    finish_rewrite(spark, path)
    return len(files)


def finish_rewrite(spark: SparkSession, path: str) -> None:
    """Puts files that were written beside the table into it, and deletes those that they replace;
    not where these are gone, as what was written since then holds."""
    if exists(spark, f"{path}_rewrite/_SUCCESS"):
        made: dict[str, list[str]] = {}
        for file in found(spark, f"{path}_rewrite/__number=*/*.parquet"):
            made.setdefault(file.rsplit("/", 2)[1].partition("=")[2], []).append(file)
        for r in spark.read.schema("__number int, path string").parquet(f"{path}_rewrite_files").collect():  # a row for each file
            folder, number = r["path"].rpartition("/")[0], str(r["__number"])
            if not exists(spark, literal_path(r["path"])):
                continue
            for file in made.get(number, ()):  # a task gives its files of all numbers one name, and numbers may share a folder
                move(spark, file, f"{folder}/n{number}-{file.rpartition('/')[2]}")
            delete(spark, r["path"])
    delete(spark, f"{path}_rewrite")
    delete(spark, f"{path}_rewrite_files")


def merge_schema(spark: SparkSession, folders: list[str]) -> list[StructType]:
    """Schemas of folders, from footers: one that holds all columns, or one for each where types differ."""
    try:
        return [spark.read.option("mergeSchema", True).parquet(*folders).schema]
    except Exception as e:  # noqa: BLE001  types that differ, told apart by name
        if "CANNOT_MERGE" not in str(e) and "merge" not in str(e).lower():
            raise
        return [landing.schema_of(spark, f) for f in folders]
