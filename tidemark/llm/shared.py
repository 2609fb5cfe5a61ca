"""Reading inputs, and tables that cut lineage in the cluster's shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.shared import delete, new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


MOST_IDS = 2_000_000  # of a broadcast table of ids, some 100 MB in memory
MADE: ContextVar[list[str] | None] = ContextVar("folders made inside ``sweeping``", default=None)


class Scratch:
    """Tables of one operator call in the shared folder.

    A written table outlives the executors that made it, so a lost executor costs only
    the tasks that it ran. ``drop`` frees a table that nothing reads any more. Results are
    read from these tables when they are asked for; ``sweeping`` frees those of the calls inside it.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = new_folder(spark, label)
        made = MADE.get()
        if made is not None:
            made.append(self.root)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        delete(self.spark, f"{self.root}/{name}")


@contextmanager
def sweeping(spark: SparkSession) -> Iterator[list[str]]:
    """Deletes at its end the tables of the calls made inside, also after an error. Results that are
    not yet written elsewhere are lost with them. Each thread, and each ``with`` inside another, has
    its own list, so nothing that another query has made is touched."""
    made: list[str] = []
    token = MADE.set(made)
    try:
        yield made
    finally:
        MADE.reset(token)
        for root in made:
            delete(spark, root)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Fewer rows in an Arrow batch, so that a batch of long texts fits a Python worker. Holds for
    the session, as plans are run after they are made; a setting that is lower already stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


def few_ids(ids: DataFrame) -> DataFrame:
    """A stored table of ids, to be broadcast if it has at most ``MOST_IDS`` rows; else Spark joins as it sees fit."""
    return F.broadcast(ids) if ids.count() <= MOST_IDS else ids


def parted(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ``docs`` whose doc_id is theirs alone; and the rest, with ``__key``, a hash of id
    and text, or None if there is no rest. Only ids are read to tell, unless there is one."""
    again = scratch.write(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("doc_id is null or n > 1").select("doc_id"), "again")
    if again.isEmpty():
        return docs, None
    known = few_ids(again.where("doc_id is not null"))
    rest = docs.where("doc_id is null").union(docs.join(known, "doc_id", "left_semi").select(docs.columns))
    return docs.where("doc_id is not null").join(known, "doc_id", "left_anti").select(docs.columns), rest.withColumn("__key", F.xxhash64(F.lit("row"), "doc_id", "text"))
