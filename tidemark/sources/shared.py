"""Folders that all executors share, and what is known of the tables in them."""

from __future__ import annotations

import json
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.schema import widest

MOST_ROWS = 1_000_000  # of a broadcast table of keys or changed rows


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset, one in the warehouse, which
    on a cluster must not be a folder of one machine."""
    found = spark.conf.get("spark.checkpoint.dir", "")
    if found:
        return found
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if warehouse.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return warehouse + "/_shared"


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, or any that a pattern names."""
    return bool(found(spark, path))


def found(spark: SparkSession, pattern: str) -> list[str]:
    """Paths of what a pattern names."""
    fs, p = _file_system(spark, pattern)
    return [s.getPath().toString() for s in fs.globStatus(p) or ()]


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes under a folder."""
    fs, p = _file_system(spark, path)
    return fs.getContentSummary(p).getLength()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Renames a file or folder; what is at ``to`` goes, and folders above it are made."""
    fs, p = _file_system(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    fs.delete(target, True)
    fs.mkdirs(target.getParent())
    if not fs.rename(p, target):
        raise OSError(f"{path} could not be moved to {to}")


def literal(name: str) -> str:
    """A file name as a pattern that names it alone."""
    return "".join(f"\\{c}" if c in "*?[]{}\\^-," else c for c in name)


def decoded(spark: SparkSession, file_path: str) -> str:
    """A path as ``_metadata.file_path`` gives it, as readers take it."""
    uri = spark._jvm.java.net.URI(file_path)
    return spark._jvm.org.apache.hadoop.fs.Path(uri).toString()


def few(rows: DataFrame, n: int) -> DataFrame:
    """``rows``, of which there are ``n``, to be broadcast if they are few; else Spark joins as it sees fit."""
    return F.broadcast(rows) if n <= MOST_ROWS else rows


class Plan:
    """The planned schema of a stored table, and what else was fixed when it was made.

    Files of a table may have narrower types, or lack columns, that others have; Spark would
    take the schema of whichever file it opens first. So the table is read with this one. It is
    a row of text beside the table for each change, which adds to those before it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, f"{path.rstrip('/')}_plan"

    def _rows(self) -> list[dict]:
        if not exists(self.spark, f"{self.path}/part-*"):
            return []
        rows = [json.loads(r["value"]) for r in self.spark.read.text(self.path).collect()]  # one for each change
        return sorted(rows, key=lambda r: r["change"])

    def read(self) -> tuple[StructType | None, dict]:
        rows = self._rows()
        return (widest([StructType.fromJson(r["schema"]) for r in rows]), rows[0]["fixed"]) if rows else (None, {})

    def extend(self, schema: StructType, **fixed) -> StructType:
        """Adds the columns and widens the types that ``schema`` has beyond the plan."""
        rows = self._rows()
        known = [StructType.fromJson(r["schema"]) for r in rows]
        new = widest([*known, schema])
        if not rows or new != widest(known):
            row = json.dumps({"change": len(rows), "schema": json.loads(new.json()), "fixed": rows[0]["fixed"] if rows else fixed})
            self.spark.createDataFrame([(row,)], "value string").coalesce(1).write.mode("append").text(self.path)
        return new
