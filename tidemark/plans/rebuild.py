"""A table built anew from the landing area, beside the one that readers use.

A table's folders are a generation under its root: history, state and audits. Which one counts is
said by rows of text under the root, of which the last holds. A rebuild fills a new generation from
the first batch on and then adds such a row, so it is either the old table or the whole new one.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.ingest import MARKS, ingest_table
from tidemark.sources.history import erased
from tidemark.sources.shared import delete, exists, found

FIRST = "first"


@dataclass(frozen=True)
class Generation:
    """Folders of one build of a table."""

    folder: str

    @property
    def paths(self) -> tuple[str, str, str]:
        """History, state and audits."""
        return tuple(f"{self.folder}/{x}" for x in ("history", "state", "recon"))


def _choices(spark: SparkSession, root: str) -> list[dict]:
    where = f"{root}/_current"
    rows = [json.loads(r["value"]) for r in spark.read.text(where).collect()] if exists(spark, f"{where}/part-*") else []  # a row for each rebuild
    return sorted(rows, key=lambda r: r["n"])


def current_generation(spark: SparkSession, root: str) -> Generation:
    """The folders that readers and runs use."""
    chosen = _choices(spark, root)
    return Generation(f"{root}/{chosen[-1]['folder'] if chosen else FIRST}")


def rebuild_table(spark: SparkSession, base: str, manifest_path: str, table: str, root: str, run_id: str, load_ts: datetime, exclude: str = "") -> DataFrame:
    """Builds a new generation from all landed batches and switches to it; the bookmarks to keep.

    Ids that were erased stay so. What an earlier call of this run id left is taken up: batches and
    rows that it wrote are written again in their places. Bookmarks of the old generation do no
    harm if the new ones are lost: what they lead to read again changes nothing.
    """
    old, new = current_generation(spark, root), Generation(f"{root}/{run_id}")
    if old == new:
        raise ValueError(f"run {run_id} is the current generation of {root}")
    history, _, _ = new.paths
    if (gone := erased(spark, old.paths[0])) is not None:
        gone.distinct().coalesce(1).write.mode("overwrite").parquet(f"{history}_erased")
    books = ingest_table(spark, base, manifest_path, table, spark.createDataFrame([], MARKS), *new.paths, run_id, load_ts, exclude)
    row = json.dumps({"n": len(_choices(spark, root)) + 1, "folder": run_id})
    spark.createDataFrame([(row,)], "value string").coalesce(1).write.mode("append").text(f"{root}/_current")
    return books


def drop_old_generations(spark: SparkSession, root: str) -> None:
    """Deletes all builds but the current one, once no reader uses them."""
    now = current_generation(spark, root).folder.rpartition("/")[2]
    for folder in found(spark, f"{root}/*"):
        name = folder.rpartition("/")[2]
        if name not in (now, "_current"):
            delete(spark, folder)
