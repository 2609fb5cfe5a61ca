"""All tables of a manifest in one call: the launch decision, and a run for each table that it names."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.ingest import MARKS, ingest_table
from tidemark.plans.rebuild import current_generation
from tidemark.sources import landing
from tidemark.sources.bookmarks import launch_decision

OUTCOME = "table_name string, status string, size_class string, notes string"


def ingest_all(spark: SparkSession, base: str, manifest_path: str, bookmarks: DataFrame, root: str, run_id: str, load_ts: datetime, exclude: str = "", without: str = "", medium: int = 100_000_000, large: int = 1_000_000_000, at_once: int = 4) -> tuple[DataFrame, DataFrame]:
    """Runs every changed table, each under ``root/<table>``, ``at_once`` at a time; (outcomes, bookmarks to keep).

    After a reset of any source nothing runs, and the outcome is one RESET row; with nothing to
    do it is one STOP row. Jobs of a table go to the fair scheduler's pool of its size class. A
    table that fails is FAILED with its error and keeps its bookmarks; the others go on.
    ``exclude`` names columns and ``without`` tables.
    """
    manifest = landing.read_manifest(spark, manifest_path)
    chosen = launch_decision(manifest, bookmarks, without, medium, large).collect()  # a row for each changed table
    if not chosen or chosen[0]["status"] != "START":
        return spark.createDataFrame([(None, r["status"], None, None) for r in chosen], OUTCOME), bookmarks
    kept = [tuple(r) for r in bookmarks.selectExpr("table_name", "fingerprint", "kind", "string(value) AS value").collect()]  # a few rows for each table

    def run(row) -> tuple[tuple, list[tuple]]:
        table = row["table_name"]
        own = [b for b in kept if b[0].lower() == table.lower()]
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", row["size_class"])
        try:
            paths = current_generation(spark, f"{root}/{table}").paths
            new = ingest_table(spark, base, manifest_path, table, spark.createDataFrame(own, MARKS), *paths, run_id, load_ts, exclude)
            return (table, "DONE", row["size_class"], None), [(*r[:3], str(r[3])) for r in new.select("table_name", "fingerprint", "kind", "value").collect()]
        except Exception as e:  # noqa: BLE001  a table's failure is its own
            return (table, "FAILED", row["size_class"], f"{type(e).__name__}: {str(e)[:500]}"), own

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        done = list(pool.map(inheritable_thread_target(spark)(run), chosen))
    ran = {row["table_name"].lower() for row in chosen}
    books = [b for b in kept if b[0].lower() not in ran] + [b for _, own in done for b in own]
    return spark.createDataFrame([outcome for outcome, _ in done], OUTCOME), spark.createDataFrame(books, MARKS)
