"""One incremental run of a table: select, read, align, append, resolve, audit.

What a run writes may be written again: batches replace themselves in history, upserts and
audit rows of the same changes change nothing. So a run that ended anywhere is repeated from its bookmarks.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import BOOKKEEPING
from tidemark.functions.scope import ColumnExclusion
from tidemark.operators import recon
from tidemark.operators.schema import widest
from tidemark.sources import bookmarks as marks
from tidemark.sources import landing
from tidemark.sources.history import beyond, merge_schema, of_batches, read_history, without_erased, write_history
from tidemark.sources.shared import Plan, exists
from tidemark.sources.state import StateTable

BUCKETS = 64
BATCH = "batch_ts"
MARKS = "table_name string, fingerprint string, kind string, value string"
LEDGER = "table_name string, fingerprint string, batch_ts long, read long, written long, dropped long, has boolean, at timestamp"
log = logging.getLogger(__name__)


def write_current(df: DataFrame, path: str, keys: tuple[str, ...] = ("id",), buckets: int = BUCKETS) -> None:
    """A whole current table, as a replay makes it, hash-distributed by key."""
    df.repartition(buckets, *keys).write.mode("errorifexists").parquet(path)


def append_recon(parts: list[DataFrame], path: str) -> None:
    """All audit rows of a run in one file, so all or none; nothing if there are none, or if they are there."""
    if not parts:
        return
    rows = united(parts)
    if exists(rows.sparkSession, f"{path}/table_name=*"):
        there = rows.sparkSession.read.schema(recon.RECON).parquet(path).select("run_id", "table_name", "tier").distinct()
        rows = rows.join(there, ["run_id", "table_name", "tier"], "left_anti").select(rows.columns)
    rows.coalesce(1).write.mode("append").partitionBy("table_name").parquet(path)


def export(df: DataFrame, path: str, fmt: str = "csv") -> None:
    writer = df.write.mode("errorifexists")
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)


def guarded(spark: SparkSession, table: str, tier: str, names: tuple[str, ...], rows: Callable[[], DataFrame]) -> DataFrame:
    """A check's few rows, worked out here and now; if that fails, an ERROR row for each name."""
    try:
        made = rows()
        return spark.createDataFrame(made.collect(), made.schema)  # a row for each check
    except Exception as e:  # noqa: BLE001  whatever ends a check must not end the run
        out = [recon.error_row(spark, table, tier, n, f"{type(e).__name__}: {str(e)[:500]}") for n in names]
        return united(out)


def united(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def recon_only(spark: SparkSession, table: str, history_path: str, state_path: str, run_id: str, at: datetime, bookmarks: DataFrame | None = None, recon_path: str = "") -> DataFrame:
    """Tier D of a stored pair of tables; no rows if either is absent. Written to ``recon_path`` if given.

    With the bookmarks of the last run, history is pinned to the batches that the state has
    merged, so that a running ingest does not show as violations. All checks come from one
    join; if that fails, each runs alone, and those that fail leave an ERROR row.
    """
    current, history = StateTable(spark, state_path).current(), read_history(spark, history_path)
    if current is None or history is None:
        return spark.createDataFrame([], recon.RECON)
    if bookmarks is not None:
        history = landing.merged_batches(history, bookmarks.where(F.lower("table_name") == table.lower()))
    try:
        joint = recon.tier_d(history, current, table)
        parts = [spark.createDataFrame(joint.collect(), joint.schema)]  # four rows
    except Exception:  # noqa: BLE001
        parts = [guarded(spark, table, "D", (name,), lambda c=check: c(history, current, table)) for name, check in recon.single_checks().items()]
    rows = united([recon.recon_rows(p, run_id, at) for p in parts])
    if recon_path:
        append_recon([rows], recon_path)
    return rows


def ingest_table(spark: SparkSession, base: str, manifest_path: str, table: str, bookmarks: DataFrame, history_path: str, state_path: str, recon_path: str, run_id: str, load_ts: datetime, exclude: str = "") -> DataFrame:
    """Runs a table's unread batches through history into the state table at ``state_path``.

    Returns the bookmarks to keep. Only folder names, schemas and fingerprints reach the
    driver. All new batches, of all fingerprints, are read and appended in one job, each in place of what
    history holds of it. What is merged are rows of history beyond the merge watermark,
    whichever run appended them, also if nothing new has landed; only the buckets of their keys
    are rewritten.
    """
    of_table = F.lower("table_name") == table.lower()
    own = lambda df: df.where(of_table).withColumn("table_name", F.lit(table))  # noqa: E731  names may differ in case
    manifest, books = own(landing.read_manifest(spark, manifest_path)), own(bookmarks)
    order = landing.fingerprint_order(manifest)
    inventory = own(landing.landing_inventory(spark, base, table))
    chosen = landing.select_batches(inventory, marks.effective_cursor(books, order), manifest)
    paths = chosen.join(inventory.withColumn(BATCH, F.col("batch").try_cast("long")), ["table_name", "fingerprint", BATCH]).join(order, ["table_name", "fingerprint"])
    picked = paths.select("place", "fingerprint", BATCH, F.regexp_extract("path", "^(.*)/[^/]+$", 1).alias("folder")).distinct().orderBy("place", BATCH).collect()
    # What was chosen is fixed here: files that land meanwhile belong to the next run.
    new = [(table, None, "hwm", r["hwm"]) for r in manifest.select("hwm").collect()]
    if picked:
        landed = append_batches(spark, picked, table, history_path, load_ts, ColumnExclusion(exclude))
        audit(spark, picked, table, landed, history_path, recon_path, run_id, load_ts)
        new += [(table, fp, "cursor", str(max(ts))) for fp, ts in batches_of(picked).items()]
    new += merge_owed(spark, table, books, history_path, state_path)
    return marks.bookmark_max_merge(books.unionByName(bookmarks.where(~of_table)), spark.createDataFrame(new, MARKS))


def batches_of(picked: list) -> dict[str, list[int]]:
    out: dict[str, list[int]] = {}
    for row in picked:
        out.setdefault(row["fingerprint"], []).append(row[BATCH])
    return out


def merge_owed(spark: SparkSession, table: str, books: DataFrame, history_path: str, state_path: str) -> list[tuple]:
    """Merges history beyond the merge watermarks; the marks to set, a row for each fingerprint."""
    history = read_history(spark, history_path)
    if history is None:
        return []
    known = books.where("kind = 'merge_watermark'").select("fingerprint", F.col("value").cast("long").alias("value")).where("value is not null").collect()  # a row for each fingerprint
    owed = history.where(beyond({r[0]: r[1] for r in known}))
    upto = owed.groupBy("fingerprint").agg(F.max(BATCH).alias("upto")).collect()
    if upto:
        StateTable(spark, state_path).upsert(owed.drop(*BOOKKEEPING, BATCH))
    return [(table, r["fingerprint"], "merge_watermark", str(r["upto"])) for r in upto]


def append_batches(spark: SparkSession, picked: list, table: str, history_path: str, load_ts: datetime, exclusion: ColumnExclusion) -> dict[str, int]:
    """Writes the picked folders to history in one job; how many rows each fingerprint has in them."""
    by_fp: dict[str, list[str]] = {}
    for row in picked:
        by_fp.setdefault(row["fingerprint"], []).append(row["folder"])
    read = [s for folders in _groups(spark, list(by_fp.values())) for s in folders]
    target = Plan(spark, history_path).extend(widest([exclusion.apply(spark.createDataFrame([], s), table).schema for s in read]))
    drop = tuple(exclusion.columns_for(table))
    rows = united([landing.scan_batches(spark, folders, fp, load_ts, target, drop, BATCH) for fp, folders in by_fp.items()])
    seen = Observation()
    counts = [F.count_if(F.col("fingerprint") == fp).alias(f"n{k}") for k, fp in enumerate(by_fp)]
    write_history(without_erased(rows, history_path, ("id",)).observe(seen, *counts), history_path)
    return {fp: seen.get[f"n{k}"] for k, fp in enumerate(by_fp)}


def _groups(spark: SparkSession, groups: list[list[str]]) -> list[list]:
    """Schemas of all folders, in one look at their footers unless types differ; then by fingerprint, in order of time."""
    whole = merge_schema(spark, [f for folders in groups for f in folders])
    if len(whole) == 1 or len(groups) == 1:
        return [whole]
    return [merge_schema(spark, folders) for folders in groups]


def audit(spark: SparkSession, picked: list, table: str, landed: dict[str, int], history_path: str, recon_path: str, run_id: str, at: datetime) -> None:
    """Tiers A and B of a run. A check that fails leaves an ERROR row; if rows can't be written, the run goes on.

    What the batches' metrics report is noted in a ledger beside history, so the cumulative check
    has the reports of all batches without opening their files again.
    """
    chosen = spark.createDataFrame([(table, r["fingerprint"], r[BATCH]) for r in picked], "table_name string, fingerprint string, batch_ts long")
    counts = spark.createDataFrame([(table, fp, n) for fp, n in landed.items()], "table_name string, fingerprint string, landed long")
    ledger = f"{history_path.rstrip('/')}_ledger"
    try:
        reported = landing.read_chosen_metrics(spark, table, [(r["fingerprint"], r[BATCH], r["folder"]) for r in picked])
        reported = spark.createDataFrame(reported.collect(), reported.schema)  # a row for each new batch

        def cumulative() -> DataFrame:
            noted = chosen.join(reported.withColumn("has", F.lit(True)), ["table_name", "fingerprint", BATCH], "left").withColumn("at", F.lit(at))
            noted.select(*[c.split()[0] for c in LEDGER.split(", ")]).coalesce(1).write.mode("append").parquet(ledger)
            every = spark.read.schema(LEDGER).parquet(ledger)
            last = every.groupBy("table_name", "fingerprint", BATCH).agg(F.max_by(F.struct("read", "written", "dropped", "has"), "at").alias("r")).select("table_name", "fingerprint", BATCH, "r.*")
            total = landing.batch_metrics_rollup(last, last.where("has").drop("has"))
            n = read_history(spark, history_path).groupBy().agg(F.count(F.lit(1)).alias("actual")).withColumn("table_name", F.lit(table))
            return recon.tier_b(total, n)

        rollup = lambda: recon.tier_a(counts, landing.batch_metrics_rollup(chosen, reported))
        parts = [guarded(spark, table, "A", ("landed_vs_reported",), rollup), guarded(spark, table, "B", ("cumulative",), cumulative)]
        append_recon([recon.recon_rows(p, run_id, at) for p in parts], recon_path)
    except Exception:  # noqa: BLE001
        log.exception("audit of %s in run %s was not written", table, run_id)
