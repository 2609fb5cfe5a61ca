"""Reconciliation: landed against reported counts, and history against current rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.keys import ERROR, MISMATCH, OK, UPSERTS, count_status, seq_key
from tidemark.operators.merge import latest_op

RECON = (
    "run_id string, committed_at timestamp, table_name string, fingerprint string, tier string, check_name string, "
    "status string, expected bigint, actual bigint, delta bigint, details string, notes string"
)
COLUMNS = [c.split()[0] for c in RECON.split(", ")]
SAMPLES = 10


def recon_rows(df: DataFrame, run_id: str | Column, committed_at: datetime | Column) -> DataFrame:
    """``df`` (table_name, fingerprint, tier, check_name, status, expected, actual, details) as audit rows."""
    as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
    out = df.withColumn("run_id", as_column(run_id)).withColumn("committed_at", as_column(committed_at).cast("timestamp"))
    out = out.withColumn("delta", F.col("actual") - F.col("expected"))
    if "notes" not in df.columns:
        out = out.withColumn("notes", F.lit(None).cast("string"))
    return out.select(*[F.col(f.split()[0]).cast(f.split()[1]) for f in RECON.split(", ")])


def tier_a(landed: DataFrame, rollup: DataFrame) -> DataFrame:
    """Each table and fingerprint: rows landed in this run against rows that its batches report."""
    both = landed.join(rollup, ["table_name", "fingerprint"], "left")
    lost = F.coalesce(F.size("missing") + F.size("corrupt"), F.lit(0))
    written, ok = F.coalesce("written", F.lit(0)), F.coalesce("ok", F.lit(0))
    details = F.to_json(F.struct(F.coalesce("read", F.lit(0)).alias("numRecordsRead"), F.coalesce("dropped", F.lit(0)).alias("numRecordsDropped"), ok.alias("ok"), lost.alias("lost")))
    return both.select(
        "table_name",
        "fingerprint",
        F.lit("A").alias("tier"),
        F.lit("landed_vs_reported").alias("check_name"),
        count_status(F.col("landed"), written, ok, lost).alias("status"),
        written.alias("expected"),
        F.col("landed").alias("actual"),
        details.alias("details"),
    )


def tier_b(rollup: DataFrame, history_counts: DataFrame) -> DataFrame:
    """Each table: rows that all processed batches report against rows in its whole history.

    With a rollup of this run's batches alone it is the check on the run only.
    """
    total = rollup.groupBy("table_name").agg(F.sum("written").alias("expected"), F.sum(F.size("missing") + F.size("corrupt")).alias("lost"), F.sum("ok").alias("ok"))
    both = history_counts.join(total, "table_name", "left")
    expected = F.coalesce("expected", F.lit(0)).cast("long")
    status = count_status(F.col("actual"), expected, F.coalesce("ok", F.lit(0)), F.coalesce("lost", F.lit(0)))
    return both.select(
        "table_name",
        F.lit(None).cast("string").alias("fingerprint"),
        F.lit("B").alias("tier"),
        F.lit("cumulative").alias("check_name"),
        status.alias("status"),
        expected.alias("expected"),
        "actual",
        F.lit(None).cast("string").alias("details"),
    )


def inv_tombstone(latest: DataFrame, current: DataFrame, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """Current keys whose latest operation is a tombstone. ``latest`` is ``latest_op`` of history."""
    return current.select(*keys).join(latest.where("op = 1").select(*keys), list(keys), "left_semi")


def inv_latest_seqval(latest: DataFrame, current: DataFrame, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """Current keys whose order key is not that of the newest upsert in history."""
    return current.select(*keys, seq_key().alias("k")).join(latest, list(keys)).where("k <> upsert_key").select(*keys)


def inv_no_orphans(latest: DataFrame, current: DataFrame, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """Current keys that history lacks."""
    return current.select(*keys).join(latest, list(keys), "left_anti")


def inv_count_formula(latest: DataFrame, current: DataFrame, history: DataFrame | None = None, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """One row: how far the number of current rows is from that of keys whose latest operation upserts.

    With ``history``, the latter counts history rows of such keys instead.
    """
    alive = latest.where(F.col("op").isin(*UPSERTS)).select(*keys)
    if history is not None:
        alive = history.select(*keys).join(alive, list(keys), "left_semi")
    signs = current.select(F.lit(1).alias("sign")).union(alive.select(F.lit(-1)))
    return signs.agg(F.abs(F.coalesce(F.sum("sign"), F.lit(0))).cast("long").alias("violations"))


CHECKS = ("tombstone", "latest_seqval", "no_orphans")


def checked_keys(history: DataFrame, current: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Every key of history or current, once, with what each check says of it."""
    now = current.select(*keys, seq_key().alias("__k"), F.lit(True).alias("__here"))
    both = latest_op(history, keys).withColumn("__known", F.lit(True)).join(now, list(keys), "full_outer")
    here, known = F.coalesce("__here", F.lit(False)), F.coalesce("__known", F.lit(False))
    return both.select(
        *keys,
        here.alias("here"),
        (known & F.col("op").isin(*UPSERTS)).alias("alive"),
        (here & known & (F.col("op") == 1)).alias("tombstone"),
        (here & known & F.coalesce(F.col("__k") != F.col("upsert_key"), F.lit(False))).alias("latest_seqval"),
        (here & ~known).alias("no_orphans"),
    )


def tier_d(history: DataFrame, current: DataFrame, table_name: str, keys: tuple[str, ...] = ("id",), details: bool = True) -> DataFrame:
    """The four checks of history against current, from one join of both by key.

    ``details`` adds the first few keys that violate a check, as JSON; it reads the same
    shuffled rows once more.
    """
    marked = checked_keys(history, current, keys)
    counts = marked.agg(*[F.count_if(F.col(c)).alias(c) for c in (*CHECKS, "here", "alive")])
    each = F.array(*[F.struct(F.lit(c).alias("check_name"), F.col(c).alias("violations")) for c in CHECKS], F.struct(F.lit("count_formula").alias("check_name"), F.abs(F.col("here") - F.col("alive")).alias("violations")))
    out = counts.select(F.inline(each))
    if details:
        bad = marked.select(*keys, F.explode(F.filter(F.array(*[F.when(F.col(c), F.lit(c)) for c in CHECKS]), lambda x: x.isNotNull())).alias("check_name"))
        first = F.row_number().over(Window.partitionBy("check_name").orderBy(*keys))  # limited before the shuffle
        some = bad.withColumn("__rn", first).where(F.col("__rn") <= SAMPLES).groupBy("check_name").agg(F.to_json(F.sort_array(F.collect_list(F.struct(*keys)))).alias("sample"))
        out = out.join(some, "check_name", "left")
    else:
        out = out.withColumn("sample", F.lit(None).cast("string"))
    return verdict(out, table_name)


def verdict(found: DataFrame, table_name: str) -> DataFrame:
    """Tier D's rows from (check_name, violations, sample)."""
    status = F.when(F.col("violations") == 0, OK).otherwise(MISMATCH)
    return found.select(
        F.lit(table_name).alias("table_name"),
        F.lit(None).cast("string").alias("fingerprint"),
        F.lit("D").alias("tier"),
        "check_name",
        status.alias("status"),
        F.lit(0).cast("long").alias("expected"),
        F.col("violations").alias("actual"),
        F.col("sample").alias("details"),
    )


def single_checks() -> dict:
    """Each check of tier D by itself, as a function of history, current and the table's name."""

    def counted(name: str, violations) -> object:
        def rows(history: DataFrame, current: DataFrame, table_name: str, keys: tuple[str, ...] = ("id",)) -> DataFrame:
            n = violations(latest_op(history, keys), current, keys=keys)
            n = n if "violations" in n.columns else n.agg(F.count(F.lit(1)).alias("violations"))
            status = F.when(F.col("violations") == 0, OK).otherwise(MISMATCH)
            none = F.lit(None).cast("string")
            return n.select(F.lit(table_name).alias("table_name"), none.alias("fingerprint"), F.lit("D").alias("tier"), F.lit(name).alias("check_name"), status.alias("status"), F.lit(0).cast("long").alias("expected"), F.col("violations").alias("actual"), none.alias("details"))

        return rows

    each = {"tombstone": inv_tombstone, "latest_seqval": inv_latest_seqval, "no_orphans": inv_no_orphans, "count_formula": inv_count_formula}
    return {name: counted(name, check) for name, check in each.items()}


def error_row(spark, table_name: str, tier: str, check_name: str, notes: str) -> DataFrame:
    """What a check leaves that could not run."""
    row = [(table_name, None, tier, check_name, ERROR, None, None, None, notes)]
    return spark.createDataFrame(row, "table_name string, fingerprint string, tier string, check_name string, status string, expected bigint, actual bigint, details string, notes string")


def snapshot_pairing(history_commits: DataFrame, current_commits: DataFrame) -> DataFrame:
    """For each current snapshot of a table, the newest history snapshot not after it; null if none.

    Both sides (table_name, snapshot_id, ts) go through one window per table, not a range join.
    """
    h = history_commits.select("table_name", "ts", F.col("snapshot_id").alias("h"), F.lit(None).cast("string").alias("c"), F.lit(0).alias("side"))
    c = current_commits.select("table_name", "ts", F.lit(None).cast("string").alias("h"), F.col("snapshot_id").alias("c"), F.lit(1).alias("side"))
    order = Window.partitionBy("table_name").orderBy("ts", "side", "h").rowsBetween(Window.unboundedPreceding, 0)
    out = h.union(c).withColumn("paired", F.last("h", ignorenulls=True).over(order)).where("side = 1")
    return out.select("table_name", F.col("c").alias("current_snapshot"), "ts", F.col("paired").alias("history_snapshot"))
