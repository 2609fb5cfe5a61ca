"""Order keys, operation classes and status rules of change data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Operation codes of change records.
INSERT, TOMBSTONE, UPDATE, SNAPSHOT = 0, 1, 2, 4
UPSERTS = (INSERT, UPDATE, SNAPSHOT)
PROTECTED = ("id", "op", "seqval_hex")
BOOKKEEPING = ("fingerprint", "load_ts")
OK, MISMATCH, PARTIAL, MISSING, ERROR = "OK", "MISMATCH", "METRICS_PARTIAL", "METRICS_MISSING", "ERROR"


def seq_key(col: str | Column = "seqval_hex", width: int = 32) -> Column:
    """The commit-order key: hex text in lower case, padded so that text order is number order."""
    col = F.col(col) if isinstance(col, str) else col
    return F.lpad(F.lower(col), width, "0")


def is_upsert() -> Column:
    return F.col("op").isin(*UPSERTS)


def is_tombstone() -> Column:
    return F.col("op") == TOMBSTONE


def epoch_ms(text: Column) -> Column:
    """A folder name or bookmark as a number; null unless it is an integer in digits."""
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("long"))


def count_status(landed: Column, written: Column, ok: Column, lost: Column) -> Column:
    """Tier A: lost batches are those whose metrics are missing or corrupt."""
    return (
        F.when((ok == 0) & (lost > 0), F.lit(MISSING)).when(landed != written, F.lit(MISMATCH)).when(lost > 0, F.lit(PARTIAL)).otherwise(F.lit(OK))
    )


def size_class(records: Column, medium: int = 100_000_000, large: int = 1_000_000_000) -> Column:
    return F.when(records >= large, F.lit("large")).when(records >= medium, F.lit("medium")).otherwise(F.lit("small"))
