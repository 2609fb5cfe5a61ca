"""Resolving change history into current rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.keys import BOOKKEEPING, is_tombstone, is_upsert, seq_key

KEYS = ("id",)


def scoped(history: DataFrame, fingerprint: str | None = None, load_ts_after_ms: int | None = None) -> DataFrame:
    """Rows of one fingerprint, loaded after a bound."""
    out = history if fingerprint is None else history.where(F.col("fingerprint") == fingerprint)
    return out if load_ts_after_ms is None else out.where(F.col("load_ts") > F.timestamp_millis(F.lit(load_ts_after_ms)))


def newest(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The row of each key with the greatest order key; ties by the row's hash.

    Planned with a limit inside each window group, so that tasks shuffle only their own best.
    """
    plain = [c for c, t in rows.dtypes if not t.startswith(("map", "variant"))]
    order = Window.partitionBy(*keys).orderBy(seq_key().desc_nulls_last(), F.xxhash64(*plain))
    return rows.withColumn("__rn", F.row_number().over(order)).where("__rn = 1").drop("__rn")


def latest_upserts(history: DataFrame, keys: tuple[str, ...] = KEYS, fingerprint: str | None = None, load_ts_after_ms: int | None = None) -> DataFrame:
    """The newest insert, update or snapshot of each key, without bookkeeping columns."""
    return newest(scoped(history, fingerprint, load_ts_after_ms).where(is_upsert()), keys).drop(*BOOKKEEPING)


def latest_op(history: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Of each key: the operation with the greatest order key, that key, and the greatest of an upsert."""
    return history.groupBy(*keys).agg(F.max_by("op", seq_key()).alias("op"), F.max(seq_key()).alias("seq_key"), F.max(F.when(is_upsert(), seq_key())).alias("upsert_key"))


def merge_upsert(current: DataFrame, source: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """``source`` replaces whole rows with a smaller order key and adds keys that are new.

    A null order key in ``current`` is never below another. ``source`` has each key once.
    """
    old = current.select(F.struct(*current.columns).alias("old"), *[F.col(k).alias(f"__o{k}") for k in keys])
    new = source.select(F.struct(*[F.col(c) for c in current.columns]).alias("new"), *[F.col(k).alias(f"__n{k}") for k in keys])
    on = [F.col(f"__o{k}") == F.col(f"__n{k}") for k in keys]
    both = old.join(new, on, "full_outer")
    take = F.col("old").isNull() | (F.col("new").isNotNull() & (seq_key(F.col("old.seqval_hex")) < seq_key(F.col("new.seqval_hex"))))
    return both.select(F.when(F.coalesce(take, F.lit(False)), F.col("new")).otherwise(F.col("old")).alias("r")).select("r.*")


def tombstone_delete(current: DataFrame, history: DataFrame, keys: tuple[str, ...] = KEYS, fingerprint: str | None = None, load_ts_after_ms: int | None = None) -> DataFrame:
    """``current`` without keys that have any tombstone in scope, wherever it stands in order."""
    gone = scoped(history, fingerprint, load_ts_after_ms).where(is_tombstone()).select(*keys).distinct()
    return current.join(gone, list(keys), "left_anti").select(current.columns)


def replay_steps(history: DataFrame, fingerprints: list[str], keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Upsert, then delete, fingerprint by fingerprint in order of time: three shuffles each."""
    current = latest_upserts(history.limit(0), keys)
    for fp in fingerprints:
        current = tombstone_delete(merge_upsert(current, latest_upserts(history, keys, fp), keys), history, keys, fp)
    return current


def replay_current(history: DataFrame, fingerprints: list[str], keys: tuple[str, ...] = KEYS) -> DataFrame:
    """What ``replay_steps`` gives, in three shuffles however many fingerprints there are.

    A key's tombstones delete all up to the end of their fingerprint, so only fingerprints
    after its last one count. Of their newest upserts the greatest order key wins, the
    earlier on a tie; a row without order key wins only if it came first, and then stays.
    """
    place = F.array_position(F.array(*map(F.lit, fingerprints)), F.col("fingerprint"))
    listed = history.where(F.col("fingerprint").isin(fingerprints))
    gone = listed.where(is_tombstone()).groupBy(*keys).agg(F.max(place).alias("__gone"))
    best = newest(listed.where(is_upsert()), (*keys, "fingerprint")).withColumn("__place", place).join(gone, list(keys), "left")
    alive = best.where(F.col("__gone").isNull() | (F.col("__place") > F.col("__gone")))
    first = F.col("__place") == F.min("__place").over(Window.partitionBy(*keys))
    alive = alive.withColumn("__stays", first & F.col("seqval_hex").isNull())
    order = Window.partitionBy(*keys).orderBy(F.desc("__stays"), seq_key().desc_nulls_last(), "__place")
    out = alive.withColumn("__rn", F.row_number().over(order)).where("__rn = 1")
    return out.select([c for c in history.columns if c not in BOOKKEEPING])


def current_state(history: DataFrame, keys: tuple[str, ...] = KEYS, keep_tombstones: bool = False) -> DataFrame:
    """The newest change of each key over all operations, hidden if it is a tombstone.

    Independent of arrival order. With ``keep_tombstones`` it is the state to merge later
    changes into, so that a late older upsert can't bring a key back.
    """
    out = newest(history, keys)
    return out if keep_tombstones else out.where(~is_tombstone()).drop(*BOOKKEEPING)


def state_as_of(history: DataFrame, load_ts: datetime | Column, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """``current_state`` of what had been loaded at a time."""
    bound = load_ts if isinstance(load_ts, Column) else F.lit(load_ts)
    return current_state(history.where(F.col("load_ts") <= bound), keys)


def erase_ids(df: DataFrame, ids: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """``df`` without the keys listed; for history and current alike."""
    return df.join(ids.select(*keys).distinct(), list(keys), "left_anti").select(df.columns)


def key_history(history: DataFrame, key, column: str = "id") -> DataFrame:
    return history.where(F.col(column) == key).orderBy(seq_key(), F.xxhash64(*history.columns))
