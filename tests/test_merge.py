from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.keys import seq_key
from tidemark.operators import merge, recon
from tidemark.sources.history import beyond

ROWS = "id long, name string, op int, seqval_hex string, fingerprint string, load_ts timestamp"
T1, T2 = datetime(2023, 11, 5, 6), datetime(2023, 11, 5, 7)


@pytest.fixture()
def history(spark):
    """Two batches: inserts of 5, 60 and 7; then an update of 5, a tombstone of 60, an insert of 800."""
    rows = [(5, "a", 0, "0a1", "fp", T1), (60, "b", 0, "0a2", "fp", T1), (7, "c", 0, "0b3", "fp", T1)]
    rows += [(5, "a2", 2, "0c4", "fp", T2), (60, "b", 1, "0d5", "fp", T2), (800, "d", 0, "0e6", "fp", T2)]
    return spark.createDataFrame(rows, ROWS)


def names(df):
    return {r["id"]: r["name"] for r in df.collect()}


def test_worked_example(history):
    expected = {5: "a2", 7: "c", 800: "d"}
    assert names(merge.current_state(history)) == expected
    assert names(merge.replay_current(history, ["fp"])) == expected
    assert names(merge.state_as_of(history, T1)) == {5: "a", 60: "b", 7: "c"}
    assert set(merge.current_state(history).columns) == {"id", "name", "op", "seqval_hex"}


def test_order_key_is_number_order(spark):
    df = spark.createDataFrame([("FF",), ("100",), ("a",), (None,)], "seqval_hex string")
    assert [r[0] for r in df.orderBy(seq_key()).collect()] == [None, "a", "FF", "100"]


def test_upsert_guard_whole_rows_and_idempotence(spark):
    cols = "id long, name string, op int, seqval_hex string"
    old = spark.createDataFrame([(1, "old", 0, "5"), (2, "old", 0, "9"), (3, "old", 0, None), (4, "only", 0, "1")], cols)
    new = spark.createDataFrame([(1, None, 2, "6"), (2, "late", 2, "8"), (3, "new", 2, "7"), (5, "added", 0, "1")], cols)
    once = merge.merge_upsert(old, new)
    assert names(once) == {1: None, 2: "old", 3: "old", 4: "only", 5: "added"}
    assert names(merge.merge_upsert(once, new)) == names(once)


def test_delete_takes_any_tombstone_but_state_takes_the_latest(spark):
    rows = [(1, "x", 1, "2", "fp", T1), (1, "again", 0, "3", "fp", T1)]
    h = spark.createDataFrame(rows, ROWS)
    assert names(merge.tombstone_delete(merge.latest_upserts(h), h)) == {}
    assert names(merge.current_state(h)) == {1: "again"}


def test_state_does_not_depend_on_order_or_splits(spark, history):
    shuffled = history.orderBy(F.rand(7))
    assert names(merge.current_state(shuffled)) == names(merge.current_state(history))
    first, second = history.where("seqval_hex > '0b3'"), history.where("seqval_hex <= '0b3'")
    late = merge.current_state(first, keep_tombstones=True).unionByName(second)
    assert names(merge.current_state(late)) == names(merge.current_state(history))


def test_invariants_hold_for_current_state(history):
    latest, state = merge.latest_op(history), merge.current_state(history)
    assert recon.inv_tombstone(latest, state).count() == 0
    assert recon.inv_latest_seqval(latest, state).count() == 0
    assert recon.inv_no_orphans(latest, state).count() == 0
    assert recon.inv_count_formula(latest, state).first()["violations"] == 0
    rows = {r["check_name"]: r["status"] for r in recon.tier_d(history, state, "t").collect()}
    assert set(rows.values()) == {"OK"} and len(rows) == 4
    bad = recon.tier_d(history, history.where("op = 0").drop("fingerprint", "load_ts"), "t").where("check_name = 'tombstone'").first()
    assert (bad["status"], bad["actual"], bad["details"]) == ("MISMATCH", 1, '[{"id":60}]')


def test_erase_batches_and_watermark(spark, history):
    assert names(merge.erase_ids(history, spark.createDataFrame([(5,), (5,)], "id long"))).keys() == {60, 7, 800}
    landed = history.withColumn("batch_ts", F.when(F.col("id") == 800, 2).otherwise(1))
    owed = lambda marks: landed.where(beyond(marks)).count()
    assert (owed({"fp": 1}), owed({"fp": 2}), owed({}), owed({"other": 9}), owed({"fp": 1, "other": 9})) == (1, 0, 6, 6, 1)


def test_empty_history(spark):
    h = spark.createDataFrame([], ROWS)
    assert merge.current_state(h).count() == 0 and merge.replay_current(h, ["fp"]).count() == 0


def test_replay_in_one_pass_equals_steps(spark):
    import random

    rng = random.Random(3)
    for _ in range(3):
        rows = [(rng.randrange(40), f"v{n}", rng.choice([0, 1, 2, 4]) if rng.random() < 0.5 else 2, rng.choice([None, f"{n:x}", f"{n // 2:X}"]), rng.choice(["f1", "f2", "f3", "f4"]), T1) for n in range(300)]
        h = spark.createDataFrame(rows, ROWS)
        order = ["f3", "f1", "f2"]
        steps = {(r["id"], r["seqval_hex"] and r["seqval_hex"].lower(), r["name"]) for r in merge.replay_steps(h, order).collect()}
        once = {(r["id"], r["seqval_hex"] and r["seqval_hex"].lower(), r["name"]) for r in merge.replay_current(h, order).collect()}
        assert steps == once
