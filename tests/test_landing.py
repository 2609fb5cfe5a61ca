import itertools
import json
import random
import re
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions.keys import count_status
from tidemark.operators import recon
from tidemark.plans import ingest
from tidemark.sources import bookmarks as marks
from tidemark.sources import landing
from tidemark.sources.history import read_history
from tidemark.sources.shared import Plan, exists
from tidemark.sources.state import StateTable
from tidemark.streaming.upsert import start_upsert_stream, upsert_batch

BATCH = "id long, name string, op int, seqval_hex string"
BOOKS = "table_name string, fingerprint string, kind string, value string"
ONE = [(5, "a", 0, "0a1"), (60, "b", 0, "0a2"), (7, "c", 0, "0b3")]
TWO = [(5, "a2", 2, "0c4"), (60, "b", 1, "0d5"), (800, "d", 0, "0e6")]


def entry(hwm="42000", n=6, history=None):
    return {"lastSuccessfulWriteTimestamp": hwm, "totalProcessedRecordsCount": n, "dataFilesPath": "s3://bucket/cda/t", "schemaHistory": history or {}}


def put(tmp_path, content):
    f = tmp_path / "manifest.json"
    f.write_text(content if isinstance(content, str) else json.dumps(content))
    return str(f)


def test_manifest(spark, tmp_path):
    path = put(tmp_path, {"a": entry("000000c42", 7_000_000_000_000, {"f2": "200", "f1": "1000"}), "b": entry()})
    rows = {r["table_name"]: r for r in landing.read_manifest(spark, path).collect()}
    assert (rows["a"]["hwm"], rows["a"]["record_count"], rows["a"]["data_path"]) == ("000000c42", 7_000_000_000_000, "cda/t")
    assert rows["b"]["schema_history"] == {}
    order = landing.fingerprint_order(landing.read_manifest(spark, path)).orderBy("place").collect()
    assert [r["fingerprint"] for r in order] == ["f2", "f1"]  # by number, not text
    (tmp_path / "empty").mkdir()
    assert landing.read_manifest(spark, put(tmp_path / "empty", {})).count() == 0


@pytest.mark.parametrize("content", ["[1, 2", '{"a": {"totalProcessedRecordsCount": [7]}}'])
def test_bad_manifest_raises(spark, tmp_path, content):
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        landing.read_manifest(spark, put(tmp_path, content)).collect()


def chosen_by_hand(names, cursor, hwm):
    """Whole numbers past the cursor and up to the mark; a bookmark that is no number bounds nothing."""
    number = lambda t: int(t) if t is not None and re.fullmatch("[+-]?[0-9]+", t) else None
    low, high = number(cursor), number(hwm)
    return sorted({n for n in map(number, names) if n is not None and (low is None or n > low) and (high is None or n <= high)})


def test_select_batches(spark):
    """Random folders and bookmarks of many tables at once, against the rule in plain Python."""
    rng = random.Random(5)
    odd = ["", " 7", "7 ", "7.0", "1e3", "_tmp", "0x10", "٣", "--5", "+"]
    cases = {}
    for k in range(120):
        folders = [str(rng.choice([rng.randrange(20), rng.randrange(10**13)])) for _ in range(rng.randrange(8))] + rng.sample(odd, rng.randrange(4)) + rng.choice([[], ["-3", "+4", "007"]])
        bound = lambda: rng.choice([None, *folders, str(rng.randrange(25)), str(rng.randrange(10**13)), "later", "1.5"])
        cases[f"t{k}"] = folders, bound(), bound()
    inv = spark.createDataFrame([(t, "f", b) for t, (fs, _, _) in cases.items() for b in fs], "table_name string, fingerprint string, batch string")
    eff = spark.createDataFrame([(t, "f", c) for t, (_, c, _) in cases.items()], "table_name string, fingerprint string, cursor string")
    hwm = spark.createDataFrame([(t, h) for t, (_, _, h) in cases.items()], "table_name string, hwm string")
    got = {}
    for r in landing.select_batches(inv, eff, hwm).collect():
        got.setdefault(r["table_name"], []).append(r["batch_ts"])
    assert {t: sorted(x) for t, x in got.items()} == {t: x for t, c in cases.items() if (x := chosen_by_hand(*c))}
    assert any(len(x) > 2 for x in got.values()) and len(got) < len(cases)


def status_by_hand(landed, written, ok, lost):
    if lost and not ok:
        return "METRICS_MISSING"
    return "MISMATCH" if landed != written else "METRICS_PARTIAL" if lost else "OK"


def test_status(spark):
    """All small combinations of landed and written rows, good and lost batches."""
    cases = list(itertools.product(range(3), range(3), range(3), range(3)))
    rows = spark.createDataFrame(cases, "landed long, written long, ok long, lost long")
    got = rows.select("*", count_status(*map(F.col, rows.columns)).alias("status")).collect()
    assert [r["status"] for r in sorted(got)] == [status_by_hand(*c) for c in cases]
    assert {r["status"] for r in got} == {"OK", "MISMATCH", "METRICS_PARTIAL", "METRICS_MISSING"}


def test_effective_cursor(spark):
    books = spark.createDataFrame([("t", "f1", "cursor", "5"), ("t", None, "hwm", "9"), ("u", "f1", "merge_watermark", "3")], BOOKS)
    fps = spark.createDataFrame([("t", "f1"), ("t", "f2"), ("u", "f1")], "table_name string, fingerprint string")
    got = {(r[0], r[1]): (r[2], r[3]) for r in marks.effective_cursor(books, fps).collect()}
    assert got == {("t", "f1"): ("5", None), ("t", "f2"): ("9", None), ("u", "f1"): (None, "3")}


def test_marks_move_forward_and_resets(spark):
    old = spark.createDataFrame([("t", "f1", "cursor", "999"), ("t", None, "hwm", "1000")], BOOKS)
    new = spark.createDataFrame([("t", "f1", "cursor", "1001"), ("t", None, "hwm", "900")], BOOKS)
    got = {r["kind"]: r["value"] for r in marks.bookmark_max_merge(old, new).collect()}
    assert got == {"cursor": 1001, "hwm": 1000}
    m = "table_name string, hwm string, record_count long, schema_history map<string,string>"
    back = spark.createDataFrame([("T", "999", 5, {"f1": "1"})], m)
    gone = spark.createDataFrame([("t", "1000", 5, {"f2": "1"})], m)
    fine = spark.createDataFrame([("t", "1000", 5, {"f1": "1"})], m)
    assert [r["kind"] for r in marks.detect_reset(back, old).collect()] == ["hwm_regression"]
    assert [(r["kind"], r["detail"]) for r in marks.detect_reset(gone, old).collect()] == [("fingerprint_pruned", "f1")]
    assert marks.detect_reset(fine, old).count() == 0
    assert [r["status"] for r in marks.launch_decision(back, old).collect()] == ["RESET"]
    assert [r["status"] for r in marks.launch_decision(fine, old).collect()] == ["STOP"]
    more = spark.createDataFrame([("t", "1001", 2_000_000_000, {"f1": "1"}), ("new", "1", 5, {})], m)
    assert sorted(tuple(r) for r in marks.launch_decision(more, old).collect()) == [("START", "new", 1, "small"), ("START", "t", 1001, "large")]
    assert [r["table_name"] for r in marks.launch_decision(more, old, "T").collect()] == ["new"]


def test_snapshot_pairing(spark):
    c = "table_name string, snapshot_id string, ts timestamp"
    at = lambda h: datetime(2024, 1, 1, h)
    h = spark.createDataFrame([("t", "h1", at(1)), ("t", "h2", at(3))], c)
    cur = spark.createDataFrame([("t", "c0", at(0)), ("t", "c1", at(2)), ("t", "c2", at(3))], c)
    assert {r["current_snapshot"]: r["history_snapshot"] for r in recon.snapshot_pairing(h, cur).collect()} == {"c0": None, "c1": "h1", "c2": "h2"}


def land(spark, base, batch, rows, metrics=None, schema=BATCH, fp="f1"):
    folder = f"{base}/t/{fp}/{batch}"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(folder)
    if metrics is not None:
        from pathlib import Path

        (Path(folder) / ".cda").mkdir()
        (Path(folder) / ".cda" / "batch-metrics.json").write_text(metrics)


def test_ingest(spark, tmp_path):
    base = str(tmp_path / "landing")
    good = json.dumps({"tableName": "t", "schemaId": "f1", "batchTimestamp": "1", "numRecordsRead": 4, "numRecordsWritten": 3, "numRecordsDropped": 1})
    land(spark, base, 41000, ONE, good)
    land(spark, base, 42000, TWO, "{corrupt")
    manifest = put(tmp_path, {"t": entry(history={"f1": "41000"})})
    books, paths = spark.createDataFrame([], BOOKS), [str(tmp_path / x) for x in ("history", "state", "recon")]
    table = StateTable(spark, paths[1])
    kept = ingest.ingest_table(spark, base, manifest, "t", books, *paths, "run1", datetime(2024, 4, 1))
    assert {r["id"]: r["name"] for r in table.current().collect()} == {5: "a2", 7: "c", 800: "d"}
    assert spark.read.parquet(paths[0]).count() == 6
    audit = {r["tier"]: (r["status"], r["expected"], r["actual"], r["delta"]) for r in spark.read.parquet(paths[2]).collect()}
    assert audit == {"A": ("MISMATCH", 3, 6, 3), "B": ("MISMATCH", 3, 6, 3)}  # one of two batches has metrics
    state = kept.select("table_name", "fingerprint", "kind", F.col("value").cast("string"))
    assert {(r["kind"], r["value"]) for r in state.collect()} == {("hwm", "42000"), ("cursor", "42000"), ("merge_watermark", "42000")}
    again = ingest.ingest_table(spark, base, manifest, "t", state, *paths, "run2", datetime(2024, 4, 2))
    assert again.count() == 3
    # a retry that lost its bookmarks appends nothing twice
    ingest.ingest_table(spark, base, manifest, "t", books, *paths, "run3", datetime(2024, 4, 3))
    assert spark.read.parquet(paths[0]).count() == 6 and table.current().count() == 3
    # a new fingerprint with a new column
    land(spark, base, 43000, [(9, "e", 0, "0f7", 1.5)], None, BATCH + ", extra double", "f2")
    manifest = put(tmp_path, {"t": entry("43000", history={"f1": "41000", "f2": "43000"})})
    ingest.ingest_table(spark, base, manifest, "t", state, *paths, "run4", datetime(2024, 4, 4))
    assert {r["id"]: r["extra"] for r in table.current().collect()} == {5: None, 7: None, 800: None, 9: 1.5}
    rows = ingest.recon_only(spark, "t", paths[0], paths[1], "run5", datetime(2024, 4, 5)).collect()
    assert {r["status"] for r in rows} == {"OK"} and len(rows) == 4
    assert ingest.recon_only(spark, "t", paths[0], str(tmp_path / "none"), "run5", datetime(2024, 4, 5)).count() == 0
    assert landing.partition_stats(spark.read.parquet(paths[0])).count() == 2
    ingest.export(table.current(), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 4
    ingest.write_current(table.current(), str(tmp_path / "whole"), buckets=2)
    assert spark.read.parquet(str(tmp_path / "whole")).count() == 4


class Run:
    """One table's folders and bookmarks over several runs."""

    def __init__(self, spark, tmp_path):
        self.spark, self.tmp, self.base = spark, tmp_path, str(tmp_path / "landing")
        self.paths = [str(tmp_path / x) for x in ("history", "state", "recon")]
        self.books, self.n = spark.createDataFrame([], BOOKS), 0

    def __call__(self, keep=True, exclude="", **history):
        """The nth run goes up to folder n thousand and a half."""
        self.n += 1
        manifest = put(self.tmp, {"T": entry(f"{self.n}500", history=history or {"f1": "1"})})
        kept = ingest.ingest_table(self.spark, self.base, manifest, "T", self.books, *self.paths, f"run{self.n}", datetime(2024, 4, self.n), exclude)
        rows = [(r["table_name"], r["fingerprint"], r["kind"], str(r["value"])) for r in kept.collect()]
        if keep:
            self.books = self.spark.createDataFrame(rows, BOOKS)
        return {(r[1], r[2]): r[3] for r in rows}

    def current(self):
        return {r["id"]: r.asDict() for r in StateTable(self.spark, self.paths[1]).current().collect()}

    def history(self):
        return read_history(self.spark, self.paths[0])


def test_merge_that_is_owed(spark, tmp_path):
    """A run that ended between append and merge: nothing new has landed, and its rows are merged."""
    run = Run(spark, tmp_path)
    land(spark, run.base, 1000, ONE)
    land(spark, run.base, 2000, TWO)
    run()
    assert run() == {(None, "hwm"): "2500", ("f1", "cursor"): "2000", ("f1", "merge_watermark"): "2000"}
    whole = run.current()
    run.paths[1] = str(tmp_path / "lost")  # as if the first run's merge had never been
    run.books = run.books.where("kind <> 'merge_watermark'")
    assert run()["f1", "merge_watermark"] == "2000" and run.current() == whole and run.history().count() == 6
    run.books = spark.createDataFrame([("t", "f1", "cursor", "1000"), ("t", "f1", "merge_watermark", "1000")], BOOKS)
    assert run()["f1", "cursor"] == "2000" and run.history().count() == 6 and run.current() == whole


def test_types_widen_over_runs(spark, tmp_path):
    """A later fingerprint widens types and adds a column; stored files keep the old ones."""
    run = Run(spark, tmp_path)
    narrow = "id int, name string, op int, seqval_hex string, n int, x float, d decimal(5,1)"
    wide = "id long, name string, op int, seqval_hex string, n long, x double, d decimal(9,1), bucket string, v int"
    land(spark, run.base, 1000, [(1, "a", 0, "1", 7, 0.5, Decimal("1.5")), (2, "b", 0, "2", 8, 1.5, None)], schema=narrow)
    run(f1="1")
    land(spark, run.base, 2000, [(2, "b2", 2, "3", 1 << 40, 2.25, Decimal("12345678.5"), "mine", 5)], schema=wide, fp="f2")
    run(f1="1", f2="2")
    land(spark, run.base, 3000, [(3, "c", 0, "4", 9, 2.5, Decimal("2.5"))], schema=narrow)
    run(f1="1", f2="2")
    got = run.current()
    assert [got[k]["n"] for k in (1, 2, 3)] == [7, 1 << 40, 9] and [got[k]["x"] for k in (1, 2, 3)] == [0.5, 2.25, 2.5]
    assert [got[k]["d"] for k in (1, 2, 3)] == [Decimal("1.5"), Decimal("12345678.5"), Decimal("2.5")]
    assert [(got[k]["bucket"], got[k]["v"]) for k in (1, 2, 3)] == [(None, None), ("mine", 5), (None, None)]
    assert run.history().count() == 4 and run.history().schema["n"].dataType.simpleString() == "bigint"
    assert [r["status"] for r in ingest.recon_only(spark, "t", *run.paths[:2], "r", datetime(2024, 5, 1)).collect()] == ["OK"] * 4
    land(spark, run.base, 4000, [(3, "c", 0, "5", "text")], schema="id int, name string, op int, seqval_hex string, n string", fp="f3")
    with pytest.raises(TypeError, match="column n"):
        run(f1="1", f2="2", f3="3")


def test_excluded_and_taken_columns(spark, tmp_path):
    run = Run(spark, tmp_path)
    land(spark, run.base, 1000, [(1, "a", 0, "1", "s")], schema=BATCH + ", secret string")
    run(exclude="t:SECRET")
    assert "secret" not in run.history().columns and "secret" not in run.current()[1]
    land(spark, run.base, 2000, [(1, "a", 0, "1", 5)], schema=BATCH + ", batch_ts int", fp="f2")
    with pytest.raises(ValueError, match="taken"):
        run(f1="1", f2="2")


def test_many_folders_in_few_jobs(spark, tmp_path):
    """All batches of a fingerprint are read and appended together."""
    run = Run(spark, tmp_path)
    rows = spark.range(120).selectExpr("id", "string(id) AS name", "0 AS op", "lower(hex(id)) AS seqval_hex", "id + 1 AS ts", "'f1' AS fp", "'t' AS t")
    rows.repartition(1).write.partitionBy("t", "fp", "ts").parquet(run.base)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("many", "ingest")
    try:
        run()
    finally:
        jobs = len(tracker.getJobIdsForGroup("many"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert run.history().select("batch_ts").distinct().count() == 120 and len(run.current()) == 120
    assert jobs < 60
    audit = spark.read.parquet(run.paths[2]).where("tier = 'A'").first()
    assert (audit["actual"], audit["status"]) == (120, "METRICS_MISSING")


def test_failed_checks_leave_error_rows(spark, tmp_path, monkeypatch):
    run = Run(spark, tmp_path)
    land(spark, run.base, 1000, ONE)

    def broken(*args, **kwargs):
        raise RuntimeError("no luck")

    monkeypatch.setattr(recon, "tier_b", broken)
    run()
    audit = {r["tier"]: (r["status"], r["notes"]) for r in spark.read.parquet(run.paths[2]).collect()}
    assert audit == {"A": ("METRICS_MISSING", None), "B": ("ERROR", "RuntimeError: no luck")} and len(run.current()) == 3
    monkeypatch.setattr(recon, "tier_d", broken)
    monkeypatch.setattr(recon, "inv_no_orphans", broken)
    checks = ingest.recon_only(spark, "t", *run.paths[:2], "d", datetime(2024, 5, 1), recon_path=run.paths[2])
    assert {r["check_name"]: r["status"] for r in checks.collect()} == {"tombstone": "OK", "latest_seqval": "OK", "no_orphans": "ERROR", "count_formula": "OK"}
    assert spark.read.parquet(run.paths[2]).where("tier = 'D'").count() == 4


def test_checks_are_pinned_to_what_is_merged(spark, tmp_path):
    run = Run(spark, tmp_path)
    land(spark, run.base, 1000, ONE)
    run()
    land(spark, run.base, 2000, TWO)
    state, run.paths[1] = run.paths[1], str(tmp_path / "elsewhere")
    run(keep=False)  # history is ahead of the state
    status = lambda books: {r["status"] for r in ingest.recon_only(spark, "t", run.paths[0], state, "d", datetime(2024, 5, 1), books).collect()}
    assert status(None) == {"OK", "MISMATCH"} and status(run.books) == {"OK"}


def test_state_table(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "s"), buckets=4)
    assert table.read() is None and table.current() is None
    rows = [(k, "x", 0, f"{k:08x}") for k in range(40)]
    table.upsert(spark.createDataFrame(rows, BATCH))
    files = lambda: {str(f) for f in (tmp_path / "s").glob("*/__bucket=*/*.parquet")}
    before, one = files(), spark.createDataFrame([(7, "y", 2, "000000ff")], BATCH)
    table.upsert(one)
    assert len({f.rpartition("/")[0] for f in files() ^ before}) == 1  # only the key's bucket was written
    table.upsert(one)
    table.upsert(one.limit(0))
    assert {r["name"] for r in table.current().where("id = 7").collect()} == {"y"} and table.current().count() == 40
    with pytest.raises(ValueError, match="taken"):
        table.upsert(one.withColumn("__bucket", F.lit(1)))


def test_upsert_that_was_cut_short(spark, tmp_path, monkeypatch):
    """Readers take rows from beside the table and leave them there; the next upsert moves them into it."""
    import shutil

    path = str(tmp_path / "s")
    table = StateTable(spark, path, buckets=2)
    table.upsert(spark.createDataFrame([(k, "x", 0, f"{k:08x}") for k in range(9)], BATCH))
    with monkeypatch.context() as m:
        calls = iter([None])
        m.setattr(StateTable, "_finish", lambda self: next(calls))  # the first is before, the second would move the rows
        with pytest.raises(StopIteration):
            table.upsert(spark.createDataFrame([(7, "y", 2, "000000ff")], BATCH))
    touched = next((tmp_path / "s_staged").glob("*/__bucket=*"))
    shutil.rmtree(tmp_path / "s" / touched.relative_to(tmp_path / "s_staged"))
    for _ in range(2):
        assert {r["name"] for r in table.current().where("id = 7").collect()} == {"y"} and table.current().count() == 9
    table.upsert(spark.createDataFrame([(8, "z", 2, "000000ff")], BATCH))
    assert {r["name"] for r in table.current().where("id in (7, 8)").collect()} == {"y", "z"} and table.current().count() == 9
    assert not exists(spark, path + "_staged")


def test_plan(spark, tmp_path):
    from pyspark.sql.types import StructType

    plan, ddl = Plan(spark, str(tmp_path / "t")), StructType.fromDDL
    assert plan.read() == (None, {})
    plan.extend(ddl("a int, b string"), buckets=8)
    plan.extend(ddl("c float, a bigint"), buckets=9)
    plan.extend(ddl("a int"))
    assert plan.read() == (ddl("a bigint, b string, c float"), {"buckets": 8})
    assert spark.read.text(str(tmp_path / "t_plan")).count() == 2


def test_metrics_rollup_from_files(spark, tmp_path):
    base = str(tmp_path)
    good = json.dumps({"tableName": "t", "numRecordsRead": 4, "numRecordsWritten": 3, "numRecordsDropped": 1})
    land(spark, base, 1, ONE, good)
    land(spark, base, 2, ONE, "{corrupt")
    land(spark, base, 3, ONE)
    chosen = spark.createDataFrame([("t", "f1", b) for b in (1, 2, 3)], "table_name string, fingerprint string, batch_ts long")
    r = landing.batch_metrics_rollup(chosen, landing.read_batch_metrics(spark, base)).first()
    assert (r["read"], r["written"], r["dropped"], r["ok"], r["missing"], r["corrupt"]) == (4, 3, 1, 1, [3], [2])


def test_stream(spark, tmp_path):
    base, state = tmp_path / "in", str(tmp_path / "state")
    spark.createDataFrame(TWO, BATCH).write.parquet(str(base / "b"))  # the later changes first
    schema = spark.createDataFrame([], BATCH).schema
    run = lambda: start_upsert_stream(spark, f"{base}/*", schema, state, str(tmp_path / "ck")).awaitTermination()
    run()
    spark.createDataFrame(ONE, BATCH).write.parquet(str(base / "a"))
    run()
    table = StateTable(spark, state)
    alive = lambda: {r["id"]: r["name"] for r in table.current().collect()}
    assert alive() == {5: "a2", 7: "c", 800: "d"}
    upsert_batch(table)(spark.createDataFrame(ONE, BATCH), 1)  # the last batch once more
    assert alive() == {5: "a2", 7: "c", 800: "d"}
