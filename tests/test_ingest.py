"""Ingests that are cut short, and what is done to stored tables: erasure, rebuild, audits by bucket, streams."""

import json
import random
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from test_landing import BATCH, BOOKS, ONE, TWO, Run, entry, land, put
from tidemark.operators import merge, recon
from tidemark.plans import ingest, launch, rebuild
from tidemark.plans.digests import DigestAudit
from tidemark.sources import history as stored
from tidemark.sources import landing, state
from tidemark.sources.history import erase, read_history
from tidemark.sources.shared import Plan
from tidemark.sources.state import StateTable
from tidemark.streaming.upsert import ingest_batch, start_ingest_stream

AT = datetime(2024, 5, 1)


def metrics(n):
    return json.dumps({"tableName": "t", "numRecordsRead": n, "numRecordsWritten": n, "numRecordsDropped": 0})


def rows_of_run(run):
    return sorted(map(tuple, run.history().select("id", "name", "op", "seqval_hex", "fingerprint", "batch_ts").collect()))


def audits(run, run_id):
    rows = run.spark.read.schema(recon.RECON).parquet(run.paths[2]).where(F.col("run_id") == run_id).collect()
    return sorted((r["tier"], r["fingerprint"], r["status"], r["expected"], r["actual"]) for r in rows)


def test_append_that_was_cut_short(spark, tmp_path):
    """A batch of which a file is missing is whole after the retry, and the audit counts what it holds."""
    run = Run(spark, tmp_path)
    land(spark, run.base, 1000, ONE, metrics(3))
    spark.createDataFrame(TWO, BATCH).repartition(3, "id").write.parquet(f"{run.base}/t/f1/1200")
    (Path(run.base) / "t/f1/1200/.cda").mkdir()
    (Path(run.base) / "t/f1/1200/.cda/batch-metrics.json").write_text(metrics(3))
    run(keep=False)
    whole = rows_of_run(run)
    files = sorted(Path(run.paths[0]).glob("*/batch_ts=1200/*.parquet"))
    files[0].unlink()
    for f in Path(run.paths[0]).glob("*/batch_ts=1200/.*"):
        f.unlink()
    assert len(whole) == 6 > len(rows_of_run(run))
    run.n = 0
    put(run.tmp, {"T": entry("1500", history={"f1": "1"})})
    ingest.ingest_table(spark, run.base, str(run.tmp / "manifest.json"), "T", run.books, *run.paths, "again", AT)
    assert rows_of_run(run) == whole and set(run.current()) == {5, 7, 800}
    assert audits(run, "again") == [("A", "f1", "OK", 6, 6), ("B", None, "OK", 6, 6)]


STEPS = [(ingest, "write_history", False), (ingest, "write_history", True), (ingest, "audit", False), (ingest, "append_recon", True), (StateTable, "_merge", True), (state, "move", False), (ingest.marks, "bookmark_max_merge", False)]


@pytest.mark.parametrize("k", range(len(STEPS)))
def test_run_that_ends_anywhere(spark, tmp_path, monkeypatch, k):
    """A run that dies before or after any of its writes, and is repeated from the bookmarks it had."""
    run = Run(spark, tmp_path)
    land(spark, run.base, 1000, ONE, metrics(3))
    run()
    land(spark, run.base, 2000, TWO, metrics(3))
    land(spark, run.base, 2100, [(9, "n", 0, "0f1")], metrics(1), fp="f2")
    owner, name, after = STEPS[k]
    true = getattr(owner, name)

    def dies(*args, **kwargs):
        if after:
            true(*args, **kwargs)
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(owner, name, dies)
        with pytest.raises(KeyboardInterrupt):
            run(keep=False, f1="1", f2="2")
    run.n -= 1
    got = run(f1="1", f2="2")
    assert got["f1", "merge_watermark"] == "2000" and got["f2", "cursor"] == "2100"
    assert sorted(r[-1] for r in rows_of_run(run)) == [1000] * 3 + [2000] * 3 + [2100]
    assert {i: r["name"] for i, r in run.current().items()} == {5: "a2", 7: "c", 800: "d", 9: "n"}
    assert audits(run, "run2") == [("A", "f1", "OK", 3, 3), ("A", "f2", "OK", 1, 1), ("B", None, "OK", 7, 7)]


def test_run_goes_on_without_its_audit(spark, tmp_path, monkeypatch):
    run = Run(spark, tmp_path)
    land(spark, run.base, 1000, ONE)

    def broken(*args):
        raise OSError("no space")

    monkeypatch.setattr(ingest, "append_recon", broken)
    assert run()["f1", "merge_watermark"] == "1000" and len(run.current()) == 3


def test_metrics_of_chosen_folders_whatever_their_case(spark, tmp_path, monkeypatch):
    """Manifest ``T``, folder ``t``; no other table's or batch's metrics are opened."""
    opened, true = [], landing.read_chosen_metrics

    def look(*args):
        out = true(*args)
        opened.append(sorted(f.rsplit("/", 5)[1:4] for f in out.inputFiles() if f.endswith(".json")))
        return out

    monkeypatch.setattr(landing, "read_chosen_metrics", look)
    run = Run(spark, tmp_path)
    land(spark, run.base, 1000, ONE, metrics(3))
    spark.createDataFrame(ONE, BATCH).write.parquet(f"{run.base}/u/f1/1000")
    (Path(run.base) / "u/f1/1000/.cda").mkdir()
    (Path(run.base) / "u/f1/1000/.cda/batch-metrics.json").write_text("{")
    run()
    land(spark, run.base, 2000, TWO, metrics(3))
    run()
    assert opened == [[["t", "f1", "1000"]], [["t", "f1", "2000"]]]
    assert audits(run, "run1") == [("A", "f1", "OK", 3, 3), ("B", None, "OK", 3, 3)]
    assert audits(run, "run2") == [("A", "f1", "OK", 3, 3), ("B", None, "OK", 6, 6)]  # of all batches, not of the run's


def test_columns_of_all_folders(spark, tmp_path):
    """A column of a later folder, and types that differ within a fingerprint."""
    run = Run(spark, tmp_path)
    narrow = BATCH.replace("id long", "id int")
    land(spark, run.base, 1000, [(1, "a", 0, "1")], schema=narrow)
    land(spark, run.base, 1100, [(2, "b", 0, "2", "more")], schema=BATCH + ", late string")
    run()
    assert {i: r["late"] for i, r in run.current().items()} == {1: None, 2: "more"}
    assert run.history().schema["id"].dataType.simpleString() == "bigint"


def test_jobs_do_not_grow_with_fingerprints(spark, tmp_path):
    tracker, counts = spark.sparkContext.statusTracker(), []
    for n in (1, 6):
        run = Run(spark, tmp_path / str(n))
        (tmp_path / str(n)).mkdir()
        for k in range(n):
            land(spark, run.base, 100 + k, [(k, "a", 0, f"{k:x}")], fp=f"f{k}")
        spark.sparkContext.setJobGroup(f"fingerprints-{n}", "ingest")
        try:
            run(**{f"f{k}": str(k) for k in range(n)})
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert len(run.current()) == n
        counts.append(len(tracker.getJobIdsForGroup(f"fingerprints-{n}")))
    assert counts[1] <= counts[0] + 4


# State


def test_buckets_split_by_doubling(spark, tmp_path):
    """Touched buckets split, others keep their files; all keys stay where they are found."""
    rows = lambda keys, name, seq: spark.createDataFrame([(k, name, 0, f"{seq:08x}") for k in keys], BATCH)
    table = StateTable(spark, str(tmp_path / "s"), buckets=4)
    table.upsert(rows(range(200), "x", 1))
    files = lambda: {str(f.relative_to(tmp_path / "s")) for f in (tmp_path / "s").glob("*/*/*.parquet")}
    before = files()
    small = StateTable(spark, str(tmp_path / "s"), split=1200)
    small.upsert(rows([7], "y", 2))
    gone, new = before - files(), files() - before
    assert len({f.rpartition("/")[0] for f in gone}) == 1 and all(f.startswith("__of=4/") for f in gone)
    assert {f.split("/")[0] for f in new} == {"__of=8"}
    rng, want = random.Random(1), {k: "x" for k in range(200)} | {7: "y"}
    for seq in range(3, 9):
        keys = rng.sample(range(300), 12)
        want |= dict.fromkeys(keys, f"n{seq}")
        (small if seq % 2 else table).upsert(rows(keys, f"n{seq}", seq))
    got = [(r["id"], r["name"]) for r in table.current().collect()]
    assert len(got) == len(want) and dict(got) == want
    assert len({of for of, _ in table.leaves()}) > 1
    assert not state._split(table.leaves())  # no bucket is inside another


def test_split_that_was_cut_short(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    StateTable(spark, path, buckets=2).upsert(spark.createDataFrame([(k, "x", 0, f"{k:08x}") for k in range(50)], BATCH))
    table, true, moved = StateTable(spark, path, split=100), state.move, []

    def one(*args):
        if moved:
            raise KeyboardInterrupt
        moved.append(true(*args))

    with monkeypatch.context() as m:
        m.setattr(state, "move", one)
        with pytest.raises(KeyboardInterrupt):
            table.upsert(spark.createDataFrame([(k, "y", 2, "00ffffff") for k in range(50)], BATCH))
    for _ in range(2):
        assert [r["name"] for r in StateTable(spark, path).current().collect()] == ["y"] * 50
        table.upsert(spark.createDataFrame([(0, "y", 2, "00ffffff")], BATCH))


def test_stored_rows_are_not_shuffled(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "s"), buckets=4)
    table.upsert(spark.createDataFrame([(k, "x", 0, f"{k:08x}") for k in range(40)], BATCH))
    merged = table._beside(table.read(), spark.createDataFrame([(7, "y", 2, "000000ff"), (7000, "z", 0, "1")], BATCH))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert {r["id"]: r["name"] for r in merged.collect()} == {k: "x" for k in range(40)} | {7: "y", 7000: "z"}


def test_new_rows_beside_stored_ones_make_few_files(spark, tmp_path):
    """A bucket gets one file of new rows, whichever tasks they come from."""
    table = StateTable(spark, str(tmp_path / "s"), buckets=8)
    table.upsert(spark.createDataFrame([(k, "x", 0, f"{k:08x}") for k in range(100)], BATCH))
    table.upsert(spark.createDataFrame([(k, "y", 0, f"{k:08x}") for k in range(50, 2000)], BATCH))
    assert table.read().count() == 2000
    assert len(list(tmp_path.glob("s/*/*/*.parquet"))) <= 2 * 8


@pytest.mark.parametrize("most", [0, state.MOST_ROWS])
def test_upserts_in_any_order(spark, tmp_path, monkeypatch, most):
    """Random changes with ties, null order keys and tombstones, in random portions; broadcast or shuffled."""
    monkeypatch.setattr(state, "MOST_ROWS", most)
    rng = random.Random(most)
    rows = [(rng.randrange(30), f"v{k}", rng.choice([0, 1, 2, 4]), rng.choice([None, f"{rng.randrange(60):x}"])) for k in range(150)]
    table = StateTable(spark, str(tmp_path / "s"), buckets=3)
    for k in range(0, 150, 50):
        table.upsert(spark.createDataFrame(rows[k : k + 50], BATCH))
    want = merge.newest(spark.createDataFrame(rows, BATCH), ("id",)).collect()
    assert sorted(map(tuple, table.read().collect()), key=repr) == sorted(map(tuple, want), key=repr)


# Erasure


def erasable(spark, tmp_path):
    run = Run(spark, tmp_path)
    land(spark, run.base, 1000, ONE)
    land(spark, run.base, 1100, TWO)
    land(spark, run.base, 1200, [(9, "n", 0, "0f1"), (10, "m", 0, "0f2")])
    run()
    names = lambda k: {str(f) for f in Path(run.paths[k]).glob("*/*/*.parquet")}
    return run, names


def test_erase(spark, tmp_path):
    """Only files that hold a subject are rewritten, and nothing brings the subject back."""
    run, names = erasable(spark, tmp_path)
    before = names(0), names(1)
    subject = spark.createDataFrame([(60,), (9,), (4242,)], "id long")
    assert erase(spark, subject, *run.paths[:2])["history"] == 3
    assert {r["id"] for r in run.history().collect()} == {5, 7, 800, 10} and set(run.current()) == {5, 7, 800, 10}
    assert all(r["id"] not in (60, 9) for r in StateTable(spark, run.paths[1]).read().collect())  # tombstones too
    assert len(before[1] & names(1)) >= len(before[1]) - 2  # other buckets keep their files
    again = before[0], names(0)
    assert erase(spark, spark.createDataFrame([(10,)], "id int"), *run.paths[:2]) == {"history": 1, "state": 1}
    assert len(again[1] & names(0)) == 2  # two batches never held the subject
    run.books = spark.createDataFrame([], BOOKS)
    run.n = 0
    run()  # reads every batch again
    land(spark, run.base, 2000, [(9, "back", 0, "0ff"), (11, "new", 0, "0fe")])
    run()
    assert set(run.current()) == {5, 7, 800, 11} and {r["id"] for r in run.history().collect()} == {5, 7, 800, 11}
    assert {r["status"] for r in ingest.recon_only(spark, "t", *run.paths[:2], "d", AT).collect()} == {"OK"}


def test_erase_from_files_of_one_folder(spark, tmp_path):
    """Files of one batch that one task rewrites all keep their other rows."""
    paths = str(tmp_path / "history"), str(tmp_path / "state")
    rows = spark.createDataFrame([(i, "x", 0, f"{i:x}") for i in range(400)], BATCH)
    Plan(spark, paths[0]).extend(rows.schema)
    stored.write_history(rows.withColumns({"load_ts": F.lit(AT), "fingerprint": F.lit("f1"), "batch_ts": F.lit(1000)}).repartition(16, "id"), paths[0])
    StateTable(spark, paths[1], buckets=1).upsert(rows)
    assert erase(spark, spark.range(0, 400, 5), *paths)["history"] == 16
    left = [i for i in range(400) if i % 5]
    assert sorted(r["id"] for r in read_history(spark, paths[0]).collect()) == left
    assert sorted(r["id"] for r in StateTable(spark, paths[1]).read().collect()) == left


@pytest.mark.parametrize("k", [0, 1, 2])
def test_erasure_that_was_cut_short(spark, tmp_path, monkeypatch, k):
    run, names = erasable(spark, tmp_path)
    calls, true = [], stored.move

    def dies(*args):
        if len(calls) == k:
            raise KeyboardInterrupt
        calls.append(true(*args))

    subject = spark.createDataFrame([(60,), (9,)], "id long")
    with monkeypatch.context() as m:
        m.setattr(stored, "move", dies)
        with pytest.raises(KeyboardInterrupt):
            erase(spark, subject, *run.paths[:2])
    erase(spark, subject, *run.paths[:2])
    left = sorted(r["id"] for r in run.history().collect())
    assert left == [5, 5, 7, 10, 800] and set(run.current()) == {5, 7, 800, 10}
    assert not list(tmp_path.glob("*_rewrite*"))


# Rebuild


def test_rebuild(spark, tmp_path, monkeypatch):
    """Readers keep the old table until the switch, whatever happens before it."""
    base, root = str(tmp_path / "landing"), str(tmp_path / "table")
    land(spark, base, 1000, ONE)
    land(spark, base, 1100, TWO)
    manifest = put(tmp_path, {"t": entry("5000", history={"f1": "1"})})
    alive = lambda: {r["id"]: r["name"] for r in StateTable(spark, rebuild.current_generation(spark, root).paths[1]).current().collect()}
    old = rebuild.current_generation(spark, root)
    ingest.ingest_table(spark, base, manifest, "t", spark.createDataFrame([], BOOKS), *old.paths, "r0", AT)
    erase(spark, spark.createDataFrame([(7,)], "id long"), *old.paths[:2])
    StateTable(spark, old.paths[1]).upsert(spark.createDataFrame([(5, "damaged", 2, "ff"), (666, "stray", 0, "1")], BATCH))
    damaged = alive()
    for owner, name in ((ingest, "write_history"), (StateTable, "_merge"), (ingest, "append_recon"), (rebuild.json, "dumps")):
        with monkeypatch.context() as m:
            m.setattr(owner, name, lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
            with pytest.raises(KeyboardInterrupt):
                rebuild.rebuild_table(spark, base, manifest, "t", root, "r1", AT)
        assert alive() == damaged and rebuild.current_generation(spark, root) == old
    books = rebuild.rebuild_table(spark, base, manifest, "t", root, "r1", AT)
    assert alive() == {5: "a2", 800: "d"}  # 7 stays erased
    assert {r["kind"]: str(r["value"]) for r in books.collect()} == {"hwm": "5000", "cursor": "1100", "merge_watermark": "1100"}
    rebuild.drop_old_generations(spark, root)
    assert not Path(old.folder).exists() and alive() == {5: "a2", 800: "d"}
    with pytest.raises(ValueError, match="current generation"):
        rebuild.rebuild_table(spark, base, manifest, "t", root, "r1", AT)


# Audits by bucket


def test_audits_by_bucket_equal_whole_ones(spark, tmp_path):
    """Random damage to a state, with rows that are lost, stale, dead or of unknown keys."""
    rng, path = random.Random(8), str(tmp_path / "history")
    table = StateTable(spark, str(tmp_path / "state"), buckets=8)
    audit = DigestAudit(spark, path, table, str(tmp_path / "digests"))
    Plan(spark, path).extend(spark.createDataFrame([], BATCH).schema)
    changes = [(rng.randrange(120), f"v{k}", rng.choice([0, 1, 2, 2, 4]), f"{k:x}") for k in range(400)]
    verdict = lambda rows: sorted((r["check_name"], r["status"], r["actual"], r["details"]) for r in rows)
    assert audit.run("t", "r", AT).count() == 0
    for k in range(4):
        part = spark.createDataFrame(changes[100 * k : 100 * k + 100], BATCH)
        stored.write_history(part.withColumns({"load_ts": F.lit(AT), "fingerprint": F.lit("f"), "batch_ts": F.lit(k)}), path)
        damage = [(i, "d", rng.choice([0, 2]), f"{rng.randrange(1, 900):x}") for i in rng.sample(range(400 if k % 2 else 120), 4 * k)]
        table.upsert(part.where(F.col("id") % 11 != k).union(spark.createDataFrame(damage, BATCH)))
        whole = verdict(recon.tier_d(read_history(spark, path), table.current(), "t").collect())
        assert verdict(audit.run("t", f"r{k}", datetime(2024, 5, 2 + k)).collect()) == whole
        assert verdict(audit.run("t", f"s{k}", datetime(2024, 5, 2 + k)).collect()) == whole  # nothing has changed
    assert {r[1] for r in whole} == {"MISMATCH"}


def test_unchanged_buckets_are_not_read(spark, tmp_path):
    """The bytes of unchanged buckets are made unreadable under their names, and the audit passes."""
    path, table = str(tmp_path / "history"), StateTable(spark, str(tmp_path / "state"), buckets=4)
    audit = DigestAudit(spark, path, table, str(tmp_path / "digests"))
    Plan(spark, path).extend(spark.createDataFrame([], BATCH).schema)

    def change(rows, batch):
        df = spark.createDataFrame(rows, BATCH)
        stored.write_history(df.withColumns({"load_ts": F.lit(AT), "fingerprint": F.lit("f"), "batch_ts": F.lit(batch)}), path)
        table.upsert(df)

    change([(k, "x", 0, f"{k:x}") for k in range(40)], 1)
    assert {r["status"] for r in audit.run("t", "a", AT).collect()} == {"OK"}
    change([(7, "y", 2, "fff")], 2)
    own = spark.createDataFrame([(7,)], "id long").select(F.pmod(state.key_hash(("id",)), F.lit(4))).first()[0]
    for side in ("state", "digests/narrow"):
        for f in (tmp_path / side).glob("*/*/*.parquet"):
            if f.parent.name != f"__bucket={own}":
                f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
                f.write_bytes(b"junk")
    assert {(r["check_name"], r["status"]) for r in audit.run("t", "b", datetime(2024, 5, 2)).collect()} == {(c, "OK") for c in (*recon.CHECKS, "count_formula")}


# Streams


@pytest.fixture
def streamed(spark, tmp_path):
    base = str(tmp_path / "landing")
    land(spark, base, 1000, ONE, metrics(3))
    land(spark, base, 1100, TWO, metrics(3))
    land(spark, base, 1200, [(9, "n", 0, "0f1", 1.5)], metrics(1), BATCH + ", extra double", "f2")
    manifest = put(tmp_path, {"t": entry("5000", history={"f1": "1", "f2": "2"})})
    paths = [str(tmp_path / f"batch-{x}") for x in ("history", "state", "recon")]
    ingest.ingest_table(spark, base, manifest, "t", spark.createDataFrame([], BOOKS), *paths, "r", AT)
    return base, tuple(str(tmp_path / f"stream-{x}") for x in ("history", "state", "recon")), paths


def contents(spark, paths):
    history = read_history(spark, paths[0]).drop("load_ts")
    state_rows = StateTable(spark, paths[1]).current()
    return [sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr) for df in (history, state_rows)]


@pytest.mark.parametrize("name", ["", "write_history", "audit", "_merge"])
def test_stream_through_history_state_and_audits(spark, tmp_path, monkeypatch, streamed, name):
    """Whatever ends a micro-batch, the restarted stream gives what the ingest of batches gives."""
    base, paths, batch = streamed
    start = lambda: start_ingest_stream(spark, f"{base}/t", "t", paths, str(tmp_path / "ck"), files_at_once=2).awaitTermination()
    if name:
        owner = StateTable if name == "_merge" else ingest
        true, calls = getattr(owner, name), []

        def dies(*args, **kwargs):
            calls.append(true(*args, **kwargs))
            raise RuntimeError("cut short")

        with monkeypatch.context() as m:
            m.setattr(owner, name, dies)
            with pytest.raises(BaseException):  # noqa: B017  what the query's thread makes of it
                start()
    start()
    start()
    assert contents(spark, paths) == contents(spark, batch)
    rows = spark.read.schema(recon.RECON).parquet(paths[2]).collect()
    assert len(rows) == len({(r["run_id"], r["tier"], r["fingerprint"]) for r in rows}) and {r["status"] for r in rows} == {"OK"}
    assert {r["run_id"] for r in rows} == {"stream-0", "stream-1"}


def test_folder_that_arrives_in_pieces(spark, tmp_path):
    folder, paths = f"{tmp_path}/t/f1/1000", tuple(str(tmp_path / x) for x in ("history", "state", "recon"))
    start = lambda: start_ingest_stream(spark, str(tmp_path / "t"), "t", paths, str(tmp_path / "ck")).awaitTermination()
    for rows in (ONE, TWO):
        spark.createDataFrame(rows, BATCH).coalesce(1).write.mode("append").parquet(folder)
        start()
    assert read_history(spark, paths[0]).count() == 6 and StateTable(spark, paths[1]).current().count() == 3
    files = spark.read.format("binaryFile").load(f"{folder}/*.parquet").select("path", "modificationTime")
    ingest_batch("t", "stream", *paths)(files, 1)  # the last micro-batch once more
    assert read_history(spark, paths[0]).count() == 6


# All tables


def test_all_tables(spark, tmp_path):
    base, root = str(tmp_path / "landing"), str(tmp_path / "tables")
    for t, rows in (("a", ONE), ("b", TWO), ("c", ONE)):
        spark.createDataFrame(rows, BATCH).coalesce(1).write.parquet(f"{base}/{t}/f1/1000")
    next(Path(f"{base}/b/f1/1000").glob("*.parquet")).write_bytes(b"junk")
    for f in Path(f"{base}/b/f1/1000").glob(".*.crc"):
        f.unlink()
    manifest = put(tmp_path, {t: entry("1500", n, {"f1": "1"}) for t, n in (("a", 5), ("b", 5_000_000_000), ("c", 200_000_000), ("left", 1))})
    run = lambda books, run_id: launch.ingest_all(spark, base, manifest, books, root, run_id, AT, without="LEFT")
    outcome, books = run(spark.createDataFrame([], BOOKS), "r0")
    got = {r["table_name"]: (r["status"], r["size_class"], bool(r["notes"])) for r in outcome.collect()}
    assert got == {"a": ("DONE", "small", False), "b": ("FAILED", "large", True), "c": ("DONE", "medium", False)}
    assert {r["table_name"] for r in books.collect()} == {"a", "c"}
    assert StateTable(spark, f"{root}/c/first/state").current().count() == 3
    outcome, books = run(books, "r1")  # the failed one is due again
    assert [r["table_name"] for r in outcome.collect()] == ["b"]
    back = books.withColumn("value", F.when(F.col("kind") == "hwm", "9999").otherwise(F.col("value")))
    outcome, same = run(back, "r2")
    assert [tuple(r)[:2] for r in outcome.collect()] == [(None, "RESET")] and same.count() == books.count()
