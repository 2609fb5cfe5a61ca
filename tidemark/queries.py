"""Registry of the change-data queries and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tidemark.functions.keys import size_class
from tidemark.functions.scope import ColumnExclusion, exclude_tables, restricted_view
from tidemark.operators import merge, recon, reports
from tidemark.operators.schema import align
from tidemark.plans import ingest, launch, rebuild
from tidemark.plans.digests import DigestAudit
from tidemark.sources import bookmarks as marks
from tidemark.sources import feed as src
from tidemark.sources import landing
from tidemark.sources.history import erase, read_history, write_history
from tidemark.sources.shared import Plan, delete, found, new_folder
from tidemark.sources.state import StateTable
from tidemark.streaming.upsert import start_ingest_stream

Query = Callable[[SparkSession, str], DataFrame]
BOUND = datetime(1998, 1, 1)
BOUND_MS = 883612800000  # the same in epoch milliseconds
AS_OF = datetime(1998, 6, 1)
AS_OF_MS = 896659200000
RUN_AT = datetime(2002, 1, 1)
SPARK: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return f(spark, sf_dir)

        SPARK[f.__name__] = run
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _newest(where: str, columns: str = "id, seqval_hex, op, amount, status") -> str:
    return f"SELECT {columns}, k FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY k DESC) AS rn FROM feed WHERE {where}) WHERE rn = 1"


UPS = "op IN (0, 2, 4)"
ROW = "id, seqval_hex, op, amount, status"


def _merged(tgt: str, source: str) -> str:
    take = "(t.id IS NULL OR t.k < s.k)"
    cols = ", ".join(f"CASE WHEN {take} THEN s.{c} ELSE t.{c} END AS {c}" for c in (*ROW.split(", "), "k"))
    return f"SELECT {cols} FROM {tgt} t FULL JOIN {source} s ON t.id = s.id".replace(take, "(t.id IS NULL OR (s.id IS NOT NULL AND t.k < s.k))")


def _replay_ctes() -> str:
    out, last = [], None
    for n, fp in enumerate(src.FINGERPRINTS):
        out.append(f"u{n} AS ({_newest(f'{UPS} AND fingerprint = ' + repr(fp))})")
        out.append(f"m{n} AS ({_merged(last, f'u{n}') if last else f'SELECT * FROM u{n}'})")
        out.append(f"c{n} AS (SELECT * FROM m{n} WHERE id NOT IN (SELECT id FROM feed WHERE op = 1 AND fingerprint = {fp!r}))")
        last = f"c{n}"
    return ", ".join(out)


REPLAY = f"WITH {src.FEED_SQL}, {_replay_ctes()}"
LATEST = "latest AS (SELECT id, arg_max(op, k) AS op, max(k) AS seq_key, max(CASE WHEN op IN (0, 2, 4) THEN k END) AS upsert_key FROM feed GROUP BY id)"
LANDING = f"WITH {src.FEED_SQL}, {src.BATCHES_SQL}, {src.METRICS_SQL}, {src.MANIFEST_SQL}, {src.BOOKMARKS_SQL}"
ROLLUP = """rollup_ AS (
  SELECT b.table_name, b.fingerprint, coalesce(sum(m.read), 0)::BIGINT AS read, coalesce(sum(m.written), 0)::BIGINT AS written, coalesce(sum(m.dropped), 0)::BIGINT AS dropped,
         count(m.written) AS ok, count(*) FILTER (m.batch_ts IS NULL) AS n_missing, count(*) FILTER (m.batch_ts IS NOT NULL AND m.written IS NULL) AS n_corrupt,
         string_agg(CASE WHEN m.batch_ts IS NULL THEN b.batch_ts END, ',' ORDER BY b.batch_ts) AS missing,
         string_agg(CASE WHEN m.batch_ts IS NOT NULL AND m.written IS NULL THEN b.batch_ts END, ',' ORDER BY b.batch_ts) AS corrupt
  FROM batches b LEFT JOIN metrics m USING (table_name, fingerprint, batch_ts) GROUP BY ALL)"""
STATUS = "CASE WHEN ok = 0 AND lost > 0 THEN 'METRICS_MISSING' WHEN actual <> expected THEN 'MISMATCH' WHEN lost > 0 THEN 'METRICS_PARTIAL' ELSE 'OK' END"


def _history(spark, d):
    return src.feed(spark, d)


def _replayed(history: DataFrame) -> DataFrame:
    return merge.replay_current(history, src.FINGERPRINTS)


# Merge


@query(f"WITH {src.FEED_SQL} SELECT {ROW}, fingerprint, load_ts FROM feed")
def feed(spark, d):
    return _history(spark, d)


@query(f"WITH {src.FEED_SQL} SELECT {ROW} FROM ({_newest(UPS + ' AND fingerprint = ' + repr('fp_2'))})")
def latest_upserts(spark, d):
    return merge.latest_upserts(_history(spark, d), fingerprint="fp_2")


@query(f"WITH {src.FEED_SQL} SELECT {ROW} FROM ({_newest(UPS + ' AND fingerprint = ' + repr('fp_2') + ' AND load_ts > TIMESTAMP ' + repr('1998-01-01'))})")
def incremental_upserts(spark, d):
    return merge.latest_upserts(_history(spark, d), fingerprint="fp_2", load_ts_after_ms=BOUND_MS)


@query(f"WITH {src.FEED_SQL}, {LATEST} SELECT * FROM latest")
def latest_op(spark, d):
    return merge.latest_op(_history(spark, d))


UPSERT_SQL = f"{REPLAY} SELECT {ROW} FROM ({_merged('u0', 'u1')})"


@query(UPSERT_SQL)
def merge_upsert(spark, d):
    h = _history(spark, d)
    return merge.merge_upsert(merge.latest_upserts(h, fingerprint="fp_1"), merge.latest_upserts(h, fingerprint="fp_2"))


@query(UPSERT_SQL)
def merge_idempotent(spark, d):
    """The same upsert twice."""
    h = _history(spark, d)
    source = merge.latest_upserts(h, fingerprint="fp_2")
    return merge.merge_upsert(merge.merge_upsert(merge.latest_upserts(h, fingerprint="fp_1"), source), source)


@query(f"{REPLAY} SELECT {ROW} FROM ({_merged('u0', 'u1')}) WHERE id NOT IN (SELECT id FROM feed WHERE op = 1 AND fingerprint = 'fp_2')")
def tombstone_delete(spark, d):
    h = _history(spark, d)
    merged = merge.merge_upsert(merge.latest_upserts(h, fingerprint="fp_1"), merge.latest_upserts(h, fingerprint="fp_2"))
    return merge.tombstone_delete(merged, h, fingerprint="fp_2")


@query(f"{REPLAY} SELECT {ROW} FROM c2")
def replay_current(spark, d):
    return _replayed(_history(spark, d))


@query(f"WITH {src.FEED_SQL} SELECT {ROW} FROM ({_newest('true')}) WHERE op <> 1")
def current_state(spark, d):
    return merge.current_state(_history(spark, d))


@query(f"WITH {src.FEED_SQL} SELECT {ROW} FROM ({_newest('load_ts <= TIMESTAMP ' + repr('1998-06-01'))}) WHERE op <> 1")
def state_as_of(spark, d):
    return merge.state_as_of(_history(spark, d), AS_OF)


@query(f"WITH {src.FEED_SQL} SELECT {ROW}, fingerprint, load_ts FROM feed WHERE id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def erase_ids(spark, d):
    subjects = spark.read.parquet(f"{d}/customer.parquet").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("id"))
    return merge.erase_ids(_history(spark, d), subjects)


@query(f"""WITH {src.FEED_SQL}
SELECT id, seqval_hex, op::BIGINT AS op, CASE WHEN fingerprint = 'fp_1' THEN amount::FLOAT::DOUBLE ELSE amount END AS amount,
       CASE WHEN fingerprint <> 'fp_1' THEN status END AS status FROM feed""")
def align_schema(spark, d):
    """The first fingerprint had no status, and a narrower amount."""
    h = _history(spark, d)
    target = StructType([StructField("id", LongType()), StructField("seqval_hex", StringType()), StructField("op", LongType()), StructField("amount", DoubleType()), StructField("status", StringType())])
    early = h.where("fingerprint = 'fp_1'").select("id", "seqval_hex", "op", F.col("amount").cast("float").alias("amount"))
    return align(early, target).union(align(h.where("fingerprint <> 'fp_1'"), target))


@query(f"""WITH {src.FEED_SQL} SELECT id, seqval_hex, op, amount, epoch_ms(load_ts) AS batch_ts, 'fp_2' AS fingerprint, TIMESTAMP '2002-01-01' AS load_ts
FROM feed WHERE fingerprint = 'fp_2' AND load_ts > TIMESTAMP '1998-01-01' AND load_ts <= TIMESTAMP '1998-06-01'""")
def scan_batches(spark, d):
    """Landed files of one fingerprint between two bookmarks, without a column, stamped."""
    base = src.land(_history(spark, d), new_folder(spark, "landing"))
    found = landing.landing_inventory(spark, base).where("fingerprint = 'fp_2'")
    tables = found.select("table_name", "fingerprint").distinct()
    chosen = landing.select_batches(found, tables.withColumn("cursor", F.lit(str(BOUND_MS))), tables.select("table_name", F.lit(str(AS_OF_MS)).alias("hwm")))
    files = chosen.join(found.withColumn("batch_ts", F.col("batch").cast("long")), ["table_name", "fingerprint", "batch_ts"])
    folders = sorted({r["path"].rpartition("/")[0] for r in files.select("path").collect()})
    return landing.scan_batches(spark, folders, "fp_2", RUN_AT, src.CHANGES, ("status",), "batch_ts")


@query(f"WITH {src.FEED_SQL}, {src.BATCHES_SQL} SELECT table_name, fingerprint, batch_ts::VARCHAR AS batch, 1::BIGINT AS files FROM batches")
def landing_inventory(spark, d):
    """The feed's landed files, listed."""
    base = src.land(_history(spark, d), new_folder(spark, "landing"))
    return landing.landing_inventory(spark, base).groupBy("table_name", "fingerprint", "batch").agg(F.count(F.lit(1)).alias("files"))


@query(f"""WITH {src.FEED_SQL}, {src.BATCHES_SQL}, {src.MANIFEST_SQL}
SELECT table_name, hwm, record_count, 'cda/' || table_name AS data_path, (SELECT count(DISTINCT fingerprint)::INT FROM batches b WHERE b.table_name = m.table_name) AS fingerprints FROM manifest m""")
def read_manifest(spark, d):
    """The feed's manifest, written as JSON and read again."""
    path = src.write_manifest(src.manifest(src.batches(_history(spark, d))), new_folder(spark, "manifest"))
    return landing.read_manifest(spark, path).withColumn("fingerprints", F.size("schema_history")).drop("schema_history")


OF_ALL = "SELECT *, row_number() OVER (PARTITION BY status, id ORDER BY k DESC) AS rn FROM feed"


def _ingested(spark, d) -> tuple[str, list[str]]:
    """Two runs of all tables from landed files with metrics, a batch for each year, the first up to half of them: the folder and the tables."""
    history, folder = _history(spark, d).withColumn("load_ts", F.date_trunc("year", "load_ts")), new_folder(spark, "ingest")
    base, batches = src.land(history, f"{folder}/landing"), src.batches(history)
    src.land_metrics(src.metrics(batches), base)
    manifest, books = src.manifest(batches), spark.createDataFrame([], ingest.MARKS)
    for n, hwm in enumerate((F.lit(str(BOUND_MS)), F.col("hwm"))):
        path = src.write_manifest(manifest.withColumn("hwm", hwm), f"{folder}/manifest-{n}")
        outcome, books = launch.ingest_all(spark, base, path, books, f"{folder}/tables", f"run-{n}", RUN_AT + timedelta(days=n), at_once=5)
    delete(spark, base)  # landed copies are of no more use
    return f"{folder}/tables", sorted(r["table_name"] for r in outcome.collect())


@query(f"WITH {src.FEED_SQL} SELECT {ROW} FROM ({OF_ALL}) WHERE rn = 1 AND op <> 1")
def ingest_table(spark, d):
    """Current rows of all tables after two runs."""
    root, tables = _ingested(spark, d)
    return ingest.united([StateTable(spark, f"{root}/{t}/first/state").current() for t in tables])


BY_YEAR = LANDING.replace("date_trunc('month'", "date_trunc('year'")


@query(f"""{BY_YEAR}, runs(run_id, lo, hi, committed_at) AS (VALUES ('run-0', 0, {BOUND_MS}, TIMESTAMP '2002-01-01'), ('run-1', {BOUND_MS}, 9223372036854775807, TIMESTAMP '2002-01-02')),
each AS (SELECT r.*, b.table_name, b.fingerprint, landed, m.read, m.written, m.dropped, m.batch_ts IS NOT NULL AS has, b.batch_ts > lo AS own
  FROM runs r JOIN batches b ON b.batch_ts <= hi LEFT JOIN metrics m USING (table_name, fingerprint, batch_ts)),
sums AS (
  SELECT run_id, committed_at, table_name, fingerprint, 'A' AS tier, 'landed_vs_reported' AS check_name, sum(landed) AS actual, coalesce(sum(written), 0) AS expected, coalesce(sum(read), 0) AS read, coalesce(sum(dropped), 0) AS dropped,
         count(written) AS ok, count(*) - count(written) AS lost FROM each WHERE own GROUP BY ALL
  UNION ALL SELECT run_id, committed_at, table_name, NULL, 'B', 'cumulative', sum(landed), coalesce(sum(written), 0), NULL, NULL, count(written), count(*) - count(written) FROM each GROUP BY ALL)
SELECT run_id, committed_at, table_name, fingerprint, tier, check_name, {STATUS} AS status, expected::BIGINT AS expected, actual::BIGINT AS actual, (actual - expected)::BIGINT AS delta,
       CASE WHEN tier = 'A' THEN '{{"numRecordsRead":' || read || ',"numRecordsDropped":' || dropped || ',"ok":' || ok || ',"lost":' || lost || '}}' END AS details, NULL::VARCHAR AS notes FROM sums""")
def ingest_audits(spark, d):
    """The audit rows of the same two runs: each run's own batches, and all up to it."""
    root, tables = _ingested(spark, d)
    return ingest.united([spark.read.schema(recon.RECON).parquet(f"{root}/{t}/first/recon") for t in tables]).select(recon.COLUMNS)


@query(f"""WITH {src.FEED_SQL}, gone AS (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'), left_ AS (SELECT * FROM feed WHERE id NOT IN (SELECT c_custkey FROM gone))
SELECT 'history' AS side, {ROW}, fingerprint, epoch_ms(load_ts) AS batch_ts FROM left_
UNION ALL SELECT 'state', {ROW}, NULL, NULL FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY k DESC) AS rn FROM left_) WHERE rn = 1 AND op <> 1""")
def erase_stored(spark, d):
    """Stored history and state after the erasure of subjects from both tables' files."""
    folder, history = new_folder(spark, "erase"), src.with_batches(_history(spark, d))
    paths = f"{folder}/history", f"{folder}/state"
    Plan(spark, paths[0]).extend(src.CHANGES)
    write_history(history, paths[0])
    state = StateTable(spark, paths[1])
    state.upsert(history.select(src.CHANGES.fieldNames()))
    subjects = spark.read.parquet(f"{d}/customer.parquet").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("id"))
    erase(spark, subjects, *paths)
    rows = ROW.split(", ")
    kept = read_history(spark, paths[0]).select(F.lit("history").alias("side"), *rows, "fingerprint", "batch_ts")
    return kept.unionByName(state.current().select(F.lit("state").alias("side"), *rows), allowMissingColumns=True)


@query(f"WITH {src.FEED_SQL} SELECT {ROW} FROM ({_newest('status = ' + repr('2-HIGH'))}) WHERE op <> 1")
def rebuild_table(spark, d):
    """Current rows of a table that was built anew from its landed files."""
    history, folder = _history(spark, d).where("status = '2-HIGH'"), new_folder(spark, "rebuild")
    base = src.land(history, f"{folder}/landing")
    path = src.write_manifest(src.manifest(src.batches(history)), f"{folder}/manifest")
    rebuild.rebuild_table(spark, base, path, "2-HIGH", f"{folder}/table", "second", RUN_AT)
    delete(spark, base)
    return StateTable(spark, rebuild.current_generation(spark, f"{folder}/table").paths[1]).current()


@query(f"WITH {src.FEED_SQL} SELECT {ROW} FROM ({_newest('status = ' + repr('2-HIGH'))}) WHERE op <> 1")
def stream_ingest(spark, d):
    """Current rows of a table whose landed files went through a stream, two thirds of them at first."""
    history, folder = _history(spark, d).where("status = '2-HIGH'"), new_folder(spark, "stream")
    base = src.land(history, f"{folder}/landing")
    files = -(-2 * len(found(spark, f"{base}/*/*/*/*.parquet")) // 3)
    paths = tuple(f"{folder}/{x}" for x in ("history", "state", "recon"))
    start_ingest_stream(spark, f"{base}/table_name=2-high", "2-high", paths, f"{folder}/checkpoint", files_at_once=files).awaitTermination()
    delete(spark, base)
    return StateTable(spark, paths[1]).current()


@query(f"WITH {src.FEED_SQL} SELECT {ROW}, fingerprint, load_ts FROM feed WHERE id = 7")
def key_history(spark, d):
    return merge.key_history(_history(spark, d), 7)


@query(f"WITH {src.FEED_SQL} SELECT fingerprint, count(*) AS n_rows, count(DISTINCT load_ts) AS files FROM feed GROUP BY 1")
def partition_stats(spark, d):
    """Of a stored history with one file for each batch."""
    path = new_folder(spark, "history")
    write_history(src.with_batches(_history(spark, d)).repartition("fingerprint"), path)
    return landing.partition_stats(spark.read.parquet(path))


# Scope


@query(f"WITH {src.FEED_SQL} SELECT id, seqval_hex, op, fingerprint, load_ts, status FROM feed")
def exclude_columns(spark, d):
    return ColumnExclusion("Orders:AMOUNT, other:status").apply(_history(spark, d), "orders")


@query(f"{LANDING} SELECT table_name FROM manifest WHERE table_name NOT IN ('1-urgent', '5-low') ORDER BY 1")
def exclude_tables_(spark, d):
    return exclude_tables(src.manifest(src.batches(_history(spark, d))), " 1-URGENT ,5-low").select("table_name").orderBy("table_name")


SPARK["exclude_tables"], SQL["exclude_tables"] = SPARK.pop("exclude_tables_"), SQL.pop("exclude_tables_")


@query(f"WITH {src.FEED_SQL} SELECT id, status FROM ({_newest('true')}) WHERE op <> 1")
def restricted_view_(spark, d):
    return restricted_view(merge.current_state(_history(spark, d)), ["id", "status"])


SPARK["restricted_view"], SQL["restricted_view"] = SPARK.pop("restricted_view_"), SQL.pop("restricted_view_")


@query(f"WITH {src.FEED_SQL} SELECT {ROW} FROM ({_newest('true')}) WHERE op <> 1 AND status = '2-HIGH' ORDER BY id LIMIT 100")
def filter_current(spark, d):
    return merge.current_state(_history(spark, d)).where("status = '2-HIGH'").orderBy("id").limit(100)


# Landing and bookmarks


def _landed(spark, d):
    return src.batches(_history(spark, d))


EFFECTIVE = """effective AS (
  SELECT s.table_name, s.fingerprint, coalesce(c.value, h.value) AS cursor, w.value AS merge_watermark FROM spans s
  LEFT JOIN bookmarks c ON c.kind = 'cursor' AND c.table_name = s.table_name AND c.fingerprint = s.fingerprint
  LEFT JOIN bookmarks w ON w.kind = 'merge_watermark' AND w.table_name = s.table_name AND w.fingerprint = s.fingerprint
  LEFT JOIN bookmarks h ON h.kind = 'hwm' AND h.table_name = s.table_name)"""


@query(f"""{LANDING}, {EFFECTIVE} SELECT b.table_name, b.fingerprint, b.batch_ts FROM batches b JOIN effective e USING (table_name, fingerprint) JOIN manifest m USING (table_name)
WHERE b.batch_ts > e.cursor::BIGINT AND b.batch_ts <= m.hwm::BIGINT""")
def select_batches(spark, d):
    landed = _landed(spark, d)
    manifest, books = src.manifest(landed), src.bookmarks(landed)
    effective = marks.effective_cursor(books, landed.select("table_name", "fingerprint").distinct())
    return landing.select_batches(src.inventory(landed), effective, manifest)


@query(f"{LANDING} SELECT table_name, fingerprint, lo AS first_seen, row_number() OVER (PARTITION BY table_name ORDER BY lo, fingerprint)::INT AS place FROM spans")
def fingerprint_order(spark, d):
    return landing.fingerprint_order(src.manifest(_landed(spark, d)))


@query(f"{LANDING}, {EFFECTIVE} SELECT * FROM effective")
def effective_cursor(spark, d):
    landed = _landed(spark, d)
    return marks.effective_cursor(src.bookmarks(landed), landed.select("table_name", "fingerprint").distinct())


NEW_MARKS = "SELECT table_name, fingerprint, 'cursor' AS kind, (lo + 86400000)::VARCHAR AS value FROM spans UNION ALL SELECT table_name, NULL, 'hwm', hwm FROM manifest"


@query(f"{LANDING} SELECT table_name, fingerprint, kind, max(value::BIGINT) AS value FROM (SELECT * FROM bookmarks UNION ALL {NEW_MARKS}) GROUP BY ALL")
def bookmark_max_merge(spark, d):
    landed = _landed(spark, d)
    lo = landed.groupBy("table_name", "fingerprint").agg((F.min("batch_ts") + 86_400_000).cast("string").alias("value")).withColumn("kind", F.lit("cursor"))
    hwm = src.manifest(landed).select("table_name", F.lit(None).cast("string").alias("fingerprint"), F.lit("hwm").alias("kind"), F.col("hwm").alias("value"))
    return marks.bookmark_max_merge(src.bookmarks(landed), lo.unionByName(hwm))


RESET = """resets AS (
  SELECT m.table_name, CASE WHEN m.hwm::BIGINT < h.value::BIGINT THEN 'hwm_regression' WHEN p.gone IS NOT NULL THEN 'fingerprint_pruned' END AS kind,
         CASE WHEN m.hwm::BIGINT < h.value::BIGINT THEN m.hwm || '<' || h.value ELSE p.gone END AS detail
  FROM manifest m LEFT JOIN bookmarks h ON h.kind = 'hwm' AND h.table_name = m.table_name
  LEFT JOIN (SELECT table_name, string_agg(fingerprint, ',' ORDER BY fingerprint) AS gone FROM bookmarks b WHERE kind = 'cursor'
             AND NOT EXISTS (SELECT 1 FROM spans s WHERE s.table_name = b.table_name AND s.fingerprint = b.fingerprint) GROUP BY 1) p ON p.table_name = m.table_name)"""


@query(f"{LANDING}, {RESET} SELECT * FROM resets WHERE kind IS NOT NULL")
def detect_reset(spark, d):
    landed = _landed(spark, d)
    return marks.detect_reset(src.manifest(landed), src.bookmarks(landed))


CHANGED = """changed AS (
  SELECT m.table_name, m.hwm::BIGINT AS ts, CASE WHEN record_count >= 4000 THEN 'large' WHEN record_count >= 3000 THEN 'medium' ELSE 'small' END AS size_class
  FROM manifest m LEFT JOIN bookmarks h ON h.kind = 'hwm' AND h.table_name = m.table_name
  WHERE m.table_name NOT IN ('1-urgent', '5-low') AND (h.value IS NULL OR m.hwm::BIGINT > h.value::BIGINT))"""


@query(f"""{LANDING}, {RESET}, {CHANGED}, head AS (SELECT CASE WHEN (SELECT count(kind) FROM resets WHERE table_name NOT IN ('1-urgent', '5-low')) > 0 THEN 'RESET' WHEN (SELECT count(*) FROM changed) = 0 THEN 'STOP' ELSE 'START' END AS status)
SELECT status, table_name, ts, size_class FROM head LEFT JOIN changed ON status = 'START'""")
def launch_decision(spark, d):
    """The tables that were reset are left out, so the rest may start."""
    landed = _landed(spark, d)
    return marks.launch_decision(src.manifest(landed), src.bookmarks(landed), "1-urgent,5-low", medium=3000, large=4000)


@query(f"{LANDING} SELECT table_name, record_count, CASE WHEN record_count >= 3020 THEN 'large' WHEN record_count >= 2980 THEN 'medium' ELSE 'small' END AS size_class FROM manifest")
def size_class_(spark, d):
    return src.manifest(_landed(spark, d)).select("table_name", "record_count", size_class(F.col("record_count"), 2980, 3020).alias("size_class"))


SPARK["size_class"], SQL["size_class"] = SPARK.pop("size_class_"), SQL.pop("size_class_")


# Reconciliation


def _rollup(landed):
    return landing.batch_metrics_rollup(landed, src.metrics(landed))


@query(f"{LANDING}, {ROLLUP} SELECT table_name, fingerprint, read, written, dropped, ok, coalesce(missing, '') AS missing, coalesce(corrupt, '') AS corrupt FROM rollup_")
def batch_metrics_rollup(spark, d):
    listed = lambda c: F.array_join(c, ",").alias(c)
    return _rollup(_landed(spark, d)).select("table_name", "fingerprint", "read", "written", "dropped", "ok", listed("missing"), listed("corrupt"))


AUDIT = "run_id, committed_at, table_name, fingerprint, tier, check_name, status, expected, actual, actual - expected AS delta, details, NULL::VARCHAR AS notes"


@query(f"""{LANDING}, {ROLLUP}, t AS (
  SELECT r.*, n_missing + n_corrupt AS lost, written AS expected, (SELECT sum(landed)::BIGINT FROM batches b WHERE b.table_name = r.table_name AND b.fingerprint = r.fingerprint) AS actual FROM rollup_ r),
u AS (SELECT *, 'run' AS run_id, TIMESTAMP '2002-01-01' AS committed_at, 'A' AS tier, 'landed_vs_reported' AS check_name, {STATUS} AS status,
  '{{"numRecordsRead":' || read || ',"numRecordsDropped":' || dropped || ',"ok":' || ok || ',"lost":' || lost || '}}' AS details FROM t)
SELECT {AUDIT} FROM u""")
def recon_tier_a(spark, d):
    landed = _landed(spark, d)
    counts = landed.groupBy("table_name", "fingerprint").agg(F.sum("landed").alias("landed"))
    return recon.recon_rows(recon.tier_a(counts, _rollup(landed)), "run", RUN_AT)


@query(f"""{LANDING}, {ROLLUP}, t AS (
  SELECT table_name, sum(written)::BIGINT AS expected, sum(n_missing + n_corrupt) AS lost, sum(ok) AS ok FROM rollup_ GROUP BY 1),
u AS (SELECT t.*, (SELECT sum(landed)::BIGINT FROM batches b WHERE b.table_name = t.table_name) AS actual FROM t),
w AS (SELECT *, 'run' AS run_id, TIMESTAMP '2002-01-01' AS committed_at, NULL::VARCHAR AS fingerprint, 'B' AS tier, 'cumulative' AS check_name, {STATUS} AS status, NULL::VARCHAR AS details FROM u)
SELECT {AUDIT} FROM w""")
def recon_tier_b(spark, d):
    landed = _landed(spark, d)
    counts = landed.groupBy("table_name").agg(F.sum("landed").alias("actual"))
    return recon.recon_rows(recon.tier_b(_rollup(landed), counts), "run", RUN_AT)


@query(f"{REPLAY}, {LATEST} SELECT id FROM c2 WHERE id IN (SELECT id FROM latest WHERE op = 1)")
def inv_tombstone(spark, d):
    h = _history(spark, d)
    return recon.inv_tombstone(merge.latest_op(h), _replayed(h))


@query(f"{REPLAY}, {LATEST} SELECT c2.id FROM c2 JOIN latest USING (id) WHERE k <> upsert_key")
def inv_latest_seqval(spark, d):
    h = _history(spark, d)
    return recon.inv_latest_seqval(merge.latest_op(h), _replayed(h))


@query(f"{REPLAY} SELECT id FROM c2 WHERE id NOT IN (SELECT id FROM feed WHERE fingerprint <> 'fp_3')")
def inv_no_orphans(spark, d):
    """Current rows against a history that lost its last fingerprint."""
    h = _history(spark, d)
    return recon.inv_no_orphans(merge.latest_op(h.where("fingerprint <> 'fp_3'")), _replayed(h))


@query(f"{REPLAY}, {LATEST} SELECT abs((SELECT count(*) FROM c2) - (SELECT count(*) FROM latest WHERE {UPS})) AS violations")
def inv_count_formula(spark, d):
    h = _history(spark, d)
    return recon.inv_count_formula(merge.latest_op(h), _replayed(h))


@query(f"{REPLAY}, {LATEST} SELECT abs((SELECT count(*) FROM c2) - (SELECT count(*) FROM feed WHERE id IN (SELECT id FROM latest WHERE {UPS}))) AS violations")
def inv_count_formula_as_coded(spark, d):
    h = _history(spark, d)
    return recon.inv_count_formula(merge.latest_op(h), _replayed(h), h)


TIER_D = f"""{REPLAY}, {LATEST}, bad AS (
  SELECT 'tombstone' AS check_name, id FROM c2 WHERE id IN (SELECT id FROM latest WHERE op = 1)
  UNION ALL SELECT 'latest_seqval', c2.id FROM c2 JOIN latest USING (id) WHERE k <> upsert_key
  UNION ALL SELECT 'no_orphans', id FROM c2 WHERE id NOT IN (SELECT id FROM latest)),
placed AS (SELECT *, row_number() OVER (PARTITION BY check_name ORDER BY id) AS place FROM bad),
v AS (
  SELECT c.check_name, count(b.id) AS actual, '[' || string_agg('{{"id":' || b.id || '}}', ',' ORDER BY b.id) FILTER (b.place <= 10) || ']' AS details
  FROM (VALUES ('tombstone'), ('latest_seqval'), ('no_orphans')) c(check_name) LEFT JOIN placed b USING (check_name) GROUP BY 1
  UNION ALL SELECT 'count_formula', abs((SELECT count(*) FROM c2) - (SELECT count(*) FROM latest WHERE {UPS})), NULL),
u AS (SELECT *, 'run' AS run_id, TIMESTAMP '2002-01-01' AS committed_at, 'customer' AS table_name, NULL::VARCHAR AS fingerprint, 'D' AS tier, CASE WHEN actual = 0 THEN 'OK' ELSE 'MISMATCH' END AS status, 0::BIGINT AS expected FROM v)
SELECT {AUDIT} FROM u"""


@query(TIER_D)
def recon_tier_d(spark, d):
    h = _history(spark, d)
    return recon.recon_rows(recon.tier_d(h, _replayed(h), "customer"), "run", RUN_AT)


@query(TIER_D)
def recon_tier_d_by_bucket(spark, d):
    """The same from stored tables, by digests of buckets: once after the first batches, then what has changed."""
    h, folder = src.with_batches(_history(spark, d)), new_folder(spark, "digests")
    path, state = f"{folder}/history", StateTable(spark, f"{folder}/state")
    Plan(spark, path).extend(src.CHANGES)
    checks = DigestAudit(spark, path, state, f"{folder}/digests")
    write_history(h.where("fingerprint = 'fp_1'"), path)
    state.upsert(merge.latest_upserts(h, fingerprint="fp_1").select(src.CHANGES.fieldNames()))
    checks.run("customer", "first", RUN_AT)
    write_history(h.where("fingerprint <> 'fp_1'"), path)
    whole = StateTable(spark, f"{folder}/replayed", buckets=state.plan.read()[1]["buckets"])
    whole.upsert(_replayed(h).select(src.CHANGES.fieldNames()))
    return DigestAudit(spark, path, whole, f"{folder}/digests").run("customer", "run", RUN_AT)


@query(f"""{LANDING}, h AS (SELECT table_name, 'h' || batch_ts || fingerprint AS snapshot_id, load_ts AS ts FROM batches),
c AS (SELECT DISTINCT table_name, 'c' || epoch_ms(date_trunc('quarter', load_ts)) AS snapshot_id, date_trunc('quarter', load_ts) - INTERVAL 10 DAY AS ts FROM batches)
SELECT c.table_name, c.snapshot_id AS current_snapshot, c.ts,
       (SELECT arg_max(h.snapshot_id, (h.ts, h.snapshot_id)) FROM h WHERE h.table_name = c.table_name AND h.ts <= c.ts) AS history_snapshot FROM c""")
def snapshot_pairing(spark, d):
    landed = _landed(spark, d)
    h = landed.select("table_name", F.concat(F.lit("h"), "batch_ts", "fingerprint").alias("snapshot_id"), F.col("load_ts").alias("ts"))
    quarter = F.date_trunc("quarter", "load_ts")
    c = landed.select("table_name", F.concat(F.lit("c"), F.unix_millis(quarter)).alias("snapshot_id"), (quarter - F.expr("INTERVAL 10 DAYS")).alias("ts")).distinct()
    return recon.snapshot_pairing(h, c)


# Reports


def recon_log(spark, d) -> DataFrame:
    """Audit rows of a run each month: tier A of each batch, and tier D of each table."""
    landed = _landed(spark, d)
    both = landed.join(src.metrics(landed), ["table_name", "fingerprint", "batch_ts"], "left")
    run_id, at = F.concat(F.lit("run-"), F.col("month")), F.col("load_ts") + F.expr("INTERVAL 1 DAY")
    lost = F.col("written").isNull()
    status = F.when(lost, "METRICS_MISSING").when(F.col("landed") != F.col("written"), "MISMATCH").otherwise("OK")
    details = F.when(~lost, F.to_json(F.struct(F.col("read").alias("numRecordsRead"), F.col("dropped").alias("numRecordsDropped"))))
    a = both.select(
        "table_name", "fingerprint", F.lit("A").alias("tier"), F.lit("landed_vs_reported").alias("check_name"), status.alias("status"),
        F.coalesce("written", F.lit(0)).alias("expected"), F.col("landed").alias("actual"), details.alias("details"), run_id.alias("r"), at.alias("t"),
    )
    some = landed.groupBy("table_name", "month", "load_ts").agg((F.sum("tombstones") % 3).alias("bad"))
    dd = some.select(
        "table_name", F.lit(None).cast("string").alias("fingerprint"), F.lit("D").alias("tier"), F.lit("tombstone").alias("check_name"), F.when(F.col("bad") == 0, "OK").otherwise("MISMATCH").alias("status"),
        F.lit(0).cast("long").alias("expected"), F.col("bad").alias("actual"), F.lit(None).cast("string").alias("details"), run_id.alias("r"), at.alias("t"),
    )
    return recon.recon_rows(a.unionByName(dd), F.col("r"), F.col("t"))


LOG = f"""{LANDING}, log0 AS (
  SELECT b.table_name, b.fingerprint, 'A' AS tier, 'landed_vs_reported' AS check_name, CASE WHEN written IS NULL THEN 'METRICS_MISSING' WHEN landed <> written THEN 'MISMATCH' ELSE 'OK' END AS status,
         coalesce(written, 0)::BIGINT AS expected, landed AS actual, CASE WHEN written IS NOT NULL THEN '{{"numRecordsRead":' || read || ',"numRecordsDropped":' || dropped || '}}' END AS details,
         'run-' || month AS run_id, load_ts + INTERVAL 1 DAY AS committed_at
  FROM batches b LEFT JOIN metrics m USING (table_name, fingerprint, batch_ts)
  UNION ALL SELECT table_name, NULL, 'D', 'tombstone', CASE WHEN sum(tombstones) % 3 = 0 THEN 'OK' ELSE 'MISMATCH' END, 0, (sum(tombstones) % 3)::BIGINT, NULL, 'run-' || month, load_ts + INTERVAL 1 DAY
  FROM batches GROUP BY table_name, month, load_ts),
log AS (SELECT {AUDIT} FROM log0),
last AS (SELECT * FROM log WHERE run_id = (SELECT arg_max(run_id, (committed_at, run_id)) FROM log))"""


@query(f"{LOG} SELECT * FROM last WHERE status NOT IN ('OK', 'METRICS_PARTIAL')")
def recon_failures(spark, d):
    return reports.recon_failures(recon_log(spark, d))


@query(f"{LOG} SELECT date_trunc('day', committed_at) AS day, table_name, sum((details::JSON->>'numRecordsDropped')::BIGINT)::BIGINT AS dropped, sum(actual)::BIGINT AS landed FROM log WHERE tier = 'A' GROUP BY ALL")
def recon_drop_rate(spark, d):
    return reports.recon_drop_rate(recon_log(spark, d))


@query(f"{LOG} SELECT table_name, max(committed_at) AS last_committed FROM log GROUP BY 1")
def table_coverage(spark, d):
    return reports.table_coverage(recon_log(spark, d))


@query(f"{LOG} SELECT table_name, max(committed_at) AS last_committed FROM log WHERE tier = 'A' AND status = 'MISMATCH' GROUP BY 1 HAVING max(committed_at) < TIMESTAMP '2001-08-03' - INTERVAL 1 DAY")
def stale_tables(spark, d):
    bad = recon_log(spark, d).where("tier = 'A' and status = 'MISMATCH'")
    return reports.stale_tables(bad, F.lit(datetime(2001, 8, 3)))


@query(f"{LOG} SELECT count(DISTINCT table_name) AS tables FROM log")
def tables_loaded(spark, d):
    return reports.tables_loaded(recon_log(spark, d))


@query(f"{LOG} SELECT count(DISTINCT table_name) AS tables, count(*) AS checks FROM log WHERE committed_at >= TIMESTAMP '2001-06-01'")
def tables_loaded_since(spark, d):
    return reports.tables_loaded_since(recon_log(spark, d), F.lit(datetime(2001, 6, 1)))


@query(f"{LOG} SELECT status, count(*) AS n FROM last GROUP BY 1")
def run_status_summary(spark, d):
    return reports.run_status_summary(recon_log(spark, d))


@query(f"{LOG} SELECT count(*) AS n FROM log WHERE status NOT IN ('OK', 'METRICS_PARTIAL')")
def bad_rows(spark, d):
    return reports.bad_rows(recon_log(spark, d))


@query(f"{LOG} SELECT check_name, status, count(*) AS n FROM log GROUP BY ALL")
def check_status_matrix(spark, d):
    return reports.check_status_matrix(recon_log(spark, d))


@query(f"{LOG} SELECT * FROM log WHERE tier = 'D' AND status <> 'OK' ORDER BY committed_at DESC, table_name, check_name LIMIT 100")
def tier_d_violations(spark, d):
    return reports.tier_d_violations(recon_log(spark, d))


@query(f"WITH {src.FEED_SQL} SELECT date_trunc('day', load_ts)::TIMESTAMP AS day, count(*) AS n FROM feed GROUP BY 1")
def rows_per_load_day(spark, d):
    return reports.rows_per_load_day(_history(spark, d))


@query(f"""WITH {src.JOBS_SQL}, t AS (SELECT *, coalesce(duration, updated - created) AS s FROM jobs),
r AS (SELECT s, row_number() OVER (ORDER BY s) - 1 AS i, count(*) OVER () AS m FROM t WHERE state = 'SUCCESS' AND s IS NOT NULL)
SELECT (SELECT count(*) FROM t WHERE state = 'SUCCESS') AS success, (SELECT count(*) FROM t WHERE state = 'FAILED') AS failed, (SELECT count(*) FROM t WHERE state = 'CANCELLED') AS cancelled,
       min(s) AS min_s, max(s) AS max_s, sum(round(s * 1000)::BIGINT)::BIGINT AS total_ms,
       min(s) FILTER (i = least(m - 1, floor(0.5::DOUBLE * m)::BIGINT)) AS p50_s, min(s) FILTER (i = least(m - 1, floor(0.9::DOUBLE * m)::BIGINT)) AS p90_s, min(s) FILTER (i = least(m - 1, floor(0.99::DOUBLE * m)::BIGINT)) AS p99_s FROM r""")
def job_timing_percentiles(spark, d):
    return reports.job_timing(src.job_runs(spark, d))


@query(f"WITH {src.JOBS_SQL} SELECT name, event_id, coalesce(duration, updated - created) AS seconds FROM jobs WHERE state = 'SUCCESS' ORDER BY seconds DESC, name, event_id LIMIT 10")
def slowest_jobs(spark, d):
    return reports.slowest_jobs(src.job_runs(spark, d))


def queries() -> dict[str, Query]:
    return dict(SPARK)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
