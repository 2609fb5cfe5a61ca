"""A change feed, and the landing and job frames around it, derived from the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructType

from tidemark.sources.shared import delete, found, move

FINGERPRINTS = ["fp_1", "fp_2", "fp_3"]
CHANGES = StructType().add("id", LongType()).add("seqval_hex", StringType()).add("op", IntegerType()).add("amount", DoubleType()).add("status", StringType())


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History rows: each order is a change of its customer."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    op = F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 7 == 0), 1).when(F.col("o_orderstatus") == "O", 0).when(F.col("o_orderstatus") == "P", 2).otherwise(4)
    day = F.col("o_orderdate").cast("timestamp")
    fingerprint = F.when(day < F.lit("1997-01-01").cast("timestamp"), "fp_1").when(day < F.lit("1999-06-01").cast("timestamp"), "fp_2").otherwise("fp_3")
    return o.select(
        F.col("o_custkey").alias("id"),
        F.lower(F.hex("o_orderkey")).alias("seqval_hex"),
        op.alias("op"),
        fingerprint.alias("fingerprint"),
        F.date_trunc("month", day).alias("load_ts"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("status"),
    )


def batches(history: DataFrame) -> DataFrame:
    """Landed batches: a table for each status, a batch for each fingerprint and month."""
    out = history.groupBy(F.lower("status").alias("table_name"), "fingerprint", "load_ts").agg(F.count(F.lit(1)).alias("landed"), F.count_if(F.col("op") == 1).alias("tombstones"))
    month = F.year("load_ts") * 12 + F.month("load_ts")
    return out.withColumn("batch_ts", F.unix_millis("load_ts")).withColumn("month", month)


def land(history: DataFrame, base: str) -> str:
    """Writes history's changes as landed files, a folder for each batch; returns ``base``."""
    table, batch = F.lower("status").alias("table_name"), F.unix_millis("load_ts").alias("batch")
    dealt = history.select(*CHANGES.fieldNames(), table, "fingerprint", batch).repartition("table_name", "fingerprint", "batch")
    dealt.write.partitionBy("table_name", "fingerprint", "batch").parquet(base)
    return base


def with_batches(history: DataFrame) -> DataFrame:
    """History rows with the number of their batch, as stored history has it."""
    return history.withColumn("batch_ts", F.unix_millis("load_ts"))


def land_metrics(reported: DataFrame, base: str) -> None:
    """Writes metrics (as ``metrics`` makes them) into their batches' folders; corrupt ones are cut short."""
    spark, made = reported.sparkSession, f"{base}_metrics"
    whole = F.to_json(F.struct(F.col("table_name").alias("tableName"), F.col("read").alias("numRecordsRead"), F.col("written").alias("numRecordsWritten"), F.col("dropped").alias("numRecordsDropped")))
    rows = reported.select(F.when(F.col("written").isNull(), "{").otherwise(whole).alias("value"), "table_name", "fingerprint", F.col("batch_ts").alias("batch"))
    rows.coalesce(1).write.partitionBy("table_name", "fingerprint", "batch").text(made)
    for path in found(spark, f"{made}/*/*/*/part-*"):  # a file for each batch
        folder = "/".join(path.split("/")[-4:-1])
        move(spark, path, f"{base}/{folder}/.cda/batch-metrics.json")
    delete(spark, made)


def write_manifest(tables: DataFrame, path: str) -> str:
    """Writes a manifest (as ``manifest`` makes it) as one JSON object; returns ``path``."""
    entry = F.struct(
        F.col("hwm").alias("lastSuccessfulWriteTimestamp"), F.col("record_count").alias("totalProcessedRecordsCount"),
        F.concat(F.lit("s3://bucket/cda/"), "table_name").alias("dataFilesPath"), F.col("schema_history").alias("schemaHistory"),
    )
    whole = tables.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("table_name", entry)))).alias("value"))
    whole.coalesce(1).write.text(path)
    return path


def metrics(landed: DataFrame) -> DataFrame:
    """Metrics of batches, by rule: every 11th month has none, every 13th is corrupt, every 5th off by one."""
    written = F.col("landed") + (F.col("month") % 5 == 0).cast("long")
    good = F.col("month") % 13 != 0
    return landed.where("month % 11 <> 0").select(
        "table_name",
        "fingerprint",
        "batch_ts",
        F.when(good, written + F.col("landed") % 3).alias("read"),
        F.when(good, written).alias("written"),
        F.when(good, F.col("landed") % 3).alias("dropped"),
    )


def inventory(landed: DataFrame) -> DataFrame:
    """Folder names, with some that are no batch."""
    odd = landed.select("table_name", "fingerprint", F.explode(F.array(F.lit(".cda"), F.lit("12 "), F.lit("1.5"))).alias("batch")).distinct()
    return landed.select("table_name", "fingerprint", F.col("batch_ts").cast("string").alias("batch")).union(odd)


def manifest(landed: DataFrame) -> DataFrame:
    """table_name, hwm, record_count and schema_history of each table."""
    seen = landed.groupBy("table_name", "fingerprint").agg(F.min("batch_ts").alias("first"), F.max("batch_ts").alias("last"), F.sum("landed").alias("n"))
    history = F.map_from_entries(F.sort_array(F.collect_list(F.struct("fingerprint", F.col("first").cast("string")))))
    return seen.groupBy("table_name").agg(F.max("last").cast("string").alias("hwm"), F.sum("n").alias("record_count"), history.alias("schema_history"))


def bookmarks(landed: DataFrame) -> DataFrame:
    """Where an earlier run stopped: a cursor per fingerprint but fp_3, marks and watermarks."""
    by_fp = landed.groupBy("table_name", "fingerprint").agg(F.min("batch_ts").alias("lo"), F.max("batch_ts").alias("hi"))
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("long").cast("string")
    cursors = by_fp.where("fingerprint <> 'fp_3'").select("table_name", "fingerprint", F.lit("cursor").alias("kind"), middle.alias("value"))
    merged = by_fp.where("fingerprint = 'fp_1'").select("table_name", "fingerprint", F.lit("merge_watermark").alias("kind"), F.col("hi").cast("string").alias("value"))
    first = F.substring("table_name", 1, 1)
    ahead = F.when(first == "1", 86_400_000).when(first == "2", 0).otherwise(-86_400_000).cast("long")
    hwm = landed.groupBy("table_name").agg(F.max("batch_ts").alias("hi")).select(
        "table_name", F.lit(None).cast("string").alias("fingerprint"), F.lit("hwm").alias("kind"), (F.col("hi") + ahead).cast("string").alias("value")
    )
    gone = landed.where("table_name like '5%'").select("table_name", F.lit("fp_0").alias("fingerprint"), F.lit("cursor").alias("kind"), F.lit("1").alias("value")).distinct()
    return cursors.unionByName(merged).unionByName(hwm).unionByName(gone)


def job_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job runs from events: name, state, created and updated in seconds, duration in seconds or null."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    created = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)
    return e.select(
        "event_id",
        F.concat_ws("-", F.lit("job"), "event_type", "user_id").alias("name"),
        F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "signup", "CANCELLED").otherwise("SUCCESS").alias("state"),
        created.alias("created"),
        (created + F.col("value")).alias("updated"),
        F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("duration"),
    )


FEED_SQL = """feed AS (
  SELECT o_custkey AS id, lower(hex(o_orderkey)) AS seqval_hex,
         CASE WHEN o_orderstatus = 'F' AND o_orderkey % 7 = 0 THEN 1 WHEN o_orderstatus = 'O' THEN 0 WHEN o_orderstatus = 'P' THEN 2 ELSE 4 END AS op,
         CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 'fp_1' WHEN o_orderdate < TIMESTAMP '1999-06-01' THEN 'fp_2' ELSE 'fp_3' END AS fingerprint,
         date_trunc('month', o_orderdate) AS load_ts, o_totalprice AS amount, o_orderpriority AS status, lpad(lower(hex(o_orderkey)), 32, '0') AS k
  FROM orders)"""
BATCHES_SQL = """batches AS (
  SELECT lower(status) AS table_name, fingerprint, load_ts, count(*) AS landed, count(*) FILTER (op = 1) AS tombstones,
         epoch_ms(load_ts) AS batch_ts, year(load_ts) * 12 + month(load_ts) AS month
  FROM feed GROUP BY ALL)"""
METRICS_SQL = """metrics AS (
  SELECT table_name, fingerprint, batch_ts, CASE WHEN month % 13 <> 0 THEN landed + (month % 5 = 0)::BIGINT + landed % 3 END AS read,
         CASE WHEN month % 13 <> 0 THEN landed + (month % 5 = 0)::BIGINT END AS written, CASE WHEN month % 13 <> 0 THEN landed % 3 END AS dropped
  FROM batches WHERE month % 11 <> 0)"""
MANIFEST_SQL = """manifest AS (
  SELECT table_name, max(last)::VARCHAR AS hwm, sum(n)::BIGINT AS record_count FROM
    (SELECT table_name, fingerprint, max(batch_ts) AS last, sum(landed) AS n FROM batches GROUP BY ALL) GROUP BY table_name)"""
BOOKMARKS_SQL = """spans AS (SELECT table_name, fingerprint, min(batch_ts) AS lo, max(batch_ts) AS hi FROM batches GROUP BY ALL),
bookmarks AS (
  SELECT table_name, fingerprint, 'cursor' AS kind, ((lo + hi) // 2)::VARCHAR AS value FROM spans WHERE fingerprint <> 'fp_3'
  UNION ALL SELECT table_name, fingerprint, 'merge_watermark', hi::VARCHAR FROM spans WHERE fingerprint = 'fp_1'
  UNION ALL SELECT table_name, NULL, 'hwm', (max(batch_ts) + CASE substr(table_name, 1, 1) WHEN '1' THEN 86400000 WHEN '2' THEN 0 ELSE -86400000 END)::VARCHAR FROM batches GROUP BY table_name
  UNION ALL SELECT DISTINCT table_name, 'fp_0', 'cursor', '1' FROM batches WHERE table_name LIKE '5%')"""
JOBS_SQL = """jobs AS (
  SELECT event_id, 'job-' || event_type || '-' || user_id AS name,
         CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'CANCELLED' ELSE 'SUCCESS' END AS state,
         epoch_us(ts) / 1e6::DOUBLE AS created, epoch_us(ts) / 1e6::DOUBLE + value AS updated, CASE WHEN event_id % 5 <> 0 THEN value END AS duration
  FROM events)"""
