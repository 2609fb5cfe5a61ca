"""Landing area: manifest, batch folders, their metrics, and reading chosen batches."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType, TimestampType

from tidemark.functions.keys import BOOKKEEPING, epoch_ms
from tidemark.sources.shared import exists, literal

MANIFEST = "map<string,struct<lastSuccessfulWriteTimestamp:string,totalProcessedRecordsCount:bigint,dataFilesPath:string,schemaHistory:map<string,string>>>"
FIGURES = "read long, written long, dropped long"
METRICS = "tableName string, schemaId string, batchTimestamp string, numRecordsRead bigint, numRecordsWritten bigint, numRecordsDropped bigint"


def landing_inventory(spark: SparkSession, base: str, table: str = "*") -> DataFrame:
    """One row per data file under ``<base>/<table>/<fingerprint>/<batch>/``; contents are not read.

    Folder names may be values alone or ``name=value``.
    """
    files = spark.read.format("binaryFile").load(f"{base}/{_any_case(table)}/*/*/*.parquet").select("path", "length")
    part = lambda k: F.regexp_extract("path", r"(?:[^/=]+=)?([^/]+)/(?:[^/=]+=)?([^/]+)/(?:[^/=]+=)?([^/]+)/[^/]+$", k)
    return files.select(part(1).alias("table_name"), part(2).alias("fingerprint"), part(3).alias("batch"), "path", "length")


def _any_case(table: str) -> str:
    """A pattern of a table's folder, whatever its case, so that other tables are not listed."""
    return table if table == "*" else "{,*=}" + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else "?" if c in "*?[]{}\\^-," else c for c in table)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per table; malformed or wrongly typed JSON raises. Bookmarks stay text."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", MANIFEST, {"mode": "FAILFAST"}).alias("m"))
    return raw.select(F.explode("m").alias("table_name", "e")).select(
        "table_name",
        F.col("e.lastSuccessfulWriteTimestamp").alias("hwm"),
        F.col("e.totalProcessedRecordsCount").alias("record_count"),
        data_key(F.col("e.dataFilesPath")).alias("data_path"),
        F.col("e.schemaHistory").alias("schema_history"),
    )


def data_key(path: Column) -> Column:
    """An object path without scheme and host."""
    return F.regexp_replace(path, r"^[A-Za-z0-9]+://[^/]+/", "")


def fingerprint_order(manifest: DataFrame) -> DataFrame:
    """Each table's fingerprints by when they were first seen, as numbers; ``place`` counts from 1."""
    seen = F.transform(F.map_entries("schema_history"), lambda e: F.struct(epoch_ms(e["value"]).alias("first_seen"), e["key"].alias("fingerprint")))
    return manifest.select("table_name", F.posexplode(F.array_sort(seen)).alias("pos", "e")).select(
        "table_name", "e.fingerprint", "e.first_seen", (F.col("pos") + 1).alias("place")
    )


def select_batches(inventory: DataFrame, effective: DataFrame, hwm: DataFrame) -> DataFrame:
    """Unread batches: numeric folder names above the cursor and up to the high-water mark.

    ``effective`` (table_name, fingerprint, cursor) and ``hwm`` (table_name, hwm) hold text;
    a bookmark that is no number is no bound.
    """
    found = inventory.select("table_name", "fingerprint", epoch_ms(F.col("batch")).alias("batch_ts")).where("batch_ts is not null").distinct()
    low = effective.select("table_name", "fingerprint", epoch_ms(F.col("cursor")).alias("low"))
    high = hwm.select("table_name", epoch_ms(F.col("hwm")).alias("high"))
    out = found.join(low, ["table_name", "fingerprint"], "left").join(high, "table_name", "left")
    return out.where("(low is null or batch_ts > low) and (high is null or batch_ts <= high)").select("table_name", "fingerprint", "batch_ts")


def stamped(df: DataFrame, fingerprint: str, load_ts: datetime, exclude: tuple[str, ...] = ()) -> DataFrame:
    """``df`` without excluded columns, with its fingerprint and the run's one load time."""
    return df.drop(*exclude).withColumn("fingerprint", F.lit(fingerprint)).withColumn("load_ts", F.lit(load_ts))


def scan_batches(spark: SparkSession, paths: list[str], fingerprint: str, load_ts: datetime, schema: StructType, exclude: tuple[str, ...] = (), batch: str = "") -> DataFrame:
    """Rows of the chosen folders, all in one read with one widest schema; absent columns are null.

    ``batch`` names a column for the number of the folder that a row came from.
    """
    kept = StructType([f for f in schema.fields if f.name.lower() not in exclude])
    if taken := {*BOOKKEEPING, batch}.intersection(kept.fieldNames()):
        raise ValueError(f"column names are taken: {sorted(taken)}")
    rows = spark.read.schema(kept).parquet(*paths)
    folder = F.substring_index(F.substring_index("_metadata.file_path", "/", -2), "/", 1)  # for each row, where a pattern is dear
    own = F.substring(folder, F.instr(folder, "=") + 1, F.length(folder)).cast("long")
    return stamped(rows.select("*", own.alias(batch)) if batch else rows, fingerprint, load_ts)


def with_bookkeeping(schema: StructType) -> StructType:
    """The columns of stored history."""
    return StructType([*schema.fields]).add("load_ts", TimestampType()).add("fingerprint", StringType()).add("batch_ts", LongType())


def merged_batches(history: DataFrame, bookmarks: DataFrame, column: str = "batch_ts") -> DataFrame:
    """History up to each fingerprint's merge watermark: what the current state has taken in."""
    marks = bookmarks.where("kind = 'merge_watermark'").select("fingerprint", F.col("value").cast("long").alias("__mark"))
    return history.join(marks, "fingerprint").where(F.col(column) <= F.col("__mark")).select(history.columns)


def schema_of(spark: SparkSession, path: str) -> StructType:
    """From a file's footer; no rows are read."""
    return spark.read.parquet(path).schema


def read_batch_metrics(spark: SparkSession, base: str) -> DataFrame:
    """One row per metrics file: table, fingerprint, batch_ts, and its figures, null if corrupt."""
    raw = spark.read.text(f"{base}/*/*/*/.cda/batch-metrics.json", wholetext=True)
    part = lambda k: F.regexp_extract(F.input_file_name(), r"([^/]+)/([^/]+)/([^/]+)/\.cda/[^/]+$", k)
    parsed = raw.select(part(1).alias("table_name"), part(2).alias("fingerprint"), part(3).cast("long").alias("batch_ts"), F.from_json("value", METRICS).alias("m"))
    return parsed.select("table_name", "fingerprint", "batch_ts", F.col("m.numRecordsRead").alias("read"), F.col("m.numRecordsWritten").alias("written"), F.col("m.numRecordsDropped").alias("dropped"))


def read_chosen_metrics(spark: SparkSession, table: str, folders: list[tuple[str, int, str]]) -> DataFrame:
    """The same for chosen batches (fingerprint, batch_ts, folder) alone; no others are listed or opened.

    A file that goes missing meanwhile counts as missing. Names are those given, whatever the folders' case.
    """
    at = [(fp, ts, f"{folder}/.cda/batch-metrics.json") for fp, ts, folder in folders]
    by_parent: dict[str, list[str]] = {}
    for _, _, path in at:
        parent, batch = path.rsplit("/", 3)[0], path.rsplit("/", 3)[1]
        by_parent.setdefault(parent, []).append(literal(batch))
    patterns = [f"{literal_path(parent)}/{{{','.join(names)}}}/.cda/batch-metrics.json" for parent, names in by_parent.items()]
    there = [p for p in patterns if exists(spark, p)]
    if not there:
        return spark.createDataFrame([], f"table_name string, fingerprint string, batch_ts long, {FIGURES}")
    raw = spark.read.option("ignoreMissingFiles", True).text(there, wholetext=True)
    own = spark.createDataFrame([(fp, ts, "/".join(path.rsplit("/", 5)[-5:])) for fp, ts, path in at], "fingerprint string, batch_ts long, __tail string")
    tail = F.regexp_extract(F.url_decode(F.replace(F.input_file_name(), F.lit("+"), F.lit("%2B"))), "([^/]+/[^/]+/[^/]+/[.]cda/[^/]+)$", 1)
    parsed = raw.select(tail.alias("__tail"), F.from_json("value", METRICS).alias("m")).join(F.broadcast(own), "__tail")
    return parsed.select(F.lit(table).alias("table_name"), "fingerprint", "batch_ts", F.col("m.numRecordsRead").alias("read"), F.col("m.numRecordsWritten").alias("written"), F.col("m.numRecordsDropped").alias("dropped"))


def literal_path(path: str) -> str:
    """A path as a pattern that names it alone."""
    scheme, sep, rest = path.partition(":/")
    return f"{scheme}{sep}" + "/".join(map(literal, rest.split("/"))) if sep else "/".join(map(literal, path.split("/")))


def batch_metrics_rollup(selected: DataFrame, metrics: DataFrame) -> DataFrame:
    """Totals of each table and fingerprint over selected batches, and which lacked metrics.

    A batch without a metrics row is missing; one whose figures are null is corrupt.
    """
    on = ["table_name", "fingerprint", "batch_ts"]
    both = selected.select(*on).join(metrics.withColumn("__has", F.lit(True)), on, "left")
    missing, corrupt = F.col("__has").isNull(), F.col("__has").isNotNull() & F.col("written").isNull()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return both.groupBy("table_name", "fingerprint").agg(
        total("read"),
        total("written"),
        total("dropped"),
        F.count_if(~missing & ~corrupt).alias("ok"),
        F.sort_array(F.collect_list(F.when(missing, F.col("batch_ts")))).alias("missing"),
        F.sort_array(F.collect_list(F.when(corrupt, F.col("batch_ts")))).alias("corrupt"),
    )


def partition_stats(history: DataFrame) -> DataFrame:
    """Rows and files of each fingerprint of a stored history."""
    return history.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("_metadata.file_path").alias("files"))
