"""Streams of landing files: into a current state, or through the whole path of an ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.functions.keys import BOOKKEEPING, epoch_ms
from tidemark.functions.scope import ColumnExclusion
from tidemark.plans import ingest
from tidemark.sources.history import of_batches, read_history
from tidemark.sources.state import StateTable

FILES = "path string, modificationTime timestamp, length long, content binary"  # fixed by the source


def upsert_batch(state: StateTable):
    """A ``foreachBatch`` function. A batch that comes again changes nothing, as the order keys
    decide; only the buckets of its keys are read and written."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        state.upsert(batch)

    return merge


def start_upsert_stream(spark: SparkSession, landing: str, schema: StructType, state_path: str, checkpoint: str, keys: tuple[str, ...] = ("id",), **trigger) -> StreamingQuery:
    """Reads parquet under ``landing`` with one widest schema; by default what is there, then stops."""
    stream = spark.readStream.schema(schema).parquet(landing)
    merge = upsert_batch(StateTable(spark, state_path, keys))
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def ingest_batch(table: str, name: str, history_path: str, state_path: str, recon_path: str, exclude: str = ""):
    """A ``foreachBatch`` function over landed files' names: history, state and audits of their folders.

    Folders are taken whole, whichever of their files are new, so a folder that arrives in pieces
    is written again as a whole. All that it writes follows from the micro-batch alone: partitions of
    history are replaced, load times are those of the files, and audit rows go by ``name`` and the
    batch's number. So a micro-batch that was cut short anywhere is made good by its repetition.
    """

    def run(files: DataFrame, batch_id: int) -> None:
        spark = files.sparkSession
        part = lambda k: F.regexp_extract("path", r"(?:[^/=]+=)?([^/]+)/(?:[^/=]+=)?([^/]+)/[^/]+$", k)
        folder = F.regexp_extract("path", "^(.*)/[^/]+$", 1).alias("folder")
        new = files.select(part(1).alias("fingerprint"), epoch_ms(part(2)).alias(ingest.BATCH), folder, "modificationTime").where(f"{ingest.BATCH} is not null")
        picked = new.groupBy("fingerprint", ingest.BATCH, "folder").agg(F.max("modificationTime").alias("at")).orderBy("fingerprint", ingest.BATCH).collect()  # folders
        if not picked:
            return
        at = max(r["at"] for r in picked)
        landed = ingest.append_batches(spark, picked, table, history_path, at, ColumnExclusion(exclude))
        rows = read_history(spark, history_path).where(of_batches(ingest.batches_of(picked)))
        StateTable(spark, state_path).upsert(rows.drop(*BOOKKEEPING, ingest.BATCH))
        ingest.audit(spark, picked, table, landed, history_path, recon_path, f"{name}-{batch_id}", at)

    return run


def start_ingest_stream(spark: SparkSession, folder: str, table: str, paths: tuple[str, str, str], checkpoint: str, name: str = "stream", exclude: str = "", files_at_once: int = 1000, **trigger) -> StreamingQuery:
    """Takes a table's folder ``<folder>/<fingerprint>/<batch>/`` through history, state and audits
    (``paths``) as files land; by default what is there, then stops. The checkpoint is the bookmark."""
    files = spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", "*.parquet").option("maxFilesPerTrigger", files_at_once)
    stream = files.load(f"{folder}/*/*").select("path", "modificationTime")  # contents are not read
    work = ingest_batch(table, name, *paths, exclude)
    return stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
