"""Tier D by bucket: checks only what has changed since the last audit.

History is kept a second time, narrow: of each key the newest upsert and the newest tombstone,
in the same hash buckets as the state. A bucket has changed if it has other files than at its last
check, on either side. Of changed buckets both sides are summed up without regard to order:
how many keys are alive, and the sum of hashes of (key, newest order key). Where the sums are
equal no check can fail; where not, the four checks are run on that bucket. What each check said
is noted by bucket, and the verdict is that of all notes. Unchanged buckets are not read.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.keys import UPSERTS, is_tombstone, seq_key
from tidemark.operators import recon
from tidemark.operators.merge import latest_op
from tidemark.sources.history import beyond, read_history
from tidemark.sources.shared import exists
from tidemark.sources.state import BUCKET, OF, StateTable, key_hash

DEAD = "__dead"
MARKS = "fingerprint string, upto long"
FACTS = ("here", "alive", *recon.CHECKS)


class DigestAudit:
    """Audits of one history and its state; what they keep is under ``path``."""

    def __init__(self, spark: SparkSession, history_path: str, state: StateTable, path: str):
        self.spark, self.history_path, self.state, self.path = spark, history_path, state, path.rstrip("/")
        self.keys = state.keys

    def _base(self) -> int:
        return self.state.plan.read()[1]["buckets"]

    def _narrow(self) -> StateTable:
        return StateTable(self.spark, f"{self.path}/narrow", (*self.keys, DEAD), self._base(), by=self.keys)

    def _follow(self, history: DataFrame) -> None:
        """Takes batches that history has beyond those already taken. What is taken twice changes nothing."""
        where = f"{self.path}/marks"
        known = self.spark.read.schema(MARKS).parquet(where).groupBy("fingerprint").agg(F.max("upto")).collect() if exists(self.spark, f"{where}/part-*") else []  # a row for each fingerprint
        new = history.where(beyond({r[0]: r[1] for r in known}))
        upto = new.groupBy("fingerprint").agg(F.max("batch_ts").alias("upto")).collect()
        if upto:
            self._narrow().upsert(new.select(*self.keys, "seqval_hex", "op", is_tombstone().alias(DEAD)))
            self.spark.createDataFrame(upto, MARKS).coalesce(1).write.mode("append").parquet(where)

    def _files(self, table: StateTable, base: int) -> DataFrame:
        """bucket and the names of its files, of one side; nothing is read."""
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
        names = listed.load(table.path).select("path")
        own = F.regexp_extract("path", f"{BUCKET}=([0-9]+)/", 1).cast("int")
        return names.select(F.pmod(own, F.lit(base)).alias("bucket"), F.regexp_extract("path", f"({OF}=.*)$", 1).alias("name"))

    def _signatures(self, base: int) -> DataFrame:
        both = self._files(self.state, base).union(self._files(self._narrow(), base).select("bucket", F.concat(F.lit("narrow/"), "name")))
        return both.groupBy("bucket").agg(F.sha2(F.array_join(F.sort_array(F.collect_list("name")), "\n"), 256).alias("signature"))

    def _notes(self) -> DataFrame | None:
        where = f"{self.path}/notes"
        if not exists(self.spark, f"{where}/part-*"):
            return None
        newest = F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("at"), F.desc("audit")))
        return self.spark.read.parquet(where).withColumn("__rn", newest).where("__rn = 1").drop("__rn")

    def _sums(self, rows: DataFrame, bucket: Column, order: Column, side: str) -> DataFrame:
        hashes = F.xxhash64(*self.keys, order).cast("decimal(38,0)")
        return rows.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias(f"n_{side}"), F.sum(hashes).alias(f"h_{side}"))

    def run(self, table_name: str, run_id: str, at: datetime) -> DataFrame:
        """The audit rows, as ``recon.tier_d`` has them; none if history or state is absent."""
        history = read_history(self.spark, self.history_path)
        if history is None or self.state.read() is None:
            return self.spark.createDataFrame([], recon.RECON)
        base = self._base()
        self._follow(history)
        now, notes = self._signatures(base), self._notes()
        if notes is None:
            changed = now
        else:
            was = notes.select("bucket", F.col("signature").alias("was"))
            changed = now.join(was, "bucket", "full_outer").where(~F.col("signature").eqNullSafe(F.col("was"))).drop("was")
        changed = {r["bucket"]: r["signature"] for r in changed.collect()}  # at most as many as buckets
        if changed:
            self._check(changed, base, at)
        return recon.recon_rows(self._verdict(table_name), run_id, at)

    def _check(self, changed: dict[int, str], base: int, at: datetime) -> None:
        bucket = F.pmod(key_hash(self.keys), F.lit(base)).cast("int")
        narrow, state = self._narrow(), self.state
        of = lambda t: t.read({leaf for leaf in t.leaves() if leaf[1] % base in changed})
        past, current = of(narrow), of(state).where(~is_tombstone())
        alive = latest_op(past, self.keys).where(F.col("op").isin(*UPSERTS))
        sums = self._sums(alive, bucket, F.col("upsert_key"), "alive").join(self._sums(current, bucket, seq_key(), "here"), "bucket", "full_outer")
        sums = sums.select("bucket", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_alive", "n_here")], F.col("h_alive").eqNullSafe(F.col("h_here")).alias("same"))
        sums = {r["bucket"]: r for r in sums.collect()}  # the same
        differ = [b for b, r in sums.items() if not r["same"] or r["n_alive"] != r["n_here"]]
        equal = [(b, s, sums[b]["n_here"] if b in sums else 0, sums[b]["n_alive"] if b in sums else 0, 0, 0, 0) for b, s in changed.items() if b not in differ]
        marked = recon.checked_keys(past.where(bucket.isin(differ)), current.where(bucket.isin(differ)), self.keys).withColumn("bucket", bucket)
        counts, samples = self._bad(marked)
        signed = self.spark.createDataFrame([(b, changed[b]) for b in differ], "bucket int, signature string")
        noted = signed.join(counts, "bucket").join(samples, "bucket", "left").select("bucket", "signature", *FACTS, "samples")
        fine = self.spark.createDataFrame(equal, "bucket int, signature string, " + ", ".join(f"{f} long" for f in FACTS))
        every = noted.unionByName(fine, allowMissingColumns=True)
        notes = self._notes()
        audit = 0 if notes is None else notes.agg(F.max("audit")).first()[0] + 1
        every.withColumn("at", F.lit(at)).withColumn("audit", F.lit(audit)).coalesce(1).write.mode("append").parquet(f"{self.path}/notes")

    def _bad(self, marked: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Counts of each bucket, and the first few keys of each of its checks."""
        counts = marked.groupBy("bucket").agg(*[F.count_if(F.col(c)).alias(c) for c in FACTS])
        named = F.filter(F.array(*[F.when(F.col(c), F.lit(c)) for c in recon.CHECKS]), lambda x: x.isNotNull())
        bad = marked.select("bucket", F.struct(*self.keys).alias("key"), F.explode(named).alias("check_name"))
        first = F.row_number().over(Window.partitionBy("bucket", "check_name").orderBy("key"))
        some = bad.withColumn("__rn", first).where(F.col("__rn") <= recon.SAMPLES)
        return counts, some.groupBy("bucket").agg(F.collect_list(F.struct("check_name", "key")).alias("samples"))

    def _verdict(self, table_name: str) -> DataFrame:
        notes = self._notes()
        total = notes.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in FACTS])
        each = F.array(*[F.struct(F.lit(c).alias("check_name"), F.col(c).alias("violations")) for c in recon.CHECKS], F.struct(F.lit("count_formula").alias("check_name"), F.abs(F.col("here") - F.col("alive")).alias("violations")))
        samples = notes.select(F.inline("samples"))
        first = F.row_number().over(Window.partitionBy("check_name").orderBy("key"))
        some = samples.withColumn("__rn", first).where(F.col("__rn") <= recon.SAMPLES).groupBy("check_name").agg(F.to_json(F.sort_array(F.collect_list("key"))).alias("sample"))
        return recon.verdict(total.select(F.inline(each)).join(some, "check_name", "left"), table_name)
