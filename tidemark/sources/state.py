"""A keyed table in hash buckets, of which an upsert rewrites only those that it touches.

Plain parquet, partitioned by ``__of`` and ``__bucket``: a bucket holds the keys whose hash leaves
``__bucket`` modulo ``__of``. A touched bucket that has grown past ``BYTES_IN_BUCKET`` is split by
doubling its modulus, once in an upsert; others stay as they are, so buckets of several moduli live side by side,
none inside another. Few changes are broadcast, past which they are shuffled with the rows of
their buckets; in the first case the table's rows stay where they are.

An upsert writes the touched buckets' new rows beside the table and then moves each folder into its
place. If it is cut short in between, the next upsert moves the rest. Readers never write: they
take such buckets from beside the table. Upserts of the same changes may be repeated.
Tombstones stay in the table, so late changes sort right.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from tidemark.functions.keys import seq_key
from tidemark.operators.merge import newest
from tidemark.operators.schema import align
from tidemark.sources.shared import MOST_ROWS, Plan, delete, exists, few, found, move, size_of

OF, BUCKET = "__of", "__bucket"
LEAST_BUCKETS, MOST_BUCKETS, ROWS_IN_BUCKET, BYTES_IN_BUCKET = 64, 1 << 20, 2_000_000, 512 << 20
Leaf = tuple[int, int]  # modulus and bucket


def key_hash(keys: tuple[str, ...]) -> Column:
    """The same for keys of wider types."""
    return F.xxhash64(*[F.col(k).cast("string") for k in keys])


def with_filters(writer, keys: tuple[str, ...]):
    """Bloom filters of keys in the files, so that a look for few keys skips most."""
    for k in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true")
    return writer.option("parquet.bloom.filter.adaptive.enabled", "true")


class StateTable:
    """``buckets`` counts when the table is made; by default it follows the first changes' size. Keys
    are dealt to buckets by their columns ``by``, which are all of them unless given."""

    def __init__(self, spark: SparkSession, path: str, keys: tuple[str, ...] = ("id",), buckets: int | None = None, split: int = BYTES_IN_BUCKET, by: tuple[str, ...] = ()):
        self.spark, self.path, self.keys, self.buckets, self.split = spark, path.rstrip("/"), keys, buckets, split
        self.by = by or keys
        self.plan, self.staged = Plan(spark, self.path), f"{self.path}_staged"

    def _stored(self, path: str, schema: StructType) -> DataFrame:
        whole = StructType([*schema.fields]).add(OF, IntegerType()).add(BUCKET, IntegerType())
        return self.spark.read.schema(whole).parquet(path)

    def _leaves(self, path: str) -> set[Leaf]:
        names = (re.search(f"{OF}=([0-9]+)/{BUCKET}=([0-9]+)$", p) for p in found(self.spark, f"{path}/{OF}=*/{BUCKET}=*"))
        return {(int(m[1]), int(m[2])) for m in names}

    def _waiting(self) -> set[Leaf]:
        """Buckets that an upsert has written beside the table."""
        return self._leaves(self.staged) if exists(self.spark, f"{self.staged}/_SUCCESS") else set()

    def _folder(self, path: str, leaf: Leaf) -> str:
        return f"{path}/{OF}={leaf[0]}/{BUCKET}={leaf[1]}"

    def _finish(self) -> None:
        """Moves what waits into the table; buckets that were split go last."""
        waiting = self._waiting()
        for leaf in sorted(waiting):
            move(self.spark, self._folder(self.staged, leaf), self._folder(self.path, leaf))
        if exists(self.spark, f"{self.staged}/_SUCCESS"):
            for leaf in _split(self._leaves(self.path)):
                delete(self.spark, self._folder(self.path, leaf))
        delete(self.spark, self.staged)

    def read(self, leaves: set[Leaf] | None = None) -> DataFrame | None:
        """All rows, or those of some buckets, tombstones too; None before the first write."""
        rows = self.read_with_buckets(leaves)
        return None if rows is None else rows.drop(OF, BUCKET)

    def read_with_buckets(self, leaves: set[Leaf] | None = None) -> DataFrame | None:
        schema, _ = self.plan.read()
        if schema is None:
            return None
        waiting, there = self._waiting(), self._leaves(self.path)
        alive = self.leaves(waiting, there)
        if not alive:
            return None
        want = alive if leaves is None else alive & leaves
        parts = []
        if settled := want - waiting:
            rows = self._stored(self.path, schema)
            parts.append(rows if settled == there else rows.where(among(settled)))
        if staged := want & waiting:
            rows = self._stored(self.staged, schema)
            parts.append(rows if staged == waiting else rows.where(among(staged)))
        if not parts:
            return self.spark.createDataFrame([], StructType([*schema.fields]).add(OF, IntegerType()).add(BUCKET, IntegerType()))
        return parts[0] if len(parts) == 1 else parts[0].union(parts[1])

    def leaves(self, waiting: set[Leaf] | None = None, there: set[Leaf] | None = None) -> set[Leaf]:
        """Buckets that hold the table's rows now."""
        every = (self._waiting() if waiting is None else waiting) | (self._leaves(self.path) if there is None else there)
        return every - _split(every)

    def current(self) -> DataFrame | None:
        rows = self.read()
        return None if rows is None else rows.where("op <> 1")

    def upsert(self, changes: DataFrame) -> None:
        """Merges ``changes``, of any order; columns that they lack are null in their rows."""
        if taken := {OF, BUCKET}.intersection(changes.columns):
            raise ValueError(f"column names are taken: {sorted(taken)}")
        self._finish()
        known, fixed = self.plan.read()
        changes = newest(changes, self.keys).persist()  # read several times; made again where an executor is lost
        try:
            n = changes.count()
            if not n:
                return
            base = fixed.get("buckets") or self.buckets or max(LEAST_BUCKETS, -(-n // ROWS_IN_BUCKET))
            schema = known if known is not None and _holds(known, changes.schema) else self.plan.extend(changes.schema, buckets=base)
            self._merge(align(changes, schema), n, schema, base)
        finally:
            changes.unpersist()
        self._finish()

    def _merge(self, changes: DataFrame, n: int, schema: StructType, base: int) -> None:
        leaves, h = self.leaves(), key_hash(self.by)
        widest_modulus = max([base, *(of for of, _ in leaves)])
        touched = [r[0] for r in changes.select(F.pmod(h, F.lit(widest_modulus)).cast("int")).distinct().collect()]  # at most as many as buckets
        inner, places, old = _split(leaves, itself=False), {}, set()
        for bucket in touched:
            of = base
            while (of, bucket % of) in inner:
                of *= 2
            leaf = (of, bucket % of)
            old |= {leaf} & leaves
            places.setdefault(leaf, None)
        for leaf in places:
            size = size_of(self.spark, self._folder(self.path, leaf)) if leaf in leaves else 0
            places[leaf] = leaf[0] * 2 if size > self.split and leaf[0] < MOST_BUCKETS else leaf[0]
        moduli = sorted({*places.values()})
        of = F.lit(moduli[0])
        if len(moduli) > 1:
            chosen = [F.when(among({leaf}, h), F.lit(places[leaf])) for leaf in places if places[leaf] != moduli[0]]
            of = F.coalesce(*chosen, F.lit(moduli[0]))
        dealt = lambda df: df.withColumn(OF, of.cast("int")).withColumn(BUCKET, F.pmod(h, F.col(OF)).cast("int"))
        whole = lambda df: dealt(df).hint("rebalance", OF, BUCKET)  # noqa: E731  else each task has a file for each bucket
        rows = self.read(old) if old else None
        if rows is None:
            out = whole(changes)
        elif n <= MOST_ROWS:
            merged, fresh = self._parts(rows, changes)
            out = dealt(merged).union(whole(fresh))
        else:
            out = whole(newest(rows.union(changes), self.keys))
        with_filters(out.write.mode("overwrite").partitionBy(OF, BUCKET), self.keys).parquet(self.staged)

    def _beside(self, rows: DataFrame, changes: DataFrame) -> DataFrame:
        merged, fresh = self._parts(rows, changes)
        return merged.union(fresh)

    def _parts(self, rows: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Stored rows, each replaced by a newer change of its key, and changes of keys that are new.

        Changes are broadcast, so stored rows are read where they are; their keys are read
        once more to tell which changes are of new keys.
        """
        plain = [c for c, t in rows.dtypes if not t.startswith(("map", "variant"))]
        order = lambda: F.struct(F.coalesce(seq_key(), F.lit("")).alias("k"), F.bitwise_not(F.xxhash64(*plain)).alias("h"))  # noqa: E731  the greatest is the newest
        new = changes.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(self.keys)], order().alias("__at"), F.struct(*changes.columns).alias("__new"))
        on = [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(self.keys)]
        both = rows.join(F.broadcast(new), on, "left")
        merged = both.select(F.when(F.col("__at") > order(), F.col("__new")).otherwise(F.struct(*rows.columns)).alias("r")).select("r.*")
        keys = list(self.keys)
        here = rows.select(*keys).join(F.broadcast(changes.select(*keys)), keys, "left_semi")
        return merged, changes.join(here, keys, "left_anti").select(rows.columns)


def _split(leaves: set[Leaf], itself: bool = True) -> set[Leaf]:
    """Buckets above ``leaves``; of those that are in ``leaves`` themselves if ``itself``."""
    above = set()
    for of, bucket in leaves:
        while of % 2 == 0:
            of //= 2
            above.add((of, bucket % of))
    return above & leaves if itself else above


def _holds(known: StructType, schema: StructType) -> bool:
    own = {f.name: f.dataType for f in known.fields}
    return all(own.get(f.name) == f.dataType for f in schema.fields)


def among(leaves: set[Leaf], h: Column | None = None) -> Column:
    """Rows of some buckets, by their partition or by the hash of their key."""
    by_modulus: dict[int, list[int]] = {}
    for of, bucket in sorted(leaves):
        by_modulus.setdefault(of, []).append(bucket)
    out = F.lit(False)
    for of, buckets in by_modulus.items():
        inside = (F.col(OF) == of) & F.col(BUCKET).isin(buckets) if h is None else F.pmod(h, F.lit(of)).isin(buckets)
        out = out | inside
    return out
