"""Mixing sources to target weights with DataFrame functions only.

Each document gets a hash-random key of its id and text. Keys order the documents of a source; the leading
hex digits deal them into ranges, so that a source with a third of all rows is spread over
hundreds of ranges. Sums per range give distributed prefix sums of sizes, and a document
is taken as far as the source's budget reaches past the sum before it. A budget above the
source's size takes whole epochs first.

Null text has size 0; a null source is a source of its own, last in order. Rows that
repeat a doc_id, or have none, count each; only rows equal in id and text share a key, so the
order is the same in every run, up to rows that are alike. The number of sources is that of a catalogue: the weights of
sources are worked out in one small sorted table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import Scratch

WORD = r"[^\x20\x09-\x0D]+"


def source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def random_key(doc_id: Column, text: Column) -> Column:
    own = F.md5(F.coalesce(text, F.lit("")))
    return F.md5(F.concat(F.coalesce(doc_id.cast("long").cast("string"), F.lit("")), F.lit(":"), own, F.lit(":mix")).cast("binary"))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, skey, size in words and the random key of each row."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "source",
        source_key(F.col("source")).alias("skey"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        random_key(F.col("doc_id"), F.col("text")).alias("key"),
    )


def targets(sources: DataFrame, weights: tuple[int, ...], share: float, ceiling: float) -> DataFrame:
    """Each source's budget: by weight, at most ``ceiling`` times its size, excess reshared by weight."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "skey")
    every = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    out = sources.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(ceiling)))
    out = out.withColumn("ratio", F.col("most") / F.col("weight")).withColumn("total", F.sum("source_size").over(every) * F.lit(float(share)))
    below = F.sum("most").over(by_ratio) - F.col("most")
    beyond = F.sum("weight").over(every) - F.sum("weight").over(by_ratio) + F.col("weight")
    out = out.withColumn("level", (F.col("total") - below) / beyond)
    level = F.min_by(F.when(F.col("ratio") >= F.col("level"), F.col("level")), F.when(F.col("ratio") >= F.col("level"), F.col("ratio"))).over(every)
    target = F.least(F.col("most"), F.coalesce(level, F.lit(float("inf"))) * F.col("weight"))
    return out.select("skey", "source_size", target.alias("target"))


def placed(docs: DataFrame, weights: tuple[int, ...], share: float, ceiling: float) -> DataFrame:
    """Each row with its key, its source's epochs and rest, and the words of the source before it."""
    scratch = Scratch(docs.sparkSession, "mixing")
    made = scratch.write(sized(docs), "sized")
    sources = made.groupBy("skey").agg(F.min("source").alias("source"), F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    sources = scratch.write(sources, "sources")
    rows = sources.agg(F.sum("rows").alias("n")).first()["n"] or 0
    digits = max(2, (rows // 200_000).bit_length() // 4 + 1)  # of 16 ranges each
    budgets = scratch.write(targets(sources, weights, share, ceiling), "targets")
    made = made.withColumn("range", F.substring("key", 1, digits))
    sums = made.groupBy("skey", "range").agg(F.sum("size").alias("n"))
    before = F.sum("n").over(Window.partitionBy("skey").orderBy("range")) - F.col("n")
    before = scratch.write(sums.select("skey", "range", before.alias("before")), "before")
    running = F.sum("size").over(Window.partitionBy("skey", "range").orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    out = made.withColumn("at", running - F.col("size")).join(before, ["skey", "range"]).join(budgets, "skey")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    out = out.withColumn("start", F.col("at") + F.col("before")).withColumn("epochs", epochs)
    return out.withColumn("rest", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, ceiling: float = 2.0) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of each row of ``docs``."""
    last = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("start")))
    taken = (F.col("epochs") * F.col("size") + last).cast("long")
    return placed(docs, weights, share, ceiling).select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, ceiling: float = 2.0) -> DataFrame:
    """Rows of ``docs``, each as often as the mix takes it as a whole.

    A source's last epoch goes up to one key, past which it would take less than half of a
    document. So only a row for each source is joined to the documents, whose texts stay.
    """
    inside = F.col("start") + F.col("size") / 2 <= F.col("rest")
    cuts = placed(docs, weights, share, ceiling).groupBy("skey").agg(F.max("epochs").alias("epochs"), F.max(F.when(inside, F.col("key"))).alias("upto"))
    cuts = Scratch(docs.sparkSession, "mixing").write(cuts, "cuts")
    both = docs.join(cuts, source_key(docs["source"]) == cuts["skey"])
    copies = cuts["epochs"] + F.coalesce(random_key(docs["doc_id"], docs["text"]) <= cuts["upto"], F.lit(False)).cast("int")
    out = both.where(copies > 0).select(*[docs[c] for c in docs.columns], F.explode(F.sequence(F.lit(1), copies.cast("int"))).alias("__copy"))
    return out.drop("__copy")


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS skey,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) || ':mix') AS key
  FROM documents),
sources AS (
  SELECT skey, min(source) AS source, sum(size)::BIGINT AS source_size FROM sized GROUP BY skey),
weighed AS (
  SELECT *, ([5.0, 2.0, 1.0])[((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
         source_size * 2.0::DOUBLE AS most, sum(source_size) OVER () * 1.5::DOUBLE AS total FROM sources),
rated AS (SELECT *, most / weight AS ratio FROM weighed),
levels AS (
  SELECT *, (total - (sum(most) OVER o - most)) / (sum(weight) OVER () - sum(weight) OVER o + weight) AS level
  FROM rated WINDOW o AS (ORDER BY ratio, skey)),
budgets AS (
  SELECT skey, source_size, least(most, coalesce((SELECT arg_min(level, ratio) FROM levels WHERE ratio >= level), 'inf'::DOUBLE) * weight) AS target
  FROM levels),
placed AS (
  SELECT s.*, b.source_size, b.target,
         sum(size) OVER (PARTITION BY s.skey ORDER BY key ROWS UNBOUNDED PRECEDING) - size AS sofar
  FROM sized s JOIN budgets b USING (skey)),
cut AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM placed)
SELECT doc_id, source, size, source_size, target,
       (epochs * size + greatest(0, least(size, round(target - epochs * source_size)::BIGINT - sofar)))::BIGINT AS taken
FROM cut
"""
