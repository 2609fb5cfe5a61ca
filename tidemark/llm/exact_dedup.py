"""Exact deduplication by content-defined chunk recipes.

A text is cut where a rolling hash over its last 32 bytes has zeros in its top bits, so
equal passages give equal chunks. A document's recipe is its list of chunk fingerprints
(64 bits) beside 128 bits of each chunk's SHA-256. Fingerprints are verified: where one
stands for chunks with different SHA-256 bits, each gets a number of its own, and the
identifier is (fingerprint, number). Documents are equal if their identifier lists are.
Only recipes are shuffled, about 24 bytes for each 2 KiB of text; texts never move.

Null text counts as empty. A null doc_id comes after all others: such a row stays only in a
group without ids, whose keep_id is null. Rows that repeat a doc_id count each; with unlike
texts they are in groups of their own, and with the same text all of them report ``kept``
where that doc_id is the one that stays. ``without_copies`` leaves one row of each group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import Scratch, few_ids, parted

SPACES = b" \t\n\x0b\x0c\r"
WINDOW = 32
SEGMENT = 1 << 20
GEAR = np.random.default_rng(20240229).integers(0, 1 << 32, 256, dtype=np.uint32)
RECIPE = "doc_id string, text_sha256 string, n_bytes long, fps array<long>, his array<long>, los array<long>"


def normalise(text: str | None) -> bytes:
    """Runs of ASCII white space become one space; UTF-8."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    body = b" ".join(raw.split())
    if not body:
        return b" " if raw else b""
    return (b" " if raw[:1] in SPACES else b"") + body + (b" " if raw[-1:] in SPACES else b"")


def cut_points(data: bytes, mean_bits: int = 11, least: int = 256, most: int = 1 << 14) -> list[int]:
    """Ends of the content-defined chunks of ``data``, which the last one closes."""
    size, found = len(data), []
    if size > least:
        values = np.frombuffer(data, dtype=np.uint8)
        for start in range(0, size, SEGMENT):
            lead = min(start, WINDOW - 1)
            h = GEAR[values[start - lead : start + SEGMENT]]
            step = 1
            while step < WINDOW:
                shifted = h[:-step] << np.uint32(step)
                h = h.copy()
                h[step:] += shifted
                step *= 2
            found.extend((np.flatnonzero(h[lead:] >> np.uint32(32 - mean_bits) == 0) + start + 1).tolist())
    ends, last = [], 0
    for end in [*found, size]:
        while end - last > most:
            last += most
            ends.append(last)
        if end - last >= least:
            ends.append(end)
            last = end
    if last < size:
        ends.append(size)
    return ends


def recipe(data: bytes, fp_bits: int = 64) -> tuple[list[int], list[int], list[int]]:
    """Fingerprints of the chunks, and the halves of 128 bits of their SHA-256, as signed longs."""
    fps, his, los, last = [], [], [], 0
    for end in cut_points(data):
        piece = data[last:end]
        digest = hashlib.sha256(piece).digest()
        fps.append((xxhash.xxh3_64_intdigest(piece) >> (64 - fp_bits)) - (1 << 63 if fp_bits == 64 else 0))
        his.append(int.from_bytes(digest[:8], "big", signed=True))
        los.append(int.from_bytes(digest[8:16], "big", signed=True))
        last = end
    return fps, his, los


def recipes(docs: DataFrame, fp_bits: int = 64) -> DataFrame:
    """One row per document: SHA-256 of its normalised text, and its recipe."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                data = normalise(text)
                rows.append((doc_id, hashlib.sha256(data).hexdigest(), len(data), *recipe(data, fp_bits)))
            yield pd.DataFrame(rows, columns=["doc_id", "text_sha256", "n_bytes", "fps", "his", "los"])

    texts = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInPandas(make, RECIPE).withColumn("doc_id", F.col("doc_id").cast("long"))  # as strings, ids beside nulls stay exact


def verified(made: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds ``nos``: the numbers that tell apart chunks under one fingerprint; empty if all are 0."""
    chunks = made.select(F.explode(F.arrays_zip("fps", "his", "los")).alias("c")).select("c.fps", "c.his", "c.los")
    shared = (
        chunks.groupBy("fps")
        .agg(F.min("his").alias("h0"), F.max("his").alias("h1"), F.min("los").alias("l0"), F.max("los").alias("l1"))
        .where("h0 <> h1 or l0 <> l1")
        .select("fps")
    )
    shared = scratch.write(shared, "shared_fps")
    none = F.array().cast("array<int>")
    if shared.isEmpty():
        return made.withColumn("nos", none)
    numbers = (
        chunks.join(shared, "fps", "left_semi")
        .distinct()
        .withColumn("no", F.row_number().over(Window.partitionBy("fps").orderBy("his", "los")) - 1)
    )
    numbers = scratch.write(numbers.where("no > 0"), "numbers")
    placed = made.select("text_sha256", F.posexplode(F.arrays_zip("fps", "his", "los")).alias("pos", "c"))
    placed = placed.select("text_sha256", "pos", "c.fps", "c.his", "c.los").join(numbers, ["fps", "his", "los"])
    renamed = placed.groupBy("text_sha256").agg(F.map_from_entries(F.collect_set(F.struct("pos", "no"))).alias("at"))
    renamed = scratch.write(renamed, "renamed")
    nos = F.when(F.col("at").isNotNull(), F.transform("fps", lambda x, i: F.coalesce(F.element_at("at", i), F.lit(0)))).otherwise(none)
    return made.join(renamed, "text_sha256", "left").withColumn("nos", nos).drop("at")


def exact_groups(docs: DataFrame, fp_bits: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, n_bytes, n_chunks of each row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "exact")
    made = scratch.write(recipes(docs, fp_bits), "recipes")
    lists = verified(made, scratch).select("doc_id", "text_sha256", "n_bytes", "fps", "nos")
    same = ["n_bytes", "fps", "nos"]
    groups = lists.groupBy(*same).agg(F.min("doc_id").alias("keep"), F.count(F.lit(1)).alias("size")).where("size > 1")
    groups = scratch.write(groups, "groups")  # joined as a table, so that a hot group's rows can be split
    keep = F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("keep"))
    return lists.join(groups, same, "left").select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        keep.eqNullSafe(F.col("doc_id")).alias("kept"),
        "text_sha256",
        "n_bytes",
        F.size("fps").alias("n_chunks"),
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns, one of each group of equal texts: that with the least doc_id.

    Only ids of dropped rows are joined to ``docs``, broadcast up to a checked number. Rows whose doc_id is null or repeats go by
    id and text.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    found = scratch.write(exact_groups(docs).select("doc_id", "kept", "text_sha256"), "found")
    plain, rest = parted(docs, scratch)
    gone = scratch.write(found.where(~F.col("kept")).select("doc_id"), "gone")
    out = plain.join(few_ids(gone), "doc_id", "left_anti").select(docs.columns)
    if rest is None:
        return out
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " ")
    stays = found.where("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__hash"))
    rest = rest.withColumn("__text", F.sha2(text, 256))
    once = rest.join(stays, (F.col("__text") == F.col("__hash")) & F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi").dropDuplicates(["__text"])
    return out.union(once.select(docs.columns))
