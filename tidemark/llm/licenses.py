r"""License scan: phrases in place, and an exact set-similarity join with notice templates.

DataFrame functions only. Words are runs of digits, letters and characters beyond ASCII,
with A-Z in lower case. ``PHRASES`` are found where their words stand consecutively.

The join finds every text block that holds at least ``threshold`` of a template's distinct
words, and all words that name its license (``NAMES``), so that another license's notice
does not pass by common words. Blocks are lines of at most ``SPREAD`` times the template's
words, whose names may stand on the next line; and, for templates that no line meets, all
runs of that many words of the document, wherever its lines end. So a wrapped notice is
found, and words scattered over a long line are not. Only template words can count, so
blocks are looked at through the templates' vocabulary, which is small and fixed; nothing
is lost by it. Template words are ordered by how many documents of the corpus hold them,
rarest first. A template with n words and needing k of them must share one of its first
n - k + 1 words (its prefix) with a block, and with the block's document. So:

* a block without a prefix word is not a candidate (tested on the raw text);
* length filter: a block with fewer than k template words is none either;
* positional filter: with a first shared word at place i of the template and j of the
  block's ordered words, at most 1 + min(n - i - 1, m - j - 1) can be shared;
* candidates are verified by counting shared words.

The templates and their order are tiny constants of the plan, not data. Texts are read twice:
once for their words, phrases and template words, of which a narrow table is kept, and once
for those with a prefix word, which are few and kept too.

Null text counts as empty. Rows are returned one for one; rows with equal or null doc_id are
told apart by their text, and get equal results if that is equal.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import Scratch

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
# Notices of public licenses and their labels.
TEMPLATES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2",
}

# Words that name each license; a template's own are those that it holds.
NAMES = {"mit": {"mit"}, "apache-2": {"apache", "2"}, "gpl-3": {"gnu", "3"}, "gpl": {"gnu"}, "cc-by-nc": {"cc", "by", "nc"}, "cc-by": {"creative", "commons", "attribution"}, "mpl-2": {"mozilla", "2"}}
SPREAD = 2


def worded(text: Column) -> Column:
    """The text's words, in their case, with one space between."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SEPARATORS, " "))


def spaces(s: Column) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))


def count_words(s: Column) -> Column:
    """Words of a string that ``worded`` made."""
    return F.when(s == "", F.lit(0)).otherwise(spaces(s) + 1).cast("long")


def phrases(words: Column) -> dict[str, Column]:
    """For each phrase, an array of the words' string split at its places; null without one."""
    low = F.translate(words, UPPER, LOWER)
    out = {}
    for phrase in PHRASES:
        some = F.lower(words).contains(phrase)
        out[phrase] = F.when(some, F.split(low, f"(?<![^ ]){phrase}(?![^ ])", -1))
    return out


def scan_phrases(docs: DataFrame, vocab: list[str]) -> DataFrame:
    """n_words, n_base, first_word, last_word and base labels of each row of (doc_id, text), and
    which words of ``vocab`` it holds."""
    df = docs.withColumn("words", worded(F.col("text"))).withColumn("n_words", count_words(F.col("words")))
    parts = phrases(F.col("words"))
    names = {p: f"parts{k}" for k, p in enumerate(parts)}
    df = df.withColumns({names[p]: c for p, c in parts.items()})
    first, last, hits, labels = [], [], [], []
    for phrase, label in PHRASES.items():
        c = F.col(names[phrase])
        found = F.coalesce(F.size(c) > 1, F.lit(False))
        hits.append(F.when(found, F.size(c) - 1).otherwise(0).cast("long"))
        first.append(F.when(found, spaces(F.element_at(c, 1)).cast("long")))  # a space follows each word before the place
        last.append(F.when(found, F.col("n_words") - spaces(F.element_at(c, -1)) - len(phrase.split())))
        labels.append(F.when(found, F.lit(label)))
    own = F.array_intersect(F.split(F.lower("words"), " "), F.array(*map(F.lit, vocab)))
    return df.select(
        "doc_id",
        F.xxhash64("text").alias("text_key"),
        own.alias("template_words"),
        "n_words",
        sum(hits[1:], hits[0]).alias("n_base"),
        F.least(*first).alias("first_word"),
        F.greatest(*last).alias("last_word"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))).alias("base"),
    )


def vocabulary(templates: dict[str, str]) -> list[str]:
    return sorted({w for t in templates for w in t.split()})


def document_counts(base: DataFrame, templates: dict[str, str]) -> dict[str, int]:
    """In how many documents each template word stands: one row per word of the vocabulary."""
    counted = base.select(F.explode("template_words").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    return {w: 0 for w in vocabulary(templates)} | {r["w"]: r["n"] for r in counted.collect()}


def prefix_index(counts: dict[str, int], templates: dict[str, str], threshold: float) -> list[dict]:
    """Each template's words, rarest first; how many it needs; its prefix."""
    out = []
    for text, label in templates.items():
        words = sorted(set(text.split()), key=lambda w: (counts[w], w))
        if len(words) > 63:
            raise ValueError(f"a template may have 63 distinct words: {text[:60]}")
        need = math.ceil(threshold * len(words) - 1e-9)
        names = sorted(NAMES.get(label, set()).intersection(words))
        out.append({"label": label, "words": words, "need": need, "prefix": words[: len(words) - need + 1], "names": names, "span": SPREAD * len(text.split())})
    return out


def similar_blocks(docs: DataFrame, index: list[dict], counts: dict[str, int], scratch: Scratch) -> DataFrame:
    """(doc_id, text_key, label, share) of each template that a line or a run of words meets."""
    order = sorted(counts, key=lambda w: (counts[w], w))
    prefix_words = sorted({w for t in index for w in t["prefix"]})
    some = r"(?i)(?<![0-9a-z\x{80}-\x{10FFFF}])(?:" + "|".join(map(re.escape, prefix_words)) + r")(?![0-9a-z\x{80}-\x{10FFFF}])"
    split = lambda text: F.split(F.translate(worded(text), UPPER, LOWER), " ")
    found = scratch.write(docs.where(F.col("text").rlike(some)).select("doc_id", F.xxhash64("text").alias("text_key"), "text"), "found")

    def candidates(blocks: DataFrame) -> DataFrame:
        """Blocks, with a column ``own`` of words, beside templates of whose words they hold enough."""
        blocks = blocks.withColumn("words", F.array_intersect(F.array(*map(F.lit, order)), "own"))
        blocks = blocks.where(F.size("words") >= min(t["need"] for t in index))
        joined = blocks.withColumn("word", F.explode("words")).join(F.broadcast(_prefixes(docs.sparkSession, index)), "word")
        place = F.array_position("words", F.col("word")) - 1
        most = 1 + F.least(F.col("length") - F.col("place") - 1, F.size("words") - place - 1)
        near = joined.where((F.size("words") >= F.col("need")) & (most >= F.col("need")))
        return near.withColumn("shared", F.size(F.array_intersect("words", "template"))).where("shared >= need")

    lines = found.withColumn("lines", F.split("text", "\n", -1)).select("doc_id", "text_key", F.posexplode("lines").alias("block", "line"), F.col("lines").alias("all"))
    lines = lines.where(F.col("line").rlike(some)).select("doc_id", "text_key", split(F.col("line")).alias("own"), split(F.get("all", F.col("block") + 1)).alias("next"))
    named = F.size(F.array_except("names", F.concat("own", "next"))) == 0
    by_line = candidates(lines).where((F.size("own") <= F.col("span")) & named)

    # A document and a template may meet by several prefix words; then one is enough.
    runs = candidates(found.select("doc_id", "text_key", split(F.col("text")).alias("own")))
    first = F.array_position(F.array_intersect("words", "template"), F.col("word")) == 1
    runs = runs.where(first & (F.size(F.array_except("names", "words")) == 0))
    runs = _in_runs(runs, index).where("shared >= need")

    share = (F.col("shared") / F.col("length")).alias("share")
    both = [df.select("doc_id", "text_key", "label", "template", F.lit(kind).alias("line"), share) for df, kind in ((by_line, True), (runs, False))]
    best = [F.max(F.when(F.col("line") == kind, F.col("share"))) for kind in (True, False)]
    return both[0].union(both[1]).groupBy("doc_id", "text_key", "label", "template").agg(F.coalesce(*best).alias("share")).drop("template")


def _in_runs(runs: DataFrame, index: list[dict]) -> DataFrame:
    """``runs`` with ``shared``: of all runs of ``span`` words that hold the template's names, the most
    distinct template words in one.

    A row for each place of a template word, with that word as one bit; a window over the places, in units
    in which every template's run is equally long, joins the bits of each run. So time grows with
    the places, and a window holds no more rows than a run has words.
    """
    whole = math.lcm(*(t["span"] for t in index))
    bit = lambda w: F.call_function("shiftleft", F.lit(1).cast("long"), F.array_position("template", w).cast("int") - 1)
    keep = ["doc_id", "text_key", "label", "number", "template", "length", "need", "span"]
    every = F.aggregate("names", F.lit(0).cast("long"), lambda m, w: m.bitwiseOR(bit(w)))
    places = runs.select(*keep, every.alias("all_names"), F.posexplode("own").alias("at", "w")).where(F.array_contains("template", F.col("w")))
    places = places.select(*keep, "all_names", bit(F.col("w")).alias("mask"), (F.col("at") * (F.lit(whole) / F.col("span")).cast("long")).alias("at"))
    over = Window.partitionBy("doc_id", "text_key", "number").orderBy("at").rangeBetween(0, whole - 1)
    held = places.withColumn("held", F.bit_or("mask").over(over)).where(F.col("held").bitwiseAND(F.col("all_names")) == F.col("all_names"))
    first = [F.first(c).alias(c) for c in ("label", "template", "length", "need")]
    return held.groupBy("doc_id", "text_key", "number").agg(*first, F.max(F.bit_count("held")).alias("shared"))


def _prefixes(spark: SparkSession, index: list[dict]) -> DataFrame:
    """A row for each prefix word of each template: as many as the templates' words at most."""
    rows = [(w, place, t | {"number": k}) for k, t in enumerate(index) for place, w in enumerate(t["prefix"])]
    strings = lambda ws: F.array(*map(F.lit, ws)).cast("array<string>")
    entry = lambda w, place, t: F.struct(
        F.lit(w).alias("word"), F.lit(place).alias("place"), F.lit(t["label"]).alias("label"), strings(t["words"]).alias("template"), F.lit(len(t["words"])).alias("length"),
        F.lit(t["need"]).alias("need"), strings(t["names"]).alias("names"), F.lit(t["span"]).alias("span"), F.lit(t["number"]).alias("number"),
    )
    return spark.range(1, numPartitions=1).select(F.explode(F.array(*(entry(*r) for r in rows))).alias("e")).select("e.*")


def scan(docs: DataFrame, threshold: float = 0.8, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of each row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scratch = Scratch(docs.sparkSession, "licenses")
    base = scratch.write(scan_phrases(docs, vocabulary(templates)), "base")
    counts = document_counts(base, templates)
    hits = similar_blocks(docs, prefix_index(counts, templates, threshold), counts, scratch)
    marks = hits.groupBy(F.col("doc_id").alias("m_id"), F.col("text_key").alias("m_key")).agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    marks = scratch.write(marks, "marks")
    out = base.join(marks, F.col("text_key").eqNullSafe(F.col("m_key")) & F.col("doc_id").eqNullSafe(F.col("m_id")), "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    score = F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0)))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"))
