"""Exact n-gram Jaccard join by PartEnum signatures, and its connected components.

Two sets of sizes a and b with a Jaccard similarity of at least p % differ in at most
``(100 - p) (a + b) / (100 + p)`` features. Sizes are cut into bands; a set belongs to the tag of
its own band and, if a partner could be there, to that of the next. For a tag, where sets differ in at most k features,
the domain of features (64-bit hashes) is cut into ``n1`` ranges and each into ``n2``. With at
most k differences some of the n1 have at most ``k2`` of them, and there the two sets agree on
``n2 - k2`` of the smaller ranges: for each such subset a signature is the hash of the tag, the
subset and what the set has in it. Linked sets share a signature for certain, nothing is sampled.
A poor signature, of next to no features, would be shared by unrelated sets, so there are some
``spare`` ranges more than it takes: a linked pair agrees in ``spare + 1`` of the n1 at least, so a
set with poor signatures in no more than ``spare`` of them leaves those out and still meets each
partner in a rich one; other sets send all.

What shares a signature is a bucket. Buckets are worked off as in ``near_dedup``: equal sets
are one class, members are held against two leaders, then members of different components that
share a bucket against each other, in blocks, and askers against whole components on full sets.
There the signature of MinHash is replaced by a parity sketch: features folded onto bits by
exclusive or, which differ in no more bits than the sets in features, so the test leaves no
linked pair out. Every link that is used is confirmed on full sets.

Null or empty texts have an empty set and no links. Rows that repeat a doc_id with the same text
are one document; with unlike texts, or without a doc_id, they are documents of their own.
A component's id is its least doc_id, null if it has none. Each row is returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations
from math import ceil, comb, exp, factorial, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from tidemark.llm.near_dedup import BLOCK, NearDuplicates, Shingler, full_sets, shared_size
from tidemark.llm.shared import Scratch, few_ids, parted

GROWTH = 1.3  # of size bands
LARGEST = 1 << 31  # features of a set
ENUMERATED = 9  # up to so many differences one range is cut and all subsets enumerated
SPLIT = (1, 0)  # n2 and k2 beyond
RICH = 2  # features that a signature should cover
ROWS_AT_ONCE = 2_000  # of small buckets in a group of a task
SIGNED = "doc_id long, n_shingles long, d0 long, d1 long, sig binary, bands array<long>"


def most_differences(total: int, percent: int) -> int:
    """Of two linked sets with so many features together."""
    return (100 - percent) * total // (100 + percent)


class Tag:
    """How sets of one size band, from ``low`` to ``high``, and their smaller partners are signed."""

    def __init__(self, low: int, high: int, percent: int):
        self.low, self.high = low, high
        k = most_differences(2 * high, percent)
        if k <= ENUMERATED:
            self.n1, self.n2, self.k2, self.spare = 1, k + 2 if k else 1, k, 0
        else:
            self.n2, self.k2 = SPLIT
            least = k // (self.k2 + 1) + 1
            self.spare, more = 0, ceil(self._poor(least))
            while self.spare < more <= least:
                self.spare, more = more, ceil(self._poor(least + more))
            self.spare = self.spare if more <= least else 0  # too small for spare ranges: all are sent
            self.n1 = least + self.spare

    def _poor(self, n1: int) -> float:
        """How many of ``n1`` ranges hold a poor signature, in nearly all sets of the band's middle size."""
        each = (self.low + self.high) / 2 / n1 * (self.n2 - self.k2) / self.n2
        one = exp(-each) * sum(each**j / factorial(j) for j in range(RICH))
        mean = n1 * min(1.0, one * comb(self.n2, self.k2))
        return mean + 3 * sqrt(mean)

    def subsets(self) -> np.ndarray:
        """A row for each subset of ``n2 - k2`` of the smaller ranges."""
        chosen = list(combinations(range(self.n2), self.n2 - self.k2))
        out = np.zeros((len(chosen), self.n2), dtype=np.uint64)
        for row, those in zip(out, chosen, strict=True):
            row[list(those)] = 1
        return out


def tags(percent: int) -> list[Tag]:
    """Bands of sizes from 1 on; partners of a set are in its own band or the one beside it."""
    out, low, growth = [], 1, max(GROWTH, 100 / percent + 0.01)
    while low < LARGEST:
        after = max(low + 1, ceil(low * growth))
        out.append(Tag(low, after - 1, percent))
        low = after
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Signer:
    """Signatures and sketches of sets, given as sorted hashes."""

    def __init__(self, percent: int, known: list[Tag]):
        self.percent, self.tags, self.lows = percent, known, np.array([t.low for t in known])
        self.made: dict[int, tuple] = {}

    def _ready(self, number: int) -> tuple:
        if number not in self.made:
            tag = self.tags[number]
            pieces = tag.n1 * tag.n2
            edges = np.array([(k << 64) // pieces for k in range(1, pieces)], dtype=np.uint64)
            subsets = tag.subsets()
            own = np.uint64(number + 1) << np.uint64(48)
            names = mixed(own + np.arange(tag.n1 * len(subsets), dtype=np.uint64)).reshape(tag.n1, -1)
            self.made[number] = (edges, subsets, names)
        return self.made[number]

    def _of_tag(self, hashes: np.ndarray, sums: np.ndarray, number: int) -> np.ndarray:
        tag, (edges, subsets, names) = self.tags[number], self._ready(number)
        cuts = np.concatenate(([0], np.searchsorted(hashes, edges), [len(hashes)]))
        within = (sums[cuts[1:]] - sums[cuts[:-1]]).reshape(tag.n1, tag.n2)
        counts = np.diff(cuts).reshape(tag.n1, tag.n2)
        keys = mixed((within @ subsets.T) ^ names)
        poor = counts @ subsets.T.astype(np.int64) < RICH  # alike in sets that agree on the subset
        return keys.ravel() if poor.any(axis=1).sum() > tag.spare else keys[~poor]

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        n = len(hashes)
        if not n:
            return np.empty(0, dtype=np.int64)
        sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(mixed(hashes), dtype=np.uint64)))
        own = int(np.searchsorted(self.lows, n, "right")) - 1
        out = [self._of_tag(hashes, sums, own)]
        if own + 1 < len(self.tags) and 100 * n >= self.percent * self.tags[own + 1].low:
            out.append(self._of_tag(hashes, sums, own + 1))
        return np.unique(np.concatenate(out)).view(np.int64)


def sketch(hashes: np.ndarray) -> bytes:
    """Parities of the features that fall on each bit; there are twice as many bits as features, at least."""
    width = max(64, 1 << (2 * len(hashes) - 1).bit_length())
    ones = np.bincount((hashes & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(ones.astype(np.uint8), bitorder="little").tobytes()


def folded(bits: bytes, size: int) -> np.ndarray:
    """A sketch on ``size`` bytes."""
    x = np.frombuffer(bits, dtype=np.uint8)
    while len(x) > size:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def differing(a: bytes, b: bytes) -> int:
    size = min(len(a), len(b))
    return int(np.bitwise_count(folded(a, size) ^ folded(b, size)).sum())


class NgramJoin(NearDuplicates):
    """One run over ``docs`` (doc_id, text), whose ids are distinct."""

    def __init__(self, docs: DataFrame, words: int = 4, percent: int = 85):
        super().__init__(docs, words, percent)
        self.tags = tags(percent)

    def _signed(self) -> DataFrame:
        """Set size, digest of the set, sketch and signatures of each row."""
        words, percent, known = self.words, self.percent, self.tags

        def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            shingles, signer = Shingler(words), Signer(percent, known)
            for batch in batches:
                rows = []
                for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                    s = shingles(text)
                    d0, d1 = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), dtype=np.int64).tolist()
                    rows.append((doc_id, len(s), d0, d1, sketch(s) if len(s) else b"", signer.keys(s)))
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in SIGNED.split(", ")])

        return self.docs.mapInPandas(make, SIGNED)

    def _classes(self) -> None:
        scratch = self.scratch
        made = scratch.write(self._signed(), "signed")
        same = made.where("n_shingles > 0").groupBy("d0", "d1").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("size")).where("size > 1")
        same = scratch.write(same.drop("size"), "same")
        known = made.join(same, ["d0", "d1"], "left").withColumn("class_id", F.when(F.col("n_shingles") > 0, F.coalesce("least", "doc_id")).otherwise(F.col("doc_id")))
        self.members = scratch.write(known.select("doc_id", "n_shingles", "class_id"), "members")
        reps = known.where("n_shingles > 0 and class_id = doc_id")
        self.reps = scratch.write(reps.select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "sig"), "reps")
        copies = scratch.write(self.members.where("class_id <> doc_id").select("doc_id"), "copies")
        self.in_bands = made.join(few_ids(copies), "doc_id", "left_anti").select(F.col("doc_id").alias("rep"), F.explode("bands").alias("key"))

    def _buckets(self) -> None:
        super()._buckets()
        for name in ("signed", "shared_keys"):
            self.scratch.drop(name)

    def _asked(self, label: DataFrame) -> DataFrame:
        """(rep, other, mate): members to hold against another component, with which they share a
        bucket and a sketch that allows a link; ``mate`` is its member of the most similar sketch.

        Large buckets are cut into blocks of both sides; small ones go many to a group, side by side.
        """
        rows = self._open(label).join(self.reps.select("rep", "n", "sig"), "rep")
        groups = 1 + (self.scratch.spark.read.parquet(f"{self.scratch.root}/many").agg(F.sum("size")).first()[0] or 0) // ROWS_AT_ONCE
        down, over = (F.ceil(F.col(c) / F.lit(BLOCK)).cast("int") for c in ("size", "minors"))
        large, spot = F.col("size") > BLOCK, F.xxhash64("rep")
        cell = F.when(large, F.col("key")).otherwise(F.pmod(F.xxhash64("key"), F.lit(groups))).alias("cell")
        row, col = F.pmod(spot, down).cast("int"), F.pmod(spot, over).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
        own = [large.alias("large"), cell, "key", "rep", "component", "n", "sig"]
        held = rows.select(*own, F.lit(False).alias("asks"), row.alias("r"), every(over).alias("c"))
        asks = rows.where("minor").select(*own, F.lit(True).alias("asks"), every(down).alias("r"), col.alias("c"))
        percent = self.percent

        def compare(cells: pd.DataFrame) -> pd.DataFrame:
            cells = cells.sort_values(["key", "asks"], kind="stable")
            keys, asking, sizes, comps, reps = (cells[c].to_numpy() for c in ("key", "asks", "n", "component", "rep"))
            sigs, found = cells["sig"].tolist(), []
            starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            for lo, hi in zip(starts, [*starts[1:], len(keys)], strict=True):
                mid = lo + int(np.searchsorted(asking[lo:hi], True))
                if lo == mid or mid == hi:
                    continue
                width = min(map(len, sigs[lo:hi]))
                y = np.stack([folded(x, width) for x in sigs[lo:mid]])
                for k in range(mid, hi):
                    total = sizes[lo:mid] + sizes[k]
                    fits = np.flatnonzero((comps[lo:mid] != comps[k]) & (100 * np.minimum(sizes[lo:mid], sizes[k]) >= percent * np.maximum(sizes[lo:mid], sizes[k])))
                    off = np.bitwise_count(y[fits] ^ folded(sigs[k], width)).sum(axis=1, dtype=np.int64)
                    near = off * (100 + percent) <= (100 - percent) * total[fits]
                    fits, off = fits[near], off[near]
                    order = np.lexsort((reps[lo:mid][fits], off))
                    others, first = np.unique(comps[lo:mid][fits[order]], return_index=True)
                    at = order[first]
                    found += zip([int(reps[k])] * len(others), others.tolist(), reps[lo:mid][fits[at]].tolist(), off[at].tolist())
            return pd.DataFrame(found, columns=["rep", "other", "mate", "off"], dtype="int64")

        compared = held.union(asks).groupBy("large", "cell", "r", "c").applyInPandas(compare, "rep long, other long, mate long, off long")
        return compared.groupBy("rep", "other").agg(F.min_by("mate", F.struct("off", "mate")).alias("mate"))

    def _may_link(self, near: DataFrame) -> DataFrame:
        percent = self.percent

        @F.pandas_udf(BooleanType())
        def allowed(a: pd.Series, b: pd.Series, total: pd.Series) -> pd.Series:
            return pd.Series([differing(x, y) * (100 + percent) <= (100 - percent) * n for x, y, n in zip(a, b, total, strict=True)], dtype="bool")

        return near.where(allowed("sa", "sb", F.col("na") + F.col("nb")))

    def _confirmed(self, pairs: DataFrame) -> DataFrame:
        """Links (u, v) among ``pairs`` (a, b): sizes and sketches that allow a link, then the percentage on full sets."""
        scratch, k = self.scratch, self.rounds
        pairs = scratch.write(pairs, f"pairs_{k}")
        side = lambda c: self.reps.select(F.col("rep").alias(c), F.col("n").alias(f"n{c}"), F.col("sig").alias(f"s{c}"))
        near = pairs.join(side("a"), "a").join(side("b"), "b")
        near = self._may_link(near.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * self.percent))
        return self._on_full_sets(scratch.write(near.select("a", "b"), f"near_{k}"), k)

    def _on_full_sets(self, near: DataFrame, k: int) -> DataFrame:
        """Links (u, v) among ``near`` (a, b)."""
        scratch = self.scratch
        need = scratch.write(near.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), f"need_{k}")
        sets = scratch.write(full_sets(self.docs.join(few_ids(need), "doc_id", "left_semi"), self.words), f"sets_{k}")
        of = lambda c: sets.select(F.col("doc_id").alias(c), F.col("n").alias(f"n{c}"), F.col("hashes").alias(f"h{c}"))
        sized = near.join(of("a"), "a").join(of("b"), "b").withColumn("both", shared_size("ha", "hb"))
        links = sized.where(F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * self.percent)
        links = scratch.write(links.select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), f"links_{k}")
        for name in ("pairs", "near", "need", "sets"):
            scratch.drop(f"{name}_{k}")
        return links


def linked(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id of each row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "ngram_join")
    plain, rest = parted(docs, scratch)
    text = F.col("text").cast("string").alias("text")
    own = plain.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    if rest is None:
        return NgramJoin(own, words, percent).run().select("doc_id", "n_shingles", "component_id")
    keyed = scratch.write(rest.select(F.col("__key").alias("node"), F.col("doc_id").cast("long").alias("id"), F.lit(True).alias("by_key")), "keyed")
    found = NgramJoin(own.union(rest.select("__key", text).dropDuplicates(["__key"])), words, percent).run()
    found = found.select(F.col("doc_id").alias("node"), "n_shingles", F.col("component_id").alias("label"))
    every = found.join(keyed, "node", "left").withColumn("doc_id", F.when(F.col("by_key"), F.col("id")).otherwise(F.col("node")))
    every = scratch.write(every.select("doc_id", "n_shingles", "label"), "every")
    least = every.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return every.join(least, "label").select("doc_id", "n_shingles", "component_id")
