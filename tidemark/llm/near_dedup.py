"""MinHash near-duplicate detection: universal hash minima, banding, verification, components.

A document's set is its distinct word shingles, as 64-bit hashes. Documents with equal sets
form a class, and one representative of each goes on. ``BANDS`` bands of ``ROWS`` minima
deal representatives into buckets: two sets with Jaccard similarity 0.8 miss every bucket
with probability 5.2e-6. A pair is verified on signatures (a set pair at 0.8 falls below
``LEAST_SHARE`` with probability 1e-5) and sizes, and then confirmed on the full sets. So a
pair at 0.8 is found with probability 0.99998, and more similar ones are missed less often.

No bucket emits all its pairs. First each member is paired with two leaders: the least
member, and the one that shares most buckets with others. Confirmed links give components.
What is left are pairs of one bucket in different components: there, members outside the
bucket's largest component are compared with all others, in blocks, on signatures, and
each asks about the components that it resembles. It is first held against the most similar
member of each, which settles most. The askers that are left and the components' members
then meet in cells of a bounded number of rows and shingles, on full sets. As links inside a
component do not change it, the components are those of all pairs in buckets.

Null or empty texts have an empty set and no links. Rows that repeat a doc_id with the same
text are one document; with unlike texts, or without a doc_id, they are documents of their
own, told apart by a hash of id and text. A component's id is its least doc_id, null if it has
none, and ``kept`` is true where that is the row's doc_id (null beside null). Each row is
returned; ``without_near_copies`` leaves one row of each component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from tidemark.llm.components import components
from tidemark.llm.shared import Scratch, few_ids, parted

BANDS, ROWS = 40, 6
HASHES = BANDS * ROWS
LEAST_SHARE = 0.68
CACHED_WORDS = 200_000
BLOCK = 512
CELL, CELL_ROWS = 1 << 16, 64  # shingles and rows on each side of a cell
_rng = np.random.default_rng(20240307)
MULT = (_rng.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)).astype(np.uint32)
PLUS = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
BAND_MULT = _rng.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
BAND_PLUS = _rng.integers(0, 1 << 63, BANDS, dtype=np.uint64)
SIGNED = "doc_id long, n_shingles long, d0 long, d1 long, sig binary, bands array<long>"


class Shingler:
    """Distinct shingles of a text as sorted 64-bit hashes; words' hashes are kept up to a bound."""

    def __init__(self, words: int):
        self.words, self.known = words, {}

    def __call__(self, text: str | None) -> np.ndarray:
        parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not parts:
            return np.empty(0, dtype=np.uint64)
        known = self.known
        if len(known) > CACHED_WORDS:
            known.clear()
        for w in set(parts).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, parts), dtype=np.uint64, count=len(parts))
        k = min(self.words, len(parts))
        out = np.full(len(parts) - k + 1, k, dtype=np.uint64)
        for j in range(k):
            out *= np.uint64(0x9E3779B97F4A7C15)
            out += h[j : j + len(out)]
            out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
        return np.unique(out)


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of each universal hash function over a set."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(x), 256):
        block = x[at : at + 256, None] * MULT
        block += PLUS
        np.minimum(least, block.min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band, which tells bands apart."""
    mixed = (least.reshape(-1, BANDS, ROWS).astype(np.uint64) * BAND_MULT).sum(axis=2, dtype=np.uint64) + BAND_PLUS
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0x94D049BB133111EB)
    return (mixed ^ (mixed >> np.uint64(30))).view(np.int64)


def signed(docs: DataFrame, words: int) -> DataFrame:
    """Set size, digest of the set, 16-bit signature and band keys of each row."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingler(words)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                s = shingles(text)
                if not len(s):
                    rows.append((doc_id, 0, 0, 0, b"", []))
                    continue
                d0, d1 = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), dtype=np.int64).tolist()
                least = minima(s)
                rows.append((doc_id, len(s), d0, d1, (least & np.uint32(0xFFFF)).astype(np.uint16).tobytes(), band_keys(least)[0]))
            yield pd.DataFrame(rows, columns=["doc_id", "n_shingles", "d0", "d1", "sig", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(make, SIGNED)


@F.pandas_udf(IntegerType())
def equal_minima(a: pd.Series, b: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype="int32")
    x, y = (np.frombuffer(b"".join(s), dtype=np.uint16).reshape(-1, HASHES) for s in (a, b))
    return pd.Series((x == y).sum(axis=1, dtype=np.int32))


@F.pandas_udf(LongType())
def shared_size(a: pd.Series, b: pd.Series) -> pd.Series:
    pairs = ((np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)) for x, y in zip(a, b, strict=True))
    return pd.Series([len(np.intersect1d(x, y, assume_unique=True)) for x, y in pairs], dtype="int64")


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, size and sorted hashes of each row's set."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingler(words)
        for batch in batches:
            found = [shingles(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n": [len(s) for s in found], "hashes": [s.tobytes() for s in found]})

    return docs.mapInPandas(make, "doc_id long, n long, hashes binary")


class NearDuplicates:
    """One run over ``docs`` (doc_id, text), whose ids are distinct; its steps share tables of the shared folder."""

    def __init__(self, docs: DataFrame, words: int = 5, percent: int = 80):
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        self.words, self.percent = words, percent
        self.scratch = Scratch(docs.sparkSession, "near")
        self.rounds = 0

    def run(self) -> DataFrame:
        """doc_id, n_shingles, class_id, component_id of each row."""
        self._classes()
        self._buckets()
        label = self._merge(None, self._confirmed(self._led()))
        asked = self.scratch.write(self._asked(label), "asked")
        label = self._merge(label, self._confirmed(asked.select(F.least("rep", "mate").alias("a"), F.greatest("rep", "mate").alias("b")).distinct()))
        label = self._merge(label, self._across(label, self._left_over(label, asked)))
        out = self.members.join(label, self.members["class_id"] == label["node"], "left")
        return out.select("doc_id", "n_shingles", "class_id", F.coalesce("component", "class_id").alias("component_id"))

    def _classes(self) -> None:
        scratch = self.scratch
        made = scratch.write(signed(self.docs, self.words), "signed")
        same = made.where("n_shingles > 0").groupBy("d0", "d1").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("size")).where("size > 1")
        same = scratch.write(same.drop("size"), "same")
        known = made.join(same, ["d0", "d1"], "left").withColumn("class_id", F.when(F.col("n_shingles") > 0, F.coalesce("least", "doc_id")).otherwise(F.col("doc_id")))
        self.members = scratch.write(known.select("doc_id", "n_shingles", "class_id"), "members")
        reps = known.where("n_shingles > 0 and class_id = doc_id")
        reps = scratch.write(reps.select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "sig", "bands"), "reps")
        scratch.drop("signed")
        self.reps = reps
        self.in_bands = reps.select("rep", F.explode("bands").alias("key"))

    def _buckets(self) -> None:
        """Buckets of two or more, with two leaders each; and their members."""
        scratch = self.scratch
        shared = scratch.write(self.in_bands.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "shared_keys")
        self.placed = placed = scratch.write(self.in_bands.join(shared, "key"), "placed")
        degree = scratch.write(placed.groupBy("rep").agg(F.sum("size").alias("degree")), "degree")
        leads = placed.join(degree, "rep").groupBy("key").agg(F.min("rep").alias("least"), F.max(F.struct("degree", (-F.col("rep")).alias("r"))).alias("top"))
        leads = leads.select("key", "least", (-F.col("top.r")).alias("central"))
        self.leads = scratch.write(leads, "leads")

    def _led(self) -> DataFrame:
        """Members beside their buckets' leaders."""
        both = self.placed.join(self.leads, "key").select("rep", F.explode(F.array("least", "central")).alias("lead"))
        return both.where("rep <> lead").select(F.least("rep", "lead").alias("a"), F.greatest("rep", "lead").alias("b")).distinct()

    def _open(self, label: DataFrame) -> DataFrame:
        """Members of buckets that hold several components; ``minor`` if outside the largest."""
        scratch = self.scratch
        known = self.placed.where("size > 2").join(label.withColumnRenamed("node", "rep"), "rep", "left")
        known = scratch.write(known.select("key", "rep", F.coalesce("component", "rep").alias("component")), "known")
        parts = known.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
        many = parts.groupBy("key").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", "component")).alias("top")).where("parts > 1")
        many = scratch.write(many.select("key", "size", (F.col("size") - F.col("top.n")).alias("minors"), F.col("top.component").alias("main")), "many")
        return known.join(many, "key").withColumn("minor", F.col("component") != F.col("main"))

    def _asked(self, label: DataFrame) -> DataFrame:
        """(rep, other, mate): members to hold against another component, with which they share
        a bucket and a similar signature, most similar to that of ``mate``. All pairs of a bucket
        that two components share are compared, in blocks; a member asks about a component once,
        however many are similar."""
        rows = self._open(label).join(self.reps.select("rep", "n", "sig"), "rep")
        down, over = (F.ceil(F.col(c) / F.lit(BLOCK)).cast("int") for c in ("size", "minors"))
        spot = F.xxhash64("rep")
        row, col = F.pmod(spot, down).cast("int"), F.pmod(spot, over).cast("int")
        held = rows.select("key", "rep", "component", "n", "sig", F.lit(False).alias("asks"), row.alias("r"), F.explode(F.sequence(F.lit(0), over - 1)).alias("c"))
        asks = rows.where("minor").select("key", "rep", "component", "n", "sig", F.lit(True).alias("asks"), F.explode(F.sequence(F.lit(0), down - 1)).alias("r"), col.alias("c"))
        percent = self.percent

        def compare(cell: pd.DataFrame) -> pd.DataFrame:
            q, p = cell[cell["asks"]], cell[~cell["asks"]]
            who, what, mates, shares = [], [], [], []
            if len(q) and len(p):
                x, y = (np.frombuffer(b"".join(s["sig"]), dtype=np.uint16).reshape(-1, HASHES) for s in (q, p))
                sizes, comps, reps = (p[c].to_numpy() for c in ("n", "component", "rep"))
                for k, (rep, n, comp) in enumerate(zip(q["rep"], q["n"], q["component"], strict=True)):
                    fits = np.flatnonzero((comps != comp) & (100 * np.minimum(sizes, n) >= percent * np.maximum(sizes, n)))
                    share = (y[fits] == x[k]).sum(axis=1)
                    fits, share = fits[share >= LEAST_SHARE * HASHES], share[share >= LEAST_SHARE * HASHES]
                    order = np.lexsort((reps[fits], -share))
                    others, first = np.unique(comps[fits[order]], return_index=True)
                    who.extend([rep] * len(others))
                    what.extend(others.tolist())
                    mates.extend(reps[fits[order[first]]].tolist())
                    shares.extend(share[order[first]].tolist())
            return pd.DataFrame({"rep": who, "other": what, "mate": mates, "share": shares}, dtype="int64")

        found = held.union(asks).groupBy("key", "r", "c").applyInPandas(compare, "rep long, other long, mate long, share long")
        return found.groupBy("rep", "other").agg(F.max_by("mate", F.struct("share", "mate")).alias("mate"))

    def _left_over(self, label: DataFrame, asked: DataFrame) -> DataFrame:
        """(rep, other) of ``asked`` that still are in different components, as these are now."""
        now = lambda c: label.select(F.col("node").alias(c), F.col("component").alias(f"now_{c}"))
        both = asked.select("rep", "other").join(now("rep"), "rep", "left").join(now("other"), "other", "left")
        other = F.coalesce("now_other", "other")
        return both.where(other != F.coalesce("now_rep", "rep")).select("rep", other.alias("other")).distinct()

    def _across(self, label: DataFrame, asked: DataFrame) -> DataFrame:
        """Links (u, v) of members to components that they asked about, confirmed on full sets.

        A component's members and its askers are dealt to cells by how many rows and shingles
        they are; each cell finds its shared shingles with one sorted list of its members'.
        """
        scratch, percent = self.scratch, self.percent
        asked = scratch.write(asked, "left_over")
        if asked.isEmpty():
            return asked.select(F.col("rep").alias("u"), F.col("other").alias("v"))
        sizes = self.reps.select("rep", "n")
        comps = asked.select(F.col("other").alias("component")).distinct()
        grouped = label.join(comps, "component").select("component", F.col("node").alias("rep"))
        single = comps.join(label, "component", "left_anti").select("component", F.col("component").alias("rep"))
        held = scratch.write(grouped.union(single).join(sizes, "rep").select("component", "rep", "n"), "held")
        asks = scratch.write(asked.join(sizes, "rep").select(F.col("other").alias("component"), "rep", "n"), "asks")
        most = lambda: F.greatest(F.ceil(F.sum("n") / F.lit(CELL)), F.ceil(F.count(F.lit(1)) / F.lit(CELL_ROWS))).cast("int")
        blocks = lambda df, name: df.groupBy("component").agg(most().alias(name))
        grid = scratch.write(blocks(held, "down").join(blocks(asks, "over"), "component"), "grid")
        spot = F.xxhash64("rep")
        one = lambda n: F.pmod(spot, F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        a = held.join(grid, "component").select("component", "rep", F.lit(False).alias("asks"), one("down").alias("r"), every("over").alias("c"))
        b = asks.join(grid, "component").select("component", "rep", F.lit(True).alias("asks"), every("down").alias("r"), one("over").alias("c"))
        need = scratch.write(held.select("rep").union(asks.select("rep")).distinct().withColumnRenamed("rep", "doc_id"), "need_across")
        sets = scratch.write(full_sets(self.docs.join(need, "doc_id", "left_semi"), self.words).withColumnRenamed("doc_id", "rep"), "sets_across")

        def confirm(cell: pd.DataFrame) -> pd.DataFrame:
            q, p = cell[cell["asks"]], cell[~cell["asks"]]
            u, v = [], []
            if len(q) and len(p):
                parts = [np.frombuffer(h, dtype=np.uint64) for h in p["hashes"]]
                n = np.array([len(x) for x in parts])
                every = np.concatenate(parts)
                order = np.argsort(every, kind="stable")
                every, owner = every[order], np.repeat(np.arange(len(parts)), n)[order]
                reps = p["rep"].to_numpy()
                for rep, raw in zip(q["rep"], q["hashes"], strict=True):
                    x = np.frombuffer(raw, dtype=np.uint64)
                    lo, hi = np.searchsorted(every, x, "left"), np.searchsorted(every, x, "right")
                    runs = hi - lo
                    at = np.repeat(lo - np.concatenate(([0], np.cumsum(runs)[:-1])), runs) + np.arange(runs.sum())
                    both = np.bincount(owner[at], minlength=len(parts))
                    linked = np.flatnonzero(100 * both >= percent * (len(x) + n - both))
                    if len(linked):
                        u.append(rep)
                        v.append(int(reps[linked[0]]))
            return pd.DataFrame({"u": u, "v": v}, dtype="int64")

        cells = a.union(b).join(sets, "rep").groupBy("component", "r", "c").applyInPandas(confirm, "u long, v long")
        links = scratch.write(cells.distinct(), "links_across")
        for name in ("left_over", "held", "asks", "grid", "need_across", "sets_across"):
            scratch.drop(name)
        return links

    def _confirmed(self, pairs: DataFrame) -> DataFrame:
        """Links (u, v) among ``pairs`` (a, b): similar signatures, then at least the percentage on full sets."""
        scratch, k = self.scratch, self.rounds
        pairs = scratch.write(pairs, f"pairs_{k}")
        side = lambda c: self.reps.select(F.col("rep").alias(c), F.col("n").alias(f"n{c}"), F.col("sig").alias(f"s{c}"))
        near = pairs.join(side("a"), "a").join(side("b"), "b")
        near = near.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * self.percent)
        near = scratch.write(near.where(equal_minima("sa", "sb") >= LEAST_SHARE * HASHES).select("a", "b"), f"near_{k}")
        need = scratch.write(near.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), f"need_{k}")
        sets = scratch.write(full_sets(self.docs.join(need, "doc_id", "left_semi"), self.words), f"sets_{k}")
        of = lambda c: sets.select(F.col("doc_id").alias(c), F.col("n").alias(f"n{c}"), F.col("hashes").alias(f"h{c}"))
        sized = near.join(of("a"), "a").join(of("b"), "b").withColumn("both", shared_size("ha", "hb"))
        links = sized.where(F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * self.percent)
        links = scratch.write(links.select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), f"links_{k}")
        for name in ("pairs", "near", "need", "sets"):
            scratch.drop(f"{name}_{k}")
        return links

    def _merge(self, label: DataFrame | None, links: DataFrame) -> DataFrame:
        """Labels (node, component) with ``links`` added, worked out on components as nodes."""
        scratch, k = self.scratch, self.rounds
        self.rounds += 1
        if label is None:
            return scratch.write(components(links, scratch), f"label_{k}")
        if links.isEmpty():
            return label
        top = lambda c: label.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
        lifted = links.join(top("u"), "u", "left").join(top("v"), "v", "left")
        lifted = lifted.select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v"))
        moved = scratch.write(components(lifted, scratch, f"cc{k}"), f"moved_{k}")
        was = label.join(moved.select(F.col("node").alias("component"), F.col("component").alias("now")), "component", "left")
        was = was.select("node", F.coalesce("now", "component").alias("component"))
        fresh = moved.join(label, "node", "left_anti")
        return scratch.write(was.union(fresh), f"label_{k}")


def _grouped(plain: DataFrame, rest: DataFrame | None, words: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, class_id, component_id, kept of each row; its ``node``, which is the
    doc_id or the key, and whether that is the one of its component that ``stays``."""
    scratch = Scratch(plain.sparkSession, "near")
    text = F.col("text").cast("string").alias("text")
    own = plain.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    if rest is None:
        kept = F.col("component_id") == F.col("doc_id")
        return NearDuplicates(own, words, percent).run().withColumns({"kept": kept, "node": F.col("doc_id"), "stays": kept})
    keyed = scratch.write(rest.select(F.col("__key").alias("node"), F.col("doc_id").cast("long").alias("id"), F.lit(True).alias("by_key")), "keyed")
    found = NearDuplicates(own.union(rest.select("__key", text).dropDuplicates(["__key"])), words, percent).run()
    every = found.withColumnsRenamed({"doc_id": "node", "component_id": "label"}).join(keyed, "node", "left")
    every = scratch.write(every.withColumn("doc_id", F.when(F.col("by_key"), F.col("id")).otherwise(F.col("node"))).drop("id", "by_key"), "every")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node"))
    least = scratch.write(every.groupBy("label").agg(F.min("doc_id").alias("component_id"), first.getField("node").alias("first")), "least")
    return every.join(least, "label").withColumns({"kept": F.col("doc_id").eqNullSafe(F.col("component_id")), "stays": F.col("node") == F.col("first")})


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, class_id, component_id, kept of each row of ``docs``."""
    found = _grouped(*parted(docs, Scratch(docs.sparkSession, "near")), words, percent)
    return found.select("doc_id", "n_shingles", "class_id", "component_id", "kept")


def without_near_copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs``, all columns, one row of each component: that with the least doc_id."""
    scratch = Scratch(docs.sparkSession, "near")
    plain, rest = parted(docs, scratch)
    found = scratch.write(_grouped(plain, rest, words, percent).select("node", "stays"), "stays")
    gone = scratch.write(found.where(~F.col("stays")).select(F.col("node").alias("doc_id")), "gone")
    out = plain.join(few_ids(gone), "doc_id", "left_anti").select(docs.columns)
    if rest is None:
        return out
    stays = found.where("stays").select(F.col("node").alias("__key")).distinct()
    return out.union(rest.join(stays, "__key", "left_semi").dropDuplicates(["__key"]).select(docs.columns))
