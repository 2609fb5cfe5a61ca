"""Cross-entropy difference of documents under matched target and background bigram models.

One vocabulary serves both models: all words of the corpus, with A-Z in lower case, parted by
ASCII white space, whatever their length, and a mark that ends a document and stands before
the next one's first word. Both models count every word and every pair of neighbours; the
target's in the documents it is given, the background's in all. The form is the same and the
smoothing fits each model's own size: with N tokens and V words,

    p(w) = (count(w) + 1) / (N + V)
    p(w | v) = (count(v, w) + s * p(w)) / (count(v) + s),   s = sqrt(N + 1)

as the square root of the number of trials is the minimax weight of a prior. A document's losses
are means over its words and its end, and its score is the target's loss less the background's:
the lower, the more like the target.

Nothing is left out, and no table of counts is collected or broadcast. Tasks turn texts into
blocks of about ``TOKENS`` tokens: sequences of numbers in the block's own vocabulary. Each
block asks for its distinct words and pairs once, as sorted 64-bit hashes with its own counts,
so that a word of any frequency is one entry of a block. Groups of a range of hashes sum the
counts and answer in the same order, and blocks look their tokens' losses up in the answers.
So sequences move once, questions once and answers once, compressed: about three times the
size of the table in all. There are tokens / ``ENTRIES`` groups, and so many questions for each
block: with very many tokens, raise both constants so that a question keeps thousands of entries.

Target ids are broadcast up to a checked number; more are joined to the texts by doc_id. Null and
empty texts have no tokens and score 0. Rows that repeat a doc_id count each, and all are of
the target if the id is; a repeated target id counts once, and a null one never.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import Scratch, few_ids

TOKENS = 1_000_000
ENTRIES = 2_000_000
LEAST_GROUPS = 64
MOST_DOCS = 100_000
MARK = 0  # the number of the mark between documents, in every block
SEQUENCES = "block long, tokens long, near_tokens long, ids binary, hashes binary, seq binary"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, their bytes by significance, compressed."""
    planes = (np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpacked(raw: bytes, *kinds: str) -> list[np.ndarray]:
    data, widths = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=np.uint8), [np.dtype(k).itemsize for k in kinds]
    n, out, at = len(data) // sum(widths), [], 0
    for kind, width in zip(kinds, widths, strict=True):
        out.append(np.ascontiguousarray(data[at : at + n * width].reshape(width, n).T).view(kind).ravel())
        at += n * width
    return out


class Numbers(dict):
    """Words by order of first use, from 1."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self) + 1
        return n


class Block:
    """Documents as one sequence of word numbers, each followed by the mark."""

    def __init__(self):
        self.numbers, self.parts, self.tokens = Numbers(), [], 0
        self.ids: list[tuple[int, bool, int, bool]] = []  # doc_id, null, words, of the target

    def add(self, doc_id: str | None, text: str | None, near: bool) -> None:
        words = words_of(text)
        self.ids.append((int(doc_id or 0), doc_id is None, len(words), near))
        if words:
            own = np.empty(len(words) + 1, dtype=np.uint32)
            own[:-1] = np.fromiter(map(self.numbers.__getitem__, words), dtype=np.uint32, count=len(words))
            own[-1] = MARK
            self.parts.append(own)
            self.tokens += len(own)

    def full(self) -> bool:
        return self.tokens >= TOKENS or len(self.ids) >= MOST_DOCS

    def frame(self) -> pd.DataFrame:
        """Its row: the most frequent words get the smallest numbers, which compress best."""
        seq = np.concatenate(self.parts) if self.parts else np.empty(0, dtype=np.uint32)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, [b"", *self.numbers]), dtype=np.uint64, count=len(self.numbers) + 1)
        order = np.argsort(-np.bincount(seq, minlength=len(hashes))[1:], kind="stable") + 1
        moved = np.zeros(len(hashes), dtype=np.uint32)
        moved[order] = np.arange(1, len(hashes), dtype=np.uint32)
        ids, null, n, near = (np.array(x, dtype=kind) for x, kind in zip(zip(*self.ids, strict=True), ("i8", "u1", "u4", "u1"), strict=True))
        row = (uuid4().int >> 65, len(seq), int(((n + 1) * near * (n > 0)).sum()), packed(ids, null, n, near), packed(hashes[np.concatenate(([MARK], order))]), packed(moved[seq]))
        return pd.DataFrame([row], columns=[c.split()[0] for c in SEQUENCES.split(", ")])


def sequences(docs: DataFrame) -> DataFrame:
    """Blocks of the rows (doc_id, text, near)."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = Block()
        for batch in batches:
            for doc_id, text, near in zip(batch["doc_id"], batch["text"], batch["near"], strict=True):
                block.add(doc_id, text, near)
                if block.full():
                    yield block.frame()
                    block = Block()
        if block.ids:
            yield block.frame()

    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "near").mapInPandas(make, SEQUENCES)  # as a string, ids beside nulls stay exact


def mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A 64-bit hash of pairs of hashes."""
    out = first * np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(32)
    out = (out + second) * np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ out >> np.uint64(32)


class Grams:
    """Distinct words and pairs of a block: first words, in order of number, then pairs."""

    def __init__(self, hashes: np.ndarray, seq: np.ndarray):
        words = len(hashes)
        before = np.empty(len(seq), dtype=np.int64)
        before[:1], before[1:] = MARK, seq[:-1]
        self.pairs, self.which = np.unique(before * words + seq, return_inverse=True)
        self.first, self.second = self.pairs // words, self.pairs % words
        one = np.uint64(1)
        self.keys = np.concatenate((hashes & ~one, mixed(hashes[self.first], hashes[self.second]) | one))  # the last bit marks pairs
        self.order = np.argsort(self.keys)

    def counts(self, seq: np.ndarray, some: np.ndarray) -> np.ndarray:
        """How often each stands at the tokens ``some``."""
        words = len(self.keys) - len(self.pairs)
        return np.concatenate((np.bincount(seq[some], minlength=words), np.bincount(self.which[some], minlength=len(self.pairs))))


def document_rows(raw: bytes) -> tuple[np.ndarray, ...]:
    return tuple(unpacked(raw, "i8", "u1", "u4", "u1"))


def group_bounds(keys: np.ndarray, groups: int) -> np.ndarray:
    """Where each group's keys begin among the sorted ``keys``; and the end."""
    group = (keys >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)
    return np.searchsorted(group, np.arange(groups + 1, dtype=np.uint64))


def questions(blocks: DataFrame, groups: int) -> DataFrame:
    """(part, block, entries): each block's hashes and counts, by ranges of hashes."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, ids, hashes, seq in zip(batch["block"], batch["ids"], batch["hashes"], batch["seq"], strict=True):
                hashes, seq = unpacked(hashes, "u8")[0], unpacked(seq, "u4")[0]
                if not len(seq):
                    continue
                _, _, n, near = document_rows(ids)
                grams = Grams(hashes, seq)
                keys = grams.keys[grams.order]
                far = grams.counts(seq, np.ones(len(seq), dtype=bool))[grams.order]
                own = grams.counts(seq, np.repeat(near == 1, np.where(n > 0, n + 1, 0)))[grams.order]
                ends = group_bounds(keys, groups)
                rows = [(part, block, packed(np.diff(keys[a:b], prepend=np.uint64(0)), own[a:b], far[a:b])) for part, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if a < b]
                yield pd.DataFrame(rows, columns=["part", "block", "entries"])

    return blocks.select("block", "ids", "hashes", "seq").mapInPandas(ask, "part int, block long, entries binary")


def answers(asked: DataFrame) -> DataFrame:
    """(part, block, counts): what both models counted of each entry, in the order asked; and on
    one row of each part how many words it has."""

    def add(group: pd.DataFrame) -> pd.DataFrame:
        keys, near, far = zip(*(unpacked(raw, "u8", "i8", "i8") for raw in group["entries"]), strict=True)
        sizes = [len(x) for x in keys]
        known, which = np.unique(np.concatenate([np.cumsum(x, dtype=np.uint64) for x in keys]), return_inverse=True)
        sums = [np.bincount(which, weights=np.concatenate(x), minlength=len(known)).astype(np.int64) for x in (near, far)]  # exact below 2**53
        out = group[["part", "block"]].assign(counts=[packed(*(s[w] for s in sums)) for w in np.split(which, np.cumsum(sizes)[:-1])], words=0)
        out.iloc[0, 3] = int((known & np.uint64(1) == 0).sum())
        return out

    return asked.groupBy("part").applyInPandas(add, "part int, block long, counts binary, words long")


def pair_losses(both: np.ndarray, first: np.ndarray, word: np.ndarray, total: int, words: int) -> np.ndarray:
    """Minus log-probabilities of pairs, from counts of the pair, its first and its second word."""
    weight = np.sqrt(total + 1)
    return -np.log((both + weight * (word + 1) / (total + words)) / (first + weight))


def score(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score of each row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "lm")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ids = scratch.write(target_ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct().withColumn("near", F.lit(True)), "targets")
    marked = docs.join(few_ids(ids), "doc_id", "left").withColumn("near", F.coalesce("near", F.lit(False)))
    blocks = scratch.write(sequences(marked), "blocks")
    total = blocks.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "near_tokens")]).first()
    groups = max(LEAST_GROUPS, -(-total["tokens"] // ENTRIES))
    told = scratch.write(answers(questions(blocks, groups)), "answers")
    words = told.agg(F.sum("words").alias("n")).first()["n"]
    models = ((total["near_tokens"], words), (total["tokens"], words))

    def judge(own: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        found = []
        for ids, hashes, seq in zip(own["ids"], own["hashes"], own["seq"], strict=True):
            ids, null, n, _ = document_rows(ids)
            sums = np.zeros((2, len(n)))
            if n.any():
                seq = unpacked(seq, "u4")[0]
                grams = Grams(unpacked(hashes, "u8")[0], seq)
                told = [unpacked(raw, "i8", "i8") for raw in replies.sort_values("part")["counts"]]
                starts = np.concatenate(([0], np.cumsum(n[n > 0].astype(np.int64) + 1)[:-1]))
                for k, model in enumerate(models):
                    counts = np.empty(len(grams.keys), dtype=np.int64)
                    counts[grams.order] = np.concatenate([x[k] for x in told])
                    of = counts[: len(counts) - len(grams.pairs)]
                    each = pair_losses(counts[len(of) :], of[grams.first], of[grams.second], *model)
                    sums[k, n > 0] = np.add.reduceat(each[grams.which], starts)
            near, far = sums / (n + 1)
            found.append(pd.DataFrame({"doc_id": pd.arrays.IntegerArray(ids.copy(), null == 1), "n_tokens": n.astype(np.int64), "target_loss": near, "background_loss": far, "score": near - far}))
        return pd.concat(found) if found else pd.DataFrame(columns=["doc_id", "n_tokens", "target_loss", "background_loss", "score"])

    both = blocks.select("block", "ids", "hashes", "seq").groupBy("block").cogroup(told.select("block", "part", "counts").groupBy("block"))
    return both.applyInPandas(judge, "doc_id long, n_tokens long, target_loss double, background_loss double, score double")
