"""Best-fit packing of token pieces into sequences, after Martello-Toth dominance reduction.

Tasks tokenise whole texts and cut only documents longer than ``capacity`` tokens. The
instance is then the histogram of piece lengths, at most ``capacity`` numbers whatever the
input, so the driver plans on counts: the reduction fixes sets that dominate every
alternative (a piece that nothing fits beside; a pair that fills a sequence; a piece with
room for one more, with the largest that fits; one with room for two more, with the largest
that fits and the largest beside that, if no other two are together more), and best-fit in
decreasing order packs the rest, all bins of one state at once. Spark ranks the pieces of each length, by hash buckets
so that a common length is spread, and tasks look their place up in the plan.

A length makes at most two new groups of bins, and the lengths in one bin sum to at most
``capacity``; so a plan of capacity 4096 has fewer than 1.2 million entries for any input
and may be broadcast; larger capacities may raise an error.

Null text counts as empty: one piece, the end id. Rows with equal or null doc_id are packed
each; pieces of one length change places at will, as none fits better than another.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import Scratch

CACHED_WORDS = 400_000
PIECES = "doc_id string, piece int, start long, length long, ids_crc32 long"
MOST_ENTRIES = 1_200_000


# Characters on which normalising only lowers case; ASCII white space parts tokens.
PLAIN = re.compile(r"[\t-\r\x20-\x7e\xa1-\xff]*\Z")
LATIN = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
NUMBER = r"0-9\xb2\xb3\xb9\xbc-\xbe"
PRETOKEN = re.compile(rf"[{LATIN}]+|[{NUMBER}]|'(?:s|t|re|ve|m|ll|d)|[^\s{LATIN}{NUMBER}]+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes for
    themselves, the others, in order, for the characters from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Ids(dict):
    """Ids (little-endian unsigned 32-bit) of single tokens of a text before merging."""

    def __init__(self, tokenizer):
        super().__init__()
        self.merge = tokenizer.model.tokenize
        letters = byte_letters()
        self.letters = {c: "".join(letters[b] for b in chr(c).encode()) for c in range(0x80, 0x100)}

    def __missing__(self, token: str) -> bytes:
        ids = [t.id for t in self.merge(token if token.isascii() else token.translate(self.letters))]
        found = array("I", ids).tobytes()
        if len(token) <= 64:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[token] = found
        return found


class WordTokenizer:
    """Ids of texts for the lower-casing word vocabulary.

    Its merges never cross the bounds of words, so for texts of plain Latin characters the
    merges of a word are looked up once and kept, up to a bound. Other texts are parted at
    ASCII white space, and words with other characters go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known = Ids(self.tokenizer)

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.known.__getitem__, PRETOKEN.findall(text.lower())))

    def _whole(self, word: str) -> bytes:
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if PLAIN.match(text) and "<|" not in text:
            return self._plain(text)
        parts = re.split(r"[\t-\r ]+", text.encode("utf-8", "replace").decode())
        return b"".join(self._plain(w) if PLAIN.match(w) and "<|" not in w else self._whole(w) for w in parts if w)


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 4096, with_ids: bool = False) -> DataFrame:
    """One row per piece; ``with_ids`` adds the ids themselves (binary, little-endian)."""
    end = np.array([end_id], dtype="<u4").tobytes()
    width = 4 * capacity

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = WordTokenizer(tokenizer_path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = tokenizer.ids(text or "") + end
                for k, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), part)[: 6 if with_ids else 5])
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if with_ids else 5])

    texts = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInPandas(cut, PIECES + ", ids binary" * with_ids).withColumn("doc_id", F.col("doc_id").cast("long"))  # as strings, ids beside nulls stay exact


def partners(left: np.ndarray, j: int, capacity: int) -> tuple[int, ...] | None:
    """Pieces that make with one of length ``j`` a set that dominates every other; None if that
    isn't known. Whatever else may stand beside ``j`` fits, piece by piece, in place of these."""
    room = capacity - j
    others = left[: room + 1].copy()
    others[j : j + 1] -= 1  # the piece itself, where its like would fit
    sizes = np.flatnonzero(others > 0)
    if not len(sizes):
        return ()
    large = int(sizes[-1])
    least = np.repeat(sizes[:3], np.minimum(others[sizes[:3]], 3))[:3].cumsum()  # of one, two and three more
    if large == room or len(least) < 2 or least[1] > room:
        return (large,)
    if len(least) == 3 and least[2] <= room:
        return None
    others[large] -= 1
    beside = np.flatnonzero(others[: room - large + 1] > 0)
    others[large] += 1
    second = int(beside[-1]) if len(beside) else 0
    lower = sizes[(sizes > second) & (2 * sizes <= room)]
    upper = sizes[np.searchsorted(sizes, room - lower, side="right") - 1]
    more = (lower + upper > large) & ((upper != lower) | (others[lower] > 1))
    return None if more.any() else (large, second) if second else (large,)


def reduction(left: np.ndarray, capacity: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """Sets that dominate, largest piece first, and how often each; they are taken out of ``left``.

    A fixed set leaves a smaller instance, in which more may dominate.
    """
    changed = True
    while changed:
        changed = False
        for j in np.flatnonzero(left)[::-1].tolist():
            while left[j] and (found := partners(left, j, capacity)) is not None:
                each = {x: (j, *found).count(x) for x in (j, *found)}
                bins = min(int(left[x]) // n for x, n in each.items())
                for x, n in each.items():
                    left[x] -= n * bins
                yield (j, *found), bins
                changed = True


def plan(counts: dict[int, int], capacity: int = 4096) -> tuple[np.ndarray, dict[str, int]]:
    """Entries (length, first rank, first sequence, offset, copies in a bin), and figures.

    The piece of rank x in an entry's range goes to sequence ``first + (x - rank) // copies``,
    at ``offset + (x - rank) % copies * length``.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    given, entries, sequences = np.zeros(capacity + 1, dtype=np.int64), [], 0

    def put(length: int, bins: int, first: int, offset: int, copies: int = 1) -> None:
        entries.append((length, int(given[length]), first, offset, copies))
        given[length] += bins * copies

    for pieces, bins in reduction(left, capacity):
        at = 0
        for length in dict.fromkeys(pieces):
            copies = pieces.count(length)
            put(length, bins, sequences, at, copies)
            at += copies * length
        sequences += bins
    fixed = sequences

    rooms: list[int] = []  # of the open bins, ascending
    groups: dict[int, list[tuple[int, int]]] = {}

    def open_bins(room: int, first: int, bins: int) -> None:
        if room and bins:
            if room not in groups:
                insort(rooms, room)
                groups[room] = []
            groups[room].append((first, bins))

    for length in np.flatnonzero(left)[::-1].tolist():
        while left[length]:
            k = bisect_left(rooms, length)
            if k < len(rooms):
                room = rooms[k]
                first, bins = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[k]
            else:
                room, first, bins = capacity, sequences, -(-int(left[length]) // (capacity // length))
                sequences += bins
            copies = room // length
            full = min(bins, int(left[length]) // copies)
            if full:
                put(length, full, first, capacity - room, copies)
                left[length] -= full * copies
                open_bins(room - copies * length, first, full)
            if full < bins:
                rest = int(left[length]) if left[length] < copies else 0
                if rest:
                    put(length, 1, first + full, capacity - room, rest)
                    left[length] -= rest
                    open_bins(room - rest * length, first + full, 1)
                open_bins(room, first + full + bool(rest), bins - full - bool(rest))
    if len(entries) > MOST_ENTRIES:
        raise ValueError("the plan is over its bound")
    total = sum(length * n for length, n in counts.items())
    figures = {"sequences": sequences, "fixed": fixed, "least": -(-total // capacity)}
    return np.array(sorted(entries), dtype=np.int64).reshape(-1, 5), figures


def pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """``pieces`` (doc_id, piece, length and more columns) with sequence_id and offset."""
    spark = pieces.sparkSession
    scratch = Scratch(spark, "packing")
    made = scratch.write(pieces, "pieces")
    buckets = 1 << max(8, (made.count() // 200_000).bit_length())
    made = made.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    counts = scratch.write(made.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")), "counts")
    histogram = {int(r["length"]): int(r["n"]) for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    entries, _ = plan(histogram, capacity)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")
    before = scratch.write(counts.select("length", "bucket", before.alias("before")), "before")
    order = [F.col(c) for c in made.columns if c in ("doc_id", "piece", "ids_crc32")]
    local = F.row_number().over(Window.partitionBy("length", "bucket").orderBy(*order)) - 1
    ranked = made.withColumn("local", local).join(before, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("local"))
    shared = spark.sparkContext.broadcast(entries)
    kept = pieces.columns

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = shared.value
        keys = (table[:, 0] << 50) + table[:, 1] if len(table) else None
        for batch in batches:
            rank, length = batch["rank"].to_numpy(np.int64), batch["length"].to_numpy(np.int64)
            if len(batch):
                e = table[np.searchsorted(keys, (length << 50) + rank, side="right") - 1]
                k = rank - e[:, 1]
                batch = batch.assign(sequence_id=e[:, 2] + k // e[:, 4], offset=e[:, 3] + k % e[:, 4] * length)
            else:
                batch = batch.assign(sequence_id=rank, offset=rank)
            yield batch[[*kept, "sequence_id", "offset"]]

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.select(*kept, "rank").mapInPandas(place, schema + ", sequence_id long, offset long")
