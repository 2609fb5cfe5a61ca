"""Exact top-k inner-product search by blocks of rows.

Components are quantised to floor(scale * x). Rows in order of vec_id make document-range
blocks of at most ``BLOCK_BYTES``: a forward index (ids and integer components, in the smallest
type that holds them) and an outline: for each component, its largest and least value. A query's
bound for a block is the sum over components of the larger of q * max and q * min.

Outlines, a thousandth of the rows or so, meet all queries first. Each query scores its blocks of
greatest bounds, as many as have k rows, and so gets a kth score to start from. Queries with the
same best block make a group, and a block is sent to those groups only in which its bound
reaches some query's kth score. There every query takes blocks in order of its bounds, scores
them through their forward index, and stops when the next bound is below its kth score so far (an equal bound
is still scored, as ties go to smaller ids). The cells' lists are then merged by query.

A task holds at most some ``GROUP_BYTES`` of queries and ``SHARD_BYTES`` of blocks; a block that is the best
of many queries is copied to cells of ``PROBES`` of them. Where bounds exclude nothing, every block
goes to every group. Vectors that are null or hold null or
non-finite components, and rows without id, take no part; an empty vector does, and scores 0.
Missing components of shorter vectors count as 0. Ids may repeat: each row is a candidate, but
rows with the query's own vec_id are its own, and of several such rows the one with the least
components asks. Scores are exact while they fit 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import Scratch

BLOCK_BYTES, GROUP_BYTES, SHARD_BYTES, OUTLINE_BYTES = 1 << 19, 1 << 24, 1 << 27, 1 << 24
PROBES = 4096  # queries in a cell of their best block
FOUND = "query_id long, vec_id long, score long"
NO_LEAST = -(1 << 63)
BLOCKS = "block long, n int, dim int, bytes long, ids binary, rows binary, high binary, low binary"


def quantised(vectors: DataFrame, scale: float = 64.0) -> DataFrame:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("long"))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("x"))


def matrix(xs: list, dim: int) -> np.ndarray:
    """The vectors as rows of integers, filled up with 0."""
    out = np.zeros((len(xs), dim), dtype=np.int64)
    for k, x in enumerate(xs):
        out[k, : len(x)] = x
    return out


def blocks(rows: DataFrame) -> DataFrame:
    """Forward blocks of rows in order of vec_id."""

    def pack(ids: list[int], xs: list) -> dict:
        m = matrix(xs, max(map(len, xs)))
        return {"block": int(ids[0]), "n": len(ids), "dim": m.shape[1], "bytes": m.nbytes, "ids": np.array(ids, dtype=np.int64).tobytes(), "rows": narrow(m).tobytes(), "high": m.max(axis=0).tobytes(), "low": m.min(axis=0).tobytes()}

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, xs, held = [], [], 0
        for batch in batches:
            for vec_id, x in zip(batch["vec_id"], batch["x"], strict=True):
                ids.append(vec_id)
                xs.append(x)
                held += 8 * len(x) + 8
                if held >= BLOCK_BYTES:
                    yield pd.DataFrame([pack(ids, xs)])
                    ids, xs, held = [], [], 0
        if ids:
            yield pd.DataFrame([pack(ids, xs)])

    return rows.repartitionByRange("vec_id").sortWithinPartitions("vec_id").mapInPandas(make, BLOCKS)


def narrow(m: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest type that holds them."""
    fits = (t for t in (np.int8, np.int16, np.int32) if m.size and np.iinfo(t).min <= m.min() and m.max() <= np.iinfo(t).max)
    return m.astype(next(fits, np.int64))


def stored(raw: bytes, n: int, dim: int) -> np.ndarray:
    size = len(raw) // max(1, n * dim) or 8
    return np.frombuffer(raw, dtype=f"i{size}").reshape(n, dim)


def _summaries(asked: pd.DataFrame, held: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Queries, and the blocks' largest and least values, as floating point where that is exact."""
    dim = max(int(held["dim"].max()), max(map(len, asked["x"])))
    q = matrix(asked["x"].tolist(), dim)
    high, low = (np.concatenate([np.pad(np.frombuffer(raw, dtype=np.int64), (0, dim - own))[None] for raw, own in zip(held[c], held["dim"], strict=True)]) for c in ("high", "low"))
    most = max(1, int(np.abs(q).max(initial=0))) * max(1, int(np.abs(high).max(initial=0)), int(np.abs(low).max(initial=0))) * max(1, dim)
    # below, products and sums of these integers are exact
    return (q.astype(float), high.astype(float), low.astype(float)) if most < 1 << 52 else (q, high, low)


def bounds(q: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The most that a row of each block can score, for each query."""
    return np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T


def search_cell(asked: pd.DataFrame, held: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best rows of ``held`` for each query in ``asked`` (query_id, x, least), of those
    that score its ``least`` or more: query_id, vec_id, score."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if len(asked) and len(held):
        q, high, low = _summaries(asked, held)
        ids, dim = asked["query_id"].to_numpy(np.int64), q.shape[1]
        mats = [np.pad(stored(raw, n, own), ((0, 0), (0, dim - own))).astype(q.dtype) for raw, n, own in zip(held["rows"], held["n"], held["dim"], strict=True)]
        names = [np.frombuffer(x, dtype=np.int64) for x in held["ids"]]
        bound = bounds(q, high, low)
        order = np.argsort(-bound, axis=1, kind="stable")
        kth = asked["least"].to_numpy(np.int64).astype(q.dtype)
        best = [(np.empty(0, dtype=q.dtype), np.empty(0, dtype=np.int64)) for _ in q]
        live = np.arange(len(q))
        for turn in range(len(held)):
            live = live[bound[live, order[live, turn]] >= kth[live]]
            if not len(live):
                break
            at = order[live, turn]
            for j in np.unique(at):
                mine = live[at == j]
                scores = q[mine] @ mats[j].T
                for i, row in zip(mine, scores, strict=True):
                    fit = np.flatnonzero((row >= kth[i]) & (names[j] != ids[i]))
                    if not len(fit):
                        continue
                    s, n = np.concatenate([best[i][0], row[fit]]), np.concatenate([best[i][1], names[j][fit]])
                    top = np.lexsort((n, -s))[:k]
                    best[i] = s[top], n[top]
                    if len(top) == k:
                        kth[i] = s[top[-1]]
        out = [(np.full(len(s), i), n, s.astype(np.int64)) for i, (s, n) in zip(ids, best, strict=True)]
    columns = [np.concatenate([x[c] for x in out]) if out else np.empty(0, dtype=np.int64) for c in range(3)]
    return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))


def best_blocks(asked: pd.DataFrame, held: pd.DataFrame, rows: int) -> pd.DataFrame:
    """For each query, the blocks of greatest bounds among ``held``, until they have ``rows`` rows: query_id, block, n, bound."""
    out = []
    if len(asked) and len(held):
        names, sizes = held["block"].to_numpy(np.int64), held["n"].to_numpy(np.int64)
        bound = bounds(*_summaries(asked, held))
        order = np.argsort(-bound, axis=1, kind="stable")
        for i, query in enumerate(asked["query_id"]):
            stop = int(np.searchsorted(np.cumsum(sizes[order[i]]), rows)) + 1
            out += [(query, names[j], sizes[j], float(bound[i, j])) for j in order[i, :stop]]
    return pd.DataFrame(out, columns=["query_id", "block", "n", "bound"])


def wanted_blocks(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
    """Blocks among ``held`` whose bound reaches the ``least`` of any query in ``asked``: g, block."""
    reached = np.zeros(len(held), dtype=bool)
    if len(asked) and len(held):
        reached = (bounds(*_summaries(asked, held)) >= asked["least"].to_numpy(np.int64)[:, None]).any(axis=0)
    names = held["block"].to_numpy(np.int64)[reached]
    return pd.DataFrame({"g": np.full(len(names), asked["g"].iloc[0] if len(asked) else 0, dtype=np.int64), "block": names})


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: float = 64.0) -> DataFrame:
    """query_id, rank, vec_id, score: for each id that ``every`` divides, its k best other rows."""
    scratch = Scratch(vectors.sparkSession, "topk")
    rows = quantised(vectors, scale)
    queries = rows.where(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("x").alias("x"))
    queries = scratch.write(queries, "queries")
    made = scratch.write(blocks(rows), "blocks")
    outlines = made.select("block", "n", "dim", "high", "low")
    asked_bytes = queries.agg(F.sum(F.size("x") * 8 + 8).alias("n")).first()["n"] or 0
    facts = made.agg(F.sum("bytes").alias("bytes"), F.sum(F.col("dim") * 16).alias("outline")).first()
    groups, shards, parts = (max(1, -(-(x or 0) // limit)) for x, limit in ((asked_bytes, GROUP_BYTES), (facts["bytes"], SHARD_BYTES), (facts["outline"], OUTLINE_BYTES)))
    dealt = lambda df, c, n, name: df.withColumn(name, F.pmod(F.xxhash64(c), F.lit(n)).cast("long"))
    spread = lambda df, n, name: df.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))

    def met(asked: DataFrame, held: DataFrame, on: list[str], work, schema: str) -> DataFrame:
        return asked.groupBy(*on).cogroup(held.groupBy(*on)).applyInPandas(work, schema)

    # Each query's best blocks by their bounds, from outlines alone; scores there give its least kth score.
    asked = spread(dealt(queries, "query_id", groups, "g"), parts, "s")
    held = spread(dealt(outlines, "block", parts, "s"), groups, "g")
    near = scratch.write(met(asked, held, ["g", "s"], lambda a, h: best_blocks(a, h, k + 1), "query_id long, block long, n long, bound double"), "near")
    order = Window.partitionBy("query_id").orderBy(F.desc("bound"), "block")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    probes = scratch.write(near.withColumn("place", F.row_number().over(order)).withColumn("before", before).where(F.col("before") < k + 1), "probes")
    crowd = probes.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / F.lit(PROBES)).cast("long").alias("pieces"))
    crowd = scratch.write(crowd, "crowd")
    piece = F.pmod(F.xxhash64("query_id"), F.col("pieces")).alias("g")
    asked = probes.join(crowd, "block").select("query_id", F.col("block").alias("s"), piece).join(queries, "query_id").withColumn("least", F.lit(NO_LEAST))
    held = made.join(crowd, "block").withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1))).withColumn("s", F.col("block"))
    lists = lambda a, h: search_cell(a, h, k)
    first = scratch.write(met(asked, held, ["g", "s"], lists, FOUND), "first")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    floors = first.withColumn("rank", rank).where(F.col("rank") == k).select("query_id", F.col("score").alias("least"))

    # Queries with one best block go together, and a block goes to a group if it may matter there.
    home = probes.where("place = 1").join(crowd, "block").select("query_id", F.xxhash64("block", piece).alias("home"))
    known = queries.join(home, "query_id").join(floors, "query_id", "left").withColumn("least", F.coalesce("least", F.lit(NO_LEAST)))
    known = scratch.write(dealt(known, "home", groups, "g").drop("home"), "known")
    held = spread(dealt(outlines, "block", parts, "s"), groups, "g")
    wanted = scratch.write(met(spread(known, parts, "s"), held, ["g", "s"], wanted_blocks, "g long, block long"), "wanted")
    wanted = dealt(wanted, "block", shards, "s")
    cells = scratch.write(wanted.select("g", "s").distinct(), "cells")
    found = met(known.join(cells, "g"), made.join(wanted, "block"), ["g", "s"], lists, FOUND)
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT vec_id, min(x) AS x FROM v WHERE vec_id % 20 = 0 GROUP BY vec_id),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM q JOIN v c ON q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20
"""
