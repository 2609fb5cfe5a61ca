"""A Merkle manifest of a dataset, its trees stored in the van Emde Boas layout.

A leaf is the digest of a row; leaves of a source, by doc_id, are the base of its tree, in which
every ``FAN`` consecutive nodes have one parent; the roots of the sources, in order, are the base
of the tree above. A tree is cut into aligned subtrees of ``LEVELS`` levels. Each is one row, with
its nodes in one array: a subtree is split at half its height, the upper half is stored first and
then each lower one, and so on down, so a node's address follows from its depth and place by
arithmetic, and the children of a node lie side by side. The roots of subtrees are the base of
the next round, until a tree has one node. Siblings are fetched the other way, from the topmost
subtree down: each hands the siblings of its nodes, and those above, to the subtrees below.

A row's leaf is worked out from its text where the text is; what is shuffled are digests. A
source with a third of all rows is many subtrees of at most 4096 leaves, which is all that a
task holds at a time. Rounds are the logarithm of the largest source to the base 4096.

Null columns are told apart from empty ones, in leaves as in the order of sources, where null is
first. Rows without a doc_id come first in their source and are not tampered with; rows that
repeat a doc_id are ordered by leaf, and those that are equal have one digest in any order. An
empty table has no rows and no root.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property
from hashlib import sha256
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.ranks import ranked
from tidemark.llm.shared import Scratch

FAN, LEVELS = 16, 3
BLOCK = FAN**LEVELS
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
NODES = "tree long, block long, n long, nodes binary, root binary"
ABOVE = "tree long, block long, above array<string>, roots array<string>"


def nodes_in(levels: int) -> int:
    """Nodes of a whole tree with so many levels of nodes."""
    return (FAN**levels - 1) // (FAN - 1)


LAYOUTS: dict[int, tuple[np.ndarray, ...]] = {}  # of the few heights that there are


def addresses(height: int) -> tuple[np.ndarray, ...]:
    """By depth from the root: the address of each node of a tree of ``height`` levels of edges."""
    if height not in LAYOUTS:
        upper = (height + 1) // 2
        lower = height + 1 - upper
        if not upper:
            return (np.zeros(1, dtype=np.int64),)
        top, bottom = addresses(upper - 1), addresses(lower - 1)
        starts = nodes_in(upper) + np.arange(FAN**upper, dtype=np.int64) * nodes_in(lower)
        LAYOUTS[height] = (*top, *((starts[:, None] + b).ravel() for b in bottom))
    return LAYOUTS[height]


def height_of(n: int) -> int:
    """Levels of edges in the topmost subtree over ``n`` nodes, or ``LEVELS`` if there is one above."""
    if n > BLOCK:
        return LEVELS
    height = 0
    while FAN**height < n:
        height += 1
    return height


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf_digest(row: dict[str, Column]) -> Column:
    """Each column as its length in bytes and its value, ``-`` for null, hashed together."""
    parts = []
    for name in COLUMNS:
        value = row[name].cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, source, leaf; and ``tampered``, the leaf after tampering, of rows that it takes."""
    row = {c: F.col(c) for c in COLUMNS}
    taken = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lower = row | {"text": F.translate(F.col("text").cast("string"), ascii_uppercase, ascii_lowercase)}
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        leaf_digest(row).alias("leaf"),
        F.when(taken, leaf_digest(lower)).alias("tampered"),
    )


def _counts(n: int, height: int) -> list[int]:
    """Nodes at each depth of a subtree over ``n`` nodes."""
    out = [n]
    for _ in range(height):
        out.append(-(-out[-1] // FAN))
    return out[::-1]


def build(rows: pd.DataFrame) -> pd.DataFrame:
    """One subtree: tree, block, n, its nodes by address, and its root."""
    rows = rows.sort_values("pos")
    tree, n = int(rows["tree"].iloc[0]), int(rows["n"].iloc[0])
    height = height_of(n)
    at, counts = addresses(height), _counts(len(rows), height)
    nodes = np.zeros((nodes_in(height + 1), 32), dtype=np.uint8)
    nodes[at[height][: len(rows)]] = np.frombuffer(b"".join(rows["digest"]), dtype=np.uint8).reshape(-1, 32)
    for depth in range(height - 1, -1, -1):
        for k in range(counts[depth]):
            children = nodes[at[depth + 1][FAN * k : min(FAN * k + FAN, counts[depth + 1])]]
            nodes[at[depth][k]] = np.frombuffer(sha256(children.tobytes().hex().encode()).digest(), dtype=np.uint8)
    block = int(rows["pos"].iloc[0]) // BLOCK
    return pd.DataFrame({"tree": [tree], "block": [block], "n": [n], "nodes": [nodes.tobytes()], "root": [nodes[0].tobytes()]})


class Subtree:
    """A stored subtree; ``size`` is how many nodes its base has."""

    def __init__(self, nodes: bytes, n: int, block: int):
        self.height, self.size = height_of(n), min(BLOCK, n - block * BLOCK)
        self.nodes, self.at = np.frombuffer(nodes, dtype=np.uint8).reshape(-1, 32), addresses(self.height)
        self.counts = _counts(self.size, self.height)
        self.runs: list[dict[int, str]] = [{} for _ in self.at]

    def _run(self, depth: int, k: int) -> str:
        """Digests of the k-th run of siblings, as one text."""
        if k not in self.runs[depth]:
            where = self.at[depth][FAN * k : min(FAN * k + FAN, self.counts[depth])]
            self.runs[depth][k] = self.nodes[where].tobytes().hex()
        return self.runs[depth][k]

    def siblings(self, k: int) -> list[str]:
        """Of the k-th node at the base: the texts left and right of it in its run, level by level."""
        out = []
        for depth in range(self.height, 0, -1):
            run, own = self._run(depth, k // FAN), k % FAN * 64
            out += [run[:own], run[own + 64 :]]
            k //= FAN
        return out


def fold(leaf: str, siblings: list[str]) -> str:
    """The root that a leaf and its siblings give."""
    for left, right in zip(siblings[::2], siblings[1::2], strict=True):
        leaf = digest(left + leaf + right)
    return leaf


def grow(base: DataFrame, scratch: Scratch, label: str) -> tuple[list[DataFrame], DataFrame]:
    """From nodes (tree, pos, n, digest), ``n`` to a tree: a table of subtrees for each round, and (tree, root)."""
    most = base.agg(F.max("n")).first()[0] or 0
    rounds: list[DataFrame] = []
    while True:
        blocks = base.groupBy("tree", F.floor(F.col("pos") / BLOCK).alias("b")).applyInPandas(build, NODES)
        rounds.append(scratch.write(blocks, f"{label}_{len(rounds)}"))
        if most <= BLOCK:
            break
        most = -(-most // BLOCK)
        base = rounds[-1].where(F.col("n") > BLOCK).select("tree", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("root").alias("digest"))
    tops = rounds[0]
    for more in rounds[1:]:
        tops = tops.union(more)
    return rounds, tops.where(F.col("n") <= BLOCK).select("tree", "root")


def fetch(nodes: DataFrame, held: DataFrame, emit: Callable, schema: str) -> DataFrame:
    """``emit`` of each subtree's own rows among ``nodes`` (tree, pos), with the siblings of each
    up to the whole manifest's root, and the roots on that way."""

    def look(rows: pd.DataFrame, subtree: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return emit(rows, [], [])
        one = subtree.iloc[0]
        stored = Subtree(one["nodes"], int(one["n"]), int(one["block"]))
        above, roots = list(one["above"]), list(one["roots"])
        if one["n"] <= BLOCK:
            roots = [bytes(one["root"]).hex(), *roots]
        return emit(rows, [stored.siblings(int(p) % BLOCK) + above for p in rows["pos"]], roots)

    block = F.floor(F.col("pos") / BLOCK).alias("block")
    mine = nodes.withColumn("block", block).groupBy("tree", "block")
    return mine.cogroup(held.groupBy("tree", "block")).applyInPandas(look, schema)


def _handed_down(rows: pd.DataFrame, siblings: list, roots: list) -> pd.DataFrame:
    return pd.DataFrame({"tree": rows["tree"], "block": rows["pos"], "above": siblings, "roots": [roots] * len(rows)})


def descend(rounds: list[DataFrame], tops: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """The first round's subtrees with what is above them; ``tops`` (tree, above, roots) is above the trees."""
    above = tops.select("tree", F.lit(0).cast("long").alias("block"), "above", "roots")
    for k in range(len(rounds) - 1, -1, -1):
        here = rounds[k]
        upper = here.where(F.col("n") <= BLOCK).join(above, ["tree", "block"])
        if k < len(rounds) - 1:
            upper = upper.union(here.where(F.col("n") > BLOCK).join(passed, ["tree", "block"]))  # noqa: F821
        held = scratch.write(upper, f"{label}_held_{k}")
        if k:
            below = rounds[k - 1].where(F.col("n") > BLOCK).select("tree", F.col("block").alias("pos"))
            passed = scratch.write(fetch(below, held, _handed_down, ABOVE), f"{label}_passed_{k}")
    return held


class Manifest:
    """The manifest of ``docs``; its tables are in the shared folder."""

    def __init__(self, docs: DataFrame):
        self.scratch = scratch = Scratch(docs.sparkSession, "merkle")
        made = scratch.write(leaves(docs), "leaves")
        placed = ranked(made, scratch, "order", ["source"], ["doc_id", "leaf"], numbered=True)
        self.leaves = scratch.write(placed.select("doc_id", "source", "leaf", "tampered", F.col("number").alias("tree"), F.col("place").alias("pos"), F.col("size").alias("n")), "placed")
        base = self.leaves.select("tree", "pos", "n", F.col("leaf").alias("digest"))
        self.subtrees, self.subroots = grow(base, scratch, "tree")
        n = F.lit(self.subroots.count()).cast("long").alias("n")
        sources = self.subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), n, F.col("root").alias("digest"))
        self.sources = scratch.write(sources, "sources")
        self.top_subtrees, self.top = grow(self.sources, scratch, "top")

    def root(self) -> str | None:
        found = self.top.first()
        return found and bytes(found["root"]).hex()

    @cached_property
    def held(self) -> DataFrame:
        """The sources' lowest subtrees with the siblings above them."""
        none = F.array().cast("array<string>")
        over = self.top.select("tree", none.alias("above"), none.alias("roots"))
        top = descend(self.top_subtrees, over, self.scratch, "top")
        each = self.scratch.write(fetch(self.sources.select("tree", "pos"), top, _handed_down, ABOVE), "over_sources")
        return descend(self.subtrees, each.select(F.col("block").alias("tree"), "above", "roots"), self.scratch, "tree")

    def proofs(self) -> DataFrame:
        """doc_id, source, leaf, siblings (left and right of the leaf's way, level by level), subroot, root."""

        def emit(rows: pd.DataFrame, siblings: list, roots: list) -> pd.DataFrame:
            sub, root = roots or (None, None)
            return pd.DataFrame({"doc_id": rows["doc_id"], "source": rows["source"], "leaf": [bytes(x).hex() for x in rows["leaf"]], "siblings": siblings, "subroot": sub, "root": root})

        return fetch(self.leaves, self.held, emit, "doc_id long, source string, leaf string, siblings array<string>, subroot string, root string")

    def audit(self) -> DataFrame:
        """Each row's proof as one digest, and whether its leaf, after tampering, still leads to the root."""

        def emit(rows: pd.DataFrame, siblings: list, roots: list) -> pd.DataFrame:
            sub, root = roots or (None, None)
            own = [bytes(x).hex() for x in rows["leaf"]]
            now = [x if t is None else bytes(t).hex() for x, t in zip(own, rows["tampered"], strict=True)]
            folded = [fold(x, s) for x, s in zip(now, siblings, strict=True)]
            return pd.DataFrame({
                "doc_id": rows["doc_id"], "leaf": own, "subroot": sub, "root": root,
                "proof_sha256": [digest("".join(s)) for s in siblings], "folded_root": folded, "verified": [f == root for f in folded],
            })

        return fetch(self.leaves, self.held, emit, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def _sql(levels: int = 12) -> str:
    """Level by level, for tables of up to 16 ** ``levels`` rows."""
    enc = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    whole = lambda text: "sha256(" + " || ".join(enc(text if c == "text" else c) for c in COLUMNS) + ")"
    lower = f"translate(text, '{ascii_uppercase}', '{ascii_lowercase}')"
    crc = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda a, b: xor(a >> 8, crc_table[(xor(a, b) & 255) + 1])), 4294967295::BIGINT)"""
    ctes = [
        """bytes AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::BIGINT, range(8)),
      lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END)) AS crc_table)""",
        f"""base AS (SELECT doc_id, source, {whole('text')} AS leaf, CASE WHEN {crc} % 5 = 0 THEN {whole(lower)} END AS tampered FROM documents, bytes)""",
        """placed AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
      row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM base)""",
        "n0 AS (SELECT tree, pos, leaf AS h FROM placed)",
    ]

    def climb(name: str, last: str) -> None:
        """``name``: nodes of ``last`` with siblings; and the nodes above, which trees of one node lack."""
        ctes.append(f"""{name}s AS (SELECT *, count(*) OVER (PARTITION BY tree) AS m,
      coalesce(string_agg(h, '') OVER (PARTITION BY tree, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
      coalesce(string_agg(h, '') OVER (PARTITION BY tree, pos // 16 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {last})""")

    up = lambda s: f"SELECT tree, pos // 16 AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h FROM {s} WHERE m > 1 GROUP BY tree, pos // 16"
    for k in range(levels):
        climb(f"n{k}", f"n{k}")
        ctes.append(f"n{k + 1} AS ({up(f'n{k}s')})")
    ctes.append("subs AS (" + " UNION ALL ".join(f"SELECT tree, h AS subroot FROM n{k}s WHERE m = 1" for k in range(levels)) + ")")
    ctes.append("t0 AS (SELECT 0 AS tree, tree AS pos, subroot AS h FROM subs)")
    for k in range(levels):
        climb(f"t{k}", f"t{k}")
        ctes.append(f"t{k + 1} AS ({up(f't{k}s')})")
    ctes.append("top AS (" + " UNION ALL ".join(f"SELECT h AS root FROM t{k}s WHERE m = 1" for k in range(levels)) + ")")
    ctes.append("f0 AS (SELECT doc_id, leaf, tree, pos, coalesce(tampered, leaf) AS x, '' AS proof FROM placed)")
    step = """{to} AS (SELECT f.doc_id, f.leaf, f.tree, f.pos, CASE WHEN s.m > 1 THEN sha256(s.l || f.x || s.r) ELSE f.x END AS x, f.proof || CASE WHEN s.m > 1 THEN s.l || s.r ELSE '' END AS proof
      FROM {last} f LEFT JOIN {level} s ON s.tree = {tree} AND s.pos = {pos} // {wide})"""
    for k in range(levels):
        ctes.append(step.format(to=f"f{k + 1}", last=f"f{k}", level=f"n{k}s", tree="f.tree", pos="f.pos", wide=FAN**k))
    ctes.append(f"g0 AS (SELECT * FROM f{levels})")
    for k in range(levels):
        ctes.append(step.format(to=f"g{k + 1}", last=f"g{k}", level=f"t{k}s", tree="0", pos="f.tree", wide=FAN**k))
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, x AS folded_root, x = root AS verified FROM g{levels} JOIN subs USING (tree) CROSS JOIN top"""


SQL = _sql(6)
