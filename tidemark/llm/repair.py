"""Repair of conversations at least cost, by Viterbi in parallel chunks with rank convergence.

A conversation's rows, by turn, must come to ``s?(ua)+`` or nothing, read as role initials. Edits
are Keep (0), Rerole (3), Delete (4), Insert of an empty turn (3); blank and repeated rows must be
deleted, and truncated ones cost 3 unless they are. States are what has been put out so far:
nothing, ``s``, ``..u``, ``..a``. A row is one letter, and costs of the rest of a conversation
are a vector over states, so a step is a product in the (min, +) algebra.

A conversation is cut into chunks. All start at once, each from a speculative cost vector at its
end, and work backward. In a fix-up pass a chunk whose end vector turned out otherwise is run
again from the right one, beside its old run, up to the row where both differ by a constant
only: from there on the old run holds, with the constant added. Passes go on while any chunk's
head changes what its predecessor starts from. In conversations that don't converge so (a
speaker alone for very long keeps two phases apart), chunks that are not settled after
``PASSES`` are composed as whole matrices, by doubling, which always ends. Then each chunk
follows its stitched costs from each state at its head, the maps from head to tail are composed
by doubling, and each chunk writes its part of the audit: of the cheapest edits at every place the
least letter. As every choice is a function of (vector, letter), steps are kept in a table.

Texts are read twice and shuffled once, to hash the repaired conversation in order: a sorted
stream through tasks, which hold an audit's letters (a byte for each row) but no texts. A
conversation with a third of all rows is many chunks; only the hash, which is sequential, takes
it through one task, row by row.

Nulls (conv_id, turn, role, text) are read as one space; turns that are null come first. Rows of one
turn are ordered by role, then by the digest of their text. A conversation of which no row is left has zeros,
an empty audit and the hash of nothing. Repeated rows are rows; an empty table has no result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.ranks import ranked
from tidemark.llm.shared import Scratch

SPACES = " \t\n\x0b\x0c\r"  # fixed: white space of the contract
STOPS = ".!?"
DELETE, REROLE, INSERT, CUT = 4, 3, 3, 3  # costs; CUT is that of a truncated row that stays
START, SYSTEM, USER, ANSWER = range(4)
STATES = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ANSWER, (ANSWER, "u"): USER}
TURNED = {START: USER, SYSTEM: USER, USER: ANSWER, ANSWER: USER}  # where the one role leads that may come next
ROLES = "suax"  # x: any other
PLAIN, TRUNCATED, BLANK, DUPLICATE = range(4)
CHUNK, PASSES = 4096, 6
Vector = tuple[int, int, int, int]


def letter(fault: int, role: str) -> str:
    return chr(ord("a") + 4 * fault + ROLES.index(role))


LETTERS = {letter(f, r): (f, r) for f in range(4) for r in ROLES}


def closed(v: list[int]) -> Vector:
    """Costs with inserts at this place."""
    user, answer = min(v[USER], INSERT + v[ANSWER]), min(v[ANSWER], INSERT + v[USER])
    return (min(v[START], INSERT + user), min(v[SYSTEM], INSERT + user), user, answer)


END = closed([0, 99, 99, 0])  # a conversation may end where nothing or an answer was put out
GUESS = END


def edits(c: str, v: Vector, q: int) -> list[tuple[str, int, int]]:
    """Delete, Keep and Rerole of row ``c`` in state ``q``: name, cost with the rest ``v``, next state."""
    fault, role = LETTERS[c]
    out = [("D", DELETE + v[q], q)]
    if fault in (PLAIN, TRUNCATED):
        stay = CUT if fault == TRUNCATED else 0
        if (q, role) in NEXT:
            to = NEXT[q, role]
            out.append(("K", stay + v[to], to))
        out.append(("R", REROLE + stay + v[TURNED[q]], TURNED[q]))
    return out


STEPS: dict[tuple[str, Vector], tuple] = {}  # there are few vectors


def step(c: str, v: Vector) -> tuple[Vector, int, list[tuple[str, int]]]:
    """Costs before row ``c`` from those after it: the vector less its least entry, that entry, and
    for each state the least letters up to this row's own, and the state after it."""
    if (c, v) in STEPS:
        return STEPS[c, v]
    full = closed([min(x[1] for x in edits(c, v, q)) for q in STATES])
    ways = []
    for q in STATES:
        letters, at = "", q
        while True:
            best = [(e, to) for e, cost, to in edits(c, v, at) if cost == full[at]]
            if full[at] == INSERT + full[TURNED[at]]:
                best.append(("I", TURNED[at]))
            name, at = min(best)
            letters += name
            if name != "I":
                break
        ways.append((letters, at))
    least = min(full)
    STEPS[c, v] = tuple(x - least for x in full), least, ways
    return STEPS[c, v]


def backward(codes: str, v: Vector) -> tuple[Vector, int]:
    total = 0
    for c in reversed(codes):
        v, k, _ = step(c, v)
        total += k
    return v, total


def fix_up(codes: str, old: Vector, head: Vector, total: int, new: Vector) -> tuple[Vector, int]:
    """The head of a chunk from end vector ``new``, known from ``old`` as (head, total)."""
    more = 0
    for c in reversed(codes):
        if new == old:  # both were reduced by their least entry: parallel from here on
            return head, total + more
        new, k, _ = step(c, new)
        old, j, _ = step(c, old)
        more += k - j
    return new, total + more


def follow(codes: str, end: Vector, start: int) -> tuple[str, int]:
    """The audit of a chunk from a state at its head, and the state at its tail."""
    ways, v = [], end
    for c in reversed(codes):
        v, _, w = step(c, v)
        ways.append(w)
    out, q = [], start
    for w in reversed(ways):
        letters, q = w[q]
        out.append(letters)
    return "".join(out), q


CLOSING = {START: "", SYSTEM: "II", USER: "I", ANSWER: ""}


def illegal(codes: str) -> int:
    roles = [LETTERS[c][1] for c in codes]
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))


# Rows


def key_of(conv_id: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def damaged(rows: DataFrame) -> DataFrame:
    """key, conv_id, turn, role, text, copies: rows by the fault that their place in the table gives them."""
    space = F.lit(" ")
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fault = F.crc32(named) % 20
    text, role = F.coalesce(F.col("text").cast("string"), space), F.coalesce(F.col("role").cast("string"), space)
    return rows.select(
        key_of(F.col("conv_id")).alias("key"),
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(fault == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(text, STOPS, "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )


def untouched(rows: DataFrame) -> DataFrame:
    """The same of rows as they are, for conversations that are not to be damaged."""
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("text", "role"))
    return rows.select(key_of(F.col("conv_id")).alias("key"), "conv_id", F.col("turn").cast("long").alias("turn"), role, text, F.lit(1).alias("copies"))


def chunked(rows: DataFrame, scratch: Scratch, chunk: int) -> DataFrame:
    """key, chunk, last, codes (a letter for each row), and the turns and faults of each chunk."""
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    narrow = rows.where("copies > 0").select(
        "key", "turn", "role", F.sha2("text", 256).alias("digest"),
        F.when(bare == "", BLANK).when(F.substring(bare, -1, 1).isin(*STOPS), PLAIN).otherwise(TRUNCATED).alias("fault"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    )
    placed = ranked(scratch.write(narrow, "narrow"), scratch, "order", ["key"], ["turn", "role", "digest"])
    placed = scratch.write(placed, "rows")
    firsts = placed.groupBy("key", "role", "digest").agg(F.min("place").alias("place")).select("key", "place", F.lit(True).alias("first"))
    initial = F.substring("role", 1, 1)
    role = F.when(initial.isin(*ROLES[:3]), F.instr(F.lit(ROLES), initial) - 1).otherwise(len(ROLES) - 1)
    fault = F.when((F.col("fault") != BLANK) & F.col("first").isNull(), DUPLICATE).otherwise(F.col("fault"))
    coded = placed.join(firsts, ["key", "place"], "left").select(
        "key", "place", "size", "turn", fault.alias("fault"), F.char(F.lit(ord("a")) + 4 * fault + role).alias("code"), F.floor(F.col("place") / chunk).alias("chunk"),
    )
    letters = F.array_sort(F.collect_list(F.struct("place", "code")))
    out = coded.groupBy("key", "chunk").agg(
        F.array_join(F.transform(letters, lambda x: x["code"]), "").alias("codes"),
        (F.max("place") + 1 == F.max("size")).alias("last"),
        F.array(*[F.coalesce(f("turn"), F.lit(0)) for f in (F.min, F.max)]).alias("span"), F.size(F.collect_set("turn")).alias("turns"),
        *[F.count_if(F.col("fault") == k).alias(n) for n, k in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED))],
    )
    return scratch.write(out, "chunks")


# Costs at the heads of chunks


SOLVED = "key string, chunk long, last boolean, codes string, used array<int>, head array<int>, total long"


def _vector(x) -> Vector:
    return tuple(int(i) for i in x)


def speculative(chunks: DataFrame) -> DataFrame:
    """Every chunk at once, from the guess at its end; of a last chunk the guess is right."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ends = [backward(codes, END if last else GUESS) for codes, last in zip(b["codes"], b["last"], strict=True)]
            used = [list(END if last else GUESS) for last in b["last"]]
            yield b.assign(used=used, head=[list(v) for v, _ in ends], total=[t for _, t in ends])

    return chunks.select("key", "chunk", "last", "codes").mapInPandas(run, SOLVED)


def next_heads(solved: DataFrame) -> DataFrame:
    """Each chunk that is not the last, with its successor's head."""
    after = solved.select("key", (F.col("chunk") - 1).alias("chunk"), F.col("head").alias("given"))
    return solved.where(~F.col("last")).join(after, ["key", "chunk"])


def fixed_up(off: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ends = [fix_up(r.codes, _vector(r.used), _vector(r.head), r.total, _vector(r.given)) for r in b.itertuples()]
            yield b.assign(used=b["given"], head=[list(v) for v, _ in ends], total=[t for _, t in ends]).drop(columns="given")

    return off.select("key", "chunk", "last", "codes", "used", "head", "total", "given").mapInPandas(run, SOLVED)


def scanned(parts: DataFrame, value: str, compose: Column, backward: bool, scratch: Scratch, label: str) -> DataFrame:
    """(key, chunk, ``value``): ``value`` of all chunks from this one to an end of its conversation,
    composed by doubling the reach in each round. ``compose`` is of columns ``a`` (earlier) and ``b``."""
    out, reach = parts, 1
    most = parts.agg(F.max("chunk")).first()[0] or 0
    while reach <= most:
        shift = -reach if backward else reach
        other = out.select("key", (F.col("chunk") + shift).alias("chunk"), F.col(value).alias("far"))
        a, b = (F.col(value), F.col("far")) if backward else (F.col("far"), F.col(value))
        both = out.join(other, ["key", "chunk"], "left").withColumns({"a": a, "b": b})
        out = scratch.write(both.select("key", "chunk", F.when(F.col("far").isNull(), F.col(value)).otherwise(compose).alias(value)), f"{label}_{reach}")
        reach *= 2
    return out


def _product() -> Column:
    """The (min, +) product of two 4 x 4 matrices, as arrays of 16."""
    cell = lambda i: F.array_min(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.get("a", i - i % 4 + k) + F.get("b", k * 4 + i % 4)))
    return F.transform(F.sequence(F.lit(0), F.lit(15)), cell)


FAR = 1 << 40  # no way


def by_matrices(solved: DataFrame, scratch: Scratch) -> DataFrame:
    """All chunks' end vectors and heads, exactly, from the matrix of each chunk."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for codes in b["codes"]:
                columns = [backward(codes, tuple(0 if q == k else FAR for q in STATES)) for k in STATES]
                rows.append([min(FAR, columns[k][0][q] + columns[k][1]) for q in STATES for k in STATES])
            yield pd.DataFrame({"key": b["key"], "chunk": b["chunk"], "matrix": rows})

    parts = scratch.write(solved.select("key", "chunk", "codes").mapInPandas(run, "key string, chunk long, matrix array<long>"), "matrices")
    rest = scanned(parts, "matrix", _product(), True, scratch, "suffix")
    at = lambda q: F.array_min(F.array(*[F.get("matrix", F.lit(4 * q + k)) + END[k] for k in STATES]))
    heads = rest.select("key", "chunk", F.array(*[at(q) for q in STATES]).alias("cost"))
    less = F.transform("cost", lambda x: (x - F.array_min("cost")).cast("int"))
    heads = scratch.write(heads.select("key", "chunk", less.alias("head"), F.array_min("cost").alias("least")), "heads")
    after = heads.select("key", (F.col("chunk") - 1).alias("chunk"), F.col("head").alias("given"), F.col("least").alias("after"))
    out = solved.drop("used", "head", "total").join(heads, ["key", "chunk"]).join(after, ["key", "chunk"], "left")
    used = F.coalesce("given", F.array(*[F.lit(x) for x in END]))
    return out.select("key", "chunk", "last", "codes", used.alias("used"), "head", (F.col("least") - F.coalesce("after", F.lit(0))).alias("total"))


def settled(chunks: DataFrame, scratch: Scratch, passes: int) -> DataFrame:
    """Every chunk with the right vector at its end (``used``) and head, and what it adds (``total``)."""
    first = scratch.write(speculative(chunks), "pass_0")
    alone = first.where("last and chunk = 0")
    many = scratch.write(first.where("not (last and chunk = 0)"), "many_0")
    if many.isEmpty():
        return alone
    for k in range(1, passes + 1):
        off = scratch.write(next_heads(many).where(F.col("given") != F.col("used")), f"off_{k}")
        if off.isEmpty():
            return alone.union(many)
        known = many.join(off.select("key", "chunk"), ["key", "chunk"], "left_anti")
        many = scratch.write(known.select(many.columns).union(fixed_up(off)), f"many_{k}")
    off = next_heads(many).where(F.col("given") != F.col("used")).select("key").distinct()
    off = scratch.write(off, "unsettled")
    whole = by_matrices(many.join(off, "key", "left_semi").select(many.columns), scratch)
    return alone.union(many.join(off, "key", "left_anti").select(many.columns)).union(whole)


# Audits


def traced(solved: DataFrame, scratch: Scratch) -> DataFrame:
    """key, chunk, audit: each chunk's letters, from the state in which its predecessors end."""

    def maps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ends = [[follow(codes, _vector(used), q)[1] for q in STATES] for codes, used in zip(b["codes"], b["used"], strict=True)]
            yield pd.DataFrame({"key": b["key"], "chunk": b["chunk"], "map": ends})

    def letters(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            audits = []
            for r in b.itertuples():
                audit, q = follow(r.codes, _vector(r.used), int(r.state))
                audits.append(audit + CLOSING[q] if r.last else audit)
            wrong = [illegal(c) for c in b["codes"]]
            yield pd.DataFrame({"key": b["key"], "chunk": b["chunk"], "audit": audits, "illegal": wrong, "ends": [c[0] + c[-1] for c in b["codes"]], "total": b["total"], "head": b["head"]})

    schema = "key string, chunk long, audit string, illegal long, ends string, total long, head array<int>"
    parts = solved.where("not last").select("key", "chunk", "codes", "used").mapInPandas(maps, "key string, chunk long, map array<int>")
    parts = scratch.write(parts, "maps")
    upto = scanned(parts, "map", F.transform("a", lambda q: F.get("b", q)), False, scratch, "prefix")
    before = upto.select("key", (F.col("chunk") + 1).alias("chunk"), F.get("map", F.lit(START)).alias("state"))
    begun = solved.where("chunk = 0").withColumn("state", F.lit(START)).union(solved.where("chunk > 0").join(before, ["key", "chunk"]).select(*solved.columns, "state"))
    return begun.select("key", "chunk", "last", "codes", "used", "head", "total", "state").mapInPandas(letters, schema)


REPAIRED = "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
OF_PIECES = {"audit": "string", "illegal": "long", "ends": "string", "total": "long", "head": "array<int>", "blank": "long", "duplicate": "long", "truncated": "long", "span": "array<long>", "turns": "int"}


class _Conversation:
    """What is known of one conversation while its pieces and then its rows pass by."""

    def __init__(self, key: str):
        self.key, self.audit, self.faults, self.illegal, self.cost = key, [], [0, 0, 0], 0, 0
        self.least = self.most = self.last = None
        self.turns, self.hash, self.lines, self.at = 0, sha256(), 0, 0

    def piece(self, r) -> None:
        self.audit.append(r.audit)
        self.faults = [a + int(b) for a, b in zip(self.faults, (r.blank, r.duplicate, r.truncated), strict=True)]
        self.illegal += int(r.illegal) + (0 if self.last is None else illegal(self.last + r.ends[0]))
        self.last = r.ends[1]
        self.cost += int(r.total) + (0 if r.chunk else int(r.head[START]))
        if r.turns:
            low, high = map(int, r.span)
            self.turns += int(r.turns) - (self.most == low)
            self.least, self.most = (low if self.least is None else self.least), high

    def begin(self) -> None:
        """All pieces have passed; an odd number of turns is led by the system's."""
        if isinstance(self.audit, list):
            self.audit = "".join(self.audit)
            self.odd = (len(self.audit) - self.audit.count("D")) % 2

    def line(self, role: str, text: str) -> None:
        self.hash.update((b"\n" if self.lines else b"") + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.lines += 1

    def due(self) -> str:
        return "assistant" if (self.lines - self.odd) % 2 else "user"

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.line(self.due(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.begin()
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self.line(role if edit == "K" else self.due(), text)

    def done(self) -> tuple:
        self.begin()
        self.inserts()
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (self.key, gaps, *self.faults, self.illegal, self.cost, self.audit, self.hash.hexdigest())


def finished(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """One row for each conversation, from its pieces and its rows in order."""
    none = lambda t: F.lit(None).cast(t)
    first = pieces.select("key", F.lit(0).alias("kind"), "chunk", none("long").alias("turn"), *[none("string").alias(c) for c in ("role", "digest", "text")], F.lit(0).alias("copies"), *OF_PIECES)
    text = F.when(F.col("copies") > 0, F.col("text")).alias("text")
    then = rows.select("key", F.lit(1).alias("kind"), none("long").alias("chunk"), "turn", "role", F.sha2("text", 256).alias("digest"), text, "copies", *[none(t).alias(c) for c, t in OF_PIECES.items()])
    dealt = first.union(then).repartition("key").sortWithinPartitions("key", "kind", "chunk", "turn", "role", "digest").drop("turn", "digest")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, out, columns = None, [], [c.split()[0] for c in REPAIRED.split(", ")]
        for b in batches:
            for r in b.itertuples():
                if now is None or r.key != now.key:
                    if now:
                        out.append(now.done())
                    now = _Conversation(r.key)
                if r.kind == 0:
                    now.piece(r)
                for _ in range(r.copies):
                    now.row(r.role, r.text)
            yield pd.DataFrame(out, columns=columns)
            out = []
        if now:
            yield pd.DataFrame([now.done()], columns=columns)

    return dealt.mapInPandas(run, REPAIRED)


def repair(conversations: DataFrame, damage: bool = True, chunk: int = CHUNK, passes: int = PASSES) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation."""
    scratch = Scratch(conversations.sparkSession, "repair")
    rows = (damaged if damage else untouched)(conversations)
    chunks = chunked(rows, scratch, chunk)
    solved = scratch.write(settled(chunks, scratch, passes), "settled")
    pieces = scratch.write(traced(solved, scratch), "pieces")
    facts = chunks.select("key", "chunk", "blank", "duplicate", "truncated", "span", "turns")
    out = finished(rows, pieces.join(facts, ["key", "chunk"]))
    conv_id = F.when(F.col("key") != "", F.substring("key", 2, 1 << 30)).cast(conversations.schema["conv_id"].dataType)
    return out.select(conv_id.alias("conv_id"), *[c for c in out.columns if c != "key"])


CRC_SQL = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)),
  lambda a, b: xor(a >> 8, crc_table[(xor(a, b) & 255) + 1])), 4294967295::BIGINT)"""
CRC_TABLE_SQL = """bytes AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::BIGINT, range(8)),
  lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END)) AS crc_table)"""

SQL = rf"""
WITH RECURSIVE {CRC_TABLE_SQL},
faults AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {CRC_SQL.format(text="coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS f FROM conversations, bytes),
damaged AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
  CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy FROM faults WHERE f <> 0),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i, count(*) OVER (PARTITION BY conv_id) AS n,
  trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM damaged),
judged AS (SELECT *, substr(role, 1, 1) AS c, CASE WHEN bare = '' THEN 'blank' WHEN i > min(i) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate'
  WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'plain' END AS fault FROM ordered),
coded AS (SELECT *, coalesce(lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c NOT IN ('su', 'ua', 'au'), false) AS wrong,
  fault IN ('plain', 'truncated') AS stays, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS cut FROM judged),
back AS (
  SELECT conv_id, n + 1 AS i, [0, 6, 3, 0] AS v FROM (SELECT DISTINCT conv_id, n FROM coded)
  UNION ALL
  SELECT conv_id, i, [least(e[1], 3 + e[3], 6 + e[4]), least(e[2], 3 + e[3], 6 + e[4]), least(e[3], 3 + e[4]), least(e[4], 3 + e[3])] FROM (
    SELECT b.conv_id, r.i, [
      least(4 + v[1], CASE WHEN stays THEN least(cut + 3 + v[3], cut + CASE c WHEN 's' THEN v[2] WHEN 'u' THEN v[3] ELSE 999999 END) ELSE 999999 END),
      least(4 + v[2], CASE WHEN stays THEN least(cut + 3 + v[3], cut + CASE c WHEN 'u' THEN v[3] ELSE 999999 END) ELSE 999999 END),
      least(4 + v[3], CASE WHEN stays THEN least(cut + 3 + v[4], cut + CASE c WHEN 'a' THEN v[4] ELSE 999999 END) ELSE 999999 END),
      least(4 + v[4], CASE WHEN stays THEN least(cut + 3 + v[3], cut + CASE c WHEN 'u' THEN v[3] ELSE 999999 END) ELSE 999999 END)] AS e
    FROM back b JOIN coded r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i - 1)),
walk AS (
  SELECT conv_id, 1::BIGINT AS i, 1 AS q, '' AS audit, []::VARCHAR[] AS lines, v[1] AS cost FROM back WHERE i = 1
  UNION ALL
  SELECT conv_id, CASE WHEN edit = 'I' THEN i ELSE i + 1 END, CASE edit WHEN 'D' THEN q WHEN 'K' THEN kept ELSE turned END, audit || edit,
         CASE edit WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, role || ':' || text)
           ELSE list_append(lines, CASE WHEN turned = 3 THEN 'user:' ELSE 'assistant:' END || CASE WHEN edit = 'R' THEN text ELSE '' END) END, cost
  FROM (
    SELECT *, CASE WHEN now[q] = 4 + rest[q] THEN 'D' WHEN now[q] = 3 + now[turned] THEN 'I' WHEN stays AND now[q] = cut + rest[kept] THEN 'K' WHEN stays THEN 'R' END AS edit FROM (
      SELECT w.conv_id, w.i, w.q, w.audit, w.lines, w.cost, b.v AS now, a.v AS rest, r.role, r.text, r.stays, r.cut,
             CASE WHEN w.q = 3 THEN 4 ELSE 3 END AS turned, CASE WHEN w.q = 1 AND r.c = 's' THEN 2 WHEN w.q <> 3 AND r.c = 'u' THEN 3 WHEN w.q = 3 AND r.c = 'a' THEN 4 END AS kept
      FROM walk w JOIN back b ON b.conv_id IS NOT DISTINCT FROM w.conv_id AND b.i = w.i
      LEFT JOIN coded r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i
      LEFT JOIN back a ON a.conv_id IS NOT DISTINCT FROM w.conv_id AND a.i = w.i + 1))
  WHERE edit IS NOT NULL),
ends AS (SELECT conv_id, arg_max(audit, length(audit)) AS audit, arg_max(lines, length(audit)) AS lines, any_value(cost) AS cost FROM walk GROUP BY conv_id),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (wrong) AS illegal FROM coded GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
