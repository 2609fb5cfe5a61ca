"""The Merkle manifest, the repair of conversations and the n-gram join, against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_ops import DOCS, components_by_hand, docs_of, low, near_texts
from tidemark.llm import merkle, ngram_join, ranks, repair
from tidemark.llm.shared import Scratch

CONVERSATIONS = "conv_id long, turn long, role string, text string"


# ranks


def test_ranked(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, "a", "b", "b", "b", "c"]), rng.choice([None, *range(9)]), k) for k in range(400)]
    df = spark.createDataFrame(rows, "g string, v long, k long").repartition(7)
    got = ranks.ranked(df, Scratch(spark, "test"), "r", ["g"], ["v", "k"], numbered=True).collect()
    key = lambda x: (x is not None, x or 0)  # noqa: E731  nulls first
    names = sorted({g for g, *_ in rows}, key=lambda g: (g is not None, g or ""))
    for g in names:
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (key(r[1]), r[2]))
        places = {r["k"]: r for r in got if r["g"] == g}
        assert [places[k]["place"] for *_, k in own] == list(range(len(own)))
        assert {r["size"] for r in places.values()} == {len(own)} and {r["number"] for r in places.values()} == {names.index(g)}


# 11


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_by_hand(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree_by_hand(nodes):
    """The root, and for each leaf the texts beside its way."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, way in enumerate(ways):
            run = nodes[at[k] // 16 * 16 :][:16]
            own = at[k] % 16
            way.append(("".join(run[:own]), "".join(run[own + 1 :])))
        nodes = [H(*nodes[k : k + 16]) for k in range(0, len(nodes), 16)]
        at = [k // 16 for k in at]
    return nodes[0], ways


def manifest_by_hand(rows):
    """``rows``: doc_id, source, lang, n_chars, text; what the query returns, as sorted tuples."""
    groups, out = {}, []
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in names:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf_by_hand(r)))
        trees.append((own, *tree_by_hand([leaf_by_hand(r) for r in own])))
    root, over = tree_by_hand([t[1] for t in trees])
    for (own, sub, ways), above in zip(trees, over, strict=True):
        for r, way in zip(own, ways, strict=True):
            taken = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            x = leaf_by_hand((*r[:4], r[4] if r[4] is None or not taken else low(r[4])))
            for left, right in (*way, *above):
                x = H(left, x, right)
            out.append((r[0], leaf_by_hand(r), sub, root, H(*(a + b for a, b in (*way, *above))), x, x == root))
    return sorted(out, key=repr)


MANIFEST = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_manifest(spark, monkeypatch, levels):
    """Sources of 1, 2, 16, 17, 256, 257 and 600 rows, and many small ones; nulls, repeats, tampering."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 16**levels)
    rng = random.Random(levels)
    sizes = {None: 17, "": 1, "a": 600, "é": 257, "z": 256, "b": 16, "A": 2} | {f"s{k}": 1 for k in range(30)}
    rows = [(rng.choice([k, k, k, None, 7]) if k % 50 == 0 else 1000 * n + k, s, rng.choice([None, "en"]), rng.choice([None, k]), rng.choice([None, "", "Ümlaut A-Z", f"Text {k}", f"lower {k}"])) for n, (s, size) in enumerate(sizes.items()) for k in range(size)]
    rows += rows[40:43]
    order = "doc_id long, source string, lang string, n_chars long, text string"
    docs = spark.createDataFrame(rng.sample(rows, len(rows)), order).repartition(5).withColumns({c: F.lit("x") for c in ("tree", "pos", "n", "leaf", "root", "size", "place")})
    manifest = merkle.Manifest(docs)
    got = [tuple(r[c] for c in MANIFEST) for r in manifest.audit().collect()]
    assert sorted(got, key=repr) == manifest_by_hand(rows)
    assert manifest.root() == got[0][3] and {r[6] for r in got} == {True, False}
    proofs = manifest.proofs().collect()
    assert len(proofs) == len(rows) and all(merkle.fold(r["leaf"], r["siblings"]) == r["root"] for r in proofs)


def test_manifest_of_little(spark):
    empty = merkle.Manifest(docs_of(spark, []))
    assert empty.audit().count() == 0 and empty.root() is None
    one = merkle.Manifest(docs_of(spark, ["A b " * 300_000]))
    r = one.audit().first()
    assert r["leaf"] == r["subroot"] == r["root"] == one.root() and r["proof_sha256"] == H("")


def test_addresses():
    """The upper half comes first, then each lower subtree in one piece; siblings lie side by side."""
    for height in range(5):
        at = merkle.addresses(height)
        every = np.concatenate(at)
        assert sorted(every.tolist()) == list(range(merkle.nodes_in(height + 1)))
        if height:
            runs = at[height].reshape(-1, 16)
            assert (np.diff(runs, axis=1) == merkle.nodes_in(1)).all() or height % 2 == 0
        upper = (height + 1) // 2
        if upper:
            assert sorted(np.concatenate(at[:upper]).tolist()) == list(range(merkle.nodes_in(upper)))


# 12


def damage_by_hand(rows):
    out = []
    for conv, turn, role, text in rows:
        conv_key, turn_key = (" " if x is None else str(x) for x in (conv, turn))
        role, text = (" " if x is None else x for x in (role, text))
        fault = zlib.crc32(f"{conv_key}:{turn_key}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        out += [(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))


def cheapest_by_search(roles, faults):
    """(cost, audit) by shortest paths with whole audits as ties, forward over places and states."""
    best = {(0, "^"): (0, "")}
    step = {("^", "s"): "s", ("^", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    for i in range(len(roles) + 1):
        for _ in range(3):  # inserts at this place
            for (j, q), (cost, audit) in list(best.items()):
                for to in {step[q, r] for r in "ua" if (q, r) in step} if j == i else ():
                    best[i, to] = min(best.get((i, to), (99**9, "")), (cost + 3, audit + "I"))
        if i == len(roles):
            break
        for (j, q), (cost, audit) in list(best.items()):
            if j != i:
                continue
            options = [(4, "D", q)]
            if faults[i] in ("", "truncated"):
                cut = 3 * (faults[i] == "truncated")
                options += [(3 + cut, "R", step[q, r]) for r in "ua" if (q, r) in step]
                options += [(cut, "K", step[q, roles[i]])] if (q, roles[i]) in step else []
            for more, name, to in options:
                best[i + 1, to] = min(best.get((i + 1, to), (99**9, "")), (cost + more, audit + name))
    return min(best[k] for k in ((len(roles), "^"), (len(roles), "a")) if k in best)


def repaired_by_hand(rows):
    faults, seen, roles = [], set(), [r[1][:1] for r in rows]
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    turns = [r[0] for r in rows if r[0] is not None]
    cost, audit = cheapest_by_search(roles, faults)
    left, lines = iter(rows), []
    lead = (len(audit) - audit.count("D")) % 2
    for edit in audit:
        _, role, text = next(left) if edit != "I" else (None, "", "")
        due = "assistant" if (len(lines) - lead) % 2 else "user"
        if edit != "D":
            lines.append(f"{role if edit == 'K' else due}:{text}")
    wrong = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), wrong, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def conversations(seed, n=60, longest=40):
    """Random ones: alternating, of one speaker, of odd roles, with nulls, blanks and repeats."""
    rng, rows = random.Random(seed), []
    for conv in [None, *range(n)]:
        style = rng.choice(["turns", "turns", "one", "odd", "any"])
        turn = rng.randrange(5)
        for k in range(rng.choice([1, 2, 5, longest])):
            turn += rng.choice([1, 1, 1, 2, 1 << 54])
            role = {"turns": "assistant" if k % 2 else "user", "one": "user", "odd": "tool"}.get(style) or rng.choice(["system", "user", "assistant", "tool", None, ""])
            text = rng.choice([f"Line {k}.", f"Line {k}?\n", f"Line {k}!", f"cut {k}", f"cut {k}", "Same.", None, " \t", "é. x"])
            rows.append((conv, rng.choice([turn] * 9 + [None]), role if rng.random() < 0.9 else "system", text))
    return rows


@pytest.mark.parametrize(("chunk", "passes"), [(4096, 6), (3, 6), (3, 0), (1, 2), (5, 1)])
def test_repair(spark, chunk, passes):
    """Whole conversations, chunks that converge, and chunks composed as matrices."""
    rows = conversations(chunk)
    table = spark.createDataFrame(rows, CONVERSATIONS).repartition(6).withColumns({c: F.lit(1) for c in ("key", "chunk", "head", "place", "size", "kind", "copies")})
    got = {r[0]: tuple(r)[1:] for r in repair.repair(table, chunk=chunk, passes=passes).collect()}
    want = {c: repaired_by_hand(damage_by_hand([r for r in rows if r[0] == c])) for c in {r[0] for r in rows}}
    assert got == want
    assert max(x[5] for x in got.values()) > 30 and any("I" in x[6] for x in got.values())


def test_repair_of_little(spark):
    assert repair.repair(spark.createDataFrame([], CONVERSATIONS)).count() == 0
    dropped = next(k for k in range(999) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    r = repair.repair(spark.createDataFrame([(dropped, 0, "user", "Hello.")], CONVERSATIONS)).collect()
    assert [tuple(x) for x in r] == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    whole = [(1, 0, "system", "S."), (1, 1, "user", "Hi! " * 300_000 + "."), (1, 2, "assistant", "Yes.")]
    r = repair.repair(spark.createDataFrame(whole, CONVERSATIONS), damage=False).first()
    assert (r["cost"], r["audit"]) == (0, "KKK")


def test_chunks_converge():
    """In a conversation of two speakers a fix-up pass ends after few rows, and gives what a whole run gives."""
    rng = random.Random(2)
    codes = "".join(repair.letter(rng.choice([0] * 9 + [1, 2]), "ua"[k % 2]) for k in range(3000))
    for new in itertools.product((0, 3), (0, 3, 6), (0, 3), (0, 3)):
        new = repair.closed(list(new))
        new = tuple(x - min(new) for x in new)
        head, total = repair.backward(codes, repair.GUESS)
        assert repair.fix_up(codes, repair.GUESS, head, total, new) == repair.backward(codes, new)


# 13


def test_tags_leave_no_partner_out():
    for percent in (60, 80, 85, 95):
        known = ngram_join.tags(percent)
        lows = [t.low for t in known]
        of = lambda n: int(np.searchsorted(lows, n, "right")) - 1  # noqa: E731,B023
        for a in range(1, 3000):
            b = 100 * a // percent
            assert of(b) - of(a) <= 1
            if of(b) > of(a):
                assert 100 * a >= percent * known[of(b)].low
                assert ngram_join.most_differences(a + b, percent) <= ngram_join.most_differences(2 * known[of(b)].high, percent)


@pytest.mark.parametrize("split", [(1, 0), (3, 1), (4, 2)])
def test_linked_sets_share_a_signature(monkeypatch, split):
    """Random pairs at the very edge of the threshold, of all sizes."""
    monkeypatch.setattr(ngram_join, "SPLIT", split)
    rng = np.random.default_rng(5)
    signer = ngram_join.Signer(85, ngram_join.tags(85))
    for n in [*range(1, 90), 120, 333, 1000, 2500]:
        for _ in range(6):
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, n, dtype=np.uint64))
            b = a
            while True:  # drops and adds features as long as the sets stay linked
                c = np.delete(b, rng.integers(len(b))) if rng.random() < rng.choice([0.2, 0.8]) and len(b) > 1 else np.unique(np.append(b, rng.integers(0, 1 << 63, dtype=np.uint64)))
                both = len(np.intersect1d(a, c))
                if 100 * both < 85 * (len(a) + len(c) - both):
                    break
                b = c
            assert len(np.intersect1d(signer.keys(a), signer.keys(b)))
            assert ngram_join.differing(ngram_join.sketch(a), ngram_join.sketch(b)) <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("few", [True, False])
def test_ngram_join(spark, monkeypatch, few):
    if few:
        monkeypatch.setattr(ngram_join, "BLOCK", 4)
    texts = near_texts(17, groups=6, size=20)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.linked(docs_of(spark, texts)).collect()}
    assert got == components_by_hand(texts, 4, 85)
    assert len({c for _, c in got.values()}) < len(got)


def test_ngram_join_of_odd_tables(spark):
    assert ngram_join.linked(docs_of(spark, [])).count() == 0
    same = "One two three four five six. " * 3
    rows = [(1, None, None, None, None), (2, "", None, "s", 0), (3, "A b " * 50_000, "en", "s", 1), (3, "A b " * 50_000, "en", "s", 1), (4, " \n\t", "x", None, 3), (None, same, "en", "s", 5), (9, same.upper(), "en", "s", 5), (7, same, "en", "s", 5), (7, "else", "en", "s", 5), (None, "alone", "en", "s", 5)]
    odd = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(1) for c in ("key", "rep", "node", "component", "n", "sig", "label", "bands")})
    got = sorted((tuple(r) for r in ngram_join.linked(odd).collect()), key=repr)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 2, 3), (3, 2, 3), (4, 0, 4), (None, 6, 7), (9, 6, 7), (7, 6, 7), (7, 1, 7), (None, 1, None)], key=repr)
