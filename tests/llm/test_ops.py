"""Operators against brute force, on small tables with nulls, empty and long texts, ties and repeats."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF
from tidemark.llm import exact_dedup, html_extract, langid, licenses, lm_score, mixing, near_dedup, packing, pii, registry, shared, topk
from tidemark.llm.shared import table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SPACES = re.compile(r"[\x20\x09-\x0D]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def docs_of(spark, texts, lang="en", source="s"):
    rows = [(i, t, lang, source, len(t or "")) for i, t in (texts.items() if isinstance(texts, dict) else enumerate(texts))]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def real(spark):
    return table(spark, SF, "documents").toPandas()


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, same, name):
    same(registry.queries()[name](spark, SF).toPandas(), duck.execute(registry.oracle_sql()[name]).df())


OPERATORS = {
    1: lambda d: html_extract.extract(d.select(F.col("doc_id").alias("page_id"), F.lit("http://h/").alias("url"), F.col("text").alias("html"))),
    2: exact_dedup.exact_groups,
    3: licenses.scan,
    5: lambda d: packing.pack(packing.tokenised_pieces(d, registry.tokenizer_path())),
    6: mixing.mix,
    7: lambda d: langid.identify(d, langid.train(d)),
    8: near_dedup.near_duplicates,
    9: pii.find_pii,
    10: lambda d: lm_score.score(d, d.where("doc_id % 2 = 0")),
}


@pytest.mark.parametrize("n", sorted(OPERATORS))
def test_empty_and_odd_tables(spark, n):
    assert OPERATORS[n](docs_of(spark, [])).count() == 0
    odd = spark.createDataFrame([(1, None, None, None, None), (2, "", None, "s", 0), (3, "A b " * 50_000, "en", "s", 1), (3, "A b " * 50_000, "en", "s", 1), (4, " \n\t", "x", None, 3), (None, "no id", "en", "s", 5)], DOCS)
    extra = odd.withColumns({c: F.lit(1) for c in ("key", "size", "words", "rank", "node", "component", "kept", "target", "host", "skey")})
    assert OPERATORS[n](extra).count() >= 6


# 1


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="<p>no</p>";</script></head><body>
<nav><ul><li><a href="/x">Menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div><div class="ad">Buy now, it is cheap and lasts for long</div>
{main}<aside>Side</aside><form><p>Your name</p></form><section class="comments"><p>First! I liked this piece very much, thanks a lot</p></section>
<footer>&copy; h &middot; all rights</footer></body></html>"""
LONG = "A sentence of prose that is long enough to count as such, with a comma. "


def test_html_text(spark):
    main = f"<article><h1>Tom &amp; Ann</h1><p><b>{LONG}<br><p>Two\n  lines &lt;here&gt;</p>{LONG}<div class='share'>Share</div></article>"
    plain = f"<div id=main-{{}}><div class='post-12 x'><p>{LONG}</p><p>End</p></div></div>"
    rows = [(k, f"http://a.org/{k}", PAGE.format(main=main)) for k in range(3)] + [(9, None, None), (10, "http://b.org", "")]
    rows += [(20 + k, f"https://u@C.org:80/{k}", PAGE.format(main=plain.replace("12", str(k)))) for k in range(3)] + [(30, "http://c.org/odd", f"<p>{LONG}<p>unclosed <b>tags"), (31, "http://d.org", "just text < 5")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for limit in (html_extract.BROADCAST_BYTES, 0):
        got = {r["page_id"]: r for r in html_extract.extract(pages, limit).collect()}
        s = LONG.strip()
        assert got[0]["text"] == f"Tom & Ann\n{s}\nTwo lines <here>\n{s}" and got[0]["path"].endswith("article")
        assert got[9]["text"] == got[10]["text"] == "" and got[9]["n_chars"] == 0
        assert got[21]["text"] == f"{s}\nEnd" and got[21]["path"] == ">html>body>div>div.post-#.x"
        assert got[30]["text"] == f"{s}\nunclosed tags" and got[31]["text"] == "just text < 5"
        assert all(r["n_chars"] == len(r["text"]) for r in got.values()) and len(got) == len(rows)


def test_html_host_of_many_templates(spark):
    names = ["abcdef"[k % 6] for k in range(60)]
    rows = [(k, f"http://h.org/{k}", f"<html><body><p>Site of h, with all its news</p><div class='wrap{x}'><p>Unmarked line</p><div class='part{x}'><p>{LONG * 9}</p></div></div></body></html>") for k, x in enumerate(names)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r["path"] == f">html>body>div.wrap{names[r['page_id']]}>div.part{names[r['page_id']]}" and r["text"] == (LONG * 9).strip() for r in got)


def test_html_fixture(spark):
    """Pages of the fixture hold their article in one element."""
    import html

    got = {r["page_id"]: r["text"] for r in registry.op1_html_extraction(spark, SF).collect()}
    for page in table(spark, SF, "pages").collect():
        inner = re.search("<article>(.*?)</article>", page["html"], re.S).group(1)
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inner))
        assert got[page["page_id"]] == "\n".join(p for p in parts if p)


@pytest.mark.parametrize("name", "main-menu main-nav post-footer entry-footer content-sidebar story-related topbar replies related-posts sidebar-left mainNav cookie_notice ad-slot recommended trending most-read popular-posts more-stories read-next outbrain taboola skip-link search-box cart notification announcement disclaimer discussion paywall teasers tag-list hidden sr-only visually-hidden".split())
def test_html_names_beside_the_text(name):
    page = lambda mark: html_extract.Page(f"<body><div class='content'><p>{LONG * 3}</p><div {mark}><p>{LONG}beside</p></div><p>End</p></div></body>").text([])[0]
    assert "beside" not in page(f"class='{name}'") and "beside" not in page(f"id={name}") and page(f"class='x {name}'").endswith("End")


@pytest.mark.parametrize("name", "content post-header nav-content has-sidebar content-sidebar-wrap main entry-content articleBody page-wrap adder hidden-xs reading-list next-chapter story-list".split())
def test_html_names_of_the_text(name):
    assert "inside" in html_extract.Page(f"<body><div class='{name}'><p>{LONG * 3}inside</p></div></body>").text([])[0]


def test_html_elements():
    text = lambda inner, out="": html_extract.Page(f"<html><body><header>Site</header><div role='navigation'>Way</div>{out}<article>{inner}</article></body></html>").text([])[0]
    s = LONG.strip()
    assert text(f"<header><h1>Title</h1></header><p>{LONG}</p><footer>Share</footer>") == f"Title\n{s}"
    assert text(f"<p>{LONG}<math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>tex</annotation></math> end</p>") == f"{s} x=2 end"
    assert text(f"<p>{LONG}<svg><text>no</text></svg><noscript>no</noscript><textarea>no</textarea></p><!-- no --><ul><li>one<li class=ad>two<li>three</ul>") == f"{s}\none\nthree"
    assert text(f"{LONG}<table><tr><th>a<td>b<tr><td>c<td>d<table><tr><td>e</table>f</table>g") == "\n".join([s, *"abcdefg"])
    assert text(f"<p title='a > b'>{LONG}</p><p hidden>no</p><p aria-hidden=true>no</p><p style='display: none'>no</p>5 < 6 &amp; 7<br>&#x41;&copy &nbsp; z") == f"{s}\n5 < 6 & 7 A© z"
    assert text(f"<p>{LONG}", out="<div><p>" + LONG * 9 + "</p></div>") == (LONG * 9).strip()


def test_html_headers_and_forms():
    s = LONG.strip()
    for inside, kept in (("<main>{}</main>", True), ("<div class='blog-post'>{}</div>", True), ("<div class='page'>{}</div>", False)):
        page = f"<body><header><h2>Site</h2></header>{inside.format(f'<header><h1>Title</h1></header><p>{LONG * 3}</p>')}</body>"
        assert html_extract.Page(page).text([])[0] == ("Title\n" if kept else "") + " ".join([s] * 3)
    page = f"<body><main><p>{LONG}</p><fieldset><legend>Names</legend><label>First</label></fieldset><label>One</label><label>Two</label><p style='visibility: hidden'>Not this</p></main></body>"
    assert html_extract.Page(page).text([])[0] in (f"{s}\nOne\nTwo\nNot this", f"{s}\nOne\nTwo")


@pytest.mark.parametrize("html", ["<a " * 300_000, "<svg>" * 300_000, "<div class=x>t " * 100_000, "<a href=\"" * 300_000, "<table>" + "<tr><td>cell " * 100_000, "<div>" * 50_000 + "</x>" * 300_000, "<!--" * 10**6, "< " * 300_000, "<table><td><table>" + "<div>" * 50_000 + "<td>" * 50_000 + "<tr>" * 50_000, "<a b='" + '"' * 10**6])
def test_broken_html_takes_linear_time(html):
    import time

    t = time.process_time()
    html_extract.Page(html).text([html_extract.votes(html)[0][0] if html_extract.votes(html) else ">div"])
    assert time.process_time() - t < 60  # quadratic work would take hours


def test_html_votes_by_hand(spark):
    """Winning paths of hosts against plain counting of each page's best container."""
    rng = random.Random(13)
    rows = []
    for k in range(300):
        h, kind = rng.choice(["a.org", "b.org", "c.org"]), rng.choice("pppqqrs")
        rows.append((k, f"https://{h}/{k}", f"<body><div class='{kind} n{k}'><p>{LONG * rng.randint(1, 5)}</p></div><section><p>{LONG * rng.randint(0, 3)}</p></section></body>"))
    rows += [(1, "https://a.org/0", "<body><table>"), (2, None, "<p>" + LONG)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    counted = Counter()
    for _, url, html in rows:
        parts = {m[1]: len(m[2].strip()) for m in re.finditer(r"<(div class='[^']*'|section)><p>([^<]*)", html)}
        best = max(reversed(parts), key=parts.get, default=None)  # of equal ones the later
        if best and url:
            classes = re.sub("[0-9]+", "#", best[11:-1]).split() if best != "section" else []
            counted[re.split("/+", url)[1], ">body>" + best.split()[0] + "".join(f".{c}" for c in sorted(classes))] += 1
    for share in (0.1, 0.5):
        most = {h: max(n for (g, _), n in counted.items() if g == h) for h, _ in counted}
        all_ = {h: sum(n for (g, _), n in counted.items() if g == h) for h, _ in counted}
        want = {x for x, n in counted.items() if n >= share * most[x[0]] and 100 * n >= all_[x[0]]}
        assert {(r["host"], r["path"]) for r in html_extract.host_paths(pages, share).collect() if r["host"]} == want


# 2


def test_exact_groups_and_colliding_fingerprints(spark, real):
    rng = random.Random(1)
    base = ["".join(rng.choices("abc def\n", k=rng.randint(0, 9000))) for _ in range(12)]
    texts = base + base[:6] + [SPACES.sub("  ", t) for t in base[:4]] + [None, "", " ", "\n"] + [base[0][:-1] + "!", "é", "é"]
    for bits in (64, 3):  # with 3 bits most fingerprints stand for several chunks
        got = {r["doc_id"]: r for r in exact_dedup.exact_groups(docs_of(spark, texts), bits).collect()}
        norm = [SPACES.sub(" ", t or "") for t in texts]
        for i, t in enumerate(norm):
            assert (got[i]["keep_id"], got[i]["group_size"], got[i]["kept"]) == (norm.index(t), norm.count(t), norm.index(t) == i)
            assert got[i]["text_sha256"] == hashlib.sha256(t.encode()).hexdigest()


def test_chunks_follow_content():
    rng = random.Random(2)
    data = bytes(rng.choices(b"abcdefgh ", k=3 * exact_dedup.SEGMENT // 2))
    ends = exact_dedup.cut_points(data)
    assert ends[-1] == len(data) and ends == sorted(set(ends))
    moved = {e - 7 for e in exact_dedup.cut_points(b"1234567" + data)}
    assert len(moved & set(ends)) > 0.98 * len(ends)


def test_without_copies(spark):
    rows = [(1, "a b", "en", "s", 1), (1, "a b", "en", "s", 1), (2, "a  b", "en", "s", 1), (3, "c", "en", "s", 1)]
    out = exact_dedup.without_copies(spark.createDataFrame(rows, DOCS))
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 3]
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]


ODD_IDS = [(1, "copy"), (2, "copy"), (2, "unique text b"), (None, "copy"), (None, "alone"), (None, " "), (None, "\n"), (5, "alone  c"), (5, "alone c"), (6, None), (6, ""), (3, "alone c"), (7, "x")]


def test_repeated_and_null_ids_lose_no_text(spark):
    """Rows that share an id, or have none, are told apart by their text."""
    rows = [(i, t, "en", "s", 1) for i, t in ODD_IDS]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    norm = [SPACES.sub(" ", t or "") for _, t in ODD_IDS]
    least = {t: min((i for (i, _), n in zip(ODD_IDS, norm) if n == t and i is not None), default=None) for t in norm}
    want = sorted(((i, least[t], norm.count(t), i == least[t]) for (i, _), t in zip(ODD_IDS, norm)), key=repr)
    assert sorted((tuple(r)[:4] for r in exact_dedup.exact_groups(docs).collect()), key=repr) == want
    kept = exact_dedup.without_copies(docs).collect()
    assert sorted(SPACES.sub(" ", r["text"] or "") for r in kept) == sorted(set(norm))
    assert all(r["doc_id"] == least[SPACES.sub(" ", r["text"] or "")] for r in kept)


def test_near_repeated_and_null_ids_lose_no_text(spark):
    long = " ".join(f"w{k}" for k in range(60))
    rows = [(4, long), (2, long + " x"), (2, "another text of its own"), (None, long + " y"), (None, "no id but text"), (None, "no id but text"), (7, "no id but text"), (None, "alone with no id"), (8, None), (8, ""), (9, "twice the same"), (9, "twice the same")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    got = near_dedup.near_duplicates(docs, 2).collect()
    want = [(4, 59, 2, False), (2, 60, 2, True), (2, 4, 2, True), (None, 60, 2, False), (None, 3, 7, False), (None, 3, 7, False), (7, 3, 7, True), (None, 3, None, True), (8, 0, 8, True), (8, 0, 8, True), (9, 2, 9, True), (9, 2, 9, True)]
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got), key=repr) == sorted(want, key=repr)
    kept = near_dedup.without_near_copies(docs, 2)
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted([(2, long + " x"), (2, rows[2][1]), (7, rows[6][1]), (None, rows[7][1]), (8, None), (8, ""), (9, rows[10][1])], key=repr)
    assert kept.columns == docs.columns


# 3

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def scan_by_hand(text, threshold=0.8):
    w = WORD.findall(low(text or ""))
    places, base = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        at = [k for k in range(len(w)) if w[k : k + len(p)] == p]
        places += at
        base |= {label} if at else set()
    more, best = set(base), 0.0
    for line in (text or "").split("\n"):
        own = set(WORD.findall(low(line)))
        for t, label in licenses.TEMPLATES.items():
            t = set(t.split())
            if len(t & own) >= math.ceil(threshold * len(t) - 1e-9):
                more.add(label)
                best = max(best, len(t & own) / len(t))
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(more)), 1.0 if base else best


def test_licenses(spark, real):
    texts = [*real["text"], None, "", "Under The MIT License under the mit license CC-BY.NC", "éunder the mit license", "under the mit licenseé under the MIT-license!"]
    texts += ["CC by NC x apache license, version 2", "ſunder the mİt license Kunder the mit license", " \n", "GNU general public license work, this is licensed under the\nversion 3"]
    for r in licenses.scan(docs_of(spark, texts)).collect():
        assert tuple(r)[1:] == scan_by_hand(texts[r["doc_id"]])


def test_wrapped_and_scattered_notices(spark):
    mit, bsd, gpl, mpl = (next(t for t, own in licenses.TEMPLATES.items() if own == label and len(t.split()) > 8) for label in ("mit", "bsd", "gpl", "mpl-2"))
    wrap = lambda t, n: "\n# ".join(" ".join(t.split()[k : k + n]) for k in range(0, len(t.split()), n))
    texts = ["some words before\n" * 30 + wrap(t, n) + "\nand after" * 30 for t in (mit, bsd, gpl, mpl) for n in (3, 7)]
    texts += [" ".join(f"{w} {'filler ' * 20}" for w in mit.split()), "\n".join(f"{w} {'filler ' * 20}" for w in mit.split())]  # scattered
    texts += ["prose " * 3000 + mit + " prose" * 3000, "released under the GPL license", "released under\nthe MIT license", "released under the\nGPL license"]
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan(docs_of(spark, texts)).collect()}
    assert [got[k] for k in range(8)] == [(x, 1.0) for x in ("mit", "bsd", "gpl", "mpl-2") for _ in range(2)]
    assert [got[k] for k in range(8, 14)] == [("", 0.0), ("", 0.0), ("mit", 1.0), ("", 0.0), ("mit", 1.0), ("", 0.0)]


def test_license_plan_is_native(spark):
    plan = licenses.scan(table(spark, SF, "documents"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# 4


def top_k_by_hand(rows, k, every=20):
    """``rows`` (vec_id, integers) in any order; ids may repeat."""
    out = {}
    for q in {i for i, _ in rows if i % every == 0}:
        x = min(v for i, v in rows if i == q)
        out[q] = [(i, -s) for s, i in sorted((-sum(a * b for a, b in zip(x, v)), i) for i, v in rows if i != q)[:k]]
    return out


@pytest.mark.parametrize("small", [False, True])
def test_top_k(spark, monkeypatch, small):
    """Ties, repeated ids, odd vectors and huge components; in one cell and in many."""
    if small:
        for name, n in (("BLOCK_BYTES", 400), ("GROUP_BYTES", 300), ("SHARD_BYTES", 4000)):
            monkeypatch.setattr(topk, name, n)
    rng = np.random.default_rng(3)
    vectors = [rng.integers(-3, 4, 6).tolist() for _ in range(300)]
    vectors[40:80] = [vectors[40]] * 40
    known = [(i, v) for i, v in enumerate(vectors)] + [(20, [1, 1]), (20, vectors[20]), (20, [3]), (7, vectors[7]), (7, [2, 0, 1]), (1060, [64_000_000_000]), (1080, []), (-20, [1] * 9), (1 << 60, [-2])]
    rows = [(i, [float(x) / 64 for x in v]) for i, v in known] + [(1000, None), (1020, [1.0, None]), (1040, [float("nan")]), (1100, [float("inf")]), (None, [1.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3), k=7).orderBy("query_id", "rank").collect()
    assert all([r["rank"] for r in g] == list(range(1, 8)) for _, g in itertools.groupby(got, key=lambda r: r["query_id"]) for g in [list(g)])
    assert {q: [(r["vec_id"], r["score"]) for r in g] for q, g in itertools.groupby(got, key=lambda r: r["query_id"])} == top_k_by_hand(known, 7)


def test_top_k_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, block int, n int, s int, g int, least int, x string"
    odd = lambda rows: topk.top_k(spark.createDataFrame([(*r, 1, 1, 1, 1, 1, "x") for r in rows], schema))
    assert odd([]).count() == 0 and odd([(20, [1.0])]).count() == 0 and odd([(20, [1.0]), (20, [1.0])]).count() == 0
    assert [tuple(r) for r in odd([(20, []), (1, []), (2, [])]).orderBy("rank").collect()] == [(20, 1, 1, 0), (20, 2, 2, 0)]
    assert odd([(20, None), (1, [1.0])]).count() == 0


def test_top_k_blocks_are_skipped():
    least = topk.NO_LEAST
    asked = pd.DataFrame([{"query_id": 0, "x": np.array([1]), "least": least}])
    block = lambda v, i: {"n": 1, "dim": 1, "ids": np.array([i]).tobytes(), "rows": np.array([[v]]).tobytes(), "high": np.array([v]).tobytes(), "low": np.array([v]).tobytes()}
    held = pd.DataFrame([block(1, 5), block(9, 6), block(9, 4)])
    assert topk.search_cell(asked, held, 1).values.tolist() == [[0, 4, 9]]
    held.loc[0, "rows"] = b"not read"[:8]  # its bound is below the first score
    assert topk.search_cell(asked, held, 1).values.tolist() == [[0, 4, 9]]
    assert topk.search_cell(asked.assign(least=10), held, 1).empty


# 5


def test_plan_places_every_piece_once():
    rng = random.Random(4)
    for capacity, n in ((10, 60), (64, 500), (64, 3), (4096, 2000), (4096, 0)):
        lengths = [min(capacity, max(1, int(rng.expovariate(4 / capacity)))) for _ in range(n)]
        counts = {x: lengths.count(x) for x in set(lengths)}
        entries, figures = packing.plan(counts, capacity)
        bins = {}
        for length, total in counts.items():
            own = entries[entries[:, 0] == length]
            for rank in range(total):
                e = own[np.searchsorted(own[:, 1], rank, side="right") - 1]
                k = rank - e[1]
                bins.setdefault(int(e[2] + k // e[4]), []).append((int(e[3] + k % e[4] * length), length))
        assert sorted(bins) == list(range(figures["sequences"]))
        for parts in bins.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= capacity
        assert figures["least"] <= figures["sequences"] <= figures["least"] * 1.23 + 1


def test_dominance_fixes_pairs():
    _, figures = packing.plan({6: 3, 4: 3, 9: 2, 10: 1}, 10)
    assert figures == {"sequences": 6, "fixed": 6, "least": 6}


def least_bins(lengths, capacity):
    """The least number of bins, by trying every place for each piece, largest first."""
    best, order = len(lengths), sorted(lengths, reverse=True)

    def go(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(order):
            best = len(rooms)
            return
        for room in {r for r in rooms if r >= order[k]}:
            i = rooms.index(room)
            go(k + 1, [*rooms[:i], room - order[k], *rooms[i + 1 :]])
        go(k + 1, [*rooms, capacity - order[k]])

    go(0, [])
    return best


def test_reduction_keeps_the_optimum():
    rng = random.Random(14)
    sizes = Counter()
    for _ in range(1500):
        capacity, low = rng.choice([(10, 1), (20, 3), (30, 5), (40, 9)])
        lengths = [rng.randint(low, capacity) if rng.random() < 0.4 else rng.randint(low, capacity // 2) for _ in range(rng.randint(1, 8))]
        left = np.bincount(lengths, minlength=capacity + 1)
        fixed = list(packing.reduction(left, capacity))
        rest = np.repeat(np.arange(capacity + 1), left).tolist()
        assert sorted([x for pieces, n in fixed for x in pieces * n] + rest) == sorted(lengths)
        assert all(sum(pieces) <= capacity for pieces, _ in fixed)
        assert sum(n for _, n in fixed) + least_bins(rest, capacity) == least_bins(lengths, capacity)
        sizes.update(len(pieces) for pieces, _ in fixed)
    assert sizes[1] and sizes[2] and sizes[3] > 20


def test_tokens_and_packing(spark):
    from tokenizers import Tokenizer

    hf = Tokenizer.from_file(registry.tokenizer_path())
    rng = random.Random(5)
    odd = [chr(c) for c in range(1, 0x180)] + list("ΣςİıſǅÅ日本 ́​\x85\xa0é'") + ["<|endoftext|>", "'s", "\n"]
    texts = ["".join(rng.choices(odd, k=rng.randint(0, 30))) for _ in range(400)] + [None, "", "word " * 9000, "word " * 4095]
    texts += table(spark, SF, "documents").toPandas()["text"].tolist()
    rows = packing.pack(packing.tokenised_pieces(docs_of(spark, texts), registry.tokenizer_path(), with_ids=True)).collect()
    for i, t in enumerate(texts):
        ids = hf.encode(t or "", add_special_tokens=False).ids + [1]
        mine = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [r["start"] for r in mine] == list(range(0, len(ids), 4096))
        for r in mine:
            part = np.array(ids[r["start"] : r["start"] + 4096], dtype="<u4").tobytes()
            assert (r["length"], r["ids_crc32"], bytes(r["ids"])) == (len(part) // 4, zlib.crc32(part), part)
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 4096 and len(ends) <= 1.02 * sum(r["length"] for r in rows) / 4096 + 1


# 6


def test_mix(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * rng.randint(0, 30)) if i % 9 else None, "en", rng.choice(["a", "b", "b", "b", "c", None, "é"]), 0) for i in range(400)]
    got = mixing.mix(spark.createDataFrame(rows, DOCS)).toPandas()
    again = mixing.mix(spark.createDataFrame(rows[::-1], DOCS)).toPandas()
    assert got.sort_values("doc_id")["taken"].tolist() == again.sort_values("doc_id")["taken"].tolist()
    assert (got["taken"] <= 2 * got["size"]).all() and len(got) == 400
    sums = got.groupby(got["source"].fillna("~"))[["size", "taken"]].sum()
    first = got.groupby(got["source"].fillna("~"))[["source_size", "target"]].first()
    assert (sums["size"] == first["source_size"]).all() and ((sums["taken"] - first["target"]).abs() <= 1).all()
    assert abs(first["target"].sum() - 1.5 * got["size"].sum()) < 1e-6 and (first["target"] <= 2 * first["source_size"] + 1e-9).all()
    odd = [(i, "w " * n + x, "en", "s", 0) for i, n, x in [(1, 3, ""), (2, 50, "x"), (2, 5, "y"), (2, 5, "z"), (None, 9, "a"), (None, 2, "b"), (None, None, "")] for n in [n or 0]]
    odd += [(None, f"w {k} w", "en", "t", 0) for k in range(300)]
    takes = [sorted(map(tuple, mixing.mix(spark.createDataFrame(odd, DOCS).orderBy(F.rand(k)).repartition(k)).collect()), key=repr) for k in (1, 3, 5)]
    assert takes[0] == takes[1] == takes[2]
    clump = mixing.mixed_documents(spark.createDataFrame(odd, DOCS)).where("source = 't'").count()
    assert abs(clump - takes[0][-1][4] / 3) < 2  # rows without id are dealt one by one
    whole = mixing.mixed_documents(spark.createDataFrame(rows, DOCS)).toPandas()
    words = whole["text"].fillna("").map(lambda t: len(t.split())).groupby(whole["source"].fillna("~")).sum()
    assert ((words - first["target"]).abs() <= 30).all() and whole.columns.tolist() == ["doc_id", "text", "lang", "source", "n_chars"]


def test_mix_plan_is_native(spark):
    plan = mixing.mix(table(spark, SF, "documents"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# 7


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs)
    got = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got["held_out"]]
    assert (held["lang_pred"] == held["lang"]).mean() > 0.97
    assert ((held["score"] > 0) & (held["score"] <= 1)).all()
    assert (got["held_out"] == got["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    by_lang = docs.orderBy("doc_id").groupBy("lang").agg(F.first("text").alias("t")).toPandas().set_index("lang")["t"]
    both = by_lang["en"][:1500] + " " + by_lang["de"][:1500]
    odd = langid.identify(docs_of(spark, [None, "", "123 !!", both]), model).orderBy("doc_id").toPandas()
    assert odd["lang_pred"].tolist()[:3] == ["und"] * 3 and odd["score"].tolist()[:3] == [0.0] * 3
    assert {x.split(":")[0] for x in odd["languages"][3].split(",")} >= {"en", "de"}
    none = langid.identify(docs_of(spark, ["² ½ ①", "Ⅷ 5", "_", "日本"]), model).orderBy("doc_id").toPandas()
    assert none["lang_pred"].tolist()[:3] == ["und"] * 3 and none["lang_pred"][3] != "und"
    kept = langid.accepted(docs_of(spark, [None, "", "123 !!", both]), model)
    assert [r["doc_id"] for r in kept.collect()] == [3]


def test_grams_of_long_and_short_texts(monkeypatch):
    """N-grams by plain slicing; in segments, counts are those of the whole text."""
    text = "Über the río, 12 x " * 300 + "end"
    want = grams_by_hand(text)
    for segment in (1 << 20, 1 << 9, 7, 6000):
        monkeypatch.setattr(langid, "SEGMENT", segment)
        found, counts = langid.grams(text)
        assert dict(zip(found.tolist(), counts.tolist())) == want and (np.diff(found.astype(int)) > 0).all()


def grams_by_hand(text):
    folded = b" " + b" ".join(re.findall(b"[a-z\x80-\xff]+", text.lower().encode())) + b" "
    return Counter(int.from_bytes(folded[k : k + n], "big") for n in (2, 3, 4) for k in range(len(folded) - n + 1))


def mixture_by_hand(logs, counts, langs, steps=4000):
    share = [1 / len(langs)] * len(langs)
    for _ in range(steps):
        new = [0.0] * len(langs)
        for row, c in zip(logs, counts):
            p = [s * math.exp(row[k]) for s, k in zip(share, langs)]
            new = [a + c * x / sum(p) for a, x in zip(new, p)]
        share = [x / sum(counts) for x in new]
    return sum(c * math.log(sum(s * math.exp(row[k]) for s, k in zip(share, langs))) for row, c in zip(logs, counts)), share


def test_mixture_and_choice_of_languages():
    """EM against plain loops; the choice by penalised likelihood against all sets."""
    rng = np.random.default_rng(12)
    for seed in range(6):
        model = np.log(rng.dirichlet(np.full(30, 0.3), size=4).T + 1e-4)
        true = rng.dirichlet(np.ones(4)) if seed % 2 else np.eye(4)[seed // 2]
        counts = rng.multinomial(400, (np.exp(model) @ true) / (np.exp(model) @ true).sum()).astype(float)
        value, share = langid.mixture(model, counts, [0, 2, 3])
        want, parts = mixture_by_hand(model.tolist(), counts.tolist(), [0, 2, 3])
        assert value == pytest.approx(want, abs=0.05) and np.allclose(share, parts, atol=5e-3)
        langs, share = langid.proportions(model, counts, 4.0)
        cost = 4.0 * math.log(counts.sum() + 1)
        values = {s: 2 * langid.mixture(model, counts, list(s))[0] - cost * len(s) for n in range(1, 5) for s in itertools.combinations(range(4), n)}
        assert values[tuple(sorted(langs))] == pytest.approx(max(values.values()), abs=1e-3) and share.sum() == pytest.approx(1)


def test_no_single_change_of_the_set_helps():
    """Six languages: nothing one step away is better, and hardly ever any other set."""
    rng = np.random.default_rng(21)
    worse = 0
    for seed in range(40):
        model = np.log(rng.dirichlet(np.full(40, 0.3 + seed % 3), size=6).T + 1e-4)
        true = np.where(rng.random(6) < 0.5, rng.dirichlet(np.ones(6)), 0) + np.eye(6)[seed % 6] * 0.2
        p = np.exp(model) @ true
        counts = rng.multinomial(200 + 100 * seed, p / p.sum()).astype(float)
        chosen = set(langid.proportions(model, counts, 4.0)[0])
        cost = 4.0 * math.log(counts.sum() + 1)
        values = {frozenset(s): 2 * langid.mixture(model, counts, list(s))[0] - cost * len(s) for n in range(1, 7) for s in itertools.combinations(range(6), n)}
        near = [v for s, v in values.items() if len(s - chosen) <= 1 and len(chosen - s) <= 1]
        assert values[frozenset(chosen)] >= max(near) - 1e-3
        worse += values[frozenset(chosen)] < max(values.values()) - 1e-3
    assert worse <= 1


def test_bound_of_a_further_language_holds():
    rng = np.random.default_rng(16)
    useful = 0
    for turn in range(60):
        model = np.log(rng.dirichlet(np.full(40, 0.5), size=4).T + 1e-5)
        share = np.array([1, 0.3 * (turn % 2), rng.choice([0, 0, 0.01, 0.05, 0.5]), 0])
        p = np.exp(model) @ share
        counts = rng.multinomial(500, p / p.sum()).astype(float)
        own = [0, 1][: 1 + turn % 2]
        value, found = langid.mixture(model, counts, own)
        most = langid.most_gains(np.exp(model), counts, own, found)
        for k in {0, 1, 2, 3} - {*own}:
            assert langid.mixture(model, counts, [*own, k])[0] - value <= most[k] + 1e-6
            useful += most[k] < 10
    assert 20 < useful < 150


def test_model_by_plain_counting(spark):
    """Every n-gram above its share is known, the others are one event; odd tables."""
    rows = [(k, t, lang, "s", 0) for k, (t, lang) in enumerate([("ab ab", "x"), ("abc", "y"), ("b", "x"), (None, "x"), ("abc", None), ("abcd abce", "y")] * 4)]
    docs = spark.createDataFrame(rows, DOCS)
    sums = {"x": Counter(), "y": Counter()}
    for i, t, lang, *_ in rows:
        if t and lang and zlib.crc32(str(i).encode()) % 4 != 2:
            sums[lang] += grams_by_hand(t)
    for least in (0.0, 0.06, 0.09):
        known = sorted({g for c in sums.values() for g, n in c.items() if n >= least * c.total()})
        assert least == 0 or len(known) < len(sums["x"] | sums["y"])
        want = np.array([[*(c[g] + 0.5 for g in known), c.total() - sum(c[g] for g in known) + 0.5] for c in sums.values()]).T
        model = langid.train(docs, least_share=least)
        assert model.langs == ["x", "y"] and model.known.tolist() == known
        assert np.allclose(model.logs, np.log(want / want.sum(axis=0)), atol=1e-5)
        logs, counts = langid.likelihoods("abce zz", model.known, model.logs)
        plain = grams_by_hand("abce zz")
        assert counts.tolist() == [plain[g] for g in known if plain[g]] + [n for n in [sum(n for g, n in plain.items() if g not in known)] if n]
        assert np.allclose(logs[-1], model.logs[-1])
    assert langid.train(spark.createDataFrame([], DOCS)).langs == []


def test_language_of_every_row_by_brute_force(spark):
    """The whole query in plain Python, with all sets of six languages tried for each document."""
    rng = np.random.default_rng(8)
    letters = "abcdefghijklmnop"
    speech = {lang: [*("".join(rng.choice(list(letters), size=rng.integers(2, 7), p=w)) for _ in range(30))] for lang, w in zip("tuvwxy", rng.dirichlet(np.full(16, 0.4), size=6))}

    def said(lang, n):
        return " ".join(rng.choice(speech[lang], size=n))

    rows = [(k, said(lang, 40), lang, "s", 0) for k, lang in enumerate("tuvwxy" * 8)]
    for k in range(24):
        a, b = rng.choice(list("tuvwxy"), size=2, replace=False)
        rows.append((100 + k, said(a, 60 + k) + " " + said(b, 5 * (k % 7)), None, None, 0))
    docs = spark.createDataFrame([*rows, (200, None, "t", "s", 0), (201, "1 2", None, "s", 0), (None, rows[0][1], "t", "s", 0)], DOCS)
    model = langid.train(docs)
    got = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    assert (got[200]["lang_pred"], got[201]["lang_pred"]) == ("und", "und") and got[None]["lang_pred"] == got[0]["lang_pred"]
    same = 0
    for i, text, *_ in rows:
        plain = grams_by_hand(text)
        at = {g: k for k, g in enumerate(model.known.tolist())}
        logs = np.array([model.logs[at.get(g, len(at))] for g in plain], dtype=float)
        counts = np.array(list(plain.values()), dtype=float)
        cost = 4.0 * math.log(counts.sum() + 1)
        fits = {s: langid.mixture(logs, counts, list(s)) for n in range(1, 7) for s in itertools.combinations(range(6), n)}
        best = max(fits, key=lambda s: 2 * fits[s][0] - cost * len(s))
        share, lang = max((float(p), model.langs[k]) for p, k in zip(fits[best][1], best))
        same += got[i]["lang_pred"] == lang and abs(got[i]["score"] - share) < 1e-3
    assert same >= len(rows) - 1


# 8


def components_by_hand(texts, words, percent=80):
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", low(t or ""))
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(texts), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in texts}


def near_texts(seed=7, groups=6, size=25):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(4000)]
    texts = {}
    for _ in range(groups):
        base = rng.choices(words, k=rng.randint(20, 200))
        for _ in range(size):
            own = [rng.choice(words) if rng.random() < rng.choice([0, 0.01, 0.05, 0.09]) else w for w in base]
            texts[len(texts)] = " ".join(own)
    for t in (None, "", "one", "One", "one two", "a b c d", *rng.sample(sorted(texts.values()), 20)):
        texts[len(texts)] = t
    ids = rng.sample(range(10_000), len(texts))
    return {ids[i]: t for i, t in texts.items()}


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates(spark, words, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    monkeypatch.setattr(near_dedup, "CELL", 1000)
    texts = near_texts()
    got = near_dedup.near_duplicates(docs_of(spark, texts), words).collect()
    expected = components_by_hand(texts, words)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == expected
    assert all(r["kept"] == (r["component_id"] == r["doc_id"]) for r in got)
    kept = near_dedup.without_near_copies(docs_of(spark, texts), words)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, (_, c) in expected.items() if i == c}


def test_components(spark, tmp_path):
    from tidemark.llm.components import components
    from tidemark.llm.shared import Scratch

    rng = random.Random(8)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1040)] + [(2000, k) for k in range(2001, 2100)] + [(5, 5)]
    root = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "test")).collect()
    assert {r["node"]: r["component"] for r in got} == root and len(got) == len(root)


# 9


def pii_by_hand(text):
    text = text or ""
    out = []
    for kind, pattern in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            double = [int(x) * (1 + k % 2) for k, x in enumerate(digits[::-1])]
            ok = {
                "email": True,
                "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")),
                "card": 14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in double) % 10 == 0,
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), ("email", "ip", "card", "phone").index(kind), f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x for *_, x in sorted(out))


def test_pii(spark, real):
    rng = random.Random(9)
    alphabet = list("abZ0123456789999..@@--+ ()_%é\n") + ["a@b.cd", "1.2.3.4", "+1 (988) 555-2485", "4337166598464399", "é😀"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(3000)] + [None, ""] + real["text"].tolist()
    for r in pii.digest(pii.find_pii(docs_of(spark, texts))).collect():
        base = pii_by_hand(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        kinds = [x.split(":")[0] for x in base.split(",")]
        assert [r[f"n_{k}"] for k in pii.BASE] == [kinds.count(k) for k in pii.BASE]
        assert set(filter(None, base.split(","))) <= set(r["spans"].split(","))


def test_pii_checks_and_context(spark):
    found = pii.spans("iban GB82 WEST 1234 5698 7654 32, GB83 WEST 1234 5698 7654 32; ssn 123-45-6789 or far " + "x" * 50 + " 123-45-6789")
    assert [(k, round(s, 1)) for k, *_, s in found] == [("iban", 1.0), ("ssn", 0.6)]
    assert [r["scores"] for r in pii.digest(pii.find_pii(docs_of(spark, ["mail a@b.cd, " + "x" * 50 + " 1.2.3.4", None]))).orderBy("doc_id").collect()] == ["1.00,0.70", ""]
    assert pii.luhn("79927398713") and not pii.luhn("79927398710")


def test_iban_before_other_words():
    spaced, plain = "DE89 3704 0044 0532 0130 00", "DE89370400440532013000"
    for text, want in (
        (f"{spaced} BIC COBADEFFXXX", [spaced]),
        (f"{plain} EUR 50", [plain]),
        (f"to {spaced} I paid", [spaced]),
        (f"AB12 {spaced} GB82 WEST 1234 5698 7654 32 OK", [spaced, "GB82 WEST 1234 5698 7654 32"]),
        (f"NO93 8601 1117 947 NOK 5, {plain}x", ["NO93 8601 1117 947"]),
    ):
        assert [s for kind, _, _, s, _ in pii.spans(text) if kind == "iban"] == want


# 10


def lm_by_hand(rows, target):
    """Losses of both models by plain counting; ``rows`` are (doc_id, text)."""
    seqs = [[None, *low(t or "").encode().split(), None] for _, t in rows]
    vocab, out = {w for s in seqs if len(s) > 2 for w in s}, []
    for own in ([s for (i, _), s in zip(rows, seqs) if i in target], seqs):
        pairs = [p for s in own if len(s) > 2 for p in itertools.pairwise(s)]
        both, first, word = Counter(pairs), Counter(a for a, _ in pairs), Counter(b for _, b in pairs)
        weight = math.sqrt(len(pairs) + 1)
        p = lambda a, b: (both[a, b] + weight * (word[b] + 1) / (len(pairs) + len(vocab))) / (first[a] + weight)  # noqa: E731, B023
        assert not vocab or all(abs(sum(p(a, b) for b in vocab) - 1) < 1e-9 for a in [None, *sorted(vocab - {None})[:5]])
        out.append([sum(-math.log(p(a, b)) for a, b in itertools.pairwise(s)) / (len(s) - 1) if len(s) > 2 else 0.0 for s in seqs])
    return [(i, len(s) - 2, near, far, near - far) for (i, _), s, near, far in zip(rows, seqs, *out)]


@pytest.mark.parametrize(("tokens", "groups", "most_ids"), [(2_000_000, 64, 2_000_000), (300, 5, 0)])
def test_lm_score(spark, monkeypatch, tokens, groups, most_ids):
    """All rows against plain counting, in one block and in many, with ids broadcast and joined."""
    monkeypatch.setattr(lm_score, "TOKENS", tokens)
    monkeypatch.setattr(lm_score, "LEAST_GROUPS", groups)
    monkeypatch.setattr(shared, "MOST_IDS", most_ids)
    rng = random.Random(11)
    common, topics = [f"c{k}" for k in range(970)], [[f"{t}{k:03}ing" for k in range(150)] for t in ("al", "be")]
    rows = [(i, " ".join(rng.choices(common, k=40))) for i in range(100)]
    rows += [(1000 + i, " ".join(w for _ in range(15) for w in (*rng.choices(topics[i % 2], k=2), rng.choice(common)))) for i in range(60)]
    rows += [(1000, rows[100][1]), (2000, "x" * 100 + " al000ing"), (2001, None), (2002, " \n"), (None, "no id É é"), ((1 << 60) + 1, "X" * 100 + " C1 c1"), (3, "other text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    good = {i for i, _ in rows if i and 1000 <= i < 1040 and i % 2 == 0} | {2001}
    target = spark.createDataFrame([(i,) for i in [*good, 1000, None, 77777]], "doc_id long")
    got = sorted((tuple(r) for r in lm_score.score(docs, target).collect()), key=repr)
    want = sorted(lm_by_hand(rows, good), key=repr)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert np.allclose([r[2:] for r in got], [r[2:] for r in want], atol=1e-9)
    held = {r[0]: r[4] for r in got if r[0] and 1040 <= r[0] < 1060}
    assert max(s for i, s in held.items() if i % 2 == 0) < min(s for i, s in held.items() if i % 2)


def test_lm_score_without_target(spark):
    got = lm_score.score(docs_of(spark, ["a b a", None]), spark.createDataFrame([], "doc_id long")).orderBy("doc_id").collect()
    assert got[0]["target_loss"] == pytest.approx(math.log(3)) and got[1]["score"] == 0.0


def test_lm_score_tells_held_out_quality(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    got = lm_score.score(docs, labels.where(~held & (F.col("quality") == 1)).select("doc_id")).join(labels.where(held), "doc_id").toPandas()
    rank, good = (-got["score"]).rank(), got["quality"] == 1
    n, m = int(good.sum()), int((~good).sum())
    assert (rank[good].sum() - n * (n + 1) / 2) / (n * m) > 0.95


def test_top_k_sends_blocks_where_bounds_reach(spark, monkeypatch):
    """In a table whose vectors lie in clusters of consecutive ids, a block goes to few groups of queries."""
    for name, n in (("BLOCK_BYTES", 2000), ("GROUP_BYTES", 600), ("SHARD_BYTES", 1 << 20), ("OUTLINE_BYTES", 4000)):
        monkeypatch.setattr(topk, name, n)
    rng = np.random.default_rng(9)
    known = [(i, (np.eye(8, dtype=int)[i // 100 % 8] * 60 + rng.integers(-3, 4, 8)).tolist()) for i in range(1600)]
    sent, write = [], shared.Scratch.write

    def counted(self, df, name):
        out = write(self, df, name)
        sent.extend([out.count()] if name == "wanted" else [])
        return out

    monkeypatch.setattr(topk.Scratch, "write", counted)
    vectors = spark.createDataFrame([(i, [x / 64 for x in v]) for i, v in known], "vec_id long, embedding array<float>")
    got = topk.top_k(vectors, k=5).orderBy("query_id", "rank").collect()
    assert {q: [(r["vec_id"], r["score"]) for r in g] for q, g in itertools.groupby(got, key=lambda r: r["query_id"])} == top_k_by_hand(known, 5)
    groups, blocks = -(-80 * 72 // 600), 1600 * 72 // 2000
    assert sent[0] < groups * blocks / 2


def runs_by_hand(words, threshold=0.8):
    """Labels of templates of which some run of words holds enough, and all names."""
    out = set()
    for text, label in licenses.TEMPLATES.items():
        t, span = set(text.split()), licenses.SPREAD * len(text.split())
        names = licenses.NAMES.get(label, set()) & t
        runs = (t.intersection(words[k : k + span]) for k in range(len(words)))
        out |= {label for r in runs if len(r) >= math.ceil(threshold * len(t) - 1e-9) and names <= r}
    return out


def test_license_runs_by_hand_and_in_long_texts(spark):
    """Random orders of each template's words, some left out, in one line; and a long text of nothing else, in time by its length."""
    import time

    rng = random.Random(6)
    every, texts = sorted({w for t in licenses.TEMPLATES for w in t.split()}), []
    for _ in range(40):
        own = rng.choice(list(licenses.TEMPLATES)).split()
        near = [w for w in own if rng.random() < 0.9] + rng.choices(every, k=rng.randrange(len(own)))
        rng.shuffle(near)
        texts.append("x " * 80 + " ".join(near) + " y" * 80)
    got = {r["doc_id"]: r["labels"] for r in licenses.scan(docs_of(spark, texts)).collect()}
    assert {k: set(filter(None, x.split(","))) - set(licenses.PHRASES.values()) for k, x in got.items()} == {k: runs_by_hand(t.split()) - set(licenses.PHRASES.values()) for k, t in enumerate(texts)}
    assert 5 < sum(map(bool, got.values())) < 40
    took = []
    for n in (100_000, 400_000):
        long = docs_of(spark, [" ".join(rng.choices(every, k=n))])
        start = time.perf_counter()
        assert licenses.scan(long).count() == 1
        took.append(time.perf_counter() - start)
    assert took[1] < 10 * took[0]
