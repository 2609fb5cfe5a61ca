"""The corpus pipeline, stage by stage, against brute force."""

import os
import random
import re
import zlib
from concurrent.futures import ThreadPoolExecutor

import pytest

import corpus_pipeline
from test_ops import DOCS, components_by_hand, near_texts
from tidemark.llm.shared import Scratch

SPACES = re.compile(r"[\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def steps(spark):
    texts = near_texts(11, groups=5, size=8) | {20_000 + k: t for k, t in enumerate([None, "", "12 34", "le la les des une pour dans que " * 9, "same  text here", "same text here"])}
    rows = [(i, t, "fr" if i == 20_003 else "en", f"s{i % 3}" if i % 7 else None, len(t or "")) for i, t in texts.items()]
    docs, out = spark.createDataFrame(rows, DOCS), []
    scratch = Scratch(spark, "test")
    docs = scratch.write(docs, "documents")
    out.append(docs.toPandas())
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.write(stage(spark, docs, ""), name)
        out.append(docs.toPandas())
    return out


def test_columns(steps):
    for frame in steps[:-1]:
        assert frame.columns.tolist() == ["doc_id", "text", "lang", "source", "n_chars"]


def test_language_drops_only_what_has_none(steps):
    raw, kept = steps[0], steps[1]
    letters = raw[raw["text"].fillna("").map(lambda t: any(c.isalpha() for c in t))]
    assert sorted(kept["doc_id"]) == sorted(letters["doc_id"])


def test_exact(steps):
    before, kept = steps[1], steps[2]
    first = before.assign(t=before["text"].map(lambda t: SPACES.sub(" ", t))).groupby("t")["doc_id"].min()
    assert sorted(kept["doc_id"]) == sorted(first)


def test_near(steps):
    before, kept = steps[2], steps[3]
    expected = components_by_hand(dict(zip(before["doc_id"], before["text"])), 5)
    assert sorted(kept["doc_id"]) == sorted(i for i, (_, c) in expected.items() if i == c)
    assert len(kept) < len(before)


def test_mix(steps):
    before, mixed = steps[3], steps[4]
    assert set(mixed["doc_id"]) <= set(before["doc_id"]) and mixed["doc_id"].value_counts().max() <= 2
    words = lambda f: f["text"].map(lambda t: len(t.split())).sum()
    longest = before["text"].map(lambda t: len(t.split())).max()
    assert abs(words(mixed) - 1.5 * words(before)) <= 4 * longest


def test_pack(steps):
    from tokenizers import Tokenizer

    from tidemark.llm.registry import tokenizer_path

    mixed, packed = steps[4], steps[5]
    hf = Tokenizer.from_file(tokenizer_path())
    sizes = {}
    for i, t in zip(mixed["doc_id"], mixed["text"]):
        ids = hf.encode(t, add_special_tokens=False).ids + [1]
        sizes[i] = (len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids)))
    assert sorted(packed["doc_id"]) == sorted(mixed["doc_id"])
    assert all(sizes[r.doc_id] == (r.length, r.ids_crc32) for r in packed.itertuples())
    for _, g in packed.sort_values("offset").groupby("sequence_id"):
        assert g["offset"].tolist() == [0, *g["length"].cumsum().tolist()[:-1]] and g["length"].sum() <= 4096


def test_no_text_is_lost(spark):
    """With ids that repeat or are null, every distinct text is left once by the stages of duplicates."""
    rng, words = random.Random(15), [f"word{k}" for k in range(500)]
    texts = [" ".join(rng.choices(words, k=40)) for _ in range(30)]
    rows = [(rng.choice([None, 1, 2, 3, 40 + k]), t, "en", "s", 1) for t in texts for k in range(rng.randint(1, 4))]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    for stage in (corpus_pipeline.exact_duplicates, corpus_pipeline.near_duplicates):
        kept = [(r["doc_id"], r["text"]) for r in stage(spark, docs, "").collect()]
        assert sorted(t for _, t in kept) == sorted(texts)
        least = {t: min((i for i, x, *_ in rows if x == t and i is not None), default=None) for t in texts}
        assert all(i == least[t] for i, t in kept)


def test_run(spark):
    from conftest import SF

    from tidemark.llm.shared import sweeping

    with sweeping(spark) as made:
        out = corpus_pipeline.run(spark, SF)
        assert len(made) == 2  # its own tables, and those of the last stage
        assert out.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(out.columns)
        assert all(map(os.path.isdir, made))
    assert not any(map(os.path.exists, made))


def test_sweeping_leaves_what_others_made(spark):
    """Tables of another thread, of a caller and of calls outside stay; an error frees its own."""
    from tidemark.llm.shared import Scratch, sweeping

    def make():
        scratch = Scratch(spark, "kept")
        scratch.write(spark.range(3), "t")
        return scratch.root

    outside = make()
    with sweeping(spark) as mine:
        own = make()
        with pytest.raises(KeyError), sweeping(spark):
            inner = make()
            with ThreadPoolExecutor(1) as pool:
                other = pool.submit(make).result()
            raise KeyError
        assert mine == [own] and not os.path.exists(inner) and all(map(os.path.isdir, (own, other, outside)))
    assert not os.path.exists(own) and all(map(os.path.isdir, (other, outside)))


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_odd_tables(spark, k):
    from pyspark.sql import functions as F

    stage = corpus_pipeline.STAGES[k][1]
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "One two three. " * 400, "en", "s", 1), (3, "One two three. " * 400, "en", "s", 1), (None, "No id here", "en", None, 3)]
    odd = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(1) for c in ("skey", "upto", "epochs", "kept", "node", "component", "n", "key", "target", "piece", "bucket")})
    out = stage(spark, odd, "")
    if k < len(corpus_pipeline.STAGES) - 1:
        assert out.columns == odd.columns
        assert 3 in {r["doc_id"] for r in out.collect()}
    else:
        assert out.count() == 5
    assert stage(spark, odd.limit(0), "").count() == 0
