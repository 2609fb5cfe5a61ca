"""Language identification as a mixture of languages, by expectation-maximisation.

Training counts byte n-grams (n of 2 to 4, words padded by a space) of every training text by
language, in tasks, and sums them by key. N-grams are told apart by their bytes, never hashed.
The model knows those that make up at least ``least_share`` of some language's n-grams, so at
most 1 / ``least_share`` for each language, however large the corpus; all others are one event,
whose likelihood is what each language spends on them. The driver only puts the languages' rows
side by side, languages x n-grams x 4 bytes, and broadcasts them: over ``MOST_LANGUAGES`` or
``MODEL_BYTES`` raise an error.

A document's n-grams are a mixture: EM estimates the proportions of languages, until none
moves by more than ``TOLERANCE``. The set of languages is chosen by penalised likelihood:
twice the log-likelihood, less log(n-grams) times ``penalty`` for each language. From the best
single language, the best of all single changes (one language more, one less, or one for another) is
made as long as one helps; changes that a bound rules out are not tried. The prediction is
the language with the largest proportion, and the score that proportion; the first by name of
equal ones.

A null text, or one without a letter, is ``und`` with score 0, as is any if nothing was learnt.
Rows are judged one by one, whatever their ids: repeated rows each count in training and get
the same result, and rows with a null doc_id are not held out.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from tidemark.llm.shared import Scratch

MOST_LANGUAGES = 512
MODEL_BYTES = 256 << 20
PENDING = 1 << 21  # n-grams that a task holds before it sums them
PLAIN_LETTER = re.compile("[A-Za-z]")
# Lower-case letters and bytes beyond ASCII stay; all else is a space.
FOLD = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
SIZES = (2, 3, 4)
SEGMENT = 1 << 20
TOLERANCE = 1e-5


def has_letter(text: str) -> bool:
    return bool(PLAIN_LETTER.search(text)) or any(map(str.isalpha, text))


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams, in order, and the sums of their counts."""
    if len(parts) == 1:
        return parts[0]
    known, which = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    sums = np.zeros(len(known), dtype=np.int64)
    np.add.at(sums, which, np.concatenate([n for _, n in parts]))
    return known, sums


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The text's n-grams, each as the number that its bytes make, in order, and how often each
    occurs. No byte is 0, so lengths don't clash. Long texts are counted in segments of starts,
    each with the bytes that its last n-grams reach."""
    folded = b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(FOLD).split())
    padded = np.frombuffer(b" " + folded + b" ", dtype=np.uint8)
    parts = []
    for at in range(0, len(padded), SEGMENT):
        x = padded[at : at + SEGMENT + max(SIZES) - 1].astype(np.uint32)
        g, found = x, []
        for n in range(2, max(SIZES) + 1):
            g = g[:-1] << np.uint32(8) | x[n - 1 :]
            if n in SIZES:
                found.append(g[:SEGMENT])
        parts.append(np.unique(np.concatenate(found), return_counts=True))
    return summed(parts)


def labelled(docs: DataFrame) -> DataFrame:
    """The rows to learn from: text and non-null lang, where crc32(doc_id) mod 4 is not 2."""
    return docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select("text", "lang")


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def gram_counts(rows: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows; each task sums its own first, as far as memory allows."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: dict[str, list] = defaultdict(list)
        held = 0
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"], strict=True):
                parts[lang].append(grams(text))
                held += len(parts[lang][-1][0])
                if held > PENDING:
                    parts = defaultdict(list, {lang: [summed(own)] for lang, own in parts.items()})
                    held = sum(len(own[0][0]) for own in parts.values())
                if held > PENDING // 2 and all(len(own) == 1 for own in parts.values()):
                    yield from given(parts)
                    parts.clear()
                    held = 0
        yield from given(parts)

    def given(parts: dict[str, list]) -> Iterator[pd.DataFrame]:
        for lang, own in parts.items():
            found, n = summed(own)
            yield pd.DataFrame({"lang": lang, "gram": found.astype(np.int64), "n": n})

    made = rows.mapInPandas(count, "lang string, gram long, n long")
    return made.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Model:
    """Languages in order of name, known n-grams in order, and log-likelihoods
    [n-gram, language], the last row being that of all other n-grams."""

    def __init__(self, langs: list[str], known: np.ndarray, logs: np.ndarray):
        self.langs, self.known, self.logs = langs, known, logs

    def parts(self) -> tuple[list[str], np.ndarray, np.ndarray]:
        return self.langs, self.known, self.logs


def train(docs: DataFrame, smoothing: float = 0.5, least_share: float = 2e-5) -> Model:
    def side_by_side(sums: pd.DataFrame) -> pd.DataFrame:
        own = sums.sort_values("gram")
        return pd.DataFrame([(own["lang"].iloc[0], own["gram"].to_numpy(np.uint32).tobytes(), own["n"].to_numpy(np.int64).tobytes())], columns=["lang", "grams", "counts"])

    scratch = Scratch(docs.sparkSession, "langid")
    counts = scratch.write(gram_counts(labelled(docs)), "counts")
    totals = scratch.write(counts.groupBy("lang").agg(F.sum("n").alias("total")), "totals")
    if totals.count() > MOST_LANGUAGES:
        raise ValueError(f"there are more than {MOST_LANGUAGES} languages")
    total = dict(sorted((r["lang"], r["total"]) for r in totals.collect()))
    known = counts.join(F.broadcast(totals), "lang").where(F.col("n") >= F.col("total") * least_share).select("gram").distinct()
    known = scratch.write(known, "known")
    if known.count() * len(total) * 4 > MODEL_BYTES:
        raise ValueError(f"the model has more than {MODEL_BYTES} bytes: raise least_share")
    made = counts.join(known, "gram", "left_semi").groupBy("lang").applyInPandas(side_by_side, "lang string, grams binary, counts binary")
    rows = {r["lang"]: (np.frombuffer(r["grams"], np.uint32), np.frombuffer(r["counts"], np.int64)) for r in made.collect()}  # 12 bytes an entry of the model
    grams_ = np.unique(np.concatenate([g for g, _ in rows.values()])) if rows else np.zeros(0, np.uint32)
    logs = np.empty((len(grams_) + 1, len(total)), dtype=np.float32)
    for k, (lang, all_) in enumerate(total.items()):
        n = np.full(len(grams_) + 1, smoothing)
        found, own = rows.get(lang, (grams_[:0], np.zeros(0)))
        n[np.searchsorted(grams_, found)] += own
        n[-1] += all_ - own.sum()
        logs[:, k] = np.log(n / n.sum())
    return Model(list(total), grams_, logs)


def likelihoods(text: str, known: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihoods [event, language] and counts of a text's n-grams; those unknown are one event."""
    found, counts = grams(text)
    at = np.searchsorted(known, found)
    hit = np.zeros(len(found), dtype=bool)
    inside = at < len(known)
    hit[inside] = known[at[inside]] == found[inside]
    missed = counts.sum() - counts[hit].sum()
    if missed:
        return logs[np.append(at[hit], len(known))], np.append(counts[hit], missed)
    return logs[at], counts


def mixture(logs: np.ndarray, counts: np.ndarray, langs: list[int]) -> tuple[float, np.ndarray]:
    """Log-likelihood and proportions of ``langs`` for n-grams with likelihoods ``logs``."""
    own = logs[:, langs]
    top = own.max(axis=1, keepdims=True)
    p = np.exp(own - top)
    share, total, moved = np.full(len(langs), 1 / len(langs)), counts.sum(), len(langs) > 1
    while moved:
        r = p * share
        new = ((counts / r.sum(axis=1)) @ r) / total
        share, moved = new, np.abs(new - share).max() > TOLERANCE
    return float(counts @ (np.log(p @ share) + top[:, 0])), share


def most_gains(odds: np.ndarray, counts: np.ndarray, chosen: list[int], share: np.ndarray, steps: tuple[float, ...] = (0.0, 0.02)) -> np.ndarray:
    """For each language, an upper bound of what it can add to the log-likelihood of the mixture
    of ``chosen``, all shares being free again; ``odds`` are likelihoods up to a factor of each n-gram.

    From any mixture m, and so from one with a ``step`` of the new language, the best one gains at most
    n log(max over its languages k of the mean of p_k / m), as the logarithm is concave."""
    total = counts.sum()
    mixed = odds[:, chosen] @ share
    ratio = odds / mixed[:, None]
    out = np.full(odds.shape[1], np.inf)
    out[chosen] = 0.0
    for step in steps:
        for k in np.flatnonzero(out > 0):
            new = 1 - step + step * ratio[:, k]
            weight = counts / new
            most = max(float(weight @ ratio[:, k]), float((weight @ ratio[:, chosen]).max())) / total
            out[k] = min(out[k], float(counts @ np.log(new)) + total * max(0.0, float(np.log(most))))
    return out


def proportions(logs: np.ndarray, counts: np.ndarray, penalty: float) -> tuple[list[int], np.ndarray]:
    """The chosen languages and their proportions: no single change of the set has a higher
    penalised likelihood."""
    logs, counts = logs.astype(np.float64), counts.astype(np.float64)
    odds = np.exp(logs - logs.max(axis=1, keepdims=True))
    cost = penalty * np.log(counts.sum() + 1)
    tried: dict[tuple[int, ...], tuple[float, np.ndarray]] = {}

    def value(langs: tuple[int, ...]) -> float:
        if langs not in tried:
            tried[langs] = mixture(logs, counts, list(langs))
        return 2 * tried[langs][0] - cost * len(langs)

    chosen = (int((counts @ logs).argmax()),)
    while True:
        base = value(chosen)
        most = most_gains(odds, counts, list(chosen), tried[chosen][1])
        sets = [(*chosen, k) for k in np.flatnonzero(2 * most > cost).tolist()]
        if len(chosen) > 1:
            fewer = [tuple(x for x in chosen if x != k) for k in chosen]
            sets += fewer + [(*some, k) for some in fewer for k in np.flatnonzero(most > 0).tolist() if k not in chosen]
        found = max((tuple(sorted(x)) for x in sets), key=value, default=chosen)
        if value(found) <= base:
            return list(chosen), tried[chosen][1]
        chosen = found


def judge(text: str | None, langs: list[str], known: np.ndarray, logs: np.ndarray, penalty: float) -> tuple[str, float, str]:
    """Predicted language, its share, and all shares (name:share, largest first)."""
    if not langs or text is None or not has_letter(text):
        return "und", 0.0, ""
    chosen, share = proportions(*likelihoods(text, known, logs), penalty)
    ranked = sorted(zip(share.tolist(), [langs[k] for k in chosen], strict=True), key=lambda x: (-x[0], x[1]))
    return ranked[0][1], min(1.0, ranked[0][0]), ",".join(f"{lang}:{s:.4f}" for s, lang in ranked)


def identify(docs: DataFrame, model: Model, penalty: float = 4.0) -> DataFrame:
    """doc_id, held_out, lang_pred, score and languages of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model.parts())

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [judge(t, *shared.value, penalty) for t in batch["text"]]
            yield batch.drop(columns="text").assign(**{c: [x[k] for x in found] for k, c in enumerate(("lang_pred", "score", "languages"))})

    rows = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    out = rows.mapInPandas(predict, "doc_id string, held_out boolean, lang_pred string, score double, languages string")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))  # as strings, ids beside nulls stay exact


def accepted(docs: DataFrame, model: Model, least_share: float = 0.3, penalty: float = 4.0) -> DataFrame:
    """Rows of ``docs``, all columns, whose main language has at least ``least_share``; never ``und``."""
    shared = docs.sparkSession.sparkContext.broadcast(model.parts())

    def keep(texts: pd.Series) -> pd.Series:
        found = (judge(t, *shared.value, penalty) for t in texts)
        return pd.Series([lang != "und" and share >= least_share for lang, share, _ in found], dtype=bool)

    return docs.where(F.pandas_udf(keep, BooleanType())(F.col("text").cast("string")))
