"""Personal data in texts: patterns propose, checksums confirm, context words adjust the score.

Kinds with a contract (``BASE``): email, ip, card (Luhn), phone. Kinds of the method's own
(``MORE``): iban (mod-97) and ssn, which count only with a score of ``least`` or more.
Each span has its kind, start and end in code points (end exclusive), text and score.
Null text counts as empty. Spans are in order of start, then of kind as listed; kinds may
overlap. Rows are scanned one by one: those that repeat a doc_id, or have none, each get a
result. One pass, without a shuffle; every pattern takes time in proportion to the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=((?:[ ]?[A-Z0-9]){11,30}))")
MORE_WORD = re.compile("[A-Za-z0-9]")
# Lengths of each country's IBAN.
LENGTHS = {
    own: int(n)
    for n, countries in (x.split(":") for x in (
        "15:NO 16:BE 18:DK,FI,FO,GL,NL 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,XK 21:CH,HR,LI,LV 22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA "
        "23:AE,GI,IL,IQ,TL 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:PT,ST 26:IS,TR 27:FR,GR,IT,MC,MR,SM 28:AL,AZ,BY,CY,DO,GT,HU,LB,PL,SV "
        "29:BR,EG,PS,QA,UA 30:JO,KW,MU 31:MT,SC 32:LC"
    ).split())
    for own in countries.split(",")
}
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
DIGIT = re.compile("[0-9]")
BASE = ("email", "ip", "card", "phone")
MORE = ("iban", "ssn")
# The prior of each kind and the words nearby that raise it.
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.4}
CONTEXT = {
    "email": {"email", "mail", "contact", "write"},
    "ip": {"ip", "address", "host", "server"},
    "card": {"card", "credit", "visa", "payment"},
    "phone": {"phone", "call", "tel", "mobile"},
    "iban": {"iban", "account", "bank"},
    "ssn": {"ssn", "social", "security"},
}
NEAR = 40
SPAN = "array<struct<kind:string,start:int,end:int,text:string,score:double>>"


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def mod97(code: str) -> bool:
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches that don't overlap, each found from its at sign."""
    free, at = 0, text.find("@")
    while at >= 0:
        if at >= free:
            part = text[free:at]
            start = at - (len(part) - len(part.rstrip(LOCAL)))
            m = DOMAIN.match(text, at + 1) if start < at else None
            if m:
                yield start, m.end()
            free = m.end() if m else at + 1  # no address holds an at sign before its own
        at = text.find("@", at + 1)


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Codes of their country's length, or where that is unknown the longest that mod-97 confirms.

    They end with a word. After a start that fails, the next one is tried.
    """
    free = 0
    for m in IBAN.finditer(text):
        start = m.start()
        if start < free:
            continue
        for end in range(m.end(1), m.start(1), -1):
            if text[end - 1] == " " or MORE_WORD.match(text, end):
                continue
            code = text[start:end].replace(" ", "")
            if len(code) >= 15 and LENGTHS.get(code[:2], len(code)) == len(code) and mod97(code):
                yield start, end
                free = end
                break


def only_digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def proposals(text: str) -> Iterator[tuple[str, int, int]]:
    """Confirmed spans of every kind."""
    if "@" in text:
        for start, end in emails(text):
            yield "email", start, end
    if not DIGIT.search(text):
        return
    for m in IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0")[:3] or 0) <= 255 for x in m.group().split(".")):
            yield "ip", *m.span()
    for m in CARD.finditer(text):
        digits = only_digits(m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield "card", *m.span()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(only_digits(m.group())) <= 15:
                yield "phone", *m.span()
    for start, end in ibans(text):
        yield "iban", start, end
    for m in SSN.finditer(text):
        if m.group()[:3] not in ("000", "666") and m.group()[0] != "9":
            yield "ssn", *m.span()


def spans(text: str | None, least: float = 0.5) -> list[tuple[str, int, int, str, float]]:
    """All spans by start, then kind as listed."""
    text = text or ""
    out = []
    for kind, start, end in proposals(text):
        near = re.findall("[a-z]+", (text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]).lower())
        score = min(1.0, PRIOR[kind] + 0.2 * bool(CONTEXT[kind].intersection(near)))
        if kind in BASE or score >= least:
            out.append((kind, start, end, text[start:end], score))
    order = {k: i for i, k in enumerate((*BASE, *MORE))}
    return sorted(out, key=lambda s: (s[1], order[s[0]]))


def find_pii(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """doc_id and the array ``pii`` of spans of each row."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end", "text", "score"), s, strict=True)) for s in spans(t, least)] for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "pii": found})

    texts = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInPandas(scan, f"doc_id string, pii {SPAN}").withColumn("doc_id", F.col("doc_id").cast("long"))  # as strings, ids beside nulls stay exact


def of_kind(kind: str):
    return lambda s: s["kind"] == kind


def digest(found: DataFrame) -> DataFrame:
    """Counts by base kind, the hash of the base spans, all spans as text, and their scores."""
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id",
        *[F.size(F.filter("pii", of_kind(k))).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("pii")).alias("spans"),
        F.array_join(F.transform("pii", lambda s: F.format_number(s["score"], 2)), ",").alias("scores"),
    )
