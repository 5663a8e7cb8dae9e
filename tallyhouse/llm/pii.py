"""Personal data by weak supervision.

Candidates are spans that look like personal data: whatever the base rules match, and looser forms of
the same kinds.  Labelers of three sorts vote on each candidate, yes, no or nothing: patterns (a strict
form), gazetteers (known endings, prefixes and area codes) and context (words before the span).
Expectation-maximisation over all candidates of the corpus estimates how often each labeler is right,
and from it how likely each candidate is personal data.  A logistic classifier of the span itself
(kind, length, digits, separators, and the votes) is trained on these likelihoods; candidates that it
accepts with at least ``ACCEPT`` and for which some labeler speaks are added to the base spans.  Base spans always stay.

Votes and features are small codes, so a candidate is one of a bounded number of patterns.  Both the
estimation and the training see the number of candidates of each pattern, counted by Spark over the
whole corpus; no candidate goes to the driver.

Spans are in code points, end exclusive.  Defined results: null is an empty text; every input row gives
one row; an empty table, or one without candidates, trains nothing and adds nothing.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyhouse.session import materialize

KINDS = ("email", "ip", "card", "phone")
# The base patterns, in their order.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# How they are searched for: a match begins where a run of its first characters does, so no position inside a
# run is tried; and for addresses the search goes out from the mark in their middle.
_BACKWARDS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_MARK, _DOMAIN = re.compile("@"), re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
SEARCHED = {"ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", "card": CARD, "phone": PHONE}
# Looser forms, whose matches are candidates only.  An address has its name, perhaps a space, the mark, and this.
_LOOSE_MARK = re.compile(r"\[at\]|\(at\)|\x20at\x20")
_LOOSE_DOMAIN = re.compile(r"\x20?[A-Za-z0-9-]++(?:\x20?(?:\[dot\]|\(dot\)|\x20dot\x20|\.)\x20?[A-Za-z0-9-]++)++")
LOOSE = {
    "card": r"[0-9]{4}([\x20./-]+[0-9]{2,6}){2,4}",
    "phone": r"(?:\(0?[0-9]{2,4}\)|00[0-9]{1,3}|0?[0-9]{2,4})[\x20./-]+[0-9]{2,4}[\x20./-]+[0-9]{2,6}(?:[\x20./-]+[0-9]{2,6})*",
}
ENDINGS = frozenset("com org net edu gov int info biz io co uk de fr es it nl eu us ca au ch at be pl".split())
COUNTRY_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 55 61 62 64 65 81 82 86 90 91".split())
YES = {
    "email": frozenset("mail email e-mail contact contacto kontakt write courriel correo".split()),
    "ip": frozenset("ip host server address adresse from login".split()),
    "card": frozenset("card visa mastercard credit karte carte tarjeta pan".split()),
    "phone": frozenset("phone call tel telefon mobile fax téléphone teléfono whatsapp".split()),
}
NO = frozenset("version v isbn issn id order no nr page pages section chapter art year serial build".split())
LABELERS = ("strict", "checksum", "gazetteer", "context", "counter")
ACCEPT, BEFORE = 0.9, 40
MAX_PATTERNS = 200_000  # bound of the pattern table: kinds x votes x features


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _holds(kind: str, s: str) -> bool:
    """Whether a match of the base pattern passes."""
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in s.split("."))
    if kind == "card":
        d = _digits(s)
        return 13 <= len(d) <= 19 and luhn(d)
    if kind == "phone":
        return 9 <= len(_digits(s)) <= 15
    return True


def addresses(text: str, mark: re.Pattern, domain: re.Pattern, space: bool) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from their marks; linear in the length of the text."""
    out, last = [], 0
    for m in mark.finditer(text):
        if m.start() < last:
            continue
        found = domain.match(text, m.end())
        if not found:
            continue
        end = m.start()
        if space and end > last and text[end - 1] == " ":
            end -= 1
        start = end
        while start > last and text[start - 1] in _BACKWARDS:
            start -= 1
        if start < end:
            out.append((start, found.end()))
            last = found.end()
    return out


def base_spans(text: str, compiled) -> list[tuple[int, int, int]]:
    out = []
    has_digit = re.search("[0-9]", text) is not None
    if "@" in text:
        out += [(0, *x) for x in addresses(text, _MARK, _DOMAIN, False)]
    for k, kind in enumerate(KINDS[1:], 1):
        if ("+" in text and has_digit) if kind == "phone" else has_digit:
            out += [(k, m.start(), m.end()) for m in compiled[kind].finditer(text) if _holds(kind, m.group())]
    return out


def votes(kind: str, text: str, start: int, end: int, base: bool) -> tuple[int, ...]:
    """1 yes, 0 no, 2 nothing, for each labeler."""
    s, d = text[start:end], _digits(text[start:end])
    before = re.findall(r"[^\W\d_][\w-]*", text[max(0, start - BEFORE) : start].lower())[-4:]
    checksum = 2
    if kind == "card":
        checksum = int(13 <= len(d) <= 19 and luhn(d))
    elif kind == "phone":
        # a length that every number has speaks against those without it, not for the others
        checksum = 2 if 9 <= len(d) <= 15 else 0
    elif kind == "ip":
        checksum = 2 if _holds("ip", s) else 0
    gazetteer = 2
    if kind == "email":
        gazetteer = int(re.split(r"[^A-Za-z]+", s)[-1].lower() in ENDINGS)
    elif kind == "card":
        gazetteer = int(d[:1] in "3456")
    elif kind == "phone":
        lead = d.lstrip("0")
        gazetteer = 1 if s[:1] in "+(" and any(lead[:n] in COUNTRY_CODES for n in (1, 2)) else 2
    context = 1 if any(w in YES[kind] for w in before) else 2
    counter = 0 if any(w in NO for w in before) or text[end : end + 1] in ("%", "€", "$") else 2
    return 1 if base else 2, checksum, gazetteer, context, counter


def features(kind: str, s: str) -> int:
    """A small code of the span's form: length, digits, separators, in steps."""
    d = len(_digits(s))
    seps = sum(not c.isalnum() for c in s)
    return (min(d, 19) // 3) * 64 + min(seps, 7) * 8 + min(len(s) // 4, 7)


_CAND = "array<struct<kind:int,start:int,end:int,votes:int,form:int,base:boolean>>"


def _candidate_pass(batches):
    compiled = {k: re.compile(p) for k, p in SEARCHED.items()}
    loose = {KINDS.index(k): re.compile(p) for k, p in LOOSE.items()}
    item = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("votes", pa.int32()), ("form", pa.int32()), ("base", pa.bool_())])
    for batch in batches:
        out = []
        for text in batch.column(1).fill_null("").to_pylist():
            base = base_spans(text, compiled)
            found = [(k, s, e, True) for k, s, e in base]
            taken = sorted((s, e) for _, s, e in base)
            starts = [s for s, _ in taken]
            reach = list(accumulate((e for _, e in taken), max))  # how far the spans up to each one reach
            more = [(0, *x) for x in addresses(text, _LOOSE_MARK, _LOOSE_DOMAIN, True)] if "at" in text else []
            if re.search("[0-9]", text):
                more += [(k, *m.span()) for k, pattern in loose.items() for m in pattern.finditer(text)]
            for k, s, e in more:
                at = bisect_left(starts, e)
                if not at or reach[at - 1] <= s:
                    found.append((k, s, e, False))
            row = []
            for k, s, e, is_base in found:
                code = 0
                for v in votes(KINDS[k], text, s, e, is_base):
                    code = code * 3 + v
                row.append({"kind": k, "start": s, "end": e, "votes": code, "form": features(KINDS[k], text[s:e]), "base": is_base})
            out.append(row)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(item))], ["doc_id", "found"])


def vote_matrix(codes: np.ndarray) -> np.ndarray:
    return np.stack([codes // 3**k % 3 for k in range(len(LABELERS) - 1, -1, -1)], axis=1)


def estimate(v: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Likelihood of each pattern and reliability (when true, when false) of each labeler."""
    said_yes, said = (v == 1), (v != 2)
    p = (said_yes.sum(1) + 1.0) / (said.sum(1) + 2.0)
    right = np.full((v.shape[1], 2), 0.8)
    for _ in range(rounds):
        w1, w0 = weight * p, weight * (1 - p)
        # a labeler starts as fairly reliable and must earn more (two made-up votes for, half a one against)
        right[:, 0] = (w1 @ said_yes + 2.0) / (w1 @ said + 2.5)
        right[:, 1] = (w0 @ (said & ~said_yes) + 2.0) / (w0 @ said + 2.5)
        prior = (w1.sum() + 1) / (weight.sum() + 2)
        yes = np.where(said_yes, right[:, 0], 1 - right[:, 0])
        no = np.where(said_yes, 1 - right[:, 1], right[:, 1])
        logit = np.log(prior / (1 - prior)) + np.where(said, np.log(yes / no), 0).sum(1)
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return p, right


def design(kind: np.ndarray, v: np.ndarray, form: np.ndarray) -> np.ndarray:
    digits, seps, length = form // 64, form // 8 % 8, form % 8
    parts = [np.ones((len(kind), 1)), *[(kind == k)[:, None] for k in range(len(KINDS))]]
    for k in range(v.shape[1]):
        parts += [(v[:, k] == 1)[:, None], (v[:, k] == 0)[:, None]]
    parts += [(kind == k)[:, None] * (digits == d)[:, None] for k in range(len(KINDS)) for d in range(7)]
    parts += [(seps == s)[:, None] for s in range(8)] + [(length == s)[:, None] for s in range(8)]
    return np.concatenate([np.asarray(p, float) for p in parts], axis=1)


def fit(x: np.ndarray, p: np.ndarray, weight: np.ndarray, rounds: int = 30, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps."""
    b = np.zeros(x.shape[1])
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (weight * q * (1 - q) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(b))
        step = np.linalg.solve(h, x.T @ (weight * (p - q)) - ridge * b)
        b += step
        if np.abs(step).max() < 1e-6:
            break
    return b


def train(counts: list) -> dict[tuple[int, int, int], float]:
    """Probability of each pattern ``(kind, votes, form)`` from ``(kind, votes, form, n)``."""
    if not counts:
        return {}
    c = np.array(counts, np.int64)
    kind, codes, form, n = c.T
    v = vote_matrix(codes)
    soft = np.zeros(len(c))
    for k in range(len(KINDS)):
        of = kind == k
        if of.any():
            soft[of] = estimate(v[of], n[of].astype(float))[0]
    x = design(kind, v, form)
    weight = n / max(1.0, n.sum() / 10_000)
    q = 1 / (1 + np.exp(-np.clip(x @ fit(x, soft, weight), -30, 30)))
    return {tuple(int(a) for a in row[:3]): float(p) for row, p in zip(c, q, strict=True)}


def candidates(docs: DataFrame, text="text", doc_id="doc_id") -> DataFrame:
    base = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return base.mapInArrow(_candidate_pass, f"doc_id long, found {_CAND}")


def find_pii(docs: DataFrame, text="text", doc_id="doc_id", accept: float = ACCEPT) -> DataFrame:
    """``doc_id``, counts of the base kinds, digest of the base spans, and all spans."""
    found = materialize(candidates(docs, text, doc_id), "pii-candidates")
    patterns = (
        found.select(F.explode("found").alias("c")).groupBy("c.kind", "c.votes", "c.form").agg(F.count("*").alias("n")).orderBy("kind", "votes", "form").limit(MAX_PATTERNS + 1).collect()
    )
    if len(patterns) > MAX_PATTERNS:
        raise RuntimeError("more patterns than their codes allow")
    trained = train([tuple(r) for r in patterns])
    # a span that no labeler speaks for is not added, however common its kind is
    yes = {k for k, p in trained.items() if p >= accept and (vote_matrix(np.array([k[1]])) == 1).any()}
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"]

    def run(batches):
        for batch in batches:
            rows = []
            for row in batch.column(1).to_pylist():
                base = sorted((c["kind"], c["start"], c["end"]) for c in row if c["base"])
                every, last = list(base), -1
                for c in sorted((c for c in row if not c["base"]), key=lambda c: (c["start"], -c["end"], c["kind"])):
                    if (c["kind"], c["votes"], c["form"]) in yes and c["start"] >= last:
                        every.append((c["kind"], c["start"], c["end"]))
                        last = c["end"]
                said = lambda of: ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(of))
                rows.append((*[sum(b[0] == k for b in base) for k in range(len(KINDS))], hashlib.sha256(said(base).encode()).hexdigest(), said(every)))
            if rows:
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in columns[:4]], *[pa.array(c, pa.string()) for c in columns[4:]]], names)

    return found.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def op4(spark, docs: DataFrame) -> DataFrame:
    return find_pii(docs)
