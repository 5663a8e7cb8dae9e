"""Secret scan with a trigram index.

Each rule's pattern gives a Boolean query over the trigrams that a match must hold.  A block of texts
is indexed by those trigrams; postings are intersected and united as the queries say, and only the
texts that remain are searched with the pattern.  A rule without mandatory trigrams searches every
text.  Postings cover a block (an Arrow batch), so the index needs no shuffle and its size is bound
by the block.

Spans are in code points, end exclusive.  Defined results: null is an empty text; every input row gives
one row; an empty table gives none; rows and columns of any name pass through ``find_secrets`` callers
unchanged because only the id and the text are read.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.trigrams import Postings, trigram_query, trigrams_of


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int = 1  # characters of the group
    group: int = 0


# The base rules, in their order.  Letters of `assign` stand in either case.
BASE = [
    Rule(
        "assign",
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        8,
        2,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]+", 32),
]
# Further formats of keys that name themselves.
MORE = [
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("map_key", r"AIza[A-Za-z0-9_-]+", 39),
]
RULES = [*BASE, *MORE]


def scan_pass(rules: list[Rule], n_base: int):
    order = {r.kind: k for k, r in enumerate(rules)}
    queries = [trigram_query(r.pattern) for r in rules]
    wanted = set().union(*(trigrams_of(q) for q in queries))
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]

    def run(batches):
        # a scan for runs may skip those that are too short; the matches it keeps are the same
        compiled = [re.compile(r.pattern if r.kind != "hex" else r"[0-9a-f]{32,}") for r in rules]
        postings = Postings(wanted)
        for batch in batches:
            texts = batch.column(1).fill_null("").to_pylist()
            postings.index(batch.column(1))
            found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
            for k, rule in enumerate(rules):
                rows = postings.find(queries[k])
                for row in range(len(texts)) if rows is None else rows.tolist():
                    for m in compiled[k].finditer(texts[row]):
                        if m.end(rule.group) - m.start(rule.group) >= rule.least:
                            found[row].append((m.start(), k, m.end()))
            counts = [[0] * len(texts) for _ in range(n_base)]
            digests, spans = [], []
            for row, of in enumerate(found):
                of.sort()
                said = [(k, f"{rules[k].kind}:{s}:{e}") for s, k, e in of]
                for k, _ in said:
                    if k < n_base:
                        counts[k][row] += 1
                digests.append(hashlib.sha256(",".join(x for k, x in said if k < n_base).encode()).hexdigest())
                spans.append(",".join(x for _, x in said))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()), pa.array(spans, pa.string())], names)

    assert [order[r.kind] for r in rules] == list(range(len(rules)))
    return run


def find_secrets(docs: DataFrame, text="text", doc_id="doc_id") -> DataFrame:
    """``doc_id``, counts of the base kinds, digest of the base spans, and all spans."""
    base = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return base.mapInArrow(
        scan_pass(RULES, len(BASE)), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def mask_secrets(docs: DataFrame, text="text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span replaced; overlapping spans become one mark."""
    patterns = RULES
    place = docs.columns.index(text)

    def run(batches):
        compiled = [re.compile(r.pattern) for r in patterns]
        queries = [trigram_query(r.pattern) for r in patterns]
        postings = Postings(set().union(*(trigrams_of(q) for q in queries)))
        for batch in batches:
            texts = batch.column(place).to_pylist()
            postings.index(batch.column(place))
            spans: list[list[tuple[int, int]]] = [[] for _ in texts]
            for k, rule in enumerate(patterns):
                rows = postings.find(queries[k])
                for row in range(len(texts)) if rows is None else rows.tolist():
                    spans[row] += [m.span() for m in compiled[k].finditer(texts[row] or "") if m.end(rule.group) - m.start(rule.group) >= rule.least]
            for row, of in enumerate(spans):
                if of:
                    out, at = [], 0
                    for s, e in sorted(of):
                        if s >= at:
                            out += [texts[row][at:s], mark]
                        at = max(at, e)
                    texts[row] = "".join([*out, texts[row][at:]])
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    return docs.mapInArrow(run, docs.schema)


def op3(spark, docs: DataFrame) -> DataFrame:
    return find_secrets(docs)


def _sql_kind(k: int, r: Rule) -> str:
    p = r.pattern.replace("'", "''")
    return f"""
SELECT r, {k} AS k, '{r.kind}' AS kind, unnest(range(1, len(a) + 1)) AS i, a, g, s FROM (
  SELECT r, regexp_extract_all(t, '{p}') AS a, regexp_extract_all(t, '{p}', {r.group}) AS g, regexp_split_to_array(t, '{p}') AS s FROM d)"""


def sql() -> str:
    least = " ".join(f"WHEN {k} THEN {r.least}" for k, r in enumerate(RULES))
    n = len(BASE)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(_sql_kind(k, r) for k, r in enumerate(RULES))}),
x AS (SELECT r, k, kind, len(a[i]) AS n,
             length(array_to_string(s[1:i], '')) + length(array_to_string(a[1:i - 1], '')) AS b
      FROM m WHERE len(g[i]) >= CASE k {least} END),
y AS (SELECT r, k, b, kind || ':' || b || ':' || (b + n) AS said FROM x),
z AS (SELECT r, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access, count(*) FILTER (WHERE k = 2) AS n_hex,
             string_agg(said, ',' ORDER BY b, k) FILTER (WHERE k < {n}) AS base, string_agg(said, ',' ORDER BY b, k) AS spans
      FROM y GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN z USING (r)
"""
