"""Registered queries against their SQL, and the pipeline against plain code."""

import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from oracle import compare, connect

from tallyhouse.llm.queries import all_llm_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WITH_SQL = [q for q in all_llm_queries() if q.sql is not None]


@pytest.mark.parametrize("query", WITH_SQL, ids=lambda q: q.name)
def test_query(spark, query):
    ok, note = compare(spark, connect(SF_DIR), query, SF_DIR)
    assert ok, note


def test_names():
    import __spark_entry__ as entry

    names = list(entry.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names


def test_pipeline(spark):
    """Stage by stage against plain code over the stage's own input."""
    import corpus_pipeline as cp

    from tallyhouse.llm import quality
    from tallyhouse.llm.base import prepare, table
    from tallyhouse.session import materialize

    prepare(spark)
    docs = table(spark, SF_DIR, "documents")
    columns = docs.columns
    out = {}
    for name, stage in cp.STAGES:
        out[name] = (docs, materialize(stage(spark, docs, SF_DIR), f"test-{name}"))
        docs = out[name][1]
        if name != "tokens":
            assert docs.columns == columns

    before, after = out["quality"]
    model = quality.fit(before, table(spark, SF_DIR, "labels"))
    rows = before.collect()
    want = {r["doc_id"] for r, s in zip(rows, model.scores(pa.array([r["text"] for r in rows], pa.string())), strict=True) if s >= 0.3}
    assert {r["doc_id"] for r in after.collect()} == want and 0 < len(want) < len(rows)

    before, after = out["near_duplicates"]
    sets = {}
    for r in before.collect():
        w = bytes(r["text"] or "", "utf-8").lower().split()
        sets[r["doc_id"]] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and sets[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert {r["doc_id"] for r in after.collect()} == {i for i in ids if find(i) == i}

    before, after = out["decontaminate"]
    import re

    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    windows = set()
    for r in table(spark, SF_DIR, "benchmark").collect():
        w = words(r["text"])
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    assert all(len(x) == 10 for x in windows)
    dirty = {r["doc_id"] for r in before.collect() if any(tuple(w[i : i + 10]) in windows for w in [words(r["text"])] for i in range(len(w) - 9))}
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect()} - dirty

    before, after = out["mix"]
    size = {r["doc_id"]: len((r["text"] or "").split()) for r in before.collect()}
    taken: dict[int, int] = {}
    for r in after.collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + len(r["text"].split())
    assert all(n <= 3 * size[i] for i, n in taken.items())
    assert abs(sum(taken.values()) - sum(size.values())) <= len(size)

    before, after = out["tokens"]
    from tokenizers import Tokenizer

    from tallyhouse.llm.tokens import vocabulary_path

    tokenizer = Tokenizer.from_file(vocabulary_path())
    want = sorted(
        (r["doc_id"], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        for r in before.collect()
        for ids in [tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1]]
    )
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in after.collect()) == want
