import random

import pytest

from tallyhouse.llm import jaccard, substrings
from tallyhouse.llm.components import connected_components

SCHEMA = "doc_id long, text string, n_shingles long, key long"


def texts(seed, hot):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, base = prose(30), prose(120)
    out = []
    for k in range(60):
        w = prose(rng.choice([0, 1, 2, 3, 15, 25, 60, 130]))
        if k % 4 == 0:
            w[len(w) // 2 : len(w) // 2] = passage
        out.append(" ".join(w))
    for _ in range(hot):  # copies of one text with a few words changed
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary) + "x"
        out.append(rng.choice([" ", "\n"]).join(w).upper() if rng.random() < 0.2 else " ".join(w))
    out += [out[0]] * 5 + ["a a a a a " * 20, "a a a a a " * 30, None, "", "\t\n ", "ä ö", "ä ö"]
    rng.shuffle(out)
    return list(enumerate(out))


def frame(spark, docs):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in docs], SCHEMA)


def brute_components(docs, shingle, percent):
    sets, root = {}, {}
    for i, t in docs:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))} if w else set()
        root[i] = i

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted((i, len(sets[i]), find(i)) for i in ids)


@pytest.mark.parametrize("shingle, percent, crowd, block", [(3, 90, 2048, 1024), (3, 90, 4, 8), (5, 80, 4, 8), (2, 60, 2048, 8), (2, 60, 4, 1024)])
def test_components(spark, rows, monkeypatch, shingle, percent, crowd, block):
    monkeypatch.setattr(jaccard, "CROWD", crowd)
    monkeypatch.setattr(jaccard, "BLOCK_DOCS", block)
    docs = texts(shingle * 100 + percent, 60)
    got = jaccard.near_duplicates(frame(spark, docs).repartition(3), shingle=shingle, percent=percent)
    assert rows(got, "doc_id", "n_shingles", "component_id") == sorted(brute_components(docs, shingle, percent), key=repr)


def test_a_group_of_many_blocks_where_few_are_like_the_leader(spark, rows, monkeypatch):
    """Copies of neighbours in a chain: the leader is linked with the first ones only, the rest with each other."""
    monkeypatch.setattr(jaccard, "BLOCK_DOCS", 4)
    rng = random.Random(8)
    w = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    docs = []
    for k in range(60):
        docs.append((k, " ".join(w)))
        w[rng.randrange(150)] = f"x{k}"
    docs += [(100 + k, " ".join([*w[:75], *[f"y{k}z{j}" for j in range(75)]])) for k in range(20)]
    rng.shuffle(docs)
    got = rows(jaccard.near_duplicates(frame(spark, docs)), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute_components(docs, 5, 80), key=repr)
    assert len({c for i, _, c in got if i < 100}) == 1


def test_sets_too_different_in_size_do_not_meet(spark, rows, monkeypatch):
    """A passage stands in texts of many lengths, each length a fourth above the one before: no two can be linked."""
    written, real = {}, jaccard.materialize

    def counted(df, label):
        out = real(df, label)
        written[label] = out.count()
        return out

    monkeypatch.setattr(jaccard, "materialize", counted)
    passage = [f"p{k}" for k in range(14)]
    docs = [(k, " ".join(passage + [f"d{k}w{j}" for j in range(round(14 * 1.25**k) - 14)])) for k in range(12)]
    got = rows(jaccard.op7(spark, frame(spark, docs)), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute_components(docs, 3, 90), key=repr) and len({c for _, _, c in got}) == 12
    assert written["jaccard-homes"] == written["jaccard-bounds"] == written["jaccard-visits"] == 0
    # sizes that may be linked meet as before, also where a chain of sizes leads from one to the other
    docs += [(20 + k, docs[11][1] + f" x{k}" + f" y{k}" * k) for k in range(4)]
    docs += [(40 + k, " ".join(passage + [f"e{j}" for j in range(100 + 8 * k)])) for k in range(12)]
    got = rows(jaccard.op7(spark, frame(spark, docs)), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute_components(docs, 3, 90), key=repr) and len({c for i, _, c in got if i >= 40}) == 1


def test_a_crowded_token_is_counted_over_all_rows(spark):
    """One row with it in each of many tasks is enough; and the keys of its documents avoid it."""
    words = " ".join(f"p{k}" for k in range(9))
    docs = [(k, words + " " + " ".join(f"d{k}w{j}" for j in range(60))) for k in range(64)]
    first = frame(spark, docs).repartition(64).select("doc_id", "text").mapInArrow(*jaccard._first_pass(5, 80))
    old, jaccard.CROWD = jaccard.CROWD, 50
    try:
        bits = jaccard.crowded_tokens(first)
    finally:
        jaccard.CROWD = old
    assert sum(bin(b).count("1") for b in bits) == 5
    keys = frame(spark, docs).select("doc_id", "text").mapInArrow(*jaccard._key_pass(5, 80, bits)).collect()
    assert not any(r["heavy"] for r in keys) and max(sum(r["key"] == k for r in keys) for k in {r["key"] for r in keys}) == 1


@pytest.mark.parametrize("few", [0, 3, 4])
def test_texts_take_one_python_pass_a_stage(spark, monkeypatch, few):
    from pyspark.sql import functions as F

    monkeypatch.setattr(jaccard, "FEW", few)
    base = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, None), (None, "d"), (5, "e")], "id long, text string")
    visits = spark.createDataFrame([(1, 7), (1, 8), (3, 9), (9, 9)], "doc long, v int").groupBy("doc").agg(F.collect_list("v").alias("visits"))
    got = jaccard.texts_of(base, visits)
    assert sorted((r[0], r[1], sorted(r[2])) for r in got.collect() if r[1]) == [(1, "a", [7, 8]), (1, "b", [7, 8])] and got.count() == 3
    plan = got._jdf.queryExecution().toString()
    assert ("MapInArrow" in plan) == (few < 4) and ("BroadcastHashJoin" in plan) == (few >= 4)


def test_keys_of_linked_sets():
    rng = random.Random(2)
    for percent in (60, 80, 90):
        for _ in range(2000):
            n = rng.randrange(1, 200)
            both = rng.randrange(1, n + 1)
            m = rng.randrange(both, 2 * n + 1)
            if 100 * both < percent * (n + m - both) or n == m == both:
                continue
            order = [(rng.random(), t) for t in range(n + m - both)]
            rank = {t: r for r, t in order}
            x, y = list(range(n)), list(range(n - both, n + m - both))
            kx, cx = jaccard.keys_of(n, percent)
            ky, cy = jaccard.keys_of(m, percent)
            first = lambda s, k: set(sorted(s, key=rank.get)[:k])
            assert len(first(x, kx) & first(y, ky)) >= min(cx, cy)


def test_keep_one(spark):
    docs = texts(5, 20)
    kept = jaccard.keep_one(frame(spark, docs))
    assert kept.columns == ["doc_id", "text", "n_shingles", "key"]
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _, c in brute_components(docs, 5, 80) if i == c}


def test_a_repeated_id_with_an_empty_text_among_many_near_copies(spark, rows):
    base = [f"w{k}" for k in range(200)]
    docs = [(k, " ".join(base[:k] + ["x"] + base[k + 1 :])) for k in range(0, 120, 8)]
    got = rows(jaccard.op7(spark, frame(spark, [*docs, (8, None), (16, "")])), "doc_id", "n_shingles", "component_id")
    assert got == sorted([(k, 198, 0) for k, _ in docs] + [(8, 0, 0), (16, 0, 0)], key=repr)


def test_odd_ids(spark, rows):
    docs = [(None, "a b c d e f g h i j k"), (1, "a b c d e f g h i j k"), (1, "other words here"), (2, "other words here"), (3, None)]
    got = rows(jaccard.op7(spark, frame(spark, docs)), "doc_id", "n_shingles", "component_id")
    assert got == sorted([(None, 9, None), (1, 9, 1), (1, 1, 1), (2, 1, 1), (3, 0, 3)], key=repr)
    assert jaccard.op7(spark, frame(spark, docs).limit(0)).count() == 0
    assert jaccard.keep_one(frame(spark, docs)).count() == 4


def test_a_long_chain_is_one_component(spark, rows):
    edges = [(k, k + 1) for k in range(70)] + [(200, 201), (5, 5), (None, 3), (201, 200)]
    got = dict(rows(connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b"), "node", "component"))
    assert got == {**{k: 0 for k in range(71)}, 200: 200, 201: 200}


# ------------------------------------------------------------------ repeated passages


def brute_kept(docs, length):
    seen, out = set(), []
    for i, t in sorted(docs):
        w = (t or "").encode().split()
        gone = set()
        for k in range(len(w) - length + 1):
            x = tuple(w[k : k + length])
            if x in seen:
                gone |= set(range(k, k + length))
            seen.add(x)
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("crowded, report", [(4096, 4), (3, 1)])
def test_repeats(spark, rows, monkeypatch, crowded, report):
    monkeypatch.setattr(substrings, "CROWDED", crowded)
    monkeypatch.setattr(substrings, "REPORT", report)
    docs = texts(crowded, 40)
    got = substrings.remove_repeats(frame(spark, docs).repartition(3))
    assert rows(got, "doc_id", "n_words", "n_removed", "kept") == brute_kept(docs, 20)


def test_repeats_of_another_length(spark, rows):
    docs = texts(77, 10)
    got = substrings.remove_repeats(frame(spark, docs), length=9, anchor=3)
    assert rows(got, "doc_id", "n_words", "n_removed", "kept") == brute_kept(docs, 9)


def test_odd_ids_of_passages(spark, rows):
    line = " ".join(f"x{k}" for k in range(25))
    docs = [(None, line), (None, line), (1, line + " tail"), (1, "short"), (2, None)]
    got = rows(substrings.remove_repeats(frame(spark, docs)), "doc_id", "n_words", "n_removed", "kept")
    assert got == sorted([(None, 25, 0, line), (None, 25, 25, ""), (1, 26, 25, "tail"), (1, 1, 0, "short"), (2, 0, 0, "")], key=repr)
    assert substrings.op6(spark, frame(spark, docs).limit(0)).count() == 0
