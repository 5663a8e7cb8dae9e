import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import fingerprints as fp

SCHEMA = "rank long, doc_id long, text string, key string, part int, words string"
COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def frame(spark, docs):
    return spark.createDataFrame([(1, i, t, "k", 2, "w") for i, t in docs], SCHEMA)


def shingles(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).encode().split()
    return {b" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def sketch(text):
    return sorted({hashlib.md5(s).hexdigest()[:16] for s in shingles(text)})[:128]


def near(a, b):
    union = sorted(set(a) | set(b))[:128]
    return sum(h in a and h in b for h in union) / len(union) if union else 1.0


def brute(docs):
    docs = [(i, t or "") for i, t in docs]
    docs.sort(key=lambda d: (d[0] is not None, d[0] or 0, hashlib.sha256(f"{'-' if d[0] is None else d[0]}:{d[1]}".encode()).hexdigest()))
    out = []
    for k, (i, t) in enumerate(docs):
        n, other = len(t), docs[(k + 1) % len(docs)][1]
        edited = t[: n - n // 2] + other[: n // 2]
        a, b = sketch(t), sketch(edited)
        out.append((i, n, hashlib.sha256(edited.encode()).hexdigest(), "".join(a), "".join(b), near(a, b), near(a, sketch(other))))
    return sorted(out, key=repr)


def texts(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["Alpha", "beta", "ÉTÉ", "x", "\U0001f600", "zeta,"]) + str(rng.randrange(60))
    prose = lambda n: rng.choice([" ", "\n", " \t "]).join(word() for _ in range(n))
    docs = [(rng.randrange(40), prose(rng.choice([0, 1, 3, 5, 6, 40, 400]))) for _ in range(50)]
    docs += [(None, None), (None, ""), (None, "null id"), (7, docs[0][1]), (-3, " \n "), *docs[:6], *docs[:2], (99, "tail"), (99, "tail"), (99, "tail")]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain_code(spark, rows, seed):
    docs = texts(seed)
    assert rows(fp.op12(spark, frame(spark, docs).repartition(4)), *COLUMNS) == brute(docs)


def test_one_document_no_document_and_a_long_one(spark, rows):
    assert rows(fp.op12(spark, frame(spark, [(1, "a b c d e f g h")])), *COLUMNS) == brute([(1, "a b c d e f g h")])
    none = fp.op12(spark, frame(spark, [(1, "a")]).limit(0))
    assert none.columns == COLUMNS and none.count() == 0
    rng = random.Random(3)
    docs = [(k, " ".join(rng.choice("abcdef") * 3 + str(rng.randrange(999)) for _ in range(250_000))) for k in range(2)]  # 1.7 MB each
    assert rows(fp.op12(spark, frame(spark, docs)), *COLUMNS) == brute(docs)


def test_no_python_on_the_main_path(spark):
    plan = fp.op12(spark, frame(spark, texts(1)))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "InArrow", "InPandas", "MapPartitions"))


def test_estimates(spark):
    rng = random.Random(9)
    w = [f"w{rng.randrange(10**6)}" for _ in range(6000)]
    pairs = [(w[:4000], w[2000:]), (w[:1000], w[:5000]), (w[:20], w[:60]), ([], w[:9])]
    data = [(k, " ".join(a), " ".join(b)) for k, (a, b) in enumerate(pairs)]
    df = fp.fingerprint(fp.fingerprint(spark.createDataFrame(data, "k int, x string, y string"), "x", "a"), "y", "b")
    a, b = F.col("a"), F.col("b")
    got = df.select("k", fp.resemblance(a, b).alias("r"), fp.containment(a, b).alias("c"), fp.distinct_shingles(a).alias("n")).orderBy("k").collect()
    for row, (k, x, y) in zip(got, data, strict=True):
        p, q = shingles(x), shingles(y)
        exact = len(p) < 128 and len(q) < 128
        assert row["r"] == pytest.approx(len(p & q) / max(1, len(p | q)), abs=0 if exact else 0.12), k
        assert row["n"] == pytest.approx(len(p), rel=0.3 if len(p) >= 128 else 0), k
        assert row["c"] == pytest.approx(len(p & q) / len(p) if p else 1.0, abs=1e-9 if exact else 0.2), k


def test_sketches_merge(spark):
    docs = [(k % 3, t) for k, (_, t) in enumerate(texts(5)) if t]
    df = fp.fingerprint(spark.createDataFrame([*docs, (8, "")], "g int, text string"), name="sketch")
    got = {r["g"]: r["sketch"] for r in fp.merge_by(df, ["g"]).collect()}
    want = {g: sorted({hashlib.md5(s).hexdigest()[:16] for h, t in docs if h == g for s in shingles(t)})[:128] for g in range(3)}
    assert got == {**want, 8: []}
    two = df.where("g < 2").groupBy("g").agg(F.first("sketch").alias("s")).groupBy().pivot("g", [0, 1]).agg(F.first("s"))
    r = two.select(fp.merged(F.col("0"), F.col("1")).alias("m"), "0", "1").first()
    assert r["m"] == sorted(set(r["0"]) | set(r["1"]))[:128]
