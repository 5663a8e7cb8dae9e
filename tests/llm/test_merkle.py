import hashlib
import random
import zlib

import pytest

from tallyhouse.llm import merkle

SCHEMA = "tree string, text string, lang string, doc_id long, source string, digest int, n_chars long"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute(docs):
    """Rows of the contract, with proofs by plain recursion over lists."""

    def leaf(d, text):
        return sha("".join(field(v) for v in (d["doc_id"], d["source"], d["lang"], d["n_chars"], text)))

    def grow(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            below = levels[-1]
            levels.append([sha("".join(below[i : i + 8])) for i in range(0, len(below), 8)])
        return levels

    def siblings(levels, k):
        out = []
        for level in levels[:-1]:
            lo = k - k % 8
            out.append((level[lo:k], level[k + 1 : lo + 8]))
            k //= 8
        return out

    langs = sorted({d["lang"] for d in docs}, key=lambda x: b"" if x is None else b"=" + x.encode())
    trees = {
        lang: sorted(
            ((d["doc_id"], leaf(d, d["text"]), d) for d in docs if d["lang"] == lang), key=lambda x: (x[0] is not None, x[0] or 0, x[1])
        )
        for lang in langs
    }
    levels = {lang: grow([x[1] for x in rows]) for lang, rows in trees.items()}
    top = grow([levels[lang][-1][0] for lang in langs])
    out = []
    for n, lang in enumerate(langs):
        for k, (doc_id, own, d) in enumerate(trees[lang]):
            steps = siblings(levels[lang], k) + siblings(top, n)
            text = d["text"]
            if text is not None and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            folded = leaf(d, text)
            for left, right in steps:
                folded = sha("".join([*left, folded, *right]))
            root = top[-1][0]
            proof = sha("".join("".join(left + right) for left, right in steps))
            out.append((doc_id, own, levels[lang][-1][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def data(n, seed):
    rng = random.Random(seed)
    docs = [
        {
            "doc_id": rng.choice([None, k, k, k, k, -k]),
            "text": rng.choice([None, "", f"Text {k}", "lower", "É Ü " + "Long " * 3000]),
            "lang": rng.choice([None, "a", "a", "a", "a", "a", "", "ä", "Z"] + [f"x{j}" for j in range(9)]),
            "source": rng.choice([None, "s", "longer:3"]),
            "n_chars": rng.choice([None, k]),
        }
        for k in range(n)
    ]
    return docs + docs[:9] + docs[:3]


def frame(spark, docs):
    return spark.createDataFrame([("t", d["text"], d["lang"], d["doc_id"], d["source"], 1, d["n_chars"]) for d in docs], SCHEMA)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("n", [1, 9, 300])
def test_manifest(spark, rows, n):
    docs = data(n, n)
    assert rows(merkle.op11(spark, frame(spark, docs).repartition(5)), *COLUMNS) == brute(docs)


def test_one_leaf_is_its_own_root(spark):
    docs = [{"doc_id": 5, "text": "x", "lang": None, "source": None, "n_chars": 1}]
    (r,) = merkle.op11(spark, frame(spark, docs)).collect()
    assert r["leaf"] == r["subroot"] == r["root"] == r["folded_root"] and r["proof_sha256"] == sha("")


def test_an_empty_table(spark):
    out = merkle.op11(spark, frame(spark, data(1, 1)).limit(0))
    assert out.columns == COLUMNS and out.count() == 0


def test_requests_take_only_their_own_ways(spark, rows):
    docs = [{"doc_id": k, "text": f"t{k % 50}", "lang": "a" if k % 3 else "b", "source": "s", "n_chars": 2} for k in range(300)]
    manifest = merkle.build(merkle.document_leaves(frame(spark, docs)))
    asked = spark.createDataFrame([("=a", 0), ("=a", 131), ("=b", 99), ("=b", 100), ("none", 1)], "tree string, rank long")
    got = merkle.proofs(manifest, asked)
    everything = {(r["tree"], r["rank"]): r for r in merkle.proofs(manifest).collect()}
    assert len(everything) == 300
    found = {(r["tree"], r["rank"]): r for r in got.collect()}
    assert set(found) == {("=a", 0), ("=a", 131), ("=b", 99)} and all(everything[k] == r for k, r in found.items())


def test_records_are_addressed_by_content(spark):
    """Every record's digest is that of its children, each digest stands once, and all nodes but leaves are there."""
    docs = data(120, 4)
    manifest = merkle.build(merkle.document_leaves(frame(spark, docs)))
    records = {r["digest"]: r["children"] for r in manifest.records().collect()}
    assert manifest.records().count() == len(records)
    assert all(sha("".join(children)) == digest and 1 <= len(children) <= 8 for digest, children in records.items())
    below = [manifest.root]
    leaves = 0
    while below:
        node = below.pop()
        below += records.get(node, [])
        leaves += node not in records
    assert leaves == len(docs)
