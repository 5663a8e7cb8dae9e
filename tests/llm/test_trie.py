import hashlib
import random
import zlib

import numpy as np
import pytest

from tallyhouse.llm import trie

SCHEMA = "part long, conv_id long, turn long, role string, node string, text string"


def frame(spark, turns):
    return spark.createDataFrame([(1, c, t, r, "n", x) for c, t, r, x in turns], SCHEMA)


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def rebuild(turns):
    own = {}
    for c, t, r, x in turns:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, digest(r or "", x or ""), (r or "", x or "")))
    own = {c: [x[3] for x in sorted(rows)] for c, rows in own.items()}
    out = {}
    for c, rows in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(base, [])[:h] + rows[h:]
    return out


def brute(turns):
    convs, nodes = rebuild(turns), {}
    for c, rows in convs.items():
        for d in range(len(rows) + 1):
            nodes.setdefault(tuple(rows[:d]), []).append(c)
    children = {p: 0 for p in nodes}
    for p in nodes:
        if p:
            children[p[:-1]] += 1
    saved, leaves = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for p, members in nodes.items():
        own = (len(members) - 1) * len(p[-1][1].encode().split()) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += own
            leaves[p[:d]] += children[p] == 0
    out = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(p))
        up = min(nodes[p[:-1]]) if p else None
        out.append((min(members), len(p), up, len(members), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def talks(seed, n, hot):
    rng = random.Random(seed)
    phrases = ["hello there", "hi", "how are you", "a b c d", "", None, "fine\tthanks\n", "ä ö"]
    greeting = [(k, "user", f"greeting {k} of all") for k in range(3)]
    copy = [(k, "x", rng.choice(phrases)) for k in range(6)]
    turns = []
    for c in rng.sample(range(-30, 6 * n), n):
        rows = [(rng.choice([k, k, k, None]), rng.choice(["user", "bot", None]), rng.choice(phrases)) for k in range(rng.choice([1, 1, 2, 3, 5, 9]))]
        kind = rng.random()
        if kind < hot:
            rows = copy
        elif kind < 2 * hot:
            rows = greeting + [(3 + k, r, x) for k, (_, r, x) in enumerate(rows)]
        turns += [(c, *r) for r in rows]
    turns += [(None, 1, "user", "nobody"), turns[0]]
    rng.shuffle(turns)
    return turns


@pytest.mark.parametrize("block, piece, hot", [(500_000, 1 << 20, 0.3), (25, 40, 0.3), (3, 20, 0.1), (60, 1 << 20, 0.45)])
def test_trie(spark, rows, monkeypatch, block, piece, hot):
    monkeypatch.setattr(trie, "BLOCK_TURNS", block)
    monkeypatch.setattr(trie, "PIECE", piece)
    turns = talks(block, 90, hot)
    got = rows(trie.op13(spark, frame(spark, turns).repartition(3)), *trie.COLUMNS)
    assert got == brute(turns)


def test_long_conversations_over_the_edges_of_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK_TURNS", 150)
    long = [(k, "user", f"turn {k % 7} of many") for k in range(120)]
    turns = [(20 * c, *r) for c in range(6) for r in long[: 120 - 7 * (c % 3)]] + [(20 * c + 400, *r) for c in range(3) for r in [*long[:80], (80, "bot", str(c))]]
    assert rows(trie.op13(spark, frame(spark, turns)), *trie.COLUMNS) == brute(turns)


def test_few_conversations(spark, rows):
    for turns in ([(5, None, None, None)], [(21, 0, "user", "own first turns go, the base is not there")], [(0, 0, "a", "b"), (1, 0, "a", "b")]):
        assert rows(trie.op13(spark, frame(spark, turns)), *trie.COLUMNS) == brute(turns)
    none = trie.op13(spark, frame(spark, [(None, 1, "a", "b")]))
    assert none.columns == trie.COLUMNS and none.count() == 0


def test_a_very_long_text(spark, rows):
    turns = [(20 * c, k, "user", "word " * 400_000 if k == 1 else "x") for c in range(2) for k in range(3)]
    assert rows(trie.op13(spark, frame(spark, turns)), *trie.COLUMNS) == brute(turns)


def test_range_minima():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 17, 64, 200):
        v = rng.integers(-1, 6, n)
        t = trie.Minima(v)
        at = rng.integers(0, n, 300)
        to = np.minimum(n - 1, at + rng.integers(0, n, 300))
        assert t.least(at, to).tolist() == [v[a : b + 1].min() for a, b in zip(at, to, strict=True)]
        least = rng.integers(0, 6, 300)
        want_right = [max(r for r in range(a, n) if (v[a + 1 : r + 1] >= d).all()) for a, d in zip(at, least, strict=True)]
        want_left = [min(x for x in range(-1, a + 1) if (v[x + 1 : a + 1] >= d).all()) for a, d in zip(at, least, strict=True)]
        assert t.right(at, least).tolist() == want_right and t.left(at, least).tolist() == want_left
