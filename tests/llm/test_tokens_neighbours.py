import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tallyhouse.llm import neighbours, tokens
from tallyhouse.llm.base import small_frame
from tallyhouse.llm.dac import Codes, encode
from tallyhouse.session import scratch_path

# ------------------------------------------------------------------ codes


@settings(deadline=None, max_examples=60)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=2000), st.data())
def test_codes_round_trip(values, data):
    codes = Codes(encode(np.array(values, np.uint64)))
    assert len(codes) == len(values) and codes.read(0, len(values)).tolist() == values
    if values:
        i = data.draw(st.integers(0, len(values) - 1))
        j = data.draw(st.integers(i, len(values)))
        assert codes[i] == values[i] and codes.read(i, j).tolist() == values[i:j]
    with pytest.raises(IndexError):
        codes[len(values)]


def test_a_value_too_large():
    with pytest.raises(ValueError):
        encode(np.array([2**32], np.uint64))


TEXTS = [(3, "The cat, the CAT and it's 42 naïve façades!!"), (1, None), (2, ""), (2, "again"), (None, "no id"), (9, "<|endoftext|> x<|ENDOFTEXT|> ΑΣ \x00   é É ½ don't"), (7, "long word " * 3000)]


def test_files(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokens.vocabulary_path())
    docs = spark.createDataFrame([(i, t, "s") for i, t in TEXTS], "doc_id long, text string, start string")
    folder = scratch_path(spark, "test-tokens")
    tokens.write_tokens(docs.repartition(2), folder, segment=50)
    got = [tuple(r) for r in tokens.read_documents(spark, folder).collect()]
    assert len(got) == len(TEXTS)
    ids = {(i, t): whole.encode(t or "", add_special_tokens=False).ids + [1] for i, t in TEXTS}
    want = sorted((-1 if i is None else i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (i, _), x in ids.items())
    assert sorted((-1 if i is None else i, n, c) for i, _, n, c in got) == want
    at = 0
    for i, start, n, _ in sorted(got, key=lambda r: r[1]):  # ascending ids, no gaps
        assert start == at
        at += n
    assert [r[0] for r in sorted(got, key=lambda r: r[1])] == [None, 1, 2, 2, 3, 7, 9]
    some = sorted(tokens.read_tokens(spark, folder, 7, 5000, 5010).collect(), key=lambda r: r["position"])
    assert [r["token"] for r in some] == ids[TEXTS[6]][5000:5010]


def test_remembered_words_are_bounded(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "REMEMBERED", 1000)
    whole = Tokenizer.from_file(tokens.vocabulary_path())
    encoder = tokens.Encoder(tokens.vocabulary_path())
    odd = ["don't", "'s", "s", "''s", "x''s", "Éé", "é", "É2", "naïve,", ",", "1a2b", "²", "ΑΣ", "\x7f", "it'll", "ll", "'ll", "a'b", "rock'", "rock's", "end'''", "No!!", "$$$"]
    for k in range(20):
        texts = [" ".join([f"{w},{'abcdefghij'[k % 10]}{chr(97 + j % 26)}{chr(97 + j // 26)}{k}." for j, w in enumerate(["no", "yes", "NO,"] * 30)]), " ".join(odd), None]
        got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode([t and t.encode() for t in texts])]
        assert got == [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
        # the words and parts of the texts in hand come on top
        assert sum(len(v) for v in vars(encoder).values() if isinstance(v, dict)) <= 1000 + 400
    assert sum(len(v) for v in vars(encoder).values() if isinstance(v, dict)) > 500


def test_texts_are_encoded_in_pieces(monkeypatch):
    monkeypatch.setattr(tokens, "PIECE", 10)
    texts = [b"abcd", None, b"abcd", b"abcd", b"x" * 50, b"", b"y"]
    found = list(tokens._text_pieces(texts))
    assert [lo for lo, _ in found] == [0, 3, 4, 5] and [t for _, some in found for t in some] == texts
    assert list(tokens._text_pieces([])) == []


def test_codes_of_ids_take_little_memory():
    import tracemalloc

    ids = np.random.default_rng(1).integers(0, 49_000, 1 << 20).astype("<u4")
    tracemalloc.start()
    try:
        data = encode(ids)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert data == encode(ids.astype(np.uint64)) and peak < 12 << 20  # three times the ids


def test_documents_read_in_pieces(monkeypatch):
    monkeypatch.setattr(tokens, "READ", 7)
    row = {"part_base": 5, "base": 2, "doc_ids": [4, 5, 6, 7], "lengths": [3, 1, 20, 6]}
    ids = np.arange(250, 280).astype("<u4")
    batch = pa.RecordBatch.from_pylist([row | {"codes": encode(ids)}])
    got = [tuple(r.values()) for out in tokens._read_pass([batch]) for r in out.to_pylist()]
    cuts = [(0, 3), (3, 4), (4, 24), (24, 30)]
    assert got == [(4 + k, 7 + a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(cuts)]


def test_small_frames_start_no_python(spark):
    for rows in ([(1, 2), (3, None)], []):
        df = small_frame(spark, rows, part=pa.int32(), part_base=pa.int64())
        assert [tuple(r) for r in df.collect()] == rows and [t for _, t in df.dtypes] == ["int", "bigint"]
        assert "ExistingRDD" not in df._jdf.queryExecution().toString()


def test_no_documents(spark):
    assert tokens.op8(spark, spark.createDataFrame([], "doc_id long, text string")).count() == 0


# ------------------------------------------------------------------ neighbours


def brute(rows, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float)) and len(v) == 8]
    out = {}
    for i, q in ok:
        if i % 50 == 0:
            best = {}
            for j, c in ok:
                if j != i:
                    best[j] = max(best.get(j, -2), float((q * c).sum() / (np.sqrt((q * q).sum()) * np.sqrt((c * c).sum()))))
            out[i] = [j for j, _ in sorted(best.items(), key=lambda x: (-round(x[1], 12), x[0]))[:k]]
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_search_with_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in np.float32(rng.normal(size=8))]) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]  # a hot vector
    rows += [rows[3], (450, [0.0] * 8), (500, None), (550, [None] * 8), (600, [float("nan")] * 8), (650, [float("inf")] + [1.0] * 7), (None, rows[1][1]), (700, [1.0])]
    got: dict = {}
    for r in neighbours.op1(spark, frame(spark, rows)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute(rows, 5)
    assert got.keys() == want.keys()
    hit = 0
    for q, found in got.items():
        assert sorted(x[0] for x in found) == [1, 2, 3, 4, 5]
        hit += len({x[1] for x in found} & set(want[q]))
    assert hit >= 0.9 * 5 * len(want)
    assert [x[1] for x in sorted(got[0])] == [1000, 1001, 1002, 1003, 1004]
    assert [x[1] for x in sorted(got[1000])] == [0, 1001, 1002, 1003, 1004]


def test_few_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [-1.0, 0.1]), (2, [0.0, 1.0])]
    got = sorted(tuple(r)[:3] for r in neighbours.op1(spark, frame(spark, rows)).collect())
    assert got == [(0, 1, 2), (0, 2, 1)]
    assert neighbours.op1(spark, frame(spark, [(3, [1.0])])).count() == 0
    assert neighbours.op1(spark, frame(spark, [])).count() == 0


def test_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    data = vectors.collect()
    ids, m = np.array([r["vec_id"] for r in data]), np.array([r["embedding"] for r in data], float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    found: dict = {}
    for r in neighbours.op1(spark, vectors).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hit = total = 0
    for k in np.flatnonzero(ids % 50 == 0):
        s = m @ m[k]
        s[k] = -9
        hit += len(found[ids[k]] & set(ids[np.argsort(-s)[:5]]))
        total += 5
    assert hit >= 0.9 * total


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 7)
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in np.float32(rng.normal(size=8))]) for i in range(300)]
    got: dict = {}
    for r in neighbours.op1(spark, frame(spark, rows)).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = brute(rows, 5)
    assert sum(len(got[q] & set(w)) for q, w in want.items()) >= 0.9 * 5 * len(want)
