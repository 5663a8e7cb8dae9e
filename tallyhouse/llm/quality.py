"""Quality of documents by votes of labelled neighbours in a latent-semantic space.

Every text becomes a bag of terms: its words, the shapes of its words (letter case, digits and the marks
around them), and marks of repetition (a word after itself, word pairs and lines that came before).
Terms are hashed to ``SPACE`` codes.  A bounded sample of labelled rows fixes the vocabulary, the most
frequent ``TERMS`` codes; document frequencies are counted over all documents.  A truncated singular
value decomposition of the weighted sample gives the latent space of ``DIMS`` dimensions.

The sample's vectors and labels are broadcast: their number is the parameter ``SAMPLE``, so the size is
bound (about 1 MB).  For every document the exact cosines to all of them are computed as products of
blocks; the ``NEIGHBOURS`` nearest vote with their label, weighted by a power of the similarity.

Labels, language, source and id are never part of a vector.  Defined results: null and empty texts, and
texts without any known term, get the share of label 1 in the sample (0.5 without a sample); a null id is
not held out; repeated ids are scored row by row; labels that contradict each other count by majority,
ties as 1; labels that are null or of unknown documents are left out; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tallyhouse.llm.base import give_back, neutral, remembers, restored, small_frame, tidy
from tallyhouse.llm.words import U64, byte_pieces, hash_words, scramble

SPACE = 1 << 20
SAMPLE, TERMS, DIMS, NEIGHBOURS, POWER = 4096, 8192, 64, 7, 12.0
THRESHOLD, FOLDS = 0.3, 5
#: Weight of shapes and of repetition beside words.
SHAPES, REPEATS = 3.0, 4.0
SEED = 7

#: Classes of bytes in a shape: capitals, other letters (and all above ASCII), digits; marks stay.
_CLASSES = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b > 127 else 48 if 48 <= b <= 57 else b for b in range(256))
_RUN = re.compile(rb"(.)\1+", re.S)
#: Codes of words, by their hash: word code << 20 | shape code.
_memory: list[np.ndarray] = [np.zeros(0, U64), np.zeros(0, np.int64)]  # sorted hashes, their codes
REMEMBERED = 600_000


def _forget() -> None:
    _memory[:] = [np.zeros(0, U64), np.zeros(0, np.int64)]


remembers("quality", _forget)


def _code(kind: bytes, term: bytes) -> int:
    return zlib.crc32(term, zlib.crc32(kind)) % SPACE


_AFTER_ITSELF, _PAIR, _LINE = (_code(b"mark", m) for m in (b"itself", b"pair", b"line"))


def _word_codes(word: bytes) -> int:
    shape = _RUN.sub(rb"\1+", word.translate(_CLASSES))[:12]
    return _code(b"word", word.lower().strip(b".,;:!?()\"'")) << 20 | _code(b"shape", shape)


def _distinct(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of one of each (text, value), and how often it occurs; ``doc`` is sorted."""
    order = np.lexsort((value, doc))
    v = value[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    return order[first], doc[first], np.diff(np.append(first, len(v)))


def _codes_of(known: np.ndarray, word) -> np.ndarray:
    """Codes of sorted different word hashes; ``word(k)`` gives the word of those not seen of late."""
    hashes, codes = _memory
    if len(hashes) > REMEMBERED:
        hashes, codes = hashes[:0], codes[:0]
    place = np.searchsorted(hashes, known)
    old = np.zeros(len(known), bool)
    inner = place < len(hashes)
    old[inner] = hashes[place[inner]] == known[inner]
    out = np.empty(len(known), np.int64)
    out[old] = codes[place[old]]
    new = np.flatnonzero(~old)
    out[new] = [_word_codes(word(k)) for k in new.tolist()]
    _memory[:] = np.insert(hashes, place[new], known[new]), np.insert(codes, place[new], out[new])
    return out


def term_rows(column: pa.Array):
    """``row, docs, doc, code, weight``: terms of the ``docs`` whole texts from ``row`` on, sorted by
    text (``doc`` from 0).  A code may come several times for a text; its weights add up."""
    for row, offsets, data in byte_pieces(column):
        bounds, hashes, start, end = hash_words(data, offsets, lower=False)
        n = np.diff(bounds)
        docs = len(n)
        doc = np.repeat(np.arange(docs), n)
        at, of, count = _distinct(doc, hashes)
        known, example, inverse = np.unique(hashes[at], return_index=True, return_inverse=True)
        packed = _codes_of(known, lambda k: data[start[at[example[k]]] : end[at[example[k]]]].tobytes())
        packed = packed[inverse]

        same = doc[1:] == doc[:-1]
        with np.errstate(over="ignore"):
            pair = scramble(hashes[:-1] * U64(3) + hashes[1:])[same]
        pairs = np.bincount(doc[1:][same], minlength=docs) - np.bincount(_distinct(doc[1:][same], pair)[1], minlength=docs)
        itself = np.bincount(doc[1:][same & (hashes[1:] == hashes[:-1])], minlength=docs)
        lines = np.zeros(docs)
        for k in range(docs):
            own = [x for x in data[offsets[k] : offsets[k + 1]].tobytes().split(b"\n") if x.strip()]
            lines[k] = (len(own) - len(set(own))) / len(own) if own else 0.0
        size = np.maximum(n, 1)
        marks = [(_AFTER_ITSELF, itself / size), (_PAIR, pairs / size), (_LINE, lines)]

        # words by dampened counts, shapes and marks by their share of the text
        every = np.arange(docs)
        docs_of = np.concatenate([of, of, *[every] * 3])
        code = np.concatenate([packed >> 20, packed & (SPACE - 1), *[np.full(docs, c) for c, _ in marks]])
        weight = np.concatenate(
            [np.log1p(count) / np.log1p(size[of]), SHAPES * np.sqrt(count / size[of]), *[REPEATS * np.sqrt(share) for _, share in marks]]
        )
        keep = weight > 0
        order = np.argsort(docs_of[keep], kind="stable")
        yield row, docs, docs_of[keep][order], code[keep][order], weight[keep][order]


def terms(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct codes and summed weights of each text."""
    out = []
    for _, docs, doc, code, weight in term_rows(column):
        edge = np.searchsorted(doc, np.arange(docs + 1))
        for lo, hi in zip(edge[:-1], edge[1:], strict=True):
            unique, inverse = np.unique(code[lo:hi], return_inverse=True)
            out.append((unique, np.bincount(inverse, weights=weight[lo:hi], minlength=len(unique))))
    return out


# ---------------------------------------------------------------- fitting


def _labelled(docs: DataFrame, labels: DataFrame, sample: int) -> list:
    """Label, codes and weights of a sample of labelled rows outside the held-out fold.

    The sample is the rows with the smallest hashes of their ids, so it is the same on every run.
    """
    fold = F.crc32(F.col("doc_id").cast("string")) % FOLDS
    known = (
        labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label")).where(fold != 0)
    )
    texts = docs.select("doc_id", "text").where("doc_id is not null")
    ids = known.join(texts.select("doc_id").distinct(), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()
    if not ids:
        return []
    spark = docs.sparkSession
    few = F.broadcast(small_frame(spark, [(r["doc_id"], r["label"]) for r in ids], doc_id=pa.int64(), label=pa.int32()))

    def bags(batches):
        for batch in batches:
            found = terms(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([c.astype(np.int32).tobytes() for c, _ in found], pa.binary()), pa.array([w.tobytes() for _, w in found], pa.binary())],
                ["doc_id", "label", "codes", "weights"],
            )

    # of rows that repeat an id, one is learnt from
    once = texts.join(few, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = once.select("doc_id", "text", "label").mapInArrow(tidy(bags, "quality"), "doc_id long, label int, codes binary, weights binary")
    found = sorted(rows.toLocalIterator(), key=lambda r: (r["doc_id"], r["codes"], r["weights"]))
    return [(r["label"], np.frombuffer(r["codes"], np.int32), np.frombuffer(r["weights"])) for r in found]


def frequencies(docs: DataFrame, vocabulary: np.ndarray) -> tuple[int, np.ndarray]:
    """Number of documents, and of documents with each term, over the whole table."""

    def count(batches):
        place = np.full(SPACE, -1, np.int32)
        place[vocabulary] = np.arange(len(vocabulary))
        n, df = 0, np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            n += batch.num_rows
            for _, _, doc, code, _ in term_rows(batch.column(0)):
                at = place[code]
                in_use = at >= 0
                df += np.bincount(np.unique(doc[in_use] * len(vocabulary) + at[in_use]) % len(vocabulary), minlength=len(vocabulary))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(len(df)), -1)), pa.array(np.append(df, n))], ["term", "n"])

    found = docs.select("text").mapInArrow(tidy(count, "quality"), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(len(vocabulary), np.int64)
    total = 0
    for r in found:
        if r["term"] < 0:
            total = r["n"]
        else:
            df[r["term"]] = r["n"]
    return total, df


def latent_axes(x: np.ndarray, dims: int) -> np.ndarray:
    """Right singular vectors of ``x`` by subspace iteration."""
    rng = np.random.default_rng(SEED)
    k = min(dims, *x.shape)
    y = x @ rng.standard_normal((x.shape[1], min(k + 16, min(x.shape)))).astype(x.dtype)
    for _ in range(4):
        q, _ = np.linalg.qr(y)
        y = x @ (x.T @ q)
    q, _ = np.linalg.qr(y)
    _, _, vt = np.linalg.svd(q.T @ x, full_matrices=False)
    return vt[:k].T


class Model:
    """Vocabulary, weights and axes of the space, and the labelled vectors in it."""

    def __init__(self, vocabulary, idf, axes, vectors, labels):
        self.vocabulary, self.idf, self.axes, self.vectors, self.labels = vocabulary, idf, axes, vectors, labels
        self.place = None

    def __getstate__(self):
        return {**self.__dict__, "place": None}

    def embed(self, docs: int, doc: np.ndarray, code: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Unit vectors of ``docs`` texts from their term rows; zero where no term is known."""
        if self.place is None:
            self.place = np.full(SPACE, -1, np.int32)
            self.place[self.vocabulary] = np.arange(len(self.vocabulary))
        at = self.place[code]
        known = at >= 0
        at, doc, value = at[known], doc[known], weight[known] * self.idf[at[known]]
        out = np.zeros((docs, self.axes.shape[1]))
        edge = np.searchsorted(doc, np.arange(docs + 1))
        for k, (lo, hi) in enumerate(zip(edge[:-1], edge[1:], strict=True)):
            if hi > lo:
                out[k] = value[lo:hi] @ self.axes[at[lo:hi]]
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norm > 0, norm, 1)

    def vote(self, v: np.ndarray) -> np.ndarray:
        """Scores of unit vectors (a block of them at a time)."""
        out = np.full(len(v), self.labels.mean())
        for lo in range(0, len(v), 512):
            cosines = v[lo : lo + 512].astype(np.float32) @ self.vectors.T
            every = np.arange(len(cosines))
            total, yes = np.zeros(len(cosines)), np.zeros(len(cosines))
            for _ in range(min(NEIGHBOURS, cosines.shape[1])):
                near = cosines.argmax(axis=1)
                weight = np.clip(cosines[every, near].astype(float), 0, 1) ** POWER
                total += weight
                yes += weight * self.labels[near]
                cosines[every, near] = -2
            some = total > 1e-12
            out[lo : lo + 512][some] = (yes[some] / total[some]).clip(0, 1)
        return out

    def scores(self, column: pa.Array) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(column), 0.5)
        found = [self.vote(self.embed(docs, doc, code, weight)) for _, docs, doc, code, weight in term_rows(column)]
        return np.concatenate(found) if found else np.zeros(0)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model, worked out on the driver from the sample: one table of sample x vocabulary at most."""
    try:
        return _fitted(docs, _labelled(docs, labels, sample))
    finally:
        give_back()


def _fitted(docs: DataFrame, rows: list) -> Model:
    if not rows:
        none = np.zeros(0)
        return Model(none.astype(np.int64), none, np.zeros((0, 1)), np.zeros((0, 1)), none)
    times = np.zeros(SPACE, np.int64)
    for _, code, _ in rows:
        times[code] += 1  # a text has each code once
    codes = np.flatnonzero(times)
    times = times[codes]
    kept = np.lexsort((codes, -times))[:TERMS]
    vocabulary = np.sort(codes[kept[times[kept] > 1]]) if (times > 1).any() else np.sort(codes[kept])
    n, df = frequencies(docs, vocabulary)
    idf = np.log((n + 1) / (df + 1)) + 1.0
    marks = np.isin(vocabulary, [_AFTER_ITSELF, _PAIR, _LINE])
    idf[marks] = 3.0  # nearly every text has some repetition; how much of it counts
    model = Model(vocabulary, idf, np.eye(1), np.zeros((0, 1)), np.zeros(0))
    x = np.zeros((len(rows), len(vocabulary)), np.float32)
    place = np.full(SPACE, -1, np.int32)
    place[vocabulary] = np.arange(len(vocabulary))
    for k, (_, code, weight) in enumerate(rows):
        at = place[code]
        known = at >= 0
        x[k, at[known]] = weight[known] * idf[at[known]]
    for lo in range(0, len(x), 256):  # the norm of all rows at once takes two more tables like x
        part = x[lo : lo + 256]
        norm = np.linalg.norm(part, axis=1, keepdims=True)
        part /= np.where(norm > 0, norm, 1)
    model.axes = latent_axes(x, DIMS).astype(np.float32)
    del x
    model.labels = np.array([float(label) for label, _, _ in rows])
    model.vectors = np.concatenate([_embedded(model, rows[lo : lo + 256]) for lo in range(0, len(rows), 256)])
    return model


def _embedded(model: Model, rows: list) -> np.ndarray:
    doc = np.repeat(np.arange(len(rows)), [len(c) for _, c, _ in rows])
    codes, weights = (np.concatenate([r[k] for r in rows]) for k in (1, 2))
    return model.embed(len(rows), doc, codes, weights).astype(np.float32)


def score(docs: DataFrame, model: Model, text="text") -> DataFrame:
    """Columns ``c0, c1, ...`` of ``docs`` plus ``score``; the model is broadcast, its size is bound."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    inner, (text,) = neutral(docs, text)
    place = inner.columns.index(text)
    schema = StructType([*inner.schema.fields, StructField("score", DoubleType())])

    def run(batches):
        for batch in batches:
            found = shared.value.scores(batch.column(place))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, "score"])

    return inner.mapInArrow(tidy(run, "quality"), schema)


def op2(spark, docs: DataFrame, labels: DataFrame) -> DataFrame:
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))
    shared = spark.sparkContext.broadcast(fit(base, labels))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.scores(batch.column(1)), pa.float64())], ["doc_id", "score"])

    rows = base.mapInArrow(tidy(run, "quality"), "doc_id long, score double")
    return rows.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents whose score reaches the threshold; labelled rows are learnt from as in ``fit``."""
    return restored(score(docs, fit(docs, labels)).where(F.col("score") >= threshold), docs)
