"""Removal of repeated passages with suffix trees of bounded depth, partitioned by anchors.

A word position with at least ``length`` words from there on starts a suffix.  Suffixes are compared
to a depth of ``length`` words only.  They are dealt out to trees, each small enough for a task:

* An ordinary suffix is dealt by its anchor, the run of ``anchor`` words that has the smallest hash
  within its first ``length`` words.  Neighbouring suffixes mostly share their anchor, so they travel
  as one stretch of positions instead of ``length`` words for each position.
* Where one anchor stands in very many different contexts, the tree would be too large; its suffixes
  are dealt by the whole prefix of ``length`` words.  (A counting pass finds these anchors.  Their
  list is bounded, and only decides how suffixes are dealt, not which are compared.)

Stretches that are equal word by word are merged before any tree is built: the earliest stays, all
others are repeated as a whole.  Only where an anchor has several different stretches their words are
fetched and a tree is built, as sorted suffixes cut to ``length`` words with the lengths of common
prefixes between neighbours.  Its nodes at depth ``length`` are the repeats (there are no deeper ones,
so no maximal repeats); all their suffixes but the earliest start earlier elsewhere.  Repeats longer
than ``length`` come out as runs of such suffixes.

Equality of whole stretches, and of the whole prefixes of crowded anchors, is that of 128 bits of hash.

Scale: the shuffles carry one row for about seven words.  Equal stretches in a batch of rows are
merged before the shuffle, so a passage in a third of all documents sends one row per batch to the
task of its anchor.  Trees are built a group at a time from sorted partitions.

Defined results: null and empty texts have no words; "earlier" means a smaller id, then an earlier
start; null ids come before all others and repeated ids are ordered by a row number of the run (rows
with equal id and text are interchangeable); an empty table gives an empty result; further columns
keep their values.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.stream import group_bounds, sorted_groups
from tallyhouse.llm.words import U64, pieces, runs, scramble, signed
from tallyhouse.session import materialize

LENGTH, ANCHOR = 20, 8
#: From so many stretches on an anchor is crowded; at most so many crowded anchors are listed.
CROWDED, MAX_CROWDED = 4096, 50_000
#: A batch reports anchors that it has in at least so many different contexts.
REPORT = 4


def _stretches(bounds: np.ndarray, words: np.ndarray, length: int, anchor: int):
    """Maximal runs of suffixes with the same anchor: ``first, last`` suffix and ``key``, plus the
    hash of each suffix' first ``length`` words (positions in ``words``)."""
    if len(words) < length:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, U64),) * 2
    of = runs(words, anchor, 11)
    width = length - anchor + 1
    n = len(words) - length + 1
    view = np.lib.stride_tricks.sliding_window_view(of, width)[:n]
    at = np.arange(n) + view.argmin(axis=1)
    valid = np.zeros(n, bool)
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        valid[lo : max(lo, hi - length + 1)] = True
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (at[1:] != at[:-1])
    new[bounds[:-1][bounds[:-1] < n]] = valid[bounds[:-1][bounds[:-1] < n]]
    first = np.flatnonzero(new)
    stop = ~valid
    stop[1:] |= new[1:]
    ends = np.append(np.flatnonzero(stop), n)
    last = ends[np.searchsorted(ends, first, side="right")] - 1
    return first, last, of[at[first]], runs(words, length, 12)


def _content(first, last, windows: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Hash of all words of each stretch, from the hashes of its suffixes."""
    sums = np.zeros(len(windows) + 1, U64)
    np.cumsum(scramble(windows + other), dtype=U64, out=sums[1:])
    with np.errstate(over="ignore"):
        # windows overlap by all but a word: their bag and the first of them fix the order
        return scramble(sums[last + 1] - sums[first] + scramble(windows[first]) * U64(3) + scramble(windows[last]) * U64(5) + (last - first).astype(U64))


def _crowd_pass(length: int, anchor: int):
    def run(batches):
        for batch in batches:
            keys, contents = [], []
            for _, bounds, words in pieces(batch.column(0), lower=False):
                first, last, key, windows = _stretches(bounds, words, length, anchor)
                if len(first):
                    keys.append(key)
                    contents.append(_content(first, last, windows, runs(words, length, 13)))
            if not keys:
                continue
            both = np.unique(np.stack([np.concatenate(keys), np.concatenate(contents)], axis=1), axis=0)
            key, count = np.unique(both[:, 0], return_counts=True)
            keep = count >= REPORT
            yield pa.RecordBatch.from_arrays([pa.array(signed(key[keep])), pa.array(count[keep].astype(np.int64))], ["key", "n"])

    return run, "key long, n long"


def _deal_pass(length: int, anchor: int, crowded: np.ndarray):
    """Stretches as ``key, content, doc, start, n, state``: state 1 is known to be repeated."""
    names = ["key", "content", "doc", "start", "n", "state"]

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            parts = []
            for row, bounds, words in pieces(batch.column(1), lower=False):
                first, last, key, windows = _stretches(bounds, words, length, anchor)
                if not len(first):
                    continue
                other = runs(words, length, 13)
                content = _content(first, last, windows, other)
                count = last - first + 1
                if len(crowded):
                    k = signed(key)
                    full = crowded[np.minimum(np.searchsorted(crowded, k), len(crowded) - 1)] == k
                    if full.any():  # suffix by suffix, dealt by all its first words
                        times = np.where(full, count, 1)
                        source = np.repeat(np.arange(len(first)), times)
                        step = np.arange(len(source)) - np.repeat(np.cumsum(times) - times, times)
                        single = full[source]
                        first = first[source] + step
                        key = np.where(single, scramble(windows[first]), key[source])
                        content = np.where(single, other[first], content[source])
                        count = np.where(single, 1, count[source])
                doc = np.searchsorted(bounds, first, side="right") - 1
                parts.append((signed(key), signed(content), ids[row + doc], first - bounds[doc], count))
            if not parts:
                continue
            key, content, doc, start, count = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((start, doc, content, key))
            key, content, doc, start, count = (x[order] for x in (key, content, doc, start, count))
            again = np.zeros(len(key), np.int8)
            again[1:] = (key[1:] == key[:-1]) & (content[1:] == content[:-1])
            # what is repeated for certain passes through, spread by its document
            key = np.where(again == 1, signed(scramble(doc.astype(np.int64).view(U64))), key)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(content), pa.array(doc), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(again)], names
            )

    return run, "key long, content long, doc long, start int, n int, state byte"


def _merge(batches):
    """Rows sorted by state, key, content, doc, start: the first of equal stretches stays (state 2
    if its key has others too, which need a tree), the rest is repeated (state 1)."""
    for table in sorted_groups(batches, ["state", "key"]):
        state = table.column("state").to_numpy().copy()
        at = group_bounds(table, ["state", "key"])
        content = table.column("content").to_numpy()
        new = np.ones(len(content), bool)
        new[1:] = content[1:] != content[:-1]
        new[at[:-1]] = True
        kinds = np.add.reduceat(new.astype(np.int64), at[:-1])
        several = np.repeat(kinds > 1, np.diff(at))
        fresh = state == 0
        state[fresh & ~new] = 1
        state[fresh & new & several] = 2
        keep = state > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(table.column(c).to_numpy()[keep]) for c in ("key", "doc", "start", "n")] + [pa.array(state[keep])], ["key", "doc", "start", "n", "state"]
        )


def _fetch_pass(length: int):
    """Word hashes of stretches that need a tree."""

    def run(batches):
        for batch in batches:
            ids, asked = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            rows = []
            for row, bounds, words in pieces(batch.column(1), lower=False):
                for k in range(len(bounds) - 1):
                    own = words[bounds[k] : bounds[k + 1]]
                    for a in asked[row + k]:
                        lo = a["start"]
                        rows.append((a["key"], ids[row + k], lo, a["n"], own[lo : lo + a["n"] + length - 1].tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()], strict=True)],
                    ["key", "doc", "start", "n", "words"],
                )

    return run, "key long, doc long, start int, n int, words binary"


def tree_repeats(words: list[np.ndarray], counts: np.ndarray, group: np.ndarray, doc: np.ndarray, start: np.ndarray, length: int):
    """Suffixes that start earlier elsewhere in the trees of their groups: ``doc, start``.

    The trees are given by sorted suffixes and the common prefix of neighbours; a node at depth
    ``length``, the deepest there is, is a maximal run of neighbours with that much in common.
    """
    depth = np.concatenate([np.lib.stride_tricks.sliding_window_view(w, length)[:c] for w, c in zip(words, counts, strict=True)])
    group = np.repeat(group, counts)
    offset = np.arange(len(group)) - np.repeat(np.cumsum(counts) - counts, counts)
    doc, start = np.repeat(doc, counts), np.repeat(start, counts) + offset
    order = np.lexsort((start, doc, *depth.T[::-1], group))
    depth, group, doc, start = depth[order], group[order], doc[order], start[order]
    same = depth[1:] == depth[:-1]
    common = np.where(same.all(axis=1), length, same.argmin(axis=1))
    inner = np.zeros(len(group), bool)
    inner[1:] = (common >= length) & (group[1:] == group[:-1])
    return doc[inner], start[inner]  # all of a node but its first


def _tree_pass(length: int):
    def run(batches):
        for table in sorted_groups(batches, ["key"]):
            at = group_bounds(table, ["key"])
            group = np.repeat(np.arange(len(at) - 1), np.diff(at))
            column = table.column("words")
            counts, doc, start = (table.column(c).to_numpy().astype(np.int64) for c in ("n", "doc", "start"))
            ends = np.cumsum(counts)
            lo = 0
            while lo < len(at) - 1:  # whole groups, together about a quarter of a million suffixes
                base = ends[at[lo] - 1] if at[lo] else 0
                hi = lo + 1
                while hi < len(at) - 1 and ends[at[hi + 1] - 1] - base <= 250_000:
                    hi += 1
                a, b = at[lo], at[hi]
                words = [np.frombuffer(column[int(k)].as_py(), U64) for k in range(a, b)]
                d, s = tree_repeats(words, counts[a:b], group[a:b], doc[a:b], start[a:b], length)
                yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(s.astype(np.int32)), pa.array(np.ones(len(d), np.int32))], ["doc", "start", "n"])
                lo = hi

    return run, "doc long, start int, n int"


def repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """``doc, start, n``: runs of suffixes that start earlier elsewhere; ``docs`` has ``doc, text``."""
    run, schema = _crowd_pass(length, anchor)
    counted = docs.select("text").mapInArrow(run, schema).groupBy("key").agg(F.sum("n").alias("n"))
    listed = counted.where(F.col("n") >= CROWDED).orderBy(F.desc("n"), "key").limit(MAX_CROWDED).collect()
    crowded = np.array(sorted(r["key"] for r in listed), np.int64)

    run, schema = _deal_pass(length, anchor, crowded)
    dealt = docs.select("doc", "text").mapInArrow(run, schema)
    merged = (
        dealt.repartition("key")
        .sortWithinPartitions("state", "key", "content", "doc", "start")
        .mapInArrow(_merge, "key long, doc long, start int, n int, state byte")
    )
    merged = materialize(merged, "substrings-stretches")

    asked = merged.where("state = 2").groupBy("doc").agg(F.collect_list(F.struct("key", "start", "n")).alias("asked"))
    run, schema = _fetch_pass(length)
    fetched = docs.select("doc", "text").join(asked, "doc").select("doc", "text", "asked").mapInArrow(run, schema)
    run, schema = _tree_pass(length)
    found = fetched.repartition("key").sortWithinPartitions("key").mapInArrow(run, schema)
    return merged.where("state = 1").select("doc", "start", "n").unionByName(found)


def _cut_pass(length: int, texts: bool):
    """Words that no run covers."""

    def run(batches):
        for batch in batches:
            out = []
            ids, column, spans = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for i, text, found in zip(ids, column, spans, strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                n, removed = len(words), 0
                if found:
                    edge = np.zeros(n + 1, np.int64)
                    lo = np.array([f["start"] for f in found])
                    hi = lo + np.array([f["n"] for f in found]) + length - 1
                    np.add.at(edge, lo, 1)
                    np.add.at(edge, hi, -1)
                    keep = np.cumsum(edge[:n]) == 0
                    removed = n - int(keep.sum())
                    words = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
                kept = b" ".join(words)
                out.append((i, n, removed, kept.decode("utf-8", "surrogatepass") if texts else hashlib.sha256(kept).hexdigest()))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64(), pa.int64(), pa.int64(), pa.string()], strict=True)], ["doc", "n_words", "n_removed", "kept"]
                )

    return run, "doc long, n_words long, n_removed long, kept string"


def _numbered(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame | None]:
    """``doc, text`` with ``doc`` unique and in the order of the ids; the ids themselves serve where
    they are unique, else rows are numbered (``doc, id``)."""
    base = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    odd = base.groupBy("id").count().where("count > 1 or id is null").limit(1).count()
    if not odd:
        return base.select(F.col("id").alias("doc"), "text"), None
    base = base.withColumn("tie", F.xxhash64("text"))
    order = [F.col("id").asc_nulls_first(), F.col("tie").asc_nulls_first()]
    # row numbers of a run grow with the partition, and within it
    ordered = base.repartitionByRange(*order).sortWithinPartitions(*order)
    named = materialize(ordered.select(F.monotonically_increasing_id().alias("doc"), "id", "text"), "substrings-rows")
    return named.select("doc", "text"), named.select("doc", "id")


def remove_repeats(docs: DataFrame, text="text", doc_id="doc_id", length: int = LENGTH, anchor: int = ANCHOR, texts: bool = True) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: the words that no repeated window covers, joined by
    spaces (or their SHA-256, with ``texts=False``)."""
    base, names = _numbered(docs, doc_id, text)
    runs_of = repeats(base, length, anchor).groupBy("doc").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    run, schema = _cut_pass(length, texts)
    out = base.join(runs_of, "doc", "left").select("doc", "text", "spans").mapInArrow(run, schema)
    if names is not None:
        out = out.join(names, "doc").drop("doc").withColumnRenamed("id", "doc")
    return out.select(F.col("doc").alias("doc_id"), "n_words", "n_removed", "kept")


def op6(spark, docs: DataFrame) -> DataFrame:
    return remove_repeats(docs, texts=False).withColumnRenamed("kept", "kept_sha256")


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 19], ' ')) AS h
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d WHERE len(w) >= 20)),
y AS (SELECT doc_id, p, row_number() OVER (PARTITION BY h ORDER BY doc_id, p) AS k FROM x),
g AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS q FROM y WHERE k > 1),
t AS (SELECT doc_id, w[q] AS word, q FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS q FROM d)),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY q) AS kept, count(*) AS n
      FROM t ANTI JOIN g USING (doc_id, q) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
