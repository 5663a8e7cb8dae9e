"""Prefix trie of conversations by range minima over sorted common prefixes.

1. Every conversation is a sequence of turn digests.  All are sorted, so the conversations below a
   node of the trie stand side by side, and ``lcp`` holds how many turns neighbours have in common.
2. Blocks of the sorted sequences are handled one by one, each with its neighbours' sequences.  A sparse
   table gives the minimum of any stretch of ``lcp``.  Every candidate prefix, a sequence cut to a depth
   at which it differs from the one before, searches its left and right extents by halving, each for
   itself, with no stack.  The extent gives members; sums and minima over it give the rest.
3. A prefix that reaches over the edge of a block is one of the few prefixes of the block's first or last
   sequence.  Its parts are summed by prefix; the words saved below it are summed over such
   prefixes along each block's edge.

Scale: sequences are 16 bytes a turn, texts are read once.  Ranges are cut by (sequence, conversation), so
copies of one conversation and conversations that share their first turns fill many blocks.  A block
holds about ``BLOCK_TURNS`` turns, and a conversation is held whole.  The digest over the conversations that end at a
node is one stream; its pieces are joined in the blocks.

Defined results: rows without a conversation id take no part; null turns come first, rows of the same turn are
ordered by digest; null role or text is empty; a conversation that is rebuilt without turns is a member
of the root; no conversations give no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyhouse.llm.base import SPACE_WORD
from tallyhouse.llm.order import placed
from tallyhouse.llm.sqltext import CRC_TABLE, crc32_sql
from tallyhouse.llm.stream import group_bounds, sorted_groups
from tallyhouse.session import materialize

TURN_BYTES = 16
#: Turns of a block of sorted sequences, counting one more for every conversation.
BLOCK_TURNS = 500_000
#: Bytes of ids joined to one piece.
PIECE = 1 << 20
FAMILY, HEADS = 20, 4
NO_ENDS = hashlib.sha256(b"").hexdigest()


# ---------------------------------------------------------------- sequences


def sequences(rows: DataFrame) -> DataFrame:
    """``conv_id, turns`` of every conversation, turns in order as (turn, digest, words)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    turn = F.struct("turn", F.substring(digest, 1, 2 * TURN_BYTES).alias("digest"), F.regexp_count(text, F.lit(SPACE_WORD)).alias("words"))
    known = rows.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("at"))
    return known.groupBy("conv_id").agg(F.sort_array(F.collect_list("at")).alias("turns"))


def rebuilt(own: DataFrame) -> DataFrame:
    """Conversations whose first turns are those of the first conversation of their family of twenty."""
    heads = own.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("head"))
    taken = (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")
    both = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).join(heads, "base", "left")
    none = F.slice("turns", F.lit(1), F.lit(0))
    head = F.slice(F.coalesce("head", none), F.lit(1), taken)
    return both.select("conv_id", F.concat(head, F.slice("turns", taken + 1, F.size("turns"))).alias("turns"))


def keyed(convs: DataFrame) -> DataFrame:
    """``conv_id, key, words``: keys sort like sequences of turns, and a prefix before what it begins."""
    return convs.select("conv_id", F.unhex(F.array_join("turns.digest", "")).alias("key"), F.col("turns.words").alias("words"))


# ---------------------------------------------------------------- range minima


class Minima:
    """Sparse table of the minima of all stretches of ``values``."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            half = 1 << (len(self.levels) - 1)
            below = self.levels[-1]
            self.levels.append(np.minimum(below[:-half], below[half:]))

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minimum of ``values[lo..hi]``, ends included."""
        out = np.empty(len(lo), self.levels[0].dtype)
        level = np.frexp((hi - lo + 1).astype(float))[1] - 1
        for k in np.unique(level):
            at = level == k
            t = self.levels[k]
            out[at] = np.minimum(t[lo[at]], t[hi[at] - (1 << int(k)) + 1])
        return out

    def right(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The last ``r`` with all of ``values[start + 1..r]`` at least ``least``."""
        at, n = start.copy(), len(self.levels[0])
        for k in range(len(self.levels) - 1, -1, -1):
            t, step = self.levels[k], 1 << k
            fits = at + step < n
            ok = np.zeros(len(at), bool)
            ok[fits] = t[at[fits] + 1] >= least[fits]
            at[ok] += step
        return at

    def left(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The first ``l`` with all of ``values[l + 1..start]`` at least ``least``; -1 if ``values[0]`` is as well."""
        at = start.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            t, step = self.levels[k], 1 << k
            fits = at - step >= -1
            ok = np.zeros(len(at), bool)
            ok[fits] = t[at[fits] - step + 1] >= least[fits]
            at[ok] -= step
        return at


def common_turns(turn: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """How many turns each sequence has in common with the one before (from the second on)."""
    both = np.minimum(length[1:], length[:-1])
    out = np.zeros(len(both), np.int64)
    active = np.flatnonzero(both > 0)
    for d in range(64):
        if not len(active):
            return out
        same = (turn[first[active] + d] == turn[first[active + 1] + d]).all(axis=1)
        active = active[same]
        out[active] = d + 1
        active = active[both[active] > d + 1]
    for i in active.tolist():
        a, b, n = int(first[i]), int(first[i + 1]), int(both[i])
        differ = (turn[a : a + n] != turn[b : b + n]).any(axis=1)
        out[i] = int(differ.argmax()) if differ.any() else n
    return out


# ---------------------------------------------------------------- a block

NODE = pa.schema(
    [
        ("kind", pa.int32()),
        ("node", pa.binary()),
        ("parent", pa.binary()),
        ("parent_conv_id", pa.int64()),
        ("conv_id", pa.int64()),
        ("depth", pa.int64()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved_tokens", pa.int64()),
        ("words", pa.int64()),
        ("ends", pa.string()),
        ("part", pa.int64()),
        ("piece", pa.int64()),
        ("last", pa.bool_()),
        ("starts", pa.bool_()),
    ]
)
NODE_TYPES = (
    "kind int, node binary, parent binary, parent_conv_id long, conv_id long, depth long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, words long, ends string, part long, piece long, last boolean, starts boolean"
)
WHOLE, PART, ENDS = 0, 1, 2


def rows_of(kind: int, n: int, **columns) -> pa.RecordBatch:
    made = [pa.array(np.full(n, kind, np.int32)) if f.name == "kind" else columns.get(f.name) for f in NODE]
    made = [pa.nulls(n, f.type) if c is None else c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(made, NODE, strict=True)]
    return pa.RecordBatch.from_arrays(made, schema=NODE)


def prefix_names(key: bytes, depths: int) -> list[bytes]:
    """Names of the prefixes of 0, 1, ..., ``depths`` turns."""
    state, out = hashlib.sha256(), []
    for d in range(depths + 1):
        out.append(state.digest()[:TURN_BYTES])
        state.update(key[d * TURN_BYTES : (d + 1) * TURN_BYTES])
    return out


def _flat(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


class Block:
    """Sorted sequences with the neighbours' ones; positions are those of different sequences."""

    def __init__(self, table: pa.Table):
        kind = table.column("kind").to_numpy()
        keys = _flat(table.column("key").cast(pa.large_binary()))
        offsets = np.frombuffer(keys.buffers()[1], np.int64)[keys.offset : keys.offset + len(keys) + 1]
        data = keys.buffers()[2]
        turn = np.frombuffer(data if data is not None and offsets[-1] else b"", np.uint64, count=int(offsets[-1]) // 8).reshape(-1, 2)
        first, length = offsets[:-1] // TURN_BYTES, np.diff(offsets) // TURN_BYTES
        lcp = common_turns(turn, first, length)
        rows = np.flatnonzero(kind == 1)
        lo, hi = int(rows[0]), int(rows[-1])
        # row i is a position of its own if it differs from the row before it in the block
        own = np.ones(len(rows), bool)
        own[1:] = ~((lcp[lo:hi] == length[lo:hi]) & (length[lo:hi] == length[lo + 1 : hi + 1]))
        self.at = np.append(np.flatnonzero(own), len(rows))  # first row of each position
        self.m = len(self.at) - 1
        head = rows[self.at[:-1]]
        self.length = length[head]
        before = int(lcp[lo - 1]) if lo > 0 else -1
        after = int(lcp[hi]) if hi + 1 < len(kind) else -1
        self.lcp = np.concatenate([[before], lcp[head[1:] - 1], [after]]).astype(np.int64)
        self.conv = table.column("conv_id").to_numpy()[lo : hi + 1].astype(np.int64)
        words = _flat(table.column("words")).slice(lo, hi - lo + 1)
        self.words = words.flatten().to_numpy().astype(np.int64)
        self.word_at = np.concatenate([[0], np.cumsum(length[lo : hi + 1])])[self.at[:-1]]
        self.first_key, self.last_key = keys[lo].as_py(), keys[hi].as_py()
        self.keys, self.head = keys, head
        self.smallest = Minima(np.minimum.reduceat(self.conv, self.at[:-1]))
        self.minima = Minima(self.lcp)
        leaf = self.lcp[1:] < self.length
        self.members = np.concatenate([[0], np.cumsum(np.diff(self.at))])
        self.leaves = np.concatenate([[0], np.cumsum(leaf)])
        # positions by what they share with the one before: counts of children are two searches
        self.codes = np.sort(self.lcp[: self.m] * (self.m + 2) + np.arange(self.m))

    def children(self, lo: np.ndarray, hi: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Prefixes of ``depth + 1`` turns that begin at ``lo..hi``."""
        code = depth * (self.m + 2)
        later = np.searchsorted(self.codes, code + hi, "right") - np.searchsorted(self.codes, code + lo, "right")
        return later + ((self.length[lo] > depth) & (self.lcp[lo] <= depth))

    def last_words(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.int64)
        deep = depth > 0
        out[deep] = self.words[self.word_at[at[deep]] + depth[deep] - 1]
        return out

    def ids(self, position: int) -> np.ndarray:
        return self.conv[self.at[position] : self.at[position + 1]]

    def run(self, part: int) -> Iterator[pa.RecordBatch]:
        m, lcp = self.m, self.lcp
        count = np.maximum(self.length - lcp[:m], 0)
        begin = np.concatenate([[0], np.cumsum(count)])
        start = np.repeat(np.arange(m), count)
        depth = np.arange(len(start)) - np.repeat(begin[:-1], count) + np.repeat(lcp[:m], count) + 1
        right = self.minima.right(start, depth)
        whole = right < m
        words = self.last_words(start, depth)
        end = np.minimum(right, m - 1)
        members = self.members[end + 1] - self.members[start]
        saved = np.concatenate([[0], np.cumsum(np.where(whole, (members - 1) * words, 0))])

        # nodes that end inside the block
        index = np.flatnonzero(whole)
        s, d, e = start[whole], depth[whole], end[whole]
        up_left, up_right = self.minima.left(s, d - 1), self.minima.right(s, d - 1)
        known = (up_left >= 0) & (up_right < m) & (d > 0)
        parent = np.zeros(len(s), np.int64)
        parent[known] = self.smallest.least(up_left[known], up_right[known])
        names_first = prefix_names(self.first_key, max(int(lcp[0]), 0))
        names_last = prefix_names(self.last_key, max(int(lcp[m]), 0))
        parent_name: list[bytes | None] = [None] * len(s)
        for k in np.flatnonzero(~known & (d > 0)).tolist():
            parent_name[k] = names_first[d[k] - 1] if up_left[k] < 0 else names_last[d[k] - 1]
        ends = [NO_ENDS] * len(s)
        for k in np.flatnonzero(self.length[s] == d).tolist():
            ends[k] = hashlib.sha256(",".join(map(str, self.ids(int(s[k])).tolist())).encode()).hexdigest()
        yield rows_of(
            WHOLE,
            len(s),
            parent=parent_name,
            parent_conv_id=pa.array(parent, pa.int64(), mask=~known),
            conv_id=self.smallest.least(s, e),
            depth=d,
            n_convs=members[whole],
            n_children=self.children(s, e, d),
            n_leaves=self.leaves[e + 1] - self.leaves[s],
            saved_tokens=saved[begin[e + 1]] - saved[index],
            ends=ends,
        )

        # parts of prefixes that reach over an edge: prefixes of the first and of the last sequence
        d1 = np.arange(int(lcp[0]) + 1)
        r1 = self.minima.right(np.zeros(len(d1), np.int64), d1)
        d2 = np.arange(int(lcp[m]) + 1)
        l2 = self.minima.left(np.full(len(d2), m - 1), d2)
        new = l2 >= 0  # else the prefix spans the block and is among the first ones
        lo = np.concatenate([np.zeros(len(d1), np.int64), l2[new]])
        hi = np.concatenate([np.minimum(r1, m - 1), np.full(int(new.sum()), m - 1)])
        d = np.concatenate([d1, d2[new]])
        names = [names_first[k] for k in d1.tolist()] + [names_last[k] for k in d2[new].tolist()]
        above = [names_first[k - 1] if k else None for k in d1.tolist()] + [names_last[k - 1] if k else None for k in d2[new].tolist()]
        if not len(d):
            return
        yield rows_of(
            PART,
            len(d),
            node=names,
            parent=above,
            conv_id=self.smallest.least(lo, hi),
            depth=d,
            n_convs=self.members[hi + 1] - self.members[lo],
            n_children=self.children(lo, hi, d),
            n_leaves=self.leaves[hi + 1] - self.leaves[lo],
            saved_tokens=saved[begin[hi + 1]] - saved[begin[lo]],
            words=self.last_words(lo, d),
            part=np.full(len(d), part),
            last=np.concatenate([r1 >= m, np.ones(int(new.sum()), bool)]),
            starts=self.lcp[lo] < d,
        )
        for k in np.flatnonzero(self.length[lo] == d).tolist():
            for n, text in enumerate(joined_ids(self.ids(int(lo[k])))):
                yield rows_of(ENDS, 1, node=[names[k]], part=[part], piece=[n], ends=[text])


def joined_ids(ids: np.ndarray) -> Iterator[str]:
    step = PIECE // 20
    for lo in range(0, len(ids), step):
        yield ",".join(map(str, ids[lo : lo + step].tolist()))


def _block_pass(batches):
    for table in sorted_groups(batches, ["part"]):
        at = group_bounds(table, ["part"])
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            yield from Block(table.slice(lo, hi - lo).combine_chunks()).run(table.column("part")[lo].as_py())


def _ends_pass(batches):
    """One digest a node over its pieces, which come in order; nothing but the state is kept."""
    name, state = None, None
    for batch in batches:
        nodes, digests = [], []
        for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if node != name:
                if state is not None:
                    nodes.append(name)
                    digests.append(state.hexdigest())
                name, state = node, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(digests, pa.string())], ["node", "digest"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["node", "digest"])


# ---------------------------------------------------------------- the trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(seqs: DataFrame) -> DataFrame:
    """The nodes over ``conv_id, key, words``."""
    seqs = materialize(seqs, "trie-sequences")
    turns = seqs.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    rows = placed(seqs, ["key", "conv_id"], "trie-sorted", max(1, -(-turns // BLOCK_TURNS)))
    # each block with the last sequence before it and the first one after it; one row a block
    edges = rows.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    order = Window.orderBy("part")
    edges = edges.select("part", F.lag("high").over(order).alias("before"), F.lead("low").over(order).alias("after"))
    columns = ["part", "kind", "key", "conv_id", "words"]
    inner = rows.withColumn("kind", F.lit(1)).select(*columns)
    outer = [
        edges.where(F.col(side).isNotNull()).select(
            "part", F.lit(kind).alias("kind"), F.col(side).alias("key"), F.lit(None).cast("bigint").alias("conv_id"), F.lit(None).cast("array<int>").alias("words")
        )
        for kind, side in ((0, "before"), (2, "after"))
    ]
    blocks = inner.unionByName(outer[0]).unionByName(outer[1]).repartition("part").sortWithinPartitions("part", "kind", "key", "conv_id")
    made = materialize(blocks.mapInArrow(_block_pass, NODE_TYPES), "trie-nodes")

    parts = made.where(F.col("kind") == PART)
    cut = parts.groupBy("node").agg(
        F.min("parent").alias("parent"),
        F.min("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("words").alias("words"),
    )
    cut = materialize(cut, "trie-cut")
    own = ((F.col("n_convs") - 1) * F.col("words")).alias("own")
    deeper = Window.partitionBy("part").orderBy(F.desc("depth"))
    along = parts.where("last").select("node", "part", "depth", "starts").join(cut.select("node", own), "node")
    along = along.withColumn("below", F.sum(F.when(F.col("starts"), F.col("own")).otherwise(0)).over(deeper))
    along = along.groupBy("node").agg(F.sum("below").alias("below"))
    pieces = made.where(F.col("kind") == ENDS).select("node", "part", "piece", "ends").repartition("node")
    digests = pieces.sortWithinPartitions("node", "part", "piece").select("node", "ends").mapInArrow(_ends_pass, "node binary, digest string")
    names = cut.select(F.col("node").alias("parent"), F.col("conv_id").alias("cut_parent"))
    over = (
        cut.join(along, "node", "left")
        .join(digests, "node", "left")
        .join(names, "parent", "left")
        .withColumn("parent_conv_id", F.col("cut_parent"))
        .withColumn("saved_tokens", F.col("saved_tokens") + F.coalesce("below", F.lit(0)))
        .withColumn("ends_sha256", F.coalesce("digest", F.lit(NO_ENDS)))
    )
    inside = (
        made.where(F.col("kind") == WHOLE)
        .join(names, "parent", "left")
        .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "cut_parent"))
        .withColumn("ends_sha256", F.col("ends"))
    )
    return inside.select(*COLUMNS).unionByName(over.select(*COLUMNS))


def op13(spark, conversations: DataFrame) -> DataFrame:
    return trie(keyed(rebuilt(sequences(conversations))))


SQL = f"""
WITH {CRC_TABLE},
c AS (SELECT conv_id, turn, sha256(strlen(role)::VARCHAR || ':' || role || text) AS digest, len(regexp_extract_all(text, '{SPACE_WORD}')) AS words
      FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS k FROM c),
i AS (SELECT conv_id, {crc32_sql("conv_id::VARCHAR")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM c), crc_table),
b AS (SELECT i.conv_id, 0 AS half, k, digest, words FROM i JOIN o ON o.conv_id = i.conv_id - i.conv_id % 20 AND o.k <= i.h
      UNION ALL SELECT i.conv_id, 1, k, digest, words FROM i JOIN o ON o.conv_id = i.conv_id AND o.k > i.h),
s AS (SELECT conv_id, list(digest ORDER BY half, k) AS s, list(words ORDER BY half, k) AS w FROM b GROUP BY conv_id),
q AS (SELECT i.conv_id, coalesce(s, []) AS s, coalesce(w, []) AS w FROM i LEFT JOIN s USING (conv_id)),
p AS (SELECT conv_id, len(s) AS turns, d, array_to_string(s[1:d], '') AS path, CASE WHEN d > 0 THEN w[d] ELSE 0 END AS words
      FROM (SELECT conv_id, s, w, unnest(range(0, len(s) + 1)) AS d FROM q)),
n AS (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (turns = d), '')) AS ends
      FROM p GROUP BY path, d),
k AS (SELECT left(path, 64 * (d - 1)) AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
x AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (path)),
t AS (SELECT left(path, 64 * a) AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * words) AS saved
      FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM x) GROUP BY 1)
SELECT x.conv_id, x.d AS depth, up.conv_id AS parent_conv_id, x.n_convs, x.n_children, t.n_leaves, t.saved::BIGINT AS saved_tokens, x.ends AS ends_sha256
FROM x JOIN t USING (path) LEFT JOIN x AS up ON x.d > 0 AND up.path = left(x.path, 64 * (x.d - 1))
"""
