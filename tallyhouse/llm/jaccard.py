"""Jaccard join of word-shingle sets with a token-group matrix.

1. ``sets``: every text becomes its set of distinct shingle hashes.  Equal sets are one class, named
   by its smallest id.
2. Keys: with the tokens in one order for all sets, a set's first tokens are its keys; so many that
   linked sets have at least ``common`` keys in common (``SPARE`` percent of the tokens).  The order is that of the hash,
   but for crowded tokens, which come last: a passage that very many documents share is a key
   only of documents that hold little else.  Keys that one document has alone are dropped.
3. Token-group matrix: the smallest document with a key leads it, and a document's home group is that
   of the leader it shares most keys with.  The matrix has one row for each key and group whose members
   have it: the group's union of keys, as rows.  Joined with a document's keys it gives
   the overlap of the document with every group's union, a bound on its overlap with each member.  Only groups
   that reach the document's ``common`` are opened; a document opens groups with smaller names than its own.
4. Opened groups: whole sets meet, in blocks.  In a group of many blocks every block is compared with
   itself and the group's leader first.  Documents that turn out to be in the leader's class are
   not compared with each other any more; only the rest meets the other blocks.
   Within a block a matrix of unions over rows of ``ROW`` neighbours decides what is compared.
   A spanning forest of the links goes out, never all pairs.
5. Components of the forest give the classes of near duplicates.

Scale: keys are a quarter to a third of the tokens at a similarity of 0.8.  Crowded tokens come from counters over all rows
(a table of fixed size, so a token may be taken for crowded that is not; that only changes the order).
Crowded keys are split into salted groups.  The texts of documents that open groups are fetched by a
join whose other side is thinned by a bit table of fixed size.  A unit of comparison is one block or two, and is held one
at a time.  Written tables are deleted after their last reader.

Defined results: null and empty texts and texts without words have the empty set, which is linked
with nothing; rows that repeat an id are one node with all their sets; a null id has no component;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyhouse.llm.base import discard, neutral, restored, tidy
from tallyhouse.llm.components import connected_components
from tallyhouse.llm.stream import group_bounds, sorted_groups
from tallyhouse.llm.words import U64, pieces, runs, scramble, signed
from tallyhouse.session import materialize

#: Words of a shingle; linked if 100 * intersection >= PERCENT * union.
SHINGLE, PERCENT = 5, 80
#: Percent of a set's tokens that linked sets have in common among their keys, at least.
SPARE = 5
#: A token counts as crowded from so many rows on (and eight times the mean of all counters).
CROWD, COUNTERS, SALTS = 2048, 1 << 20, 16
CHUNK = 4096
#: Bits that thin out the documents before their texts are fetched.
BITS = 1 << 25
#: Visits that are broadcast to the texts; more of them go to the texts by a shuffle.
FEW = 50_000
#: Documents and tokens of a block, documents of a row of the matrix.
BLOCK_DOCS, BLOCK_TOKENS, ROW = 1024, 1_000_000, 32


# ---------------------------------------------------------------- sets


def shingle_sets(column: pa.Array, shingle: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, sorted distinct shingle hashes)`` of every text."""
    for row, bounds, hashes in pieces(column, lower=True):
        whole = runs(hashes, shingle, 71)
        for k in range(len(bounds) - 1):
            lo, hi = int(bounds[k]), int(bounds[k + 1])
            if hi - lo >= shingle:
                yield row + k, np.unique(whole[lo : hi - shingle + 1])
            elif hi > lo:  # the whole sequence; the seed tells the lengths apart
                yield row + k, runs(hashes[lo:hi], hi - lo, 1000 + hi - lo)
            else:
                yield row + k, np.zeros(0, U64)


def _digest(tokens: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        a, b = scramble(tokens), scramble(tokens + U64(0x5851F42D4C957F2D))
        mix = scramble(np.array([a.sum(dtype=U64), b.sum(dtype=U64) + U64(len(tokens))], U64))
    return tuple(int(x) for x in signed(mix))


# ---------------------------------------------------------------- keys


def keys_of(n: int, percent: int) -> tuple[int, int]:
    """How many of ``n`` tokens are keys, and how many of them any linked set has as well, at least.

    Linked sets share at least ``need`` tokens.  Of those, the first ``common`` in the order stand among
    the first ``n - need + common`` of either set.
    """
    need = -(-percent * n // 100)
    if need == n and 100 * n // percent == n:
        return 0, 1  # only equal sets are linked here, and these are one class
    common = max(1, min(need, SPARE * n // 100))
    return n - need + common, common


def _first_pass(shingle: int, percent: int):
    """A row for every text, and what each task counted of tokens."""
    schema = pa.schema(
        [("kind", pa.int32()), ("id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("common", pa.int64()), ("data", pa.binary())]
    )

    def frame(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema, strict=True)], schema=schema)

    def run(batches):
        counters = np.zeros(COUNTERS, np.uint32)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = []
            for row, tokens in shingle_sets(batch.column(1), shingle):
                rows.append((0, ids[row], len(tokens), *_digest(tokens), keys_of(len(tokens), percent)[1], None))
                slots, times = np.unique((tokens & U64(COUNTERS - 1)).astype(np.int64), return_counts=True)
                counters[slots] += times.astype(np.uint32)
            if rows:
                yield frame(rows)
        if counters.any():
            yield frame([(1, at, 0, 0, 0, 0, zlib.compress(counters[at : at + CHUNK].tobytes(), 1)) for at in range(0, COUNTERS, CHUNK)])

    return tidy(run), "kind int, id long, n long, d1 long, d2 long, common long, data binary"


def _crowded_pass(least: float):
    """Which counters of a chunk reach ``least`` over all tasks; tasks' rows come one after the other."""

    def run(batches):
        at, total = None, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([np.packbits(total >= least).tobytes()], pa.binary())], ["id", "bits"])

        for batch in batches:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if chunk != at:
                    if at is not None:
                        yield done()
                    at, total = chunk, np.zeros(CHUNK, np.uint64)
                total += np.frombuffer(zlib.decompress(data), np.uint32)
        if at is not None:
            yield done()

    return tidy(run), "id long, bits binary"


def crowded_tokens(first: DataFrame) -> bytes:
    """The counters of crowded tokens, as bits."""
    total = first.where("kind = 0").agg(F.sum("n")).first()[0] or 0
    run, schema = _crowded_pass(max(CROWD, 8 * total / COUNTERS))
    chunks = first.where("kind = 1").select("id", "data").repartition("id").sortWithinPartitions("id").mapInArrow(run, schema).collect()
    out = bytearray(COUNTERS // 8)
    for r in chunks:
        out[r["id"] // 8 : (r["id"] + CHUNK) // 8] = r["bits"]
    return bytes(out)


def _key_pass(shingle: int, percent: int, crowded: bytes):
    """Keys of every document; of equal sets in a batch only the first gives keys."""

    def run(batches):
        full = np.unpackbits(np.frombuffer(crowded, np.uint8)).astype(bool)
        for batch in batches:
            ids = np.array([-1 if x is None else x for x in batch.column(0).to_pylist()], np.int64)
            known = np.array([x is not None for x in batch.column(0).to_pylist()], bool)
            seen: set[tuple[int, int]] = set()
            keys, docs, heavy, sizes = [], [], [], []
            found = {row: tokens for row, tokens in shingle_sets(batch.column(1), shingle) if len(tokens) and known[row]}
            for row in sorted(found, key=lambda r: ids[r]):
                tokens = found[row]
                n = len(tokens)
                take = keys_of(n, percent)[0]
                d = _digest(tokens)
                if take == 0 or d in seen:
                    continue
                seen.add(d)
                hot = full[(tokens & U64(COUNTERS - 1)).astype(np.int64)]
                if hot.any():
                    order = np.argsort(hot, kind="stable")[:take]
                    tokens, hot = tokens[order], hot[order]
                keys.append(tokens[:take])
                heavy.append(hot[:take])
                docs.append(np.full(take, ids[row]))
                sizes.append(np.full(take, n, np.int32))
            if not keys:
                continue
            key, doc, hot = signed(np.concatenate(keys)), np.concatenate(docs), np.concatenate(heavy)
            salt = np.zeros(len(key), np.int32)
            salt[hot] = (scramble(doc[hot].view(U64)) % U64(SALTS)).astype(np.int32)
            columns = [pa.array(key), pa.array(salt), pa.array(doc), pa.array(hot), pa.array(np.concatenate(sizes))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "salt", "doc", "heavy", "n"])

    return tidy(run), "key long, salt int, doc long, heavy boolean, n int"


def _leaders(percent: int):
    """Of keys with several documents (or of crowded ones): ``key, doc, n, leader``.

    A key's rows come in the order of ``n``, the size of their sets.  Where the next set is too large to be linked
    with the one before, no link goes over the gap, and the sets on either side are apart.
    """

    def run(batches):
        for table in sorted_groups(batches, ["key", "salt"]):
            doc, n = table.column("doc").to_numpy(), table.column("n").to_numpy()
            begins = np.zeros(len(doc), bool)
            begins[group_bounds(table, ["key", "salt"])[:-1]] = True
            begins[1:] |= 100 * n[:-1].astype(np.int64) < percent * n[1:].astype(np.int64)
            at = np.flatnonzero(begins)
            size = np.diff(np.append(at, len(doc)))
            leader = np.repeat(np.minimum.reduceat(doc, at), size)
            keep = np.repeat(size > 1, size) | (table.column("heavy").to_numpy(zero_copy_only=False).astype(bool))
            columns = [table.column("key").to_numpy()[keep], doc[keep], n[keep], leader[keep]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "doc", "n", "leader"])

    return tidy(run), "key long, doc long, n int, leader long"


# ---------------------------------------------------------------- comparing


def linked(common: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return (100 * common >= percent * (a + b - common)) & (common > 0)


class Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def compare_block(sets: list[np.ndarray], percent: int, one: list[int]) -> tuple[list[tuple[int, int]], Forest]:
    """A spanning forest of the links among ``sets`` (positions), by a token-group matrix.

    The positions in ``one`` are known to be one class already; no links are given for that.
    """
    n = np.array([len(s) for s in sets], np.int64)
    forest, out = Forest(len(sets)), []
    for i in one:
        forest.join(i, one[0])
    # neighbours by size, then by smallest token: rows of the matrix hold alike documents
    order = sorted(range(len(sets)), key=lambda i: (n[i], int(sets[i][0])))
    tokens, inverse = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    width = n[order]
    ends = np.cumsum(width)
    of = [inverse[e - w : e] for e, w in zip(ends, width, strict=True)]
    often = np.bincount(inverse, minlength=len(tokens)) > 1  # other tokens are in no intersection
    place = np.cumsum(often) - 1
    of = [place[x[often[x]]] for x in of]
    total = int(often.sum())
    groups = [range(g, min(g + ROW, len(order))) for g in range(0, len(order), ROW)]
    for g, rows in enumerate(groups):
        union = np.zeros(total, bool)
        for r in rows:
            union[of[r]] = True
        columns = np.flatnonzero(union)
        spot = np.full(total, -1, np.int64)
        spot[columns] = np.arange(len(columns))
        inside = np.zeros((len(rows), len(columns)), np.float32)
        for k, r in enumerate(rows):
            inside[k, spot[of[r]]] = 1
        largest = width[rows[-1]]
        asking = []
        for q in range(rows[0] + 1, len(order)):
            if percent * width[q] > 100 * largest:
                break  # ordered by size: no later document is small enough
            bound = int(union[of[q]].sum())  # no member shares more tokens with q
            if 100 * bound >= percent * width[q]:
                asking.append(q)
        whole = {forest.root(order[r]) for r in rows}
        if len(whole) == 1:  # rows and documents that are already one class add nothing
            asking = [q for q in asking if forest.root(order[q]) not in whole]
        step = max(1, (4 << 20) // max(1, len(columns)))
        for lo in range(0, len(asking), step):
            some = asking[lo : lo + step]
            ask = np.zeros((len(some), len(columns)), np.float32)
            for k, q in enumerate(some):
                at = spot[of[q]]
                ask[k, at[at >= 0]] = 1
            common = np.rint(ask @ inside.T).astype(np.int64)
            for k, r in zip(*np.nonzero(linked(common, width[some][:, None], width[list(rows)][None, :], percent)), strict=True):
                a, b = order[some[k]], order[rows[r]]
                if a != b and forest.join(a, b):
                    out.append((a, b))
    return out, forest


def _compare_pass(percent: int):
    """Links, and in groups of several blocks (``grp, doc`` with no ``v``) who is not in the leader's class."""
    keys = ["grp", "i", "j"]

    def run(batches):
        for table in sorted_groups(batches, keys):
            at = group_bounds(table, keys)
            docs, group, many = (table.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "grp", "many"))
            known = table.column("known").to_numpy(zero_copy_only=False)
            sets = table.column("tokens")
            u, v, grp = [], [], []
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                own = docs[lo:hi].tolist()
                # the leader may be sent by several of its rows; all its rows are one node
                one = np.flatnonzero(known[lo:hi]).tolist()
                found, forest = compare_block([np.frombuffer(sets[k].as_py(), U64) for k in range(lo, hi)], percent, one)
                u += [own[a] for a, _ in found]
                v += [own[b] for _, b in found]
                grp += [None] * len(found)
                if many[lo]:
                    lead = {forest.root(k) for k, d in enumerate(own) if d == group[lo]}
                    outside = sorted({d for k, d in enumerate(own) if forest.root(k) not in lead})
                    u += outside
                    v += [None] * len(outside)
                    grp += [int(group[lo])] * len(outside)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(grp, pa.int64())], ["u", "v", "grp"])

    return tidy(run), "u long, v long, grp long"


def _slot(doc: int, n: int) -> int:
    return int(scramble(np.array([doc & (2**64 - 1)], U64))[0] % U64(n))


def _units(doc: int, visit: dict) -> list[tuple[int, int, bool, bool]]:
    """``i, j, many, known``: the units of a group in which a document is compared.

    First each block with itself and the leader (``j`` -1); then the documents outside the leader's class,
    in ``others`` blocks of their own, with every block.
    """
    blocks, others = visit["blocks"], visit["others"]
    if not others:
        return [(i, -1, blocks > 1, False) for i in (range(blocks) if doc == visit["grp"] else [_slot(doc, blocks)])]
    out = {(_slot(doc, blocks), j) for j in range(others)}
    if visit["outside"]:
        out |= {(i, _slot(doc + 1, others)) for i in range(blocks)}
    return [(i, j, False, not visit["outside"]) for i, j in sorted(out)]


def _visit_pass(shingle: int):
    """Token sets of documents, one row for each unit that they are compared in."""
    names = ["grp", "i", "j", "many", "known", "doc", "tokens"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64(), pa.binary()]

    def run(batches):
        for batch in batches:
            ids, visits = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            rows, held = [], 0
            for row, tokens in shingle_sets(batch.column(1), shingle):
                if not len(tokens):
                    continue  # a row of an id that others give words
                data = tokens.tobytes()
                for v in visits[row]:
                    for unit in _units(ids[row], v):
                        rows.append((v["grp"], *unit, ids[row], data))
                        held += len(data)
                if held > 16 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names)

    return tidy(run), "grp long, i int, j int, many boolean, known boolean, doc long, tokens binary"


def _thinning(bits: bytes):
    """Rows whose id may be among those that the bit table was made of."""

    def run(batches):
        table = np.frombuffer(bits, np.uint8)
        for batch in batches:
            slot = batch.column(2).to_numpy()
            yield batch.filter(pa.array((table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1)).select([0, 1])

    return tidy(run), "id long, text string"


def texts_of(base: DataFrame, todo: DataFrame) -> DataFrame:
    """``id, text, visits`` of the documents in ``todo``; most other texts stay where they are.

    Python passes never follow each other in one stage: that takes two workers a task, and Spark keeps
    and uses them all from then on.
    """
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(BITS)) + 1
    marked = todo.select(slot("doc").alias("slot"), F.size("visits").alias("n"))
    by_page = marked.groupBy(F.bitmap_bucket_number("slot").alias("page"))
    pages = by_page.agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"), F.sum("n").alias("n")).collect()
    if sum(r["n"] for r in pages) <= FEW:
        return base.join(F.broadcast(todo), base["id"] == todo["doc"]).select("id", "text", "visits")
    table = bytearray(BITS // 8)
    for r in pages:  # pages count from 1
        at = (r["page"] - 1) * len(r["bits"])
        table[at : at + len(r["bits"])] = r["bits"]
    thin = base.where("id is not null").select("id", "text", (slot("id") - 1).alias("slot")).mapInArrow(*_thinning(bytes(table)))
    return thin.join(todo.hint("merge"), thin["id"] == todo["doc"]).select("id", "text", "visits")


# ---------------------------------------------------------------- the join


def near_duplicates(docs: DataFrame, text="text", doc_id="doc_id", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``."""
    spark = docs.sparkSession
    base = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    first = materialize(base.mapInArrow(*_first_pass(shingle, percent)), "jaccard-sets")
    nodes = first.where("kind = 0").drop("kind", "data")
    crowded = crowded_tokens(first)

    # equal sets are one class
    known = nodes.where("n > 0 and id is not null")
    classes = known.groupBy("d1", "d2", "n").agg(F.min("id").alias("class"), F.min("common").alias("common"))
    same = known.join(classes, ["d1", "d2", "n"]).where("id <> class").select(F.col("id").alias("u"), F.col("class").alias("v"))
    leaders = classes.groupBy(F.col("class").alias("doc")).agg(F.max("n").alias("n"), F.min("common").alias("common"))

    # all that is known of a document's keys meets once, by document: with how many of them each leader shares, its
    # home, and whether they are fewer than any link would give it
    own, with_leader = Window.partitionBy("doc"), Window.partitionBy("doc", "leader")
    at_home = (
        base.mapInArrow(*_key_pass(shingle, percent, crowded))
        .repartition("key", "salt")
        .sortWithinPartitions("key", "salt", "n")
        .mapInArrow(*_leaders(percent))
        .join(leaders.select("doc", "common"), "doc")
        .withColumn("with", F.count("*").over(with_leader))
        .withColumns({"home": F.max_by("leader", F.struct("with", -F.col("leader"))).over(own), "keys": F.count("*").over(own)})
        .where("keys >= common")
        .select("key", "doc", "n", "common", "home")
        .distinct()
    )
    at_home = materialize(at_home, "jaccard-homes")
    # the token-group matrix: keys of a group's union as rows, with the number of members that have them and the sizes
    # of their sets; a document meets only those keys that a member of a size it may be linked with has
    matrix = at_home.groupBy("key", F.col("home").alias("grp")).agg(
        F.count("*").alias("members"), F.min("n").cast("long").alias("least"), F.max("n").cast("long").alias("most")
    )
    near = (percent * F.col("n").cast("long") <= 100 * F.col("most")) & (percent * F.col("least") <= 100 * F.col("n").cast("long"))
    # two linked documents meet in the home group of one of them, that with the smaller name
    bound = at_home.join(matrix, "key").where("grp <= home").where(near).groupBy("doc", "grp", "home", "common")
    bound = materialize(bound.agg(F.count("*").alias("keys"), F.count_if(F.col("members") > 1).alias("others")), "jaccard-bounds")
    discard(at_home)
    guests = bound.where("grp < home and keys >= common").select("doc", "grp")
    hosts = bound.where("grp = home").join(guests.select("grp", F.lit(True).alias("visited")).distinct(), "grp", "left")
    hosts = hosts.where("visited or others >= common").select("doc", "grp")
    opened = guests.unionByName(hosts)
    sizes = (
        opened.join(leaders.select("doc", "n"), "doc")
        .groupBy("grp")
        .agg(F.count("*").alias("docs"), F.sum("n").alias("tokens"))
        .where("docs > 1")
        .select("grp", F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS), F.ceil(F.col("tokens") / BLOCK_TOKENS)).cast("int").alias("blocks"))
    )
    visits = opened.join(sizes, "grp")
    # the leader meets every block of its group, also when it is at home elsewhere
    led = visits.unionByName(sizes.where("blocks > 1").select(F.col("grp").alias("doc"), "grp", "blocks")).distinct()
    visits = materialize(led, "jaccard-visits")
    discard(bound)

    def compare(asked: DataFrame, label: str) -> DataFrame:
        visit = F.struct("grp", "blocks", "others", "outside")
        todo = asked.groupBy("doc").agg(F.collect_list(visit).alias("visits"))
        sets = texts_of(base, todo).mapInArrow(*_visit_pass(shingle))
        units = sets.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j")
        return materialize(units.mapInArrow(*_compare_pass(percent)), label)

    found = compare(visits.withColumn("others", F.lit(0)).withColumn("outside", F.lit(False)), "jaccard-links")
    edges = [found.where("v is not null").select("u", "v"), same]
    outside = found.where("v is null").select(F.col("u").alias("doc"), "grp", F.lit(True).alias("outside")).distinct()
    written = [found]
    if not outside.isEmpty():
        left = outside.groupBy("grp").agg(F.ceil(F.count("*") / BLOCK_DOCS).cast("int").alias("others"))
        again = visits.join(left, "grp").join(outside, ["doc", "grp"], "left").withColumn("outside", F.coalesce("outside", F.lit(False)))
        written.append(compare(again, "jaccard-rest"))
        edges.append(written[-1].where("v is not null").select("u", "v"))
    links = edges[0]
    for e in edges[1:]:
        links = links.unionByName(e)
    links = materialize(links, "jaccard-edges")
    for table in [visits, *written]:
        discard(table)
    parts = connected_components(links, "u", "v")
    discard(links)
    return (
        nodes.join(parts, nodes["id"] == parts["node"], "left")
        .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
    )


def keep_one(docs: DataFrame, text="text", doc_id="doc_id", **how) -> DataFrame:
    """``docs`` with one document, the one with the smallest id, of each group of near duplicates.

    Rows that repeat an id are repetitions of one document: all stay or go with it.
    """
    inner, (text, doc_id) = neutral(docs, text, doc_id)
    found = near_duplicates(inner, text, doc_id, **how)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct()
    return restored(inner.join(gone, inner[doc_id] == gone["gone"], "left_anti"), docs)


def op7(spark, docs: DataFrame) -> DataFrame:
    """Three words and a similarity of 0.9."""
    return near_duplicates(docs, shingle=3, percent=90)


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 2], ' ') AS t
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
-- rarest tokens first: linked sets share one of the first n - ceil(0.9 n) + 1
f AS (SELECT t, count(*) AS df FROM s GROUP BY t),
o AS (SELECT s.doc_id, s.t, n.n, row_number() OVER (PARTITION BY s.doc_id ORDER BY f.df, s.t) AS k
      FROM s JOIN f USING (t) JOIN n USING (doc_id)),
p AS (SELECT doc_id, t, n FROM o WHERE k <= n - (9 * n + 9) // 10 + 1),
c AS (SELECT DISTINCT a.doc_id AS u, b.doc_id AS v FROM p a JOIN p b ON a.t = b.t AND a.doc_id > b.doc_id
      WHERE 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n),
x AS (SELECT u, v, count(*) AS i FROM c JOIN s a ON a.doc_id = u JOIN s b ON b.doc_id = v AND a.t = b.t GROUP BY u, v),
l AS (SELECT u, v FROM x JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * i >= 90 * (a.n + b.n - i)),
e AS (SELECT u, v FROM l UNION SELECT v, u FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.v FROM r JOIN e ON r.b = e.u)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, m AS component_id
FROM d JOIN (SELECT a, min(b) AS m FROM r GROUP BY a) ON a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
