"""Merkle manifest of a data set: a content-addressed graph and proofs read out of it.

1. Every row is a leaf digest.  Within a tree (one per language) leaves are ranked by id, every eight
   consecutive nodes become one, until one is left; the roots of the trees form a tree of their own.
2. The graph is stored as records ``digest -> children``, one per digest.
3. Leaf requests descend from the root: the digits of a leaf's rank, highest first, select a child of
   each record, and the unselected children are collected as one segment of the path.  Requests that
   share a path so far travel as one row, so a level has at most as many rows as it has nodes.
   Segments are reversed in the end: a proof goes from the leaf to the root.

Scale: leaves are digests, the texts are read once.  A tree may hold all rows: ranks come from a range
sort whose ties are spread as well, every level is a grouping of at most eight rows, and each level is an
eighth of the one below.  Levels are written tables.

Defined results: a null field is ``-`` in its leaf and a null language is a tree of its own, the first; a
null id sorts first and is not tampered with; rows that repeat an id are ordered by their leaf digest;
equal rows are leaves of their own; an empty table has no trees, no root and no rows; texts of any
length are hashed whole; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field as attribute

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.llm.base import LOWER, UPPER
from tallyhouse.llm.order import ranked
from tallyhouse.llm.sqltext import CRC_TABLE, crc32_sql
from tallyhouse.session import materialize

FAN_BITS = 3
FAN = 1 << FAN_BITS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest_of(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` or byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def joined(digests: Column) -> Column:
    return F.array_join(digests, "")


def height_of(n: Column) -> Column:
    """How often every eight become one until one is left: the least h with 8 ** h >= n."""
    return F.size(F.filter(F.sequence(F.lit(0), F.lit(20)), lambda h: F.pow(F.lit(8.0), h) < n))


@dataclass
class Forest:
    """``levels[k]`` has the nodes k + 1 steps above the leaves: tree, height, rank, digest, children
    (and ``items``, what the leaves carry, on the first level); ``tops`` has tree, height, digest."""

    levels: list[DataFrame] = attribute(default_factory=list)
    tops: DataFrame | None = None

    def records(self) -> DataFrame:
        """``digest -> children``, one row per digest."""
        parts = [x.where("height > 0").select("digest", "children") for x in self.levels]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.dropDuplicates(["digest"])


def grow(leaves: DataFrame, order: list[str], carried: list[str], label: str) -> Forest:
    """The trees over ``tree, digest`` and the ``carried`` columns, leaves in the order of ``order``."""
    nodes, sizes = ranked(leaves, "tree", order, f"{label}-order")
    nodes = nodes.join(sizes.select("tree", height_of(F.col("n")).alias("height")), "tree")
    out, tops, level = Forest(), [], 1
    while True:
        kept = carried if level == 1 else []
        item = F.struct(F.col("rank").bitwiseAND(FAN - 1).alias("at"), "digest", *kept)
        run = F.shiftright("rank", FAN_BITS)
        up = nodes.groupBy("tree", "height", run.alias("rank")).agg(F.array_sort(F.collect_list(item)).alias("items"))
        up = up.withColumn("children", F.col("items.digest"))
        # a tree of one leaf has no node above it; its row only keeps what the leaf carries
        digest = F.when(F.col("height") == 0, F.col("children")[0]).otherwise(digest_of(joined(F.col("children"))))
        up = up.withColumn("digest", digest)
        up = materialize(up if level == 1 else up.drop("items"), f"{label}-level-{level}")
        out.levels.append(up)
        tops.append(up.where(F.col("height") <= level if level == 1 else F.col("height") == level).select("tree", "height", "digest"))
        nodes = up.where(F.col("height") > level).select("tree", "height", "rank", "digest")
        if nodes.isEmpty():
            break
        level += 1
    out.tops = tops[0]
    for t in tops[1:]:
        out.tops = out.tops.unionByName(t)
    return out


def descend(forest: Forest, starts: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """From the tops of trees down to the rows of the first level: ``tree, height, rank, digest, path``
    and the columns of ``starts``, which are ``tree, height, digest, path`` and others.

    ``requests`` (tree, rank of a leaf) limits the way to what is asked for.
    """
    wanted = None if requests is None else requests.select("tree", F.shiftright("rank", FAN_BITS).alias("rank")).distinct()
    starts = starts.withColumn("rank", F.lit(0).cast("bigint"))
    here = None
    for level in range(len(forest.levels), 0, -1):
        begin = starts.where(F.col("height") <= 1 if level == 1 else F.col("height") == level)
        here = begin if here is None else here.unionByName(begin)
        if wanted is not None:
            shift = FAN_BITS * (level - 1)
            here = here.join(wanted.select("tree", F.shiftright("rank", shift).alias("rank")).distinct(), ["tree", "rank"], "left_semi")
        if level == 1:
            return here
        records = forest.levels[level - 1].select("digest", "children").dropDuplicates(["digest"])
        columns = here.columns
        here = here.join(records, "digest").select("*", F.posexplode("children").alias("digit", "child"))
        here = here.withColumn("path", F.concat("path", F.array(unselected("children", "digit"))))
        here = here.withColumn("rank", F.shiftleft("rank", FAN_BITS) + F.col("digit")).withColumn("digest", F.col("child"))
        here = here.select(*columns)
    raise ValueError("a forest without levels")


def unselected(children: str, digit: str) -> Column:
    """The children left and right of the selected one."""
    after = F.greatest(F.size(children) - F.col(digit) - 1, F.lit(0))
    return F.struct(
        F.slice(children, F.lit(1), F.col(digit)).alias("left"), F.slice(children, F.col(digit) + 2, after).alias("right")
    )


def leaves_below(forest: Forest, at: DataFrame) -> DataFrame:
    """From rows of the first level to their leaves: what leaves carry under ``item``, and the path."""
    items = forest.levels[0].select("tree", "rank", "digest", "items", "children")
    rest = [c for c in at.columns if c not in ("tree", "rank", "digest", "path", "height")]
    out = at.join(items, ["tree", "rank", "digest"]).select("*", F.posexplode("items").alias("digit", "item"))
    path = F.when(F.col("height") == 0, F.col("path")).otherwise(F.concat("path", F.array(unselected("children", "digit"))))
    rank = F.shiftleft("rank", FAN_BITS) + F.col("digit")
    return out.select("tree", rank.alias("rank"), "item", path.alias("path"), *rest)


@dataclass
class Manifest:
    trees: Forest  # leaves of the data, one tree per language
    top: Forest  # its leaves are the roots of ``trees``
    root: str | None

    def records(self) -> DataFrame:
        return self.trees.records().unionByName(self.top.records()).dropDuplicates(["digest"])


EMPTY_PATH = "cast(array() as array<struct<left:array<string>,right:array<string>>>)"


def build(rows: DataFrame) -> Manifest:
    """``rows``: tree (a text without nulls), digest, doc_id, tampered; ordered by id, then digest."""
    trees = grow(rows, ["doc_id", "digest"], ["doc_id", "tampered"], "merkle")
    top = grow(trees.tops.select("digest", F.col("tree").alias("name"), F.lit("").alias("tree")), ["name"], ["name"], "merkle-top")
    first = top.tops.first()
    return Manifest(trees, top, first["digest"] if first else None)


def proofs(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """``tree, rank, doc_id, leaf, tampered, subroot, proof`` of all leaves, or of those in ``requests``
    (tree, rank).  A proof is an array of (left, right) siblings, from the leaf to the root."""
    starts = manifest.top.tops.withColumn("path", F.expr(EMPTY_PATH))
    subroots = leaves_below(manifest.top, descend(manifest.top, starts))
    starts = subroots.select(F.col("item.name").alias("tree"), F.col("item.digest").alias("digest"), F.col("item.digest").alias("subroot"), "path")
    starts = starts.join(manifest.trees.tops.select("tree", "height"), "tree")
    found = leaves_below(manifest.trees, descend(manifest.trees, starts, requests))
    if requests is not None:
        found = found.join(requests.select("tree", "rank").distinct(), ["tree", "rank"], "left_semi")
    return found.select(
        "tree", "rank", "item.doc_id", F.col("item.digest").alias("leaf"), "item.tampered", "subroot", F.reverse("path").alias("proof")
    )


def proof_digest(proof: Column) -> Column:
    return digest_of(joined(F.transform(proof, lambda s: F.concat(joined(s["left"]), joined(s["right"])))))


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(proof, leaf, lambda below, s: digest_of(joined(s["left"]), below, joined(s["right"])))


def document_leaves(docs: DataFrame) -> DataFrame:
    """``tree, doc_id, digest, tampered`` of ``documents``, written; ``tampered`` is the leaf with A-Z of
    the text in lower case where 3 divides the id's CRC, else null."""
    fields = [field(F.col(c)) for c in FIELDS]
    changed = [*fields[:-1], field(F.translate("text", UPPER, LOWER))]
    hit = (F.crc32(F.col("doc_id").cast("string")) % 3 == 0) & F.col("text").isNotNull()
    return materialize(
        docs.select(
            F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-")).alias("tree"),  # sorts like lang, null first
            "doc_id",
            digest_of(*fields).alias("digest"),
            F.when(hit, digest_of(*changed)).alias("tampered"),
        ),
        "merkle-leaves",
    )


def op11(spark, docs: DataFrame) -> DataFrame:
    manifest = build(document_leaves(docs))
    found = proofs(manifest)
    folded = fold(F.coalesce("tampered", "leaf"), F.col("proof"))
    root = F.lit(manifest.root).cast("string")
    out = found.select("doc_id", "leaf", "subroot", root.alias("root"), proof_digest(F.col("proof")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql_leaf(text: str) -> str:
    values = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v})::VARCHAR || ':' || {v}, '-')" for v in values) + ")"


_LOWERED = f"translate(text, '{UPPER}', '{LOWER}')"
SQL = f"""
WITH RECURSIVE {CRC_TABLE},
d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '-') AS tree, {_sql_leaf("text")} AS leaf,
    CASE WHEN text IS NOT NULL AND {crc32_sql("doc_id::VARCHAR")} % 3 = 0 THEN {_sql_leaf(_LOWERED)} END AS tampered
  FROM documents, crc_table),
o AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS k,
             count(*) OVER (PARTITION BY tree) AS n FROM d),
-- nodes of the trees, level by level
a AS (
  SELECT tree, 0 AS level, k, n, leaf AS digest FROM o
  UNION ALL
  SELECT tree, level + 1, k // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY k))
  FROM a WHERE n > 1 GROUP BY tree, level, n, k // 8),
s AS (SELECT tree, level AS height, digest FROM a WHERE n = 1),
t AS (SELECT *, row_number() OVER (ORDER BY tree) - 1 AS k, count(*) OVER () AS n FROM s),
b AS (
  SELECT 0 AS level, k, n, digest FROM t
  UNION ALL
  SELECT level + 1, k // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY k)) FROM b WHERE n > 1 GROUP BY level, n, k // 8),
-- every node's place among its siblings: what stands left and right of it
ax AS (SELECT tree, level, k, n, string_agg(digest, '' ORDER BY k) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l,
              string_agg(digest, '' ORDER BY k) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS g
       FROM a WINDOW w AS (PARTITION BY tree, level, k // 8 ORDER BY k)),
bx AS (SELECT level, k, n, string_agg(digest, '' ORDER BY k) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l,
              string_agg(digest, '' ORDER BY k) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS g
       FROM b WINDOW w AS (PARTITION BY level, k // 8 ORDER BY k)),
p AS (
  SELECT o.r, ax.level AS step, coalesce(l, '') AS l, coalesce(g, '') AS g
  FROM o JOIN ax ON ax.tree = o.tree AND ax.n > 1 AND ax.k = o.k // (8 ** ax.level)::BIGINT
  UNION ALL
  SELECT o.r, 100 + bx.level, coalesce(l, ''), coalesce(g, '')
  FROM o JOIN t USING (tree) JOIN bx ON bx.n > 1 AND bx.k = t.k // (8 ** bx.level)::BIGINT),
q AS (SELECT r, list(struct_pack(l := l, g := g) ORDER BY step) AS steps, sha256(string_agg(l || g, '' ORDER BY step)) AS proof FROM p GROUP BY r),
f AS (
  SELECT o.r, coalesce(tampered, leaf) AS digest, 1 AS i, steps FROM o LEFT JOIN q USING (r)
  UNION ALL
  SELECT r, sha256(steps[i].l || digest || steps[i].g), i + 1, steps FROM f WHERE i <= len(steps))
SELECT o.doc_id, o.leaf, s.digest AS subroot, b.digest AS root, coalesce(q.proof, sha256('')) AS proof_sha256,
       f.digest AS folded_root, f.digest = b.digest AS verified
FROM o JOIN s USING (tree) JOIN b ON b.n = 1 LEFT JOIN q USING (r) JOIN f ON f.r = o.r AND f.i = coalesce(len(f.steps), 0) + 1
"""
