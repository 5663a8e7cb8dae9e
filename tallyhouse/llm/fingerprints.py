"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame functions only.

A text's shingles (five words, A-Z in lower case; a shorter text is one shingle) are hashed, and its
fingerprint is the ``K`` smallest different hashes, in order.  Two sketches give the smallest hashes of
the union, so sketches of parts merge to that of the whole; the share of them that is in both estimates
the resemblance, and the largest of a full sketch tells how many different shingles there are.

The hash is the first 64 bits of MD5 as a hexadecimal text, which sorts like the number and which any
engine can repeat.

``op12`` holds each text against the one that follows it by id.  Ids are ranked by a range sort of
(id, digest) without texts.  Then texts are dealt by digest once, each document's text goes to the document
before it, cut to what that one takes of it, and everything else is computed in the row.

Scale: nothing is grouped but rows that repeat both id and text, whatever their number; they are one row
until the result.  A text's words are held in one task, like the text itself.

Defined results: null is the empty text; a text without words has the empty sketch, alike (1.0) to
another such and to no other (0.0); null ids sort first; rows that repeat an id are ordered by digest of the
text; a row that stands several times is followed by itself, but for the last; one row alone is followed
by itself; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.llm.base import LOWER, SPACE_WORD, UPPER
from tallyhouse.llm.order import ranked
from tallyhouse.session import materialize

SHINGLE, K, DIGITS = 5, 128, 16
NONE = "cast(array() as array<string>)"


# ---------------------------------------------------------------- sketches


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(SPACE_WORD), F.lit(0))


def sketch_of_words(w: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    """Bottom-k sketch of an array of words."""
    at = F.sequence(F.lit(1), F.greatest(F.size(w) - shingle + 1, F.lit(1)))
    hashes = F.transform(at, lambda i: F.substring(F.md5(F.array_join(F.slice(w, i, F.lit(shingle)), " ")), 1, DIGITS))
    return F.when(F.size(w) == 0, F.expr(NONE)).otherwise(bottom(hashes, k))


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of what two sketches stand for."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of both that each has."""
    union = merged(a, b, k)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of different shingles; exact below ``k``."""
    largest = F.conv(F.substring(F.element_at(a, -1), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / largest)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has; 1 if ``a`` has none."""
    both = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct_shingles(a, k)))


def text_of(a: Column) -> Column:
    return F.array_join(a, "")


def packed(a: Column) -> Column:
    """A sketch as bytes, for the way through a shuffle."""
    return F.unhex(text_of(a))


def unpacked(data: Column) -> Column:
    size = DIGITS // 2
    at = F.sequence(F.lit(1), F.greatest(F.octet_length(data), F.lit(1)), F.lit(size))
    hashes = F.transform(at, lambda i: F.lower(F.hex(F.substring(data, i, F.lit(size)))))
    return F.when(F.octet_length(data) == 0, F.expr(NONE)).otherwise(hashes)


def merge_by(sketches: DataFrame, by: list[str], sketch: str = "sketch", k: int = K) -> DataFrame:
    """One sketch for each group of rows: ``by`` and ``sketch``.

    Hashes are made different before they meet, and a task passes on only ``k`` of a group, so a group
    may hold most of the rows.  A group whose rows all have empty sketches has the empty sketch.
    """
    names = [f"g{i}" for i in range(len(by))]
    rows = sketches.select(*[F.col(c).alias(n) for c, n in zip(by, names, strict=True)], F.col(sketch).alias("s"))
    hashes = rows.select(*names, F.explode("s").alias("h")).distinct()
    place = F.row_number().over(Window.partitionBy(*names).orderBy("h"))
    least = hashes.withColumn("place", place).where(F.col("place") <= k)
    least = least.select(*names, "h").unionByName(rows.select(*names).distinct().withColumn("h", F.lit(None).cast("string")))
    out = least.groupBy(*names).agg(F.sort_array(F.collect_list("h")).alias("s"))
    return out.select(*[F.col(n).alias(c) for c, n in zip(by, names, strict=True)], F.col("s").alias(sketch))


def fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the sketch of a text column."""
    return docs.withColumn(name, sketch_of_words(words(F.coalesce(F.col(text), F.lit("")))))


# ---------------------------------------------------------------- documents and their edited texts


def _following(nodes: DataFrame, count: int) -> DataFrame:
    """``key, doc_id, n_chars, copies`` of every document, and of the one before it ``prev_key`` and how
    many characters that one takes; the first follows the last."""
    before = nodes.select(
        F.pmod(F.col("rank") + 1, F.lit(count)).alias("rank"), F.col("key").alias("prev_key"), F.shiftright("n_chars", 1).alias("takes")
    )
    return nodes.select("rank", "key", "doc_id", "n_chars", "copies").join(before, "rank").drop("rank")


def op12(spark, docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    key = F.substring(F.unhex(F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), text), 256)), 1, 16)
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), key.alias("key"))
    narrow = base.select("key", "doc_id", F.char_length("text").cast("bigint").alias("n_chars"))
    nodes = materialize(narrow.groupBy("key", "doc_id", "n_chars").agg(F.count("*").alias("copies")).withColumn("all", F.lit("")), "fingerprint-nodes")
    placed, _ = ranked(nodes, "all", ["doc_id", "key"], "fingerprint-order")
    order = materialize(_following(placed, max(1, nodes.count())), "fingerprint-next")

    texts = base.select("key", "text").groupBy("key").agg(F.first("text").alias("text"))
    heads = (
        texts.join(order.select("key", "prev_key", "takes"), "key")
        .withColumn("words", words(F.col("text")))
        .select(
            F.col("prev_key").alias("key"),
            F.substring("text", F.lit(1), F.col("takes").cast("int")).alias("head"),
            packed(sketch_of_words(F.col("words"))).alias("next_sketch"),
        )
    )
    own = texts.join(order.select("key", "doc_id", "n_chars", "copies"), "key").withColumn("words", words(F.col("text")))
    own = own.withColumn("sketch", sketch_of_words(F.col("words"))).drop("words")
    half = F.shiftright("n_chars", 1).cast("int")
    itself = F.struct(F.substring("text", F.lit(1), half).alias("head"), packed(F.col("sketch")).alias("next_sketch"), (F.col("copies") - 1).alias("times"))
    following = F.struct("head", "next_sketch", F.lit(1).cast("bigint").alias("times"))
    pairs = own.join(heads, "key").withColumn(
        "next", F.explode(F.when(F.col("copies") > 1, F.array(following, itself)).otherwise(F.array(following)))
    )
    kept = F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int"))
    edited = pairs.select("doc_id", "n_chars", "sketch", "next", F.concat(kept, F.col("next.head")).alias("edited"))
    edited = edited.withColumn("words", words(F.col("edited"))).withColumn("edited_sketch", sketch_of_words(F.col("words")))
    edited = edited.withColumn("next_sketch", unpacked(F.col("next.next_sketch")))
    return edited.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        text_of(F.col("sketch")).alias("fingerprint"),
        text_of(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        F.explode(F.array_repeat(F.lit(1), F.col("next.times").cast("int"))).alias("copy"),
    ).drop("copy")


def _sql_sketch(text: str) -> str:
    w = f"regexp_extract_all(translate({text}, '{UPPER}', '{LOWER}'), '{SPACE_WORD}')"
    one = f"left(md5(array_to_string(w[i:i + {SHINGLE - 1}], ' ')), {DIGITS})"
    return f"""(SELECT coalesce(list_sort(list_distinct(list({one})))[1:{K}], [])
   FROM (SELECT {w} AS w), unnest(range(1, greatest(len(w) - {SHINGLE - 2}, 2))) AS u(i) WHERE len(w) > 0)"""


def _sql_near(a: str, b: str) -> str:
    union = f"list_sort(list_distinct(list_concat({a}, {b})))[1:{K}]"
    return f"CASE WHEN len({a}) + len({b}) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect({union}, list_intersect({a}, {b})))::DOUBLE / len({union}) END"


SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
o AS (SELECT *, length(text) AS n, row_number() OVER (ORDER BY doc_id NULLS FIRST, sha256(coalesce(doc_id::VARCHAR, '-') || ':' || text)) AS k, count(*) OVER () AS rows FROM d),
e AS (SELECT a.k, a.doc_id, a.n, a.text, b.k AS next, left(a.text, a.n - a.n // 2) || left(b.text, a.n // 2) AS edited
      FROM o a JOIN o b ON b.k = a.k % a.rows + 1),
s AS (SELECT *, {_sql_sketch("text")} AS f, {_sql_sketch("edited")} AS g FROM e)
SELECT s.doc_id, s.n AS n_chars, sha256(s.edited) AS edited_sha256, array_to_string(s.f, '') AS fingerprint, array_to_string(s.g, '') AS edited_fingerprint,
       {_sql_near("s.f", "s.g")} AS near_edited, {_sql_near("s.f", "x.f")} AS near_next
FROM s JOIN s x ON x.k = s.next
"""
