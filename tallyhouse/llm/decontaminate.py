"""Benchmark decontamination with a hash set of test n-grams.

Texts are lower-cased (A-Z) and cut into words of ASCII letters and digits and of all characters
above ASCII.  A benchmark item gives all runs of ``n`` words; an item with fewer words gives itself.
The hashes of these windows form a set that is sent to every task with the plan.  Training texts are
scanned window by window against it inside one projection, words are never exploded, and a window
whose hash is in the set is compared as text (verified).  Nothing but hits is ever shuffled.

The set is counted before it is sent: above ``MAX_SET`` windows the windows of the documents are
joined with those of the benchmark by shuffle instead, with the same result.

Defined results: null and empty texts have no words and no hits; null items and items without words
have no windows; every input row is a document of its own (repeated and null ids too); an empty
benchmark hits nothing, an empty table stays empty; columns named like ours keep their values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.llm.base import LOWER, UPPER, neutral, restored
from tallyhouse.session import materialize

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after lower-casing
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # the same words before it
N = 10
MAX_SET = 100_000

_HIT = "struct<start:int,end:int,window:string>"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def benchmark_windows(benchmark: DataFrame, text="text", item_id="item_id", n: int = N) -> DataFrame:
    """``len, window, items``: every distinct window and the items it is from."""
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words_of(F.col(text)).alias("w")
    ).where(F.size("w") > 0)
    items = items.withColumn("len", F.least(F.size("w"), F.lit(n)))
    starts = F.sequence(F.lit(1), F.size("w") - F.col("len") + 1)
    spans = F.transform(starts, lambda i: F.array_join(F.slice("w", i, F.col("len")), " "))
    return (
        items.select("item", "len", F.explode(spans).alias("window"))
        .groupBy("len", "window")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )


def _starts(length: int) -> str:
    return f"if(size(__w) >= {length}, sequence(1, size(__w) - {length - 1}), cast(array() as array<int>))"


def _hits(length: int, keep: str) -> Column:
    """Spans of ``length`` words of ``__w`` that pass the test ``keep`` on their start ``i``."""
    window = f"array_join(slice(__w, i, {length}), ' ')"
    return F.expr(
        f"transform(filter({_starts(length)}, i -> {keep}), "
        f"i -> named_struct('start', i, 'end', i + {length - 1}, 'window', {window}))"
    )


def _with_words(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` plus ``__w``.  As the output of a generator the words stay a column: a filter on
    what is computed from them is not pushed below, where each of its steps would cut the text anew."""
    return docs.withColumn("__w", F.explode(F.array(words_of(F.col(text)))))


def with_hits(docs: DataFrame, windows: DataFrame, text="text", max_set: int = MAX_SET) -> DataFrame:
    """``docs`` plus ``__n_words`` and ``__hits``, the verified spans in word numbers from 1."""
    known = windows.select("len", "window", F.xxhash64(F.split("window", " ")).alias("h"))
    rows = known.limit(max_set + 1).collect()
    if len(rows) > max_set:
        return _with_hits_joined(docs, windows, text)
    by_len: dict[int, list] = {}
    for r in rows:
        by_len.setdefault(r["len"], []).append(r)
    scan = _with_words(docs, text)
    found = [F.expr(f"cast(array() as array<{_HIT}>)")]
    for length, of_len in sorted(by_len.items()):
        # words hold no quote and no backslash
        hashes = ",".join(f"cast('{r['h']}' as bigint)" for r in of_len)
        texts = ",".join(f"'{r['window']}'" for r in of_len)
        found.append(
            _hits(
                length,
                f"xxhash64(slice(__w, i, {length})) in ({hashes}) and array_join(slice(__w, i, {length}), ' ') in ({texts})",
            )
        )
    return scan.withColumns({"__n_words": F.size("__w"), "__hits": F.concat(*found)}).drop("__w")


def _with_hits_joined(docs: DataFrame, windows: DataFrame, text: str) -> DataFrame:
    """For benchmarks too large to send along: exploded windows, joined by shuffle."""
    fixed = materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "decontaminate-docs")
    scan = _with_words(fixed, text).select("__row", "__w")
    lengths = [r["len"] for r in windows.select("len").distinct().collect()]  # at most n
    spans = F.concat(*[_hits(length, "true") for length in sorted(lengths)])
    every = scan.select("__row", F.explode(spans).alias("s"))
    hits = (
        every.join(windows.select("window"), F.col("s.window") == F.col("window"))
        .groupBy("__row")
        .agg(F.collect_list("s").alias("__hits"))
    )
    out = fixed.join(hits, "__row", "left").withColumn("__n_words", F.size(words_of(F.col(text))))
    none = F.expr(f"cast(array() as array<{_HIT}>)")
    return out.withColumn("__hits", F.coalesce(F.col("__hits"), none)).drop("__row")


def covered(hits: Column) -> Column:
    """Number of words inside any of the spans."""
    zero = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n"))
    return F.aggregate(
        F.array_sort(hits),
        zero,
        lambda a, s: F.struct(
            F.greatest(a["upto"], s["end"]).alias("upto"),
            (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["upto"], s["start"] - 1))).alias("n"),
        ),
    )["n"]


def decontaminate(docs: DataFrame, benchmark: DataFrame, text="text", remove="documents", n: int = N, max_set: int = MAX_SET) -> DataFrame:
    """``docs`` without contaminated documents, or with the hit words cut out of their texts.

    ``remove="spans"`` drops hit words and the characters between two hit words; what stands
    around them stays as it is.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    inner, (text,) = neutral(docs, text)
    rows = with_hits(inner, benchmark_windows(benchmark, n=n), text, max_set)
    if remove == "documents":
        return restored(rows.where(F.size("__hits") == 0), docs)
    rows = rows.withColumns(
        {
            "__raw": F.regexp_extract_all(F.col(text), F.lit(RAW_WORD), F.lit(0)),
            "__gap": F.split(F.col(text), RAW_WORD, -1),
            "__out": F.array_distinct(F.flatten(F.transform("__hits", lambda s: F.sequence(s["start"], s["end"])))),
        }
    )
    piece = (
        "concat_ws('', __gap[0], array_join(transform(sequence(1, __n_words), i -> concat("
        "if(array_contains(__out, i), '', __raw[i - 1]), "
        "if(array_contains(__out, i) and array_contains(__out, i + 1), '', __gap[i]))), ''))"
    )
    cut = F.when(F.size("__hits") > 0, F.expr(piece)).otherwise(F.col(text))
    return restored(rows.withColumn(text, cut), docs)


def report(docs: DataFrame, benchmark: DataFrame, text="text", doc_id="doc_id", item_id="item_id", n: int = N, max_set: int = MAX_SET) -> DataFrame:
    """One row per document: words, hit words and the items whose windows occur."""
    windows = benchmark_windows(benchmark, item_id=item_id, n=n)
    one = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = with_hits(one, windows, "text", max_set).select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.col("__n_words").cast("bigint").alias("n_words"),
        covered(F.col("__hits")).cast("bigint").alias("n_hit"),
        F.array_distinct(F.transform("__hits", lambda s: s["window"])).alias("hit"),
    )
    # one row for each distinct hit window, or one for a document without hits
    each = rows.select("row", "doc_id", "n_words", "n_hit", F.explode_outer("hit").alias("window"))
    items = each.join(windows.select("window", F.explode("items").alias("item")), "window", "left")
    return items.groupBy("row", "doc_id", "n_words", "n_hit").agg(F.sort_array(F.collect_set("item")).alias("items")).drop("row")


def op5(spark, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return report(docs, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item, l, array_to_string(w[p:p + l - 1], ' ') AS win
  FROM (SELECT item, w, least(len(w), 10) AS l, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p
        FROM b WHERE len(w) > 0)),
dw AS (
  SELECT r, l, p, array_to_string(w[p:p + l - 1], ' ') AS win
  FROM (SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS p
        FROM d, (SELECT DISTINCT l FROM bw) WHERE len(w) >= l)),
hits AS (SELECT dw.r, dw.p, dw.l, bw.item FROM dw JOIN bw ON dw.l = bw.l AND dw.win = bw.win),
n AS (SELECT r, count(DISTINCT q) AS n_hit
      FROM (SELECT r, unnest(range(p, p + l)) AS q FROM hits) GROUP BY r),
i AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
      FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN i USING (r)
"""
