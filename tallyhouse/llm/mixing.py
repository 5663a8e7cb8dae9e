"""Mixing sources to target weights by weighted sampling without replacement.

Every source gets a budget of words.  Budgets are shared out by weight; a source stops at
``max_epochs`` times its own size and what it cannot use is shared among the others, again by
weight, until no source is above its limit.  A source whose budget is above its size is taken
whole as often as it fits (complete epochs).  The rest of the budget is filled by
Efraimidis-Spirakis sampling: every document draws ``u`` from (0, 1) by a hash of its id, its key
is ``-ln(u) / weight``, and documents join in ascending order of the key until their summed sizes
reach the budget.  The document at the boundary joins with as many words as are still missing.

Scale: a source may hold any share of all rows.  Everything is decided on ids, sizes and keys, without
texts.  Keys are cut into ranges by their logarithm, so a range holds at most one part in 22,000 of the rows of a
source (1 / (e * KEY_RANGES)), whatever their weights are.  Sizes are summed per (source, range), which map tasks
pre-aggregate, and the prefix sum over ranges finds the one range in which the budget ends.  Only that range is ordered
row by row; it gives the document at the boundary.  A second pass over the texts then compares each row with the boundary of
its source; no text is shuffled, and only boundary documents are taken apart into words.

Defined results: null text has size 0 and takes nothing; a null source is a source of its own,
ordered last; null and repeated ids are rows of their own, ordered by text digest among equal keys
(rows that are equal in all of these are interchangeable); an empty table gives an empty result;
columns that carry a name used here keep their values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.llm.base import SPACE_WORD, neutral, restored
from tallyhouse.session import materialize

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Ranges of keys for each unit of the key's logarithm.
KEY_RANGES = 8192
NO_RANGE = -(1 << 31)
SEED = "mix-1"
#: Per-source figures are broadcast up to this many sources; beyond it they are joined by shuffle.
MAX_BROADCAST_SOURCES = 100_000

#: Marks that prose rarely holds in numbers (fixed value).
MARKS = "|*$%&#!"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_WORD)), F.lit(0)).cast("bigint")


def mark_weight(text: Column) -> Column:
    """Quality weight in (0, 1]: falls with the share of marks among the characters."""
    t = F.coalesce(text, F.lit(""))
    marks = F.length(t) - F.length(F.translate(t, MARKS, ""))
    return F.lit(1.0) / (F.lit(1.0) + F.lit(20.0) * marks / F.greatest(F.length(t), F.lit(1)))


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) that depends on the id and the seed only."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``__source, __source_size`` -> plus ``__target``: water-filling in closed form.

    Sources in the order of limit over weight; if the first k stand at their limit, the others
    get ``(total - their limits) / (weights of the others)`` times their weight.  The smallest k
    for which nobody else is above its limit is the fixed point of resharing.
    """
    by_name = Window.orderBy(F.col("__source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    s = sizes.withColumn("__w", F.get(cycle, ((F.row_number().over(by_name) - 1) % len(weights)).cast("int")))
    s = s.withColumn("__limit", F.col("__source_size").cast("double") * max_epochs)
    order = Window.orderBy(F.col("__limit") / F.col("__w"), F.col("__source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumns(
        {
            "__place": F.row_number().over(order),
            "__level": (
                F.sum("__source_size").over(everyone).cast("double")
                - F.coalesce(F.sum("__limit").over(before), F.lit(0.0))
            )
            / (F.sum("__w").over(everyone) - F.coalesce(F.sum("__w").over(before), F.lit(0.0))),
        }
    )
    # the first source, in this order, that stays below its limit sets the level
    fits = F.when(F.col("__level") <= F.col("__limit") / F.col("__w"), F.struct("__place", "__level"))
    s = s.withColumn("__level", F.min(fits).over(everyone)["__level"])
    target = F.least(F.col("__limit"), F.coalesce(F.col("__level") * F.col("__w"), F.col("__limit")))
    return s.select("__source", "__source_size", target.alias("__target"))


def sized(docs: DataFrame, text="text", source="source", doc_id="doc_id", weight=None, seed: str = SEED) -> DataFrame:
    """``docs`` with size, key and key range of every row."""
    w = F.greatest(weight if weight is not None else mark_weight(F.col(text)), F.lit(1e-6))
    out = docs.withColumns(
        {
            "__id": F.col(doc_id),
            "__source": F.col(source).cast("string"),
            "__size": word_count(F.col(text)),
            "__key": -F.log(draw(F.col(doc_id), seed)) / w,
            "__tie": F.md5(F.coalesce(F.col(text), F.lit(""))),
        }
    )
    return out.withColumn("__range", F.floor(F.log("__key") * KEY_RANGES).cast("int"))


def budgets(slim: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """A row for each source: what it gets and where it ends.

    ``slim`` has the rows of ``sized`` without texts, written.  ``__end`` is the (key, id, tie) at which the budget
    ends, null if nothing is left after whole epochs; ``__missing`` words are taken from the rows that
    stand there.
    """
    # one row per source and key range; also the source sizes come from it
    ranges = materialize(slim.groupBy("__source", "__range").agg(F.sum("__size").alias("__range_size")), "mix-ranges")
    sizes = ranges.groupBy("__source").agg(F.sum("__range_size").alias("__source_size"))
    plan = source_targets(sizes, weights, max_epochs)
    plan = plan.withColumn("__budget", F.round("__target").cast("bigint"))
    full = F.col("__source_size") > 0
    plan = plan.withColumn(
        "__epochs",
        F.when(full, F.least(F.floor(F.col("__budget") / F.greatest("__source_size", F.lit(1))), F.lit(max_epochs)))
        .otherwise(0)
        .cast("bigint"),
    ).withColumn("__rest", F.col("__budget") - F.col("__epochs") * F.col("__source_size"))

    upto = Window.partitionBy("__source").orderBy("__range").rowsBetween(Window.unboundedPreceding, 0)
    running = ranges.select(
        F.col("__source").alias("__s"), "__range", "__range_size", F.sum("__range_size").over(upto).alias("__upto")
    )
    cut = (
        running.join(plan.select(F.col("__source").alias("__s2"), "__rest"), F.col("__s").eqNullSafe(F.col("__s2")))
        .where((F.col("__upto") - F.col("__range_size") < F.col("__rest")) & (F.col("__upto") >= F.col("__rest")))
        .groupBy("__s")
        .agg(F.min_by(F.struct("__range", (F.col("__upto") - F.col("__range_size")).alias("before")), "__range").alias("__cut"))
    )
    plan = plan.join(cut, F.col("__source").eqNullSafe(F.col("__s")), "left").select(
        F.col("__source").alias("__ps"),
        "__source_size",
        "__target",
        "__epochs",
        # nothing left over after whole epochs: no range is cut, none is taken
        F.coalesce(F.col("__cut.__range"), F.lit(NO_RANGE)).alias("__cut_range"),
        (F.col("__rest") - F.coalesce(F.col("__cut.before"), F.lit(0))).cast("bigint").alias("__left"),
    )
    plan = materialize(plan, "mix-plan")

    # the cut ranges alone are ordered; rows that are equal in key, id and text count as one there
    inside = slim.join(_side(plan.select("__ps", "__cut_range", "__left")), F.col("__source").eqNullSafe(F.col("__ps")) & (F.col("__range") == F.col("__cut_range")))
    equal = inside.groupBy("__source", "__left", "__key", "__id", "__tie", "__size").agg(F.sum("__size").alias("__words"))
    so_far = F.sum("__words").over(Window.partitionBy("__source").orderBy("__key", "__id", "__tie").rowsBetween(Window.unboundedPreceding, 0))
    equal = equal.withColumn("__upto", so_far).withColumn("__missing", F.col("__left") - (F.col("__upto") - F.col("__words")))
    ends = equal.where((F.col("__missing") > 0) & (F.col("__missing") <= F.col("__words")))
    ends = ends.select(F.col("__source").alias("__es"), F.struct("__key", "__id", "__tie").alias("__end"), "__missing")
    both = plan.join(ends, F.col("__ps").eqNullSafe(F.col("__es")), "left")
    return materialize(both.select("__ps", "__source_size", "__target", "__epochs", "__end", "__missing"), "mix-ends")


def _side(plan: DataFrame) -> DataFrame:
    """A row for each source: sent to all tasks up to a number of rows."""
    return F.broadcast(plan) if plan.limit(MAX_BROADCAST_SOURCES + 1).count() <= MAX_BROADCAST_SOURCES else plan


def allocate(frame: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows of ``sized`` with ``__source_size, __target, __epochs``, with ``__whole``, whether a row is taken once more,
    and ``__part``, how many of its words are taken beside that."""
    rows = frame.join(_side(plan), F.col("__source").eqNullSafe(F.col("__ps")))
    here = F.struct("__key", "__id", "__tie")
    # the id is compared first: what else makes up the place is then worked out for few rows
    at_end = F.col("__end").isNotNull() & F.col("__id").eqNullSafe(F.col("__end.__id")) & (here == F.col("__end"))
    at_end = F.coalesce(F.when(F.col("__end").isNull(), F.lit(False)).otherwise(at_end), F.lit(False))
    rest = rows.where(~at_end)
    rest = rest.withColumns({"__whole": F.coalesce(here < F.col("__end"), F.lit(False)), "__part": F.lit(0).cast("bigint")})
    # rows that cannot be told apart share what is missing, one after the other
    copy = F.row_number().over(Window.partitionBy("__source").orderBy("__key"))
    end = rows.where(at_end).withColumn("__part", F.col("__missing") - (copy - 1) * F.col("__size"))
    end = end.withColumn("__part", F.greatest(F.lit(0).cast("bigint"), F.least("__part", "__size")))
    end = end.withColumns({"__whole": (F.col("__part") == F.col("__size")) & (F.col("__size") > 0)})
    end = end.withColumn("__part", F.when(F.col("__whole"), F.lit(0).cast("bigint")).otherwise(F.col("__part")))
    return rest.unionByName(end).drop("__ps", "__end", "__missing")


SLIM = ["__id", "__source", "__size", "__key", "__tie", "__range"]


def mix(docs: DataFrame, text="text", source="source", doc_id="doc_id", **how) -> DataFrame:
    """The mixed corpus: rows of ``docs``, each as often as the mix takes it.

    A document whose words are taken ``k`` times and a part comes out ``k`` times whole and once
    cut to the part, so the words of the result are the words of the plan.
    """
    inner, (text, source, doc_id) = neutral(docs, text, source, doc_id)
    base = sized(inner, text, source, doc_id)
    rows = allocate(base, budgets(materialize(base.select(*SLIM), "mix-sizes"), **how))
    # a text without words is never taken
    some = F.coalesce(F.col(text).rlike(SPACE_WORD), F.lit(False))
    copies = F.when(some, F.col("__epochs") + F.col("__whole").cast("int")).otherwise(0).cast("int")
    slots = F.concat(
        F.array_repeat(F.lit(False), copies), F.when(F.col("__part") > 0, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))
    )
    out = rows.withColumn("__cut_copy", F.explode(slots))
    # the first `part` words, with the white space between them as it was
    words = F.regexp_extract_all(F.col(text), F.lit(SPACE_WORD), F.lit(0))
    gaps = F.regexp_extract_all(F.col(text), F.lit(r"[\x20\x09-\x0D]+"), F.lit(0))
    head = F.regexp_extract(F.col(text), r"^[\x20\x09-\x0D]*", 0)
    skip = F.when(F.length(head) > 0, 1).otherwise(0)
    cut_text = F.concat(
        head,
        F.array_join(
            F.zip_with(
                F.slice(words, 1, F.col("__part").cast("int")),
                F.slice(gaps, skip + 1, F.greatest(F.col("__part").cast("int") - 1, F.lit(0))),
                lambda w, g: F.concat(w, F.coalesce(g, F.lit(""))),
            ),
            "",
        ),
    )
    out = out.withColumn(text, F.when(F.col("__cut_copy"), cut_text).otherwise(F.col(text)))
    return restored(out, docs)


def op9(spark, docs: DataFrame) -> DataFrame:
    """Digest of the plan: one row per document."""
    slim = materialize(sized(docs).select(*SLIM), "mix-sizes")
    rows = allocate(slim, budgets(slim))
    taken = (F.col("__epochs") + F.col("__whole").cast("int")) * F.col("__size") + F.col("__part")
    return rows.select(
        F.col("__id").alias("doc_id"),
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.round("__target", 6).alias("target"),
        taken.cast("bigint").alias("taken"),
    )


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(text, '')) AS tie,
         -ln((('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT + 0.5) / 281474976710656.0)
           / greatest(1.0 / (1.0 + 20.0 * (length(coalesce(text, '')) - length(translate(coalesce(text, ''), '|*$%&#!', '')))
                             / greatest(length(coalesce(text, '')), 1)), 1e-6) AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, 3.0 * source_size AS cap,
             CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS weight
      FROM s),
-- rounds of sharing: everyone above its cap stays there, the rest is shared anew
rounds AS (
  SELECT 0 AS k, source, source_size, cap, weight, false AS capped,
         (SELECT sum(source_size) FROM w) * weight / (SELECT sum(weight) FROM w) AS target FROM w
  UNION ALL
  SELECT k + 1, source, source_size, cap, weight, capped OR target >= cap,
         CASE WHEN capped OR target >= cap THEN cap
              ELSE (sum(source_size) OVER () - coalesce(sum(cap) FILTER (WHERE capped OR target >= cap) OVER (), 0))
                   * weight / sum(weight) FILTER (WHERE NOT (capped OR target >= cap)) OVER () END
  FROM rounds WHERE k < 60),
t AS (SELECT source, source_size, target, round(target)::BIGINT AS budget FROM rounds WHERE k = 60),
e AS (SELECT *, CASE WHEN source_size > 0 THEN least(budget // source_size, 3) ELSE 0 END AS epochs FROM t),
r AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, budget - epochs * e.source_size AS rest,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.tie ROWS UNBOUNDED PRECEDING) AS upto
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       (epochs * size + greatest(0, least(size, rest - (upto - size))))::BIGINT AS taken
FROM r
"""
