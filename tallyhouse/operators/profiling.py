"""Profiles of raw frames: columns, values, formats and rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.functions import strip, title
from tallyhouse.operators import relational as rel
from tallyhouse.operators.staging import data_columns
from tallyhouse.plans.views import ratio

# --- fixed values -----------------------------------------------------------
KNOWN_PRODUCT_TYPES = [
    "Tools",
    "Cosmetics",
    "Electronics",
    "Apparel",
    "Furniture",
    "Grocery",
    "Kitchenware",
    "Sports",
    "Toys",
    "Jewelry",
]
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
MOSTLY_NULL = 0.8
# --- end of fixed values ----------------------------------------------------


def profile_file(df: DataFrame, expected: list[str] | None = None) -> DataFrame:
    """One row per column: rows, NULLs, repeated rows of the frame, and whether
    the column was expected; expected columns that are absent have no counts."""
    columns = data_columns(df)
    counts = df.agg(F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    distinct = df.select(*columns).distinct().agg(F.count("*").alias("distinct_rows"))
    per_column = counts.crossJoin(distinct).unpivot(  # one row each
        ["rows", "distinct_rows"], columns, "column", "nulls"
    )
    out = per_column.select(
        "column",
        "rows",
        "nulls",
        (ratio(F.col("nulls"), F.col("rows")) * 100).alias("null_pct"),
        (F.col("rows") - F.col("distinct_rows")).alias("duplicate_rows"),
        F.col("column").isin(expected or columns).alias("expected"),
    )
    missing = [c for c in expected or [] if c not in columns]
    if missing:
        absent = df.sparkSession.createDataFrame([(c, True) for c in missing], "column string, expected boolean")
        out = out.unionByName(absent, allowMissingColumns=True)
    return out


def value_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, value, n) for all columns in one pass; NULL is a value here."""
    columns = columns or data_columns(df)
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return texts.unpivot([], columns, "column", "value").groupBy("column", "value").agg(F.count("*").alias("n"))


def profile_columns(counts: DataFrame) -> DataFrame:
    """Per column, from its value counts: NULLs, distinct values, blanks,
    values that differ by case only, values with outer white space."""
    v = F.col("value")
    cased = counts.filter(v.isNotNull()).groupBy("column", F.lower("value").alias("low")).agg(F.count("*").alias("forms"))
    casing = cased.groupBy("column").agg(F.count_if(F.col("forms") > 1).alias("case_variants"))
    summary = counts.groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(v.isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count("value").alias("distinct_values"),
        F.coalesce(F.sum(F.when(strip(v) == "", F.col("n"))), F.lit(0)).alias("empty_strings"),
        F.coalesce(F.sum(F.when(strip(v) != v, F.col("n"))), F.lit(0)).alias("outer_whitespace"),
    )
    return summary.join(casing, "column", "left").select(
        "column",
        "rows",
        "nulls",
        (ratio(F.col("nulls"), F.col("rows")) * 100).alias("null_pct"),
        "distinct_values",
        "empty_strings",
        "outer_whitespace",
        (F.coalesce(F.col("case_variants"), F.lit(0)) > 0).alias("inconsistent_casing"),
    )


def top_values(counts: DataFrame, k: int = 10) -> DataFrame:
    """The most frequent values per column.  Each task keeps its own top k
    before the shuffle, so a column of unique values is no burden."""
    rank = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value")))
    return (
        counts.filter(F.col("value").isNotNull())
        .withColumn("rank", rank)
        .filter(F.col("rank") <= k)
        .select("column", "rank", "value", "n")
    )


def typos(counts: DataFrame, known: list[str] = KNOWN_PRODUCT_TYPES) -> DataFrame:
    """Values one slip away from a known one: a doubled plural s, or one letter
    more or less at the end.  Works on distinct values."""
    v = F.lower(strip(F.col("value")))
    c = F.lower(strip(F.col("correct")))
    rest = F.replace(v, c, F.lit(""))
    slip = (
        (v.contains(c) & rest.isin("s", "ss"))
        | ((F.length(v) == F.length(c) - 1) & c.startswith(v))
        | ((F.length(v) == F.length(c) + 1) & v.startswith(c))
    )
    words = F.explode(F.array(*[F.lit(w) for w in known])).alias("correct")
    return (
        counts.filter(F.col("value").isNotNull())
        .select("column", "value", "n", words)
        .filter((v != c) & slip)
        .select("column", F.col("value").alias("typo"), "correct", F.col("n").alias("occurrences"))
    )


def _values(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).cast("string").alias("value")).filter(F.col("value").isNotNull())


def _format_check(df: DataFrame, column: str) -> list[DataFrame]:
    low = column.lower()
    out = []

    def row(frame: DataFrame, rule: str, measure: Column, fails: Column) -> None:
        out.append(
            frame.agg(measure.alias("value")).select(
                F.lit(column).alias("column"), F.lit(rule).alias("rule"), "value", fails.alias("flagged")
            )
        )

    value = F.col("value")
    if "name" in low and "product" not in low and "campaign" not in low:
        mixed = (value != title(value)) & (value != F.upper(value)) & (value != F.lower(value))
        row(_values(df, column), "mixed-case names", F.count_if(mixed), value > 0)
    if "email" in low:
        # a missing address counts as invalid, an empty one does not
        text = F.coalesce(F.col(column).cast("string"), F.lit("nan"))
        row(df, "invalid emails", F.count_if((text != "") & ~text.rlike(EMAIL)), value > 0)
    if "phone" in low or "contact" in low:
        digits = F.length(F.regexp_replace(value, r"\D", ""))
        row(_values(df, column), "phone lengths", F.count_distinct(digits), value > 2)
    return out


def format_checks(df: DataFrame) -> DataFrame:
    """Checks picked by column name, over all values: names, e-mail addresses, phone numbers."""
    return rel.union_all([c for name in data_columns(df) for c in _format_check(df, name)])


def row_checks(df: DataFrame) -> DataFrame:
    """Rows without any value, and rows with more than 80 % NULLs."""
    columns = data_columns(df)
    nulls = sum((F.col(c).isNull().cast("int") for c in columns), F.lit(0))
    return df.select(nulls.alias("nulls")).agg(
        F.count_if(F.col("nulls") == len(columns)).alias("empty_rows"),
        F.count_if(F.col("nulls") / len(columns) > MOSTLY_NULL).alias("mostly_null_rows"),
    )
