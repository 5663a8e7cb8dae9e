"""Join and aggregate shapes used on their own by checks and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


# Rows of a join's side: fewer may be broadcast, if Spark finds them small; so many in a partition may be hashed in memory.
BROADCAST_ROWS, HASHED_ROWS = 1_000_000, 200_000


def hashed(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of ``rows`` rows, for the side of a join with a far larger table that need not be sorted then:
    partitions of ``df`` are hashed in memory, where it is too large to be broadcast and its partitions are small."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.hint("shuffle_hash") if BROADCAST_ROWS < rows <= HASHED_ROWS * partitions else df


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def without_partner(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``left`` that find no row in ``right``."""
    keys = [on] if isinstance(on, str) else on
    return left.join(right.select(*keys), keys, "left_anti")


def orphans(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """As ``without_partner``, but a NULL key is no violation."""
    return without_partner(left.filter(F.col(key).isNotNull()), right, key)


def repeated(df: DataFrame, keys: list[str], count: str = "occurrences") -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count("*").alias(count)).filter(F.col(count) > 1)


def count_tuples(*columns: str) -> Column:
    """Distinct combinations; one with a NULL in it counts like any other."""
    return F.count_distinct(F.struct(*columns))


def joined_text(df: DataFrame, keys: list[str], column: str, name: str, sep: str = ", ") -> DataFrame:
    """Distinct values of ``column`` per key, sorted, as one text.

    Equal values are removed by a shuffle on (key, value) first, so that what
    meets in one place is the result itself.
    """
    distinct = df.select(*keys, column).filter(F.col(column).isNotNull()).distinct()
    return distinct.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_list(column)), sep).alias(name))


def sorted_values(df: DataFrame, keys: list[str], column: str, name: str) -> DataFrame:
    """Distinct values per key as a sorted array."""
    distinct = df.select(*keys, column).distinct()
    return distinct.groupBy(*keys).agg(F.sort_array(F.collect_list(column)).alias(name))


def side_by_side(*one_row: DataFrame) -> DataFrame:
    """One-row results next to each other."""
    return reduce(lambda a, b: a.crossJoin(b), one_row)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Rows of like tables one after the other; absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
