"""Places of rows in a global order, without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.session import materialize


def row_in_task() -> Column:
    """0, 1, 2, ... within the task that reads the row."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))


def placed(df: DataFrame, order: list[str], label: str, parts: int | None = None) -> DataFrame:
    """``df`` written in the order of the ``order`` columns (nulls first), with ``part`` and ``row`` in it.

    Range partitioning reads its input twice, so ``df`` should be a written table.
    """
    by = [F.col(c).asc_nulls_first() for c in order]
    ranges = df.repartitionByRange(parts, *by) if parts else df.repartitionByRange(*by)
    return materialize(
        ranges.sortWithinPartitions(*by).select("*", F.spark_partition_id().alias("part"), row_in_task().alias("row")), label
    )


def ranked(df: DataFrame, group: str, order: list[str], label: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``rank`` (from 0) of every row in its group, and ``group, n`` of all groups.

    Rows are sorted into ranges of (group, order), so one group may fill many tasks; only the number
    of rows of a group in each task goes through a window.  ``group`` holds no null.
    """
    rows = placed(df, [group, *order], label)
    sizes = rows.groupBy(group, "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select(group, "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    out = rows.join(shift, [group, "part"]).withColumn("rank", F.col("row") + F.col("shift")).drop("part", "row", "shift")
    return out, sizes.groupBy(group).agg(F.sum("n").alias("n"))
