"""First/last row per key, gap-free positions and surrogate keys.

Nothing here puts one key's rows, or a whole table, through a single task:

* first/last per key is an aggregate with a partial step on the map side;
* positions are counted inside blocks and shifted by the sizes of the blocks
  before.  A block is the set of rows one ingest task wrote.

``ingest_seq`` is the order of arrival: the number of the block (a file split,
or the task that wrote the rows) in the upper bits, the row's place within the
block in the lower ``BLOCK_BITS``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

Stage = Callable[[DataFrame, str], DataFrame]
BLOCK_BITS = 28  # a split of 128 MiB holds fewer rows than that
FILE_BITS = 43  # place within a file or batch; above it the number of the file or batch
SURROGATE_BUCKETS = 256


def with_ingest_seq(df: DataFrame, name: str = "ingest_seq") -> DataFrame:
    """Number the rows in reading order.

    Must be written out before use: the numbers belong to this very pass.
    """
    return df.withColumn(name, F.shiftleft(F.spark_partition_id().cast("bigint"), BLOCK_BITS) + row_in_task())


def row_in_task() -> Column:
    """0, 1, 2, ... within the task that reads the row."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))


def ingest_block(seq: str | Column) -> Column:
    return F.shiftright(F.col(seq) if isinstance(seq, str) else seq, BLOCK_BITS)


def _one_per_key(df: DataFrame, keys: list[str], order: str, pick: str) -> DataFrame:
    """One whole row per key: a single aggregate buffer, and rows of equal order are told apart by
    their values, so the choice does not depend on the partitioning."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    quoted = ", ".join(f"`{c}`" for c in rest)
    # one struct, led by what decides: a buffer holds no value twice
    others = "".join(f", `{c}` AS c{k}" for k, c in enumerate(rest) if c != order)
    kept = F.expr(f"{pick}(struct(`{order}` AS first, xxhash64({quoted}) AS tie{others}))").alias("__row")
    one = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(kept)
    place = {c: "first" if c == order else f"c{k}" for k, c in enumerate(rest)}
    return one.select(*[F.col(f"`{c}`") if c in keys else F.col(f"__row.{place[c]}").alias(c) for c in df.columns])


def first_per_key(df: DataFrame, keys: list[str], order: str = "ingest_seq") -> DataFrame:
    """The row that came first for each key (insert-or-ignore in one batch)."""
    return _one_per_key(df, keys, order, "min")


def last_per_key(df: DataFrame, keys: list[str], order: str = "ingest_seq") -> DataFrame:
    """The row that came last for each key (overwrite in one batch)."""
    return _one_per_key(df, keys, order, "max")


def with_group_position(
    df: DataFrame,
    keys: list[str],
    seq: str = "ingest_seq",
    name: str = "position",
    stage: Stage = lambda df, label: df,
    few: bool = False,
) -> DataFrame:
    """1, 2, 3, ... within each key by arrival.

    The window runs per (key, block), so a key that holds a large part of the
    table is spread over as many groups as there were ingest tasks.

    Only keys with rows in several blocks are shifted.  Where ``stage`` writes
    the shifts, their size is known before the rows are joined with them: few
    are broadcast, and the rows are not shuffled for that join.  ``few`` says
    that the shifts are few whatever the feed: keys that are files have one row
    per file and ingest task.
    """
    block = "__block"
    blocked = df.withColumn(block, ingest_block(seq))
    local = blocked.withColumn(
        name, F.row_number().over(Window.partitionBy(*keys, block).orderBy(seq))
    )
    sizes = blocked.groupBy(*keys, block).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        sizes.withColumn("__shift", F.sum("__n").over(before))
        .filter(F.col("__shift") > 0)  # first blocks need no shift
        .select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(block).alias("__b"), "__shift")
    )
    shifts = F.broadcast(shifts) if few else stage(shifts, "position_shifts")
    on = F.col(block) == F.col("__b")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return local.join(shifts, on, "left").select(
        *df.columns,
        (F.col(name) + F.coalesce(F.col("__shift"), F.lit(0))).cast("bigint").alias(name),
    )


def with_global_position(df: DataFrame, seq: str = "ingest_seq", name: str = "position") -> DataFrame:
    """0, 1, 2, ... over the whole table by arrival, without a global window.

    The window over block sizes has one row per ingest task, not per data row.
    """
    block = "__block"
    blocked = df.withColumn(block, ingest_block(seq))
    local = blocked.withColumn(
        name, F.row_number().over(Window.partitionBy(block).orderBy(seq)) - 1
    )
    sizes = blocked.groupBy(block).agg(F.count("*").alias("__n"))
    before = Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        F.col(block).alias("__b"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift")
    )
    return local.join(shifts, F.col(block) == F.col("__b")).select(
        *df.columns, (F.col(name) + F.col("__shift")).cast("bigint").alias(name)
    )


def with_surrogate_key(
    new_members: DataFrame,
    key: str,
    sk: str,
    current: DataFrame | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Number new members after the highest key in ``current``; 0 is never used.

    Members are numbered by ``key`` inside hash buckets; each bucket is shifted
    by the sizes of those before.  Keys are distinct, so buckets are even; there
    are as many as the session has shuffle partitions, if that is more than usual.
    """
    if buckets is None:
        buckets = max(SURROGATE_BUCKETS, int(new_members.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    split = new_members.selectExpr("*", f"pmod(xxhash64({key}), {buckets}) AS __bucket")
    local = split.selectExpr("*", f"row_number() OVER (PARTITION BY __bucket ORDER BY {key}) AS __local")
    # at most ``buckets`` rows
    shifts = (
        split.groupBy("__bucket")
        .agg(F.count("*").alias("__n"))
        .selectExpr(
            "__bucket",
            "coalesce(sum(__n) OVER (ORDER BY __bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS __shift",
        )
    )
    if current is not None:
        highest = current.agg(F.expr(f"coalesce(max({sk}), 0) AS __highest"))
        shifts = shifts.crossJoin(highest).selectExpr("__bucket", "__shift + __highest AS __shift")
    return local.join(F.broadcast(shifts), "__bucket").selectExpr(
        f"CAST(__local + __shift AS BIGINT) AS {sk}", *new_members.columns
    )
