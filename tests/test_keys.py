"""Ordering helpers against brute force, on data where one key holds most rows."""

import random

from pyspark.sql import functions as F

from tallyhouse.operators import keys


def skewed(spark, n=2000):
    rnd = random.Random(7)
    data = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(50)}"
        block = i // 137  # 15 blocks, not aligned with keys
        data.append((key, (block << keys.BLOCK_BITS) + i, rnd.randrange(1000)))
    rnd.shuffle(data)
    return data, spark.createDataFrame(data, "k string, ingest_seq bigint, v int")


def test_group_position(spark):
    data, df = skewed(spark)
    got = {(r.k, r.ingest_seq): r.position for r in keys.with_group_position(df, ["k"]).collect()}
    want = {}
    for key in {k for k, _, _ in data}:
        for i, seq in enumerate(sorted(s for k, s, _ in data if k == key)):
            want[(key, seq)] = i + 1
    assert got == want


def test_group_position_with_null_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 5 << keys.BLOCK_BITS), ("a", 2)], "k string, ingest_seq bigint")
    got = sorted((str(r.k), r.position) for r in keys.with_group_position(df, ["k"]).collect())
    assert got == [("None", 1), ("None", 2), ("a", 1)]


def test_global_position(spark):
    data, df = skewed(spark)
    got = sorted((r.ingest_seq, r.position) for r in keys.with_global_position(df).collect())
    assert got == [(s, i) for i, s in enumerate(sorted(s for _, s, _ in data))]


def test_first_and_last_per_key(spark):
    data, df = skewed(spark)
    first = {r.k: (r.ingest_seq, r.v) for r in keys.first_per_key(df, ["k"]).collect()}
    last = {r.k: (r.ingest_seq, r.v) for r in keys.last_per_key(df, ["k"]).collect()}
    for key in {k for k, _, _ in data}:
        mine = sorted((s, v) for k, s, v in data if k == key)
        assert first[key] == mine[0] and last[key] == mine[-1]


def test_first_per_key_keeps_null_values_of_the_first_row(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2)], "k string, v int, ingest_seq bigint")
    assert keys.first_per_key(df, ["k"]).first().v is None


def test_last_wins_does_not_depend_on_partitioning(spark):
    _, df = skewed(spark)
    results = [sorted(map(tuple, keys.last_per_key(df.repartition(n), ["k"]).collect())) for n in (1, 3, 8)]
    assert results[0] == results[1] == results[2]


def test_surrogate_keys_are_dense_and_continue(spark):
    ids = spark.range(1000).select(F.concat(F.lit("u"), "id").alias("user_id"))
    first = keys.with_surrogate_key(ids.filter("user_id < 'u5'"), "user_id", "sk", buckets=7)
    n = first.count()
    assert sorted(r.sk for r in first.collect()) == list(range(1, n + 1))
    rest = keys.with_surrogate_key(ids.filter("user_id >= 'u5'"), "user_id", "sk", first, buckets=7)
    assert sorted(r.sk for r in rest.collect()) == list(range(n + 1, 1001))


def test_no_window_without_partition_runs_over_data_rows(spark):
    """The only global windows are over block and bucket sizes."""
    _, df = skewed(spark)
    for plan in (keys.with_global_position(df), keys.with_surrogate_key(df.select("k").distinct(), "k", "sk")):
        text = plan._jdf.queryExecution().optimizedPlan().toString()
        for line in text.splitlines():
            if "Window [" in line and "sum(" not in line:
                assert "__block" in line or "__bucket" in line, line


def test_shifts_of_positions_are_staged_or_broadcast(spark):
    from tallyhouse.operators.keys import BLOCK_BITS

    data = [(k, f"f{k % 2}", (b << BLOCK_BITS) + k) for b in range(3) for k in range(4)]
    df = spark.createDataFrame(data, "k int, file string, ingest_seq bigint")
    staged = []

    def stage(shifts, label):
        staged.append((label, shifts.count()))
        return shifts

    got = {(r.k, r.ingest_seq >> BLOCK_BITS): r.position for r in keys.with_group_position(df, ["k"], stage=stage).collect()}
    assert got == {(k, b): b + 1 for b in range(3) for k in range(4)}
    assert staged == [("position_shifts", 8)]  # first blocks need none
    few = keys.with_group_position(df, ["file"], few=True)
    assert "Broadcast" in few._jdf.queryExecution().sparkPlan().toString() or "broadcast" in few._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.position for r in few.collect()) == sorted([*range(1, 7)] * 2)


def test_one_row_per_key_by_order_then_values(spark):
    df = spark.createDataFrame(
        [("a", 1, 5, "x"), ("a", 2, 4, None), ("b", None, 1, "y"), ("b", 3, 2, "z"), (None, 1, 1, "w")], "k string, `v w` int, ingest_seq int, tie string"
    )
    assert sorted(map(tuple, keys.first_per_key(df, ["k"]).collect()), key=repr) == [("a", 2, 4, None), ("b", None, 1, "y"), (None, 1, 1, "w")]
    assert sorted(map(tuple, keys.last_per_key(df, ["k"]).collect()), key=repr) == [("a", 1, 5, "x"), ("b", 3, 2, "z"), (None, 1, 1, "w")]
    assert keys.first_per_key(df, ["k"]).columns == df.columns
    by_key = keys.first_per_key(df.withColumnRenamed("tie", "t"), ["ingest_seq"])  # the order may be the key itself
    assert by_key.count() == 4
