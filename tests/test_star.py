"""Views and loaders against plain joins, on stars with hot keys."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.operators import dimensions as dims
from tallyhouse.operators import facts, quality
from tallyhouse.plans import kpis, views


def frame(spark, table, data):
    return spark.createDataFrame(data, schemas.warehouse_schema(table))


@pytest.fixture(scope="module")
def hot_star(spark):
    """A third of the orders share user, merchant and day; a third of the lines
    share the product and one order; some users are stubs, some prices missing."""
    rnd = random.Random(11)
    days = [dt.date(2020, 1, 1) + dt.timedelta(i) for i in range(60)]
    key = lambda d: d.year * 10000 + d.month * 100 + d.day
    pick = lambda n: 1 if rnd.random() < 0.34 else rnd.randrange(1, n)
    orders, lines, rows = [], {}, {}
    for i in range(300):
        day = days[0] if rnd.random() < 0.34 else rnd.choice(days)
        o = (f"o{i}", pick(40), pick(15), pick(6), key(day), 3, rnd.choice([0, 0, 2, 5, None]))
        orders.append(o)
        if rnd.random() < 0.8:
            for _ in range(90 if i == 0 else rnd.randrange(1, 4)):
                p = rnd.randrange(1, 120) if i == 0 else pick(30)
                lines[(o[0], p)] = (o[0], p, o[1], o[2], o[3], o[4], Decimal("1.50"), rnd.choice([0, 1, 5]))
        if rnd.random() < 0.7:
            c = pick(5)
            rows[(c, o[1], o[2], o[4])] = (o[0], c, o[1], o[2], o[4], rnd.choice([0, 1, None]))
    blank = [None] * 4
    return {
        "fact_orders": frame(spark, "fact_orders", orders),
        "fact_line_items": frame(spark, "fact_line_items", list(lines.values())),
        "fact_campaign_transactions": frame(spark, "fact_campaign_transactions", list(rows.values())),
        "dim_user": frame(
            spark,
            "dim_user",
            [
                (i, f"U{i}", None, None, None, None if i % 7 == 0 else f"city{i % 2}", "land", None, None, None, None if i % 7 == 0 else f"t{i % 3}", None)
                for i in range(1, 40)
            ],
        ),
        "dim_merchant": frame(spark, "dim_merchant", [(i, f"M{i}", f"m{i}", *blank, None, None) for i in range(1, 16)]),
        "dim_staff": frame(spark, "dim_staff", [(i, f"S{i}", f"s{i}", *blank, None, None, None) for i in range(1, 7)]),
        "dim_product": frame(
            spark, "dim_product", [(i, f"P{i}", None, f"k{i % 3}", None if i % 11 == 0 else Decimal(i)) for i in range(1, 120)]
        ),
        "dim_campaign": frame(spark, "dim_campaign", [(i, f"C{i}", f"c{i}", None, Decimal(i)) for i in range(1, 6)]),
        "dim_date": dims.build_calendar(spark, days[0], days[-1]),
        "dim_user_job": dims.empty_table(spark, "dim_user_job"),
        "dim_credit_card": dims.empty_table(spark, "dim_credit_card"),
    }


def flat(star):
    """Everything joined, one row per line of an order, as the slow way round."""
    lines = star["fact_line_items"].select("order_id", "product_sk", "quantity")
    product = star["dim_product"].select("product_sk", "product_id", F.col("price").alias("list_price"))
    return (
        star["fact_orders"]
        .join(lines, "order_id", "left")
        .join(product, "product_sk", "left")
        .join(star["dim_user"].select("user_sk", "user_type", "country", "city"), "user_sk", "left")
        .join(star["dim_merchant"].select("merchant_sk", "merchant_id"), "merchant_sk", "left")
        .join(star["dim_staff"].select("staff_sk", "staff_id"), "staff_sk", "left")
        .join(star["dim_date"].select(F.col("date_sk").alias("transaction_date_sk"), "date"), "transaction_date_sk", "left")
        .withColumn("revenue", F.col("quantity") * F.col("list_price"))
    )


def measures():
    late = F.count_distinct(F.when(F.col("delay_days") > 0, F.col("order_id")))
    return {
        "orders": F.count_distinct("order_id"),
        "users": F.count_distinct("user_sk"),
        "merchants": F.count_distinct("merchant_id"),
        "staff": F.count_distinct("staff_id"),
        "products": F.count_distinct("product_id"),
        "items": F.sum("quantity"),
        "revenue": F.sum("revenue"),
        "per_line": F.avg(F.col("revenue").cast("double")),
        "late": late,
        "line_delay": F.avg("delay_days"),
        "quantity": F.avg("quantity"),
        "first": F.min("date"),
        "last": F.max("date"),
        "taken": F.count_distinct(F.when(F.col("availed") == 1, F.col("order_id"))),
    }


# view -> (its grouping columns from flat columns, its measures)
PLAIN = {
    "vw_campaign_performance": (
        {"campaign_id": "campaign_id"},
        {
            "total_orders": "orders",
            "unique_customers": "users",
            "total_quantity_sold": "items",
            "total_revenue": "revenue",
            "avg_order_value": "per_line",
            "orders_with_campaign": "taken",
        },
    ),
    "vw_merchant_performance": (
        {"merchant_id": "merchant_id"},
        {
            "total_orders": "orders",
            "unique_customers": "users",
            "total_items_sold": "items",
            "total_revenue": "revenue",
            "avg_order_value": "per_line",
            "staff_count": "staff",
            "delayed_orders": "late",
        },
    ),
    "vw_customer_segment_revenue": (
        {"customer_segment": "user_type", "customer_country": "country", "customer_city": "city"},
        {
            "total_orders": "orders",
            "unique_customers": "users",
            "total_items_purchased": "items",
            "total_revenue": "revenue",
            "avg_order_value": "per_line",
            "first_order_date": "first",
            "last_order_date": "last",
            "merchants_purchased_from": "merchants",
            "unique_products_purchased": "products",
        },
    ),
    "vw_segment_revenue_by_time": (
        {"date": "date", "customer_segment": "user_type"},
        {
            "total_orders": "orders",
            "unique_customers": "users",
            "total_items_sold": "items",
            "total_revenue": "revenue",
            "avg_order_value": "per_line",
        },
    ),
    "vw_sales_by_time": (
        {"date": "date"},
        {
            "total_orders": "orders",
            "unique_customers": "users",
            "total_items_sold": "items",
            "total_revenue": "revenue",
            "avg_order_value": "per_line",
            "delayed_orders": "late",
            "avg_delay_days": "line_delay",
        },
    ),
    "vw_product_performance": (
        {"product_id": "product_id"},
        {
            "total_orders": "orders",
            "unique_customers": "users",
            "total_quantity_sold": "items",
            "total_revenue": "revenue",
            "avg_quantity_per_order": "quantity",
            "merchants_selling": "merchants",
        },
    ),
    "vw_staff_performance": (
        {"staff_id": "staff_id"},
        {
            "total_orders_processed": "orders",
            "unique_customers_served": "users",
            "total_items_processed": "items",
            "total_revenue_generated": "revenue",
            "merchants_worked_with": "merchants",
        },
    ),
}


def plain(v):
    if isinstance(v, (float, Decimal)):
        return round(float(v), 6)
    return v


@pytest.mark.parametrize("name", PLAIN)
def test_view_equals_plain_joins(spark, hot_star, name):
    groups, wanted = PLAIN[name]
    joined = flat(hot_star)
    if name == "vw_campaign_performance":
        taken = hot_star["fact_campaign_transactions"].select("order_id", "campaign_sk", "availed")
        joined = joined.join(taken, "order_id").join(hot_star["dim_campaign"].select("campaign_sk", "campaign_id"), "campaign_sk")
    if name == "vw_product_performance":
        joined = joined.filter(F.col("product_id").isNotNull())
    known = measures()
    want = joined.groupBy(*[F.col(c).alias(n) for n, c in groups.items()]).agg(*[known[m].alias(n) for n, m in wanted.items()])
    got = views.VIEWS[name](hot_star).select(*want.columns)
    order = lambda rows: sorted((tuple(plain(v) for v in r) for r in rows), key=repr)
    assert order(got.collect()) == order(want.collect())


def test_view_total_equals_direct_total(hot_star):
    assert kpis.revenue_consistency(hot_star).first().status == "MATCH"
    assert quality.referential(hot_star).filter("violations > 0").isEmpty()


def test_nulls_come_first_when_sorting_down(hot_star):
    revenue = [r.total_revenue for r in views.product_performance(hot_star).collect()]
    known = [r for r in revenue if r is not None]
    assert revenue[: len(revenue) - len(known)] == [None] * (len(revenue) - len(known))
    assert known == sorted(known, reverse=True)


def test_tuples_with_nulls_count(spark):
    from tallyhouse.operators import relational as rel

    df = spark.createDataFrame([("a", None), ("a", None), ("a", "b"), (None, None)], "x string, y string")
    assert df.agg(rel.count_tuples("x", "y")).first()[0] == 3


# --- loaders ---------------------------------------------------------------------------


def batch(spark, ddl, data):
    return spark.createDataFrame(data, ddl)


def test_upsert_keeps_keys_and_takes_the_last_row(spark):
    ddl = "product_id string, product_name string, product_type string, price decimal(10,2), ingest_seq bigint"
    first = dims.upsert_dimension(
        "dim_product", dims.empty_table(spark, "dim_product"), batch(spark, ddl, [("A", "a", "t", Decimal(1), 1), ("B", "b", "t", Decimal(2), 2)])
    )
    keys = {r.product_id: r.product_sk for r in first.collect()}
    assert sorted(keys.values()) == [1, 2]
    second = dims.upsert_dimension(
        "dim_product",
        first,
        batch(spark, ddl, [("B", "old", "t", Decimal(3), 1), ("B", "<null>", "t2", None, 5), ("C", "c", "t", Decimal(4), 3), (None, "x", "t", None, 4)]),
    )
    got = {r.product_id: r for r in second.collect()}
    assert got["A"].product_sk == keys["A"] and got["B"].product_sk == keys["B"] and got["C"].product_sk == 3
    assert (got["B"].product_name, got["B"].product_type, got["B"].price) == (None, "t2", None)
    assert got["A"].product_name == "a" and len(got) == 3


def test_partial_upsert_of_orders(spark):
    ddl = schemas.WAREHOUSE["fact_orders"]
    current = batch(spark, ddl, [("known", 1, 1, 1, 20200101, 5, 0)])
    offered = batch(
        spark, ddl + ", __seq bigint", [("known", 9, 9, 9, 20209999, 7, 3, 1), ("new", 2, 2, 2, 20200102, 1, 1, 5), ("new", 3, 3, 3, 20200103, 8, None, 9)]
    )
    got = {r.order_id: tuple(r)[1:] for r in facts.upsert_orders(current, offered).collect()}
    assert got == {"known": (1, 1, 1, 20200101, 7, 3), "new": (2, 2, 2, 20200102, 8, None)}


def test_campaign_rekey_with_taken_key(spark):
    dim = frame(spark, "dim_campaign", [(1, "UNKNOWN", "Unknown Campaign", None, Decimal(0)), (2, "LATE", "l", None, Decimal(1))])
    fact = frame(
        spark,
        "fact_campaign_transactions",
        [("o1", 1, 7, 7, 20200101, 1), ("o0", 2, 7, 7, 20200101, 0), ("o2", 1, 8, 8, 20200101, 1), ("o3", 1, 8, 8, 20200102, None)],
    )
    staged = batch(spark, "order_id string, campaign_id string", [("o1", "LATE"), (" o2 ", "LATE"), ("o2", "ZZZ"), ("o3", "NEVER"), (None, "LATE")])
    moved, counted = facts.rekey_late_campaigns(fact, dim, staged)
    assert {r.order_id: r.campaign_sk for r in moved.collect()} == {"o1": 1, "o0": 2, "o2": 2, "o3": 1}
    assert tuple(counted.first()) == (1, 1)


def test_unequal_feeds_are_cut_to_the_shorter(spark):
    from tallyhouse.operators.keys import BLOCK_BITS

    seq = lambda i: ((i // 3) << BLOCK_BITS) + i  # noqa: E731  three rows per block
    prices = batch(
        spark,
        "line_item_id string, order_id string, price decimal(10,2), quantity int, ingest_seq bigint",
        [(f"l{i}", f"x{i}", Decimal(i), i, seq(i)) for i in range(8)],
    )
    products = batch(
        spark, "line_item_id string, order_id string, product_id string, ingest_seq bigint", [("p", f"o{i}", f"P{i}", seq(i)) for i in range(5)]
    )
    got = sorted((r.order_id, r.line_item_id, int(r.price)) for r in facts.zip_by_position(products, prices).collect())
    assert got == [(f"o{i}", f"l{i}", i) for i in range(5)]


def test_repeated_delays_the_last_one_counts(spark):
    orders = batch(
        spark,
        "order_id string, user_id string, transaction_date date, estimated_arrival_days int, staff_id string, ingest_seq bigint",
        [(" o1 ", "U1", dt.date(2020, 1, 1), 3, "ignored", 1), ("o1", "U2", dt.date(2020, 1, 2), 9, None, 2), ("lost", "U1", dt.date(2020, 1, 1), 1, None, 3)],
    )
    merchants = batch(spark, "order_id string, merchant_id string, staff_id string, ingest_seq bigint", [("o1", "M1", "S1", 1), ("o1", "M2", "S2", 2)])
    delays = batch(spark, "order_id string, delay_days int, ingest_seq bigint", [("o1", 4, 1), ("o1", 6, 2)])
    star = {
        "dim_user": frame(spark, "dim_user", [(5, "U1", *[None] * 10)]),
        "dim_merchant": frame(spark, "dim_merchant", [(6, "M1", *[None] * 7)]),
        "dim_staff": frame(spark, "dim_staff", [(7, "S1", *[None] * 8)]),
        "dim_date": dims.build_calendar(spark),
    }
    load = facts.load_orders(dims.empty_table(spark, "fact_orders"), orders, merchants, delays, star)
    assert [tuple(r) for r in load.table.collect()] == [("o1", 5, 6, 7, 20200101, 3, 6)]
    assert load.rejects.isEmpty()
    # rejected, it comes out once per delay
    lost = facts.load_orders(
        dims.empty_table(spark, "fact_orders"), orders, merchants, delays, {**star, "dim_user": star["dim_user"].limit(0)}
    )
    assert sorted('"delay_days":4' in r.raw_data for r in lost.rejects.collect()) == [False, True]
    none = facts.load_orders(dims.empty_table(spark, "fact_orders"), orders, merchants, None, star, missing_delay=None)
    assert none.table.first().delay_days is None


def test_text_dates_that_reach_the_loader(spark):
    orders = batch(
        spark,
        "order_id string, user_id string, transaction_date string, estimated_arrival_days string, ingest_seq bigint",
        [("o1", "U1", "soon", "3days", 1), ("o2", "U1", "2020-02-03", "4days", 2)],
    )
    merchants = batch(spark, "order_id string, merchant_id string, staff_id string, ingest_seq bigint", [("o1", "M1", "S1", 1), ("o2", "M1", "S1", 2)])
    star = {
        "dim_user": frame(spark, "dim_user", [(5, "U1", *[None] * 10)]),
        "dim_merchant": frame(spark, "dim_merchant", [(6, "M1", *[None] * 7)]),
        "dim_staff": frame(spark, "dim_staff", [(7, "S1", *[None] * 8)]),
        "dim_date": dims.build_calendar(spark),
    }
    load = facts.load_orders(dims.empty_table(spark, "fact_orders"), orders, merchants, None, star)
    assert load.rejects.first().error_reason == "invalid transaction_date format 'soon'"
    assert [(r.order_id, r.estimated_arrival_days) for r in load.table.collect()] == [("o2", 4)]


def test_campaign_without_unknown_member(spark):
    dim = frame(spark, "dim_campaign", [(2, "C", "c", None, Decimal(1))])
    orders = frame(spark, "fact_orders", [("o1", 1, 1, 1, 20200101, 1, 0)])
    rows = batch(
        spark, "order_id string, campaign_id string, availed int, ingest_seq bigint", [("o1", "C", 1, 1), ("o1", "X", 1, 2), ("o1", None, 1, 3)]
    )
    load = facts.load_campaign_transactions(dims.empty_table(spark, "fact_campaign_transactions"), rows, dim, orders)
    assert load.table.count() == 1
    assert sorted(r.error_reason for r in load.rejects.collect()) == [
        "campaign_id 'X' not found in dim_campaign and Unknown campaign not available",
        "campaign_id is NULL and Unknown campaign not available",
    ]


def test_calendar(spark):
    days = dims.build_calendar(spark)
    assert days.count() == 2192
    assert dims.extend_calendar(days, days).count() == 2192
    row = days.filter("date_sk = 20240229").first()
    assert (row.month_name, row.quarter, row.day) == ("February ", "Q1", 29)
    weekend = dims.build_calendar(spark, extended=True).filter("date_sk = 20240302").first()
    assert weekend.is_weekend and weekend.day_name == "Saturday"


def test_sample_star_loads_only_what_is_asked_for(spark, tmp_path):
    from tallyhouse.plans import sample_star

    day = dt.datetime(1996, 1, 2)
    tables = {
        "region": ("r_regionkey int, r_name string", [(0, "ASIA")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(k, f"N{k}", 0) for k in range(25)]),
        "customer": ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", [(1, "c", 0, 1.0, "BUILDING")]),
        "supplier": ("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double", [(2, "s", 0, 1.0)]),
        "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double", [(3, "p", "b", "LARGE", 1, 2.5)]),
        "orders": (
            "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
            [(7, 1, "F", 9.0, day, "1-URGENT"), (8, 99, "O", 9.0, day, "1-URGENT")],
        ),
        "lineitem": (
            "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
            "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
            [(7, 3, 2, 1, 4.0, 10.0, 0.0, 0.0, "N", "O", day), (8, 3, 2, 1, 4.0, 10.0, 0.0, 0.0, "N", "O", day)],
        ),
    }
    for name, (ddl, data) in tables.items():
        spark.createDataFrame(data, ddl).write.parquet(f"{tmp_path}/{name}.parquet")
    star = sample_star.star(spark, str(tmp_path))
    assert "fact_line_items" in star and not star._made
    assert [r.order_id for r in star["fact_orders"].collect()] == ["O7"]
    assert set(star._made) == {"dim_user", "dim_merchant", "dim_staff", "dim_date", "fact_orders"}
    assert sample_star._key(spark, str(tmp_path)) not in sample_star._lines  # the line feed was not sorted
    early = star.replaced(fact_orders=lambda: star["fact_orders"].limit(0))
    assert early["fact_orders"].isEmpty() and early["dim_user"] is star["dim_user"]
    assert [(r.order_id, r.quantity) for r in star["fact_line_items"].collect()] == [("O7", 4)]
    assert [r.order_id for r in star["reject_fact_line_items"].collect()] == ["O8"]
    assert [(r.product_id, r.source_file) for r in star["reject_fact_line_items"].collect()] == [("PRODUCT3", "lines-N.csv")]
    assert len(dict(star)) == len(star) == 14


@pytest.fixture
def line_feeds(spark):
    """Orders in several blocks and spellings, repeats, unknown and missing keys, feeds of unequal length."""
    rnd = random.Random(11)
    ids = ["o1", " o1 ", "o2", "o3", "o4", "lost", "", None]
    products = [(rnd.choice(ids), rnd.choice(["p1", "p2 ", "p3", "none", "", None]), (k % 3) << 28 | k, "f") for k in range(400)]
    prices = [(rnd.choice(ids), None, f"{k}.50", f"{k % 9}pcs" if k % 11 else None, (k % 5) << 28 | k) for k in range(430)]
    dim = spark.createDataFrame([(k, f"p{k}") for k in (1, 2, 3)], "product_sk long, product_id string")
    orders = spark.createDataFrame(
        [(f"o{k}", k, k + 1, k + 2, 19980101) for k in (1, 2, 3)],
        "order_id string, user_sk long, merchant_sk long, staff_sk long, transaction_date_sk int",
    )
    return (
        spark.createDataFrame(prices, "order_id string, line_item_id string, price string, quantity string, ingest_seq long"),
        spark.createDataFrame(products, "order_id string, product_id string, ingest_seq long, file_source string"),
        dim,
        orders,
    )


def test_orders_in_one_place_load_like_orders_spread_over_tasks(spark, line_feeds, rows):
    empty = dims.empty_table(spark, "fact_line_items")
    spread, together = (facts.load_line_items(empty, *line_feeds, pairing="order", large_order=n) for n in (0, 1000))
    known = spread.table.filter("product_sk < 3")
    later = [facts.load_line_items(known, *line_feeds, pairing="order", large_order=n).added for n in (0, 1000)]
    for a, b in ((spread.table, together.table), (spread.offered, together.offered), tuple(later)):
        assert rows(a, *a.columns) == rows(b, *a.columns) != []
    shown = [c for c in spread.rejects.columns if c != "rejected_at"]
    assert rows(spread.rejects, *shown) == rows(together.rejects, *shown) != []


def test_line_load_shuffles_both_feeds_once(spark, line_feeds):
    empty = dims.empty_table(spark, "fact_line_items")
    plan = facts.load_line_items(empty, *line_feeds, pairing="order").table._jdf.queryExecution().executedPlan().toString()
    # both feeds together, then the orders, and the products where Spark does not broadcast them
    assert plan.count("Exchange hashpartitioning") <= 4
    assert "SortAggregate" not in plan


def test_repeated_pairs_are_staged_once(spark, rows):
    lines = spark.createDataFrame(
        [("a", "p", "f1", 1), ("a", "p", "f2", 2), ("b", "p", "f1", 3), (None, "p", "f1", 4), (None, "p", "f1", 5), ("c", None, "f1", 6), ("c", None, "f1", 7)],
        "order_id string, product_id string, file_source string, loaded_at int",
    )
    staged = []

    def stage(df, label):
        staged.append(label)
        return spark.createDataFrame(df.collect(), df.schema)

    got = quality.repeated_pairs(lines, top=None, stage=stage)
    assert staged == ["repeated_pairs"]
    assert rows(got, *got.columns) == [("a", "p", 2, "f1, f2", 1, 2), (None, "p", 2, None, 4, 5)]


@pytest.mark.parametrize("twice", [False, True])
def test_products_are_looked_up_before_the_lines_are_paired(spark, line_feeds, rows, monkeypatch, twice):
    """Rows are narrow then; a dimension that names a product twice is looked up afterwards, as it would shift positions."""
    prices, products, dim, orders = line_feeds
    if twice:
        dim = dim.unionByName(spark.createDataFrame([(9, "p1"), (8, None), (7, None)], dim.schema))
    empty = dims.empty_table(spark, "fact_line_items")
    together, spread = (facts.load_line_items(empty, prices, products, dim, orders, pairing="order", large_order=n) for n in (1000, 0))
    assert rows(together.table, *empty.columns) == rows(spread.table, *empty.columns) != []
    shown = [c for c in spread.rejects.columns if c != "rejected_at"]
    assert rows(spread.rejects, *shown) == rows(together.rejects, *shown) != []
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        load = facts.load_line_items(empty, prices, products, dim, orders, pairing="order")
        plan = load.offered._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # the plan names what comes later first
    assert (plan.index("Window") < plan.index("hashpartitioning(product_id")) == (not twice)


@pytest.mark.parametrize("groups", [1, 1 << 16])
def test_large_orders_are_found_also_among_others_of_their_group(spark, monkeypatch, groups):
    monkeypatch.setattr(facts, "ORDER_GROUPS", groups)
    feeds = [spark.createDataFrame([(o,) for o in ids], "order_id string") for ids in (["a"] * 4 + ["b"] * 5 + [None] * 20, [" a "] * 3 + ["c"] * 7)]
    assert facts.has_large_orders(*feeds, 6) and not facts.has_large_orders(*feeds, 7)


def test_conflicts_are_counted_in_one_pass(spark, tmp_path):
    """Repeated, unknown and missing keys on either side; a product with two keys and one that is named twice alike."""
    rnd = random.Random(5)
    orders, products = ["a", "b", "c", "d", None], ["p1", "p2", "p3", "p4", "lost", None]
    staged = [(rnd.choice(orders), rnd.choice(products), "f") for _ in range(120)]
    dim = [(1, "p1"), (2, "p2"), (22, "p2"), (3, "p3"), (3, "p3"), (None, "p4"), (5, None)]
    fact = [(rnd.choice(orders), rnd.choice([1, 2, 22, 3, 4, None])) for _ in range(14)]

    def stored(data, name, schema):
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    lines = stored(staged, "lines", "order_id string, product_id string, file_source string")
    star = {
        "dim_product": stored(dim, "dim", "product_sk long, product_id string"),
        "fact_line_items": stored(fact, "fact", "order_id string, product_sk long"),
    }
    got = quality.conflict_summary(lines, star)
    named = [(o, p) for o, p, _ in staged if p]
    loaded = {f for f in fact if None not in f}
    clash = sum((o, k) in loaded for o, p in named for k, q in dim if p == q)
    u, twice = len(set(named)), len(named) - len(set(named))
    r = got.first()
    assert (r.unique_in_staging, r.fact_rows, r.unique_in_fact, r.duplicates_in_fact) == (u, 14, len(set(fact)), 14 - len(set(fact)))
    assert (r.difference, r.would_conflict, r.duplicates_in_staging, r.total_conflicts) == (u - 14, clash, twice, clash + twice)
    assert r.conflict_percentage == round(100 * Decimal(clash + twice) / u, 2) and clash > 0
    assert quality.would_conflict(lines, star).count() == clash
    assert quality.staged_pair_totals(lines).first()[:2] == (len(named), u)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3  # each table once
    none = quality.conflict_summary(lines.limit(0), {n: t.limit(0) for n, t in star.items()}).first()
    assert (none.unique_in_staging, none.fact_rows, none.would_conflict, none.total_conflicts) == (0, 0, 0, 0)


def test_a_large_dimension_is_hashed_by_partition(spark, line_feeds, rows, monkeypatch):
    from tallyhouse.operators import relational

    empty = dims.empty_table(spark, "fact_line_items")
    plain = facts.load_line_items(empty, *line_feeds, pairing="order")
    assert "ShuffledHashJoin" not in plain.offered._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(relational, "BROADCAST_ROWS", 2)
    load = facts.load_line_items(empty, *line_feeds, pairing="order")
    assert "ShuffledHashJoin" in load.offered._jdf.queryExecution().executedPlan().toString()
    assert rows(load.table, *empty.columns) == rows(plain.table, *empty.columns) != []
    star = {"dim_product": line_feeds[2], "fact_line_items": plain.table}
    hashed = quality.conflict_summary(line_feeds[1], star).first()
    monkeypatch.setattr(relational, "HASHED_ROWS", 0)  # partitions would be too large
    merged = quality.conflict_summary(line_feeds[1], star)
    assert "ShuffledHashJoin" not in merged._jdf.queryExecution().executedPlan().toString()
    assert merged.first() == hashed and hashed.would_conflict > 0
