"""Pruned merges, the change feed, and files that arrive as a stream."""

import random
import shutil

import feeds
import pytest
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.plans import manifest
from tallyhouse.plans.refresh import refresh, upsert_order_files
from tallyhouse.plans.store import Conflict, Store
from tallyhouse.streaming import arrivals

ORDER = "order_id string, user_sk long, merchant_sk long, staff_sk long, transaction_date_sk int, estimated_arrival_days int, delay_days int"


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "warehouse"))


def orders(spark, rows):
    return spark.createDataFrame([(i, 1, 1, 1, day, 3, delay) for i, day, delay in rows], ORDER)


def offered(df):
    return df.withColumn("__seq", F.lit(0))


def test_a_load_that_changes_one_day_rewrites_that_day(spark, store, rows):
    days = [(f"o{d:02d}-{k:03d}", 20240100 + d, 0) for d in range(20) for k in range(50)]
    store.replace("fact_orders", orders(spark, days).repartitionByRange(20, "transaction_date_sk").sortWithinPartitions("order_id"))
    before = store.files("fact_orders")
    day_of = {f: {r[0] for r in store.read_files("fact_orders", [f]).select("transaction_date_sk").distinct().collect()} for f in before}
    gone = upsert_order_files(store, offered(orders(spark, [("o07-001", 20240107, 9), ("o07-050", 20240107, 4), ("o07-002", 20240107, 0)])))
    assert gone and all(20240107 in day_of[f] for f in gone)
    assert set(before) - set(store.files("fact_orders")) == set(gone) and len(gone) <= 2
    want = {i: (9 if i == "o07-001" else d) for i, _, d in days} | {"o07-050": 4}
    assert dict(rows(store.read("fact_orders"), "order_id", "delay_days")) == want
    # the same again changes nothing, and writes nothing
    number = store.version("fact_orders")
    assert upsert_order_files(store, offered(orders(spark, [("o07-001", 20240107, 9)]))) == []
    assert store.version("fact_orders") == number
    # new orders alone replace no file
    assert upsert_order_files(store, offered(orders(spark, [("p1", 20240109, 1)]))) == []
    assert store.read("fact_orders").count() == 1002
    store.vacuum("fact_orders", keep_states=1)
    assert store.read("fact_orders").count() == 1002
    store.merge("fact_orders", ["order_id"])
    assert store.read("fact_orders").count() == 1002 and len(store._folders("fact_orders")) == 1


def test_two_writers_of_one_file(spark, store):
    store.replace("fact_orders", orders(spark, [("a", 1, 0), ("b", 1, 0)]))
    files = store.files("fact_orders")
    store.rewrite("fact_orders", files, orders(spark, [("a", 1, 1), ("b", 1, 1)]))
    with pytest.raises(Conflict):
        store.rewrite("fact_orders", files, orders(spark, [("a", 1, 2), ("b", 1, 2)]))
    assert {r.delay_days for r in store.read("fact_orders").collect()} == {1}


def test_manifests_miss_no_key_and_name_few_other_files(spark):
    rng = random.Random(4)
    ids = [f"{rng.randrange(10**9):x}" for _ in range(20_000)]
    data = spark.createDataFrame([(i, f"f{k % 40}") for k, i in enumerate(ids)] + [(None, "f1")], "k string, file string")
    made = manifest.of_keys(data, "k").persist()
    asked = [ids[5], ids[7], None]
    keys = spark.createDataFrame([(a,) for a in asked], "key string")
    found = {r.file for r in manifest.files_with(made, keys).collect()}
    assert {"f5", "f7"} <= found and len(found) <= 6
    none = spark.createDataFrame([(f"none{k}",) for k in range(50)], "key string")
    assert len(manifest.files_with(made.withColumns({"low": F.lit(""), "high": F.lit("~")}), none).collect()) <= 20
    assert manifest.files_with(made.limit(0), keys).count() == 0
    made.unpersist()


def test_changed_rows(spark, store, rows):
    store.append("fact_orders", orders(spark, [("a", 1, 0)]))
    since = store.version("fact_orders")
    assert store.changed_rows("fact_orders", since).count() == 0
    store.append("fact_orders", orders(spark, [("b", 1, 0), ("c", 2, 0)]).coalesce(1))
    assert rows(store.changed_rows("fact_orders", since), "order_id") == [("b",), ("c",)]
    assert store.changed_rows("fact_orders", 0).count() == 3
    held = store.touched("fact_orders", spark.createDataFrame([("b",)], "k string"))
    store.rewrite("fact_orders", held, orders(spark, [("c", 2, 5)]))
    assert "b" in {i for (i,) in rows(store.changed_rows("fact_orders", since + 1), "order_id")}
    middle = store.version("fact_orders") - 1
    store.vacuum("fact_orders", keep_states=1)
    assert store.changed_rows("fact_orders", middle) is None  # that state is not there any more


def company(root, orders_of, tag=""):
    feeds.orders(root, [f"{i},{u},3days,{d}" for i, u, _, d in orders_of], tag=tag)
    feeds.merchants_of_orders(root, [f"{i},{m},S1" for i, _, m, _ in orders_of], tag=tag)
    feeds.prices(root, [f"{i},2.00,1pc" for i, *_ in orders_of], tag=tag)
    feeds.products_of_orders(root, [f"{i},bars,P{k % 3}" for k, (i, *_) in enumerate(orders_of)], tag=tag)
    feeds.campaign_rows(root, [f"{d},CMP1,{i},3days,1" for i, _, _, d in orders_of], tag=tag)


FACTS = {
    "fact_orders": ["order_id", "transaction_date_sk", "estimated_arrival_days", "delay_days"],
    "fact_line_items": ["order_id", "transaction_date_sk", "quantity"],
    "fact_campaign_transactions": ["order_id", "availed"],
    "reject_fact_orders": ["order_id", "error_reason"],
}


def test_increments_give_what_one_load_gives_and_a_second_load_reads_no_staged_row(spark, store, tmp_path, rows):
    root, whole = tmp_path / "data", tmp_path / "whole"
    first = [(f"o{k}", f"U{k}", "M1" if k % 4 else "LATE", f"2024-01-{1 + k % 9:02d}") for k in range(12)]
    second = [(f"n{k}", f"U{k}", "M1", "2024-02-03") for k in range(3)]
    for r in (root, whole):
        feeds.write(r, "Marketing Department/campaign_data.csv", feeds.CAMPAIGNS)
        feeds.staff_dims(r, ["S1"])
        company(r, first)
    feeds.merchant_dims(root, ["M1"])
    star = refresh(spark, str(root), store)
    assert star["reject_fact_orders"].count() == 3
    # the rejected orders' merchant arrives, with more orders and a delay of a known one
    feeds.write(root, "Enterprise/merchant_data_late.html", feeds.html_table(("", "merchant_id", "name"), [(0, "LATE", "x")]))
    feeds.merchant_dims(whole, ["M1", "LATE"])
    for r in (root, whole):
        company(r, second, tag="_2")
        feeds.write(r, "Operations/order_delays.csv", feeds.csv("order_id,delay in days", ["o1,6", "n1,2"]))
    star = refresh(spark, str(root), store)
    other = Store(spark, str(tmp_path / "other"))
    want = refresh(spark, str(whole), other)
    for t, columns in FACTS.items():
        if t == "reject_fact_orders":
            continue  # the first load's rejects stay on record
        assert rows(star[t], *columns) == rows(want[t], *columns), t
    # nothing new: no staged row is read, as none is there any more, and no fact moves on
    facts = {t: store.version(t) for t in schemas.WAREHOUSE}
    for dataset in schemas.STAGING:
        table = schemas.staging_table(dataset)
        for folder in store._folders(table) if store.exists(table) else []:
            shutil.rmtree(f"{store.root}/{table}/{folder}")
    refresh(spark, str(root), store)
    assert facts == {t: store.version(t) for t in facts}


def test_files_arrive_as_a_stream_with_columns_in_any_order(spark, store, tmp_path, rows):
    root, landing = tmp_path / "data", tmp_path / "landing"
    feeds.merchant_dims(root, ["M1"])
    feeds.staff_dims(root, ["S1"])
    refresh(spark, str(root), store)
    feeds.write(landing, "a/order_data_1.csv", "order_id,user_id,estimated arrival,transaction_date\no1,U1,3days,2024-01-15\n")
    feeds.write(landing, "a/order_data_2.csv", "transaction_date,user_id,order_id,estimated arrival\n2024-01-16,U2,o2,4days\n")
    feeds.write(landing, "a/order_with_merchant_data.csv", "staff_id,order_id,merchant_id\nS1,o1,M1\nS1,o2,M1\n")
    feeds.write(landing, "a/notes.txt", "nothing for the star")
    checkpoint = str(tmp_path / "checkpoint")
    star = arrivals.stream_into_star(spark, str(landing), store, checkpoint)
    columns = ["order_id", "transaction_date_sk", "estimated_arrival_days"]
    assert rows(star["fact_orders"], *columns) == [("o1", 20240115, 3), ("o2", 20240116, 4)]
    users = {r.user_sk: r.user_id for r in star["dim_user"].collect()}
    assert {r.order_id: users[r.user_sk] for r in star["fact_orders"].collect()} == {"o1": "U1", "o2": "U2"}
    # a batch that is tried again adds nothing, anywhere
    listing = spark.createDataFrame([(f"file:{p}", f"file://{p}") for p in map(str, (landing / "a").iterdir())], "path string, file_path string")
    tables = [*schemas.WAREHOUSE, "ingestion_log", *[schemas.staging_table(d) for d in schemas.STAGING]]
    before = {t: (store.version(t), store.read(t).count()) for t in tables}
    arrivals.star_batch(store, listing, "arrivals", 0)
    assert before == {t: (store.version(t), store.read(t).count()) for t in tables}
    assert store.read("ingestion_log").where("file_path like '%landing%'").count() == 3
    # the next batch changes a known order
    feeds.write(landing, "b/order_delays.csv", "delay in days,order_id\n7,o2\n")
    star = arrivals.stream_into_star(spark, str(landing), store, checkpoint)
    assert rows(star["fact_orders"], "order_id", "delay_days") == [("o1", 0), ("o2", 7)]
    # and the batch load takes up none of these files
    assert store.read("stg_operations_department_order_data").count() == 2
