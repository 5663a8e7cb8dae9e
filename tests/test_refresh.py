"""Whole loads over small department files."""

import os
import time

import feeds
import pytest
from pyspark.sql import functions as F

from tallyhouse.plans import kpis, views
from tallyhouse.plans.refresh import refresh
from tallyhouse.plans.store import Store

MERCHANTS, STAFF = ["M1", "M2"], ["S1", "S2"]


def counts(star):
    return {t: star[t].count() for t in star if t.startswith(("fact_", "reject_"))}


@pytest.fixture
def company(tmp_path):
    """Marketing and enterprise files that every scenario starts from."""
    root = tmp_path / "data"
    feeds.write(root, "Marketing Department/campaign_data.csv", feeds.CAMPAIGNS)
    feeds.merchant_dims(root, MERCHANTS)
    feeds.staff_dims(root, STAFF)
    return root


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "warehouse"))


def daily_file(root):
    feeds.orders(root, [f"o{i},U{i},{i + 3}days,2024-01-15" for i in range(4)])
    feeds.merchants_of_orders(root, [f"o{i},M{i % 2 + 1},S1" for i in range(4)])
    feeds.prices(root, ["o0,10.50,2pcs", "o1,3.00,1piece", "o1,4.25,4PCs", "o2,7.00,3px", "o3,1.00,10pieces"])
    feeds.products_of_orders(root, ["o0,pan cakes,P1", "o1,bars,P2", "o1,tea,P3", "o2,pan cakes,P1", "o3,bars,P2"])
    feeds.campaign_rows(root, [f"2024-01-15,CMP{i % 3 + 1},o{i},3days,{i % 2}" for i in range(4)])


@pytest.mark.parametrize("mode", ["staged", "direct"])
def test_new_daily_file(spark, company, store, mode):
    daily_file(company)
    star = refresh(spark, str(company), store, mode=mode)
    assert counts(star) == {
        "fact_orders": 4,
        "fact_line_items": 5,
        "fact_campaign_transactions": 4,
        "reject_fact_orders": 0,
        "reject_fact_line_items": 0,
        "reject_fact_campaign_transactions": 0,
    }
    # stubs: ids only; the name of a product is kept by the direct load alone
    assert star["dim_user"].count() == 4 and star["dim_user"].filter("name is not null").count() == 0
    names = sorted(str(r.product_name) for r in star["dim_product"].collect())
    assert names == (["bars", "pan cakes", "tea"] if mode == "direct" else ["None"] * 3)
    orders = {r.order_id: (r.estimated_arrival_days, r.delay_days) for r in star["fact_orders"].collect()}
    assert orders["o2"] == (5, 0)
    # line count and sales at line price, not order count
    kpi = kpis.daily_sales(star, "2024-01-15").first()
    assert kpi.order_count == 5 and float(kpi.total_sales) == 21.0 + 3.0 + 17.0 + 21.0 + 10.0
    # products without a list price have no revenue in the views
    assert views.sales_by_time(star).first().total_revenue is None
    assert kpis.revenue_consistency(star).first().difference is None
    # the same files again add nothing
    again = refresh(spark, str(company), store, mode=mode)
    assert counts(again) == counts(star)


def test_dimension_files_are_formatted(spark, company, store):
    daily_file(company)
    feeds.workbook(
        str(company / "Business/product_list.xlsx"),
        [["", "product_id", "product_name", "product_type", "price"], [0, "P1", "pan  cakes", "cosmetic_x", 2.5], [1, "P2", "bars", "tools", 4]],
    )
    feeds.write(
        company,
        "Customer/user_data.json",
        '{"user_id":{"0":"U1","1":"U2"},"name":{"0":"o\'neil","1":"van gogh"},"gender":{"0":"f","1":"m"},'
        '"user_type":{"0":"basic","1":"VERIFIED"},"creation_date":{"0":"2020-02-03 04:05:06","1":"bad"},"birthdate":{"0":"1990-01-01","1":null}}',
    )
    feeds.write(company, "Customer/user_job.csv", ",user_id,job_title,job_level\n0,U1,ceo,[null]\n1,U2,hr lead,senior\n")
    star = refresh(spark, str(company), store)
    users = {r.user_id: r for r in star["dim_user"].collect()}
    assert len(users) == 4
    assert (users["U1"].name, users["U1"].gender, users["U1"].user_type) == ("O'Neil", "Female", "Basic")
    assert users["U2"].name == "van Gogh" and users["U2"].creation_date is None and users["U0"].name is None
    products = {r.product_id: (r.product_name, r.product_type, r.price) for r in star["dim_product"].collect()}
    assert products["P1"] == ("Pan Cakes", "Cosmetics", pytest.approx(2.5)) or str(products["P1"][2]) == "2.50"
    assert products["P3"] == (None, None, None)
    jobs = sorted((r.user_id, r.job_title, r.job_level) for r in star["dim_user_job"].collect())
    assert jobs == [("U1", "CEO", None), ("U2", "HR Lead", "Senior")]
    merchants = sorted((r.merchant_id, r.name, r.contact_number) for r in star["dim_merchant"].collect())
    assert merchants == [("M1", "Acme Inc", "0255"), ("M2", "Acme Inc", "0255")]
    campaigns = {r.campaign_id: (r.campaign_name, r.campaign_description, float(r.discount)) for r in star["dim_campaign"].collect()}
    assert campaigns["CMP1"][0] == "spring push" and campaigns["CMP2"][2] == 10.0 and "UNKNOWN" in campaigns
    # view total equals the total from the facts
    assert kpis.revenue_consistency(star).first().status == "MATCH"


def test_late_campaigns(spark, company, store):
    feeds.orders(company, ["o1,U1,3days,2024-01-25", "o2,U2,3days,2024-01-25", "o3,U3,3days,2024-01-25"])
    feeds.merchants_of_orders(company, ["o1,M1,S1", "o2,M1,S1", "o3,M2,S2"])
    feeds.prices(company, ["o1,1,1pc"])
    feeds.products_of_orders(company, ["o1,x,P1"])
    feeds.campaign_rows(company, ["2024-01-25,LATE1,o1,3days,1", "2024-01-25,LATE2,o2,3days,0", "2024-01-25,,o3,3days,1"])
    star = refresh(spark, str(company), store)

    def per_campaign(s):
        named = s["fact_campaign_transactions"].join(s["dim_campaign"], "campaign_sk")
        return sorted((r.order_id, r.campaign_id) for r in named.collect())

    assert per_campaign(star) == [("o1", "UNKNOWN"), ("o2", "UNKNOWN"), ("o3", "UNKNOWN")]
    feeds.write(
        company,
        "Marketing Department/late_campaign_data.csv",
        "\tcampaign_id\tcampaign_name\tcampaign_description\tdiscount\n0\tLATE1\tA\tB\t15%\n1\tLATE2\tC\tD\t20%\n",
    )
    after = refresh(spark, str(company), store)
    assert per_campaign(after) == [("o1", "LATE1"), ("o2", "LATE2"), ("o3", "UNKNOWN")]
    assert counts(refresh(spark, str(company), store)) == counts(after)


def test_rejects_name_the_first_broken_rule(spark, company, store):
    feeds.orders(
        company,
        [
            "ok1,U1,3days,2024-01-30",
            "bad-merchant,U1,3days,2024-01-30",
            "bad-date,U1,3days,2024-13-45",
            "no-user,,3days,2024-01-30",
            "bad-staff,U1,3days,2024-01-30",
            "far-date,U1,3days,2031-01-30",
            "no-merchant-row,U1,3days,2024-01-30",
        ],
    )
    feeds.merchants_of_orders(
        company,
        ["ok1,M1,S1", "bad-merchant,NOPE,S1", "bad-date,M1,S1", "no-user,M1,S1", "bad-staff,M1,NOBODY", "far-date,M1,S1"],
    )
    feeds.prices(company, ["ok1,5.00,2pcs", "ok1,6.00,1pc", "bad-date,1,1pc", "ok1,9.00,1pc"])
    feeds.products_of_orders(company, ["ok1,a,P1", "ok1,b,", "bad-date,c,P2", "ok1,d,P1"])
    feeds.campaign_rows(
        company, ["2024-01-30,CMP1,ok1,3days,1", "not-a-date,CMP1,ok1,3days,0", "2024-01-30,CMP1,ghost,3days,1"]
    )
    star = refresh(spark, str(company), store)
    reasons = {r.order_id: r.error_reason for r in star["reject_fact_orders"].collect()}
    assert reasons == {
        "bad-merchant": "merchant_id 'NOPE' not found in dim_merchant",
        "bad-date": "null transaction_date",
        "no-user": "user_id 'None' not found in dim_user",
        "bad-staff": "staff_id 'NOBODY' not found in dim_staff",
        "far-date": "date '2031-01-30' not found in dim_date",
    }
    lines = sorted((r.order_id, str(r.product_id), r.error_reason) for r in star["reject_fact_line_items"].collect())
    assert lines == [
        ("bad-date", "P2", "order_id 'bad-date' not found in fact_orders"),
        ("ok1", "None", "product_id is NULL"),
    ]
    # the second P1 line of the order is ignored, the first one stays
    assert [(float(r.price), r.quantity) for r in star["fact_line_items"].collect()] == [(5.0, 2)]
    assert [(r.order_id, r.availed) for r in star["fact_campaign_transactions"].collect()] == [("ok1", 1)]
    assert [r.error_reason for r in star["reject_fact_campaign_transactions"].collect()] == [
        "order_id 'ghost' not found in fact_orders"
    ]
    source = star["reject_fact_orders"].first().source_file
    assert source.endswith("order_data.csv")
    # P2 got a stub before the facts were loaded, so it is not an unknown product
    assert star["dim_product"].filter("product_id = 'P2'").count() == 1


def test_modified_file_replaces_its_rows(spark, company, store):
    daily_file(company)
    refresh(spark, str(company), store)
    time.sleep(1.1)
    feeds.orders(company, ["o0,U0,9days,2024-01-15", "new,U9,1days,2024-01-16"])
    os.utime(company / "Operations/order_data.csv")
    feeds.merchants_of_orders(company, ["new,M1,S2"], tag="_2")
    star = refresh(spark, str(company), store)
    staged = store.read("stg_operations_department_order_data")
    assert sorted(r.order_id for r in staged.collect()) == ["new", "o0"]
    orders = {r.order_id: r.estimated_arrival_days for r in star["fact_orders"].collect()}
    # known orders stay, and take over the new day count
    assert len(orders) == 5 and orders["o0"] == 9 and orders["o1"] == 4


def test_append_keeps_old_rows_of_a_modified_file(spark, company, store):
    from tallyhouse.plans.refresh import ingest

    daily_file(company)
    ingest(spark, str(company), store, "order_data").collect()
    assert ingest(spark, str(company), store, "order_data").first().decision == "skip"
    time.sleep(1.1)
    os.utime(company / "Operations/order_data.csv")
    decision = ingest(spark, str(company), store, "order_data", on_modified="append").first()
    assert decision.reason == "File modified after last ingestion"
    assert store.read("stg_operations_department_order_data").count() == 8
    ingest(spark, str(company), store, "order_data", force=True)
    assert store.read("stg_operations_department_order_data").count() == 4


def test_lines_carry_the_keys_of_their_order(spark, company, store):
    """What the views rely on when they do not join the two facts."""
    daily_file(company)
    star = refresh(spark, str(company), store)
    keys = ["user_sk", "merchant_sk", "staff_sk", "transaction_date_sk"]
    orders = star["fact_orders"].select("order_id", *keys)
    assert star["fact_line_items"].join(orders, ["order_id", *keys], "left_anti").isEmpty()
    assert star["fact_campaign_transactions"].join(
        orders, ["order_id", "user_sk", "merchant_sk", "transaction_date_sk"], "left_anti"
    ).isEmpty()


def test_reset(spark, store):
    row = spark.range(1).select(F.lit("x").alias("order_id"))
    store.append("fact_orders", row)
    assert store.append("fact_orders", row).count() == 2
    store.reset("fact_orders")
    assert store.read("fact_orders").count() == 0


def test_a_second_load_repeats_no_reject_and_rewrites_no_unmoved_campaigns(spark, company, store):
    daily_file(company)
    feeds.orders(company, ["o9,U9,3days,2024-01-15"], tag="_9")
    feeds.merchants_of_orders(company, ["o9,NOBODY,S1"], tag="_9")
    refresh(spark, str(company), store)
    rejects = {t: store.read(t).count() for t in ("reject_fact_orders", "reject_fact_line_items", "reject_fact_campaign_transactions")}
    assert rejects["reject_fact_orders"] == 1
    before = store._folders("fact_campaign_transactions")
    refresh(spark, str(company), store)
    assert rejects == {t: store.read(t).count() for t in rejects}
    assert store._folders("fact_campaign_transactions")[: len(before)] == before
    log = store.read("ingestion_log").collect()
    assert log and {r.status for r in log} == {"success"} and all(r.rows_ingested > 0 for r in log)


@pytest.mark.parametrize("mode", ["staged", "direct"])
def test_rows_that_do_not_fit_are_kept_once(spark, company, store, mode):
    daily_file(company)
    feeds.orders(company, ["o9,U9,3days,2024-01-15", "o8,U8,3days,2024-01-15,surplus"], tag="_9")
    for _ in range(2):
        refresh(spark, str(company), store, mode=mode)
        found = store.read("rejected_rows").collect()
        assert [(r.dataset, r.record) for r in found] == [("order_data", "1,o8,U8,3days,2024-01-15,surplus")]
