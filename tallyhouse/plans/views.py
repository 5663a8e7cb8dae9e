"""The seven analytical views over the star.

A view is a function of the star tables.  All of them aggregate before they
join, which is exact because of what the fact loaders guarantee:

* ``fact_orders`` has one row per order, ``fact_line_items`` one per (order,
  product), so counting distinct orders is counting rows;
* line items and campaign rows carry the user, merchant, staff and date keys
  of their order, so most views never join the two big facts;
* surrogate keys point at one dimension row, so names can be looked up after
  the aggregate, on a result that is small.

``avg_order_value`` is the average revenue of a *line*.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Star = Mapping[str, DataFrame]


def ratio(a: Column, b: Column) -> Column:
    """a / b as a double; NULL where b is 0."""
    return a.cast("double") / F.nullif(b, F.lit(0)).cast("double")


def percent(a: Column, b: Column, digits: int = 2) -> Column:
    return F.round(ratio(a, b) * 100, digits)


def priced_lines(star: Star, *columns: str) -> DataFrame:
    """Line items with ``revenue`` = quantity x list price of the product."""
    price = star["dim_product"].select("product_sk", F.col("price").alias("__list_price"))
    return (
        star["fact_line_items"]
        .select(*columns, "product_sk", "quantity")
        .join(price, "product_sk", "left")
        .withColumn("revenue", F.col("quantity") * F.col("__list_price"))
        .drop("__list_price")
    )


def _line_sums() -> list[Column]:
    return [
        F.sum("quantity").alias("items"),
        F.sum("revenue").alias("revenue"),
        F.count("revenue").alias("priced"),
    ]


def order_totals(star: Star) -> DataFrame:
    """Line items at one row per order."""
    return (
        priced_lines(star, "order_id")
        .groupBy("order_id")
        .agg(F.count("*").alias("lines"), *_line_sums())
    )


def _money(c: Column) -> Column:
    return c.cast("decimal(38,2)")


def _same(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in columns])


def campaign_performance(star: Star) -> DataFrame:
    """Per campaign, the Unknown member included."""
    totals = order_totals(star).drop("lines")
    grouped = (
        star["fact_campaign_transactions"]
        .select("campaign_sk", "order_id", "user_sk", "availed")
        .join(totals, "order_id", "left")
        .groupBy("campaign_sk")
        .agg(
            F.count("*").alias("total_orders"),
            F.count_distinct("user_sk").alias("unique_customers"),
            F.sum("items").alias("total_quantity_sold"),
            F.sum("revenue").alias("revenue"),
            F.sum("priced").alias("priced"),
            F.count_if(F.col("availed") == 1).alias("orders_with_campaign"),
        )
    )
    return (
        grouped.join(star["dim_campaign"], "campaign_sk")
        .select(
            "campaign_id",
            "campaign_name",
            "campaign_description",
            "discount",
            "total_orders",
            "unique_customers",
            "total_quantity_sold",
            _money(F.col("revenue")).alias("total_revenue"),
            ratio(F.col("revenue"), F.col("priced")).alias("avg_order_value"),
            "orders_with_campaign",
            percent(F.col("orders_with_campaign"), F.col("total_orders")).alias("campaign_avail_rate_pct"),
        )
        .orderBy(F.desc_nulls_first("total_orders"), F.desc_nulls_first("total_revenue"))
    )


def merchant_performance(star: Star) -> DataFrame:
    by_order = (
        star["fact_orders"]
        .groupBy("merchant_sk")
        .agg(
            F.count("*").alias("total_orders"),
            F.count_distinct("user_sk").alias("unique_customers"),
            F.count_distinct("staff_sk").alias("staff_count"),
            F.sum("delay_days").alias("delay_sum"),
            F.count("delay_days").alias("delay_n"),
            F.count_if(F.col("delay_days") > 0).alias("delayed_orders"),
        )
    )
    by_line = priced_lines(star, "merchant_sk").groupBy("merchant_sk").agg(*_line_sums())
    merchant = star["dim_merchant"].select(
        "merchant_sk",
        "merchant_id",
        F.col("name").alias("merchant_name"),
        F.col("city").alias("merchant_city"),
        F.col("state").alias("merchant_state"),
        F.col("country").alias("merchant_country"),
    )
    return (
        by_order.join(by_line, "merchant_sk", "left")
        .join(merchant, "merchant_sk", "left")
        .select(
            "merchant_id",
            "merchant_name",
            "merchant_city",
            "merchant_state",
            "merchant_country",
            "total_orders",
            "unique_customers",
            F.col("items").alias("total_items_sold"),
            _money(F.col("revenue")).alias("total_revenue"),
            ratio(F.col("revenue"), F.col("priced")).alias("avg_order_value"),
            ratio(F.col("delay_sum"), F.col("delay_n")).alias("avg_delay_days"),
            "delayed_orders",
            "staff_count",
            percent(F.col("delayed_orders"), F.col("total_orders")).alias("delay_rate_pct"),
        )
        .orderBy(F.desc_nulls_first("total_revenue"))
    )


def _date_of(key: Column) -> Column:
    """Calendar date of a yyyymmdd key."""
    return F.make_date((key / 10000).cast("int"), (key / 100).cast("int") % 100, key % 100)


def customer_segment_revenue(star: Star) -> DataFrame:
    segment = ["customer_segment", "customer_country", "customer_city"]
    users = star["dim_user"].select(
        "user_sk",
        F.col("user_type").alias("customer_segment"),
        F.col("country").alias("customer_country"),
        F.col("city").alias("customer_city"),
    )
    by_order = (
        star["fact_orders"]
        .select("user_sk", "merchant_sk", "transaction_date_sk")
        .join(users, "user_sk", "left")
        .groupBy(*segment)
        .agg(
            F.count("*").alias("total_orders"),
            F.count_distinct("user_sk").alias("unique_customers"),
            F.count_distinct("merchant_sk").alias("merchants_purchased_from"),
            F.min("transaction_date_sk").alias("first_sk"),
            F.max("transaction_date_sk").alias("last_sk"),
        )
    )
    # lines come down to one row per user and product before they are joined with either
    pairs = star["fact_line_items"].groupBy("user_sk", "product_sk").agg(F.sum("quantity").alias("items"), F.count("quantity").alias("counted"))
    price = star["dim_product"].select("product_sk", F.col("price").alias("list_price"))
    by_line = (
        pairs.join(price, "product_sk", "left")
        .join(users, "user_sk", "left")
        .groupBy(*segment)
        .agg(
            F.count_distinct("product_sk").alias("unique_products_purchased"),
            F.sum("items").alias("items"),
            F.sum(F.col("items") * F.col("list_price")).alias("revenue"),
            F.sum(F.when(F.col("list_price").isNotNull(), F.col("counted")).otherwise(0)).alias("priced"),
        )
    )
    return (
        by_order.join(by_line, _same(by_order, by_line, segment), "left")
        .select(
            *[by_order[c] for c in segment],
            "total_orders",
            "unique_customers",
            F.col("items").alias("total_items_purchased"),
            _money(F.col("revenue")).alias("total_revenue"),
            ratio(F.col("revenue"), F.col("priced")).alias("avg_order_value"),
            _date_of(F.col("first_sk")).alias("first_order_date"),
            _date_of(F.col("last_sk")).alias("last_order_date"),
            "merchants_purchased_from",
            F.coalesce(F.col("unique_products_purchased"), F.lit(0)).alias("unique_products_purchased"),
        )
        .orderBy(F.desc_nulls_first("total_revenue"))
    )


def segment_revenue_by_time(star: Star) -> DataFrame:
    """Per day and customer segment.

    Orders and lines are stacked and reduced to (day, user) in one shuffle; a
    user has one segment, so customers of a segment are rows of that result.
    """
    grain = ["transaction_date_sk", "user_sk"]
    orders = star["fact_orders"].select(
        *grain,
        F.lit(1).alias("orders"),
        F.lit(None).cast("int").alias("quantity"),
        F.lit(None).cast("decimal(21,2)").alias("revenue"),
    )
    lines = priced_lines(star, *grain).select(*grain, F.lit(0).alias("orders"), "quantity", "revenue")
    per_user = orders.unionByName(lines).groupBy(*grain).agg(F.sum("orders").alias("orders"), *_line_sums())
    segments = star["dim_user"].select("user_sk", F.col("user_type").alias("customer_segment"))
    grouped = (
        per_user.join(segments, "user_sk", "left")
        .groupBy("transaction_date_sk", "customer_segment")
        .agg(
            F.sum("orders").alias("total_orders"),
            F.count("*").alias("unique_customers"),
            F.sum("items").alias("total_items_sold"),
            F.sum("revenue").alias("revenue"),
            F.sum("priced").alias("priced"),
        )
    )
    return (
        grouped.join(star["dim_date"], F.col("transaction_date_sk") == F.col("date_sk"), "left")
        .select(
            "date",
            "year",
            "month",
            "month_name",
            "quarter",
            "customer_segment",
            "total_orders",
            "unique_customers",
            "total_items_sold",
            _money(F.col("revenue")).alias("total_revenue"),
            ratio(F.col("revenue"), F.col("priced")).alias("avg_order_value"),
        )
        .orderBy(F.asc_nulls_last("date"), F.asc_nulls_last("customer_segment"))
    )


def sales_by_time(star: Star) -> DataFrame:
    """Per day.  ``avg_delay_days`` counts an order once per line it has, so
    this view does need the two facts joined - at one row per order."""
    weight = F.greatest(F.coalesce(F.col("lines"), F.lit(1)), F.lit(1))
    grouped = (
        star["fact_orders"]
        .select("order_id", "user_sk", "transaction_date_sk", "delay_days")
        .join(order_totals(star), "order_id", "left")
        .groupBy("transaction_date_sk")
        .agg(
            F.count("*").alias("total_orders"),
            F.count_distinct("user_sk").alias("unique_customers"),
            F.sum("items").alias("total_items_sold"),
            F.sum("revenue").alias("revenue"),
            F.sum("priced").alias("priced"),
            F.count_if(F.col("delay_days") > 0).alias("delayed_orders"),
            F.sum(F.col("delay_days") * weight).alias("delay_sum"),
            F.sum(F.when(F.col("delay_days").isNotNull(), weight)).alias("delay_n"),
        )
    )
    return (
        grouped.join(star["dim_date"], F.col("transaction_date_sk") == F.col("date_sk"), "left")
        .select(
            "date",
            "year",
            "month",
            "month_name",
            "quarter",
            "day",
            "total_orders",
            "unique_customers",
            "total_items_sold",
            _money(F.col("revenue")).alias("total_revenue"),
            ratio(F.col("revenue"), F.col("priced")).alias("avg_order_value"),
            "delayed_orders",
            ratio(F.col("delay_sum"), F.col("delay_n")).alias("avg_delay_days"),
        )
        .orderBy(F.desc_nulls_first("date"))
    )


def product_performance(star: Star) -> DataFrame:
    grouped = (
        star["fact_line_items"]
        .groupBy("product_sk")
        .agg(
            F.count("*").alias("total_orders"),
            F.count_distinct("user_sk").alias("unique_customers"),
            F.sum("quantity").alias("total_quantity_sold"),
            F.count("quantity").alias("counted"),
            F.count_distinct("merchant_sk").alias("merchants_selling"),
        )
    )
    return (
        grouped.join(star["dim_product"], "product_sk", "left")
        .select(
            "product_id",
            "product_name",
            "product_type",
            "price",
            "total_orders",
            "unique_customers",
            "total_quantity_sold",
            _money(F.col("total_quantity_sold") * F.col("price")).alias("total_revenue"),
            ratio(F.col("total_quantity_sold"), F.col("counted")).alias("avg_quantity_per_order"),
            "merchants_selling",
        )
        .orderBy(F.desc_nulls_first("total_revenue"))
    )


def staff_performance(star: Star) -> DataFrame:
    by_order = (
        star["fact_orders"]
        .groupBy("staff_sk")
        .agg(
            F.count("*").alias("total_orders_processed"),
            F.count_distinct("user_sk").alias("unique_customers_served"),
            F.count_distinct("merchant_sk").alias("merchants_worked_with"),
        )
    )
    by_line = priced_lines(star, "staff_sk").groupBy("staff_sk").agg(*_line_sums())
    staff = star["dim_staff"].select(
        "staff_sk",
        "staff_id",
        F.col("name").alias("staff_name"),
        F.col("job_level").alias("staff_job_level"),
        F.col("city").alias("staff_city"),
        F.col("state").alias("staff_state"),
    )
    return (
        by_order.join(by_line, "staff_sk", "left")
        .join(staff, "staff_sk", "left")
        .select(
            "staff_id",
            "staff_name",
            "staff_job_level",
            "staff_city",
            "staff_state",
            "total_orders_processed",
            "unique_customers_served",
            F.col("items").alias("total_items_processed"),
            _money(F.col("revenue")).alias("total_revenue_generated"),
            ratio(F.col("revenue"), F.col("priced")).alias("avg_order_value"),
            "merchants_worked_with",
        )
        .orderBy(F.desc_nulls_first("total_revenue_generated"))
    )


VIEWS = {
    "vw_campaign_performance": campaign_performance,
    "vw_merchant_performance": merchant_performance,
    "vw_customer_segment_revenue": customer_segment_revenue,
    "vw_segment_revenue_by_time": segment_revenue_by_time,
    "vw_sales_by_time": sales_by_time,
    "vw_product_performance": product_performance,
    "vw_staff_performance": staff_performance,
}


def register_views(spark: SparkSession, star: Star) -> None:
    """Create or replace all views, and the star tables under their names."""
    for name, table in star.items():
        table.createOrReplaceTempView(name)
    for name, view in VIEWS.items():
        view(star).createOrReplaceTempView(name)


def materialize_view(star: Star, name: str, path: str) -> None:
    """Store a view's result; day-level views are laid out by year and month."""
    df = VIEWS[name](star)
    writer = df.write.mode("overwrite")
    if {"year", "month"} <= set(df.columns):
        writer = df.repartition("year", "month").write.mode("overwrite").partitionBy("year", "month")
    writer.parquet(path)
