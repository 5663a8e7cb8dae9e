"""KPI, business-question and reconciliation queries on views and facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tallyhouse.plans.views import (
    Star,
    campaign_performance,
    customer_segment_revenue,
    merchant_performance,
    percent,
    priced_lines,
    ratio,
    sales_by_time,
)

ABSENT_CAMPAIGN = "No Campaign"


def daily_sales(star: Star, date: dt.date | str) -> DataFrame:
    """Rows after the line join (so lines, not orders) and sales at line price."""
    # day keys are yyyymmdd: as a literal the day reaches both scans, and lines carry the date of
    # their order
    on_day = F.col("transaction_date_sk") == int(str(date)[:10].replace("-", ""))
    orders = star["fact_orders"].filter(on_day)
    lines = star["fact_line_items"].filter(on_day).select("order_id", (F.col("price") * F.col("quantity")).alias("sales"))
    return orders.select("order_id").join(lines, "order_id", "left").agg(
        F.count("*").alias("order_count"),
        F.coalesce(F.sum("sales"), F.lit(0)).cast("decimal(38,2)").alias("total_sales"),
    )


def revenue_from_view(star: Star) -> DataFrame:
    return sales_by_time(star).agg(F.sum("total_revenue").cast("decimal(38,2)").alias("value"))


def revenue_from_lines(star: Star) -> DataFrame:
    return priced_lines(star).agg(F.sum("revenue").cast("decimal(38,2)").alias("value"))


def total_revenue(star: Star) -> DataFrame:
    """The same total by two routes, with the time of asking."""
    both = [
        revenue_from_view(star).withColumn("metric", F.lit("Total Revenue (View)")),
        revenue_from_lines(star).withColumn("metric", F.lit("Total Revenue (Direct from Facts)")),
    ]
    return both[0].unionByName(both[1]).select("metric", "value", F.current_timestamp().alias("query_time"))


def monthly_revenue_view(star: Star) -> DataFrame:
    """``unique_customers`` counts distinct *values* of the daily counter, as asked."""
    return (
        sales_by_time(star)
        .groupBy("year", "month", "month_name", "quarter")
        .agg(
            F.sum("total_revenue").cast("decimal(38,2)").alias("monthly_revenue"),
            F.sum("total_orders").alias("total_orders"),
            F.sum("total_items_sold").alias("total_items_sold"),
            F.avg("avg_order_value").alias("avg_order_value"),
            F.count_distinct("unique_customers").alias("unique_customers"),
        )
        .orderBy(F.asc_nulls_last("year"), F.asc_nulls_last("month"))
    )


def monthly_revenue_facts(star: Star) -> DataFrame:
    """Orders and line revenue reduced to days, then to months."""
    orders = star["fact_orders"].groupBy("transaction_date_sk").agg(F.count("*").alias("orders"))
    lines = (
        priced_lines(star, "transaction_date_sk")
        .groupBy("transaction_date_sk")
        .agg(F.sum("revenue").alias("revenue"))
    )
    return (
        orders.join(lines, "transaction_date_sk", "left")
        .join(star["dim_date"], F.col("transaction_date_sk") == F.col("date_sk"), "left")
        .groupBy("year", "month", "month_name")
        .agg(
            F.sum("revenue").cast("decimal(38,2)").alias("monthly_revenue"),
            F.sum("orders").alias("total_orders"),
        )
        .orderBy(F.asc_nulls_last("year"), F.asc_nulls_last("month"))
    )


def revenue_consistency(star: Star) -> DataFrame:
    """View total against direct total, with a verdict."""
    vt = revenue_from_view(star).withColumnRenamed("value", "view_total")
    direct = revenue_from_lines(star).withColumnRenamed("value", "direct_total")
    gap = F.abs(F.col("view_total") - F.col("direct_total"))
    pct = ratio(gap, F.col("view_total")) * 100
    return vt.crossJoin(direct).select(  # one row each
        "view_total",
        "direct_total",
        gap.alias("difference"),
        F.round(pct, 4).alias("percent_difference"),
        F.when(gap < 0.01, "MATCH").when(pct < 0.01, "MATCH (within 0.01%)").otherwise("MISMATCH").alias("status"),
    )


def top_campaigns(star: Star, k: int = 10) -> DataFrame:
    return (
        campaign_performance(star)
        .select(
            "campaign_name",
            "discount",
            "total_orders",
            "unique_customers",
            "total_revenue",
            "avg_order_value",
            "campaign_avail_rate_pct",
        )
        .orderBy(F.desc_nulls_first("total_orders"), F.asc("campaign_name"))
        .limit(k)
    )


def campaign_order_totals(star: Star) -> DataFrame:
    """Orders over all campaigns: summed over the view (an order counts once
    per campaign) and counted once each."""
    view = campaign_performance(star).agg(F.sum("total_orders").alias("value"))
    direct = (
        star["fact_campaign_transactions"]
        .join(star["dim_campaign"].filter(F.col("campaign_name") != ABSENT_CAMPAIGN), "campaign_sk", "left_semi")
        .agg(F.count_distinct("order_id").alias("value"))
    )
    return (
        view.withColumn("metric", F.lit("Total Campaign Orders (View)"))
        .unionByName(direct.withColumn("metric", F.lit("Total Campaign Orders (Direct)")))
        .select("metric", "value")
    )


def segment_revenue_view(star: Star) -> DataFrame:
    return (
        customer_segment_revenue(star)
        .groupBy("customer_segment")
        .agg(
            F.sum("total_revenue").cast("decimal(38,2)").alias("segment_revenue"),
            F.sum("total_orders").alias("segment_orders"),
            F.count_distinct("unique_customers").alias("segment_customers"),
            F.avg("avg_order_value").alias("segment_avg_order_value"),
        )
        .orderBy(F.desc_nulls_first("segment_revenue"))
    )


def segment_revenue_facts(star: Star) -> DataFrame:
    """Facts are reduced to users before the user table is joined."""
    grain = "user_sk"
    orders = star["fact_orders"].select(
        grain, F.lit(1).alias("orders"), F.lit(None).cast("decimal(21,2)").alias("revenue")
    )
    lines = priced_lines(star, grain).select(grain, F.lit(0).alias("orders"), "revenue")
    per_user = (
        orders.unionByName(lines)
        .groupBy(grain)
        .agg(F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"))
    )
    return (
        per_user.join(star["dim_user"].select(grain, F.col("user_type").alias("customer_segment")), grain, "left")
        .groupBy("customer_segment")
        .agg(
            F.sum("revenue").cast("decimal(38,2)").alias("segment_revenue"),
            F.sum("orders").alias("segment_orders"),
        )
        .orderBy(F.desc_nulls_first("segment_revenue"))
    )


def top_merchants(star: Star, k: int = 10) -> DataFrame:
    return (
        merchant_performance(star)
        .select(
            "merchant_name",
            "merchant_city",
            "merchant_state",
            "total_orders",
            "total_revenue",
            "avg_order_value",
            "avg_delay_days",
            "delay_rate_pct",
        )
        .orderBy(F.desc_nulls_first("total_revenue"), F.asc("merchant_name"))
        .limit(k)
    )


def merchant_revenue_totals(star: Star) -> DataFrame:
    view = merchant_performance(star).agg(F.sum("total_revenue").cast("decimal(38,2)").alias("value"))
    return (
        view.withColumn("metric", F.lit("Total Merchant Revenue (View)"))
        .unionByName(revenue_from_lines(star).withColumn("metric", F.lit("Total Merchant Revenue (Direct)")))
        .select("metric", "value")
    )


def question_campaigns(star: Star, k: int = 10) -> DataFrame:
    return (
        campaign_performance(star)
        .select(
            "campaign_name",
            "discount",
            "total_orders",
            "unique_customers",
            "campaign_avail_rate_pct",
            "total_revenue",
            "avg_order_value",
        )
        .orderBy(F.desc_nulls_first("total_orders"), F.desc_nulls_first("total_revenue"), F.asc("campaign_name"))
        .limit(k)
    )


def question_merchants(star: Star, k: int = 20) -> DataFrame:
    return (
        merchant_performance(star)
        .select(
            "merchant_name",
            "merchant_city",
            "merchant_state",
            "total_orders",
            "total_revenue",
            "avg_order_value",
            "avg_delay_days",
            "delayed_orders",
            percent(F.col("delayed_orders"), F.col("total_orders")).alias("delay_percentage"),
        )
        .orderBy(F.desc_nulls_first("total_revenue"), F.asc("merchant_name"))
        .limit(k)
    )


def question_segments(star: Star, k: int = 50) -> DataFrame:
    return (
        customer_segment_revenue(star)
        .select(
            "customer_segment",
            "customer_country",
            "customer_city",
            "total_orders",
            "total_revenue",
            "avg_order_value",
            "unique_products_purchased",
        )
        .orderBy(
            F.desc_nulls_first("total_revenue"),
            F.asc("customer_segment"),
            F.asc("customer_country"),
            F.asc("customer_city"),
        )
        .limit(k)
    )


def question_user_types(star: Star) -> DataFrame:
    return (
        customer_segment_revenue(star)
        .groupBy("customer_segment")
        .agg(
            F.sum("total_revenue").cast("decimal(38,2)").alias("segment_revenue"),
            F.sum("total_orders").alias("segment_orders"),
            F.sum("unique_customers").alias("segment_customers"),
        )
        .orderBy(F.desc_nulls_first("segment_revenue"))
    )


def product_type_counts(star: Star) -> DataFrame:
    return (
        star["dim_product"]
        .groupBy("product_type")
        .agg(F.count("*").alias("products"))
        .orderBy(F.desc("products"), F.asc("product_type"))
    )


def missing_job_levels(star: Star) -> DataFrame:
    return star["dim_user_job"].agg(
        F.lit("dim_user_job").alias("table_name"),
        F.count("*").alias("total_rows"),
        F.count("job_level").alias("non_null_job_level"),
        (F.count("*") - F.count("job_level")).alias("missing_job_level"),
    )


def order_completeness(star: Star) -> DataFrame:
    """Orders with and without lines.

    Lines exist only for loaded orders, so this is two independent counts.
    """
    orders = star["fact_orders"].agg(F.count("*").alias("total_orders"))
    with_lines = star["fact_line_items"].agg(F.count_distinct("order_id").alias("orders_with_line_items"))
    return orders.crossJoin(with_lines).withColumn(  # one row each
        "orders_without_items", F.col("total_orders") - F.col("orders_with_line_items")
    )


# --- the four timed roll-ups -----------------------------------------------------


def rollup_months(star: Star) -> DataFrame:
    return (
        sales_by_time(star)
        .groupBy("year", "month")
        .agg(F.sum("total_revenue").cast("decimal(38,2)").alias("monthly_revenue"))
        .orderBy(F.asc_nulls_last("year"), F.asc_nulls_last("month"))
    )


def rollup_campaigns(star: Star, k: int = 10) -> DataFrame:
    return (
        campaign_performance(star)
        .select("campaign_name", "total_orders", "total_revenue")
        .orderBy(F.desc_nulls_first("total_orders"), F.asc("campaign_name"))
        .limit(k)
    )


def rollup_segments(star: Star) -> DataFrame:
    return (
        customer_segment_revenue(star)
        .groupBy("customer_segment")
        .agg(F.sum("total_revenue").cast("decimal(38,2)").alias("segment_revenue"))
        .orderBy(F.desc_nulls_first("segment_revenue"))
    )


def rollup_merchants(star: Star, k: int = 10) -> DataFrame:
    return (
        merchant_performance(star)
        .select("merchant_name", "total_revenue")
        .orderBy(F.desc_nulls_first("total_revenue"), F.asc("merchant_name"))
        .limit(k)
    )
