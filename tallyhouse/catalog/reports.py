"""Views, KPI and business-question queries over the star."""

from __future__ import annotations

from tallyhouse.catalog.base import Query
from tallyhouse.catalog.star_sql import ratio, with_star
from tallyhouse.plans import kpis, sample_star, views

VIEW_COLUMNS = {
    "vw_campaign_performance": "campaign_id:s campaign_name:s campaign_description:s discount:d total_orders:i "
    "unique_customers:i total_quantity_sold:i total_revenue:d avg_order_value:r6 orders_with_campaign:i "
    "campaign_avail_rate_pct:r2",
    "vw_merchant_performance": "merchant_id:s merchant_name:s merchant_city:s merchant_state:s merchant_country:s "
    "total_orders:i unique_customers:i total_items_sold:i total_revenue:d avg_order_value:r6 avg_delay_days:r6 "
    "delayed_orders:i staff_count:i delay_rate_pct:r2",
    "vw_customer_segment_revenue": "customer_segment:s customer_country:s customer_city:s total_orders:i "
    "unique_customers:i total_items_purchased:i total_revenue:d avg_order_value:r6 first_order_date:s "
    "last_order_date:s merchants_purchased_from:i unique_products_purchased:i",
    "vw_segment_revenue_by_time": "date:s year:i month:i month_name:s quarter:s customer_segment:s total_orders:i "
    "unique_customers:i total_items_sold:i total_revenue:d avg_order_value:r6",
    "vw_sales_by_time": "date:s year:i month:i month_name:s quarter:s day:i total_orders:i unique_customers:i "
    "total_items_sold:i total_revenue:d avg_order_value:r6 delayed_orders:i avg_delay_days:r6",
    "vw_product_performance": "product_id:s product_name:s product_type:s price:d total_orders:i unique_customers:i "
    "total_quantity_sold:i total_revenue:d avg_quantity_per_order:r6 merchants_selling:i",
    "vw_staff_performance": "staff_id:s staff_name:s staff_job_level:s staff_city:s staff_state:s "
    "total_orders_processed:i unique_customers_served:i total_items_processed:i total_revenue_generated:d "
    "avg_order_value:r6 merchants_worked_with:i",
}


def on_star(fn, *args):
    return lambda spark, sf_dir: fn(sample_star.star(spark, sf_dir), *args)


def report(name: str, fn, columns: str, sql: str, *args) -> Query:
    return Query(name, on_star(fn, *args), columns, with_star(sql))


KPI_DAY = "1998-06-15"
_LINE_TOTAL = "(SELECT SUM(l.quantity * p.price) FROM fact_line_items l JOIN dim_product p ON p.product_sk = l.product_sk)"
_GAP = "ABS(v.total - d.total)"

QUERIES = [
    *[report(n, fn, VIEW_COLUMNS[n], f"SELECT * FROM {n}") for n, fn in views.VIEWS.items()],
    report(
        "kpi_daily_sales",
        kpis.daily_sales,
        "order_count:i total_sales:d",
        f"""SELECT COUNT(*) AS order_count, COALESCE(SUM(l.price * l.quantity), 0) AS total_sales
        FROM (SELECT * FROM fact_orders WHERE transaction_date_sk = {KPI_DAY.replace('-', '')}) o
        LEFT JOIN fact_line_items l ON l.order_id = o.order_id""",
        KPI_DAY,
    ),
    report(
        "kpi_total_revenue",
        kpis.total_revenue,
        "metric:s value:d",
        f"""SELECT 'Total Revenue (View)' AS metric, SUM(total_revenue) AS value FROM vw_sales_by_time
        UNION ALL SELECT 'Total Revenue (Direct from Facts)', {_LINE_TOTAL}""",
    ),
    report(
        "kpi_monthly_revenue",
        kpis.monthly_revenue_view,
        "year:i month:i month_name:s quarter:s monthly_revenue:d total_orders:i total_items_sold:i "
        "avg_order_value:r4 unique_customers:i",
        """SELECT year, month, month_name, quarter, SUM(total_revenue) AS monthly_revenue,
        SUM(total_orders) AS total_orders, SUM(total_items_sold) AS total_items_sold,
        AVG(avg_order_value) AS avg_order_value, COUNT(DISTINCT unique_customers) AS unique_customers
        FROM vw_sales_by_time GROUP BY year, month, month_name, quarter""",
    ),
    report(
        "kpi_monthly_revenue_direct",
        kpis.monthly_revenue_facts,
        "year:i month:i month_name:s monthly_revenue:d total_orders:i",
        """SELECT year, month, month_name, SUM(revenue) AS monthly_revenue, COUNT(DISTINCT order_id) AS total_orders
        FROM order_lines LEFT JOIN dim_date ON date_sk = transaction_date_sk GROUP BY ALL""",
    ),
    report(
        "kpi_consistency",
        kpis.revenue_consistency,
        "view_total:d direct_total:d difference:d percent_difference:r4 status:s",
        f"""SELECT v.total AS view_total, d.total AS direct_total, {_GAP} AS difference,
        ROUND({ratio(_GAP, 'v.total')} * 100, 4) AS percent_difference,
        CASE WHEN {_GAP} < 0.01 THEN 'MATCH' WHEN {ratio(_GAP, 'v.total')} * 100 < 0.01 THEN 'MATCH (within 0.01%)'
        ELSE 'MISMATCH' END AS status
        FROM (SELECT SUM(total_revenue) AS total FROM vw_sales_by_time) v
        CROSS JOIN (SELECT {_LINE_TOTAL} AS total) d""",
    ),
    report(
        "kpi_top_campaigns",
        kpis.top_campaigns,
        "campaign_name:s discount:d total_orders:i unique_customers:i total_revenue:d avg_order_value:r6 "
        "campaign_avail_rate_pct:r2",
        """SELECT campaign_name, discount, total_orders, unique_customers, total_revenue, avg_order_value,
        campaign_avail_rate_pct FROM vw_campaign_performance
        ORDER BY total_orders DESC NULLS FIRST, campaign_name LIMIT 10""",
    ),
    report(
        "kpi_top_campaigns_totals",
        kpis.campaign_order_totals,
        "metric:s value:i",
        """SELECT 'Total Campaign Orders (View)' AS metric, SUM(total_orders) AS value FROM vw_campaign_performance
        UNION ALL SELECT 'Total Campaign Orders (Direct)', COUNT(DISTINCT t.order_id)
        FROM fact_campaign_transactions t WHERE t.campaign_sk IN
        (SELECT campaign_sk FROM dim_campaign WHERE campaign_name <> 'No Campaign')""",
    ),
    report(
        "kpi_segment_revenue",
        kpis.segment_revenue_view,
        "customer_segment:s segment_revenue:d segment_orders:i segment_customers:i segment_avg_order_value:r4",
        """SELECT customer_segment, SUM(total_revenue) AS segment_revenue, SUM(total_orders) AS segment_orders,
        COUNT(DISTINCT unique_customers) AS segment_customers, AVG(avg_order_value) AS segment_avg_order_value
        FROM vw_customer_segment_revenue GROUP BY customer_segment""",
    ),
    report(
        "kpi_segment_revenue_direct",
        kpis.segment_revenue_facts,
        "customer_segment:s segment_revenue:d segment_orders:i",
        """SELECT user_type AS customer_segment, SUM(revenue) AS segment_revenue, COUNT(DISTINCT order_id) AS segment_orders
        FROM order_lines x LEFT JOIN dim_user u ON u.user_sk = x.user_sk GROUP BY ALL""",
    ),
    report(
        "kpi_top_merchants",
        kpis.top_merchants,
        "merchant_name:s merchant_city:s merchant_state:s total_orders:i total_revenue:d avg_order_value:r6 "
        "avg_delay_days:r6 delay_rate_pct:r2",
        """SELECT merchant_name, merchant_city, merchant_state, total_orders, total_revenue, avg_order_value,
        avg_delay_days, delay_rate_pct FROM vw_merchant_performance
        ORDER BY total_revenue DESC NULLS FIRST, merchant_name LIMIT 10""",
    ),
    report(
        "kpi_top_merchants_totals",
        kpis.merchant_revenue_totals,
        "metric:s value:d",
        f"""SELECT 'Total Merchant Revenue (View)' AS metric, SUM(total_revenue) AS value FROM vw_merchant_performance
        UNION ALL SELECT 'Total Merchant Revenue (Direct)', {_LINE_TOTAL}""",
    ),
    report(
        "bq_campaigns",
        kpis.question_campaigns,
        "campaign_name:s discount:d total_orders:i unique_customers:i campaign_avail_rate_pct:r2 total_revenue:d "
        "avg_order_value:r6",
        """SELECT campaign_name, discount, total_orders, unique_customers, campaign_avail_rate_pct, total_revenue,
        avg_order_value FROM vw_campaign_performance
        ORDER BY total_orders DESC NULLS FIRST, total_revenue DESC NULLS FIRST, campaign_name LIMIT 10""",
    ),
    report(
        "bq_merchants",
        kpis.question_merchants,
        "merchant_name:s merchant_city:s merchant_state:s total_orders:i total_revenue:d avg_order_value:r6 "
        "avg_delay_days:r6 delayed_orders:i delay_percentage:r2",
        f"""SELECT merchant_name, merchant_city, merchant_state, total_orders, total_revenue, avg_order_value,
        avg_delay_days, delayed_orders, ROUND({ratio('delayed_orders', 'total_orders')} * 100, 2) AS delay_percentage
        FROM vw_merchant_performance ORDER BY total_revenue DESC NULLS FIRST, merchant_name LIMIT 20""",
    ),
    report(
        "bq_segments",
        kpis.question_segments,
        "customer_segment:s customer_country:s customer_city:s total_orders:i total_revenue:d avg_order_value:r6 "
        "unique_products_purchased:i",
        """SELECT customer_segment, customer_country, customer_city, total_orders, total_revenue, avg_order_value,
        unique_products_purchased FROM vw_customer_segment_revenue
        ORDER BY total_revenue DESC NULLS FIRST, customer_segment, customer_country, customer_city LIMIT 50""",
    ),
    report(
        "bq_segments_by_user_type",
        kpis.question_user_types,
        "customer_segment:s segment_revenue:d segment_orders:i segment_customers:i",
        """SELECT customer_segment, SUM(total_revenue) AS segment_revenue, SUM(total_orders) AS segment_orders,
        SUM(unique_customers) AS segment_customers FROM vw_customer_segment_revenue GROUP BY customer_segment""",
    ),
    report(
        "profile_product_types",
        kpis.product_type_counts,
        "product_type:s products:i",
        "SELECT product_type, COUNT(*) AS products FROM dim_product GROUP BY product_type",
    ),
    report(
        "profile_missing_job_level",
        kpis.missing_job_levels,
        "table_name:s total_rows:i non_null_job_level:i missing_job_level:i",
        """SELECT 'dim_user_job' AS table_name, COUNT(*) AS total_rows, COUNT(job_level) AS non_null_job_level,
        COUNT(*) - COUNT(job_level) AS missing_job_level FROM dim_user_job""",
    ),
    report(
        "profile_completeness",
        kpis.order_completeness,
        "total_orders:i orders_with_line_items:i orders_without_items:i",
        """SELECT a AS total_orders, b AS orders_with_line_items, a - b AS orders_without_items FROM (
        SELECT COUNT(DISTINCT order_id) AS a, COUNT(DISTINCT CASE WHEN product_sk IS NOT NULL THEN order_id END) AS b
        FROM order_lines)""",
    ),
    report(
        "perf_view_rollups",
        kpis.rollup_months,
        "year:i month:i monthly_revenue:d",
        "SELECT year, month, SUM(total_revenue) AS monthly_revenue FROM vw_sales_by_time GROUP BY year, month",
    ),
    report(
        "perf_rollup_campaigns",
        kpis.rollup_campaigns,
        "campaign_name:s total_orders:i total_revenue:d",
        """SELECT campaign_name, total_orders, total_revenue FROM vw_campaign_performance
        ORDER BY total_orders DESC NULLS FIRST, campaign_name LIMIT 10""",
    ),
    report(
        "perf_rollup_segments",
        kpis.rollup_segments,
        "customer_segment:s segment_revenue:d",
        """SELECT customer_segment, SUM(total_revenue) AS segment_revenue FROM vw_customer_segment_revenue
        GROUP BY customer_segment""",
    ),
    report(
        "perf_rollup_merchants",
        kpis.rollup_merchants,
        "merchant_name:s total_revenue:d",
        """SELECT merchant_name, total_revenue FROM vw_merchant_performance
        ORDER BY total_revenue DESC NULLS FIRST, merchant_name LIMIT 10""",
    ),
]
