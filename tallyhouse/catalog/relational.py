"""Joins, aggregates, windows, sorting and set operations one by one."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhouse.catalog.base import Query
from tallyhouse.catalog.loads import _LINES, _THIN, _known_dim_products, _known_orders, _line_products, _thin_dims
from tallyhouse.catalog.star_sql import ratio as sql_ratio, with_star
from tallyhouse.functions import normalize_key
from tallyhouse.operators import facts, keys
from tallyhouse.operators import relational as rel
from tallyhouse.operators.quality import repeated_pairs
from tallyhouse.plans import sample_star
from tallyhouse.plans.sample_star import table
from tallyhouse.plans.views import percent, ratio, sales_by_time
from tallyhouse.session import materialize

star = sample_star.star


def staged(spark, sf_dir, name: str) -> DataFrame:
    return sample_star.staging(spark, sf_dir)[name]


# --- joins -------------------------------------------------------------------------


def join_inner(spark, sf_dir):
    orders = staged(spark, sf_dir, "order_data").drop("staff_id").withColumn("order_id", normalize_key(F.col("order_id")))
    merchants = staged(spark, sf_dir, "order_with_merchant_data").select("order_id", "merchant_id", "staff_id")
    return orders.join(merchants.withColumn("order_id", normalize_key(F.col("order_id"))), "order_id", "inner")


def join_left(spark, sf_dir):
    """Delays are offered twice, so an order with a delay comes out twice."""
    delays = staged(spark, sf_dir, "order_delays").select("order_id", "delay_days")
    return staged(spark, sf_dir, "order_data").select("order_id", "user_id").join(
        delays.unionByName(delays), "order_id", "left"
    )


def join_dim_lookup(spark, sf_dir):
    dims = _thin_dims(spark, sf_dir)
    judged = facts.judge_orders(
        facts.combine_orders(
            staged(spark, sf_dir, "order_data"), staged(spark, sf_dir, "order_with_merchant_data"), None
        ),
        dims["dim_user"],
        dims["dim_merchant"],
        dims["dim_staff"],
        dims["dim_date"],
    )
    return judged.select(
        "order_id",
        F.col("user_sk").isNotNull().alias("user_found"),
        F.col("merchant_sk").isNotNull().alias("merchant_found"),
        F.col("staff_sk").isNotNull().alias("staff_found"),
        "transaction_date_sk",
    )


def scan_key_maps(spark, sf_dir):
    """(business key, surrogate key) of each looked-up dimension, as counts."""
    s = star(spark, sf_dir)
    maps = [
        facts.key_map(s[d], d).select(F.lit(d).alias("dimension"), F.col(k).alias("id"), F.col(sk).alias("sk"))
        for d, (sk, k) in facts.schemas.DIM_KEYS.items()
    ]
    maps.append(
        s["dim_date"].select(
            F.lit("dim_date").alias("dimension"), F.col("date").cast("string").alias("id"), F.col("date_sk").cast("bigint").alias("sk")
        )
    )
    return rel.union_all(maps).groupBy("dimension").agg(
        F.count("id").alias("members"), F.count_distinct("sk").alias("keys"), F.count_if(F.col("sk") == 0).alias("zero_keys")
    )


def join_fact_lookup(spark, sf_dir):
    s = star(spark, sf_dir)
    lines = staged(spark, sf_dir, "line_item_data_products").select("order_id", "product_id")
    found = lines.join(facts.order_keys(_known_orders(s)), "order_id", "left")
    return (
        found.join(s["dim_merchant"].select("merchant_sk", "merchant_id"), "merchant_sk", "left")
        .groupBy("merchant_id", "transaction_date_sk")
        .agg(F.count("*").alias("lines"), F.count_distinct("order_id").alias("orders"))
    )


def _with_products(spark, sf_dir) -> DataFrame:
    return _line_products(spark, sf_dir).filter(F.col("product_id").isNotNull())


def join_positional(spark, sf_dir):
    """The product feed is the shorter one: the surplus prices fall off."""
    return facts.zip_by_position(_with_products(spark, sf_dir), staged(spark, sf_dir, "line_item_data_prices"))


def join_positional_by_key(spark, sf_dir):
    return facts.zip_by_order(_with_products(spark, sf_dir), staged(spark, sf_dir, "line_item_data_prices"))


def join_composite(spark, sf_dir):
    s = star(spark, sf_dir)
    lines = staged(spark, sf_dir, "line_item_data_products").select("order_id", "product_id", "file_source")
    return (
        lines.join(facts.key_map(s["dim_product"], "dim_product"), "product_id")
        .join(s["fact_line_items"].select("order_id", "product_sk"), ["order_id", "product_sk"])
        .groupBy("file_source")
        .agg(F.count("*").alias("matches"))
    )


def join_star(spark, sf_dir):
    """Every order with its line items and the names behind its keys."""
    s = star(spark, sf_dir)
    lines = (
        s["fact_line_items"]
        .select("order_id", "product_sk", "quantity")
        .join(s["dim_product"].select("product_sk", "product_id", "price"), "product_sk", "left")
    )
    return (
        s["fact_orders"]
        .join(s["dim_date"].select(F.col("date_sk").alias("transaction_date_sk"), "date"), "transaction_date_sk", "left")
        .join(s["dim_user"].select("user_sk", "user_id", "user_type"), "user_sk", "left")
        .join(s["dim_merchant"].select("merchant_sk", "merchant_id"), "merchant_sk", "left")
        .join(s["dim_staff"].select("staff_sk", "staff_id"), "staff_sk", "left")
        .join(lines, "order_id", "left")
    )


def join_anti(spark, sf_dir):
    return rel.without_partner(staged(spark, sf_dir, "order_data"), star(spark, sf_dir)["fact_orders"], "order_id")


def join_semi(spark, sf_dir):
    lines = staged(spark, sf_dir, "line_item_data_products").select("order_id", "product_id", "file_source")
    return lines.join(rel.repeated(lines, ["order_id", "product_id"]), ["order_id", "product_id"], "left_semi")


def join_cross_scalar(spark, sf_dir):
    lines = staged(spark, sf_dir, "line_item_data_products")
    fact = star(spark, sf_dir)["fact_line_items"]
    return rel.side_by_side(
        lines.agg(rel.count_tuples("order_id", "product_id").alias("staged_pairs")),
        fact.agg(F.count("*").alias("fact_rows")),
    ).withColumn("difference", F.col("staged_pairs") - F.col("fact_rows"))


def scalar_subquery(spark, sf_dir):
    s = star(spark, sf_dir)
    return spark.sql(
        """SELECT (SELECT count(*) FROM {merchants}) AS total_in_dim,
                  (SELECT count(DISTINCT merchant_sk) FROM {orders}) AS distinct_in_facts,
                  (SELECT max(delay_days) FROM {orders}) AS longest_delay""",
        merchants=s["dim_merchant"],
        orders=s["fact_orders"],
    )


def join_on_date_expr(spark, sf_dir):
    stamped = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    return stamped.join(star(spark, sf_dir)["dim_date"].select("date", "date_sk", "quarter"), "date")


def join_cte_preagg(spark, sf_dir):
    s = star(spark, sf_dir)
    delays = (
        s["fact_orders"]
        .filter(F.col("delay_days").isNotNull())
        .groupBy("merchant_sk")
        .agg(
            ratio(F.sum("delay_days"), F.count("delay_days")).alias("avg_delay_days"),
            F.count_if(F.col("delay_days") > 0).alias("delayed_orders"),
        )
    )
    return s["dim_merchant"].select("merchant_sk", "merchant_id").join(delays, "merchant_sk", "left")


def join_optional_key(spark, sf_dir):
    known = _known_dim_products(star(spark, sf_dir))
    return rel.orphans(_line_products(spark, sf_dir), known, "product_id").groupBy("product_id").agg(
        F.count("*").alias("orphans")
    )


# --- aggregates ----------------------------------------------------------------------


def agg_count(spark, sf_dir):
    return _line_products(spark, sf_dir).agg(F.count("*").alias("rows"), F.count("product_id").alias("with_product"))


def agg_count_distinct(spark, sf_dir):
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_returnflag")
        .agg(F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_suppkey").alias("suppliers"))
    )


def agg_count_distinct_case(spark, sf_dir):
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey")
        .agg(F.count_distinct(F.when(F.col("l_quantity") > 25, F.col("l_orderkey"))).alias("large_orders"))
    )


def agg_count_if(spark, sf_dir):
    return star(spark, sf_dir)["fact_campaign_transactions"].groupBy("transaction_date_sk").agg(
        F.count_if(F.col("availed").isNull()).alias("unanswered"),
        F.count_if(F.col("availed") == 0).alias("declined"),
    )


def agg_count_distinct_tuple(spark, sf_dir):
    return (
        _line_products(spark, sf_dir).groupBy("file_source").agg(rel.count_tuples("order_id", "product_id").alias("pairs"))
    )


def _priced(spark, sf_dir) -> DataFrame:
    s = star(spark, sf_dir)
    return s["fact_line_items"].join(s["dim_product"].select("product_sk", F.col("price").alias("list_price"), "product_type"), "product_sk", "left")


def agg_sum_product(spark, sf_dir):
    return _priced(spark, sf_dir).groupBy("product_type").agg(
        F.sum("quantity").alias("quantity"), F.sum(F.col("quantity") * F.col("list_price")).alias("revenue")
    )


def agg_avg(spark, sf_dir):
    revenue = F.col("quantity") * F.col("list_price")
    return _priced(spark, sf_dir).groupBy("transaction_date_sk").agg(
        ratio(F.sum(revenue), F.count(revenue)).alias("avg_line_revenue"),
        ratio(F.sum("quantity"), F.count("quantity")).alias("avg_quantity"),
    )


def agg_min_max(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
        F.min("l_extendedprice").alias("lowest"),
        F.max("l_extendedprice").alias("highest"),
    )


def agg_string_agg(spark, sf_dir):
    return repeated_pairs(staged(spark, sf_dir, "line_item_data_products"), top=None, stage=materialize)


def agg_array_ordered(spark, sf_dir):
    brands = rel.sorted_values(table(spark, sf_dir, "part"), ["p_type"], "p_brand", "brands")
    return brands.select("p_type", F.size("brands").alias("n"), F.array_join("brands", ",").alias("brands"))


def agg_having(spark, sf_dir):
    return rel.repeated(staged(spark, sf_dir, "line_item_data_products"), ["order_id", "product_id"])


def agg_reaggregate(spark, sf_dir):
    return sales_by_time(star(spark, sf_dir)).groupBy("year", "quarter").agg(
        F.sum("total_revenue").alias("revenue"),
        F.avg("avg_order_value").alias("avg_of_avg"),
        F.sum("unique_customers").alias("summed_customers"),
        F.count_distinct("unique_customers").alias("customer_counts"),
    )


def agg_global(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(
        F.sum("l_quantity").alias("quantity"), F.min("l_shipdate").alias("first_ship"), F.count("*").alias("rows")
    )


def agg_ratio_pct(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        percent(F.count_if(F.col("o_orderstatus") == "F"), F.count("*")).alias("shipped_pct")
    )


def agg_nested_cte(spark, sf_dir):
    per_order = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("lines"))
    return per_order.groupBy("lines").agg(F.count("*").alias("orders"))


def distinct_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


def dedup_keep_first(spark, sf_dir):
    lines = sample_star.staged_lines(spark, sf_dir).select("order_id", "product_id", "price", "quantity", "ingest_seq")
    return keys.first_per_key(lines, ["order_id"])


# --- windows ---------------------------------------------------------------------------


def win_row_number(spark, sf_dir):
    lines = sample_star.staged_lines(spark, sf_dir).select("order_id", "product_id", "price", "ingest_seq")
    return keys.with_group_position(lines, ["order_id"])


def win_first_wins(spark, sf_dir):
    lines = sample_star.staged_lines(spark, sf_dir).select("order_id", "product_id", "price", "quantity", "ingest_seq")
    return keys.first_per_key(lines, ["order_id", "product_id"])


def win_last_wins(spark, sf_dir):
    lines = sample_star.staged_lines(spark, sf_dir).select("product_id", "order_id", "price", "ingest_seq")
    return keys.last_per_key(lines, ["product_id"])


# --- order, limit, sets ------------------------------------------------------------------


def sort_multi(spark, sf_dir):
    s = star(spark, sf_dir)
    return (
        s["fact_campaign_transactions"]
        .join(s["dim_campaign"].select("campaign_sk", "campaign_id"), "campaign_sk")
        .select("campaign_id", "availed", "order_id")
        .orderBy(F.asc_nulls_last("campaign_id"), F.desc_nulls_first("availed"), F.asc("order_id"))
    )


def topk(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_totalprice")
        .orderBy(F.desc_nulls_first("o_totalprice"), F.asc("o_orderkey"))
        .limit(20)
    )


def limit_sample(spark, sf_dir):
    lines = staged(spark, sf_dir, "line_item_data_products").select("order_id", "product_id", "file_source")
    dup = lines.join(rel.repeated(lines, ["order_id", "product_id"]), ["order_id", "product_id"], "left_semi")
    return dup.orderBy("order_id", "product_id", "file_source").limit(20)


def union_all(spark, sf_dir):
    lines = staged(spark, sf_dir, "line_item_data_products").select("order_id", "product_id")
    others = staged(spark, sf_dir, "order_data").select("order_id", "user_id")
    return rel.union_all([lines, others]).groupBy("order_id").agg(
        F.count("*").alias("rows"), F.count("product_id").alias("products"), F.count("user_id").alias("users")
    )


def set_difference(spark, sf_dir):
    """Products in line items that the product table does not have."""
    lines = staged(spark, sf_dir, "line_item_data_products").select(normalize_key(F.col("product_id")).alias("product_id"))
    return rel.without_partner(lines.distinct(), _known_dim_products(star(spark, sf_dir)), "product_id")


QUERIES = [
    Query(
        "join_inner",
        join_inner,
        "order_id:s user_id:s merchant_id:s staff_id:s",
        with_star("SELECT o.order_id, o.user_id, m.merchant_id, m.staff_id FROM stg_orders o JOIN stg_merchants m ON m.order_id = o.order_id"),
    ),
    Query(
        "join_left",
        join_left,
        "order_id:s user_id:s delay_days:i",
        with_star(
            """SELECT o.order_id, o.user_id, d.delay_days FROM stg_orders o
            LEFT JOIN (SELECT * FROM stg_delays UNION ALL SELECT * FROM stg_delays) d ON d.order_id = o.order_id"""
        ),
    ),
    Query(
        "join_dim_lookup",
        join_dim_lookup,
        "order_id:s user_found:b merchant_found:b staff_found:b transaction_date_sk:i",
        with_star(
            """SELECT o.order_id, u.user_sk IS NOT NULL AS user_found, tm.merchant_sk IS NOT NULL AS merchant_found,
            ts.staff_sk IS NOT NULL AS staff_found, d.date_sk AS transaction_date_sk
            FROM stg_orders o JOIN stg_merchants m ON m.order_id = o.order_id
            LEFT JOIN thin_user u ON u.user_id = o.user_id LEFT JOIN thin_merchant tm ON tm.merchant_id = m.merchant_id
            LEFT JOIN thin_staff ts ON ts.staff_id = m.staff_id LEFT JOIN thin_date d ON d.date = o.transaction_date""",
            _THIN,
        ),
    ),
    Query(
        "scan_key_maps",
        scan_key_maps,
        "dimension:s members:i keys:i zero_keys:i",
        with_star(
            " UNION ALL ".join(
                f"SELECT '{d}' AS dimension, COUNT(*) AS members, COUNT(*) AS keys, 0 AS zero_keys FROM {d}"
                for d in ("dim_campaign", "dim_product", "dim_user", "dim_staff", "dim_merchant", "dim_date")
            )
        ),
    ),
    Query(
        "join_fact_lookup",
        join_fact_lookup,
        "merchant_id:s transaction_date_sk:i lines:i orders:i",
        with_star(
            """SELECT o.merchant_id, o.transaction_date_sk, COUNT(*) AS lines, COUNT(DISTINCT l.order_id) AS orders
            FROM stg_lines l LEFT JOIN known_orders o ON o.order_id = l.order_id GROUP BY 1, 2""",
            _LINES,
        ),
    ),
    Query(
        "join_positional",
        join_positional,
        "order_id:s product_id:s price:d quantity:i",
        with_star(
            """SELECT a.order_id, a.product_id, b.price, b.quantity
            FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY seq) AS n FROM stg_lines WHERE file_source <> 'lines-R.csv') a
            JOIN (SELECT *, ROW_NUMBER() OVER (ORDER BY seq) AS n FROM stg_lines) b ON a.n = b.n"""
        ),
    ),
    Query(
        "join_positional_by_key",
        join_positional_by_key,
        "order_id:s product_id:s price:d quantity:i",
        with_star(
            """SELECT a.order_id, a.product_id, b.price, b.quantity FROM numbered_products a
            JOIN numbered_prices b ON a.order_id = b.order_id AND a.rn = b.rn""",
            _LINES,
        ),
    ),
    Query(
        "join_composite",
        join_composite,
        "file_source:s matches:i",
        with_star(
            """SELECT l.file_source, COUNT(*) AS matches FROM stg_lines l JOIN dim_product p ON p.product_id = l.product_id
            JOIN fact_line_items f ON f.order_id = l.order_id AND f.product_sk = p.product_sk GROUP BY 1"""
        ),
    ),
    Query(
        "join_star",
        join_star,
        "order_id:s date:s user_id:s user_type:s merchant_id:s staff_id:s product_id:s quantity:i price:d",
        with_star(
            """SELECT o.order_id, d.date, u.user_id, u.user_type, m.merchant_id, s.staff_id, p.product_id, l.quantity, p.price
            FROM fact_orders o LEFT JOIN dim_date d ON d.date_sk = o.transaction_date_sk
            LEFT JOIN dim_user u ON u.user_sk = o.user_sk LEFT JOIN dim_merchant m ON m.merchant_sk = o.merchant_sk
            LEFT JOIN dim_staff s ON s.staff_sk = o.staff_sk LEFT JOIN fact_line_items l ON l.order_id = o.order_id
            LEFT JOIN dim_product p ON p.product_sk = l.product_sk"""
        ),
    ),
    Query(
        "join_anti",
        join_anti,
        "order_id:s user_id:s",
        with_star("SELECT o.order_id, o.user_id FROM stg_orders o WHERE NOT EXISTS (SELECT 1 FROM fact_orders f WHERE f.order_id = o.order_id)"),
    ),
    Query(
        "join_semi",
        join_semi,
        "order_id:s product_id:s file_source:s",
        with_star(
            """SELECT order_id, product_id, file_source FROM stg_lines WHERE (order_id, product_id) IN
            (SELECT (order_id, product_id) FROM stg_lines GROUP BY order_id, product_id HAVING COUNT(*) > 1)"""
        ),
    ),
    Query(
        "join_cross_scalar",
        join_cross_scalar,
        "staged_pairs:i fact_rows:i difference:i",
        with_star(
            """SELECT a.n AS staged_pairs, b.n AS fact_rows, a.n - b.n AS difference
            FROM (SELECT COUNT(DISTINCT (order_id, product_id)) AS n FROM stg_lines) a
            CROSS JOIN (SELECT COUNT(*) AS n FROM fact_line_items) b"""
        ),
    ),
    Query(
        "scalar_subquery",
        scalar_subquery,
        "total_in_dim:i distinct_in_facts:i longest_delay:i",
        with_star(
            """SELECT (SELECT COUNT(*) FROM dim_merchant) AS total_in_dim,
            (SELECT COUNT(DISTINCT merchant_sk) FROM fact_orders) AS distinct_in_facts,
            (SELECT MAX(delay_days) FROM fact_orders) AS longest_delay"""
        ),
    ),
    Query(
        "join_on_date_expr",
        join_on_date_expr,
        "o_orderkey:i date_sk:i quarter:s",
        with_star("SELECT o_orderkey, date_sk, quarter FROM orders JOIN dim_date d ON CAST(o_orderdate AS DATE) = d.date"),
    ),
    Query(
        "join_cte_preagg",
        join_cte_preagg,
        "merchant_id:s avg_delay_days:r6 delayed_orders:i",
        with_star(
            f"""SELECT m.merchant_id, d.avg_delay_days, d.delayed_orders FROM dim_merchant m LEFT JOIN
            (SELECT merchant_sk, {sql_ratio('SUM(delay_days)', 'COUNT(delay_days)')} AS avg_delay_days,
            COUNT(CASE WHEN delay_days > 0 THEN 1 END) AS delayed_orders FROM fact_orders GROUP BY 1) d
            ON d.merchant_sk = m.merchant_sk"""
        ),
    ),
    Query(
        "join_optional_key",
        join_optional_key,
        "product_id:s orphans:i",
        with_star(
            """SELECT l.product_id, COUNT(*) AS orphans FROM stg_lines l LEFT JOIN known_products p ON p.product_id = l.product_id
            WHERE p.product_id IS NULL AND l.file_source <> 'lines-R.csv' GROUP BY 1""",
            _LINES,
        ),
    ),
    Query(
        "agg_count",
        agg_count,
        "rows:i with_product:i",
        """SELECT COUNT(*) AS rows, COUNT(CASE WHEN l_returnflag <> 'R' THEN 1 END) AS with_product FROM lineitem""",
    ),
    Query(
        "agg_count_distinct",
        agg_count_distinct,
        "l_returnflag:s orders:i suppliers:i",
        "SELECT l_returnflag, COUNT(DISTINCT l_orderkey) AS orders, COUNT(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1",
    ),
    Query(
        "agg_count_distinct_case",
        agg_count_distinct_case,
        "l_suppkey:i large_orders:i",
        "SELECT l_suppkey, COUNT(DISTINCT CASE WHEN l_quantity > 25 THEN l_orderkey END) AS large_orders FROM lineitem GROUP BY 1",
    ),
    Query(
        "agg_count_if",
        agg_count_if,
        "transaction_date_sk:i unanswered:i declined:i",
        with_star(
            """SELECT transaction_date_sk, COUNT(CASE WHEN availed IS NULL THEN 1 END) AS unanswered,
            COUNT(CASE WHEN availed = 0 THEN 1 END) AS declined FROM fact_campaign_transactions GROUP BY 1"""
        ),
    ),
    Query(
        "agg_count_distinct_tuple",
        agg_count_distinct_tuple,
        "file_source:s pairs:i",
        with_star(
            """SELECT file_source, COUNT(DISTINCT (order_id, CASE WHEN file_source <> 'lines-R.csv' THEN product_id END)) AS pairs
            FROM stg_lines GROUP BY 1"""
        ),
    ),
    Query(
        "agg_sum_product",
        agg_sum_product,
        "product_type:s quantity:i revenue:d",
        with_star(
            """SELECT p.product_type, SUM(l.quantity) AS quantity, SUM(l.quantity * p.price) AS revenue
            FROM fact_line_items l LEFT JOIN dim_product p ON p.product_sk = l.product_sk GROUP BY 1"""
        ),
    ),
    Query(
        "agg_avg",
        agg_avg,
        "transaction_date_sk:i avg_line_revenue:r6 avg_quantity:r6",
        with_star(
            f"""SELECT transaction_date_sk, {sql_ratio('SUM(l.quantity * p.price)', 'COUNT(l.quantity * p.price)')} AS avg_line_revenue,
            {sql_ratio('SUM(l.quantity)', 'COUNT(l.quantity)')} AS avg_quantity
            FROM fact_line_items l LEFT JOIN dim_product p ON p.product_sk = l.product_sk GROUP BY 1"""
        ),
    ),
    Query(
        "agg_min_max",
        agg_min_max,
        "l_suppkey:i first_ship:s last_ship:s lowest:d highest:d",
        """SELECT l_suppkey, MIN(l_shipdate) AS first_ship, MAX(l_shipdate) AS last_ship, MIN(l_extendedprice) AS lowest,
        MAX(l_extendedprice) AS highest FROM lineitem GROUP BY 1""",
    ),
    Query(
        "agg_string_agg",
        agg_string_agg,
        "order_id:s product_id:s occurrence_count:i source_files:s first_seen:s last_seen:s",
        with_star(
            """SELECT order_id, product_id, COUNT(*) AS occurrence_count,
            string_agg(DISTINCT file_source, ', ' ORDER BY file_source) AS source_files,
            MIN(loaded_at) AS first_seen, MAX(loaded_at) AS last_seen FROM stg_lines GROUP BY 1, 2 HAVING COUNT(*) > 1"""
        ),
    ),
    Query(
        "agg_array_ordered",
        agg_array_ordered,
        "p_type:s n:i brands:s",
        """SELECT p_type, COUNT(DISTINCT p_brand) AS n, array_to_string(list(DISTINCT p_brand ORDER BY p_brand), ',') AS brands
        FROM part GROUP BY 1""",
    ),
    Query(
        "agg_having",
        agg_having,
        "order_id:s product_id:s occurrences:i",
        with_star("SELECT order_id, product_id, COUNT(*) AS occurrences FROM stg_lines GROUP BY 1, 2 HAVING COUNT(*) > 1"),
    ),
    Query(
        "agg_reaggregate",
        agg_reaggregate,
        "year:i quarter:s revenue:d avg_of_avg:r4 summed_customers:i customer_counts:i",
        with_star(
            """SELECT year, quarter, SUM(total_revenue) AS revenue, AVG(avg_order_value) AS avg_of_avg,
            SUM(unique_customers) AS summed_customers, COUNT(DISTINCT unique_customers) AS customer_counts
            FROM vw_sales_by_time GROUP BY 1, 2"""
        ),
    ),
    Query(
        "agg_global",
        agg_global,
        "quantity:r2 first_ship:s rows:i",
        "SELECT SUM(l_quantity) AS quantity, MIN(l_shipdate) AS first_ship, COUNT(*) AS rows FROM lineitem",
    ),
    Query(
        "agg_ratio_pct",
        agg_ratio_pct,
        "o_custkey:i shipped_pct:r2",
        f"""SELECT o_custkey, ROUND({sql_ratio("COUNT(CASE WHEN o_orderstatus = 'F' THEN 1 END)", 'COUNT(*)')} * 100, 2) AS shipped_pct
        FROM orders GROUP BY 1""",
    ),
    Query(
        "agg_nested_cte",
        agg_nested_cte,
        "lines:i orders:i",
        "SELECT lines, COUNT(*) AS orders FROM (SELECT l_orderkey, COUNT(*) AS lines FROM lineitem GROUP BY 1) GROUP BY 1",
    ),
    Query(
        "distinct_rows",
        distinct_rows,
        "l_suppkey:i l_returnflag:s l_linestatus:s",
        "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem",
    ),
    Query(
        "dedup_keep_first",
        dedup_keep_first,
        "order_id:s product_id:s price:d quantity:s",
        with_star(
            """SELECT order_id, product_id, price, CAST(quantity AS VARCHAR) || 'pcs' AS quantity FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY seq) AS rn FROM stg_lines) WHERE rn = 1"""
        ),
    ),
    Query(
        "win_row_number",
        win_row_number,
        "order_id:s product_id:s price:d position:i",
        with_star(
            """SELECT order_id, product_id, price, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY seq) AS position
            FROM stg_lines"""
        ),
    ),
    Query(
        "win_first_wins",
        win_first_wins,
        "order_id:s product_id:s price:d quantity:s",
        with_star(
            """SELECT order_id, product_id, price, CAST(quantity AS VARCHAR) || 'pcs' AS quantity FROM (SELECT *,
            ROW_NUMBER() OVER (PARTITION BY order_id, product_id ORDER BY seq) AS rn FROM stg_lines) WHERE rn = 1"""
        ),
    ),
    Query(
        "win_last_wins",
        win_last_wins,
        "product_id:s order_id:s price:d",
        with_star(
            """SELECT product_id, order_id, price FROM (SELECT *,
            ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY seq DESC) AS rn FROM stg_lines) WHERE rn = 1"""
        ),
    ),
    Query(
        "sort_multi",
        sort_multi,
        "campaign_id:s availed:i order_id:s",
        with_star(
            """SELECT c.campaign_id, f.availed, f.order_id FROM fact_campaign_transactions f
            JOIN dim_campaign c ON c.campaign_sk = f.campaign_sk
            ORDER BY c.campaign_id ASC NULLS LAST, f.availed DESC NULLS FIRST, f.order_id"""
        ),
    ),
    Query(
        "topk",
        topk,
        "o_orderkey:i o_totalprice:d",
        "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey LIMIT 20",
    ),
    Query(
        "limit_sample",
        limit_sample,
        "order_id:s product_id:s file_source:s",
        with_star(
            """SELECT order_id, product_id, file_source FROM (SELECT *, COUNT(*) OVER (PARTITION BY order_id, product_id) AS n
            FROM stg_lines) WHERE n > 1 ORDER BY order_id, product_id, file_source LIMIT 20"""
        ),
    ),
    Query(
        "union_all",
        union_all,
        "order_id:s rows:i products:i users:i",
        with_star(
            """SELECT order_id, COUNT(*) AS rows, COUNT(product_id) AS products, COUNT(user_id) AS users FROM (
            SELECT order_id, product_id, NULL AS user_id FROM stg_lines
            UNION ALL SELECT order_id, NULL, user_id FROM stg_orders) GROUP BY 1"""
        ),
    ),
    Query(
        "set_difference",
        set_difference,
        "product_id:s",
        with_star("SELECT product_id FROM stg_lines EXCEPT SELECT product_id FROM known_products", _LINES),
    ),
]
