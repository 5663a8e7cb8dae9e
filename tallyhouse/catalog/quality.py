"""Data-quality, reconciliation and profiling queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhouse.catalog.base import Query
from tallyhouse.catalog.loads import _LINES, _known_dim_products, _known_orders, _line_products
from tallyhouse.catalog.star_sql import MESSY_TYPE, ratio as sql_ratio, with_star
from tallyhouse.operators import dimensions as dims
from tallyhouse.operators import facts, profiling, quality
from tallyhouse.operators import relational as rel
from tallyhouse.plans import sample_star
from tallyhouse.plans.sample_star import table
from tallyhouse.session import materialize

star = sample_star.star
KPI_DAY = "1998-06-15"
YEAR, MONTH = 1998, 1


def _flawed(spark, sf_dir) -> sample_star.Lazy:
    """The star with members taken away and values damaged, so that the checks
    have something to find."""
    s = star(spark, sf_dir)
    quantity, delay = F.col("quantity"), F.col("delay_days")
    return s.replaced(
        dim_user=lambda: s["dim_user"].filter(F.col("user_type") != "Machinery"),
        dim_merchant=lambda: s["dim_merchant"].filter(F.col("city") != "ASIA"),
        dim_product=lambda: s["dim_product"].filter(F.col("product_type") != "Grocery"),
        dim_campaign=lambda: s["dim_campaign"].withColumn("discount", (F.col("discount") * 4).cast("decimal(10,2)")),
        fact_line_items=lambda: s["fact_line_items"].withColumns(
            {
                "price": F.when(quantity != 7, F.col("price")),
                "quantity": F.when(quantity > 45, -quantity).otherwise(quantity),
            }
        ),
        fact_orders=lambda: s["fact_orders"]
        .unionByName(s["fact_orders"].filter(delay == 9))
        .withColumn("delay_days", F.when(delay == 8, -1).otherwise(delay)),
    )


_FLAWED = {
    "bad_user": "SELECT * FROM dim_user WHERE user_type <> 'Machinery'",
    "bad_merchant": "SELECT * FROM dim_merchant WHERE city <> 'ASIA'",
    "bad_product": "SELECT * FROM dim_product WHERE product_type <> 'Grocery'",
    "bad_campaign": "SELECT * REPLACE (CAST(discount * 4 AS DECIMAL(10,2)) AS discount) FROM dim_campaign",
    "bad_lines": """SELECT * REPLACE (CASE WHEN quantity <> 7 THEN price END AS price,
        CASE WHEN quantity > 45 THEN -quantity ELSE quantity END AS quantity) FROM fact_line_items""",
    "bad_orders": """SELECT * REPLACE (CASE WHEN delay_days = 8 THEN -1 ELSE delay_days END AS delay_days) FROM
        (SELECT * FROM fact_orders UNION ALL SELECT * FROM fact_orders WHERE delay_days = 9)""",
}
_BAD = {
    "fact_orders": "bad_orders",
    "fact_line_items": "bad_lines",
    "dim_user": "bad_user",
    "dim_merchant": "bad_merchant",
    "dim_product": "bad_product",
    "dim_campaign": "bad_campaign",
}


def _bad(name: str) -> str:
    return _BAD.get(name, name)


_REFERENTIAL = " UNION ALL ".join(
    f"""SELECT '{t}.{c} references {r}' AS "check", COUNT(*) AS violations FROM {_bad(t)} a
    LEFT JOIN {_bad(r)} b ON a.{c} = b.{rc} WHERE b.{rc} IS NULL"""
    for t, c, r, rc in quality.REFERENCES
)
_NULLS = " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", '{c}' AS "column", COUNT(*) AS nulls FROM {_bad(t)} WHERE {c} IS NULL"""
    for t, cs in quality.CRITICAL_COLUMNS.items()
    for c in (cs if not t.startswith("dim_") else cs[1:])
)
_DUPLICATES = " UNION ALL ".join(
    f"""SELECT 'Duplicate {k} in {t}' AS "check", COUNT(*) AS violations FROM
    (SELECT {k} FROM {_bad(t)} GROUP BY {k} HAVING COUNT(*) > 1)"""
    for t, k in quality.UNIQUE_KEYS
)
_RANGES = " UNION ALL ".join(
    f"""SELECT '{name}' AS "check", COUNT(*) AS violations FROM {_bad(t)} WHERE {cond}"""
    for name, t, cond in quality.RANGES
)
_ROWS = " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", COUNT(*) AS records FROM {_bad(t)}""" for t in quality.COUNTED_TABLES
)


def _judge(value: str) -> str:
    return f"CASE WHEN {value} = 0 THEN 'PASSED' ELSE 'FAILED' END"


_REPORT = f"""SELECT 'references' AS kind, "check" AS name, violations AS value, {_judge('violations')} AS status FROM ({_REFERENTIAL})
UNION ALL SELECT 'nulls', "table" || '.' || "column", nulls, {_judge('nulls')} FROM ({_NULLS})
UNION ALL SELECT 'nulls', 'dim_user.user_sk', 0, 'PASSED' UNION ALL SELECT 'nulls', 'dim_product.product_sk', 0, 'PASSED'
UNION ALL SELECT 'duplicates', "check", violations, {_judge('violations')} FROM ({_DUPLICATES})
UNION ALL SELECT 'ranges', "check", violations, {_judge('violations')} FROM ({_RANGES})
UNION ALL SELECT 'rows', "table", records, 'INFO' FROM ({_ROWS})"""


def on_flawed(fn):
    return lambda spark, sf_dir: fn(_flawed(spark, sf_dir))


def _rename(fn, **names):
    def run(spark, sf_dir):
        df = fn(spark, sf_dir)
        for old, new in names.items():
            df = df.withColumnRenamed(old, new)
        return df

    return run


def staged_products(spark, sf_dir) -> DataFrame:
    return sample_star.staging(spark, sf_dir)["line_item_data_products"]


def staged_prices(spark, sf_dir) -> DataFrame:
    return sample_star.staging(spark, sf_dir)["line_item_data_prices"]


def line_item_gap(spark, sf_dir):
    """Line items loaded against a product and order table with gaps."""
    whole = star(spark, sf_dir)
    s = whole.replaced(dim_product=lambda: _known_dim_products(whole), fact_orders=lambda: _known_orders(whole))
    load = facts.load_line_items(
        dims.empty_table(spark, "fact_line_items"),
        staged_prices(spark, sf_dir),
        _line_products(spark, sf_dir),
        s["dim_product"],
        s["fact_orders"],
        "position",
    )
    s = s.replaced(fact_line_items=lambda: load.table, reject_fact_line_items=lambda: load.rejects)
    return quality.line_item_gap(staged_prices(spark, sf_dir), _line_products(spark, sf_dir), s)


def new_members(spark, sf_dir):
    """Members for all staged users: loaded, stubbed, and used or not."""
    s = star(spark, sf_dir)
    known = s["dim_user"].filter(F.col("user_type") == "Building")
    ids = sample_star.staging(spark, sf_dir)["user_data"].select("user_id")
    return quality.members_in_use(known, _known_orders(s), ids, "user_id", "user_sk")


def column_ready(spark, sf_dir):
    return rel.union_all(
        [
            quality.column_ready(df, column).withColumn("feed", F.lit(name))
            for name, df, column in [
                ("merchants", sample_star.staging(spark, sf_dir)["order_with_merchant_data"], "staff_id"),
                ("products", _line_products(spark, sf_dir), "product_id"),
                ("orders", sample_star.staging(spark, sf_dir)["order_data"], "staff_id"),
            ]
        ]
    )


def _metrics(spark, sf_dir):
    s = star(spark, sf_dir)
    early = s.replaced(
        fact_line_items=lambda: s["fact_line_items"].filter(F.col("quantity") <= 25),
        fact_orders=lambda: s["fact_orders"].filter(F.col("delay_days") < 5),
    )
    return quality.metric_changes(quality.load_metrics(early, KPI_DAY), quality.load_metrics(s, KPI_DAY))


def expected_rows(spark, sf_dir):
    """What the rows held back would add, against what was added."""
    s = star(spark, sf_dir)
    return quality.expected_changes(
        _metrics(spark, sf_dir),
        {
            "fact_line_items_count": s["fact_line_items"].filter(F.col("quantity") > 25).agg(F.count("*")),
            "fact_orders_count": s["fact_orders"].agg(F.count("*")),
        },
    )


_DAY = f"JOIN dim_date d ON d.date_sk = o.transaction_date_sk AND d.date = DATE '{KPI_DAY}'"
_CHANGES = f"""SELECT 'fact_orders_count' AS metric, COUNT(CASE WHEN delay_days < 5 THEN 1 END) AS before, COUNT(*) AS after FROM fact_orders
UNION ALL SELECT 'fact_line_items_count', COUNT(CASE WHEN quantity <= 25 THEN 1 END), COUNT(*) FROM fact_line_items
UNION ALL SELECT 'kpi_order_count',
    (SELECT COUNT(*) FROM fact_orders o {_DAY} LEFT JOIN fact_line_items l ON l.order_id = o.order_id AND l.quantity <= 25
     WHERE o.delay_days < 5),
    (SELECT COUNT(*) FROM fact_orders o {_DAY} LEFT JOIN fact_line_items l ON l.order_id = o.order_id)
UNION ALL SELECT 'kpi_total_sales',
    (SELECT COALESCE(SUM(l.price * l.quantity), 0) FROM fact_orders o {_DAY}
     LEFT JOIN fact_line_items l ON l.order_id = o.order_id AND l.quantity <= 25 WHERE o.delay_days < 5),
    (SELECT COALESCE(SUM(l.price * l.quantity), 0) FROM fact_orders o {_DAY} LEFT JOIN fact_line_items l ON l.order_id = o.order_id)"""


# --- profiles ------------------------------------------------------------------------


def raw_users(spark, sf_dir) -> DataFrame:
    """Customer rows as a messy file: blanks, mixed case, gaps."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.concat(F.lit("USER"), F.col("c_custkey").cast("string")).alias("user_id"),
        F.when(F.col("c_acctbal") < 0, F.upper("c_name")).otherwise(F.col("c_name")).alias("name"),
        F.when(F.col("c_acctbal") > 9000, F.lit(None))
        .when(F.col("c_acctbal") < 0, F.concat(F.lit(" "), F.lower("c_mktsegment")))
        .when(F.col("c_acctbal") < 1000, F.lower("c_mktsegment"))
        .otherwise(F.col("c_mktsegment"))
        .alias("user_type"),
        F.when(F.col("c_acctbal") < 500, "  ").otherwise(F.col("c_nationkey").cast("string")).alias("city"),
        F.when(
            F.col("c_nationkey") > 10, F.concat(F.lit("user"), F.col("c_custkey").cast("string"), F.lit("@example.com"))
        )
        .when(F.col("c_nationkey") > 5, "nobody(at)example")
        .when(F.col("c_nationkey") > 2, "")
        .alias("email"),
        F.concat(F.lit("+63 "), F.col("c_custkey").cast("string")).alias("contact_number"),
        F.col("c_custkey").alias("ingest_seq"),
    )


_RAW_USERS = """SELECT 'USER' || CAST(c_custkey AS VARCHAR) AS user_id,
    CASE WHEN c_acctbal < 0 THEN upper(c_name) ELSE c_name END AS name,
    CASE WHEN c_acctbal > 9000 THEN NULL WHEN c_acctbal < 0 THEN ' ' || lower(c_mktsegment)
        WHEN c_acctbal < 1000 THEN lower(c_mktsegment) ELSE c_mktsegment END AS user_type,
    CASE WHEN c_acctbal < 500 THEN '  ' ELSE CAST(c_nationkey AS VARCHAR) END AS city,
    CASE WHEN c_nationkey > 10 THEN 'user' || CAST(c_custkey AS VARCHAR) || '@example.com'
        WHEN c_nationkey > 5 THEN 'nobody(at)example' WHEN c_nationkey > 2 THEN '' END AS email,
    '+63 ' || CAST(c_custkey AS VARCHAR) AS contact_number, c_custkey AS seq FROM customer"""
_USER_COLUMNS = ["user_id", "name", "user_type", "city", "email", "contact_number"]


def profile_file(spark, sf_dir):
    df = raw_users(spark, sf_dir)
    twice = df.unionByName(df.filter(F.col("user_type").isNull()))
    return profiling.profile_file(twice, _USER_COLUMNS[:-1] + ["birthdate"])


def profile_column(spark, sf_dir):
    return profiling.profile_columns(profiling.value_counts(raw_users(spark, sf_dir)))


def profile_top_values(spark, sf_dir):
    return profiling.top_values(profiling.value_counts(raw_users(spark, sf_dir)))


def profile_typos(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        F.when(F.col("p_type") == "ECONOMY", "Toolss")
        .when(F.col("p_type") == "LARGE", "cosmetic")
        .when(F.col("p_type") == "SMALL", "Groceryy")
        .when(F.col("p_type") == "MEDIUM", "Apparel")
        .otherwise(F.col("p_type"))
        .alias("product_type")
    )
    return profiling.typos(profiling.value_counts(part))


def profile_formats(spark, sf_dir):
    return profiling.format_checks(raw_users(spark, sf_dir))


def sparse_rows(spark, sf_dir) -> DataFrame:
    """Orders widened so that some rows are empty or nearly so."""
    o = table(spark, sf_dir, "orders")
    keep = F.col("o_orderstatus") == "F"
    open_ = F.col("o_orderstatus") == "O"
    cols = ["o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderkey"]
    return o.select(
        *[F.when(keep, F.col(c)).alias(c) for c in cols], F.when(keep | open_, F.col("o_orderstatus")).alias("o_orderstatus")
    )


_PAIRS = "(SELECT order_id, product_id, COUNT(*) AS n FROM stg_lines GROUP BY 1, 2)"

QUERIES = [
    Query(
        "dq_referential",
        _rename(on_flawed(quality.referential), check="check_name"),
        "check_name:s violations:i",
        with_star(f'SELECT "check" AS check_name, violations FROM ({_REFERENTIAL})', _FLAWED),
    ),
    Query(
        "dq_nulls",
        _rename(on_flawed(quality.null_counts), table="table_name", column="column_name"),
        "table_name:s column_name:s nulls:i",
        with_star(
            f"""SELECT "table" AS table_name, "column" AS column_name, nulls FROM ({_NULLS})
            UNION ALL SELECT 'dim_user', 'user_sk', 0 UNION ALL SELECT 'dim_product', 'product_sk', 0""",
            _FLAWED,
        ),
    ),
    Query(
        "dq_duplicates",
        _rename(on_flawed(quality.duplicate_keys), check="check_name"),
        "check_name:s violations:i",
        with_star(f'SELECT "check" AS check_name, violations FROM ({_DUPLICATES})', _FLAWED),
    ),
    Query(
        "dq_ranges",
        _rename(on_flawed(quality.range_violations), check="check_name"),
        "check_name:s violations:i",
        with_star(f'SELECT "check" AS check_name, violations FROM ({_RANGES})', _FLAWED),
    ),
    Query(
        "dq_row_counts",
        _rename(on_flawed(quality.row_counts), table="table_name"),
        "table_name:s records:i",
        with_star(f'SELECT "table" AS table_name, records FROM ({_ROWS})', _FLAWED),
    ),
    Query("dq_report", on_flawed(quality.report), "kind:s name:s value:i status:s", with_star(_REPORT, _FLAWED)),
    Query(
        "dq_conflicts",
        lambda spark, sf_dir: quality.conflict_summary(staged_products(spark, sf_dir), star(spark, sf_dir)),
        "unique_in_staging:i fact_rows:i unique_in_fact:i duplicates_in_fact:i difference:i status:s would_conflict:i "
        "duplicates_in_staging:i total_conflicts:i conflict_percentage:r2",
        with_star(
            f"""SELECT u AS unique_in_staging, f AS fact_rows, f AS unique_in_fact, 0 AS duplicates_in_fact, u - f AS difference,
            CASE WHEN u > f THEN 'More in staging (some rows not loaded or conflicted)'
                WHEN u = f THEN 'Match (all unique staging rows loaded)'
                ELSE 'More in fact (unexpected - check for issues)' END AS status,
            w AS would_conflict, r - u AS duplicates_in_staging, w + r - u AS total_conflicts,
            ROUND({sql_ratio('w + r - u', 'u')} * 100, 2) AS conflict_percentage
            FROM (SELECT (SELECT COUNT(*) FROM {_PAIRS}) AS u, (SELECT COUNT(*) FROM fact_line_items) AS f,
                (SELECT COUNT(*) FROM stg_lines) AS r,
                (SELECT COUNT(*) FROM stg_lines l JOIN dim_product p ON p.product_id = l.product_id
                 JOIN fact_line_items x ON x.order_id = l.order_id AND x.product_sk = p.product_sk) AS w)"""
        ),
    ),
    Query(
        "dq_conflicts_top",
        lambda spark, sf_dir: quality.repeated_pairs(staged_products(spark, sf_dir)),
        "order_id:s product_id:s occurrence_count:i source_files:s first_seen:s last_seen:s",
        with_star(
            """SELECT order_id, product_id, COUNT(*) AS occurrence_count,
            string_agg(DISTINCT file_source, ', ' ORDER BY file_source) AS source_files,
            MIN(loaded_at) AS first_seen, MAX(loaded_at) AS last_seen FROM stg_lines GROUP BY 1, 2 HAVING COUNT(*) > 1
            ORDER BY occurrence_count DESC, order_id, product_id LIMIT 20"""
        ),
    ),
    Query(
        "dq_conflicts_totals",
        lambda spark, sf_dir: quality.staged_pair_totals(staged_products(spark, sf_dir)),
        "total_rows:i unique_combinations:i duplicate_rows:i duplicate_percentage:r2",
        with_star(
            f"""SELECT SUM(n) AS total_rows, COUNT(*) AS unique_combinations, SUM(n) - COUNT(*) AS duplicate_rows,
            ROUND({sql_ratio('SUM(n) - COUNT(*)', 'SUM(n)')} * 100, 2) AS duplicate_percentage FROM {_PAIRS}"""
        ),
    ),
    Query(
        "dq_conflicts_by_file",
        lambda spark, sf_dir: quality.staged_pairs_by_file(staged_products(spark, sf_dir)),
        "file_source:s total_rows:i unique_combinations:i duplicate_rows:i duplicate_percentage:r2",
        with_star(
            f"""SELECT file_source, COUNT(*) AS total_rows, COUNT(DISTINCT (order_id, product_id)) AS unique_combinations,
            COUNT(*) - COUNT(DISTINCT (order_id, product_id)) AS duplicate_rows,
            ROUND({sql_ratio('COUNT(*) - COUNT(DISTINCT (order_id, product_id))', 'COUNT(*)')} * 100, 2) AS duplicate_percentage
            FROM stg_lines GROUP BY 1 HAVING COUNT(*) > COUNT(DISTINCT (order_id, product_id))"""
        ),
    ),
    Query(
        "dq_conflicts_sample",
        lambda spark, sf_dir: quality.conflict_sample(staged_products(spark, sf_dir), star(spark, sf_dir), stage=materialize),
        "order_id:s product_id:s file_source:s conflict_reason:s",
        with_star(
            """SELECT l.order_id, l.product_id, l.file_source, 'Already in fact_line_items' AS conflict_reason
            FROM stg_lines l JOIN dim_product p ON p.product_id = l.product_id
            JOIN fact_line_items f ON f.order_id = l.order_id AND f.product_sk = p.product_sk
            ORDER BY l.order_id, l.product_id, l.file_source LIMIT 20"""
        ),
    ),
    Query(
        "dq_line_item_gap",
        line_item_gap,
        "metric:s value:i",
        with_star(
            """SELECT metric, value FROM (SELECT
            (SELECT COUNT(*) FROM stg_lines) AS staged_prices, (SELECT COUNT(*) FROM stg_lines) AS staged_products,
            (SELECT COUNT(*) FROM first_lines) AS fact_rows, (SELECT COUNT(*) FROM first_lines) AS fact_pairs,
            CAST(0 AS BIGINT) AS repeated_pairs,
            (SELECT COUNT(DISTINCT l.order_id) FROM stg_lines l WHERE NOT EXISTS
                (SELECT 1 FROM known_orders o WHERE o.order_id = l.order_id)) AS orders_not_loaded,
            (SELECT COUNT(*) FROM stg_lines l WHERE file_source <> 'lines-R.csv' AND NOT EXISTS
                (SELECT 1 FROM known_products p WHERE p.product_id = l.product_id)) AS lines_with_unknown_product,
            (SELECT COUNT(*) FROM judged_lines WHERE reason IS NOT NULL) AS rejected,
            CAST(0 AS BIGINT) AS duplicate_rows,
            (SELECT COUNT(*) FROM stg_lines) - (SELECT COUNT(*) FROM first_lines) AS staged_minus_fact,
            (SELECT COUNT(*) FROM judged_lines WHERE reason IS NULL) - (SELECT COUNT(*) FROM first_lines) AS ignored_as_repeat)
            UNPIVOT (value FOR metric IN (staged_prices, staged_products, fact_rows, fact_pairs, repeated_pairs,
                orders_not_loaded, lines_with_unknown_product, rejected, duplicate_rows, staged_minus_fact, ignored_as_repeat))""",
            _LINES,
        ),
    ),
    Query(
        "dq_line_item_repeats",
        lambda spark, sf_dir: quality.repeated_fact_pairs(
            {"fact_line_items": sample_star.staged_lines(spark, sf_dir).withColumnRenamed("product_id", "product_sk")}
        ),
        "order_id:s product_sk:s occurrences:i",
        with_star(
            """SELECT order_id, product_id AS product_sk, COUNT(*) AS occurrences FROM stg_lines GROUP BY 1, 2
            HAVING COUNT(*) > 1 ORDER BY occurrences DESC, order_id, product_sk LIMIT 20"""
        ),
    ),
    Query(
        "dq_new_members",
        new_members,
        "user_id:s member_exists:b referenced:b",
        with_star(
            """SELECT user_id, user_type = 'Building' AS member_exists, user_type = 'Building' AND EXISTS
            (SELECT 1 FROM known_orders o WHERE o.user_sk = u.user_sk) AS referenced FROM dim_user u""",
            _LINES,
        ),
    ),
    Query(
        "dq_merchant_gap",
        lambda spark, sf_dir: quality.merchant_gap(star(spark, sf_dir).replaced(fact_orders=lambda: _late_orders(spark, sf_dir))),
        "total_in_dim:i duplicate_ids:i distinct_in_view:i repeated_in_view:i occurrences_in_facts:i distinct_in_facts:i "
        "without_orders:i difference:i validation:s",
        with_star(
            """SELECT COUNT(*) AS total_in_dim, 0 AS duplicate_ids, COUNT(n) AS distinct_in_view, 0 AS repeated_in_view,
            SUM(n) AS occurrences_in_facts, COUNT(n) AS distinct_in_facts, COUNT(*) - COUNT(n) AS without_orders,
            COUNT(*) - COUNT(n) AS difference, 'View matches fact_orders' AS validation
            FROM dim_merchant m LEFT JOIN (SELECT merchant_sk, COUNT(*) AS n FROM fact_orders WHERE delay_days = 9
                AND transaction_date_sk > 20010000 GROUP BY 1) o ON o.merchant_sk = m.merchant_sk"""
        ),
    ),
    Query(
        "dq_merchants_without_orders",
        lambda spark, sf_dir: quality.merchants_without_orders(
            star(spark, sf_dir).replaced(fact_orders=lambda: _late_orders(spark, sf_dir))
        ),
        "merchant_id:s name:s city:s country:s",
        with_star(
            """SELECT merchant_id, name, city, country FROM dim_merchant m WHERE NOT EXISTS (SELECT 1 FROM fact_orders o
            WHERE o.merchant_sk = m.merchant_sk AND delay_days = 9 AND transaction_date_sk > 20010000)"""
        ),
    ),
    Query(
        "dq_jan_revenue",
        lambda spark, sf_dir: quality.month_revenue(star(spark, sf_dir), YEAR, MONTH),
        "source:s total_revenue:d total_orders:i orders_with_line_items:i",
        with_star(
            f"""SELECT 'Direct from Facts' AS source, SUM(l.quantity * p.price) AS total_revenue,
            COUNT(DISTINCT o.order_id) AS total_orders, COUNT(DISTINCT l.order_id) AS orders_with_line_items
            FROM fact_orders o LEFT JOIN dim_date d ON d.date_sk = o.transaction_date_sk
            LEFT JOIN fact_line_items l ON l.order_id = o.order_id LEFT JOIN dim_product p ON p.product_sk = l.product_sk
            WHERE d.year = {YEAR} AND d.month = {MONTH}
            UNION ALL SELECT x, SUM(total_revenue), SUM(total_orders), NULL FROM vw_sales_by_time
            CROSS JOIN (VALUES ('View (Sum of Daily)'), ('View (Monthly)')) t(x)
            WHERE year = {YEAR} AND month = {MONTH} GROUP BY x"""
        ),
    ),
    Query(
        "dq_jan_revenue_days",
        lambda spark, sf_dir: quality.month_profile(star(spark, sf_dir), YEAR, MONTH),
        "days:i days_with_null_revenue:i days_with_zero_revenue:i min_daily_revenue:d max_daily_revenue:d "
        "avg_daily_revenue:r6 orders_without_line_items:i",
        with_star(
            f"""SELECT COUNT(*) AS days, COUNT(CASE WHEN total_revenue IS NULL THEN 1 END) AS days_with_null_revenue,
            COUNT(CASE WHEN total_revenue = 0 THEN 1 END) AS days_with_zero_revenue, MIN(total_revenue) AS min_daily_revenue,
            MAX(total_revenue) AS max_daily_revenue, {sql_ratio('SUM(total_revenue)', 'COUNT(total_revenue)')} AS avg_daily_revenue,
            (SELECT COUNT(*) FROM fact_orders o JOIN dim_date d ON d.date_sk = o.transaction_date_sk
             WHERE d.year = {YEAR} AND d.month = {MONTH} AND o.order_id NOT IN (SELECT order_id FROM fact_line_items))
            AS orders_without_line_items FROM vw_sales_by_time WHERE year = {YEAR} AND month = {MONTH}"""
        ),
    ),
    Query(
        "dq_column_ready",
        column_ready,
        "feed:s total:i missing:i filled:i verdict:s",
        with_star(
            """SELECT 'merchants' AS feed, COUNT(*) AS total, 0 AS missing, COUNT(*) AS filled, 'ready' AS verdict FROM stg_merchants
            UNION ALL SELECT 'products', COUNT(*), COUNT(CASE WHEN file_source = 'lines-R.csv' THEN 1 END),
            COUNT(CASE WHEN file_source <> 'lines-R.csv' THEN 1 END), 'some rows will be skipped' FROM stg_lines
            UNION ALL SELECT 'orders', COUNT(*), COUNT(*), 0, 'no row has a value' FROM stg_orders"""
        ),
    ),
    Query(
        "metrics_before_after",
        _metrics,
        "metric:s before:d after:d change:d",
        with_star(f"SELECT *, after - before AS change FROM ({_CHANGES})"),
    ),
    Query(
        "check_expected_rows",
        expected_rows,
        "metric:s expected:d actual:d passed:b",
        with_star(
            """SELECT 'fact_line_items_count' AS metric, COUNT(CASE WHEN quantity > 25 THEN 1 END) AS expected,
            COUNT(CASE WHEN quantity > 25 THEN 1 END) AS actual, TRUE AS passed FROM fact_line_items
            UNION ALL SELECT 'fact_orders_count', COUNT(*), COUNT(CASE WHEN delay_days >= 5 THEN 1 END), FALSE FROM fact_orders"""
        ),
    ),
    Query(
        "profile_file",
        _rename(profile_file, column="column_name"),
        "column_name:s rows:i nulls:i null_pct:r4 duplicate_rows:i expected:b",
        with_star(
            " UNION ALL ".join(
                f"""SELECT '{c}' AS column_name, COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS nulls,
                {sql_ratio(f'COUNT(*) - COUNT({c})', 'COUNT(*)')} * 100 AS null_pct,
                (SELECT COUNT(*) FROM raw_users WHERE user_type IS NULL) AS duplicate_rows, {c != 'contact_number'} AS expected
                FROM (SELECT * FROM raw_users UNION ALL SELECT * FROM raw_users WHERE user_type IS NULL)"""
                for c in _USER_COLUMNS
            )
            + " UNION ALL SELECT 'birthdate', NULL, NULL, NULL, NULL, TRUE",
            {"raw_users": _RAW_USERS},
        ),
    ),
    Query(
        "profile_column",
        _rename(profile_column, column="column_name"),
        "column_name:s rows:i nulls:i null_pct:r4 distinct_values:i empty_strings:i outer_whitespace:i inconsistent_casing:b",
        with_star(
            " UNION ALL ".join(
                f"""SELECT '{c}' AS column_name, COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS nulls,
                {sql_ratio(f'COUNT(*) - COUNT({c})', 'COUNT(*)')} * 100 AS null_pct, COUNT(DISTINCT {c}) AS distinct_values,
                COUNT(CASE WHEN trim({c}) = '' THEN 1 END) AS empty_strings,
                COUNT(CASE WHEN trim({c}) <> {c} THEN 1 END) AS outer_whitespace,
                COUNT(DISTINCT lower({c})) < COUNT(DISTINCT {c}) AS inconsistent_casing FROM raw_users"""
                for c in _USER_COLUMNS
            ),
            {"raw_users": _RAW_USERS},
        ),
    ),
    Query(
        "profile_top_values",
        _rename(profile_top_values, column="column_name"),
        "column_name:s rank:i value:s n:i",
        with_star(
            f"""SELECT column_name, rank, value, n FROM (SELECT column_name, value, COUNT(*) AS n,
            ROW_NUMBER() OVER (PARTITION BY column_name ORDER BY COUNT(*) DESC, value) AS rank FROM
            ({' UNION ALL '.join(f"SELECT '{c}' AS column_name, {c} AS value FROM raw_users" for c in _USER_COLUMNS)})
            WHERE value IS NOT NULL GROUP BY 1, 2) WHERE rank <= 10""",
            {"raw_users": _RAW_USERS},
        ),
    ),
    Query(
        "profile_typos",
        _rename(profile_typos, column="column_name"),
        "column_name:s typo:s correct:s occurrences:i",
        """SELECT 'product_type' AS column_name, typo, correct, COUNT(*) AS occurrences FROM part
        JOIN (VALUES ('ECONOMY', 'Toolss', 'Tools'), ('LARGE', 'cosmetic', 'Cosmetics'), ('SMALL', 'Groceryy', 'Grocery'))
            t(kind, typo, correct) ON p_type = kind GROUP BY ALL""",
    ),
    Query(
        "profile_formats",
        _rename(profile_formats, column="column_name"),
        "column_name:s rule:s value:i flagged:b",
        with_star(
            """SELECT 'name' AS column_name, 'mixed-case names' AS rule, 0 AS value, FALSE AS flagged
            UNION ALL SELECT 'email', 'invalid emails', COUNT(*), COUNT(*) > 0 FROM raw_users
            WHERE email IS NULL OR email = 'nobody(at)example'
            UNION ALL SELECT 'contact_number', 'phone lengths', COUNT(DISTINCT length(regexp_replace(contact_number, '\\D', '', 'g'))),
            COUNT(DISTINCT length(regexp_replace(contact_number, '\\D', '', 'g'))) > 2
            FROM raw_users""",
            {"raw_users": _RAW_USERS},
        ),
    ),
    Query(
        "profile_rows",
        lambda spark, sf_dir: profiling.row_checks(sparse_rows(spark, sf_dir)),
        "empty_rows:i mostly_null_rows:i",
        """SELECT COUNT(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS empty_rows,
        COUNT(CASE WHEN o_orderstatus <> 'F' THEN 1 END) AS mostly_null_rows FROM orders""",
    ),
]


def _late_orders(spark, sf_dir) -> DataFrame:
    """Only long delays of the last year, so that some merchants have no order."""
    return star(spark, sf_dir)["fact_orders"].filter(
        (F.col("delay_days") == 9) & (F.col("transaction_date_sk") > 20010000)
    )
