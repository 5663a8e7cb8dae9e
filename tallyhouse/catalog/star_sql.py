"""SQL text of the feeds and the star over the given tables (DuckDB dialect).

Written from the rules, not from the Spark plans: it is what the Spark results
are checked against.
"""

from __future__ import annotations

# --- text helpers --------------------------------------------------------------


def title(e: str) -> str:
    runs = rf"regexp_extract_all({e}, '([\p{{L}}]+|[^\p{{L}}]+)')"
    return f"array_to_string(list_transform({runs}, lambda t: upper(t[1:1]) || lower(t[2:])), '')"


def strip(e: str) -> str:
    return rf"regexp_replace({e}, '^\s+|\s+$', '', 'g')"


def squeeze(e: str) -> str:
    return rf"regexp_replace({strip(e)}, '\s+', ' ', 'g')"


def first_number(e: str) -> str:
    return rf"TRY_CAST(NULLIF(regexp_extract({e}, '(\d+)', 1), '') AS INTEGER)"


MESSY_TYPE = """CASE p_type WHEN 'ECONOMY' THEN ' cosmetic_products ' WHEN 'LARGE' THEN 'TECH'
    WHEN 'SMALL' THEN 'toys' WHEN 'MEDIUM' THEN 'home-decor' WHEN 'PROMO' THEN 'GROCERIES'
    WHEN 'STANDARD' THEN 'School  Supplies' ELSE p_type END"""
TYPE_GROUP = """CASE p_type WHEN 'ECONOMY' THEN 'Cosmetics' WHEN 'LARGE' THEN 'Electronics And Technology'
    WHEN 'SMALL' THEN 'Toys And Entertainment' WHEN 'MEDIUM' THEN 'Home Decor' WHEN 'PROMO' THEN 'Grocery'
    WHEN 'STANDARD' THEN 'Stationary And School Supplies' ELSE p_type END"""

LINE_ORDER = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)

_CTES = {
    "places": "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey",
    # --- feeds
    "stg_lines": f"""SELECT 'O' || CAST(l_orderkey AS VARCHAR) AS order_id,
        'PRODUCT' || CAST(l_partkey AS VARCHAR) AS product_id,
        CAST(l_extendedprice AS DECIMAL(10,2)) AS price, CAST(l_quantity AS INTEGER) AS quantity,
        'lines-' || l_returnflag || '.csv' AS file_source, l_shipdate AS loaded_at,
        ROW_NUMBER() OVER (ORDER BY {LINE_ORDER}) AS seq FROM lineitem""",
    "stg_orders": """SELECT 'O' || CAST(o_orderkey AS VARCHAR) AS order_id, 'USER' || CAST(o_custkey AS VARCHAR) AS user_id,
        CAST(o_orderdate AS DATE) AS transaction_date, CAST(o_orderkey % 15 + 1 AS INTEGER) AS estimated_arrival_days,
        o_orderkey AS seq FROM orders""",
    "stg_merchants": """SELECT 'O' || CAST(o_orderkey AS VARCHAR) AS order_id,
        'MERCHANT' || CAST(suppkey AS VARCHAR) AS merchant_id, 'STAFF' || CAST(o_custkey % 25 AS VARCHAR) AS staff_id
        FROM orders JOIN (SELECT l_orderkey, MIN(l_suppkey) AS suppkey FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""",
    "stg_delays": """SELECT 'O' || CAST(o_orderkey AS VARCHAR) AS order_id,
        CAST(floor(o_totalprice) AS BIGINT) % 10 AS delay_days FROM orders WHERE o_orderstatus = 'F'""",
    "stg_campaign_rows": """SELECT 'O' || CAST(o_orderkey AS VARCHAR) AS order_id, o_orderpriority AS campaign_id,
        CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS availed, CAST(o_orderdate AS DATE) AS transaction_date,
        o_orderkey AS seq FROM orders""",
    # --- dimensions
    "dim_user": f"""SELECT c_custkey + 1 AS user_sk, 'USER' || CAST(c_custkey AS VARCHAR) AS user_id,
        {title('c_name')} AS name, n_name || ' street' AS street, r_name AS city, n_name AS country,
        CASE WHEN c_acctbal < 0 THEN 'Female' ELSE 'Male' END AS gender, {title('c_mktsegment')} AS user_type
        FROM customer JOIN places ON c_nationkey = n_nationkey""",
    "dim_merchant": f"""SELECT s_suppkey + 1 AS merchant_sk, 'MERCHANT' || CAST(s_suppkey AS VARCHAR) AS merchant_id,
        {title('s_name')} AS name, r_name AS city, CAST(NULL AS VARCHAR) AS state, n_name AS country,
        '+10' || CAST(s_suppkey AS VARCHAR) || '55' AS contact_number
        FROM supplier JOIN places ON s_nationkey = n_nationkey""",
    "dim_staff": f"""SELECT n_nationkey + 1 AS staff_sk, 'STAFF' || CAST(n_nationkey AS VARCHAR) AS staff_id,
        {title('n_name')} AS name, r_name AS job_level, CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS state
        FROM places""",
    "dim_product": f"""SELECT p_partkey + 1 AS product_sk, 'PRODUCT' || CAST(p_partkey AS VARCHAR) AS product_id,
        {title('p_name')} AS product_name, {TYPE_GROUP} AS product_type,
        CAST(p_retailprice AS DECIMAL(10,2)) AS price FROM part""",
    "dim_campaign": """SELECT ROW_NUMBER() OVER (ORDER BY campaign_id) AS campaign_sk, * FROM (
        SELECT DISTINCT o_orderpriority AS campaign_id, 'Push ' || o_orderpriority AS campaign_name,
            'Plan for ' || o_orderpriority AS campaign_description,
            CAST(substr(o_orderpriority, 1, 1) || '0' AS DECIMAL(10,2)) AS discount
        FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'
        UNION ALL SELECT 'UNKNOWN', 'Unknown Campaign',
            'Placeholder for orders with missing or late-arriving campaign data', 0)""",
    "dim_date": """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, CAST(d AS DATE) AS date,
        CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, rpad(monthname(d), 9, ' ') AS month_name,
        CAST(day(d) AS INTEGER) AS day, 'Q' || CAST(quarter(d) AS VARCHAR) AS quarter
        FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY) AS t(d)""",
    "dim_user_job": f"""SELECT 'USER' || CAST(c_custkey AS VARCHAR) AS user_id,
        {title('lower(c_mktsegment)')} || ' VP' AS job_title, CASE WHEN c_acctbal < 0 THEN NULL ELSE 'Senior' END AS job_level
        FROM customer""",
    "dim_credit_card": f"""SELECT 'USER' || CAST(c_custkey AS VARCHAR) AS user_id, {title('c_name')} AS name,
        '4000' || CAST(c_custkey AS VARCHAR) AS credit_card_number, {title('lower(c_mktsegment)')} || ' Bank' AS issuing_bank
        FROM customer""",
    # --- facts
    "fact_orders": """SELECT o.order_id, u.user_sk, m.merchant_sk, s.staff_sk, d.date_sk AS transaction_date_sk,
        o.estimated_arrival_days, COALESCE(l.delay_days, 0) AS delay_days
        FROM stg_orders o JOIN stg_merchants om ON om.order_id = o.order_id
        LEFT JOIN stg_delays l ON l.order_id = o.order_id
        JOIN dim_user u ON u.user_id = o.user_id JOIN dim_merchant m ON m.merchant_id = om.merchant_id
        JOIN dim_staff s ON s.staff_id = om.staff_id JOIN dim_date d ON d.date = o.transaction_date""",
    "fact_line_items": """SELECT order_id, product_sk, user_sk, merchant_sk, staff_sk, transaction_date_sk, price, quantity FROM (
        SELECT l.order_id, p.product_sk, o.user_sk, o.merchant_sk, o.staff_sk, o.transaction_date_sk, l.price, l.quantity,
            ROW_NUMBER() OVER (PARTITION BY l.order_id, p.product_sk ORDER BY l.seq) AS rn
        FROM stg_lines l JOIN dim_product p ON p.product_id = l.product_id JOIN fact_orders o ON o.order_id = l.order_id)
        WHERE rn = 1""",
    "fact_campaign_transactions": """SELECT order_id, campaign_sk, user_sk, merchant_sk, transaction_date_sk, availed FROM (
        SELECT c.order_id, COALESCE(k.campaign_sk, (SELECT campaign_sk FROM dim_campaign WHERE campaign_id = 'UNKNOWN')) AS campaign_sk,
            o.user_sk, o.merchant_sk, o.transaction_date_sk, c.availed,
            ROW_NUMBER() OVER (PARTITION BY COALESCE(k.campaign_sk, 0), o.user_sk, o.merchant_sk, o.transaction_date_sk
                ORDER BY c.seq) AS rn
        FROM stg_campaign_rows c LEFT JOIN dim_campaign k ON k.campaign_id = c.campaign_id
        JOIN fact_orders o ON o.order_id = c.order_id) WHERE rn = 1""",
}


def ratio(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)"


# One row per line of an order (one row for an order without lines); every
# view is a set of measures over it, grouped by names.
_CTES["order_lines"] = """SELECT o.*, l.product_sk, l.quantity, l.quantity * p.price AS revenue
    FROM fact_orders o LEFT JOIN fact_line_items l ON l.order_id = o.order_id
    LEFT JOIN dim_product p ON p.product_sk = l.product_sk"""

_MEASURES = {
    "orders": "COUNT(DISTINCT x.order_id)",
    "users": "COUNT(DISTINCT x.user_sk)",
    "merchants": "COUNT(DISTINCT x.merchant_sk)",
    "staff": "COUNT(DISTINCT x.staff_sk)",
    "products": "COUNT(DISTINCT x.product_sk)",
    "late": "COUNT(DISTINCT CASE WHEN x.delay_days > 0 THEN x.order_id END)",
    "items": "SUM(x.quantity)",
    "revenue": "SUM(x.revenue)",
    "per_line": ratio("SUM(x.revenue)", "COUNT(x.revenue)"),
}


def _view(names: str, joins: str, **measures: str) -> str:
    """Names, then measures (known by name, or SQL) over ``order_lines x``."""
    columns = [names, *[f"{_MEASURES.get(m, m)} AS {alias}" for alias, m in measures.items()]]
    return f"SELECT {', '.join(columns)} FROM order_lines x {joins} GROUP BY ALL"


_DAY = "LEFT JOIN dim_date d ON d.date_sk = x.transaction_date_sk"
_USER = "LEFT JOIN dim_user u ON u.user_sk = x.user_sk"
_TAKEN = "COUNT(DISTINCT CASE WHEN t.availed = 1 THEN x.order_id END)"

_VIEWS = {
    "vw_campaign_performance": _view(
        "c.campaign_id, c.campaign_name, c.campaign_description, c.discount",
        "JOIN fact_campaign_transactions t ON t.order_id = x.order_id JOIN dim_campaign c ON c.campaign_sk = t.campaign_sk",
        total_orders="orders",
        unique_customers="users",
        total_quantity_sold="items",
        total_revenue="revenue",
        avg_order_value="per_line",
        orders_with_campaign=_TAKEN,
        campaign_avail_rate_pct=f"ROUND({ratio(_TAKEN, _MEASURES['orders'])} * 100, 2)",
    ),
    "vw_merchant_performance": "SELECT v.* EXCLUDE (merchant_sk), h.avg_delay_days, h.delayed_orders, "
    f"ROUND({ratio('h.delayed_orders', 'v.total_orders')} * 100, 2) AS delay_rate_pct FROM ("
    + _view(
        "x.merchant_sk, m.merchant_id, m.name AS merchant_name, m.city AS merchant_city, m.state AS merchant_state, "
        "m.country AS merchant_country",
        "LEFT JOIN dim_merchant m ON m.merchant_sk = x.merchant_sk",
        total_orders="orders",
        unique_customers="users",
        total_items_sold="items",
        total_revenue="revenue",
        avg_order_value="per_line",
        staff_count="staff",
    )
    + f""") v JOIN (SELECT merchant_sk, {ratio('SUM(delay_days)', 'COUNT(delay_days)')} AS avg_delay_days,
        COUNT(CASE WHEN delay_days > 0 THEN 1 END) AS delayed_orders FROM fact_orders GROUP BY merchant_sk) h
        ON h.merchant_sk = v.merchant_sk""",
    "vw_customer_segment_revenue": _view(
        "u.user_type AS customer_segment, u.country AS customer_country, u.city AS customer_city",
        f"{_USER} {_DAY}",
        total_orders="orders",
        unique_customers="users",
        total_items_purchased="items",
        total_revenue="revenue",
        avg_order_value="per_line",
        first_order_date="MIN(d.date)",
        last_order_date="MAX(d.date)",
        merchants_purchased_from="merchants",
        unique_products_purchased="products",
    ),
    "vw_segment_revenue_by_time": _view(
        "d.date, d.year, d.month, d.month_name, d.quarter, u.user_type AS customer_segment",
        f"{_USER} {_DAY}",
        total_orders="orders",
        unique_customers="users",
        total_items_sold="items",
        total_revenue="revenue",
        avg_order_value="per_line",
    ),
    "vw_sales_by_time": _view(
        "d.date, d.year, d.month, d.month_name, d.quarter, d.day",
        _DAY,
        total_orders="orders",
        unique_customers="users",
        total_items_sold="items",
        total_revenue="revenue",
        avg_order_value="per_line",
        delayed_orders="late",
        avg_delay_days=ratio("SUM(x.delay_days)", "COUNT(x.delay_days)"),
    ),
    "vw_product_performance": _view(
        "p.product_id, p.product_name, p.product_type, p.price",
        "JOIN dim_product p ON p.product_sk = x.product_sk",
        total_orders="orders",
        unique_customers="users",
        total_quantity_sold="items",
        total_revenue="revenue",
        avg_quantity_per_order=ratio("SUM(x.quantity)", "COUNT(x.quantity)"),
        merchants_selling="merchants",
    ),
    "vw_staff_performance": _view(
        "s.staff_id, s.name AS staff_name, s.job_level AS staff_job_level, s.city AS staff_city, s.state AS staff_state",
        "LEFT JOIN dim_staff s ON s.staff_sk = x.staff_sk",
        total_orders_processed="orders",
        unique_customers_served="users",
        total_items_processed="items",
        total_revenue_generated="revenue",
        avg_order_value="per_line",
        merchants_worked_with="merchants",
    ),
}
_ALL = {**_CTES, **_VIEWS}


def with_star(select: str, extra: dict[str, str] | None = None) -> str:
    """``select`` after a WITH clause of the star tables and views it uses."""
    defs = {**_ALL, **(extra or {})}
    used: set[str] = set()

    def visit(text: str) -> None:
        for name in defs:
            if name in text and name not in used and _mentions(text, name):
                used.add(name)
                visit(defs[name])

    visit(select)
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in defs.items() if name in used)
    return f"WITH {ctes}\n{select}" if ctes else select


def _mentions(text: str, name: str) -> bool:
    at = text.find(name)
    while at >= 0:
        after = text[at + len(name) : at + len(name) + 1]
        before = text[at - 1 : at] if at else ""
        if not (after.isalnum() or after == "_") and not (before.isalnum() or before in "_."):
            return True
        at = text.find(name, at + 1)
    return False
