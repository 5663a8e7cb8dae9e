"""Dimension and fact loads, rejects, surrogate keys, staging formatters.

Surrogate keys differ between engines, so results are shown by business key.
Where a load needs rows that fail, the dimensions leave out members by a
natural property (a segment, a region, a year) - never by thinning out ids.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tallyhouse import schemas
from tallyhouse.catalog.base import Query
from tallyhouse.catalog.star_sql import MESSY_TYPE, squeeze, title, with_star
from tallyhouse.operators import dimensions as dims
from tallyhouse.operators import facts, keys, staging
from tallyhouse.plans import sample_star
from tallyhouse.plans.sample_star import table
from tallyhouse.session import materialize

# --- dimensions ------------------------------------------------------------------


def _product_batch(spark, sf_dir) -> DataFrame:
    """Every part, and the large ones a second time at twice the price."""
    part = table(spark, sf_dir, "part")
    row = part.select(
        F.concat(F.lit("PRODUCT"), F.col("p_partkey").cast("string")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_type"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        F.col("p_partkey").alias("ingest_seq"),
        "p_size",
    )
    again = row.filter(F.col("p_size") > 25).withColumns(
        {
            "price": (F.col("price") * 2).cast("decimal(10,2)"),
            "ingest_seq": F.col("ingest_seq") + F.lit(1 << 40),
        }
    )
    return row.unionByName(again).drop("p_size")


def _known_products(spark, sf_dir) -> DataFrame:
    first = table(spark, sf_dir, "part").filter(F.col("p_type") != "PROMO")
    batch = first.select(
        F.concat(F.lit("PRODUCT"), F.col("p_partkey").cast("string")).alias("product_id"),
        F.lit("old").alias("product_name"),
        F.col("p_partkey").alias("ingest_seq"),
    )
    return dims.upsert_dimension("dim_product", dims.empty_table(spark, "dim_product"), batch)


def _same_key(after: DataFrame, before: DataFrame, key: str, sk: str) -> DataFrame:
    """Mark members that kept the surrogate key they had before."""
    had = before.select(F.col(key).alias("__k"), F.col(sk).alias("__s"))
    return after.join(had, F.col(key) == F.col("__k"), "left").withColumn(
        "kept_key", F.coalesce(F.col("__s") == F.col(sk), F.lit(False))
    )


def scd1_upsert(spark, sf_dir):
    before = _known_products(spark, sf_dir)
    after = dims.upsert_dimension("dim_product", before, _product_batch(spark, sf_dir))
    return _same_key(after, before, "product_id", "product_sk")


def set_based_dims(spark, sf_dir):
    """Two sources of the same dimension; the second overrules the first."""
    batch = _product_batch(spark, sf_dir)
    old = batch.withColumn("product_name", F.lit("superseded"))
    current = dims.empty_table(spark, "dim_product")
    return dims.load_dimension_set_based("dim_product", current, [old, batch])


_PRODUCT_AFTER = """SELECT 'PRODUCT' || CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
    p_type AS product_type,
    CAST(p_retailprice AS DECIMAL(10,2)) * (CASE WHEN p_size > 25 THEN 2 ELSE 1 END) AS price"""


def surrogate_key(spark, sf_dir):
    """Keys are 1..n without gaps, whatever engine counts."""
    ids = table(spark, sf_dir, "customer").select(F.concat(F.lit("USER"), F.col("c_custkey").cast("string")).alias("user_id"))
    first = keys.with_surrogate_key(ids.filter(F.col("user_id") < "USER5"), "user_id", "user_sk")
    rest = keys.with_surrogate_key(ids.filter(F.col("user_id") >= "USER5"), "user_id", "user_sk", first)
    return first.unionByName(rest).agg(
        F.count("*").alias("members"),
        F.count_distinct("user_sk").alias("distinct_keys"),
        F.min("user_sk").alias("lowest"),
        F.max("user_sk").alias("highest"),
    )


def unknown_member(spark, sf_dir):
    feed = sample_star.transformed(spark, sf_dir)["campaign_data"]
    dim = dims.upsert_dimension("dim_campaign", dims.empty_table(spark, "dim_campaign"), feed)
    return dims.ensure_unknown_campaign(dims.ensure_unknown_campaign(dim))


def late_users(spark, sf_dir):
    """Only the users of one market are loaded; orders bring the others."""
    feed = sample_star.transformed(spark, sf_dir)
    known = dims.upsert_dimension(
        "dim_user", dims.empty_table(spark, "dim_user"), feed["user_data"].filter(F.col("user_type") == "Building")
    )
    return dims.stub_users(known, feed["order_data"])


def late_products(spark, sf_dir):
    feed = sample_star.transformed(spark, sf_dir)
    known = dims.upsert_dimension(
        "dim_product",
        dims.empty_table(spark, "dim_product"),
        feed["product_list"].filter(F.col("product_type") == "Grocery"),
    )
    names = feed["product_list"].select("product_id", F.col("product_name"))
    lines = feed["line_item_data_products"].join(names, "product_id", "left")
    return dims.stub_products(known, lines)


def outrigger(dedup: bool):
    def run(spark, sf_dir):
        feed = sample_star.transformed(spark, sf_dir)["user_job"]
        once = dims.append_outrigger("dim_user_job", dims.empty_table(spark, "dim_user_job"), feed, dedup)
        twice = dims.append_outrigger("dim_user_job", once, feed, dedup)
        return twice.groupBy("user_id", "job_title", "job_level").agg(
            F.count("*").alias("copies"), F.count_distinct("user_job_sk").alias("keys")
        )

    return run


def update_product_type(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        F.concat(F.lit("PRODUCT"), F.col("p_partkey").cast("string")).alias("product_id"),
        sample_star.messy_type(F.col("p_type")).alias("product_type"),
    )
    return dims.regroup_product_types(part)


def build_dim_date(spark, sf_dir):
    """Calendar of the days the orders span, built twice: the second adds none."""
    span = table(spark, sf_dir, "orders").agg(
        F.min(F.to_date("o_orderdate")).alias("a"), F.max(F.to_date("o_orderdate")).alias("b")
    )
    days = span.select(F.explode(F.expr("sequence(a, b, interval 1 day)")).alias("date"))
    calendar = dims.calendar_columns(days)
    return dims.extend_calendar(calendar, calendar)


# --- facts -----------------------------------------------------------------------


def _thin_dims(spark, sf_dir) -> dict[str, DataFrame]:
    """The star's dimensions without some members, so that rows are rejected."""
    star = sample_star.star(spark, sf_dir)
    return {
        "dim_user": star["dim_user"].filter(F.col("user_type") != "Machinery"),
        "dim_merchant": star["dim_merchant"].filter(F.col("city") != "ASIA"),
        "dim_staff": star["dim_staff"].filter(F.col("job_level") != "EUROPE"),
        "dim_date": star["dim_date"].filter(F.col("year") < 2001),
    }


def _dated_orders(spark, sf_dir) -> DataFrame:
    """Open orders come without a date."""
    feed = sample_star.transformed(spark, sf_dir)["order_data"]
    pending = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("order_id"),
        (F.col("o_orderstatus") == "P").alias("pending"),
    )
    return feed.join(pending, "order_id").withColumn(
        "transaction_date", F.when(~F.col("pending"), F.col("transaction_date"))
    ).drop("pending")


def _orders_load(spark, sf_dir) -> facts.Load:
    feed = sample_star.transformed(spark, sf_dir)
    return facts.load_orders(
        dims.empty_table(spark, "fact_orders"),
        _dated_orders(spark, sf_dir),
        feed["order_with_merchant_data"],
        feed["order_delays"],
        _thin_dims(spark, sf_dir),
    )


def _orders_by_name(fact: DataFrame, star) -> DataFrame:
    return (
        fact.join(star["dim_user"].select("user_sk", "user_id"), "user_sk")
        .join(star["dim_merchant"].select("merchant_sk", "merchant_id"), "merchant_sk")
        .join(star["dim_staff"].select("staff_sk", "staff_id"), "staff_sk")
    )


def load_fact_orders(spark, sf_dir):
    return _orders_by_name(_orders_load(spark, sf_dir).table, sample_star.star(spark, sf_dir))


def reject_split(spark, sf_dir):
    return _orders_load(spark, sf_dir).rejects


def sink_reject(spark, sf_dir):
    """The row copy holds every member, those without a value too."""
    return _orders_load(spark, sf_dir).rejects.select(
        "order_id",
        "error_reason",
        F.get_json_object("raw_data", "$.user_id").alias("raw_user"),
        F.get_json_object("raw_data", "$.transaction_date").alias("raw_date"),
        F.col("raw_data").contains('"payment_method":null').alias("nulls_kept"),
        F.col("rejected_at").isNotNull().alias("dated"),
    )


_THIN = {
    "thin_user": "SELECT * FROM dim_user WHERE user_type <> 'Machinery'",
    "thin_merchant": "SELECT * FROM dim_merchant WHERE city <> 'ASIA'",
    "thin_staff": "SELECT * FROM dim_staff WHERE job_level <> 'EUROPE'",
    "thin_date": "SELECT * FROM dim_date WHERE year < 2001",
    "dated_orders": """SELECT s.order_id, s.user_id, s.estimated_arrival_days,
        CASE WHEN o.o_orderstatus <> 'P' THEN s.transaction_date END AS transaction_date
        FROM stg_orders s JOIN orders o ON s.seq = o.o_orderkey""",
    "judged": """SELECT o.order_id, o.user_id, m.merchant_id, m.staff_id, o.transaction_date, o.estimated_arrival_days,
        COALESCE(l.delay_days, 0) AS delay_days, d.date_sk,
        CASE WHEN u.user_sk IS NULL THEN 'user_id ''' || o.user_id || ''' not found in dim_user'
            WHEN tm.merchant_sk IS NULL THEN 'merchant_id ''' || m.merchant_id || ''' not found in dim_merchant'
            WHEN ts.staff_sk IS NULL THEN 'staff_id ''' || m.staff_id || ''' not found in dim_staff'
            WHEN o.transaction_date IS NULL THEN 'null transaction_date'
            WHEN d.date_sk IS NULL THEN 'date ''' || CAST(o.transaction_date AS VARCHAR) || ''' not found in dim_date'
            END AS reason
        FROM dated_orders o JOIN stg_merchants m ON m.order_id = o.order_id
        LEFT JOIN stg_delays l ON l.order_id = o.order_id
        LEFT JOIN thin_user u ON u.user_id = o.user_id LEFT JOIN thin_merchant tm ON tm.merchant_id = m.merchant_id
        LEFT JOIN thin_staff ts ON ts.staff_id = m.staff_id LEFT JOIN thin_date d ON d.date = o.transaction_date""",
}


def load_fact_orders_legacy(spark, sf_dir):
    feed = sample_star.transformed(spark, sf_dir)
    return _orders_by_name(
        facts.load_orders_set_based(
            dims.empty_table(spark, "fact_orders"),
            _dated_orders(spark, sf_dir),
            feed["order_with_merchant_data"],
            feed["order_delays"],
            _thin_dims(spark, sf_dir),
        ),
        sample_star.star(spark, sf_dir),
    )


def _known_orders(star) -> DataFrame:
    """Orders of merchants outside Asia: lines of the others are rejected."""
    outside = star["dim_merchant"].filter(F.col("city") != "ASIA").select("merchant_sk")
    return star["fact_orders"].join(outside, "merchant_sk", "left_semi").select(*star["fact_orders"].columns)


def _known_dim_products(star) -> DataFrame:
    return star["dim_product"].filter(F.col("product_type") != "Grocery")


def _line_products(spark, sf_dir) -> DataFrame:
    """Lines of one file come without a product."""
    feed = sample_star.transformed(spark, sf_dir)["line_item_data_products"]
    return feed.withColumn("product_id", F.when(F.col("file_source") != "lines-R.csv", F.col("product_id")))


def _lines_load(spark, sf_dir, pairing: str) -> facts.Load:
    star = sample_star.star(spark, sf_dir)
    return facts.load_line_items(
        dims.empty_table(spark, "fact_line_items"),
        sample_star.transformed(spark, sf_dir)["line_item_data_prices"],
        _line_products(spark, sf_dir),
        _known_dim_products(star),
        _known_orders(star),
        pairing,
    )


def _lines_by_name(fact: DataFrame, star) -> DataFrame:
    return fact.join(star["dim_product"].select("product_sk", "product_id"), "product_sk").join(
        star["dim_merchant"].select("merchant_sk", "merchant_id"), "merchant_sk"
    )


def load_fact_line_items(spark, sf_dir):
    return _lines_by_name(_lines_load(spark, sf_dir, "position").table, sample_star.star(spark, sf_dir))


def line_item_rejects(spark, sf_dir):
    return (
        _lines_load(spark, sf_dir, "order")
        .rejects.groupBy("order_id", "product_id", "error_reason", "source_file")
        .agg(F.count("*").alias("rows"))
    )


def load_fact_line_items_legacy(spark, sf_dir):
    star = sample_star.star(spark, sf_dir)
    return _lines_by_name(
        facts.load_line_items_set_based(
            dims.empty_table(spark, "fact_line_items"),
            sample_star.transformed(spark, sf_dir)["line_item_data_prices"],
            _line_products(spark, sf_dir),
            _known_dim_products(star),
            _known_orders(star),
            stage=materialize,
        ),
        star,
    )


_LINES = {
    "known_orders": """SELECT o.*, m.merchant_id FROM fact_orders o JOIN dim_merchant m ON m.merchant_sk = o.merchant_sk
        WHERE m.city <> 'ASIA'""",
    "known_products": "SELECT * FROM dim_product WHERE product_type <> 'Grocery'",
    "judged_lines": """SELECT l.order_id, CASE WHEN l.file_source <> 'lines-R.csv' THEN l.product_id END AS product_id,
        l.price, l.quantity, l.seq, l.file_source, o.merchant_id, o.transaction_date_sk,
        CASE WHEN l.file_source = 'lines-R.csv' THEN 'product_id is NULL'
            WHEN p.product_sk IS NULL THEN 'product_id ''' || l.product_id || ''' not found in dim_product'
            WHEN o.order_id IS NULL THEN 'order_id ''' || l.order_id || ''' not found in fact_orders' END AS reason
        FROM stg_lines l LEFT JOIN known_products p ON p.product_id = l.product_id
        LEFT JOIN known_orders o ON o.order_id = l.order_id""",
    "first_lines": """SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id, product_id ORDER BY seq) AS rn
        FROM judged_lines WHERE reason IS NULL) WHERE rn = 1""",
    # within an order the n-th product meets the n-th price: lines without a product are gone before that
    "numbered_products": """SELECT order_id, product_id, seq, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY seq) AS rn
        FROM stg_lines WHERE file_source <> 'lines-R.csv'""",
    "numbered_prices": """SELECT order_id, price, quantity, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY seq) AS rn
        FROM stg_lines""",
    "old_lines": """SELECT * FROM (SELECT a.order_id, a.product_id, b.price, b.quantity, o.merchant_id, o.transaction_date_sk,
        ROW_NUMBER() OVER (PARTITION BY a.order_id, a.product_id ORDER BY a.seq) AS first_rn
        FROM numbered_products a JOIN numbered_prices b ON a.order_id = b.order_id AND a.rn = b.rn
        JOIN known_products p ON p.product_id = a.product_id JOIN known_orders o ON o.order_id = a.order_id)
        WHERE first_rn = 1""",
}


def _campaign_load(spark, sf_dir) -> facts.Load:
    star = sample_star.star(spark, sf_dir)
    return facts.load_campaign_transactions(
        dims.empty_table(spark, "fact_campaign_transactions"),
        sample_star.transformed(spark, sf_dir)["transactional_campaign_data"],
        star["dim_campaign"].filter(F.col("campaign_id") != "2-HIGH"),
        _known_orders(star),
    )


def _campaigns_by_name(fact: DataFrame, star) -> DataFrame:
    return fact.join(star["dim_campaign"].select("campaign_sk", "campaign_id"), "campaign_sk")


def load_fact_campaign_txn(spark, sf_dir):
    return _campaigns_by_name(_campaign_load(spark, sf_dir).table, sample_star.star(spark, sf_dir))


def campaign_rejects(spark, sf_dir):
    return _campaign_load(spark, sf_dir).rejects


def load_fact_campaign_txn_legacy(spark, sf_dir):
    """Late shipments move the transaction to another day: those rows vanish."""
    star = sample_star.star(spark, sf_dir)
    raw = sample_star.feeds(spark, sf_dir)["transactional_campaign_data"]
    dated = raw.withColumns(
        {
            "availed": F.when(F.col("availed") == "Yes", 1).when(F.col("availed") == "no", 0).cast("int"),
            "transaction_date": F.when(
                F.col("campaign_id") == "1-URGENT", F.date_add("transaction_date", 1)
            ).otherwise(F.col("transaction_date")),
        }
    )
    fact = facts.load_campaign_transactions_set_based(
        dims.empty_table(spark, "fact_campaign_transactions"),
        dated,
        star["dim_campaign"],
        star["dim_date"],
        _known_orders(star),
    )
    return _campaigns_by_name(fact, star)


_CAMPAIGNS = {
    "known_orders": _LINES["known_orders"],
    "known_campaigns": "SELECT * FROM dim_campaign WHERE campaign_id <> '2-HIGH'",
    "campaign_rows": """SELECT c.order_id, COALESCE(k.campaign_id, 'UNKNOWN') AS campaign_id, c.availed, c.seq,
        o.user_sk, o.merchant_sk, o.transaction_date_sk, c.campaign_id AS asked, o.order_id IS NULL AS lost
        FROM stg_campaign_rows c LEFT JOIN known_campaigns k ON k.campaign_id = c.campaign_id
        LEFT JOIN known_orders o ON o.order_id = c.order_id""",
}


def late_campaign_rekey(spark, sf_dir):
    """Load while two campaigns are missing, let them arrive, move the rows."""
    star = sample_star.star(spark, sf_dir)
    feed = sample_star.transformed(spark, sf_dir)["transactional_campaign_data"]
    early = star["dim_campaign"].filter(~F.col("campaign_id").isin("2-HIGH", "3-MEDIUM"))
    fact = facts.load_campaign_transactions(
        dims.empty_table(spark, "fact_campaign_transactions"), feed, early, star["fact_orders"]
    ).table
    fact = materialize(fact, "early_campaign_rows")  # read three times below
    moved, _ = facts.rekey_late_campaigns(fact, star["dim_campaign"], feed)
    return _campaigns_by_name(moved, star)


# --- mutation primitives -----------------------------------------------------------


def insert_ignore(spark, sf_dir):
    """Lines of one file are there already; all lines are offered."""
    lines = sample_star.staging(spark, sf_dir)["line_item_data_products"].select("order_id", "product_id", "ingest_seq", "file_source")
    prices = sample_star.staging(spark, sf_dir)["line_item_data_prices"].select("ingest_seq", "price", "quantity")
    offered = lines.join(prices, "ingest_seq")
    columns = ["order_id", "product_id", "price", "quantity"]
    pair = ["order_id", "product_id"]
    current = keys.first_per_key(
        offered.filter(F.col("file_source") == "lines-R.csv").select(*columns, "ingest_seq"), pair
    ).select(*columns)
    fresh = facts.insert_or_ignore(current, offered.select(*columns, "ingest_seq"), pair)
    return current.unionByName(fresh)


def upsert_partial(spark, sf_dir):
    """Shipped orders are known; every line offers new values for its order."""
    current = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F").select(
        F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("order_id"),
        (F.col("o_custkey") + 1).alias("user_sk"),
        F.lit(1).cast("bigint").alias("merchant_sk"),
        F.lit(1).cast("bigint").alias("staff_sk"),
        F.lit(19950101).alias("transaction_date_sk"),
        F.lit(None).cast("int").alias("estimated_arrival_days"),
        F.lit(0).alias("delay_days"),
    )
    lines = sample_star.staged_lines(spark, sf_dir)
    number = F.substring("product_id", 8, 18).cast("bigint") + 1
    offered = lines.select(
        "order_id",
        number.alias("user_sk"),
        number.alias("merchant_sk"),
        F.lit(2).cast("bigint").alias("staff_sk"),
        F.lit(19960101).alias("transaction_date_sk"),
        F.regexp_extract("quantity", r"(\d+)", 1).cast("int").alias("estimated_arrival_days"),
        number.cast("int").alias("delay_days"),
        F.col("ingest_seq").alias("__seq"),
    )
    return facts.upsert_orders(current, offered)


# --- staging and transform formatters ------------------------------------------------

_FORMAT_COLUMNS = {
    "campaign_data": "campaign_id:s campaign_name:s campaign_description:s discount:d",
    "transactional_campaign_data": "transaction_id:s user_id:s campaign_id:s order_id:s availed:i",
    "order_data": "order_id:s user_id:s transaction_date:s payment_method:s total_amount:d estimated_arrival_days:i staff_id:s",
    "line_item_data_prices": "line_item_id:s order_id:s quantity:i discount:d price:d",
    "line_item_data_products": "order_id:s product_id:s",
    "order_delays": "order_id:s delay_days:i",
    "product_list": "product_id:s product_name:s product_type:s price:d",
    "user_data": "user_id:s name:s street:s state:s city:s country:s birthdate:s gender:s device_address:s user_type:s creation_date:s",
    "user_job": "user_id:s job_title:s job_level:s",
    "user_credit_card": "user_id:s name:s credit_card_number:s issuing_bank:s",
    "merchant_data": "merchant_id:s name:s street:s state:s city:s country:s contact_number:s creation_date:s",
    "staff_data": "staff_id:s name:s street:s state:s city:s country:s job_level:s contact_number:s creation_date:s",
    "order_with_merchant_data": "order_id:s merchant_id:s staff_id:s",
}
_FORMAT_SQL = {
    "campaign_data": "SELECT * FROM dim_campaign WHERE campaign_id <> 'UNKNOWN'",
    "transactional_campaign_data": "SELECT NULL AS transaction_id, NULL AS user_id, * FROM stg_campaign_rows",
    "order_data": "SELECT *, NULL AS payment_method, NULL AS total_amount, NULL AS staff_id FROM stg_orders",
    "line_item_data_prices": "SELECT NULL AS line_item_id, NULL AS discount, * FROM stg_lines",
    "line_item_data_products": "SELECT * FROM stg_lines",
    "order_delays": "SELECT * FROM stg_delays",
    "product_list": "SELECT * FROM dim_product",
    "user_data": "SELECT *, NULL AS state, NULL AS birthdate, NULL AS device_address, NULL AS creation_date FROM dim_user",
    "user_job": "SELECT * FROM dim_user_job",
    "user_credit_card": "SELECT * FROM dim_credit_card",
    "merchant_data": "SELECT *, NULL AS street, NULL AS creation_date FROM dim_merchant",
    "staff_data": """SELECT staff_id, name, NULL AS street, NULL AS state, NULL AS city, NULL AS country, job_level,
        NULL AS contact_number, NULL AS creation_date FROM dim_staff""",
    "order_with_merchant_data": "SELECT * FROM stg_merchants",
}


def _stage(dataset: str):
    return lambda spark, sf_dir: sample_star.staging(spark, sf_dir)[dataset]


def _transform(dataset: str):
    return lambda spark, sf_dir: sample_star.transformed(spark, sf_dir)[dataset]


_ORDER_COLUMNS = "order_id:s user_id:s merchant_id:s staff_id:s transaction_date_sk:i estimated_arrival_days:i delay_days:i"
_LINE_COLUMNS = "order_id:s product_id:s merchant_id:s transaction_date_sk:i price:d quantity:i"

QUERIES = [
    Query(
        "scd1_upsert",
        scd1_upsert,
        "product_id:s product_name:s product_type:s price:d kept_key:b",
        f"{_PRODUCT_AFTER}, p_type <> 'PROMO' AS kept_key FROM part",
    ),
    Query(
        "load_dims_set_based",
        set_based_dims,
        "product_id:s product_name:s product_type:s price:d",
        f"{_PRODUCT_AFTER} FROM part",
    ),
    Query(
        "surrogate_key",
        surrogate_key,
        "members:i distinct_keys:i lowest:i highest:i",
        "SELECT COUNT(*) AS members, COUNT(*) AS distinct_keys, 1 AS lowest, COUNT(*) AS highest FROM customer",
    ),
    Query(
        "unknown_member",
        unknown_member,
        "campaign_id:s campaign_name:s campaign_description:s discount:d",
        with_star("SELECT * FROM dim_campaign"),
    ),
    Query(
        "late_dim_users",
        late_users,
        "user_id:s name:s city:s country:s user_type:s",
        with_star(
            """SELECT user_id, name, city, country, user_type FROM dim_user WHERE user_type = 'Building'
            UNION ALL SELECT DISTINCT user_id, NULL, NULL, NULL, NULL FROM stg_orders
            WHERE user_id NOT IN (SELECT user_id FROM dim_user WHERE user_type = 'Building')"""
        ),
    ),
    Query(
        "late_dim_products",
        late_products,
        "product_id:s product_name:s product_type:s price:d",
        with_star(
            """SELECT product_id, product_name, product_type, price FROM dim_product WHERE product_type = 'Grocery'
            UNION ALL SELECT DISTINCT l.product_id, p.product_name, NULL, CAST(NULL AS DECIMAL(10,2))
            FROM stg_lines l JOIN dim_product p ON p.product_id = l.product_id WHERE p.product_type <> 'Grocery'"""
        ),
    ),
    Query(
        "append_outrigger",
        outrigger(True),
        "user_id:s job_title:s job_level:s copies:i keys:i",
        with_star("SELECT *, 1 AS copies, 1 AS keys FROM dim_user_job"),
    ),
    Query(
        "append_outrigger_every_run",
        outrigger(False),
        "user_id:s job_title:s job_level:s copies:i keys:i",
        with_star("SELECT *, 2 AS copies, 2 AS keys FROM dim_user_job"),
    ),
    Query(
        "update_product_type",
        update_product_type,
        "product_id:s product_type:s",
        f"""SELECT 'PRODUCT' || CAST(p_partkey AS VARCHAR) AS product_id,
        CASE WHEN p_type = 'SMALL' THEN 'Toys And Entertainment' WHEN p_type = 'PROMO' THEN 'Grocery'
            ELSE {MESSY_TYPE} END AS product_type FROM part""",
    ),
    Query(
        "build_dim_date",
        build_dim_date,
        "date_sk:i date:s year:i month:i month_name:s day:i quarter:s",
        with_star(
            """SELECT * FROM dim_date WHERE date BETWEEN (SELECT MIN(CAST(o_orderdate AS DATE)) FROM orders)
            AND (SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders)"""
        ),
    ),
    Query(
        "load_fact_orders",
        load_fact_orders,
        _ORDER_COLUMNS,
        with_star(
            """SELECT order_id, user_id, merchant_id, staff_id, date_sk AS transaction_date_sk, estimated_arrival_days,
            delay_days FROM judged WHERE reason IS NULL""",
            _THIN,
        ),
    ),
    Query(
        "load_fact_orders_legacy",
        load_fact_orders_legacy,
        _ORDER_COLUMNS,
        with_star(
            """SELECT j.order_id, j.user_id, j.merchant_id, j.staff_id, j.date_sk AS transaction_date_sk,
            j.estimated_arrival_days, d.delay_days FROM judged j LEFT JOIN stg_delays d ON d.order_id = j.order_id
            WHERE reason IS NULL""",
            _THIN,
        ),
    ),
    Query(
        "reject_split",
        reject_split,
        "order_id:s user_id:s merchant_id:s staff_id:s transaction_date:s error_reason:s",
        with_star("SELECT *, reason AS error_reason FROM judged WHERE reason IS NOT NULL", _THIN),
    ),
    Query(
        "sink_reject",
        sink_reject,
        "order_id:s error_reason:s raw_user:s raw_date:s nulls_kept:b dated:b",
        with_star(
            """SELECT order_id, reason AS error_reason, user_id AS raw_user, CAST(transaction_date AS VARCHAR) AS raw_date,
            TRUE AS nulls_kept, TRUE AS dated FROM judged WHERE reason IS NOT NULL""",
            _THIN,
        ),
    ),
    Query(
        "load_fact_line_items",
        load_fact_line_items,
        _LINE_COLUMNS,
        with_star("SELECT * FROM first_lines", _LINES),
    ),
    Query(
        "load_fact_line_items_rejects",
        line_item_rejects,
        "order_id:s product_id:s error_reason:s source_file:s rows:i",
        with_star(
            """SELECT order_id, product_id, reason AS error_reason, file_source AS source_file, COUNT(*) AS rows
            FROM judged_lines WHERE reason IS NOT NULL GROUP BY ALL""",
            _LINES,
        ),
    ),
    Query(
        "load_fact_line_items_legacy",
        load_fact_line_items_legacy,
        _LINE_COLUMNS,
        with_star("SELECT * FROM old_lines", _LINES),
    ),
    Query(
        "load_fact_campaign_txn",
        load_fact_campaign_txn,
        "order_id:s campaign_id:s transaction_date_sk:i availed:i",
        with_star(
            """SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY campaign_id, user_sk, merchant_sk,
            transaction_date_sk ORDER BY seq) AS rn FROM campaign_rows WHERE NOT lost) WHERE rn = 1""",
            _CAMPAIGNS,
        ),
    ),
    Query(
        "load_fact_campaign_txn_rejects",
        campaign_rejects,
        "order_id:s campaign_id:s error_reason:s",
        with_star(
            """SELECT order_id, asked AS campaign_id, 'order_id ''' || order_id || ''' not found in fact_orders'
            AS error_reason FROM campaign_rows WHERE lost""",
            _CAMPAIGNS,
        ),
    ),
    Query(
        "load_fact_campaign_txn_legacy",
        load_fact_campaign_txn_legacy,
        "order_id:s campaign_id:s transaction_date_sk:i availed:i",
        with_star(
            """SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY asked, user_sk, merchant_sk,
            transaction_date_sk ORDER BY seq) AS rn FROM campaign_rows WHERE NOT lost
            AND asked NOT IN ('1-URGENT', '4-NOT SPECIFIED')) WHERE rn = 1""".replace(
                "SELECT * FROM (SELECT *,",
                "SELECT order_id, asked AS campaign_id, transaction_date_sk, availed FROM (SELECT *,",
            ),
            _CAMPAIGNS,
        ),
    ),
    Query(
        "late_campaign_rekey",
        late_campaign_rekey,
        "order_id:s campaign_id:s transaction_date_sk:i availed:i",
        with_star(
            """SELECT order_id, CASE WHEN campaign_id = 'UNKNOWN' AND asked IN ('2-HIGH', '3-MEDIUM') AND turn = 1
                THEN asked ELSE campaign_id END AS campaign_id, transaction_date_sk, availed
            FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY asked, user_sk, merchant_sk, transaction_date_sk
                ORDER BY order_id) AS turn FROM early WHERE rn = 1)""",
            {
                "early": """SELECT *, ROW_NUMBER() OVER (PARTITION BY campaign_id, user_sk, merchant_sk,
                    transaction_date_sk ORDER BY seq) AS rn FROM (
                    SELECT c.order_id, CASE WHEN c.campaign_id IN ('1-URGENT', '5-LOW') THEN c.campaign_id ELSE 'UNKNOWN' END
                        AS campaign_id, c.campaign_id AS asked, c.availed, c.seq, o.user_sk, o.merchant_sk, o.transaction_date_sk
                    FROM stg_campaign_rows c JOIN fact_orders o ON o.order_id = c.order_id)"""
            },
        ),
    ),
    Query(
        "insert_ignore",
        insert_ignore,
        "order_id:s product_id:s price:d quantity:i",
        with_star(
            """SELECT order_id, product_id, price, quantity FROM (SELECT *, ROW_NUMBER() OVER (
            PARTITION BY order_id, product_id ORDER BY CASE WHEN file_source = 'lines-R.csv' THEN 0 ELSE 1 END, seq) AS rn
            FROM stg_lines) WHERE rn = 1"""
        ),
    ),
    Query(
        "upsert_partial",
        upsert_partial,
        "order_id:s user_sk:i merchant_sk:i staff_sk:i transaction_date_sk:i estimated_arrival_days:i delay_days:i",
        with_star(
            """SELECT COALESCE(c.order_id, b.order_id) AS order_id, COALESCE(c.user_sk, b.first_number) AS user_sk,
            CASE WHEN c.order_id IS NULL THEN b.first_number ELSE 1 END AS merchant_sk,
            CASE WHEN c.order_id IS NULL THEN 2 ELSE 1 END AS staff_sk,
            CASE WHEN c.order_id IS NULL THEN 19960101 ELSE 19950101 END AS transaction_date_sk,
            b.last_quantity AS estimated_arrival_days,
            CASE WHEN b.order_id IS NULL THEN 0 ELSE b.last_number END AS delay_days
            FROM (SELECT 'O' || CAST(o_orderkey AS VARCHAR) AS order_id, o_custkey + 1 AS user_sk FROM orders
                WHERE o_orderstatus = 'F') c
            FULL JOIN (SELECT order_id, arg_min(CAST(substr(product_id, 8) AS BIGINT) + 1, seq) AS first_number,
                arg_max(CAST(substr(product_id, 8) AS BIGINT) + 1, seq) AS last_number,
                arg_max(quantity, seq) AS last_quantity FROM stg_lines GROUP BY order_id) b ON b.order_id = c.order_id"""
        ),
    ),
    *[
        Query(f"stage_{d}", _stage(d), _FORMAT_COLUMNS[d], with_star(_FORMAT_SQL[d]))
        for d in schemas.STAGING
    ],
    *[
        Query(f"transform_{d}", _transform(d), _FORMAT_COLUMNS[d], with_star(_FORMAT_SQL[d]))
        for d in schemas.STAGING
        if d != "order_with_merchant_data"
    ],
]
