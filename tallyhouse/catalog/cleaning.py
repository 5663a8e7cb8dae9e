"""Cleaning steps and formatters one by one, on text made from the tables.

The text of a formatter query is one SQL expression that both engines run; the
expected value is derived from the parts the text was put together from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhouse import functions as fx
from tallyhouse.catalog.base import Query
from tallyhouse.catalog.star_sql import MESSY_TYPE, TYPE_GROUP, title, with_star
from tallyhouse.operators import staging
from tallyhouse.plans import sample_star
from tallyhouse.plans.sample_star import table
from tallyhouse.plans.views import percent, ratio


def formatter(name: str, source: str, key: str, text: str, fn, code: str, expected: str) -> Query:
    """``fn`` over ``text`` on every row of ``source``."""

    def run(spark, sf_dir):
        return table(spark, sf_dir, source).select(key, F.expr(text).alias("text")).select(
            key, fn(F.col("text")).alias("value")
        )

    return Query(name, run, f"{key}:i value:{code}", f"SELECT {key}, {expected} AS value FROM {source}")


_SEG = "concat(upper(substr(c_mktsegment, 1, 1)), lower(substr(c_mktsegment, 2)))"
# a word that starts with "mac" gets a capital after it
_MAC = f"CASE c_mktsegment WHEN 'MACHINERY' THEN 'MaChinery' ELSE {_SEG} END"
_NATION = "concat('Nation_', c_nationkey)"

FORMATTERS = [
    formatter(
        "fn_extract_numeric",
        "orders",
        "o_orderkey",
        """CASE o_orderstatus WHEN 'F' THEN concat(o_orderkey % 15, 'days') WHEN 'O' THEN concat(' -', o_orderkey % 15, '.7')
        ELSE concat('no ', o_orderpriority) END""",
        fx.extract_number,
        "i",
        "CASE o_orderstatus WHEN 'P' THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) ELSE o_orderkey % 15 END",
    ),
    formatter(
        "fn_clean_value",
        "part",
        "p_partkey",
        """CASE p_type WHEN 'ECONOMY' THEN ' <NULL> ' WHEN 'LARGE' THEN 'N/a' WHEN 'SMALL' THEN '< none >'
        WHEN 'MEDIUM' THEN concat('  ', p_name, ' ') WHEN 'PROMO' THEN '' ELSE concat('<', p_name, '>') END""",
        fx.clean_value,
        "s",
        "CASE p_type WHEN 'MEDIUM' THEN p_name WHEN 'STANDARD' THEN concat('<', p_name, '>') END",
    ),
    formatter(
        "fn_parse_discount",
        "part",
        "p_partkey",
        """CASE p_type WHEN 'ECONOMY' THEN concat(p_size, '%') WHEN 'LARGE' THEN concat(p_size, ' PCT') WHEN 'SMALL'
        THEN concat(p_size, '%%') WHEN 'MEDIUM' THEN concat(p_size, '.5percent') WHEN 'PROMO' THEN 'none' ELSE concat('ca. ', p_size) END""",
        fx.discount_percent,
        "d",
        "CASE p_type WHEN 'MEDIUM' THEN p_size + 0.5 WHEN 'PROMO' THEN NULL ELSE p_size END",
    ),
    formatter("fn_format_product_type", "part", "p_partkey", MESSY_TYPE, fx.product_type, "s", TYPE_GROUP),
    formatter(
        "fn_product_type_basic",
        "part",
        "p_partkey",
        MESSY_TYPE,
        fx.product_type_basic,
        "s",
        """CASE p_type WHEN 'ECONOMY' THEN 'Cosmetic Products' WHEN 'LARGE' THEN 'TECH' WHEN 'SMALL' THEN 'Toys'
        WHEN 'MEDIUM' THEN 'Home Decor' WHEN 'PROMO' THEN 'GROCERIES' ELSE 'School Supplies' END""",
    ),
    formatter(
        "fn_product_type_sql",
        "part",
        "p_partkey",
        """CASE p_type WHEN 'ECONOMY' THEN ' Cosmetic ' WHEN 'LARGE' THEN 'ELECTRONICS AND TECH' WHEN 'SMALL' THEN 'entertainment'
        WHEN 'MEDIUM' THEN 'home-decor' WHEN 'PROMO' THEN 'Kitchen Ware' ELSE 'stationery' END""",
        fx.product_type_group,
        "s",
        """CASE p_type WHEN 'ECONOMY' THEN 'Cosmetics' WHEN 'LARGE' THEN 'Electronics And Technology' WHEN 'SMALL'
        THEN 'Toys And Entertainment' WHEN 'MEDIUM' THEN 'home-decor' WHEN 'PROMO' THEN 'Kitchenware'
        ELSE 'Stationary And School Supplies' END""",
    ),
    formatter(
        "fn_format_name",
        "customer",
        "c_custkey",
        """CASE c_nationkey % 6 WHEN 0 THEN concat('mc', lower(c_mktsegment)) WHEN 1 THEN concat('MAC', c_mktsegment)
        WHEN 2 THEN concat('o''', lower(c_mktsegment)) WHEN 3 THEN concat(' VAN  der ', c_mktsegment, ' ')
        WHEN 4 THEN concat(c_mktsegment, '-', lower(c_mktsegment)) ELSE lower(c_name) END""",
        fx.person_name,
        "s",
        f"""CASE c_nationkey % 6 WHEN 0 THEN concat('Mc', {_SEG}) WHEN 1 THEN concat('MaC', lower(c_mktsegment))
        WHEN 2 THEN concat('O''', {_SEG}) WHEN 3 THEN concat('van der ', {_MAC})
        WHEN 4 THEN concat({_MAC}, '-', {_SEG}) ELSE c_name END""",
    ),
    formatter(
        "fn_format_place",
        "customer",
        "c_custkey",
        "concat(' CITY  Of the ', lower(c_mktsegment), ' LA nation_', c_nationkey)",
        fx.place,
        "s",
        f"concat('City of the ', {_SEG}, ' la ', {_NATION})",
    ),
    formatter(
        "fn_format_street",
        "customer",
        "c_custkey",
        "concat('  ', c_nationkey, '   Old ', c_mktsegment, '\t st ')",
        fx.street,
        "s",
        "concat(c_nationkey, ' Old ', c_mktsegment, ' st')",
    ),
    formatter(
        "fn_format_phone",
        "customer",
        "c_custkey",
        """CASE c_nationkey % 3 WHEN 0 THEN concat('+63 (', c_nationkey, ') 55+', c_custkey) WHEN 1
        THEN concat('(02) ', c_custkey, '+', c_nationkey) ELSE c_mktsegment END""",
        fx.phone,
        "s",
        """CASE c_nationkey % 3 WHEN 0 THEN concat('+63', c_nationkey, '55+', c_custkey) WHEN 1
        THEN concat('02', c_custkey, c_nationkey) ELSE '' END""",
    ),
    formatter(
        "fn_format_gender",
        "customer",
        "c_custkey",
        """CASE c_nationkey % 6 WHEN 0 THEN ' M' WHEN 1 THEN 'female' WHEN 2 THEN 'Non-Binary' WHEN 3 THEN '  '
        WHEN 4 THEN c_mktsegment END""",
        fx.gender,
        "s",
        f"""CASE c_nationkey % 6 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' WHEN 2 THEN 'Other' WHEN 4 THEN {_SEG} END""",
    ),
    formatter(
        "fn_format_user_type",
        "customer",
        "c_custkey",
        "concat(' ', lower(c_mktsegment), '   USER')",
        fx.user_type,
        "s",
        f"concat({_SEG}, ' User')",
    ),
    formatter(
        "fn_format_job_title",
        "customer",
        "c_custkey",
        "concat('vp of  ', lower(c_mktsegment), ' It')",
        fx.job_title,
        "s",
        f"concat('VP Of ', {_SEG}, ' IT')",
    ),
    formatter(
        "fn_format_job_level",
        "customer",
        "c_custkey",
        "CASE c_nationkey % 3 WHEN 0 THEN '[NULL]' WHEN 1 THEN ' none ' ELSE concat('senior  ', c_mktsegment) END",
        fx.job_level,
        "s",
        f"CASE WHEN c_nationkey % 3 = 2 THEN concat('Senior ', {_SEG}) END",
    ),
    formatter(
        "fn_format_card",
        "customer",
        "c_custkey",
        "CASE WHEN c_nationkey % 3 = 0 THEN c_mktsegment ELSE concat('4000-', c_nationkey, ' ', c_custkey, 'x') END",
        fx.card_number,
        "s",
        "CASE WHEN c_nationkey % 3 <> 0 THEN concat('4000', c_nationkey, c_custkey) END",
    ),
    formatter(
        "fn_format_bank", "customer", "c_custkey", "concat(lower(c_mktsegment), '   BANK ')", fx.bank, "s", f"concat({_SEG}, ' Bank')"
    ),
    formatter(
        "fn_campaign_description",
        "part",
        "p_partkey",
        """concat(CASE WHEN p_size > 25 THEN '\"\"\"' ELSE '\"' END, p_name, '   now', CASE WHEN p_size > 25 THEN '\"\"\"' ELSE '' END)""",
        fx.campaign_description,
        "s",
        "concat(p_name, ' now')",
    ),
    formatter("fn_product_name", "part", "p_partkey", "concat(' ', p_name, '  x')", fx.product_name, "s", f"concat({title('p_name')}, ' X')"),
    formatter("fn_campaign_name", "part", "p_partkey", "concat(' ', p_name, '  x')", fx.campaign_name, "s", "concat(p_name, ' x')"),
    formatter(
        "fn_title",
        "customer",
        "c_custkey",
        "concat('3rd o''', c_mktsegment, '-', lower(c_name))",
        fx.title,
        "s",
        f"concat('3Rd O''', {_SEG}, '-', c_name)",
    ),
    formatter(
        "fn_norm_discount_legacy",
        "part",
        "p_partkey",
        """CASE p_type WHEN 'ECONOMY' THEN concat(p_size, '%') WHEN 'LARGE' THEN concat(p_size, ' PCT') WHEN 'MEDIUM'
        THEN concat('about ', p_size, '.25 percent') WHEN 'PROMO' THEN 'none' ELSE concat(p_size, '%%') END""",
        fx.legacy_discount,
        "d",
        "CASE p_type WHEN 'MEDIUM' THEN p_size + 0.25 WHEN 'PROMO' THEN NULL ELSE p_size END",
    ),
    formatter(
        "fn_norm_quantity_legacy",
        "part",
        "p_partkey",
        "CASE WHEN p_size > 40 THEN 'none' ELSE concat(p_size, 'pcs ', p_size) END",
        fx.first_quantity,
        "i",
        "CASE WHEN p_size <= 40 THEN p_size END",
    ),
    formatter(
        "fn_norm_arrival_legacy",
        "part",
        "p_partkey",
        "CASE WHEN p_size > 40 THEN concat(p_size, 'd') WHEN p_size > 30 THEN concat('', p_size) ELSE concat('in ', p_size, '  days') END",
        fx.arrival_days_before_word,
        "i",
        "CASE WHEN p_size <= 30 THEN p_size END",
    ),
    formatter(
        "fn_to_date_coerce",
        "orders",
        "o_orderkey",
        """CASE o_orderstatus WHEN 'F' THEN substr(CAST(CAST(o_orderdate AS DATE) AS CHAR(10)), 1, 10) WHEN 'O' THEN '2024-13-45'
        ELSE 'not-a-date' END""",
        fx.lenient_date,
        "s",
        "CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END",
    ),
    formatter(
        "fn_to_number_coerce",
        "part",
        "p_partkey",
        "CASE WHEN p_size > 40 THEN 'n.a.' WHEN p_size > 20 THEN concat(' ', p_size, '.5 ') ELSE concat('', p_size) END",
        fx.to_double,
        "d",
        "CASE WHEN p_size > 40 THEN NULL WHEN p_size > 20 THEN p_size + 0.5 ELSE p_size END",
    ),
    formatter(
        "fn_key_normalize",
        "orders",
        "o_orderkey",
        "concat('  ', o_orderkey, ' ')",
        fx.normalize_key,
        "s",
        "concat('', o_orderkey)",
    ),
]

_AVAILED = "CASE o_orderpriority WHEN '1-URGENT' THEN '1' WHEN '2-HIGH' THEN 'TRUE' WHEN '3-MEDIUM' THEN 'yes' WHEN '5-LOW' THEN 'Not Applicable' ELSE '0' END"


def convert_availed(spark, sf_dir):
    text = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_AVAILED).alias("t"))
    return text.select(
        "o_orderkey",
        *[fx.availed_flag(F.col("t"), v).alias(v) for v in ("ingest", "transform", "direct", "set_based")],
    )


def date_parts(spark, sf_dir):
    d = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        fx.date_key(d).alias("date_sk"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        fx.month_label(d).alias("month_name"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter"),
    )


def to_json_row(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).alias("user"),
        F.to_date("o_orderdate").alias("day"),
    )
    return df.select("o_orderkey", fx.row_json(["user", "day"]).alias("raw"))


def falsy_coalesce(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        fx.first_non_falsy(
            F.when(F.col("p_size") > 25, F.col("p_size")).when(F.col("p_size") > 10, F.lit(0)), F.lit(-1)
        ).alias("value"),
    )


# --- steps -----------------------------------------------------------------------------


def _indexed(spark, sf_dir) -> DataFrame:
    """Customers with leftovers of row indexes."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("Unnamed: 0"),
        F.col("c_name").alias("old_id_x"),
        F.col("c_custkey").cast("string").alias("0"),
        (F.col("c_custkey") * 2).cast("string").alias("7"),
        F.col("c_custkey").cast("string").alias("user id"),
        F.col("c_custkey").alias("ingest_seq"),
    )


def _shape(df: DataFrame, key: str) -> DataFrame:
    """Which columns are left, on each row."""
    names = ",".join(sorted(staging.data_columns(df)))
    return df.select(F.col(f"`{key}`").alias("id"), F.lit(names).alias("columns"))


def drop_index_cols(spark, sf_dir):
    return _shape(staging.drop_index_columns(_indexed(spark, sf_dir)), "user id")


def drop_first_index_col(spark, sf_dir):
    df = _indexed(spark, sf_dir)
    nameless = staging.drop_first_index_column(df)
    numbered = staging.drop_first_index_column(df.drop("Unnamed: 0", "old_id_x"))
    digits = staging.drop_first_index_column(df.select("user id", "7", "ingest_seq"), aggressive=True)
    counted = staging.drop_first_index_column(df.select(F.col("0").alias("n"), "user id", "ingest_seq"), "html")
    shapes = [_shape(d, k) for d, k in ((nameless, "user id"), (numbered, "user id"), (digits, "7"), (counted, "user id"))]
    out = shapes[0]
    for s in shapes[1:]:
        out = out.unionByName(s)
    return out.groupBy("columns").agg(F.count("*").alias("rows"))


def drop_unnamed(spark, sf_dir):
    df = _indexed(spark, sf_dir).withColumn("_c0", F.lit("x"))
    return _shape(staging.drop_unnamed(df), "user id")


def normalize_names(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias(" User  ID "), F.col("c_name").alias("full-name_"), F.col("c_mktsegment").alias("_Seg__ment")
    )
    return staging.normalize_names(df)


_DIRTY = """CASE p_type WHEN 'ECONOMY' THEN 'NaN' WHEN 'LARGE' THEN ' N/A ' WHEN 'SMALL' THEN concat('  ', p_name, '   x ')
    WHEN 'MEDIUM' THEN '' WHEN 'PROMO' THEN 'Null' ELSE p_name END"""
_DIRTY_CLEAN = """CASE p_type WHEN 'SMALL' THEN concat(p_name, ' x') WHEN 'PROMO' THEN 'Null' WHEN 'STANDARD' THEN p_name END"""


def clean_strings(spark, sf_dir):
    return staging.clean_strings(table(spark, sf_dir, "part").select("p_partkey", F.expr(_DIRTY).alias("text")))


def drop_empty_rows(spark, sf_dir):
    """Rows that hold nothing but lineage are dropped."""
    df = table(spark, sf_dir, "part").select(
        F.when(F.col("p_type") == "SMALL", F.col("p_partkey")).alias("a"),
        F.when(F.col("p_size") > 25, F.col("p_name")).alias("b"),
        F.col("p_partkey").alias("ingest_seq"),
    )
    return staging.drop_empty_rows(df)


def resolve_aliases(spark, sf_dir):
    df = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("ID"),
        F.col("s_name").alias("merchant_name"),
        F.concat(F.lit("street "), F.col("s_nationkey").cast("string")).alias("Address"),
        F.col("s_suppkey").cast("string").alias("phone"),
    )
    return staging.resolve_aliases(df, "merchant_data")


def project_to_schema(spark, sf_dir):
    """Undeclared columns fall off, absent ones are NULL, bad numbers too."""
    df = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("order_id"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey").cast("string")).otherwise("many").alias("delay_days"),
        F.col("o_orderpriority").alias("remark"),
    )
    return staging.project_to_schema(df, "order_delays")


def drop_lineage(spark, sf_dir):
    """The load time goes, the file name stays for the rejects."""
    df = staging.transform(sample_star.staging(spark, sf_dir)["line_item_data_products"], "line_item_data_products")
    return _shape(df, "order_id").groupBy("columns").agg(
        F.count("*").alias("rows"), F.lit("loaded_at" in df.columns).alias("has_load_time"), F.lit("file_source" in df.columns).alias("has_file")
    )


def require_columns(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("merchant_id"))
    skipped = staging.require_columns(df, "order_with_merchant_data")
    warned = staging.require_columns(df, "line_item_data_products")
    return warned.agg(F.count("*").alias("kept_rows")).withColumn("skipped", F.lit(skipped is None))


def row_placeholder_id(spark, sf_dir):
    return staging.with_row_placeholder(
        sample_star.staged_lines(spark, sf_dir).select("order_id", "product_id", "file_source", "ingest_seq")
    )


def filter_null_key(spark, sf_dir):
    df = table(spark, sf_dir, "part").select("p_partkey", F.expr(_DIRTY).alias("key"))
    return staging.clean_strings(df).filter(F.col("key").isNotNull())


def filter_predicates(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    flag = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2)
    return o.withColumn("flag", flag).filter(
        (
            (F.col("o_totalprice") > 100000) & (F.col("o_orderpriority") != "5-LOW") & ~F.col("flag").isin(0, 1)
        )
        | (F.col("flag").isNull() & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (F.col("o_totalprice") < 50000))
    ).select("o_orderkey", "flag")


def case_when(spark, sf_dir):
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(price < 10000, "small").when(price < 100000, "medium").otherwise(F.col("o_orderpriority")).alias("label"),
    )


def coalesce_nullif(spark, sf_dir):
    per_user = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("shipped"), F.count_if(F.col("o_orderstatus") == "P").alias("pending")
    )
    return per_user.select(
        "o_custkey",
        F.coalesce(F.nullif("shipped", F.lit(0)), F.lit(-1)).alias("shipped"),
        percent(F.col("shipped"), F.col("pending")).alias("pct"),
        F.round(ratio(F.col("shipped"), F.col("pending")), 4).alias("share"),
        F.abs(F.col("shipped") - F.col("pending")).alias("gap"),
    )


def label_rows(spark, sf_dir):
    """A label, a measure and the time of asking (the time is not compared)."""
    out = table(spark, sf_dir, "orders").agg(F.count("*").alias("value"))
    return out.select(F.lit("Orders").alias("metric"), "value", F.current_timestamp().isNotNull().alias("dated"))


def light_clean(spark, sf_dir):
    df = table(spark, sf_dir, "part").select(
        F.lit("i").alias("Unnamed: 0"),
        "p_partkey",
        F.concat(F.col("p_size").cast("string"), F.lit("pct")).alias("Discount"),
        F.concat(F.col("p_size").cast("string"), F.lit("PCs")).alias("quantity"),
        F.concat(F.col("p_size").cast("string"), F.lit("days")).alias("estimated arrival"),
        F.when(F.col("p_size") > 25, "1999-01-02").otherwise("?").alias("creation_date"),
    )
    out = staging.light_clean(df)
    return out.withColumnRenamed("estimated arrival", "arrival").withColumn("width", F.lit(len(out.columns)))


QUERIES = [
    *FORMATTERS,
    Query(
        "fn_convert_availed",
        convert_availed,
        "o_orderkey:i ingest:i transform:i direct:i set_based:i",
        """SELECT o_orderkey, CASE WHEN p IN (1, 2, 3) THEN 1 ELSE 0 END AS ingest,
        CASE WHEN p IN (1, 2, 3) THEN 1 WHEN p = 4 THEN 0 END AS transform,
        CASE WHEN p IN (1, 2) THEN 1 WHEN p IN (3, 4) THEN 0 END AS direct,
        CASE WHEN p IN (1, 2) THEN 1 WHEN p = 4 THEN 0 END AS set_based
        FROM (SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS p FROM orders)""",
    ),
    Query(
        "fn_date_parts",
        date_parts,
        "o_orderkey:i date_sk:i year:i month:i day:i month_name:s quarter:s",
        """SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_sk, year(o_orderdate) AS year,
        month(o_orderdate) AS month, day(o_orderdate) AS day, rpad(monthname(o_orderdate), 9, ' ') AS month_name,
        'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter FROM orders""",
    ),
    Query(
        "fn_to_json_row",
        to_json_row,
        "o_orderkey:i raw:s",
        """SELECT o_orderkey, concat('{"user":', CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS VARCHAR) ELSE 'null' END,
        ',"day":"', CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '"}') AS raw FROM orders""",
    ),
    Query(
        "fn_falsy_coalesce",
        falsy_coalesce,
        "p_partkey:i value:i",
        "SELECT p_partkey, CASE WHEN p_size > 25 THEN p_size ELSE -1 END AS value FROM part",
    ),
    Query("fn_light_clean", light_clean, "p_partkey:i Discount:d quantity:i arrival:i creation_date:s width:i",
        """SELECT p_partkey, p_size AS Discount, p_size AS quantity, p_size AS arrival,
        CASE WHEN p_size > 25 THEN '1999-01-02 00:00:00' END AS creation_date, 5 AS width FROM part"""),
    Query(
        "drop_index_cols",
        drop_index_cols,
        "id:s columns:s",
        "SELECT CAST(c_custkey AS VARCHAR) AS id, '7,user id' AS columns FROM customer",
    ),
    Query(
        "drop_first_index_col",
        drop_first_index_col,
        "columns:s rows:i",
        """SELECT columns, n * (SELECT COUNT(*) FROM customer) AS rows FROM
        (VALUES ('0,7,old_id_x,user id', 1), ('7,user id', 1), ('7', 1), ('user id', 1)) t(columns, n)""",
    ),
    Query(
        "drop_unnamed",
        drop_unnamed,
        "id:s columns:s",
        "SELECT CAST(c_custkey AS VARCHAR) AS id, '0,7,old_id_x,user id' AS columns FROM customer",
    ),
    Query(
        "normalize_names",
        normalize_names,
        "User_ID:i full_name:s Seg_ment:s",
        "SELECT c_custkey AS User_ID, c_name AS full_name, c_mktsegment AS Seg_ment FROM customer",
    ),
    Query("clean_strings", clean_strings, "p_partkey:i text:s", f"SELECT p_partkey, {_DIRTY_CLEAN} AS text FROM part"),
    Query(
        "drop_empty_rows",
        drop_empty_rows,
        "a:i b:s",
        """SELECT CASE WHEN p_type = 'SMALL' THEN p_partkey END AS a, CASE WHEN p_size > 25 THEN p_name END AS b FROM part
        WHERE p_type = 'SMALL' OR p_size > 25""",
    ),
    Query(
        "resolve_aliases",
        resolve_aliases,
        "merchant_id:i name:s street:s contact_number:s",
        """SELECT s_suppkey AS merchant_id, s_name AS name, concat('street ', s_nationkey) AS street,
        CAST(s_suppkey AS VARCHAR) AS contact_number FROM supplier""",
    ),
    Query(
        "project_to_schema",
        project_to_schema,
        "order_id:s delay_days:i file_source:s",
        """SELECT concat('O', o_orderkey) AS order_id, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS delay_days,
        NULL AS file_source FROM orders""",
    ),
    Query(
        "drop_lineage",
        drop_lineage,
        "columns:s rows:i has_load_time:b has_file:b",
        """SELECT 'line_item_id,order_id,product_id' AS columns, COUNT(*) AS rows, FALSE AS has_load_time, TRUE AS has_file
        FROM lineitem""",
    ),
    Query(
        "require_columns", require_columns, "kept_rows:i skipped:b", "SELECT COUNT(*) AS kept_rows, TRUE AS skipped FROM orders"
    ),
    Query(
        "row_placeholder_id",
        row_placeholder_id,
        "order_id:s product_id:s file_source:s line_item_id:s",
        with_star(
            """SELECT order_id, product_id, file_source,
            ROW_NUMBER() OVER (PARTITION BY file_source ORDER BY seq) - 1 AS line_item_id FROM stg_lines"""
        ),
    ),
    Query(
        "filter_null_key",
        filter_null_key,
        "p_partkey:i key:s",
        f"SELECT p_partkey, {_DIRTY_CLEAN} AS key FROM part WHERE p_type IN ('SMALL', 'PROMO', 'STANDARD')",
    ),
    Query(
        "filter_predicates",
        filter_predicates,
        "o_orderkey:i flag:i",
        """SELECT * FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS flag, o_totalprice,
        o_orderpriority FROM orders) WHERE (o_totalprice > 100000 AND o_orderpriority != '5-LOW' AND flag NOT IN (0, 1))
        OR (flag IS NULL AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice < 50000)""",
    ),
    Query(
        "case_when",
        case_when,
        "o_orderkey:i label:s",
        """SELECT o_orderkey, CASE WHEN o_totalprice < 10000 THEN 'small' WHEN o_totalprice < 100000 THEN 'medium'
        ELSE o_orderpriority END AS label FROM orders""",
    ),
    Query(
        "coalesce_nullif",
        coalesce_nullif,
        "o_custkey:i shipped:i pct:r2 share:r4 gap:i",
        """SELECT o_custkey, COALESCE(NULLIF(f, 0), -1) AS shipped,
        ROUND(CAST(f AS DOUBLE) / NULLIF(CAST(p AS DOUBLE), 0) * 100, 2) AS pct,
        ROUND(CAST(f AS DOUBLE) / NULLIF(CAST(p AS DOUBLE), 0), 4) AS share, ABS(f - p) AS gap
        FROM (SELECT o_custkey, COUNT(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS f,
            COUNT(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS p FROM orders GROUP BY 1)""",
    ),
    Query("label_rows", label_rows, "metric:s value:i dated:b", "SELECT 'Orders' AS metric, COUNT(*) AS value, TRUE AS dated FROM orders"),
]
