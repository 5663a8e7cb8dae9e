"""The star over the given tables.

``feeds`` shows the tables as the thirteen departmental feeds; ``build_star``
runs the real formatters and loaders over them and stores the result in the
scratch folder, as a nightly load would.  A table is loaded when it is first
asked for, and what it is loaded from before it: a query over orders does not
wait for the line items.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyhouse.operators import dimensions as dims
from tallyhouse.operators import facts
from tallyhouse.operators.keys import with_ingest_seq
from tallyhouse.operators.staging import format_for_staging, transform
from tallyhouse.session import configure, materialize, scratch_path

CALENDAR = (dt.date(1995, 1, 1), dt.date(2001, 12, 31))
NO_CAMPAIGN = "4-NOT SPECIFIED"

# Messy spellings given to the six part types.
MESSY_TYPES = {
    "ECONOMY": " cosmetic_products ",
    "LARGE": "TECH",
    "SMALL": "toys",
    "MEDIUM": "home-decor",
    "PROMO": "GROCERIES",
    "STANDARD": "School  Supplies",
}
LINE_ORDER = [
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id(prefix: str, c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.lit(prefix), c.cast("string"))


def messy_type(c: Column) -> Column:
    return F.coalesce(*[F.when(c == k, F.lit(v)) for k, v in MESSY_TYPES.items()], c)


def line_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in a fixed order of arrival, with the order kept as a number."""
    li = table(spark, sf_dir, "lineitem").orderBy(*LINE_ORDER)
    return with_ingest_seq(li).select(
        _id("O", "l_orderkey").alias("order_id"),
        _id("PRODUCT", "l_partkey").alias("product_id"),
        F.col("l_extendedprice").cast("decimal(10,2)").cast("string").alias("price"),
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("pcs")).alias("quantity"),
        F.concat(F.lit("lines-"), F.col("l_returnflag"), F.lit(".csv")).alias("file_source"),
        F.col("l_shipdate").cast("timestamp").alias("loaded_at"),
        "ingest_seq",
    )


def order_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order belongs to the lowest of its suppliers; orders without lines to none."""
    lowest = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_suppkey").alias("suppkey"))
    return (
        table(spark, sf_dir, "orders")
        .join(lowest, F.col("o_orderkey") == F.col("l_orderkey"))
        .select(
            _id("O", "o_orderkey").alias("order_id"),
            _id("MERCHANT", "suppkey").alias("merchant_id"),
            _id("STAFF", F.col("o_custkey") % 25).alias("staff_id"),
            F.col("o_orderkey").alias("ingest_seq"),
        )
    )


class Lazy(Mapping):
    """Named frames, each planned when it is first asked for."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        self._makers, self._made = makers, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self):
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)

    def __contains__(self, name: object) -> bool:
        return name in self._makers  # without making it

    def make(self, *names: str) -> None:
        """Make several at once; none of them may need another."""
        with ThreadPoolExecutor(max_workers=4) as pool:
            list(pool.map(self.__getitem__, names))

    def replaced(self, **makers: Callable[[], DataFrame]) -> "Lazy":
        """The same frames, with some made otherwise."""
        return Lazy({n: (lambda n=n: self[n]) for n in self} | makers)

    def map(self, fn: Callable[[DataFrame, str], DataFrame]) -> "Lazy":
        return Lazy({n: (lambda n=n: fn(self[n], n)) for n in self})


def feeds(spark: SparkSession, sf_dir: str) -> Lazy:
    """Raw feeds: texts as a department would send them."""
    t = lambda name: table(spark, sf_dir, name)
    where = lambda: t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    orders = lambda: t("orders")
    lines = lambda: staged_lines(spark, sf_dir)
    seq = F.col("o_orderkey").alias("ingest_seq")
    makers = {
        "campaign_data": lambda: orders().filter(F.col("o_orderpriority") != NO_CAMPAIGN)
        .select("o_orderpriority")
        .distinct()
        .select(
            F.col("o_orderpriority").alias("campaign_id"),
            F.concat(F.lit("  Push   "), F.col("o_orderpriority")).alias("campaign_name"),
            F.concat(F.lit('"""Plan  for '), F.col("o_orderpriority"), F.lit('"""')).alias("campaign_description"),
            F.concat(F.substring("o_orderpriority", 1, 1), F.lit("0pct")).alias("discount"),
            F.lit(0).cast("bigint").alias("ingest_seq"),
        ),
        "transactional_campaign_data": lambda: orders().select(
            _id("O", "o_orderkey").alias("order_id"),
            F.col("o_orderpriority").alias("campaign_id"),
            F.when(F.col("o_orderstatus") == "F", "Yes").when(F.col("o_orderstatus") == "O", "no").alias("availed"),
            F.col("o_orderdate").cast("date").alias("transaction_date"),
            seq,
        ),
        "order_data": lambda: orders().select(
            _id("O", "o_orderkey").alias("order_id"),
            _id("USER", "o_custkey").alias("user_id"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("transaction_date"),
            F.concat((F.col("o_orderkey") % 15 + 1).cast("string"), F.lit("days")).alias("estimated_arrival"),
            seq,
        ),
        "order_with_merchant_data": lambda: order_merchants(spark, sf_dir),
        "order_delays": lambda: orders().filter(F.col("o_orderstatus") == "F").select(
            _id("O", "o_orderkey").alias("order_id"),
            F.concat((F.floor("o_totalprice") % 10).cast("string"), F.lit(" days")).alias("delay_in_days"),
            seq,
        ),
        "line_item_data_prices": lambda: lines().select("order_id", "price", "quantity", "file_source", "loaded_at", "ingest_seq"),
        "line_item_data_products": lambda: lines().select("order_id", "product_id", "file_source", "loaded_at", "ingest_seq"),
        "product_list": lambda: t("part").select(
            _id("PRODUCT", "p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            messy_type(F.col("p_type")).alias("product_type"),
            F.col("p_retailprice").cast("decimal(10,2)").cast("string").alias("price"),
            F.col("p_partkey").alias("ingest_seq"),
        ),
        "user_data": lambda: t("customer")
        .join(where(), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            _id("USER", "c_custkey").alias("user_id"),
            F.col("c_name").alias("name"),
            F.concat(F.lit(" "), F.col("n_name"), F.lit("   street ")).alias("street"),
            F.col("r_name").alias("city"),
            F.col("n_name").alias("country"),
            F.when(F.col("c_acctbal") < 0, "f").otherwise("MALE").alias("gender"),
            F.col("c_mktsegment").alias("user_type"),
            F.col("c_custkey").alias("ingest_seq"),
        ),
        "user_job": lambda: t("customer").select(
            _id("USER", "c_custkey").alias("user_id"),
            F.concat(F.lower("c_mktsegment"), F.lit(" vp")).alias("job_title"),
            F.when(F.col("c_acctbal") < 0, "[null]").otherwise("senior").alias("job_level"),
            F.col("c_custkey").alias("ingest_seq"),
        ),
        "user_credit_card": lambda: t("customer").select(
            _id("USER", "c_custkey").alias("user_id"),
            F.lower("c_name").alias("name"),
            F.concat(F.lit("4000-"), F.col("c_custkey").cast("string")).alias("credit_card_number"),
            F.concat(F.lower("c_mktsegment"), F.lit("  bank")).alias("issuing_bank"),
            F.col("c_custkey").alias("ingest_seq"),
        ),
        "merchant_data": lambda: t("supplier")
        .join(where(), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            _id("MERCHANT", "s_suppkey").alias("merchant_id"),
            F.col("s_name").alias("name"),
            F.col("r_name").alias("city"),
            F.col("n_name").alias("country"),
            F.concat(F.lit("+1 (0"), F.col("s_suppkey").cast("string"), F.lit(") 55")).alias("contact_number"),
            F.col("s_suppkey").alias("ingest_seq"),
        ),
        "staff_data": lambda: where().select(
            _id("STAFF", "n_nationkey").alias("staff_id"),
            F.col("n_name").alias("name"),
            F.col("r_name").alias("job_level"),
            F.col("n_nationkey").cast("bigint").alias("ingest_seq"),
        ),
    }
    return Lazy(makers)


# feed -> dimension it fills
DIM_FEEDS = {
    "dim_campaign": "campaign_data",
    "dim_product": "product_list",
    "dim_user": "user_data",
    "dim_staff": "staff_data",
    "dim_merchant": "merchant_data",
    "dim_user_job": "user_job",
    "dim_credit_card": "user_credit_card",
    "dim_date": None,
}

_built: dict[tuple[str, str], Lazy] = {}
_lines: dict[tuple[str, str], DataFrame] = {}


def _key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return spark.sparkContext.applicationId, sf_dir.rstrip("/")


def staged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line feed, written once: its order of arrival must not change."""
    key = _key(spark, sf_dir)
    if key not in _lines:
        _lines[key] = materialize(line_feed(configure(spark), sf_dir), "line_feed")
    return _lines[key]


def staging(spark: SparkSession, sf_dir: str) -> Lazy:
    """The thirteen staging tables, formatted."""
    return feeds(spark, sf_dir).map(format_for_staging)


def transformed(spark: SparkSession, sf_dir: str) -> Lazy:
    return staging(spark, sf_dir).map(transform)


def _dimension(spark: SparkSession, name: str, feeds: Mapping[str, DataFrame]) -> DataFrame:
    if name == "dim_date":
        return dims.build_calendar(spark, *CALENDAR)
    empty = dims.empty_table(spark, name)
    if name in dims.OUTRIGGERS:
        return dims.append_outrigger(name, empty, feeds[DIM_FEEDS[name]])
    loaded = dims.upsert_dimension(name, empty, feeds[DIM_FEEDS[name]])
    return dims.ensure_unknown_campaign(loaded) if name == "dim_campaign" else loaded


def _store_fact(df: DataFrame, label: str) -> DataFrame:
    """Write a fact clustered by day: readers of a few days skip the other
    files and row groups.  The order id in the sort splits a hot day."""
    by = ["transaction_date_sk", "order_id"]
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def build_star(spark: SparkSession, sf_dir: str) -> Lazy:
    feed = transformed(configure(spark), sf_dir)

    def orders() -> facts.Load:
        star.make("dim_user", "dim_merchant", "dim_staff", "dim_date")  # independent of each other: their jobs may overlap
        return facts.load_orders(
            dims.empty_table(spark, "fact_orders"),
            feed["order_data"],
            feed["order_with_merchant_data"],
            feed["order_delays"],
            star,
            stage=materialize,
        )

    def line_items() -> facts.Load:
        return facts.load_line_items(
            dims.empty_table(spark, "fact_line_items"),
            feed["line_item_data_prices"],
            feed["line_item_data_products"],
            star["dim_product"],
            star["fact_orders"],
            pairing="order",
            stage=materialize,
        )

    def campaign_transactions() -> facts.Load:
        return facts.load_campaign_transactions(
            dims.empty_table(spark, "fact_campaign_transactions"),
            feed["transactional_campaign_data"],
            star["dim_campaign"],
            star["fact_orders"],
            stage=materialize,
        )

    fact_loads = {
        "fact_orders": orders,
        "fact_line_items": line_items,
        "fact_campaign_transactions": campaign_transactions,
    }
    loads = Lazy(fact_loads)
    makers = {n: (lambda n=n: materialize(_dimension(spark, n, feed), n)) for n in DIM_FEEDS}
    for fact in fact_loads:
        makers[fact] = lambda n=fact: _store_fact(loads[n].table, n)
        makers[f"reject_{fact}"] = lambda n=fact: loads[n].rejects
    star = Lazy(makers)
    return star


def star(spark: SparkSession, sf_dir: str) -> Lazy:
    """The stored star of ``sf_dir``; each table is built on first use in an application."""
    key = _key(spark, sf_dir)
    if key not in _built:
        _built[key] = build_star(spark, sf_dir)
    return _built[key]
