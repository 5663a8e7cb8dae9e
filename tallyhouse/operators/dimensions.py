"""Dimension loads: overwrite-by-key, stubs for late members, outriggers, calendar."""

from __future__ import annotations

import datetime as dt
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyhouse import schemas
from tallyhouse.functions import (
    clean_value,
    date_key,
    job_level,
    month_label,
    normalize_key,
    product_type_group,
)
from tallyhouse.operators.keys import last_per_key, with_surrogate_key

UNKNOWN_CAMPAIGN = "UNKNOWN"
UNKNOWN_CAMPAIGN_NAME = "Unknown Campaign"
UNKNOWN_CAMPAIGN_NOTE = "Placeholder for orders with missing or late-arriving campaign data"


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    """No rows in the declared layout.

    Written as a filter that is always false, so that the optimizer sees the
    emptiness and drops the joins of a first load.
    """
    return spark.range(1).where("false").select().to(schemas.warehouse_schema(table))


def _conform(df: DataFrame, table: str) -> DataFrame:
    """Declared columns in declared order and type; absent ones are NULL."""
    return df.to(schemas.warehouse_schema(table))


@lru_cache(maxsize=None)
def _cleaned(name: str) -> Column:
    return clean_value(F.col(name)).alias(name)


def upsert_dimension(table: str, current: DataFrame, batch: DataFrame, seq: str = "ingest_seq") -> DataFrame:
    """Members of ``batch`` replace the attributes of those already there.

    Surrogate keys of known members stay.  Within the batch the last row of a
    key wins.  Rows without a key are left out.
    """
    sk, key = schemas.DIM_KEYS[table]
    attrs = schemas.attributes(table)
    have = set(batch.columns)
    text_attrs = {f.name for f in schemas.warehouse_schema(table).fields if f.dataType.simpleString() == "string"}
    incoming = batch.filter(F.col(key).isNotNull()).select(
        key, seq, *[_cleaned(a) if a in text_attrs else F.col(a) for a in attrs if a in have]
    )
    latest = last_per_key(incoming, [key], seq).drop(seq)
    latest = _conform(latest, table).drop(sk)
    known = current.alias("c").join(latest.selectExpr("*", "true AS __hit").alias("b"), key, "left")
    updated = known.selectExpr(
        f"c.{sk}", key, *[f"CASE WHEN b.__hit THEN b.{a} ELSE c.{a} END AS {a}" for a in attrs]
    )
    added = with_surrogate_key(latest.join(current.select(key), key, "left_anti"), key, sk, current)
    return _conform(updated, table).unionByName(_conform(added, table))


def load_dimension_set_based(table: str, current: DataFrame, sources: list[DataFrame]) -> DataFrame:
    """All staging sources of a dimension at once, equal rows taken once.

    Where sources disagree about a member, the later source wins, and within
    it the later row.
    """
    numbered = [
        df.selectExpr(*[c for c in df.columns if c != "ingest_seq"], f"struct({i} AS source, ingest_seq) AS ingest_seq")
        for i, df in enumerate(sources)
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)
    return upsert_dimension(table, current, stacked)


def _add_members(table: str, current: DataFrame, members: DataFrame) -> DataFrame:
    """Insert members whose key is not there yet; the others stay untouched."""
    sk, key = schemas.DIM_KEYS[table]
    # the stored key is compared as stripped text as well
    known = current.select(normalize_key(F.col(key)).alias(key))
    added = with_surrogate_key(members.join(known, key, "left_anti"), key, sk, current)
    return current.unionByName(_conform(added, table))


def ensure_unknown_campaign(dim_campaign: DataFrame) -> DataFrame:
    """Add the member that campaign rows fall back to, if it is missing."""
    spark = dim_campaign.sparkSession
    unknown = spark.range(1).select(
        F.lit(UNKNOWN_CAMPAIGN).alias("campaign_id"),
        F.lit(UNKNOWN_CAMPAIGN_NAME).alias("campaign_name"),
        F.lit(UNKNOWN_CAMPAIGN_NOTE).alias("campaign_description"),
        F.lit(0).cast("decimal(10,2)").alias("discount"),
    )
    return _add_members("dim_campaign", dim_campaign, unknown)


def _stripped_ids(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn(key, normalize_key(F.col(key))).filter(F.length(key) > 0)


def stub_users(dim_user: DataFrame, orders: DataFrame) -> DataFrame:
    """Members known by id only, for users first seen in an order."""
    ids = _stripped_ids(orders.select("user_id"), "user_id").distinct()
    return _add_members("dim_user", dim_user, ids)


def stub_products(dim_product: DataFrame, line_products: DataFrame, seq: str = "ingest_seq") -> DataFrame:
    """Members for products first seen in a line item.

    The name is the first one the line items give, where they give any.
    """
    lines = _stripped_ids(line_products, "product_id")
    if "product_name" in lines.columns:
        named = F.when(F.col("product_name").isNotNull(), F.col(seq))
        members = lines.groupBy("product_id").agg(
            F.trim(F.min_by("product_name", named)).alias("product_name")
        )
    else:
        members = lines.select("product_id").distinct()
    return _add_members("dim_product", dim_product, members)


OUTRIGGERS = {
    "dim_user_job": ("user_job_sk", ["user_id", "job_title", "job_level"]),
    "dim_credit_card": ("credit_card_sk", ["user_id", "name", "credit_card_number", "issuing_bank"]),
}


def append_outrigger(table: str, current: DataFrame, batch: DataFrame, dedup: bool = True) -> DataFrame:
    """Append rows that hang off a user.

    These tables have no key besides the surrogate one.  By default a row that
    is already there is not added again; ``dedup=False`` appends every row.
    """
    sk, columns = OUTRIGGERS[table]
    rows = batch.filter(F.col("user_id").isNotNull()).select(
        F.col("user_id").cast("string").alias("user_id"),
        *[
            (job_level(F.col(c)) if c == "job_level" else clean_value(F.col(c))).alias(c)
            for c in columns
            if c != "user_id"
        ],
        *([] if dedup else ["ingest_seq"]),
    )
    if dedup:
        rows = rows.distinct()
        same = [rows[c].eqNullSafe(current[c]) for c in columns if c != "user_id"]
        on = rows["user_id"] == current["user_id"]
        for s in same:
            on = on & s
        rows = rows.join(current, on, "left_anti")
        row_key = F.concat_ws("\x1f", *[F.coalesce(F.col(c), F.lit("\x00")) for c in columns])
        keyed = rows.withColumn("__row", row_key)
    else:
        # equal rows are all kept; their place in the feed tells them apart
        keyed = rows.withColumnRenamed("ingest_seq", "__row")
    added = with_surrogate_key(keyed, "__row", sk, current).drop("__row")
    return current.unionByName(_conform(added, table))


def regroup_product_types(dim_product: DataFrame) -> DataFrame:
    """Bring product types to their group name; NULL types stay NULL."""
    return dim_product.withColumn("product_type", product_type_group(F.col("product_type")))


def build_calendar(
    spark: SparkSession,
    first: dt.date = dt.date(2020, 1, 1),
    last: dt.date = dt.date(2025, 12, 31),
    extended: bool = False,
) -> DataFrame:
    """One row per day.  Size is the number of days, known before it runs."""
    days = (last - first).days + 1
    date = F.date_add(F.lit(first), F.col("id").cast("int"))
    out = spark.range(days).select(date.alias("date"))
    return calendar_columns(out, extended)


def calendar_columns(days: DataFrame, extended: bool = False) -> DataFrame:
    d = F.col("date")
    out = days.select(
        date_key(d).alias("date_sk"),
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        month_label(d).alias("month_name"),
        F.dayofmonth(d).alias("day"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter"),
    )
    if extended:
        out = out.withColumns(
            {
                "day_of_week": F.dayofweek(d),
                "day_name": F.date_format(d, "EEEE"),
                "is_weekend": F.dayofweek(d).isin(1, 7),
            }
        )
    return out


def extend_calendar(current: DataFrame, days: DataFrame) -> DataFrame:
    """Add the days that are not in the calendar yet."""
    return current.unionByName(days.join(current.select("date_sk"), "date_sk", "left_anti"))
