"""Fact loads: key lookups, rejects with a reason, upserts and re-keying.

Every loader judges each offered row once (a ``reason`` column), and derives
both outcomes - rows to load and rows to reject - from that judged table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse import schemas
from tallyhouse.functions import date_key, extract_number, lenient_date, normalize_key, row_json
from tallyhouse.operators.dimensions import UNKNOWN_CAMPAIGN
from tallyhouse.operators.keys import (
    Stage,
    first_per_key,
    with_global_position,
    with_group_position,
)
from tallyhouse.operators.relational import hashed


@dataclass
class Load:
    """Result of a fact load: the new table and the rows turned away."""

    table: DataFrame
    rejects: DataFrame
    offered: DataFrame  # rows that passed every rule, before key conflicts
    added: DataFrame | None = None  # new rows alone, where known rows never change


def _shown(c: Column) -> Column:
    """An id inside a reason text; a missing one is spelled ``None``."""
    return F.coalesce(c, F.lit("None"))


def _missing_text(c: Column) -> Column:
    return c.isNull() | (F.length(c) == 0)


def key_map(dim: DataFrame, table: str) -> DataFrame:
    """(business key, surrogate key) of a dimension: the two columns a lookup reads.

    No broadcast is asked for: Spark broadcasts a side whose size it has
    checked against ``autoBroadcastJoinThreshold``, and otherwise joins by
    shuffle, splitting hot keys.
    """
    sk, key = schemas.DIM_KEYS[table]
    return dim.select(F.col(key).alias(key), F.col(sk).alias(sk))


def order_keys(fact_orders: DataFrame) -> DataFrame:
    """Keys that line items and campaign rows take over from their order."""
    return fact_orders.select(
        normalize_key(F.col("order_id")).alias("order_id"),
        "user_sk",
        "merchant_sk",
        "staff_sk",
        "transaction_date_sk",
    )


def _rejects(judged: DataFrame, table: str, echo: list[str], raw: list[str]) -> DataFrame:
    source = F.col("file_source") if "file_source" in judged.columns else F.lit(None).cast("string")
    have = set(judged.columns)
    out = judged.filter(F.col("reason").isNotNull()).select(
        *[
            (F.nullif(F.col(c).cast("string"), F.lit("")) if c in have else F.lit(None).cast("string")).alias(c)
            for c in echo
        ],
        F.col("reason").alias("error_reason"),
        source.alias("source_file"),
        F.localtimestamp().alias("rejected_at"),
        row_json([c for c in raw if c in have]).alias("raw_data"),
    )
    return out.select(*[F.col(f.name).cast(f.dataType) for f in schemas.warehouse_schema(table).fields])


def insert_or_ignore(
    current: DataFrame, offered: DataFrame, keys: list[str], seq: str = "ingest_seq"
) -> DataFrame:
    """Rows of ``offered`` that are new: first of each key, not in ``current``."""
    fresh = first_per_key(offered, keys, seq).drop(seq)
    return fresh.join(current.select(*keys), keys, "left_anti").select(*current.columns)


# --- orders -------------------------------------------------------------------


def _keyed_delays(delays: DataFrame) -> DataFrame:
    return delays.select(normalize_key(F.col("order_id")).alias("order_id"), "delay_days", "ingest_seq")


def combine_orders(
    orders: DataFrame, order_merchants: DataFrame, delays: DataFrame | None
) -> DataFrame:
    """Orders with their merchant and staff, and their delay.

    The staff named by the merchant feed counts, not the one on the order.  An
    order without a merchant row is left out.  Of several orders or merchant
    rows the first stays, of several delays the last; ``__delays`` says how
    many there were.  Each side comes down to one row per order before the
    joins, so an order that is repeated very often is no hot key in them.
    """
    left = orders.drop("staff_id").withColumn("order_id", normalize_key(F.col("order_id")))
    right = order_merchants.select(
        normalize_key(F.col("order_id")).alias("order_id"),
        "merchant_id",
        "staff_id",
        F.col("ingest_seq").alias("__merchant_seq"),
    )
    first_order = first_per_key(left, ["order_id"])
    first_merchant = first_per_key(right, ["order_id"], "__merchant_seq").drop("__merchant_seq")
    combined = first_order.join(first_merchant, "order_id", "inner")
    if delays is None:
        return combined.withColumns({"delay_days": F.lit(None).cast("int"), "__delays": F.lit(0).cast("bigint")})
    last = _keyed_delays(delays).groupBy("order_id").agg(
        F.max_by("delay_days", "ingest_seq").alias("delay_days"), F.count("*").alias("__delays")
    )
    return combined.join(last, "order_id", "left")


def _per_delay(rejected: DataFrame, delays: DataFrame | None) -> DataFrame:
    """A rejected order comes out once per delay row it has."""
    if delays is None:
        return rejected
    several = F.coalesce(F.col("__delays"), F.lit(0)) > 1
    each = rejected.filter(several).drop("delay_days").join(
        _keyed_delays(delays).select("order_id", "delay_days"), "order_id"
    )
    return rejected.filter(~several).unionByName(each)


def judge_orders(
    combined: DataFrame,
    dim_user: DataFrame,
    dim_merchant: DataFrame,
    dim_staff: DataFrame,
    dim_date: DataFrame,
    missing_delay: int | None = 0,
) -> DataFrame:
    """Look up the four keys and name the first rule a row breaks."""
    text_date = dict(combined.dtypes)["transaction_date"] == "string"
    date = lenient_date(F.col("transaction_date")) if text_date else F.col("transaction_date").cast("date")
    keyed = combined.withColumns(
        {
            "user_id": normalize_key(F.col("user_id")),
            "merchant_id": normalize_key(F.col("merchant_id")),
            "staff_id": normalize_key(F.col("staff_id")),
            "__date": date,
        }
    )
    keyed = (
        keyed.join(key_map(dim_user, "dim_user"), "user_id", "left")
        .join(key_map(dim_merchant, "dim_merchant"), "merchant_id", "left")
        .join(key_map(dim_staff, "dim_staff"), "staff_id", "left")
        .join(
            dim_date.select(F.col("date").alias("__date"), F.col("date_sk").alias("transaction_date_sk")),
            "__date",
            "left",
        )
    )
    rules = [
        (F.col("user_sk").isNull(), "user_id '", "user_id", "' not found in dim_user"),
        (F.col("merchant_sk").isNull(), "merchant_id '", "merchant_id", "' not found in dim_merchant"),
        (F.col("staff_sk").isNull(), "staff_id '", "staff_id", "' not found in dim_staff"),
        (F.col("transaction_date").isNull(), "null transaction_date", None, ""),
        (F.col("__date").isNull(), "invalid transaction_date format '", "transaction_date", "'"),
        (F.col("transaction_date_sk").isNull(), "date '", "__date", "' not found in dim_date"),
    ]
    reason = F.coalesce(
        *[
            F.when(
                broken,
                F.concat(F.lit(a), _shown(F.col(c).cast("string")), F.lit(b)) if c else F.lit(a),
            )
            for broken, a, c, b in rules
        ]
    )
    types = dict(keyed.dtypes)

    def whole(name: str) -> Column:
        c = F.col(name)
        return extract_number(c) if types[name] == "string" else c.try_cast("int")

    delay = F.coalesce(whole("delay_days"), F.lit(missing_delay).cast("int"))
    return keyed.withColumns(
        {"reason": reason, "estimated_arrival_days": whole("estimated_arrival_days"), "__delay": delay}
    )


def upsert_orders(current: DataFrame, offered: DataFrame) -> DataFrame:
    """Known orders keep their keys; only the two day counts are overwritten.

    Within one batch the keys come from the first row of an order and the day
    counts from the last.
    """
    keys = ["user_sk", "merchant_sk", "staff_sk", "transaction_date_sk"]
    counts = ["estimated_arrival_days", "delay_days"]
    batch = offered.groupBy("order_id").agg(
        *[F.min_by(k, "__seq").alias(f"__{k}") for k in keys],
        *[F.max_by(c, "__seq").alias(f"__{c}") for c in counts],
        F.lit(True).alias("__hit"),
    )
    merged = current.join(batch, "order_id", "full")
    return merged.select(
        "order_id",
        *[F.coalesce(F.col(k), F.col(f"__{k}")).alias(k) for k in keys],
        *[F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) for c in counts],
    ).select(*[F.col(f.name).cast(f.dataType) for f in schemas.warehouse_schema("fact_orders").fields])


def load_orders(
    current: DataFrame,
    orders: DataFrame,
    order_merchants: DataFrame,
    delays: DataFrame | None,
    dims: dict[str, DataFrame],
    missing_delay: int | None = 0,
    stage: Stage = lambda df, label: df,
) -> Load:
    judged = judge_orders(
        combine_orders(orders, order_merchants, delays),
        dims["dim_user"],
        dims["dim_merchant"],
        dims["dim_staff"],
        dims["dim_date"],
        missing_delay,
    )
    judged = stage(judged, "judged_orders")
    raw = [c for c in orders.columns if c not in schemas.LINEAGE and c != "staff_id"]
    rejects = _rejects(
        _per_delay(judged.filter(F.col("reason").isNotNull()), delays),
        "reject_fact_orders",
        ["order_id", "user_id", "merchant_id", "staff_id", "transaction_date"],
        raw + ["merchant_id", "staff_id", "delay_days"],
    )
    offered = judged.filter(F.col("reason").isNull()).select(
        "order_id",
        "user_sk",
        "merchant_sk",
        "staff_sk",
        "transaction_date_sk",
        "estimated_arrival_days",
        F.col("__delay").alias("delay_days"),
        F.lit(0).alias("__seq"),
    )
    return Load(upsert_orders(current, offered), rejects, offered)


def load_orders_set_based(
    current: DataFrame,
    orders: DataFrame,
    order_merchants: DataFrame,
    delays: DataFrame,
    dims: dict[str, DataFrame],
) -> DataFrame:
    """Older rule set: rows that miss a partner vanish silently, a known order
    is left alone, and an absent delay stays NULL."""
    od = orders.filter(
        F.col("order_id").isNotNull() & F.col("user_id").isNotNull() & F.col("transaction_date").isNotNull()
    ).select("order_id", "user_id", F.to_date("transaction_date").alias("date"), "estimated_arrival_days")
    om = order_merchants.filter(
        F.col("order_id").isNotNull() & F.col("merchant_id").isNotNull() & F.col("staff_id").isNotNull()
    ).select("order_id", "merchant_id", "staff_id")
    rows = (
        od.join(om, "order_id")
        .join(delays.select("order_id", "delay_days"), "order_id", "left")
        .join(key_map(dims["dim_user"], "dim_user"), "user_id")
        .join(key_map(dims["dim_merchant"], "dim_merchant"), "merchant_id")
        .join(key_map(dims["dim_staff"], "dim_staff"), "staff_id")
        .join(dims["dim_date"].select("date", F.col("date_sk").alias("transaction_date_sk")), "date")
    )
    # which of several rows of one order enters is not defined; the smallest does
    values = F.struct(
        "user_sk", "merchant_sk", "staff_sk", "transaction_date_sk", "estimated_arrival_days", "delay_days"
    )
    one = rows.groupBy("order_id").agg(F.min(values).alias("v")).select("order_id", "v.*")
    fresh = one.join(current.select("order_id"), "order_id", "left_anti")
    return current.unionByName(fresh.select(*current.columns))


# --- line items ---------------------------------------------------------------

# Rows of one order, of both feeds, that one task may hold in any case.
LARGE_ORDER = 100_000
# Orders are counted in so many groups first; only where a group has more rows than that, one by one.
ORDER_GROUPS = 1 << 16


def _price_columns(prices: DataFrame) -> DataFrame:
    return prices.select(
        F.col("order_id").alias("__price_order"),
        F.col("line_item_id").alias("__price_line"),
        "price",
        "quantity",
        "__position",
    )


def zip_by_position(products: DataFrame, prices: DataFrame) -> DataFrame:
    """n-th product row with n-th price row of the whole feed.

    The longer feed is cut to the length of the shorter one.  The order id is
    that of the product row, the line id that of the price row.
    """
    left = with_global_position(products.drop("line_item_id"), name="__position")
    right = _price_columns(with_global_position(prices, name="__position"))
    return (
        left.join(right, "__position", "inner")
        .withColumnRenamed("__price_line", "line_item_id")
        .drop("__position", "__price_order")
    )


def zip_by_order(products: DataFrame, prices: DataFrame, stage: Stage = lambda df, label: df) -> DataFrame:
    """n-th product of an order with the n-th price of that order."""
    left = with_group_position(
        products.filter(F.col("order_id").isNotNull()).drop("line_item_id"), ["order_id"], name="__position", stage=stage
    )
    right = _price_columns(
        with_group_position(prices.filter(F.col("order_id").isNotNull()), ["order_id"], name="__position", stage=stage)
    ).withColumnRenamed("__price_order", "order_id")
    return (
        left.join(right, ["order_id", "__position"], "inner")
        .withColumnRenamed("__price_line", "line_item_id")
        .drop("__position")
    )


def has_large_orders(products: DataFrame, prices: DataFrame, rows: int) -> bool:
    """Whether any order has more than ``rows`` rows in the two feeds."""
    feeds = [feed.filter(F.col("order_id").isNotNull()).select(normalize_key(F.col("order_id")).alias("k")) for feed in (products, prices)]
    keys = feeds[0].unionByName(feeds[1])

    def any_large(by: Column) -> bool:
        return not keys.groupBy(by.alias("by")).agg(F.count("*").alias("n")).filter(F.col("n") > rows).isEmpty()

    return any_large(F.pmod(F.xxhash64("k"), F.lit(ORDER_GROUPS))) and any_large(F.col("k"))


def zip_in_place(products: DataFrame, prices: DataFrame) -> DataFrame:
    """As ``zip_by_order``, through one shuffle of both feeds by ``__key``, the compared form of the
    order id: what follows by order finds its rows in place.  An order is one task's work.

    The order id as it was written is kept as ``__written`` only where it is not its compared form.
    """
    first = products.filter(F.col("order_id").isNotNull()).drop("line_item_id")
    second = _price_columns(prices.filter(F.col("order_id").isNotNull()).withColumn("__position", F.col("ingest_seq")))
    own = [c for c in first.columns if c != "order_id"]
    key, order = normalize_key(F.col("order_id")), ["__key", "__written"]
    keys = [key.alias("__key"), F.nullif(F.col("order_id"), key).alias("__written")]
    taken = ["__price_line", "price", "quantity"]
    rows = first.select(
        *keys, F.col("ingest_seq").alias("__seq"), F.lit(0).alias("__feed"), *own
    ).unionByName(
        second.withColumnRenamed("__price_order", "order_id").select(
            *keys,
            F.col("__position").alias("__seq"),
            F.lit(1).alias("__feed"),
            F.struct(*taken).alias("__offer"),
        ),
        allowMissingColumns=True,
    )
    placed = rows.repartition("__key").withColumn(
        "__position", F.row_number().over(Window.partitionBy(*order, "__feed").orderBy("__seq"))
    )
    pairs = Window.partitionBy(*order).orderBy("__position", "__feed")
    met = F.when(F.lead("__position").over(pairs) == F.col("__position"), F.lead("__offer").over(pairs))
    return (
        placed.withColumn("__met", met)
        .filter((F.col("__feed") == 0) & F.col("__met").isNotNull())
        .select("__key", *own, F.col("__met.__price_line").alias("line_item_id"), "__met.price", "__met.quantity")
    )


def with_product_keys(products: DataFrame, dim_product: DataFrame, members: int) -> DataFrame:
    """Product rows with ``product_sk``, looked up while they are narrow.  The dimension must name a product once."""
    known = hashed(key_map(dim_product, "dim_product"), members)
    return products.withColumn("product_id", normalize_key(F.col("product_id"))).join(known, "product_id", "left")


def judge_line_items(combined: DataFrame, dim_product: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """Look up the keys and name the first rule a row breaks.

    Of rows from ``zip_in_place`` ``__first`` says whether a row is the first of its (order, product): all of these
    are judged alike, so the first of those that pass is known before the products are looked up.  Rows that
    bring a ``product_sk`` have been looked up.
    """
    in_place = "__key" in combined.columns
    keyed = combined.withColumns(
        {
            "product_id": normalize_key(F.col("product_id")),
            "order_id": F.col("__key") if in_place else normalize_key(F.col("order_id")),
        }
    ).drop("__key")
    orders, known = order_keys(fact_orders), key_map(dim_product, "dim_product")
    if in_place:
        keyed = keyed.join(orders, "order_id", "left")
        rest = ["user_sk", "merchant_sk", "staff_sk", "transaction_date_sk", F.col("price").cast("decimal(10,2)"), _line_quantity(keyed), "ingest_seq"]
        placed = Window.partitionBy("order_id").orderBy("product_id", "ingest_seq", F.xxhash64(*rest))
        again = (F.row_number().over(placed) > 1) & F.lag("product_id").over(placed).eqNullSafe(F.col("product_id"))
        keyed = keyed.withColumn("__first", ~again)
        if "product_sk" not in keyed.columns:
            keyed = keyed.join(known, "product_id", "left")
    else:
        keyed = keyed.join(known, "product_id", "left").join(orders, "order_id", "left")
    reason = F.coalesce(
        F.when(_missing_text(F.col("product_id")), F.lit("product_id is NULL")),
        F.when(
            F.col("product_sk").isNull(),
            F.concat(F.lit("product_id '"), F.col("product_id"), F.lit("' not found in dim_product")),
        ),
        F.when(
            F.col("user_sk").isNull(),
            F.concat(F.lit("order_id '"), _shown(F.col("order_id")), F.lit("' not found in fact_orders")),
        ),
    )
    return keyed.withColumns({"reason": reason, "__quantity": _line_quantity(keyed)})


def _line_quantity(lines: DataFrame) -> Column:
    quantity = F.col("quantity")
    if dict(lines.dtypes)["quantity"] == "string":
        quantity = extract_number(quantity)
    return F.coalesce(quantity.try_cast("int"), F.lit(0))


def load_line_items(
    current: DataFrame,
    prices: DataFrame,
    products: DataFrame,
    dim_product: DataFrame,
    fact_orders: DataFrame,
    pairing: str = "position",
    stage: Stage = lambda df, label: df,
    large_order: int = LARGE_ORDER,
) -> Load:
    """``pairing``: ``position`` over the whole feed, or ``order`` within each order.

    The second gives the same rows where both feeds list the same orders in
    the same sequence, and needs no agreement between files.  Where an order
    has more than ``large_order`` rows, orders are spread over tasks, at the
    price of more shuffles.
    """
    if pairing == "position":
        combined = zip_by_position(products, prices)
    elif has_large_orders(products, prices, large_order):
        combined = zip_by_order(products, prices, stage)
    else:
        named = dim_product.filter(F.col("product_id").isNotNull()).groupBy("product_id").agg(F.count("*").alias("n"))
        members, most = named.agg(F.count("*"), F.max("n")).first()
        if members == 0 or most == 1:
            products = with_product_keys(products, dim_product, members)
        combined = zip_in_place(products, prices)
    judged = judge_line_items(combined, dim_product, fact_orders)
    # what only a reject shows is not kept of the rows that pass
    shown = [c for c in ("product_id", "line_item_id", "file_source", "quantity") if c in judged.columns]
    judged = stage(
        judged.withColumns({c: F.when(F.col("reason").isNotNull(), F.col(c)) for c in shown}), "judged_line_items"
    )
    rejects = _rejects(
        judged,
        "reject_fact_line_items",
        ["order_id", "product_id", "line_item_id"],
        ["order_id", "product_id", "line_item_id", "price", "quantity"],
    )
    columns = [
        "order_id",
        "product_sk",
        "user_sk",
        "merchant_sk",
        "staff_sk",
        "transaction_date_sk",
        F.col("price").cast("decimal(10,2)").alias("price"),
        F.col("__quantity").alias("quantity"),
        "ingest_seq",
    ]
    passed = judged.filter(F.col("reason").isNull())
    offered, pair = passed.select(*columns), ["order_id", "product_sk"]
    if "__first" in judged.columns:
        first = passed.filter("__first").select(*columns)
        fresh = first.join(current.select(*pair), pair, "left_anti").select(*current.columns)
    else:
        fresh = insert_or_ignore(current, offered, pair)
    return Load(current.unionByName(fresh), rejects, offered, fresh)


def load_line_items_set_based(
    current: DataFrame,
    prices: DataFrame,
    products: DataFrame,
    dim_product: DataFrame,
    fact_orders: DataFrame,
    stage: Stage = lambda df, label: df,
) -> DataFrame:
    """Older rule set: inner joins only, no rejects, NULL quantities kept."""
    rows = (
        zip_by_order(products.filter(F.col("product_id").isNotNull()), prices, stage)
        .join(key_map(dim_product, "dim_product"), "product_id")
        .join(order_keys(fact_orders), "order_id")
        .select(*current.columns, "ingest_seq")
    )
    return current.unionByName(insert_or_ignore(current, rows, ["order_id", "product_sk"]))


# --- campaign transactions ----------------------------------------------------

CAMPAIGN_FACT_KEY = ["campaign_sk", "user_sk", "merchant_sk", "transaction_date_sk"]


def _unknown_key(dim_campaign: DataFrame) -> DataFrame:
    """Surrogate key of the UNKNOWN member: always one row, NULL if it is missing."""
    return dim_campaign.filter(F.col("campaign_id") == UNKNOWN_CAMPAIGN).agg(
        F.max("campaign_sk").alias("__unknown_sk")
    )


def judge_campaign_transactions(
    transactions: DataFrame, dim_campaign: DataFrame, fact_orders: DataFrame
) -> DataFrame:
    keyed = (
        transactions.withColumns(
            {
                "campaign_id": normalize_key(F.col("campaign_id")),
                "order_id": normalize_key(F.col("order_id")),
            }
        )
        .join(
            dim_campaign.select("campaign_id", F.col("campaign_sk").alias("__known_sk")), "campaign_id", "left"
        )
        .crossJoin(_unknown_key(dim_campaign))  # one row
        .join(order_keys(fact_orders).drop("staff_sk"), "order_id", "left")
    )
    campaign_sk = F.coalesce(F.col("__known_sk"), F.col("__unknown_sk"))
    reason = F.coalesce(
        F.when(
            campaign_sk.isNull() & _missing_text(F.col("campaign_id")),
            F.lit("campaign_id is NULL and Unknown campaign not available"),
        ),
        F.when(
            campaign_sk.isNull(),
            F.concat(
                F.lit("campaign_id '"),
                F.col("campaign_id"),
                F.lit("' not found in dim_campaign and Unknown campaign not available"),
            ),
        ),
        F.when(
            F.col("user_sk").isNull(),
            F.concat(F.lit("order_id '"), _shown(F.col("order_id")), F.lit("' not found in fact_orders")),
        ),
    )
    return keyed.withColumns({"campaign_sk": campaign_sk, "reason": reason})


def load_campaign_transactions(
    current: DataFrame,
    transactions: DataFrame,
    dim_campaign: DataFrame,
    fact_orders: DataFrame,
    stage: Stage = lambda df, label: df,
) -> Load:
    """A campaign that is not known goes to the UNKNOWN member.

    The key has no order id: a second order of one user at one merchant on one
    day under one campaign is ignored.
    """
    judged = stage(
        judge_campaign_transactions(transactions, dim_campaign, fact_orders), "judged_campaign_transactions"
    )
    rejects = _rejects(
        judged,
        "reject_fact_campaign_transactions",
        ["order_id", "user_id", "campaign_id", "transaction_date"],
        [c for c in transactions.columns if c not in schemas.LINEAGE],
    )
    offered = judged.filter(F.col("reason").isNull()).select(*current.columns, "ingest_seq")
    fresh = insert_or_ignore(current, offered, CAMPAIGN_FACT_KEY)
    return Load(current.unionByName(fresh), rejects, offered, fresh)


def load_campaign_transactions_set_based(
    current: DataFrame,
    transactions: DataFrame,
    dim_campaign: DataFrame,
    dim_date: DataFrame,
    fact_orders: DataFrame,
) -> DataFrame:
    """Older rule set: unknown campaigns vanish, and the transaction date must
    be the date of the order."""
    dated = (
        transactions.filter(F.col("order_id").isNotNull() & F.col("campaign_id").isNotNull())
        .join(key_map(dim_campaign, "dim_campaign"), "campaign_id")
        .withColumn("date", F.to_date("transaction_date"))
        .join(dim_date.select("date", F.col("date_sk").alias("transaction_date_sk")), "date")
    )
    rows = dated.join(order_keys(fact_orders), ["order_id", "transaction_date_sk"]).select(
        *current.columns, "ingest_seq"
    )
    return current.unionByName(insert_or_ignore(current, rows, CAMPAIGN_FACT_KEY))


def campaign_moves(fact: DataFrame, dim_campaign: DataFrame, staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows on UNKNOWN whose campaign has arrived since, with ``__new_sk``.

    An order staged with several campaigns takes the smallest id.  A move onto
    a key that is taken is not made: the row stays on UNKNOWN.  Of several
    rows that would move onto one free key, the smallest order id moves.
    Returns the moves and a one-row count of moved and held-back rows.
    """
    campaign_of_order = (
        staged.withColumns(
            {
                "order_id": normalize_key(F.col("order_id")),
                "campaign_id": normalize_key(F.col("campaign_id")),
            }
        )
        .filter((F.length("campaign_id") > 0) & (F.length("order_id") > 0))
        .groupBy("order_id")
        .agg(F.min("campaign_id").alias("campaign_id"))
    )
    arrived = dim_campaign.filter(F.col("campaign_id") != UNKNOWN_CAMPAIGN).select(
        "campaign_id", F.col("campaign_sk").alias("__new_sk")
    )
    # one row, so the hot UNKNOWN key is compared where it lies, not shuffled
    open_rows = fact.crossJoin(_unknown_key(dim_campaign)).filter(F.col("campaign_sk") == F.col("__unknown_sk"))
    moves = open_rows.join(campaign_of_order.join(arrived, "campaign_id"), "order_id").select(
        *fact.columns, "__new_sk"
    )
    target = ["__new_sk", "user_sk", "merchant_sk", "transaction_date_sk"]
    # one move per target key, and none onto a key that is taken
    chosen = first_per_key(moves, target, "order_id")
    taken = fact.select(F.col("campaign_sk").alias("__new_sk"), *target[1:])
    chosen = chosen.join(taken, target, "left_anti")
    counts = (
        moves.agg(F.count("*").alias("__candidates"))
        .crossJoin(chosen.agg(F.count("*").alias("moved")))
        .select("moved", (F.col("__candidates") - F.col("moved")).alias("held_back"))
    )
    return chosen, counts


def apply_campaign_moves(fact: DataFrame, moves: DataFrame) -> DataFrame:
    moved_keys = moves.select(*CAMPAIGN_FACT_KEY, "__new_sk")
    return fact.join(moved_keys, CAMPAIGN_FACT_KEY, "left").select(
        *[
            F.coalesce(F.col("__new_sk"), F.col("campaign_sk")).alias("campaign_sk") if c == "campaign_sk" else F.col(c)
            for c in fact.columns
        ]
    )


def rekey_late_campaigns(
    fact: DataFrame, dim_campaign: DataFrame, staged: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """``campaign_moves`` made: the new table, and the counts."""
    moves, counts = campaign_moves(fact, dim_campaign, staged)
    return apply_campaign_moves(fact, moves), counts
