"""Data-quality checks on the star and reconciliation of staging with facts.

All checks give rows; none raises.
"""

from __future__ import annotations

import datetime as dt
from collections import ChainMap
from typing import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.operators import relational as rel
from tallyhouse.operators.keys import Stage
from tallyhouse.plans.views import (
    Star,
    merchant_performance,
    percent,
    priced_lines,
    ratio,
    sales_by_time,
)

# --- fixed values -----------------------------------------------------------
# (table, column, referenced table, referenced column)
REFERENCES = [
    ("fact_orders", "user_sk", "dim_user", "user_sk"),
    ("fact_orders", "merchant_sk", "dim_merchant", "merchant_sk"),
    ("fact_orders", "staff_sk", "dim_staff", "staff_sk"),
    ("fact_orders", "transaction_date_sk", "dim_date", "date_sk"),
    ("fact_line_items", "product_sk", "dim_product", "product_sk"),
    ("fact_line_items", "order_id", "fact_orders", "order_id"),
    ("fact_campaign_transactions", "campaign_sk", "dim_campaign", "campaign_sk"),
    ("fact_campaign_transactions", "order_id", "fact_orders", "order_id"),
    ("dim_user_job", "user_id", "dim_user", "user_id"),
    ("dim_credit_card", "user_id", "dim_user", "user_id"),
]
CRITICAL_COLUMNS = {
    "fact_orders": ["order_id", "user_sk", "merchant_sk", "staff_sk", "transaction_date_sk"],
    "fact_line_items": [
        "order_id",
        "product_sk",
        "user_sk",
        "merchant_sk",
        "staff_sk",
        "transaction_date_sk",
        "price",
        "quantity",
    ],
    "fact_campaign_transactions": ["order_id", "campaign_sk", "user_sk", "merchant_sk", "transaction_date_sk"],
    "dim_user": ["user_sk", "user_id"],
    "dim_product": ["product_sk", "product_id"],
}
UNIQUE_KEYS = [("fact_orders", "order_id"), ("dim_user", "user_id"), ("dim_product", "product_id")]
# (check, table, condition that must not hold)
RANGES = [
    ("Negative prices in fact_line_items", "fact_line_items", "price < 0"),
    ("Negative quantities in fact_line_items", "fact_line_items", "quantity < 0"),
    ("Invalid discount values (>100%)", "dim_campaign", "discount > 100"),
    ("Invalid availed flag (not 0 or 1)", "fact_campaign_transactions", "availed NOT IN (0, 1)"),
    ("Negative delay_days", "fact_orders", "delay_days < 0"),
    ("Negative estimated_arrival_days", "fact_orders", "estimated_arrival_days < 0"),
    ("Negative price", "dim_product", "price < 0"),
]
COUNTED_TABLES = [
    "dim_campaign",
    "dim_product",
    "dim_user",
    "dim_staff",
    "dim_merchant",
    "dim_date",
    "dim_user_job",
    "dim_credit_card",
    "fact_orders",
    "fact_line_items",
    "fact_campaign_transactions",
]
# --- end of fixed values ----------------------------------------------------


def referential(star: Star, skip_null: bool = False) -> DataFrame:
    """Rows whose key points nowhere, per reference.

    Keys are counted before they are looked up, so a hot key is one row by the
    time it is shuffled.  A NULL key counts as a violation unless skipped.
    """
    checks = []
    for table, column, target, target_column in REFERENCES:
        if table not in star or target not in star:
            continue
        keys = star[table].select(F.col(column).alias("__key"))
        if skip_null:
            keys = keys.filter(F.col("__key").isNotNull())
        counted = keys.groupBy("__key").agg(F.count("*").alias("__n"))
        known = star[target].select(F.col(target_column).alias("__key"))
        checks.append(
            counted.join(known, "__key", "left_anti").agg(
                F.lit(f"{table}.{column} references {target}").alias("check"),
                F.coalesce(F.sum("__n"), F.lit(0)).alias("violations"),
            )
        )
    return rel.union_all(checks)


def null_counts(star: Star) -> DataFrame:
    """NULLs in the columns that must have a value; one pass per table."""
    out = []
    for table, columns in CRITICAL_COLUMNS.items():
        if table not in star:
            continue
        counts = star[table].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        out.append(counts.unpivot([], columns, "column", "nulls").select(F.lit(table).alias("table"), "column", "nulls"))
    return rel.union_all(out)


def duplicate_keys(star: Star) -> DataFrame:
    return rel.union_all(
        [
            rel.repeated(star[t], [key]).agg(
                F.lit(f"Duplicate {key} in {t}").alias("check"), F.count("*").alias("violations")
            )
            for t, key in UNIQUE_KEYS
            if t in star
        ]
    )


def range_violations(star: Star) -> DataFrame:
    """All range rules of a table in one pass."""
    out = []
    for table in dict.fromkeys(t for _, t, _ in RANGES):
        if table not in star:
            continue
        rules = [(name, cond) for name, t, cond in RANGES if t == table]
        counts = star[table].agg(*[F.count_if(F.expr(cond)).alias(name) for name, cond in rules])
        out.append(counts.unpivot([], [f"`{n}`" for n, _ in rules], "check", "violations"))
    return rel.union_all(out)


def row_counts(star: Star) -> DataFrame:
    return rel.union_all(
        [
            star[t].agg(F.lit(t).alias("table"), F.count("*").alias("records"))
            for t in COUNTED_TABLES
            if t in star
        ]
    )


def counts_by_table(star: Star) -> DataFrame:
    """``kind, name, value`` of NULLs, ranges and rows: one aggregate, and so one scan, a table."""
    out = []
    for table in dict.fromkeys([*CRITICAL_COLUMNS, *[t for _, t, _ in RANGES], *COUNTED_TABLES]):
        if table not in star:
            continue
        measures = [("nulls", f"{table}.{c}", F.count_if(F.col(c).isNull())) for c in CRITICAL_COLUMNS.get(table, [])]
        measures += [("ranges", name, F.count_if(F.expr(cond))) for name, t, cond in RANGES if t == table]
        measures += [("rows", table, F.count("*"))] if table in COUNTED_TABLES else []
        counts = star[table].agg(*[m.alias(f"m{k}") for k, (_, _, m) in enumerate(measures)])
        each = [F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("name"), F.col(f"m{k}").alias("value")) for k, (kind, name, _) in enumerate(measures)]
        out.append(counts.select(F.inline(F.array(*each))))
    return rel.union_all(out)


def stacked_references(star: Star) -> DataFrame:
    """``check, violations`` of all references: the keys of a table are counted in one scan of it, and
    looked up in one join against the keys of all targets."""
    used = [r for r in REFERENCES if r[0] in star and r[2] in star]
    targets = list(dict.fromkeys(r[2:] for r in used))
    counted = []
    for table in dict.fromkeys(r[0] for r in used):
        keys = [
            F.struct(F.lit(k).alias("ref"), F.lit(targets.index(r[2:])).alias("target"), F.col(r[1]).cast("string").alias("key"))
            for k, r in enumerate(used)
            if r[0] == table
        ]
        counted.append(star[table].select(F.inline(F.array(*keys))).groupBy("ref", "target", "key").agg(F.count("*").alias("n")))
    known = [star[t].select(F.lit(k).alias("target"), F.col(c).cast("string").alias("key")) for k, (t, c) in enumerate(targets)]
    astray = rel.union_all(counted).join(rel.union_all(known), ["target", "key"], "left_anti").groupBy("ref").agg(F.sum("n").alias("n"))
    names = [F.struct(F.lit(k).alias("ref"), F.lit(f"{t}.{c} references {target}").alias("check")) for k, (t, c, target, _) in enumerate(used)]
    checks = counted[0].sparkSession.range(1).select(F.inline(F.array(*names)))
    return checks.join(astray, "ref", "left").select("check", F.coalesce("n", F.lit(0)).alias("violations"))


def report(star: Star) -> DataFrame:
    """Every check in one table: kind, name, value and whether it passed."""
    counts = counts_by_table(star)
    for kind, df in (("references", stacked_references(star)), ("duplicates", duplicate_keys(star))):
        counts = counts.unionByName(df.select(F.lit(kind).alias("kind"), F.col("check").alias("name"), F.col("violations").alias("value")))
    passed = F.when(F.col("kind") == "rows", "INFO").when(F.col("value") == 0, "PASSED").otherwise("FAILED")
    return counts.select("kind", "name", "value", passed.alias("status"))


# --- duplicate (order, product) pairs ------------------------------------------

PAIR = ["order_id", "product_id"]


def repeated_pairs(line_products: DataFrame, top: int | None = 20, stage: Stage = lambda df, label: df) -> DataFrame:
    """Pairs staged more than once, with their files and first and last load.

    The pairs are found (and cut to ``top``) before any file names are put
    together.  Where ``stage`` writes them, their size is known by then: few
    are broadcast, and the lines are not shuffled a second time.
    """
    lines = line_products.filter(F.col("product_id").isNotNull())
    pairs = (
        lines.groupBy(*PAIR)
        .agg(
            F.count("*").alias("occurrence_count"),
            F.min("loaded_at").alias("first_seen"),
            F.max("loaded_at").alias("last_seen"),
        )
        .filter(F.col("occurrence_count") > 1)
    )
    if top is not None:
        pairs = pairs.orderBy(F.desc("occurrence_count"), *PAIR).limit(top)
    pairs = stage(pairs, "repeated_pairs")
    named = lines.join(pairs.select(*PAIR), PAIR, "left_semi")
    return pairs.join(rel.joined_text(named, PAIR, "file_source", "source_files"), PAIR, "left").select(
        *PAIR, "occurrence_count", "source_files", "first_seen", "last_seen"
    )


def staged_pair_totals(line_products: DataFrame) -> DataFrame:
    counts = line_products.filter(F.col("product_id").isNotNull()).agg(
        F.count("*").alias("total_rows"), rel.count_tuples(*PAIR).alias("unique_combinations")
    )
    dup = F.col("total_rows") - F.col("unique_combinations")
    return counts.withColumns(
        {"duplicate_rows": dup, "duplicate_percentage": percent(dup, F.col("total_rows"))}
    )


def staged_pairs_by_file(line_products: DataFrame) -> DataFrame:
    """Pairs are reduced per file first, so a large file is spread by pair."""
    per_pair = (
        line_products.filter(F.col("product_id").isNotNull())
        .groupBy("file_source", *PAIR)
        .agg(F.count("*").alias("n"))
    )
    dup = F.col("total_rows") - F.col("unique_combinations")
    return (
        per_pair.groupBy("file_source")
        .agg(F.sum("n").alias("total_rows"), F.count("*").alias("unique_combinations"))
        .withColumns({"duplicate_rows": dup, "duplicate_percentage": percent(dup, F.col("total_rows"))})
        .filter(F.col("duplicate_rows") > 0)
        .orderBy(F.desc("duplicate_rows"))
    )


def _with_product_sk(line_products: DataFrame, star: Star) -> DataFrame:
    return line_products.filter(F.col("product_id").isNotNull()).join(
        star["dim_product"].select("product_id", "product_sk"), "product_id"
    )


def would_conflict(line_products: DataFrame, star: Star) -> DataFrame:
    """Staged rows whose pair is in the fact table already."""
    pairs = star["fact_line_items"].select("order_id", "product_sk")
    return _with_product_sk(line_products, star).join(pairs, ["order_id", "product_sk"], "left_semi")


def conflict_counts(line_products: DataFrame, star: Star) -> DataFrame:
    """The counts of ``staged_pair_totals``, of ``would_conflict`` and of the fact's pairs, as one row.

    Staged rows are counted by pair, each pair is joined with its product, and then it meets the fact's rows by
    (order, product key) in one aggregate.  Where a product comes with several keys, its pairs are counted at the
    first of them, and each key may conflict.
    """
    places = Window.partitionBy("product_id").orderBy("product_sk")
    products = star["dim_product"].select("product_id", "product_sk").withColumn("__lead", F.row_number().over(places) == 1)
    products = rel.hashed(products, star["dim_product"].count())
    known = line_products.filter(F.col("product_id").isNotNull()).select(*PAIR).join(products, "product_id", "left")
    pairs = known.groupBy(*PAIR, "product_sk", F.coalesce("__lead", F.lit(True)).alias("__lead")).agg(F.count("*").alias("n"))
    none, by = F.lit(0).cast("bigint"), ["order_id", "product_sk"]
    staged = pairs.select(
        *by, "n", F.when(F.col("__lead"), F.col("n")).otherwise(none).alias("rows"), F.col("__lead").cast("bigint").alias("pairs"), none.alias("loaded")
    )
    loaded = star["fact_line_items"].select(*by, none.alias("n"), none.alias("rows"), none.alias("pairs"), F.lit(1).cast("bigint").alias("loaded"))
    met = staged.unionByName(loaded).groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("n", "rows", "pairs", "loaded")])
    conflict = (F.col("loaded") > 0) & F.col("order_id").isNotNull() & F.col("product_sk").isNotNull()
    counts = {
        "total_rows": F.sum("rows"),
        "unique_combinations": F.sum("pairs"),
        "fact_rows": F.sum("loaded"),
        "unique_in_fact": F.count_if(F.col("loaded") > 0),
        "would_conflict": F.sum(F.when(conflict, F.col("n"))),
    }
    return met.agg(*[F.coalesce(c, none).alias(name) for name, c in counts.items()])


def conflict_summary(line_products: DataFrame, star: Star) -> DataFrame:
    one = conflict_counts(line_products, star)
    duplicates = F.col("total_rows") - F.col("unique_combinations")
    total = F.col("would_conflict") + duplicates
    return one.select(
        F.col("unique_combinations").alias("unique_in_staging"),
        "fact_rows",
        "unique_in_fact",
        (F.col("fact_rows") - F.col("unique_in_fact")).alias("duplicates_in_fact"),
        (F.col("unique_combinations") - F.col("fact_rows")).alias("difference"),
        F.when(
            F.col("unique_combinations") > F.col("fact_rows"), "More in staging (some rows not loaded or conflicted)"
        )
        .when(F.col("unique_combinations") == F.col("fact_rows"), "Match (all unique staging rows loaded)")
        .otherwise("More in fact (unexpected - check for issues)")
        .alias("status"),
        "would_conflict",
        duplicates.alias("duplicates_in_staging"),
        total.alias("total_conflicts"),
        percent(total, F.col("unique_combinations")).alias("conflict_percentage"),
    )


def conflict_sample(line_products: DataFrame, star: Star, n: int = 20, stage: Stage = lambda df, label: df) -> DataFrame:
    """Some rows an insert would skip, and why; ordered so that it repeats."""
    rows = _with_product_sk(line_products, star)
    loaded = star["fact_line_items"].select("order_id", "product_sk", F.lit(True).alias("loaded"))
    twice = stage(rel.repeated(line_products.filter(F.col("product_id").isNotNull()), PAIR), "repeated_pairs").select(
        *PAIR, F.lit(True).alias("twice")
    )
    return (
        rows.join(loaded, ["order_id", "product_sk"], "left")
        .join(twice, PAIR, "left")
        .filter(F.coalesce(F.col("loaded"), F.col("twice"), F.lit(False)))
        .select(
            *PAIR,
            "product_sk",
            "file_source",
            F.when(F.col("loaded"), "Already in fact_line_items").otherwise("Duplicate in staging").alias("conflict_reason"),
        )
        .orderBy(*PAIR, "file_source")
        .limit(n)
    )


# --- staging against facts -----------------------------------------------------


def line_item_gap(prices: DataFrame, products: DataFrame, star: Star) -> DataFrame:
    """Where staged line items went, one measure per row."""
    fact = star["fact_line_items"]
    pairs = fact.groupBy("order_id", "product_sk").agg(F.count("*").alias("n"))
    fact_counts = pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("fact_rows"),
        F.count("*").alias("fact_pairs"),
        F.count_if(F.col("n") > 1).alias("repeated_pairs"),
    )
    lost_orders = rel.without_partner(prices.select("order_id").distinct(), star["fact_orders"], "order_id")
    lost_products = rel.orphans(products, star["dim_product"], "product_id")
    one = rel.side_by_side(
        prices.agg(F.count("*").alias("staged_prices")),
        products.agg(F.count("*").alias("staged_products")),
        fact_counts,
        lost_orders.agg(F.count("*").alias("orders_not_loaded")),
        lost_products.agg(F.count("*").alias("lines_with_unknown_product")),
        star["reject_fact_line_items"].agg(F.count("*").alias("rejected")),
    ).withColumns(
        {
            "duplicate_rows": F.col("fact_rows") - F.col("fact_pairs"),
            "staged_minus_fact": F.col("staged_prices") - F.col("fact_rows"),
            # every staged row is loaded, rejected or ignored as a repeat
            "ignored_as_repeat": F.least("staged_prices", "staged_products") - F.col("fact_rows") - F.col("rejected"),
        }
    )
    measures = one.columns
    return one.select(*[F.col(c).cast("bigint") for c in measures]).unpivot([], measures, "metric", "value")


def repeated_fact_pairs(star: Star, top: int = 20) -> DataFrame:
    return (
        rel.repeated(star["fact_line_items"], ["order_id", "product_sk"])
        .orderBy(F.desc("occurrences"), "order_id", "product_sk")
        .limit(top)
    )


def members_in_use(
    dim: DataFrame, fact: DataFrame, ids: DataFrame, key: str, sk: str
) -> DataFrame:
    """For each id: is there a member, and does a fact row point at it?"""
    used = fact.select(sk).distinct().withColumn("__used", F.lit(True))
    members = dim.select(key, sk).join(used, sk, "left")
    return (
        ids.select(key)
        .distinct()
        .join(members, key, "left")
        .select(
            key,
            F.col(sk).isNotNull().alias("member_exists"),
            F.coalesce(F.col("__used"), F.lit(False)).alias("referenced"),
        )
    )


def merchants_without_orders(star: Star) -> DataFrame:
    return rel.without_partner(star["dim_merchant"], star["fact_orders"], "merchant_sk")


def merchant_gap(star: Star) -> DataFrame:
    view = merchant_performance(star).groupBy("merchant_id").agg(F.count("*").alias("n"))
    one = rel.side_by_side(
        star["dim_merchant"].agg(
            F.count("*").alias("total_in_dim"),
            (F.count("*") - F.count_distinct("merchant_id")).alias("duplicate_ids"),
        ),
        view.agg(
            F.count("merchant_id").alias("distinct_in_view"), F.count_if(F.col("n") > 1).alias("repeated_in_view")
        ),
        star["fact_orders"].agg(
            F.count("merchant_sk").alias("occurrences_in_facts"), F.count_distinct("merchant_sk").alias("distinct_in_facts")
        ),
        merchants_without_orders(star).agg(F.count("*").alias("without_orders")),
    )
    return one.withColumns(
        {
            "difference": F.col("total_in_dim") - F.col("distinct_in_view"),
            "validation": F.when(
                F.col("distinct_in_view") == F.col("distinct_in_facts"), "View matches fact_orders"
            ).otherwise("View count differs from fact_orders"),
        }
    )


def _of_days(star: Star, days: Column) -> Star:
    """The star with both facts cut to some days at their scans (lines carry the date of their order)."""
    return ChainMap({t: star[t].filter(days) for t in ("fact_orders", "fact_line_items")}, star)


def month_revenue(star: Star, year: int, month: int) -> DataFrame:
    """Revenue and orders of one month by three routes.

    The month is cut by its day keys, which prunes both facts at the scan.
    """
    first, after = year * 10000 + month * 100, year * 10000 + (month + 1) * 100
    in_month = (F.col("transaction_date_sk") > first) & (F.col("transaction_date_sk") < after)
    lines = priced_lines(star, "order_id", "transaction_date_sk").filter(in_month)
    direct = rel.side_by_side(
        lines.agg(F.sum("revenue").alias("total_revenue"), F.count_distinct("order_id").alias("orders_with_line_items")),
        star["fact_orders"].filter(in_month).agg(F.count("*").alias("total_orders")),
    ).select(F.lit("Direct from Facts").alias("source"), "total_revenue", "total_orders", "orders_with_line_items")
    days = sales_by_time(_of_days(star, in_month)).filter((F.col("year") == year) & (F.col("month") == month))
    daily = days.agg(
        F.lit("View (Sum of Daily)").alias("source"),
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_orders").alias("total_orders"),
    )
    monthly = (
        days.groupBy("year", "month")
        .agg(F.sum("total_revenue").alias("r"), F.sum("total_orders").alias("o"))
        .agg(F.lit("View (Monthly)").alias("source"), F.sum("r").alias("total_revenue"), F.sum("o").alias("total_orders"))
    )
    return rel.union_all([direct, daily, monthly])


def month_profile(star: Star, year: int, month: int) -> DataFrame:
    """Days of the month without or with zero revenue, and orders without lines."""
    first, after = year * 10000 + month * 100, year * 10000 + (month + 1) * 100
    in_month = (F.col("transaction_date_sk") > first) & (F.col("transaction_date_sk") < after)
    days = sales_by_time(_of_days(star, in_month)).filter((F.col("year") == year) & (F.col("month") == month))
    profile = days.agg(
        F.count("*").alias("days"),
        F.count_if(F.col("total_revenue").isNull()).alias("days_with_null_revenue"),
        F.count_if(F.col("total_revenue") == 0).alias("days_with_zero_revenue"),
        F.min("total_revenue").alias("min_daily_revenue"),
        F.max("total_revenue").alias("max_daily_revenue"),
        ratio(F.sum("total_revenue"), F.count("total_revenue")).alias("avg_daily_revenue"),
    )
    empty = rel.without_partner(
        star["fact_orders"].filter(in_month), star["fact_line_items"].filter(in_month), "order_id"
    )
    return rel.side_by_side(profile, empty.agg(F.count("*").alias("orders_without_line_items")))


def column_ready(df: DataFrame, column: str) -> DataFrame:
    """Is a column filled well enough for the loads that need it?"""
    counts = df.agg(F.count("*").alias("total"), F.count_if(F.col(column).isNull()).alias("missing"))
    return counts.select(
        "total",
        "missing",
        (F.col("total") - F.col("missing")).alias("filled"),
        F.when(F.col("total") == 0, "table is empty")
        .when(F.col("missing") == F.col("total"), "no row has a value")
        .when(F.col("missing") > 0, "some rows will be skipped")
        .otherwise("ready")
        .alias("verdict"),
    )


# --- before and after a load -----------------------------------------------------


def load_metrics(star: Star, date: dt.date | str | None = None) -> DataFrame:
    """(metric, value): fact row counts, and the day's KPI where a day is given."""
    from tallyhouse.plans.kpis import daily_sales

    parts = [
        star[t].agg(F.lit(f"{t}_count").alias("metric"), F.count("*").cast("decimal(38,2)").alias("value"))
        for t in ("fact_orders", "fact_line_items")
    ]
    if date is not None:
        kpi = daily_sales(star, date).select(
            F.col("order_count").cast("decimal(38,2)").alias("kpi_order_count"),
            F.col("total_sales").alias("kpi_total_sales"),
        )
        parts.append(kpi.unpivot([], kpi.columns, "metric", "value"))
    return rel.union_all(parts)


def metric_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    b = before.withColumnRenamed("value", "before")
    a = after.withColumnRenamed("value", "after")
    return b.join(a, "metric", "full").withColumn("change", F.col("after") - F.col("before"))


def expected_changes(changes: DataFrame, expected: Mapping[str, DataFrame], tolerance: float = 0.01) -> DataFrame:
    """Compare metric changes with one-value frames computed from the files."""
    wanted = rel.union_all(
        [
            df.select(F.lit(metric).alias("metric"), F.col(df.columns[0]).cast("decimal(38,2)").alias("expected"))
            for metric, df in expected.items()
        ]
    )
    return wanted.join(changes.select("metric", F.col("change").alias("actual")), "metric", "left").withColumn(
        "passed", F.coalesce(F.abs(F.col("actual") - F.col("expected")) <= tolerance, F.lit(False))
    )
