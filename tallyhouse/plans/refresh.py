"""The nightly load: find files, stage, dimensions, stubs, facts.

The order matters.  Users and products are stubbed before the facts, merchants
and staff never are, so an order of an unknown merchant is rejected.  Late
campaigns are re-keyed before campaign rows are loaded again, so that a replay
finds the rows it would insert already there.

Every step notes in the state of its table which states of its inputs it has
read.  A step whose inputs have not moved on is left out, so a second load of
the same files reads no staged row.  Orders are judged again only where a row
of theirs has come or gone since, or where they were rejected; of the facts only
files that hold such orders are read and written anew.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse import schemas
from tallyhouse.functions import normalize_key
from tallyhouse.operators import dimensions as dims
from tallyhouse.operators import facts
from tallyhouse.operators.keys import FILE_BITS
from tallyhouse.operators.relational import union_all
from tallyhouse.operators.staging import DIRECT_FORMATS, apply_formats, format_for_staging, transform
from tallyhouse.plans.store import Store
from tallyhouse.session import configure, materialize
from tallyhouse.sources import incremental
from tallyhouse.sources.discovery import DATASET_FILES, dataset_files, source_files
from tallyhouse.sources.readers import file_frames, unsupported

FACT_ORDER = ["transaction_date_sk", "order_id"]
DIM_FEEDS = {
    "dim_product": "product_list",
    "dim_user": "user_data",
    "dim_staff": "staff_data",
    "dim_merchant": "merchant_data",
}
# columns only the direct load keeps
DIRECT_COLUMNS = {"line_item_data_products": "product_name STRING", "transactional_campaign_data": "transaction_date STRING"}


def stage_files(
    spark: SparkSession, files, dataset: str, direct: bool = False, rejects: list[DataFrame] | None = None
) -> DataFrame | None:
    """Read, clean and format the files of a dataset, layout by layout."""
    extra = DIRECT_COLUMNS.get(dataset) if direct else None
    frames = [format_for_staging(df, dataset, extra) for df in file_frames(spark, files, rejects=rejects)]
    frames = [f for f in frames if f is not None]
    return union_all(frames) if frames else None


def ingest(
    spark: SparkSession,
    root: str,
    store: Store,
    dataset: str,
    force: bool = False,
    on_modified: str = "replace",
) -> DataFrame:
    """Stage the files that need it; returns the decision per file.

    A file that changed replaces its old rows; ``on_modified="append"`` keeps
    both.  Files are numbered after those staged before.
    """
    table = schemas.staging_table(dataset)
    known = materialize(store.sources(table), "staged-files")
    loads = known.select("file_source", F.col("last_loaded").alias("loaded_at"))
    staged = loads if store.exists(table) else None
    decisions = materialize(incremental.decide_files(dataset_files(spark, root, dataset), staged, force), "decisions")
    chosen = decisions.filter(F.col("decision") == "process")
    start = known.agg(F.max(F.shiftright("last_seq", FILE_BITS))).first()[0]
    files = source_files(chosen, 0 if start is None else start + 1)
    rejects: list[DataFrame] = []
    loaded = stage_files(spark, files, dataset, rejects=rejects) if files else None
    if loaded is not None:
        again = chosen.filter(F.col("reason").isin(incremental.MODIFIED, incremental.FORCED)).select(
            F.col("path").alias("file_source")
        )
        held = store.holding(table, again) if on_modified == "replace" and staged is not None else []
        if held:
            before = store.read_files(table, held)
            kept = before.join(again, "file_source", "left_anti").select(*before.columns)
            store.rewrite(table, held, kept.unionByName(loaded))
        else:
            store.append(table, loaded)
    if files:
        _record(store, dataset, chosen, files, start, rejects)
    return decisions.withColumn("dataset", F.lit(dataset))


def _keep_rejected(store: Store, dataset: str, rejects: list[DataFrame], again: bool = False) -> None:
    """Append rows that did not fit; with ``again``, those that an earlier load of the same files has
    not left there.  The number of a file may differ between loads, the place in it does not."""
    if not rejects:
        return
    found = union_all(rejects).withColumn("dataset", F.lit(dataset))
    if again and store.exists("rejected_rows"):
        place = F.col("ingest_seq").bitwiseAND(F.lit((1 << FILE_BITS) - 1))
        seen = store.read("rejected_rows").select("dataset", "file_source", "record", "reason", place.alias("__place")).distinct()
        found = found.withColumn("__place", place).join(seen, seen.columns, "left_anti").drop("__place")
    found = materialize(found, "rejected-rows")
    if not found.isEmpty():
        store.append("rejected_rows", found)


def _record(store: Store, dataset: str, chosen: DataFrame, files, start: int | None, rejects: list[DataFrame]) -> None:
    """Keep rows that did not fit, and log every file that was taken up: also those of an unknown
    format and those that gave no row."""
    _keep_rejected(store, dataset, rejects)
    table = schemas.staging_table(dataset)
    unknown = [f.path for f in unsupported(files)]
    skipped = chosen.filter(F.col("path").isin(unknown))
    now = store.sources(table).filter(F.shiftright("last_seq", FILE_BITS) > (-1 if start is None else start))
    log = incremental.ingestion_log(now, table, chosen.filter(~F.col("path").isin(unknown)), skipped)
    store.append("ingestion_log", log)


def ingest_all(spark: SparkSession, root: str, store: Store, force: bool = False, on_modified: str = "replace") -> DataFrame:
    """All datasets; their jobs do not depend on each other and may overlap."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        decisions = list(pool.map(lambda d: ingest(spark, root, store, d, force, on_modified), DATASET_FILES))
    return incremental.decision_counts(union_all(decisions))


class StagedFeeds(Mapping):
    """The staging tables as feeds, each looked up when it is asked for: a step that is left out opens
    none, and a step reads at least the states that it notes."""

    def __init__(self, store: Store):
        self.store = store

    def __getitem__(self, dataset: str) -> DataFrame:
        return transform(self.store.read(schemas.staging_table(dataset)), dataset)

    def __iter__(self):
        return iter(schemas.STAGING)

    def __len__(self) -> int:
        return len(schemas.STAGING)


def staged_feeds(store: Store) -> Mapping[str, DataFrame]:
    return StagedFeeds(store)


def direct_feeds(spark: SparkSession, root: str, store: Store | None = None) -> dict[str, DataFrame]:
    """Feeds straight from the files, without staging tables.

    Keeps the product name of line items and puts places into title case.
    Each feed is written once, because its order of arrival must not change.
    Rows that do not fit go to ``rejected_rows`` of the store; without a store
    long rows are cut to their header.
    """

    def feed(dataset: str) -> DataFrame:
        files = source_files(dataset_files(spark, root, dataset))
        rejects: list[DataFrame] | None = None if store is None else []
        df = stage_files(spark, files, dataset, direct=True, rejects=rejects) if files else None
        if rejects:
            _keep_rejected(store, dataset, rejects, again=True)
        if df is None:
            df = spark.range(1).where("false").select().to(schemas.staging_schema(dataset))
        df = apply_formats(transform(df, dataset), DIRECT_FORMATS.get(dataset, {}))
        return materialize(df, f"direct_{dataset}")

    with ThreadPoolExecutor(max_workers=4) as pool:
        return dict(zip(schemas.STAGING, pool.map(feed, schemas.STAGING)))


def _together(jobs: list[Callable[[], object]]) -> None:
    """Run jobs that do not depend on each other at the same time."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        for job in [pool.submit(j) for j in jobs]:
            job.result()


@dataclass
class Loading:
    """One load into a store: its feeds, and whether they come from the staging tables."""

    spark: SparkSession
    store: Store
    feeds: Mapping[str, DataFrame]
    staged: bool

    def step(self, table: str, name: str, feeds: list[str], tables: list[str], job: Callable[[dict, dict], None], **how) -> None:
        """Run ``job(before, note)`` unless its inputs are at the states it has read them at.

        ``before`` has those states, ``note`` is what the job's write has to leave in ``table``.
        """
        if not self.staged:
            job({}, {})
            return
        staged = [schemas.staging_table(d) for d in feeds]
        now = {t: self.store.version(t) for t in staged + tables} | how
        before = self.store.meta(table).get("read", {}).get(name, {})
        idle = self.store.exists(table) and not any(now[t] for t in staged)  # nothing was ever staged for it
        if before != now and not idle:
            job(before, {"read": {name: now}})

    def changed(self, dataset: str, before: dict, key: str = "order_id") -> DataFrame | None:
        """Keys of staged rows that have come or gone since ``before``; None if that cannot be told."""
        table = schemas.staging_table(dataset)
        rows = self.store.changed_rows(table, before[table]) if table in before else None
        return None if rows is None else rows.select(normalize_key(F.col(key)).alias("key"))


def load_dimensions(load: Loading, calendar) -> None:
    spark, store, feeds = load.spark, load.store, load.feeds

    def days() -> None:
        dates = store.read("dim_date")
        wanted = dims.extend_calendar(dates, dims.build_calendar(spark, *calendar))
        if wanted.count() != dates.count():
            store.replace("dim_date", wanted)

    def campaigns() -> None:
        def upsert_campaigns(_, note) -> None:
            known = dims.ensure_unknown_campaign(store.read("dim_campaign"))
            store.replace("dim_campaign", dims.upsert_dimension("dim_campaign", known, feeds["campaign_data"]), meta=note)

        load.step("dim_campaign", "upsert", ["campaign_data"], [], upsert_campaigns)
        load.step("fact_campaign_transactions", "rekey", ["transactional_campaign_data"], ["dim_campaign"], partial(rekey, load))

    def upsert(table: str, feed: str) -> None:
        def job(_, note) -> None:
            store.replace(table, dims.upsert_dimension(table, store.read(table), feeds[feed]), meta=note)

        load.step(table, "upsert", [feed], [], job)

    def outrigger(table: str, feed: str) -> None:
        def job(_, note) -> None:
            store.replace(table, dims.append_outrigger(table, store.read(table), feeds[feed]), meta=note)

        load.step(table, "append", [feed], [], job)

    _together(
        [
            campaigns,
            *[partial(upsert, table, feed) for table, feed in DIM_FEEDS.items()],
            partial(outrigger, "dim_user_job", "user_job"),
            partial(outrigger, "dim_credit_card", "user_credit_card"),
            days,
        ]
    )


def rekey(load: Loading, before: dict, note: dict) -> None:
    """Move campaign rows to campaigns that have arrived since they were loaded.

    Only files with a row that moves are written anew.
    """
    store, table = load.store, "fact_campaign_transactions"
    fact = store.read(table)
    moves, counts = facts.campaign_moves(fact, store.read("dim_campaign"), load.feeds["transactional_campaign_data"])
    moves = materialize(moves, "campaign-moves")
    if not moves.isEmpty():
        files = store.touched(table, moves.select("order_id"))
        moved = facts.apply_campaign_moves(store.read_files(table, files), moves)
        store.rewrite(table, files, moved, FACT_ORDER, note)
    elif note:
        store.mark(table, note)


def _add_rejects(store: Store, table: str, rejects: DataFrame) -> None:
    """Append the rejects that the table does not hold from an earlier load of the same rows."""
    known = store.read(table)
    columns = [c for c in known.columns if c != "rejected_at"]
    seen = known.select(*[F.col(c).alias(f"__{c}") for c in columns]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in columns])
    fresh = materialize(rejects.to(known.schema).join(seen, same, "left_anti"), "rejects")
    if not fresh.isEmpty():
        store.append(table, fresh)


def _only(feed: DataFrame, keys: DataFrame | None) -> DataFrame:
    """Rows of a feed whose order is among the keys."""
    if keys is None:
        return feed
    rows = feed.withColumn("__key", normalize_key(F.col("order_id")))
    return rows.join(keys.select(F.col("key").alias("__key")), "__key", "left_semi").select(*feed.columns)


ORDER_FEEDS = ["order_data", "order_with_merchant_data", "order_delays"]


def upsert_order_files(store: Store, offered: DataFrame, note: dict | None = None) -> list[str]:
    """Bring judged orders into ``fact_orders``; only files that hold one of them are written anew.

    Returns these files.  ``offered`` must be a written table.
    """
    files = store.touched("fact_orders", offered.select("order_id"))
    held = store.read_files("fact_orders", files)
    fresh = facts.upsert_orders(held, offered)
    # rows that come out as they are ask for no write
    changed = materialize(fresh.exceptAll(held), "changed-orders")
    if changed.isEmpty():
        if note:
            store.mark("fact_orders", note)
        return []
    files = store.touched("fact_orders", changed.select("order_id"))
    merged = facts.upsert_orders(store.read_files("fact_orders", files), offered.join(changed.select("order_id"), "order_id", "left_semi"))
    store.rewrite("fact_orders", files, merged, FACT_ORDER, note)
    return files


def load_facts(load: Loading, pairing: str, missing_delay: int | None) -> None:
    store, feeds = load.store, load.feeds

    def users() -> None:
        def job(_, note) -> None:
            store.replace("dim_user", dims.stub_users(store.read("dim_user"), feeds["order_data"]), meta=note)

        load.step("dim_user", "stubs", ["order_data"], [], job)

    def products() -> None:
        def job(_, note) -> None:
            store.replace("dim_product", dims.stub_products(store.read("dim_product"), feeds["line_item_data_products"]), meta=note)

        load.step("dim_product", "stubs", ["line_item_data_products"], [], job)

    def types(_, note) -> None:
        """Product types under the names that the views group by; only where one has another name."""
        products = store.read("dim_product")
        grouped = dims.regroup_product_types(products)
        if grouped.exceptAll(products).isEmpty():
            store.mark("dim_product", note) if note else None
        else:
            store.replace("dim_product", grouped, meta=note)

    def orders(before: dict, note: dict) -> None:
        star = store.star()
        parts = [load.changed(d, before) for d in ORDER_FEEDS] if before.get("missing_delay") == str(missing_delay) else [None]
        keys = None
        if all(p is not None for p in parts):
            # what was turned away is judged again: its merchant or day may have come since
            parts.append(store.read("reject_fact_orders").select(F.col("order_id").alias("key")))
            keys = materialize(reduce(DataFrame.unionByName, parts).distinct(), "changed-keys")
        made = facts.load_orders(
            store.read_files("fact_orders", []), *[_only(feeds[d], keys) for d in ORDER_FEEDS], star, missing_delay, stage=materialize
        )
        upsert_order_files(store, materialize(made.offered, "offered-orders"), note)
        _add_rejects(store, "reject_fact_orders", made.rejects)

    def lines(_, note: dict) -> None:
        made = facts.load_line_items(
            store.read("fact_line_items"),
            feeds["line_item_data_prices"],
            feeds["line_item_data_products"],
            store.read("dim_product"),
            store.read("fact_orders"),
            pairing,
            stage=materialize,
        )
        store.append("fact_line_items", made.added, FACT_ORDER, note)
        _add_rejects(store, "reject_fact_line_items", made.rejects)

    def campaigns(_, note: dict) -> None:
        made = facts.load_campaign_transactions(
            store.read("fact_campaign_transactions"),
            feeds["transactional_campaign_data"],
            store.read("dim_campaign"),
            store.read("fact_orders"),
            stage=materialize,
        )
        store.append("fact_campaign_transactions", made.added, FACT_ORDER, note)
        _add_rejects(store, "reject_fact_campaign_transactions", made.rejects)

    _together([users, products])
    load.step("dim_product", "types", ["product_list"], [], types)
    people = ["dim_user", "dim_merchant", "dim_staff", "dim_date"]
    load.step("fact_orders", "orders", ORDER_FEEDS, people, orders, missing_delay=str(missing_delay))
    known = ["dim_product", "fact_orders"]
    _together(
        [
            partial(load.step, "fact_line_items", "lines", ["line_item_data_prices", "line_item_data_products"], known, lines, pairing=pairing),
            partial(
                load.step, "fact_campaign_transactions", "load", ["transactional_campaign_data"], ["dim_campaign", "fact_orders"], campaigns
            ),
        ]
    )


def refresh(
    spark: SparkSession,
    root: str,
    store: Store,
    mode: str = "staged",
    force: bool = False,
    on_modified: str = "replace",
    pairing: str = "position",
    missing_delay: int | None = 0,
    calendar: tuple[dt.date, dt.date] = (dt.date(2020, 1, 1), dt.date(2025, 12, 31)),
) -> dict[str, DataFrame]:
    """One load.  ``mode="direct"`` goes from the files to the star at once."""
    configure(spark)
    if mode == "staged":
        ingest_all(spark, root, store, force, on_modified)
        feeds = staged_feeds(store)
    else:
        feeds = direct_feeds(spark, root, store)
    load = Loading(spark, store, feeds, mode == "staged")
    load_dimensions(load, calendar)
    load_facts(load, pairing, missing_delay)
    return store.star()
