"""Which files to load in this run, and what happened to each of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse import schemas

NEW = "File not yet processed"
FORCED = "Full reload is enabled"
MODIFIED = "File modified after last ingestion"
UNCHANGED = "File already processed and not modified"
UNDATED = "File already processed (no timestamp available)"


def loaded_files(staged: DataFrame) -> DataFrame:
    """(file_source, last_loaded) of a staging table.  The aggregate has one
    row per file; equal names meet in a partial step first."""
    return (
        staged.filter(F.col("file_source").isNotNull())
        .groupBy("file_source")
        .agg(F.max("loaded_at").alias("last_loaded"))
    )


def decide_files(listing: DataFrame, staged: DataFrame | None, force: bool = False) -> DataFrame:
    """Listing with ``decision`` (process / skip) and ``reason``.

    A file is loaded when it is new, when it changed after its last load, or
    when a full reload is asked for.
    """
    if force or staged is None:
        return listing.withColumns(
            {"decision": F.lit("process"), "reason": F.lit(FORCED if force else NEW)}
        )
    known = listing.join(
        loaded_files(staged).withColumnRenamed("file_source", "path").withColumn("__known", F.lit(True)), "path", "left"
    )
    reason = (
        F.when(F.col("__known").isNull(), NEW)
        .when(F.col("last_loaded").isNull(), UNDATED)
        .when(F.col("modified") > F.col("last_loaded"), MODIFIED)
        .otherwise(UNCHANGED)
    )
    decided = known.withColumn("reason", reason).drop("__known", "last_loaded")
    return decided.withColumn(
        "decision", F.when(F.col("reason").isin(NEW, MODIFIED), "process").otherwise("skip")
    )


def new_files(listing: DataFrame, staged: DataFrame) -> DataFrame:
    """Files whose name the staging table does not hold."""
    known = staged.select(F.col("file_source").alias("path")).distinct()
    return listing.join(known, "path", "left_anti")


def not_logged(listing: DataFrame, log: DataFrame, table_name: str) -> DataFrame:
    """Files without a success in the ingestion log for this table."""
    done = log.filter((F.col("table_name") == table_name) & (F.col("status") == "success"))
    return listing.join(done.select(F.col("file_path").alias("path")).distinct(), "path", "left_anti")


def decision_counts(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("dataset", "decision", "reason").agg(F.count("*").alias("files"))


def ingestion_log(loaded: DataFrame, table_name: str, listing: DataFrame, skipped: DataFrame | None = None) -> DataFrame:
    """One log row per file: how many rows came in, or why it was skipped.

    ``loaded`` has a row for every row that came in, or counts in a column ``rows``.
    """
    n = F.sum("rows") if "rows" in loaded.columns else F.count("*")
    counts = loaded.groupBy(F.col("file_source").alias("path")).agg(n.alias("n"))
    done = listing.join(counts, "path", "left").select(
        F.col("path").alias("file_path"),
        F.lit(table_name).alias("table_name"),
        F.coalesce(F.col("n"), F.lit(0)).alias("rows_ingested"),
        F.lit("success").alias("status"),
        F.lit(None).cast("string").alias("message"),
        F.current_timestamp().alias("ts"),
    )
    if skipped is not None:
        out = skipped.select(
            F.col("path").alias("file_path"),
            F.lit(table_name).alias("table_name"),
            F.lit(0).cast("bigint").alias("rows_ingested"),
            F.lit("skipped").alias("status"),
            F.concat(F.lit("Unsupported ext ."), F.regexp_extract("path", r"\.([^./]+)$", 1)).alias("message"),
            F.current_timestamp().alias("ts"),
        )
        done = done.unionByName(out)
    return done.to(schemas.struct(schemas.INGESTION_LOG))


def staging_tables(spark: SparkSession, prefix: str, sub_tables: bool = False) -> DataFrame | None:
    """Union of the registered tables whose name starts with ``prefix``.

    Tables cut out of a page (``..._tbl1``) count only with ``sub_tables``.
    ``None`` where no table fits.
    """
    names = sorted(
        t.name for t in spark.catalog.listTables() if t.name.startswith(prefix) and (sub_tables or "_tbl" not in t.name)
    )
    if not names:
        return None
    from tallyhouse.operators.relational import union_all

    return union_all([spark.table(n) for n in names])
