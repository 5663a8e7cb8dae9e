"""Arriving files as a stream into the star, each of them once.

The stream carries file names; the checkpoint remembers them.  A micro-batch is
read by the readers of the batch load, so columns are bound by the header of
each file and every format is taken.  Its rows are appended to the staging
tables under the name of the stream and the number of the batch, which stand in
the state that brings the rows: a batch that is tried again finds its number
there and adds nothing.  The loaders then take up what has come since the states
they have read, which they note in the same way.

A file that is edited in place is not seen again; those stay with the batch load,
which in turn skips what the stream has staged.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from fnmatch import fnmatch

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse import schemas
from tallyhouse.operators.keys import FILE_BITS
from tallyhouse.operators.relational import union_all
from tallyhouse.plans.refresh import Loading, load_dimensions, load_facts, stage_files, staged_feeds
from tallyhouse.plans.store import Store
from tallyhouse.session import configure, materialize
from tallyhouse.sources import incremental
from tallyhouse.sources.discovery import DATASET_FILES, source_files
from tallyhouse.sources.readers import unsupported

DatasetOf = Callable[[str], "str | None"]


def dataset_of_name(path: str) -> str | None:
    """The dataset that a file belongs to by its name; None for any other file."""
    name = path.rsplit("/", 1)[-1].lower()
    for dataset, (pattern, look_alike) in DATASET_FILES.items():
        if fnmatch(name, pattern) and not (look_alike and look_alike in name):
            return dataset
    return None


def arriving_files(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Names of arriving files as a stream; their content is not read here."""
    return (
        spark.readStream.format("binaryFile")
        .schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select("path", F.col("_metadata.file_path").alias("file_path"))
    )


def stage_batch(store: Store, listing: DataFrame, stream: str, number: int, dataset_of: DatasetOf = dataset_of_name) -> list[str]:
    """Stage the files of a micro-batch; returns the datasets that got rows.

    ``listing`` has at most as many files as the stream takes up at once.
    """
    spark = store.spark
    found: dict[str, list] = {}
    for row in listing.select("path", "file_path").distinct().orderBy("path").collect():
        dataset = dataset_of(row["path"])
        if dataset is not None:
            found.setdefault(dataset, []).append(row)
    taken = []
    for dataset, rows in found.items():
        table, name = schemas.staging_table(dataset), f"{stream}/{dataset}"
        unknown: list[str] = []
        if store.meta(table).get("streams", {}).get(name, -1) < number:  # else the rows are there, the log may not be
            last = store.sources(table).agg(F.max(F.shiftright("last_seq", FILE_BITS))).first()[0]
            files = source_files(spark.createDataFrame(rows, "path string, file_path string"), 0 if last is None else last + 1)
            rejects: list[DataFrame] = []
            staged = stage_files(spark, files, dataset, rejects=rejects)
            if rejects:
                lost = union_all(rejects).withColumn("dataset", F.lit(dataset))
                store.append_once("rejected_rows", materialize(lost, "arrivals-rejects"), name, number)
            if staged is not None and store.append_once(table, staged, name, number):
                taken.append(dataset)
            unknown = [f.path for f in unsupported(files)]
        listed = spark.createDataFrame([(r["path"],) for r in rows], "path string")
        known = store.sources(table).join(listed.select(F.col("path").alias("file_source")), "file_source", "left_semi")
        log = incremental.ingestion_log(known, table, listed.filter(~F.col("path").isin(unknown)), listed.filter(F.col("path").isin(unknown)))
        store.append_once("ingestion_log", log, name, number)
    return taken


def load_arrivals(stream: DataFrame, checkpoint: str, load: Callable[[DataFrame, int], None]) -> None:
    """Run ``load`` on everything that is waiting, then stop.

    ``load`` gets the batch and its number; a batch that is tried again has
    the same number, so writing under that number makes it count once.
    """
    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stage_arrivals(spark: SparkSession, folder: str, store: Store, checkpoint: str, stream: str = "arrivals", dataset_of: DatasetOf = dataset_of_name, files_per_batch: int = 1000) -> None:
    """Stage what has arrived in ``folder``."""
    load_arrivals(arriving_files(spark, folder, files_per_batch), checkpoint, lambda files, number: stage_batch(store, files, stream, number, dataset_of))


def star_batch(
    store: Store,
    listing: DataFrame,
    stream: str,
    number: int,
    dataset_of: DatasetOf = dataset_of_name,
    pairing: str = "position",
    missing_delay: int | None = 0,
    calendar: tuple[dt.date, dt.date] = (dt.date(2020, 1, 1), dt.date(2025, 12, 31)),
) -> None:
    """Stage a micro-batch and bring the star up to date with the staging tables."""
    stage_batch(store, listing, stream, number, dataset_of)
    load = Loading(store.spark, store, staged_feeds(store), True)
    load_dimensions(load, calendar)
    load_facts(load, pairing, missing_delay)


def stream_into_star(
    spark: SparkSession, folder: str, store: Store, checkpoint: str, stream: str = "arrivals", files_per_batch: int = 1000, **how
) -> dict[str, DataFrame]:
    """Everything that has arrived in ``folder``, through the staging tables into the facts."""
    configure(spark)
    load_arrivals(arriving_files(spark, folder, files_per_batch), checkpoint, lambda files, number: star_batch(store, files, stream, number, **how))
    return store.star()
