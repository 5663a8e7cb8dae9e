"""File name and order of arrival, attached while a file is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.operators.keys import BLOCK_BITS, FILE_BITS, row_in_task
from tallyhouse.sources.discovery import SourceFile

_SPLIT_BITS = 22  # splits of a file start at least 4 MiB apart
MAX_FILES = 1 << 20  # over all loads
MAX_FILES_PER_LOAD = 1 << 18


def place_in_split() -> Column:
    """Place in a splittable text file: its split, then the row within."""
    split = F.shiftright(F.col("_metadata.file_block_start"), _SPLIT_BITS)
    return F.shiftleft(split, BLOCK_BITS) + row_in_task()


def with_lineage(df: DataFrame, files: list[SourceFile], file_path: Column, place: Column) -> DataFrame:
    """Add ``file_source``, ``loaded_at`` and ``ingest_seq``.

    ``file_path`` and ``place`` must come from the scan itself.  The order of
    arrival is that of the sorted paths, then the place within the file.
    """
    if files and files[-1].ordinal >= MAX_FILES:
        raise ValueError("more files than the order of arrival can number")
    if len(files) > MAX_FILES_PER_LOAD:
        raise ValueError("too many files for one load; load them in several runs")
    data = df.select("*", file_path.alias("__file"), place.alias("__place"))
    ordinals = df.sparkSession.createDataFrame(
        [(f.file_path, f.path, f.ordinal) for f in files], "__file string, file_source string, __ordinal bigint"
    )
    # the limit above bounds the list, so it can be sent along; a shuffle by
    # file would put a large file into one task
    joined = data.join(F.broadcast(ordinals), "__file")
    seq = F.shiftleft(F.col("__ordinal"), FILE_BITS) + F.col("__place")
    return joined.select(
        *df.columns, "file_source", F.current_timestamp().alias("loaded_at"), seq.cast("bigint").alias("ingest_seq")
    )
