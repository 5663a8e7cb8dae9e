"""Find source files and tell what is in them from their first bytes."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

# --- fixed values -----------------------------------------------------------
# dataset -> (file name pattern, name part that marks a look-alike)
DATASET_FILES = {
    "campaign_data": ("*campaign_data*", "transactional"),
    "transactional_campaign_data": ("*transactional_campaign_data*", None),
    "order_data": ("*order_data*", None),
    "line_item_data_prices": ("*line_item_data_prices*", None),
    "line_item_data_products": ("*line_item_data_products*", None),
    "order_delays": ("*order_delays*", None),
    "product_list": ("*product_list*", None),
    "user_data": ("*user_data*", None),
    "user_job": ("*user_job*", None),
    "user_credit_card": ("*user_credit_card*", None),
    "merchant_data": ("*merchant_data*", "order_with_merchant_data"),
    "staff_data": ("*staff_data*", None),
    "order_with_merchant_data": ("*order_with_merchant_data*", None),
}
SKIPPED_DIRS = ("Test",)
# --- end of fixed values ----------------------------------------------------


def find_files(
    spark: SparkSession,
    root: str,
    pattern: str = "*",
    exclude_name: str | None = None,
    skip_dirs: tuple[str, ...] = SKIPPED_DIRS,
) -> DataFrame:
    """Files below ``root`` by name: path, file_path, modified, length.

    Only names and sizes are read: the content column is never selected.
    Folders are matched below the root, so a root inside a skipped folder works.
    """
    base = root.rstrip("/")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(base)
        .select(
            "path",
            F.col("_metadata.file_path").alias("file_path"),
            F.col("modificationTime").alias("modified"),
            "length",
        )
    )
    plain = base.split(":", 1)[1].lstrip("/") if ":" in base else base.lstrip("/")
    below = F.element_at(F.split(F.col("path"), F.lit(_literal(plain) + "/"), 2), 2)
    for folder in skip_dirs:
        files = files.filter(~F.concat(F.lit("/"), below).contains(f"/{folder}/"))
    if exclude_name:
        files = files.filter(~F.lower("path").contains(exclude_name.lower()))
    return files.orderBy("path")


def _literal(text: str) -> str:
    return r"\Q" + text + r"\E"


def dataset_files(spark: SparkSession, root: str, dataset: str, **options) -> DataFrame:
    pattern, look_alike = DATASET_FILES[dataset]
    return find_files(spark, root, pattern, look_alike, **options)


@dataclass(frozen=True)
class SourceFile:
    path: str  # as the file system names it
    file_path: str  # as ``_metadata.file_path`` shows it on each row
    ordinal: int  # place among the files of the dataset

    @property
    def extension(self) -> str:
        name = self.path.rsplit("/", 1)[-1]
        return name.rsplit(".", 1)[-1].lower() if "." in name else ""


def source_files(listing: DataFrame, start: int = 0) -> list[SourceFile]:
    """The listing as a list: one entry per file, as Spark's own file index
    keeps on the driver.  ``start`` continues the numbering of earlier loads."""
    rows = listing.select("path", "file_path").orderBy("path").collect()
    return [SourceFile(r.path, r.file_path, start + i) for i, r in enumerate(rows)]


def head(spark: SparkSession, path: str, size: int = 65536) -> str:
    """The first ``size`` bytes of a file and the rest of the line they end in, as text without a
    byte-order mark; so the first line is whole, however long.

    Read through the Hadoop file system, so it works wherever Spark reads.
    """
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    stream = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(hadoop_path)
    try:
        raw = part = bytes(stream.readNBytes(size))
        while part and b"\n" not in part:
            part = bytes(stream.readNBytes(size))
            raw += part
    finally:
        stream.close()
    end = raw.find(b"\n", size - 1)
    return (raw if end < 0 else raw[: end + 1]).decode("utf-8-sig", errors="ignore")


def heads(spark: SparkSession, paths: list[str]) -> list[str]:
    """``head`` of many files, some at a time."""
    with ThreadPoolExecutor(max_workers=16) as pool:
        return list(pool.map(lambda p: head(spark, p), paths))


def first_line(text: str) -> str:
    return text.split("\n", 1)[0].rstrip("\r")


def tab_or_comma(line: str) -> str:
    """Separator by the header line; the tab is the default."""
    tabs, commas = line.count("\t"), line.count(",")
    if tabs > commas:
        return "\t"
    return "," if commas else "\t"


def dominant_separator(text: str, size: int = 4096) -> str:
    """Most frequent of four separators in the whole lines that begin in the first ``size``
    characters; the comma is the default."""
    end = text.find("\n", size - 1)
    sample = text if end < 0 else text[:end]
    best = max([",", "\t", ";", "|"], key=sample.count)
    return best if sample.count(best) else ","
