"""Shared helpers: table access, column names that cannot clash, a registered query."""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallyhouse.session import configure

#: Patterns that several operators share (fixed values).  Both engines read them alike.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: What a Python worker is given at once: rows may hold long texts.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    return configure(spark)


@dataclass(frozen=True)
class LlmQuery:
    """A registered query: the operator at production parameters over whole tables."""

    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.run(prepare(spark), sf_dir)

    def oracle(self) -> str | None:
        return self.sql


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_frame(spark: SparkSession, rows: list[tuple], **types: pa.DataType) -> DataFrame:
    """A few rows of the driver as a table.  They go by Arrow: of plain rows Spark makes an RDD in Python, and
    the workers for that stay in the executors beside those of the passes."""
    columns = zip(*rows, strict=True) if rows else [()] * len(types)
    return spark.createDataFrame(pa.table([pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)], list(types)))


def neutral(df: DataFrame, *wanted: str) -> tuple[DataFrame, list[str]]:
    """``df`` with columns ``c0, c1, ...``, so that no name clashes with an operator's own, and the
    new names of the ``wanted`` columns."""
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))]), [f"c{df.columns.index(w)}" for w in wanted]


def restored(out: DataFrame, df: DataFrame) -> DataFrame:
    """The columns of ``df`` under their old names, out of a frame that came from ``neutral``."""
    return out.select(*[f"c{k}" for k in range(len(df.columns))]).toDF(*df.columns)


def discard(written: DataFrame) -> None:
    """Delete a table that ``materialize`` wrote, after its last reader.  Its folder must be in the scratch folder."""
    spark = written.sparkSession
    folders = {f.rsplit("/", 1)[0] for f in written.inputFiles()}
    for folder in folders:
        if f"/tallyhouse/{spark.sparkContext.applicationId}/" not in folder:
            raise ValueError(f"{folder} is not a scratch table")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_caches: dict[str, Callable[[], None]] = {}


def remembers(name: str, forget: Callable[[], None]) -> None:
    """Name what a module remembers in a worker from one task to the next."""
    _caches[name] = forget


def forget_others(name: str) -> None:
    for other, forget in _caches.items():
        if other != name:
            forget()


def give_back() -> None:
    """Return this process's freed memory to the machine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:
        pass  # another C library


def tidy(run, cache: str = ""):
    """``run`` for ``mapInArrow`` in workers that live on from stage to stage: what other passes remember is
    forgotten when a task begins, and freed memory goes back to the machine when it ends."""

    def tidied(batches):
        from tallyhouse.llm import base  # the worker's own module

        base.forget_others(cache)
        try:
            yield from run(batches)
        finally:
            base.give_back()

    return tidied
