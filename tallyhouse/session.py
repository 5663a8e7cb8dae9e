"""Session settings, code for the executors, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the jobs rely on.  Adaptive execution is what turns a
# sort-merge join into a broadcast join once the real size of a side is known,
# and what splits a skewed join partition.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even when the next operator then needs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_own_dirs: dict[str, str] = {}
_shipped: set[str] = set()


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that tasks find it wherever the
    driver was started from."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="tallyhouse-code-"), "tallyhouse.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                archive.write(path, os.path.join("tallyhouse", os.path.relpath(path, root)))
    spark.sparkContext.addPyFile(target)  # Spark serves it from the driver; no shared folder is needed
    _shipped.add(app)


def scratch_root(spark: SparkSession) -> str:
    """Folder shared by driver and executors, as named by the cluster.

    A folder of our own is made only for a local session that names none; on a cluster that would
    scatter the files over the machines, so there it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    set_by_user = spark.sparkContext._jsc.sc().getCheckpointDir()
    if set_by_user.isDefined():
        return set_by_user.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("name a folder that driver and executors share in spark.checkpoint.dir")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="tallyhouse-")
    return _own_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the scratch folder that nothing else uses."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/tallyhouse/{app}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder and return the written table.

    Cuts the lineage and lets several consumers share one computation.  The
    copy lives in shared storage, so it survives lost executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
