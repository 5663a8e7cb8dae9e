"""Warehouse tables as Parquet snapshots.

A table is a set of immutable folders.  Numbered state files name the folders
of each state, the files of them that no longer count, and what its writers
have read (``meta``); the highest number is the current one.  A write goes to a
new folder and then creates the next state file, which fails if another writer
was first; an append then reads the state again and retries.  State files are
only ever created, never renamed or replaced, so readers never see half a table,
a job that dies leaves the old state in place, and appends at the same time all
stay.  ``vacuum`` removes what no recent state names.

Beside each folder of a keyed or a staging table stands a manifest (see
``manifest``).  With it ``rewrite`` replaces only the files that hold changed
keys, and ``changed_rows`` gives what has come or gone since an earlier state.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace as altered

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse import schemas
from tallyhouse.plans import manifest


def with_missing_column(df: DataFrame, name: str, kind: str) -> DataFrame:
    """Add a column that older rows do not have; they get NULL."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))


_STATE = re.compile(r"_state-(\d{12})\.json")
RETRIES = 50
#: Tables whose files carry a manifest of this column.
KEYED = {"fact_orders": "order_id", "fact_line_items": "order_id", "fact_campaign_transactions": "order_id"}


def _state_name(number: int) -> str:
    return f"_state-{number:012d}.json"


def _beside(folder: str) -> str:
    """The manifest of a data folder."""
    return "k-" + folder[2:]


@dataclass(frozen=True)
class State:
    folders: list[str] = field(default_factory=list)
    dropped: list[str] = field(default_factory=list)  # "folder/file" that no longer counts
    meta: dict = field(default_factory=dict)

    def without(self, files: list[str]) -> State:
        return altered(self, dropped=[*self.dropped, *files])

    def marked(self, meta: dict | None) -> State:
        """Entries of ``meta`` are merged one level deep: notes of different writers stay apart."""
        out = dict(self.meta)
        for name, value in (meta or {}).items():
            out[name] = {**out.get(name, {}), **value} if isinstance(value, dict) else value
        return altered(self, meta=out)


class Conflict(RuntimeError):
    """Another writer has replaced what this one was about to."""


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # --- state -----------------------------------------------------------

    def _path(self, text: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)

    def _fs(self, path):
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _listing(self, table: str) -> tuple[list[int], list[str]]:
        """Numbers of the state files, and the data folders."""
        path = self._path(f"{self.root}/{table}")
        fs = self._fs(path)
        if not fs.exists(path):
            return [], []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        states = [int(m[1]) for m in map(_STATE.fullmatch, names) if m]
        return sorted(states), sorted(n for n in names if n.startswith("v-"))

    def _state(self, table: str, number: int) -> State | None:
        """A state; None for a file that is not there or that its writer did not finish."""
        path = self._path(f"{self.root}/{table}/{_state_name(number)}")
        if not self._fs(path).exists(path):
            return None
        stream = self._fs(path).open(path)
        try:
            return State(**json.loads(bytes(stream.readAllBytes()).decode()))
        except ValueError:
            return None
        finally:
            stream.close()

    def _current(self, table: str) -> tuple[int, State]:
        """Highest number in use, and the last complete state."""
        return self._last(table)[::2]

    def _last(self, table: str) -> tuple[int, int, State]:
        """Highest number in use, number of the last complete state, and that state."""
        states, data = self._listing(table)
        for number in reversed(states):
            state = self._state(table, number)
            if state is not None:
                return states[-1], number, state
        if data:
            raise RuntimeError(f"{self.root}/{table} holds data but no state file; vacuum it or restore the state")
        return states[-1] if states else 0, 0, State()

    def _folders(self, table: str) -> list[str]:
        return self._current(table)[1].folders

    def version(self, table: str) -> int:
        """Number of the current state."""
        return self._last(table)[1]

    def meta(self, table: str) -> dict:
        return self._current(table)[1].meta

    def _create(self, table: str, number: int, state: State) -> bool:
        """Write a state file; False if its number is taken."""
        path = self._path(f"{self.root}/{table}/{_state_name(number)}")
        try:
            stream = self._fs(path).create(path, False)  # fails if it exists
        except Py4JJavaError as failed:
            if "AlreadyExists" not in str(failed.java_exception):
                raise
            return False
        gone = [f for f in state.dropped if f.split("/")[0] in state.folders]
        stream.write(json.dumps({"folders": state.folders, "dropped": gone, "meta": state.meta}).encode())
        stream.close()
        return True

    def _begin(self, table: str) -> None:
        """A table has a state, if an empty one, before it has data."""
        states, data = self._listing(table)
        if not states and not data:
            self._create(table, 1, State())

    def _advance(self, table: str, following: Callable[[State], State | None]) -> None:
        """Create the next state from the current one, again if another writer was first.

        ``following`` may return None: the current state already holds what was to be written.
        """
        for _ in range(RETRIES):
            number, state = self._current(table)
            after = following(state)
            if after is None or self._create(table, number + 1, after):
                return
        raise RuntimeError(f"{table}: other writers were first {RETRIES} times")

    def vacuum(self, table: str, keep_states: int = 2) -> list[str]:
        """Delete what none of the last ``keep_states`` states names, and older state files.

        Run it when no load is running: a folder just written belongs to no state yet.
        """
        states, data = self._listing(table)
        kept = [s for s in (self._state(table, n) for n in states[-keep_states:]) if s]
        named = {f for s in kept for f in s.folders}
        # a file goes when every state that names its folder has dropped it
        dropped = {f for s in kept for f in s.dropped}
        dropped = {f for f in dropped if all(f in s.dropped for s in kept if f.split("/")[0] in s.folders)}
        gone = [f for f in data if f not in named]
        gone += [_beside(f) for f in gone] + sorted(dropped) + [_state_name(n) for n in states[:-keep_states]]
        out = []
        for name in gone:
            path = self._path(f"{self.root}/{table}/{name}")
            if self._fs(path).delete(path, True):
                out.append(name)
        return out

    def merge(self, table: str, cluster_by: list[str] | None = None) -> DataFrame:
        """Rewrite the folders of a table as one; rows appended meanwhile stay."""
        before = self._current(table)[1]
        rows = self._rows(table, before)
        folder = self._write(table, rows, cluster_by)

        def following(now: State) -> State:
            if now.folders[: len(before.folders)] != before.folders or set(now.dropped) != set(before.dropped):
                raise Conflict(f"{table} was replaced while its folders were merged")
            return State([folder, *now.folders[len(before.folders) :]], [], now.meta)

        self._advance(table, following)
        return self.read(table)

    def _write(self, table: str, df: DataFrame, cluster_by: list[str] | None) -> str:
        self._begin(table)
        folder = f"v-{uuid.uuid4().hex[:12]}"
        if cluster_by:
            df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
        df.write.mode("errorifexists").parquet(f"{self.root}/{table}/{folder}")
        made = self._manifest_of(table, folder)
        if made is not None:
            made.write.mode("errorifexists").parquet(f"{self.root}/{table}/{_beside(folder)}")
        return folder

    # --- manifests ---------------------------------------------------------

    def _manifest_of(self, table: str, folder: str) -> DataFrame | None:
        """A manifest from the rows of a folder."""
        rows = self.spark.read.schema(self.schema(table)).parquet(f"{self.root}/{table}/{folder}")
        rows = rows.withColumn("file", F.concat(F.lit(f"{folder}/"), F.col("_metadata.file_name")))
        if table in KEYED:
            return manifest.of_keys(rows, KEYED[table])
        if table.startswith("stg_"):
            return manifest.of_sources(rows)
        return None

    def _manifest(self, table: str) -> DataFrame | None:
        """The manifest of the current files; folders written without one are read for it."""
        state = self._current(table)[1]
        parts = []
        for folder in state.folders:
            path = self._path(f"{self.root}/{table}/{_beside(folder)}/_SUCCESS")
            schema = manifest.KEYS if table in KEYED else manifest.SOURCES
            stored = self._fs(path).exists(path)
            made = self.spark.read.schema(schema).parquet(str(path.getParent())) if stored else self._manifest_of(table, folder)
            parts.append(made.select(*schemas.struct(schema).names))
        if not parts:
            return None
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        if not state.dropped:
            return out
        gone = self.spark.createDataFrame([(f,) for f in state.dropped], "file string")
        return out.join(gone, "file", "left_anti")

    def sources(self, table: str) -> DataFrame:
        """Of a staging table, per source file: ``file_source, last_loaded, last_seq, rows``; no row is read."""
        made = self._manifest(table)
        if made is None:
            made = self.spark.createDataFrame([], manifest.SOURCES)
        return made.groupBy("file_source").agg(
            F.max("last_loaded").alias("last_loaded"), F.max("last_seq").alias("last_seq"), F.sum("rows").alias("rows")
        )

    def touched(self, table: str, keys: DataFrame) -> list[str]:
        """Files of a keyed table that may hold one of the ``keys`` (one column); few others are among them."""
        made = self._manifest(table)
        return [] if made is None else sorted(r["file"] for r in manifest.files_with(made, keys.toDF("key")).collect())

    def holding(self, table: str, sources: DataFrame) -> list[str]:
        """Files of a staging table with rows of the source files ``file_source``."""
        made = self._manifest(table)
        if made is None:
            return []
        found = made.join(sources.select("file_source"), "file_source", "left_semi").select("file").distinct()
        return sorted(r["file"] for r in found.collect())

    # --- tables ------------------------------------------------------------

    def schema(self, table: str):
        if table in schemas.WAREHOUSE:
            return schemas.warehouse_schema(table)
        for dataset in schemas.STAGING:
            if schemas.staging_table(dataset) == table:
                return schemas.staging_schema(dataset)
        if table == "ingestion_log":
            return schemas.struct(schemas.INGESTION_LOG)
        if table == "rejected_rows":
            return schemas.struct(schemas.REJECTED_ROWS)
        raise KeyError(table)

    def exists(self, table: str) -> bool:
        return bool(self._folders(table))

    def files(self, table: str, state: State | None = None) -> list[str]:
        """The files of a state, by default the current one, as ``folder/file``."""
        state = state or self._current(table)[1]
        gone, out = set(state.dropped), []
        for folder in state.folders:
            path = self._path(f"{self.root}/{table}/{folder}")
            names = [s.getPath().getName() for s in self._fs(path).listStatus(path)]
            out += [f"{folder}/{n}" for n in names if n.endswith(".parquet") and f"{folder}/{n}" not in gone]
        return sorted(out)

    def read_files(self, table: str, files: list[str]) -> DataFrame:
        schema = self.schema(table)
        if not files:
            return self.spark.range(1).where("false").select().to(schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{table}/{f}" for f in files])

    def _rows(self, table: str, state: State) -> DataFrame:
        """Folders are named whole where all their files count."""
        partly = {f.split("/")[0] for f in state.dropped}
        names = [f for f in state.folders if f not in partly]
        if partly:
            names += self.files(table, State([f for f in state.folders if f in partly], state.dropped))
        return self.read_files(table, names)

    def read(self, table: str) -> DataFrame:
        """Current state in the declared layout; columns added later are NULL
        in older folders."""
        return self._rows(table, self._current(table)[1])

    def changed_rows(self, table: str, since: int) -> DataFrame | None:
        """Rows of files that have come or gone since state ``since``; rows that were only copied are among them.

        None if that state or its files are not there any more.
        """
        then, now = self._state(table, since) if since else State(), self._current(table)[1]
        if then is None:
            return None
        try:
            old, new = set(self.files(table, then)), set(self.files(table, now))
        except Py4JJavaError as failed:
            if "FileNotFound" not in str(failed.java_exception):
                raise
            return None
        # vacuum may have taken files of folders that are still there
        lost = [f for f in now.dropped if f not in then.dropped and f not in old and f.split("/")[0] in then.folders]
        return None if lost else self.read_files(table, sorted(old ^ new))

    def replace(self, table: str, df: DataFrame, cluster_by: list[str] | None = None, meta: dict | None = None) -> DataFrame:
        folder = self._write(table, df.to(self.schema(table)), cluster_by)
        self._advance(table, lambda now: State([folder], [], now.meta).marked(meta))
        return self.read(table)

    def append(self, table: str, df: DataFrame, cluster_by: list[str] | None = None, meta: dict | None = None) -> DataFrame:
        """Add rows without touching the folders that are there."""
        folder = self._write(table, df.to(self.schema(table)), cluster_by)
        self._advance(table, lambda now: State([*now.folders, folder], now.dropped, now.meta).marked(meta))
        return self.read(table)

    def append_once(self, table: str, df: DataFrame, stream: str, number: int, cluster_by: list[str] | None = None) -> bool:
        """Append batch ``number`` of a stream, unless a state already holds it; the number stands in the
        state that brings the rows, so both come or neither."""
        if self.meta(table).get("streams", {}).get(stream, -1) >= number:
            return False
        folder = self._write(table, df.to(self.schema(table)), cluster_by)
        done = []

        def following(now: State) -> State | None:
            done[:] = [now.meta.get("streams", {}).get(stream, -1) < number]
            if not done[0]:
                return None
            return State([*now.folders, folder], now.dropped, now.meta).marked({"streams": {stream: number}})

        self._advance(table, following)
        return done[0]

    def rewrite(self, table: str, files: list[str], df: DataFrame, cluster_by: list[str] | None = None, meta: dict | None = None) -> DataFrame:
        """``df`` in place of the rows of ``files``; all other files stay.

        Fails if another writer has replaced one of the files since.
        """
        folder = self._write(table, df.to(self.schema(table)), cluster_by)

        def following(now: State) -> State:
            if any(f in now.dropped or f.split("/")[0] not in now.folders for f in files):
                raise Conflict(f"{table}: files were replaced by another writer")
            return State([*now.folders, folder], now.dropped, now.meta).without(files).marked(meta)

        self._advance(table, following)
        return self.read(table)

    def mark(self, table: str, meta: dict) -> None:
        """A state of the same rows with other notes."""
        self._advance(table, lambda now: now.marked(meta))

    def reset(self, *tables: str) -> None:
        """Empty tables: their state names an empty folder, and nothing counts as read."""
        for table in tables:
            folder = self._write(table, self.spark.range(1).where("false").select().to(self.schema(table)), None)
            self._advance(table, lambda _, folder=folder: State([folder]))

    def reset_staging(self) -> None:
        self.reset(*[schemas.staging_table(d) for d in schemas.STAGING])

    def reset_all(self) -> None:
        self.reset_staging()
        self.reset(*schemas.WAREHOUSE)

    def star(self) -> dict[str, DataFrame]:
        return {t: self.read(t) for t in schemas.WAREHOUSE}
