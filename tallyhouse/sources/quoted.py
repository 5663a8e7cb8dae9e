"""Line breaks inside quotes, in files that stay splittable.

Whether a line begins inside a quoted cell depends on all lines before it.  Each
split is read in both states: a line is a map from the state before it to the
state after it, and so is a split, whose map is that of its lines one after the
other.  Composing the maps of a file's splits in order gives the state at the
beginning of each; then every split puts its own lines together, and only the
records that reach over the end of a split are joined afterwards.

A quote opens a cell only where a cell begins, and closes it only where one
ends; any other is text.  So a stray quote (``1,screen 5" wide``) opens nothing.  A
file whose last quote is never closed has no records over several lines.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.operators.keys import row_in_task
from tallyhouse.sources.discovery import SourceFile
from tallyhouse.sources.lineage import place_in_split

#: Splits of files with such records in one load; their states are sent to all tasks.
MAX_SPLITS = 1_000_000


class Quotes:
    """The state after a line, for either state before it: inside a quoted cell or not."""

    def __init__(self, sep: str):
        s = re.escape(sep)
        body = rf'[^"]*+(?:(?:""|"(?!"|{s}|\Z))[^"]*+)*+'
        cell = rf'(?:"{body}"(?={s}|\Z)|(?!")[^{s}]*+)'
        rest = rf'(?:{cell}{s})*+"{body}\Z'
        self.opens = re.compile(rest)
        self.stays = re.compile(rf"{body}\Z")
        self.opens_again = re.compile(rf'{body}"{s}{rest}')

    def after(self, line: str, inside: bool) -> bool:
        if not inside:
            return self.opens.match(line) is not None
        return self.stays.match(line) is not None or self.opens_again.match(line) is not None


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Stretches of rows of one file and split."""
    files, blocks = batch.column("file_path").to_pylist(), batch.column("block").to_pylist()
    lo = 0
    for i in range(1, batch.num_rows + 1):
        if i == batch.num_rows or blocks[i] != blocks[lo] or files[i] != files[lo]:
            yield lo, i
            lo = i


def _lines(spark: SparkSession, files: list[SourceFile]) -> DataFrame:
    return spark.read.text([f.path for f in files]).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        place_in_split().alias("place"),
    )


def _map_pass(sep: str):
    """The map of every split, and whether one of its lines may open a record of several."""

    names = ["file_path", "block", "place", "from_outside", "from_inside", "opened"]
    types = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_())

    def frame(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names)

    def run(batches):
        quotes = Quotes(sep)
        at, outside, inside, opened = None, False, True, False
        for batch in batches:
            out = []
            quoted = pc.match_substring(batch.column("value"), '"').to_pylist()
            for lo, hi in _runs(batch):
                here = (batch.column("file_path")[lo].as_py(), batch.column("block")[lo].as_py())
                if at is None or here != at[:2]:
                    if at is not None:
                        out.append((*at, outside, inside, opened))
                    at, outside, inside, opened = (*here, batch.column("place")[lo].as_py()), False, True, False
                for i in range(lo, hi):
                    if quoted[i]:  # a line without quotes leaves each state as it is
                        line = batch.column("value")[i].as_py()
                        after = (quotes.after(line, False), quotes.after(line, True))
                        opened = opened or after[0]
                        outside, inside = after[outside], after[inside]
            if out:
                yield frame(out)
        if at is not None:
            yield frame([(*at, outside, inside, opened)])

    return run, "file_path string, block long, place long, from_outside boolean, from_inside boolean, opened boolean"


def states(spark: SparkSession, files: list[SourceFile], sep: str) -> DataFrame:
    """``file_path, block, inside``: the state at the beginning of each split, of files with records over
    several lines; other files do not come out."""
    maps = _lines(spark, files).mapInArrow(*_map_pass(sep))
    # the splits of a file in order, one entry each
    step = F.struct("block", "place", "from_outside", "from_inside")
    per_file = maps.groupBy("file_path").agg(F.sort_array(F.collect_list(step)).alias("steps"), F.bool_or("opened").alias("opened"))
    along = F.aggregate(
        "steps",
        F.struct(F.lit(False).alias("inside"), F.expr("cast(array() as array<struct<block:bigint,inside:boolean>>)").alias("seen")),
        lambda acc, x: F.struct(
            F.when(acc["inside"], x["from_inside"]).otherwise(x["from_outside"]).alias("inside"),
            F.concat(acc["seen"], F.array(F.struct(x["block"].alias("block"), acc["inside"].alias("inside")))).alias("seen"),
        ),
    )
    known = per_file.where("opened").select("file_path", along.alias("along")).where("not along.inside")
    return known.select("file_path", F.explode("along.seen").alias("at")).select("file_path", "at.block", "at.inside")


WHOLE, TAIL, HEAD = 0, 1, 2


def _record_pass(sep: str):
    """Records of each split; the one that is open at its end, and the lines that end the one before."""

    def run(batches):
        quotes = Quotes(sep)
        at, inside, held, held_place, head = None, False, [], 0, False

        def flush(out):
            if at is not None and held:
                out.append((*at, held_place, HEAD if head else TAIL, "\n".join(held)))
            held.clear()

        for batch in batches:
            out = []
            values, quoted = batch.column("value").to_pylist(), pc.match_substring(batch.column("value"), '"').to_pylist()
            places, starts = batch.column("place").to_pylist(), batch.column("inside").to_pylist()
            for lo, hi in _runs(batch):
                here = (batch.column("file_path")[lo].as_py(), batch.column("block")[lo].as_py())
                if here != at:
                    flush(out)
                    at, inside, head = here, starts[lo], starts[lo]
                for i in range(lo, hi):
                    after = quotes.after(values[i], inside) if quoted[i] else inside
                    if inside:
                        held.append(values[i])
                        if not held[1:]:
                            held_place = places[i]
                        if not after:
                            out.append((*at, held_place, HEAD if head else WHOLE, "\n".join(held)))
                            held.clear()
                            head = False
                    elif after:
                        held.append(values[i])
                        held_place = places[i]
                    else:
                        out.append((*at, places[i], WHOLE, values[i]))
                    inside = after
            if out:
                yield _batch(out)
        out = []
        flush(out)
        if out:
            yield _batch(out)

    return run, "file_path string, block long, place long, kind int, value string"


def _batch(rows) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], ["file_path", "block", "place", "kind", "value"])


def records(spark: SparkSession, files: list[SourceFile], sep: str, begin: DataFrame) -> DataFrame:
    """``value, file_path, block, place`` of every record; ``begin`` is what ``states`` found."""
    if begin.count() > MAX_SPLITS:
        raise ValueError("too many splits with line breaks in quotes for one load; load them in several runs")
    # sent along, so the lines stay in their order; a split that holds no line begins nowhere
    lines = _lines(spark, files).join(F.broadcast(begin), ["file_path", "block"], "left")
    lines = lines.select("value", "file_path", "block", "place", F.coalesce("inside", F.lit(False)).alias("inside"))
    made = lines.mapInArrow(*_record_pass(sep))
    whole = made.where(F.col("kind") == WHOLE).select("value", "file_path", "block", "place")
    # at most two pieces a split: the end of a record from before, and the beginning of one that goes on
    pieces = made.where(F.col("kind") != WHOLE)
    order = F.struct("block", (F.col("kind") == TAIL).alias("last"), "value", "place")
    per_file = pieces.groupBy("file_path").agg(F.sort_array(F.collect_list(F.struct("block", (F.col("kind") == TAIL).alias("tail"), "place"))).alias("all"))
    # a record is the piece that begins it and all pieces before the next beginning
    tails = per_file.select("file_path", F.explode(F.filter("all", lambda x: x["tail"])).alias("t"), F.col("all"))
    after = F.filter("all", lambda x: x["tail"] & (x["block"] > F.col("t.block")))
    spans = tails.select("file_path", F.col("t.block").alias("from_block"), F.coalesce(F.get(after, F.lit(0))["block"], F.lit((1 << 62))).alias("to_block"))
    mine = (F.col("block") >= F.col("from_block")) & (F.col("block") <= F.col("to_block"))
    # of its own split a record has the tail, of the next one's only the head
    mine &= (F.col("block") > F.col("from_block")) | (F.col("kind") == TAIL)
    mine &= (F.col("block") < F.col("to_block")) | (F.col("kind") == HEAD)
    grouped = pieces.join(spans, "file_path").where(mine).groupBy("file_path", F.col("from_block").alias("block")).agg(F.sort_array(F.collect_list(order)).alias("p"))
    joined = grouped.select(F.array_join("p.value", "\n").alias("value"), "file_path", "block", F.get("p", F.lit(0))["place"].alias("place"))
    return whole.unionByName(joined)
