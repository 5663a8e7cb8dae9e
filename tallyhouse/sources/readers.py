"""Readers per format.  Each gives text columns plus lineage.

Files of one dataset may differ in separator and header.  They are read in
groups that agree in both, so the number of scans is the number of layouts.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyhouse.operators.relational import union_all
from tallyhouse.operators.staging import clean_frame, drop_first_index_column
from tallyhouse.sources import documents, quoted
from tallyhouse.sources.discovery import (
    SourceFile,
    dominant_separator,
    first_line,
    heads,
    tab_or_comma,
)
from tallyhouse.session import materialize
from tallyhouse.sources.lineage import place_in_split, with_lineage

log = logging.getLogger(__name__)

_INDEX, _OVERFLOW, _MORE, _RECORD = "__index", "__overflow", "__more", "__record"
TOO_LONG = "more cells than the header"
NO_DOCUMENT = "no document of records or columns"
_ABSENT = "\u0001"  # no cell holds this, so empty cells stay empty texts


def _unique(names: list[str]) -> list[str]:
    """Blank header cells get the names Spark gives them; repeats a suffix."""
    out: list[str] = []
    for i, name in enumerate(names):
        name = name if name.strip() else f"_c{i}"
        while name in out:
            name += "_1"
        out.append(name)
    return out


def _groups(items: list[tuple[SourceFile, tuple]]) -> dict[tuple, list[SourceFile]]:
    out: dict[tuple, list[SourceFile]] = {}
    for file, layout in items:
        out.setdefault(layout, []).append(file)
    return out


def split_header(line: str, sep: str) -> list[str]:
    import csv

    return next(csv.reader([line], delimiter=sep), [])


def by_header(text: str) -> str:
    return tab_or_comma(first_line(text))


def _quoted(spark: SparkSession, files: list[SourceFile], sep: str) -> list[SourceFile]:
    """Files with a quote where a cell begins; no other can hold a line break in quotes."""
    s = "\\x{" + f"{ord(sep):x}" + "}"
    text = spark.read.text([f.path for f in files]).filter(F.col("value").rlike(f'(^|{s})"'))
    found = {r.p for r in text.select(F.col("_metadata.file_path").alias("p")).distinct().collect()}
    return [f for f in files if f.file_path in found]


def _over_lines(spark: SparkSession, files: list[SourceFile], seps: list[str]) -> tuple[set[str], dict[str, DataFrame]]:
    """Files with records over several lines (``file_path``), and by separator the states of their splits."""
    broken, begins = set(), {}
    for sep in sorted(set(seps)):
        some = _quoted(spark, [f for f, s in zip(files, seps, strict=True) if s == sep], sep)
        if some:
            begins[sep] = materialize(quoted.states(spark, some, sep), "quote-states")
            broken |= {r.file_path for r in begins[sep].select("file_path").distinct().collect()}
    return broken, begins


def delimited_frames(
    spark: SparkSession,
    files: list[SourceFile],
    separator: Callable[[str], str] = by_header,
    skip_long_rows: bool = False,
    multiline: bool = True,
    rejects: list[DataFrame] | None = None,
) -> list[DataFrame]:
    """Delimited text with a header line, separator found per file.

    Doubled quotes are decoded.  A row with fewer cells than the header is
    filled up.  One with more cells goes to ``rejects`` as (file_source,
    ingest_seq, record, reason); without that list it is cut to the header, and
    with ``skip_long_rows`` it is left out.  If all rows of a file have one cell
    more and the first counts up, that cell is a row index and is dropped.
    Line breaks inside quotes are put together split by split (see ``quoted``), in the
    files that have any; ``multiline=False`` takes every line for a row.
    """
    tops = heads(spark, [f.path for f in files])
    seps = [separator(text) for text in tops]
    broken, begins = _over_lines(spark, files, seps) if multiline else (set(), {})
    layouts = []
    for file, text, sep in zip(files, tops, seps, strict=True):
        layouts.append((file, (sep, first_line(text), file.file_path in broken)))
    frames = []
    for (sep, header, whole), group in _groups(layouts).items():
        names = _unique(split_header(header, sep))
        if _ragged(names):
            frames.append(drop_first_index_column(_resplit(spark, group, sep, header), "csv"))
            continue
        options = {"sep": sep, "quote": '"', "escape": '"', "nullValue": _ABSENT, "emptyValue": ""}
        records = None
        if whole:
            begin = begins[sep].join(spark.createDataFrame([(f.file_path,) for f in group], "file_path string"), "file_path", "left_semi")
            records = quoted.records(spark, group, sep, begin)
            records = materialize(records.filter((F.trim("value") != "") & ~((F.col("value") == header) & (F.col("block") == 0))), "csv-records")

        def cells(part: list[SourceFile], columns: list[str], records: DataFrame | None = records, options: dict = options) -> tuple[DataFrame, T.StructType]:
            schema = T.StructType([T.StructField(n, T.StringType()) for n in columns])
            if records is None:
                df = spark.read.csv([f.path for f in part], schema=schema, header=True, **options)
                return with_lineage(df, part, F.col("_metadata.file_path"), place_in_split()), schema
            row = F.from_csv("value", schema.toDDL(), options).alias("row")
            df = with_lineage(records.select(row, "value", "file_path", "place"), part, F.col("file_path"), F.col("place"))
            fields = [F.col("row")[n].alias(n) for n in columns]
            return df.select(*fields, F.col("value").alias(_RECORD), "file_source", "loaded_at", "ingest_seq"), schema

        if whole:
            found = cells(group, [_INDEX, *names, _MORE])[0]
            one_more = F.col(f"`{names[-1]}`").isNotNull() & F.col(_MORE).isNull()
            found = found.select("file_source", "ingest_seq", F.trim(_INDEX).alias("t"), one_more.alias("one_more"), one_more.alias("filled"))
        else:
            found = _leading_cells(spark, group, sep, header, len(names))
        indexed = _indexed(found)
        for part in ([f for f in group if f.path in indexed], [f for f in group if f.path not in indexed]):
            if not part:
                continue
            if part[0].path in indexed:
                frames.append(drop_first_index_column(cells(part, [_INDEX, *names])[0].drop(_INDEX, _RECORD), "csv"))
                continue
            # an extra column tells rows that have more cells than the header
            df, schema = cells(part, [*names, _OVERFLOW])
            if rejects is not None and not skip_long_rows:
                rejects.append(_long_rows(spark, part, df, schema, options, header, whole))
            if rejects is not None or skip_long_rows:
                df = df.filter(F.col(_OVERFLOW).isNull())
            frames.append(drop_first_index_column(df.drop(_OVERFLOW, _RECORD), "csv"))
    return frames


def _leading_cells(spark: SparkSession, group: list[SourceFile], sep: str, header: str, width: int) -> DataFrame:
    """First cell ``t`` of every line, whether the line has one cell more than the header, and whether
    its last cell is filled.  Counted in the text, as the parser does not tell empty from absent."""
    lines = spark.read.text([f.path for f in group])
    lines = with_lineage(lines, group, F.col("_metadata.file_path"), place_in_split())
    parts = F.split(F.regexp_replace("value", '"[^"]*"', "x"), "\\Q" + sep + "\\E")
    first = F.trim(F.replace(F.split_part("value", F.lit(sep), F.lit(1)), F.lit('"'), F.lit("")))
    return lines.filter((F.trim("value") != "") & (F.col("value") != header)).select(
        "file_source", "ingest_seq", first.alias("t"), (F.size(parts) == width + 1).alias("one_more"), (F.trim(F.element_at(parts, -1)) != "").alias("filled")
    )


def _indexed(cells: DataFrame) -> set[str]:
    """Files (``file_source``) each of whose rows has one cell more than the header and begins with a
    number that counts up by one.  One aggregate; a row per such file comes back.

    A last cell that is empty everywhere comes of separators at the ends of lines, not of an index.
    """
    n = F.col("t").try_cast("bigint")
    per_file = (
        cells.withColumn("n", n)
        .groupBy("file_source")
        .agg(
            F.count_if(~F.col("one_more") | F.col("n").isNull() | ~F.col("t").rlike(r"^\d+$")).alias("others"),
            F.count_if("filled").alias("filled"),
            F.count("*").alias("rows"),
            F.count_distinct("n").alias("distinct"),
            F.min("n").alias("low"),
            F.max("n").alias("high"),
            F.min_by("n", "ingest_seq").alias("first"),
            F.max_by("n", "ingest_seq").alias("end"),
        )
    )
    counts_up = "rows = distinct and high - low + 1 = rows and first = low and end = high"
    return {r.file_source for r in per_file.filter(f"others = 0 and filled > 0 and {counts_up}").select("file_source").collect()}


def _long_rows(spark: SparkSession, group, df: DataFrame, schema, options: dict, header: str, whole: bool) -> DataFrame:
    """Rows with more cells than the header, as they stand in the file."""
    if whole:
        long = df.filter(F.col(_OVERFLOW).isNotNull())
        record = F.col(_RECORD)
    else:
        lines = spark.read.text([f.path for f in group])
        lines = with_lineage(lines, group, F.col("_metadata.file_path"), place_in_split())
        cells = F.from_csv("value", schema.toDDL(), options)
        long = lines.filter((F.col("value") != header) & cells[_OVERFLOW].isNotNull())
        record = F.col("value")
    return long.select("file_source", "ingest_seq", record.alias("record"), F.lit(TOO_LONG).alias("reason"))


def _ragged(names: list[str]) -> bool:
    """The header came out as one cell that still holds separators."""
    return "\t" in names[0]


def _resplit(spark: SparkSession, group: list[SourceFile], sep: str, header: str) -> DataFrame:
    """Split the lines by hand: no quoting, a leading row number dropped, rows
    cut or filled to the width of the header."""
    cells = header.split(sep)[1:] if header.startswith("\t") else header.split(sep)
    names = [n for n in (c.strip().strip('"').strip("'") for c in cells) if n]
    lines = spark.read.text([f.path for f in group])
    lines = with_lineage(lines, group, F.col("_metadata.file_path"), place_in_split())
    return resplit_lines(lines, names, sep, header)


def resplit_lines(lines: DataFrame, names: list[str], sep: str, header: str) -> DataFrame:
    """``value`` lines -> text columns ``names``."""
    body = lines.filter((F.trim("value") != "") & (F.col("value") != header))
    parts = F.split(F.col("value"), "\\Q" + sep + "\\E")
    width = len(names)
    numbered = F.trim(F.element_at(parts, 1)).rlike(r"^\d+$")
    kept = F.when(numbered, F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))).otherwise(parts)
    bare = F.transform(kept, lambda c: F.regexp_replace(F.trim(c), "^\"+|\"+$|^'+|'+$", ""))
    padded = F.slice(F.concat(bare, F.array_repeat(F.lit(""), width)), 1, width)
    rest = [c for c in lines.columns if c != "value"]
    return body.select(*[padded[i].alias(n) for i, n in enumerate(names)], *rest)


def parquet_frames(spark: SparkSession, files: list[SourceFile]) -> list[DataFrame]:
    """Column types are kept; files with fewer columns are filled with NULLs."""
    df = spark.read.option("mergeSchema", "true").parquet(*[f.path for f in files])
    return [with_lineage(df, files, F.col("_metadata.file_path"), F.col("_metadata.row_index"))]


def json_frames(spark: SparkSession, files: list[SourceFile], rejects: list[DataFrame] | None = None) -> list[DataFrame]:
    """A document per file: a list of records, or columns of {row: value}.

    A document cannot be split, so a file is read by one task.  One that is
    neither goes to ``rejects`` whole; without that list its name is logged.
    """
    text = spark.read.text([f.path for f in files], wholetext=True).select(
        F.col("_metadata.file_path").alias("__path"), "value"
    )
    broken = text.filter(~F.coalesce(_is_document(), F.lit(False)))
    if rejects is None:
        for row in broken.select("__path").collect():
            log.warning("%s: %s", row["__path"], NO_DOCUMENT)
    else:
        broken = with_lineage(broken, files, F.col("__path"), F.lit(0).cast("bigint"))
        rejects.append(broken.select("file_source", "ingest_seq", F.col("value").alias("record"), F.lit(NO_DOCUMENT).alias("reason")))
    rows = json_rows(text)
    # one entry per column name
    names = [r.name for r in rows.select(F.explode(F.map_keys("cells")).alias("name")).distinct().orderBy("name").collect()]
    named = rows.select("__path", "row", *[F.col("cells")[n].alias(n) for n in names])
    return [with_lineage(named, files, F.col("__path"), F.col("row")).drop("__path", "row")]


def _is_document() -> Column:
    listed = F.ltrim("value").startswith("[")
    records = F.from_json("value", "array<map<string,string>>").isNotNull()
    columns = F.from_json("value", "map<string,map<string,string>>").isNotNull()
    return F.when(listed, records).otherwise(columns)


def json_rows(text: DataFrame) -> DataFrame:
    """(__path, value) documents -> (__path, row, cells) with cells by name."""
    listed = F.ltrim("value").startswith("[")
    records = text.filter(listed).select(
        "__path", F.posexplode(F.from_json("value", "array<map<string,string>>")).alias("row", "cells")
    )
    columns = text.filter(~listed).select(
        "__path", F.explode(F.from_json("value", "map<string,map<string,string>>")).alias("name", "column")
    )
    # rows are keyed 0, 1, 2, ... as text; a group holds one cell per column
    by_row = (
        columns.select("__path", "name", F.explode("column").alias("row", "value"))
        .groupBy("__path", F.col("row").try_cast("bigint").alias("row"))
        .agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("cells"))
    )
    return records.select("__path", F.col("row").cast("bigint").alias("row"), "cells").unionByName(by_row)


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs as columns named by their path."""

    def leaves(schema: T.StructType, path: tuple[str, ...]):
        for f in schema.fields:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, here)
            else:
                yield here

    return df.select(
        *[
            F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path))
            for path in leaves(df.schema, ())
        ]
    )


def _promote_header(rows: DataFrame, files: list[SourceFile], kind: str) -> list[DataFrame]:
    """Cells by row -> columns named by row 0 of each table.

    The cells are written once, as every layout reads them again.  The layouts,
    not the tables, come to the driver; the tables of a layout are found by a
    join on (file, table).
    """
    rows = materialize(rows, "cells")
    headers = rows.filter(F.col("row_no") == 0).select("__path", "table_no", "cells", F.to_json(F.struct("cells")).alias("layout"))
    layouts = headers.groupBy("layout").agg(F.first("cells").alias("cells")).orderBy("layout").collect()
    frames = []
    for layout in layouts:
        names = _unique([(c or "").strip() for c in layout["cells"]])
        mine = headers.filter(F.col("layout") == layout["layout"]).select("__path", "table_no")
        body = rows.filter(F.col("row_no") > 0).join(mine, ["__path", "table_no"], "left_semi")
        named = body.select(
            *[F.get(F.col("cells"), F.lit(i)).alias(n) for i, n in enumerate(names)], "__path", "table_no", "row_no"
        )
        place = F.shiftleft(F.col("table_no").cast("bigint"), 28) + F.col("row_no")
        out = with_lineage(named, files, F.col("__path"), place).drop("__path", "row_no")
        frames.append(drop_first_index_column(out.drop("table_no"), kind) if kind != "tables" else out)
    return frames


def _cells(spark: SparkSession, files: list[SourceFile], parse) -> DataFrame:
    content = spark.read.format("binaryFile").load([f.path for f in files]).select(
        F.col("_metadata.file_path").alias("__path"), "content"
    )
    return content.mapInPandas(parse, "__path string, table_no int, row_no int, cells array<string>")


def excel_frames(spark: SparkSession, files: list[SourceFile]) -> list[DataFrame]:
    """First sheet of each workbook, one task per file."""
    return _promote_header(_cells(spark, files, documents.sheet_cells), files, "excel")


def html_frames(spark: SparkSession, files: list[SourceFile]) -> list[DataFrame]:
    """First table of each page."""
    rows = _cells(spark, files, documents.table_cells).filter(F.col("table_no") == 0)
    return _promote_header(rows, files, "html")


def html_table_frames(spark: SparkSession, files: list[SourceFile]) -> list[DataFrame]:
    """Every table of each page, told apart by ``table_no``."""
    return _promote_header(_cells(spark, files, documents.table_cells), files, "tables")


# extension -> reader; a reader gives one frame per layout found
READERS: dict[str, Callable[..., list[DataFrame]]] = {
    "csv": delimited_frames,
    "parquet": parquet_frames,
    "json": json_frames,
    "xlsx": excel_frames,
    "html": html_frames,
}


def read(spark: SparkSession, files: list[SourceFile], reader: Callable[..., list[DataFrame]], **options) -> DataFrame:
    """All layouts in one frame; a column that a layout lacks is NULL there."""
    return union_all(reader(spark, files, **options))


def file_frames(
    spark: SparkSession, files: list[SourceFile], clean: bool = True, rejects: list[DataFrame] | None = None
) -> list[DataFrame]:
    """Files of any known format, cleaned, one frame per layout.

    Files of an unknown format are left out (see ``unsupported``); ``rejects``
    takes what does not fit its file (see ``delimited_frames``).
    """
    frames = []
    for (kind,), group in _groups([(f, (f.extension,)) for f in files]).items():
        reader = READERS.get(kind)
        if reader is None:
            log.warning("unsupported file type %r: %d file(s)", kind, len(group))
            continue
        options = {"rejects": rejects} if kind in ("csv", "json") else {}
        frames += [clean_frame(df) if clean else df for df in reader(spark, group, **options)]
    return frames


def read_files(
    spark: SparkSession, files: list[SourceFile], clean: bool = True, rejects: list[DataFrame] | None = None
) -> DataFrame | None:
    frames = file_frames(spark, files, clean, rejects)
    return union_all(frames) if frames else None


def unsupported(files: list[SourceFile]) -> list[SourceFile]:
    return [f for f in files if f.extension not in READERS]
