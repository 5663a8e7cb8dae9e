"""Readers on small files of every format."""

import os

import feeds
import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import staging
from tallyhouse.sources import discovery, documents, incremental, readers


def files_of(spark, root, pattern="*", **options):
    return discovery.source_files(discovery.find_files(spark, str(root), pattern, **options))


def test_discovery_skips_look_alikes_and_test_folders(spark, tmp_path):
    for name in (
        "a/campaign_data.csv",
        "b/transactional_campaign_data.csv",
        "Test/x/campaign_data_late.csv",
        "b/merchant_data.html",
        "b/order_with_merchant_data.csv",
    ):
        feeds.write(tmp_path, name, "x\n")

    def names(dataset, root=tmp_path):
        listing = discovery.dataset_files(spark, str(root), dataset)
        return [os.path.relpath(f.path.replace("file:", ""), root) for f in discovery.source_files(listing)]

    assert names("campaign_data") == ["a/campaign_data.csv"]
    assert names("transactional_campaign_data") == ["b/transactional_campaign_data.csv"]
    assert names("merchant_data") == ["b/merchant_data.html"]
    # a root inside a skipped folder is searched
    assert names("campaign_data", tmp_path / "Test") == ["x/campaign_data_late.csv"]
    everything = discovery.find_files(spark, str(tmp_path), "*campaign_data*", skip_dirs=())
    assert everything.count() == 3


@pytest.mark.parametrize(
    "line,sep", [("a\tb\tc", "\t"), ("a,b,c", ","), ("a,b\tc\td", "\t"), ("a,b\tc", ","), ("abc", "\t")]
)
def test_tab_or_comma(line, sep):
    assert discovery.tab_or_comma(line) == sep


@pytest.mark.parametrize("text,sep", [("a;b;c\n1;2;3", ";"), ("a|b", "|"), ("abc", ","), ("a\tb\tc,d", "\t")])
def test_dominant_separator(text, sep):
    assert discovery.dominant_separator(text) == sep


def test_csv_quotes_order_and_layouts(spark, tmp_path, rows):
    feeds.write(tmp_path, "a.csv", ',order id,note\n0,o1,"say ""hi"", you"\n1,o2,\n\n')
    feeds.write(tmp_path, "b.csv", "﻿\tnote\torder id\n0\tlater\to3\n")
    df = readers.read_files(spark, files_of(spark, tmp_path, "*.csv"))
    got = [(r.order_id, r.note) for r in df.orderBy("ingest_seq").collect()]
    assert got == [("o1", 'say "hi", you'), ("o2", None), ("o3", "later")]
    assert {os.path.basename(r.file_source) for r in df.collect()} == {"a.csv", "b.csv"}


def test_reading_order_over_many_splits(spark, tmp_path):
    feeds.write(tmp_path, "big_1.csv", ",k,v\n" + "".join(f"{i},a{i},{'x' * 40}\n" for i in range(3000)))
    feeds.write(tmp_path, "big_2.csv", ",k,v\n" + "".join(f"{i},b{i},y\n" for i in range(50)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 22))
    try:
        df = readers.read(spark, files_of(spark, tmp_path), readers.delimited_frames)
        got = [r.k for r in df.orderBy("ingest_seq").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [f"a{i}" for i in range(3000)] + [f"b{i}" for i in range(50)]


def test_long_rows_are_skipped_and_short_ones_filled(spark, tmp_path, rows):
    feeds.write(tmp_path, "a.csv", "x;y;z\n1;2;3\n1;2\n1;2;3;4\n")
    df = readers.read(
        spark, files_of(spark, tmp_path), readers.delimited_frames, separator=discovery.dominant_separator, skip_long_rows=True
    )
    assert rows(df, "x", "y", "z") == [("1", "2", "3"), ("1", "2", None)]


def test_ragged_lines(spark, rows):
    lines = spark.createDataFrame(
        [("id\tname",), ("0\tu1\t'Ann'",), ("1\tu2",), ("u3\tBob\tsurplus\tmore",), ("  ",)], "value string"
    )
    out = readers.resplit_lines(lines, ["id", "name"], "\t", "id\tname")
    assert rows(out, "id", "name") == [("u1", "Ann"), ("u2", ""), ("u3", "Bob")]


def test_json_shapes(spark, tmp_path, rows):
    feeds.write(tmp_path, "a.json", '[{"id": 1, "name": "x"}, {"id": 2, "extra": {"k": 1}}]')
    feeds.write(tmp_path, "b.json", '{"id": {"0": 3, "1": 4}, "name": {"0": "y", "1": null}}')
    df = readers.read(spark, files_of(spark, tmp_path), readers.json_frames)
    assert rows(df, "id", "name") == [("1", "x"), ("2", None), ("3", "y"), ("4", None)]
    assert [r.id for r in df.orderBy("ingest_seq").collect()] == ["1", "2", "3", "4"]


def test_flatten(spark):
    df = spark.sql("select 1 a, named_struct('b', 2, 'c', named_struct('d', 3)) s")
    assert readers.flatten(df).columns == ["a", "s.b", "s.c.d"]


def test_html_tables(spark, tmp_path, rows):
    page = feeds.html_table(["", " order_id ", "delay in days"], [["0", "o1", "3 days"], ["1", "o2", "x &amp; y"]])
    page += "<table><tr><th>k<th>v<tr><td>1<td>2</table>"
    feeds.write(tmp_path, "a.html", page)
    files = files_of(spark, tmp_path)
    df = readers.read(spark, files, readers.html_frames)
    assert rows(df, "order_id", "`delay in days`") == [("o1", "3 days"), ("o2", "x & y")]
    every = readers.read(spark, files, readers.html_table_frames)
    assert sorted((r.table_no, r.k, r.order_id) for r in every.collect()) == [
        (0, None, "o1"),
        (0, None, "o2"),
        (1, "1", None),
    ]


def test_nested_tables_stay_apart():
    page = "<table><tr><td>a<table><tr><td>inner</td></tr></table></td><td>b</td></tr></table>"
    tables = documents.html_tables(page)
    assert tables[1] == [["inner"]] and len(tables) == 2


def test_workbook(spark, tmp_path, rows):
    feeds.workbook(str(tmp_path / "p.xlsx"), [["", "product_id", "price"], [0, "P1", 2.5], [1, "P2", None], [2, None, 3]])
    df = readers.read(spark, files_of(spark, tmp_path), readers.excel_frames)
    assert rows(df, "product_id", "price") == [("P1", "2.5"), ("P2", None), (None, "3")]


def test_parquet_keeps_order(spark, tmp_path):
    spark.range(100).select("id", F.lit("x").alias("v")).coalesce(1).write.parquet(str(tmp_path / "t"))
    df = readers.read(spark, files_of(spark, tmp_path, "*.parquet"), readers.parquet_frames)
    assert [r.id for r in df.orderBy("ingest_seq").collect()] == list(range(100))


def test_unknown_formats_are_left_out(spark, tmp_path):
    feeds.write(tmp_path, "a.csv", "k,v\nx,1\n")
    feeds.write(tmp_path, "b.zip", "nothing")
    files = files_of(spark, tmp_path)
    assert readers.read_files(spark, files).count() == 1
    assert [f.extension for f in readers.unsupported(files)] == ["zip"]
    listing = discovery.find_files(spark, str(tmp_path))
    loaded = readers.read_files(spark, files)
    out = incremental.ingestion_log(
        loaded, "t", listing.filter("path like '%.csv'"), listing.filter("path like '%.zip'")
    )
    assert sorted((r.status, r.rows_ingested, r.message) for r in out.collect()) == [
        ("skipped", 0, "Unsupported ext .zip"),
        ("success", 1, None),
    ]


def test_decisions(spark, rows):
    listing = spark.sql(
        """select * from values ('new', timestamp'2024-01-02'), ('same', timestamp'2024-01-02'),
        ('changed', timestamp'2024-01-05'), ('undated', timestamp'2024-01-02') t(path, modified)"""
    )
    staged = spark.sql(
        """select * from values ('same', timestamp'2024-01-03'), ('changed', timestamp'2024-01-01'),
        ('changed', timestamp'2024-01-03'), ('undated', cast(null as timestamp)) t(file_source, loaded_at)"""
    )
    got = {r.path: (r.decision, r.reason) for r in incremental.decide_files(listing, staged).collect()}
    assert got == {
        "new": ("process", incremental.NEW),
        "same": ("skip", incremental.UNCHANGED),
        "changed": ("process", incremental.MODIFIED),
        "undated": ("skip", incremental.UNDATED),
    }
    assert incremental.decide_files(listing, staged, force=True).filter("decision = 'process'").count() == 4
    assert rows(incremental.new_files(listing, staged), "path") == [("new",)]


def test_index_columns(spark):
    df = spark.createDataFrame(
        [(i, str(i), str(i), str(5 - i), "v") for i in range(5)], ["ingest_seq", "_c0", "0", "1", "my_Old_ID"]
    )
    assert staging.data_columns(staging.drop_index_columns(df)) == ["1"]
    keys = spark.createDataFrame([(i, str(100 + 7 * i), "v") for i in range(5)], ["ingest_seq", "id", "v"])
    assert "id" in staging.drop_first_index_column(keys).columns
    assert "id" not in staging.drop_first_index_column(keys, aggressive=True).columns


def test_aliases_prefer_the_sure_name(spark):
    df = spark.createDataFrame([("a", "b", "c")], ["phone", "contact_number", "id"])
    out = staging.resolve_aliases(df, "merchant_data")
    assert out.first().contact_number == "b" and "merchant_id" in out.columns
    late = spark.createDataFrame([("o", "3 days")], ["order_id", "delay_in_days"])
    assert staging.resolve_aliases(late, "order_delays").columns == ["order_id", "delay_days"]


def test_projection_without_common_columns(spark):
    assert staging.project_to_schema(spark.range(1), "order_delays") is None
