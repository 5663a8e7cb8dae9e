"""Sources, incremental ingestion, sinks and table upkeep.

Where an operator reads files, Spark first writes one of the given tables in
that format to the scratch folder; what is read back must equal the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse import schemas
from tallyhouse.catalog.base import Query
from tallyhouse.catalog.star_sql import with_star
from tallyhouse.catalog.workbooks import workbook_bytes
from tallyhouse.operators import relational as rel
from tallyhouse.operators.keys import with_ingest_seq
from tallyhouse.plans import sample_star, views
from tallyhouse.plans.refresh import upsert_order_files
from tallyhouse.plans.sample_star import table
from tallyhouse.plans.store import Store, with_missing_column
from tallyhouse.session import materialize, scratch_path
from tallyhouse.sources import discovery, incremental, readers
from tallyhouse.streaming import arrivals

star = sample_star.star


# --- files made from the tables ----------------------------------------------------------


def customers(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        # quotes and separators inside a cell
        F.concat(F.lit('say "'), F.col("c_name"), F.lit('", all')).alias("c_name"),
        "c_mktsegment",
    )


_CUSTOMERS = "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, concat('say \"', c_name, '\", all') AS c_name, c_mktsegment FROM customer"


def _write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> None:
    df.write.csv(path, sep=sep, header=header, quote='"', escape='"', mode="errorifexists")


def _files(spark: SparkSession, root: str, pattern: str = "*") -> list[discovery.SourceFile]:
    return discovery.source_files(discovery.find_files(spark, root, pattern))


def _rows_of(spark: SparkSession, listing: DataFrame) -> DataFrame:
    """Rows of each file found; the files differ in their columns, so each is a scan of its own."""
    found = discovery.source_files(listing)
    return rel.union_all(
        [spark.read.parquet(f.path).agg(F.lit(f.path.rsplit("/", 1)[-1]).alias("name"), F.count("*").alias("rows")) for f in found]
    )


def src_discover(spark, sf_dir):
    """The files of the data set itself, with their rows."""
    return _rows_of(spark, discovery.find_files(spark, sf_dir, "*.parquet"))


def src_exclude_name(spark, sf_dir):
    return _rows_of(spark, discovery.find_files(spark, sf_dir, "*.parquet", exclude_name="ORDERS"))


_NAMES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
]


def _name_rows(skip: str = "") -> str:
    return " UNION ALL ".join(f"SELECT '{n}.parquet' AS name, COUNT(*) AS rows FROM {n}" for n in _NAMES if n != skip)


def src_csv_auto(spark, sf_dir):
    """Half of the markets as comma files, the others as tab files."""
    root = scratch_path(spark, "csv")
    df = customers(spark, sf_dir)
    early = F.col("c_mktsegment") < "G"
    _write_csv(df.filter(early), f"{root}/comma")
    _write_csv(df.filter(~early), f"{root}/tab", "\t")
    return readers.read(spark, _files(spark, root, "*.csv"), readers.delimited_frames)


def src_csv_multi(spark, sf_dir):
    """Four separators; a row with a cell too many is dropped."""
    root = scratch_path(spark, "csv")
    df = customers(spark, sf_dir)
    markets = {"AUTOMOBILE": ",", "BUILDING": "\t", "FURNITURE": ";", "HOUSEHOLD": "|", "MACHINERY": "|"}
    for sep in dict.fromkeys(markets.values()):
        mine = df.filter(F.col("c_mktsegment").isin([m for m, s in markets.items() if s == sep]))
        cells = F.concat_ws(
            sep,
            *[F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"')) for c in df.columns],
            # some rows get one cell more than the header
            F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("surplus")),
        )
        header = spark.range(1).select(F.lit(sep.join(df.columns)).alias("value"))
        folder = f"{root}/{ord(sep)}"
        # every part file needs the header as its first line
        lines = mine.select(cells.alias("value"))
        _write_lines(header, lines, folder)
    return readers.read(
        spark, _files(spark, root), readers.delimited_frames, separator=discovery.dominant_separator, skip_long_rows=True
    )


def _write_lines(header: DataFrame, lines: DataFrame, folder: str) -> None:
    """Text files that each start with the header line: the header is sent to
    every file, then sorted to its top."""
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heads = header.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(0).alias("rank"), "value")
    body = lines.select(F.pmod(F.hash("value"), F.lit(parts)).alias("part"), F.lit(1).alias("rank"), "value")
    stacked = heads.unionByName(body).repartition(parts, "part").sortWithinPartitions("part", "rank")
    stacked.select("part", "value").write.partitionBy("part").text(folder)


def src_csv_ragged(spark, sf_dir):
    """Files whose header stands in one pair of quotes: lines are split by hand, a row number is dropped,
    short rows are filled and long ones cut."""
    root = scratch_path(spark, "ragged")
    c = table(spark, sf_dir, "customer")
    line = F.concat_ws(
        "\t",
        F.col("c_custkey").cast("string"),
        F.concat(F.lit('"'), F.col("c_name"), F.lit('"')),
        F.when(F.col("c_acctbal") > 1000, F.col("c_mktsegment")),
        F.when(F.col("c_acctbal") > 5000, F.lit("surplus")),
    )
    header = spark.range(1).select(F.lit('"\tname\tsegment"').alias("value"))
    _write_lines(header, c.select(line.alias("value")), root)
    return readers.read(spark, _files(spark, root, "*.txt"), readers.delimited_frames)


def src_csv_breaks(spark, sf_dir):
    """Cells with line breaks, quotes and separators, beside files with stray quotes; rows with a cell too
    many are kept apart."""
    root = scratch_path(spark, "breaks")
    df = customers(spark, sf_dir).withColumn("c_name", F.concat("c_name", F.lit("\nof "), "c_mktsegment", F.lit(', "so"\n')))
    early = F.col("c_mktsegment") < "G"
    cell = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    surplus = F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("sur\nplus"))
    broken = F.concat_ws(",", *[cell(F.col(c)) for c in df.columns], cell(surplus))
    stray = F.concat_ws(",", F.col("c_custkey"), F.concat(F.lit('screen 5" '), F.col("c_custkey")), F.col("c_mktsegment"))
    header = spark.range(1).select(F.lit(",".join(df.columns)).alias("value"))
    _write_lines(header, df.filter(early).select(broken.alias("value")), f"{root}/a")
    _write_lines(header, df.filter(~early).select(stray.alias("value")), f"{root}/b")
    rejects: list[DataFrame] = []
    read = readers.read(spark, _files(spark, root, "*.txt"), readers.delimited_frames, rejects=rejects)
    lost = rel.union_all(rejects).select(F.lit(None).cast("string").alias("c_custkey"), F.col("record").alias("c_name"), F.col("reason").alias("c_mktsegment"))
    return read.select("c_custkey", "c_name", "c_mktsegment").unionByName(lost)


def src_parquet(spark, sf_dir):
    return readers.read(spark, _files(spark, sf_dir, "customer.parquet"), readers.parquet_frames).select(
        "c_custkey", "c_name", "c_mktsegment", F.element_at(F.split("file_source", "/"), -1).alias("file")
    )


# A document holds the customers of one block of keys, so its size is bounded.
BLOCK = 1000


def _blocks(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.floor(F.col("c_custkey") / BLOCK).cast("string").alias("__path"),
        F.col("c_custkey").cast("string").alias("c_custkey"),
        "c_name",
        "c_mktsegment",
        "c_nationkey",
    )


def src_json(spark, sf_dir):
    """Documents that list records, and documents of columns."""
    fields = ("c_custkey", "c_name", "c_mktsegment")
    docs = _blocks(spark, sf_dir)
    as_records = docs.filter(F.col("c_nationkey") < 12).groupBy("__path").agg(
        F.to_json(F.collect_list(F.struct(*fields))).alias("value")
    )
    column = lambda name: F.map_from_entries(F.collect_list(F.struct(F.col("c_custkey"), F.col(name))))
    as_columns = docs.filter(F.col("c_nationkey") >= 12).groupBy("__path").agg(
        F.to_json(F.create_map(*[x for f in fields for x in (F.lit(f), column(f))])).alias("value")
    )
    both = as_records.withColumn("kind", F.lit("r")).unionByName(as_columns.withColumn("kind", F.lit("c")))
    broken = spark.createDataFrame([("x", '{"c_name": [1, 2', "b")], "__path string, value string, kind string")
    root = scratch_path(spark, "json")
    _write_documents(both.unionByName(broken).select(F.concat("kind", "__path").alias("__path"), F.encode("value", "UTF-8").alias("content")), root, "json")
    rejects: list[DataFrame] = []
    read = readers.read(spark, _files(spark, root), readers.json_frames, rejects=rejects)
    lost = rejects[0].select(F.lit(None).cast("string").alias("c_custkey"), F.col("record").alias("c_name"), F.col("reason").alias("c_mktsegment"))
    return read.select(*fields).unionByName(lost)


def _write_documents(docs: DataFrame, root: str, extension: str) -> None:
    """One file for each (__path, content); they come to the driver one at a time."""
    spark = docs.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for row in docs.select("__path", "content").toLocalIterator():
        path = jvm.org.apache.hadoop.fs.Path(f"{root}/{row['__path']}.{extension}")
        stream = path.getFileSystem(conf).create(path, False)
        stream.write(row["content"])
        stream.close()


def src_json_flatten(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    nested = e.select("event_id", F.struct(F.struct(F.from_json("props", "k BIGINT").alias("props"), "value").alias("body")).alias("doc"))
    return readers.flatten(nested).withColumnsRenamed(
        {"doc.body.props.k": "doc_body_props_k", "doc.body.value": "doc_body_value"}
    )



def _pages(spark, sf_dir) -> list[discovery.SourceFile]:
    """Pages with a table of customers, whose market spans the rows that share it, and a table with their
    number, whose name spans two columns."""
    blocks = _blocks(spark, sf_dir).withColumn("at", F.col("c_custkey").cast("bigint"))
    of_market = blocks.groupBy("__path", "c_mktsegment").agg(F.sort_array(F.collect_list(F.struct("at", "c_name"))).alias("c"))
    cells = lambda x: F.concat(F.lit("<td>"), x["c_name"], F.lit(" </td><td> "), x["at"].cast("string"), F.lit("</td></tr>"))
    span = F.concat(F.lit('<td rowspan="'), F.size("c").cast("string"), F.lit('">'), F.col("c_mktsegment"), F.lit("</td>"))
    rows = F.transform("c", lambda x, i: F.concat(F.lit("<tr>"), F.when(i == 0, span).otherwise(""), cells(x)))
    of_market = of_market.select("__path", F.array_join(rows, "").alias("rows"), F.size("c").alias("n"))
    page = F.concat(
        F.lit("<html><script>'<table>'</script><table><tr><th>c_mktsegment</th><th>c_name </th><th> c_custkey</th></tr>"),
        F.array_join(F.collect_list("rows"), ""),
        F.lit('</table><table><tr><th colspan="2">page</th><th>n</th></tr><tr><td colspan=2>p'),
        F.col("__path"),
        F.lit("</td><td>"),
        F.sum("n").cast("string"),
        F.lit("</td></tr></table></html>"),
    )
    root = scratch_path(spark, "pages")
    _write_documents(of_market.groupBy("__path").agg(F.encode(page, "UTF-8").alias("content")), root, "html")
    return _files(spark, root)


def src_html_table(spark, sf_dir):
    return readers.read(spark, _pages(spark, sf_dir), readers.html_frames)


def src_html_tables(spark, sf_dir):
    """The tables of a page have columns of their own; those of the other table are missing."""
    read = readers.read(spark, _pages(spark, sf_dir), readers.html_table_frames)
    return read.select("table_no", F.coalesce("c_mktsegment", "page").alias("first_cell"), F.coalesce("c_name", "page_1").alias("second_cell"), F.coalesce("c_custkey", "n").alias("third_cell"))


def src_excel(spark, sf_dir):
    """Workbooks with text, days and flags, written by a small helper."""
    more = _blocks(spark, sf_dir).withColumns({"opened": F.lit(43831) + F.col("c_custkey").cast("int") % 1000, "big": F.col("c_nationkey") > 12})
    root = scratch_path(spark, "books")
    _write_documents(more.groupBy("__path").applyInPandas(workbook_bytes, "__path string, content binary"), root, "xlsx")
    return readers.read(spark, _files(spark, root), readers.excel_frames)


def src_dispatch(spark, sf_dir):
    """Parquet and CSV are read, an unknown extension is left out and logged."""
    root = scratch_path(spark, "mixed")
    df = customers(spark, sf_dir)
    _write_csv(df.filter(F.col("c_mktsegment") < "G"), f"{root}/a")
    df.filter(F.col("c_mktsegment") >= "G").write.parquet(f"{root}/b")
    df.select(F.col("c_name").alias("value")).write.text(f"{root}/c")
    files = [f for f in _files(spark, root) if not f.path.endswith("_SUCCESS")]
    read = readers.read_files(spark, files, clean=False)
    return read.withColumn("skipped_files", F.lit(len(readers.unsupported(files)) > 0))


def src_concat_files(spark, sf_dir):
    """Tables that differ in columns, one after the other."""
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"))
    return rel.union_all([a, b])


def scan_staging(spark, sf_dir):
    """Rows of each of the thirteen staging tables."""
    tables = sample_star.staging(spark, sf_dir)
    return rel.union_all([tables[d].agg(F.lit(d).alias("dataset"), F.count("*").alias("rows")) for d in schemas.STAGING])


_SCAN_SQL = {
    "campaign_data": "(SELECT COUNT(DISTINCT o_orderpriority) - 1 FROM orders)",
    "transactional_campaign_data": "(SELECT COUNT(*) FROM orders)",
    "order_data": "(SELECT COUNT(*) FROM orders)",
    "line_item_data_prices": "(SELECT COUNT(*) FROM lineitem)",
    "line_item_data_products": "(SELECT COUNT(*) FROM lineitem)",
    "order_delays": "(SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'F')",
    "product_list": "(SELECT COUNT(*) FROM part)",
    "user_data": "(SELECT COUNT(*) FROM customer)",
    "user_job": "(SELECT COUNT(*) FROM customer)",
    "user_credit_card": "(SELECT COUNT(*) FROM customer)",
    "merchant_data": "(SELECT COUNT(*) FROM supplier)",
    "staff_data": "(SELECT COUNT(*) FROM nation)",
    "order_with_merchant_data": "(SELECT COUNT(DISTINCT l_orderkey) FROM lineitem)",
}


def scan_staging_pattern(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    for name in ("stg_pattern_customer_a", "stg_pattern_customer_b", "stg_pattern_customer_tbl1"):
        c.createOrReplaceTempView(name)
    found = incremental.staging_tables(spark, "stg_pattern_customer")
    with_sub = incremental.staging_tables(spark, "stg_pattern_customer", sub_tables=True)
    return rel.side_by_side(found.agg(F.count("*").alias("rows")), with_sub.agg(F.count("*").alias("with_sub_tables")))


# --- incremental -------------------------------------------------------------------------


def _listing(spark, sf_dir) -> DataFrame:
    """Order days as file names, with a time of change."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("path"))
        .agg(F.max("o_orderdate").cast("timestamp").alias("modified"))
    )


def _staged(spark, sf_dir) -> DataFrame:
    """Rows loaded from those files: urgent orders only, low ones a day early."""
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority").isin("1-URGENT", "5-LOW", "2-HIGH"))
    day = F.col("o_orderdate").cast("timestamp")
    loaded = (
        F.when(F.col("o_orderpriority") == "1-URGENT", day + F.expr("INTERVAL 1 DAY"))
        .when(F.col("o_orderpriority") == "5-LOW", day - F.expr("INTERVAL 1 DAY"))
    )
    return o.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("file_source"), loaded.alias("loaded_at"))


_STAGED = """(SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS path, MAX(CASE o_orderpriority WHEN '1-URGENT'
    THEN o_orderdate + INTERVAL 1 DAY WHEN '5-LOW' THEN o_orderdate - INTERVAL 1 DAY END) AS last_loaded
    FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW', '2-HIGH') GROUP BY 1)"""
_LISTING = "(SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS path, MAX(o_orderdate) AS modified FROM orders GROUP BY 1)"
_DECIDED = f"""SELECT l.path, CASE WHEN s.path IS NULL THEN '{incremental.NEW}' WHEN last_loaded IS NULL THEN '{incremental.UNDATED}'
    WHEN modified > last_loaded THEN '{incremental.MODIFIED}' ELSE '{incremental.UNCHANGED}' END AS reason
    FROM {_LISTING} l LEFT JOIN {_STAGED} s ON s.path = l.path"""
_DECISION = f"CASE WHEN reason IN ('{incremental.NEW}', '{incremental.MODIFIED}') THEN 'process' ELSE 'skip' END"


def inc_new_files(spark, sf_dir):
    """Sources of the documents that have no toxic document loaded yet."""
    docs = table(spark, sf_dir, "documents")
    listing = docs.select(F.concat_ws("/", "source", "lang").alias("path")).distinct()
    toxic = table(spark, sf_dir, "labels").filter(F.col("toxic") == 1).select("doc_id")
    staged = docs.join(toxic, "doc_id", "left_semi").select(F.concat_ws("/", "source", "lang").alias("file_source"))
    return incremental.new_files(listing, staged)


def inc_modified(spark, sf_dir):
    return incremental.decide_files(_listing(spark, sf_dir), _staged(spark, sf_dir))


def inc_force(spark, sf_dir):
    return incremental.decide_files(_listing(spark, sf_dir), _staged(spark, sf_dir), force=True)


def _log(spark, sf_dir) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "failed").otherwise("interrupted")
    return table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("file_path"), F.lit("t").alias("table_name"), status.alias("status")
    )


def inc_log_skip(spark, sf_dir):
    return incremental.not_logged(_listing(spark, sf_dir), _log(spark, sf_dir), "t")


def inc_stats(spark, sf_dir):
    return incremental.decision_counts(inc_modified(spark, sf_dir).withColumn("dataset", F.lit("order_data")))


def _order_texts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("order_id"),
        F.concat(F.lit("USER"), F.col("o_custkey").cast("string")).alias("user_id"),
        F.concat((F.col("o_orderkey") % 15 + 1).cast("string"), F.lit("days")).alias("estimated arrival"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("transaction_date"),
    )


def inc_stream(spark, sf_dir):
    """Order files arrive in two parts with their columns in another order; each run of the stream
    takes what is new, and a batch that is tried again adds nothing."""
    root, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    store = Store(spark, scratch_path(spark, "store"))
    orders = _order_texts(spark, sf_dir)
    for part, rows in enumerate((F.col("transaction_date") < "1998-01-01", F.col("transaction_date") >= "1998-01-01")):
        columns = orders.columns[::-1] if part else orders.columns
        _write_csv(orders.filter(rows).select(*columns), f"{root}/{part}")
        arrivals.stage_arrivals(spark, root, store, checkpoint, dataset_of=lambda _: "order_data")
    arrived = spark.createDataFrame([(f.path, f.file_path) for f in _files(spark, f"{root}/1", "*.csv")], "path string, file_path string")
    arrivals.stage_batch(store, arrived, "arrivals", 1, lambda _: "order_data")
    return store.read(schemas.staging_table("order_data"))


def _dims_in(spark, sf_dir) -> Store:
    """A store that holds the dimensions only."""
    store = Store(spark, scratch_path(spark, "store"))
    tables = star(spark, sf_dir)
    for name in tables:
        if name.startswith("dim_"):
            store.replace(name, tables[name])
    return store


def inc_stream_facts(spark, sf_dir):
    """Orders, their merchants and their delays arrive as files and end in the fact; delays come last, so known orders change."""
    root, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    store, feed = _dims_in(spark, sf_dir), sample_star.staging(spark, sf_dir)
    _write_csv(_order_texts(spark, sf_dir), f"{root}/order_data")
    _write_csv(feed["order_with_merchant_data"].select("staff_id", "merchant_id", "order_id"), f"{root}/merchants")
    names = {"order_data": "order_data", "merchants": "order_with_merchant_data", "delays": "order_delays"}
    how = {"dataset_of": lambda path: names[path.rsplit("/", 2)[-2]], "calendar": sample_star.CALENDAR}
    arrivals.stream_into_star(spark, root, store, checkpoint, **how)
    _write_csv(feed["order_delays"].select("order_id", F.col("delay_days").cast("string").alias("delay in days")), f"{root}/delays")
    made = arrivals.stream_into_star(spark, root, store, checkpoint, **how)
    named = made["fact_orders"].join(made["dim_user"].select("user_sk", "user_id"), "user_sk")
    return named.join(made["dim_merchant"].select("merchant_sk", "merchant_id"), "merchant_sk")


# --- sinks and upkeep ----------------------------------------------------------------------


def sink_staging(spark, sf_dir):
    """Appended twice: rows keep the file they came from."""
    store = Store(spark, scratch_path(spark, "store"))
    delays = sample_star.staging(spark, sf_dir)["order_delays"].withColumns(
        {"file_source": F.lit("delays.csv"), "loaded_at": F.current_timestamp()}
    )
    name = schemas.staging_table("order_delays")
    store.append(name, delays)
    both = store.append(name, delays.withColumn("file_source", F.lit("again.csv")))
    return both.groupBy("file_source").agg(
        F.count("*").alias("rows"), F.sum("delay_days").alias("days"), F.count_if(F.col("loaded_at").isNull()).alias("undated")
    )


def sink_snapshot(spark, sf_dir):
    """A table is replaced while its old state is the input."""
    store = Store(spark, scratch_path(spark, "store"))
    fact = star(spark, sf_dir)["fact_orders"]
    store.replace("fact_orders", fact)
    doubled = store.read("fact_orders").withColumn("delay_days", F.col("delay_days") * 2)
    return store.replace("fact_orders", doubled, ["transaction_date_sk", "order_id"]).select(
        "order_id", "transaction_date_sk", "delay_days"
    )


def sink_merge(spark, sf_dir):
    """The orders of one day get another delay: only files with that day are written anew."""
    store = Store(spark, scratch_path(spark, "store"))
    fact = star(spark, sf_dir)["fact_orders"]
    by_day = fact.repartitionByRange(16, "transaction_date_sk", "order_id").sortWithinPartitions("transaction_date_sk", "order_id")
    store.replace("fact_orders", by_day)
    before = set(store.files("fact_orders"))
    day = fact.filter("transaction_date_sk = 19960102")
    changed = day.withColumns({"delay_days": F.col("delay_days") + 100, "__seq": F.lit(0)})
    upsert_order_files(store, materialize(changed, "changed"))
    kept = before & set(store.files("fact_orders"))
    return store.read("fact_orders").select("order_id", "delay_days", F.lit(len(kept) >= len(before) - 4).alias("others_stay"))


def inc_changes(spark, sf_dir):
    """What has come since a state: two appends after it, and not what was there."""
    store = Store(spark, scratch_path(spark, "store"))
    fact = star(spark, sf_dir)["fact_orders"]
    store.replace("fact_orders", fact.filter("transaction_date_sk < 19970101"))
    since = store.version("fact_orders")
    store.append("fact_orders", fact.filter("transaction_date_sk between 19970101 and 19971231"))
    store.append("fact_orders", fact.filter("transaction_date_sk > 19971231"))
    return store.changed_rows("fact_orders", since).select("order_id", "transaction_date_sk")


def sink_view(spark, sf_dir):
    views.register_views(spark, star(spark, sf_dir))
    views.register_views(spark, star(spark, sf_dir))
    return spark.sql("SELECT staff_id, total_orders_processed FROM vw_staff_performance")


def sink_materialize(spark, sf_dir):
    """A stored view, laid out by year and month and read back whole."""
    path = scratch_path(spark, "materialized")
    views.materialize_view(star(spark, sf_dir), "vw_sales_by_time", path)
    return spark.read.parquet(path).select("date", "year", "month", "total_orders", "total_revenue")


def sink_ingest_log(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("file_source"))
    listing = docs.select(F.col("file_source").alias("path")).distinct()
    skipped = table(spark, sf_dir, "documents").select(F.concat("source", F.lit(".zip")).alias("path")).distinct()
    return incremental.ingestion_log(docs, "documents", listing, skipped)


def sink_reset(spark, sf_dir):
    store = Store(spark, scratch_path(spark, "store"))
    fact = star(spark, sf_dir)["fact_line_items"]
    before = store.append("fact_line_items", fact).agg(F.count("*").alias("before"))
    before_rows = before.first()["before"]
    store.reset("fact_line_items")
    return store.read("fact_line_items").agg(F.count("*").alias("after")).withColumn("before", F.lit(before_rows))


def schema_add_column(spark, sf_dir):
    old = table(spark, sf_dir, "orders").select("o_orderkey")
    new = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("staff_id"))
    widened = with_missing_column(with_missing_column(old, "staff_id", "string"), "staff_id", "string")
    return rel.union_all([widened, new]).groupBy("o_orderkey").agg(
        F.count("*").alias("rows"), F.max("staff_id").alias("staff_id"), F.count_if(F.col("staff_id").isNull()).alias("missing")
    )


QUERIES = [
    Query("src_discover", src_discover, "name:s rows:i", _name_rows()),
    Query("src_exclude_name", src_exclude_name, "name:s rows:i", _name_rows("orders")),
    Query("src_csv_auto", src_csv_auto, "c_custkey:s c_name:s c_mktsegment:s", _CUSTOMERS),
    Query(
        "src_csv_multi",
        src_csv_multi,
        "c_custkey:s c_name:s c_mktsegment:s",
        f"{_CUSTOMERS} WHERE c_mktsegment <> 'MACHINERY'",
    ),
    Query(
        "src_csv_ragged",
        src_csv_ragged,
        "name:s segment:s",
        "SELECT c_name AS name, CASE WHEN c_acctbal > 1000 THEN c_mktsegment ELSE '' END AS segment FROM customer",
    ),
    Query(
        "src_csv_breaks",
        src_csv_breaks,
        "c_custkey:s c_name:s c_mktsegment:s",
        f"""WITH c AS (SELECT c_custkey, concat(c_name, chr(10), 'of ', c_mktsegment, ', "so"', chr(10)) AS c_name, c_mktsegment FROM ({_CUSTOMERS}))
        SELECT CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN c_custkey END AS c_custkey,
               CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN c_name
                    ELSE concat('"', c_custkey, '","', replace(c_name, '"', '""'), '","', c_mktsegment, '","sur', chr(10), 'plus"') END AS c_name,
               CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN c_mktsegment ELSE 'more cells than the header' END AS c_mktsegment
        FROM c WHERE c_mktsegment < 'G'
        UNION ALL SELECT c_custkey, concat('screen 5" ', c_custkey), c_mktsegment FROM c WHERE c_mktsegment >= 'G'""",
    ),
    Query(
        "src_parquet",
        src_parquet,
        "c_custkey:i c_name:s c_mktsegment:s file:s",
        "SELECT c_custkey, c_name, c_mktsegment, 'customer.parquet' AS file FROM customer",
    ),
    Query(
        "src_json",
        src_json,
        "c_custkey:s c_name:s c_mktsegment:s",
        """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer
        UNION ALL SELECT NULL, '{"c_name": [1, 2', 'no document of records or columns'""",
    ),
    Query(
        "src_json_flatten",
        src_json_flatten,
        "event_id:i doc_body_props_k:i doc_body_value:d",
        "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS doc_body_props_k, value AS doc_body_value FROM events",
    ),
    Query(
        "src_excel",
        src_excel,
        "c_custkey:s c_name:s opened:s big:s",
        """SELECT c_custkey, c_name, CAST(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INT) AS VARCHAR) AS opened,
        CASE WHEN c_nationkey > 12 THEN 'True' ELSE 'False' END AS big FROM customer""",
    ),
    Query(
        "src_html_table",
        src_html_table,
        "c_custkey:s c_name:s c_mktsegment:s",
        "SELECT c_custkey, c_name, c_mktsegment FROM customer",
    ),
    Query(
        "src_html_tables",
        src_html_tables,
        "table_no:i first_cell:s second_cell:s third_cell:s",
        f"""SELECT 0 AS table_no, c_mktsegment AS first_cell, c_name AS second_cell, CAST(c_custkey AS VARCHAR) AS third_cell FROM customer
        UNION ALL SELECT 1, concat('p', c_custkey // {BLOCK}), concat('p', c_custkey // {BLOCK}), CAST(COUNT(*) AS VARCHAR) FROM customer
        GROUP BY c_custkey // {BLOCK}""",
    ),
    Query(
        "src_dispatch",
        src_dispatch,
        "c_custkey:s c_name:s c_mktsegment:s skipped_files:b",
        f"SELECT *, TRUE AS skipped_files FROM ({_CUSTOMERS})",
    ),
    Query(
        "src_concat_files",
        src_concat_files,
        "key:i name:s balance:d",
        """SELECT c_custkey AS key, c_name AS name, NULL AS balance FROM customer
        UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier""",
    ),
    Query(
        "scan_staging",
        scan_staging,
        "dataset:s rows:i",
        " UNION ALL ".join(f"SELECT '{d}' AS dataset, {sql} AS rows" for d, sql in _SCAN_SQL.items()),
    ),
    Query(
        "scan_staging_pattern",
        scan_staging_pattern,
        "rows:i with_sub_tables:i",
        "SELECT 2 * COUNT(*) AS rows, 3 * COUNT(*) AS with_sub_tables FROM customer",
    ),
    Query(
        "inc_new_files",
        inc_new_files,
        "path:s",
        """SELECT DISTINCT source || '/' || lang AS path FROM documents WHERE source || '/' || lang NOT IN
        (SELECT source || '/' || lang FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE toxic = 1)""",
    ),
    Query("inc_modified", inc_modified, "path:s decision:s reason:s", f"SELECT *, {_DECISION} AS decision FROM ({_DECIDED})"),
    Query(
        "inc_force",
        inc_force,
        "path:s decision:s reason:s",
        f"SELECT path, 'process' AS decision, '{incremental.FORCED}' AS reason FROM {_LISTING}",
    ),
    Query(
        "inc_log_skip",
        inc_log_skip,
        "path:s",
        """SELECT path FROM (SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS path,
        COUNT(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS done FROM orders GROUP BY 1) WHERE done = 0""",
    ),
    Query(
        "inc_stats",
        inc_stats,
        "dataset:s decision:s reason:s files:i",
        f"""SELECT 'order_data' AS dataset, {_DECISION} AS decision, reason, COUNT(*) AS files FROM ({_DECIDED}) GROUP BY ALL""",
    ),
    Query(
        "inc_stream",
        inc_stream,
        "order_id:s user_id:s transaction_date:s estimated_arrival_days:i",
        with_star("SELECT order_id, user_id, transaction_date, estimated_arrival_days FROM stg_orders"),
    ),
    Query(
        "inc_stream_facts",
        inc_stream_facts,
        "order_id:s user_id:s merchant_id:s transaction_date_sk:i estimated_arrival_days:i delay_days:i",
        with_star(
            """SELECT order_id, user_id, merchant_id, transaction_date_sk, estimated_arrival_days, delay_days
            FROM fact_orders JOIN dim_user USING (user_sk) JOIN dim_merchant USING (merchant_sk)"""
        ),
    ),
    Query(
        "inc_changes",
        inc_changes,
        "order_id:s transaction_date_sk:i",
        with_star("SELECT order_id, transaction_date_sk FROM fact_orders WHERE transaction_date_sk >= 19970101"),
    ),
    Query(
        "sink_merge",
        sink_merge,
        "order_id:s delay_days:i others_stay:b",
        with_star(
            """SELECT order_id, delay_days + CASE WHEN transaction_date_sk = 19960102 THEN 100 ELSE 0 END AS delay_days,
            TRUE AS others_stay FROM fact_orders"""
        ),
    ),
    Query(
        "sink_staging",
        sink_staging,
        "file_source:s rows:i days:i undated:i",
        with_star(
            """SELECT f AS file_source, COUNT(*) AS rows, SUM(delay_days) AS days, 0 AS undated FROM stg_delays
            CROSS JOIN (VALUES ('delays.csv'), ('again.csv')) t(f) GROUP BY 1"""
        ),
    ),
    Query(
        "sink_snapshot",
        sink_snapshot,
        "order_id:s transaction_date_sk:i delay_days:i",
        with_star("SELECT order_id, transaction_date_sk, delay_days * 2 AS delay_days FROM fact_orders"),
    ),
    Query(
        "sink_view",
        sink_view,
        "staff_id:s total_orders_processed:i",
        with_star("SELECT staff_id, total_orders_processed FROM vw_staff_performance"),
    ),
    Query(
        "sink_materialize",
        sink_materialize,
        "date:s year:i month:i total_orders:i total_revenue:d",
        with_star("SELECT date, year, month, total_orders, total_revenue FROM vw_sales_by_time"),
    ),
    Query(
        "sink_ingest_log",
        sink_ingest_log,
        "file_path:s table_name:s rows_ingested:i status:s message:s",
        """SELECT source AS file_path, 'documents' AS table_name, COUNT(*) AS rows_ingested, 'success' AS status,
        NULL AS message FROM documents GROUP BY source
        UNION ALL SELECT DISTINCT source || '.zip', 'documents', 0, 'skipped', 'Unsupported ext .zip' FROM documents""",
    ),
    Query("sink_reset", sink_reset, "before:i after:i", with_star("SELECT COUNT(*) AS before, 0 AS after FROM fact_line_items")),
    Query(
        "schema_add_column",
        schema_add_column,
        "o_orderkey:i rows:i staff_id:s missing:i",
        "SELECT o_orderkey, 2 AS rows, CAST(o_custkey AS VARCHAR) AS staff_id, 1 AS missing FROM orders",
    ),
]
