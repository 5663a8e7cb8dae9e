"""Files and stores that must not lose or change anything."""

import feeds
import pytest
from pyspark.sql import functions as F

from tallyhouse import session
from tallyhouse.functions import dates
from tallyhouse.operators import keys, staging
from tallyhouse.plans import kpis
from tallyhouse.plans.store import Store
from tallyhouse.sources import discovery, readers


def files_of(spark, root, pattern="*"):
    return discovery.source_files(discovery.find_files(spark, str(root), pattern))


# ------------------------------------------------------------------ readers


def test_a_header_of_more_than_64_kib(spark, tmp_path):
    names = [f"column_{k:05d}_{'x' * 12}" for k in range(5000)]
    feeds.write(tmp_path, "wide.csv", ",".join(names) + "\n" + ",".join(map(str, range(5000))) + "\n")
    df = readers.read(spark, files_of(spark, tmp_path), readers.delimited_frames)
    assert staging.data_columns(df) == names
    assert df.select(names[-1]).first()[0] == "4999"


def test_line_breaks_in_quotes_are_found(spark, tmp_path, rows):
    feeds.write(tmp_path, "a.csv", 'k,v\na,"one\ntwo"\nb,x\n')
    feeds.write(tmp_path, "b.csv", "k,v\nc,y\n")
    df = readers.read_files(spark, files_of(spark, tmp_path, "*.csv"), clean=False)
    assert rows(df, "k", "v") == [("a", "one\ntwo"), ("b", "x"), ("c", "y")]


def test_long_rows_and_broken_documents_are_kept_apart(spark, tmp_path, rows):
    feeds.write(tmp_path, "a.csv", "a,b\n1,2\n3,4,5,6\n7\n")
    feeds.write(tmp_path, "b.json", '[{"a": "8", "b": "9"}]')
    feeds.write(tmp_path, "c.json", '[{"a": "8", ')
    rejects = []
    frames = readers.file_frames(spark, files_of(spark, tmp_path), rejects=rejects)
    assert sorted(r for f in frames for r in rows(f, "a", "b")) == [("1", "2"), ("7", None), ("8", "9")] or sorted(
        (str(a), str(b)) for f in frames for a, b in rows(f, "a", "b")
    ) == [("1", "2"), ("7", "None"), ("8", "9")]
    found = [r for df in rejects for r in rows(df, "record", "reason")]
    assert sorted(found) == [("3,4,5,6", readers.TOO_LONG), ('[{"a": "8", ', readers.NO_DOCUMENT)]


def test_long_rows_are_cut_where_nobody_takes_rejects(spark, tmp_path, rows):
    feeds.write(tmp_path, "a.csv", "a,b\n1,2\n3,4,5,6\n7\n")
    files = files_of(spark, tmp_path)
    want = sorted([("1", "2"), ("3", "4"), ("7", None)], key=repr)
    assert rows(readers.read(spark, files, readers.delimited_frames), "a", "b") == want
    assert rows(readers.read_files(spark, files, clean=False), "a", "b") == want
    rejects = []
    assert readers.read_files(spark, files, clean=False, rejects=rejects).count() == 2
    assert [r for df in rejects for r in rows(df, "record")] == [("3,4,5,6",)]


@pytest.mark.parametrize("taken", [True, False])
def test_an_index_cell_without_a_name(spark, tmp_path, rows, taken):
    feeds.write(tmp_path, "a.csv", "a,b\n0,x,y\n1,z,\n2,,w\n")
    feeds.write(tmp_path, "b.csv", "a,b\n1,p,\n2,q,\n")  # separators at the ends
    feeds.write(tmp_path, "c.csv", "a,b\nr,1,5\ns,2,5\n")  # no index
    rejects = [] if taken else None
    found = rows(readers.read(spark, files_of(spark, tmp_path), readers.delimited_frames, rejects=rejects), "a", "b")
    want = [("x", "y"), ("z", None), (None, "w"), ("1", "p"), ("2", "q")]
    assert found == sorted(want if taken else [*want, ("r", "1"), ("s", "2")], key=repr)
    if taken:
        assert sorted(r for df in rejects for r in rows(df, "record")) == [("r,1,5",), ("s,2,5",)]


def test_a_broken_document_is_named(spark, tmp_path, caplog):
    feeds.write(tmp_path, "a.json", '[{"a": "8"}]')
    feeds.write(tmp_path, "b.json", '[{"a": "8", ')
    assert readers.read_files(spark, files_of(spark, tmp_path), clean=False).count() == 1
    assert "b.json" in caplog.text


def test_a_digit_named_column_goes_only_where_all_files_agree(spark):
    def frame(b):
        a = [("a.csv", k, str(k), "v") for k in range(20)]
        return spark.createDataFrame(a + [("b.csv", 100 + k, v, "v") for k, v in enumerate(b)], "file_source string, ingest_seq long, `7` string, v string")

    counts = [str(k + 5) for k in range(20)]
    assert staging.data_columns(staging.drop_index_columns(frame(counts))) == ["v"]
    for odd in (counts[:11] + ["99"] + counts[12:], ["real", "values"], counts[::-1], counts[:10] + counts[9:]):
        assert staging.data_columns(staging.drop_index_columns(frame(odd))) == ["7", "v"]


@pytest.mark.parametrize(
    "text, want",
    [
        ("1/15/2024 10:00", "2024-01-15 10:00:00"),
        ("2020/02/03 04:05:06", "2020-02-03 04:05:06"),
        ("Jan 15, 2024 10:00 AM", "2024-01-15 10:00:00"),
        ("15/01/2024", "2024-01-15 00:00:00"),
        ("2024-01-15 01:02:03", "2024-01-15 01:02:03"),
        ("12", None),
        ("2024-13-45", None),
    ],
)
def test_dates_with_times(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(dates.lenient_timestamp(F.col("t")).cast("string")).first()[0]
    assert got == want


def test_equal_order_numbers_give_one_row_whatever_the_partitioning(spark):
    data = [("k", 1, f"a{i}", f"b{i}") for i in range(50)] + [("n", None, "x", "y")]
    df = spark.createDataFrame(data, "k string, ingest_seq long, a string, b string")
    got = [{tuple(r) for r in keys.first_per_key(df.repartition(n), ["k"]).collect()} for n in (1, 7)]
    assert got[0] == got[1] and ("n", None, "x", "y") in got[0]
    a, b = next((r[2], r[3]) for r in got[0] if r[0] == "k")
    assert a[1:] == b[1:]


# ------------------------------------------------------------------ store


def log_rows(spark, name):
    return spark.range(1).select(F.lit(name).alias("file_path"), F.lit("t").alias("table_name"), F.lit(1).cast("bigint").alias("rows_ingested"), F.lit("success").alias("status"), F.lit(None).cast("string").alias("message"), F.current_timestamp().alias("ts"))


def names(store):
    return sorted(r.file_path for r in store.read("ingestion_log").collect())


def test_interleaved_appends_all_stay(spark, tmp_path, monkeypatch):
    one, two = Store(spark, str(tmp_path)), Store(spark, str(tmp_path))
    one.append("ingestion_log", log_rows(spark, "a"))
    stale = two._current("ingestion_log")
    first = [stale]
    monkeypatch.setattr(two, "_current", lambda t: first.pop() if first else Store._current(two, t))
    one.append("ingestion_log", log_rows(spark, "b"))  # moves on after `two` has read the state
    two.append("ingestion_log", log_rows(spark, "c"))
    assert names(one) == ["a", "b", "c"]


def test_a_dead_writer_leaves_the_old_state(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.append("ingestion_log", log_rows(spark, "a"))
    store._write("ingestion_log", log_rows(spark, "lost"), None)  # died before its state
    assert names(store) == ["a"]
    (tmp_path / "ingestion_log" / "_state-000000000009.json").write_text('{"fold')  # died while writing it
    assert names(store) == ["a"]
    store.append("ingestion_log", log_rows(spark, "b"))
    assert names(store) == ["a", "b"]
    gone = store.vacuum("ingestion_log")
    assert any(g.startswith("v-") for g in gone) and names(store) == ["a", "b"]
    assert len(store._folders("ingestion_log")) == 2
    store.merge("ingestion_log")
    assert names(store) == ["a", "b"] and len(store._folders("ingestion_log")) == 1


def test_data_without_a_state_is_an_error(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.append("ingestion_log", log_rows(spark, "a"))
    for state in (tmp_path / "ingestion_log").glob("*_state*"):
        state.rename(tmp_path / f"moved{state.name}")
    with pytest.raises(RuntimeError):
        store.read("ingestion_log")


# ------------------------------------------------------------------ plans and session


def test_the_day_reaches_both_scans(spark, tmp_path):
    facts = {
        "fact_orders": spark.createDataFrame([("o", 20240115)], "order_id string, transaction_date_sk int"),
        "fact_line_items": spark.createDataFrame([("o", 20240115, 2, 3)], "order_id string, transaction_date_sk int, price int, quantity int"),
    }
    for name, df in facts.items():
        df.write.parquet(str(tmp_path / name))
    star = {n: spark.read.parquet(str(tmp_path / n)) for n in facts}
    out = kpis.daily_sales(star, "2024-01-15")
    assert tuple(out.first()) == (1, 6)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(transaction_date_sk,20240115)") >= 2


def test_a_cluster_must_name_its_shared_folder(spark, monkeypatch):
    class Elsewhere:
        class conf:
            get = staticmethod(lambda *_: None)

        class sparkContext:
            master, applicationId = "spark://host:7077", "x"

            class _jsc:
                class sc:
                    class getCheckpointDir:
                        @staticmethod
                        def isDefined():
                            return False

    with pytest.raises(RuntimeError):
        session.scratch_root(Elsewhere)
