"""Line breaks and stray quotes in delimited files of several splits."""

import csv
import random

import pytest

from tallyhouse.sources import quoted, readers
from tallyhouse.sources.discovery import find_files, source_files


def files(spark, root):
    return source_files(find_files(spark, str(root), "*.csv"))


@pytest.fixture
def splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(4 << 20))
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def by_characters(text: str, sep: str) -> bool:
    """Whether a line that begins outside ends inside a quoted cell."""
    inside, begins, i = False, True, 0
    while i < len(text):
        c = text[i]
        if inside:
            if c == '"':
                if text[i + 1 : i + 2] == '"':
                    i += 1
                elif i + 1 == len(text) or text[i + 1] == sep:
                    inside = False
        elif c == '"' and begins:
            inside = True
        begins = not inside and c == sep
        i += 1
    return inside


@pytest.mark.parametrize("sep", [",", "\t", "|"])
def test_states_of_lines(sep):
    rng = random.Random(7)
    quotes = quoted.Quotes(sep)
    for _ in range(20_000):
        line = "".join(rng.choice(['"', '"', sep, "a", " "]) for _ in range(rng.randrange(14)))
        assert quotes.after(line, False) == by_characters(line, sep), line
        assert quotes.after(line, True) == by_characters('"x' + line, sep), line
    assert not quotes.after(f'1{sep}screen 5" wide', False) and quotes.after(f'1{sep}"two lines', False)
    assert quotes.after('"' + '""' * 300_000, False) and not quotes.after(sep.join(['"a"'] * 200_000), False)


def test_records_over_the_ends_of_splits(spark, tmp_path, splits):
    rng = random.Random(3)
    rows = []
    for k in range(60_000):
        text = rng.choice(["plain", 'say "hi", all', "two\nlines", 'a "q"\n\n"b"', "", "x" * rng.randrange(300), "many\n" * rng.randrange(60)])
        rows.append([str(k), text, rng.choice(["", "end", 'end"'])])
    rows[30_000][1] = "long " * 900_000 + "\n" + "tail " * 900_000  # one record over several whole splits
    with open(tmp_path / "a.csv", "w", newline="") as f:
        out = csv.writer(f, lineterminator="\n")
        out.writerow(["id", "text", "more"])
        out.writerows(rows)
    df = readers.read(spark, files(spark, tmp_path), readers.delimited_frames)
    got = {r.id: (r.text, r.more) for r in df.collect()}
    assert len(got) == len(rows) and df.count() == len(rows)
    assert all((got[i][0] or "", got[i][1] or "") == (t, m) for i, t, m in rows)
    assert quoted._lines(spark, files(spark, tmp_path)).select("block").distinct().count() > 3
    # arrival goes by the place in the file
    assert [r.id for r in df.orderBy("ingest_seq").select("id").collect()] == [r[0] for r in rows]


def test_stray_quotes_and_rows_that_do_not_fit(spark, tmp_path, splits):
    body = "".join(f'{k},screen {k}" wide,z\n' for k in range(200_000))
    (tmp_path / "a.csv").write_text("id,text,more\n" + body)
    (tmp_path / "b.csv").write_text('id,text,more\n1,"two\nlines",x\n2,"a, b",y,surplus\n\n3,"so\nmany",z,"sur\nplus"\n4,c\n')
    (tmp_path / "c.csv").write_text('id,text,more\n1,"never closed,x\n2,b,y\n')
    rejects = []
    df = readers.read(spark, files(spark, tmp_path), readers.delimited_frames, rejects=rejects)
    counts = {r[0].rsplit("/", 1)[-1]: r[1] for r in df.groupBy("file_source").count().collect()}
    assert counts == {"a.csv": 200_000, "b.csv": 2, "c.csv": 2}
    assert df.where("id = 77 and text = 'screen 77\" wide'").count() == 1
    b = sorted((r.id, r.text, r.more) for r in df.where("file_source like '%b.csv'").collect())
    assert b == [("1", "two\nlines", "x"), ("4", "c", None)]
    lost = sorted(r.record for r in rejects[0].unionByName(rejects[1]).collect()) if len(rejects) > 1 else sorted(r.record for r in rejects[0].collect())
    assert lost == ['2,"a, b",y,surplus', '3,"so\nmany",z,"sur\nplus"']
    assert df.where("file_source like '%a.csv'").select("text").rdd.getNumPartitions() > 1


def test_an_index_cell_beside_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text\n0,a,"two\nlines"\n1,b,x\n2,c,"y\nz"\n')
    df = readers.read(spark, files(spark, tmp_path), readers.delimited_frames)
    assert sorted((r.id, r.text) for r in df.collect()) == [("a", "two\nlines"), ("b", "x"), ("c", "y\nz")]
