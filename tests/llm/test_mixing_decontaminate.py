import re

import pytest

from tallyhouse.llm import decontaminate as dc, mixing

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None) for i, t, s in rows], DOCS)


# ------------------------------------------------------------------ mixing


def test_targets_reach_the_fixed_point(spark, rows):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 0), (None, 200), ("d", 30)], "__source string, __source_size long")
    got = {s: t for s, t in rows(mixing.source_targets(sizes), "__source", "__target")}
    cap = {"a": 30.0, "b": 3000.0, "c": 0.0, "d": 90.0, None: 600.0}
    weight = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2], strict=True))
    capped: set = set()
    for _ in range(10):
        free = [s for s in weight if s not in capped]
        level = (1240 - sum(cap[s] for s in capped)) / max(1e-9, sum(weight[s] for s in free))
        capped |= {s for s in free if level * weight[s] >= cap[s]}
    want = {s: cap[s] if s in capped else level * weight[s] for s in weight}
    assert got == pytest.approx(want)


def test_plan_of_a_hot_source(spark):
    docs = [(i, " ".join(["w"] * (i % 7)), "hot" if i % 3 else None) for i in range(600)] + [(5, "x y", "hot"), (None, "n", "tiny"), (None, None, "tiny"), (7, "", "tiny")]
    got = mixing.op9(spark, frame(spark, docs)).collect()
    assert len(got) == len(docs)
    again = mixing.op9(spark, frame(spark, docs[::-1])).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    of: dict = {}
    for r in got:
        of.setdefault((r["source_size"], r["target"]), []).append(r["taken"])
    assert all(abs(sum(t) - target) <= 1 for (_, target), t in of.items())


def test_mixed_rows_hold_the_words_of_the_plan(spark):
    docs = [(i, "\n".join(f"{i}w{k}" for k in range(i % 5)) + "  ", "s" if i % 4 else "t") for i in range(80)]
    base = frame(spark, docs).withColumnRenamed("lang", "__size")  # a clashing name
    out = mixing.mix(base)
    assert out.columns == base.columns
    plan = {r["doc_id"]: r["taken"] for r in mixing.op9(spark, frame(spark, docs)).collect()}
    words: dict[int, int] = {}
    whole = {i: t for i, t, _ in docs}
    for r in out.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
        assert r["text"] == whole[r["doc_id"]] or whole[r["doc_id"]].startswith(r["text"])
        assert r["__size"] == "en"
    assert words == {i: n for i, n in plan.items() if n}


@pytest.mark.parametrize("n", [1, 7, 40])
def test_equal_rows_share_what_is_missing(spark, n):
    """Rows without an id and with one text stand at one place; so does the end of a budget."""
    docs = [(None, "a b c d e", "s")] * n + [(k, "x y z " * (k % 9), "t") for k in range(60)] + [(None, "f g", None)] * 3
    plan = [(r["source_size"], r["taken"]) for r in mixing.op9(spark, frame(spark, docs)).collect() if r["doc_id"] is None]
    assert sum(t % 5 not in (0,) for size, t in plan if size == 5 * n) <= 1 and len(plan) == n + 3
    out = mixing.mix(frame(spark, docs)).where("doc_id is null").collect()
    assert sum(len(r["text"].split()) for r in out) == sum(t for _, t in plan)
    assert all("a b c d e".startswith(r["text"]) or "f g".startswith(r["text"]) for r in out)


def test_no_range_of_keys_holds_much_of_a_source(spark):
    docs = spark.range(300_000).selectExpr("id as doc_id", "if(id % 3 = 0, '|||', 'x') as text", "'s' as source")
    most = mixing.sized(docs).groupBy("__range").count().agg({"count": "max"}).first()[0]
    assert most <= 300_000 / 22_000 * 3 + 10


def test_mixing_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    assert mixing.op9(spark, empty).count() == 0 and mixing.mix(empty).count() == 0


# ------------------------------------------------------------------ decontamination


def brute(docs, items):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    windows = []
    for i, t in items:
        w = cut(t)
        windows += [("" if i is None else str(i), w[k : k + 10]) for k in range(max(1, len(w) - 9))] if w else []
    out = []
    for i, t, _ in docs:
        w, hit, names = cut(t), set(), set()
        for name, win in windows:
            for k in range(len(w) - len(win) + 1):
                if w[k : k + len(win)] == win:
                    hit |= set(range(k, k + len(win)))
                    names.add(name)
        out.append((i, len(w), len(hit), len(names)))
    return sorted(out, key=str)


LONG = "alpha beta gamma delta eps zeta eta theta iota kappa lambda mu"
ITEMS = [(1, LONG), (2, "Only Three words"), (3, None), (None, "ünï Çode"), (5, " .,! "), (6, LONG)]
TEXTS = [
    (1, "x " + LONG.upper() + " y " + LONG, "s"),
    (2, "only-three WORDS; only three", "s"),
    (2, "clean text", "s"),
    (None, None, None),
    (4, "", "s"),
    (5, "ünï çode ünï Çode", "s"),
    (6, "beta gamma delta eps zeta eta theta iota kappa", "s"),
    (7, "only three words " * 50, "s"),
]


@pytest.mark.parametrize("most", [dc.MAX_SET, 2])
def test_report(spark, most):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = dc.report(frame(spark, TEXTS), items, max_set=most).collect()
    assert sorted([(r["doc_id"], r["n_words"], r["n_hit"], len(r["items"])) for r in got], key=str) == brute(TEXTS, ITEMS)


def test_removal(spark, rows):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    base = frame(spark, TEXTS).withColumnRenamed("lang", "__hits")
    kept = dc.decontaminate(base, items)
    assert kept.columns == base.columns
    assert [r[0] for r in rows(kept, "text")] == ["", "beta gamma delta eps zeta eta theta iota kappa", "clean text", None]
    spans = dict(rows(dc.decontaminate(base, items, remove="spans").where("doc_id in (1, 5)"), "doc_id", "text"))
    assert spans == {1: "x  y ", 5: "ünï çode "}


def test_no_benchmark(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r["n_hit"] for r in dc.op5(spark, frame(spark, TEXTS), none).collect()} == {0}
    assert dc.op5(spark, frame(spark, TEXTS).limit(0), none).count() == 0
