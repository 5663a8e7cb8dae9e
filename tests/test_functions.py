"""Formatters on literal examples."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse import functions as fx

D = Decimal
CASES = [
    (fx.title, {"o'brien": "O'Brien", "3rd": "3Rd", "ab-cd EF": "Ab-Cd Ef", "": "", None: None}),
    (
        fx.clean_value,
        {" x ": "x", "<null>": None, "< N/A >": None, "NULL": None, "NaN": None, "<x>": "<x>", "": None, None: None},
    ),
    (
        fx.product_type,
        {
            "cosmetic_products": "Cosmetics",
            "TECH": "Electronics And Technology",
            "": "Cosmetics",
            "   ": "Cosmetics",
            "toy": "Toys And Entertainment",
            "home-decor": "Home Decor",
            " GROCERIES ": "Grocery",
            "ABC zed": "ABC Zed",
            "school  supplies": "Stationary And School Supplies",
            None: None,
        },
    ),
    (fx.product_type_basic, {"ABC_zed-x": "ABC Zed X", "toys": "Toys", None: None}),
    (fx.product_type_group, {" Toys ": "Toys And Entertainment", "x y": "x y", "tech": "tech", None: None}),
    (
        fx.person_name,
        {
            "mcdonald": "McDonald",
            "macleod": "MaCleod",
            "o'brien": "O'Brien",
            "ludwig van der BERG": "Ludwig van der Berg",
            "D'ANGELO": "D'Angelo",
            "mc": "Mc",
            "  ann   lee ": "Ann Lee",
            None: None,
        },
    ),
    (fx.place, {"city OF new-york": "City of New-York", "LA paz": "la Paz", None: None}),
    (fx.street, {"  12   Main  st ": "12 Main st"}),
    (fx.phone, {"+63 (2) 555+1": "+632555+1", "(02) 55+5": "02555", "abc": "", None: None}),
    (fx.gender, {"m": "Male", " F ": "Female", "Non-Binary": "Other", "xx": "Xx", "": None, None: None}),
    (fx.user_type, {" verified   USER ": "Verified User"}),
    (fx.job_title, {"ceo of it": "CEO Of IT", "hr manager": "HR Manager"}),
    (fx.job_level, {"[null]": None, " senior  one ": "Senior One", "None": None, "": None, None: None}),
    (fx.card_number, {"4000-1": "40001", "x": None, None: None}),
    (fx.campaign_description, {'"""Twee  health."" - R"': 'Twee health."" - R', ' "a" ': "a"}),
    (fx.campaign_name, {"  Big   SALE ": "Big SALE"}),
    (fx.extract_number, {"-3": 3, "3.7": 3, "": None, "12days": 12, "99999999999": None, None: None}),
    (
        fx.discount_percent,
        {"1%": D(1), "1pct": D(1), "10%%": D(10), "5percent": D(5), "x": None, "2.5%": D("2.5"), None: None},
    ),
    (fx.legacy_discount, {"1%": D(1), "1pct": D(1), "10%%": D(10), "5 percent": D(5), "x": None}),
    (fx.first_quantity, {"4pcs": 4, "5piece": 5, "6PC": 6, "none": None}),
    (fx.arrival_days_before_word, {"10days": 10, "11d": None, "11": None, "3 days": 3}),
    (
        fx.lenient_date,
        {
            "2024-01-15": dt.date(2024, 1, 15),
            "2024-13-45": None,
            "not-a-date": None,
            "01/15/2024": dt.date(2024, 1, 15),
            "2024-01-15 10:00:00": dt.date(2024, 1, 15),
            None: None,
        },
    ),
    (fx.to_decimal, {"1.5": D("1.50"), " 2 ": D(2), "x": None}),
    (fx.to_double, {"1.5": 1.5, "x": None}),
]


@pytest.mark.parametrize("fn,cases", CASES, ids=[f.__name__ for f, _ in CASES])
def test_formatter(spark, fn, cases):
    df = spark.createDataFrame(list(enumerate(cases)), "i int, v string").select("i", fn(F.col("v")).alias("r"))
    got = [r.r for r in df.orderBy("i").collect()]
    assert got == list(cases.values())


@pytest.mark.parametrize(
    "variant,expected",
    [
        ("ingest", [1, 1, 1, 0, 2, 0, None, 1]),
        ("transform", [1, 1, 1, 0, 0, None, None, 0]),
        ("direct", [1, 1, 0, 0, 0, None, None, 0]),
        ("set_based", [1, 1, None, None, None, None, None, None]),
    ],
)
def test_availed(spark, variant, expected):
    values = ["1", "true", "Yes", "no", "2", "Not Applicable", None, "1.0"]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    assert [r.r for r in df.select("i", fx.availed_flag(F.col("v"), variant).alias("r")).orderBy("i").collect()] == expected


def test_formatters_can_be_applied_twice(spark):
    names = ["mcdonald", "o'neil smith", "VAN der berg", "3rd st."]
    df = spark.createDataFrame([(n,) for n in names], "v string")
    once = df.select(fx.person_name(F.col("v")).alias("a"))
    both = once.select("a", fx.person_name(F.col("a")).alias("b")).collect()
    assert all(r.a == r.b for r in both)


def test_month_label_is_padded(spark):
    r = spark.sql("select date'2024-05-07' d").select(fx.month_label(F.col("d")).alias("m"), fx.date_key(F.col("d")).alias("k")).first()
    assert r.m == "May      " and r.k == 20240507


def test_row_json_keeps_nulls(spark):
    df = spark.sql("select 'a' x, cast(null as int) y, date'2024-01-02' z")
    assert df.select(fx.row_json(["x", "y", "z"])).first()[0] == '{"x":"a","y":null,"z":"2024-01-02"}'


def test_zero_falls_through(spark):
    df = spark.createDataFrame([(0, 5), (None, 6), (7, 8)], "a int, b int")
    assert [r[0] for r in df.select(fx.first_non_falsy(F.col("a"), F.col("b"))).collect()] == [5, 6, 7]


def test_texts_that_need_no_cleaning_are_told_by_their_ends(spark):
    """``clean_value`` and ``normalize_key`` leave most texts alone, and give what the full rule gives for all."""
    from itertools import product

    from tallyhouse.functions import text

    signs = [" ", "\t", "　", "\x1f", "\x00", "\x7f", "n", "N", "a", "<", ">", "/", "é", "K", "1", "\n"]
    odd = ["".join(t) for k in range(4) for t in product(signs, repeat=k)]
    odd += [f"{a}{w}{b}" for w in ("nan", "None", "NULL", "n/a", "<null>", "< N/A >", "<x>", "O12") for a in ("", " ", "x") for b in ("", " ", "!")]
    df = spark.createDataFrame([(t,) for t in [*odd, None]], "t string")
    for new, full in ((fx.clean_value, text._apply(F.col("t"), text._clean("x"))), (fx.normalize_key, text.strip(F.col("t")))):
        assert df.filter(~new(F.col("t")).eqNullSafe(full)).collect() == []
    plan = df.select(fx.clean_value(F.col("t")).alias("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan and plan.index("ascii(t") < plan.index("lambdafunction")
    numbers = spark.range(3).select(F.col("id"), (F.col("id") / 2).alias("d"), F.lit(D("1.50")).alias("m"), (F.col("id") > 1).alias("b"))
    for c in numbers.columns:
        assert numbers.filter(~fx.clean_value(F.col(c)).eqNullSafe(F.col(c).cast("string"))).count() == 0
