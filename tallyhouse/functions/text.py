"""Text formatters as native column expressions.

The body of a formatter is SQL text over one lambda variable.  ``_apply`` runs
it on a column through ``transform`` over a one-element array, which

* computes the column once, however often the body mentions it - formatters
  applied on top of each other add up instead of multiplying;
* builds the whole expression in one parser call.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, functions as F

# --- fixed values -----------------------------------------------------------
# White space of every kind, as code points.
WHITE_SPACE = "".join(
    chr(c)
    for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
# Spellings that mean "no value".
NULL_WORDS = ["", "nan", "none", "null", "n/a", "na", "<null>"]
# The same, inside angle brackets.
BRACKETED_NULL_WORDS = ["null", "none", "nan", "n/a", "na"]
# What these begin with, in either case.
NULL_BEGINNINGS = "nN<"
JOB_LEVEL_NULL_WORDS = ["[null]", "null", "none", ""]

NAME_PARTICLES = ["van", "der", "de", "la", "le"]
PLACE_PARTICLES = ["of", "the", "and", "de", "la", "le", "van", "der"]
JOB_ABBREVIATIONS = ["CEO", "CTO", "CFO", "VP", "SVP", "EVP", "PM", "HR", "IT", "QA", "UI", "UX"]

GENDERS = {
    "m": "Male",
    "male": "Male",
    "f": "Female",
    "female": "Female",
    "other": "Other",
    "o": "Other",
    "non-binary": "Other",
    "nb": "Other",
}

# Category -> spellings.  The order is part of the rule: a partial match takes
# the first spelling that fits.
PRODUCT_TYPES = [
    ("Cosmetics", ["cosmetic", "cosmetics"]),
    (
        "Electronics And Technology",
        ["electronic", "electronics", "electronics and tech", "electronics and technology"],
    ),
    ("Toys And Entertainment", ["toy", "toys", "toys and entertainment", "entertainment"]),
    ("Apparel", ["apparel", "clothing"]),
    ("Furniture", ["furniture"]),
    ("Grocery", ["grocery", "groceries"]),
    ("Readymade Dinner", ["readymade dinner", "readymade dinners"]),
    ("Kitchenware", ["kitchenware", "kitchen ware"]),
    ("Tools", ["tool", "tools"]),
    ("Accessories", ["accessory", "accessories"]),
    (
        "Stationary And School Supplies",
        [
            "stationary",
            "stationery",
            "stationary and school supplies",
            "stationery and school supplies",
            "school supplies",
        ],
    ),
]
# --- end of fixed values ----------------------------------------------------


@lru_cache(maxsize=None)
def _lambda(body: str) -> Column:
    return F.expr(f"x -> {body}")


def _apply(c: Column, body: str) -> Column:
    return F.element_at(F.call_function("transform", F.array(c), _lambda(body)), 1)


# --- SQL text ---------------------------------------------------------------
# Each helper returns SQL over the SQL it is given.  R'...' is a raw literal;
# (?U) makes \s cover white space of every kind.
_WS = "".join(f"\\u{ord(c):04X}" for c in WHITE_SPACE)


def _quote(text: str) -> str:
    return "'" + text.replace("'", "\\'") + "'"


def _in(probe: str, words: list[str]) -> str:
    return f"{probe} IN ({', '.join(_quote(w) for w in words)})"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _strip(x: str) -> str:
    return f"btrim({x}, '{_WS}')"


def _squeeze(x: str) -> str:
    return rf"regexp_replace({_strip(x)}, R'(?U)\s+', ' ')"


def _title(x: str) -> str:
    runs = rf"regexp_extract_all({x}, R'(\p{{L}}+|[^\p{{L}}]+)', 1)"
    return f"array_join(transform({runs}, t -> initcap(t)), '')"


def _words(x: str, fmt: str) -> str:
    """``fmt`` (over ``w``) on each word of the squeezed text."""
    return f"array_join(transform(split({_squeeze(x)}, ' '), w -> {fmt}), ' ')"


def _clean(x: str) -> str:
    inner = "|".join(BRACKETED_NULL_WORDS)
    empty = rf"({_in('lower(s)', NULL_WORDS)} OR s RLIKE R'(?iU)^<\s*({inner})\s*>$')"
    return _let(_strip(x), "s", f"CASE WHEN NOT {empty} THEN s END")


def _basic_type(x: str) -> str:
    kept = f"CASE WHEN w = upper(w) AND w <> lower(w) AND length(w) > 1 THEN w ELSE {_title('w')} END"
    return _words(f"translate({x}, '_-', '  ')", kept)


def _exact_type(probe: str) -> str:
    return " ".join(f"WHEN {_in(probe, words)} THEN {_quote(group)}" for group, words in PRODUCT_TYPES)


def _partial_type(probe: str) -> str:
    def fits(words: list[str]) -> str:
        return " OR ".join(
            f"contains({probe}, {_quote(w)}) OR contains({_quote(w)}, {probe})" for w in words
        )

    return " ".join(f"WHEN {fits(words)} THEN {_quote(group)}" for group, words in PRODUCT_TYPES)


def _person(w: str) -> str:
    rest = _title(f"substring({w}, 3)")
    first, second = f"substring({w}, 1, 1)", f"substring({w}, 2, 1)"
    return f"""CASE
        WHEN {_in(f'lower({w})', NAME_PARTICLES)} THEN lower({w})
        WHEN length({w}) > 2 AND lower({w}) RLIKE '^(mc|mac)' THEN upper({first}) || lower({second}) || {rest}
        WHEN length({w}) > 2 AND {w} RLIKE "^[OoDd]'" THEN upper({first}) || {second} || {rest}
        ELSE {_title(w)} END"""


def _digits(x: str) -> str:
    return rf"regexp_replace({x}, R'\D', '')"


# --- formatters -------------------------------------------------------------


def strip(c: Column) -> Column:
    """Drop white space of every kind from both ends (``trim`` drops blanks only)."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def squeeze(c: Column) -> Column:
    """Strip, and turn each inner run of white space into one blank."""
    return F.regexp_replace(strip(c), r"(?U)\s+", " ")


def title(c: Column) -> Column:
    """Upper-case each letter that follows a non-letter, lower-case the rest.

    Unlike ``initcap`` this also restarts after apostrophes, digits and
    hyphens, so ``o'brien`` gives ``O'Brien`` and ``3rd`` gives ``3Rd``.
    """
    return _apply(c, _title("x"))


def _visible_ends(c: Column) -> Column:
    """Whether a text begins and ends with a visible ASCII character, so that there is nothing to strip."""
    return F.ascii(c).between(0x21, 0x7E) & F.ascii(F.substring(c, -1, 1)).between(0x21, 0x7E)


def clean_value(c: Column) -> Column:
    """Stripped text; spellings of "no value" become NULL.

    Most texts stay as they are, which their first and last character tell: all spellings begin with one of three.
    """
    text = c.cast("string")
    plain = _visible_ends(text) & ~F.ascii(text).isin(*[ord(x) for x in NULL_BEGINNINGS])
    return F.when(plain, text).otherwise(_apply(c, _clean("x")))


def product_type_basic(c: Column) -> Column:
    """Separators to blanks, title case, all-capital words kept."""
    return _apply(c, _basic_type("x"))


def product_type(c: Column) -> Column:
    """Category of a free-text product type.

    An exact spelling decides first.  Otherwise the first spelling that holds
    the text, or is held by it, decides; text that fits nothing is kept.
    """
    decided = _let("lower(shown)", "p", f"CASE {_exact_type('p')} {_partial_type('p')} ELSE shown END")
    return _apply(c, _let(_basic_type("x"), "shown", f"CASE WHEN shown IS NOT NULL THEN {decided} END"))


def product_type_group(c: Column) -> Column:
    """Category by exact spelling only; any other value is kept as it is."""
    return _apply(c, _let("lower(trim(x))", "p", f"CASE {_exact_type('p')} ELSE x END"))


def person_name(c: Column) -> Column:
    return _apply(c, _words("x", _person("w")))


def place(c: Column) -> Column:
    """City, state or country."""
    low = _in("lower(w)", PLACE_PARTICLES)
    return _apply(c, _words("x", f"CASE WHEN {low} THEN lower(w) ELSE {_title('w')} END"))


def street(c: Column) -> Column:
    return squeeze(c)


def phone(c: Column) -> Column:
    """Digits, with a leading plus and any plus after that kept."""
    kept = _let(
        r"regexp_replace(x, R'[^\d+]', '')",
        "k",
        "CASE WHEN startswith(k, '+') THEN k ELSE replace(k, '+', '') END",
    )
    return _apply(c, kept)


def gender(c: Column) -> Column:
    known = " ".join(f"WHEN p = {_quote(k)} THEN {_quote(v)}" for k, v in GENDERS.items())
    return _apply(c, _let(f"lower({_strip('x')})", "p", f"CASE {known} WHEN p <> '' THEN {_title('p')} END"))


def user_type(c: Column) -> Column:
    return _apply(c, _title(_squeeze("x")))


def product_name(c: Column) -> Column:
    return _apply(c, _title(_squeeze("x")))


def bank(c: Column) -> Column:
    return _apply(c, _title(_squeeze("x")))


def job_title(c: Column) -> Column:
    short = _in("upper(w)", JOB_ABBREVIATIONS)
    return _apply(c, _words("x", f"CASE WHEN {short} THEN upper(w) ELSE {_title('w')} END"))


def job_level(c: Column) -> Column:
    empty = _in("lower(s)", JOB_LEVEL_NULL_WORDS)
    return _apply(c, _let(_squeeze("x"), "s", f"CASE WHEN NOT {empty} THEN {_title('s')} END"))


def card_number(c: Column) -> Column:
    """Digits only; no digits at all is no number."""
    return _apply(c, _let(_digits("x"), "d", "CASE WHEN d <> '' THEN d END"))


def campaign_description(c: Column) -> Column:
    """Without the stray quotes the source wraps around it."""
    out = _strip("x")
    for pattern in ('^"""', '"""$', '^"', '"$'):
        out = f"regexp_replace({out}, R'{pattern}', '')"
    return _apply(c, _squeeze(out))


def campaign_name(c: Column) -> Column:
    return squeeze(c)


def normalize_key(c: Column) -> Column:
    """Business key as it is compared everywhere: text without outer blanks."""
    text = c.cast("string")
    return F.when(_visible_ends(text), text).otherwise(strip(text))


def row_json(columns: list[str]) -> Column:
    """The row as JSON, members without a value included."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
