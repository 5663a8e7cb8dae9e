"""Cleaning of freshly read files and their projection onto staging tables.

Frames arrive with every data column as text, plus the lineage columns.
"""

from __future__ import annotations

import logging
import re
from functools import lru_cache
from typing import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse import functions as fx
from tallyhouse import schemas
from tallyhouse.operators.keys import with_group_position

log = logging.getLogger(__name__)

# --- fixed values -----------------------------------------------------------
# Cell texts that stand for "no value", compared with their case.
NULL_TOKENS = ["nan", "None", "null", "N/A", "NA", "n/a", "NULL", "<null>", "NaN", "NAN", ""]

# Other names under which a file may bring a column: (sure, possible).  A
# possible name counts only where no column took the target yet.
ALIASES: dict[str, dict[str, tuple[str, str]]] = {
    "campaign_data": {
        "campaign_id": (r"campaign_id", r"^id$"),
        "campaign_name": (r"campaign_name", r"^name$"),
        "campaign_description": (r"campaign_description", r"^description$"),
        "discount": (r"discount", r"(?!)"),
    },
    "merchant_data": {
        "merchant_id": (r"merchant_id", r"^id$"),
        "name": (r"^(name|merchant_name)$", r"(?!)"),
        "street": (r"^(street|address)$", r"(?!)"),
        "state": (r"^state$", r"(?!)"),
        "city": (r"^city$", r"(?!)"),
        "country": (r"^country$", r"(?!)"),
        "contact_number": (r"contact.*number|number.*contact", r"contact|phone"),
        "creation_date": (r"creation.*date|date.*creation", r"creation"),
    },
    "order_data": {"estimated_arrival_days": (r"^estimated_arrival_days$", r"^estimated_arrival$")},
    "line_item_data_products": {"product_id": (r"^product_id$", r"^product$")},
    "order_delays": {"delay_days": (r"^delay_days$", r"^delay_in_days$")},
    "order_with_merchant_data": {"staff_id": (r"^staff_id$", r"^staff$")},
}

REQUIRED: dict[str, tuple[str, list[str]]] = {
    "order_with_merchant_data": ("skip", ["order_id", "merchant_id", "staff_id"]),
    "line_item_data_products": ("warn", ["order_id", "product_id"]),
}
# --- end of fixed values ----------------------------------------------------

Fmt = Callable[[Column], Column]


@lru_cache(maxsize=None)
def _cleaned(fmt: Fmt) -> Fmt:
    return lambda c: fmt(fx.clean_value(c))


# Column formats on the way into staging.  Names not listed pass as they are.
STAGE_FORMATS: dict[str, dict[str, Fmt]] = {
    "campaign_data": {
        "discount": fx.discount_percent,
        "campaign_name": _cleaned(fx.campaign_name),
        "campaign_description": _cleaned(fx.campaign_description),
    },
    "transactional_campaign_data": {"availed": fx.availed_flag},
    "order_data": {
        "transaction_date": fx.lenient_date,
        "total_amount": fx.to_decimal,
        "estimated_arrival_days": fx.extract_number,
    },
    "line_item_data_prices": {
        "quantity": fx.extract_number,
        "discount": fx.discount_percent,
        "price": fx.to_decimal,
    },
    "line_item_data_products": {
        "product_id": fx.clean_value,
        "order_id": fx.clean_value,
        "line_item_id": fx.clean_value,
    },
    "order_delays": {"delay_days": fx.extract_number},
    "product_list": {
        "price": fx.to_decimal,
        "product_type": fx.product_type,
        "product_name": _cleaned(fx.product_name),
    },
    "user_data": {
        "birthdate": fx.lenient_date,
        "creation_date": fx.lenient_timestamp,
        "name": _cleaned(fx.person_name),
        "street": _cleaned(fx.street),
        "gender": fx.gender,
        "user_type": fx.user_type,
    },
    "user_job": {"job_title": _cleaned(fx.job_title), "job_level": fx.job_level},
    "user_credit_card": {
        "name": _cleaned(fx.person_name),
        "credit_card_number": _cleaned(fx.card_number),
        "issuing_bank": _cleaned(fx.bank),
    },
    "merchant_data": {
        "name": _cleaned(fx.person_name),
        "street": _cleaned(fx.street),
        "contact_number": _cleaned(fx.phone),
        "creation_date": fx.lenient_timestamp,
    },
    "staff_data": {
        "name": _cleaned(fx.person_name),
        "street": _cleaned(fx.street),
        "contact_number": _cleaned(fx.phone),
        "creation_date": fx.lenient_timestamp,
    },
    "order_with_merchant_data": {
        "staff_id": fx.clean_value,
        "merchant_id": fx.clean_value,
        "order_id": fx.clean_value,
    },
}


def _same_number(c: Column) -> Column:
    return c


# Formats applied again on the way from staging to the star; all of them leave
# an already formatted value alone.  The merchant feed has none.
TRANSFORM_FORMATS: dict[str, dict[str, Fmt]] = {
    "campaign_data": {
        "campaign_name": _cleaned(fx.campaign_name),
        "campaign_description": _cleaned(fx.campaign_description),
        "discount": _same_number,
    },
    "product_list": {
        "product_name": _cleaned(fx.product_name),
        "product_type": fx.product_type,
        "price": _same_number,
    },
    "user_data": {
        "name": _cleaned(fx.person_name),
        "street": _cleaned(fx.street),
        "gender": fx.gender,
        "user_type": fx.user_type,
    },
    "user_job": {"job_title": _cleaned(fx.job_title), "job_level": fx.job_level},
    "user_credit_card": {
        "name": _cleaned(fx.person_name),
        "credit_card_number": _cleaned(fx.card_number),
        "issuing_bank": _cleaned(fx.bank),
    },
    "merchant_data": {
        "name": _cleaned(fx.person_name),
        "street": _cleaned(fx.street),
        "contact_number": _cleaned(fx.phone),
    },
    "staff_data": {"name": _cleaned(fx.person_name), "street": _cleaned(fx.street)},
    "order_data": {"transaction_date": lambda c: c.cast("date")},
    "line_item_data_prices": {"discount": _same_number, "quantity": _same_number},
    "line_item_data_products": {},
    "order_delays": {"delay_days": _same_number},
    "transactional_campaign_data": {"availed": lambda c: fx.availed_flag(c.cast("string"), "transform")},
}


def data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in schemas.LINEAGE]


# --- columns ----------------------------------------------------------------


def normalize_name(name: str) -> str:
    out = re.sub(r"_+", "_", name.strip().replace(" ", "_").replace("-", "_"))
    return out.strip("_")


def normalize_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c if c in schemas.LINEAGE else normalize_name(c) for c in df.columns])


def _is_blank_name(name: str) -> bool:
    """Blank headers read as ``_c0``, ``_c1`` ... or ``Unnamed: 0``."""
    low = name.strip().lower()
    return low == "" or low.startswith("unnamed") or re.fullmatch(r"_c\d+", low) is not None


def drop_unnamed(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if _is_blank_name(c)])


def _every_file(df: DataFrame, column: str, counting: bool, start: int | None = None) -> bool:
    """Whether all values of a column are whole numbers and, if ``counting``, run up by one in
    reading order, from ``start`` where it is given - in each file that has values, judged on all
    its rows.  One aggregate; one row comes back."""
    text = F.trim(F.col(f"`{column}`").cast("string"))
    number = text.try_cast("bigint")
    by = [F.col("file_source")] if "file_source" in df.columns else []
    per_file = (
        df.select(*by, "ingest_seq", text.alias("t"), number.alias("n"))
        .filter(F.col("t").isNotNull())
        .groupBy(*by)
        .agg(
            F.count_if(~F.col("t").rlike(r"^\d+$") | F.col("n").isNull()).alias("others"),
            F.count("*").alias("rows"),
            F.count_distinct("n").alias("distinct"),
            F.min("n").alias("low"),
            F.max("n").alias("high"),
            F.min_by("n", "ingest_seq").alias("first"),
            F.max_by("n", "ingest_seq").alias("last"),
        )
    )
    holds = F.col("others") == 0
    if counting:
        run = (F.col("high") - F.col("low") + 1 == F.col("rows")) & (F.col("distinct") == F.col("rows"))
        holds = holds & run & (F.col("first") == F.col("low")) & (F.col("last") == F.col("high"))
        if start is not None:
            holds = holds & (F.col("low") == start)
    return bool(per_file.filter(F.col("rows") > 0).agg(F.bool_and(F.coalesce(holds, F.lit(False))).alias("all")).first()["all"])


def drop_index_columns(df: DataFrame) -> DataFrame:
    """Drop leftovers of a row index: ``old_id``-like and nameless columns, and
    digit-named columns that count up by one through every file."""
    drop = []
    for c in data_columns(df):
        low = c.strip().lower()
        if "old_id" in low or _is_blank_name(c):
            drop.append(c)
        elif low.isdigit() and _every_file(df, c, counting=True):
            drop.append(c)
    return df.drop(*drop)


def drop_first_index_column(df: DataFrame, kind: str = "csv", aggressive: bool = False) -> DataFrame:
    """Drop the first column where it looks like a row index.

    CSV: no name, or a number as its name and values that count up by one in
    every file; with ``aggressive`` also when all its values are digits, which
    loses a genuine numeric key.  HTML: a number as its name, or values that run
    0, 1, 2, ... in every file.
    """
    columns = data_columns(df)
    if not columns:
        return df
    first = columns[0]
    if _is_blank_name(first):
        return df.drop(first)
    numbered = first.strip().isdigit()
    if kind == "html":
        return df.drop(first) if numbered or _every_file(df, first, counting=True, start=0) else df
    if numbered and len(columns) > 1 and _every_file(df, first, counting=True):
        return df.drop(first)
    return df.drop(first) if aggressive and _every_file(df, first, counting=False) else df


def resolve_aliases(df: DataFrame, dataset: str) -> DataFrame:
    """Rename columns that a file calls differently."""
    rules = ALIASES.get(dataset, {})
    taken: dict[str, str] = {}
    for column in data_columns(df):
        low = column.lower().strip().replace(" ", "_")
        for target, (sure, possible) in rules.items():
            if re.search(sure, low) or (target not in taken and re.search(possible, low)):
                taken[target] = column
                break
    out = df
    for target, column in taken.items():
        if target != column:
            if target in out.columns:
                out = out.drop(target)
            out = out.withColumnRenamed(column, target)
    return out


def first_present(df: DataFrame, names: list[str]) -> Column:
    """Value of the first of ``names`` that the frame has, else NULL."""
    for name in names:
        if name in df.columns:
            return F.col(name)
    return F.lit(None).cast("string")


def require_columns(df: DataFrame, dataset: str) -> DataFrame | None:
    """``None`` where a file must be skipped for want of a column."""
    policy, needed = REQUIRED.get(dataset, ("warn", []))
    missing = [c for c in needed if c not in df.columns]
    if not missing:
        return df
    log.warning("%s lacks %s (%s)", dataset, missing, policy)
    return None if policy == "skip" else df


# --- values -----------------------------------------------------------------


def clean_strings(df: DataFrame) -> DataFrame:
    """Strip every text, turn no-value tokens into NULL, squeeze inner blanks."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind == "string" and name not in schemas.LINEAGE:
            text = fx.strip(c)
            c = F.when(text.isin(NULL_TOKENS), F.lit(None)).otherwise(fx.squeeze(text)).alias(name)
        out.append(c)
    return df.select(*out)


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.dropna(how="all", subset=data_columns(df))


def clean_frame(df: DataFrame) -> DataFrame:
    """Everything a freshly read file goes through, whatever its format."""
    return drop_empty_rows(clean_strings(normalize_names(drop_index_columns(df))))


def with_row_placeholder(df: DataFrame, name: str = "line_item_id") -> DataFrame:
    """Place of the row within its file, from 0, where the file has no such id."""
    if name in df.columns:
        return df
    placed = with_group_position(df, ["file_source"], name="__place", few=True)
    return placed.withColumn(name, (F.col("__place") - 1).cast("string")).drop("__place")


def project_to_schema(df: DataFrame, dataset: str, extra: str | None = None) -> DataFrame | None:
    """Declared columns only, each in its declared type; what does not parse is
    NULL.  A frame that shares no column with the table gives nothing.

    ``extra`` declares further columns to keep, as DDL.
    """
    target = schemas.staging_schema(dataset)
    if extra:
        target = schemas.struct(extra + ", " + target.toDDL())
    have = set(df.columns)
    if not [f for f in target.fields if f.name in have and f.name not in schemas.LINEAGE]:
        log.warning("no column of %s among %s", dataset, df.columns)
        return None
    kinds = dict(df.dtypes)
    parsed = [
        f"try_cast({f.name} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in target.fields
        if kinds.get(f.name) not in (None, f.dataType.simpleString())
    ]
    same = [f.name for f in target.fields if kinds.get(f.name) == f.dataType.simpleString()]
    return df.selectExpr(*same, *parsed).to(target)


@lru_cache(maxsize=None)
def _formatted(column: str, fmt: Fmt) -> Column:
    return fmt(F.col(column))


def light_clean(df: DataFrame) -> DataFrame:
    """Older cleaning, driven by column names alone."""
    out = drop_unnamed(df)
    formats: dict[str, Fmt] = {}
    for c in data_columns(out):
        low = c.lower()
        if "discount" in low:
            formats[c] = fx.legacy_discount
        if "quantity" in low:
            formats[c] = fx.first_quantity
        if "estimated" in low and "arrival" in low:
            formats[c] = fx.arrival_days_before_word
        if "date" in low:
            formats[c] = fx.lenient_timestamp
    return out.withColumns({c: fmt(F.col(f"`{c}`")) for c, fmt in formats.items()})


def apply_formats(df: DataFrame, formats: dict[str, Fmt]) -> DataFrame:
    have = set(df.columns)
    present = {c: _formatted(c, fmt) for c, fmt in formats.items() if c in have}
    return df.withColumns(present) if present else df


def format_for_staging(df: DataFrame, dataset: str, extra: str | None = None) -> DataFrame | None:
    """Cleaned file -> rows of its staging table, or ``None`` if it is skipped."""
    out = resolve_aliases(df, dataset)
    if dataset == "line_item_data_products":
        out = with_row_placeholder(out)
    out = require_columns(out, dataset)
    if out is None:
        return None
    return project_to_schema(apply_formats(out, STAGE_FORMATS[dataset]), dataset, extra)


# Places are put into title case only by the direct load.
DIRECT_FORMATS: dict[str, dict[str, Fmt]] = {
    d: {c: _cleaned(fx.place) for c in ("city", "state", "country")}
    for d in ("user_data", "merchant_data", "staff_data")
}


def transform(df: DataFrame, dataset: str) -> DataFrame:
    """Staging rows -> rows for the star loaders.

    ``loaded_at`` is dropped; the file name and the order of arrival stay, so
    that rejects can name their source and first/last rules have an order.
    """
    out = df.drop("loaded_at")
    return apply_formats(out, TRANSFORM_FORMATS.get(dataset, {}))
