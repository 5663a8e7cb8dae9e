"""Column expressions: every formatter is ``Column -> Column``, no UDFs."""

from tallyhouse.functions.numbers import (
    arrival_days_before_word,
    availed_flag,
    discount_percent,
    extract_number,
    first_non_falsy,
    first_quantity,
    legacy_discount,
    to_decimal,
    to_double,
    truncate_number,
)
from tallyhouse.functions.dates import date_key, lenient_date, lenient_timestamp, month_label
from tallyhouse.functions.text import (
    bank,
    campaign_description,
    campaign_name,
    card_number,
    clean_value,
    gender,
    job_level,
    job_title,
    normalize_key,
    person_name,
    phone,
    place,
    product_name,
    product_type,
    product_type_basic,
    product_type_group,
    row_json,
    squeeze,
    street,
    strip,
    title,
    user_type,
)

__all__ = [n for n in dir() if not n.startswith("_")]
