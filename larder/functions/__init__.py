from larder.functions.numbers import (
    comma_decimal,
    lenient_double,
    lenient_int,
    lenient_long,
    percent_of,
    typed_null,
)
from larder.functions.text import is_present, list_items, normal_lower, normal_upper
from larder.functions.dates import date_parts, parse_iso_date, path_text

__all__ = [
    "comma_decimal",
    "date_parts",
    "is_present",
    "lenient_double",
    "lenient_int",
    "lenient_long",
    "list_items",
    "normal_lower",
    "normal_upper",
    "parse_iso_date",
    "path_text",
    "percent_of",
    "typed_null",
]
