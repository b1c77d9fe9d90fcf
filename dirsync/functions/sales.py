"""Addresses and prices of the sales table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# Fixed value: optional '#', digits, optional letter, optional range, then white space.
HOUSE_NUMBER = r"^\s*#?\d+[A-Za-z]?(?:[-–/]\d+[A-Za-z]?)?\s+"


def strip_house_no(address: Column) -> Column:
    return strip(F.regexp_replace(F.coalesce(address, F.lit("")), HOUSE_NUMBER, ""))


def fmt_price(price: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(price.cast("bigint"), 0))


def addr_query(address: Column, city: Column, state: Column, zip_code: Column, default_state: str) -> Column:
    """The text an address is looked up by."""
    return F.format_string(
        "%s, %s, %s %s",
        strip(address),
        strip(city),
        F.coalesce(state, F.lit(default_state)),
        F.coalesce(zip_code, F.lit("")),
    )
