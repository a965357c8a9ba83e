"""Small text expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def address_part(address: Column) -> Column:
    """The last but one comma-separated part: ``''`` for a single part, NULL for no address."""
    part = F.trim(F.try_element_at(F.split(address, ","), F.lit(-2)))
    return F.when(address.isNotNull(), F.coalesce(part, F.lit("")))


def grid(value: Column) -> Column:
    """Round to one decimal, ties to even."""
    return F.bround(value, 1)


def point_text(latitude: Column, longitude: Column) -> Column:
    return F.concat_ws(", ", latitude.cast("string"), longitude.cast("string"))


def page_query(page: Column, rows: int) -> Column:
    return F.concat(F.lit(f"limit={rows}&offset="), (page * rows).cast("string"))
