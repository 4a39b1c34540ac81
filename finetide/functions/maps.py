"""Map expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def numbered_values(c: Column) -> Column:
    """The values under digits-only keys, in the order of those numbers; other keys are left out."""
    digits = F.map_filter(c, lambda key, _: key.rlike("^[0-9]+$"))
    pairs = F.transform(
        F.map_entries(digits),
        lambda e: F.struct(e["key"].cast("decimal(38,0)").alias("n"), e["value"].alias("value")),
    )
    return F.transform(F.array_sort(pairs), lambda e: e["value"])


def expected_parts(size: Column, part_size: int) -> Column:
    """How many parts of ``part_size`` a file of ``size`` bytes has; none if it is empty."""
    return F.ceil(size / part_size).cast("bigint")


def upload_parts(c: Column, size: Column, part_size: int) -> Column:
    """``numbered_values``, checked against the number of parts the size calls for."""
    parts = numbered_values(c)
    message = F.format_string("found %d parts, expected %d", F.size(parts), expected_parts(size, part_size))
    return F.when(F.size(parts) == expected_parts(size, part_size), parts).otherwise(F.raise_error(message))
