"""Hash keys and canonical JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_LENGTH = 16


def short_hash(c: Column) -> Column:
    return F.substring(F.sha2(c, 256), 1, KEY_LENGTH)


def canonical_json(c: Column) -> Column:
    """JSON text with object keys in order at every level and no optional blanks."""
    return F.to_json(F.parse_json(c))


def config_key(config_json: Column) -> Column:
    """The content address of a configuration given as JSON text."""
    return short_hash(canonical_json(config_json))


def seeded_key(seed: int, row_id: Column) -> Column:
    """A uniform, reproducible sort key per row: shuffles without a random generator."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), row_id.cast("string")), 256)
