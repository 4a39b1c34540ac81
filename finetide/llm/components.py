"""Connected components by alternating large and small stars.

Every round rewrites the links as a table in the shared folder: an executor that is lost costs a
task, not the rounds so far. A node with very many links meets them in a join on two shuffled
sides, which Spark splits when one key is large, and in minima that are taken before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finetide.llm.store import Stored


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for each node that has a link; root is the smallest node it reaches.

    Links of a node with itself and links with a null end count as none.
    """
    real = links.filter(F.col(a) != F.col(b))
    now = Stored(real.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    seen = _state(now.df)
    while True:
        new = Stored(_round(now.df), "links")
        state = _state(new.df)
        now.drop()
        now = new
        if state == seen:
            break
        seen = state
    stars = now.df
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).union(stars.select("v", "v").distinct())


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.crc32(F.hex(F.xxhash64("u", "v")).cast("binary")))).first())


def _round(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    # A link (u, v) of the least m becomes (v, m); (u, m) itself is the case v = m.
    small = large.join(least, "u").select(
        F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")
    )
    return small.filter("u <> v").distinct()
