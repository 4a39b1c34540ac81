"""Groups of linked rows: each row's group is named by its least member."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finetide.session import written


def groups(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for each node with a link to another one; ``root`` is the least it reaches.

    Every round takes the least name among a node's neighbours and then that name's own name, so
    chains halve and the rounds are about the logarithm of the longest. The state is a table in the
    shared folder: a lost executor costs a task. Minima are taken before the shuffle, and a node of
    very many links stands in a join that Spark can split.
    """
    real = links.select(F.col(a).alias("node"), F.col(b).alias("other")).filter("node <> other")
    both = written(real.union(real.select("other", "node")).distinct(), "links")
    roots = written(both.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("root")), "groups")
    while True:
        named = both.join(roots.select(F.col("node").alias("other"), "root"), "other")
        least = named.groupBy("node").agg(F.min("root").alias("least"))
        nearer = roots.join(least, "node").select("node", F.least("root", "least").alias("root"), F.col("root").alias("was"))
        nearer = written(nearer, "groups")
        ends = nearer.select(F.col("node").alias("end"), F.col("root").alias("end_root"))
        jumped = nearer.join(ends, F.col("root") == F.col("end")).select("node", F.col("end_root").alias("root"), "was")
        after = written(jumped, "groups")
        changed = not after.filter("root <> was").isEmpty()
        roots = after.select("node", "root")
        if not changed:
            return roots
