"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document's key is exponential, its rate the document's quality weight: sorted by key, the front
of a source is a weighted sample without replacement. Each source takes whole epochs first and then
the front of its documents up to the rest of its word budget.

No source is sorted or summed in one task. Sizes are added per (source, key bucket), and the bucket in
which a source's budget ends is cut again until it holds few rows; only those are ordered. What comes
out is one cut key per source, and every document is decided by comparing its own key with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from finetide.llm.store import Stored
from finetide.operators.positions import with_position

SHARE = 1.5
MOST = 2.0
# The weights of the sources in order, repeating.
WEIGHTS = (3, 1, 2)
#: Buckets that a range of keys is cut into, and rows of a source that are few enough to order.
BUCKETS = 4096
RANKED_ROWS = 20_000
#: Plans of so many sources are broadcast; more are joined by shuffle.
SMALL_SOURCES = 100_000
# Characters that count as symbols.
SYMBOLS = "#$%&*+/<=>@[\\]^_`{|}~!"
BLANKS = "\t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Runs of characters that are no space and not U+0009 to U+000D."""
    spaced = F.translate(F.coalesce(text.cast("string"), F.lit("")), BLANKS, " " * len(BLANKS))
    return F.array_remove(F.split(spaced, " "), "")


def quality_weight(text: Column) -> Column:
    """The share of characters that are no symbols, to the eighth power, and 0.05 at least."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    length = F.greatest(F.length(text), F.lit(1)).cast("double")
    share = 1 - (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))) / length
    second = share * share
    fourth = second * second
    return F.greatest(fourth * fourth, F.lit(0.05))


def sample_key(row_id: Column, weight: Column, seed: int) -> Column:
    """-ln(u) / weight, u uniform in (0, 1) by the hash of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit("null")))
    u = (F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.ln(u) / weight


def tie_key(text: Column) -> Column:
    """A number below 2**52 from the text, by which rows of one key are ordered."""
    return F.conv(F.substring(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")), 1, 13), 16, 10).cast("double")


def _key_columns(id_col: str, text_col: str, source_col: str, seed: int) -> list[Column]:
    text = F.col(text_col)
    key = sample_key(F.col(id_col), quality_weight(text), seed)
    return [F.col(source_col).cast("string").alias("source"), F.size(words(text)).cast("bigint").alias("size"), key.alias("key"), tie_key(text).alias("tie")]


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), *_key_columns(id_col, text_col, source_col, seed))


def targets(rows: DataFrame, share: float = SHARE, most: float = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target) from (source, size) rows.

    Targets share ``share`` times all sizes by weight; one that would exceed ``most`` times its
    source's size stops there and its excess goes to the others, until none is above. Each round
    is one small aggregate over the sources.
    """
    sums = Stored(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "sources").df
    named = sums.filter("source is not null")
    ranked = with_position(named, "source", "place") if named.take(1) else named.withColumn("place", F.lit(0).cast("bigint"))
    last = sums.filter("source is null").withColumn("place", F.lit(named.count()).cast("bigint"))
    ranked = ranked.select("source", "source_size", "place").unionByName(last.select("source", "source_size", "place"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    table = Stored(ranked.withColumn("weight", weight).withColumn("cap", most * F.col("source_size")), "weighed").df
    total = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        over = F.col("cap") <= level * F.col("weight") if capped >= 0 else F.lit(False)
        row = table.agg(F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0.0)).alias("full"), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)).alias("open"), F.count_if(over).alias("n")).first()
        if row["n"] == capped or not row["open"]:
            break
        capped = row["n"]
        level = (total - row["full"]) / row["open"]
    return table.select("source", "source_size", F.least("cap", level * F.col("weight")).alias("target"))


def _narrowed(rows: DataFrame, goal: DataFrame) -> DataFrame:
    """(own, before, rest, least and last key and tie) per source: the range of (key, tie) in which its budget ends.

    The range of keys is cut into ``BUCKETS`` whose sizes are added; the one in which the budget ends
    is cut again until it holds ``RANKED_ROWS`` rows at most, or one key, whose ties are then cut
    likewise. Each round is one aggregate over narrow rows and gives a row per source.
    """
    ends = lambda: [F.count("*").alias("n"), *[f(c).alias(f"{end}_{c}") for c in ("key", "tie") for f, end in ((F.min, "least"), (F.max, "last"))]]
    wanted = goal.filter((F.col("rest") > 0) & (F.col("rest") < F.col("source_size"))).select(F.col("source").alias("own"), "rest")
    whole = rows.groupBy("source").agg(*ends()).join(wanted, F.col("source").eqNullSafe(F.col("own"))).drop("source")
    ranges = Stored(whole.withColumn("before", F.lit(0).cast("bigint")), "ranges").df
    while not (left := ranges.filter(_wide())).isEmpty():
        by_key = F.col("least_key") < F.col("last_key")
        low, high = (F.when(by_key, F.col(f"{end}_key")).otherwise(F.col(f"{end}_tie")) for end in ("least", "last"))
        inside = _within(rows, left)
        value = F.when(by_key, F.col("key")).otherwise(F.col("tie"))
        bucket = F.least(F.floor((value - low) / (high - low) * BUCKETS), F.lit(BUCKETS - 1))
        sums = inside.groupBy("own", bucket.alias("bucket")).agg(F.sum("size").alias("size"), F.first("rest").alias("rest"), F.first("before").alias("start"), *ends())
        running = F.sum("size").over(W.partitionBy("own").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
        sums = sums.withColumn("before", F.col("start") + F.coalesce(running, F.lit(0)))
        chosen = sums.filter("before <= rest and rest < before + size").select(*ranges.columns)
        ranges = Stored(ranges.filter(~_wide()).unionByName(chosen), "ranges").df
    return ranges


def _wide() -> Column:
    return (F.col("n") > RANKED_ROWS) & ((F.col("least_key") < F.col("last_key")) | (F.col("least_tie") < F.col("last_tie")))


def _within(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    held = F.broadcast(ranges) if ranges.count() <= SMALL_SOURCES else ranges
    same = F.col("source").eqNullSafe(F.col("own")) & F.col("key").between(F.col("least_key"), F.col("last_key")) & F.col("tie").between(F.col("least_tie"), F.col("last_tie"))
    return rows.join(held, same)


def plan(rows: DataFrame, goal: DataFrame) -> DataFrame:
    """(source, source_size, target, epochs, cut, cut_tie, part, tied) per source.

    Documents whose (key, tie) is below the cut are in the fractional epoch; those on it, ``tied``
    words in all, give ``part`` words.
    """
    size, target = F.col("source_size"), F.col("target")
    epochs = F.when(size > 0, F.floor(target / size + 1e-9)).otherwise(0).cast("bigint")
    goal = goal.withColumn("epochs", epochs).withColumn("rest", F.greatest(F.round(target - F.col("epochs") * size), F.lit(0)).cast("bigint"))
    goal = Stored(goal, "goals").df
    inside = _within(rows, _narrowed(rows, goal)).groupBy("own", "key", "tie").agg(F.sum("size").alias("tied"), F.first("before").alias("before"), F.first("rest").alias("rest"))
    running = F.sum("tied").over(W.partitionBy("own").orderBy("key", "tie").rowsBetween(W.unboundedPreceding, -1))
    inside = inside.withColumn("before", F.col("before") + F.coalesce(running, F.lit(0))).filter("before <= rest and rest < before + tied")
    inside = inside.select("own", F.col("key").alias("cut"), F.col("tie").alias("cut_tie"), (F.col("rest") - F.col("before")).alias("part"), "tied")
    out = goal.join(inside, F.col("source").eqNullSafe(F.col("own")), "left").drop("own")
    # Without a cut the rest is 0 or the whole source: rounding may leave either.
    none = F.when(F.col("rest") > 0, F.lit(float("inf"))).otherwise(-1.0)
    out = out.withColumn("cut", F.coalesce("cut", none)).na.fill(-1, ["cut_tie"]).na.fill(0, ["part"]).na.fill(1, ["tied"]).drop("rest")
    return Stored(out, "mix-plan").df


def _decided(rows: DataFrame, planned: DataFrame, whole: bool) -> DataFrame:
    """``fraction``: the words that the fractional epoch takes, and ``taken``: all words. ``whole``: of the
    documents on the cut all words are taken or none, whichever is nearer."""
    planned = planned.withColumnRenamed("source", "own")
    planned = F.broadcast(planned) if planned.count() <= SMALL_SOURCES else planned
    joined = rows.join(planned, F.col("source").eqNullSafe(F.col("own"))).drop("own")
    below = (F.col("key") < F.col("cut")) | ((F.col("key") == F.col("cut")) & (F.col("tie") < F.col("cut_tie")))
    part = F.floor(F.col("size") * F.col("part") / F.col("tied"))
    if whole:
        part = F.when(2 * F.col("part") >= F.col("tied"), F.col("size")).otherwise(0)
    on_it = (F.col("key") == F.col("cut")) & (F.col("tie") == F.col("cut_tie"))
    share = F.when(below, F.col("size")).when(on_it, part).otherwise(0)
    return joined.withColumn("fraction", share.cast("bigint")).withColumn("taken", (F.col("epochs") * F.col("size") + share).cast("bigint"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17) -> DataFrame:
    """(id, size, source_size, target, taken) per row of ``docs``.

    Null and empty texts have size 0 and are taken 0 times; a null source is the last source. Rows of
    equal keys (repeated or null ids) go by a hash of their texts; equal rows share what a cut leaves
    them by size. Reruns agree, whatever the partitioning. An empty table gives an empty one.
    """
    rows = Stored(_keyed(docs, id_col, text_col, source_col, seed), "keys").df
    decided = _decided(rows, plan(rows, targets(rows)), whole=False)
    return decided.select(F.col("id").alias(id_col), "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row per epoch, and the fractional epoch's rows.

    Rows come whole and unchanged: the document on which a source's budget ends is taken if that comes
    nearer to the budget than leaving it, and so are all rows equal to it. Texts are not shuffled:
    each row is decided by its source's cut. Documents of which nothing is taken go, those without
    words among them. Columns may have any names.
    """
    rows = Stored(_keyed(docs, id_col, text_col, source_col, seed), "keys").df
    planned = plan(rows, targets(rows))
    shape = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    decided = _decided(docs.select(shape, *_key_columns(id_col, text_col, source_col, seed)), planned, whole=True)
    copies = F.col("epochs") + F.when(F.col("fraction") > 0, 1).otherwise(0)
    copies = F.when((copies > 0) & (F.col("size") > 0), F.sequence(F.lit(1).cast("bigint"), copies)).otherwise(F.array().cast("array<bigint>"))
    return decided.select("row", F.explode(copies)).select(*[F.col("row")[c].alias(c) for c in docs.columns])
