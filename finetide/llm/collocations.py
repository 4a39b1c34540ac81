"""Phrases whose words keep company: collocations by fingerprints of n-grams.

A prefix polynomial over the words of a stretch of text gives the Rabin-Karp fingerprint of any
n-gram as a difference of two sums, so numpy hashes all of them without a loop. The texts are read
once per phrase length and once more:

1. Words are counted by fingerprint, and the frequent ones make a filter of fixed size; then pairs
   of words that pass it, triples of pairs that pass theirs, and so on.
2. N-grams that pass their length's filter are counted by two independent fingerprints, with a
   pointer to a text that holds one. A filter lets too much pass, never too little, so counts do
   not depend on its size; phrases that share the first fingerprint are told apart by the second.

Only then is text touched: each frequent fingerprint is looked up in the one text it points to,
where the phrase must be found again, and becomes words. Occurrences are added up per task before
each shuffle, so a phrase in a third of all texts is one row per task; pointed texts are the only
ones that move.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from finetide.llm.bitfilter import fixed_filter, passes
from finetide.llm.store import Stored
from finetide.llm.textcodes import U64, lowered, mixed, owner, span_hashes, spans, text_parts

MAX_WORDS = 3
LEAST_COUNT = 10
#: Per cent of a phrase's occurrences inside a longer candidate from which it counts as its part.
INSIDE = 50
TOP = 2000
UNKNOWN = "und"
#: Bits of a filter, as a power of two.
FILTER_BITS = 25
#: N-grams that a task holds before it adds them up, and rows it hands on at once.
HELD = 1_500_000
ROWS = 200_000
#: Parts in which the candidates of a language are ranked first.
RANKED_PARTS = 32
_OTHER_BASE = 0xA0761D6478BD642F
# The characters that end a piece, and those that end a word inside one.
STOPS = ".,;:!?\n\x0b\x0c\r"
BLANKS = " \t"
_STOP_BYTES = np.zeros(256, bool)
_STOP_BYTES[list(STOPS.encode())] = True
_WORD_BYTES = ~_STOP_BYTES
_WORD_BYTES[list(BLANKS.encode())] = False


class Words:
    """The words of some texts, and the fingerprints of their n-grams; none crosses a piece's end."""

    def __init__(self, data: np.ndarray, off: np.ndarray, keys: np.ndarray, bits: int) -> None:
        self.low = lowered(data)
        self.starts, self.ends, first = spans(self.low, off, _WORD_BYTES)
        self.text, self.keys, self.shift = owner(first), keys, U64(64 - bits)
        n = len(self.starts)
        self.hashes = span_hashes(self.low, self.starts, self.ends)
        stops = np.zeros(len(self.low) + 1, np.int64)
        np.cumsum(_STOP_BYTES[self.low], out=stops[1:])
        self.joined = np.zeros(n, bool)  # with the next word
        if n:
            self.joined[:-1] = (self.text[1:] == self.text[:-1]) & (stops[self.starts[1:]] == stops[self.ends[:-1]])

    def whole(self, n: int) -> np.ndarray:
        """First words of the n-grams."""
        ok = np.ones(max(len(self.starts) - n + 1, 0), bool)
        for k in range(n - 1):
            ok &= self.joined[k : k + len(ok)]
        return np.flatnonzero(ok)

    def passing(self, n: int, filter_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First words and first fingerprints of the n-grams that pass."""
        at = self.whole(n)
        h = self.prints(at, n)
        ok = passes(filter_, h)
        return at[ok], h[ok]

    def prints(self, at: np.ndarray, n: int) -> np.ndarray:
        """The first fingerprint; it covers the language."""
        return mixed(span_hashes(self.hashes, at, at + n) ^ self.keys[self.text[at]]) >> self.shift

    def other_prints(self, at: np.ndarray, n: int) -> np.ndarray:
        return mixed(span_hashes(self.hashes, at, at + n, _OTHER_BASE) ^ self.keys[self.text[at]])

    def phrase(self, at: int, n: int) -> str:
        raw = [self.low[s:e].tobytes() for s, e in zip(self.starts[at : at + n].tolist(), self.ends[at : at + n].tolist(), strict=True)]
        return b" ".join(raw).decode()


def _word_parts(batch: pa.RecordBatch, bits: int) -> Iterator[tuple[int, Words]]:
    """(first row, its words) of some rows of (mark, key, text) at a time."""
    keys = batch.column(1).to_numpy(zero_copy_only=False).view(U64)
    for i, j, data, off in text_parts(batch.column(2)):
        yield i, Words(data, off, keys[i:j], bits)


def _counts(docs: DataFrame, n: int, filter_: np.ndarray | None, least: int, bits: int) -> DataFrame:
    """(h) of the frequent n-grams; ``filter_`` is that of the next shorter ones."""

    def added(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        h, count = np.unique(np.concatenate(parts), return_counts=True)
        for i in range(0, len(h), ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(h[i : i + ROWS].view(np.int64)), pa.array(count[i : i + ROWS])], names=["h", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for _, words in _word_parts(batch, bits):
                at = words.whole(n)
                if filter_ is not None:
                    frequent = np.zeros(len(words.starts), bool)
                    frequent[words.passing(n - 1, filter_)[0]] = True
                    at = at[frequent[at] & frequent[at + 1]]
                held.append(words.prints(at, n))
                if sum(map(len, held)) >= HELD:
                    yield from added(held)
                    held = []
        if held:
            yield from added(held)

    rows = docs.mapInArrow(run, "h bigint, f bigint")
    return Stored(rows.groupBy("h").agg(F.sum("f").alias("f")).filter(F.col("f") >= least).select("h"), "frequent").df


def _found(docs: DataFrame, filters: list[np.ndarray], least: int, bits: int) -> DataFrame:
    """(n, h, g, f, mark) of the frequent n-grams, and with n of 0 all words per language, h its key."""
    names = ["n", "h", "g", "f", "mark"]

    def added(n: int, parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        h, g, mark = (np.concatenate(x) for x in zip(*parts, strict=True))
        if not len(h):
            return
        order = np.argsort(h, kind="stable")
        h, g, mark = h[order], g[order], mark[order]
        heads = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])))
        count, mark = np.diff(np.append(heads, len(h))), np.minimum.reduceat(mark, heads)
        h, g = h[heads].view(np.int64), g[heads].view(np.int64)
        for i in range(0, len(h), ROWS):
            columns = [np.full(len(h[i : i + ROWS]), n, np.int32), *(x[i : i + ROWS] for x in (h, g, count, mark))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, ...]]] = {n: [] for n in range(1, len(filters) + 1)}
        sizes = dict.fromkeys(held, 0)
        totals: dict[int, int] = {}
        for batch in batches:
            marks = batch.column(0).to_numpy(zero_copy_only=False)
            for i, words in _word_parts(batch, bits):
                keys, of = np.unique(words.keys[words.text], return_inverse=True)
                for key, count in zip(keys.view(np.int64).tolist(), np.bincount(of, minlength=len(keys)).tolist(), strict=True):
                    totals[key] = totals.get(key, 0) + count
                for n, filter_ in enumerate(filters, 1):
                    at, h = words.passing(n, filter_)
                    held[n].append((h, words.other_prints(at, n), marks[i + words.text[at]]))
                    sizes[n] += len(at)
                    if sizes[n] >= HELD:
                        yield from added(n, held[n])
                        held[n], sizes[n] = [], 0
        for n, parts in held.items():
            if parts:
                yield from added(n, parts)
        if totals:
            columns = [pa.array([0] * len(totals), pa.int32()), pa.array(list(totals), pa.int64()), pa.array([0] * len(totals), pa.int64()), pa.array(list(totals.values()), pa.int64()), pa.array([0] * len(totals), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.mapInArrow(run, "n int, h bigint, g bigint, f bigint, mark bigint")
    sums = rows.groupBy("n", "h", "g").agg(F.sum("f").alias("f"), F.min("mark").alias("mark"))
    return Stored(sums.filter((F.col("f") >= least) | (F.col("n") == 0)), "found-prints").df


def _materialised(docs: DataFrame, langs: DataFrame, found: DataFrame, bits: int) -> DataFrame:
    """(lang, n, phrase, f): each fingerprint read in the text it points to."""
    grams = found.filter("n > 0")
    pointed = fixed_filter(grams, "mark", FILTER_BITS)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column(0).to_numpy(zero_copy_only=False).view(U64)
            yield batch.filter(pa.array(passes(pointed, marks)))

    texts = docs.mapInArrow(kept, docs.schema)
    wanted = grams.groupBy("mark").agg(F.collect_list(F.struct("n", "h", "g", "f")).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                own = batch.slice(k, 1)
                asked = own.column(3).values.slice(own.column(3).offsets[0].as_py(), own.column(3).value_lengths()[0].as_py())
                n_of, h_of, g_of, f_of = (asked.field(c).to_numpy(zero_copy_only=False) for c in range(4))
                rows: list[tuple[int, int, str, int]] = []
                for _, words in _word_parts(own, bits):
                    for n in np.unique(n_of).tolist():
                        mine = np.flatnonzero(n_of == n)
                        at = words.whole(n)
                        h, g = words.prints(at, n).view(np.int64), words.other_prints(at, n).view(np.int64)
                        place = {pair: p for pair, p in zip(zip(h.tolist(), g.tolist(), strict=True), at.tolist(), strict=True)}
                        rows += [(n, int(f_of[m]), words.phrase(place[int(h_of[m]), int(g_of[m])], n), int(h_of[m])) for m in mine]
                key = own.column(1)[0].as_py()
                columns = [pa.array([key] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "n", "phrase", "f"])

    rows = texts.join(wanted, "mark").select("mark", "key", "text", "wanted").mapInArrow(run, "key bigint, n int, phrase string, f bigint")
    rows = rows.groupBy("key", "n", "phrase").agg(F.max("f").alias("f"))  # of rows that are alike in all one counts
    return Stored(rows.join(langs, "key").select("lang", "n", "phrase", "f"), "phrases").df


def floored(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)), exact beyond 64 bits."""
    long = lambda c: c.cast("decimal(15,0)")
    return F.call_function("div", long(a) * long(a) * F.lit(1_000_000).cast("decimal(7,0)"), long(left) * long(right))


def phrases(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS, least: int = LEAST_COUNT, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """(lang, n, phrase, f) of all phrases of up to ``max_words`` words with ``least`` occurrences,
    and (lang, n_words) per language. ``bits`` shortens the first fingerprint."""
    lang, text = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = docs.select(F.xxhash64(F.col(id_col), lang, text).alias("mark"), F.xxhash64(lang).alias("key"), text.alias("text"))
    langs = Stored(docs.select(lang.alias("lang")).distinct().select("lang", F.xxhash64("lang").alias("key")), "languages").df
    filters: list[np.ndarray] = []
    for n in range(1, max_words + 1):
        filters.append(fixed_filter(_counts(own, n, filters[-1] if filters else None, least, bits), "h", FILTER_BITS))
    found = _found(own, filters, least, bits)
    totals = found.filter("n = 0").select(F.col("h").alias("key"), F.col("f").alias("n_words")).join(langs, "key").select("lang", "n_words")
    return _materialised(own, langs, found, bits), totals


def collocations(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    max_words: int = MAX_WORDS, least: int = LEAST_COUNT, top: int = TOP, inside: int = INSIDE, bits: int = 64,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases by score.

    A phrase's score is that of its worst cut into a first part of l and a rest of r occurrences.
    Phrases that mostly stand inside a longer candidate go. A null language is ``und``; null and
    empty texts have no words; rows that repeat an id count each; a language without candidates, as
    an empty table, gives no row. Equal scores rank by occurrences, then by the phrase's bytes.
    Other columns of ``docs`` play no part, whatever their names.
    """
    if max_words < 2:
        raise ValueError("max_words must be 2 or more")
    known, totals = phrases(docs, id_col, text_col, lang_col, max_words, least, bits)
    parts = known.select("lang", "phrase", "f")
    words = F.split("phrase", " ")
    candidates = known.filter("n >= 2").select("lang", "phrase", F.col("f").alias("a"), "n", words.alias("words"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n") - 1)))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("n") - F.col("k")), " ").alias("right"),
    )
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    worst = cuts.select("lang", "phrase", "a", F.struct(floored(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r").alias("cut"))
    scored = worst.groupBy("lang", "phrase").agg(F.min("a").alias("a"), F.min("cut").alias("cut"))
    shorter = F.flatten(F.transform(F.sequence(F.lit(2), F.col("n") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("n") - m + 1), lambda i: F.array_join(F.slice("words", i, m), " "))))
    longer = candidates.filter("n > 2").select("lang", F.explode(shorter).alias("phrase"), "a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("longer") < inside * F.col("a"), F.lit(True)))
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANKED_PARTS))
    first = kept.withColumn("place", F.row_number().over(W.partitionBy("lang", part).orderBy(*order))).filter(F.col("place") <= top)
    ranked = first.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("bigint")).filter(F.col("rank") <= top)
    return ranked.join(totals.withColumnRenamed("n_words", "n"), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
