"""Benchmark decontamination by winnowing.

Of every window of consecutive word k-grams the least hash is kept, so that each run of
``K + WINDOW - 1`` = 13 words shared by a document and an item has a kept k-gram in common. The
items' fingerprints are joined with the documents' and each hit is extended word by word, which
both verifies it and finds its whole extent; a window that a hit's surroundings reach beyond has
a kept k-gram of its own.

Of the documents' fingerprints only those are shuffled that pass a filter of the items' hashes.
The filter has 2**FILTER_BITS bits whatever the size of the benchmark: a benchmark that fills it
sends more rows to the join, but the result does not depend on it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finetide.llm.store import Stored
from finetide.llm.textcodes import U64, WORD_BYTES, gram_hashes, lowered, owner, span_hashes, spans, text_parts, winnowed

SPAN = 13
K = 5
WINDOW = SPAN - K + 1
FILTER_BITS = 22


def _items(items: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Distinct word sequences with their fingerprints, and the ids of each sequence."""
    kept = items.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).cast("string").alias("text"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: list[list[str]] = [[] for _ in range(batch.num_rows)]
            for i, _, data, off in text_parts(batch.column(1)):
                low = lowered(data)
                starts, ends, first = spans(low, off, WORD_BYTES)
                raw = low.tobytes()
                for k in range(len(off) - 1):
                    own = slice(first[k], first[k + 1])
                    words[i + k] = [raw[a:b].decode() for a, b in zip(starts[own], ends[own], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, type=pa.list_(pa.string()))], names=["item_id", "words"])

    worded = kept.mapInArrow(split, "item_id string, words array<string>").filter(F.size("words") > 0)
    worded = worded.withColumn("sequence", F.sha2(F.array_join("words", " "), 256))
    named = Stored(worded, "items").df
    classes = named.groupBy("sequence").agg(F.first("words").alias("words"))

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, fps, places, least, lists = [], [], [], [], []
            for sequence, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = [w.encode() for w in words]
                data = np.frombuffer(b"".join(raw), np.uint8)
                ends = np.cumsum([len(w) for w in raw])
                hashes = span_hashes(data, ends - [len(w) for w in raw], ends)
                if len(words) < SPAN:
                    grams, at = gram_hashes(hashes, len(words)), [0]
                else:
                    grams = gram_hashes(hashes, K)
                    at = np.flatnonzero(winnowed(grams, np.array([0, len(words)]), K, WINDOW)).tolist()
                keys += [sequence] * len(at)
                fps += [int(x) for x in grams[at].view(np.int64)]
                # A hit is extended by a window to each side at most: the words beyond stay behind.
                heads = [max(0, p - SPAN) for p in at]
                places += [p - h for p, h in zip(at, heads, strict=True)]
                least += [min(SPAN, len(words))] * len(at)
                lists += [words[h : p + K + SPAN] for p, h in zip(at, heads, strict=True)]
            columns = [pa.array(keys, pa.string()), pa.array(fps, pa.int64()), pa.array(places, pa.int32()), pa.array(least, pa.int32()), pa.array(lists, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["sequence", "fp", "at", "least", "words"])

    found = classes.mapInArrow(prints, "sequence string, fp bigint, at int, least int, words array<string>")
    return Stored(found, "item-prints").df, named.select("sequence", "item_id")


def _hits(docs: DataFrame, id_col: str, text_col: str, slots: np.ndarray, short: list[int]) -> DataFrame:
    """(row, id, n_words, hits) per row: the fingerprints that pass the filter, with the words around."""
    kept = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")
    )
    mask = U64((1 << FILTER_BITS) - 1)
    hit_type = pa.struct([("fp", pa.int64()), ("at", pa.int32()), ("before", pa.int32()), ("words", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = np.zeros(1 << FILTER_BITS, bool)
        sent[slots] = True
        for batch in batches:
            counts = np.zeros(batch.num_rows, np.int64)
            hits: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for i, j, data, off in text_parts(batch.column(2)):
                low = lowered(data)
                starts, ends, first = spans(low, off, WORD_BYTES)
                counts[i:j] = np.diff(first)
                hashes = span_hashes(low, starts, ends)
                of = owner(first)
                raw = low.tobytes()
                for length in [K, *short]:
                    grams = gram_hashes(hashes, length)
                    if not len(grams):
                        continue
                    passed = sent[(grams >> U64(1)) & mask]
                    # A whole item of K words lies in no window; then every k-gram is looked up.
                    at = np.flatnonzero(passed & winnowed(grams, first, K, WINDOW) if length == K and K not in short else passed)
                    at = at[of[at] == of[at + length - 1]]
                    for p, d in zip(at.tolist(), of[at].tolist(), strict=True):
                        a = max(int(first[d]), p - (SPAN - length) if length == K else p)
                        b = min(int(first[d + 1]), p + SPAN if length == K else p + length)
                        words = " ".join([raw[s:e].decode() for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)])
                        hits[i + d].append({"fp": int(grams[p : p + 1].view(np.int64)[0]), "at": p - int(first[d]), "before": p - a, "words": words})
            columns = [batch.column(0), batch.column(1), pa.array(counts), pa.array(hits, type=pa.list_(hit_type))]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "id", "n_words", "hits"])

    kind = kept.schema["id"].dataType.simpleString()
    return kept.mapInArrow(run, f"row bigint, id {kind}, n_words bigint, hits array<struct<fp bigint, at int, before int, words string>>")


def _extended(joined: DataFrame) -> DataFrame:
    """(row, sequence, lo, hi) of the document words that each verified hit covers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sequences, los, his = [], [], [], []
            for row, at, before, text, sequence, place, least, item in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = text.split(" ")
                lo, k = before, place
                while lo > 0 and k > 0 and words[lo - 1] == item[k - 1]:
                    lo, k = lo - 1, k - 1
                hi, k = before, place
                while hi < len(words) and k < len(item) and words[hi] == item[k]:
                    hi, k = hi + 1, k + 1
                if hi > before and hi - lo >= least:
                    rows.append(row)
                    sequences.append(sequence)
                    los.append(at - before + lo)
                    his.append(at - before + hi)
            columns = [pa.array(rows, pa.int64()), pa.array(sequences, pa.string()), pa.array(los, pa.int64()), pa.array(his, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "sequence", "lo", "hi"])

    return joined.mapInArrow(run, "row bigint, sequence string, lo bigint, hi bigint")


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(id, n_words, n_hit, item_ids, spans) per row of ``docs``.

    A window is 13 consecutive words of an item, or all words of a shorter one. n_hit counts the
    document's words inside any occurrence of a window, spans are their joint (lo, hi) word
    ranges, item_ids the items that have occurring windows, sorted as strings. Null and empty
    texts have no words and hit nothing; items without words never occur; a null item id counts
    under the name "null"; items of one id count as one; repeated documents are counted each; an empty benchmark hits nothing.
    """
    prints, named = _items(items, item_id_col, item_text_col)
    mask = (1 << FILTER_BITS) - 1
    slots = prints.select(F.shiftright("fp", 1).bitwiseAND(F.lit(mask)).alias("slot")).distinct().toArrow().column(0).to_numpy()
    lengths = prints.filter(F.col("least") < SPAN).select("least").distinct()
    short = sorted(r[0] for r in lengths.collect())  # at most twelve
    rows = Stored(_hits(docs, id_col, text_col, slots, short), "document-prints").df
    hits = rows.filter(F.size("hits") > 0).select("row", F.explode("hits").alias("hit"))
    right = prints.select("fp", "sequence", F.col("at").alias("place"), "least", F.col("words").alias("item"))
    joined = hits.select("row", "hit.*").join(right, "fp").select("row", "at", "before", "words", "sequence", "place", "least", "item")
    found = Stored(_extended(joined).distinct(), "extended").df
    covered = found.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("lo", "hi"))).alias("parts")).select("row", _union("parts"))
    ids = named.select("sequence", F.coalesce("item_id", F.lit("null")).alias("item_id"))
    items_of = found.select("row", "sequence").distinct().join(ids, "sequence")
    items_of = items_of.groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    marked = covered.join(items_of, "row")
    out = rows.select("row", "id", "n_words").join(marked, "row", "left")
    empty = F.array().cast("array<struct<lo:bigint,hi:bigint>>")
    out = out.select("id", "n_words", F.coalesce("spans", empty).alias("spans"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))
    length = F.aggregate("spans", F.lit(0).cast("bigint"), lambda t, s: t + s["hi"] - s["lo"])
    return out.select(F.col("id").alias(id_col), "n_words", length.alias("n_hit"), "item_ids", "spans")


def _union(parts: str):
    """Joint ranges of sorted, possibly overlapping ones."""
    empty = F.array().cast("array<struct<lo:bigint,hi:bigint>>")

    def add(done, part):
        last = F.try_element_at(done, F.lit(-1))
        grown = F.struct(last["lo"].alias("lo"), F.greatest(last["hi"], part["hi"]).alias("hi"))
        joined = F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(grown))
        return F.when(last["hi"] >= part["lo"], joined).otherwise(F.concat(done, F.array(part)))

    return F.aggregate(parts, empty, add).alias("spans")


def is_contaminated():
    """The share rule: hit words are at least one in twenty."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def clean_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated; a row of a null id stays. Columns stay as they are."""
    found = contamination(docs, items, id_col, text_col).filter(is_contaminated())
    bad = Stored(found.select(id_col).filter(F.col(id_col).isNotNull()).distinct(), "contaminated").df
    return docs.join(bad, id_col, "left_anti").select(*docs.columns)
