"""Repeated passages: runs of consecutive sentences, hashed and joined over the whole corpus.

A sentence of more than ``CUT_WINDOW`` words counts as several. A run starts or ends at each
sentence and takes as few further sentences as it needs to hold ``least_words`` words; a third one
has an end that follows from the words up to it and a window beyond. So a passage of whole sentences
with that many words is covered by runs that lie within it, to its first and last sentence. One that
starts and ends anywhere keeps about a dozen words at an end, where its copies may be cut unlike,
and has a run from 50 words on. A run that occurs in several documents stays
in the one with the least id; in one document it stays where it is first. All sentences of the
other occurrences are removed.

A run is 96 bits of hash, a document id and two sentence numbers. The least id of each run is a
sum-like aggregate taken before the shuffle, so a passage in a third of all documents is one row
per task there; in the join that follows Spark splits a large key. Texts move once, to their
document's list of removed sentences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finetide.llm.bitfilter import fixed_filter, passes
from finetide.llm.store import Stored
from finetide.llm.textcodes import WORD_BYTES, gram_hashes, lowered, owner, span_hashes, spans, text_parts, winnowed

#: A run has this many words at least.
LEAST_WORDS = 25
#: A sentence of more words is taken in pieces: it is cut before each word pair of the least hash
#: in a window of so many. Copies of a passage inside long sentences are so cut alike, and no
#: piece is longer than the window.
CUT_WINDOW = 12
LONG_SENTENCE = CUT_WINDOW
#: Bits of the filter of shared runs, as a power of two.
FILTER_BITS = 27
_OTHER_BASE = 0xA0761D6478BD642F
_STOPS = np.zeros(256, dtype=bool)
_STOPS[[33, 46, 63]] = True
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, 9, 11, 12, 13]] = True


def sentences(low: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """(word starts, word hashes, first word of each sentence and the end, each text's first sentence, sentence's text, first words after a stop).

    A sentence ends after a stop with white space or the end behind it, and at a line's end; a
    long one is several pieces, each counted as a sentence.
    """
    starts, ends, first = spans(low, off, WORD_BYTES)
    of = owner(first)
    n = len(low)
    behind = np.ones(n, dtype=bool)
    if n:
        behind[:-1] = _BLANK[low[1:]] | (low[1:] == 10)
    marks = np.zeros(n + 1, np.int64)
    np.cumsum((low == 10) | (_STOPS[low] & behind), out=marks[1:])
    new = np.ones(len(starts), dtype=bool)
    if len(starts) > 1:
        new[1:] = (of[1:] != of[:-1]) | (marks[starts[1:]] > marks[ends[:-1]])
    hashes, stops = span_hashes(low, starts, ends), np.flatnonzero(new)
    if len(starts) > 1:
        number = np.cumsum(new) - 1
        long = np.bincount(number)[number] > LONG_SENTENCE
        cuts = winnowed(gram_hashes(hashes, 2), first, 2, CUT_WINDOW)
        new[:-1] |= long[:-1] & cuts
    heads = np.flatnonzero(new)
    text = of[heads]
    return starts, hashes, np.append(heads, len(starts)), np.searchsorted(text, np.arange(len(off))), text, stops


def _alike(words: np.ndarray, left: np.ndarray, right: np.ndarray, stops: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each sentence a run whose end depends on no word beyond ``least`` + ``CUT_WINDOW`` + 1 from its start.

    It ends at the first stop from ``least`` words on, or else before the least word pair of the
    next window, which is a cut, since the sentence around it is long.
    """
    grams = gram_hashes(words, 2)
    number = np.flatnonzero(left + least + CUT_WINDOW <= len(grams))
    if not len(number):
        return number, number
    place = left[number] + least
    end = place + np.lib.stride_tricks.sliding_window_view(grams, CUT_WINDOW)[place].argmin(axis=1)
    stop = np.append(stops, len(words))[np.searchsorted(stops, place)]
    end = np.where(stop < place + CUT_WINDOW, stop, end)
    to = np.searchsorted(right, end)
    ok = right[np.minimum(to, len(right) - 1)] == end
    return number[ok], to[ok]


def text_runs(low: np.ndarray, off: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(text, first sentence, last sentence, 64-bit hash, 32-bit hash, repeats one before in its text) per run."""
    starts, words, heads, first, text, stops = sentences(low, off)
    n = len(heads) - 1
    if n <= 0:
        return tuple(np.zeros(0, k) for k in (np.int64, np.int64, np.int64, np.int64, np.int32, bool))
    left, right = heads[:-1], heads[1:]
    number = np.arange(n)
    to = np.searchsorted(right, left + least)
    ok = to < n
    forward = (number[ok], to[ok])
    start = np.searchsorted(left, right - least, side="right") - 1
    ok = start >= 0
    backward = (start[ok], number[ok])
    third = _alike(words, left, right, stops, least)
    a, b = np.concatenate([forward[0], backward[0], third[0]]), np.concatenate([forward[1], backward[1], third[1]])
    same = text[a] == text[b]
    pairs = np.unique(a[same] * n + b[same])
    a, b = pairs // n, pairs % n
    h = span_hashes(words, left[a], right[b]).view(np.int64)
    g = (span_hashes(words, left[a], right[b], _OTHER_BASE) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    of = text[a]
    order = np.lexsort((a, h, of))
    again = np.zeros(len(a), dtype=bool)
    again[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (of[order[1:]] == of[order[:-1]])
    return of, a - first[of], b - first[of], h, g, again


def runs(docs: DataFrame, least: int, shared: np.ndarray | None = None) -> DataFrame:
    """(id, a, b, h, g, again) for every run of every text, or with a filter for those that pass it
    or repeat one before in their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for i, _, data, off in text_parts(batch.column(1)):
                found = text_runs(lowered(data), off, least)
                if shared is not None:
                    kept = passes(shared, found[3]) | found[5]
                    found = tuple(x[kept] for x in found)
                of, a, b, h, g, again = found
                columns = [ids.take(pa.array(of + i)), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(h), pa.array(g), pa.array(again)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "a", "b", "h", "g", "again"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, a int, b int, h bigint, g int, again boolean")


def repeated(docs: DataFrame, least: int) -> DataFrame:
    """(id, parts): per document the sentence ranges to remove."""
    found = runs(docs, least)
    shared = found.groupBy("h", "g").agg(F.min("id").alias("keeper"), F.max("id").alias("last"))
    shared = Stored(shared.filter("keeper < last").select("h", "g", "keeper"), "shared-runs").df
    # Of the runs only those that may be shared are shuffled a second time.
    found = runs(docs, least, fixed_filter(shared, "h", FILTER_BITS))
    later = found.select("id", "a", "b", "h", "g").join(shared, ["h", "g"]).filter("id > keeper").select("id", "a", "b")
    inside = found.filter("again").select("id", "a", "b")
    return later.union(inside).groupBy("id").agg(F.collect_set(F.struct("a", "b")).alias("parts"))


def dedupe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with later occurrences of repeated runs cut from the text, and ``n_sentences``, ``n_removed``.

    Words are compared in lower case and without what stands between them. A text of which all is
    repeated becomes empty. Null and empty texts stay as they are, as do rows of a null id, which
    are not compared. Rows that repeat an id count as one document and are cut alike. Columns of
    ``docs`` keep their places; the two counts come last and replace columns of their names.
    """
    if least_words < 1:
        raise ValueError("least_words must be positive")
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).filter("id is not null and text is not null")
    cuts = Stored(repeated(own, least_words), "cuts").df
    shape = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("n_sentences", "n_removed")]).alias("row")
    rows = docs.select(shape, F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(cuts, "id", "left")
    cut = _without(rows)
    kept = [c for c in docs.columns if c not in ("n_sentences", "n_removed")]
    columns = [F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in kept]
    return cut.select(*columns, "n_sentences", "n_removed")


def _without(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, parts = batch.column("text"), batch.column("parts")
            out = texts.to_pylist()
            n_sentences, n_removed = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for i, j, data, off in text_parts(texts):
                starts, _, heads, first, _, _ = sentences(lowered(data), off)
                n_sentences[i:j] = np.diff(first)
                for k in range(j - i):
                    spans_of = parts[i + k].as_py()
                    if not spans_of:
                        continue
                    count = int(first[k + 1] - first[k])
                    gone = np.zeros(count + 1, np.int64)
                    np.add.at(gone, [p["a"] for p in spans_of], 1)
                    np.add.at(gone, [p["b"] + 1 for p in spans_of], -1)
                    stay = np.cumsum(gone[:-1]) == 0
                    n_removed[i + k] = count - int(stay.sum())
                    edges = np.append(starts[heads[first[k] : first[k + 1]]], off[k + 1])
                    edges[0] = off[k]
                    raw = b"".join(data[edges[s] : edges[s + 1]].tobytes() for s in np.flatnonzero(stay).tolist())
                    out[i + k] = raw.decode()
            columns = [batch.column("row"), pa.array(out, pa.string()), pa.array(n_sentences), pa.array(n_removed)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "text", "n_sentences", "n_removed"])

    kind = rows.schema["row"].dataType.simpleString()
    return rows.select("row", "text", "parts").mapInArrow(run, f"row {kind}, text string, n_sentences bigint, n_removed bigint")
