"""Toxicity from confirmed toxic examples and unlabelled text (non-negative PU learning).

A text is the set of its words, hashed. A linear scorer is trained with numpy on the driver:
the risk of calling unlabelled text clean, less the part that the class prior ascribes to toxic
text, is kept from falling below zero, so that the scorer cannot profit from its own memory.
The training rows are a bounded sample (``most_positive``, ``most_unlabelled``); near copies in
it count once. Scoring is one pass over the whole texts and moves none of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finetide.llm.store import bounded_sample, held_out, one_each
from finetide.llm.textcodes import U64, WORD_BYTES, gram_hashes, lowered, owner, span_hashes, spans, text_parts

FEATURE_BITS = 20
THRESHOLD = 0.7
#: A word is a feature when it sits in this many toxic texts and stands out by so many deviations.
LEAST_TEXTS, LEAST_DEVIATIONS = 3, 4.0


@dataclass
class Scorer:
    slots: np.ndarray
    weights: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        dense = np.zeros(1 << FEATURE_BITS)
        dense[self.slots] = self.weights
        return dense


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's distinct feature numbers with the text's number, and the least hash of its word triples."""
    low = lowered(data)
    starts, ends, first = spans(low, off, WORD_BYTES)
    hashes = span_hashes(low, starts, ends)
    of = owner(first)
    pairs = np.unique(of.astype(U64) << U64(FEATURE_BITS) | hashes & U64((1 << FEATURE_BITS) - 1))
    sketch = np.full(len(off) - 1, np.iinfo(np.uint64).max, dtype=U64)
    grams = gram_hashes(hashes, 3)
    if len(grams):
        inside = of[: len(grams)] == of[2 : 2 + len(grams)]
        np.minimum.at(sketch, of[: len(grams)][inside], grams[inside])
    if len(hashes):  # texts under three words
        single = np.diff(first) < 3
        small = single[of]
        np.minimum.at(sketch, of[small], hashes[small])
    return (pairs & U64((1 << FEATURE_BITS) - 1)).astype(np.int64), (pairs >> U64(FEATURE_BITS)).astype(np.int64), sketch


def _featured(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, sketches = [], []
            for _, _, data, off in text_parts(batch.column(1)):
                slots, of, sketch = features(data, off)
                edges = np.searchsorted(of, np.arange(len(off)))
                lists += [slots[a:b].astype(np.int32) for a, b in zip(edges, edges[1:], strict=False)]
                sketches.append(sketch.view(np.int64))
            if lists:
                columns = [batch.column(0), pa.array(lists, pa.list_(pa.int32())), pa.array(np.concatenate(sketches))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "slots", "sketch"])

    kind = texts.schema["id"].dataType.simpleString()
    return texts.select("id", "text").mapInArrow(run, f"id {kind}, slots array<int>, sketch bigint")


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    most_positive: int = 8000, most_unlabelled: int = 16000,
) -> Scorer:
    """A scorer from rows that are not held out.

    At most ``most_positive`` texts labelled toxic and ``most_unlabelled`` texts of any kind are
    used, chosen by a hash of the id, one of each id. The class prior is the toxic share of the labels. Without
    a toxic text the scorer gives every text the score 0.
    """
    named = labels.filter(~held_out(id_col)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    named = named.filter("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label"))
    prior = named.agg(F.avg("label")).first()[0] or 0.0
    own = docs.filter(~held_out(id_col)).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    own = own.filter("id is not null and text is not null")
    groups = []
    for ids, most in ((named.filter("label = 1").select("id"), most_positive), (own.select("id"), most_unlabelled)):
        picked = own.join(F.broadcast(bounded_sample(ids, most)), "id")  # at most ``most`` ids
        rows = one_each(_featured(picked), "sketch").toArrow().to_pandas().sort_values("sketch").drop_duplicates("sketch")
        groups.append([np.asarray(x, np.int64) for x in rows["slots"]])
    positive, unlabelled = groups
    if not positive or not 0 < prior < 1:
        return Scorer(np.zeros(0, np.int64), np.zeros(0), -np.inf)
    return fit(positive, unlabelled, prior)


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, rounds: int = 400) -> Scorer:
    """The linear scorer of least non-negative risk, by gradient steps with momentum."""
    size = 1 << FEATURE_BITS
    in_p = np.bincount(np.concatenate(positive), minlength=size)
    in_u = np.bincount(np.concatenate(unlabelled), minlength=size) if unlabelled else np.zeros(size)
    n_p, n_u = len(positive), max(1, len(unlabelled))
    share = (in_p + in_u + 1) / (n_p + n_u + 2)
    deviation = np.sqrt(share * (1 - share) * (1 / n_p + 1 / n_u))
    stands_out = (in_p / n_p - in_u / n_u) / deviation
    slots = np.flatnonzero((in_p >= LEAST_TEXTS) & (stands_out >= LEAST_DEVIATIONS))
    number = np.full(size, -1, np.int64)
    number[slots] = np.arange(len(slots))

    def flat(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        columns = number[np.concatenate(texts)] if texts else np.zeros(0, np.int64)
        rows = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        return rows[columns >= 0], columns[columns >= 0]

    (rows_p, cols_p), (rows_u, cols_u) = flat(positive), flat(unlabelled)
    weights, bias = np.zeros(len(slots)), float(np.log(prior / (1 - prior)))
    speed = np.zeros(len(slots) + 1)
    scale = np.zeros(len(slots) + 1)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for step in range(1, rounds + 1):
        z_p = bias + np.bincount(rows_p, weights=weights[cols_p], minlength=n_p)
        z_u = bias + np.bincount(rows_u, weights=weights[cols_u], minlength=len(unlabelled))
        # Logistic losses: of a toxic text called clean, and of either side called toxic.
        clean_risk = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean() if len(unlabelled) else 0.0
        g_p = prior * (sigmoid(z_p) - 1) / n_p
        d_p, d_u = -prior * sigmoid(z_p) / n_p, sigmoid(z_u) / n_u
        if clean_risk < 0:
            d_p, d_u = -d_p, -d_u
            g_p = np.zeros_like(g_p)
        left, right = g_p + d_p, d_u
        gradient = np.append(
            np.bincount(cols_p, weights=left[rows_p], minlength=len(slots)) + np.bincount(cols_u, weights=right[rows_u], minlength=len(slots)),
            left.sum() + right.sum(),
        )
        gradient[:-1] += 1e-5 * weights
        speed = 0.9 * speed + 0.1 * gradient
        scale = 0.99 * scale + 0.01 * gradient**2
        move = 0.05 * speed / (1 - 0.9**step) / (np.sqrt(scale / (1 - 0.99**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - float(move[-1])
    return Scorer(slots, weights, bias)


def score(docs: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) per row, 0 to 1. Null and empty texts hold no word and get the scorer's base score.

    Repeated rows and null ids get a row each; an empty table gives an empty one.
    """
    kept = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = scorer.table()
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for i, j, data, off in text_parts(batch.column(1)):
                low = lowered(data)
                starts, ends, first = spans(low, off, WORD_BYTES)
                slots = (span_hashes(low, starts, ends) & U64((1 << FEATURE_BITS) - 1)).astype(np.int64)
                hit = np.flatnonzero(weights[slots])
                pairs = np.unique(owner(first)[hit] << FEATURE_BITS | slots[hit])
                total = np.bincount(pairs >> FEATURE_BITS, weights=weights[pairs & ((1 << FEATURE_BITS) - 1)], minlength=j - i)
                out[i:j] = total
            z = np.clip(out + scorer.bias, -700, 700)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-z)))], names=["id", "score"])

    return kept.mapInArrow(run, f"id {kept.schema['id'].dataType.simpleString()}, score double").withColumnRenamed("id", id_col)
