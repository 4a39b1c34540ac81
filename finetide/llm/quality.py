"""Quality by hierarchical empirical Bayes over documents, paths and hosts.

A document classifier gives each text a probability from its character and word statistics. Sites
are two levels, host and path. Their posterior means come from sums over all documents: a host is
shrunk towards the corpus, a path towards its host, each with a strength estimated from the spread
between the sites of its level (method of moments). A document's log odds are the classifier's plus
its path's shift from the corpus, its own share taken out of the sums first.

Sums are taken before the shuffle, so a host with a third of all rows is one row per task. The
classifier is fitted with numpy on the driver to a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finetide.llm.store import Stored, bounded_sample, held_out, one_each
from finetide.llm.textcodes import INK_BYTES, gram_hashes, lowered, owner, span_hashes, spans, sums, text_parts

#: A document is rejected when its posterior of being good is below this.
THRESHOLD = 0.5
EDGE = 1e-6


def _flags(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


_UPPER, _LOWER, _DIGIT, _HIGH = _flags((65, 90)), _flags((97, 122)), _flags((48, 57)), _flags((128, 255))
_STOP = _flags((46, 46), (33, 33), (63, 63), (44, 44))
_SYMBOL = _flags((35, 38), (42, 43), (47, 47), (60, 62), (64, 64), (91, 96), (123, 126), (33, 33))
_LINE = _flags((10, 10))
FEATURES = 13


def statistics(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` numbers per text; an empty text has zeros."""
    n = len(off) - 1
    count = lambda table: sums(table[data].astype(np.int64), off).astype(float)
    size = np.maximum(np.diff(off), 1).astype(float)
    low = lowered(data)
    starts, ends, first = spans(low, off, INK_BYTES)
    words = np.diff(first).astype(float)
    per = np.maximum(words, 1)
    hashes = span_hashes(low, starts, ends)
    of = owner(first)

    def distinct(values: np.ndarray, of: np.ndarray) -> np.ndarray:
        order = np.lexsort((values, of))
        values, of = values[order], of[order]
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
        return np.bincount(of[new], minlength=n).astype(float)

    again = np.zeros(len(hashes), np.int64)
    if len(hashes) > 1:
        again[1:] = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
    pairs = gram_hashes(hashes, 2)
    inside = of[: len(pairs)] == of[1 : 1 + len(pairs)] if len(pairs) else np.zeros(0, bool)
    pair_share = distinct(pairs[inside], of[: len(pairs)][inside]) / np.maximum(words - 1, 1)
    upper, lower, high = count(_UPPER), count(_LOWER), count(_HIGH)
    long_words = np.bincount(of, weights=(ends - starts > 20), minlength=n) if len(of) else np.zeros(n)
    out = np.stack(
        [
            np.log1p(words), (upper + lower + high) / size, upper / np.maximum(upper + lower, 1), count(_DIGIT) / size,
            count(_SYMBOL) / size, count(_SYMBOL) / per, count(_STOP) / per, count(_LINE) / per, size / per / 10,
            distinct(hashes, of) / per, sums(again, first) / per, pair_share, long_words / per,
        ],
        axis=1,
    )
    return np.where(words[:, None] > 0, out, 0.0)


@dataclass
class Classifier:
    """A logistic model of standardised statistics and their squares."""

    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    bias: float

    def columns(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.spread, -8, 8)
        return np.concatenate([z, z * z / 4], axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.columns(x) @ self.weights + self.bias, -14, 14)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 30, ridge: float = 1.0) -> Classifier:
    """Logistic regression by Newton steps. One class alone, or no row, gives a constant."""
    spread = x.std(axis=0) if len(x) else np.ones(FEATURES)
    model = Classifier(x.mean(axis=0) if len(x) else np.zeros(FEATURES), np.where(spread > 0, spread, 1.0), np.zeros(2 * FEATURES), 0.0)
    share = (y.sum() + 1) / (len(y) + 2)
    model.bias = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return model
    z = np.concatenate([model.columns(x), np.ones((len(x), 1))], axis=1)
    w = np.append(model.weights, model.bias)
    penalty = np.append(np.full(2 * FEATURES, ridge), 1e-6)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + penalty * w
        hessian = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    model.weights, model.bias = w[:-1], float(w[-1])
    return model


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    most_rows: int = 20000,
) -> Classifier:
    """A classifier from at most ``most_rows`` labelled rows that are not held out, chosen by a hash of the id, one of each id."""
    named = labels.filter(~held_out(id_col)).select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label"))
    named = named.filter("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label"))
    named = named.join(bounded_sample(named.select("id"), most_rows), "id")
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = own.join(F.broadcast(named), "id").select("id", "text", F.xxhash64("text").alias("mark"), "label")  # at most most_rows ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(data, off) for _, _, data, off in text_parts(batch.column(1))]
            if found:
                values = pa.array(list(np.concatenate(found)), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), values, batch.column(3)], names=["id", "mark", "x", "label"])

    kind = f"id {rows.schema['id'].dataType.simpleString()}, mark bigint, x array<double>, label double"
    table = one_each(rows.mapInArrow(run, kind), "mark").select("mark", "x", "label").toArrow().to_pandas().sort_values("mark")
    x = np.stack(table["x"].tolist()) if len(table) else np.zeros((0, FEATURES))
    return fit(x, (table["label"].to_numpy() > 0.5).astype(float))


def evidence(docs: DataFrame, model: Classifier, site: list[Column], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, host, path, p) per row: the classifier's probability of good text."""
    host, path = site
    kept = docs.select(
        F.col(id_col).alias("id"), F.coalesce(host.cast("string"), F.lit("")).alias("host"),
        F.coalesce(path.cast("string"), F.lit("")).alias("path"), F.col(text_col).cast("string").alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.zeros(batch.num_rows)
            for i, j, data, off in text_parts(batch.column(3)):
                p[i:j] = np.clip(model.probability(statistics(data, off)), EDGE, 1 - EDGE)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(p)], names=["id", "host", "path", "p"])

    return kept.mapInArrow(run, f"id {kept.schema['id'].dataType.simpleString()}, host string, path string, p double")


def _strength(groups: DataFrame, prior: str) -> float:
    """Pseudo-documents of the prior mean, from how far the groups' means lie from it beyond their noise."""
    noise = F.col(prior) * (1 - F.col(prior))
    row = groups.filter("n > 1").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col(prior), 2)).alias("between"),
        F.sum(noise).alias("noise"), F.sum(F.col("n") * noise).alias("scale"),
    ).first()
    if not row["n"]:
        return 10.0
    variance = max(row["between"] - row["noise"], 0.0) / row["n"]
    return float(min(max(row["scale"] / row["n"] / variance - 1 if variance > 0 else 1e4, 1.0), 1e4))


def posterior(rows: DataFrame) -> DataFrame:
    """``rows`` of :func:`evidence` with ``site_mean`` and ``score``, the posterior probability of good text."""
    paths = Stored(rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s")), "paths").df
    total = paths.agg(F.sum("n"), F.sum("s")).first()
    mean = min(max(total[1] / total[0], EDGE), 1 - EDGE) if total[0] else 0.5
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).withColumn("prior", F.lit(mean))
    of_host = _strength(hosts, "prior")
    hosts = hosts.select("host", F.col("n").alias("host_n"), F.col("s").alias("host_s"), ((F.col("s") + of_host * mean) / (F.col("n") + of_host)).alias("host_mean"))
    sites = Stored(paths.join(hosts, "host"), "sites").df
    of_path = _strength(sites.withColumn("prior", F.col("host_mean")), "prior")
    joined = rows.join(sites.select("host", "path", "n", "s", "host_n", "host_s"), ["host", "path"])
    own_host = (F.col("host_s") - F.col("p") + of_host * mean) / (F.col("host_n") - 1 + of_host)
    own_path = (F.col("s") - F.col("p") + of_path * own_host) / (F.col("n") - 1 + of_path)
    logit = lambda c: F.ln(c / (1 - c))
    bounded = F.least(F.greatest(own_path, F.lit(EDGE)), F.lit(1 - EDGE))
    odds = logit(F.col("p")) + logit(F.col("site_mean")) - float(np.log(mean / (1 - mean)))
    return joined.withColumn("site_mean", bounded).withColumn("score", 1 / (1 + F.exp(-odds))).select("id", "host", "path", "p", "site_mean", "score")


def default_site() -> list[Column]:
    """Host: the source up to its first slash. Path: the whole source and the language section in it."""
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    return [F.substring_index(source, "/", 1), F.concat_ws("/", source, F.col("lang").cast("string"))]


def classify(
    docs: DataFrame, labels: DataFrame, site: list[Column] | None = None, id_col: str = "doc_id", text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(id, doc_score, site_mean, score, accepted) per row.

    A null text reads as empty, a null source or language as an empty site name. Repeated rows and
    null ids get a row each. Without labels the classifier is constant. An empty table gives an
    empty one. Exact ties with the threshold are accepted.
    """
    model = train(docs, labels, id_col, text_col)
    rows = Stored(evidence(docs, model, site or default_site(), id_col, text_col), "evidence").df
    out = posterior(rows)
    return out.select(F.col("id").alias(id_col), F.col("p").alias("doc_score"), "site_mean", "score", (F.col("score") >= threshold).alias("accepted"))


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is not rejected; a row of a null id stays. Columns stay as they are."""
    found = classify(docs, labels, id_col=id_col, text_col=text_col).filter("not accepted")
    bad = Stored(found.select(id_col).filter(F.col(id_col).isNotNull()).distinct(), "rejected").df
    return docs.join(bad, id_col, "left_anti").select(*docs.columns)
