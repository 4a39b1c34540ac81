"""The trained operators against plain Python: Kneser-Ney costs, the non-negative risk, posteriors."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from finetide.llm import language_id, quality, toxicity
from finetide.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def folded(text):
    """Letters in lower case, one space for what stands between them, in UTF-16 units after three spaces."""
    out = []
    for c in text:
        if ord(c) > 0xFFFF:
            pair = c.encode("utf-16-le")
            out += [chr(int.from_bytes(pair[k : k + 2], "little")) for k in (0, 2)]
        elif c.isalpha():
            out.append(c.lower() if len(c.lower()) == 1 else c)
        elif out and out[-1] != " ":
            out.append(" ")
    return "   " + "".join(out)


def grams(text):
    line = folded(text)
    return [line[k - 3 : k + 1] for k in range(3, len(line))]


class PlainKneserNey:
    def __init__(self, texts):
        counts = Counter(g for t in texts for g in grams(t))
        self.levels = []
        for n in (4, 3, 2, 1):
            values = Counter(counts.values())
            discount = values[1] / (values[1] + 2 * values[2]) if values[1] and values[2] else 0.5
            total, kinds = Counter(), Counter()
            for g, c in counts.items():
                total[g[:-1]] += c
                kinds[g[:-1]] += 1
            self.levels.append((n, dict(counts), discount, total, kinds))
            self.least = 1 / (len(counts) + 1)
            counts = Counter(g[1:] for g in counts)
        self.levels.reverse()
        self.known = {}

    def log_prob(self, gram):
        if gram not in self.known:
            p = self.least
            for n, counts, discount, total, kinds in self.levels:
                own, before = gram[4 - n :], gram[4 - n : 3]
                if total[before]:
                    p = max(counts.get(own, 0) - discount, 0) / total[before] + discount * kinds[before] / total[before] * p
            self.known[gram] = math.log(p)
        return self.known[gram]


def test_language_costs(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang")
    odd = [(-1, "Straße ÉCOLE 漢字 😀 12 qxqzj", None), (-2, "  , leading and trailing!  ", "en"), (-3, "İstanbul ẞ", None)]
    docs = docs.union(spark.createDataFrame(odd, docs.schema))
    rows = {r["doc_id"]: r for r in docs.collect()}
    texts = defaultdict(list)
    for i, r in rows.items():
        if zlib.crc32(str(i).encode()) % 3 != 1 and r["text"] is not None and r["lang"] is not None:
            texts[r["lang"]].append(r["text"])
    plain = {lang: PlainKneserNey(own) for lang, own in texts.items()}
    found = {r["doc_id"]: r for r in language_id.predict(docs, language_id.train(docs)).collect()}
    assert found.keys() == rows.keys()
    for i, r in rows.items():
        if not any(c.isalpha() for c in r["text"] or ""):
            assert found[i]["lang_pred"] == "und"
            continue
        own = grams(r["text"])
        costs = {lang: -sum(map(model.log_prob, own)) / len(own) for lang, model in plain.items()}
        assert found[i]["cost"] == pytest.approx(min(costs.values()), rel=1e-5)
        assert costs[found[i]["lang_pred"]] == pytest.approx(min(costs.values()), rel=1e-5)


def test_language_by_table_with_one_frequent_pair(spark, monkeypatch):
    """Nearly every run has the same middle pair; chunks and slices are small."""
    monkeypatch.setattr(language_id, "SLICE_ROWS", 200)
    monkeypatch.setattr(language_id, "CHUNK_BYTES", 3000)
    draw = np.random.default_rng(3)
    letters = {"one": "cdefghijk", "two": "hijklmnop"}
    rows = []
    for i in range(240):
        lang = "one" if i % 2 else "two"
        rows.append((i, "".join(f"{a}ab{b}" for a, b in zip(draw.choice(list(letters[lang]), 60), draw.choice(list(letters[lang]), 60), strict=True)), lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)
    held, spread = language_id.train(docs), language_id.train(docs, held_runs=1)
    assert isinstance(spread, language_id.SpreadModels)
    want, got = ({r["doc_id"]: r for r in language_id.predict(docs, m).collect()} for m in (held, spread))
    assert len(got) == 240
    for i, _, lang in rows:
        assert got[i]["lang_pred"] == want[i]["lang_pred"] == lang
        assert got[i]["cost"] == pytest.approx(want[i]["cost"], rel=1e-5)


def plain_objective(x_p, x_u, prior, w):
    """(what a step goes down on, the clean risk) for weights with the bias last."""
    z_p, z_u = x_p @ w[:-1] + w[-1], x_u @ w[:-1] + w[-1]
    clean = np.log1p(np.exp(z_u)).mean() - prior * np.log1p(np.exp(z_p)).mean()
    if clean < 0:
        return -clean + 5e-6 * (w[:-1] ** 2).sum(), clean
    return prior * np.log1p(np.exp(-z_p)).mean() + clean + 5e-6 * (w[:-1] ** 2).sum(), clean


@pytest.mark.parametrize(("prior", "rounds"), [(0.01, 40), (0.1, 40), (0.6, 120)])
def test_non_negative_risk(prior, rounds):
    """Each step follows the numeric gradient of the risk; but for the least prior the clean risk falls below zero at times."""
    draw = np.random.default_rng(5)
    shares = np.array([0.7, 0.6, 0.5, 0.4])
    positive = [np.flatnonzero(draw.random(4) < shares).astype(np.int64) for _ in range(60)]
    unlabelled = [np.flatnonzero(draw.random(4) < shares * 0.08).astype(np.int64) for _ in range(200)]
    dense = lambda texts: np.stack([np.isin(np.arange(4), t) for t in texts]).astype(float)
    x_p, x_u = dense(positive), dense(unlabelled)
    w = np.append(np.zeros(4), math.log(prior / (1 - prior)))
    speed, scale, below = np.zeros(5), np.zeros(5), 0
    for step in range(1, rounds + 1):
        below += plain_objective(x_p, x_u, prior, w)[1] < 0
        negative = plain_objective(x_p, x_u, prior, w)[1] < 0
        gradient = np.zeros(5)
        for k in range(5):
            move = np.zeros(5)
            move[k] = 1e-6
            up, down = (plain_objective(x_p, x_u, prior, w + s * move) for s in (1, -1))
            assert (up[1] < 0) == (down[1] < 0) == negative
            gradient[k] = (up[0] - down[0]) / 2e-6
        speed, scale = 0.9 * speed + 0.1 * gradient, 0.99 * scale + 0.01 * gradient**2
        w = w - 0.05 * speed / (1 - 0.9**step) / (np.sqrt(scale / (1 - 0.99**step)) + 1e-8)
    scorer = toxicity.fit(positive, unlabelled, prior, rounds)
    assert scorer.slots.tolist() == [0, 1, 2, 3]
    assert np.append(scorer.weights, scorer.bias) == pytest.approx(w, abs=1e-3)
    assert (below > 0) == (prior > 0.01)


def test_toxicity_scores(spark):
    """A score is the sigmoid of the bias and the weights of a text's different words."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    scorer = toxicity.train(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    weight = dict(zip(scorer.slots.tolist(), scorer.weights.tolist(), strict=True))
    slots = {}

    def slot(word):
        if word not in slots:
            data = np.frombuffer(word, np.uint8)
            slots[word] = int(toxicity.features(data, np.array([0, len(data)]))[0][0])
        return slots[word]

    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, scorer).collect()}
    for r in docs.collect():
        words = set(re.findall(rb"[0-9a-z\x80-\xff]+", (r["text"] or "").encode().lower()))
        z = scorer.bias + sum(weight.get(s, 0.0) for s in {slot(w) for w in words})
        assert got[r["doc_id"]] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)


def plain_strength(groups):
    """Groups of (n, sum, prior) to the pseudo-documents of their priors."""
    groups = [(n, s, m) for n, s, m in groups if n > 1]
    total = sum(n for n, _, _ in groups)
    if not total:
        return 10.0
    between = sum(n * (s / n - m) ** 2 for n, s, m in groups)
    variance = max(between - sum(m * (1 - m) for _, _, m in groups), 0.0) / total
    if variance <= 0:
        return 1e4
    return min(max(sum(n * m * (1 - m) for n, _, m in groups) / total / variance - 1, 1.0), 1e4)


def test_quality_posteriors(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    name = next(n for n in QUERIES if n.startswith("op9_"))
    found = {r["doc_id"]: r for r in QUERIES[name](spark, DATA).collect()}
    site = {}
    for i, r in docs.items():
        source = r["source"] or ""
        site[i] = (source.split("/")[0], "/".join([source, *([r["lang"]] if r["lang"] is not None else [])]))
    host, path = defaultdict(lambda: [0, 0.0]), defaultdict(lambda: [0, 0.0])
    for i, r in found.items():
        for table, key in ((host, site[i][0]), (path, site[i])):
            table[key][0] += 1
            table[key][1] += r["doc_score"]
    mean = sum(r["doc_score"] for r in found.values()) / len(found)
    of_host = plain_strength([(n, s, mean) for n, s in host.values()])
    host_mean = {h: (s + of_host * mean) / (n + of_host) for h, (n, s) in host.items()}
    of_path = plain_strength([(n, s, host_mean[p[0]]) for p, (n, s) in path.items()])
    logit = lambda p: math.log(p / (1 - p))
    for i, r in found.items():
        (n, s), (host_n, host_s), p = path[site[i]], host[site[i][0]], r["doc_score"]
        own_host = (host_s - p + of_host * mean) / (host_n - 1 + of_host)
        own = min(max((s - p + of_path * own_host) / (n - 1 + of_path), quality.EDGE), 1 - quality.EDGE)
        assert r["site_mean"] == pytest.approx(own, rel=1e-6)
        score = 1 / (1 + math.exp(-(logit(p) + logit(own) - logit(mean))))
        assert r["score"] == pytest.approx(score, rel=1e-5, abs=1e-9) and r["accepted"] == (r["score"] >= quality.THRESHOLD)


def test_quality_classifier_is_the_best_of_its_penalty():
    """The fitted weights leave no gradient of the penalised likelihood."""
    draw = np.random.default_rng(2)
    x = draw.normal(size=(400, quality.FEATURES))
    y = (x[:, 0] - x[:, 3] + draw.normal(size=400) > 0).astype(float)
    model = quality.fit(x, y)
    columns, p = model.columns(x), model.probability(x)
    assert columns.T @ (p - y) + model.weights == pytest.approx(0, abs=1e-4) and (p - y).sum() == pytest.approx(0, abs=1e-3)
