"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of a lexicon (words and word beginnings), second-person words and
their nearness to lexicon words, capitals, punctuation, and obfuscated spellings. The lexicon is learned
from labels too: terms far more frequent among toxic than among other documents.

Learning reads a bounded sample of about ``SAMPLE`` labelled documents outside fold 0, by hash of the id.
Folds 1 and 2 give the lexicon, 3 the trees and 4 the calibration, so that no stage learns from what the
one before it has seen. Every document is scored in one pass without a shuffle.

Defined results: null text is empty; an empty text gets the score of all-zero features; without labels
of both kinds every score is the share of toxic labels (0 without any); several labels of one id count
as toxic if one is; labels without a document, and null labels, teach nothing; repeated rows give
repeated rows; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_sample, fold, map_arrow, pieces, store, table

SAMPLE, TERMS, PREFIXES = 12_000, 400, (4, 5, 6)
TREES, DEPTH, BINS, RATE = 60, 3, 32, 0.15
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Fixed list: second-person words of the languages in the corpus.
SECOND = frozenset("you your yours yourself u ur du dich dir dein deine euch ihr sie tu toi te ton ta tes vous votre "
                   "vos tú ti tus usted ustedes vosotros vuestro".split())
EDGE = ".,;:!?\"'()[]{}*#%&$|<>-"
PLAIN = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i",
                       "*": None, ".": None, "-": None, "_": None})
MIXED = re.compile(r"[^\W\d_][\d@$*_!.\-]+[^\W\d_]")
FEATURES = 18


def words_of(text: str) -> list[str]:
    return [w.strip(EDGE) for w in WORD.findall(text.lower())]


def terms_of(word: str) -> list[str]:
    """A word as a term, and its beginnings (marked by an asterisk)."""
    return [word, *[word[:n] + "*" for n in PREFIXES if len(word) > n]]


def features(text: str, lexicon: dict[str, float]) -> list[float]:
    n_chars = max(1, len(text))
    raw = WORD.findall(text.lower())
    n = max(1, len(raw))
    clean = [w.strip(EDGE) for w in raw]
    distinct = Counter(clean)
    weight = {}
    whole = begin = hidden = 0
    for w, k in distinct.items():
        best = lexicon.get(w, 0.0)
        if best:
            whole += k
        for p in PREFIXES:
            if len(w) > p:
                got = lexicon.get(w[:p] + "*", 0.0)
                if got:
                    best = max(best, got)
        if best:
            begin += k
            weight[w] = best
        elif not w.isalpha() and any(c.isalpha() for c in w):
            plain = w.translate(PLAIN)
            got = max([lexicon.get(plain, 0.0), *[lexicon.get(plain[:p] + "*", 0.0) for p in PREFIXES]])
            if got:
                hidden += k
                weight[w] = got
    second = sum(distinct.get(w, 0) for w in SECOND)
    near = 0
    if weight and second:
        hits = [i for i, w in enumerate(clean) if w in weight]
        near = sum(any(w in SECOND for w in clean[max(0, i - 4):i + 5]) for i in hits)
    hits = sum(distinct[w] for w in weight)
    upper = sum(map(str.isupper, text)) if not text.islower() else 0
    marks = text.count("!")
    return [hits / n, np.log1p(hits), whole / n, begin / n, hidden / n, float(len(weight)), max(weight.values(), default=0.0),
            sum(v * distinct[w] for w, v in weight.items()), second / n, near / n, float(near), upper / n_chars,
            marks / n_chars, text.count("?") / n_chars, sum(text.count(c) for c in ".,;:'\"") / n_chars,
            sum(1 for w in distinct if MIXED.search(w)) / n, np.log1p(n), n_chars / n]


class Boosted:
    """Logistic gradient boosting over binned features; trees of fixed depth as arrays."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        cuts = np.linspace(0, 1, BINS + 1)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, f], cuts)) for f in range(x.shape[1])]
        b = self.binned(x)
        p = np.clip(y.mean(), 1e-4, 1 - 1e-4)
        self.start, self.trees = float(np.log(p / (1 - p))), []
        score = np.full(len(y), self.start)
        for _ in range(TREES):
            prob = 1 / (1 + np.exp(-score))
            tree = self.grow(b, y - prob, prob * (1 - prob))
            self.trees.append(tree)
            score += self.walk(b, tree)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(self.edges)], 1)

    def grow(self, b: np.ndarray, g: np.ndarray, h: np.ndarray):
        size = 2 ** (DEPTH + 1) - 1
        feature, cut, value = np.full(size, -1), np.zeros(size, int), np.zeros(size)
        node = np.zeros(len(b), int)
        for k in range(size):
            mine = node == k
            if not mine.any():
                continue
            value[k] = RATE * g[mine].sum() / (h[mine].sum() + 1.0)
            if 2 * k + 2 >= size:
                continue
            total_g, total_h, best = g[mine].sum(), h[mine].sum(), 1e-3
            for f in range(b.shape[1]):
                gs = np.cumsum(np.bincount(b[mine, f], g[mine], BINS + 1))[:-1]
                hs = np.cumsum(np.bincount(b[mine, f], h[mine], BINS + 1))[:-1]
                gain = gs ** 2 / (hs + 1) + (total_g - gs) ** 2 / (total_h - hs + 1) - total_g ** 2 / (total_h + 1)
                gain[(hs < 0.5) | (total_h - hs < 0.5)] = 0
                if gain.max() > best:
                    best, feature[k], cut[k] = gain.max(), f, int(gain.argmax())
            if feature[k] >= 0:
                node[mine] = np.where(b[mine, feature[k]] <= cut[k], 2 * k + 1, 2 * k + 2)
        return feature, cut, value

    @staticmethod
    def walk(b: np.ndarray, tree) -> np.ndarray:
        feature, cut, value = tree
        node = np.zeros(len(b), int)
        for _ in range(DEPTH):
            f = feature[node]
            down = np.where(b[np.arange(len(b)), np.maximum(f, 0)] <= cut[node], 2 * node + 1, 2 * node + 2)
            node = np.where(f >= 0, down, node)
        return value[node]

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.binned(x)
        return self.start + sum(self.walk(b, t) for t in self.trees)


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: steps (score, probability), smoothed by half a label on either side."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []
    for s, v in zip(score[order], y[order]):
        blocks.append([s, v, 1.0])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            _, v2, n2 = blocks.pop()
            blocks[-1][1] += v2
            blocks[-1][2] += n2
    return np.array([b[0] for b in blocks]), np.array([(b[1] + 0.25) / (b[2] + 0.5) for b in blocks])


class Model:
    def __init__(self, lexicon, trees, steps, share):
        self.lexicon, self.trees, self.steps, self.share = lexicon, trees, steps, share

    def score(self, texts: list[str]) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.share)
        x = np.array([features(t, self.lexicon) for t in texts]).reshape(len(texts), FEATURES)
        raw = self.trees.score(x)
        if self.steps is None:
            return 1 / (1 + np.exp(-raw))
        return np.interp(raw, *self.steps)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    spark = docs.sparkSession
    known = (labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").alias("id"))
             .agg(F.max("toxic").cast("int").alias("toxic")).filter(fold("id") != 0))
    known = store(spark, bounded_sample(known, sample, "id"), "toxic-labels")  # 2 * sample rows at most
    rows = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("id"))
    rows = store(spark, rows.select(F.coalesce("text", F.lit("")).alias("text"), "toxic", fold("id").alias("fold")), "toxic-texts")
    count = {(bool(r["toxic"]), r["early"]): r["count"] for r in rows.groupBy("toxic", (F.col("fold") <= 2).alias("early")).count().collect()}
    n = {t: sum(v for (k, _), v in count.items() if k == t) for t in (True, False)}
    share = n[True] / max(1, sum(n.values()))
    if not n[True] or not n[False]:
        return Model({}, None, None, share)

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            seen: dict[bool, Counter] = {True: Counter(), False: Counter()}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[bool(toxic)].update({t for w in set(words_of(text)) if w for t in terms_of(w)})
            every = list(seen[True])  # terms of toxic texts; others cannot enter the lexicon
            yield pa.RecordBatch.from_arrays([pa.array(every, pa.string()), pa.array([seen[True][t] for t in every], pa.int64())], names=["term", "n"])

    early = rows.filter("fold <= 2").select("text", "toxic")
    toxic_terms = (map_arrow(early.filter("toxic != 0"), terms, "term string, n long").groupBy("term").agg(F.sum("n").alias("t"))
                   .filter(F.col("t") >= max(2, round(0.004 * count.get((True, True), 0)))))
    toxic_terms = {r["term"]: r["t"] for r in toxic_terms.orderBy(F.desc("t"), "term").limit(20_000).collect()}

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            seen: Counter = Counter()
            for text in batch.column(0).to_pylist():
                seen.update({t for w in set(words_of(text)) if w for t in terms_of(w) if t in toxic_terms})
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["term", "n"])

    clean = {r["term"]: r["n"] for r in map_arrow(early.filter("toxic = 0").select("text"), others, "term string, n long")
             .groupBy("term").agg(F.sum("n").alias("n")).collect()}
    n_t, n_c = count.get((True, True), 0) + 1, count.get((False, True), 0) + 1
    odds = {t: float(np.log((k + 0.5) / n_t) - np.log((clean.get(t, 0) + 0.5) / n_c)) for t, k in toxic_terms.items()}
    best = sorted((t for t in odds if odds[t] > 2.0), key=lambda t: (-odds[t] * toxic_terms[t], t))[:TERMS]
    lexicon = {t: odds[t] for t in best}

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            x = [features(t, lexicon) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1), batch.column(2)], names=["x", "toxic", "fold"])

    late = map_arrow(rows.filter("fold > 2").select("text", "toxic", "fold"), dense, "x array<double>, toxic int, fold long").collect()
    late = sorted((r["fold"], r["toxic"], r["x"]) for r in late)
    x, y, f = np.array([r[2] for r in late]).reshape(len(late), FEATURES), np.array([bool(r[1]) for r in late], float), np.array([r[0] for r in late])
    if not (0 < y[f == 3].sum() < (f == 3).sum()):
        return Model(lexicon, None, None, share)
    trees = Boosted(x[f == 3], y[f == 3])
    held = y[f == 4]
    steps = isotonic(trees.score(x[f == 4]), held) if 0 < held.sum() < len(held) else None
    return Model(lexicon, trees, steps, share)


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            score = np.clip(model.score([t or "" for t in batch.column(1).to_pylist()]), 0, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], names=["doc_id", "score"])

    return map_arrow(docs.selectExpr("cast(doc_id as long) doc_id", "text"), run, "doc_id long, score double")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
