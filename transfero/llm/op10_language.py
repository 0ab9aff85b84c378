"""Language identification by string kernels: Nystroem landmarks and one-versus-rest kernel ridge regression.

A text is cut into blocks of ``BLOCK`` characters; a block is the set of its n-grams of 1 to 4
characters (lower case, everything but letters as one space), hashed to ``DIMS`` places. The kernel of
two blocks is the number of n-grams present in both over the geometric mean of their counts. Ridge
regression in the Nystroem space of ``LANDMARKS`` blocks gives one score per language. The kernel is
linear in the presence vectors, so landmarks and coefficients fold into one matrix, and scoring is
presence matrix times that matrix, batch by batch over all blocks of the whole text; a text's score is
the mean over its blocks, weighted by their letters.

Fitting uses a bounded sample of labelled rows: ``SAMPLE`` documents in all, equally many per language but
``LEAST`` of each, at most three blocks each. Every language is learned and every document is scored.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every text if
nothing was learned; ties go to the language first in code-point order; repeated rows give repeated
rows; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fold, map_arrow, pieces, store, table

BLOCK, DIMS, ORDERS = 2000, 1 << 14, 4
LANDMARKS, SAMPLE, LEAST, RIDGE = 200, 1500, 8, 1e-2
UNKNOWN = "und"


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def presence(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Presence matrix of all blocks of ``texts``, each block's text index, and its number of letters."""
    codes = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    lengths = np.array([len(c) for c in codes], np.int64)
    flat = np.concatenate(codes) if len(codes) else np.empty(0, np.uint32)
    blocks = -(-lengths // BLOCK)
    first_block = np.cumsum(blocks) - blocks
    owner = np.repeat(np.arange(len(texts)), blocks)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    block = np.repeat(first_block, lengths) + at // BLOCK
    left = np.repeat(lengths, lengths) - at  # characters up to the end of the text
    alpha = _letters()[flat]
    letters = np.bincount(block, alpha, len(owner))
    flat = np.where(alpha, flat, 32).astype(np.uint64)
    matrix = np.zeros((len(owner), DIMS), np.float32)
    h = np.zeros(len(flat), np.uint64)
    for n in range(1, ORDERS + 1):
        h = h[: len(flat) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + flat[n - 1:] + np.uint64(n)
        ok = left[: len(h)] >= n
        place = ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - 14)
        matrix[block[: len(h)][ok], place[ok].astype(np.int64)] = 1
    return matrix, owner, letters


def _groups(texts: list[str], blocks: int = 512) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``blocks`` blocks, so that the presence matrix stays small."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += -(-len(t) // BLOCK)
        if held >= blocks:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _normal(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.sqrt(np.maximum(matrix.sum(1, keepdims=True), 1))


def fit(docs: DataFrame, sample: int = SAMPLE, least: int = LEAST) -> tuple[list[str], np.ndarray]:
    """(languages, matrix DIMS x languages) learned from rows of ``docs`` outside fold 0.

    Every language of these rows is learned, from ``sample`` rows divided by the number of languages, but ``least``
    rows of each (all, if it has fewer): the rows with the smallest hashes among about twice as many.
    """
    rows = docs.filter((fold() != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    h, full = F.xxhash64("doc_id", "text"), float(1 << 64)
    counts = rows.groupBy(F.col("lang").alias("_lang")).agg(F.count(F.lit(1)).alias("_n"), F.min(h).alias("_least"))
    counts = store(docs.sparkSession, counts, "language-counts")
    n_langs = counts.count()
    if not n_langs:
        return [], np.zeros((DIMS, 0), np.float32)
    each = max(least, sample // n_langs)
    # the share of the hash range that 2 * each rows of the language fill; all of it for languages that are not larger
    limit = F.when(F.col("_n") <= 2 * each, F.lit((1 << 63) - 1)).otherwise((F.lit(-(1 << 63)) + F.lit(2 * each * full) / F.col("_n")).cast("long"))
    limit = F.greatest(limit, F.col("_least"))  # at least one row of each, however many copies the others are
    near = rows.select("lang", "doc_id", "text", h.alias("h")).join(counts.select("_lang", limit.alias("limit")), F.col("lang") == F.col("_lang")).filter("h <= limit").dropDuplicates(["lang", "h"])
    first = near.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id", "text"))).filter(F.col("r") <= each)
    # three blocks spread over the text; shorter texts give what they have
    spread = F.expr(f"transform(array(0.0, 0.5, 1.0), x -> substring(text, cast(1 + x * greatest(length(text) - {BLOCK}, 0) as int), {BLOCK}))")
    chosen = first.select("lang", "doc_id", F.explode(F.array_distinct(spread)).alias("block"))
    got = sorted((r["lang"], -1 if r["doc_id"] is None else r["doc_id"], r["block"]) for r in chosen.collect())
    got = [g for g in got if any(map(str.isalpha, g[2]))]
    if not got:
        return [], np.zeros((DIMS, 0), np.float32)
    langs = sorted({g[0] for g in got})
    x = np.concatenate([_normal(presence([g[2][:BLOCK] for g in got[i:i + 256]])[0]) for i in range(0, len(got), 256)])
    y = np.array([[g[0] == lang for lang in langs] for g in got], np.float64)
    rng = np.random.default_rng(7)
    marks = np.sort(np.concatenate([rng.permutation(np.flatnonzero(y[:, c]))[: max(1, LANDMARKS // len(langs))] for c in range(len(langs))]))
    z = x[marks]
    values, vectors = np.linalg.eigh((z @ z.T).astype(np.float64))
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
    phi = (x @ z.T).astype(np.float64) @ root
    weight = (1 / np.maximum(y.sum(0), 1))[y.argmax(1)][:, None]  # languages count alike
    weight *= len(x) / weight.sum()
    beta = np.linalg.solve(phi.T @ (phi * weight) + RIDGE * len(x) * np.eye(len(marks)) / len(langs), phi.T @ (y * weight))
    return langs, (z.T.astype(np.float64) @ root @ beta).astype(np.float32)


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray] | None = None) -> DataFrame:
    """All columns of ``docs`` (doc_id, text, ...) and ``lang_pred, score``; the model is fitted if not given."""
    langs, matrix = model or fit(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            texts = [t or "" for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            total = np.zeros((len(texts), max(1, len(langs))))
            letters = np.zeros(len(texts))
            for lo, hi in _groups(texts):
                p, owner, n = presence(texts[lo:hi])
                if len(langs) and len(p):
                    s = (p @ matrix) / np.sqrt(np.maximum(p.sum(1, keepdims=True), 1)) * n[:, None]
                    np.add.at(total, owner + lo, s)
                np.add.at(letters, owner + lo, n)
            mean = total / np.maximum(letters, 1)[:, None]
            best = mean.argmax(1)
            known = (letters > 0) & (len(langs) > 0)
            score = np.where(known, np.clip(mean.max(1), 0, 1), 0.0)
            pred = [langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                             names=[*batch.schema.names, "lang_pred", "score"])

    from pyspark.sql.types import DoubleType, StringType, StructField, StructType
    schema = StructType([*[StructField(f.name, f.dataType, True) for f in docs.schema.fields],
                         StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return map_arrow(docs, run, schema)


def known_language(docs: DataFrame, min_score: float = 0.1) -> DataFrame:
    """Rows of ``docs``, columns unchanged, whose language is known: not ``und`` and scored ``min_score`` or more.

    Columns of ``docs`` travel under numbered names, so a ``lang_pred`` of the input does not clash.
    """
    columns = docs.columns
    numbered = docs.select(*[F.col(f"`{c}`").alias(c if c == "text" else f"c{i}") for i, c in enumerate(columns)])
    kept = identify(numbered, fit(docs)).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score))
    return kept.select(*[F.col(c if c == "text" else f"c{i}").alias(c) for i, c in enumerate(columns)])


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = identify(docs.select("doc_id", "text"), fit(docs))
    return out.select("doc_id", (fold() == 0).alias("held_out"), "lang_pred", "score")
