"""Token counts: pieces are counted once per distinct pre-token and summed over pre-token frequencies.

Each task builds per-document pre-token frequencies, counts the pieces of every distinct pre-token it
has not met before, and joins the two in its own memory: document and pre-token rows never cross the
network, so nothing shuffles and a lost task repeats only its own split. Ids of a document are never
put together.

Defined results: null or empty text has 0 bytes and 0 tokens; repeated rows give repeated rows; a null
``doc_id`` stays null; other columns of the input are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from .common import map_arrow, pieces, table
from .tokens import vocabulary, worker_tokens

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def token_counts(docs: DataFrame, files: tuple[str, str, str] | None = None, limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs`` (doc_id, text)."""
    files = files or vocabulary()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = worker_tokens(*files)
        for batch in pieces(batches):
            texts = batch.column(1).to_pylist()
            n_tokens = [0] * len(texts)
            frequencies: list[Counter] = [Counter()] * len(texts)
            distinct: set[str] = set()
            for i, text in enumerate(texts):
                if text:
                    chunks = tokens.chunks(text)
                    if chunks is None:
                        n_tokens[i] = len(tokens.whole(text))
                    else:
                        n_tokens[i] = len(tokens.first(chunks[0]))
                        frequencies[i] = Counter(chunks[1:])
                        distinct.update(frequencies[i])
            ids = tokens.lookup(distinct)
            n_pieces = {c: len(ids[c]) // 4 for c in distinct}
            n_tokens = [n + sum([k * n_pieces[c] for c, k in f.items()]) for n, f in zip(n_tokens, frequencies)]
            n_bytes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), n_bytes, pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return map_arrow(docs.selectExpr("cast(doc_id as long) doc_id", "text"), count, SCHEMA)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
