"""Helpers shared by the operators: table reading, scratch tables in the shared folder, words, Arrow batches."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Words of every contract: runs of anything but space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)
SEPARATORS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def store(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as parquet in the cluster's shared checkpoint folder and return a scan of it.

    Cuts the lineage: a lost executor costs a re-read of the files, never a recomputation of the job.
    """
    path = f"{ensure_checkpoint_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def fold(col: str | Column = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; rows where it is 0 are held out of training (null id: null)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.crc32(c.cast("string").cast("binary")) % 5


_shipped: set[str] = set()


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow`` after sending this package to the executors (once per application)."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp()) / "transfero_code.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for source in package.rglob("*.py"):
                z.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)
    return df.mapInArrow(run, schema)


def let(value: Column, body) -> Column:
    """Bind ``value`` once for use inside lambdas; a plain reference would be evaluated per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bounded_sample(df: DataFrame, n: int, *key: str) -> DataFrame:
    """About ``n`` rows chosen by a hash of ``key`` (all rows, if fewer), never more than ``2 * n``.

    Only for fitting models; what a model is applied to is never sampled.
    """
    total = df.count()
    if total <= n:
        return df
    cut = -(1 << 63) + int((1 << 64) * (n / total))
    return df.filter(F.xxhash64(*key) < F.lit(cut)).limit(2 * n)


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of about ``limit`` bytes of text (at least one row each), zero-copy."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        if batch.num_rows == 0:
            continue
        size = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
        block = np.cumsum(size) // limit
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi > lo:
                yield batch.slice(lo, hi - lo)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, weight: str, limit: int) -> Iterator[pa.Table]:
    """From batches sorted by ``key``: tables of whole key groups, closed once ``weight`` sums to ``limit``.

    Memory is bounded by ``limit`` plus one group, so callers bound their groups (see each operator).
    """
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        total += int(pc.sum(batch.column(batch.schema.get_field_index(weight))).as_py() or 0)
        if total < limit:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        keys = t.column(key).to_numpy()
        last = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
        if last:
            start, sizes = 0, np.cumsum(t.column(weight).to_numpy())
            starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
            starts = starts[starts <= last]
            for cut in starts[1:]:
                if sizes[cut - 1] - (sizes[start - 1] if start else 0) >= limit or cut == last:
                    yield t.slice(start, cut - start)
                    start = int(cut)
            t = t.slice(last)
            held = t.to_batches()
            total = int(pc.sum(t.column(weight)).as_py() or 0)
        else:
            held = t.to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
