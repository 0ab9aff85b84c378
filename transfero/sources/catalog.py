"""Source catalog: (legacy table name) -> DataFrame, plus the shared-SQL oracle builder.

``Legacy(spark, sf_dir)`` reads the test tables of one folder and builds each legacy-shaped table
from its adapter text on first use (table names are bound as DataFrame parameters, no views). The DataFrames stay lazy: Catalyst sees adapter and job
as one plan, so filters and column pruning reach the parquet scan.
"""

from __future__ import annotations

import copy
import functools
import re
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import Split
from ..session import is_planning, process_session, scratch_owner, scratch_path, shuffle_files_removed
from .adapters import ADAPTERS
from .files import fingerprint, remove
from .target import Snapshot

#: Bytes of an input table for each partition of a shuffle, at most: tasks grow in number with the input, not in memory.
#: Adaptive execution joins small ones again.
SHUFFLE_BYTES = 4 << 20

#: How steps are packed: they lie on disk until the last reader is through.
STEP_CODEC = "zstd"

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _blank(result: object) -> object:
    """A step's result without rows and without the plan behind it, so that planning takes no longer with depth."""
    if isinstance(result, Split):
        return Split(_blank(result.tagged), *result.only_rejected)
    if isinstance(result, tuple):
        return tuple(map(_blank, result))
    return result.sparkSession.createDataFrame([], result.schema) if isinstance(result, DataFrame) else result


def _write_lying(df: DataFrame, by: tuple[str, ...], path: str) -> DataFrame:
    """``df`` written to ``path`` in one bucket of ``by`` for each partition of a shuffle, and read back. Only a table knows
    its buckets; the frame read from it does without its name afterwards, and dropping that leaves the files."""
    spark, name = df.sparkSession, path.rsplit("/", 1)[1].replace("-", "_")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, *by).write.format("parquet").option("compression", STEP_CODEC).bucketBy(n, *by).option("path", path).saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"drop table {name}")


class Catalog:
    """What jobs read: legacy tables, tables already in the target, and steps derived from them.

    Steps are built once. While one is built, every table and step it asks for is noted, so the reads form a graph
    (``reads``: node -> nodes it uses). A step named in ``shared`` is written once and read from there by all that
    use it; ``release`` removes what a step has written when its last reader is through.
    """

    spark: SparkSession

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.previous: Snapshot | None = None
        self.shared: set[tuple] = set()
        self.reads: dict[tuple, set[tuple]] = {}
        self.written: list[tuple] = []
        self._cache: dict[str, DataFrame] = {}
        self._memo: dict[tuple, object] = {}
        self._scratch: dict[tuple, list[str]] = {}
        self._inside: list[tuple] = []

    def read(self, name: str) -> DataFrame:
        raise NotImplementedError

    def table(self, name: str) -> DataFrame:
        node = ("table", name)
        self._note(node)
        if name not in self._cache:
            with self.inside(node):
                df = self.read(name)
            self._cache[name] = _blank(df) if is_planning() else df
        return self._cache[name]

    def __getitem__(self, name: str) -> DataFrame:
        return self.table(name)

    def existing(self, output: str, table: str, without: tuple[str, ...] = ()) -> DataFrame:
        """Rows of a target table before this run: what the last run published as ``output`` (without the segments
        that this run replaces), or else the legacy name ``table``."""
        self._note(("target", output))
        published = self.previous.table(output, without) if self.previous else None
        return self.table(table) if published is None else published

    def _note(self, node: tuple) -> None:
        if self._inside:
            self.reads.setdefault(self._inside[-1], set()).add(node)

    @contextmanager
    def inside(self, node: tuple) -> Iterator[None]:
        self._inside.append(node)
        self.reads.setdefault(node, set())
        try:
            with scratch_owner(self._scratch.setdefault(node, [])):
                yield
        finally:
            self._inside.pop()

    def memo(self, key: tuple, build: Callable[[], object], store: bool = False, by: tuple[str, ...] = ()) -> object:
        """Build a derived result once per catalog (DataFrames are immutable, so sharing is safe); with ``store``
        it is written once whoever reads it, its rows lying by ``by`` if that is given."""
        self._note(key)
        if key not in self._memo:
            with self.inside(key):
                result = build()
            if is_planning():
                result = _blank(result)
            elif store or key in self.shared:
                result = self._store(key, result, by)
            self._memo[key] = result
        return self._memo[key]

    def _store(self, key: tuple, result: object, by: tuple[str, ...] = ()) -> object:
        """Write a step once. A split is written before it is split; other tuples frame by frame. With ``by`` it is
        written in buckets of these columns, so that readers who need equal ones together do not move its rows."""
        inner, self._scratch[key] = self._scratch[key], []

        def write(df: DataFrame) -> DataFrame:
            with scratch_owner(self._scratch[key]):
                path = scratch_path(df.sparkSession, "step")
            with shuffle_files_removed(df.sparkSession):
                if by:
                    back = _write_lying(df, by, path)
                else:
                    df.write.parquet(path, compression=STEP_CODEC)
            self.written.append(key)
            return back if by else df.sparkSession.read.schema(df.schema).parquet(path)

        if isinstance(result, Split):
            stored = Split(write(result.tagged), *result.only_rejected)
        elif isinstance(result, tuple):
            stored = tuple(write(df) for df in result)
        else:
            stored = write(result)
        for path in inner:  # numbering tables that only this step has read
            remove(SparkSession.getActiveSession(), path)
        return stored

    def release(self, node: tuple) -> None:
        """Remove what ``node`` has written; nothing reads it any more."""
        for path in self._scratch.pop(node, []):
            remove(SparkSession.getActiveSession(), path)
        self._memo.pop(node, None)
        if node[0] == "table":
            self._cache.pop(node[1], None)

    def outline(self) -> "Catalog":
        """A catalog over the same tables with nothing derived yet, for planning."""
        twin = copy.copy(self)
        twin.shared, twin.reads, twin.written = set(), {}, []
        twin._cache, twin._memo, twin._scratch, twin._inside = {}, {}, {}, []
        return twin


class Legacy(Catalog):
    """Legacy-shaped inputs of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(process_session(spark))
        self.sf_dir = sf_dir.rstrip("/")
        self._base: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        if name not in self._base:
            self._base[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            self._spread(self._base[name])
        return self._base[name]

    def _spread(self, table: DataFrame) -> None:
        """Raise the number of shuffle partitions to what ``table`` asks for; the caller's number is the least."""
        size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        key = "spark.sql.shuffle.partitions"
        if (wanted := -(-size // SHUFFLE_BYTES)) > int(self.spark.conf.get(key)):
            self.spark.conf.set(key, str(wanted))

    def read(self, name: str) -> DataFrame:
        builder = _SPARK_BUILDERS.get(name)
        if builder is not None:
            return builder(self)
        # The adapter's table names become DataFrame parameters of spark.sql, so no temporary
        # view is registered in the caller's session.
        text, used = ADAPTERS[name], base_tables(name)
        template = re.sub(rf"\b({'|'.join(used)})\b", r"{\1}", text) if used else text
        return self.spark.sql(template, **{b: self.base(b) for b in used})

    def made_from(self, name: str) -> str:
        """Digest of the files behind a legacy table."""
        return " ".join(fingerprint(self.base(b)) for b in base_tables(name))


def base_tables(name: str) -> list[str]:
    name = {"almox_movimento_linhas": "almox_movimento"}.get(name, name)
    return [b for b in BASE_TABLES if re.search(rf"\b{b}\b", ADAPTERS[name])]


def derived(fn):
    """Decorator for job steps ``fn(src, *args)``: one build per catalog and arguments, so a step used
    by several outputs of a job (and the checkpoints it takes) is not repeated."""
    @functools.wraps(fn)
    def wrapper(src: Catalog, *args, **kw):
        return src.memo(("step", fn.__module__, fn.__qualname__, args, tuple(sorted(kw.items()))), lambda: fn(src, *args, **kw))
    return wrapper


def stored(fn):
    """Like ``derived``, for a step that a single output reads several times: it is written once."""
    @functools.wraps(fn)
    def wrapper(src: Catalog, *args, **kw):
        return src.memo(("step", fn.__module__, fn.__qualname__, args, tuple(sorted(kw.items()))), lambda: fn(src, *args, **kw), store=True)
    return wrapper


def stored_by(*columns: str):
    """Like ``stored``, with the rows lying by ``columns``: joins, windows and aggregates by them move nothing."""
    def decorate(fn):
        @functools.wraps(fn)
        def wrapper(src: Catalog, *args, **kw):
            return src.memo(("step", fn.__module__, fn.__qualname__, args, tuple(sorted(kw.items()))), lambda: fn(src, *args, **kw), True, columns)
        return wrapper
    return decorate


def view(fn):
    """Like ``derived``, for a cheap projection of other steps: it is never worth a table of its own."""
    @functools.wraps(fn)
    def wrapper(src: Catalog, *args, **kw):
        return src.memo(("view", fn.__module__, fn.__qualname__, args, tuple(sorted(kw.items()))), lambda: fn(src, *args, **kw))
    return wrapper


def _movement_lines(src: Legacy) -> DataFrame:
    """Warehouse movements without their running number: the adapter's columns, and the keys it numbers them by."""
    text = ADAPTERS["almox_movimento"]
    columns = text[text.index("l_partkey cdmaterial"):text.rindex(" from lineitem")]
    keys = ", ".join(f"{c} _k_{c}" for c in _MOVEMENT_ORDER)
    return src.spark.sql(f"select {columns}, {keys} from {{lineitem}}", lineitem=src.base("lineitem"))


_MOVEMENT_ORDER = ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _almox_movimento(src: Legacy) -> DataFrame:
    """Warehouse ledger: the adapter numbers all lineitems with one unpartitioned window, which
    runs in a single task. Here the same numbers come from the distributed global numbering."""
    from ..operators.numbering import global_number

    keys = [f"_k_{c}" for c in _MOVEMENT_ORDER]
    return global_number(_movement_lines(src), keys, "nrlancamento").drop(*keys)


def _commitment_items(src: Legacy) -> DataFrame:
    """Items of commitments: the adapter's rows, with the customers joined to the orders, of which there are fewer."""
    text = ADAPTERS["dataview_pedidoempenho"]
    columns = text[:text.index(" from lineitem")]
    bought = src.base("orders").join(src.base("customer"), F.col("c_custkey") == F.col("o_custkey"))
    return src.spark.sql(f"{columns} from {{lineitem}} join {{bought}} on o_orderkey = l_orderkey",
                         lineitem=src.base("lineitem"), bought=bought)


def _earlier_registry(history: bool) -> Callable[[Legacy], DataFrame]:
    def build(src: Legacy) -> DataFrame:
        from ..plans.tender import earlier_registry
        return earlier_registry(src, history)
    return build


_SPARK_BUILDERS: dict[str, Callable[[Legacy], DataFrame]] = {
    "almox_movimento": _almox_movimento,
    "almox_movimento_linhas": lambda src: _movement_lines(src).drop(*[f"_k_{c}" for c in _MOVEMENT_ORDER]),
    "dataview_pedidoempenho": _commitment_items,
    "regpreco_existing": _earlier_registry(False),
    "regprecohis_existing": _earlier_registry(True),
}


def oracle(body: str, adapters: Iterable[str], ctes: Iterable[tuple[str, str]] = ()) -> str:
    """DuckDB text: the named adapters as CTEs, then extra CTEs, then the body."""
    parts = [f"{name} AS ({ADAPTERS[name]})" for name in adapters]
    parts += [f"{name} AS ({sql})" for name, sql in ctes]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
