"""Whole migration into a target of versions: every output once, every shared step once, published as a whole.

The graph of outputs, steps and tables is traced first. A step that several outputs or steps read is written once
and removed after its last reader; numbering tables go with the step or output they were made for. Outputs are
written in an order that follows from the graph. Rows that the target already holds are those of the last
published version, so a second run over the same sources gives the same tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..context import DEFAULT_CONTEXT, MigrationContext
from ..sources.catalog import Catalog, Legacy
from ..sources.target import Snapshot, Target
from .graph import Graph, Node, output, trace


class _Readers:
    """Counts readers down: a node is through when it is written, or when everything that reads it is through."""

    def __init__(self, graph: Graph, catalog: Catalog):
        self.catalog, self.readers, self.below = catalog, graph.readers(), graph.reads
        self.through: set[Node] = set()

    def done(self, node: Node) -> None:
        """``node`` reads nothing any more: release what only it still needed."""
        if node in self.through:
            return
        self.through.add(node)
        for used in self.below.get(node, ()):
            if self.readers[used] <= self.through:
                self.catalog.release(used)
                self.done(used)

    def stored(self) -> None:
        for node in list(dict.fromkeys(self.catalog.written)):
            if node not in self.through:
                self.done(node)


def _made_from(catalog: Catalog, graph: Graph, name: str, ctx: MigrationContext) -> str | None:
    """Digest of an output's sources; None where it cannot be told or depends on the target itself."""
    below = graph.below(output(name))
    if not isinstance(catalog, Legacy) or any(n[0] == "target" for n in below):
        return None
    said = [repr(ctx), *(f"{n[1]} {catalog.made_from(n[1])}" for n in sorted(n for n in below if n[0] == "table"))]
    return hashlib.sha256("\n".join(said).encode()).hexdigest()


def load_order(catalog: Catalog, ctx: MigrationContext = DEFAULT_CONTEXT) -> list[str]:
    """All outputs in the order in which they are loaded."""
    from . import JOBS
    return trace(catalog, JOBS, ctx).order()


def migrate(spark: SparkSession, src: Catalog | str, target_dir: str, ctx: MigrationContext = DEFAULT_CONTEXT,
            names: list[str] | None = None, only_stale: bool = False,
            before_write: Callable[[str], None] | None = None) -> Snapshot:
    """Load the named outputs (all, if none are named) into ``target_dir`` and publish them as its next version.

    ``only_stale`` takes over, without computing them, outputs whose source files have not changed since the last
    version and that read no rows of the target; it does not see changes of the code. ``before_write`` is called
    with the name of each output before it is written. If anything fails, the target stays at its last version.
    """
    from . import JOBS, SEGMENTS

    catalog = Legacy(spark, src) if isinstance(src, str) else src
    run = Target(spark, target_dir).begin()
    catalog.previous = run.previous
    jobs = {n: JOBS[n] for n in (names or JOBS)}
    made = {}
    if only_stale and run.previous:
        graph = trace(catalog, jobs, ctx)
        made = {n: _made_from(catalog, graph, n, ctx) for n in jobs}
        for name in [n for n, m in made.items() if m and m == run.previous.made_from.get(n) and n in run.previous.tables]:
            run.keep(name)
            run.made_from[name] = made[name]
            del jobs[name]
    graph = trace(catalog, {n: SEGMENTS.get(n, job) for n, job in jobs.items()}, ctx)
    catalog.shared = graph.shared()
    readers = _Readers(graph, catalog)
    order = Graph(graph.reads, jobs).order()
    try:
        for name in order:
            if before_write:
                before_write(name)
            with catalog.inside(output(name)):
                built = SEGMENTS[name](catalog, ctx) if name in SEGMENTS else {"all": jobs[name](catalog, ctx)}
                for segment, df in built.items():
                    if isinstance(df, DataFrame):
                        run.write(name, df, segment)
                    else:
                        run.keep(name, segment)
            if (said := made.get(name) or _made_from(catalog, graph, name, ctx)) is not None:
                run.made_from[name] = said
            readers.stored()
            catalog.release(output(name))
            readers.done(output(name))
    finally:
        for node in list(catalog._scratch):
            catalog.release(node)
        catalog.shared = set()
    return run.publish()
