"""Which output needs which steps and tables, found by building all plans once without running any job."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from ..context import MigrationContext
from ..session import planning
from ..sources.catalog import Catalog

Node = tuple


def output(name: str) -> Node:
    return ("output", name)


@dataclass(frozen=True)
class Graph:
    """``reads``: node -> nodes that it uses directly. Nodes are outputs, steps, views, legacy tables and target tables."""

    reads: dict[Node, frozenset[Node]]
    jobs: dict[str, Callable]

    def readers(self) -> dict[Node, set[Node]]:
        found: dict[Node, set[Node]] = {}
        for node, used in self.reads.items():
            for x in used:
                found.setdefault(x, set()).add(node)
        return found

    def below(self, node: Node) -> set[Node]:
        """Everything a node needs, directly or not."""
        seen, todo = set(), [node]
        while todo:
            for x in self.reads.get(todo.pop(), ()):
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return seen

    def shared(self) -> set[Node]:
        """Steps with several readers; a reader of a view reads what the view is made of."""
        readers = self.readers()

        def through(node: Node) -> set[Node]:
            out = set()
            for r in readers.get(node, ()):
                out |= through(r) if r[0] == "view" else {r}
            return out

        return {n for n in readers if n[0] == "step" and len(through(n)) > 1}

    def order(self) -> list[str]:
        """Outputs in load order: an output whose own rows another one reads comes first, else as registered."""
        step = {_of(job): name for name, job in self.jobs.items()}
        needs = {name: {step[x[1:3]] for x in self.below(output(name)) if x[0] in ("step", "view") and x[1:3] in step} - {name} for name in self.jobs}
        done: list[str] = []

        def visit(name: str) -> None:
            if name not in done:
                for other in self.jobs:
                    if other in needs[name]:
                        visit(other)
                done.append(name)

        for name in self.jobs:
            visit(name)
        return done

    def clearing(self) -> list[str]:
        """The order in which tables can be cleared: the load order backwards."""
        return self.order()[::-1]


def _of(job: Callable) -> tuple[str, str]:
    return job.__module__, job.__qualname__


def trace(src: Catalog, jobs: dict[str, Callable], ctx: MigrationContext) -> Graph:
    outline = src.outline()
    with planning():
        for name, job in jobs.items():
            with outline.inside(output(name)):
                job(outline, ctx)
    return Graph({n: frozenset(x) for n, x in outline.reads.items()}, dict(jobs))
