"""Mergeable aggregate specifications.

Sliding windows are computed from per-pane partial aggregates (see
``operators.windows``), so each aggregate states how it is computed on rows
(``partials``), how partial results merge (``merges``) and how the output is
finished.  All three are built-in Spark aggregate expressions, so both phases
run with map-side partial aggregation and whole-stage codegen.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Agg:
    """``reversible``: partial results are counts, never null, so a pane that leaves a window is subtracted."""
    name: str

    reversible = False

    def partials(self) -> list[tuple[str, Column]]:
        raise NotImplementedError

    def merges(self) -> list[tuple[str, Column]]:
        raise NotImplementedError

    def finish(self) -> Column:
        raise NotImplementedError

    def _p(self, suffix: str = "") -> str:
        return f"__{self.name}{suffix}"


@dataclass(frozen=True)
class Count(Agg):
    """``count(*)`` (A1/A4), or ``count(col)`` when ``col`` is given."""
    col: str | None = None

    reversible = True

    def partials(self):
        c = F.count(F.lit(1)) if self.col is None else F.count(self.col)
        return [(self._p(), c)]

    def merges(self):
        return [(self._p(), F.sum(self._p()))]

    def finish(self):
        return F.coalesce(F.col(self._p()), F.lit(0)).cast("long")


@dataclass(frozen=True)
class Sum(Agg):
    """``sum(col)`` (A3)."""
    col: str = ""

    def partials(self):
        return [(self._p(), F.sum(self.col))]

    def merges(self):
        return [(self._p(), F.sum(self._p()))]

    def finish(self):
        return F.col(self._p())


@dataclass(frozen=True)
class Min(Agg):
    col: str = ""

    def partials(self):
        return [(self._p(), F.min(self.col))]

    def merges(self):
        return [(self._p(), F.min(self._p()))]

    def finish(self):
        return F.col(self._p())


@dataclass(frozen=True)
class Max(Agg):
    col: str = ""

    def partials(self):
        return [(self._p(), F.max(self.col))]

    def merges(self):
        return [(self._p(), F.max(self._p()))]

    def finish(self):
        return F.col(self._p())


@dataclass(frozen=True)
class IntAvg(Agg):
    """Integer average ``sum(col) div count(*)`` (A2), truncating like integer division."""
    col: str = ""

    def partials(self):
        return [(self._p("_s"), F.sum(F.col(self.col).cast("long"))), (self._p("_n"), F.count(F.lit(1)))]

    def merges(self):
        return [(self._p("_s"), F.sum(self._p("_s"))), (self._p("_n"), F.sum(self._p("_n")))]

    def finish(self):
        # exact BIGINT division, truncating toward zero like the reference's Long division
        return F.expr(f"`{self._p('_s')}` div `{self._p('_n')}`")


@dataclass(frozen=True)
class Avg(Agg):
    col: str = ""

    def partials(self):
        return [(self._p("_s"), F.sum(self.col)), (self._p("_n"), F.count(self.col))]

    def merges(self):
        return [(self._p("_s"), F.sum(self._p("_s"))), (self._p("_n"), F.sum(self._p("_n")))]

    def finish(self):
        return F.col(self._p("_s")) / F.col(self._p("_n"))


@dataclass(frozen=True)
class ApproxDistinct(Agg):
    """Approximate distinct count (A6) with mergeable HLL sketches."""
    col: str = ""
    lg_k: int = 12

    def partials(self):
        return [(self._p(), F.hll_sketch_agg(self.col, self.lg_k))]

    def merges(self):
        return [(self._p(), F.hll_union_agg(self._p(), True))]

    def finish(self):
        return F.hll_sketch_estimate(self._p())


def partial_exprs(aggs) -> list[Column]:
    return [c.alias(n) for a in aggs for n, c in a.partials()]


def merge_exprs(aggs) -> list[Column]:
    return [c.alias(n) for a in aggs for n, c in a.merges()]


def finish_exprs(aggs) -> list[Column]:
    return [a.finish().alias(a.name) for a in aggs]
