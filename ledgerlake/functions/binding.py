"""Bind an intermediate value inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is computed once however often the body reads it.

    Higher-order functions share no common subexpressions, so a nested lambda would repeat the work per element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def runs(items: Column, key: Callable[[Column], Column]) -> Column:
    """An array that is sorted by ``key``, cut into one array for each key. One pass over the items."""

    def cut(items: Column) -> Column:
        first = lambda _, i: (i == 0) | ~key(F.get(items, i)).eqNullSafe(key(F.get(items, i - 1)))
        numbered = F.transform(items, lambda x, i: F.when(first(x, i), i))
        starts = F.filter(numbered, lambda i: i.isNotNull())

        def slices(starts: Column) -> Column:
            after = lambda g: F.coalesce(F.get(starts, g + 1), F.size(items))
            return F.transform(starts, lambda s, g: F.slice(items, s + 1, after(g) - s))

        return let(starts, slices)

    return let(items, cut)
