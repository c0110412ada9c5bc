"""Small helpers for functions that take a column or its name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def filled(x: Column | str) -> Column:
    """Null where the text is blank."""
    return F.nullif(F.trim(col(x)), F.lit(""))


def first_filled(*xs: Column | str) -> Column:
    """The first text that is not blank."""
    return F.coalesce(*(filled(x) for x in xs))


def once(value: Column, use) -> Column:
    """use(value) with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def cases(pairs: Iterable[tuple[Column, object]], default: object = None) -> Column:
    """The value of the first condition that holds; conditions keep their order."""
    out = None
    for condition, value in pairs:
        v = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, v) if out is None else out.when(condition, v)
    end = default if isinstance(default, Column) else F.lit(default)
    return end if out is None else out.otherwise(end)


def lookup(x: Column | str, table: dict[str, str], default: Column | None = None) -> Column:
    """A value from a small fixed table."""
    found = F.element_at(F.create_map(*(F.lit(v) for pair in table.items() for v in pair)), col(x))
    return found if default is None else F.coalesce(found, default)


def ordered_distinct(items: Column, key) -> Column:
    """Elements whose key appears for the first time; elements with a null key go.

    Keys are worked out once and sorted, so long arrays cost n log n. Keys and elements are of types that can be sorted.
    """
    keyed = F.filter(F.transform(items, lambda x, i: F.struct(key(x).alias("k"), i.alias("i"), x.alias("x"))), lambda s: s["k"].isNotNull())
    firsts = once(F.array_sort(keyed), lambda a: F.filter(a, lambda s, i: (i == 0) | (F.get(a, i - 1)["k"] != s["k"])))
    placed = F.array_sort(F.transform(firsts, lambda s: F.struct(s["i"].alias("i"), s["x"].alias("x"))))
    return F.transform(placed, lambda s: s["x"])


def stretches(items: Column, key) -> Column:
    """Array of struct(key, items): neighbouring elements of equal key (null is one like any other) as arrays, in order; linear."""

    def cut(a: Column) -> Column:
        new = lambda i: (i == 0) | ~key(F.get(a, i)).eqNullSafe(key(F.get(a, i - 1)))
        starts = F.filter(F.sequence(F.lit(0), F.size(a)), lambda i: (i < F.size(a)) & new(i))
        return once(starts, lambda at: F.transform(at, lambda p, j: F.struct(key(F.get(a, p)).alias("key"), F.slice(a, p + 1, F.coalesce(F.get(at, j + 1), F.size(a)) - p).alias("items"))))

    return once(items, cut)
