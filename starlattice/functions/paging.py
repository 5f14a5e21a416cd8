"""Sorted pages and page counts. A page writes nothing."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Up to this many rows before the end of a page every task keeps that many and one task sorts them.
SHALLOW_ROWS = 10_000
# Values of a sort column, at most about so many, that cut the rows before a deep page into ranges.
CUTS = 64

# A column's name and whether it goes down.
SortKey = tuple[str, bool]


def sort_keys(names: Iterable[str], descending: bool = False) -> list[SortKey]:
    return [(n, descending) for n in names]


def sort_columns(names: Iterable[str], descending: bool = False) -> list[Column]:
    """Nulls last going up and first going down."""
    return [F.col(n).desc_nulls_first() if descending else F.col(n).asc_nulls_last() for n in names]


def _sorted(keys: Iterable[SortKey]) -> list[Column]:
    return [column for name, descending in keys for column in sort_columns([name], descending)]


def page_of(df: DataFrame, order: Iterable[SortKey], page: int, page_size: int) -> DataFrame:
    """One page of the sorted rows.

    `order` should end in a unique key, so that pages never overlap. A page near
    the start is the end of a top-n. For one further on, sampled values of the first
    column cut the rows into ranges, which are counted; only those that hold the page
    are cut again, until they are few. The cuts are literals, so ranges are the same
    whenever they are read, and push down to the files. A value that very many rows
    share is cut by the next column.
    """
    if page < 1 or page_size < 1:
        raise ValueError("page and page_size start at 1")
    order = list(order)
    rows, start, left = df, (page - 1) * page_size, list(order)
    while left and start + page_size > SHALLOW_ROWS:
        found, start, shared, narrowed = _ranges_of_page(rows, left[0], start, page_size)
        rows = found
        if shared or not narrowed:
            left.pop(0)
            if not shared:
                break
    return rows.orderBy(*_sorted(order)).offset(start).limit(page_size)


def _ranges_of_page(df: DataFrame, key: SortKey, start: int, page_size: int) -> tuple[DataFrame, int, bool, bool]:
    """The rows of the ranges that hold `page_size` rows from `start`, and how many of them come before these.

    Also whether all of them share one value of the column, and whether rows were left out.
    """
    name, descending = key
    value, total = F.col(f"`{name}`"), df.count()
    known = df.where(value.isNotNull()).select(value.alias("value"))
    cuts = sorted({r["value"] for r in known.sample(min(1.0, CUTS / max(total, 1)), seed=1).collect()})
    if not cuts:
        cuts = [r["value"] for r in known.limit(1).collect()]
    if not cuts:
        return df, start, True, False
    # Range 2 i + 1 is the cut value i, range 2 i lies before it; nulls are one range at the end, or first going down.
    edges = F.array(*[F.lit(c) for c in cuts])
    number = 2 * F.size(F.filter(edges, lambda c: c < value)) + F.array_contains(edges, value).cast("int")
    nulls = 2 * len(cuts) + 1
    counted = df.groupBy(F.coalesce(number, F.lit(nulls)).alias("part")).count().collect()
    counts = {r["part"]: r["count"] for r in counted}
    before, held = 0, []
    for part in sorted(counts, reverse=descending):
        if not held and before + counts[part] <= start:
            before += counts[part]
        elif before + sum(counts[p] for p in held) < start + page_size:
            held.append(part)
    if not held:
        return df.limit(0), 0, True, True
    inside = [_within(value, part, cuts) if part != nulls else value.isNull() for part in held]
    rows = df.where(reduce(lambda a, b: a | b, inside))
    shared = len(held) == 1 and held[0] % 2 == 1
    return rows, start - before, shared, sum(counts[p] for p in held) < total


def _within(value: Column, part: int, cuts: list) -> Column:
    at = part // 2
    if part % 2:
        return value == F.lit(cuts[at])
    after = value > F.lit(cuts[at - 1]) if at > 0 else value.isNotNull()
    return after & (value < F.lit(cuts[at])) if at < len(cuts) else after


def page_after(df: DataFrame, order: Iterable[SortKey], values: Iterable, page_size: int) -> DataFrame:
    """The page that follows the row with these values of the sort columns.

    Rows before it are left out by a filter that reaches the files; with files
    sorted by the first column most are never read. Nothing is counted.
    """
    order, values = list(order), list(values)
    if len(order) != len(values) or any(v is None for v in values):
        raise ValueError("every sort column needs a value")
    further, same = F.lit(False), F.lit(True)
    for (name, descending), given in zip(order, values):
        value = F.col(f"`{name}`")
        beyond = value < F.lit(given) if descending else (value > F.lit(given)) | value.isNull()
        further = further | (same & beyond)
        same = same & (value == F.lit(given))
    first, descending = order[0]
    bound = F.col(f"`{first}`") <= F.lit(values[0]) if descending else (F.col(f"`{first}`") >= F.lit(values[0])) | F.col(f"`{first}`").isNull()
    return df.where(bound & further).orderBy(*_sorted(order)).limit(page_size)


def page_counts(df: DataFrame, page_size: int, *, at_least_one: bool = False) -> DataFrame:
    """One row: total_rows and total_pages."""
    pages = F.ceil(F.col("total_rows") / F.lit(page_size)).cast("bigint")
    if at_least_one:
        pages = F.greatest(F.lit(1).cast("bigint"), pages)
    return df.agg(F.count(F.lit(1)).alias("total_rows")).withColumn("total_pages", pages)
