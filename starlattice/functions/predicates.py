"""Filter predicates built from user-level filter dictionaries."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# Filter fields that hold whole numbers.
INTEGER_FIELDS = frozenset(
    {"year", "quarter", "month", "time_key", "product_key", "customer_key", "store_key"}
)


def is_active(value: Any) -> bool:
    """None, the empty string and "All" mean "no predicate"; 0 is a value."""
    return value is not None and value != "" and value != "All"


def active_filters(filters: Mapping[str, Any] | None) -> dict[str, Any]:
    """The filters that restrict anything, whole-number fields cast to int."""
    return {
        name: int(value) if name in INTEGER_FIELDS else value
        for name, value in (filters or {}).items()
        if is_active(value)
    }


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def equals_all(filters: Mapping[str, Any] | None) -> Column:
    """Equality conjunction over the active filters."""
    return all_of(F.col(name) == F.lit(value) for name, value in active_filters(filters).items())


def key_contains(name: str, text: str) -> Column:
    """Substring search over a numeric key; % and _ keep their LIKE meaning."""
    return F.col(name).cast("string").like(f"%{text}%")


def key_contains_nocase(name: str, text: str) -> Column:
    return F.col(name).cast("string").ilike(f"%{text}%")


def changed_since(name: str, mark: Any, *, inclusive: bool) -> Column:
    """High-water-mark predicate: `>=` reading from sources, `>` between layers."""
    since = F.lit(mark).cast("date")
    return F.col(name) >= since if inclusive else F.col(name) > since
