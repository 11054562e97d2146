"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def safe_div(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 (ANSI mode would raise instead)."""
    return F.try_divide(num, den)


def ticker_window(partition: str | list[str] = "ticker", order: str = "date") -> WindowSpec:
    """Per-ticker series in date order."""
    return Window.partitionBy(partition).orderBy(order)


def trailing_rows(n: int, partition: str | list[str] = "ticker", order: str = "date") -> WindowSpec:
    """The current row and the n-1 rows before it (partial at the start)."""
    return ticker_window(partition, order).rowsBetween(-(n - 1), Window.currentRow)


def pct_change(cur: Column, prev: Column) -> Column:
    return safe_div(cur - prev, prev)


def is_missing(c: Column) -> Column:
    """NULL or NaN (what ``dropna`` treats as missing for doubles)."""
    return c.isNull() | F.isnan(c)


def band(value: Column, bands: list[tuple[float, str]], otherwise: str,
         inclusive: bool = True, descending: bool = True) -> Column:
    """Map value to a label by thresholds tried in order.

    descending=True: first threshold t with value >= t (or > t) wins.
    descending=False: first threshold t with value <= t (or < t) wins.
    """
    out = None
    for t, label in bands:
        if descending:
            cond = value >= t if inclusive else value > t
        else:
            cond = value <= t if inclusive else value < t
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(otherwise) if out is not None else F.lit(otherwise)
