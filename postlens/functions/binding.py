"""Name an intermediate value inside one column expression.

Columns built in steps grow when a later filter is pushed below them, once per
reference and step. A value bound here stays one expression wherever the
optimizer moves it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once however often ``use`` reads it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def let_sql(name: str, value: str, body: str) -> str:
    """SQL text of ``body``, in which ``name`` stands for ``value``."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"
