"""Number expressions as SQL text: long ones are parsed once, not built call by call."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlens.functions.binding import let_sql

MICRO = 1_000_000


def exact_round_sql(x: str, digits: int = 3) -> str:
    """SQL text that rounds the double ``x`` to ``digits`` decimals as its exact value demands.

    ``round`` works on the shortest decimal form of the double, so it differs
    on values whose last digit looks like a five but is not one. Here the
    product with the power of ten is split into its rounded value and its
    rounding error, and the error decides the ties; true ties go to even.
    """
    scale = f"{10**digits}D"
    choice = (
        "CASE WHEN r.f > 0.5D OR (r.f = 0.5D AND r.e > 0D) THEN r.w + 1D "
        f"WHEN r.f = 0.5D AND r.e = 0D THEN 2D * rint((r.w + r.f) / 2D) ELSE r.w END / {scale}"
    )
    parts = f"named_struct('p', x * {scale}, 'e', (h * {scale} - x * {scale}) + (x - h) * {scale})"
    split = "named_struct('w', double(floor(s.p)), 'f', s.p - double(floor(s.p)), 'e', s.e)"
    inner = let_sql("s", parts, let_sql("r", split, choice))
    return let_sql("x", x, let_sql("h", "134217729D * x - (134217729D * x - x)", inner))


def exact_round(x: str, digits: int = 3) -> Column:
    """``exact_round_sql`` of a column name or SQL expression as a column."""
    return F.expr(exact_round_sql(x, digits))


def micro_sql(x: str) -> str:
    """SQL text of a score as whole millionths: integer sums do not depend on their order."""
    return f"bigint(floor(({x}) * {MICRO}D + 0.5D))"


def to_micro(x: Column) -> Column:
    """The same for a column."""
    return F.floor(x * F.lit(float(MICRO)) + F.lit(0.5)).cast("bigint")


def clamp_sql(x: str) -> str:
    """SQL text of ``x`` held between -1 and 1."""
    return f"greatest(-1D, least(1D, {x}))"
