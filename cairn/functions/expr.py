"""Column-expression helpers. All are built-in Spark expressions, so they stay
inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Exact types for the FIFO engine. Quantities are fixed-point so that
# differences of prefix sums are exact (no false unmatched residue): running
# sums up to 1e23 units and (32,9) - (32,9) -> (33,9) keep every digit.
# Prices keep 16 decimals (sub-cent tokens trade far below 1e-9 USD). Money
# is (38,10) so sums cannot overflow on real data (ANSI mode would fail the
# job); quantity x price is exact to 1e-6 USD.
QTY = DecimalType(32, 9)
PRICE = DecimalType(24, 16)
MONEY = DecimalType(38, 10)


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den, default=0.0) -> Column:
    """num / den as double, ``default`` when den is null or 0."""
    n, d = col(num).cast("double"), col(den).cast("double")
    return F.when(d.isNull() | (d == 0), F.lit(default)).otherwise(n / d)


def clip(c, lo=0.0, hi=1.0) -> Column:
    return F.least(F.greatest(col(c), F.lit(lo)), F.lit(hi))


def round_half_up(c, digits: int) -> Column:
    """Round a double half-up with plain IEEE operations
    (floor(x * 10^d + 0.5) / 10^d). Engine-independent: any engine doing the
    same three double operations gets the same bits, which keeps value
    hashes comparable across engines."""
    scale = 10 ** digits
    return (F.floor(col(c).cast("double") * scale + 0.5) / scale).cast("double")


def money_out(c, digits: int = 2) -> Column:
    """Round an exact decimal amount half-up, then expose it as double."""
    return F.round(col(c), digits).cast("double")


def ts_ntz(text: str) -> Column:
    """A TIMESTAMP_NTZ literal; the test tables store naive UTC times."""
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


def elapsed_seconds(start, end) -> Column:
    """Whole seconds from start to end, independent of the session time zone."""
    return F.timestamp_diff("SECOND", col(start), col(end))


def elapsed_micros(start, end) -> Column:
    return F.timestamp_diff("MICROSECOND", col(start), col(end))


def whole_days(start, end) -> Column:
    """Python ``(end - start).days``: floor of elapsed 24-hour periods."""
    return F.floor(elapsed_micros(start, end) / F.lit(86_400_000_000)).cast("long")


def sql_round(expr: str, digits: int) -> str:
    """SQL text of :func:`round_half_up` for the DuckDB oracle."""
    scale = 10 ** digits
    return f"CAST(FLOOR(CAST({expr} AS DOUBLE) * {scale} + 0.5) / {scale} AS DOUBLE)"
