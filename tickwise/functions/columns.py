"""Reusable column expressions.

Everything here returns a ``Column`` built from built-in functions, so it
stays inside whole-stage codegen and works on batch and streaming frames.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from tickwise import schemas as S


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(df: DataFrame, col: str) -> Column:
    """Microseconds since the epoch for a TIMESTAMP or TIMESTAMP_NTZ column."""
    if isinstance(df.schema[col].dataType, TimestampNTZType):
        return F.expr(
            f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{col}`)")
    return F.unix_micros(F.col(col))


def order_key(df: DataFrame, time_col: str, tie_breaker: str | None = None) -> Column:
    """A single sortable value for (time, tie_breaker).

    ``min_by(x, struct(t, id))`` makes Spark plan a SortAggregate; a scalar
    ``decimal(38,0)`` key keeps the partial/final HashAggregate. Micros need
    at most 17 digits; the tie-breaker, any BIGINT, is shifted to 1..2^64, and
    a null one is 0, before all others: ``micros * 2*10^19 + tie`` orders
    exactly like the pair.
    """
    us = epoch_micros(df, time_col)
    if tie_breaker is None:
        return us
    tie = F.col(tie_breaker).cast("decimal(20,0)") + F.expr("CAST('9223372036854775809' AS DECIMAL(20,0))")
    return (us.cast("decimal(18,0)") * F.expr("CAST('20000000000000000000' AS DECIMAL(20,0))")
            + F.coalesce(tie, F.lit(0).cast("decimal(21,0)"))).cast("decimal(38,0)")


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def interval_seconds(text: str) -> int | None:
    """Seconds of a simple interval such as ``"5 minutes"`` (None if not simple)."""
    import re
    m = re.fullmatch(r"\s*(\d+)\s*(second|minute|hour|day|week)s?\s*", text.lower())
    return int(m.group(1)) * _UNIT_SECONDS[m.group(2)] if m else None


def safe_ratio(num, den) -> Column:
    """num / den, null when den is 0 or null (ANSI-safe)."""
    return F.try_divide(_c(num), F.nullif(_c(den), F.lit(0)))


def _num(x: float) -> str:
    """A double literal in Spark SQL text."""
    return f"CAST('{float(x)!r}' AS DOUBLE)" if x != x or x in (float("inf"), float("-inf")) \
        else f"{float(x)!r}D"


# Each scoring expression has one form, SQL text, so that many columns are built in one
# call; the functions give it as a Column.

def z_score_sql(value: str, mean: str, std: str) -> str:
    """(x - mean) / std when std is known and positive, else 0.0."""
    return (f"CASE WHEN {std} IS NOT NULL AND {std} > 0D THEN ({value} - {mean}) / {std} "
            f"ELSE 0D END")


def pct_fallback_sql(return_col: str = "price_return_pct", vol_col: str = "rolling_volatility",
                     avg_col: str = "avg_price") -> str:
    """Early-window rule: big return or volatility above 2 % of the average price."""
    return (f"(abs({return_col}) > {_num(S.FALLBACK_RETURN_PCT)} "
            f"OR {vol_col} > {avg_col} * {_num(S.FALLBACK_VOL_RATIO)})")


def severity_sql(z: str = "z_score") -> str:
    return (f"CASE WHEN abs({z}) > {_num(S.SEVERITY_HIGH_Z)} THEN 'high' "
            f"WHEN abs({z}) > {_num(S.SEVERITY_MEDIUM_Z)} THEN 'medium' ELSE 'low' END")


PCT_FALLBACK_SQL, SEVERITY_SQL = pct_fallback_sql(), severity_sql()


def z_score(value: str, mean: str, std: str) -> Column:
    return F.expr(z_score_sql(value, mean, std))


def pct_fallback(return_col: str = "price_return_pct", vol_col: str = "rolling_volatility",
                 avg_col: str = "avg_price") -> Column:
    return F.expr(pct_fallback_sql(return_col, vol_col, avg_col))


def severity(z: str = "z_score") -> Column:
    return F.expr(severity_sql(z))


def threshold_band(value, bands: Sequence[float],
                   labels: Sequence[str] = ("green", "yellow", "red")) -> Column:
    """Colour band of a value: below bands[0] -> labels[0], ... (``>=`` steps)."""
    v = _c(value)
    out = F.when(v.isNull(), F.lit(None).cast("string"))
    for b, lab in sorted(zip(bands, labels[1:]), reverse=True):
        out = out.when(v >= F.lit(b), lab)
    return out.otherwise(labels[0])


def severity_label(col="severity") -> Column:
    """Display text of a severity: HIGH / MEDIUM / LOW."""
    return F.upper(_c(col))


def time_filter(col, start=None, end=None) -> Column:
    """Dashboard time range ``start <= col <= end``; either bound may be None."""
    c = _c(col)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (c >= _c(start) if isinstance(start, Column) else c >= F.lit(start))
    if end is not None:
        cond = cond & (c <= _c(end) if isinstance(end, Column) else c <= F.lit(end))
    return cond


def recent(col, as_of, interval: str) -> Column:
    """``col > as_of - INTERVAL interval`` (strict, as in the checks)."""
    a = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return _c(col) > a - F.expr(f"INTERVAL {interval}")


def not_system(col="symbol") -> Column:
    return _c(col) != F.lit(S.SYSTEM_SYMBOL)


def symbol_list(csv: str) -> Column:
    """Comma-separated list -> array of trimmed, non-blank names."""
    return F.filter(F.transform(F.split(F.lit(csv), ","), lambda x: F.trim(x)),
                    lambda x: x != "")


SNAP_DIGITS = 9
ROUNDED_BELOW = 1e15


def round_half_away(col, digits: int) -> Column:
    """Round a double to ``digits`` places, half away from zero, as decimal
    arithmetic does, after snapping it to ``SNAP_DIGITS`` places.

    Step 1 (binary): ``round(x * 10^9) / 10^9`` removes last-bit noise, so a
    value that is a decimal tie in exact arithmetic (an average such as
    53.2509375) no longer depends on the order an engine summed in.
    Step 2 (decimal): the snapped value becomes ``DECIMAL(38,9)`` and is
    rounded there, so 2.675 -> 2.68 and 1037.0821875 -> 1037.082188, as a
    store computing ``ROUND(x::numeric, n)`` shows them. Returns a double.
    NaN, the infinities and values from 10^15 on, which have no such places as
    doubles, are returned as they are.
    """
    snap, x = F.lit(float(10 ** SNAP_DIGITS)), _c(col).cast("double")
    y = F.round(x * snap, 0) / snap
    rounded = F.round(y.cast(f"decimal(38,{SNAP_DIGITS})"), digits).cast("double")
    return F.when(F.abs(x) < F.lit(ROUNDED_BELOW), rounded).otherwise(x)


def round_sql(expr: str, digits: int) -> str:
    """SQL text of ``round_half_away`` (DuckDB dialect). The double -> decimal
    step goes through the shortest decimal text, as Spark's cast does; a
    direct cast would scale in binary and lose halves of large values."""
    rounded = (f"CAST(round(CAST(CAST(round({expr}, {SNAP_DIGITS}) AS VARCHAR) "
               f"AS DECIMAL(38,{SNAP_DIGITS})), {digits}) AS DOUBLE)")
    x = f"CAST({expr} AS DOUBLE)"
    return f"CASE WHEN isfinite({x}) AND abs({x}) < {ROUNDED_BELOW!r} THEN {rounded} ELSE {x} END"


def round_cols(df: DataFrame, cols: Iterable[str], digits: int = 6) -> DataFrame:
    """Round the given double columns in place (``round_half_away``)."""
    cols = set(cols)
    return df.select([round_half_away(c, digits).alias(c) if c in cols else F.col(c)
                      for c in df.columns])
