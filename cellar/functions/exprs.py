"""Column-expression helpers. All are built-in Spark expressions (codegen, JVM side)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Decimal places computed doubles are rounded to before they are ranked or
# reported, so that results do not depend on summation order.
ROUND = 6


def rnd(c, digits: int = ROUND) -> Column:
    """Round half away from zero on the scaled double, ``round(x * 10^d) / 10^d``.

    This is the arithmetic SQL engines such as DuckDB use for ``round(double, d)``;
    Spark's own ``round(double, d)`` goes through the decimal string of the value
    and can differ on exact halves, so the scaled form is used everywhere.
    """
    c = c if isinstance(c, Column) else F.col(c)
    p = float(10**digits)
    return F.round(c * F.lit(p)) / F.lit(p)


def mean(c, decimals: int | None = None) -> Column:
    """Mean rounded to 6 digits.

    With ``decimals`` (values carry at most that many decimal places, e.g.
    money or rates with 2) the mean is taken over exact decimals, so it does
    not depend on summation order: Spark's decimal average keeps
    ``decimals + 4`` places, half-up; the SQL oracle rounds the same way.
    """
    c = c if isinstance(c, Column) else F.col(c)
    if decimals is None:
        return rnd(F.avg(c))
    assert decimals == ROUND - 4, "the decimal average keeps decimals + 4 places"
    return F.avg(c.cast(f"decimal(18,{decimals})")).cast("double")


def clamp(c: Column, lo: float, hi: float) -> Column:
    """Bound a prediction to the rating scale."""
    return F.least(F.greatest(c, F.lit(float(lo))), F.lit(float(hi)))


def nan_to_null(c: Column) -> Column:
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def nan_as_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NaN in float columns (of ``cols``, else of all) becomes NULL: one kind of missing value (D3)."""
    wanted = {f.name: f.dataType for f in df.schema.fields if f.dataType.typeName() in ("double", "float") and (cols is None or f.name in cols)}
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)).cast(t) for c, t in wanted.items()}) if wanted else df


#: the most rows that a side whose size a parameter sets is broadcast with
MAX_BROADCAST_ROWS = 200_000


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint for a side of at most ``rows`` rows, if that is few; else the join is left to Spark."""
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def pearson_from_moments(n, sx, sy, sxx, syy, sxy, eps: float = 1e-9) -> Column:
    """Pearson r from six moment sums; NULL when a side is constant.

    Spark's ``corr`` throws DIVIDE_BY_ZERO on a constant group under ANSI mode,
    so the coefficient is written out.
    """
    n, sx, sy, sxx, syy, sxy = (F.col(x) if isinstance(x, str) else x for x in (n, sx, sy, sxx, syy, sxy))
    vx = n * sxx - sx * sx
    vy = n * syy - sy * sy
    cov = n * sxy - sx * sy
    return F.when((vx > eps) & (vy > eps), cov / F.sqrt(vx * vy))


def safe_div(num: Column, den: Column, default: float = 0.0) -> Column:
    """num/den, or ``default`` when den is 0."""
    return F.when(den != 0, num / den).otherwise(F.lit(default))
