"""Numeric column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def hash_key(*parts) -> Column:
    """md5 hex of ``parts`` joined by '|': a partition-independent random key."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]))


def hash_uniform(*parts) -> Column:
    """Uniform draw in [0, 1) from the first 32 bits of the md5 key."""
    h = hash_key(*parts)
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def safe_div(num, den) -> Column:
    """Division that is null when the denominator is zero (ANSI-safe)."""
    return F.try_divide(num, den)


def det_round(c, digits: int) -> Column:
    """Round half up as floor(x * 10^d + 0.5) / 10^d: plain IEEE double
    arithmetic, so every engine gives bit-identical results (built-in round
    functions differ on half-way cases).  From |x| * 10^d >= 2^52 on a double
    has no digits left to round (and floor() would leave the BIGINT range), so
    such values, infinities and NaN are returned as they are."""
    c = c if isinstance(c, Column) else F.col(c)
    scale = F.lit(float(10 ** digits))
    x = c.cast("double")
    return (F.when(F.abs(x) * scale < F.lit(2.0 ** 52), F.floor(x * scale + F.lit(0.5)) / scale)
            .otherwise(x))


def round_doubles(df: DataFrame, digits: int = 6, overrides: dict | None = None) -> DataFrame:
    """Round every DOUBLE/FLOAT column (for stable comparisons of results)."""
    overrides = overrides or {}
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(det_round(F.col(f.name), overrides.get(f.name, digits)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def fmt_duration(seconds: Column) -> Column:
    """seconds -> 'h:m:s.s' (hours and minutes without padding)."""
    s = seconds.cast("double")
    return F.format_string("%.0f:%.0f:%.1f", F.floor(s / 3600).cast("double"),
                           F.floor((s % 3600) / 60).cast("double"), s % 60)


def linspace_int(start: Column | int, stop: Column | int, n: int) -> Column:
    """n integer steps from start to stop: trunc(start + i*(stop-start)/(n-1))."""
    start_c = start if isinstance(start, Column) else F.lit(start)
    stop_c = stop if isinstance(stop, Column) else F.lit(stop)
    if n == 1:
        return F.array(start_c.cast("int"))
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                       lambda i: (start_c + i * (stop_c - start_c) / F.lit(n - 1)).cast("int"))
