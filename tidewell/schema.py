"""Column conventions and clock arithmetic.

``observations``: key columns, ``ts`` (TIMESTAMP_NTZ, fixed offset), ``value``
(DOUBLE, missing = NULL).  Screened data adds ``user_flag`` (NULL no opinion,
1 anomaly, 0 kept by a person).  Key columns are never NULL: a missing
sublocation is the text ``default``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

KEYS = ("station", "param")
DEFAULT_SUBLOC = "default"
MICROS = 1_000_000


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(ts: Column | str) -> Column:
    return F.unix_micros(col(ts).cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us.cast("long")).cast("timestamp_ntz")


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def nan_to_null(c: Column | str) -> Column:
    c = col(c)
    return F.when(~F.isnan(c), c)


def observations(df, keys=KEYS, ts="ts", value="value"):
    """Cast to the canonical columns; NaN becomes NULL."""
    v = nan_to_null(col(value).cast("double"))
    return df.select(*keys, col(ts).cast("timestamp_ntz").alias("ts"), v.alias("value"))
