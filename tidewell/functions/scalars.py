"""FN-*.  Scalar functions as Columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewell.operators.checks import require_empty
from tidewell.schema import col, ntz

# Unit pairs as (from, to, scale, offset): to = from * scale + offset
UNIT_FACTORS = [
    ("ft^3/s", "m^3/s", 0.028316846592, 0.0),
    ("m^3/s", "ft^3/s", 1 / 0.028316846592, 0.0),
    ("ft", "m", 0.3048, 0.0),
    ("m", "ft", 1 / 0.3048, 0.0),
    ("deg_f", "deg_c", 5.0 / 9.0, -160.0 / 9.0),
    ("deg_c", "deg_f", 1.8, 32.0),
]

# Other names of a unit
UNIT_NAMES = {"fnu": "FNU", "ntu": "FNU", "us/cm": "microS/cm", "microsiemens/cm": "microS/cm", "cfs": "ft^3/s",
              "cms": "m^3/s", "feet": "ft", "meters": "m", "deg_f": "deg_c", "psu": "psu"}

# Words for a gate state
GATE_STATES = {"O": "Open", "OPEN": "Open", "C": "Closed", "CLSD": "Closed", "CLOSED": "Closed",
               "OP": "Tidal", "M-OP": "Tidal", "TIDAL": "Tidal"}


def _map(pairs) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def fahrenheit_to_celsius(f) -> Column:
    """FN-1."""
    return F.round((col(f) - 32.0) * 5.0 / 9.0, 2)


def convert_units(value, from_unit, to_unit) -> Column:
    """FN-2.  Units as Columns or texts; an unknown pair is an error."""
    a = F.lit(from_unit) if isinstance(from_unit, str) else from_unit
    b = F.lit(to_unit) if isinstance(to_unit, str) else to_unit
    v = col(value)
    out = F.when(a == b, v)
    for x, y, scale, offset in UNIT_FACTORS:
        out = out.when((a == x) & (b == y), v * scale + offset)
    return out.otherwise(F.raise_error(F.concat(F.lit("no conversion from "), a, F.lit(" to "), b)).cast("double"))


def canonical_unit(unit) -> Column:
    """FN-3.  Canonical name of a unit; unknown names stay."""
    u = col(unit)
    return F.coalesce(_map(UNIT_NAMES)[F.lower(F.trim(u))], u)


def canonical_value(value, unit) -> Column:
    """FN-3.  Value in the canonical unit (only Fahrenheit changes)."""
    return F.when(F.lower(F.trim(col(unit))) == "deg_f", fahrenheit_to_celsius(value)).otherwise(col(value))


def linear(value, scale=1.0, offset=0.0) -> Column:
    """FN-4."""
    return col(value) * scale + offset


def ec_to_psu_25c(ec) -> Column:
    """FN-5.  Practical salinity from specific conductance (microS/cm) at 25 C:
    PSS-78 with the low-salinity extension of Hill et al. (1986)."""
    r = col(ec) / 53087.0
    s = F.sqrt(r)
    t = 10.0 / (1.0 + 0.0162 * 10.0)  # (25 - 15) / (1 + k (25 - 15))
    # PSS-78 coefficients
    a = (0.0080, -0.1692, 25.3851, 14.0941, -7.0261, 2.7081)
    b = (0.0005, -0.0056, -0.0066, -0.0375, 0.0636, -0.0144)
    # conductivity ratio at 25 C relative to standard seawater at 25 C
    poly = lambda c: c[0] + s * (c[1] + s * (c[2] + s * (c[3] + s * (c[4] + s * c[5]))))
    low_x, low_y = 400.0 * r, 100.0 * r
    hill = 0.0080 / (1 + 1.5 * low_x + low_x * low_x) + 0.0005 * t / (1 + F.sqrt(low_y) + low_y + low_y * F.sqrt(low_y))
    return poly(a) + t * poly(b) - hill


def add_column(df: DataFrame, name: str, default=None, dtype="string") -> DataFrame:
    """FN-6.  A constant column; it must not exist."""
    if name in df.columns:
        raise ValueError(f"column {name} exists")
    return df.withColumn(name, F.lit(default).cast(dtype))


def datum_adjust(value, ts, adj: float, until: str) -> Column:
    """FN-7.  Add ``adj`` up to and including ``until``."""
    return F.when(col(ts) <= ntz(until), col(value) + adj).otherwise(col(value))


def depth_class(text) -> Column:
    """FN-8.  ``depth = x``: below 0 air, up to 1 upper, else lower."""
    d = F.regexp_extract(F.lower(col(text)), r"depth\s*=\s*(-?\d+(?:\.\d+)?)", 1)
    x = F.when(d != "", d).try_cast("double")
    bad = F.raise_error(F.concat(F.lit("no depth in: "), F.coalesce(col(text), F.lit("")))).cast("string")
    return F.when(x.isNull(), bad).when(x < 0, "air").when(x <= 1, "upper").otherwise("lower")


def normalize_gate_state(text) -> Column:
    """FN-9."""
    return F.coalesce(_map(GATE_STATES)[F.upper(F.trim(col(text)))], col(text))


def normalize_action(text) -> Column:
    """FN-10."""
    t = F.lower(F.trim(col(text)))
    return (F.when(t.rlike(r"partial"), "partially open").when(t.rlike(r"clos"), "closed").when(t.rlike(r"open"), "open")
            .when(t.isin("-", ""), "no action").otherwise(t))


DATE_FORMATS = ("M/d/yyyy H:mm", "M/d/yy H:mm", "yyyy-MM-dd HH:mm:ss", "M/d/yyyy")


def parse_any_datetime(text, formats=DATE_FORMATS) -> Column:
    """FN-11.  First format that parses, else NULL.  Two-digit years 69 to 99 are
    of the last century."""
    out = []
    for f in formats:
        t = F.try_to_timestamp(F.trim(col(text)), F.lit(f)).cast("timestamp_ntz")
        if "yy" in f and "yyyy" not in f:
            t = F.when(F.year(t) > 2068, t - F.expr("INTERVAL 100 YEARS")).otherwise(t)
        out.append(t)
    return F.coalesce(*out)


def append_note(comment, text) -> Column:
    """FN-12.  ``gate N`` of the text before the comment, unless it is there; ``-`` is empty."""
    c = F.when(F.trim(F.coalesce(col(comment), F.lit(""))) == "-", F.lit("")).otherwise(F.coalesce(col(comment), F.lit("")))
    gate = F.lower(F.regexp_extract(F.lower(col(text)), r"gate\s+\d+", 0))
    return F.when((gate == "") | F.lower(c).contains(gate), c).when(c == "", gate).otherwise(F.concat_ws(" ", gate, c))


def one_line(text) -> Column:
    """FN-13."""
    return F.regexp_replace(col(text), r"[\r\n]+", " ")


def clean_number(text) -> Column:
    """FN-14.  Unit text, thousands commas and leading zeros removed; bad text NULL."""
    t = F.regexp_replace(F.trim(col(text)), r"(?i)\s*cfs\s*", "")
    t = F.regexp_replace(F.regexp_replace(t, ",", ""), r"^0+(?=\d)", "")
    return F.when(t != "", t).try_cast("double")


def station_kind(station) -> Column:
    """FN-15.  Seven digits are a tide and current station, else a buoy."""
    return F.when(col(station).cast("string").rlike(r"^\d{7}$"), "tidecurrent").otherwise("buoy")


def clip_interval(start, end, lo, hi, now=None) -> tuple[Column, Column]:
    """FN-16.  Interval cut to [lo, hi]; an open end means now."""
    e = F.coalesce(col(end), now if now is not None else F.localtimestamp())
    return F.greatest(col(start), lo), F.least(e, hi)


def normalize_column_names(df: DataFrame, order=None) -> DataFrame:
    """FN-17.  Lower case, spaces to ``_``; reorder to ``order``, missing ones NULL."""
    d = df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])
    if order is None:
        return d
    return d.select(*[F.col(c) if c in d.columns else F.lit(None).cast("string").alias(c) for c in order])


def single_value_column(df: DataFrame) -> DataFrame:
    """FN-17.  The one column whose name is a spelling of ``value`` gets that name."""
    same = [c for c in df.columns if c.strip().lower() == "value"]
    if len(same) > 1:
        raise ValueError(f"several value columns: {same}")
    return df.withColumnRenamed(same[0], "value") if same else df


def map_param(df: DataFrame, mapping: DataFrame, name="src_param", strict=True) -> DataFrame:
    """FN-18.  Provider name to canonical ``param``.  Blank names and names mapped
    to NULL are dropped; a name without a mapping row is an error."""
    d = df.filter(F.trim(F.coalesce(F.col(name), F.lit(""))) != "")
    m = mapping.select(F.col("src_name").alias(name), "param", F.lit(True).alias("__known"))
    j = d.join(m, name, "left")
    if strict:
        require_empty(j.filter("__known IS NULL").select(name).distinct(), "unknown parameter names")
    return j.filter("__known AND param IS NOT NULL").drop("__known")
