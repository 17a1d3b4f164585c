"""Number expressions: grammar, extraction, numeric coercion, text form of floats.

Dirty text is always tested against an ASCII grammar before it is cast, because SQL casts accept
more ('1d', '0x1p3') than a number in a data file should.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import defaults

NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER = r"^[+-]?[0-9]+$"
INT64_LIMIT = 9.223372036854775807e18


def ascii_digits(c: Column) -> Column:
    """Devanagari digits to ASCII digits."""
    return F.translate(c, "०१२३४५६७८९", "0123456789")


def undecorated(c: Column, decoration: str = defaults.NUMBER_DECORATION) -> Column:
    """The cell without separators and currency signs, inner spaces kept."""
    return F.trim(F.translate(c, decoration, ""))


def looks_numeric(c: Column, decoration: str = defaults.NUMBER_DECORATION) -> Column:
    return undecorated(c, decoration).rlike(NUMBER)


def extract_int(c: Column, decoration: str = defaults.NUMBER_DECORATION) -> Column:
    """The integer in a decorated cell, NULL when there is none or it exceeds 64 bits."""
    bare = F.translate(c, decoration + " ", "")
    return F.when(bare.rlike(INTEGER), bare.try_cast("bigint"))


def extract_float(c: Column, decoration: str = defaults.NUMBER_DECORATION) -> Column:
    """The float in a decorated cell; only numbers written with a point qualify."""
    bare = F.translate(c, decoration + " ", "")
    return F.when(F.contains(bare, F.lit(".")) & bare.rlike(NUMBER), bare.try_cast("double"))


def parse_cells(df: DataFrame, cells: dict[str, str], decoration: str = defaults.NUMBER_DECORATION) -> DataFrame:
    """Adds, per cleaned text cell `v` and tag `t` in `cells`, the columns `t_hit`, `t_int`, `t_point`
    and `t_plain`: number-like?, extracted integer, extracted float, value without extraction.

    One pass over the characters and one regular expression serve all four.
    """
    bare = {t: F.replace(F.col(f"{t}_text"), F.lit(" "), F.lit("")) for t in cells}
    df = df.select("*", *[undecorated(F.col(v), decoration).alias(f"{t}_text") for t, v in cells.items()])
    df = df.select("*", *[bare[t].alias(f"{t}_bare") for t in cells])
    df = df.select("*", *[F.col(f"{t}_bare").rlike(NUMBER).alias(f"{t}_num") for t in cells])
    out = []
    for t, v in cells.items():
        text, number, is_number = F.col(f"{t}_text"), F.col(f"{t}_bare"), F.col(f"{t}_num")
        point = F.contains(number, F.lit("."))
        out += [(is_number & (text == number)).alias(f"{t}_hit"),
                F.when(is_number & ~point, number.try_cast("bigint")).alias(f"{t}_int"),
                F.when(is_number & point, number.try_cast("double")).alias(f"{t}_point"),
                F.when(is_number & (F.col(v) == number), number.try_cast("double")).alias(f"{t}_plain")]
    gone = {f"{t}_{k}" for t in cells for k in ("text", "bare", "num")}
    return df.select(*[c for c in df.columns if c not in gone], *out)


def coerce_double(c: Column, dtype: T.DataType) -> Column:
    """Any column as DOUBLE; text that is no number becomes NULL, NaN too."""
    if isinstance(dtype, T.StringType):
        bare = F.trim(c)
        return F.when(bare.rlike(NUMBER), bare.try_cast("double"))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), c.cast("double"))
    if isinstance(dtype, (T.IntegralType, T.DecimalType, T.BooleanType)):
        return c.cast("double")
    return F.lit(None).cast("double")


def is_whole(d: Column) -> Column:
    """Is a DOUBLE an integer that fits 64 bits?"""
    return (d == F.floor(d)) & (F.abs(d) < INT64_LIMIT)


def float_text(c: Column) -> Column:
    """Shortest decimal text of a double: plain from 1e-4 to below 1e16, else `1.5e-05` style."""
    raw = c.cast("string")
    size = F.abs(c)
    plain = F.rtrim(raw.try_cast("decimal(38,21)").cast("string"), F.lit("0"))
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    mantissa = F.regexp_replace(F.substring_index(raw, "E", 1), r"\.0$", "")
    exponent = F.substring_index(raw, "E", -1).try_cast("int")
    digits = F.lpad(F.abs(exponent).cast("string"), 2, "0")
    digits = F.when(F.abs(exponent) > 99, F.abs(exponent).cast("string")).otherwise(digits)
    sign = F.when(exponent < 0, F.lit("-")).otherwise(F.lit("+"))
    scientific = F.concat(mantissa, F.lit("e"), sign, digits)
    return (
        F.when(F.contains(raw, F.lit("E")),
               F.when((size >= 1e-4) & (size < 1e16), plain).otherwise(scientific))
        .otherwise(raw)
    )


def as_text(c: Column, dtype: T.DataType) -> Column:
    """Text form of a typed cell: floats as above, booleans as `True`/`False`."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return float_text(c.cast("double"))
    if isinstance(dtype, T.BooleanType):
        return F.initcap(c.cast("string"))
    return c.cast("string")


def half_even(c: Column, digits: int = 2) -> Column:
    scale = float(10 ** digits)
    return F.rint(c * scale) / scale
