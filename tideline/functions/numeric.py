"""Numbers: checked narrowing, exact decimals and their wire bytes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

INTEGERS = {"smallint": (-(1 << 15), (1 << 15) - 1), "int": (-(1 << 31), (1 << 31) - 1)}
FLOAT_MAX = 3.4028234663852886e38


def fail(*parts) -> Column:
    """An error with the parts as its text, for a branch that must not be reached."""
    return F.raise_error(F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts]))


def integer(value: Column, kind: str) -> Column:
    """Value as smallint, int or bigint; an error where it doesn't fit."""
    if kind == "bigint":
        return value.cast("bigint")
    low, high = INTEGERS[kind]
    wide = value.cast("bigint")
    return F.when(wide.isNull(), F.lit(None)).when(wide.between(low, high), wide).otherwise(fail("value overflows ", kind, ": ", wide.cast("string"))).cast(kind)


def float32(value: Column) -> Column:
    """Double as float; an error beyond float's range."""
    wide = value.cast("double")
    over = (F.abs(wide) > FLOAT_MAX) & ~F.isnan(wide) & (F.abs(wide) != float("inf"))
    return F.when(over, fail("value overflows float: ", wide.cast("string"))).otherwise(wide).cast("float")


NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
PLAIN = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)$"


def _finite(text: Column, nan_is_null: bool) -> Column:
    """The trimmed text of a number; NaN is null or an error, anything else an error."""
    known = F.when(text.rlike(NUMBER), text)
    if nan_is_null:
        known = known.when(F.upper(text) == "NAN", F.lit(None))
    return F.when(text.isNull(), F.lit(None)).otherwise(known.otherwise(fail("not a finite number: ", text)))


def fraction_digits(text: Column) -> Column:
    return F.length(F.regexp_extract(text, r"[.]([0-9]*)$", 1))


def decimal(text: Column, precision: int, scale: int) -> Column:
    """Text as decimal(precision, scale), NaN as null; an error unless it has exactly that many fraction digits.

    A number without a fraction part counts as one at scale 0.
    """
    number = _finite(text.cast("string"), True)
    same = fraction_digits(number) == scale
    wrong = fail("scale differs from ", str(scale), ": ", number)
    return F.when(number.isNull(), F.lit(None)).when(same, number).otherwise(wrong).cast(f"decimal({precision},{scale})")


def money(text: Column, scale: int = 2, trim: str = "$", commas: bool = True) -> Column:
    """Text of an amount as decimal(19, scale): currency signs trimmed at both ends, commas removed; NaN is an error."""
    bare = text.cast("string")
    if trim:
        bare = F.btrim(bare, F.lit(trim))
    if commas:
        bare = F.replace(bare, F.lit(","), F.lit(""))
    number = _finite(bare, False)
    same = fraction_digits(number) == scale
    wrong = fail("scale differs from ", str(scale), ": ", number)
    return F.when(number.isNull(), F.lit(None)).when(same, number).otherwise(wrong).cast(f"decimal(19,{scale})")


def unscaled(value: Column, scale: int) -> Column:
    """A decimal's digits as a whole number, decimal(38,0)."""
    return F.replace(F.format_string("%s", value.cast("string")), F.lit("."), F.lit("")).cast("decimal(38,0)") if scale else value.cast("decimal(38,0)")


def _bytes_needed(whole: Column) -> Column:
    """Least number of bytes of a two's complement that holds a bigint."""
    magnitude = F.when(whole < 0, -(whole + 1)).otherwise(whole)
    bits = F.when(magnitude == 0, 0).otherwise(F.length(F.bin(magnitude)))
    return F.floor(bits / 8).cast("int") + 1


def twos_complement(whole: Column) -> Column:
    """Least big-endian two's complement bytes of a bigint."""
    digits = F.lpad(F.hex(whole), 16, "0")
    return F.unhex(F.right(digits, 2 * _bytes_needed(whole)))


def from_twos_complement(data: Column, scale: int) -> Column:
    """The decimal that `twos_complement` wrote, up to eight bytes."""
    digits = F.hex(data)
    negative = F.conv(F.substring(digits, 1, 1), 16, 10).cast("int") >= 8
    padded = F.lpad(digits, 16, "0")
    filled = F.when(negative, F.concat(F.repeat(F.lit("F"), 16 - F.length(digits)), digits)).otherwise(padded)
    high, low = F.conv(F.substring(filled, 1, 8), 16, 10).cast("bigint"), F.conv(F.substring(filled, 9, 8), 16, 10).cast("bigint")
    signed = F.when(high >= (1 << 31), high - (1 << 32)).otherwise(high)
    whole = signed.cast("decimal(38,0)") * F.lit(1 << 32).cast("decimal(11,0)") + low.cast("decimal(11,0)")
    return (whole.cast("decimal(28,0)") / F.lit(10**scale).cast("decimal(19,0)")).cast(f"decimal(28,{scale})")


def decimal_bytes(value: Column, precision: int, scale: int) -> Column:
    """Wire bytes of a decimal: its unscaled value as least big-endian two's complement.

    Up to 18 digits stay inside the JVM; wider ones are split into 9-digit limbs in Python, by Arrow batches.
    """
    if precision <= 18:
        return twos_complement(F.round(value * F.lit(10**scale).cast("decimal(19,0)"), 0).cast("decimal(38,0)").cast("bigint")) if scale else twos_complement(value.cast("bigint"))
    return _wide_bytes(value.cast("string"))


def _encode(text: str | None) -> bytes | None:
    if text is None:
        return None
    whole = int(text.replace(".", ""))
    magnitude = -(whole + 1) if whole < 0 else whole
    return whole.to_bytes(magnitude.bit_length() // 8 + 1, "big", signed=True)


def _wide_bytes(text: Column) -> Column:
    @F.pandas_udf("binary")
    def encode(batch: pd.Series) -> pd.Series:
        return batch.map(_encode, na_action="ignore")

    return encode(text)


def variable_numeric(text: Column) -> Column:
    """struct<scale, value> of a number's own scale, NaN as null."""
    number = _finite(text.cast("string"), True)
    mantissa = F.when(number.rlike(PLAIN), number).otherwise(F.when(number.isNotNull(), fail("exponents have no scale of their own: ", number)))
    return F.when(number.isNotNull(), F.struct(fraction_digits(mantissa).cast("int").alias("scale"), _wide_bytes(mantissa).alias("value")))
