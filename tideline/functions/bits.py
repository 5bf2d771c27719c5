"""Bit strings and booleans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tideline.functions.numeric import fail


def _little_endian(bits: Column) -> Column:
    """Bytes of a text of 0s and 1s, lowest first, without zero bytes at the end; any length."""
    padded = F.concat(F.repeat(F.lit("0"), F.pmod(-F.length(bits), F.lit(8))), bits)
    octets = F.regexp_extract_all(padded, F.lit("([01]{8})"), F.lit(1))
    digits = F.array_join(F.transform(F.reverse(octets), lambda o: F.lpad(F.conv(o, 2, 16), 2, "0")), "")
    return F.unhex(F.regexp_replace(digits, r"^((?:..)*?)(?:00)*$", "$1"))


def _checked(bits: Column, good: Column, size: int) -> Column:
    return F.when(bits.isNull(), F.lit(None)).when(~bits.rlike("^[01]*$"), fail("not a bit string: ", bits)).when(good, bits).otherwise(fail("length differs from bit size ", str(size), ": ", bits))


def bit(bits: Column, size: int) -> Column:
    """bit(n) from a text of n digits: boolean for n = 1, else little-endian bytes."""
    if size < 1:
        raise ValueError("bit size must be at least 1")
    text = _checked(bits, F.length(bits) == size, size)
    return text == "1" if size == 1 else _little_endian(text)


def bit_varying(bits: Column, size: int = 0) -> Column:
    """bit varying(n) as little-endian bytes; 0: any length."""
    return _little_endian(_checked(bits, F.length(bits) <= size if size else F.lit(True), size))


def bit_bytes(data: Column, size: int) -> Column:
    """A binary bit(n) value: boolean for n = 1 (one byte, 0 or 1), else the bytes."""
    if size != 1:
        return data
    digits = F.hex(data)
    return F.when(data.isNull(), F.lit(None)).when(digits.isin("00", "01"), digits == "01").otherwise(fail("not one bit: ", digits))


def flag(value: Column) -> Column:
    """0 or 1 as boolean; an error otherwise."""
    number = value.cast("bigint")
    return F.when(number.isNull(), F.lit(None)).when(number.isin(0, 1), number == 1).otherwise(fail("not a boolean: ", number.cast("string")))
