"""Points and geometries."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tideline.functions.numeric import fail

POINT = r"^\(\s*([^,()]+?)\s*,\s*([^,()]+?)\s*\)$"
POINT_BYTES = 25


def point(text: Column) -> Column:
    """struct<x, y> of "(x,y)"; an error for another form or a part that is no number."""
    part = lambda i: F.regexp_extract(text, POINT, i).try_cast("double")
    made = F.struct(part(1).alias("x"), part(2).alias("y"))
    known = text.rlike(POINT) & part(1).isNotNull() & part(2).isNotNull()
    return F.when(text.isNull(), F.lit(None)).when(known, made).otherwise(fail("not a point: ", text))


def hex_geometry(text: Column) -> Column:
    """struct<wkb, srid> of a hexadecimal geometry: wkb in base64, srid null."""
    return F.when(text.isNotNull(), F.struct(F.base64(F.unhex(text)).alias("wkb"), F.lit(None).cast("int").alias("srid")))


def _point_of(data: bytes) -> dict:
    if len(data) != POINT_BYTES:
        raise ValueError(f"a point has {POINT_BYTES} bytes, not {len(data)}")
    if data[4] != 1:
        raise ValueError("only little-endian points are known")
    if struct.unpack_from("<I", data, 5)[0] != 1:
        raise ValueError("not a point")
    x, y = struct.unpack_from("<dd", data, 9)
    return {"x": x, "y": y}


def _geometry_of(data: bytes) -> dict:
    if len(data) < POINT_BYTES:
        raise ValueError(f"a geometry has at least {POINT_BYTES} bytes, not {len(data)}")
    return {"wkb": data[4:], "srid": struct.unpack_from("<I" if data[4] == 1 else ">I", data, 0)[0]}


def _by_batch(one, kind: str):
    @F.pandas_udf(kind)
    def parse(batch: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(bytes(x)) if x is not None else {} for x in batch], columns=[c.split()[0] for c in kind.split(", ")])

    return parse


def binary_point(data: Column) -> Column:
    """struct<x, y> of a point with its srid, 25 bytes, little-endian. Doubles have no JVM function to unpack them."""
    return F.when(data.isNotNull(), _by_batch(_point_of, "x double, y double")(data))


def binary_geometry(data: Column) -> Column:
    """struct<wkb, srid> of a geometry with its srid in front, in the byte order of its WKB."""
    return F.when(data.isNotNull(), _by_batch(_geometry_of, "wkb binary, srid int")(data))
