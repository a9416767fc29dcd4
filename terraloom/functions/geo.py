"""ST_* functions on WKB columns: Arrow-batched Python where Spark has no expression."""

from __future__ import annotations

import math
import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, StringType

from ..geometry import assembly, wkb

#: Radius of the sphere of the Mercator projection, and the latitude at which its square ends.
RADIUS = 6378137.0
MERCATOR_LIMIT = 85.05112877980659


@F.pandas_udf(StringType())
def st_astext(g: pd.Series) -> pd.Series:
    """Well-known text; null gives an empty string."""
    return g.map(lambda b: "" if b is None else wkb.to_text(*wkb.load(b)))


@F.pandas_udf(BooleanType())
def st_isempty(g: pd.Series) -> pd.Series:
    """Whether the geometry has no point; null counts as empty."""
    return g.map(lambda b: True if b is None else wkb.is_empty(*wkb.load(b)))


@F.pandas_udf(BooleanType())
def st_isvalid(g: pd.Series) -> pd.Series:
    """Whether the geometry is valid; null is not."""
    return g.map(lambda b: False if b is None else assembly.valid(*wkb.load(b)))


@F.pandas_udf(BinaryType())
def st_point(x: pd.Series, y: pd.Series) -> pd.Series:
    """WKB of a point; null if a coordinate is null or not a number."""
    return pd.Series([None if pd.isna(a) or pd.isna(b) else struct.pack("<BIdd", 1, 1, a, b) for a, b in zip(x, y, strict=True)], dtype=object)


def mercator(p: np.ndarray) -> np.ndarray:
    """Longitude and latitude in degrees to metres of spherical (web) Mercator."""
    lat = np.clip(p[:, 1], -MERCATOR_LIMIT, MERCATOR_LIMIT)
    return np.column_stack([RADIUS * np.radians(p[:, 0]), RADIUS * np.log(np.tan(math.pi / 4 + np.radians(lat) / 2))])


def unmercator(p: np.ndarray) -> np.ndarray:
    return np.column_stack([np.degrees(p[:, 0] / RADIUS), np.degrees(2 * np.arctan(np.exp(p[:, 1] / RADIUS)) - math.pi / 2)])


PROJECTIONS = {3857: mercator, 4326: lambda p: p}


def st_transform(g: Column, srid: int = 3857) -> Column:
    """WKB in degrees as WKB in the projection with this code (3857 or 4326); null gives null."""
    project = PROJECTIONS[srid]

    @F.pandas_udf(BinaryType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda b: None if b is None else wkb.dump(*wkb.transform(*wkb.load(b), project)))

    return run(g)


@F.pandas_udf(BinaryType())
def st_transform_to(g: pd.Series, srid: pd.Series) -> pd.Series:
    """st_transform with the projection's code as a column; an unknown code raises."""
    return pd.Series([None if b is None else wkb.dump(*wkb.transform(*wkb.load(b), PROJECTIONS[int(k)])) for b, k in zip(g, srid, strict=True)], dtype=object)


def mercator_x(lon: Column) -> Column:
    """Native: metres east."""
    return F.lit(RADIUS) * F.radians(lon)


def mercator_y(lat: Column) -> Column:
    """Native: metres north, clipped to the square."""
    lat = F.greatest(F.least(lat, F.lit(MERCATOR_LIMIT)), F.lit(-MERCATOR_LIMIT))
    return F.lit(RADIUS) * F.ln(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2))
