"""Column catalogue for declaring point schemas."""

from __future__ import annotations

from pyspark.sql import types as T

from lidarframe.sources.layouts import ATTRIBUTES, POINT_FORMATS, column_type


def point_schema(
    *names: str, unsigned: bool = False, strict: bool = False, nullable: bool = False, exact: int | None = None
) -> T.StructType:
    """Schema of the named point attributes in the given order; without names all of them.

    With ``exact`` x, y, z are decimals with so many digits after the point, computed without doubles.
    """
    for name in names:
        if name not in ATTRIBUTES:
            raise ValueError(f"{name!r} is no point attribute; known: {', '.join(ATTRIBUTES)}")
    return T.StructType(
        [
            T.StructField(n, column_type(n, unsigned, strict, exact), nullable)
            for n in names or ATTRIBUTES
        ]
    )


def format_schema(point_format: int, unsigned: bool = False, strict: bool = False) -> T.StructType:
    """Schema of every attribute of one point format, in file order."""
    if point_format not in POINT_FORMATS:
        raise ValueError(f"unknown point format {point_format}")
    return point_schema(*POINT_FORMATS[point_format], unsigned=unsigned, strict=strict)
