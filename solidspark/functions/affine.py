"""Transforms of points as column expressions: (x, y, z) in, (x, y, z) out."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from solidspark.errors import ErrorCode, SolidError

Point = tuple[Column, Column, Column]


def move(p: Point, dx: float, dy: float, dz: float) -> Point:
    return p[0] + F.lit(float(dx)), p[1] + F.lit(float(dy)), p[2] + F.lit(float(dz))


def scale(p: Point, about: tuple[float, float, float], factors: tuple[float, float, float]) -> Point:
    """About a point."""
    return tuple(F.lit(float(o)) + (c - F.lit(float(o))) * F.lit(float(s)) for c, o, s in zip(p, about, factors, strict=True))


def rotate(p: Point, degrees: float, axis: tuple[float, float, float]) -> Point:
    """Rodrigues' rotation about an axis through the origin; a zero axis is an invalid argument."""
    length = math.sqrt(sum(a * a for a in axis))
    if not length:
        raise SolidError(ErrorCode.INVALID_ARGUMENT, "zero axis")
    k = [a / length for a in axis]
    c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    rows = [[c * (i == j) + (1 - c) * k[i] * k[j] + s * e for j, e in enumerate(row)] for i, row in enumerate(([0, -k[2], k[1]], [k[2], 0, -k[0]], [-k[1], k[0], 0]))]
    return tuple(F.lit(r[0]) * p[0] + F.lit(r[1]) * p[1] + F.lit(r[2]) * p[2] for r in rows)


def reflect(p: Point, at: tuple[float, float, float], normal: tuple[float, float, float]) -> Point:
    """In the plane through ``at``; a zero normal is an invalid argument."""
    nn = sum(n * n for n in normal)
    if not nn:
        raise SolidError(ErrorCode.INVALID_ARGUMENT, "zero normal")
    d = sum(((c - F.lit(float(o))) * F.lit(float(n)) for c, o, n in zip(p, at, normal, strict=True)), F.lit(0.0))
    return tuple(c - F.lit(2.0) * d / F.lit(float(nn)) * F.lit(float(n)) for c, n in zip(p, normal, strict=True))


def flips(factors: tuple[float, float, float] = (1, 1, 1), mirrored: bool = False) -> bool:
    """Whether a transform turns triangles inside out, so that connectivity is to be reversed."""
    return mirrored != (math.prod(factors) < 0)
