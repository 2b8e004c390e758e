"""Solids as predicates over points. A boolean of solids is a boolean expression, evaluated in one pass by codegen."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from solidspark.errors import ErrorCode, SolidError
from solidspark.functions import affine

Box = tuple[tuple[float, float, float], tuple[float, float, float]]


class Solid:
    def contains(self, x: Column, y: Column, z: Column) -> Column:
        raise NotImplementedError

    def bounds(self) -> Box:
        """Corners of a box around the solid (exact for primitives)."""
        raise NotImplementedError

    def __or__(self, other: Solid) -> Solid:
        return Unite((self, other))

    def __and__(self, other: Solid) -> Solid:
        return Intersect(self, other)

    def __sub__(self, other: Solid) -> Solid:
        return Subtract(self, other)

    def moved(self, dx: float, dy: float, dz: float) -> Solid:
        return Moved(self, lambda p: affine.move(p, -dx, -dy, -dz), lambda b: tuple((c[0] + dx, c[1] + dy, c[2] + dz) for c in b))

    def rotated(self, degrees: float, axis: tuple[float, float, float]) -> Solid:
        affine.rotate((F.lit(0.0),) * 3, degrees, axis)  # checks the axis
        r = math.sqrt(3) * max(abs(v) for c in self.bounds() for v in c)
        return Moved(self, lambda p: affine.rotate(p, -degrees, axis), lambda b: ((-r,) * 3, (r,) * 3))

    def scaled(self, about: tuple[float, float, float], factors: tuple[float, float, float]) -> Solid:
        if not all(factors):
            raise SolidError(ErrorCode.INVALID_ARGUMENT, "zero factor")

        def box(b: Box) -> Box:
            ends = [sorted(o + (c[i] - o) * s for c in b) for i, (o, s) in enumerate(zip(about, factors, strict=True))]
            return tuple(e[0] for e in ends), tuple(e[1] for e in ends)

        return Moved(self, lambda p: affine.scale(p, about, tuple(1 / f for f in factors)), box)

    def section(self, normal: tuple[float, float, float], offset: float, reverse: bool = False) -> Solid:
        return Section(self, normal, offset, reverse)


def _positive(**sizes: float) -> None:
    for name, value in sizes.items():
        if value <= 0:
            raise SolidError(ErrorCode.INVALID_ARGUMENT, f"{name} must be > 0")


@dataclass(frozen=True)
class Brick(Solid):
    """Centred at the origin; y and z both 0 make a cube."""

    x: float
    y: float = 0
    z: float = 0

    def __post_init__(self):
        if self.y == 0 and self.z == 0:
            object.__setattr__(self, "y", self.x)
            object.__setattr__(self, "z", self.x)
        _positive(x=self.x, y=self.y, z=self.z)

    def contains(self, x, y, z):
        return (F.abs(x) <= F.lit(self.x / 2)) & (F.abs(y) <= F.lit(self.y / 2)) & (F.abs(z) <= F.lit(self.z / 2))

    def bounds(self):
        h = (self.x / 2, self.y / 2, self.z / 2)
        return tuple(-v for v in h), h


@dataclass(frozen=True)
class Cylinder(Solid):
    """Along z, centred; a minor radius of 0 is the major one."""

    height: float
    major: float
    minor: float = 0

    def __post_init__(self):
        _positive(height=self.height, major=self.major)

    def contains(self, x, y, z):
        a, b = float(self.major), float(self.minor or self.major)
        return ((x / F.lit(a)) * (x / F.lit(a)) + (y / F.lit(b)) * (y / F.lit(b)) <= F.lit(1.0)) & (F.abs(z) <= F.lit(self.height / 2))

    def bounds(self):
        h = (self.major, self.minor or self.major, self.height / 2)
        return tuple(-v for v in h), h


@dataclass(frozen=True)
class Cone(Solid):
    """Base at z = -height / 2; the top radius is along the major axis, 0 for a point."""

    height: float
    major: float
    minor: float = 0
    top: float = 0

    def __post_init__(self):
        _positive(height=self.height, major=self.major)

    def contains(self, x, y, z):
        a, b, h = float(self.major), float(self.minor or self.major), float(self.height)
        s = F.lit(1.0) + F.lit(self.top / a - 1) * (z + F.lit(h / 2)) / F.lit(h)
        return ((x / F.lit(a)) * (x / F.lit(a)) + (y / F.lit(b)) * (y / F.lit(b)) <= s * s) & (F.abs(z) <= F.lit(h / 2))

    def bounds(self):
        s = max(1.0, self.top / self.major)
        h = (s * self.major, s * (self.minor or self.major), self.height / 2)
        return tuple(-v for v in h), h


@dataclass(frozen=True)
class Sphere(Solid):
    radius: float

    def contains(self, x, y, z):
        return x * x + y * y + z * z <= F.lit(float(self.radius) ** 2)

    def bounds(self):
        return (-self.radius,) * 3, (self.radius,) * 3


@dataclass(frozen=True)
class Torus(Solid):
    """About z; a minor radius of the major one or more closes the hole."""

    major: float
    minor: float

    def __post_init__(self):
        _positive(major=self.major, minor=self.minor)

    def contains(self, x, y, z):
        d = F.sqrt(x * x + y * y) - F.lit(float(self.major))
        return d * d + z * z <= F.lit(float(self.minor) ** 2)

    def bounds(self):
        r = self.major + self.minor
        return (-r, -r, -self.minor), (r, r, self.minor)


@dataclass(frozen=True)
class Unite(Solid):
    parts: tuple[Solid, ...]

    def __post_init__(self):
        if not self.parts or not all(isinstance(p, Solid) for p in self.parts):
            raise SolidError(ErrorCode.INVALID_ARGUMENT, "only solids can be united")

    def contains(self, x, y, z):
        out = F.lit(False)
        for p in self.parts:
            out = out | p.contains(x, y, z)
        return out

    def bounds(self):
        boxes = [p.bounds() for p in self.parts]
        return tuple(min(b[0][i] for b in boxes) for i in range(3)), tuple(max(b[1][i] for b in boxes) for i in range(3))


@dataclass(frozen=True)
class Intersect(Solid):
    a: Solid
    b: Solid

    def contains(self, x, y, z):
        return self.a.contains(x, y, z) & self.b.contains(x, y, z)

    def bounds(self):
        (a0, a1), (b0, b1) = self.a.bounds(), self.b.bounds()
        low, high = tuple(map(max, a0, b0)), tuple(map(min, a1, b1))
        if any(h < v for v, h in zip(low, high, strict=True)):
            raise SolidError(ErrorCode.FAILURE, "empty intersection")
        return low, high


@dataclass(frozen=True)
class Subtract(Solid):
    blank: Solid
    tool: Solid

    def contains(self, x, y, z):
        return self.blank.contains(x, y, z) & ~self.tool.contains(x, y, z)

    def bounds(self):
        return self.blank.bounds()


@dataclass(frozen=True)
class Section(Solid):
    """The part on the normal's side of a plane at ``offset`` along the unit normal, or with ``reverse`` the other."""

    solid: Solid
    normal: tuple[float, float, float]
    offset: float
    reverse: bool = False

    def __post_init__(self):
        if not any(self.normal):
            raise SolidError(ErrorCode.INVALID_ARGUMENT, "zero normal")

    def contains(self, x, y, z):
        side = signed_distance((x, y, z), self.normal)
        return self.solid.contains(x, y, z) & (side <= F.lit(float(self.offset)) if self.reverse else side >= F.lit(float(self.offset)))

    def bounds(self):
        return self.solid.bounds()


class Moved(Solid):
    """A solid under a transform: points go back by its inverse."""

    def __init__(self, solid: Solid, back, box):
        self.solid, self.back, self.box = solid, back, box

    def contains(self, x, y, z):
        return self.solid.contains(*self.back((x, y, z)))

    def bounds(self):
        return self.box(self.solid.bounds())


def signed_distance(p: affine.Point, normal: tuple[float, float, float]) -> Column:
    """Of points from the plane through the origin, along the unit normal."""
    n = math.sqrt(sum(v * v for v in normal))
    return (p[0] * F.lit(float(normal[0])) + p[1] * F.lit(float(normal[1])) + p[2] * F.lit(float(normal[2]))) / F.lit(n)
