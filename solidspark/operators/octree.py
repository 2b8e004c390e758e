"""Booleans of primitives, many solids at once: whether anything is left, in how many pieces, in which box.

A solid is a table of terms that are applied in order: ``unite``, ``subtract`` or ``intersect``, each a primitive at a
place. Space around a solid is halved along all axes again and again. Interval arithmetic tells, for a whole cell, that a
term holds all of it (1), nothing of it (-1), or may hold a part (0); a boolean of these three is their maximum, their minimum,
or the minimum with the second one turned. Only cells that are undecided go on to the next round, so the cells grow with the
surface and not with the volume; in the last round a cell counts by its centre. What is left is a set of cells of several
sizes, whose pieces are components over common faces: found within tiles of 2**TILE cells along an axis by the task that makes them,
and between tiles by joins of their outer cells."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solidspark.errors import ErrorCode
from solidspark.operators.components import smallest_reachable
from solidspark.skew import shuffled
from solidspark.staging import stage

#: What a term is made of; sizes as in :data:`solidspark.operators.faceting.KINDS`.
TERM = "solid_id long, ord int, op string, kind string, a double, b double, c double, d double, dx double, dy double, dz double"


KINDS = ("brick", "sphere", "cylinder", "cone", "torus")
OPS = ("unite", "subtract", "intersect")
#: Numbers of a term, as they are laid one behind the other.
NUMBERS = ("a", "b", "c", "d", "dx", "dy", "dz")
#: Levels that are told apart before cells are dealt to tasks (so that a large solid is not one task), and cells that a task tests at a time.
START, MOST = 2, 1 << 15
#: A tile is a cell that many levels above the last one; so many are labelled at a time.
TILE, TILES = 4, 256


def _square(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest square of an interval."""
    return np.where((low <= 0) & (high >= 0), 0.0, np.minimum(low * low, high * high)), np.maximum(low * low, high * high)


def term_state(kind: str, n: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """1, 0 or -1: whether a term holds all of a box (rows of low and high corners), perhaps some, or none of it.

    n: the term's NUMBERS, a row for each box. Where one that is needed is missing nothing is held for certain."""
    a, b, c, d = n[:, :4].T
    (x0, y0, z0), (x1, y1, z1) = (low - n[:, 4:]).T, (high - n[:, 4:]).T
    inside = lambda lo, hi, h: (lo >= -h) & (hi <= h)
    apart = lambda lo, hi, h: (hi < -h) | (lo > h)
    (xl, xh), (yl, yh), (zl, zh) = _square(x0, x1), _square(y0, y1), _square(z0, z1)
    if kind == "brick":
        all_, none = inside(x0, x1, a / 2) & inside(y0, y1, b / 2) & inside(z0, z1, c / 2), apart(x0, x1, a / 2) | apart(y0, y1, b / 2) | apart(z0, z1, c / 2)
    elif kind == "sphere":
        all_, none = xh + yh + zh <= a * a, xl + yl + zl > a * a
    elif kind == "torus":
        dl, dh = _square(np.sqrt(xl + yl) - a, np.sqrt(xh + yh) - a)
        all_, none = dh + zh <= b * b, dl + zl > b * b
    else:
        small = np.where(c > 0, c, b)
        least, greatest = xl / (b * b) + yl / (small * small), xh / (b * b) + yh / (small * small)
        thin = wide = np.ones(len(n))
        if kind == "cone":  # its radius runs straight from 1 at the base to the top's share of it
            ends = [1 + (d / b - 1) * (np.clip(z, -a / 2, a / 2) + a / 2) / a for z in (z0, z1)]
            thin, wide = np.minimum(*ends), np.maximum(*ends)
        all_, none = (greatest <= thin * thin) & inside(z0, z1, a / 2), (least > wide * wide) | apart(z0, z1, a / 2)
    return np.where(all_, 1, np.where(none, -1, 0))


def solid_state(codes: np.ndarray, numbers: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """What terms in order make of boxes. codes: a row of them for each box, -1 where there are no more."""
    state = np.full(len(low), -1)
    with np.errstate(all="ignore"):
        for k in range(codes.shape[1]):
            for code in np.unique(codes[:, k]):
                if code < 0:
                    continue
                of = np.flatnonzero(codes[:, k] == code)
                s, op = term_state(KINDS[code % len(KINDS)], numbers[of, k], low[of], high[of]), OPS[code // len(KINDS)]
                state[of] = np.minimum(state[of], -s) if op == "subtract" else np.minimum(state[of], s) if op == "intersect" else np.maximum(state[of], s)
    return state


def _boxes(terms: DataFrame) -> DataFrame:
    """(solid_id, lx, ly, lz, wx, wy, wz, terms): the box around all terms that can add to a solid, and its terms in order."""
    k, (a, b, c, d) = F.col("kind"), (F.col(x) for x in "abcd")
    small = F.when(c > 0, c).otherwise(b)
    grow = F.greatest(F.lit(1.0), F.try_divide(d, b))
    pick = lambda brick, cylinder, cone, sphere, torus: F.when(k == "brick", brick).when(k == "cylinder", cylinder).when(k == "cone", cone).when(k == "sphere", sphere).when(k == "torus", torus)
    half = {"x": pick(a / 2, b, b * grow, a, a + b), "y": pick(b / 2, small, small * grow, a, a + b), "z": pick(c / 2, a / 2, a / 2, a, b)}
    adds = F.col("op") == "unite"
    low = [F.min(F.when(adds, F.col(f"d{x}") - h)).alias(f"l{x}") for x, h in half.items()]
    high = [F.max(F.when(adds, F.col(f"d{x}") + h)).alias(f"h{x}") for x, h in half.items()]
    each = F.array_sort(F.collect_list(F.struct("ord", "op", "kind", *"abcd", "dx", "dy", "dz"))).alias("terms")  # as many as the solid was made of
    found = terms.groupBy("solid_id").agg(*low, *high, each)
    return found.select("solid_id", "lx", "ly", "lz", *[(F.col(f"h{x}") - F.col(f"l{x}")).alias(f"w{x}") for x in "xyz"], "terms")


def _code(level: int | np.ndarray, at: np.ndarray) -> np.ndarray:
    """A cell as one number, for levels under 16."""
    return (np.int64(level) << 48) + (at[:, 0] << 32) + (at[:, 1] << 16) + at[:, 2]


def _labels(held: np.ndarray) -> np.ndarray:
    """The least place of each cell's component in its tile, over grids (tile, x, y, z) of what is held; others: the number of places."""
    none = np.int64(held[0].size)
    out = np.where(held, np.arange(none).reshape(held.shape[1:])[None], none)
    while True:
        least = out.copy()
        for axis in (1, 2, 3):
            ahead, back = [slice(None)] * 4, [slice(None)] * 4
            ahead[axis], back[axis] = slice(1, None), slice(None, -1)
            ahead, back = tuple(ahead), tuple(back)
            np.minimum(least[ahead], least[back], out=least[ahead])
            np.minimum(least[back], least[ahead], out=least[back])
            least[~held] = none
        if (least == out).all():
            return out
        out = least


def _held(frame: pd.DataFrame, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(level, row of ``frame``, place, piece) of the cells that are held, for cells of one level in; depth first, so that a task has few
    cells at a time. No piece comes in two yields."""
    top = max(0, depth - TILE)
    origin, width = frame[["lx", "ly", "lz"]].to_numpy(float), frame[["wx", "wy", "wz"]].to_numpy(float)
    most = max(map(len, frame["codes"]))
    codes = np.full((len(frame), most), -1)
    numbers = np.full((len(frame), most, len(NUMBERS)), np.nan)
    for k, (c, v) in enumerate(zip(frame["codes"], frame["numbers"], strict=True)):
        codes[k, : len(c)], numbers[k, : len(c)] = c, np.asarray(v, float).reshape(-1, len(NUMBERS))

    def tested(level: int, own: np.ndarray, at: np.ndarray) -> np.ndarray:
        off = (0.5, 0.5) if level == depth else (0.0, 1.0)
        low, high = (origin[own] + width[own] * (at + o) / 2**level for o in off)
        return solid_state(codes[own], numbers[own], low, high)

    def tiles(own: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        side, found = 2 ** (depth - top), []
        grid = np.zeros((len(own), side, side, side), bool)
        tile, below = np.arange(len(own)), at
        for level in range(top, depth + 1):
            state, size = np.concatenate([tested(level, own[tile[k : k + MOST]], below[k : k + MOST]) for k in range(0, len(tile), MOST)]), 2 ** (depth - level)
            t, c = tile[state == 1], below[state == 1]
            local = (c - (at[t] << (level - top))) * size
            found.append((np.full(len(t), level), t, c, local))
            step = np.indices((size,) * 3).reshape(3, -1).T
            x, y, z = (local[:, None, :] + step[None]).reshape(-1, 3).T
            grid[np.repeat(t, len(step)), x, y, z] = True
            tile, below = _children(tile[state == 0], below[state == 0])
            if not len(tile):
                break
        labels = _labels(grid)
        level, t, c, local = map(np.concatenate, zip(*found, strict=True))
        if len(t):
            first = labels[t, local[:, 0], local[:, 1], local[:, 2]]
            place = np.stack(np.unravel_index(first, (side,) * 3), 1) + at[t] * side
            yield level, own[t], c, _code(depth, place)

    todo = [(int(frame["level"].iloc[0]), np.arange(len(frame)), frame[["ix", "iy", "iz"]].to_numpy(np.int64))]
    while todo:
        level, own, at = todo.pop()
        n = TILES if level == top else MOST
        if len(own) > n:
            todo.append((level, own[n:], at[n:]))
            own, at = own[:n], at[:n]
        if level == top:
            yield from tiles(own, at)
            continue
        state = tested(level, own, at)
        if (state == 1).any():
            yield np.full((state == 1).sum(), level), own[state == 1], at[state == 1], _code(level, at[state == 1])
        if (state == 0).any():
            todo.append((level + 1, *_children(own[state == 0], at[state == 0])))


CELL = "solid_id long, level int, ix int, iy int, iz int, piece long"
#: What many cells of a solid come to: pieces (within tiles), cells of the last level, box.
SUM = "n_pieces long, n_cells long, min_x double, min_y double, min_z double, max_x double, max_y double, max_z double"


def _cells(solid: np.ndarray, level: np.ndarray, at: np.ndarray, piece: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"solid_id": solid, "level": level, "ix": at[:, 0], "iy": at[:, 1], "iz": at[:, 2], "piece": piece})


def _refine(depth: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Cells of one level in, those of it and below that are held out."""

    def refine(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in filter(len, frames):
            solid = frame["solid_id"].to_numpy()
            for level, own, at, piece in _held(frame, depth):
                yield _cells(solid[own], level, at, piece)

    return refine


def _summed(depth: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Cells of one level in; out one row of SUM for each that holds anything, and, where there are many tiles, the cells that those of another may touch."""
    top = max(0, depth - TILE)
    columns = [c.split()[0] for c in f"{CELL}, {SUM}".split(", ")]

    def summed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in filter(len, frames):
            solid, origin, width = frame["solid_id"].to_numpy(), frame[["lx", "ly", "lz"]].to_numpy(float), frame[["wx", "wy", "wz"]].to_numpy(float)
            n_pieces, n_cells = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
            low, high = np.full((len(frame), 3), np.inf), np.full((len(frame), 3), -np.inf)
            for level, own, at, piece in _held(frame, depth):
                np.add.at(n_pieces, pd.DataFrame({"own": own, "piece": piece}).drop_duplicates()["own"].to_numpy(), 1)
                np.add.at(n_cells, own, np.int64(1) << (3 * (depth - level)))
                n = (2**level)[:, None]
                np.minimum.at(low, own, origin[own] + width[own] * at / n)
                np.maximum.at(high, own, origin[own] + width[own] * (at + 1) / n)
                if top:
                    last = (1 << np.maximum(level - top, 0))[:, None] - 1
                    outer = ((at & last == 0) | (at & last == last)).any(axis=1)
                    yield _cells(solid[own[outer]], level[outer], at[outer], piece[outer]).reindex(columns=columns)
            of = n_cells > 0
            sums = pd.DataFrame({"solid_id": solid, "n_pieces": n_pieces, "n_cells": n_cells, **{f"min_{x}": low[:, k] for k, x in enumerate("xyz")}, **{f"max_{x}": high[:, k] for k, x in enumerate("xyz")}})
            yield sums[of].reindex(columns=columns)

    return summed


def _children(own: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.repeat(own, 8), (2 * at[:, None, :] + EIGHT[None]).reshape(-1, 3)


EIGHT = np.array([[k % 2, k // 2 % 2, k // 4] for k in range(8)])


def _dealt(terms: DataFrame, depth: int) -> DataFrame:
    """The cells of level START of all solids, with what their solids are made of, dealt to tasks, which go on alone."""
    start = min(START, max(0, depth - TILE))
    code = lambda t: F.array_position(F.array(*map(F.lit, OPS)), t.getField("op")) * len(KINDS) + F.array_position(F.array(*map(F.lit, KINDS)), t.getField("kind")) - len(KINDS) - 1
    known = lambda t: t.getField("op").isin(*OPS) & t.getField("kind").isin(*KINDS)
    boxes = _boxes(terms).where("lx + ly + lz + wx + wy + wz is not null").withColumn("terms", F.filter("terms", known))
    flat = boxes.withColumns({"codes": F.transform("terms", code), "numbers": F.flatten(F.transform("terms", lambda t: F.array(*[t.getField(c) for c in NUMBERS])))}).drop("terms")
    cells = flat.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(8**start - 1))))
    cells = cells.withColumns({"level": F.lit(start), **{f"i{x}": F.shiftright("_k", n * start) % 2**start for n, x in enumerate("xyz")}})
    return cells.repartition("solid_id", "_k").drop("_k")


def decided(terms: DataFrame, depth: int) -> DataFrame:
    """(solid_id, level, ix, iy, iz, piece): the cells of which all belongs to the solid, at ``depth`` those whose centre does.

    terms: see ``TERM``; the first one of a solid is united with nothing, terms of unknown kinds or operations and solids without a box hold nothing.
    A cell of level n is one of 2**n along each axis of the solid's box.
    Cells with the same ``piece`` of a solid hang together in one tile; one that is larger than a tile is a piece of its own."""
    return _dealt(terms, depth).mapInPandas(_refine(depth), CELL)


def touching(cells: DataFrame, depth: int) -> DataFrame:
    """(a, b): pieces of different tiles, each as (solid_id, piece), cells of which have a face, or a part of one, in common. A cell at
    the side of its tile looks for its equals and for larger ones."""
    axes, top = [f"i{x}" for x in "xyz"], max(0, depth - TILE)
    ways = F.explode(F.array(*[F.struct(*[F.lit(s if n == k else 0).alias(c) for n, c in enumerate(axes)]) for k in range(3) for s in (-1, 1)])).alias("w")
    near = cells.select("solid_id", "piece", F.col("level").alias("own"), *axes, ways)
    near = near.select("solid_id", "piece", "own", *[F.col(c).alias(f"{c}0") for c in axes], *[(F.col(c) + F.col(f"w.{c}")).alias(c) for c in axes])
    out = " or ".join(f"shiftright({c}, own - {top}) <> shiftright({c}0, own - {top})" for c in axes)
    near = near.where(" and ".join(f"{c} >= 0 and {c} < shiftleft(1, own)" for c in axes)).where(f"own < {top} or {out}")
    up = near.select("solid_id", F.col("piece").alias("from"), *axes, "own", F.explode(F.sequence(F.lit(0), "own")).alias("level"))
    up = up.select("solid_id", "from", "level", *[F.expr(f"shiftright({c}, own - level)").alias(c) for c in axes])
    node = lambda c: F.struct("solid_id", F.col(c).alias("piece"))
    return up.join(shuffled(cells), ["solid_id", "level", *axes]).where(F.col("from") != F.col("piece")).select(node("from").alias("a"), node("piece").alias("b")).distinct()


def pieces(terms: DataFrame, depth: int = 6) -> DataFrame:
    """(solid_id, status, n_pieces, n_cells, volume, min_x, ..., max_z) of every solid of ``terms``: what its booleans leave, at a resolution of
    2**depth cells along each axis of its box.

    depth: 15 at most. An empty result is a failure, with no box. Pieces hang together over faces; the box is that of the cells that are left.
    The tasks that find the cells sum them up as well: only outer cells of tiles are rows, and none where a solid is one tile."""
    found = stage(_dealt(terms, depth).mapInPandas(_summed(depth), f"{CELL}, {SUM}"), "octree-inside")
    sides = [*[F.min(f"min_{x}").alias(f"min_{x}") for x in "xyz"], *[F.max(f"max_{x}").alias(f"max_{x}") for x in "xyz"]]
    held = found.where("n_cells is not null").groupBy("solid_id").agg(F.sum("n_pieces").alias("n_pieces"), F.sum("n_cells").alias("n_cells"), *sides)
    if depth > TILE:
        labels = smallest_reachable(touching(found.where("level is not null").select("solid_id", "level", "ix", "iy", "iz", "piece"), depth))
        joined = labels.groupBy(F.col("node.solid_id").alias("solid_id"), "component").agg((F.count("*") - 1).alias("less")).groupBy("solid_id").agg(F.sum("less").alias("less"))
        held = held.join(shuffled(joined), "solid_id", "left").withColumn("n_pieces", F.col("n_pieces") - F.coalesce("less", F.lit(0))).drop("less")
    whole = F.col("wx") * F.col("wy") * F.col("wz")
    out = _boxes(terms).select("solid_id", whole.alias("whole")).join(shuffled(held), "solid_id", "left")
    count, size = F.coalesce("n_pieces", F.lit(0)), F.col("whole") * F.col("n_cells") / F.lit(8.0**depth)
    status = F.when(count > 0, int(ErrorCode.SUCCESS)).otherwise(int(ErrorCode.FAILURE))
    return out.select("solid_id", status.alias("status"), count.alias("n_pieces"), F.coalesce("n_cells", F.lit(0)).alias("n_cells"), F.coalesce(size, F.lit(0.0)).alias("volume"), *[f"{side}_{x}" for side in ("min", "max") for x in "xyz"])
