"""Universes, fills and lattices of many decks: points go down from the cells of universe 0 into what fills them.

A cell belongs to the universe that ``u=`` names (0 without it). ``fill=n`` puts universe n into it, ``fill=n (t)`` by transformation card
t, ``fill=n (x y z ...)`` by a displacement and the nine numbers of a rotation (degrees with ``*fill``). A cell with ``lat=1`` stands
for all the boxes that repeat its own, an ``rpp`` or pairs of planes across axes; along an axis that it does not bound it does not
repeat. Its fill is one universe or ``i1:i2 j1:j2 k1:k2`` and a universe for each element, the first index fastest; its own number
leaves an element as it is, 0 and what lies outside the ranges is no element.

A deck's universes come together, as they do in its text, so points meet their deck once; a batch of points then goes down one level at a
time, and what has arrived goes no further. A ring of fills would never end: its universes are found first, from the decks alone, and points
that come to one of them end there. ``trcl``, ``lat=2`` and fills of single elements by transformations are not read."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from solidspark.errors import ErrorCode
from solidspark.sources.regions import SHAPES, UNIT, cell_card, cell_cards, holds, met, number, packed, read_decks, regions, shape, signs, surface_cards, tr_cards, turned, whole, words_of

#: A fill and all that is written for it: numbers, ranges and parentheses up to the next word.
FILL = r"(?i)(\*?)\bfill\s*=\s*([-+0-9.:()\s]+)"
FILLED = "deck string, cell_id int, universe int, lat int, fill array<int>, low array<int>, high array<int>, off array<double>, rot array<double>"
_FILL = re.compile(FILL, re.ASCII)
_CUT = re.compile(FILL.replace("(?i)(", r"(?i)\s(", 1), re.ASCII)
_RANGE = re.compile(r"(-?\d+)\s*:\s*(-?\d+)", re.ASCII)
_INNER = re.compile(r"\(([^)]*)\)")
Cards = list[tuple[str, int, str]]


def without_fills(cards: DataFrame) -> DataFrame:
    """The same cards, those of cells without their fills, so that their regions are what is left."""
    return cards.withColumn("card", F.when(F.col("section") == "cell", F.regexp_replace("card", FILL.replace("(?i)(", "(?i)\\s(", 1), " ")).otherwise(F.col("card")))


@lru_cache(maxsize=4096)
def _without_fill(card: str) -> str:
    return _CUT.sub(" ", card) if "=" in card else card


@lru_cache(maxsize=4096)
def _fill(card: str) -> tuple[dict, int | None]:
    """Of a cell card the cell, its universe and what fills it, and the number of the transformation card that says where."""
    cell, _, params = cell_card(_without_fill(card))
    own, tr = whole(params.get("u")), None
    one = {"cell_id": cell, "universe": abs(own) if own is not None else 0, "lat": whole(params.get("lat")), "fill": None, "low": [], "high": [], "off": None, "rot": UNIT}
    if found := _FILL.search(card):
        outer, inner = found[2].split("(")[0], _INNER.search(found[2])
        ranges = _RANGE.findall(outer)
        named = [whole(w) for w in words_of(_RANGE.sub(" ", outer)) if w]
        given = [number(w) for w in words_of(inner[1]) if w] if inner else []
        tr = int(given[0]) if len(given) == 1 and given[0] is not None else None
        one |= {"fill": named or None, "low": [int(a) for a, _ in ranges], "high": [int(b) for _, b in ranges], "off": given[:3] if len(given) >= 3 else None, "rot": turned(given[3:12], found[1] == "*")}
    return one, tr


def deck_fills(cards: Cards) -> list[dict]:
    """Of every cell of a deck: its universe, and the universes that fill it with their place; see ``FILLED``."""
    moves, out = tr_cards(cards), []
    for section, _, card in cards:
        if section == "cell":
            one, tr = _fill(card)
            # of transformation cards of one number the first
            out.append(one | dict(zip(("off", "rot"), moves[tr][0], strict=True)) if tr in moves else one)
    return out


def fills(cards: DataFrame) -> DataFrame:
    """A row (see ``FILLED``) for every cell: its universe, and the universes that fill it with their place; no fill: null.

    A deck's cards come together, as they do in its text."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in FILLED.split(", ")]
        for frame in frames:
            rows = [{"deck": d, **one} for d, cs in zip(frame["deck"], frame["cards"], strict=True) for one in deck_fills([(c["section"], c["ord"], c["card"]) for c in cs])]
            made = pd.DataFrame(rows, columns=names)
            yield made.astype({"lat": "Int32", "universe": "int32", "cell_id": "int32"})

    return cards.groupBy("deck").agg(F.array_sort(F.collect_list(F.struct("section", "ord", "card"))).alias("cards")).mapInPandas(read, FILLED)


def ringed(steps: set[tuple[int, int]]) -> set[int]:
    """The universes that a ring of fills (outer, inner) runs through, or that lie between rings.

    Fills whose inner universe fills nothing, or whose outer one nothing holds, go, until none does."""
    while True:
        outer, inner = {a for a, _ in steps}, {b for _, b in steps}
        less = {(a, b) for a, b in steps if b in outer and a in inner}
        if less == steps:
            return outer | inner
        steps = less


def _steps(filled: list[dict]) -> set[tuple[int, int]]:
    """A universe that names itself in a lattice is no step."""
    return {(one["universe"], u) for one in filled if one["fill"] is not None for u in one["fill"] if u and not (u == one["universe"] and one["lat"] is not None)}


def rings(filled: DataFrame) -> DataFrame:
    """(deck, universe): those that a ring of fills runs through, or that lie between rings. A universe that names itself in a lattice is none."""
    each = filled.where("fill is not null").groupBy("deck").agg(F.collect_list(F.struct("universe", "lat", "fill")).alias("fills"))

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(d, u) for d, fs in zip(frame["deck"], frame["fills"], strict=True) for u in ringed(_steps([{"universe": f["universe"], "lat": f["lat"], "fill": list(f["fill"])} for f in fs]))]
            yield pd.DataFrame(rows, columns=["deck", "universe"])

    return each.mapInPandas(find, "deck string, universe int")


def _bounds(words: list[str], surfaces: list[dict]) -> list[tuple[float | None, float | None]]:
    """(lo, hi) along each axis of the box of a lattice cell's region; null where it has no bound."""
    least, greatest = [[], [], []], [[], [], []]
    for s in surfaces:
        p, own = (s["params"] + [None] * 6)[:6], str(s["surface_id"])
        inside, outside = "-" + own in words, own in words or "+" + own in words
        for n, axis in enumerate("xyz"):
            if s["mnemonic"] == "p" + axis:
                least[n] += [p[0]] * outside
                greatest[n] += [p[0]] * inside
            elif s["mnemonic"] == "rpp" and inside:
                least[n].append(p[2 * n])
                greatest[n].append(p[2 * n + 1])
    key = lambda v: (math.isnan(v), v)
    return [(max([v for v in low if v is not None], key=key, default=None), min([v for v in high if v is not None], key=key, default=None)) for low, high in zip(least, greatest, strict=True)]


def deck_shape(cards: Cards) -> tuple[bytes, bytes] | None:
    """Shape and numbers of a deck with universes: cells in order, each with its universe and, where it has them, its fill, lattice and place."""
    found = cell_cards(cards, _without_fill)
    if not found:
        return None
    surfaces, filled = surface_cards(cards), deck_fills(cards)
    good = {c["ord"]: c for c in regions(found)[0]}
    form, numbers = shape(list(good.values()), surfaces)
    form["rings"], form["cells"] = sorted(ringed(_steps(filled))), []
    for (n, *_), one in zip(found, filled, strict=True):
        if n not in good:
            continue
        cell = {"id": one["cell_id"], "words": good[n]["words"], "universe": one["universe"], "fill": one["fill"]}
        if one["lat"] is not None:
            bounds = _bounds(good[n]["words"], surfaces)
            # along an axis without both bounds it does not repeat
            cell |= {"lattice": len(numbers), "repeats": [None not in b for b in bounds], "low": one["low"], "high": one["high"]}
            numbers += [v if None not in b else 0.0 for b in bounds for v in b]
        if one["off"] is not None:
            place = [*(one["off"] + [None] * 3)[:3], *one["rot"]]
            cell |= {"place": len(numbers), "lost": None in place}
            numbers += [0.0 if v is None else v for v in place]
        form["cells"].append(cell)
    return packed(form, numbers)


def _down(cell: dict, universe: int, p: np.ndarray, at: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """The universe below a cell at points, whether there is one, the points there, and whether they lie in no element of a lattice."""
    n = len(at[0])
    fill, gone = cell["fill"] or [None], np.zeros(n, bool)
    below, lattice = np.full(n, fill[0] or 0), "lattice" in cell
    if lattice:
        index = []
        for k, v in enumerate(at):
            lo, hi = p[cell["lattice"] + 2 * k], p[cell["lattice"] + 2 * k + 1]
            pitch = hi - lo
            step = np.floor((v - lo) / pitch) if cell["repeats"][k] else np.zeros(n)
            index.append(np.clip(np.where(np.isnan(step) | (pitch == 0), 0.0, step), -(2.0**63), 2.0**63))
            at = [*at[:k], v - index[k] * pitch, *at[k + 1 :]]
        if len(cell["low"]) == 3:
            first, last = cell["low"], cell["high"]
            within = np.logical_and.reduce([(i >= a) & (i <= b) for i, a, b in zip(index, first, last, strict=True)])
            i, j, k = (np.where(within, v - a, 0).astype("int64") for v, a in zip(index, first, strict=True))
            place = i + (last[0] - first[0] + 1) * (j + (last[1] - first[1] + 1) * k)
            # what is not listed is no element
            listed = np.array([*(u or 0 for u in fill), 0])
            below = np.where(within, listed[np.minimum(place, len(fill))], 0)
            gone = below == 0
    if "place" in cell:
        off, rot = p[cell["place"] : cell["place"] + 3], p[cell["place"] + 3 : cell["place"] + 12]
        d = [v - o for v, o in zip(at, off, strict=True)]
        at = [rot[3 * k] * d[0] + rot[3 * k + 1] * d[1] + rot[3 * k + 2] * d[2] for k in range(3)]
    return below, (below != 0) & ~(lattice & (below == universe)), at, gone


def _descend(form: dict, p: np.ndarray, at: list[np.ndarray], lost: frozenset[int]) -> list[pa.Array]:
    """(cell, path, status) of points of decks of one shape."""
    n = len(at[0])
    at, universe, status = [v.copy() for v in at], np.zeros(n, "int64"), np.full(n, int(ErrorCode.FAILURE), "int32")
    known, paths = np.full(n, not lost), []
    todo, cells_of = np.arange(n), {}
    for cell in form.get("cells", []):
        cells_of.setdefault(cell["universe"], []).append(cell)
    while len(todo):
        level, on = np.zeros(n, "int64"), np.zeros(n, bool)
        further = []
        for u in np.unique(universe[todo]).tolist():
            rows = todo[universe[todo] == u]
            if u in cells_of and u in form["rings"]:
                status[rows] = int(ErrorCode.INVALID_ENTITY_TOPOLOGY)
                continue
            q, places = p[:, rows], [v[rows] for v in at]
            own, left = signs(form.get("surfaces", []), q, places), known[rows]
            for cell in cells_of.get(u, []):
                # no cell is looked at once one holds all points
                if not left.any():
                    break
                here = np.flatnonzero(left & (("lattice" in cell) | (holds(cell["words"], own, len(rows)) == 1)))
                left[here] = False
                below, goes, moved, gone = _down(cell, u, q[:, here], [v[here] for v in places])
                there = rows[here]
                level[there], on[there] = cell["id"], ~gone
                status[there[~gone & ~goes]] = int(ErrorCode.SUCCESS)
                went = there[~gone & goes]
                universe[went] = below[~gone & goes]
                known[went] = not cell.get("lost")
                for k in range(3):
                    at[k][went] = moved[k][~gone & goes]
                further.append(went)
        paths.append((level, on))
        todo = np.concatenate(further) if further else todo[:0]
    on = np.array([v for _, v in paths]).reshape(len(paths), n).T
    cells = np.array([v for v, _ in paths]).reshape(len(paths), n).T.astype("int32")
    ends = np.concatenate([[0], np.cumsum(on.sum(axis=1))]).astype("int32")
    last = np.where(on, np.arange(on.shape[1]), -1).max(axis=1, initial=-1)
    cell = pa.array(cells[np.arange(n), last], mask=status != int(ErrorCode.SUCCESS))
    return [cell, pa.ListArray.from_arrays(pa.array(ends), pa.array(cells[on])), pa.array(status)]


def locate(points: DataFrame, decks: DataFrame) -> DataFrame:
    """``points`` (deck, x, y, z and more) with ``cell`` (the innermost one; null on none), ``path`` (the cells from outside in) and ``status``:
    success, FAILURE on no cell or element of some level, INVALID_ENTITY_TOPOLOGY at a ring of fills.

    A point is in the first cell that holds it of its universe; a lattice cell holds all of its. Points of decks that are not there, or with a null
    coordinate, are on no cell. Names of ``points`` may not begin with ``_`` or be those of the columns that are added."""
    return met(points, read_decks(decks, SHAPES, deck_shape), [("cell", IntegerType()), ("path", ArrayType(IntegerType())), ("status", IntegerType())], _descend)
