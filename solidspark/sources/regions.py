"""Regions of many decks at once: every point is classified by the cells of its own deck, with no deck on the driver.

A deck is read where it is, by one task: a cell's region becomes a list of words in postfix, complements of other cells put in place of their
names. What all decks that are written alike share, kinds of surfaces and words of cells, is their shape; the numbers in which they
differ stand beside it. Points meet the shape and the numbers of their deck in one join; a batch of them then finds its signs and
folds its words by arrays, a shape at once, over a stack of truth values. Surfaces may be macrobodies (negative inside all of their facets)
and may stand under a transformation card. Facets of macrobodies by their own names, lattices and universes are not read."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, IntegerType, StructType

from solidspark.skew import shuffled
from solidspark.sources.deck import split_cards

WORDS = re.compile(r"#?\(|\)|:|#\d+|[+-]?\d+")
#: Operators of postfix: both, either, not.
AND, OR, NOT = "&", ":", "!"


def postfix(region: list[str]) -> list[str]:
    """Words in postfix: blanks are AND, ``:`` is OR and binds less, ``#(...)`` is NOT; ``#n`` stays a word. Unbalanced: ValueError."""
    out: list[str] = []
    stack: list[str] = []
    rank, ready = {OR: 1, AND: 2}, False

    def operator(op: str) -> None:
        while stack and rank.get(stack[-1], 0) >= rank[op]:
            out.append(stack.pop())
        stack.append(op)

    for w in WORDS.findall(" ".join(region)):
        if w == ")":
            while stack and not stack[-1].endswith("("):
                out.append(stack.pop())
            if not stack or not ready:
                raise ValueError("unbalanced region")
            if stack.pop()[0] == "#":
                out.append(NOT)
            continue
        if w == OR:
            if not ready:
                raise ValueError("nothing to unite")
            operator(OR)
            ready = False
            continue
        if ready:
            operator(AND)
        if w.endswith("("):
            stack.append(w)
            ready = False
        else:
            out.append(w)
            ready = True
    if any(s.endswith("(") for s in stack) or (stack and not ready):
        raise ValueError("unbalanced region")
    return out + stack[::-1]


def resolved(regions: dict[int, list[str]]) -> dict[int, list[str] | None]:
    """Postfix regions of a deck's cells with every ``#n`` replaced by cell n's own words and NOT; null where cells
    complement each other in a ring, or one that is not there."""
    done: dict[int, list[str] | None] = {}

    def of(cell: int, above: tuple[int, ...]) -> list[str] | None:
        if cell in done:
            return done[cell]
        if cell in above or cell not in regions:
            return None
        out: list[str] = []
        for w in regions[cell]:
            if w[0] == "#":
                inner = of(int(w[1:]), (*above, cell))
                if inner is None:
                    return None
                out += [*inner, NOT]
            else:
                out.append(w)
        done[cell] = out
        return out

    return {cell: of(cell, ()) for cell in regions}


SPACE = re.compile(r"\s+", re.ASCII)
PAIR = re.compile(r"(\S+?)=(\S+)", re.ASCII)
_DOUBLE = re.compile(r"([+-]?(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?)[df]?|([+-]?inf(?:inity)?|nan)", re.ASCII | re.IGNORECASE)
_WHOLE = re.compile(r"[+-]?\d+", re.ASCII)
_MOVED = re.compile(r"(\*?)tr(\d+)", re.ASCII)
UNIT = [float(k % 4 == 0) for k in range(9)]
#: Characters of decks that a task reads, about.
TASK_CHARS = 1_000_000
SURFACES = "array<struct<surface_id:int,mnemonic:string,params:array<double>,off:array<double>,rot:array<double>>>"


def words_of(card: str) -> list[str]:
    return SPACE.split(card.strip(" "))


def number(word: str) -> float | None:
    """A word as a double, null where it is none."""
    found = _DOUBLE.fullmatch(word)
    return float(found[1] or found[2]) if found else None


def whole(word: str | None) -> int | None:
    """A word as a whole number of 32 bits, null where it is none."""
    return int(word) if word is not None and _WHOLE.fullmatch(word) and -(2**31) <= int(word) < 2**31 else None


def certain(word: str) -> int:
    """A word that must be a whole number."""
    found = whole(word)
    if found is None:
        raise ValueError(f"{word!r} is no whole number")
    return found


def turned(given: list[float | None], degrees: bool) -> list[float | None]:
    """The rows of a rotation; fewer than nine numbers: none."""
    if len(given) < 9:
        return UNIT
    return [None if v is None else math.cos(math.radians(v)) if math.isfinite(v) else math.nan for v in given] if degrees else given


@lru_cache(maxsize=4096)
def cell_card(card: str) -> tuple[int, tuple[str, ...], dict[str, str]]:
    """(cell_id, region in postfix, params) of a cell card; a region that cannot be read is null. Decks that are written alike repeat their cards."""
    pairs = PAIR.findall(card) if "=" in card else []
    w = words_of(PAIR.sub("", card) if pairs else card)
    void = len(w) > 1 and certain(w[1]) == 0
    try:
        region = tuple(postfix(w[2 if void else 3 :]))
    except ValueError:
        region = None
    return certain(w[0]), region, {k.lower(): v.split("=")[0] for k, v in pairs}


def cell_cards(cards: list[tuple[str, int, str]], strip: Callable[[str], str] = lambda card: card) -> list[tuple]:
    """(ord, cell_id, region, params) of the cell cards."""
    return [(n, *cell_card(strip(card))) for section, n, card in cards if section == "cell"]


def tr_cards(cards: list[tuple[str, int, str]]) -> dict[int, list[tuple[list, list]]]:
    """(off, rot) of the transformation cards by their numbers: a displacement and the rows of a rotation, in degrees with ``*``."""
    moves: dict[int, list] = {}
    for section, _, card in cards:
        if section == "data":
            w = words_of(card.lower())
            if name := _MOVED.fullmatch(w[0]):
                given = [number(v) for v in w[1:]]
                moves.setdefault(int(name[2]), []).append((given[:3], turned(given[3:12], name[1] == "*")))
    return moves


@lru_cache(maxsize=4096)
def surface_card(card: str) -> tuple[int | None, int | None, str | None, list[float | None]]:
    """(surface_id, transformation, mnemonic, params) of a surface card."""
    w = words_of(card)
    at = 2 if len(w) > 1 and _WHOLE.fullmatch(w[1]) else 1
    own = re.search(r"\d+", w[0], re.ASCII)
    return whole(own[0]) if own else None, whole(w[1]) if at == 2 else None, w[at].lower() if len(w) > at else None, [number(v) for v in w[at + 1 :]]


def surface_cards(cards: list[tuple[str, int, str]]) -> list[dict]:
    """Surfaces (surface_id, mnemonic, params, off, rot); off and rot are those of its transformation card, or null."""
    moves, out = tr_cards(cards), []
    for section, _, card in cards:
        if section == "surface":
            own, tr, kind, params = surface_card(card)
            out += [{"surface_id": own, "mnemonic": kind, "params": params, "off": off, "rot": rot} for off, rot in moves.get(tr) or [(None, None)]]
    return out


def regions(found: list[tuple]) -> tuple[list[dict], list[int]]:
    """Cells (ord, cell_id, words) in order, and those whose regions cannot be read."""
    words = {cell: region for _, cell, region, _ in found if region is not None}
    done = resolved(words)
    return [{"ord": n, "cell_id": cell, "words": w} for n, cell, *_ in found if (w := done.get(cell)) is not None], [cell for _, cell, region, _ in found if region is None] + [c for c, w in done.items() if w is None]


def read_decks(decks: DataFrame, schema: str, row: Callable[[list[tuple[str, int, str]]], tuple | None]) -> DataFrame:
    """(deck and ``schema``) of decks (deck, value): what ``row`` makes of a deck's cards, none where it is null. As many tasks as the texts ask for."""
    arrow = to_arrow_schema(StructType.fromDDL(f"deck string, {schema}"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(d, *r) for d, t in zip(batch["deck"].to_pylist(), batch["value"].to_pylist(), strict=True) if (r := row(split_cards(t))) is not None]
            yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, r, strict=True)) for r in rows], schema=arrow)

    total = decks.agg(F.sum(F.length("value"))).first()[0] or 0
    return decks.select("deck", "value").repartition(-(-total // TASK_CHARS) or 1, "deck").mapInArrow(read, f"deck string, {schema}")


def geometry(decks: DataFrame) -> DataFrame:
    """(deck, cells, bad, surfaces) of decks (deck, value): one row each, as large as its text."""

    def row(cards: list[tuple[str, int, str]]) -> tuple | None:
        found = cell_cards(cards)
        return (*regions(found), surface_cards(cards)) if found else None

    return read_decks(decks, f"cells array<struct<ord:int,cell_id:int,words:array<string>>>, bad array<int>, surfaces {SURFACES}", row)


#: How many numbers the surfaces have.
_AXES = {f"{k}{v}": n for v in "xyz" for k, n in (("p", 1), ("c", 1), ("c/", 3), ("s", 2))}
SIZES = {"so": 1, "s": 4, "sph": 4, "p": 4, "gq": 10, "sq": 10, "rpp": 6, "box": 12, "rcc": 7} | _AXES


def _uses(kind: str) -> set[int]:
    """Axes whose coordinates a surface asks for."""
    if kind not in _AXES or kind[0] == "s":
        return {0, 1, 2}
    own = {"xyz".index(kind[-1])}
    return own if kind[0] == "p" else {0, 1, 2} - own


def surface_numbers(s: dict) -> list[float] | None:
    """The numbers of a surface (with those of its transformation), as :func:`surface_value` reads them; null where it has no value at any point.

    What is null leaves the sides of macrobodies that ask for it out of account."""
    kind, inf = s["mnemonic"], math.inf
    if kind not in SIZES:
        return None
    p, move, lost = (s["params"] + [None] * 12)[: SIZES[kind]], [], set()
    if s["off"] is not None:
        off = (s["off"] + [None] * 3)[:3]
        rows = [s["rot"][3 * k : 3 * k + 3] for k in range(3)]
        lost = {k for k in range(3) if None in off or None in rows[k]}
        move = [0.0 if v is None else v for v in off] + [v for k in range(3) for v in ([0.0] * 3 if k in lost else rows[k])]
    if kind == "rpp":
        p = [None if k // 2 in lost else v for k, v in enumerate(p)]
        return None if p == [None] * 6 else [(inf if k % 2 else -inf) if v is None else v for k, v in enumerate(p)] + move
    if kind == "box":
        open_ = [None in p[k : k + 3] for k in (3, 6, 9)]
        if lost or None in p[:3] or all(open_):
            return None
        return p[:3] + [v for k, o in enumerate(open_) for v in ([0.0] * 3 if o else p[3 * k + 3 : 3 * k + 6])] + [-inf if o else 0.0 for o in open_] + move
    if kind == "rcc":
        return None if lost or None in p[:6] else p[:6] + ([0.0, -inf] if p[6] is None else [p[6], 0.0]) + move
    return None if None in p or lost & _uses(kind) else p + move


def surface_value(kind: str, p: np.ndarray, at: list[np.ndarray], lost: frozenset[int] = frozenset()) -> np.ndarray | None:
    """Of a surface at points: negative inside or below, positive outside; null where it has no value. p: its numbers, a row each; lost: axes that the points have no coordinate on."""
    n = SIZES[kind] + {"box": 3, "rcc": 1}.get(kind, 0)
    if lost and (len(p) > n or (kind != "rpp" and lost & _uses(kind)) or len(lost) == 3):
        return None
    if len(p) > n:
        # into the axes that the surface is given in
        d = [v - o for v, o in zip(at, p[n : n + 3], strict=True)]
        at = [p[n + 3 + 3 * k] * d[0] + p[n + 4 + 3 * k] * d[1] + p[n + 5 + 3 * k] * d[2] for k in range(3)]
    x, y, z = at
    sq = lambda v: v * v
    dot = lambda u, v: u[0] * v[0] + u[1] * v[1] + u[2] * v[2]
    if kind == "so":
        return sq(x) + sq(y) + sq(z) - sq(p[0])
    if kind in ("s", "sph"):
        return sq(x - p[0]) + sq(y - p[1]) + sq(z - p[2]) - sq(p[3])
    if kind == "p":
        return p[0] * x + p[1] * y + p[2] * z - p[3]
    if kind == "gq":
        return p[0] * sq(x) + p[1] * sq(y) + p[2] * sq(z) + p[3] * x * y + p[4] * y * z + p[5] * z * x + p[6] * x + p[7] * y + p[8] * z + p[9]
    if kind == "sq":
        return p[0] * sq(x - p[7]) + p[1] * sq(y - p[8]) + p[2] * sq(z - p[9]) + 2 * (p[3] * (x - p[7]) + p[4] * (y - p[8]) + p[5] * (z - p[9])) + p[6]
    if kind == "rpp":
        return np.maximum.reduce([f for k, v in enumerate(at) if k not in lost for f in (p[2 * k] - v, v - p[2 * k + 1])])
    if kind in ("box", "rcc"):
        rel = [v - p[k] for k, v in enumerate(at)]
        if kind == "box":
            return np.maximum.reduce([f + p[11 + k // 3] for k in (3, 6, 9) for f in (-dot(rel, p[k : k + 3]), dot(rel, p[k : k + 3]) - dot(p[k : k + 3], p[k : k + 3]))])
        along, h2 = dot(rel, p[3:6]), dot(p[3:6], p[3:6])
        return np.maximum.reduce([-along, along - h2, dot(rel, rel) * h2 - sq(along) - sq(p[6]) * h2 + p[7]])
    axis = "xyz".index(kind[-1])
    u, w = (v for k, v in enumerate(at) if k != axis)
    if kind[0] == "p":
        return at[axis] - p[0]
    if kind[0] == "s":
        return sq(at[axis] - p[0]) + sq(u) + sq(w) - sq(p[1])
    return sq(u - p[0]) + sq(w - p[1]) - sq(p[2]) if kind[1] == "/" else sq(u) + sq(w) - sq(p[0])


Signs = Callable[[int], tuple[np.ndarray, np.ndarray] | None]


def signs(surfaces: list[list], p: np.ndarray, at: list[np.ndarray], lost: frozenset[int] = frozenset()) -> Signs:
    """Of surfaces (surface_id, kind, first number, end) that are asked for: whether points are inside and outside, 1 for true, -1 for not; null
    for one without a value. No number counts as above all."""
    places = {own: rest for own, *rest in surfaces}

    @cache
    def of(own: int) -> tuple[np.ndarray, np.ndarray] | None:
        kind, first, end = places.get(own, (None, 0, 0))
        v = surface_value(kind, p[first:end], at, lost) if kind else None
        return None if v is None else tuple(np.where(side, 1, -1).astype("int8") for side in (v < 0, (v > 0) | np.isnan(v)))

    return of


def holds(words: list[str], found: Signs, n: int) -> np.ndarray:
    """Whether postfix words hold at n points: 1 for true, -1 for not, 0 where a surface is not known."""
    stack, nil = [], np.zeros(n, "int8")
    for w in words:
        if w == NOT:
            stack.append(-stack.pop())
        elif w in (AND, OR):
            last = stack.pop()
            stack.append((np.minimum if w == AND else np.maximum)(stack.pop(), last))
        else:
            own = whole(w)
            pair = None if own is None else found(abs(own))
            stack.append(nil if pair is None else pair[0 if w[0] == "-" else 1])
    return stack[0] if stack else nil


def shape(found: list[dict], surfaces: list[dict]) -> tuple[dict, list[float]]:
    """What decks that are written alike share (cells, and surfaces with the places of their numbers), and the numbers. A surface that is given twice, or has no number: ValueError."""
    out, numbers = [], []
    ids = [s["surface_id"] for s in surfaces]
    if None in ids or len(set(ids)) < len(ids):
        raise ValueError("surfaces without a number of their own")
    for s in surfaces:
        own = surface_numbers(s)
        if own is not None:
            out.append([s["surface_id"], s["mnemonic"], len(numbers), len(numbers) + len(own)])
            numbers += own
    return {"cells": [[c["cell_id"], c["words"]] for c in found], "surfaces": out}, numbers


def packed(form: dict, numbers: list[float]) -> tuple[bytes, bytes]:
    return json.dumps(form, separators=(",", ":")).encode(), np.array(numbers, "<f8").tobytes()


@lru_cache(maxsize=1024)
def unpacked(form: bytes) -> dict:
    return json.loads(form)


SHAPES = "shape binary, numbers binary"


def met(points: DataFrame, shapes: DataFrame, more: list[tuple[str, DataType]], one: Callable[[dict, np.ndarray, list[np.ndarray], frozenset[int]], list[pa.Array]]) -> DataFrame:
    """``points`` (deck, x, y, z and more) with the columns ``more`` that ``one`` finds from the shape and the numbers of their decks
    (a row each) for points of one shape at once; lost: axes on which these points are null. Where there is no deck they are what it finds for an empty shape."""
    kept = points.columns
    schema = StructType(list(points.schema.fields))
    for name, kind in more:
        schema = schema.add(name, kind)
    at = [F.col(c).cast("double").alias(f"_{c}") for c in "xyz"]
    rows = points.select("*", *at).join(shuffled(shapes.withColumnsRenamed({"shape": "_shape", "numbers": "_numbers"})), "deck", "left").select(*kept, "_x", "_y", "_z", "_shape", "_numbers")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = batch["_shape"].dictionary_encode(null_encoding="encode")
            places = [batch[f"_{c}"] for c in "xyz"]
            gone = sum(np.asarray(v.is_null()).astype(int) << k for k, v in enumerate(places))
            xyz = [v.fill_null(0.0).to_numpy(zero_copy_only=False) for v in places]
            alike = forms.indices.to_numpy() * 8 + gone
            order, parts = np.argsort(alike, kind="stable"), []
            for rows in np.split(order, np.flatnonzero(np.diff(alike[order])) + 1) if len(order) else []:
                key = int(alike[rows[0]])
                form = forms.dictionary[key // 8].as_py()
                raw = b"" if form is None else b"".join(batch["_numbers"].take(pa.array(rows)).to_pylist())
                p = np.frombuffer(raw, "<f8").reshape(len(rows), -1).T if raw else np.zeros((0, len(rows)))
                with np.errstate(all="ignore"):
                    parts.append(one(unpacked(form or b"{}"), np.ascontiguousarray(p), [v[rows] for v in xyz], frozenset(k for k in range(3) if key >> k & 1)))
            back = pa.array(np.argsort(order))
            found = [pa.concat_arrays(part).take(back) for part in zip(*parts, strict=True)]
            if found:
                yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], *found], names=[*kept, *[name for name, _ in more]])

    return rows.mapInArrow(find, schema)


def classify(points: DataFrame, decks: DataFrame) -> DataFrame:
    """``points`` (deck, x, y, z and more) with ``cell``: the first cell of the point's own deck that holds it, else null."""

    def row(cards: list[tuple[str, int, str]]) -> tuple[bytes, bytes] | None:
        found = cell_cards(cards)
        return packed(*shape(regions(found)[0], surface_cards(cards))) if found else None

    def one(form: dict, p: np.ndarray, at: list[np.ndarray], lost: frozenset[int]) -> list[pa.Array]:
        n = len(at[0])
        found, left, known = np.zeros(n, "int32"), np.ones(n, bool), signs(form.get("surfaces", []), p, at, lost)
        for cell, words in form.get("cells", []):
            # no cell is looked at once one holds all points
            if not left.any():
                break
            here = left & (holds(words, known, n) == 1)
            found[here], left = cell, left & ~here
        return [pa.array(found, mask=left)]

    return met(points, read_decks(decks, SHAPES, row), [("cell", IntegerType())], one)
