"""Universes, fills and lattices on small decks, and the octree against full grids."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from solidspark.errors import ErrorCode
from solidspark.operators import octree
from solidspark.sources import deck, universes

NESTED = """nested
1 0 -1 fill=5 (7)
2 0 1
3 0 1 -2 3 -4 u=5 lat=1 FILL=0:1 0:0 0:0 6 0
4 0 -5 u=6
5 0 5 u=6 fill=8 (0.5 0 0)
6 0 -6 u=8
7 0 6 u=8 trcl=1

1 so 10
2 px 1
3 py 0
4 py 2
5 so 0.25
6 pz 0

tr7 1 0 0 0 1 0 -1 0 0 0 0 1
"""


def at(spark, text, *points):
    decks = spark.createDataFrame([("d", text)], "deck string, value string")
    table = spark.createDataFrame([("d", k, *p) for k, p in enumerate(points)], "deck string, k int, x double, y double, z double")
    return [(r.cell, list(r.path), r.status) for r in universes.locate(table, decks).orderBy("k").collect()]


def test_fills(spark):
    cards = deck.cards_of(spark.createDataFrame([("d", NESTED)], "deck string, value string"))
    rows = {r.cell_id: r for r in universes.fills(cards).collect()}
    assert (rows[1].universe, list(rows[1].fill), list(rows[1].off), list(rows[1].rot)) == (0, [5], [1, 0, 0], [0, 1, 0, -1, 0, 0, 0, 0, 1])
    assert (rows[3].universe, rows[3].lat, list(rows[3].fill), list(rows[3].low), list(rows[3].high), rows[3].off) == (5, 1, [6, 0], [0, 0, 0], [1, 0, 0], None)
    assert (list(rows[5].off), list(rows[5].rot)) == ([0.5, 0, 0], [1, 0, 0, 0, 1, 0, 0, 0, 1]) and rows[2].fill is None and rows[7].universe == 8
    whole = {r.cell_id: list(r.region) for r in deck.cells(universes.without_fills(cards)).collect()}
    assert whole[1] == ["-1"] and whole[3] == ["1", "-2", "3", "-4"] and whole[5] == ["5"]


def test_nested_planes_and_moves(spark):
    text = NESTED.replace("1 -2 3 -4 u=5", "7 -2 3 -4 u=5").replace("6 pz 0\n", "6 pz 0\n7 px 0\n")
    ok, failed = int(ErrorCode.SUCCESS), int(ErrorCode.FAILURE)
    # into the first fill: (x, y) becomes (y, 1 - x), so element (0, 0) is 0 <= y < 1 and -1 < x <= 1
    got = at(spark, text, (0.95, 0.1, 0.1), (0.2, 0.5, -1.0), (0.2, 0.5, 1.0), (0.2, 1.5, 0.0), (0.2, 2.5, 0.0), (20.0, 0.0, 0.0), (None, 0.0, 0.0))
    assert got == [(4, [1, 3, 4], ok), (6, [1, 3, 5, 6], ok), (7, [1, 3, 5, 7], ok), (None, [1], failed), (None, [1], failed), (2, [2], ok), (None, [], failed)]


def test_rings_end(spark):
    text = "ring\n1 0 -1 fill=2\n2 0 1\n3 0 -1 u=2 fill=3\n4 0 1 u=2\n5 0 -2 u=3 fill=2\n6 0 2 u=3\n7 0 -1 u=9 fill=2\n\n1 so 5\n2 so 1\n"
    decks = spark.createDataFrame([("d", text), ("e", text.replace("u=3 fill=2", "u=3"))], "deck string, value string")
    filled = universes.fills(deck.cards_of(decks))
    assert {tuple(r) for r in universes.rings(filled).collect()} == {("d", 2), ("d", 3)}
    assert at(spark, text, (0.0, 0.0, 0.0), (9.0, 0.0, 0.0)) == [(None, [1], int(ErrorCode.INVALID_ENTITY_TOPOLOGY)), (2, [2], 0)]
    assert at(spark, text.replace("u=3 fill=2", "u=3"), (0.0, 0.0, 0.0), (3.0, 0.0, 0.0)) == [(5, [1, 3, 5], 0), (6, [1, 3, 6], 0)]


def test_no_points_and_no_decks(spark):
    none = spark.createDataFrame([], "deck string, value string")
    points = spark.createDataFrame([("d", 0.0, 0.0, 0.0)], "deck string, x double, y double, z double")
    assert [(r.cell, r.status) for r in universes.locate(points, none).collect()] == [(None, int(ErrorCode.FAILURE))]
    assert universes.locate(points.limit(0), none).count() == 0


def flooded(held: np.ndarray) -> int:
    left, n = {tuple(c) for c in np.argwhere(held)}, 0
    while left:
        n, todo = n + 1, [left.pop()]
        while todo:
            c = todo.pop()
            for axis in range(3):
                for step in (-1, 1):
                    near = tuple(v + step * (k == axis) for k, v in enumerate(c))
                    if near in left:
                        left.remove(near)
                        todo.append(near)
    return n


@pytest.mark.parametrize("depth", [3, 5, 6])
def test_octree_equals_a_grid(spark, depth):
    """Random solids; depth 5 and 6 have pieces that hang together over tiles."""
    rng, rows = random.Random(depth), []
    for solid in range(12):
        for k in range(rng.randint(1, 4)):
            kind = rng.choice(octree.KINDS)
            sizes = [rng.uniform(0.3, 1.5) for _ in range(4)]
            if kind == "torus":
                sizes[1] = sizes[0] * 0.3
            rows.append((solid, k, "unite" if k == 0 else rng.choice(octree.OPS), kind, *sizes, *[rng.uniform(-1, 1) for _ in range(3)]))
    table = spark.createDataFrame(rows, octree.TERM)
    got = {r.solid_id: r for r in octree.pieces(table, depth).collect()}
    boxes = {r.solid_id: r for r in octree._boxes(table).collect()}
    n = 2**depth
    grid = (np.indices((n,) * 3).reshape(3, -1).T + 0.5) / n
    for solid, b in boxes.items():
        points = np.array([b.lx, b.ly, b.lz]) + np.array([b.wx, b.wy, b.wz]) * grid
        held = np.zeros(len(points), bool)
        for _, k, op, kind, *v in sorted(r for r in rows if r[0] == solid):
            with np.errstate(all="ignore"):
                one = octree.term_state(kind, np.broadcast_to(np.array(v), (len(points), 7)), points, points) == 1
            held = held & ~one if op == "subtract" else held & one if op == "intersect" else held | one
        assert (got[solid].n_cells, got[solid].n_pieces) == (held.sum(), flooded(held.reshape((n,) * 3))), solid


def test_octree_without_boxes(spark):
    table = spark.createDataFrame([(1, 0, "unite", "unknown", *[1.0] * 7), (2, 0, "subtract", "sphere", *[1.0] * 7), (3, 0, "unite", "sphere", None, *[1.0] * 6)], octree.TERM)
    got = octree.pieces(table, 3).collect()
    assert {(r.solid_id, r.status, r.n_pieces) for r in got} == {(k, int(ErrorCode.FAILURE), 0) for k in (1, 2, 3)}
    assert octree.decided(table.where(F.lit(False)), 3).count() == 0
