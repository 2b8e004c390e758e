"""What a reviewer found on larger tables: figures that grew past their limits."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from solidspark.staging import shared_dir
from tests.test_round4 import joins


def staged(spark):
    folder = shared_dir(spark).removeprefix("file://")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_points_meet_their_universes_once(spark):
    """However deep the universes are nested: one join, and nothing written between levels."""
    from solidspark.sources import universes

    depth = 6
    cells = "\n".join(f"{k + 1} 0 -{k + 1} u={k} fill={k + 1}" for k in range(depth)) + f"\n{depth + 1} 0 -1 u={depth}"
    faces = "\n".join(f"{k + 1} so {10 - k}" for k in range(depth))
    decks = spark.createDataFrame([("a", f"t\n{cells}\n\n{faces}\n"), ("b", "t\n1 0 -1 fill=1\n2 0 1\n3 0 -1 u=1 fill=1\n\n1 so 1.0\n")], "deck string, value string")
    points = spark.createDataFrame([("a", 1, 0.5, 0.0, 0.0), ("a", 2, 9.5, 0.0, 0.0), ("b", 3, 0.5, 0.0, 0.0), ("b", 4, 5.0, 0.0, 0.0), ("c", 5, 0.0, 0.0, 0.0), ("a", 6, float("nan"), 0.0, 0.0)], "deck string, k int, x double, y double, z double")
    before = staged(spark)
    found = universes.locate(points, decks)
    assert joins(found) == {"SortMergeJoin"}
    assert [(r.k, r.cell, list(r.path), r.status) for r in found.orderBy("k").collect()] == [(1, 7, [1, 2, 3, 4, 5, 6, 7], 0), (2, None, [1], 22), (3, None, [1], 10), (4, 2, [2], 0), (5, None, [], 22), (6, None, [], 22)]
    assert staged(spark) == before


def test_surfaces_of_which_something_is_not_known(spark):
    """What is not a number leaves the sides that ask for it out of account; a null coordinate likewise."""
    from solidspark.sources import regions

    text = "t\n1 0 -1\n2 0 -2\n3 0 3\n4 0 -4 : -5\n\n1 rpp -1 1 x 1 -1\n2 cz x\n3 pz 5\n4 3 so 1\n5 px -5\n\ntr3 0 x 0\n"
    decks = spark.createDataFrame([("a", text)], "deck string, value string")
    rows = [(1, 0.0, -9.0, 9.0, 1), (2, 0.0, 2.0, 0.0, None), (3, 2.0, 0.0, 6.0, 3), (4, -9.0, 2.0, 0.0, 4), (5, None, 0.0, 0.0, 1), (6, None, 2.0, 6.0, 3), (7, None, None, 0.0, 1), (8, None, None, None, None), (9, 2.0, 2.0, float("nan"), 3)]
    points = spark.createDataFrame([("a", *r) for r in rows], "deck string, k int, x double, y double, z double, want int")
    assert [(r.k, r.cell) for r in regions.classify(points, decks).orderBy("k").collect()] == [(r[0], r[-1]) for r in rows]


def test_decks_are_read_in_one_pass(spark, monkeypatch):
    """By as many tasks as their texts ask for, however well these compress, and nothing is written."""
    from solidspark.sources import regions

    monkeypatch.setattr(regions, "TASK_CHARS", 100)
    decks = spark.range(40).select(F.col("id").cast("string").alias("deck"), F.lit("t\n1 0 -1\n2 0 1\n\n1 so 1.0\n").alias("value")).coalesce(1)
    points = decks.select("deck", F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), (F.col("deck").cast("double") / 20).alias("z"))
    before = staged(spark)
    found = regions.classify(points, decks)
    assert {int(r.deck): r.cell for r in found.collect()} == {k: 1 if k < 20 else 2 if k > 20 else None for k in range(40)}
    assert staged(spark) == before
    assert regions.geometry(decks).rdd.getNumPartitions() == 10


def test_boxes_are_found_once_a_cell(spark):
    """A filter on a box reads 18 numbers; it may not find the box anew for each."""
    from solidspark.sources import imports
    from solidspark.sources.deck import DeckOptions

    decks = spark.createDataFrame([("a", "t\n1 0 -1 : -2\n2 0 #1\n\n1 so 1.0\n2 rpp 0 3 0 1 0 1\n"), ("b", "t\n1 0 -1\n\n1 pz 1.0\n")], "deck string, value string")
    found = imports.graveyards(decks, DeckOptions())
    plan = found._jdf.queryExecution().sparkPlan().toString().split("\n")
    assert any("Filter" in line for line in plan) and not any("Filter" in line and "lambda" in line for line in plan)
    assert [(r.deck, [round(v, 9) for v in r.inner]) for r in found.collect()] == [("a", [-1.4, -1.4, -1.4, 3.4, 1.4, 1.4])]


def solids(spark):
    rows = [(1, "brick", 1.0, 2.0, 3.0, 0.0), (2, "sphere", 1.0, 0.0, 0.0, 0.0), (3, "torus", 1.0, 0.25, 0.0, 0.0), (4, "torus", 1.0, 1.0, 0.0, 0.0), (5, "cylinder", 2.0, 1.0, 0.5, 0.0), (6, "cone", 2.0, 1.0, 0.5, 2.0), (7, "cone", 2.0, 1.0, 0.0, 0.0)]
    return spark.createDataFrame(rows, "ent_id long, kind string, a double, b double, c double, d double")


def test_sizes_of_solids_join_nothing(spark):
    """Triangles have their points where they are made, the same that joins with vertices give."""
    from solidspark.operators import faceting

    want = {r.owner_id: (round(r.area, 9), round(r.volume, 9), r.n) for r in faceting.enclosed(*faceting.solid_mesh(solids(spark))).collect()}
    found = faceting.solid_sizes(solids(spark))
    assert joins(found) == set() and "ENSURE_REQUIREMENTS" not in found._jdf.queryExecution().executedPlan().toString()
    assert {r.owner_id: (round(r.area, 9), round(r.volume, 9), r.n) for r in found.collect()} == want and len(want) == 7


def test_sides_are_counted_where_solids_are_made(spark, monkeypatch):
    """None is shuffled, and only the ends of loops are written."""
    from solidspark.operators import faceting, mesh

    plans, staged_rows, stage = [], [], mesh.stage

    def watched(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        out = stage(df, name)
        staged_rows.append(out.count())
        return out

    _, elements = faceting.solid_mesh(solids(spark), keep=("ord",))
    monkeypatch.setattr(mesh, "stage", watched)
    whole = {r.volume_id: tuple(r)[2:] for r in mesh.closedness(elements).collect()}
    assert whole == {k: (0, 0, 0, 0) for k in range(1, 8)} and staged_rows == [7] and "ENSURE_REQUIREMENTS" not in plans[0]
    torn = elements.where("ord > 0 or owner_id <> 2")
    senses = solids(spark).select(F.col("ent_id").alias("child_id"), (F.col("ent_id") + 10).alias("parent_id"), F.lit(-1).alias("sense"))
    got = {r.volume_id: tuple(r)[2:] for r in mesh.closedness(torn, senses).collect()}
    # six that are closed and the torn one with its three sides, which may be used either way
    assert got == {k + 10: (3, 0, 0, 1) if k == 2 else (0, 0, 0, 0) for k in range(1, 8)} and staged_rows[1] == 7 + 3


def test_surfaces_of_one_volume_meet_at_sides(spark):
    """A volume of several surfaces beside one that is the only surface of its volume, and one that bounds both kinds."""
    from solidspark.operators import mesh

    four = [(1, [1, 3, 2]), (1, [1, 2, 4]), (2, [2, 3, 4]), (2, [1, 4, 3])]
    table = spark.createDataFrame([(k, o, [v + 0 for v in c]) for k, (o, c) in enumerate(four)] + [(9, 3, [7, 8, 9]), (10, 3, [9, 8, 7])], "eh long, owner_id long, conn array<long>")
    senses = spark.createDataFrame([(1, 10, 1), (2, 10, 1), (2, 20, -1), (3, 30, 1), (3, 40, 1), (1, 40, 1), (1, 40, 1)], "child_id long, parent_id long, sense int")
    got = {r.volume_id: tuple(r)[1:] for r in mesh.closedness(table, senses).collect()}
    assert got == {10: (6, 0, 0, 0, 0), 20: (5, 4, 0, 0, 1), 30: (3, 0, 0, 0, 0), 40: (8, 0, 4, 1, 0)}
