"""What a reviewer found on larger tables: what Spark takes for small is not sent to the driver, and figures that ran over."""

from __future__ import annotations


def joins(df):
    """The names of the joins that a plan begins with."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return {w for w in ("BroadcastHashJoin", "BroadcastNestedLoopJoin", "ShuffledHashJoin", "SortMergeJoin") if w in plan}


def test_fingerprint_tables_are_shuffled(spark):
    """28 keys for each fingerprint: Spark takes them for one."""
    from solidspark.llm import simhash

    table = spark.createDataFrame([(k, -k) for k in range(5)], "hi long, lo long")
    assert joins(simhash.near_pairs(table, table)) == {"SortMergeJoin"}


def test_decks_are_shuffled(spark):
    """Decks are texts that compress well: their files are far smaller than what a broadcast of them would be."""
    from solidspark.sources import regions

    decks = spark.createDataFrame([("a", "t\n1 0 -1\n\n1 so 1.0\n")], "deck string, value string")
    points = spark.createDataFrame([("a", 0.0, 0.0, 0.0)], "deck string, x double, y double, z double")
    found = regions.classify(points, decks)
    assert joins(found) == {"SortMergeJoin"}
    assert [r.cell for r in found.collect()] == [1]


def test_meshes_are_shuffled(spark):
    """Solids become thousands of rows each by ``explode``, of which Spark's sizes say nothing."""
    from solidspark.operators import faceting, mesh

    solids = spark.createDataFrame([(1, "brick", 1.0, 2.0, 3.0, 0.0), (2, "sphere", 1.0, 0.0, 0.0, 0.0)], "ent_id long, kind string, a double, b double, c double, d double")
    vertices, elements = faceting.solid_mesh(solids)
    assert joins(elements) == set()
    found = faceting.enclosed(vertices, elements)
    assert joins(found) == {"SortMergeJoin"}
    assert round({r.owner_id: r.volume for r in found.collect()}[1], 9) == 6
    senses = spark.createDataFrame([(1, 1, 1), (2, 2, -1)], "child_id long, parent_id long, sense int")
    closed = mesh.closedness(elements.where("eh > 1"), senses)
    assert joins(closed) == {"SortMergeJoin"}
    assert sorted((r.volume_id, r.missing, r.loops) for r in closed.collect()) == [(1, 3, 1), (2, 0, 0)]


def test_journals_are_composed_in_order(spark):
    """Bit for bit what one operation after the other gives, across what were blocks of 256."""
    import random

    from solidspark.operators import journal

    rng, k = random.Random(5), 600
    maps = [[rng.uniform(-1, 1) for _ in range(12)] for _ in range(k)]
    now = list(journal.UNIT)
    for m in maps:
        now = [m[i // 4 * 4] * now[i % 4] + m[i // 4 * 4 + 1] * now[i % 4 + 4] + m[i // 4 * 4 + 2] * now[i % 4 + 8] + (m[i // 4 * 4 + 3] if i % 4 == 3 else 0) for i in range(12)]
    table = spark.createDataFrame([(e, s, m) for e in (1, None) for s, m in enumerate(maps)], "ent_id long, seq long, map array<double>").repartition(3)
    got = {r.ent_id: (r.map, r.n) for r in journal.composed(table).collect()}
    assert got == {1: (now, k), None: (now, k)}
    ops = [("rotate", 60, 1, 0, 0, 0, 0), ("reflect", 0, 0, 1, 1, 2, 2)]
    table = spark.createDataFrame([(1, "body", s, op, *map(float, a)) for s, (op, *a) in enumerate(ops)], "ent_id long, kind string, seq long, op string, a0 double, a1 double, a2 double, a3 double, a4 double, a5 double")
    turn, mirror = [r.map for r in journal.judged(table).orderBy("seq").collect()]
    assert turn[0] == 1 and mirror == [7 / 9, -4 / 9, -4 / 9, 4 / 9, -4 / 9, 1 / 9, -8 / 9, 8 / 9, -4 / 9, -8 / 9, 1 / 9, 8 / 9]


def test_removed_lines_meet_texts_by_a_shuffle(spark):
    """At every size alike: what is broadcast on a small table and shuffled on a larger one grows faster than its input."""
    from solidspark.llm import linedup

    docs = spark.createDataFrame([(1, "a\nb\nc\nd"), (2, "x\na\nb\nc")], "doc_id long, text string")
    found = linedup.dedup_lines(docs)
    assert joins(found) == {"SortMergeJoin"}
    assert {r.doc_id: r.text for r in found.collect()} == {1: "a\nb\nc\nd", 2: "x"}


def test_octree_cells_are_summed_by_their_tasks(spark, monkeypatch):
    """A solid has hundreds of cells; one row of it goes on to joins, and of its cells the outer ones of tiles where there are many tiles."""
    from pyspark.sql import functions as F

    from solidspark.operators import octree

    staged, stage = [], octree.stage
    monkeypatch.setattr(octree, "stage", lambda df, name: staged.append(stage(df, name)) or staged[-1])
    ball = lambda s, k, op, r, x: (s, k, op, "sphere", r, 0.0, 0.0, 0.0, x, 0.0, 0.0)
    table = spark.createDataFrame([ball(1, 0, "unite", 1.0, 0.1), ball(2, 0, "unite", 0.5, -2.0), ball(2, 1, "unite", 0.7, 2.0), ball(3, 0, "unite", 1.0, 0.0), ball(3, 1, "subtract", 2.0, 0.0)], octree.TERM)
    for depth in (3, 6):
        got = {r.solid_id: r for r in octree.pieces(table, depth).collect()}
        cells, n = octree.decided(table, depth), F.expr("shiftleft(1L, level)")
        box = [f(F.col(f"l{x}") + F.col(f"w{x}") * (F.col(f"i{x}") + k) / n) for f, k in ((F.min, 0), (F.max, 1)) for x in "xyz"]
        want = {r[0]: r for r in cells.join(octree._boxes(table), "solid_id").groupBy("solid_id").agg(F.sum(F.expr(f"shiftleft(1L, 3 * ({depth} - level))")), *box).collect()}
        assert {s: (r.n_cells, *r[5:]) for s, r in got.items() if r.n_cells} == {s: tuple(r[1:]) for s, r in want.items()}
        assert {s: r.n_pieces for s, r in got.items()} == {1: 1, 2: 2, 3: 0}
        rows = [r.level for r in staged[-1].collect()]
        assert rows.count(None) >= 2 and (len(rows) == 2 if depth == 3 else len(rows) < cells.count())
