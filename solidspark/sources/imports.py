"""What an import makes of decks by its options: groups of cells by material and importance, cell ids as tags, and a shell around everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solidspark.sources.deck import DeckOptions, cards_of, cells
from solidspark.sources.regions import AND, NOT, OR, geometry

_INF = float("inf")


def _box(low: list[Column], high: list[Column]) -> Column:
    return F.array(*[c.cast("double") for c in (*low, *high)])


def _space() -> Column:
    return F.array(*[F.lit(-_INF)] * 3, *[F.lit(_INF)] * 3)


def surface_box(s: Column) -> Column:
    """(least x, y, z, greatest x, y, z) of the inside of a surface (mnemonic, params, off, rot); without bounds where it has none.

    A bounded one under a transformation has the box of its turned box."""
    p = lambda k: F.get(s.getField("params"), F.lit(k))
    kind, off = s.getField("mnemonic"), s.getField("off")
    rot = lambda i, k: F.get(s.getField("rot"), F.lit(3 * i + k))
    around = lambda centre, half: _box([c - h for c, h in zip(centre, half, strict=True)], [c + h for c, h in zip(centre, half, strict=True)])
    nil, inf = F.lit(0.0), F.lit(_INF)
    own = F.when(kind == "so", around([nil] * 3, [p(0)] * 3)).when(kind.isin("s", "sph"), around([p(0), p(1), p(2)], [p(3)] * 3)).when(kind == "rpp", _box([p(0), p(2), p(4)], [p(1), p(3), p(5)]))
    edges = [[p(3 * e + k) for k in range(3)] for e in (1, 2, 3)]
    own = own.when(kind == "box", _box([p(k) + sum((F.least(e[k], nil) for e in edges), nil) for k in range(3)], [p(k) + sum((F.greatest(e[k], nil) for e in edges), nil) for k in range(3)]))
    h2 = p(3) * p(3) + p(4) * p(4) + p(5) * p(5)
    own = own.when(kind == "rcc", around([p(k) + p(3 + k) / 2 for k in range(3)], [F.abs(p(3 + k)) / 2 + p(6) * F.sqrt(F.greatest(nil, 1 - F.try_divide(p(3 + k) * p(3 + k), h2))) for k in range(3)]))
    for n, k in enumerate("xyz"):
        at = [p(0) if i == n else nil for i in range(3)]
        own = own.when(kind == f"s{k}", around(at, [p(1)] * 3))
    fixed = own
    for n, k in enumerate("xyz"):
        others = [i for i in range(3) if i != n]
        fixed = fixed.when(kind == f"p{k}", _box([-inf] * 3, [p(0) if i == n else inf for i in range(3)]))
        fixed = fixed.when(kind == f"c{k}", around([nil] * 3, [inf if i == n else p(0) for i in range(3)]))
        fixed = fixed.when(kind == f"c/{k}", around([p(others.index(i)) if i in others else nil for i in range(3)], [p(2) if i in others else inf for i in range(3)]))

    def turned(o: Column) -> Column:
        b = lambda k: F.get(o, F.lit(k))
        centre, half = [(b(k) + b(k + 3)) / 2 for k in range(3)], [(b(k + 3) - b(k)) / 2 for k in range(3)]
        return around([F.get(off, F.lit(i)) + sum((rot(k, i) * centre[k] for k in range(3)), nil) for i in range(3)], [sum((F.abs(rot(k, i)) * half[k] for k in range(3)), nil) for i in range(3)])

    # an array of one names what is used often
    moved = F.get(F.transform(F.array(own), turned), F.lit(0))
    return F.coalesce(F.when(off.isNull(), fixed).otherwise(moved), _space())


def _outside(s: Column) -> Column:
    """Of the other side: all space, but for a plane across an axis."""
    out = F.when(s.getField("off").isNotNull(), _space())
    for n, k in enumerate("xyz"):
        out = out.when(s.getField("mnemonic") == f"p{k}", _box([F.get(s.getField("params"), F.lit(0)) if i == n else F.lit(-_INF) for i in range(3)], [F.lit(_INF)] * 3))
    return out.otherwise(_space())


def cell_boxes(found: DataFrame) -> DataFrame:
    """(deck, cell_id, box) of :func:`regions.geometry`: a box around each cell, by intervals; a complement may be anywhere."""
    known = F.map_from_entries(F.transform("surfaces", lambda s: F.struct(s.getField("surface_id").alias("key"), F.array(surface_box(s), _outside(s)).alias("value"))))

    def step(known: Column, stack: Column, w: Column) -> Column:
        n = F.size(stack)
        last, before = F.get(stack, n - 1), F.get(stack, n - 2)
        rest, under = F.slice(stack, 1, F.greatest(n - 1, F.lit(0))), F.slice(stack, 1, F.greatest(n - 2, F.lit(0)))
        side = lambda low, high: F.array(*[low(F.get(before, F.lit(k)), F.get(last, F.lit(k))) for k in range(3)], *[high(F.get(before, F.lit(k)), F.get(last, F.lit(k))) for k in range(3, 6)])
        of = F.try_element_at(known, F.abs(w.try_cast("int")))
        own = F.coalesce(F.get(of, F.when(F.startswith(w, F.lit("-")), 0).otherwise(1)), _space())
        push = lambda s, v: F.concat(s, F.array(v))
        return F.when(w == AND, push(under, side(F.greatest, F.least))).when(w == OR, push(under, side(F.least, F.greatest))).when(w == NOT, push(rest, _space())).otherwise(push(stack, own))

    box = lambda b, words: F.get(F.aggregate(words, F.array().cast("array<array<double>>"), lambda stack, w: step(b, stack, w)), F.lit(0))
    # an array of one names what is used often; boxes are found before their cells become rows, for a filter on a box would find it anew for every number that it
    # reads. Spark infers a filter for ``explode`` alike, but none for ``explode_outer``
    boxes = F.transform(F.array(known), lambda b: F.transform("cells", lambda c: F.struct(c.getField("cell_id").alias("cell_id"), F.coalesce(box(b, c.getField("words")), _space()).alias("box"))))
    return found.select("deck", F.explode_outer(F.get(boxes, F.lit(0))).alias("c")).where("c is not null").select("deck", "c.cell_id", "c.box")


def graveyards(decks: DataFrame, options: DeckOptions, margin: float = 0.1) -> DataFrame:
    """(deck, inner, outer) of decks (deck, value): a shell of two boxes around all cells that have bounds, each larger than what
    it holds by ``margin`` of the longest side. Decks of which no cell has bounds have none, nor has any if it is not asked for."""
    boxes = cell_boxes(geometry(decks)) if options.make_graveyard else cell_boxes(geometry(decks)).limit(0)
    b = lambda k: F.get("box", F.lit(k))
    finite = b(0) <= b(3)
    for k in range(6):
        finite = finite & (F.abs(b(k)) < _INF)
    hull = boxes.where(finite).groupBy("deck").agg(*[F.min(b(k)).alias(f"l{k}") for k in range(3)], *[F.max(b(k + 3)).alias(f"h{k}") for k in range(3)])
    side = F.greatest(*[F.col(f"h{k}") - F.col(f"l{k}") for k in range(3)]) * margin
    shell = lambda n: F.array(*[F.col(f"l{k}") - n * side for k in range(3)], *[F.col(f"h{k}") + n * side for k in range(3)])
    return hull.select("deck", shell(1).alias("inner"), shell(2).alias("outer"))


def groups(decks: DataFrame, options: DeckOptions) -> DataFrame:
    """(deck, name, cell_id): cells by material and density (void has none) and by importance, as far as the options ask."""
    found = cells(cards_of(decks))
    mats = found.where("material_id <> 0").select("deck", F.concat(F.lit("mat:"), F.col("material_id").cast("string"), F.lit("/rho:"), F.col("density").cast("string")).alias("name"), "cell_id")
    imps = found.select("deck", "cell_id", F.explode("params").alias("k", "v")).where(F.startswith("k", F.lit("imp:"))).select("deck", F.concat("k", F.lit("="), "v").alias("name"), "cell_id")
    return (mats if options.tag_materials else mats.limit(0)).unionByName(imps if options.tag_importances else imps.limit(0))


def cell_tags(decks: DataFrame, options: DeckOptions) -> DataFrame:
    """(deck, cell_id, global_id): the cell's own number, or without it its place in the deck."""
    order = cards_of(decks).where("section = 'cell'").select("deck", "ord", F.split_part(F.trim("card"), F.lit(" "), F.lit(1)).cast("int").alias("cell_id"))
    return order.select("deck", "cell_id", (F.col("cell_id") if options.tag_cell_ids else F.col("ord") + 1).alias("global_id"))
