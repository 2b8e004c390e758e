"""Decks of cells and surfaces: a reader of their text, and cells as predicates over points.

Grammar: a title, cell cards, a blank line, surface cards, a blank line, data cards. Comment lines (``c``),
``$`` comments, continuation by five leading blanks, unions (``:``), complements (``#n``) and surface kinds
besides origin spheres follow the public deck manuals and are our extension."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, fields

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from solidspark.errors import ErrorCode, SolidError

CARDS = "deck string, section string, ord int, card string"
CELL = "deck string, cell_id int, material_id int, density double, region array<string>, params map<string,string>"


@dataclass
class DeckOptions:
    """Keywords of an import; per call."""

    verbose: bool = False
    debug: bool = False
    debug_output: bool = False
    debug_input: bool = False
    extra_effort: bool = False
    uwuw_names: bool = False
    tag_materials: bool = True
    merge_geometry: bool = True
    tag_importances: bool = True
    tag_cell_ids: bool = True
    make_graveyard: bool = True
    imprint_geometry: bool = True
    tolerance: float | None = None

    @classmethod
    def parse(cls, words: list[str]) -> tuple[DeckOptions, list[str]]:
        """Options and warnings. ``skip_*`` turns a default off; ``tol`` takes the next word."""
        skips = {"skip_mats": "tag_materials", "skip_merge": "merge_geometry", "skip_imps": "tag_importances", "skip_nums": "tag_cell_ids", "skip_graveyard": "make_graveyard", "skip_imprint": "imprint_geometry"}
        flags = {f.name for f in fields(cls) if f.default is False}
        out, warnings, rest = cls(), [], iter(words)
        for w in rest:
            if w in skips:
                setattr(out, skips[w], False)
            elif w == "tol":
                out.tolerance = float(next(rest))
                if not 0 < out.tolerance <= 0.1:
                    warnings.append(f"tolerance {out.tolerance} is unusual")
            elif w in flags:
                setattr(out, w, True)
            else:
                raise SolidError(ErrorCode.INVALID_ARGUMENT, f"unknown keyword {w}")
        if out.merge_geometry and not out.imprint_geometry:
            warnings.append("merging without imprinting")
        if out.debug_input and not out.debug:
            out.debug = True
        else:
            out.debug_input = False
        return out, warnings


def split_cards(text: str) -> list[tuple[str, int, str]]:
    """(section, ord, card) of a deck; sections: title, cell, surface, data."""
    lines = text.split("\n")
    out = [("title", 0, lines[0].strip())]
    sections, k, n = ("cell", "surface", "data"), 0, 0
    for line in lines[1:]:
        if not line.strip():
            if n:
                k, n = k + 1, 0
            if k > 2:
                break
            continue
        if re.match(r" {0,4}[cC](\s|$)", line):
            continue
        card = line.split("$")[0].rstrip()
        if not card.strip():
            continue
        if card.startswith("     ") and n:
            s, o, c = out[-1]
            out[-1] = (s, o, f"{c} {card.strip()}")
        else:
            out.append((sections[k], n, card.strip()))
            n += 1
    return out


def cards_of(decks: DataFrame) -> DataFrame:
    """The cards of decks (deck, value): their names and texts."""

    def cards(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(d, *c) for d, t in zip(frame["deck"], frame["value"], strict=True) for c in split_cards(t)]
            yield pd.DataFrame(rows, columns=["deck", "section", "ord", "card"])

    return decks.select("deck", "value").mapInPandas(cards, CARDS)


def read_cards(spark: SparkSession, path: str) -> DataFrame:
    """The cards of every deck under ``path``."""
    return cards_of(spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("deck"), "value"))


def cells(cards: DataFrame) -> DataFrame:
    """(deck, cell_id, material_id, density, region, params); material 0 has no density."""
    c = cards.where("section = 'cell'").select("deck", F.regexp_extract_all("card", F.lit(r"\S+=\S+"), F.lit(0)).alias("ps"), F.split(F.trim(F.regexp_replace("card", r"\S+=\S+", "")), r"\s+").alias("w"))
    void = F.get("w", F.lit(1)).cast("int") == 0
    region = F.slice("w", F.when(void, 3).otherwise(4), F.size("w"))
    pairs = F.map_from_entries(F.transform("ps", lambda p: F.struct(F.lower(F.split_part(p, F.lit("="), F.lit(1))), F.split_part(p, F.lit("="), F.lit(2)))))
    return c.select("deck", F.get("w", F.lit(0)).cast("int").alias("cell_id"), F.get("w", F.lit(1)).cast("int").alias("material_id"), F.when(~void, F.get("w", F.lit(2)).cast("double")).alias("density"), region.alias("region"), pairs.alias("params"))


def surfaces(cards: DataFrame) -> DataFrame:
    """(deck, surface_id, mnemonic, params)."""
    w = cards.where("section = 'surface'").select("deck", F.split("card", r"\s+").alias("w"))
    return w.select("deck", F.get("w", F.lit(0)).cast("int").alias("surface_id"), F.lower(F.get("w", F.lit(1))).alias("mnemonic"), F.transform(F.slice("w", 3, F.size("w")), lambda v: v.cast("double")).alias("params"))


def materials(cards: DataFrame) -> DataFrame:
    """(deck, material_id, ord, zaid, fraction) of the m cards."""
    m = cards.where("section = 'data'").where(F.col("card").rlike(r"^[mM]\d+\s")).select("deck", F.split("card", r"\s+").alias("w"))
    pairs = F.transform(F.sequence(F.lit(0), F.floor((F.size("w") - 1) / 2).cast("int") - 1), lambda k: F.struct(k.alias("ord"), F.get("w", 2 * k + 1).cast("int").alias("zaid"), F.get("w", 2 * k + 2).cast("double").alias("fraction")))
    return m.select("deck", F.substring(F.get("w", F.lit(0)), 2, 9).cast("int").alias("material_id"), F.explode(pairs).alias("p")).select("deck", "material_id", "p.*")


def params(cards: DataFrame) -> DataFrame:
    """(deck, ord, keyword, args) of the other data cards."""
    d = cards.where("section = 'data'").where(~F.col("card").rlike(r"^[mM]\d+\s")).select("deck", "ord", F.split("card", r"\s+").alias("w"))
    return d.select("deck", "ord", F.lower(F.get("w", F.lit(0))).alias("keyword"), F.slice("w", 2, F.size("w")).alias("args"))


def surface_value(mnemonic: str, p: list[float], x: Column, y: Column, z: Column) -> Column:
    """Negative inside (or below) a surface, positive outside."""
    at = dict(zip("xyz", (x, y, z), strict=True))
    n = lambda v: F.lit(float(v))
    sq = lambda c: c * c
    if mnemonic == "so":
        return sq(x) + sq(y) + sq(z) - n(p[0] ** 2)
    if mnemonic == "s":
        return sq(x - n(p[0])) + sq(y - n(p[1])) + sq(z - n(p[2])) - n(p[3] ** 2)
    if mnemonic in ("px", "py", "pz"):
        return at[mnemonic[1]] - n(p[0])
    if mnemonic == "p":
        return n(p[0]) * x + n(p[1]) * y + n(p[2]) * z - n(p[3])
    if mnemonic in ("cx", "cy", "cz"):
        a, b = (c for k, c in at.items() if k != mnemonic[1])
        return sq(a) + sq(b) - n(p[0] ** 2)
    raise SolidError(ErrorCode.NOT_SUPPORTED, f"surface {mnemonic}")


def region_predicate(region: list[str], values: dict[int, Column], cells_by_id: dict[int, list[str]] | None = None) -> Column:
    """Blanks are AND, ``:`` is OR and binds less, ``#n`` is not cell n, parentheses group."""
    words = re.findall(r"#?\(|\)|:|#\d+|[+-]?\d+", " ".join(region))
    at = 0

    def union() -> Column:
        nonlocal at
        out = both()
        while at < len(words) and words[at] == ":":
            at += 1
            out = out | both()
        return out

    def both() -> Column:
        nonlocal at
        out = None
        while at < len(words) and words[at] not in (":", ")"):
            w = words[at]
            at += 1
            if w.endswith("("):
                one = union()
                at += 1
                one = ~one if w[0] == "#" else one
            elif w[0] == "#":
                one = ~region_predicate((cells_by_id or {})[int(w[1:])], values, cells_by_id)
            else:
                one = values[abs(int(w))] < 0 if w[0] == "-" else values[int(w)] > 0
            out = one if out is None else out & one
        return F.lit(True) if out is None else out

    return union()


def cell_of(x: Column, y: Column, z: Column, cell_rows: list, surface_rows: list) -> Column:
    """The cell of a point as one CASE, first cell first; null on no cell. Rows: those of one deck, collected."""
    values = {s.surface_id: surface_value(s.mnemonic, s.params, x, y, z) for s in surface_rows}
    by_id = {c.cell_id: c.region for c in cell_rows}
    out = F.lit(None).cast("int")
    for c in reversed(cell_rows):
        out = F.when(region_predicate(c.region, values, by_id), F.lit(c.cell_id)).otherwise(out)
    return out
