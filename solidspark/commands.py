"""The command surface: a registry of names, and options that hold for one call."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

from solidspark.errors import ErrorCode, SolidError


@dataclass
class ExportOptions:
    """Keywords of an export with their defaults."""

    faceting_tolerance: float = 1e-3
    length_tolerance: float = 0.0
    normal_tolerance: int = 5
    make_watertight: bool = False
    verbose: bool = False
    fatal_on_curves: bool = False

    @classmethod
    def parse(cls, words: list[str]) -> ExportOptions:
        out, rest = cls(), iter(words)
        kinds = {f.name: type(f.default) for f in fields(cls)}
        for w in rest:
            if w not in kinds:
                raise SolidError(ErrorCode.INVALID_ARGUMENT, f"unknown keyword {w}")
            setattr(out, w, True if kinds[w] is bool else kinds[w](float(next(rest))))
        return out


def export_mesh(model, path: str, *words: str):
    """Write a model; its faceting report."""
    return model.export(path, ExportOptions.parse(list(words)))


def import_deck(spark, path: str, *words: str) -> dict:
    """The tables of the decks under ``path``, with the options and their warnings."""
    from solidspark.sources import deck

    options, warnings = deck.DeckOptions.parse(list(words))
    cards = deck.read_cards(spark, path)
    return {"cell": deck.cells(cards), "surface": deck.surfaces(cards), "material": deck.materials(cards), "param": deck.params(cards), "options": options, "warnings": warnings}


def geometry_smoke(points, radius: float = 2.0, radius2: float = 1.0):
    """A sphere and a torus, moved, turned, scaled, united and cut, applied to points (x, y, z)."""
    from pyspark.sql import functions as F

    from solidspark.functions.solid import Sphere, Torus

    body = Sphere(radius).moved(radius, 0, 0) | Torus(radius, radius2).rotated(45, (1, 0, 0)).scaled((0, 0, 0), (1, 1, 0.5))
    return points.where(body.section((0, 0, 1), 0.0).contains(F.col("x"), F.col("y"), F.col("z")))


COMMANDS: dict[str, Callable] = {"export_mesh": export_mesh, "import_deck": import_deck, "geometry_smoke": geometry_smoke}


def keys() -> list[str]:
    return list(COMMANDS)


def create_command(key: str) -> Callable | None:
    """None for an unknown key."""
    return COMMANDS.get(key)
