"""Decks as a Spark data source: ``spark.dataSource.register(DeckSource)``, then ``spark.read.format("deck").load(folder)``.

Rows are cards (deck, section, ord, card), as of :func:`solidspark.sources.deck.cards_of`; ``deck`` is the path of a file. Files are dealt to
partitions by their sizes, at most ``partition_bytes`` (64 MB by default) each but for a single larger file; a deck is read whole by one task, for
a card's section depends on the blank lines before it. With a schema of fewer columns only those are made and moved; ``sections`` (separated by
commas) keeps the cards of some sections. An empty folder gives no rows, a path that is not there is an error. Where ``path`` names a remote store the
file systems of Arrow open it on the driver (names and sizes alone) and in the tasks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from solidspark.errors import ErrorCode, SolidError
from solidspark.sources.deck import CARDS, split_cards

PARTITION_BYTES = 64 << 20


@dataclass
class DeckFiles(InputPartition):
    """The files of one task."""

    paths: list[str]


def _opened(path: str):
    """The file system of a path or address, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class DeckReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.path, self.columns = options.get("path"), schema.fieldNames()
        if not self.path:
            raise SolidError(ErrorCode.INVALID_ARGUMENT, "no path of decks")
        unknown = set(self.columns) - {c.split()[0] for c in CARDS.split(", ")}
        if unknown:
            raise SolidError(ErrorCode.INVALID_ARGUMENT, f"cards have no {sorted(unknown)}")
        self.sections = {s.strip() for s in options["sections"].split(",")} if "sections" in options else None
        self.most = int(options.get("partition_bytes", PARTITION_BYTES))

    def partitions(self) -> list[DeckFiles]:
        from pyarrow import fs

        store, root = _opened(self.path)
        found = store.get_file_info(root)
        if found.type == fs.FileType.NotFound:
            raise SolidError(ErrorCode.FILE_NOT_FOUND)
        files = [found] if found.is_file else store.get_file_info(fs.FileSelector(root, recursive=True))
        parts, held = [], self.most
        for f in sorted((f for f in files if f.is_file and not f.base_name.startswith(("_", "."))), key=lambda f: f.path):
            if held + f.size > self.most or not parts:
                parts.append(DeckFiles([]))
                held = 0
            parts[-1].paths.append(f.path)
            held += f.size
        return parts or [DeckFiles([])]

    def read(self, partition: DeckFiles) -> Iterator[tuple]:
        store, _ = _opened(self.path)
        for path in partition.paths:
            with store.open_input_stream(path) as f:
                text = f.read().decode("utf-8", "replace")
            for section, ord_, card in split_cards(text):
                if self.sections is None or section in self.sections:
                    row = {"deck": path, "section": section, "ord": ord_, "card": card}
                    yield tuple(row[c] for c in self.columns)


class DeckSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "deck"

    def schema(self) -> str:
        return CARDS

    def reader(self, schema: StructType) -> DeckReader:
        return DeckReader(dict(self.options), schema)
