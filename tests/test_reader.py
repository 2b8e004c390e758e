"""Decks as a data source, and saving by file type."""

import pytest

from solidspark.errors import ErrorCode, SolidError
from solidspark.model import Model
from solidspark.sources import deck, files
from solidspark.sources.reader import DeckReader, DeckSource


@pytest.fixture
def folder(spark, tmp_path):
    spark.dataSource.register(DeckSource)
    for k in range(30):
        sub = tmp_path / f"d{k % 3}"
        sub.mkdir(exist_ok=True)
        (sub / f"{k}.deck").write_text(f"deck {k}\n{k} 1 -2.5 -1 imp:n=1\nc nothing\n{k + 100} 0 1\n\n1 so\n     {k}.5\n\nm1 1001 1\n")
    (tmp_path / "_SUCCESS").write_text("")
    return str(tmp_path)


def test_source_equals_texts(spark, folder):
    got = spark.read.format("deck").load(folder)
    want = deck.read_cards(spark, f"{folder}/*/*")
    short = lambda df: sorted((r.deck.split("/")[-1], r.section, r.ord, r.card) for r in df.collect())
    assert short(got) == short(want) and len(short(got)) == 150
    assert {r.cell_id for r in deck.cells(got).collect()} == {k + n for k in range(30) for n in (0, 100)}
    assert {tuple(r.params) for r in deck.surfaces(spark.read.format("deck").load(f"file://{folder}")).collect()} == {(k + 0.5,) for k in range(30)}


def test_source_prunes_and_deals(spark, folder):
    cards = spark.read.format("deck").schema("card string").option("sections", "surface, data").load(folder)
    assert cards.columns == ["card"] and cards.count() == 60
    dealt = spark.read.format("deck").option("partition_bytes", "200").load(folder)
    assert dealt.rdd.getNumPartitions() > 5 and dealt.count() == 150
    one = spark.read.format("deck").load(f"{folder}/d0/0.deck")
    assert one.rdd.getNumPartitions() == 1 and one.count() == 5


def test_source_of_nothing(spark, folder, tmp_path):
    (tmp_path / "none").mkdir()
    assert spark.read.format("deck").load(str(tmp_path / "none")).count() == 0
    with pytest.raises(SolidError) as wrong:
        DeckReader({"path": str(tmp_path / "gone")}, spark.read.format("deck").load(folder).schema).partitions()
    assert wrong.value.code == ErrorCode.FILE_NOT_FOUND
    with pytest.raises(Exception, match="cards have no"):
        spark.read.format("deck").schema("other string").load(folder).count()


def test_saving_by_type(spark, tmp_path):
    tables = {"entity": spark.createDataFrame([(1, 3), (2, 2)], "ent_id long, dim int")}
    model = Model(spark, tables=tables)
    assert model.save(str(tmp_path / "a.sat")) == "ACIS_SAT"
    assert model.save(str(tmp_path / "b"), [f"TYPE={files.FILE_TYPES[0]}"]) == files.FILE_TYPES[0]
    back = Model.open(spark, str(tmp_path / "a.sat"))
    assert sorted(r.ent_id for r in back["entity"].collect()) == [1, 2]
    for name, options, code in (("c", [], "FAILURE"), ("c.sat", ["SIZE=3"], "INVALID_ARGUMENT"), ("c.sat", ["TYPE=other"], "NOT_SUPPORTED")):
        with pytest.raises(SolidError) as wrong:
            model.save(str(tmp_path / name), options)
        assert wrong.value.code == ErrorCode[code] and model.error.code == ErrorCode[code]
    with pytest.raises(SolidError) as wrong:
        model.save(str(tmp_path / "a.sat"))
    assert wrong.value.code == ErrorCode.FILE_WRITE_ERROR
