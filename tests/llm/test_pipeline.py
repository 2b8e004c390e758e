"""The pipeline's stages by their contracts, and the whole against brute force where a rule decides."""

import random
import subprocess
import sys
from collections import Counter, defaultdict
from pathlib import Path

import pytest

import corpus_pipeline
from tests.llm.test_operators import SCHEMA, brute_repeats, components, sentence, shingle_sets, three_lines

ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    where, rng = tmp_path_factory.mktemp("tables"), random.Random(7)
    texts = ["\n".join(sentence(rng, 12) for _ in range(8)) for _ in range(120)]
    bad = [" ".join(w + "$$$" for w in sentence(rng, 60).split()) for _ in range(40)]
    leak = sentence(rng, 40)
    rows = [(k, t) for k, t in enumerate([*texts, *bad])]
    rows += [(300, texts[3]), (301, texts[4].replace(" ", " x ", 1)), (302, sentence(rng, 40) + "\n" + leak), (303, texts[5] + "\n" + sentence(rng, 30)), (304, None), (305, "")]
    spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], SCHEMA).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame([(k, int(k < 120), 0) for k in range(0, 160, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    return str(where)


def test_stages(spark, sf_dir, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "MinHash near-dedup", "benchmark decontamination", "best-fit packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, []
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert k == 4 or docs.columns == columns
        kept.append({r.doc_id: r for r in docs.collect()})
    good = set(range(120)) | {300, 301, 302, 303}
    assert good <= set(kept[0]) and not set(range(120, 160)) & set(kept[0])
    rules = {k[0]: v for k, v in brute_repeats([(d, r.text) for d, r in kept[0].items()], lambda t: t.split("\n"), "\n", three_lines).items()}
    assert {d: r.text for d, r in kept[1].items()} == {d: t for d, (n, gone, t) in rules.items() if not n or gone < n}
    assert 300 not in kept[1] and all(r.n_chars == (None if r.text is None else len(r.text)) for r in kept[1].values())
    ids = sorted(kept[1])
    sets = shingle_sets([kept[1][d].text for d in ids])
    assert set(kept[2]) == {d for d, c, own in zip(ids, components(sets, ids), sets, strict=True) if not own or c == d}
    assert set(kept[2]) - set(kept[3]) == {302}
    assert set(kept[4]) == set(kept[3])


def test_run_is_the_stages_in_turn(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir).collect()
    sequences = defaultdict(int)
    for r in got:
        sequences[r.sequence_id] += r.length
    assert max(sequences.values()) <= 2048 and max(Counter((r.doc_id, r.piece) for r in got).values()) == 1


def test_the_rest_works_without_these_folders(tmp_path):
    """The entry module imports, with its other queries, where the llm folders and the pipeline are missing."""
    for name in ("solidspark", "__spark_entry__.py"):
        subprocess.run(["cp", "-r", str(ROOT / name), str(tmp_path)], check=True)
    subprocess.run(["rm", "-r", str(tmp_path / "solidspark/llm")], check=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'csg_cells' in q and 'pipeline' not in q and not any(k.startswith('op1_') for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
