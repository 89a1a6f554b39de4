"""The corpus pipeline on a small table with planted cases."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from cartwheel.llm import pieces
from tests.llm.test_operators import PRIVATE, edited, prose

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    item, base = prose(900, 40), prose(901, 100)
    rows = [(i, prose(i, 60 + i)) for i in range(30)]
    rows += [(40, base), (41, base), (42, edited(base, [50])), (50, f"{prose(77, 30)} {item} {prose(78, 30)}")]
    rows += [(60, None), (61, ""), (62, "12 34"), (70, prose(70, 40) + " " + PRIVATE[0][1]), (40, base), (None, prose(80, 50))]
    data = [(i, t, "en" if k % 2 else "fr", "s", len(t or "")) for k, (i, t) in enumerate(rows)]
    spark.createDataFrame(data, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_run(spark, tables):
    texts = {}
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, tables)
        assert sorted(kept.columns) == sorted(docs.columns), name
        docs = spark.createDataFrame(kept.collect(), docs.schema)
        texts[name] = sorted((r.doc_id for r in docs.collect()), key=lambda x: (x is None, x))
    assert not {60, 61, 62} & set(texts["language_id"]) and 41 in texts["language_id"]
    assert not {41, 42} & set(texts["near_dedup"]) and texts["near_dedup"].count(40) == 1 and None in texts["near_dedup"]
    assert 50 not in texts["decontamination"] and set(range(30)) <= set(texts["decontamination"])
    assert texts["pii"] == texts["decontamination"]
    last = corpus_pipeline.run(spark, tables).collect()
    assert sorted((r.doc_id for r in last), key=lambda x: (x is None, x)) == texts["pii"]
    private = next(r for r in last if r.doc_id == 70)
    assert b"555-2485" not in pieces.decode(private.pieces) and all(r.lossless for r in last)


def test_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)} and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
