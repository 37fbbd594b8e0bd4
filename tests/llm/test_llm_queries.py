"""The registered queries, and the pipeline stage by stage."""

import corpus_pipeline
import pytest
from cases import CLASH, docs_frame, random_texts
from oracle_check import compare, connect

import __spark_entry__ as contract
from lodgewise.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, sf_dir, name):
    assert compare(spark, connect(sf_dir), name, queries.QUERIES[name], queries.ORACLES[name], sf_dir) is None


def test_all_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, len(numbers) + 1)) and queries.QUERIES.keys() | {"pipeline"} <= contract.queries().keys()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "decontamination", "personal_data", "packing"]


def test_every_document_has_a_row(spark, sf_dir):
    ids = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").collect()}
    for name in ("op2_token_files", "op4_packing", "op5_repeats", "op6_jaccard_join", "op8_toxicity", "op9_personal_data", "op10_token_counts"):
        assert {r.doc_id for r in queries.QUERIES[name](spark, sf_dir).select("doc_id").collect()} == ids, name


def test_stages_take_effect(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    passage = spark.read.parquet(f"{sf_dir}/benchmark.parquet").filter("length(text) > 100").first().text
    own = " ".join(f"own{i} clean{i}" for i in range(60))
    added = [(900_000, own), (900_001, own.replace("own7 ", "other ")), (900_002, f"{own[::-1]} {passage} {own[::-1]}"), (900_003, f"write to me@there.example about {own[5:][::-1].upper()}"), (900_004, None), (900_005, "")]
    now = docs.unionByName(docs_frame(spark, added))
    for step, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, sf_dir).write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        if step < 4:
            assert now.columns == docs.columns
    stage = lambda name: {r.doc_id: r for r in spark.read.parquet(f"{tmp_path}/{name}").collect()}
    clean, alone, free, masked = (stage(n) for n, _ in corpus_pipeline.STAGES[:4])
    assert {d for d, _ in added} <= clean.keys() and 900_001 not in alone and 900_000 in alone
    assert 900_002 in alone and 900_002 not in free and free.keys() == masked.keys()
    assert masked[900_003].text.startswith("write to [EMAIL] about") and masked[900_003].n_chars == len(masked[900_003].text)
    assert {r.doc_id for r in now.select("doc_id").collect()} == masked.keys()


def test_stages_on_odd_tables(spark, sf_dir):
    rows = [(None, None), (None, "x y"), (1, "same text of some more words here"), (1, "same text of some more words here"), (2, ""), (3, random_texts(1)[0])]
    for table in (docs_frame(spark, rows, CLASH), docs_frame(spark, [])):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, sf_dir)
            n = out.count()
            if table.columns[-1] == CLASH[-1]:
                assert n == {"near_copies": 5}.get(name, 6), name
                assert name == "packing" or out.columns == table.columns
            else:
                assert n == 0
