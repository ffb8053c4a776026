"""Every query and stage over edge rows and over empty tables."""

import pytest

import corpus_pipeline
from skyloom.llm.queries import QUERIES

PER_DOCUMENT = ["op2_token_counts", "op3_toxicity", "op5_jaccard", "op6_language", "op7_bpe", "op8_pii", "op10_licenses", "op11_token_binary", "op12_merkle"]


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_one_row_a_document(spark, edge_dir, name):
    docs = spark.read.parquet(f"{edge_dir}/edge/documents.parquet")
    got = QUERIES[name](spark, f"{edge_dir}/edge").collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0)
    assert [r.doc_id for r in sorted(got, key=key)] == [r.doc_id for r in sorted(docs.select("doc_id").collect(), key=key)]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, edge_dir, name):
    assert QUERIES[name](spark, f"{edge_dir}/empty").count() == 0


def test_stages_keep_columns_and_pass_empty_tables(spark, edge_dir):
    for folder, some in (("edge", True), ("empty", False)):
        docs = spark.read.parquet(f"{edge_dir}/{folder}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, f"{edge_dir}/{folder}")
            assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
            rows = out.collect()
            assert bool(rows) == some, name
            for r in rows:  # clashing columns keep their values
                assert r["_toxicity"] == "_toxicity" and r["_t"] == "_t" and r["_row"] == "_row"
        assert bool(corpus_pipeline.STAGES[-1][1](spark, docs, f"{edge_dir}/{folder}").count()) == some


def test_near_duplicate_stage_keeps_one_of_repeated_rows(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/edge/documents.parquet")
    kept = corpus_pipeline.STAGES[2][1](spark, docs, f"{edge_dir}/edge").collect()
    assert [r.doc_id for r in kept if r.text == "same text here again and again"] == [12]


BIG = [9007199254740993, None, 9007199254740995, 9223372036854775807, -9223372036854775807]


def test_ids_of_nineteen_digits_beside_null(spark, tmp_path):
    """No id goes through a double, whatever nulls share its batch."""
    text = " ".join(f"w{k}" for k in range(40))
    texts = [text, text + " x", "one two three", "four five", "six"]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", None, None) for i, t in zip(BIG, texts, strict=True)], schema).coalesce(1)
    vectors = spark.createDataFrame([(i, [1.0, float(k)], None) for k, i in enumerate(BIG)], "vec_id long, embedding array<float>, label int").coalesce(1)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    vectors.write.parquet(f"{tmp_path}/embeddings.parquet")
    spark.createDataFrame([(BIG[0], 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    key = lambda x: (x is None, x or 0)
    for name in (*PER_DOCUMENT, "op4_packing"):
        got = QUERIES[name](spark, str(tmp_path)).collect()
        assert sorted((r.doc_id for r in got), key=key) == sorted(BIG, key=key), name
        if name == "op5_jaccard":
            assert {r.doc_id: r.component_id for r in got} == {BIG[0]: BIG[0], None: BIG[0], BIG[2]: BIG[2], BIG[3]: BIG[3], BIG[4]: BIG[4]}
    got = QUERIES["op9_embedding_dedup"](spark, str(tmp_path)).collect()
    assert sorted((r.vec_id for r in got), key=key) == sorted(BIG, key=key)
    stage = corpus_pipeline.STAGES[2][1](spark, docs, str(tmp_path)).collect()
    assert sorted((r.doc_id for r in stage), key=key) == sorted((i for i in BIG if i is not None), key=key)


def test_many_rows_without_an_id_share_no_shard(spark):
    """Shards are drawn by row: half of all rows without an id are packed like any others."""
    from skyloom.llm import op4_packing as o4

    docs = spark.createDataFrame([(None if k % 2 else k, "a b c") for k in range(400)], "doc_id long, text string")
    rows = o4.pack_documents(docs, shard_rows=20, capacity=64).collect()
    assert len(rows) == 400 and sum(r.doc_id is None for r in rows) == 200
