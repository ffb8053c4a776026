import pytest

#: Names that the operators use for their own columns.
CLASHES = ["score", "held_out", "keys", "key", "cls", "rid", "node", "r", "_t", "_all", "_added", "_toxicity", "_language", "_row", "toks", "n", "h", "block", "chunk", "vec", "dim", "digest", "content", "shard", "bin", "offset", "spans", "rank"]
EDGE_TEXTS = [None, "", "   \n\t ", "a", "A  b", "a b", "Émile Zola, écrivain français né à Paris.", "<|endoftext|> x <|endoftext|>", "x" * 70_000, " ".join(f"w{k}" for k in range(20_000)), "\U0001f600 mail me: a@b.co or +1 (555) 010-2030 \U0001f600", "1.2.3.4 4111 1111 1111 1111", "same text here again and again", "same text here again and again"]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    rows = [(k, t, None if k % 3 == 0 else "en", None, None) for k, t in enumerate(EDGE_TEXTS)] + [(None, "text of nobody", None, None, None), (12, "same text here again and again", "en", "s", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", *(f"'{c}' as `{c}`" for c in CLASHES))


@pytest.fixture(scope="session")
def edge_dir(spark, edge_docs, tmp_path_factory):
    """A folder of tables with the edge documents and vectors, and one with empty tables."""
    at = tmp_path_factory.mktemp("edge")
    vectors = [(0, [1.0, 0.0], 1), (20, [1.0, 0.0], 1), (1, None, 1), (2, [0.0, 0.0], 1), (3, [float("nan"), 1.0], 1), (4, [2.0, 0.1], None), (None, [1.0, 0.0], 2), (5, [1.0, 0.0, 0.0], 1), (40, [], 1), (6, [None, 1.0], 1), (7, [-1.0, 0.0], 1), (7, [-1.0, 0.0], 1)]
    emb = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").selectExpr("*", *(f"'{c}' as `{c}`" for c in CLASHES))
    labels = spark.createDataFrame([(3, None, 1), (4, 1, 0), (None, 1, 1), (5, 1, None), (4, 1, 0), *((k, 1, 0) for k in range(8, 13))], "doc_id long, quality int, toxic int")
    for name, some in (("edge", 1 << 30), ("empty", 0)):
        for t, df in (("documents", edge_docs), ("embeddings", emb), ("labels", labels)):
            df.limit(some).coalesce(2).write.parquet(f"{at}/{name}/{t}.parquet")
    return str(at)
