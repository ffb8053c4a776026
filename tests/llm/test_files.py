"""Token files with Elias-Fano boundaries, and the Merkle manifest, against plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.llm import op11_token_binary as files
from skyloom.llm import op12_merkle as merkle
from skyloom.llm.common import fresh_path
from skyloom.llm.elias_fano import EliasFano, encode
from skyloom.llm.op2_token_counts import vocabulary_path


@pytest.mark.parametrize("numbers", [[], [0], [7], [0, 0, 0], [5, 5, 900], [0, 2**63, 2**64 - 1], list(range(0, 100_000, 7)), [3] * 500, [0] * 70 + [10**12]])
def test_sequence_returns_its_numbers(numbers):
    made = EliasFano(encode(np.array(numbers, dtype=np.uint64)))
    assert made.values().tolist() == numbers and len(made) == len(numbers)
    assert [made.select(i) for i in range(len(numbers))] == numbers
    for x in {0, 1, 5, 8, 899, 10**12, *numbers[:50]}:
        assert made.first_at_least(x) == int(np.searchsorted(np.array(numbers, dtype=np.uint64), np.uint64(x)))
    with pytest.raises(IndexError):
        made.select(len(numbers))


def test_sequence_of_random_numbers_is_small():
    rng = random.Random(1)
    for n, top in ((1, 1), (65, 64), (1000, 10**6), (5000, 5000), (4096, 2**50)):
        numbers = sorted(rng.randrange(top) for _ in range(n))
        data = encode(np.array(numbers, dtype=np.uint64))
        made = EliasFano(data)
        assert made.values().tolist() == numbers and all(made.select(i) == numbers[i] for i in rng.sample(range(n), min(n, 300)))
        # two bits and the low part a number, half a bit for samples, and a head
        assert 8 * len(data) <= n * (2.6 + max(0, np.log2(max(1, top / n)) + 1)) + 400
    with pytest.raises(ValueError):
        encode(np.array([2, 1]))


def test_ids_are_the_library_s():
    from tokenizers import Tokenizer

    library, (made, width) = Tokenizer.from_file(vocabulary_path()), files.encoder(vocabulary_path())
    assert width == 2
    rng, alphabet = random.Random(3), list("abcXYZ'sdtl 019.,!?-_#\t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0   ​᠎﻿　éÉßİıσΣςé̈각한字あ٣\U0001f600\x00퟿")
    texts = ["", " ", "<|endoftext|>", "a<|endoftext|>b <|startoftext|>", "x" * 5000, "don't we'll 'S 's", *("".join(rng.choices(alphabet, k=rng.randrange(1, 60))) for _ in range(3000))]
    for t in texts:
        assert np.frombuffer(made(t), "<u2").tolist() == [*library.encode(t, add_special_tokens=False).ids, 2], repr(t)


def _want_files(rows):
    """(doc_id, start, n_tokens, crc) in order; equal ids by the digest that the operator names."""
    from tokenizers import Tokenizer

    library, at, out = Tokenizer.from_file(vocabulary_path()), 0, []
    for doc_id, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def _rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit("")))).collect()]


@pytest.mark.parametrize("ids, docs", [(1 << 17, 1 << 15), (300, 5), (1, 1)])
def test_files_return_every_document(spark, edge_docs, monkeypatch, ids, docs):
    monkeypatch.setattr(files, "SEGMENT_IDS", ids)
    monkeypatch.setattr(files, "SEGMENT_DOCS", docs)
    want = _want_files(_rows_of(edge_docs))
    out = files.write_binary(edge_docs, fresh_path(spark, "files"))
    assert sorted(map(tuple, files.documents(spark, out).collect()), key=lambda r: r[1]) == want
    assert sorted(map(tuple, files.boundaries(spark, out).collect()), key=lambda r: r[1]) == [r[:3] for r in want]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        files.write_binary(edge_docs, out)


def test_files_of_one_id_are_spread_and_far_ids_are_exact(spark):
    df = spark.createDataFrame([(7, f"word {k}") for k in range(400)] + [(-(2**63), "least"), (2**63 - 1, "most")], "doc_id long, text string").repartition(3)
    out = files.write_binary(df, fresh_path(spark, "files"))
    assert sorted(map(tuple, files.documents(spark, out).collect()), key=lambda r: r[1]) == _want_files(_rows_of(df))
    assert files.segments(spark, out).select("shard").distinct().count() > 1


def test_files_of_an_empty_table(spark, edge_docs):
    out = files.write_binary(edge_docs.limit(0), fresh_path(spark, "files"))
    assert files.documents(spark, out).collect() == [] and files.fetch(spark, out, [1]).collect() == []


def test_fetched_documents_hold_their_ids(spark, sf_dir, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(files, "SEGMENT_DOCS", 90)
    docs, library = spark.read.parquet(f"{sf_dir}/documents.parquet"), Tokenizer.from_file(vocabulary_path())
    out, text = files.write_binary(docs, fresh_path(spark, "files")), {r.doc_id: r.text for r in docs.collect()}
    asked = [*sorted(text)[::9], 10**15, -4]
    got = {r.doc_id: r for r in files.fetch(spark, out, asked).collect()}
    assert set(got) == set(asked) & set(text)
    start = {r.doc_id: r.start for r in files.boundaries(spark, out).collect()}
    assert all(r.ids == [*library.encode(text[d], add_special_tokens=False).ids, 2] and r.start == start[d] for d, r in got.items())
    assert {r.doc_id for r in files.fetch(spark, out, sorted(text)).collect()} == set(text)


def test_op11_gives_what_the_library_gives(spark, sf_dir):
    rows = files.op11_token_binary(spark, sf_dir).collect()
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == _want_files(_rows_of(spark.read.parquet(f"{sf_dir}/documents.parquet")))


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([_h(*out[-1][k : k + 2]) for k in range(0, len(out[-1]), 2)])
    return out


def _want_proofs(rows):
    """Brute force: (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of rows in the table's column order."""
    said = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: _h(*(said(r[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")))
    order = lambda v: (v is not None, v if v is not None else 0)
    langs = sorted({r["lang"] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees, subroots = {}, []
    for lang in langs:
        own = sorted((r for r in rows if r["lang"] == lang), key=lambda r: (order(r["doc_id"]), leaf(r)))
        trees[lang] = own, _levels([leaf(r) for r in own])
        subroots.append(trees[lang][1][-1][0])
    top, out = _levels(subroots), []
    for k, lang in enumerate(langs):
        own, levels = trees[lang]
        for i, r in enumerate(own):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            now, proof = leaf(r | {"n_chars": None if r["n_chars"] is None else r["n_chars"] + hit}), []
            for some, at in ((levels, i), (top, k)):
                for nodes in some[:-1]:
                    near = nodes[at ^ 1 : (at ^ 1) + 1]
                    proof += near
                    now = _h(*(near + [now] if at % 2 else [now] + near))
                    at //= 2
            out.append((r["doc_id"], levels[0][i], levels[-1][0], top[-1][0], _h(*proof), now, now == top[-1][0]))
    return sorted(out, key=str)


def _tables(spark, df, folder):
    df.write.parquet(f"{folder}/documents.parquet")
    return sorted(map(tuple, merkle.op12_merkle(spark, str(folder)).collect()), key=str)


def test_manifest_of_edge_rows(spark, edge_docs, tmp_path):
    df = edge_docs.withColumn("n_chars", F.when(F.col("doc_id") % 2 == 0, F.lit(2**63 - 1)).otherwise(F.col("n_chars")))
    got = _tables(spark, df.repartition(3), tmp_path)
    assert got == _want_proofs([r.asDict() for r in df.collect()]) and not all(r[-1] for r in got)


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 2, None: 1}, {"a": 63, "b": 64, "c": 65, "": 128}, {"é": 4097, "z": 3, None: 129}])
def test_manifest_of_trees_of_all_sizes(spark, tmp_path, sizes):
    rows = [(k * 3 + 1, "s", lang, k, f"text {k}") for lang, n in sizes.items() for k in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    assert _tables(spark, df, tmp_path) == _want_proofs([r.asDict() for r in df.collect()])


def test_manifest_of_many_languages_and_repeated_rows(spark, tmp_path):
    rows = [(k % 50, None, f"lang{k % 300}", None, "same") for k in range(900)] * 2
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert _tables(spark, df, tmp_path) == _want_proofs([r.asDict() for r in df.collect()])


def test_manifest_can_be_opened_again(spark, sf_dir):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), fresh_path(spark, "merkle")
    made, again = merkle.write_manifest(docs, out), merkle.open_manifest(spark, out)
    assert made.root == again.root and len(made.leaves) == len(again.leaves)
    assert merkle.proofs(again).filter("folded_root = root").count() == docs.count()


def test_manifest_of_an_empty_table(spark, edge_docs):
    made = merkle.write_manifest(edge_docs.limit(0), fresh_path(spark, "merkle"))
    assert made.root is None and merkle.proofs(made).collect() == []
