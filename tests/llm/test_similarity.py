"""Joins and searches against brute force."""

import random

import numpy as np
import pytest

from skyloom.llm import common
from skyloom.llm import op1_ann as o1
from skyloom.llm import op5_jaccard as o5
from skyloom.llm import op9_embedding_dedup as o9
from skyloom.llm.components import components
from skyloom.llm.signature_tree import Union, enough, joined, overlap


def roots(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(k) for k in range(n)]


def test_components(spark):
    draw = random.Random(1)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 460)] + [(500, k) for k in range(501, 600)]
    df = spark.createDataFrame([(a, b) for a, b in links], "a long, b long")
    want = roots(600, links)
    touched = {x for a, b in links if a != b for x in (a, b)}
    assert {r.node: r.root for r in components(df).collect()} == {x: want[x] for x in touched}
    assert components(df.limit(0)).count() == 0


def test_written_tables_can_be_cleaned(spark):
    import os

    df = common.materialize(spark.range(3), "t")
    path = df.inputFiles()[0].removeprefix("file://")
    assert df.count() == 3 and os.path.exists(path)
    common.clean(spark)
    assert not os.path.exists(path)


def test_dual_traversal_finds_all_components():
    draw = np.random.default_rng(2)
    sets = []
    for _ in range(12):
        base = draw.integers(0, 1 << 62, draw.integers(3, 200)).astype(np.uint64)
        sets += [np.unique(np.where(draw.random(len(base)) < draw.choice([0, 0.05, 0.12, 0.3]), draw.integers(0, 1 << 62, len(base)).astype(np.uint64), base)) for _ in range(15)]
    known = Union(len(sets))
    joined(sets, known, np.arange(len(sets)), None)
    similar = [(a, b) for a in range(len(sets)) for b in range(a) if enough(overlap(sets[a], sets[b]), len(sets[a]), len(sets[b]), 80, 100)]
    assert [known.find(k) for k in range(len(sets))] == roots(len(sets), similar)


def shingle_sets(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)]) if w else frozenset()


def planted():
    """Near copies, chains, texts right at the threshold, a shared passage, copies and short texts."""
    draw = random.Random(7)
    word = lambda: f"w{draw.randrange(10**6)}"
    texts, base, passage = [], [word() for _ in range(150)], [word() for _ in range(60)]
    for _ in range(120):
        t = list(base)
        for _ in range(draw.randint(0, 9)):
            t[draw.randrange(len(t))] = word()
        texts.append(" ".join(t))
    texts += [" ".join([word() for _ in range(40)] + passage + [word() for _ in range(40)]) for _ in range(60)]
    chain = [word() for _ in range(100)]
    for k in range(20):
        texts.append(" ".join(chain[2 * k : 2 * k + 60]))
    for cut in range(1, 12):  # sizes that meet or miss the bound by one shingle
        t = [word() for _ in range(49)]
        texts += [" ".join(t), " ".join(t[: 49 - cut]), " ".join(t[:45])]
    return texts + [texts[0]] * 5 + ["a b", "A\tB", "b a", "", "a b c d e", "a b c d e f"]


@pytest.mark.parametrize("chunk", [8, 1024])
def test_jaccard_components(spark, chunk):
    texts = planted()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in o5.jaccard_components(df, chunk=chunk).collect()}
    sets = [shingle_sets(t) for t in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert [got[k].component_id for k in range(len(texts))] == roots(len(texts), links)
    assert [got[k].n_shingles for k in range(len(texts))] == [len(s) for s in sets]


def test_a_notice_of_many_unlike_texts_names_no_block(spark, monkeypatch):
    """Unlike texts with 14 words in common, in one hot block by the first order: none by the second, so no chunks meet; near copies among them are found."""
    draw = random.Random(3)
    word = lambda: f"w{draw.randrange(10**7)}"
    notice = " ".join(f"n{k}" for k in range(14))
    texts = [" ".join([*(word() for _ in range(13)), notice, *(word() for _ in range(13))]) for _ in range(700)]
    texts += [f"{texts[k]} {word()}" for k in range(0, 700, 70)] + [texts[5]] * 3
    seen = []
    again, across = o5._again, o5._cross_links
    monkeypatch.setattr(o5, "_again", lambda *a: seen.append(again(*a)) or seen[-1])
    monkeypatch.setattr(o5, "_cross_links", lambda *a: seen.append("across") or across(*a))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in o5.jaccard_components(df, chunk=32).collect()}
    assert got == {k: k for k in range(700)} | {700 + j: 70 * j for j in range(10)} | {710 + j: 5 for j in range(3)}
    assert len(seen) == 1 and seen[0].groupBy("block").count().filter("count > 32").count() == 0


def vectors(n=600, dim=24, seed=3):
    draw = np.random.default_rng(seed)
    x = draw.standard_normal((n, dim))
    for k in range(0, n // 2, 3):
        x[k + 1] = x[k] * draw.uniform(0.5, 2) + draw.standard_normal(dim) * draw.choice([0.0, 0.1, 0.3, 0.5])
        x[k + 2] = x[k]
    return x


def frame(spark, x):
    return spark.createDataFrame([(k, [float(v) for v in r]) for k, r in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)


def best(x, q, k):
    s = o1.products(np.broadcast_to(x[q], x.shape), x)
    return [int(i) for i in np.lexsort((np.arange(len(x)), -s)) if i != q][:k]


def written(spark, x):
    return o1.materialize(o1.usable(frame(spark, x)), "v")


@pytest.mark.parametrize("size", [250, 40])
def test_search_is_exact_at_factor_one(spark, size):
    x = vectors()
    found = written(spark, x)
    index = o1.build_index(found, shard_size=size * x.shape[1], sample_rows=100)
    assert index.trees.count() > 1 and index.trees.select("leaf").distinct().count() > 1
    got = {}
    for r in o1.search(index, found.filter("vec_id % 20 = 0"), factor=1.0, block_rows=10).collect():
        got.setdefault(r.query_id, {})[r.rank] = r
    assert sorted(got) == list(range(0, len(x), 20))
    for q, ranks in got.items():
        assert [ranks[k].vec_id for k in range(1, 21)] == best(x, q, 20)
        assert ranks[1].score == pytest.approx(float(x[q] @ x[ranks[1].vec_id]), rel=1e-14)


@pytest.mark.parametrize("block", [1, 7, 450])
def test_copies_tie_wherever_they_stand(block):
    """Three copies of each vector at random places, factor 1: members, order and scores as brute force has them."""
    for seed in range(12):
        draw = np.random.default_rng(seed)
        x = np.repeat(draw.standard_normal((150, 64)), 3, axis=0)[draw.permutation(450)]
        tree = o1.Tree(np.arange(450), x, leaf=20)
        for at in np.array_split(np.arange(450), -(-450 // block))[:40]:
            scores, ids, _ = tree.search(x[at], at, 20, 1.0)
            for q, own, who in zip(at, scores, ids, strict=True):
                assert who.tolist() == best(x, q, 20) and (own == o1.products(np.broadcast_to(x[q], (20, 64)), x[who])).all()


def test_search_finds_scattered_copies(spark):
    draw = np.random.default_rng(5)
    x = np.repeat(draw.standard_normal((300, 24)), 3, axis=0)[draw.permutation(900)]
    found = written(spark, x)
    got = {}
    for r in o1.search(o1.build_index(found, shard_size=60 * 24, sample_rows=100), found.filter("vec_id % 20 = 0"), factor=1.0, block_rows=3).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.vec_id
    assert all([ranks[k] for k in range(1, 21)] == best(x, q, 20) for q, ranks in got.items()) and len(got) == 45


def test_trees_go_only_where_queries_are(spark):
    """One query: its own leaf's trees are sent once, the others only as far as the query reaches."""
    draw = np.random.default_rng(8)
    centres = 30 * draw.standard_normal((8, 4))
    x = centres[np.arange(800) % 8] + 0.01 * draw.standard_normal((800, 4))
    found = written(spark, x)
    index = o1.build_index(found, shard_size=100 * 4)
    steps = o1.search_steps(index, found.filter("vec_id = 0"))
    # a task tells what it took, so there are as many such rows as trees that met the query
    assert steps.filter("vec_id = -1").count() < index.trees.count()


def test_search_of_few_and_of_equal_vectors(spark):
    same = written(spark, np.ones((200, 4)))
    got = o1.search(o1.build_index(same, shard_size=100), same.filter("vec_id % 20 = 0")).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: (r.query_id, r.rank)) if r.query_id == 0] == list(range(1, 21))
    few = written(spark, np.eye(5))
    assert len(o1.search(o1.build_index(few), few.filter("vec_id = 0")).collect()) == 4


def test_pruning_spares_most_scores_on_clusters(spark):
    """Clustered vectors at the shipped factor: fewer than a third of all scores, recall over 0.95."""
    draw = np.random.default_rng(8)
    centres = draw.standard_normal((40, 24))
    x = centres[np.arange(4000) % 40] + 0.25 * draw.standard_normal((4000, 24))
    x /= np.sqrt((x * x).sum(1))[:, None]
    found = written(spark, x)
    index, asked = o1.build_index(found, shard_size=500 * 24), found.filter("vec_id % 20 = 0")
    steps = o1.materialize(o1.search_steps(index, asked), "steps")
    got = {}
    for r in o1.search(index, asked).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    share, recall = steps.agg({"seen": "sum"}).first()[0] / (200 * 4000), np.mean([len(got[q] & set(best(x, q, 20))) / 20 for q in got])
    assert share < 1 / 3 and recall > 0.95


def test_recall_of_the_query(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").toPandas()
    x = np.array(e["embedding"].tolist(), dtype=float)
    assert (e["vec_id"] == np.arange(len(x))).all()
    got = {}
    for r in o1.op1_ann(spark, sf_dir).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert np.mean([len(got[q] & set(best(x, q, 20))) / 20 for q in got]) >= 0.9


@pytest.mark.parametrize("chunk", [16, 1024])
def test_embedding_duplicates(spark, chunk):
    x = vectors()
    got = o9.duplicates(frame(spark, x), chunk_size=chunk * x.shape[1]).toPandas().set_index("vec_id").loc[range(len(x))]
    u = x / np.sqrt((x * x).sum(1))[:, None]
    close = u @ u.T >= 0.9
    np.fill_diagonal(close, False)
    assert got["n_links"].tolist() == close.sum(1).tolist()
    want = roots(len(x), [(a, b) for a, b in zip(*np.nonzero(close), strict=True) if a > b])
    assert got["component_id"].tolist() == want and got["kept"].tolist() == [k == w for k, w in enumerate(want)]


def test_estimates_are_unbiased_and_bounded():
    draw = np.random.default_rng(4)
    a = draw.standard_normal((400, 32))
    a[200:] = a[:200] + draw.standard_normal((200, 32)) * draw.choice([0.2, 0.5, 1.0], (200, 1))
    a /= np.sqrt((a * a).sum(1))[:, None]
    code, factor = o9.encode(a)
    est, spread = o9.estimates(code, factor, code, factor)
    real, off = a @ a.T, ~np.eye(400, dtype=bool)
    error = est - real
    close = off & (real > 0.6)
    assert abs(error[off].mean()) < 0.01 and close.sum() > 200 and abs(error[close].mean()) < 0.02
    assert (np.abs(error) <= 4 * spread + 1e-9)[off].mean() > 0.999
    assert o9.possible(code, factor, code, factor, 0.9, 4.0)[off & (real >= 0.9)].all()
    assert o9.possible(code, factor, code, factor, 0.9, 4.0)[off & (real < 0.3)].mean() < 0.01


def test_bands_meet_as_planned():
    """Pairs right at the threshold meet in a band with the planned probability, also where bands share bits of the code."""
    draw, dim = np.random.default_rng(6), 32
    x = draw.standard_normal((3000, dim))
    x /= np.sqrt((x * x).sum(1))[:, None]
    y = draw.standard_normal((3000, dim))
    y -= (x * y).sum(1)[:, None] * x
    y /= np.sqrt((y * y).sum(1))[:, None]
    y = 0.9 * x + np.sqrt(1 - 0.81) * y
    for n, recall in ((10_000, 0.99), (10**7, 0.9)):
        bits, bands = o9.plan(n, dim, recall=recall)
        where = o9.positions(o9.code_bits(dim), bits, bands)
        met = (o9.band_keys(o9.encode(x)[0], where) == o9.band_keys(o9.encode(y)[0], where)).any(axis=1).mean()
        assert met > recall - 0.02, (n, bits, bands, met)


def test_edge_vectors(spark, edge_dir):
    got = sorted((r.vec_id is None, r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in o9.op9_embedding_dedup(spark, f"{edge_dir}/edge").collect())
    by = {r[1]: r for r in got if not r[0]}
    assert len(got) == 12 and by[0][2:] == (3, 0, True) and by[20][2:] == (3, 0, False) and by[4][2:] == (3, 0, False)
    assert by[1][2:] == (0, 1, True) and by[5][2:] == (0, 5, True) and by[7][2:] == (1, 7, True)
    assert got[-1] == (True, 0, 3, 0, False)
    found = {(r.query_id, r.vec_id) for r in o1.op1_ann(spark, f"{edge_dir}/edge").collect()}
    assert found == {(0, 4), (0, 20), (0, 7), (20, 4), (20, 0), (20, 7)}
