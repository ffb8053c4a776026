"""Operator 1: approximate nearest neighbours by a vantage-point tree a shard, for the largest inner product.

One more coordinate makes all vectors as long as the longest, so that the largest inner product is the smallest distance. A tree splits vectors
by their distance from a vantage point, at the median. A search leaves out the far side of a split unless the query is within ``factor`` times
its present k-th distance of the border; with factor one the triangle inequality makes that exact, and below one it's faster and may miss some.

A small tree over a bounded sample, the router, has up to 1,024 leaves; every vector belongs to a leaf, and a leaf's vectors make one or more
shards of bounded size, each with its tree. Trees are rows of an index table. A query first searches its own leaf's shards; with the k-th score
found there it goes to those other leaves whose borders it reaches, and no others. Queries travel to trees: a task holds one tree and streams the queries through it.

Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null id, take no part. Vectors only meet
others of their length. Copies tie, and ties go to the smaller id. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import collected, materialize, table
from .vectors import loaded, read_vectors

K = 20
#: Relaxation of the pruning; measured recall in the README.
FACTOR = 0.2
#: Components of a shard's vectors together, so 8,192 rows of 64; rows of a leaf; queries that meet one copy of a tree.
SHARD_SIZE, LEAF, BLOCK_ROWS = 1 << 19, 128, 65_536
#: Share of the largest distance that rounding can shift a distance by, near zero at most.
BLUR = 1e-7
#: Rows from which the router is built, and its leaves at most (a leaf may have any number of shards).
SAMPLE_ROWS, MOST_LEAVES = 16_384, 1024


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner product of each row of ``q`` with the same row of ``x``, summed in the order of the components: equal vectors have equal
    scores wherever they stand. A matrix product doesn't give that; its last bits depend on a vector's place."""
    return np.add.reduce(np.ascontiguousarray((q * x).T), axis=0)


class Tree:
    """A vantage-point tree over the rows of ``x``; its form is a list of nodes (vantage, border, inner, outer) and leaves."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, longest: float | None = None, leaf: int = LEAF, seed: int = 1):
        """``longest``: the largest squared length that any vector has, here or elsewhere."""
        self.ids, self.x = ids, x
        norms = (x * x).sum(axis=1)
        self.longest = float(norms.max(initial=0.0) if longest is None else longest)
        self.extra = np.sqrt(np.maximum(self.longest - norms, 0.0))
        self.leaf = leaf
        self.rows: list[int] = []
        self.nodes: list[tuple[int, float, int, int]] = []  # a leaf: (-1, 0, first, last) in rows
        self.draw = np.random.default_rng(seed)
        self.root = self._build(np.arange(len(ids)))

    def _distance(self, i: int, at: np.ndarray) -> np.ndarray:
        d = self.x[at] - self.x[i]
        return np.sqrt((d * d).sum(axis=1) + (self.extra[at] - self.extra[i]) ** 2)

    def _build(self, at: np.ndarray) -> int:
        if len(at) > self.leaf:
            # of a few, the vantage point from which distances differ most
            tried = self.draw.choice(at, size=min(4, len(at)), replace=False)
            some = at if len(at) <= 512 else self.draw.choice(at, size=512, replace=False)
            vantage = int(max(tried, key=lambda i: self._distance(i, some).var()))
            d = self._distance(vantage, at)
            border = float(np.median(d))
            near = d <= border
            if not near.all():
                k = len(self.nodes)
                self.nodes.append((vantage, border, 0, 0))
                self.nodes[k] = (vantage, border, self._build(at[near]), self._build(at[~near]))
                return k
        first = len(self.rows)
        self.rows += at.tolist()
        self.nodes.append((-1, 0.0, first, len(self.rows)))
        return len(self.nodes) - 1

    def search(self, q: np.ndarray, q_ids: np.ndarray, k: int, factor: float, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
        """Scores and ids of the k best of each query, best first; unfilled places hold -inf. Also how many scores it took.
        ``least``: scores below which nothing is wanted, one a query."""
        floor = np.full(len(q), -np.inf) if least is None else least
        best, who, seen = np.full((len(q), k), -np.inf), np.full((len(q), k), np.iinfo(np.int64).max), 0
        rows = np.asarray(self.rows, dtype=np.int64)
        q_norm = (q * q).sum(axis=1)
        # what rounding can do to a matrix product, and to a distance, whose square it shifts
        ulps = 4e-16 * (q.shape[1] + 2) * np.sqrt(q_norm * self.longest)
        slack = BLUR * np.sqrt(q_norm + self.longest)

        def reach(a: np.ndarray) -> np.ndarray:
            """Distance of the k-th best so far."""
            return np.sqrt(np.maximum(q_norm[a] + self.longest - 2 * np.maximum(best[a, -1], floor[a]), 0.0))

        def leaf(first: int, last: int, a: np.ndarray) -> None:
            nonlocal seen
            at = rows[first:last]
            score = q[a] @ self.x[at].T
            seen += score.size
            score[q_ids[a][:, None] == self.ids[at][None, :]] = -np.inf
            cut = np.maximum(best[a, -1], floor[a]) - ulps[a]
            hit = score.max(axis=1) >= cut
            a, score, cut = a[hit], score[hit], cut[hit]
            if not len(a):
                return
            if score.shape[1] > k:  # a row can't be among the k best where k others are better by more than rounding
                cut = np.maximum(cut, np.partition(score, -k, axis=1)[:, -k] - 2 * ulps[a])
            # the matrix product finds candidates; those are scored one by one, and ranked by that
            i, j = np.nonzero(score >= np.maximum(cut, np.finfo(float).min)[:, None])
            score = np.full_like(score, -np.inf)
            score[i, j] = products(q[a[i]], self.x[at[j]])
            all_score = np.concatenate([best[a], score], axis=1)
            all_id = np.concatenate([who[a], np.broadcast_to(self.ids[at], score.shape)], axis=1)
            order = np.lexsort((all_id, -all_score), axis=1)[:, :k]
            best[a], who[a] = np.take_along_axis(all_score, order, 1), np.take_along_axis(all_id, order, 1)

        def visit(node: int, a: np.ndarray) -> None:
            if not len(a):
                return
            vantage, border, inner, outer = self.nodes[node]
            if vantage < 0:
                leaf(inner, outer, a)
                return
            d = np.sqrt(np.maximum(q_norm[a] + self.longest - 2 * (q[a] @ self.x[vantage]), 0.0))
            near = d <= border
            visit(inner, a[near])
            visit(outer, a[~near])
            late = np.abs(d - border) <= factor * reach(a) + slack[a]
            visit(outer, a[near & late])
            visit(inner, a[~near & late])

        visit(self.root, np.arange(len(q)))
        return best, who, seen

    def pack(self) -> dict:
        form = np.array(self.nodes, dtype=np.float64).reshape(-1, 4)
        single = self.x.astype(np.float32)
        return {"ids": self.ids.tobytes(), "vecs": (single if (single == self.x).all() else self.x).tobytes(), "rows": np.asarray(self.rows, np.int32).tobytes(), "nodes": form.tobytes(), "root": self.root, "longest": self.longest}

    @staticmethod
    def unpack(r) -> Tree:
        t = Tree.__new__(Tree)
        t.ids, t.longest, t.root = np.frombuffer(r["ids"], np.int64), float(r["longest"]), int(r["root"])
        t.x = np.frombuffer(r["vecs"], np.float32 if len(r["vecs"]) == 4 * int(r["dim"]) * len(t.ids) else np.float64).reshape(len(t.ids), -1).astype(np.float64)
        t.rows = np.frombuffer(r["rows"], np.int32)
        t.nodes = [(int(v), b, int(i), int(o)) for v, b, i, o in np.frombuffer(r["nodes"]).reshape(-1, 4)]
        return t


class Router:
    """The upper part of all trees of one vector length: which leaf a vector belongs to, and which leaves a query reaches."""

    def __init__(self, x: np.ndarray, longest: float, leaves: int):
        made = Tree(np.arange(len(x)), x, longest, leaf=max(1, -(-len(x) // leaves)))
        vantages = sorted({n[0] for n in made.nodes if n[0] >= 0})
        place = {v: k for k, v in enumerate(vantages)}
        self.x, self.extra, self.longest, self.root, self.leaves = x[vantages], made.extra[vantages], longest, made.root, 0
        self.nodes: list[tuple[int, float, int, int]] = []
        for v, border, i, o in made.nodes:
            self.nodes.append((place[v], border, i, o) if v >= 0 else (-1, 0.0, self.leaves, 0))
            self.leaves += v < 0

    def _visit(self, x: np.ndarray, extra: np.ndarray, slack: np.ndarray):
        """(leaf, rows of x) that meet there: on the near side of each border, or within ``slack`` of it."""
        norms, waiting = (x * x).sum(axis=1), [(self.root, np.arange(len(x)))]
        while waiting:
            node, a = waiting.pop()
            if not len(a):
                continue
            vantage, border, inner, outer = self.nodes[node]
            if vantage < 0:
                yield inner, a
                continue
            v = self.x[vantage]
            d = np.sqrt(np.maximum(norms[a] + v @ v - 2 * (x[a] @ v) + (extra[a] - self.extra[vantage]) ** 2, 0.0))
            late = np.abs(d - border) <= slack[a]
            waiting += [(inner, a[(d <= border) | late]), (outer, a[(d > border) | late])]

    def _one(self, x: np.ndarray, extra: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int32)
        for leaf, a in self._visit(x, extra, np.full(len(x), -1.0)):
            out[a] = leaf
        return out

    def leaf_of_row(self, x: np.ndarray) -> np.ndarray:
        return self._one(x, np.sqrt(np.maximum(self.longest - (x * x).sum(axis=1), 0.0)))

    def leaf_of_query(self, x: np.ndarray) -> np.ndarray:
        return self._one(x, np.zeros(len(x)))

    def reached(self, x: np.ndarray, least: np.ndarray, factor: float) -> list[list[int]]:
        """Leaves that each query reaches with its k-th score ``least``, but for its own."""
        out, home = [[] for _ in x], self.leaf_of_query(x)
        norms = (x * x).sum(axis=1)
        slack = factor * np.sqrt(np.maximum(norms + self.longest - 2 * least, 0.0)) + BLUR * np.sqrt(norms + self.longest)
        for leaf, a in self._visit(x, np.zeros(len(x)), slack):
            for k in a.tolist():
                if home[k] != leaf:
                    out[k].append(leaf)
        return out


@dataclass
class Index:
    """``trees``: a written table, one row a shard (dim, leaf, sub and the tree). ``routers``: a broadcast dictionary by vector length."""

    trees: DataFrame
    routers: object


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, dim, vec, norm2) of the vectors that take part."""
    return read_vectors(vectors, id_col, vec_col).filter("vec_id is not null and vec is not null").select("vec_id", "dim", "vec", "norm2")


def _by_dim(dims: pd.Series, vecs: pd.Series):
    """(dim, positions, matrix) of each vector length of a batch."""
    dims = dims.to_numpy()
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        yield int(dim), at, loaded(vecs.iloc[at], int(dim))


def build_index(vectors: DataFrame, shard_size: int = SHARD_SIZE, sample_rows: int = SAMPLE_ROWS) -> Index:
    """``vectors``: from :func:`usable`, written. Routers are built from an expected ``sample_rows`` rows, drawn by a hash of the id,
    and never from more than twice as many, however often an id is repeated."""
    kinds = collected(vectors.groupBy("dim").agg(F.count("*").alias("n"), F.max("norm2").alias("longest")))
    draw = F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(1_000_000))
    share = int(min(1.0, sample_rows / max(int(kinds["n"].sum()), 1)) * 1_000_000)
    sample, routers = collected(vectors.filter(draw < share).select("vec_id", "dim", "vec").limit(2 * sample_rows)), {}
    for dim, n, longest in zip(kinds["dim"].tolist(), kinds["n"].tolist(), kinds["longest"].tolist(), strict=True):
        some = sample[sample["dim"] == dim].sort_values("vec_id", kind="stable")
        x = loaded(some["vec"], dim) if len(some) else np.zeros((0, dim))
        routers[dim] = Router(x, longest, max(1, min(MOST_LEAVES, n * dim // shard_size)))
    sent = vectors.sparkSession.sparkContext.broadcast(routers)

    @F.pandas_udf("int")
    def leaf_of(dims: pd.Series, vecs: pd.Series) -> pd.Series:
        out = np.zeros(len(dims), np.int32)
        for dim, at, x in _by_dim(dims, vecs):
            out[at] = sent.value[dim].leaf_of_row(x)
        return pd.Series(out)

    routed = materialize(vectors.select("vec_id", "dim", "vec", leaf_of.asNondeterministic()("dim", "vec").alias("leaf")), "routed")
    # a leaf's vectors make as many shards as their number asks for: at most 1,024 counts a vector length
    shards = F.broadcast(routed.groupBy("dim", "leaf").agg(F.ceil(F.count("*") * F.col("dim") / shard_size).alias("subs")))
    dealt = routed.join(shards, ["dim", "leaf"]).withColumn("sub", F.pmod(F.xxhash64("vec_id"), "subs").cast("int"))

    def tree(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id", kind="stable")
        first = rows.iloc[0]
        made = Tree(rows["vec_id"].to_numpy(np.int64), loaded(rows["vec"], int(first["dim"])), sent.value[int(first["dim"])].longest)
        return pd.DataFrame([{"dim": first["dim"], "leaf": first["leaf"], "sub": first["sub"], **made.pack()}])

    made = dealt.select("dim", "leaf", "sub", "vec_id", "vec").groupBy("dim", "leaf", "sub").applyInPandas(tree, "dim int, leaf int, sub int, ids binary, vecs binary, rows binary, nodes binary, root int, longest double")
    return Index(materialize(made, "vp-index"), sent)


_TREE = ("ids", "vecs", "rows", "nodes", "root", "longest")


def _meet(index: Index, queries: DataFrame, k: int, factor: float, block_rows: int) -> DataFrame:
    """(query_id, vec_id, score, seen): of each query and each shard of its leaf, what is as good as ``least`` and among the shard's k best;
    one row without vec_id tells how many scores a shard's task took. ``queries``: a written table of query_id, dim, leaf, vec, least.

    A leaf's queries are dealt in blocks of about ``block_rows``, and its trees are sent once a block: not at all where no query reaches the leaf."""
    blocks = F.broadcast(queries.groupBy("dim", "leaf").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks")))  # at most 1,024 rows a vector length
    block = F.pmod(F.xxhash64("query_id", F.lit(9)), F.col("blocks")).cast("int")
    asked = queries.join(blocks, ["dim", "leaf"]).join(index.trees.select("dim", "leaf", "sub"), ["dim", "leaf"])
    asked = asked.select("dim", "leaf", "sub", block.alias("block"), "query_id", "vec", "least", *(F.lit(None).cast(index.trees.schema[c].dataType).alias(c) for c in _TREE))
    trees = index.trees.join(blocks, ["dim", "leaf"]).select("dim", "leaf", "sub", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(None).cast("long").alias("query_id"), F.lit(None).cast("binary").alias("vec"), F.lit(None).cast("double").alias("least"), *_TREE)
    key = ["dim", "leaf", "sub", "block"]

    def run(batches):
        held, at = None, None
        for batch in batches:
            for here, rows in batch.groupby(key, sort=False):
                if here != at:  # a tree's row comes before its queries
                    at, held = here, Tree.unpack(rows.iloc[0])
                    rows = rows.iloc[1:]
                if not len(rows):
                    continue
                q_ids = rows["query_id"].to_numpy(np.int64)
                best, who, seen = held.search(loaded(rows["vec"], int(here[0])), q_ids, k, factor, rows["least"].to_numpy(float))
                got = np.isfinite(best) & (best >= rows["least"].to_numpy(float)[:, None])
                yield pd.DataFrame({"query_id": np.repeat(q_ids, got.sum(axis=1)), "vec_id": who[got], "score": best[got], "seen": np.int64(0)})
                yield pd.DataFrame({"query_id": q_ids[:1], "vec_id": np.int64(-1), "score": -np.inf, "seen": np.int64(seen)})

    # nulls come first in a sort, so the tree does; longs with a null go as a number that the tree's row alone has
    both = trees.unionByName(asked).withColumns({"first": F.col("query_id").isNotNull(), "query_id": F.coalesce("query_id", F.lit(0))})
    return both.repartition(*key).sortWithinPartitions(*key, "first").drop("first").mapInPandas(run, "query_id long, vec_id long, score double, seen long")


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.filter(F.col("score") > float("-inf")).withColumn("rank", rank).filter(F.col("rank") <= k)


def search_steps(index: Index, queries: DataFrame, k: int = K, factor: float = FACTOR, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All that :func:`_meet` finds for ``queries`` (vec_id, dim, vec): in their own leaves, and in the others that they reach from there."""
    routers = index.routers

    @F.pandas_udf("int")
    def home(dims: pd.Series, vecs: pd.Series) -> pd.Series:
        out = np.zeros(len(dims), np.int32)
        for dim, at, x in _by_dim(dims, vecs):
            out[at] = routers.value[dim].leaf_of_query(x)
        return pd.Series(out)

    @F.pandas_udf("array<int>")
    def others(dims: pd.Series, vecs: pd.Series, least: pd.Series) -> pd.Series:
        out = [[]] * len(dims)
        for dim, at, x in _by_dim(dims, vecs):
            for i, leaves in zip(at.tolist(), routers.value[dim].reached(x, least.to_numpy(float)[at], factor), strict=True):
                out[i] = leaves
        return pd.Series(out, dtype=object)

    asked = queries.select(F.col("vec_id").alias("query_id"), "dim", "vec").dropDuplicates(["query_id", "dim", "vec"])
    low = F.lit(float("-inf"))
    asked = materialize(asked.select("*", home.asNondeterministic()("dim", "vec").alias("leaf"), low.alias("least")), "queries-at-home")
    first = materialize(_meet(index, asked, k, factor, block_rows), "first-found")
    kth = _best(first, k).groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("score")).select("query_id", F.when(F.col("n") == k, F.col("score")).alias("kth"))
    bounded = asked.drop("leaf", "least").join(kth, "query_id", "left").withColumn("least", F.coalesce("kth", low)).drop("kth")
    bounded = materialize(bounded.withColumn("to", others.asNondeterministic()("dim", "vec", "least")), "queries-away")
    away = bounded.select("query_id", "dim", "vec", "least", F.explode("to").alias("leaf"))
    return first.unionByName(_meet(index, away, k, factor, block_rows))


def search(index: Index, queries: DataFrame, k: int = K, factor: float = FACTOR, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best found of each query. ``queries``: rows of a written table like the index's. All rows with a
    query's id are its own and no candidates; queries that repeat an id and a vector are one, and of those that repeat the id alone the best of all are given."""
    return _best(search_steps(index, queries, k, factor, block_rows), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = materialize(usable(table(spark, sf_dir, "embeddings")), "vectors")
    return search(build_index(vectors), vectors.filter(F.col("vec_id") % 20 == 0))
