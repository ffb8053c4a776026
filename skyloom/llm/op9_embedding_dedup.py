"""Operator 9: near duplicates of embeddings by randomised-rotation binary codes with stored correction factors.

A unit vector is turned by several random rotations and kept as the signs of its coordinates, with one correction factor: the inner product of
the turned vector and its scaled signs. The scaled signs of two vectors agree as far as the arcsine of their cosine says, up to the factors; so the
number of bits in which two codes differ (XOR and a count of bits) gives an estimate of the cosine without bias, and its spread is known from the
number of bits. Only pairs whose estimate comes within ``sigmas`` spreads of the threshold are computed exactly; only the exact value decides a link.

Bands are parts of the code; vectors that agree in a band meet. The number of bits a band follows the number of vectors, and the number of bands is
such that a pair right at the threshold meets with probability ``recall`` (closer pairs do so almost surely). A pair counts in the first
band it meets in. Only codes travel through the bands. A vector is sent to those groups alone in which it has a pair to be computed. Copies are compared
once, as a class. Bands' groups larger than a chunk are dealt into pairs of chunks. All pairs within a group are judged there, and only counts
and a spanning star leave the task.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing. Repeated ids are vectors of
their own. A row with a null id may link others; its kept is false.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table
from .components import components, with_least
from .signature_tree import Union
from .vectors import loaded, read_vectors

THRESHOLD, RECALL, SIGMAS = 0.9, 0.999, 4.0
#: Components of a chunk's vectors together: 4,096 vectors of 64.
CHUNK_SIZE = 1 << 18
#: Vectors that should meet in a band's group by chance, and the least number of bits of a code.
PER_GROUP, CODE_BITS = 1024, 256


def code_bits(dim: int) -> int:
    """Whole rotations of ``dim`` bits each."""
    return -(-CODE_BITS // dim) * dim


def plan(n: int, dim: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """Bits a band and number of bands for ``n`` vectors. At the threshold, the number of differing bits is binomial; the probability to meet
    in no band is taken over it."""
    size, differ = code_bits(dim), math.acos(threshold) / math.pi
    bits = min(30, size // 2, max(6, round(math.log2(max(n, 2) / PER_GROUP))))
    h = np.arange(size - bits + 1)
    weight = np.exp([math.lgamma(size + 1) - math.lgamma(k + 1) - math.lgamma(size - k + 1) + k * math.log(differ) + (size - k) * math.log(1 - differ) for k in h.tolist()])
    meet = np.prod([(size - h - i) / (size - i) for i in range(bits)], axis=0)
    missed = lambda bands: 1 - weight.sum() + (weight * (1 - meet) ** bands).sum()
    bands = 1
    while missed(bands) > 1 - recall and bands < 4000:
        bands += max(1, bands // 16)
    return bits, bands


@lru_cache(maxsize=8)
def positions(size: int, bits: int, bands: int) -> np.ndarray:
    """Bands x bits: which of the code's bits make each band; bands share bits only once all are used."""
    draw, need = np.random.default_rng(7), bits * bands
    per = size // bits
    return np.concatenate([draw.permutation(size)[: per * bits].reshape(per, bits) for _ in range(-(-need // (per * bits)))])[:bands]


@lru_cache(maxsize=8)
def rotations(dim: int) -> np.ndarray:
    """Random rotations, side by side: dim x bits of a code."""
    draw = np.random.default_rng(20_000 + dim)
    return np.concatenate([np.linalg.qr(draw.standard_normal((dim, dim)))[0] for _ in range(code_bits(dim) // dim)], axis=1)


def encode(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign bits (rows x 64-bit words) and the correction factor of unit vectors."""
    dim, size = unit.shape[1], code_bits(unit.shape[1])
    turned = unit @ rotations(dim)
    packed = np.packbits(turned >= 0, axis=1)
    words = np.zeros((len(unit), -(-size // 64) * 8), np.uint8)
    words[:, : packed.shape[1]] = packed
    return words.view(np.uint64), (np.abs(turned).mean(axis=1) * math.sqrt(dim)).astype(np.float32)


def band_keys(code: np.ndarray, where: np.ndarray) -> np.ndarray:
    """Rows x bands: the bits of each band as a number."""
    on = np.unpackbits(np.ascontiguousarray(code).view(np.uint8), axis=1)[:, where.ravel()].reshape(len(code), *where.shape).astype(np.int64)
    return on @ (1 << np.arange(where.shape[1], dtype=np.int64))


def _angles(code: np.ndarray, factor: np.ndarray, code2: np.ndarray, factor2: np.ndarray, dim: int) -> np.ndarray:
    """Estimated arcsines of the cosines, rows of the one with rows of the other; by counts of differing bits."""
    differ = np.zeros((len(code), len(code2)), np.int32)
    for k in range(code.shape[1]):
        differ += np.bitwise_count(code[:, k, None] ^ code2[None, :, k])
    return (1 - (2 / code_bits(dim)) * differ) / (factor[:, None].astype(float) * factor2[None, :])


def _dim_of(code: np.ndarray, dim: int | None) -> int:
    return dim or 64 * code.shape[1]


def estimates(code, factor, code2, factor2, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines and their spread. The sine of an estimate with a spread falls short by a factor that is known."""
    size = code_bits(_dim_of(code, dim))
    angle = np.clip(_angles(code, factor, code2, factor2, _dim_of(code, dim)), -math.pi / 2, math.pi / 2)
    share = np.clip(0.5 - angle / math.pi, 0.5 / size, 1 - 0.5 / size)
    spread = math.pi * np.sqrt(share * (1 - share) / size)
    return np.clip(np.sin(angle) * np.exp(spread**2 / 2), -1, 1), spread


def possible(code, factor, code2, factor2, threshold: float, sigmas: float, dim: int | None = None) -> np.ndarray:
    """Which pairs' estimates come within ``sigmas`` spreads of the threshold; the spread is that of a pair right at it."""
    size, share = code_bits(_dim_of(code, dim)), math.acos(threshold) / math.pi
    return _angles(code, factor, code2, factor2, _dim_of(code, dim)) >= math.asin(threshold) - sigmas * math.pi * math.sqrt(share * (1 - share) / size)


def _maybe(rows: pd.DataFrame, where: np.ndarray, threshold: float, sigmas: float):
    """(x, y) positions of a group's pairs that have to be computed here: estimated close enough, and in no earlier band together.
    Some rows at a time; in a group of two chunks, only pairs across them."""
    dim, band = int(rows["dim"].iloc[0]), int(rows["band"].iloc[0])
    raw = rows["code"]
    code = np.frombuffer(b"".join(raw), np.uint64).reshape(len(rows), -1)
    factor = rows["factor"].to_numpy(np.float32)
    nodes = rows["node"].to_numpy(np.int64)
    sides = [rows[c].to_numpy() for c, i, j in (("side", "i", "j"), ("side2", "i2", "j2")) if c in rows and rows[i].iloc[0] != rows[j].iloc[0]]
    keys = band_keys(code, where[:band]) if band else None
    for at in range(0, len(rows), 512):
        some = slice(at, at + 512)
        ok = possible(code[some], factor[some], code, factor, threshold, sigmas, dim) & (nodes[some, None] < nodes[None, :])
        for side in sides:
            ok &= side[some, None] != side[None, :]
        x, y = np.nonzero(ok)
        x += at
        if band and len(x):
            new = np.ones(len(x), bool)
            for k in range(0, len(x), 1 << 16):
                new[k : k + (1 << 16)] = ~(keys[x[k : k + (1 << 16)]] == keys[y[k : k + (1 << 16)]]).any(axis=1)
            x, y = x[new], y[new]
        if len(x):
            yield x, y


def _codes_only(where, threshold: float, sigmas: float):
    """A group's rows, without vectors -> those that have a pair to be computed there."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        used = np.zeros(len(rows), bool)
        for x, y in _maybe(rows, where.value[int(rows["dim"].iloc[0])], threshold, sigmas):
            used[x] = used[y] = True
        return rows.loc[used, ["node", "dim", "band", "key", "i", "j", "side"]]

    return run


def _judge(where, threshold: float, sigmas: float):
    """A group's rows with vectors -> (a, b, n): n links that a gets here (b is -1), or a link of the star (n is 0)."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        vec = loaded(rows["vec"], int(rows["dim"].iloc[0]))
        unit = vec / np.sqrt((vec * vec).sum(axis=1))[:, None]
        nodes, copies = rows["node"].to_numpy(np.int64), rows["copies"].to_numpy(np.int64)
        links, known = np.zeros(len(rows), np.int64), Union(len(rows))
        for xs, ys in _maybe(rows, where.value[int(rows["dim"].iloc[0])], threshold, sigmas):
            for at in range(0, len(xs), 1 << 14):
                p, q = xs[at : at + (1 << 14)], ys[at : at + (1 << 14)]
                ok = (unit[p] * unit[q]).sum(axis=1) >= threshold
                p, q = p[ok], q[ok]
                np.add.at(links, p, copies[q])
                np.add.at(links, q, copies[p])
                for i, j in zip(p.tolist(), q.tolist(), strict=True):
                    known.link(i, j)
        top = np.array([known.find(k) for k in range(len(rows))])
        has, star = np.flatnonzero(links), np.flatnonzero(top != np.arange(len(rows)))
        return pd.DataFrame({"a": np.r_[nodes[has], nodes[top[star]]], "b": np.r_[np.full(len(has), -1), nodes[star]], "n": np.r_[links[has], np.zeros(len(star), np.int64)]})

    return run


def _dealt(entries: DataFrame, counted: DataFrame, group: list[str], chunk_size: int, name: str = "") -> tuple[DataFrame, list[str]]:
    """``entries`` with i, j and side, and what to group by then: groups of more than a chunk are dealt into chunks, and a row goes to
    each pair of chunks that its own is in; pairs meet in one of these. ``counted``: the same rows, without what they carry."""
    i, j, side = (c + name for c in ("i", "j", "side"))
    sized = counted.groupBy(*group).agg(F.ceil(F.count("*") * F.col("dim") / chunk_size).cast("int").alias("chunks")).filter("chunks > 1")
    chunks = F.coalesce("chunks", F.lit(1))
    dealt = entries.join(materialize(sized, "large-groups"), group, "left").withColumn("chunk", F.pmod(F.xxhash64("node", "band", F.lit(name)), chunks).cast("int"))
    other = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), chunks - 1)))
    made = other.withColumns({i: F.least("chunk", "o"), j: F.greatest("chunk", "o"), side: F.col("chunk") > F.col("o")}).drop("chunks", "chunk", "o")
    return made, [*group, i, j]


def duplicates(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, sigmas: float = SIGMAS, chunk_size: int = CHUNK_SIZE, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    spark = vectors.sparkSession
    rows = materialize(read_vectors(vectors, id_col, vec_col).select(F.monotonically_increasing_id().alias("rid"), "vec_id", "dim", "vec", "cls"), "vectors")
    grouped = rows.filter(F.col("cls").isNotNull()).groupBy("dim", "cls").agg(F.min("rid").alias("node"), F.min("vec_id").alias("least_id"), F.count("*").alias("copies"))
    classes = materialize(grouped, "vector-classes")
    plans = {r["dim"]: plan(r["n"], r["dim"], threshold, recall) for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # a row a vector length
    where = spark.sparkContext.broadcast({dim: positions(code_bits(dim), *p) for dim, p in plans.items()})

    @F.pandas_udf("code binary, factor float, keys array<long>")
    def coded(dims: pd.Series, vecs: pd.Series) -> pd.DataFrame:
        out: list = [None] * len(dims)
        for dim in dims.unique().tolist():
            at = np.flatnonzero(dims.to_numpy() == dim)
            x = loaded(vecs.iloc[at], dim)
            code, factor = encode(x / np.sqrt((x * x).sum(axis=1))[:, None])
            for i, c, f, k in zip(at.tolist(), code, factor, band_keys(code, where.value[dim]), strict=True):
                out[i] = (c.tobytes(), f, k)
        return pd.DataFrame(out, columns=["code", "factor", "keys"])

    firsts = rows.select(F.col("rid").alias("node"), "vec").join(classes.select("node", "dim", "copies"), "node")
    codes = materialize(firsts.withColumn("r", coded.asNondeterministic()("dim", "vec")).select("node", "dim", "copies", "vec", "r.*"), "vector-codes")
    keyed = codes.select("node", "dim", F.posexplode("keys").alias("band", "key"))
    entries = codes.select("node", "dim", "code", "factor", F.posexplode("keys").alias("band", "key"))
    placed, group = _dealt(entries, keyed, ["dim", "band", "key"], chunk_size)
    open_ = materialize(placed.groupBy(*group).applyInPandas(_codes_only(where, threshold, sigmas), "node long, dim int, band int, key long, i int, j int, side boolean"), "open-pairs")
    # vectors are larger than codes, and their groups are dealt into smaller chunks
    again, finer = _dealt(open_, open_, group, chunk_size // 16, "2")
    with_vectors = again.join(codes.select("node", "copies", "vec", "code", "factor"), "node")
    found = materialize(with_vectors.groupBy(*finer).applyInPandas(_judge(where, threshold, sigmas), "a long, b long, n long"), "vector-links")
    links = found.filter("b < 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    parts = materialize(components(found.filter("b >= 0").select("a", "b")), "components")
    by_class = classes.join(with_least(parts, classes), "node", "left").join(links, "node", "left")
    by_class = materialize(by_class.select("dim", "cls", F.coalesce("component", "least_id").alias("component"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links")), "result-of-class")
    linked = rows.filter(F.col("cls").isNotNull()).select("vec_id", "dim", "cls").join(by_class, ["dim", "cls"]).select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"))
    alone = rows.filter(F.col("cls").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates(table(spark, sf_dir, "embeddings"))
