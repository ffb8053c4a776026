"""Operator 3: toxicity by non-negative positive-unlabelled learning.

A linear model over the presence of words and of their first letters, all that the training texts have, is trained by numpy from confirmed toxic texts and from unlabelled
texts. With class prior p, positive risk P+ and P- (as if labelled negative) and unlabelled risk U-, it lowers
p P+ + max(0, U- - p P-); where the bracket falls below zero, the step goes against it instead, so that it can't be
fitted below zero. Logistic loss makes the output a probability.

Training samples are bounded by ``max_positive`` and ``max_unlabelled`` (expected numbers of a hash draw; twice their sum at most, and ``MAX_FEATURES`` features a text); the prior is counted over all labels of the
training folds. Scores read the text alone. Null and empty texts score the model's bias. Repeated rows and null ids are kept; rows
with a null id never train. Without any positive label every score is the prior given.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, materialize, packed, table, trainable

_WORD = regex.compile(r"\w+")
MAX_POSITIVE, MAX_UNLABELLED = 4000, 8000
#: Where a feature's weight is let out by half: the difference of its rates in units of its spread.
LEAST_Z = 3.0
THRESHOLD = 0.3
#: Training stops where the mean risk of so many steps has fallen by less than this share.
WINDOW, LEAST_FALL = 15, 0.01
#: Features that one text can have in the sample; those with the smallest keys stay. It bounds what the driver fits on, not what is scored.
MAX_FEATURES = 100_000
#: Names kept in each of a worker's memos before it is emptied.
MEMO_WORDS = 100_000


def features_of_word(word: str) -> list[int]:
    """Keys of the word itself and of its first three, four and five letters."""
    keys = [word, *(f"{word[:n]}|{n}" for n in (3, 4, 5) if len(word) > n)]
    return [xxhash.xxh32_intdigest(k.encode("utf-8", "replace")) for k in keys]


class Weights(dict):
    """Weights of words, or of their first letters, by name; 0 for what training hasn't met, which isn't kept: most such words come once. Emptied when full."""

    def __init__(self, by_key: dict[int, float], end: str):
        super().__init__()
        self.by_key, self.end = by_key, end

    def __missing__(self, name: str) -> float:
        made = self.by_key.get(xxhash.xxh32_intdigest((name + self.end).encode("utf-8", "replace")))
        if made is None:
            return 0.0
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[name] = made
        return made


@dataclass
class Model:
    """Weights by feature key, of all features of the training texts."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def __getstate__(self):
        return {"keys": self.keys, "weights": self.weights, "bias": self.bias}

    @cached_property
    def _by_name(self) -> list:
        """Lookups of whole words and of their first three, four and five letters."""
        by_key = dict(zip(self.keys.tolist(), self.weights.tolist(), strict=True))
        return [Weights(by_key, end).__getitem__ for end in ("", "|3", "|4", "|5")]

    def score(self, text: str | None) -> float:
        words = set(_WORD.findall((text or "").lower()))
        whole, *starts = self._by_name
        parts = [map(whole, words), *(map(of, {w[:n] for w in words if len(w) > n}) for n, of in zip((3, 4, 5), starts, strict=True))]
        z = self.bias + math.fsum(chain.from_iterable(parts))  # the same in any order
        return 1 / (1 + math.exp(-min(max(z, -35.0), 35.0)))


def evidence(in_p: np.ndarray, in_u: np.ndarray, n_p: int, n_u: int) -> np.ndarray:
    """How far each feature's weight is let out, 0 to 1, by the numbers of positive and unlabelled texts it's in: the difference of
    its rates in units of its spread, the wider of the pooled and the separate one, saturating about LEAST_Z."""
    p, u, both = in_p / n_p, in_u / n_u, (in_p + in_u) / (n_p + n_u)
    spread = np.maximum(p * (1 - p) / n_p + u * (1 - u) / n_u, both * (1 - both) * (1 / n_p + 1 / n_u))
    z = np.abs(p - u) / np.sqrt(spread + 1e-9) / LEAST_Z
    return z**4 / (1 + z**4)


def risk(p: np.ndarray, u: np.ndarray, prior: float) -> tuple[float, float]:
    """The two parts of the risk for the outputs of positive and unlabelled texts under the logistic loss: that of the positive ones
    with the class prior, and that of the negative ones, which is the unlabelled less the positive share and may fall below zero."""
    return float(prior * np.logaddexp(0, -p).mean()), float(np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean())


def risk_gradient(p: np.ndarray, u: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """The step's direction by output: the gradient of both parts; where the negative part is below zero, that of its opposite alone."""
    sp, su = (1 / (1 + np.exp(-np.clip(x, -35, 35))) for x in (p, u))
    gp, gu = -prior * sp / len(p), su / len(u)
    return (prior * (sp - 1) / len(p) + gp, gu) if risk(p, u, prior)[1] >= 0 else (-gp, -gu)


def _pieces(starts: np.ndarray, total: int, most: int = 1 << 20) -> list[tuple]:
    """Consecutive parts, by their starts, in pieces of about ``most`` entries: (first part, last, begin, end, starts within)."""
    out, first = [], 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + most)))
        end = int(starts[last]) if last < len(starts) else total
        out.append((first, last, int(starts[first]), end, starts[first:last] - starts[first]))
        first = last
    return out


def train_pu(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, keys: np.ndarray, steps: int = 300, rate: float = 0.05, decay: float = 1e-3) -> Model:
    """``positive`` and ``unlabelled``: arrays of distinct feature keys of each text, all of them among ``keys``.

    Training ends after ``steps`` or once the risk no longer falls: its mean over the last ``WINDOW`` steps is that of those before, to a hundredth.
    All keys get a weight: one that the gradient moves, times the feature's :func:`evidence`, so that the many rare features don't drown the rest."""
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    keys = np.sort(np.asarray(keys))
    if not positive or not unlabelled:
        return Model(np.empty(0, np.int64), np.empty(0), float(np.log(prior / (1 - prior))))

    n_p, n_u = len(positive), len(unlabelled)
    lengths = np.array([len(x) for x in (*positive, *unlabelled)], dtype=np.int64)
    at = np.concatenate([np.searchsorted(keys, x).astype(np.int32) for x in (*positive, *unlabelled)])
    in_p = np.bincount(at[: lengths[:n_p].sum()], minlength=len(keys))
    in_all = np.bincount(at, minlength=len(keys))
    # sums over each text's features and over each feature's texts, by their starts in either order
    filled, used = np.flatnonzero(lengths), np.flatnonzero(in_all)
    by_text, by_key = (np.cumsum(lengths) - lengths)[filled], (np.cumsum(in_all) - in_all)[used]
    texts = np.repeat(np.arange(n_p + n_u, dtype=np.int32), lengths)[np.argsort(at, kind="stable")]
    let = evidence(in_p, in_all - in_p, n_p, n_u)

    def summed(x, where, parts, to, size):
        """Sums of ``x`` at ``where`` over the parts that begin at given places, a bounded piece at a time."""
        out = np.zeros(size)
        for first, last, begin, end, starts in parts:
            out[to[first:last]] = np.add.reduceat(x[where[begin:end]], starts)
        return out

    by_text, by_key = _pieces(by_text, len(at)), _pieces(by_key, len(at))
    w, b = np.zeros(len(keys)), float(np.log(prior / (1 - prior)))
    m, v, mb, vb, seen = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0, []
    for step in range(1, steps + 1):
        z = b + summed(let * w, at, by_text, filled, n_p + n_u)
        seen.append(sum(np.maximum(risk(z[:n_p], z[n_p:], prior), 0.0)))
        if len(seen) >= 4 * WINDOW and np.mean(seen[-WINDOW:]) > (1 - LEAST_FALL) * np.mean(seen[-2 * WINDOW : -WINDOW]):
            break
        gp, gu = risk_gradient(z[:n_p], z[n_p:], prior)
        g = let * summed(np.concatenate([gp, gu]), texts, by_key, used, len(keys)) + decay * w
        gb = gp.sum() + gu.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9**step, 1 - 0.999**step
        w -= rate * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        b -= rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    return Model(keys, let * w, float(b))


def _keys_column():
    """Column: the distinct feature keys of each text of the sample, as signed integers of the same 32 bits."""

    @F.pandas_udf("array<int>")
    def keys(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            found = {k for w in set(_WORD.findall((t or "").lower())) for k in features_of_word(w)}
            out.append(np.sort(np.fromiter(found, dtype=np.uint32, count=len(found)))[:MAX_FEATURES].view(np.int32))
        return pd.Series(out, dtype=object)

    return keys.asNondeterministic()(F.col("text"))


def fit(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED, prior: float | None = None) -> Model:
    """Train from rows outside the held-out fold. ``labels``: doc_id, toxic; only its positive rows are used as labels,
    and both kinds to count the prior (unless given)."""
    labelled = labels.select("doc_id", "toxic").filter(trainable() & F.col("toxic").isNotNull())
    n_toxic, n_labelled = labelled.agg(F.coalesce(F.sum((F.col("toxic") == 1).cast("long")), F.lit(0)), F.count("*")).first()
    if prior is None:
        prior = min(max(n_toxic / n_labelled, 1e-3), 0.9) if n_labelled else 0.1
    known = docs.select("doc_id", "text").filter(trainable())
    n_docs = known.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000))
    share = lambda most, n: int(min(1.0, most / max(n, 1)) * 1_000_000)
    # the expected number of either kind is at most its parameter; ids are hashed, so it's near that
    toxic_ids = labelled.filter((F.col("toxic") == 1) & (draw < share(max_positive, n_toxic))).select("doc_id").distinct().limit(2 * max_positive).withColumn("is_p", F.lit(True))

    sampled = known.join(F.broadcast(toxic_ids), "doc_id", "left").withColumn("is_u", draw < share(max_unlabelled, n_docs)).withColumn("is_p", F.coalesce("is_p", F.lit(False)))
    drawn = sampled.filter(F.col("is_p") | F.col("is_u"))
    rows = materialize(drawn.select("doc_id", "is_p", "is_u", _keys_column().alias("keys")), "toxicity-sample")
    if rows.count() > 2 * (max_positive + max_unlabelled):  # an id that very many rows repeat is drawn with all of them
        rows = rows.limit(2 * (max_positive + max_unlabelled))
    got = rows.toArrow().sort_by("doc_id").combine_chunks()
    if not got.num_rows:
        return train_pu([], [], prior, np.empty(0))
    # all texts' keys in one array, and each text's part of it
    lists = got["keys"].combine_chunks()
    flat, ends = lists.flatten().to_numpy().view(np.uint32), lists.offsets.to_numpy()
    texts = [flat[a - ends[0] : e - ends[0]] for a, e in zip(ends[:-1], ends[1:], strict=True)]
    of = lambda c: [t for t, yes in zip(texts, got[c].to_pylist(), strict=True) if yes]
    positive, unlabelled, keys = of("is_p"), of("is_u"), np.unique(flat)
    del got, lists
    return train_pu(positive, unlabelled, prior, keys)


def score_column(model: Model, text_col: str = "text"):
    """Column: the score of every whole text."""
    sent = SparkSession.getActiveSession().sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        made = sent.value
        return pd.Series([made.score(t) for t in texts], dtype="float64")

    return score.asNondeterministic()(F.col(text_col))


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted)."""
    scored = docs.select(F.col(id_col).alias("doc_id"), score_column(model, text_col).alias("score"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, fit(docs, table(spark, sf_dir, "labels")))


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents whose score stays below the threshold, with their columns. A null or empty text scores the
    model's bias, so it stays unless most texts are toxic. Repeated rows and null ids are judged by their texts like any others."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = packed(docs).select("row", score_column(model, "row.text").alias("score"))
    return scored.filter(F.col("score") < THRESHOLD).select("row.*")
