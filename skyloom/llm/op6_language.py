"""Operator 6: language identification by sparse multinomial logistic regression on TF-IDF of character n-grams.

Letters are lower-cased, all else becomes a space, and n-grams of one to three characters are hashed into a fixed
number of features. Document frequencies are counted over all training documents. The weights are learned by
follow-the-regularised-leader with elastic-net penalties from a bounded sample of every language, and a
temperature is fitted on a part of that sample which the weights don't see. Memory and time of training grow with the number of languages.

A text that is null or has no letter is ``und`` with score 0. Repeated rows and null ids are kept; rows with a null
id or language never train. Without any training row every text with letters is ``und`` as well.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import collected, held_out, packed, table, trainable

BITS = 14
FEATURES = 1 << BITS
#: Training documents a language, and of all languages together: shared alike where there are more than 200, 20 each at least.
PER_LANGUAGE, MAX_ROWS = 1500, 300_000
#: The elastic net's penalties. At sf0.1, 0.1 holds two thirds of the seen features' weights at zero without a held-out error more.
L1, L2 = 0.1, 1e-4
UNDETERMINED = "und"
#: The pipeline keeps documents whose language is at least so certain.
LEAST_SCORE = 0.5


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed n-grams of a whole text; None without a letter."""
    if not text:
        return None
    a = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4")
    is_letter = _letters()[a]
    if not is_letter.any():
        return None
    a = np.where(is_letter, a, 32).astype(np.uint32)
    shift = np.uint32(32 - BITS)
    one = a * np.uint32(2654435761)
    total = np.bincount((one >> shift).astype(np.int64), minlength=FEATURES)
    if len(a) > 1:
        two = (one[:-1] ^ (a[1:] * np.uint32(2246822519))) * np.uint32(3266489917)
        total += np.bincount((two >> shift).astype(np.int64), minlength=FEATURES)
        if len(a) > 2:
            three = (two[:-1] ^ (a[2:] * np.uint32(668265263))) * np.uint32(374761393)
            total += np.bincount((three >> shift).astype(np.int64), minlength=FEATURES)
    return total


def tf_idf(n: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features present and their values, of length 1."""
    at = np.flatnonzero(n)
    x = (1 + np.log(n[at])) * idf[at]
    return at, x / (np.sqrt((x * x).sum()) or 1.0)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # features x languages
    bias: np.ndarray
    temperature: float

    def logits(self, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        n = counts(text)
        if n is None or not self.languages:
            return UNDETERMINED, 0.0
        z = self.logits(*tf_idf(n, self.idf)) / self.temperature
        p = np.exp(z - z.max())
        k = int(np.argmax(p))
        return self.languages[k], float(p[k] / p.sum())


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], n_classes: int, epochs: int = 4, alpha: float = 1.0, beta: float = 1.0, l1: float = L1, l2: float = L2, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with per-coordinate rates; weights that l1 holds at zero stay sparse."""
    z, n = np.zeros((FEATURES + 1, n_classes)), np.zeros((FEATURES + 1, n_classes))
    order = np.random.default_rng(seed)

    def weights(zi, ni):
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            at, x, y = rows[k]
            at, x = np.append(at, FEATURES), np.append(x, 0.2)
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1
            g = x[:, None] * p
            g2 = g * g
            z[at] = zi + g - (np.sqrt(ni + g2) - np.sqrt(ni)) / alpha * w
            n[at] = ni + g2
    # the weights take z's place, some features at a time
    for k in range(0, FEATURES + 1, 1024):
        z[k : k + 1024] = weights(z[k : k + 1024], n[k : k + 1024])
    return z[:-1].astype(np.float32), z[-1] * 0.2


def fit_temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by golden section on its logarithm."""
    if not len(y):
        return 1.0

    def loss(t):
        s = z / np.exp(t)
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]).mean())

    a, b, r = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Learn from (doc_id, text, lang) outside the held-out fold."""
    known = docs.select("doc_id", "text", "lang").filter(trainable() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    by_language = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(by_language)
    if not languages:
        return Model([], np.zeros(FEATURES), np.zeros((FEATURES, 0)), np.zeros(0), 1.0)

    def frequencies(batches):
        total, n = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for t in batch["text"]:
                c = counts(t)
                if c is not None:
                    total += c > 0
                    n += 1
        at = np.flatnonzero(total)
        yield pd.DataFrame({"feature": np.append(at, -1), "n": np.append(total[at], n)})

    found = collected(known.select("text").mapInPandas(frequencies, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")))
    df = np.zeros(FEATURES)
    inside = found["feature"] >= 0
    df[found["feature"][inside].to_numpy()] = found["n"][inside].to_numpy()
    n_docs = int(found["n"][~inside].sum())
    idf = np.log((1 + n_docs) / (1 + df)) + 1

    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000))
    per_language = max(20, min(per_language, MAX_ROWS // len(languages)))
    shares = [(lang, int(min(1.0, per_language / n) * 1_000_000)) for lang, n in by_language.items()]
    least = F.broadcast(known.sparkSession.createDataFrame(pd.DataFrame(shares, columns=["lang", "least"]), "lang string, least long"))

    @F.pandas_udf("features array<int>, n array<int>")
    def sparse(texts: pd.Series) -> pd.DataFrame:
        made = [counts(t) for t in texts]
        at = [np.flatnonzero(c).astype(np.int32) if c is not None else np.empty(0, np.int32) for c in made]
        return pd.DataFrame({"features": at, "n": [c[i].astype(np.int32) if c is not None else np.empty(0, np.int32) for c, i in zip(made, at, strict=True)]})

    drawn = known.join(least, "lang").filter(draw < F.col("least")).select("doc_id", "lang", sparse.asNondeterministic()("text").alias("s")).select("doc_id", "lang", "s.*")
    sample = collected(drawn).sort_values("doc_id", kind="stable", ignore_index=True)
    rows, number = [], {lang: k for k, lang in enumerate(languages)}
    for at, n, lang in zip(sample["features"], sample["n"], sample["lang"], strict=True):
        at, n = np.asarray(at, np.int64), np.asarray(n, float)
        if len(at):
            x = (1 + np.log(n)) * idf[at]
            rows.append((at, x / np.sqrt((x * x).sum()), number[lang]))
    # every fifth row is set aside, but no language's first
    first = {y: k for k, (*_, y) in reversed(list(enumerate(rows)))}
    aside = [r for k, r in enumerate(rows) if k % 5 == 0 and first[r[2]] != k]
    learn = [r for k, r in enumerate(rows) if k % 5 or first[r[2]] == k]
    w, b = train_ftrl(learn, len(languages))
    z = np.array([x @ w[at] + b for at, x, _ in aside]) if aside else np.zeros((0, len(languages)))
    return Model(languages, idf, w, b, fit_temperature(z, np.array([y for *_, y in aside], dtype=int)))


def _predict_column(model: Model, text_col: str = "text"):
    sent = SparkSession.getActiveSession().sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        made = sent.value
        return pd.DataFrame([made.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict.asNondeterministic()(F.col(text_col))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score)."""
    found = docs.select(F.col(id_col).alias("doc_id"), _predict_column(model, text_col).alias("r"))
    return found.select("doc_id", held_out().alias("held_out"), "r.lang_pred", "r.score")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))


def reject_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents whose language is found with enough certainty, with their columns. Texts that are null, empty or
    without a letter have no language and go. Repeated rows and null ids are judged by their texts like any others."""
    found = packed(docs).select("row", _predict_column(fit(docs), "row.text").alias("p"))
    return found.filter((F.col("p.lang_pred") != UNDETERMINED) & (F.col("p.score") >= LEAST_SCORE)).select("row.*")
