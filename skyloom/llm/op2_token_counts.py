"""Operator 2: token counts by a digest cache.

A text is normalised (runs of ASCII white space become one space, ends are trimmed: the tokenizer drops white space
itself, so the count stays the same), and SHA-256 of that and of the tokenizer's version is looked up in a cache
table. Only distinct misses are encoded, and their counts are appended to the cache. Null counts as empty.
Repeated rows each get their count; null ids stay. The cache is a Parquet folder in shared storage, one
subfolder a tokenizer; two writers may append the same digest, which reading removes.
"""

from __future__ import annotations

import hashlib
import json
import os
from functools import lru_cache

import pandas as pd
import regex
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import SPACE, byte_alphabet, shown, uncommon
from .common import fresh_path, materialize, materialize_narrow, table

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
#: Words kept in a worker's memo before it is emptied.
MEMO_WORDS = 300_000
#: A digest with more than one in so many rows is looked up apart.
HOT = 1000


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordCounter:
    """Counts of a tokenizer that lower-cases, drops white space and merges within words only: a word's count doesn't depend on
    its surroundings, so it's kept in a memo of bounded size. Normalising and merging are the library's own; only the split is done here, by
    the pattern of the file. Texts that hold a special string go through the library whole."""

    def __init__(self, spec: dict, library):
        self.library, self.memo = library, {}
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", SPACE))
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.letter = {b: c for c, b in byte_alphabet().items()}

    @staticmethod
    def fits(spec: dict) -> bool:
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
        kinds = [(x["type"], x.get("behavior"), x.get("invert"), x.get("use_regex")) for x in steps]
        clean = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers") or []] == ["NFC", "Replace", "Lowercase"]
        return clean and kinds == [("Split", "Removed", True, None), ("ByteLevel", None, None, False)] and spec.get("post_processor") is None

    def __call__(self, text: str) -> int:
        if any(s in text for s in self.specials):
            return len(self.library.encode(text, add_special_tokens=False).ids)
        # plain ASCII has no other normal form
        plain = text.lower() if text.isascii() else self.library.normalizer.normalize_str(text)
        memo, total = self.memo, 0
        words = [plain[m.start() : m.end()] for m in self.split.finditer(shown(plain))] if uncommon(plain) else self.split.findall(plain)
        for w in words:
            n = memo.get(w)
            if n is None:
                if len(memo) >= MEMO_WORDS:
                    memo.clear()
                n = memo[w] = len(self.library.model.tokenize("".join([self.letter[b] for b in w.encode("utf-8", "replace")])))
            total += n
        return total


@lru_cache(maxsize=4)
def _counter(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path.endswith(".model"):
        import sentencepiece

        made = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in made.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if WordCounter.fits(spec):
        count = WordCounter(spec, made)
        return lambda texts: [count(t) for t in texts]
    return lambda texts: [len(e) for t in texts for e in made.encode_batch_fast([t], add_special_tokens=False)]


def drops_white_space(path: str) -> bool:
    """Whether a vocabulary file's normalizer and pre-tokenizer leave no white space, whatever stands between words."""
    if path.endswith(".model"):
        return False
    with open(path, encoding="utf-8") as f:
        return WordCounter.fits(json.load(f))


def tokenizer_digest(path: str) -> str:
    """SHA-256 of the vocabulary file: another file is another version."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def normalised(text):
    """Column: what a tokenizer that drops white space between words makes the same count of."""
    return F.btrim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\t\n\x0B\f\r ]+", " "))


def read_cache(spark: SparkSession, cache_path: str, version: str) -> DataFrame:
    """(digest, n_tokens), one row a digest; empty before the first append."""
    try:
        kept = spark.read.schema("digest binary, n_tokens long").parquet(f"{cache_path}/{version}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "digest binary, n_tokens long")
    return kept.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, cache_path: str, path: str | None = None, limit: int = LIMIT, white_space_free: bool | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit). ``white_space_free``: the tokenizer drops white space, so texts that
    differ only there share a cache entry; else the content is taken as it is. Unless given, it's told from the vocabulary file."""
    spark, path = docs.sparkSession, path or vocabulary_path()
    if white_space_free is None:
        white_space_free = drops_white_space(path)
    version = tokenizer_digest(path)
    content = normalised(F.col(text_col)) if white_space_free else F.coalesce(F.col(text_col), F.lit(""))
    read = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_bytes"), content.alias("content"))
    keyed = read.withColumn("digest", F.unhex(F.sha2(F.col("content"), 256)))
    narrow = materialize(keyed.select("doc_id", "n_bytes", "digest"), "token-digests")

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series(_counter(path)(texts.tolist()), dtype="int64")

    known = read_cache(spark, cache_path, version)
    # the texts of distinct misses: one row a digest, combined before the exchange
    misses = keyed.select("digest", "content").dropDuplicates(["digest"]).join(known, "digest", "left_anti")
    misses.select("digest", count.asNondeterministic()("content").alias("n_tokens")).write.mode("append").parquet(f"{cache_path}/{version}")
    counts = read_cache(spark, cache_path, version)
    # digests with more than one in HOT of all rows are fewer than that and go to all tasks; only the other rows are dealt by digest
    often = narrow.groupBy("digest").agg(F.count("*").alias("n")).filter(F.col("n") * HOT > narrow.count()).select("digest")
    hot = F.broadcast(materialize_narrow(counts.join(often, "digest"), "hot-digests"))
    rest = narrow.join(hot.select("digest"), "digest", "left_anti").join(counts, "digest", "left")
    found = narrow.join(hot, "digest").unionByName(rest)
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache, so every distinct text is encoded here."""
    return count_tokens(table(spark, sf_dir, "documents"), fresh_path(spark, "token-cache"))
