"""Operator 11: token ids as binary files with Elias-Fano document boundaries.

The format is a Parquet folder of segments, a row each. A segment holds the concatenated ids of consecutive documents (16 bits an id where the
vocabulary allows, else 32, little-endian), the end of each document in it as an Elias-Fano sequence with select samples, and the documents'
own ids, less the least of them, as another; no table holds 64 bits a document. Documents ascend by doc_id over segments and shards.
A segment knows how many ids stand before it in its shard; the shards' sums (at most ``MAX_SHARDS`` numbers) give the rest.

How the order comes about: texts are encoded once and the narrow ids are written; ranges of (doc_id, digest of the text, row number) are dealt to shards,
so one id with a third of all rows still spreads; each shard is sorted and cut into segments as it streams by, so a task holds a segment at most.

Null counts as an empty text: the end mark alone. Null doc_ids come first, in the order of their texts' digests, as do repeated ids among
themselves; repeated rows each keep their place. An empty table gives a folder without segments. Columns other than the two named ones aren't read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_left, bisect_right
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import _L as LETTERS
from .bpe import _N as DIGITS
from .bpe import _S as WHITE
from .bpe import byte_alphabet, shown, uncommon
from .common import clean, fresh_path, materialize, small_batches, table, written
from .elias_fano import EliasFano, encode
from .op2_token_counts import WordCounter, vocabulary_path

END_ID = 2
#: A segment is closed with so many ids or documents; a longer document has one of its own.
SEGMENT_IDS, SEGMENT_DOCS = 1 << 17, 1 << 15
#: Ids a shard should hold, and the largest number of shards: their sums go to the driver.
SHARD_IDS, MAX_SHARDS = 1 << 22, 1 << 15
#: Words kept in a worker's memo, and the longest kept.
MEMO_WORDS, MEMO_CHARS = 300_000, 64
SEGMENT = "shard int, segment int, base long, n_docs int, n_ids long, width int, n_null int, least long, most long, doc_ids binary, bounds binary, ids binary"


class Words(dict):
    """Ids, as bytes, of words as the split leaves them; filled by the library's model, emptied when full."""

    def __init__(self, library, width: int):
        super().__init__()
        self.tokenize, self.width, self.letter = library.model.tokenize, width, {b: c for c, b in byte_alphabet().items()}

    def __missing__(self, word: str) -> bytes:
        shape = word if word.isascii() and word.isalnum() else "".join([self.letter[b] for b in word.encode("utf-8", "replace")])
        made = b"".join([t.id.to_bytes(self.width, "little") for t in self.tokenize(shape)])
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[word] = made
        return made


#: The split of the vocabulary file over common characters, which lie in plain ranges (fixed value).
SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^{WHITE}{LETTERS}{DIGITS}]+")


@lru_cache(maxsize=4)
def encoder(path: str, end_id: int = END_ID):
    """A function from text to the bytes of its ids and the end mark, and the width of an id.

    Where the tokenizer drops white space and merges within words only, a word's ids don't depend on its surroundings and are kept in a bounded memo; normalising
    and merging are the library's. A text of common characters is in its normal form, and only needs small letters. Texts with a special string, and
    other tokenizers, go through the library whole.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    width = 2 if max(library.get_vocab_size(with_added_tokens=True), end_id + 1) <= 1 << 16 else 4
    kind = f"<u{width}"
    end = np.asarray([end_id], dtype=kind).tobytes()
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)

    def whole(text: str) -> bytes:
        return np.asarray(library.encode(text, add_special_tokens=False).ids, dtype=kind).tobytes() + end

    if not WordCounter.fits(spec):
        return whole, width
    of, specials = Words(library, width).__getitem__, [t["content"] for t in spec["added_tokens"]]

    def made(text: str) -> bytes:
        if any(s in text for s in specials):
            return whole(text)
        plain = library.normalizer.normalize_str(text) if uncommon(text) else text.lower()
        words = [plain[m.start() : m.end()] for m in SPLIT.finditer(shown(plain))] if uncommon(plain) else SPLIT.findall(plain)
        return b"".join(map(of, words)) + end

    return made, width


def encoded(docs: DataFrame, path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, ids binary) of every whole text, with the end mark."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("binary")
    def ids_of(texts: pd.Series) -> pd.Series:
        of = encoder(path, end_id)[0]
        return pd.Series([of(t or "") for t in texts], dtype=object)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("digest"), ids_of(F.col(text_col)).alias("ids"))


class _Open:
    """A segment that's being filled."""

    def __init__(self, shard: int, number: int, base: int, width: int):
        self.shard, self.number, self.base, self.width = shard, number, base, width
        self.docs, self.parts, self.ends, self.n_ids = [], [], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.n_ids += len(ids) // self.width
        self.docs.append(doc_id)
        self.parts.append(ids)
        self.ends.append(self.n_ids)

    def full(self) -> bool:
        return self.n_ids >= SEGMENT_IDS or len(self.docs) >= SEGMENT_DOCS

    def row(self) -> dict:
        known = [d for d in self.docs if d is not None]
        # differences of 64-bit ids can pass 63 bits
        above = np.array([d - known[0] for d in known], dtype=np.uint64)
        return dict(
            shard=self.shard, segment=self.number, base=self.base, n_docs=len(self.docs), n_ids=self.n_ids, width=self.width, n_null=len(self.docs) - len(known), least=known[0] if known else None, most=known[-1] if known else None,
            doc_ids=encode(above), bounds=encode(np.array(self.ends, dtype=np.uint64)), ids=b"".join(self.parts),
        )


def _arrow(schema: str):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def write_binary(docs: DataFrame, out: str, path: str | None = None, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encodes every text and writes the folder ``out``, which must not exist yet; returns ``out``."""
    spark, path, first = docs.sparkSession, path or vocabulary_path(), written()
    width, arrow = encoder(path, end_id)[1], _arrow(SEGMENT)
    flat = materialize(encoded(docs, path, end_id, id_col, text_col).withColumn("nr", F.monotonically_increasing_id()), "token-ids", "zstd")
    total = flat.agg(F.sum(F.octet_length("ids"))).first()[0] or 0
    shards = min(MAX_SHARDS, max(spark.sparkContext.defaultParallelism, total // width // SHARD_IDS))
    order = ["doc_id", "digest", "nr"]

    def cut(batches):
        now = None
        shard = TaskContext.get().partitionId()
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if now is None:
                    now = _Open(shard, 0, 0, width)
                now.add(doc_id, ids.as_py())
                if now.full():
                    yield pa.RecordBatch.from_pylist([now.row()], schema=arrow)
                    now = _Open(shard, now.number + 1, now.base + now.n_ids, width)
        if now is not None and now.docs:
            yield pa.RecordBatch.from_pylist([now.row()], schema=arrow)

    ranged = flat.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    ranged.select("doc_id", "ids").mapInArrow(cut, SEGMENT).write.option("compression", "zstd").parquet(out)
    clean(spark, first)
    return out


def segments(spark: SparkSession, out: str) -> DataFrame:
    """The rows of a written folder."""
    small_batches(spark)
    return spark.read.schema(SEGMENT).parquet(out)


def _bases(rows: DataFrame) -> dict[int, int]:
    """Ids before each shard."""
    sums = sorted(rows.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect())
    before = np.concatenate([[0], np.cumsum([r.n for r in sums], dtype=np.int64)]) if sums else [0]
    return {r.shard: int(b) for r, b in zip(sums, before, strict=False)}


def _documents(row: dict) -> list[int | None]:
    return [None] * row["n_null"] + [row["least"] + d for d in EliasFano(row["doc_ids"]).values().tolist()]


def boundaries(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, start, n_tokens) of all documents, from the sequences alone: the ids aren't read."""
    return _rows(segments(spark, out), False).select("doc_id", "start", "n_tokens")


def documents(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of all documents; the checksum is that of the ids as 32-bit integers."""
    return _rows(segments(spark, out), True)


def _rows(rows: DataFrame, with_ids: bool) -> DataFrame:
    base, names = _bases(rows), ["shard", "base", "width", "n_null", "least", "doc_ids", "bounds", *(["ids"] if with_ids else [])]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    arrow = _arrow(schema)

    def read(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                ends = EliasFano(row["bounds"]).values().astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                sums = [None] * len(ends)
                if with_ids:
                    wide = memoryview(np.frombuffer(row["ids"], dtype=f"<u{row['width']}").astype("<u4").tobytes())
                    sums = [zlib.crc32(wide[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(_documents(row), pa.int64()), pa.array(starts + base[row["shard"]] + row["base"]), pa.array(ends - starts), pa.array(sums, pa.int64())], schema=arrow)

    return rows.select(*names).mapInArrow(read, schema)


def fetch(spark: SparkSession, out: str, wanted: list[int]) -> DataFrame:
    """(doc_id, start, n_tokens, ids array<int>) of a bounded list of documents. Statistics of the files leave out segments that can't hold one; in the others, a
    document's place comes from a search by select, and only its own ids are unpacked. A repeated id gives each of its documents."""
    rows = segments(spark, out)
    base, asked, schema = _bases(rows), sorted(set(wanted)), "doc_id long, start long, n_tokens long, ids array<int>"
    arrow = _arrow(schema)
    near = rows.filter(F.expr(" or ".join(f"({x} between least and most)" for x in asked) or "false")) if len(asked) <= 64 else rows.filter(F.lit(asked[0]) <= F.col("most")).filter(F.col("least") <= asked[-1])

    def read(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                own, bounds, found = EliasFano(row["doc_ids"]), EliasFano(row["bounds"]), []
                for x in asked[bisect_left(asked, row["least"]) : bisect_right(asked, row["most"])]:
                    at = own.first_at_least(x - row["least"])
                    while at < len(own) and own.select(at) == x - row["least"]:
                        i = at + row["n_null"]
                        a, b = bounds.select(i - 1) if i else 0, bounds.select(i)
                        ids = np.frombuffer(row["ids"], dtype=f"<u{row['width']}", count=b - a, offset=a * row["width"])
                        found.append({"doc_id": x, "start": base[row["shard"]] + row["base"] + a, "n_tokens": b - a, "ids": ids.astype(np.int32).tolist()})
                        at += 1
                yield pa.RecordBatch.from_pylist(found, schema=arrow)

    return near.mapInArrow(read, schema)


def op11_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the files, which stay, and reads them back."""
    return documents(spark, write_binary(table(spark, sf_dir, "documents"), fresh_path(spark, "token-binary")))
