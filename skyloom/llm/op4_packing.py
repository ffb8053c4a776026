"""Operator 4: best-fit packing by the sum-of-squares rule.

A document becomes its ids and an end mark; only those longer than a sequence are cut, and the first piece takes the
remainder, so all others fill a sequence each. Each piece goes where the sum over gaps of the squared number of open
bins becomes smallest. The rule needs only the counts of open bins by gap, so a shard of pieces, the longer
half first and then the others mixed, is packed by one task in memory bounded by the shard; shards have a fixed expected
number of rows. Bins that stay less than full are then packed again as wholes, across shards, by the same rule.

Null texts count as empty: they are one piece that holds the end mark. Repeated rows and null ids are kept, as a
piece each. An empty table gives no rows.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import read_vocabulary
from .common import materialize, table

VOCABULARY = "byte_bpe_50k.json"
CAPACITY = 1024
END_ID = 2
#: Pieces a task packs.
SHARD_ROWS = 20_000
#: Characters on which the two tokenizer libraries' classes agree beyond doubt; other texts take the slower library.
COMMON = regex.compile(r"[^\x00-ɏ‐-‧]")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def _encoder(path: str):
    """Ids as the tokenizers library gives them; common texts go through a faster library over the same tables."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tiktoken
    from tokenizers import Tokenizer

    from public_tokenizers import PATTERN

    with open(path, encoding="utf-8") as f:
        vocabulary, special = read_vocabulary(json.load(f))
    fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=vocabulary, special_tokens=special)
    slow = Tokenizer.from_file(path)
    slow.no_truncation()
    slow.no_padding()

    def ids(text: str) -> np.ndarray:
        if COMMON.search(text) or len(text) > 1_000_000:
            return np.asarray(slow.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.asarray(fast.encode(text, allowed_special="all"), dtype="<u4")

    return ids


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids binary): little-endian unsigned 32-bit ids of each piece."""
    path = path or vocabulary_path()

    @F.pandas_udf("array<struct<start: long, length: long, ids: binary>>")
    def cut(texts: pd.Series) -> pd.Series:
        encode, out = _encoder(path), []
        for t in texts:
            ids = np.append(encode(t or ""), np.uint32(end_id)).astype("<u4")
            first = len(ids) % capacity
            ends = ([first] if first else []) + list(range(first + capacity, len(ids) + 1, capacity))
            out.append([{"start": a, "length": b - a, "ids": ids[a:b].tobytes()} for a, b in zip([0, *ends], ends, strict=False)])
        return pd.Series(out, dtype=object)

    cut_rows = docs.select(F.col(id_col).alias("doc_id"), cut.asNondeterministic()(F.col(text_col)).alias("p"))
    return cut_rows.select("doc_id", F.posexplode("p").alias("piece", "p")).select("doc_id", "piece", "p.start", "p.length", "p.ids")


def sum_of_squares(lengths: np.ndarray, capacity: int, sparing: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, taken in the order given, and how full each bin gets. ``sparing``: a new bin only if no open one fits.

    Placing an item of length s in a bin of gap g changes the sum of squares by 2 (N[g-s] - N[g]) + 2, where N[0]
    counts nothing; a new bin is one of gap ``capacity`` that counts nothing. The largest fall wins, the smaller gap
    among equals.
    """
    n = np.zeros(capacity + 1, dtype=np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, fill = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    far = np.iinfo(np.int64).max
    for k, s in enumerate(lengths.tolist()):
        after = n[0 : capacity + 1 - s]  # counts at gap g - s, for g from s to capacity
        here = n[s : capacity + 1]
        cost = np.where(here > 0, 2 * (after - here) + 2, far)
        if here[0] > 0:
            cost[0] = 1 - 2 * here[0]
        if s == capacity:
            cost[-1] = 0
        elif not sparing or not here[:-1].any():
            cost[-1] = 2 * n[capacity - s] + 1
        g = int(np.argmin(cost)) + s
        if g == capacity:
            b = len(fill)
            fill.append(0)
        else:
            b = stacks[g].pop()
            n[g] -= 1
        bins[k], offsets[k] = b, fill[b]
        fill[b] += s
        if g - s:
            stacks[g - s].append(b)
            n[g - s] += 1
    return bins, offsets, np.asarray(fill, dtype=np.int64)


def arrival(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The order in which items are placed: those longer than half a bin first, longest first, for each opens a bin anyway; then the others,
    mixed, for the rule steers by the counts that a mixed stream builds up."""
    big = np.flatnonzero(2 * lengths > capacity)
    small = np.flatnonzero(2 * lengths <= capacity)
    return np.concatenate([big[np.argsort(-lengths[big], kind="stable")], np.random.default_rng(0).permutation(small)])


def fewest_bins(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The better of two runs of the rule: over the mixed arrival, which wins for many items, and sparing over falling lengths, which wins for few."""
    best = None
    for order, sparing in ((arrival(lengths, capacity), False), (np.argsort(-lengths, kind="stable"), True)):
        b, o, fill = sum_of_squares(lengths[order], capacity, sparing)
        if best is None or len(fill) < len(best[2]):
            bins, offsets = np.empty_like(b), np.empty_like(o)
            bins[order], offsets[order] = b, o
            best = bins, offsets, fill
    return best


def pack(items: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``items``, a written table with rid (long, distinct, never null) and length, with sequence_id and offset.

    Only rid and length go through Python, so that no other column's values or nulls can suffer there. Pieces as long as a
    sequence need no search. The rest is dealt into shards at random by rid, so that no repeated id makes a shard larger.
    """
    is_full = F.col("length") >= capacity
    rest = items.filter(~is_full)
    shards = max(1, -(-rest.count() // shard_rows))

    def pack_shard(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rid", kind="stable", ignore_index=True)
        bins, offsets, fill = fewest_bins(rows["length"].to_numpy(), capacity)
        return rows.assign(bin=bins, offset=offsets, fill=fill[bins])[["rid", "shard", "bin", "offset", "fill"]]

    dealt = rest.select("rid", "length", F.pmod(F.xxhash64("rid"), F.lit(shards)).alias("shard")).repartition(shards, "shard")
    first = materialize(dealt.groupBy("shard").applyInPandas(pack_shard, "rid long, shard long, bin long, offset long, fill long"), "packed")
    loose = first.filter((F.col("offset") == 0) & (F.col("fill") < capacity)).select("shard", "bin", "fill")
    again = max(1, -(-loose.count() // shard_rows))

    def pack_bins(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["shard", "bin"], kind="stable", ignore_index=True)
        made, offsets, _ = fewest_bins(rows["fill"].to_numpy(), capacity)
        return rows.assign(made=made, base=offsets)[["shard", "bin", "again", "made", "base"]]

    redealt = loose.withColumn("again", F.pmod(F.xxhash64("shard", "bin"), F.lit(again))).repartition(again, "again")
    moved = redealt.groupBy("again").applyInPandas(pack_bins, "shard long, bin long, again long, made long, base long")
    # numbers: three residues keep full pieces, untouched bins and repacked bins apart
    placed = first.join(moved, ["shard", "bin"], "left").select(
        "rid",
        F.when(F.col("made").isNull(), (F.col("bin") * shards + F.col("shard")) * 3).otherwise((F.col("made") * again + F.col("again")) * 3 + 1).alias("sequence_id"),
        (F.col("offset") + F.coalesce(F.col("base"), F.lit(0))).alias("offset"),
    )
    whole = items.filter(is_full).select("*", (F.col("rid") * 3 + 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return rest.join(placed, "rid").unionByName(whole)


def _numbered(cut: DataFrame) -> DataFrame:
    return cut.select(F.monotonically_increasing_id().alias("rid"), "*")


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, shard_rows: int = SHARD_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every document."""
    cut = pieces(docs, path, capacity, end_id, id_col, text_col)
    narrow = _numbered(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
    return pack(materialize(narrow, "pieces"), capacity, shard_rows).drop("rid")


def sequences(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(sequence_id, ids binary, n): the packed sequences themselves. A sequence gathers ``capacity`` pieces at most."""
    placed = pack(materialize(_numbered(pieces(docs, path, capacity, end_id, id_col, text_col)), "pieces-with-ids"), capacity)
    parts = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"), F.sum("length").alias("n"))
    return parts.select("sequence_id", F.expr("aggregate(p, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids"), "n")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
