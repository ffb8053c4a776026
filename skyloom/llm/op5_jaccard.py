"""Operator 5: n-gram Jaccard join by signature trees.

Documents with equal shingle sets form a class; classes are compared, documents only carry their class's result. A pair of
similar sets shares a token among the first fifth (and one more) of each, in any order of tokens that is the same for all.
The order here: a fixed quarter of all tokens by its hash comes first, rare tokens before frequent ones; the others follow by hash, and
only sets too small in that quarter need them. Tokens of one class only can't link anything and fall away, and most documents
with them. Classes that share such a token meet in a block, named by the token's smallest class; a block gets
each class's whole set once. A large block is dealt into levels of set sizes, of which only adjoining ones can hold similar sets, and those into chunks;
its smallest class goes to each chunk. In a chunk a signature tree is joined with itself (signature_tree.py); every link is verified on the whole sets. Chunks
of a block whose classes aren't all in one component yet are dealt anew by a better order, in which all tokens of these classes are counted: what many unlike documents have in
common, a notice say, then names no block. The few large blocks that stay open even so have their chunks joined with each other where their levels allow, except for pairs within the
component that most are in, which need no comparing. So nothing is left out, and a large group of near copies costs its size.

A document with fewer words than a shingle has the whole sequence as its one shingle; without words or text
the set is empty and linked with nothing, and the component is the document's own id. Repeated rows
are documents of their own. A row with a null id can link others; its own component is the smallest id it reaches, or null.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import collected, materialize, materialize_narrow, packed, table
from .components import components, with_least
from .signature_tree import Union, joined

WORDS = 5
NUM, DEN = 80, 100
CHUNK = 1024
#: Where sets meet: a chunk of a level of a block, and two of them.
PLACE, ACROSS = ["block", "level", "chunk"], ["block", "level", "i", "level2", "j"]
#: One token in so many is in the part of the order that is sorted by frequency.
SAMPLED = 4
#: Bits of the filter that keeps most sets without candidates from being built again; its size is fixed.
FILTER_BITS = 1 << 26
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles."""
    found = (text or "").encode("utf-8", "replace").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), dtype=np.uint64, count=len(found))
    if len(h) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(found), seed=1)], dtype=np.uint64)
    n = len(h) - words + 1
    mixed = np.zeros(n, np.uint64)
    for k in range(words):
        mixed = (mixed ^ (h[k : k + n] * _ODD[k % 8])) * np.uint64(0x9FB21C651E98DF25)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def first_fifth(n: int, num: int = NUM, den: int = DEN) -> int:
    """Length of the part of a set of size n that must hold a common token: n less the least overlap, and one."""
    return n - -(-num * n // den) + 1


def order_tokens(s: np.ndarray, num: int = NUM, den: int = DEN) -> np.ndarray:
    """All tokens of the sampled part, and as many of the others as the first fifth still lacks."""
    sampled = s % np.uint64(SAMPLED) == 0
    lack = first_fifth(len(s), num, den) - int(sampled.sum())
    return np.concatenate([s[sampled], s[~sampled][:lack]]) if lack > 0 else s[sampled]


def _mark(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def _places(marks: np.ndarray) -> np.ndarray:
    """Three places in the filter of each mark."""
    return np.stack([(marks.astype(np.int64).view(np.uint64) * m) >> np.uint64(64 - FILTER_BITS.bit_length() + 1) for m in _ODD[:3]]).astype(np.int64)


def _reduced(docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """(rid, doc_id, mark, n, cls, toks): one row a document; toks only at the first document of its class in a partition.
    ``mark`` is a hash of the text that Spark can compute again."""

    def each(batches):
        seen: set[bytes] = set()
        for batch in batches:
            n, cls, toks = [], [], []
            for t in batch["text"]:
                s = shingles(t, words)
                c = xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None
                n.append(len(s))
                cls.append(c)
                toks.append(None if c is None or c in seen else _signed(order_tokens(s, num, den)))
                if c is not None:
                    seen.add(c)
            yield pd.DataFrame({"id": batch["id"], "known": batch["known"], "mark": batch["mark"], "n": n, "cls": cls, "toks": toks})

    # a column of longs with a null would be doubles in pandas, and ids above 2^53 would change
    doc_id = F.col("doc_id").cast("long")
    sent = docs.select(F.coalesce(doc_id, F.lit(0)).alias("id"), doc_id.isNotNull().alias("known"), "text", _mark(F.col("text")).alias("mark"))
    made = sent.mapInPandas(each, "id long, known boolean, mark long, n long, cls binary, toks array<long>")
    return made.select(F.monotonically_increasing_id().alias("rid"), F.when(F.col("known"), F.col("id")).alias("doc_id"), "mark", "n", "cls", "toks")


def _blocks(reduced: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """(block, node): classes that share a token of their first fifths, under the smallest of them."""
    # partial sums before the exchange; only tokens of two rows or more come back
    entries = reduced.filter(F.col("toks").isNotNull()).select("rid", F.explode("toks").alias("h"))
    counted = materialize_narrow(entries.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1"), "shared-tokens")
    shared = entries.join(counted, "h")
    sampled = f"pmod(h, {SAMPLED}) = 0"
    sizes = reduced.filter(F.col("toks").isNotNull()).select("rid", "cls", F.expr(f"size(filter(toks, h -> {sampled}))").alias("in_sample"), (F.col("n") - F.ceil(num * F.col("n") / den) + 1).cast("long").alias("fifth"))
    first_shared = materialize_narrow(_in_first_fifth(shared.withColumn("sampled", F.expr(sampled)), sizes), "first-tokens")
    by_node = materialize_narrow(first_shared.join(classes.select("cls", "node"), "cls").select("h", "node").distinct(), "first-tokens")
    least = by_node.groupBy("h").agg(F.min("node").alias("block"), F.count("*").alias("k")).filter("k > 1").select("h", "block")
    return by_node.join(materialize_narrow(least, "blocks-by-token"), "h").select("block", "node").distinct()


def _in_first_fifth(shared: DataFrame, sizes: DataFrame) -> DataFrame:
    """(h, cls): of each row, the shared tokens whose place in the order is in its first fifth.

    Tokens that aren't shared come before all shared ones of the sampled part; so many are known from the counts.
    """
    own = Window.partitionBy("rid", "sampled")
    ranked = shared.withColumn("k", F.row_number().over(own.orderBy("df", "h"))).withColumn("of", F.count("*").over(own))
    return ranked.join(sizes, "rid").filter(~F.col("sampled") | (F.col("in_sample") - F.col("of") + F.col("k") <= F.col("fifth"))).select("h", "cls")


def _sets(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(cls, toks): the whole set of each class in ``nodes`` (node, cls, mark), built from the text that the class's mark names; and of a few others whose marks the
    filter can't tell from these. Only the texts that pass the filter are cut into shingles."""
    spark = docs.sparkSession

    def positions(batches):
        for batch in batches:
            at = np.unique(_places(batch["mark"].to_numpy()))
            word = at >> 6
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(at) else np.empty(0, np.int64)
            bits = np.bitwise_or.reduceat(np.left_shift(np.uint64(1), (at & 63).astype(np.uint64)), starts) if len(at) else np.empty(0, np.uint64)
            yield pd.DataFrame({"word": word[starts], "bits": bits.view(np.int64)})

    # at most FILTER_BITS / 64 rows, whatever the input
    found = collected(nodes.select("mark").mapInPandas(positions, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")))
    filter_ = np.zeros(FILTER_BITS // 64, np.int64)
    filter_[found["word"].to_numpy()] = found["bits"].to_numpy()
    sent = spark.sparkContext.broadcast(filter_.view(np.uint64))

    def each(batches):
        words_of, seen = sent.value, set()
        for batch in batches:
            at = _places(batch["mark"].to_numpy())
            hit = (words_of[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).all(axis=0)
            cls, toks = [], []
            for t in batch["text"][hit]:
                s = shingles(t, words)
                if not len(s):
                    continue
                c = xxhash.xxh3_128_digest(s.tobytes())
                if c not in seen:
                    seen.add(c)
                    cls.append(c)
                    toks.append(s.tobytes())
            if cls:
                yield pd.DataFrame({"cls": cls, "toks": toks})

    return docs.select("text", _mark(F.col("text")).alias("mark")).mapInPandas(each, "cls binary, toks binary").dropDuplicates(["cls"])


def _grouped(batches, keys: list[str]):
    """Groups of consecutive rows with equal keys, as lists of rows; the partition is sorted by the keys."""
    held, key = [], None
    for batch in batches:
        for row in batch.itertuples(index=False):
            k = tuple(getattr(row, x) for x in keys)
            if k != key and held:
                yield held
                held = []
            key = k
            held.append(row)
    if held:
        yield held


def _within(num: int, den: int):
    """Rows (block, level, chunk, node, toks) -> (a, b): a star a component that a chunk holds."""

    def run(batches):
        for rows in _grouped(batches, PLACE):
            rows.sort(key=lambda r: r.node)
            nodes = [r.node for r in rows]
            sets = [np.frombuffer(r.toks, np.uint64) for r in rows]
            known = Union(len(rows))
            joined(sets, known, np.arange(len(rows)), None, num, den)
            links = [(nodes[known.find(k)], nodes[k]) for k in range(len(rows)) if known.find(k) != k]
            if links:
                yield pd.DataFrame(links, columns=["a", "b"])

    return run


def _across(num: int, den: int):
    """Rows (block, level, i, level2, j, side, root, node, toks) -> (a, b): links between a chunk and a chunk of a block's minor components."""

    def run(batches):
        for rows in _grouped(batches, ACROSS):
            left = [r for r in rows if r.side == 0]
            right = [r for r in rows if r.side == 1]
            if not left or not right:
                continue
            both = left + right
            sets = [np.frombuffer(r.toks, np.uint64) for r in both]
            known, first = Union(len(both)), {}
            for k, r in enumerate(both):
                known.link(first.setdefault(r.root, k), k)
            before = [known.find(k) for k in range(len(both))]
            joined(sets, known, np.arange(len(left)), np.arange(len(left), len(both)), num, den)
            links = [(both[known.find(k)].node, both[k].node) for k in sorted(set(before)) if known.find(k) != k]
            if links:
                yield pd.DataFrame(links, columns=["a", "b"])

    return run


def jaccard_components(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN, chunk: int = CHUNK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document; ``num`` / ``den`` is the least similarity."""
    return _rows(docs, words, num, den, chunk, id_col, text_col).select("doc_id", "n_shingles", "component_id")


def _rows(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN, chunk: int = CHUNK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, mark, n_shingles, component_id, root) of every document; root names the component even where no id does."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    reduced = materialize(_reduced(docs, words, num, den), "shingle-tokens")
    classes = materialize_narrow(reduced.filter(F.col("cls").isNotNull()).groupBy("cls").agg(F.min("rid").alias("node"), F.min("doc_id").alias("least_id"), F.max("n").alias("n"), F.min("mark").alias("mark")), "shingle-classes")
    blocks = materialize_narrow(_blocks(reduced, classes, num, den), "blocks")
    nodes = materialize_narrow(blocks.select("node").distinct().join(classes.select("node", "cls", "mark"), "node"), "block-nodes")
    dealt, chunks = _dealt(blocks, classes, chunk, num, den)
    # a large block's own class goes to each of its chunks: it's like most of them, and holds their components together
    spread = dealt.filter("not large or node != block").select(*PLACE, "node").unionByName(chunks.select(*PLACE, F.col("block").alias("node")))
    # sets are dealt by class once: for dropping repeated ones, and for this join
    edges = spread.join(nodes, "node").join(_sets(docs, nodes, words), "cls").select(*PLACE, "node", "toks").repartition(*PLACE).sortWithinPartitions(*PLACE).mapInPandas(_within(num, den), "a long, b long")
    edges = materialize_narrow(edges.distinct(), "links")
    found = materialize_narrow(components(edges), "components")
    large = _open(dealt.filter("large"), found)
    if not large.isEmpty():
        wide = materialize_narrow(large.select("node").distinct().join(nodes, "node"), "wide-nodes")
        members = materialize(_sets(docs, wide, words).join(wide, "cls").select("node", "toks"), "wide-sets")
        dealt, chunks = _dealt(materialize_narrow(_again(members, found, num, den), "blocks-again"), classes, chunk, num, den)
        spread = dealt.filter("not large or node != block").select(*PLACE, "node").unionByName(chunks.select(*PLACE, F.col("block").alias("node")))
        more = spread.join(members, "node").repartition(*PLACE).sortWithinPartitions(*PLACE).mapInPandas(_within(num, den), "a long, b long")
        edges = materialize_narrow(edges.unionByName(more.distinct()), "links")
        found = materialize_narrow(components(edges), "components")
        large = _open(dealt.filter("large"), found)
        if not large.isEmpty():
            edges = edges.unionByName(_cross_links(large, chunks, found, members, chunk, num, den))
            found = materialize_narrow(components(edges), "components")
    by_class = classes.join(with_least(found, classes), "node", "left").select("cls", F.coalesce("component", "least_id").alias("component"), F.coalesce("root", "node").alias("root"))
    plain = reduced.filter(F.col("cls").isNull()).select("doc_id", "mark", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.col("rid").alias("root"))
    linked = reduced.filter(F.col("cls").isNotNull()).select("doc_id", "mark", "n", "cls").join(materialize_narrow(by_class, "component-of-class"), "cls")
    return linked.select("doc_id", "mark", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "root").unionByName(plain)


def _dealt(blocks: DataFrame, classes: DataFrame, chunk: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(block, level, chunk, node, large) of every class in every block, and the distinct (block, level, chunk) of large blocks. A block larger than a chunk is
    dealt by the size of its sets: a level's sizes are as far apart as similar sets' sizes can be, so that only sets of the same and of
    adjoining levels can be similar; and a level into chunks."""
    large = materialize_narrow(blocks.groupBy("block").agg(F.count("*").alias("k")).filter(F.col("k") > chunk).select("block"), "large-blocks")
    small = blocks.join(large, "block", "left_anti").select("block", F.lit(0).alias("level"), F.lit(0).alias("chunk"), "node", F.lit(False).alias("large"))
    level = F.floor(F.log("n") / F.log(F.lit(den / num)) + 1e-9).cast("int")
    placed = materialize_narrow(blocks.join(large, "block", "left_semi").join(classes.select("node", "n"), "node").select("block", level.alias("level"), "node"), "levels")
    sizes = placed.groupBy("block", "level").agg(F.ceil(F.count("*") / chunk).cast("int").alias("chunks"))
    split = placed.join(sizes, ["block", "level"]).select("block", "level", F.pmod(F.xxhash64("node", F.lit(3)), "chunks").cast("int").alias("chunk"), "node", F.lit(True).alias("large"))
    dealt = materialize_narrow(small.unionByName(split), "chunks")
    return dealt, dealt.filter("large").select(*PLACE).distinct()


def _open(large: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``large`` whose blocks hold more than one component."""
    rooted = large.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = rooted.groupBy("block").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("block")
    return materialize_narrow(large.join(several, "block", "left_semi"), "open-blocks")


def _again(members: DataFrame, found: DataFrame, num: int, den: int) -> DataFrame:
    """(block, node) of the sets ``members`` (node, toks) by their own best order: the first pass sorts a part of the tokens by frequency among all; here all
    tokens of these few sets are counted. Those that only one component has can't link two, and come first, then the rarer ones. So a token that
    very many unlike sets have, a notice say, is in the first fifth of those alone that have little else."""

    def listed(batches):
        for batch in batches:
            sets = [np.frombuffer(t, np.int64) for t in batch["toks"]]
            yield pd.DataFrame({"node": batch["node"], "n": [len(x) for x in sets], "toks": sets})

    rooted = members.mapInPandas(listed, "node long, n long, toks array<long>").join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    entries = rooted.select("node", "root", "n", F.explode("toks").alias("h"))
    counted = entries.groupBy("h").agg(F.count("*").alias("df"), F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("h", "df")
    own = Window.partitionBy("node")
    ranked = entries.join(materialize_narrow(counted, "shared-tokens"), "h").withColumn("k", F.row_number().over(own.orderBy("df", "h"))).withColumn("of", F.count("*").over(own))
    first = ranked.filter(F.col("n") - F.col("of") + F.col("k") <= F.col("n") - F.ceil(num * F.col("n") / den) + 1)
    by_node = materialize_narrow(first.select("h", "node"), "first-tokens")
    least = by_node.groupBy("h").agg(F.min("node").alias("block"), F.count("*").alias("k")).filter("k > 1").select("h", "block")
    return by_node.join(least, "h").select("block", "node").distinct()


def _beside(df: DataFrame, level: str, to: str) -> DataFrame:
    """Every row for its own level and the two that adjoin it, as column ``to``."""
    return df.withColumn(to, F.explode(F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda d: F.col(level) + d)))


def _cross_links(large: DataFrame, chunks: DataFrame, found: DataFrame, members: DataFrame, chunk: int, num: int, den: int) -> DataFrame:
    """Links between chunks of blocks that hold several components: every chunk meets the chunks of all classes
    outside the block's largest component that are of its level or adjoin it."""
    rooted = large.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    by_root = rooted.groupBy("block", "root").agg(F.count("*").alias("k"))
    main = by_root.groupBy("block").agg(F.max_by("root", F.struct("k", "root")).alias("main"), F.count("*").alias("roots")).filter("roots > 1").select("block", "main")
    here = materialize_narrow(rooted.join(main, "block").select("block", "level", F.col("chunk").alias("i"), "root", "node", "main"), "open-chunks")
    sizes = here.filter("root != main").groupBy("block", F.col("level").alias("level2")).agg(F.ceil(F.count("*") / chunk).cast("int").alias("minor_chunks"))
    left = _beside(here, "level", "level2").join(sizes, ["block", "level2"]).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("minor_chunks") - 1)))
    minor = here.filter("root != main").withColumnRenamed("level", "level2").drop("i").join(sizes, ["block", "level2"]).withColumn("j", F.pmod(F.xxhash64("node", F.lit(5)), "minor_chunks").cast("int"))
    right = _beside(minor, "level2", "level").join(chunks.select("block", "level", F.col("chunk").alias("i")), ["block", "level"])
    shown = lambda df, side: df.select(*ACROSS, F.lit(side).alias("side"), "root", "node")
    rows = shown(left, 0).unionByName(shown(right, 1)).join(members, "node").select(*ACROSS, "side", "root", "node", "toks")
    return materialize_narrow(rows.repartition(*ACROSS).sortWithinPartitions(*ACROSS).mapInPandas(_across(num, den), "a long, b long").distinct(), "links")


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near duplicates the document with the smallest id, with its columns.

    A null id comes after all others; rows that repeat an id and a text are one document, and of rows that repeat an id alone the one with the
    smaller hash of its text stays. Documents without words are linked with nothing and stay.
    """
    told = _rows(docs).groupBy("root", "doc_id", "mark").agg(F.count("*").alias("n"))
    first = told.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark", "n")).alias("x")).select("x.*")
    picked = materialize_narrow(first.select(_row_key(F.col("doc_id"), F.col("mark")).alias("key"), "n"), "kept-documents")
    rows = packed(docs).select("row", _row_key(F.col("row.doc_id"), _mark(F.col("row.text"))).alias("key"))
    once = rows.join(picked.filter("n = 1").select("key").hint("shuffle_hash"), "key", "left_semi").select("row.*")
    # rows that repeat: few as a rule, so that this join's other side is sent round and no text moves
    more = picked.filter("n > 1").select("key").distinct()
    repeated = rows.join(more, "key", "left_semi").groupBy("key").agg(F.first("row").alias("row")).select("row.*")
    return once.unionByName(repeated)


def _row_key(doc_id: Column, mark: Column) -> Column:
    return F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("null")), mark.cast("string"))
