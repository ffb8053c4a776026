"""Operator 12: a Merkle manifest of a table of documents, with proofs.

Bottom-up build: leaves are ranked within their language and dealt in blocks of 64 neighbours; a block hashes its own subtree of up to six
binary levels and is written with it, and its top is a leaf of the next table, until one block holds a language's root. The languages' subroots
are built up to the root in the same way. Top-down push: the written tables are joined children to parents from the root on; each child
prepends its siblings, those of the levels in its block, to the proof that its parent hands down. So a proof is exchanged once a block, never once a document.

Ranks don't need a language in one task: rows are dealt by ranges of (lang, doc_id, leaf, row number), numbered as they lie sorted, and the counts
of each range and language, a few rows, give what stands before.

A null is hashed as ``-``. A null doc_id comes before all others and isn't tampered with; null is a language of its own. Equal ids of a language are
ordered by their leaves; repeated rows have equal leaves and each its own place and proof. An empty table gives no rows and no root. Columns other than the five hashed
ones aren't read, so clashing names do no harm. Any integers are hashed exactly; adding 1 to the largest doesn't overflow.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import clean, fresh_path, materialize, materialize_narrow, table, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Binary levels of a block, and its leaves.
STRIDE = 6
WIDTH = 1 << STRIDE


def leaf_of(values: dict[str, Column] | None = None) -> Column:
    """Digest of a row; ``values`` stand in for columns."""
    said = [(values or {}).get(c, F.col(c)).cast("string") for c in FIELDS]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in said)), 256)


def ranked(df: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """``df``, a written table whose rows ``order`` tells apart, with pos, from 0, and n, the rows of the key (which may be null)."""
    lies = df.repartitionByRange(F.col(key), *order).sortWithinPartitions(key, *order)
    # the upper bits are the range's number, the lower ones count its rows
    lies = materialize(lies.withColumn("at", F.monotonically_increasing_id()), f"{name}-sorted")
    span = F.shiftright("at", 33)
    spans = materialize_narrow(lies.groupBy(span.alias("span"), F.col(key).alias("of")).agg(F.min("at").alias("first"), F.count("*").alias("rows")), f"{name}-spans")
    of_key = Window.partitionBy("of")
    spans = spans.select("span", "of", "first", F.coalesce(F.sum("rows").over(of_key.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"), F.sum("rows").over(of_key).alias("n"))
    return lies.join(spans, (span == F.col("span")) & F.col(key).eqNullSafe(F.col("of"))).select(*df.columns, (F.col("before") + F.col("at") - F.col("first")).alias("pos"), "n")


#: Levels of a block from its leaves' digests: each from the one before, pairs of neighbours, a last one alone.
_NEXT = "transform(sequence(0, cast((size(element_at(a, -1)) - 1) div 2 as int)), j -> sha2(concat(get(element_at(a, -1), 2 * j), coalesce(get(element_at(a, -1), 2 * j + 1), '')), 256))"
_LEVELS = f"aggregate(slice(array({', '.join(map(str, range(STRIDE)))}), 1, steps), array(transform(items, x -> x.h)), (a, t) -> concat(a, array({_NEXT})))"
#: Siblings of the child at ``i``, from its level up: 'l' or 'r' with the digest, or an empty text where it has none.
_SIBLINGS = f"""transform(slice(array({', '.join(map(str, range(STRIDE)))}), 1, size(levels) - 1), t -> case when shiftright(item.i, t) % 2 = 1 then concat('l', get(levels[t], shiftright(item.i, t) - 1))
 when shiftright(item.i, t) + 1 < size(levels[t]) then concat('r', get(levels[t], shiftright(item.i, t) + 1)) else '' end)"""
_FOLDED = "aggregate(proof, coalesce(claimed, h), (a, p) -> sha2(case left(p, 1) when 'l' then concat(substr(p, 2), a) when 'r' then concat(a, substr(p, 2)) else a end, 256))"


def _blocks(nodes: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(tree, block, n, items, levels, top) of nodes (tree, pos, n, h, ...): a row a block; at most ``WIDTH`` items each."""
    item = F.struct((F.col("pos") % WIDTH).cast("int").alias("i"), "h", *extra)
    grouped = nodes.groupBy("tree", F.floor(F.col("pos") / WIDTH).alias("block")).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(item)).alias("items"))
    steps = F.least(F.lit(STRIDE), F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0)).cast("int")
    return grouped.withColumn("steps", steps).withColumn("levels", F.expr(_LEVELS)).drop("steps").withColumn("top", F.expr("levels[size(levels) - 1][0]"))


def _build(nodes: DataFrame, out: str, name: str, extra: tuple[str, ...] = ()) -> list[DataFrame]:
    """Writes the tables of blocks of all trees in ``nodes``, lowest first."""
    made: list[DataFrame] = []
    while True:
        at = f"{out}/{name}-{len(made)}"
        rows = _blocks(nodes, () if made else extra)
        rows.write.parquet(at)
        made.append(nodes.sparkSession.read.schema(rows.schema).parquet(at))
        nodes = made[-1].filter(F.col("n") > WIDTH).select("tree", F.col("block").alias("pos"), F.ceil(F.col("n") / WIDTH).alias("n"), F.col("top").alias("h"))
        if nodes.isEmpty():
            return made


def _tops(tables: list[DataFrame]) -> DataFrame:
    """(tree, top) of all trees."""
    done = [t.filter(F.col("n") <= WIDTH).select("tree", "top") for t in tables]
    out = done[0]
    for t in done[1:]:
        out = out.unionByName(t)
    return out


@dataclass
class Manifest:
    """Written tables of blocks: of the leaves by language, and of the languages; ``root`` is null for an empty table."""

    leaves: list[DataFrame]
    langs: list[DataFrame]
    root: str | None


def write_manifest(docs: DataFrame, out: str, claimed: dict[str, Column] | None = None) -> Manifest:
    """Builds the trees below the folder ``out``. ``claimed``: columns as a holder of the rows claims them; the leaf of that, where it
    differs, is kept beside the true one, for :func:`proofs` to fold."""
    spark, first = docs.sparkSession, written()
    leaf = leaf_of()
    other = leaf_of(claimed) if claimed else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id"), F.col("lang").alias("tree"), leaf.alias("h"), other.alias("claimed")).withColumn("claimed", F.when(F.col("claimed") != F.col("h"), F.col("claimed")))
    rows = materialize(rows.withColumn("nr", F.monotonically_increasing_id()), "merkle-leaves")
    leaves = _build(ranked(rows, "tree", ["doc_id", "h", "nr"], "merkle"), out, "leaves", ("doc_id", "claimed"))
    tops = _tops(leaves).select(F.lit("").alias("all"), F.col("tree").alias("lang"), F.col("top").alias("h"))
    langs = _build(ranked(tops, "all", ["lang"], "merkle-langs").withColumnRenamed("all", "tree"), out, "langs", ("lang",))
    clean(spark, first)
    root = _tops(langs).first()
    return Manifest(leaves, langs, root and root.top)


def open_manifest(spark: SparkSession, out: str) -> Manifest:
    """A manifest written before."""

    def tables(name: str) -> list[DataFrame]:
        made = [spark.read.parquet(f"{out}/{name}-0")]
        while not made[-1].filter(F.col("n") > WIDTH).isEmpty():
            made.append(spark.read.parquet(f"{out}/{name}-{len(made)}"))
        return made

    leaves, langs = tables("leaves"), tables("langs")
    root = _tops(langs).first()
    return Manifest(leaves, langs, root and root.top)


def _pushed(tables: list[DataFrame], tops: DataFrame, extra: tuple[str, ...]) -> DataFrame:
    """(tree, h, proof, subroot, extra...) of the lowest table's items. ``tops``: (tree, proof, subroot) that each tree's own root inherits."""
    handed = None
    for k in reversed(range(len(tables))):
        own = tops.join(tables[k].filter(F.col("n") <= WIDTH).select(F.col("tree").alias("of"), "block"), F.col("tree").eqNullSafe(F.col("of"))).select("tree", "block", "proof", "subroot")
        handed = own if handed is None else handed.unionByName(own)
        blocks = tables[k].select(F.col("tree").alias("of"), F.col("block").alias("nr"), "items", "levels")
        children = handed.join(blocks, F.col("tree").eqNullSafe(F.col("of")) & (F.col("block") == F.col("nr")))
        children = children.select("tree", "nr", "proof", "subroot", "levels", F.explode("items").alias("item"))
        proof = F.concat(F.expr(_SIBLINGS), F.col("proof")).alias("proof")
        if k:
            handed = children.select("tree", (F.col("nr") * WIDTH + F.col("item.i")).alias("block"), proof, "subroot")
    return children.select("tree", "item.h", *(f"item.{c}" for c in extra), proof, "subroot")


def proofs(manifest: Manifest) -> DataFrame:
    """(doc_id, lang, leaf, claimed, subroot, root, proof, folded_root): a row a document. The proof is an array of the siblings on the way to the root, 'l' or 'r'
    telling their side, an empty text where a node has none; ``folded_root`` follows from it and the claimed leaf, or else the true one."""
    nothing = _tops(manifest.langs).select("tree", F.array().cast("array<string>").alias("proof"), F.lit("").alias("subroot"))
    subroots = _pushed(manifest.langs, nothing, ("lang",)).select(F.col("lang").alias("tree"), "proof", F.col("h").alias("subroot"))
    rows = _pushed(manifest.leaves, subroots, ("doc_id", "claimed"))
    return rows.select("doc_id", F.col("tree").alias("lang"), F.col("h").alias("leaf"), "claimed", "subroot", F.lit(manifest.root).cast("string").alias("root"), "proof", F.expr(_FOLDED).alias("folded_root"))


def tampered() -> dict[str, Column]:
    """n_chars, 1 larger where 7 divides the checksum of the id."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    exact = F.col("n_chars").cast("decimal(20,0)")
    return {"n_chars": F.when(hit, exact + 1).otherwise(exact)}


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves of all rows, their proofs, and which rows, some tampered with, still lead to the root."""
    rows = proofs(write_manifest(table(spark, sf_dir, "documents"), fresh_path(spark, "merkle"), tampered()))
    said = F.sha2(F.concat_ws("", F.transform("proof", lambda p: F.substring(p, 2, 64))), 256)
    return rows.select("doc_id", "leaf", "subroot", "root", said.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
