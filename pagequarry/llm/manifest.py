"""Merkle manifest of a documents table, its proofs and their check (operator 13).

Every row is a leaf: H of its fields doc_id, source, lang, n_chars and text,
each written ``-`` when null, else as its UTF-8 byte count, ``:`` and its
value (integers in decimal); H is the lowercase hex SHA-256 of its inputs
joined, digests taken as hex text. Within a language (null first, then by
UTF-8 bytes) leaves ascend by doc_id (null first; equal ids by leaf). While
more than one node remains, each run of ``FANOUT`` consecutive nodes, the last
run shorter, even a single node, becomes the H of its members; the node that
remains is the language's subroot, a lone leaf being its own. The subroots in
language order give the root the same way.

Each level is one grouped aggregate: a node's slot in its run is its position
modulo the fan-out, and conditional aggregates spread the run's members into
``FANOUT`` columns. Joining the columns gives the parent's H; joining all but
the node's own column gives its siblings, those left and those right of it.
Going down again, each node receives its parent's chain of (left, right)
siblings up to the root and prepends its own. A leaf's proof is the H of all
siblings, level by level from the leaf up, left to right; ``folded_root`` folds
a leaf up the chain again, and ``verified`` says whether that reaches the root.

Positions come from a range-partitioned sort written once, whose partitions
are counted per language, so a language with a third of all rows is cut into
many tasks. Every level is written to the shared folder, and no text is
shuffled: only digests, ids and positions travel.

Null fields are written ``-``; a null language is a language of its own;
repeated rows are leaves each; an empty table gives no row. Extra columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagequarry.session import materialise

FANOUT = 8
# More trees (languages) or partitions than this are joined by shuffle, not broadcast.
MAX_BROADCAST_ROWS = 1_000_000
UP = "array<struct<left:string,right:string>>"
_ROW_BITS = (1 << 33) - 1


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count of the value's text, ``:`` and the text."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(field(doc_id), field(source), field(lang), field(n_chars), field(text)), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tampered_where_crc_divisible(doc_id: Column, text: Column, divisor: int = 3) -> Column:
    """``text`` with A-Z lower-cased where ``divisor`` divides crc32 of the decimal doc_id; nulls stay."""
    hit = F.crc32(doc_id.cast("string")) % divisor == 0
    return F.when(hit, lower_ascii(text)).otherwise(text)


def tree_key(value: Column) -> Column:
    """A never-null text ordered as ``value`` with null first, bytewise after."""
    return F.when(value.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), value))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= MAX_BROADCAST_ROWS else df


def _positions(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` (with ``tree``) numbered from 0 within their tree in ``order``, with the tree's size ``n``."""
    keys = [F.col("tree").asc(), *order]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    written = (
        materialise(placed, "manifest-placed")
        .withColumn("_part", F.shiftright("_at", 33))
        .withColumn("_row", F.col("_at").bitwiseAND(F.lit(_ROW_BITS)))
    )
    pieces = written.groupBy("_part", "tree").agg(F.min("_row").alias("_first"), F.count("*").alias("_size"))
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(
        "_part",
        "tree",
        "_first",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"),
        F.sum("_size").over(Window.partitionBy("tree")).alias("n"),
    )
    return written.join(_small(starts), ["_part", "tree"]).select(
        *rows.columns, (F.col("_start") + F.col("_row") - F.col("_first")).alias("pos"), "n"
    )


def _levels(nodes: DataFrame) -> list[tuple[int, DataFrame]]:
    """Runs of ``FANOUT`` nodes grouped into parents, level by level; ``width`` is the leaves a node of the level stands for."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels = []
    current, width = nodes, 1
    while most > width:
        slot = F.col("pos") % FANOUT
        spread = [F.max(F.when(slot == k, F.col("hash"))).alias(f"c{k}") for k in range(FANOUT)]
        if width == 1:
            spread += [F.max(F.when(slot == k, F.col("what"))).alias(f"w{k}") for k in range(FANOUT)]
        grouped = (
            current.where(F.col("n") > width)
            .groupBy("tree", F.expr(f"pos div {FANOUT}").alias("pos"), "n")
            .agg(*spread)
            .withColumn("hash", F.sha2(F.concat_ws("", *(F.col(f"c{k}") for k in range(FANOUT))), 256))
        )
        grouped = materialise(grouped, "manifest-level")
        levels.append((width, grouped))
        current, width = grouped.select("tree", "pos", "n", "hash"), width * FANOUT
    return levels


def _tops(nodes: DataFrame, levels: list[tuple[int, DataFrame]]) -> DataFrame:
    """(tree, hash) of the node each tree ends in."""
    tops = nodes.where(F.col("n") == 1).select("tree", "hash")
    for width, grouped in levels:
        tops = tops.unionByName(grouped.where(F.col("n") <= width * FANOUT).select("tree", "hash"))
    return tops


def _chains(nodes: DataFrame, levels: list[tuple[int, DataFrame]]) -> DataFrame:
    """(tree, what, up): every leaf with its siblings, (left, right) per level from the leaf up."""
    columns = [F.col(f"c{k}") for k in range(FANOUT)]
    up = None
    for width, grouped in reversed(levels):
        if up is None:
            grouped = grouped.withColumn("up", F.lit(None).cast(UP))
        else:
            grouped = grouped.join(up.select("tree", "pos", "up"), ["tree", "pos"], "left")
        slots = F.array(
            *(
                F.struct(
                    F.lit(k).alias("k"),
                    columns[k].alias("hash"),
                    F.concat_ws("", *columns[:k]).alias("left"),
                    F.concat_ws("", *columns[k + 1 :]).alias("right"),
                    (F.col(f"w{k}") if width == 1 else F.lit(None)).alias("what"),
                )
                for k in range(FANOUT)
            )
        )
        up = grouped.select(
            "tree",
            "pos",
            F.coalesce("up", F.array().cast(UP)).alias("above"),
            F.explode(F.filter(slots, lambda s: s["hash"].isNotNull())).alias("s"),
        ).select(
            "tree",
            (F.col("pos") * FANOUT + F.col("s.k")).alias("pos"),
            F.concat(F.array(F.struct(F.col("s.left").alias("left"), F.col("s.right").alias("right"))), "above").alias("up"),
            F.col("s.what").alias("what"),
        )
    alone = nodes.where(F.col("n") == 1).select("tree", "pos", F.array().cast(UP).alias("up"), "what")
    return alone if up is None else up.unionByName(alone)


def manifest(
    documents: DataFrame,
    tampered: Column | None = None,
    doc_id: str = "doc_id",
    source: str = "source",
    lang: str = "lang",
    n_chars: str = "n_chars",
    text: str = "text",
) -> DataFrame:
    """Per row: doc_id, lang, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``tampered`` is the text checked against the manifest (default: A-Z
    lower-cased where 3 divides crc32 of the decimal doc_id); leaf, subroot,
    root and proof are those of the rows as given.
    """
    if tampered is None:
        tampered = tampered_where_crc_divisible(F.col(doc_id), F.col(text))
    fields = [F.col(doc_id), F.col(source), F.col(lang), F.col(n_chars)]
    rows = documents.select(
        tree_key(F.col(lang)).alias("tree"),
        F.col(doc_id).alias("doc_id"),
        F.col(lang).alias("lang"),
        leaf(*fields, F.col(text)).alias("hash"),
        leaf(*fields, tampered).alias("changed"),
    )
    rows = rows.select("tree", "doc_id", "hash", F.struct("doc_id", "lang", F.col("hash").alias("leaf"), "changed").alias("what"))
    leaves = _positions(rows, F.col("doc_id").asc_nulls_first(), F.col("hash").asc())
    levels = _levels(leaves)
    chains = _chains(leaves, levels)
    subroots = materialise(_tops(leaves, levels), "manifest-subroots")

    # The subroots, in language order, are the leaves of the top tree.
    top_nodes = _positions(subroots.select(F.lit("").alias("tree"), "hash", F.col("tree").alias("what")), F.col("what").asc())
    top_levels = _levels(top_nodes)
    top_chains = _chains(top_nodes, top_levels)
    root = _tops(top_nodes, top_levels).select("tree", F.col("hash").alias("root"))
    languages = (
        top_chains.join(root, "tree")
        .select(F.col("what").alias("tree"), F.col("up").alias("up_top"), "root")
        .join(subroots.withColumnRenamed("hash", "subroot"), "tree")
    )

    proven = chains.join(_small(languages), "tree").withColumn("path", F.concat("up", "up_top"))
    proof = F.aggregate("path", F.lit(""), lambda acc, x: F.concat(acc, x["left"], x["right"]))
    folded = F.aggregate("path", F.col("what.changed"), lambda acc, x: F.sha2(F.concat(x["left"], acc, x["right"]), 256))
    return proven.select(
        F.col("what.doc_id").alias("doc_id"),
        F.col("what.lang").alias("lang"),
        F.col("what.leaf").alias("leaf"),
        "subroot",
        "root",
        F.sha2(proof, 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
