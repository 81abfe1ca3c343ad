"""Source divergence audit: how far each source's term distribution is from its language's and from the other sources' (operator 12).

Terms are runs of ASCII letters and non-ASCII characters; only A-Z are
lower-cased. Inside ``mapInArrow`` each Arrow batch is counted with Arrow
compute alone: ``ascii_lower``, ``split_pattern_regex`` on the runs between
terms, ``dictionary_encode`` of the terms and hash ``group_by``, first by
(row, term) for document frequencies, then by (lang, source, term). These
partial counts, and one row per (lang, source) group that marks it as
occurring, are merged by Spark's grouped sums.

Each language keeps the terms found in at least ``min_docs`` of its
documents (rows); V is their number. A group's (or the whole language's)
smoothed rate of a kept term is p = 1 + floor(scale * (count + 2) / (N + 2V)),
N the group's occurrences of kept terms, all in exact integers, and two rates
differ by f = floor((p - q)^2 / (p + q)).

Part ``pair``: for every other source of the language, f summed over all
kept terms (0 when V = 0). Each row of kept terms carries the sources where
the term occurs; in ``mapInArrow`` a chunk of terms becomes a dense integer
matrix of rates, absent sources at their p0, and f of all ordered pairs is
summed in numpy, per task, before Spark adds the tasks' sums. The work is
kept terms times sources squared per language; memory is bounded by
``PAIR_VALUES`` values per chunk.
Part ``term``: the kept terms present in the group whose p exceeds the
language's q, the ``top`` largest f. Ranks count from 1 per group and part,
larger values first, then items by their UTF-8 bytes.

Null text, lang or source count as ''. Every group that occurs has its pair
rows (none when its language has one source); a group without terms has no
term rows. Repeated rows count as often as they occur. Extra columns of the
input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagequarry.session import materialise

# The characters between terms: ASCII but letters.
BETWEEN_TERMS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS = 10
SCALE = 10**9
TOP = 10
# More (lang, source) groups than this are joined by shuffle, not broadcast.
MAX_BROADCAST_GROUPS = 1_000_000

# Partial counts a task holds before handing them on.
MERGED_ROWS = 1 << 20
# Terms whose rates against all pairs of sources are held in memory at once: terms x sources^2 values.
PAIR_VALUES = 1 << 22

PARTIAL = "lang string, source string, term string, occurrences long, docs long"


def _batch_counts(batch: pa.RecordBatch) -> pa.Table:
    lang, source = batch.column("lang"), batch.column("source")
    pieces = pc.split_pattern_regex(pc.ascii_lower(batch.column("text")), BETWEEN_TERMS)
    flat = pc.list_flatten(pieces)
    present = pc.not_equal(flat, "")
    terms = pc.filter(flat, present)
    rows = pc.filter(pc.list_parent_indices(pieces), present)
    coded = pc.dictionary_encode(terms)
    per_row = pa.table({"row": rows, "term": coded.indices}).group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")])
    per_group = (
        pa.table(
            {
                "lang": pc.take(lang, per_row["row"]),
                "source": pc.take(source, per_row["row"]),
                "term": per_row["term"],
                "n": per_row["count_all"],
            }
        )
        .group_by(["lang", "source", "term"], use_threads=False)
        .aggregate([("n", "sum"), ("n", "count")])
    )
    found = pa.table(
        {
            "lang": per_group["lang"],
            "source": per_group["source"],
            "term": pc.take(coded.dictionary, per_group["term"]),
            "occurrences": pc.cast(per_group["n_sum"], pa.int64()),
            "docs": pc.cast(per_group["n_count"], pa.int64()),
        }
    )
    # Every group of the batch occurs, terms or not.
    groups = pa.table({"lang": lang, "source": source}).group_by(["lang", "source"], use_threads=False).aggregate([([], "count_all")])
    marks = pa.table(
        {
            "lang": groups["lang"],
            "source": groups["source"],
            "term": pa.nulls(groups.num_rows, pa.string()),
            "occurrences": pa.array([0] * groups.num_rows, pa.int64()),
            "docs": pc.cast(groups["count_all"], pa.int64()),
        }
    )
    return pa.concat_tables([found, marks])


def _merged(tables: list[pa.Table]) -> pa.Table:
    merged = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False).aggregate(
        [("occurrences", "sum"), ("docs", "sum")]
    )
    return merged.rename_columns(["lang", "source", "term", "occurrences", "docs"]).select(["lang", "source", "term", "occurrences", "docs"])


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's batches, merged within the task while they stay below ``MERGED_ROWS``."""
    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        counted = _batch_counts(batch)
        held.append(counted)
        rows += counted.num_rows
        if rows > MERGED_ROWS:
            merged = _merged(held)
            held, rows = [merged], merged.num_rows
            if rows > MERGED_ROWS // 2:
                yield from merged.to_batches()
                held, rows = [], 0
    if held:
        yield from _merged(held).to_batches()


PAIR_SUMS = "lang string, source string, item string, visited long"


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """f summed over a batch's terms for every ordered pair of sources of their language, in exact integers."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        for lang in pc.unique(batch.column("lang")).to_pylist():
            rows = table.filter(pc.equal(table["lang"], lang))
            groups = rows["sources"][0].values
            names = groups.field("source")
            p0 = groups.field("p0").to_numpy(zero_copy_only=False).astype(np.int64)
            size = len(names)
            present = rows["present"].combine_chunks()
            offsets = present.offsets.to_numpy()
            entries = present.values
            where = pc.index_in(entries.field("source"), value_set=names).to_numpy(zero_copy_only=False).astype(np.int64)
            rates = entries.field("p").to_numpy(zero_copy_only=False).astype(np.int64)
            total = np.zeros((size, size), np.int64)
            step = max(1, PAIR_VALUES // (size * size))
            for first in range(0, len(rows), step):
                last = min(len(rows), first + step)
                dense = np.tile(p0, (last - first, 1))
                at = slice(offsets[first], offsets[last])
                dense[np.repeat(np.arange(last - first), np.diff(offsets[first : last + 1])), where[at]] = rates[at]
                p, q = dense[:, :, None], dense[:, None, :]
                total += ((p - q) * (p - q) // (p + q)).sum(axis=0)
            a, b = np.nonzero(~np.eye(size, dtype=bool))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(a), pa.string()), names.take(pa.array(a)), names.take(pa.array(b)), pa.array(total[a, b])],
                names=["lang", "source", "item", "visited"],
            )


def term_counts(documents: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Occurrences and documents of every (lang, source, term); term null for the group's own row."""
    rows = documents.select(
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(F.col(lang), F.lit("")).alias("lang"),
        F.coalesce(F.col(source), F.lit("")).alias("source"),
    )
    return (
        rows.mapInArrow(_partial_counts, PARTIAL)
        .groupBy("lang", "source", "term")
        .agg(F.sum("occurrences").alias("count"), F.sum("docs").alias("docs"))
    )


def _rate(count, total, kept):
    """p = 1 + floor(scale * (count + 2) / (N + 2V)) in exact long arithmetic."""
    return F.lit(1) + F.expr(f"({SCALE} * ({count} + 2)) div ({total} + 2 * {kept})")


def _difference(p, q):
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div (({p}) + ({q}))")


def _small(df: DataFrame, bound: int) -> DataFrame:
    """``df`` marked for broadcast when its counted rows stay within ``bound``."""
    return F.broadcast(df) if df.count() <= bound else df


def divergences(
    documents: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_docs: int = MIN_DOCS,
    top: int = TOP,
) -> DataFrame:
    """Rows (lang, source, part, item, value long, rank int) as the module describes."""
    counts = materialise(term_counts(documents, text, lang, source), "audit-counts")
    groups = counts.filter(F.col("term").isNull()).select("lang", "source")
    present = counts.filter(F.col("term").isNotNull())
    by_language = present.groupBy("lang", "term").agg(F.sum("count").alias("lang_count"), F.sum("docs").alias("lang_docs"))
    kept = materialise(by_language.filter(F.col("lang_docs") >= min_docs).drop("lang_docs"), "audit-kept")
    languages = _small(kept.groupBy("lang").agg(F.count("*").alias("V"), F.sum("lang_count").alias("lang_total")), MAX_BROADCAST_GROUPS)
    entries = present.join(kept.select("lang", "term"), ["lang", "term"])
    totals = entries.groupBy("lang", "source").agg(F.sum("count").alias("N"))
    group_rates = materialise(
        groups.join(languages, "lang", "left")
        .join(totals, ["lang", "source"], "left")
        .select(
            "lang",
            "source",
            F.coalesce("V", F.lit(0)).alias("V"),
            F.coalesce("N", F.lit(0)).alias("N"),
        )
        .withColumn("p0", F.when(F.col("V") > 0, _rate("0", "N", "V"))),
        "audit-groups",
    )
    small_groups = _small(group_rates, MAX_BROADCAST_GROUPS)
    rates = entries.join(small_groups.select("lang", "source", "N", "V"), ["lang", "source"]).select(
        "lang", "source", "term", _rate("`count`", "N", "V").alias("p")
    )
    language_rates = kept.join(languages, "lang").select(
        "lang", "term", _rate("lang_count", "lang_total", "V").alias("q")
    )
    # One row per (lang, term): the sources where it occurs with their rates, and the language's rate.
    by_term = materialise(
        rates.groupBy("lang", "term")
        .agg(F.collect_list(F.struct("source", "p")).alias("present"))
        .join(language_rates, ["lang", "term"]),
        "audit-terms",
    )

    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    term_part = (
        by_term.select("lang", "term", "q", F.explode("present").alias("x"))
        .where(F.col("x.p") > F.col("q"))
        .select(
            "lang",
            F.col("x.source").alias("source"),
            F.lit("term").alias("part"),
            F.col("term").alias("item"),
            _difference("x.p", "q").alias("value"),
        )
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= top)
    )

    # Pair part: every term against all ordered pairs of the language's sources, absent ones at their p0.
    sources = small_groups.groupBy("lang").agg(F.collect_list(F.struct("source", "p0")).alias("sources"))
    visited = by_term.join(_small(sources, MAX_BROADCAST_GROUPS), "lang").select("lang", "present", "sources")
    sums = visited.mapInArrow(_pair_sums, PAIR_SUMS).groupBy("lang", "source", "item").agg(F.sum("visited").alias("visited"))
    a = group_rates.alias("a")
    b = group_rates.select("lang", F.col("source").alias("item"), F.col("p0").alias("other_p0"))
    pairs = (
        a.join(_small(b, MAX_BROADCAST_GROUPS), "lang")
        .where(F.col("source") != F.col("item"))
        .join(sums, ["lang", "source", "item"], "left")
        .select(
            "lang",
            "source",
            F.lit("pair").alias("part"),
            "item",
            F.when(F.col("V") == 0, F.lit(0)).otherwise(F.coalesce("visited", F.lit(0))).cast("long")
            .alias("value"),
        )
        .withColumn("rank", F.row_number().over(ranked))
    )
    return pairs.unionByName(term_part.select(*pairs.columns)).withColumn("rank", F.col("rank").cast("int"))
