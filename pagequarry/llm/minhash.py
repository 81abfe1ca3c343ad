"""Near duplicates by min-max hashing of word shingles, confirmed on full sets.

A text's set holds its distinct shingles of five words (A-Z lower-cased); a
shorter text is one shingle. Every permutation of the shingle hashes yields two
signature values, the minimum and the maximum, so 128 values cost 64 hash
evaluations. Thirty-two bands of four values find candidates: a pair of
similarity 0.75 shares none of them with probability (1 - 0.75^4)^32 < 1e-5.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagequarry.llm import tokens
from pagequarry.llm.components import components
from pagequarry.llm.membership import possible_keys
from pagequarry.session import materialise

SHINGLE_WORDS = 5
BANDS = 32
PERMUTATIONS_PER_BAND = 2
# How often the members of a bucket meet one of them before components meet each other.
STAR_ROUNDS = 1
# Least similarity of a link, as percent of the union.
LINK_PERCENT = 75
# Sizes of sets are compared by steps of this ratio.
SIZE_STEP = 1.03
# What is kept of a member of a bucket beside a shingle.
MEMBER = ("id", "size", "component", "rest")

_random = np.random.default_rng(71)
_FACTORS = _random.integers(1, 1 << 63, BANDS * PERMUTATIONS_PER_BAND, dtype=np.uint64) | np.uint64(1)
_SHIFTS = _random.integers(1, 1 << 63, BANDS * PERMUTATIONS_PER_BAND, dtype=np.uint64)
_BAND_KEYS = _random.integers(1, 1 << 63, BANDS, dtype=np.uint64)
_SET_KEYS = _random.integers(1, 1 << 63, 2, dtype=np.uint64)


def shingle_sets(part: tokens.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted within the row, and the rows' offsets."""
    found = tokens.words(part, fold=True)
    hashes, _, offsets = tokens.ngrams(found, tuple(range(SHINGLE_WORDS)))
    lengths = np.diff(found.rows)
    sets = []
    for row, length in enumerate(lengths):
        if length >= SHINGLE_WORDS:
            values = np.sort(hashes[offsets[row]:offsets[row + 1]])
            sets.append(values[np.concatenate([[True], values[1:] != values[:-1]])])
        elif length:
            own = found.hashes[found.rows[row]:found.rows[row + 1]]
            whole = (own * tokens.PLACES[:length]).sum(dtype=np.uint64, keepdims=True)
            sets.append(tokens.mix(whole + np.uint64(length)))
        else:
            sets.append(hashes[:0])
    return np.concatenate(sets) if sets else hashes[:0], np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tokens.slices(batch.column("text")):
            values, offsets = shingle_sets(part)
            rows = len(offsets) - 1
            sums = [tokens.row_sums(tokens.mix(values ^ key), offsets) for key in _SET_KEYS]
            bands = np.zeros((rows, BANDS), np.uint64)
            for band in range(BANDS):
                key = np.full(rows, _BAND_KEYS[band], np.uint64)
                for at in range(PERMUTATIONS_PER_BAND * band, PERMUTATIONS_PER_BAND * (band + 1)):
                    permuted = values * _FACTORS[at] + _SHIFTS[at]
                    for ends in (tokens.row_least(permuted, offsets), tokens.row_greatest(permuted, offsets)):
                        key = tokens.mix(key * tokens.PLACES[0] + ends)
                bands[:, band] = key
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(part.first, rows),
                    tokens.as_longs(np.diff(offsets)),
                    tokens.as_longs(sums[0]),
                    tokens.as_longs(sums[1]),
                    pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * BANDS, pa.int32()), tokens.as_longs(bands.reshape(-1))),
                ],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands"],
            )


def sketches(documents: DataFrame) -> DataFrame:
    """``doc_id, n_shingles``, a 128-bit digest of the whole set, and the band keys of each row."""
    return documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        _sketches, "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>"
    )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tokens.slices(batch.column("text")):
            values, offsets = shingle_sets(part)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(part.first, len(offsets) - 1),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), tokens.as_longs(values)),
                ],
                names=["id", "members"],
            )


def candidate_sets(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """``id, members``: the full shingle sets of the rows whose doc_id is in ``ids`` (id)."""
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    near = possible_keys(texts, "doc_id", ids.select(F.col("id").alias("doc_id")))
    return near.mapInArrow(_sets, "id bigint, members array<bigint>").join(ids, "id", "left_semi")


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shared = np.zeros(batch.num_rows, np.int64)
        total = np.zeros(batch.num_rows, np.int64)
        for row, (left, right) in enumerate(zip(batch.column("set_a"), batch.column("set_b"))):
            x, y = left.values.to_numpy(), right.values.to_numpy()
            shared[row] = len(np.intersect1d(x, y, assume_unique=True))
            total[row] = len(x) + len(y) - shared[row]
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(shared), pa.array(total)], names=["a", "b", "shared", "total"]
        )


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, shared, total``: sizes of intersection and union of the full sets of each pair."""
    both = (
        pairs.join(sets.select(F.col("id").alias("a"), F.col("members").alias("set_a")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("members").alias("set_b")), "b")
    )
    return both.select("a", "b", "set_a", "set_b").mapInArrow(_overlaps, "a bigint, b bigint, shared bigint, total bigint")


def links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of which 100 * intersection >= 75 * union."""
    found = overlaps(pairs, sets).filter(F.col("shared") * 100 >= F.col("total") * LINK_PERCENT)
    return materialise(found.select("a", "b"), "links")


def _mixed(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets that still hold several components."""
    labelled = buckets.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep")
    )
    several = labelled.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
    return materialise(labelled.join(several.select("band"), "band", "left_semi"), "mixed-buckets")


def _rarest_first(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``id, size, component, shingle, rest``: the rare shingles of each member that may start a link.

    A member's shingles are ordered by how many members have them (those that
    one component alone has come first, equal counts by hash), alike for all.
    ``rest`` counts a shingle and what follows it; a link has at least 75
    percent of the member's set from its first shared shingle on.
    """
    labels = members.select(F.col("rep").alias("id"), "component").distinct()
    shingles = sets.join(labels, "id").select("id", "component", F.size("members").alias("size"), F.explode("members").alias("shingle"))
    spread = shingles.groupBy("shingle").agg(
        F.when(F.min("component") < F.max("component"), F.count("*")).otherwise(0).alias("held")
    )
    ordered = (
        shingles.join(spread, "shingle")
        .groupBy("id")
        .agg(F.first("component").alias("component"), F.first("size").alias("size"), F.sort_array(F.collect_list(F.struct("held", "shingle"))).alias("held"))
    )
    # As many leading shingles as leave 75 percent of the set from the last of them on.
    leading = F.expr(f"slice(held, 1, cast(size - ceil(size * {LINK_PERCENT} / 100) + 1 as int))")
    return (
        ordered.select("id", "component", "size", F.posexplode(leading).alias("place", "found"))
        .filter("found.held > 0")
        .select("id", "component", "size", F.col("found.shingle").alias("shingle"), (F.col("size") - F.col("place")).alias("rest"))
    )


def _size_step(size: str) -> Column:
    return F.floor(F.log(F.expr(size)) / math.log(SIZE_STEP))


def _across(mixed: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of bucket members in different components that may reach the least similarity.

    Members meet where they share one of their rarest shingles. A pair's first
    shared shingle bounds its intersection by what follows in either set, so a
    pair without a shingle that leaves enough behind it in both cannot link.
    The larger of two sets looks, by steps of size, only for sets small enough
    for what its shingle leaves; the smaller one needs 6/7 of its own behind it.
    """
    leading = materialise(_rarest_first(mixed, sets), "leading-shingles")
    smaller = leading.filter(F.col("rest") * (100 + LINK_PERCENT) >= F.col("size") * 2 * LINK_PERCENT)
    smaller = smaller.select("shingle", _size_step("size").alias("step"), *(F.col(c).alias(f"{c}_a") for c in MEMBER))
    # Sizes of a smaller set that can reach LINK_PERCENT with at most ``rest`` shingles shared.
    least = f"(size * {LINK_PERCENT} + 99) div 100"
    most = f"least(size, rest * {100 + LINK_PERCENT} div {LINK_PERCENT} - size)"
    larger = leading.filter(f"{least} <= {most}").select(
        "shingle", F.explode(F.sequence(_size_step(least), _size_step(most))).alias("step"), *(F.col(c).alias(f"{c}_b") for c in MEMBER)
    )
    # The commonest component of a meeting point does not meet itself there.
    meeting = (
        smaller.select("shingle", "step", F.col("component_a").alias("component"))
        .union(larger.select("shingle", "step", "component_b"))
        .groupBy("shingle", "step", "component").count()
        .groupBy("shingle", "step")
        .agg(F.max_by("component", F.struct("count", "component")).alias("main"), F.count("*").alias("several"))
        .filter("several > 1")
        .select("shingle", "step", "main")
    )
    smaller = smaller.join(meeting, ["shingle", "step"]).withColumn("in_main", F.col("component_a") == F.col("main")).drop("main")
    larger = larger.join(meeting, ["shingle", "step"]).withColumn(
        "in_main", F.explode(F.when(F.col("component_b") == F.col("main"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True))))
    ).drop("main")
    shared = F.least("rest_a", "rest_b")
    return (
        smaller.join(larger, ["shingle", "step", "in_main"])
        .filter(F.col("component_a") != F.col("component_b"))
        .filter((F.col("size_a") < F.col("size_b")) | ((F.col("size_a") == F.col("size_b")) & (F.col("id_a") < F.col("id_b"))))
        .filter(shared * 100 >= (F.col("size_a") + F.col("size_b") - shared) * LINK_PERCENT)
        .select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"))
        .distinct()
    )


def near_duplicates(documents: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``documents`` (doc_id, text).

    See :func:`judged`, which also gives each row's set digest.
    """
    return judged(documents).select("doc_id", "n_shingles", "component_id", "kept")


def judged(documents: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b, component_id, kept`` for every row of ``documents`` (doc_id, text).

    Rows with equal sets are one class, of which the smallest id takes part.
    Members of a band bucket meet its smallest id; where the bucket then still
    holds several components, they meet another member, STAR_ROUNDS times in
    all. What is left are members of different components, which meet where
    their rarest shingles allow a link.
    So no bucket is expanded to all of its pairs, and no link between members
    of different components is left out.

    A row without words, text or doc_id is linked with nothing (component_id is
    its doc_id; without one it is null and the row is kept). Rows that repeat a
    doc_id are judged each by its own text. Other columns are not read.
    """
    rows = materialise(sketches(documents), "sketches")
    whole_set = ["set_a", "set_b", "n_shingles"]
    classes = materialise(
        rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy(*whole_set)
        .agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")),
        "classes",
    )
    members = classes.select("rep", F.explode("bands").alias("band"), F.col("n_shingles").alias("size"))
    shared_bands = members.groupBy("band").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low <> high")
    buckets = materialise(members.join(shared_bands.select("band"), "band", "left_semi"), "buckets")
    sets = materialise(candidate_sets(documents, buckets.select(F.col("rep").alias("id")).distinct()), "candidate-sets")
    edges = labels = None
    mixed = buckets.withColumn("component", F.col("rep"))
    for turn in range(STAR_ROUNDS):
        order = F.col("rep") if turn == 0 else F.xxhash64("rep", F.lit(turn))
        centres = mixed.groupBy("band").agg(F.min_by(F.struct("rep", "component"), order).alias("centre"))
        pairs = (
            mixed.join(centres, "band").filter("component <> centre.component")
            .select(F.least("rep", "centre.rep").alias("a"), F.greatest("rep", "centre.rep").alias("b")).distinct()
        )
        found = links(pairs, sets)
        edges = found if edges is None else edges.union(found)
        labels = components(edges)
        mixed = _mixed(buckets, labels)
        if mixed.limit(1).count() == 0:
            break
    else:
        labels = components(edges.union(links(_across(mixed, sets), sets)))
    named = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        *whole_set, F.coalesce("component", "rep").alias("found")
    )
    return (
        rows.drop("bands")
        .join(named, whole_set, "left")
        .select(
            "doc_id",
            "n_shingles",
            "set_a",
            "set_b",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id")).alias("component_id"),
            (F.col("doc_id").isNull() | (F.col("doc_id") == F.coalesce("found", "doc_id"))).alias("kept"),
        )
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch with the size and 128-bit digest of every row's shingle set."""
    for batch in batches:
        sizes, firsts, seconds = [], [], []
        for part in tokens.slices(batch.column("text")):
            values, offsets = shingle_sets(part)
            sizes.append(tokens.as_longs(np.diff(offsets)))
            firsts.append(tokens.as_longs(tokens.row_sums(tokens.mix(values ^ _SET_KEYS[0]), offsets)))
            seconds.append(tokens.as_longs(tokens.row_sums(tokens.mix(values ^ _SET_KEYS[1]), offsets)))
        columns = [pa.concat_arrays(found) if found else pa.array([], pa.int64()) for found in (sizes, firsts, seconds)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *_DIGEST])


_DIGEST = ["_dedup_n", "_dedup_a", "_dedup_b"]


def deduplicated(documents: DataFrame) -> DataFrame:
    """One row of each group of near duplicates, with all its columns.

    The verdict goes by row: a row stays when its own text is kept by
    :func:`judged` (its doc_id is its component's), matched by doc_id and set
    digest together, so a unique text is never dropped because a copy shares
    its doc_id; of rows with the same doc_id and the same set one stays.
    Components are found over doc_ids, so two different texts under one
    doc_id are in one component: both stay, even when they are near each
    other. Rows without doc_id or without words are linked with nothing and
    all stay.
    """
    winners = (
        judged(documents)
        .where("kept AND n_shingles > 0 AND doc_id IS NOT NULL")
        .select(F.col("doc_id").alias("_dedup_id"), F.col("set_a").alias("_dedup_a"), F.col("set_b").alias("_dedup_b"))
        .distinct()
    )
    schema = T.StructType([*documents.schema.fields, *(T.StructField(name, T.LongType()) for name in _DIGEST)])
    digested = documents.mapInArrow(_digests, schema)
    alone = digested.where(F.col("doc_id").isNull() | (F.col("_dedup_n") == 0))
    grouped = digested.where(F.col("doc_id").isNotNull() & (F.col("_dedup_n") > 0))
    chosen = grouped.join(
        winners, (grouped["doc_id"] == winners["_dedup_id"]) & (grouped["_dedup_a"] == winners["_dedup_a"]) & (grouped["_dedup_b"] == winners["_dedup_b"]), "left_semi"
    ).dropDuplicates(["doc_id", "_dedup_a", "_dedup_b"])
    return chosen.unionByName(alone).drop(*_DIGEST)
