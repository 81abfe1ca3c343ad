"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the distinct words, word pairs and pairs with one or two
words between them, hashed to BUCKETS. Every shard of the learning rows runs
FTRL-proximal (per-coordinate rates, L1) from the common state; the changes of
a coordinate are averaged over the shards that met it, by a grouped sum, and the
next round goes on from there. L1 leaves few weights that are not 0, so the
model that scoring tasks receive is a short list of bucket and weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.llm import tokens
from pagequarry.session import materialise

BUCKETS = 1 << 20
# Places of the words of a feature: word, pair, skip-grams.
FEATURES = ((0,), (0, 1), (0, 2), (0, 3))
# The classifier is fitted on about so many labelled rows, chosen by a hash of their id.
MAX_LEARNING_ROWS = 30_000
SHARDS = 4
ROUNDS = 6
ALPHA, BETA, L1, L2 = 2.0, 1.0, 2.0, 0.0
# A feature is taken in when it has so many learning rows and its share of toxic ones is no chance (chi-square).
MIN_ROWS = 5
MIN_CHI_SQUARE = 10.0
TOXIC_FROM = 0.7


class ToxicityModel(NamedTuple):
    """Buckets with a weight other than 0, in order; the bias is the bucket BUCKETS."""

    buckets: np.ndarray
    weights: np.ndarray


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def _features(part: tokens.Slice) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets and row offsets, for each kind of feature."""
    found = tokens.words(part, tokens.NO_LETTERS, fold=True)
    for places in FEATURES:
        hashes, _, offsets = tokens.ngrams(found, places)
        yield (hashes >> np.uint64(44)).astype(np.int64), offsets


def _row_features(part: tokens.Slice) -> list[np.ndarray]:
    kinds = list(_features(part))
    return [
        np.unique(np.concatenate([buckets[offsets[row]:offsets[row + 1]] for buckets, offsets in kinds]))
        for row in range(len(part.offsets) - 1)
    ]


def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """FTRL-proximal weights of coordinates with gradient sums ``z`` and squared sums ``n``."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def _row_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        toxic = batch.column("toxic").to_pylist()
        for part in tokens.slices(batch.column("text")):
            for row, buckets in enumerate(_row_features(part)):
                totals[0, buckets] += 1
                totals[1, buckets] += toxic[part.first + row]
    used = np.flatnonzero(totals[0])
    yield pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.array(totals[0][used], pa.int32()), pa.array(totals[1][used], pa.int32())],
        names=["bucket", "n", "n_toxic"],
    )


def _featured(batches: Iterator[pa.RecordBatch], taken: np.ndarray) -> Iterator[pa.RecordBatch]:
    chosen = np.zeros(BUCKETS + 1, bool)
    chosen[taken] = True
    for batch in batches:
        for part in tokens.slices(batch.column("text")):
            rows = [buckets[chosen[buckets]] for buckets in _row_features(part)]
            offsets = np.concatenate([[0], np.cumsum([len(row) for row in rows])])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("toxic").slice(part.first, len(rows)),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(rows), pa.int32())),
                ],
                names=["toxic", "buckets"],
            )


class _State(NamedTuple):
    """Gradient sums ``z`` and squared sums ``n`` of the coordinates taken in; the last one is the bias."""

    buckets: np.ndarray
    z: np.ndarray
    n: np.ndarray


def _trained(batches: Iterator[pa.RecordBatch], state: _State) -> Iterator[pa.RecordBatch]:
    z, n = state.z.copy(), state.n.copy()
    place = np.full(BUCKETS + 1, -1)
    place[state.buckets] = np.arange(len(state.buckets))
    for batch in batches:
        for toxic, buckets in zip(batch.column("toxic").to_pylist(), batch.column("buckets")):
            at = place[buckets.values.to_numpy()]
            at = np.append(at[at >= 0], len(z) - 1)
            own = weights_of(z[at], n[at])
            slope = 1 / (1 + np.exp(-np.clip(own.sum(), -35, 35))) - toxic
            grown = n[at] + slope * slope
            z[at] += slope - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * own
            n[at] = grown
    changed = np.flatnonzero(n != state.n)
    yield pa.RecordBatch.from_arrays(
        [pa.array(changed, pa.int32()), pa.array(z[changed] - state.z[changed]), pa.array(n[changed] - state.n[changed])],
        names=["place", "z", "n"],
    )


def learn(documents: DataFrame, labels: DataFrame, learning: Column | None = None) -> ToxicityModel:
    """A model of ``labels`` (doc_id, toxic) over the texts of ``documents`` (doc_id, text).

    Only ids where ``learning`` (over doc_id) holds are used, about
    MAX_LEARNING_ROWS of them at most. The driver holds the state of at most
    BUCKETS + 1 coordinates. Null labels and texts are left out; an id labelled
    twice counts as toxic when any label says so. Without labelled texts every
    score is 0.5.
    """
    known = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .filter(F.lit(True) if learning is None else learning)
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    share = min(1.0, MAX_LEARNING_ROWS / max(1, known.count()))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20))))
    # About MAX_LEARNING_ROWS ids and labels, whatever the size of the corpus.
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).filter(
        "text IS NOT NULL"
    ).join(F.broadcast(chosen), "doc_id")
    dealt = rows.repartition(SHARDS, F.xxhash64("doc_id")).sortWithinPartitions(F.hash("doc_id")).select("text", "toxic")
    chosen_rows = materialise(dealt, "toxicity-rows")
    n_rows, n_toxic = chosen_rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    rate = n_toxic / max(1, n_rows)
    off = F.col("n_toxic") - F.col("n") * rate
    chance = F.col("n") * (rate * (1 - rate)) * (1 - F.col("n") / max(1, n_rows)) + 1e-9
    taken = (
        chosen_rows.coalesce(SHARDS).mapInArrow(_row_counts, "bucket int, n int, n_toxic int")
        .groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic"))
        .filter((F.col("n") >= MIN_ROWS) & (off * off >= chance * MIN_CHI_SQUARE)).select("bucket").toArrow()
    )
    buckets = np.append(np.sort(taken.column("bucket").to_numpy()), BUCKETS).astype(np.int64)
    inside = documents.sparkSession.sparkContext.broadcast(buckets)
    sample = materialise(
        chosen_rows.mapInArrow(lambda batches: _featured(batches, inside.value), "toxic int, buckets array<int>"), "toxicity-features"
    )
    state = _State(buckets, np.zeros(len(buckets)), np.zeros(len(buckets)))
    for _ in range(ROUNDS):
        shared = documents.sparkSession.sparkContext.broadcast(state)
        merged = (
            sample.coalesce(SHARDS).mapInArrow(lambda batches, s=shared: _trained(batches, s.value), "place int, z double, n double")
            .groupBy("place").agg(F.avg("z").alias("z"), F.avg("n").alias("n")).toArrow()
        )
        at = merged.column("place").to_numpy()
        z, n = state.z.copy(), state.n.copy()
        z[at] += merged.column("z").to_numpy()
        n[at] += merged.column("n").to_numpy()
        state = _State(buckets, z, n)
    weights = weights_of(state.z, state.n)
    return ToxicityModel(buckets[weights != 0], weights[weights != 0])


def _scores(part: tokens.Slice, table: np.ndarray) -> np.ndarray:
    rows = len(part.offsets) - 1
    at, of = [], []
    for buckets, offsets in _features(part):
        hit = np.flatnonzero(table[buckets])
        at.append(buckets[hit])
        of.append(np.searchsorted(offsets, hit, "right") - 1)
    # Each bucket counts once in a row.
    keys = np.unique(np.concatenate(of) * (BUCKETS + 1) + np.concatenate(at))
    sums = np.bincount(keys // (BUCKETS + 1), table[keys % (BUCKETS + 1)], minlength=rows)
    return 1 / (1 + np.exp(-np.clip(sums + table[BUCKETS], -35, 35)))


def score(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``documents`` (doc_id, text), whole texts.

    ``predicted`` is 1 from a score of 0.7 on. A null or empty text, or one
    without a word, gets the score of the bias alone. Repeated rows score
    alike; other columns are not read.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(BUCKETS + 1)
        table[shared.value.buckets] = shared.value.weights
        for batch in batches:
            for part in tokens.slices(batch.column("text")):
                found = _scores(part, table)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(name).slice(part.first, len(found)) for name in ("doc_id", "held_out")),
                        pa.array(found), pa.array(found >= TOXIC_FROM).cast(pa.int32()),
                    ],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(scored, "doc_id bigint, held_out boolean, score double, predicted int")
