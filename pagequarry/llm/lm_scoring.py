"""Cross-entropy difference of two bigram models that share one vocabulary.

The target model is counted on the target texts, the background model on all
texts, both whole. The vocabulary is the VOCABULARY words most frequent in the
background; every other word is one unknown word, and a text begins with a
boundary. A word's probability after another interpolates bigram, unigram and
uniform shares with the same weights in both models, so their losses compare
word by word. What scoring needs is one loss difference per pair of vocabulary
words: a table whose size is fixed. So texts that differ only in unknown words
score alike; score_by_every_word() keeps every word, and its tables grow with
the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.llm import tokens
from pagequarry.session import materialise

VOCABULARY = 1022
UNKNOWN = VOCABULARY
BOUNDARY = VOCABULARY + 1
SIZE = VOCABULARY + 2
# Weights of bigram, unigram and uniform share; without a count for the context the first falls to the second.
BIGRAM, UNIGRAM, UNIFORM = 0.7, 0.25, 0.05
# Distinct words a counting task holds before it hands on what it has.
_HELD_WORDS = 1 << 18


class DifferenceModel(NamedTuple):
    """Sorted word hashes with their numbers, and target loss minus background loss by pair of numbers."""

    hashes: np.ndarray
    numbers: np.ndarray
    table: np.ndarray


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def summed() -> pa.RecordBatch:
        words = np.concatenate([w for w, _, _ in held]) if held else np.zeros(0, np.uint64)
        counts = np.concatenate([c for _, c, _ in held]) if held else np.zeros(0, np.int64)
        texts = np.concatenate([t for _, _, t in held]) if held else np.zeros(0, object)
        unique, first, inverse = np.unique(words, return_index=True, return_inverse=True)
        return pa.RecordBatch.from_arrays(
            [tokens.as_longs(unique), pa.array(texts[first], pa.string()), pa.array(np.bincount(inverse, counts, len(unique)).astype(np.int64))],
            names=["hash", "word", "n"],
        )

    for batch in batches:
        for part in tokens.slices(batch.column("text")):
            found = tokens.words(part, fold=True)
            unique, first, counts = np.unique(found.hashes, return_index=True, return_counts=True)
            raw = part.data.tobytes()
            texts = np.array([raw[found.begins[k]:found.ends[k]].decode("utf-8", "replace") for k in first], object)
            held.append((unique, counts, texts))
            size += len(unique)
            if size > _HELD_WORDS:
                yield summed()
                held, size = [], 0
    yield summed()


def vocabulary(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, in order, and numbers of the VOCABULARY most frequent words; equal counts go by the word."""
    top = (
        texts.select("text").mapInArrow(_word_counts, "hash bigint, word string, n bigint")
        .groupBy("hash").agg(F.sum("n").alias("n"), F.min(F.translate("word", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).alias("word"))
        .orderBy(F.desc("n"), "word").limit(VOCABULARY).collect()
    )
    hashes = np.array([r["hash"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], order


def _numbered(part: tokens.Slice, hashes: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pair index (context * SIZE + word) of every word, and the rows' offsets among them."""
    found = tokens.words(part, fold=True)
    if not len(found.hashes):
        return np.zeros(0, np.int64), found.rows
    word = np.full(len(found.hashes), UNKNOWN, np.int64)
    if len(hashes):
        place = np.minimum(np.searchsorted(hashes, found.hashes), len(hashes) - 1)
        known = hashes[place] == found.hashes
        word[known] = numbers[place[known]]
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[found.rows[:-1][np.diff(found.rows) > 0]] = BOUNDARY
    return context * SIZE + word, found.rows


def _pair_counts(batches: Iterator[pa.RecordBatch], hashes: np.ndarray, numbers: np.ndarray) -> Iterator[pa.RecordBatch]:
    totals = np.zeros((2, SIZE * SIZE), np.int64)
    for batch in batches:
        target = batch.column("target").to_numpy(zero_copy_only=False)
        for part in tokens.slices(batch.column("text")):
            pairs, rows = _numbered(part, hashes, numbers)
            totals[0] += np.bincount(pairs, minlength=SIZE * SIZE)
            inside = np.repeat(target[part.first:part.last], np.diff(rows))
            totals[1] += np.bincount(pairs[inside], minlength=SIZE * SIZE)
    used = np.flatnonzero(totals[0])
    yield pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.array(totals[0][used]), pa.array(totals[1][used])], names=["pair", "n", "n_target"]
    )


def losses(counts: np.ndarray) -> np.ndarray:
    """Loss of each word (column) after each context (row) of a model with these pair counts."""
    of_context, of_word = counts.sum(axis=1, keepdims=True), counts.sum(axis=0, keepdims=True)
    total = of_word.sum()
    # Every number but the boundary can follow.
    unigram = (of_word / total if total else np.zeros_like(of_word, float)) * UNIGRAM + UNIFORM / (SIZE - 1)
    bigram = np.divide(counts, of_context, out=np.zeros(counts.shape), where=of_context > 0)
    back = of_word / total if total else np.zeros(of_word.shape)
    return -np.log(np.where(of_context > 0, bigram, back) * BIGRAM + unigram)


def learn(documents: DataFrame, target: DataFrame) -> DifferenceModel:
    """Models of all texts of ``documents`` (doc_id, text) and of those whose doc_id is in ``target`` (doc_id).

    The driver holds SIZE * SIZE pair counts, whatever the size of the corpus.
    """
    wanted = target.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.lit(True).alias("_target")).distinct()
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    hashes, numbers = vocabulary(rows)
    shared = documents.sparkSession.sparkContext.broadcast((hashes, numbers))
    counted = (
        # The target ids grow with the documents, so they are not broadcast, whatever their number today.
        rows.join(wanted.hint("merge"), "doc_id", "left").select("text", F.coalesce("_target", F.lit(False)).alias("target"))
        .mapInArrow(lambda batches: _pair_counts(batches, *shared.value), "pair int, n bigint, n_target bigint")
        .groupBy("pair").agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target")).toArrow()
    )
    background, own = np.zeros((2, SIZE * SIZE))
    pairs = counted.column("pair").to_numpy()
    background[pairs], own[pairs] = counted.column("n").to_numpy(), counted.column("n_target").to_numpy()
    return DifferenceModel(hashes, numbers, losses(own.reshape(SIZE, SIZE)) - losses(background.reshape(SIZE, SIZE)))


def score(documents: DataFrame, model: DifferenceModel) -> DataFrame:
    """``doc_id, n_tokens, difference`` for each row of ``documents`` (doc_id, text), whole texts.

    ``difference`` is the mean over the words of target loss minus background
    loss, in nats: the lower, the more like the target. A null or empty text,
    or one of blanks, has 0 words and difference 0. Repeated rows score alike;
    other columns are not read.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        table = known.table.reshape(-1)
        for batch in batches:
            for part in tokens.slices(batch.column("text")):
                pairs, rows = _numbered(part, known.hashes, known.numbers)
                n = np.diff(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(part.first, len(n)), tokens.as_longs(n),
                        pa.array(tokens.row_sums(table[pairs], rows) / np.maximum(n, 1)),
                    ],
                    names=["doc_id", "n_tokens", "difference"],
                )

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scored, "doc_id bigint, n_tokens bigint, difference double")


# ---- Every word ----

# The context of a text's first word, in place of a word's hash.
_START = np.uint64(0)
# Words and pairs with at least this share of all are at most 1 / HOT_SHARE and travel to the tasks; all others are joined.
HOT_SHARE = 1e-5


def _pairs(part: tokens.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each word's context, of the word and of both, and the rows' offsets among them."""
    found = tokens.words(part, fold=True)
    context = np.empty_like(found.hashes)
    context[1:] = found.hashes[:-1]
    context[found.rows[:-1][np.diff(found.rows) > 0]] = _START
    return context, found.hashes, tokens.mix(context * tokens.PLACES[0] + found.hashes * tokens.PLACES[1]), found.rows


def _every_pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def summed() -> pa.RecordBatch:
        keys, contexts, words, counts, own = (np.concatenate(column) for column in zip(*held))
        _, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        return pa.RecordBatch.from_arrays(
            [
                tokens.as_longs(contexts[first]), tokens.as_longs(words[first]),
                *(pa.array(np.bincount(inverse, n, len(first)).astype(np.int64)) for n in (counts, own)),
            ],
            names=["context", "word", "n", "n_target"],
        )

    for batch in batches:
        target = batch.column("target").to_numpy(zero_copy_only=False)
        for part in tokens.slices(batch.column("text")):
            contexts, words, keys, rows = _pairs(part)
            inside = np.repeat(target[part.first:part.last], np.diff(rows)).astype(float)
            unique, first, inverse, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
            held.append((unique, contexts[first], words[first], counts, np.bincount(inverse, inside, len(unique))))
            size += len(unique)
            if size > _HELD_WORDS:
                yield summed()
                held, size = [], 0
    if held:
        yield summed()


def _with_totals(pairs: DataFrame, totals: DataFrame, key: str, total: int) -> DataFrame:
    """``pairs`` with the ``totals`` of their ``key``: those of frequent keys are broadcast, others joined."""
    frequent = F.broadcast(totals.filter(F.col(f"{key}_n") >= HOT_SHARE * total))
    rest = pairs.join(frequent.select(key), key, "left_anti").join(totals.hint("merge"), key)
    return pairs.join(frequent, key).unionByName(rest)


def _pair_losses(pairs: DataFrame) -> tuple[DataFrame, int]:
    """``context, word, n, loss`` of every pair that occurs, target loss minus background loss, and the number of words."""
    sums = lambda key: materialise(
        pairs.groupBy(key).agg(F.sum("n").alias(f"{key}_n"), F.sum("n_target").alias(f"{key}_target")), f"{key}-totals"
    )
    contexts, words = sums("context"), sums("word")
    all_words = words.agg(F.count("*").alias("distinct"), F.sum("word_n").alias("n"), F.sum("word_target").alias("target")).first()
    total, own = all_words.n or 0, all_words.target or 0
    found = _with_totals(_with_totals(pairs, contexts, "context", total), words, "word", total)
    uniform = F.lit(UNIFORM / max(all_words.distinct, 1))
    one_word = F.col("word_target") / own if own else F.lit(0.0)
    after = F.when(F.col("context_target") > 0, F.col("n_target") / F.col("context_target")).otherwise(one_word)
    target = -F.log(after * BIGRAM + one_word * UNIGRAM + uniform)
    background = -F.log(F.col("n") / F.col("context_n") * BIGRAM + F.col("word_n") / max(total, 1) * UNIGRAM + uniform)
    return materialise(found.select("context", "word", "n", (target - background).alias("loss")), "pair-losses"), total


class _Frequent(NamedTuple):
    """Frequent pairs, sorted by the hash of both: contexts, words, losses."""

    keys: np.ndarray
    contexts: np.ndarray
    words: np.ndarray
    losses: np.ndarray

    @staticmethod
    def of(found: pa.Table) -> _Frequent:
        contexts, words = (found.column(name).to_numpy().view(np.uint64) for name in ("context", "word"))
        keys = tokens.mix(contexts * tokens.PLACES[0] + words * tokens.PLACES[1])
        order = np.argsort(keys)
        return _Frequent(keys[order], contexts[order], words[order], found.column("loss").to_numpy()[order])

    def look_up(self, contexts: np.ndarray, words: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs are frequent, and the losses of those (0 for others)."""
        if not len(self.keys):
            return np.zeros(len(keys), bool), np.zeros(len(keys))
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = (self.keys[place] == keys) & (self.contexts[place] == contexts) & (self.words[place] == words)
        return known, np.where(known, self.losses[place], 0.0)


def _digests(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """A hash of each row's pairs with their counts: all a text's score depends on."""
    return tokens.row_sums(tokens.mix(keys ^ tokens.PLACES[2]), rows)


def score_by_every_word(documents: DataFrame, target: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, difference`` for each row of ``documents`` (doc_id, text), by models of every word.

    Both models are learned as in :func:`learn`, from all ``documents`` and from
    those whose doc_id is in ``target``, but no word is unknown: all distinct
    words of the documents share the uniform part. Pair counts and losses are
    tables that grow with the corpus; texts meet them by joins, only those of
    frequent words and pairs, at most 1 / HOT_SHARE, travel to the tasks. Rows
    are treated as in :func:`score`.
    """
    wanted = target.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.lit(True).alias("_target")).distinct()
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = (
        rows.filter("text IS NOT NULL").join(wanted.hint("merge"), "doc_id", "left").select("text", F.coalesce("_target", F.lit(False)).alias("target"))
        .mapInArrow(_every_pair, "context bigint, word bigint, n bigint, n_target bigint")
        .groupBy("context", "word").agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target"))
    )
    known, total = _pair_losses(materialise(counted, "pair-counts"))
    frequent = known.filter(F.col("n") >= HOT_SHARE * total).select("context", "word", "loss").toArrow()
    shared = documents.sparkSession.sparkContext.broadcast(_Frequent.of(frequent))

    def by_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.slices(batch.column("text")):
                contexts, words, keys, offsets = _pairs(part)
                found, loss = shared.value.look_up(contexts, words, keys)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(part.first, len(offsets) - 1), tokens.as_longs(_digests(keys, offsets)), tokens.as_longs(np.diff(offsets)),
                        tokens.as_longs(tokens.row_sums((~found).astype(np.int64), offsets)), pa.array(tokens.row_sums(loss, offsets)),
                    ],
                    names=["doc_id", "digest", "n_tokens", "n_rare", "frequent"],
                )

    def rare_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.slices(batch.column("text")):
                contexts, words, keys, offsets = _pairs(part)
                at = np.flatnonzero(~shared.value.look_up(contexts, words, keys)[0])
                row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[at]
                order = np.lexsort((keys[at], row))
                row, at = row[order], at[order]
                new = np.ones(len(at), bool)
                new[1:] = (row[1:] != row[:-1]) | (keys[at[1:]] != keys[at[:-1]])
                first = np.flatnonzero(new)
                counts = np.diff(np.append(first, len(at)))
                row, at = row[first], at[first]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(row + part.first)), tokens.as_longs(_digests(keys, offsets)[row]),
                        tokens.as_longs(contexts[at]), tokens.as_longs(words[at]), pa.array(counts.astype(np.int32), pa.int32()),
                    ],
                    names=["doc_id", "digest", "context", "word", "times"],
                )

    whole = rows.mapInArrow(by_row, "doc_id bigint, digest bigint, n_tokens bigint, n_rare bigint, frequent double")
    # Equal rows add the same sums, so their mean is that of each.
    rare = (
        rows.mapInArrow(rare_pairs, "doc_id bigint, digest bigint, context bigint, word bigint, times int")
        .join(known.filter(F.col("n") < HOT_SHARE * total).select("context", "word", "loss").hint("merge"), ["context", "word"])
        .groupBy(F.col("doc_id").alias("_doc_id"), F.col("digest").alias("_digest"))
        .agg((F.sum(F.col("times") * F.col("loss")) / F.sum("times")).alias("rare"))
    )
    mean = (F.col("frequent") + F.coalesce(F.col("rare") * F.col("n_rare"), F.lit(0.0))) / F.greatest("n_tokens", F.lit(1))
    both = whole.join(rare.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("digest") == F.col("_digest")), "left")
    return both.select("doc_id", "n_tokens", mean.alias("difference"))
