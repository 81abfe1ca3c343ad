"""Benchmark decontamination with spaced seeds: overlaps of twelve words, two of which may differ.

A mask keeps six of ten successive words and ignores the others. The masks are
chosen so that any window of WINDOW words with at most SUBSTITUTIONS differing
ones agrees in all kept words of at least one mask at one place, so joining the
hashes of masked words finds every such window. Each hit carries the words
around it and is verified word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.llm import tokens
from pagequarry.session import materialise

WINDOW = 12
SUBSTITUTIONS = 2
SPAN = 10
# Items of fewer words than WINDOW are found where all their words occur; shorter ones than this are not looked for.
MIN_ITEM_WORDS = 5
# Bits of the table of benchmark hashes that scanning tasks receive.
BITS = 1 << 24
_BLOCK_BITS = 1 << 15
_BEFORE = WINDOW - SPAN
_AROUND = SPAN + 2 * _BEFORE


def lossless(masks: tuple[tuple[int, ...], ...]) -> bool:
    """Whether every window with at most SUBSTITUTIONS differing words is hit by a mask somewhere."""
    places = [{at + k for k in mask} for mask in masks for at in range(WINDOW - SPAN + 1)]
    return all(any(not kept & set(wrong) for kept in places) for wrong in combinations(range(WINDOW), SUBSTITUTIONS))


def _chosen_masks(weight: int) -> tuple[tuple[int, ...], ...]:
    """Masks of ``weight`` kept words, the most useful next one first, until no window is missed."""
    pairs = list(combinations(range(WINDOW), SUBSTITUTIONS))
    candidates = [(0, *inner, SPAN - 1) for inner in combinations(range(1, SPAN - 1), weight - 2)]
    found: list[tuple[int, ...]] = []
    missed = set(pairs)

    def caught(mask: tuple[int, ...]) -> set[tuple[int, ...]]:
        return {p for p in missed if any(not {at + k for k in mask} & set(p) for at in range(WINDOW - SPAN + 1))}

    while missed:
        best = max(candidates, key=lambda mask: len(caught(mask)))
        missed -= caught(best)
        found.append(best)
    return tuple(found)


MASKS = _chosen_masks(6)
_CONTEXT = "array<bigint>"


def _seeds(found: tokens.Words, lengths: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes and first words of all masked windows, and of whole windows of the given lengths."""
    for number, mask in enumerate(MASKS):
        hashes, at, _ = tokens.ngrams(found, mask)
        yield tokens.mix(hashes + np.uint64(number + 1)), at
    for length in lengths:
        hashes, at, _ = tokens.ngrams(found, tuple(range(length)))
        yield hashes, at


def _contexts(found: tokens.Words, at: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The hashed words from _BEFORE before to after a masked window; 0 outside of the row."""
    places = at[:, None] + np.arange(-_BEFORE, _AROUND - _BEFORE)
    inside = (places >= found.rows[row][:, None]) & (places < found.rows[row + 1][:, None])
    return np.where(inside, found.hashes[np.clip(places, 0, len(found.hashes) - 1)], np.uint64(0))


def _batch(ids: pa.Array, row: np.ndarray, hashes: np.ndarray, around: np.ndarray, lengths: np.ndarray | None) -> pa.RecordBatch:
    names, columns = ["id", "seed", "around"], [
        ids.take(pa.array(row)), tokens.as_longs(hashes),
        pa.ListArray.from_arrays(pa.array(np.arange(len(row) + 1) * _AROUND, pa.int32()), tokens.as_longs(around.reshape(-1))),
    ]
    if lengths is not None:
        names, columns = [*names, "length"], [*columns, tokens.as_longs(lengths)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tokens.slices(batch.column("text")):
            found = tokens.words(part, tokens.NO_LETTERS, fold=True)
            ids, counts = batch.column("id").slice(part.first, len(part.offsets) - 1), np.diff(found.rows)
            for k, (hashes, at) in enumerate(_seeds(found, tuple(range(MIN_ITEM_WORDS, WINDOW)))):
                row = np.searchsorted(found.rows, at, "right") - 1
                # Long items by masks, short ones as wholes.
                wanted = counts[row] >= WINDOW if k < len(MASKS) else counts[row] == MIN_ITEM_WORDS + k - len(MASKS)
                at, row, hashes = at[wanted], row[wanted], hashes[wanted]
                yield _batch(ids, row, hashes, _contexts(found, at, row), counts[row])


def _document_seeds(batches: Iterator[pa.RecordBatch], wanted: tuple[np.ndarray, tuple[int, ...]]) -> Iterator[pa.RecordBatch]:
    bits, lengths = wanted
    for batch in batches:
        for part in tokens.slices(batch.column("text")):
            found = tokens.words(part, tokens.NO_LETTERS, fold=True)
            ids = batch.column("id").slice(part.first, len(part.offsets) - 1)
            for hashes, at in _seeds(found, lengths):
                place = hashes >> np.uint64(40)
                held = np.flatnonzero(bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
                if len(held):
                    row = np.searchsorted(found.rows, at[held], "right") - 1
                    yield _batch(ids, row, hashes[held], _contexts(found, at[held], row), None)


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """The upper 24 bits of all seeds as a bitmap of fixed size."""
    place = F.shiftrightunsigned("seed", 40)
    blocks = (
        seeds.select(place.alias("place")).groupBy((F.col("place") / _BLOCK_BITS).cast("int").alias("block"))
        .agg(F.expr(f"bitmap_construct_agg(place % {_BLOCK_BITS})").alias("bits")).collect()
    )
    bits = np.zeros(BITS // 8, np.uint8)
    for block in blocks:
        own = np.frombuffer(bytes(block["bits"]), np.uint8)
        bits[block["block"] * (_BLOCK_BITS // 8):][:len(own)] = own
    return bits


def overlaps(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, matched`` for each document and benchmark item that overlap.

    Words are runs of letters and digits, A-Z lower-cased. An overlap is a
    window of WINDOW words of the item whose place in the document has the same
    words, at most SUBSTITUTIONS excepted; ``matched`` is the most equal words
    of such a window. An item of MIN_ITEM_WORDS to WINDOW - 1 words overlaps
    where all its words stand in a row; a shorter or null one never does. Null
    ids and texts give no rows, repeated rows none beyond the first; other
    columns are not read. Both tables may be of any size: scanning tasks get a
    bitmap of 2 MB, and only windows that pass it are joined to the items.
    """
    items = benchmark.select(F.col("item_id").cast("bigint").alias("id"), F.col("text").cast("string").alias("text")).filter(
        "id IS NOT NULL AND text IS NOT NULL"
    )
    seeds = materialise(items.mapInArrow(_item_seeds, f"id bigint, seed bigint, around {_CONTEXT}, length bigint"), "benchmark-seeds")
    lengths = tuple(sorted(r[0] for r in seeds.filter(F.col("length") < WINDOW).select("length").distinct().collect()))
    shared = documents.sparkSession.sparkContext.broadcast((_bitmap(seeds), lengths))
    texts = documents.select(F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("string").alias("text")).filter(
        "id IS NOT NULL AND text IS NOT NULL"
    )
    hits = texts.mapInArrow(lambda batches: _document_seeds(batches, shared.value), f"id bigint, seed bigint, around {_CONTEXT}")
    pairs = hits.select(F.col("id").alias("doc_id"), "seed", F.col("around").alias("there")).join(
        seeds.select(F.col("id").alias("item_id"), "seed", "around", "length"), "seed"
    )
    equal = F.zip_with("there", "around", lambda x, y: F.when((x == y) & (y != 0), 1).otherwise(0))
    pairs = pairs.select("doc_id", "item_id", "length", equal.alias("equal"))
    counts = [
        F.aggregate(F.slice("equal", at + 1, WINDOW), F.lit(0), lambda total, x: total + x) for at in range(2 * _BEFORE - 1)
    ]
    # A short item's window begins where the context's middle does.
    short = F.aggregate(F.slice("equal", _BEFORE + 1, WINDOW - 1), F.lit(0), lambda total, x: total + x)
    matched = F.when(F.col("length") < WINDOW, F.when(short >= F.col("length"), F.col("length"))).otherwise(F.greatest(*counts))
    return (
        pairs.select("doc_id", "item_id", "length", matched.cast("bigint").alias("matched"))
        .filter((F.col("length") < WINDOW) & F.col("matched").isNotNull() | (F.col("matched") >= WINDOW - SUBSTITUTIONS))
        .groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"))
    )


def decontaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` without any overlap, with all their columns; rows without doc_id or text stay."""
    found = materialise(overlaps(documents, benchmark).select(F.col("doc_id").alias("_hit")).distinct(), "contaminated")
    return documents.join(found, documents["doc_id"] == found["_hit"], "left_anti")
