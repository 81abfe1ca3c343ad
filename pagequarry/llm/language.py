"""Language identification by error-correcting output codes over byte n-grams.

Each learned language has a codeword. A binary classifier per bit separates
the languages whose bit is set from the others: naive Bayes over hashed byte
n-grams (two to four bytes, letters only, A-Z lower-cased), whose counts come
from one pass over all learning texts, each language weighing the same. Decoding
adds up, for each codeword, the logistic loss of its bits against the
classifiers' margins, a bit's loss weighing as much as the bit was right on the
learning texts. The codeword of least loss wins; a text whose two best
codewords are about equally near is flagged as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.llm import tokens

ORDERS = (2, 3, 4)
BUCKETS = 1 << 15
# Up to so many languages get every distinct split as a bit; more get random codes.
EXHAUSTIVE_LANGUAGES = 6
RANDOM_BITS = 31
# Margins are mean log odds of a gram times SHARPNESS, drawn to 0 as by PRIOR_GRAMS undecided grams.
SHARPNESS = 8.0
PRIOR_GRAMS = 10.0
AMBIGUOUS_BELOW = 0.5
CALIBRATION_TEXTS = 5000
UNDETERMINED = "und"
# Languages are held in a broadcast table of BUCKETS values each.
MAX_LANGUAGES = 1000

_SPACE = 32
_LETTERS = np.full(256, _SPACE, np.uint8)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


class LanguageModel(NamedTuple):
    languages: list[str]
    code: np.ndarray  # languages x bits, +1 or -1
    weights: np.ndarray  # BUCKETS + 1 x bits, the last row 0
    bit_weights: np.ndarray


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def _grams(part: tokens.Slice) -> Iterator[np.ndarray]:
    """Buckets of the n-grams at each byte, order by order; BUCKETS where there is none."""
    n = len(part.data)
    letters = _LETTERS[part.data].astype(np.uint32)
    blank = letters == _SPACE
    # Bytes left in the row from each byte on, as far as the longest order matters.
    short = np.zeros(n, np.int64)
    ends = part.offsets[1:][np.diff(part.offsets) > 0]
    begins = part.offsets[:-1][np.diff(part.offsets) > 0]
    for back in range(1, max(ORDERS)):
        at = ends - back
        short[at[at >= begins]] = back
    for order in ORDERS:
        if n < order:
            yield np.full(n, BUCKETS, np.uint32)
            continue
        key, inner_blank = letters.copy(), np.zeros(n, bool)
        for place in range(1, order):
            key[:n - place] = key[:n - place] * np.uint32(257) + letters[place:]
            if place < order - 1:
                inner_blank[:n - place] |= blank[place:]
        bucket = (key * np.uint32(2654435761) + np.uint32(order * 0x9E3779B1 & 0xFFFFFFFF)) >> np.uint32(17)
        none = inner_blank | ((short > 0) & (short < order))
        if order == 2:
            none[:n - 1] |= blank[:-1] & blank[1:]
        bucket[none] = BUCKETS
        yield bucket


def _margins(part: tokens.Slice, weights: np.ndarray) -> np.ndarray:
    total = np.zeros((len(part.offsets) - 1, weights.shape[1]))
    grams = np.zeros(len(total))
    for bucket in _grams(part):
        # By stretches, as the looked-up rows are wide.
        for row, last in _stretches(part.offsets, 1 << 17):
            low, high = part.offsets[row], part.offsets[last]
            if high - low > 1 << 18:  # one long text
                for at in range(low, high, 1 << 17):
                    own = bucket[at:min(high, at + (1 << 17))]
                    total[row] += weights[own].sum(axis=0, dtype=np.float64)
            else:
                total[row:last] += tokens.row_sums(weights[bucket[low:high]], part.offsets[row:last + 1] - low)
        grams += tokens.row_sums((bucket < BUCKETS).astype(np.int64), part.offsets)
    return SHARPNESS * total / (grams + PRIOR_GRAMS)[:, None]


def _stretches(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    row = 0
    while row < len(offsets) - 1:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, last
        row = last


def _has_letter(part: tokens.Slice) -> np.ndarray:
    ascii_letters = tokens.row_sums(((part.data | 32) - np.uint8(97) < 26).astype(np.int64), part.offsets)
    found = ascii_letters > 0
    other = tokens.row_sums((part.data >= 128).astype(np.int64), part.offsets)
    for row in np.flatnonzero(~found & (other > 0)):
        text = part.data[part.offsets[row]:part.offsets[row + 1]].tobytes().decode("utf-8", "replace")
        found[row] = any(c.isalpha() for c in text)
    return found


def codewords(languages: int) -> np.ndarray:
    """A code of +1 and -1, one row per language, no column constant or repeated."""
    if languages < 2:
        return np.ones((languages, 1))
    if languages <= EXHAUSTIVE_LANGUAGES:
        splits = np.arange(1, 1 << (languages - 1))
        return np.array([[1.0 if language and split >> (language - 1) & 1 else -1.0 for split in splits] for language in range(languages)])
    best, apart = None, -1
    for seed in range(50):
        code = np.where(np.random.default_rng(seed).random((languages, RANDOM_BITS)) < 0.5, -1.0, 1.0)
        agree = code @ code.T
        np.fill_diagonal(agree, -RANDOM_BITS)
        distance = (RANDOM_BITS - agree.max()) / 2
        if distance > apart and (np.abs(code.sum(axis=0)) < languages).all():
            best, apart = code, distance
    if best is None or apart == 0:
        raise ValueError(f"{RANDOM_BITS} bits do not separate {languages} languages")
    return best


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in tokens.slices(batch.column("text")):
            langs = batch.column("lang").slice(part.first, part.last - part.first).dictionary_encode()
            names = langs.dictionary.to_pylist()
            first = np.repeat(langs.indices.to_numpy() * (BUCKETS + 1), np.diff(part.offsets))
            for bucket in _grams(part):
                found = np.bincount(first + bucket, minlength=len(names) * (BUCKETS + 1)).reshape(len(names), -1)
                for name, own in zip(names, found):
                    totals.setdefault(name, np.zeros(BUCKETS + 1, np.int64))[:] += own
    for name, total in sorted(totals.items()):
        used = np.flatnonzero(total[:BUCKETS])
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(total[used], pa.int64())],
            names=["lang", "bucket", "n"],
        )


def learn(documents: DataFrame, learning: Column | None = None) -> LanguageModel:
    """A model from ``text`` and ``lang`` of the rows where ``learning`` holds (all by default).

    Every such text counts, whole. What reaches the driver is one count per
    language and bucket, at most MAX_LANGUAGES * BUCKETS, and one number per
    bit. The bits' weights come from about CALIBRATION_TEXTS texts, chosen by
    a hash of their id.
    """
    rows = (
        documents.filter(F.lit(True) if learning is None else learning)
        .select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
        .filter("text IS NOT NULL AND lang IS NOT NULL")
    )
    counts = rows.select("text", "lang").mapInArrow(_counts, "lang string, bucket int, n bigint")
    counts = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    names = found.column("lang").combine_chunks().dictionary_encode()
    languages = sorted(names.dictionary.to_pylist())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    place = np.array([languages.index(name) for name in names.dictionary.to_pylist()], np.int64)
    table = np.zeros((len(languages), BUCKETS))
    if len(languages):
        table[place[names.indices.to_numpy()], found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    code = codewords(len(languages))
    weights = np.zeros((BUCKETS + 1, code.shape[1]), np.float32)
    if len(languages) < 2:
        return LanguageModel(languages, code, weights, np.ones(code.shape[1]))
    shares = (table + 0.5) / (table + 0.5).sum(axis=1, keepdims=True)
    for bit in range(code.shape[1]):
        one, other = shares[code[:, bit] > 0].mean(axis=0), shares[code[:, bit] < 0].mean(axis=0)
        weights[:BUCKETS, bit] = np.log(one) - np.log(other)
    model = LanguageModel(languages, code, weights, np.ones(code.shape[1]))
    share = min(1.0, CALIBRATION_TEXTS / max(1, rows.count()))
    sample = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))).select("text", "lang")
    shared = documents.sparkSession.sparkContext.broadcast(model)
    right = (
        sample.mapInArrow(lambda batches: _bits_right(batches, shared.value), "bit int, right bigint, n bigint")
        .groupBy("bit").agg((F.sum("right") / F.sum("n")).alias("rate")).collect()
    )
    rates = {r["bit"]: r["rate"] for r in right}
    # A bit no better than chance has no say.
    trust = np.array([max(0.05, 2 * rates.get(bit, 1.0) - 1) for bit in range(code.shape[1])])
    return model._replace(bit_weights=trust / trust.mean())


def _bits_right(batches: Iterator[pa.RecordBatch], model: LanguageModel) -> Iterator[pa.RecordBatch]:
    right, n, bits = np.zeros(model.code.shape[1], np.int64), 0, model.code.shape[1]
    for batch in batches:
        for part in tokens.slices(batch.column("text")):
            langs = batch.column("lang").slice(part.first, part.last - part.first).to_pylist()
            wanted = model.code[[model.languages.index(lang) for lang in langs]]
            right += (wanted * _margins(part, model.weights) > 0).sum(axis=0)
            n += len(langs)
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(bits), pa.int32()), pa.array(right), pa.array([n] * bits, pa.int64())], names=["bit", "right", "n"]
    )


def _decoded(batches: Iterator[pa.RecordBatch], model: LanguageModel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in tokens.slices(batch.column("text")):
            rows = len(part.offsets) - 1
            letters = _has_letter(part) & (len(model.languages) > 0)
            if model.languages:
                margins = _margins(part, model.weights)
                losses = (np.logaddexp(0, -margins[:, None, :] * model.code[None]) * model.bit_weights).sum(axis=2)
                odds = np.exp(losses.min(axis=1, keepdims=True) - losses)
                best, score = losses.argmin(axis=1), 1 / odds.sum(axis=1)
                found = [model.languages[k] if known else UNDETERMINED for k, known in zip(best, letters)]
            else:
                score, found = np.zeros(rows), [UNDETERMINED] * rows
            ambiguous = letters & (score < AMBIGUOUS_BELOW)
            columns = [batch.column(name).slice(part.first, rows) for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found, pa.string()), pa.array(np.where(letters, score, 0.0)), pa.array(ambiguous)],
                names=[*(name for name in batch.schema.names if name != "text"), "lang_pred", "score", "ambiguous"],
            )


def identify(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, ambiguous`` for each row of ``documents`` (doc_id, text).

    ``score`` is the winner's share of exp(-loss) over all codewords. A text
    that is null, empty or without a letter, and any text when no language was
    learned, is ``und`` with score 0. Equal losses go to the language first in
    the alphabet. Repeated rows are predicted alike; other columns are not read.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(
        lambda batches: _decoded(batches, shared.value),
        "doc_id bigint, held_out boolean, lang_pred string, score double, ambiguous boolean",
    )


def identified(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` whose language is told clearly, with the columns they came with.

    Rejected are texts without a letter and texts flagged as ambiguous. The
    model learns from the non-null languages of the rows themselves; where
    there are none, texts with a letter stay.
    """
    model = learn(documents)
    name = "_text"
    while name in documents.columns:
        name += "_"
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in tokens.slices(batch.column(name)):
                chosen = _has_letter(part)
                if len(known.languages) > 1:
                    losses = np.logaddexp(0, -_margins(part, known.weights)[:, None, :] * known.code[None]) * known.bit_weights
                    losses = losses.sum(axis=2)
                    chosen &= 1 / np.exp(losses.min(axis=1, keepdims=True) - losses).sum(axis=1) >= AMBIGUOUS_BELOW
                rows = batch.slice(part.first, len(chosen)).filter(pa.array(chosen))
                yield rows.drop_columns([name])

    return documents.withColumn(name, F.col("text").cast("string")).mapInArrow(keep, documents.schema)
