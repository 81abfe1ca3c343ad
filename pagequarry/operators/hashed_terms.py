"""TF-IDF vectors by the hashing trick: signed buckets, document frequencies of a fixed size, no vocabulary.

A term's bucket is the number of the first eight hex digits of its MD5 modulo
``buckets``; its sign is +1 when the ninth hex digit is even, else -1 (any
engine can compute both). A row's weight in a bucket is the signed sum of
its terms' counts there, times ``ln((N + 1) / (df + 1))``, N the number of
rows and df the number of rows with a term in the bucket; vectors are scaled
to unit length, and buckets of weight 0 are left out.

Counts are made inside each row (the terms' counts of ``bag_of_words`` folded
by bucket in numpy, MD5 taken once per distinct term of an Arrow batch), so
texts are not shuffled. Document frequencies are at most ``buckets`` numbers,
counted by a grouped sum that combines before the shuffle and handed to the
tasks as an array: however large the vocabulary, nothing is joined to it.
Collisions of terms in a bucket are the price; with 2^18 buckets they are
rare.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagequarry.operators.models import slices
from pagequarry.operators.terms import bag_of_words
from pagequarry.session import materialise

BUCKETS = 1 << 18
# Terms, or buckets, of whole rows that a task works on at a time.
ENTRIES = 200_000
HASHED = T.ArrayType(T.StructType([T.StructField("bucket", T.LongType()), T.StructField("tf", T.LongType())]))
VECTOR = T.ArrayType(T.StructType([T.StructField("bucket", T.LongType()), T.StructField("weight", T.DoubleType())]))


def bucket_and_sign(term: str, buckets: int) -> tuple[int, int]:
    digest = hashlib.md5(term.encode("utf-8")).hexdigest()
    return int(digest[:8], 16) % buckets, 1 if int(digest[8], 16) % 2 == 0 else -1


def bucket_column(term: Column, buckets: int = BUCKETS) -> Column:
    """The same bucket as :func:`bucket_and_sign`, as a Spark expression."""
    return F.pmod(F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def _pieces(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with at most ``ENTRIES`` entries of ``column``."""
    for batch in batches:
        sizes = pc.list_value_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        for start, stop in slices(sizes, ENTRIES):
            yield batch.slice(start, stop - start)


def _fold(buckets: int):
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, "terms"):
            bags = batch.column("terms")
            sizes = pc.list_value_length(bags).fill_null(0).to_numpy(zero_copy_only=False)
            flat = pc.list_flatten(bags)
            coded = pc.dictionary_encode(flat.field("term"))
            table = np.array([bucket_and_sign(term, buckets) for term in coded.dictionary.to_pylist()], np.int64).reshape(-1, 2)
            codes = coded.indices.to_numpy(zero_copy_only=False)
            tf = flat.field("tf").to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(bags)), sizes)
            bucket = table[codes, 0] if len(codes) else np.zeros(0, np.int64)
            signed = tf * table[codes, 1] if len(codes) else np.zeros(0, np.int64)
            keys, where = np.unique(row * buckets + bucket, return_inverse=True)
            sums = np.bincount(where, signed, len(keys)).astype(np.int64)
            rows, found = keys // buckets, keys % buckets
            offsets = np.searchsorted(rows, np.arange(len(bags) + 1)).astype(np.int32)
            entries = pa.StructArray.from_arrays([pa.array(found), pa.array(sums)], ["bucket", "tf"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.ListArray.from_arrays(pa.array(offsets), entries)],
                ["row", "id", "hashed"],
            )

    return fold


def _weigh(idf: np.ndarray):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, "hashed"):
            hashed = batch.column("hashed")
            sizes = pc.list_value_length(hashed).fill_null(0).to_numpy(zero_copy_only=False)
            flat = pc.list_flatten(hashed)
            bucket = flat.field("bucket").to_numpy(zero_copy_only=False)
            weight = flat.field("tf").to_numpy(zero_copy_only=False) * idf[bucket]
            row = np.repeat(np.arange(len(hashed)), sizes)
            used = weight != 0
            row, bucket, weight = row[used], bucket[used], weight[used]
            norm = np.sqrt(np.bincount(row, weight * weight, len(hashed)))
            counts = np.bincount(row, minlength=len(hashed))
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            entries = pa.StructArray.from_arrays([pa.array(bucket), pa.array(weight / norm[row])], ["bucket", "weight"])
            out = pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(offsets, entries)], ["id", "vector"])
            yield out.filter(pa.array(counts > 0))

    return weigh


def hashed_tfidf(df: DataFrame, id: str, text: str, buckets: int = BUCKETS) -> DataFrame:
    """``id, vector array<struct<bucket, weight>>`` of every row with a nonzero weight; rows are kept apart even where ids repeat."""
    bags = bag_of_words(df, id, text).withColumn("row", F.monotonically_increasing_id())
    schema = T.StructType([T.StructField("row", T.LongType()), bags.schema["id"], T.StructField("hashed", HASHED)])
    hashed = materialise(bags.select("row", "id", "terms").mapInArrow(_fold(buckets), schema), "hashed-bags")
    documents = hashed.count()
    # At most ``buckets`` rows, combined before the shuffle.
    counted = hashed.select(F.explode("hashed.bucket").alias("bucket")).groupBy("bucket").count().collect()
    df_of = np.zeros(buckets)
    for entry in counted:
        df_of[entry.bucket] = entry["count"]
    idf = np.log((documents + 1.0) / (df_of + 1.0))
    out = T.StructType([bags.schema["id"], T.StructField("vector", VECTOR)])
    return hashed.mapInArrow(_weigh(idf), out)
