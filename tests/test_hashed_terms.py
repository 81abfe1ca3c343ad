"""Hashed TF-IDF against a plain computation; Spark's bucket expression equals the Python one."""

import hashlib
import math

from pyspark.sql import functions as F

from pagequarry.operators.hashed_terms import bucket_and_sign, bucket_column, hashed_tfidf


def test_hashed_vectors_against_brute_force(spark):
    rows = [(1, "red fox red"), (1, "blue dog"), (None, "red cat"), (2, ""), (3, None), (4, "fox fox fox dog")]
    df = spark.createDataFrame(rows, "id bigint, text string")
    buckets = 4  # few buckets: collisions and cancelling signs happen
    got = [(r.id, tuple((e.bucket, round(e.weight, 9)) for e in r.vector)) for r in hashed_tfidf(df, "id", "text", buckets).collect()]
    bags = []
    for _, text in rows:
        counts = {}
        for word in (text or "").lower().split():
            counts[word] = counts.get(word, 0) + 1
        bags.append(counts)
    hashed = []
    for counts in bags:
        found = {}
        for word, tf in counts.items():
            bucket, sign = bucket_and_sign(word, buckets)
            found[bucket] = found.get(bucket, 0) + sign * tf
        hashed.append(found)
    df_of = {}
    for found in hashed:
        for bucket in found:
            df_of[bucket] = df_of.get(bucket, 0) + 1
    expected = []
    for (key, _), found in zip(rows, hashed):
        raw = {b: tf * math.log((len(rows) + 1) / (df_of[b] + 1)) for b, tf in found.items()}
        raw = {b: w for b, w in raw.items() if w != 0}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        if raw:
            expected.append((key, tuple(sorted((b, round(w / norm, 9)) for b, w in raw.items()))))
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_bucket_expression_equals_python(spark):
    terms = ["red", "fox", "ünï", "", "a" * 300]
    df = spark.createDataFrame([(t,) for t in terms], "t string")
    found = [r.b for r in df.select(bucket_column(F.col("t"), 262144).alias("b")).collect()]
    assert found == [bucket_and_sign(t, 262144)[0] for t in terms]
    assert hashlib.md5(b"").hexdigest()  # the empty term hashes like any other
