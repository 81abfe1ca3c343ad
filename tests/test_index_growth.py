"""Building and searching the inverted index: postings shuffled once, groups numbered in place, no unneeded tier read."""

import glob

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagequarry.operators import postings, terms
from pagequarry.operators.keys import numbered_runs
from pagequarry.operators.postings import InvertedIndex, bucket_of
from pagequarry.operators.terms import KeywordIndex


def test_runs_are_numbered_without_a_second_shuffle(spark):
    rng = np.random.default_rng(3)
    # One group holds most rows and is cut; weights repeat within a group.
    rows = [("cut", int(w)) for w in rng.integers(0, 50, 400)] + [(f"g{b}", int(w)) for b, w in rng.integers(0, 9, (150, 2))]
    df = spark.createDataFrame(rows, "g string, w int").repartition(5)
    numbered = numbered_runs(df, "g", [F.desc("w")], name="n", first=[F.length("g")])
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan
    groups, expected = {}, {}
    for row in numbered.collect():
        groups.setdefault(row.g, []).append((row.n, row.w))
    for g, w in rows:
        expected.setdefault(g, []).append(w)
    assert set(groups) == set(expected)
    for key, found in groups.items():
        assert [n for n, _ in sorted(found)] == list(range(len(found)))
        assert [w for _, w in sorted(found)] == sorted(expected[key], reverse=True)


def random_texts(n):
    rng = np.random.default_rng(8)
    words = [a + b for a in "abcdefghij" for b in "klmnop"]
    zipf = 1 / np.arange(1, 61)
    texts = [" ".join(rng.choice(words, size=rng.integers(1, 30), p=zipf / zipf.sum())) for _ in range(n)]
    texts += ["", None] + [f"own{'x' * i} {words[i]}" for i in range(20)] + [texts[0]] * 15
    return texts, [" ".join(rng.choice(words, size=3)) for _ in range(12)] + ["ownx aa ownxxx", "nothing", None]


@pytest.mark.parametrize("most, rows", [(0, 0), (7, 4_000_000), (40, 0), (None, 4_000_000)])
def test_rare_terms_and_joins_by_shuffle_equal_the_vector_search(spark, tmp_path, monkeypatch, most, rows):
    texts, asked = random_texts(150)
    docs = spark.createDataFrame(list(enumerate(texts)), "d bigint, t string")
    questions = spark.createDataFrame(list(enumerate(asked)), "q bigint, t string")
    monkeypatch.setattr(postings, "MAX_BROADCAST_ROWS", rows)
    monkeypatch.setattr(postings, "QUESTION_BLOCK", 6)  # several passes
    index = InvertedIndex.build(docs, "d", "t", path=str(tmp_path / "index"), buckets=4, block=2, max_broadcast=most)
    assert index.vocabulary.is_small == (most is None)
    found = sorted(map(tuple, index.search(questions, "q", "t", 4).collect()))
    assert found == sorted(map(tuple, KeywordIndex.build(docs, "d", "t").search(questions, "q", "t", 4).collect()))


def test_a_common_term_is_not_read_as_deep_as_a_rare_one(spark, tmp_path):
    # The rare word alone decides: its hundred equal texts are all met, of the common word only the first tiers.
    texts = ["rare common"] * 100 + ["common"] * 100 + ["z"] * 30
    docs = spark.createDataFrame(list(enumerate(texts)), "d bigint, t string")
    path = str(tmp_path / "index")
    index = InvertedIndex.build(docs, "d", "t", path=path, buckets=64, block=1)
    questions = spark.createDataFrame([(0, "rare common")], "q bigint, t string")
    before = sorted(map(tuple, index.search(questions, "q", "t", 3).collect()))
    assert [row[2] for row in before] == [0, 1, 2]
    common, rare = spark.range(1).select(*(bucket_of(F.lit(w), 64) for w in ("common", "rare"))).first()
    assert common != rare
    spoiled = [n for n in glob.glob(f"{path}/postings/tier=*/bucket={common}/*.parquet") if int(n.split("tier=")[1].split("/")[0]) > 3]
    assert spoiled
    for name in spoiled:
        with open(name, "wb") as handle:
            handle.write(b"not parquet")
    assert sorted(map(tuple, index.search(questions, "q", "t", 3).collect())) == before


def test_texts_that_share_an_id_are_ranked_apart(spark, tmp_path):
    # Weak twins under one id do not push out a better single text.
    texts = [(1, "fox dog"), (2, "fox fox dog"), (3, "fox cat cow hen"), (3, "fox cat cow hen"), (4, "fox cat cow"), (None, "fox")]
    docs = spark.createDataFrame(texts + [(9, "dog"), (9, "pig")], "d bigint, t string")
    questions = spark.createDataFrame([(0, "fox")], "q bigint, t string")
    index = InvertedIndex.build(docs, "d", "t", path=str(tmp_path / "index"), buckets=4, block=1)
    assert [r.id for r in index.search(questions, "q", "t", 3).orderBy("rank").collect()] == [2, 1, 4]


@pytest.mark.parametrize("most", [0, 10, 500_000])
def test_summaries_join_rare_words_only(spark, monkeypatch, most):
    texts = ["red fox. red red dog! the blue dog? a b c. " * 2 + f"own{'x' * i} red." for i in range(12)] + ["1. 2. 3! 4? " * 9, "short.", "", None]
    rows = [(None if i == 3 else i // 2, text) for i, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "id int, text string")
    expected = sorted(map(tuple, terms.summarise_long_texts(df, "id", "text", limit=20, keep=2).collect()), key=repr)
    joined, attach = [], terms.Vocabulary.attach

    def seen(self, rows, spread_by, how):
        joined.extend(r.term for r in rows.collect())
        return attach(self, rows, spread_by, how)

    monkeypatch.setattr(terms.Vocabulary, "attach", seen)
    monkeypatch.setattr(terms, "MAX_BROADCAST_TERMS", most)
    monkeypatch.setattr(terms, "MAX_BROADCAST_POSITIONS", 0 if most else 4_000_000)
    monkeypatch.setattr(terms, "WORDS_AT_ONCE", 5)
    assert sorted(map(tuple, terms.summarise_long_texts(df, "id", "text", limit=20, keep=2).collect()), key=repr) == expected
    if most == 10:
        assert joined and "red" not in joined
    if most > 10:
        assert not joined
