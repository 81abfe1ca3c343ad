"""Vocabularies beyond the bound: frequent terms travel, only the others are joined."""

import pytest
from pyspark.sql import functions as F

from pagequarry.operators import terms


def bags_of(spark):
    # Term t<n> is in 2^n texts; "red" in all, one text has nothing, ids repeat and are missing.
    texts = [" ".join(["red"] * (i % 3 + 1) + ["t" + chr(97 + n) for n in range(6) if i < 2**n]) for i in range(40)] + ["", None, "only"]
    rows = [(None if i == 7 else i // 2, text) for i, text in enumerate(texts)]
    return terms.bag_of_words(spark.createDataFrame(rows, "id int, text string"), "id", "text")


def listed(vectors):
    return sorted(((r.id, tuple((t.term, round(t.weight, 9)) for t in r.vector)) for r in vectors.collect()), key=repr)


@pytest.mark.parametrize("most", [0, 1, 3, 6])
def test_head_and_rest_equal_the_whole_vocabulary(spark, most):
    bags = bags_of(spark)
    whole = terms.Vocabulary.of(bags)
    part = terms.Vocabulary.of(bags, max_broadcast=most)
    assert whole.is_small and not part.is_small and part.head().count() <= most
    assert listed(terms.tfidf_vectors(bags, part)) == listed(terms.tfidf_vectors(bags, whole))
    # Terms that no text has weigh as in no document, on both ways.
    asked = terms.bag_of_words(spark.createDataFrame([(1, "unknown red ta"), (2, "unknown")], "id int, text string"), "id", "text")
    assert listed(terms.tfidf_vectors(asked, part)) == listed(terms.tfidf_vectors(asked, whole))


def test_only_terms_outside_the_head_are_joined(spark, monkeypatch):
    bags = bags_of(spark)
    part = terms.Vocabulary.of(bags, max_broadcast=4)
    joined, attach = [], terms.Vocabulary.attach

    def seen(self, postings, spread_by, how):
        joined.extend(r.term for r in postings.collect())
        return attach(self, postings, spread_by, how)

    monkeypatch.setattr(terms.Vocabulary, "attach", seen)
    terms.tfidf_vectors(bags, part).collect()
    frequencies = {r.term: r.df for r in part.frequencies.collect()}
    head = {r.term for r in part.head().collect()}
    assert head and "red" in head and not head & set(joined)
    assert len(joined) == sum(df for term, df in frequencies.items() if term not in head) < sum(frequencies.values()) / 2
