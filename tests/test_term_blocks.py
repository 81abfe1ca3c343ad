"""Vocabularies of which nothing may travel: rows are packed in blocks, and a block's terms joined once."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagequarry.operators import terms


def bags_of(spark, texts, partitions=2):
    rows = [(None if i % 11 == 7 else i // 2, text) for i, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "id int, text string").coalesce(partitions)
    return terms.bag_of_words(df, "id", "text")


TEXTS = ["red " * (i % 3 + 1) + " ".join("w" + chr(97 + n) for n in range(i % 9)) for i in range(50)] + ["", None, "only été", ""]


def listed(vectors):
    return sorted(((r.id, tuple((t.term, round(t.weight, 9)) for t in r.vector)) for r in vectors.collect()), key=repr)


def test_a_term_is_joined_once_for_each_block(spark, monkeypatch):
    bags = bags_of(spark, TEXTS)
    part = terms.Vocabulary.of(bags, max_broadcast=0)
    joined, attach = [], terms.Vocabulary.attach

    def seen(self, postings, spread_by, how):
        joined.extend(r.term for r in postings.collect())
        return attach(self, postings, spread_by, how)

    monkeypatch.setattr(terms.Vocabulary, "attach", seen)
    assert listed(terms.tfidf_vectors(bags, part)) == listed(terms.tfidf_vectors(bags, terms.Vocabulary.of(bags)))
    df = {r.term: r.df for r in part.frequencies.collect()}
    assert set(joined) == set(df) and df["red"] == 50
    assert max(joined.count(term) for term in df) <= 2


@pytest.mark.parametrize("block, weighed", [(1, 1), (5, 3), (40, 7), (10_000, 10_000)])
def test_blocks_of_any_size_equal_the_whole_vocabulary(spark, monkeypatch, block, weighed):
    monkeypatch.setattr(terms, "POSTINGS_AT_ONCE", block)
    monkeypatch.setattr(terms, "WEIGHED_AT_ONCE", weighed)
    bags = bags_of(spark, TEXTS, partitions=3)
    whole, part = terms.Vocabulary.of(bags), terms.Vocabulary.of(bags, max_broadcast=0)
    assert listed(terms.tfidf_vectors(bags, part)) == listed(terms.tfidf_vectors(bags, whole))
    asked = bags_of(spark, ["unknown red wa", "unknown", "", None])
    assert listed(terms.tfidf_vectors(asked, part)) == listed(terms.tfidf_vectors(asked, whole))
    nothing = bags_of(spark, ["", None])
    assert terms.tfidf_vectors(nothing, part).count() == 0


def test_ids_of_any_type_and_the_setting_are_kept(spark):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    bags = bags_of(spark, TEXTS).select(F.concat(F.lit("d"), F.col("id")).alias("id"), "terms")
    vectors = terms.tfidf_vectors(bags, terms.Vocabulary.of(bags, max_broadcast=0))
    assert vectors.schema["id"].dataType == bags.schema["id"].dataType
    assert listed(vectors) == listed(terms.tfidf_vectors(bags, terms.Vocabulary.of(bags)))
    assert spark.conf.get(setting) == before


def test_blocks_hold_every_row_and_are_bounded():
    bags = [[{"term": f"t{n}", "tf": n + 1} for n in range(i % 7)] for i in range(60)]
    kind = pa.list_(pa.struct([("term", pa.string()), ("tf", pa.int64())]))
    batches = [
        pa.RecordBatch.from_arrays([pa.array(range(at, at + 20)), pa.array(bags[at : at + 20], kind)], ["id", "terms"])
        for at in range(0, 60, 20)
    ]
    found = []
    for packed in terms._pack_rows(10)(iter(batches)):
        names = terms._unpacked(packed.column("terms")[0]).column("term").to_pylist()
        assert len(set(names)) == len(names)
        rows, number = terms._unpacked(packed.column("rows")[0]).to_pylist(), 0
        assert sum(len(r["bag"]) for r in rows) <= 20
        for r in rows:
            listed_terms = []
            for entry in r["bag"]:
                number += entry["step"]
                listed_terms.append({"term": names[number], "tf": entry["tf"]})
            found.append((r["id"], listed_terms))
    assert found == list(enumerate(bags))
