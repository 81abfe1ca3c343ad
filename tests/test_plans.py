"""What the physical plans must and must not contain."""

import contextlib
import io

from pyspark.sql import functions as F

from pagequarry.operators import ranking
from pagequarry.operators.index import capture_changes, newest_per_key
from pagequarry.plans.pages import pages_to_chunks

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_chunking_is_one_narrow_stage(spark):
    assert "Exchange" not in plan(pages_to_chunks(spark.read.parquet(f"{FOLDER}/pages.parquet")))


def test_search_reads_two_columns_and_pushes_its_filter(spark):
    index = spark.read.parquet(f"{FOLDER}/embeddings.parquet").withColumnsRenamed({"vec_id": "id", "embedding": "vector"})
    questions = index.select(F.col("id").alias("qid"), "vector")
    text = plan(ranking.nearest(questions, index, 2, where=F.col("label") == 3))
    assert "EqualTo(label,3)" in text
    assert "ReadSchema: struct<vec_id:bigint,embedding:array<float>,label:int>" in text
    assert "label" not in plan(ranking.nearest(questions, index, 2))
    assert plan(ranking.nearest(questions, index, 2)).count("Exchange hashpartitioning") <= 1
    assert "WindowGroupLimit" in plan(ranking.nearest(questions, index, 2))


def test_change_capture_shuffles_hashes_only(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    text = plan(capture_changes(documents, documents, "doc_id", "text"))
    shuffled = [line for line in text.splitlines() if line.startswith("Arguments: hashpartitioning")]
    assert shuffled and all("text" not in line for line in shuffled)


def test_newest_per_key_combines_before_the_shuffle(spark):
    text = plan(newest_per_key(spark.range(10).selectExpr("id % 2 AS k", "id AS v"), "k", "v"))
    assert "partial_max_by" in text
