"""Registered queries: vectors, index upkeep and search."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagequarry.functions.text import STOP_WORDS, explode_rows
from pagequarry.functions.vectors import vector_sum
from pagequarry.operators import ranking, signs, terms
from pagequarry.operators.answers import apply_threshold, attach_columns, embed_questions
from pagequarry.operators.index import (
    capture_changes,
    content_hash,
    delete_keys,
    index_rows,
    refuse_duplicates,
    upsert_vectors,
)
from pagequarry.operators.models import embed, hashed_words
from pagequarry.operators.cells import CellIndex
from pagequarry.operators.hashed_terms import hashed_tfidf
from pagequarry.operators.postings import InvertedIndex
from pagequarry.plans import sql
from pagequarry.plans.registry import query, table, texts
from pagequarry.session import materialise, new_folder
from pagequarry.streaming.change_feed import ChangeFeed
from pagequarry.streaming.index_sync import IndexSync


def vector_index(spark, folder):
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label"
    )


def self_questions(index):
    return index.select(F.col("id").alias("qid"), "vector")


def document_index(spark, folder):
    documents = texts(spark, folder, "documents")
    return documents.select(F.col("doc_id").alias("id"), embed(F.col("text"), hashed_words(64)).alias("vector"))


def asked(spark, folder):
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("question"))


# ---- vectors and index upkeep ----


@query(f"WITH {sql.hashed_vectors('v', 'documents', 'doc_id', 'text')} SELECT id, dim, round(w, 6) AS weight FROM v")
def text_vectors(spark, folder):
    """Default embedder, listed by dimension."""
    listed = explode_rows(document_index(spark, folder), F.col("vector"), "dim", "w")
    return listed.filter(F.col("w") != 0).select(
        "id", F.col("dim").cast("bigint").alias("dim"), F.round(F.col("w").cast("double"), 6).alias("weight")
    )


@query(f"""
    SELECT id, term, count(*) AS tf FROM (SELECT doc_id AS id, unnest({sql.words('text')}) AS term FROM documents)
    GROUP BY 1, 2""")
def bags_of_words(spark, folder):
    bags = terms.bag_of_words(texts(spark, folder, "documents"), "doc_id", "text")
    return explode_rows(bags, F.col("terms"), "_", "t").select("id", "t.term", "t.tf")


@query(f"""
    WITH {sql.frequencies('c', 'documents', 'doc_id', 'text')}, {sql.tfidf('t', 'documents', 'doc_id', 'text', 'c')}
    SELECT id, term, round(w, 6) AS weight FROM t""")
def term_weights(spark, folder):
    bags = materialise(terms.bag_of_words(texts(spark, folder, "documents"), "doc_id", "text"), "bags-of-words")
    vectors = terms.tfidf_vectors(bags, terms.Vocabulary.of(bags))
    return explode_rows(vectors, F.col("vector"), "_", "t").select(
        "id", "t.term", F.round("t.weight", 6).alias("weight")
    )


@query(f"""
    WITH t AS (SELECT doc_id AS id, unnest({sql.words('text')}) AS term FROM documents),
    h AS (SELECT id, ('0x' || substr(md5(term), 1, 8))::BIGINT % 262144 AS bucket,
                 CASE WHEN ('0x' || substr(md5(term), 9, 1))::BIGINT % 2 = 0 THEN 1 ELSE -1 END AS sign FROM t),
    b AS (SELECT id, bucket, sum(sign) AS tf FROM h GROUP BY 1, 2),
    d AS (SELECT bucket, count(*) AS df FROM b GROUP BY 1),
    n AS (SELECT count(*)::DOUBLE AS n FROM documents),
    r AS (SELECT id, bucket, tf * ln((n + 1) / (df + 1)) AS raw FROM b JOIN d USING (bucket), n WHERE tf <> 0)
    SELECT id, bucket, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)), 6) AS weight FROM r WHERE raw <> 0""")
def hashed_term_weights(spark, folder):
    """TF-IDF by the hashing trick: signed buckets, document frequencies of fixed size, no vocabulary joined."""
    vectors = hashed_tfidf(texts(spark, folder, "documents"), "doc_id", "text")
    listed = explode_rows(vectors, F.col("vector"), "_", "v")
    return listed.select("id", F.col("v.bucket").alias("bucket"), F.round("v.weight", 6).alias("weight"))


@query(f"""
    WITH {sql.frequencies('c', 'documents', 'doc_id', 'text')}, {sql.tfidf('t', 'documents', 'doc_id', 'text', 'c')}
    SELECT id, term, round(w, 6) AS weight FROM t""")
def term_weights_by_join(spark, folder):
    """The same by the join that vocabularies too large for the tasks take."""
    bags = materialise(terms.bag_of_words(texts(spark, folder, "documents"), "doc_id", "text"), "bags-of-words")
    vectors = terms.tfidf_vectors(bags, terms.Vocabulary.of(bags, max_broadcast=0))
    return explode_rows(vectors, F.col("vector"), "_", "t").select(
        "id", "t.term", F.round("t.weight", 6).alias("weight")
    )


@query(f"""
    WITH {sql.vector_sums('t', 'pages', 'page_id', 'html')}
    SELECT page_id AS id, url, md5(coalesce(html, '')) AS content_hash, 'hashed-64' AS model_id, 64::BIGINT AS dimension,
           coalesce(total, 0) AS total
    FROM pages LEFT JOIN t ON id = page_id""")
def built_index(spark, folder):
    pages = refuse_duplicates(texts(spark, folder, "pages"), "page_id")
    rows = index_rows(pages, "page_id", "html", hashed_words(64), "hashed-64", ("url",))
    dimension = F.size("vector").cast("bigint").alias("dimension")
    return rows.select("id", "url", "content_hash", "model_id", dimension, vector_sum(F.col("vector")).alias("total"))


@query("""
    WITH old AS (SELECT doc_id, md5(text) AS old_hash FROM documents WHERE lang <> 'es'),
    new AS (SELECT doc_id, md5(CASE source WHEN 'src3' THEN text || ' revised' ELSE text END) AS new_hash
            FROM documents WHERE lang <> 'de')
    SELECT doc_id, CASE WHEN old_hash IS NULL THEN 'insert' WHEN new_hash IS NULL THEN 'delete' ELSE 'update' END AS change,
           old_hash, new_hash
    FROM old FULL JOIN new USING (doc_id) WHERE old_hash IS DISTINCT FROM new_hash""")
def captured_changes(spark, folder):
    """Inserts, updates and deletes between two states of the documents."""
    documents = table(spark, folder, "documents")
    revised = F.when(F.col("source") == "src3", F.concat("text", F.lit(" revised"))).otherwise(F.col("text"))
    old = documents.filter(F.col("lang") != "es")
    new = documents.filter(F.col("lang") != "de").withColumn("text", revised)
    return capture_changes(old, new, "doc_id", "text")


def change_sets(spark, folder):
    """Two sets of changes to an index of all documents not in Spanish."""
    documents = table(spark, folder, "documents").withColumnRenamed("doc_id", "id")

    def change(rows, version, text=None, deleted=False):
        return rows.select(
            "id",
            (F.col("text") if text is None else text).alias("text"),
            F.lit(version).cast("bigint").alias("version"),
            F.lit(deleted).alias("deleted"),
        )

    def of(source):
        return documents.filter(F.col("source") == source)

    inserted = change(documents.filter(F.col("lang") == "es"), 1)
    updated = change(of("src3"), 2, F.concat("text", F.lit(" revised")))
    late = change(of("src3"), 1, F.concat("text", F.lit(" draft")))
    unchanged = change(of("src7"), 2)
    removed = change(of("src5"), 3, deleted=True)
    return [inserted.unionByName(updated), late.unionByName(unchanged).unionByName(removed)]


CHANGE_SCHEMA = "id bigint, text string, version bigint, deleted boolean"


def sync_documents(spark, folder):
    """An index kept in step through a stream of the change sets."""
    sync = IndexSync(spark, new_folder(spark, "synced-index"), hashed_words(64), T.LongType(), shards=8)
    documents = texts(spark, folder, "documents")
    sync.build(documents.filter(F.col("lang") != "es"), "doc_id", "text")
    incoming, checkpoint = new_folder(spark, "changes"), new_folder(spark, "stream")
    for changes in change_sets(spark, folder):
        changes.write.mode("append").parquet(incoming)
        stream = spark.readStream.schema(CHANGE_SCHEMA).parquet(incoming)
        sync.start(stream, checkpoint).awaitTermination()
    return sync


@query(f"""
    WITH state AS (
        SELECT doc_id, CASE WHEN source IN ('src3', 'src7') THEN 2 WHEN lang = 'es' THEN 1 ELSE 0 END::BIGINT AS version,
               CASE source WHEN 'src3' THEN text || ' revised' ELSE text END AS text
        FROM documents WHERE source <> 'src5'), {sql.vector_sums('t', 'state', 'doc_id', 'text')}
    SELECT doc_id AS id, version, md5(text) AS content_hash, coalesce(total, 0) AS total
    FROM state LEFT JOIN t ON id = doc_id""")
def synced_index(spark, folder):
    """State after inserts, updates, late versions, unchanged texts and deletes arrived as a stream."""
    current = sync_documents(spark, folder).read()
    return current.select("id", "version", "content_hash", vector_sum(F.col("vector")).alias("total"))


@query(f"""
    WITH old AS (SELECT doc_id, md5(coalesce(text, '')) AS old_hash FROM documents WHERE lang <> 'es'),
    state AS (
        SELECT doc_id, CASE source WHEN 'src3' THEN text || ' revised' ELSE text END AS text FROM documents WHERE lang <> 'de'),
    {sql.vector_sums('t', 'state', 'doc_id', 'text')}
    SELECT doc_id AS id, CASE WHEN old_hash = md5(coalesce(state.text, '')) THEN 0 ELSE 1 END::BIGINT AS version,
           md5(coalesce(state.text, '')) AS content_hash, coalesce(total, 0) AS total
    FROM state LEFT JOIN old USING (doc_id) LEFT JOIN t ON id = doc_id""")
def fed_index(spark, folder):
    """An index built from one snapshot, brought to the next by a published feed read as a stream."""
    documents = table(spark, folder, "documents")
    revised = F.when(F.col("source") == "src3", F.concat("text", F.lit(" revised"))).otherwise(F.col("text"))
    old = documents.filter(F.col("lang") != "es")
    new = documents.filter(F.col("lang") != "de").withColumn("text", revised)
    sync = IndexSync(spark, new_folder(spark, "fed-index"), hashed_words(64), T.LongType(), shards=8)
    sync.build(old, "doc_id", "text")
    feed = ChangeFeed(spark, new_folder(spark, "feed"))
    feed.publish(old, new, "doc_id", "text")
    sync.start(feed.stream("bigint", max_files=4), new_folder(spark, "feed-stream")).awaitTermination()
    current = sync.read()
    return current.select("id", "version", "content_hash", vector_sum(F.col("vector")).alias("total"))


@query("""
    SELECT vec_id AS id, CASE WHEN label = 3 THEN 100 ELSE label END::INTEGER AS label,
           round(CASE WHEN label = 3 THEN list_sum(list_transform(embedding, lambda x: -x::DOUBLE))
                      ELSE list_sum(embedding::DOUBLE[]) END, 6) AS total
    FROM embeddings WHERE label <> 5""")
def upserted_index(spark, folder):
    """Vectors of one label replaced, those of another deleted; the newer of two versions wins."""
    index = vector_index(spark, folder)
    changed = index.filter(F.col("label") == 3)
    older = changed.withColumns({"label": F.lit(99), "version": F.lit(1)})
    newer = changed.withColumns(
        {"label": F.lit(100), "version": F.lit(2), "vector": F.transform("vector", lambda x: -x)}
    )
    updated = upsert_vectors(index, older.unionByName(newer), "id", "vector", 64, "version")
    current = delete_keys(updated, index.filter(F.col("label") == 5), "id")
    total = F.aggregate("vector", F.lit(0.0), lambda t, x: t + x)
    return current.select("id", "label", F.round(total, 6).alias("total"))


# ---- search ----


def _l2_hits(k: int, condition: str = "true", columns: str = "qid, rank, id, score") -> str:
    return f"""
    WITH scores AS (
        SELECT q.vec_id AS qid, d.vec_id AS id,
               {sql.significant('(1 / (1 + power(list_distance(q.embedding::DOUBLE[], d.embedding::DOUBLE[]), 2)))')} AS score
        FROM embeddings q JOIN embeddings d ON q.vec_id <> d.vec_id AND {condition}),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM scores)
    SELECT {columns} FROM ranked WHERE rank <= {k}"""


@query(_l2_hits(3))
def nearest_vectors(spark, folder):
    """The three nearest other vectors of every vector."""
    index = vector_index(spark, folder)
    return ranking.without_self(ranking.nearest(self_questions(index), index, 4), 3)


@query(_l2_hits(3))
def nearest_vectors_in_blocks(spark, folder):
    """The same for a question set too large to broadcast: blocks against blocks."""
    index = vector_index(spark, folder)
    hits = ranking.nearest(
        self_questions(index), index, 4, max_questions=100, question_block=512, index_block=512
    )
    return ranking.without_self(hits, 3)


_SCALED_HITS = _l2_hits(3).replace("FROM embeddings q JOIN embeddings d", """
        FROM (SELECT vec_id, list_transform(embedding, lambda x: x * 1000) AS embedding FROM embeddings) q
        JOIN (SELECT vec_id, list_transform(embedding, lambda x: x * 1000) AS embedding FROM embeddings) d""")


def _scaled_hits(spark, folder, **blocks):
    index = vector_index(spark, folder).withColumn("vector", F.transform("vector", lambda x: (x * 1000).cast("float")))
    return ranking.without_self(ranking.nearest(self_questions(index), index, 4, **blocks), 3)


@query(_SCALED_HITS)
def nearest_scaled_vectors(spark, folder):
    """Vectors a thousand times as long, whose scores are all near zero."""
    return _scaled_hits(spark, folder)


@query(_SCALED_HITS)
def nearest_scaled_vectors_in_blocks(spark, folder):
    return _scaled_hits(spark, folder, max_questions=100, question_block=512, index_block=512)


@query(_l2_hits(2, columns="qid, rank, id, (SELECT label FROM embeddings e WHERE e.vec_id = ranked.id) AS label, score"))
def hits_with_columns(spark, folder):
    index = vector_index(spark, folder)
    hits = ranking.without_self(ranking.nearest(self_questions(index), index, 3), 2)
    return attach_columns(hits, index, "id", "label")


@query(_l2_hits(2, condition="d.label IN (1, 2)"))
def filtered_search(spark, folder):
    """Only vectors the caller may see, filtered before ranking."""
    index = vector_index(spark, folder)
    hits = ranking.nearest(self_questions(index), index, 3, where=F.col("label").isin(1, 2))
    return ranking.without_self(hits, 2)


@query(f"SELECT doc_id, source FROM documents WHERE list_contains({sql.words('text')}, 'that')")
def keyword_filter(spark, folder):
    documents = texts(spark, folder, "documents")
    return documents.filter(terms.has_keyword(F.col("text"), "That")).select("doc_id", "source")


def _keyword_hits(k: int, tail: str, condition: str = "TRUE") -> str:
    stop = STOP_WORDS
    return f"""
    WITH {sql.frequencies('c', 'documents', 'doc_id', 'text', stop)},
    {sql.tfidf('d', 'documents', 'doc_id', 'text', 'c', stop)},
    {sql.tfidf('q', 'benchmark', 'item_id', 'text', 'c', stop)},
    scores AS (
        SELECT q.id AS qid, d.id AS id, {sql.significant('sum(q.w * d.w)')} AS score
        FROM q JOIN d USING (term) WHERE {condition} GROUP BY 1, 2),
    hits AS (
        SELECT * FROM (SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank, id, score
                       FROM scores WHERE score > 0) WHERE rank <= {k})
    {tail}"""


def inverted_index(spark, folder):
    return InvertedIndex.build(texts(spark, folder, "documents"), "doc_id", "text", STOP_WORDS)


@query(_keyword_hits(3, "SELECT qid, rank, id, score FROM hits"))
def keyword_search_by_postings(spark, folder):
    """As ``keyword_search``, from postings of the asked terms only, stopping each question early."""
    return inverted_index(spark, folder).search(table(spark, folder, "benchmark"), "item_id", "text", 3)


@query(_keyword_hits(3, "SELECT qid, rank, id, score FROM hits", "d.id IN (SELECT doc_id FROM documents WHERE source = 'src3')"))
def keyword_search_in_source(spark, folder):
    """Keyword search among the texts of one source only, admitted before ranking."""
    allowed = table(spark, folder, "documents").where(F.col("source") == "src3").select("doc_id")
    return inverted_index(spark, folder).search(table(spark, folder, "benchmark"), "item_id", "text", 3, allowed=allowed)


def keyword_hits(spark, folder, k):
    index = terms.KeywordIndex.build(texts(spark, folder, "documents"), "doc_id", "text", STOP_WORDS)
    return index.search(table(spark, folder, "benchmark"), "item_id", "text", k)


@query(_keyword_hits(3, "SELECT qid, rank, id, score FROM hits"))
def keyword_search(spark, folder):
    """TF-IDF cosine of every question against every document."""
    return keyword_hits(spark, folder, 3)


@query(_keyword_hits(2, """
    SELECT item_id AS qid, rank, id, score FROM benchmark LEFT JOIN (SELECT * FROM hits WHERE score > 0.66) ON item_id = qid"""))
def relevant_hits(spark, folder):
    """Hits above the threshold; questions without one stay."""
    return apply_threshold(asked(spark, folder).select("qid"), keyword_hits(spark, folder, 2))


_QUESTION_RANKING = f"""
    WITH {sql.hashed_vectors('d', 'documents', 'doc_id', 'text')}, {sql.hashed_vectors('q', 'benchmark', 'item_id', 'text')},
    {sql.cosine_ranking('hits', 'q', 'd')}"""


@query(f"{_QUESTION_RANKING} SELECT qid, rank, id, score FROM hits WHERE rank <= 3")
def question_search(spark, folder):
    """Questions embedded and searched among all documents."""
    questions = embed_questions(asked(spark, folder), "question", hashed_words(64))
    return ranking.nearest(questions, document_index(spark, folder), 3, ranking.Dense("cosine"))


_DISTANCE = "list_distance({a}.embedding::DOUBLE[], {b}.embedding::DOUBLE[])"


@query(f"""
    WITH centres AS (
        SELECT row_number() OVER (ORDER BY label) AS cell, embedding FROM (
            SELECT label, arg_min(embedding, vec_id) AS embedding FROM embeddings GROUP BY label)),
    placed AS (
        SELECT vec_id, cell, row_number() OVER (
            PARTITION BY vec_id ORDER BY {_DISTANCE.format(a='e', b='c')}, cell) AS place
        FROM embeddings e, centres c),
    scores AS (
        SELECT q.vec_id AS qid, d.vec_id AS id,
               {sql.significant(f"(1 / (1 + power({_DISTANCE.format(a='q', b='d')}, 2)))")} AS score
        FROM placed a JOIN placed b ON a.cell = b.cell AND a.place <= 4 AND b.place = 1 AND a.vec_id <> b.vec_id
        JOIN embeddings q ON q.vec_id = a.vec_id JOIN embeddings d ON d.vec_id = b.vec_id)
    SELECT qid, rank, id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM scores) WHERE rank <= 3""")
def approximate_search_by_label_centres(spark, folder):
    """Nearest vectors among four cells, around the first vector of each label."""
    index = vector_index(spark, folder)
    firsts = index.groupBy("label").agg(F.min_by("vector", "id").alias("vector")).orderBy("label")
    # One row per label, of which there are ten.
    centroids = np.array([row.vector for row in firsts.select("vector").toLocalIterator()])
    cells = materialise(ranking.assign_cells(index.select("id", "vector"), centroids), "celled-index")
    return ranking.without_self(ranking.approximate_nearest(self_questions(index), cells, centroids, 4, probes=4), 3)


@query()
def approximate_search(spark, folder):
    """Nearest vectors among half of the cells; no SQL, as the cells come from k-means."""
    index = vector_index(spark, folder).select("id", "vector")
    centroids = ranking.train_centroids(index, 8)
    cells = materialise(ranking.assign_cells(index, centroids), "celled-index")
    return ranking.without_self(ranking.approximate_nearest(self_questions(index), cells, centroids, 4, probes=4), 3)


@query(_l2_hits(2, condition="d.label = 5"))
def filtered_approximate_search(spark, folder):
    """The nearest vectors of one label among stored cells: the closest cells, then every cell its radius leaves in reach."""
    index = vector_index(spark, folder)
    centroids = ranking.train_centroids(index.select("id", "vector"), 8)
    cells = CellIndex.build(index, centroids)
    hits = cells.search(self_questions(index), 3, probes=2, where=F.col("label") == 5)
    return ranking.without_self(hits, 2)


@query()
def hashed_candidate_search(spark, folder):
    """Nearest vectors among sign-projection candidates, scored exactly; no SQL, recall is tested against the exact search."""
    index = vector_index(spark, folder).select("id", "vector")
    return ranking.without_self(signs.hashed_nearest(self_questions(index), index, 4), 3)


@query(_l2_hits(3))
def approximate_search_of_all_cells(spark, folder):
    """Probing every cell is exact."""
    index = vector_index(spark, folder).select("id", "vector")
    centroids = ranking.train_centroids(index, 8)
    cells = materialise(ranking.assign_cells(index, centroids), "celled-index")
    return ranking.without_self(ranking.approximate_nearest(self_questions(index), cells, centroids, 4, probes=8), 3)
