"""Registered queries: sources, sinks and the run-metadata table."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagequarry.functions.vectors import vector_sum
from pagequarry.operators.chunking import chunk_id, explode_chunks, paragraphs
from pagequarry.operators.index import IndexStore
from pagequarry.operators.keys import NumberedTable, dense_ids
from pagequarry.operators.memos import HEADERS, raw_memos
from pagequarry.operators.models import hashed_words
from pagequarry.plans import sql
from pagequarry.plans.registry import query, table, texts
from pagequarry.plans.sql import article
from pagequarry.session import new_folder
from pagequarry.sources import readers, tables


def memo_export(spark, folder):
    """The documents as a memo export in CSV; returns its path."""
    documents = texts(spark, folder, "documents")
    written = F.expr("timestamp_ntz'2022-01-05 00:00:00' + make_dt_interval(0, cast(n_chars as int), 15)")
    values = {
        "Timestamp": F.date_format(written, "MMM dd, yyyy hh:mm a"),
        "Date of Memo": F.date_format(written, "MMM dd, yyyy"),
        "TO (one per line)": F.concat_ws("\n", "lang", "source"),
        "FROM (one per line)": F.col("source"),
        "Link to Memo (file upload)": F.concat(F.lit("memo/"), "doc_id"),
        "Memo Text Part 1": F.col("text"),
        "Memo Text Part 2": F.col("lang"),
    }
    path = new_folder(spark, "memo-export")
    columns = [values.get(name, F.lit(None).cast("string")).alias(name) for name in ("Timestamp", *HEADERS)]
    readers.write_memo_export(documents.select(*columns), path)
    return path


@query("""
    SELECT 'memo/' || doc_id AS Link_to_Memo, lang || chr(10) || source AS "TO", source AS "FROM",
           text AS Memo_Text_1, lang AS Memo_Text_2, CAST(NULL AS VARCHAR) AS Memo_Subject
    FROM documents""")
def memo_export_scan(spark, folder):
    """CSV with quoted cells over several lines, headers renamed."""
    export = readers.read_memo_export(spark, memo_export(spark, folder))
    return raw_memos(export).select("Link_to_Memo", "TO", "FROM", "Memo_Text_1", "Memo_Text_2", "Memo_Subject")


@query("SELECT doc_id, lang, n_chars FROM documents")
def parquet_columns(spark, folder):
    return readers.read_parquet(spark, f"{folder}/documents.parquet", "doc_id", "lang", "n_chars")


@query("SELECT * FROM labels")
def table_scan(spark, folder):
    """Catalog table over the newest version of a folder."""
    stored = tables.VersionedTable(spark, new_folder(spark, "labels"))
    stored.overwrite(table(spark, folder, "labels"))
    stored.publish("published_labels")
    return readers.read_table(spark, "published_labels")


@query("SELECT url FROM pages")
def sitemap_urls(spark, folder):
    path = new_folder(spark, "sitemap")
    readers.write_sitemap(table(spark, folder, "pages"), path)
    return readers.read_sitemap(spark, path).select("url")


@query(f"""
    SELECT url, text FROM (SELECT url, trim({article()}) AS text FROM pages) WHERE text IS NOT NULL""")
def raw_pages(spark, folder):
    return readers.raw_pages(texts(spark, folder, "pages"))


@query("SELECT doc_id, lang, n_chars * 2 AS n_chars FROM documents WHERE lang <> 'en'")
def overwritten_table(spark, folder):
    """A table overwritten by a query over itself."""
    stored = tables.VersionedTable(spark, new_folder(spark, "documents"))
    stored.overwrite(table(spark, folder, "documents").select("doc_id", "lang", "n_chars"))
    stored.overwrite(stored.read().filter(F.col("lang") != "en").withColumn("n_chars", F.col("n_chars") * 2))
    return stored.read()


@query("""
    SELECT doc_id, CAST(NULL AS INTEGER) AS quality, lang, source FROM documents
    UNION ALL BY NAME SELECT doc_id, quality FROM labels""")
def appended_columns(spark, folder):
    """Two appends with different columns read as one table."""
    path = new_folder(spark, "evolving")
    tables.append(table(spark, folder, "documents").select("doc_id", "lang", "source"), path)
    tables.append(table(spark, folder, "labels").select("doc_id", "quality"), path)
    return tables.read_evolved(spark, path).select("doc_id", "quality", "lang", "source")


@query("SELECT page_id, url FROM pages")
def guarded_write(spark, folder):
    """An empty table is replaced; the third write finds enough rows and is skipped."""
    stored = tables.VersionedTable(spark, new_folder(spark, "guarded"))
    pages = table(spark, folder, "pages").select("page_id", "url")
    stored.write_if_needed(pages.limit(0), min_rows=1)
    stored.write_if_needed(pages, min_rows=1)
    stored.write_if_needed(pages.limit(0), min_rows=1)
    return stored.read()


@query("""
    SELECT doc_id * 65536 + chunk_no AS id, doc_id, chunk_no
    FROM (SELECT doc_id, unnest(range(len(list_filter(string_split(text, chr(10)), lambda p: trim(p) <> '')))) AS chunk_no
          FROM documents)""")
def chunk_ids(spark, folder):
    chunks = explode_chunks(texts(spark, folder, "documents"), paragraphs(F.col("text")), "doc_id")
    return chunks.select(chunk_id(F.col("doc_id"), F.col("chunk_no")).alias("id"), "doc_id", "chunk_no")


@query("""
    SELECT row_number() OVER (ORDER BY lang IS DISTINCT FROM 'en', doc_id, chunk_no) AS id, doc_id, chunk_no
    FROM (SELECT doc_id, lang, unnest(range(len(list_filter(string_split(text, chr(10)), lambda p: trim(p) <> '')))) AS chunk_no
          FROM documents)""")
def numbered_chunk_ids(spark, folder):
    """Chunk ids of two appends, English pages first, the second going on from the first's last id."""
    chunks = explode_chunks(texts(spark, folder, "documents"), paragraphs(F.col("text")), "doc_id", "lang")
    numbered = NumberedTable(spark, new_folder(spark, "numbered-chunks"))
    english = F.col("lang") == "en"
    numbered.append(chunks.where(english).select("doc_id", "chunk_no"), "doc_id", "chunk_no")
    numbered.append(chunks.where(~english | F.col("lang").isNull()).select("doc_id", "chunk_no"), "doc_id", "chunk_no")
    return numbered.read().select("id", "doc_id", "chunk_no")


@query("SELECT row_number() OVER (ORDER BY lang, doc_id) AS id, lang, doc_id FROM documents")
def dense_row_ids(spark, folder):
    return dense_ids(table(spark, folder, "documents").select("lang", "doc_id"), "lang", "doc_id", partitions=32)


@query(f"""
    WITH {sql.vector_sums('t', 'documents', 'doc_id', 'text')}
    SELECT doc_id AS id, source, md5(text) AS content_hash, 64::BIGINT AS dimension, coalesce(total, 0) AS total
    FROM documents LEFT JOIN t ON id = doc_id""")
def stored_index(spark, folder):
    """Index snapshot written and loaded again; the second build finds it and does nothing."""
    store = IndexStore(spark, new_folder(spark, "index"))
    documents = texts(spark, folder, "documents")
    for _ in range(2):
        store.build(documents, "doc_id", "text", hashed_words(64), "hashed-64", ("source",))
    index = store.load("hashed-64")
    dimension = F.size("vector").cast("bigint").alias("dimension")
    return index.select("id", "source", "content_hash", dimension, vector_sum(F.col("vector")).alias("total"))


@query("SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 2")
def preview_rows(spark, folder):
    return tables.preview(table(spark, folder, "documents").select("doc_id", "lang", "source"), "doc_id", rows=2)


@query("SELECT conv_id, turn, role, CASE role WHEN 'user' THEN 1 ELSE 2 END AS run FROM conversations")
def appended_runs(spark, folder):
    """Results of two runs; the first one is repeated and stays single."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role")
    path = new_folder(spark, "runs")
    for run, role in ((1, "user"), (2, "assistant"), (1, "user")):
        chosen = turns.filter(F.col("role") == "user") if role == "user" else turns.filter(F.col("role") != "user")
        tables.append_run(chosen, path, run)
    return spark.read.parquet(path)


@query("""
    SELECT event_type, event_id, value FROM (
        SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS n FROM events)
    WHERE n = 1""")
def latest_run_per_name(spark, folder):
    newest = tables.latest_per_name(table(spark, folder, "events"), "event_type", "ts", "event_id")
    return newest.select("event_type", "event_id", "value")


@query("SELECT event_id, user_id, value FROM events WHERE event_type = 'click' ORDER BY ts DESC LIMIT 1")
def latest_run_for_name(spark, folder):
    newest = tables.latest_for(table(spark, folder, "events"), "click", "event_type", "ts")
    return newest.select("event_id", "user_id", "value")


@query("SELECT event_id, event_type FROM events WHERE NOT coalesce(event_type = 'error', false)")
def rows_deleted(spark, folder):
    stored = tables.VersionedTable(spark, new_folder(spark, "events"))
    stored.overwrite(table(spark, folder, "events").select("event_id", "event_type"))
    stored.delete(F.col("event_type") == "error")
    return stored.read()


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS name, count(*) >= 400 AS enough FROM {name}"
    for name in ("benchmark", "conversations", "documents", "pages")))
def row_checks(spark, folder):
    checks = [
        tables.row_check(table(spark, folder, name), name, 400)
        for name in ("benchmark", "conversations", "documents", "pages")
    ]
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return result
