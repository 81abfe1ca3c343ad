"""Registered queries: cleaning, HTML and chunking."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagequarry.functions import html, text
from pagequarry.functions.vectors import vector_sum
from pagequarry.operators import chunking, memos
from pagequarry.operators.models import hashed_words, stub_text_model, summarise_with
from pagequarry.operators.prompts import answer_html
from pagequarry.operators.terms import summarise_long_texts
from pagequarry.plans import sql
from pagequarry.plans.memos import memos_to_index
from pagequarry.plans.pages import pages_to_chunks
from pagequarry.plans.registry import query, table, texts
from pagequarry.plans.source_queries import memo_export
from pagequarry.session import new_folder
from pagequarry.sources.readers import read_memo_export


@query(f"SELECT doc_id, {sql.replace_all('text', text.SYMBOL_PATTERN, ' ')} AS text FROM documents")
def symbols_cleaned(spark, folder):
    return texts(spark, folder, "documents").select("doc_id", text.clean_symbols(F.col("text")).alias("text"))


@query(f"""
    SELECT 'memo/' || doc_id AS Link_to_Memo, {sql.replace_all('text', text.SYMBOL_PATTERN, ' ')} AS Text,
           lang || chr(10) || source AS "TO", source AS "FROM",
           strftime(TIMESTAMP '2022-01-05 00:15:00' + to_hours(CAST(n_chars AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS written,
           strftime(TIMESTAMP '2022-01-05 00:15:00' + to_hours(CAST(n_chars AS INTEGER)), '%Y-%m-%d') AS memo_day
    FROM documents""")
def memo_silver(spark, folder):
    """Export to silver: six columns, symbols cleaned, timestamps parsed."""
    silver = memos.silver_memos(memos.raw_memos(read_memo_export(spark, memo_export(spark, folder))))
    return silver.select(
        "Link_to_Memo", "Text", "TO", "FROM",
        F.date_format("Timestamp", "yyyy-MM-dd HH:mm:ss").alias("written"),
        F.date_format("Date_of_Memo", "yyyy-MM-dd").alias("memo_day"),
    )


@query(f"""
    WITH cleaned AS (SELECT doc_id, {sql.replace_all('text', text.SYMBOL_PATTERN, ' ')} AS text FROM documents),
    {sql.vector_sums('t', 'cleaned', 'doc_id', 'text')}
    SELECT 'memo/' || doc_id AS id, md5(text) AS content_hash, 64::BIGINT AS dimension, coalesce(total, 0) AS total
    FROM cleaned LEFT JOIN t ON id = doc_id""")
def memo_index(spark, folder):
    """Export to stored vector index."""
    store = memos_to_index(
        spark, memo_export(spark, folder), new_folder(spark, "memos"), hashed_words(64), "hashed-64"
    )
    index = store.load("hashed-64")
    dimension = F.size("vector").cast("bigint").alias("dimension")
    return index.select("id", "content_hash", dimension, vector_sum(F.col("vector")).alias("total"))


@query("""
    SELECT item_id, strftime(try_strptime(stamp, '%b %d, %Y %I:%M %p'), '%Y-%m-%d %H:%M') AS parsed FROM (
        SELECT event_id AS item_id, CASE event_type WHEN 'error' THEN props
               ELSE strftime(ts, '%b %d, %Y %I:%M %p') END AS stamp FROM events)""")
def parsed_timestamps(spark, folder):
    """Dates in the export's pattern; text that is no date becomes null."""
    events = table(spark, folder, "events")
    stamp = F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.date_format("ts", "MMM dd, yyyy hh:mm a"))
    parsed = memos.parse_timestamp(stamp, memos.TIMESTAMP_FORMAT)
    return events.select(F.col("event_id").alias("item_id"), F.date_format(parsed, "yyyy-MM-dd HH:mm").alias("parsed"))


@query("""
    SELECT source AS metadata_source, page_content FROM (
        SELECT source, CASE WHEN lang <> 'de' THEN text END AS page_content FROM documents)
    WHERE page_content IS NOT NULL""")
def document_records(spark, folder):
    """Document structs of rows that have text."""
    documents = table(spark, folder, "documents").withColumn("text", F.when(F.col("lang") != "de", F.col("text")))
    records = memos.document_records(documents, "text", "source")
    return records.select(
        F.col("document.metadata")["source"].alias("metadata_source"), F.col("document.page_content").alias("page_content")
    )


@query("SELECT doc_id, source FROM documents WHERE lang = 'fr'")
def rows_of_value(spark, folder):
    return table(spark, folder, "documents").filter(F.col("lang") == "fr").select("doc_id", "source")


@query(f"""
    SELECT page_id, {sql.plain(sql.visible(f"regexp_extract(html, {sql.quoted(html.TITLE_PATTERN)}, 1)"))} AS title
    FROM pages""")
def page_titles(spark, folder):
    return texts(spark, folder, "pages").select("page_id", html.page_title(F.col("html")).alias("title"))


@query(f"SELECT page_id, {sql.collapse(sql.plain(sql.visible('html')))} AS text FROM pages")
def page_text(spark, folder):
    pages = texts(spark, folder, "pages")
    return pages.select("page_id", text.collapse_blank_lines(html.html_to_text(F.col("html"))).alias("text"))


@query(f"SELECT page_id, {sql.collapse(sql.plain(sql.visible('html')))} AS text FROM pages")
def page_text_parsed(spark, folder):
    """The same by a parser in a pandas UDF."""
    pages = texts(spark, folder, "pages")
    return pages.select("page_id", text.collapse_blank_lines(html.parsed_text(F.col("html"))).alias("text"))


@query(f"SELECT conv_id, turn, {sql.collapse('text')} AS text FROM conversations")
def blank_lines_collapsed(spark, folder):
    turns = table(spark, folder, "conversations")
    return turns.select("conv_id", "turn", text.collapse_blank_lines(F.col("text")).alias("text"))


def _summaries(source: str, id: str, limit: int, keep: int) -> str:
    """``id, text_short`` of texts over ``limit`` characters by their most telling sentences."""
    return f"""
    WITH {sql.frequencies('c', source, id, 'text')},
    split AS (
        SELECT id, list_filter(list_transform(regexp_extract_all(text, '[^.!?]+[.!?]*'), lambda s: {sql.strip('s')}),
                               lambda s: s <> '') AS sentences
        FROM (SELECT {id} AS id, text FROM {source} WHERE length(text) > {limit})),
    placed AS (SELECT id, unnest(range(len(sentences))) AS position, unnest(sentences) AS sentence FROM split),
    scored AS (
        SELECT id, position, round(sum(ln((n + 1) / (df + 1))) / count(*), 9) AS score
        FROM (SELECT id, position, unnest({sql.words('sentence')}) AS term FROM placed) JOIN c_df USING (term), c_n
        GROUP BY 1, 2),
    best AS (
        SELECT id, position FROM (
            SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, position) AS n FROM scored) WHERE n <= {keep}),
    summaries AS (
        SELECT id, string_agg(sentence, ' ' ORDER BY position) AS summary
        FROM placed JOIN best USING (id, position) GROUP BY id)
    SELECT d.{id}, CASE WHEN length(d.text) > {limit} THEN coalesce(summary, d.text) ELSE d.text END AS text_short
    FROM {source} d LEFT JOIN summaries s ON s.id = d.{id}"""


@query(_summaries("documents", "doc_id", 10_000, 3))
def long_texts_summarised(spark, folder):
    documents = texts(spark, folder, "documents").select("doc_id", "text")
    return summarise_long_texts(documents, "doc_id", "text").select("doc_id", "text_short")


@query("""
    SELECT doc_id, CASE WHEN length(text) > 10000 THEN text || 'Reply ' || md5(text) ELSE text END AS text_short
    FROM documents""")
def long_texts_by_model(spark, folder):
    """Only texts over 10,000 characters are sent to the model."""
    short = summarise_with(F.col("text"), stub_text_model())
    return texts(spark, folder, "documents").select("doc_id", short.alias("text_short"))


@query(f"""
    SELECT doc_id, array_to_string(list_filter({sql.words('text')},
           lambda w: w NOT IN ({', '.join(sql.quoted(w) for w in text.STOP_WORDS)})), ' ') AS text
    FROM documents""")
def stop_words_removed(spark, folder):
    return texts(spark, folder, "documents").select("doc_id", text.remove_stop_words(F.col("text")).alias("text"))


@query(f"""
    SELECT doc_id, trim({sql.replace_all(f"lower({sql.replace_all('text', text.ILLEGAL_PATTERN, '')})", r'[[:space:]]+', ' ')}) AS text
    FROM documents""")
def characters_normalised(spark, folder):
    return texts(spark, folder, "documents").select("doc_id", text.normalise_case(F.col("text")).alias("text"))


@query("SELECT conv_id, turn, replace(text, chr(10), '<br/>') AS text FROM conversations")
def html_line_breaks(spark, folder):
    turns = table(spark, folder, "conversations")
    return turns.select("conv_id", "turn", text.line_breaks_to_html(F.col("text")).alias("text"))


@query("""
    SELECT conv_id, turn,
           '<section><h4>' || role || '</h4><p>' || text || '</p><ul><li>' || role || '</li><li>' || turn || '</li></ul></section>'
           AS fragment
    FROM conversations""")
def answer_fragments(spark, folder):
    sources = F.array(F.col("role"), F.col("turn").cast("string"))
    fragment = answer_html(F.col("role"), F.col("text"), sources)
    return table(spark, folder, "conversations").select("conv_id", "turn", fragment.alias("fragment"))


PATTERNS = {"blank_separated": r"\S+", "words_and_marks": r"\w+|[^\w\s]", "letters": "[a-z]+"}


@query("SELECT doc_id, " + ", ".join(f"len({sql.tokens('text', p)})::BIGINT AS {n}" for n, p in PATTERNS.items()) + " FROM documents")
def token_counts(spark, folder):
    counts = [text.token_count(F.col("text"), p).cast("bigint").alias(n) for n, p in PATTERNS.items()]
    return texts(spark, folder, "documents").select("doc_id", *counts)


@query(f"SELECT doc_id, {sql.truncated('text', 100)} AS text FROM documents")
def token_truncation(spark, folder):
    return texts(spark, folder, "documents").select("doc_id", text.truncate_tokens(F.col("text"), 100).alias("text"))


# Page articles are short and have no sections, so the queries pack paragraphs.
CHUNK_LIMITS = {"max_tokens": 100, "min_tokens": 10, "tag": "p"}

_PAGE_CHUNKS = f"""
    WITH RECURSIVE articles AS (
        SELECT page_id, url, {sql.plain(sql.visible(f"regexp_extract(html, {sql.quoted(html.TITLE_PATTERN)}, 1)"))} AS title,
               string_split(regexp_replace({sql.visible('body')}, '(<p[ >])', chr(1) || '\\1', 'g'), chr(1)) AS raw
        FROM (SELECT *, trim({sql.article()}) AS body FROM pages) WHERE body IS NOT NULL),
    parts AS (
        SELECT page_id, url, title, list_transform(raw, lambda r: {sql.plain('r')}) AS parts FROM articles),
    whole AS (SELECT *, array_to_string(parts, '') AS text FROM parts),
    fold(page_id, step, grown, done) AS (
        SELECT page_id, 1, '', CAST([] AS VARCHAR[]) FROM whole WHERE len({sql.tokens('text')}) > 100
        UNION ALL
        SELECT f.page_id, step + 1,
               CASE WHEN len({sql.tokens('grown')}) * 2 > 100 THEN parts[step] ELSE grown || parts[step] END,
               CASE WHEN len({sql.tokens('grown')}) * 2 > 100 THEN list_append(done, grown) ELSE done END
        FROM fold f JOIN whole w USING (page_id) WHERE step <= len(parts)),
    packed AS (
        SELECT page_id, CASE WHEN len({sql.tokens('grown')}) > 10 THEN list_append(done, grown) ELSE done END AS chunks
        FROM fold JOIN whole USING (page_id) WHERE step = len(parts) + 1),
    listed AS (
        SELECT page_id, list_transform(chunks, lambda c: {sql.collapse('c')}) AS chunks, true AS cut FROM packed
        UNION ALL
        SELECT page_id, [{sql.collapse('text')}], false FROM whole WHERE len({sql.tokens('text')}) <= 100),
    numbered AS (
        SELECT page_id, cut, unnest(range(len(chunks))) AS chunk_no, unnest(chunks) AS content FROM listed)
    SELECT page_id * 65536 + chunk_no AS id, url, title,
           CASE WHEN cut THEN {sql.truncated('content', 100)} ELSE content END AS content
    FROM numbered JOIN whole USING (page_id)"""


@query(_PAGE_CHUNKS)
def page_chunks(spark, folder):
    """Pages to chunks: main content, title, section packing, row ids."""
    return pages_to_chunks(texts(spark, folder, "pages"), **CHUNK_LIMITS)


@query(_PAGE_CHUNKS)
def page_chunks_tokenizer(spark, folder):
    """The same chunks by a Python tokenizer in a pandas UDF."""
    return pages_to_chunks(texts(spark, folder, "pages"), tokenizer=chunking.RegexTokenizer, **CHUNK_LIMITS)


_PIECES = sql.pieces(sql.collapse("c"))
_WHOLE_CHUNKS = (
    _PAGE_CHUNKS.replace("> 10 THEN list_append", "> 0 THEN list_append")
    .replace(f"list_transform(chunks, lambda c: {sql.collapse('c')})", f"""flatten(list_transform(chunks, lambda c:
            list_transform(range(0, len({_PIECES}), 100), lambda i: array_to_string(list_slice({_PIECES}, i + 1, i + 100), ''))))""")
    .replace(sql.truncated("content", 100), "content")
)


@query(_WHOLE_CHUNKS)
def whole_page_chunks(spark, folder):
    """Chunks that lose nothing: tails stay and long sections go on in further chunks."""
    return pages_to_chunks(texts(spark, folder, "pages"), keep_all=True, **CHUNK_LIMITS)


@query(_WHOLE_CHUNKS)
def whole_page_chunks_tokenizer(spark, folder):
    return pages_to_chunks(
        texts(spark, folder, "pages"), tokenizer=chunking.RegexTokenizer, keep_all=True, **CHUNK_LIMITS
    )


@query("""
    SELECT doc_id, chunk_no, paragraphs[chunk_no + 1] AS content FROM (
        SELECT doc_id, paragraphs, unnest(range(len(paragraphs))) AS chunk_no FROM (
            SELECT doc_id, list_filter(string_split(text, chr(10)), lambda p: trim(p) <> '') AS paragraphs FROM documents))""")
def paragraph_chunks(spark, folder):
    return chunking.explode_chunks(table(spark, folder, "documents"), chunking.paragraphs(F.col("text")), "doc_id")


def _fixed(size: int) -> str:
    return f"""
        SELECT doc_id, unnest(range(CAST(ceil(len(p) / {size}) AS BIGINT))) AS chunk_no, p FROM (
            SELECT doc_id, {sql.pieces('text')} AS p FROM documents)"""


@query(f"""
    SELECT doc_id, chunk_no, array_to_string(list_slice(p, chunk_no * 200 + 1, chunk_no * 200 + 200), '') AS content
    FROM ({_fixed(200)})""")
def fixed_length_chunks(spark, folder):
    chunks = chunking.fixed_length_chunks(F.col("text"), 200)
    return chunking.explode_chunks(texts(spark, folder, "documents"), chunks, "doc_id")


_CHUNKS_2000 = f"""(
    SELECT doc_id * 65536 + chunk_no AS id,
           array_to_string(list_slice(p, chunk_no * 2000 + 1, chunk_no * 2000 + 2000), '') AS text
    FROM ({_fixed(2000)}))"""


@query(_summaries("chunks", "id", 5_000, 5).replace("WITH ", f"WITH chunks AS {_CHUNKS_2000}, ", 1))
def chunk_summaries(spark, folder):
    """Big chunks, each summarised once."""
    chunks = chunking.explode_chunks(
        texts(spark, folder, "documents"), chunking.fixed_length_chunks(F.col("text"), 2000), "doc_id", content="text"
    )
    keyed = chunks.select(chunking.chunk_id(F.col("doc_id"), F.col("chunk_no")).alias("id"), "text")
    return summarise_long_texts(keyed, "id", "text", limit=5_000, keep=5).select("id", "text_short")
