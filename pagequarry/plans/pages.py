"""Web pages to chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.functions.html import page_title
from pagequarry.operators.chunking import (
    MAX_TOKENS,
    MIN_TOKENS,
    chunk_id,
    explode_chunks,
    page_chunks,
    page_chunks_with,
)
from pagequarry.sources.readers import raw_pages


def pages_to_chunks(
    pages: DataFrame,
    max_tokens: int = MAX_TOKENS,
    min_tokens: int = MIN_TOKENS,
    tag: str = "h2",
    content: Column | None = None,
    tokenizer=None,
    keep_tail: bool = False,
    keep_all: bool = False,
) -> DataFrame:
    """``id, url, title, content`` from ``page_id, url, html``; one narrow stage, no shuffle.

    With ``tokenizer`` tokens are counted in Python, otherwise natively. Short
    tails go unless ``keep_tail``; ``keep_all`` loses neither them nor what
    exceeds a chunk's length.
    """
    body = raw_pages(pages.withColumn("url", F.struct("page_id", "url")), content).select("url.page_id", "url.url", "text")
    limits = {"max_tokens": max_tokens, "min_tokens": min_tokens, "tag": tag, "keep_tail": keep_tail, "keep_all": keep_all}
    text = F.col("text")
    chunks = page_chunks(text, **limits) if tokenizer is None else page_chunks_with(text, tokenizer, **limits)
    titled = body.select("page_id", "url", page_title(text).alias("title"), chunks.alias("chunks"))
    rows = explode_chunks(titled, F.col("chunks"), "page_id", "url", "title")
    return rows.select(chunk_id(F.col("page_id"), F.col("chunk_no")).alias("id"), "url", "title", "content")
